"""Streams against batch, resumption, late records, malformed messages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
import replay
from voltfleet.operators import realtime
from voltfleet.schema import normalise
from voltfleet.settings import Settings
from voltfleet.sources import messages, sample
from voltfleet.sources.workspace import children, fresh_folder
from voltfleet.streaming import carried, jobs, windows


def stream_over(spark, parts, job, runner=jobs.run_to_table):
    """Send the parts one by one, running the job to its end after each."""
    inbox, outbox, checkpoint = (fresh_folder(spark, n) for n in ("in", "out", "ckpt"))
    for part in parts:
        messages.send_batch(part.drop("date"), inbox, fmt="text")
        stream = messages.decode(messages.read_topic(spark, inbox, "text"))
        runner(job(stream), outbox, checkpoint)
    return outbox


def rows(df, *drop):
    return sorted(map(str, (r.asDict() for r in df.drop(*drop).collect())))


@pytest.fixture(scope="module")
def drive(records):
    return records(
        *[
            {"at": 7 * i, "vehicle_id": f"EV_{i % 2}", "speed": float(i % 90), "soc": 90.0 - i / 10}
            for i in range(240)
        ]
    )


def carried_over(spark, parts, make, flush=False, **options):
    """Send the parts one by one, running a vehicle operator to its end after each."""
    inbox, folder, checkpoint = (fresh_folder(spark, n) for n in ("in", "carried", "ckpt"))
    job = make(folder, **options)
    for part in parts:
        messages.send_batch(part.drop("date"), inbox, fmt="text")
        stream = messages.decode(messages.read_topic(spark, inbox, "text"), kind="timestamp_ntz")
        jobs.run_carried(stream, job, checkpoint)
    if flush:
        job.flush(spark)
    return job


def test_count_window_resumes_from_its_tables(spark, drive):
    job = carried_over(spark, replay.time_slices(drive, 3), carried.window_metrics)
    got = job.results(spark)
    assert got.count() == 238
    assert rows(got) == rows(realtime.window_metrics(drive).select(*got.columns))
    assert job.late(spark).count() == 0


def test_pairs_resume_from_their_tables(spark, drive):
    got = carried_over(spark, replay.time_slices(drive, 2), carried.pairwise_metrics).results(spark)
    assert rows(got) == rows(realtime.pairwise_metrics(drive).select(*got.columns))


def test_late_records_go_to_a_table_of_their_own(spark, records):
    df = records({"at": 0}, {"at": 20}, {"at": 10, "speed": 99.0}, {"at": 30})
    parts = [df.filter("seq < 2"), df.filter("seq >= 2")]
    job = carried_over(spark, parts, carried.window_metrics)
    got = job.results(spark).orderBy("seq").collect()
    assert [r["seq"] for r in got] == [1, 3] and got[-1]["record_count"] == 3
    late = job.late(spark).collect()
    assert [(r["seq"], r["speed"]) for r in late] == [(2, 99.0)]  # the whole record
    done = spark.read.parquet(job._state(job._before(spark, 2**40), "done")).first()
    assert done["late_records"] == 1 and done["pending_records"] == 0


@pytest.mark.parametrize("make, operator", [
    (carried.window_metrics, realtime.window_metrics), (carried.pairwise_metrics, realtime.pairwise_metrics)
])
def test_the_buffer_puts_late_records_in_their_place(spark, drive, make, operator):
    parts = replay.time_slices(drive, 3, "seq % 10 = 0")
    assert len(parts) == 4
    job = carried_over(spark, parts, make, flush=True, delay=replay.width_of(drive, 3))
    got = job.results(spark)
    assert rows(got) == rows(operator(drive).select(*got.columns))
    assert job.late(spark).count() == 0


def test_records_wait_until_the_delay_has_passed(spark, records):
    df = records(*[{"at": 10 * i} for i in range(6)])
    job = carried_over(spark, [df.filter("seq < 4"), df.filter("seq >= 4")], carried.pairwise_metrics, delay=20)
    assert sorted(r["seq"] for r in job.results(spark).collect()) == [0, 1, 2, 3]
    job.flush(spark)
    assert sorted(r["seq"] for r in job.results(spark).collect()) == [0, 1, 2, 3, 4, 5]


def test_a_batch_that_is_run_again_changes_nothing(spark, drive):
    job = carried.window_metrics(fresh_folder(spark, "carried"), delay=60)
    parts = [p.drop("date") for p in replay.time_slices(drive, 3, "seq % 10 = 0")]
    for number, part in enumerate(parts[:2]):
        job(part, number)
    once = rows(job.results(spark)), rows(job.late(spark)), rows(spark.read.parquet(job._state(1, "carry")))
    job(parts[1], 1)
    assert once == (rows(job.results(spark)), rows(job.late(spark)), rows(spark.read.parquet(job._state(1, "carry"))))
    emitted = []
    job.emit = lambda df, number: emitted.append((number, df.count()))

    def broken(rows, fresh):
        raise RuntimeError("lost")

    whole, job.operator = job.operator, broken
    with pytest.raises(RuntimeError):
        job(parts[2], 2)
    job.operator = whole
    job(parts[2], 2)  # goes on from batch 1, not from what the broken run left
    straight = carried.window_metrics(fresh_folder(spark, "carried"), delay=60)
    for number, part in enumerate(parts[:3]):
        straight(part, number)
    assert rows(job.results(spark)) == rows(straight.results(spark)) and emitted[0][0] == 2
    names = children(spark, f"{job.folder}/state")
    assert names == ["batch=1", "batch=2"]  # older tables are gone


def test_a_busy_vehicle_is_cut_into_blocks_and_no_python_runs(spark, records):
    busy = records(*[{"at": i, "vehicle_id": "EV_1" if i % 3 else f"EV_{i % 30}", "speed": float(i % 50)} for i in range(600)])
    cfg = Settings(block_rows=128)
    plans = []

    def spy(folder, **options):
        job = carried.window_metrics(folder, cfg, **options)
        operator = job.operator

        def run(rows, fresh):
            out = operator(rows, fresh)
            plans.append(out._jdf.queryExecution().executedPlan().toString())
            return out

        job.operator = run
        return job

    got = carried_over(spark, replay.time_slices(busy, 2), spy).results(spark)
    assert rows(got) == rows(realtime.window_metrics(busy).select(*got.columns))
    assert plans and not any(k in p for p in plans for k in ("Python", "Pandas", "Arrow"))
    assert all("_block" in p for p in plans)


def test_records_without_seq_as_the_topic_sends_them(spark, drive):
    sent = drive.drop("seq", "date").orderBy("timestamp").coalesce(1)
    inbox, folder, checkpoint = (fresh_folder(spark, n) for n in ("in", "carried", "ckpt"))
    messages.send_batch(sent, inbox, fmt="text")
    job = carried.pairwise_metrics(folder)
    jobs.run_carried(messages.decode(messages.read_topic(spark, inbox, "text"), kind="timestamp_ntz"), job, checkpoint)
    got = job.results(spark).drop("seq")
    assert rows(got) == rows(realtime.pairwise_metrics(drive).select(*got.columns))


def test_unread_times_stay_in_the_tables(spark, records):
    df = records({"at": 0}, {"at": 20}, {"at": "n/a", "soc": 40.0}, {"at": 10}, {"at": 30}, {"at": 40})
    parts = [df.filter("seq < 2"), df.filter("seq = 2"), df.filter("seq > 2")]
    got = {}
    for make in (carried.window_metrics, carried.pairwise_metrics):
        job = carried_over(spark, parts, make)
        got[make] = {r["seq"]: r for r in job.results(spark).collect()}
        assert [r["seq"] for r in job.late(spark).collect()] == [3]  # 10 is late, as 20 was read
    window, pair = got.values()
    assert sorted(window) == [1, 2, 4, 5] and sorted(pair) == [0, 1, 2, 4, 5]
    assert window[2]["window_end_time"] is None and window[2]["window_duration"] == 1.0
    assert window[5]["record_count"] == 5 and window[5]["window_duration"] == 40.0
    assert pair[2]["soc_rate_per_hour"] == -7200.0 == -pair[4]["soc_rate_per_hour"]


def test_played_records_with_unread_times_equal_batch(spark):
    written = normalise(sample.written(spark, SF_SMALL).limit(400)).cache()
    unread = written.filter("timestamp IS NULL").count()
    parts = replay.time_slices(written, 2)
    assert unread and sum(p.count() for p in parts) == 400
    for make, operator in ((carried.pairwise_metrics, realtime.pairwise_metrics), (carried.window_metrics, realtime.window_metrics)):
        got = carried_over(spark, parts, make).results(spark)
        assert rows(got) == rows(operator(written).select(*got.columns))


def test_dead_letters_stay_the_same_after_a_rerun(spark, records):
    sent = messages.encode(records({}, {}).drop("date")).select("value")
    bad = spark.createDataFrame([("{not json",), ('{"speed": 3}',)], "value string")
    inbox, outbox = fresh_folder(spark, "in"), fresh_folder(spark, "letters")
    sent.unionByName(bad).write.text(inbox)
    for _ in range(2):  # a checkpoint that was lost: the batch comes again under its number
        jobs.run_letters(messages.read_topic(spark, inbox, "text"), outbox, fresh_folder(spark, "ckpt"))
    assert spark.read.parquet(f"{outbox}/records").count() == 2
    assert {r["line"] for r in spark.read.parquet(f"{outbox}/dead").collect()} == {"{not json", '{"speed": 3}'}


def test_event_time_windows_update(spark, drive):
    out = stream_over(
        spark, replay.time_slices(drive, 2), windows.stream_sliding_windows, jobs.run_updates
    )
    key = ["window_start", "window_end_time", "vehicle_id"]
    got = jobs.latest_updates(spark, out, key)
    want = realtime.sliding_windows(drive).select(*got.columns)
    assert rows(got) == rows(want)


def test_records_behind_the_watermark_are_dropped(spark, records):
    df = records({"at": 0}, {"at": 7200}, {"at": 3, "speed": 1.0})
    parts = [df.filter("seq < 2"), df.filter("seq = 2")]
    job = lambda s: windows.stream_sliding_windows(s, delay="1 minute")
    out = stream_over(spark, parts, job, jobs.run_updates)
    got = jobs.latest_updates(spark, out, ["window_start", "vehicle_id"])
    assert got.filter("min_speed = 1.0").count() == 0 and got.count() == 10


def test_copies_are_dropped_across_batches(spark, records):
    df = records({"at": 0}, {"at": 0, "speed": 1.0}, {"at": 5}, {"at": 5})
    out = stream_over(
        spark, [df.filter("seq < 3"), df.filter("seq = 3")], windows.stream_deduplicate
    )
    assert spark.read.parquet(out).count() == 2


def test_derived_columns_equal_batch(spark, drive):
    out = stream_over(spark, [drive], windows.stream_derive)
    got = spark.read.parquet(out)
    want = windows.stream_derive(drive.drop("date")).select(*got.columns)
    as_text = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    assert rows(got.withColumn("timestamp", as_text)) == rows(want.withColumn("timestamp", as_text))


def test_malformed_messages(spark, records):
    good = messages.encode(records({}).drop("date"))
    bad = spark.createDataFrame(
        [("k", "{not json"), ("k", ""), ("k", "[1]"), ("k", '{"speed": 3}')], "key string, value string"
    )
    both = good.unionByName(bad)
    assert messages.decode(both).count() == 1
    kept = messages.decode(both, keep_malformed=True)
    assert kept.filter("malformed = '{not json'").count() == 1
    sent = messages.envelope(good, "vehicle_can_data", 1).first()
    assert sent["key"] == "EV_001" and sent["topic"] == "vehicle_can_data"


def test_topic_to_topic(spark, drive):
    inbox, outbox, checkpoint = (fresh_folder(spark, n) for n in ("in", "topic", "ckpt"))
    messages.send_batch(drive.drop("date"), inbox, fmt="text")
    run = jobs.start_realtime(
        spark, inbox, outbox, checkpoint, fmt="text", available_now=True
    )
    run.awaitTermination()
    schema = messages.text_times(realtime.window_metrics(drive).schema)
    sent = messages.decode(spark.read.text(outbox), schema, time="window_end_time", kind="timestamp_ntz")
    assert rows(sent) == rows(realtime.window_metrics(drive).select(*sent.columns))
