"""Registered queries of the library, each with its check in SQL.

Every query reads whole tables: the telemetry projection of ``events``, or data
Spark derives from it.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import replay  # noqa: E402
from oracles import oracles  # noqa: E402
from voltfleet.functions import derive  # noqa: E402
from voltfleet.operators import dedup, fill, metrics, outliers, quality, realtime, reports  # noqa: E402
from voltfleet.plans import cleaning, incremental, warehouse  # noqa: E402
from voltfleet.schema import normalise  # noqa: E402
from voltfleet.sources import files, messages, sample  # noqa: E402
from voltfleet.sources.workspace import fresh_folder, materialise  # noqa: E402
from voltfleet.streaming import carried, jobs, windows  # noqa: E402

try:  # the text operators and the pipeline may be left out of an installation
    import corpus_pipeline
    from voltfleet.llm import queries as text_queries
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("corpus_pipeline", "voltfleet.llm")):
        raise
    corpus_pipeline = text_queries = None

Query = Callable[[SparkSession, str], DataFrame]
RUN_TIME = "2024-02-01 00:00:00"
FIELDS = ["seq", "timestamp", "vehicle_id"]


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.dated(spark, sf_dir)


def _unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.deduplicate(_raw(spark, sf_dir))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(_raw(spark, sf_dir))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.daily_metrics(_clean(spark, sf_dir))


def _layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily metrics as a stored table, for reports that read it more than once."""
    return materialise(_daily(spark, sf_dir), "daily")


def _stages(spark: SparkSession, sf_dir: str) -> cleaning.Stages:
    return cleaning.clean_stages(_raw(spark, sf_dir))


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cleaning_report(cleaning.stored(_stages(spark, sf_dir)), RUN_TIME)


def _fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise(sample.fine(spark, sf_dir))


def _written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise(sample.written(spark, sf_dir))


def _written_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(_written(spark, sf_dir))


def _fill(strategy: str, records: Query = _raw) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        unique = materialise(dedup.deduplicate(records(spark, sf_dir)), "unique")
        filled = fill.fill_nulls(unique, {"default": strategy}, unique=True)
        return filled.select(*FIELDS, "speed", "battery_voltage", "soc")

    return query


def _metric(name: str) -> Query:
    return lambda spark, sf_dir: metrics.metric(_daily(spark, sf_dir), name)


def _derive_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.add_status(_unique(spark, sf_dir)).select(*FIELDS, *derive.STATUS)


def _derive_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _unique(spark, sf_dir)
    out = derive.add_flags(derive.add_power(base))
    return out.select(*FIELDS, *[c for c in out.columns if c not in base.columns])


def _speed_acceleration(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = realtime.speed_acceleration(_clean(spark, sf_dir), unique=True)
    return out.select(*FIELDS, "speed_acceleration")


def _clip_iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    unique = materialise(_unique(spark, sf_dir), "unique")
    return outliers.handle_outliers(unique, method="iqr", action="clip")


def _soc_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _layer(spark, sf_dir)
    hot = metrics.metric(wide, "high_temp_duration")
    return metrics.battery_health_by_join(hot, wide.select("vehicle_id", "date", "soc_cycles"))


def _quality_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.quality_stats(_report(spark, sf_dir))


def _overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.overview(_raw(spark, sf_dir), _clean(spark, sf_dir))


def _streamed(records: Query, job, updates: list[str] | None = None) -> Query:
    """Play records back as messages and run a stream job over them, slice by slice.

    Every run stops when it has read what is there; the next one resumes from the
    checkpoint with the state the last one left.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = materialise(records(spark, sf_dir).drop("date"), "feed")
        inbox, outbox = fresh_folder(spark, "inbox"), fresh_folder(spark, "outbox")
        checkpoint = fresh_folder(spark, "checkpoint")
        for _ in replay.play(source, inbox):
            stream = job(messages.decode(messages.read_topic(spark, inbox, "text")))
            run = jobs.run_to_table if updates is None else jobs.run_updates
            run(stream, outbox, checkpoint)
        if updates is not None:
            return jobs.latest_updates(spark, outbox, updates)
        return spark.read.parquet(outbox)

    return query


def _wall_clock(result: Query, *columns: str) -> Query:
    """Stream times back to wall-clock stamps."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = result(spark, sf_dir)
        for c in columns:
            df = df.withColumn(c, df[c].cast("timestamp_ntz"))
        return df

    return query


def _stream_derive(stream: DataFrame) -> DataFrame:
    out = windows.stream_derive(stream)
    return out.select(*FIELDS, *[c for c in out.columns if c not in stream.columns])


#: Seconds that records wait for late ones: the longest that a slice of the played records lasts.
SLICES = 3
DELAYED = "seq % 10 = 0"


def _carried(records: Query, job, late: str = "false", wait: bool = False, side: bool = False) -> Query:
    """Play records back and run a vehicle operator over them, a run for every slice.

    ``wait``: records wait as long as a slice lasts. ``side``: the records that came too late.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = materialise(records(spark, sf_dir).drop("date"), "feed")
        inbox, checkpoint = fresh_folder(spark, "inbox"), fresh_folder(spark, "checkpoint")
        delay = replay.width_of(source, SLICES) if wait else 0
        run = job(fresh_folder(spark, "carried"), delay=delay)
        for _ in replay.play(source, inbox, SLICES, late):
            stream = messages.decode(messages.read_topic(spark, inbox, "text"), kind="timestamp_ntz")
            jobs.run_carried(stream, run, checkpoint)
        if wait:
            run.flush(spark)
        return run.late(spark) if side else run.results(spark)

    return query


def _stream_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in, window metrics out as messages, and those read back."""
    source = materialise(_clean(spark, sf_dir).drop("date"), "feed")
    inbox, outbox = fresh_folder(spark, "inbox"), fresh_folder(spark, "topic")
    checkpoint = fresh_folder(spark, "checkpoint")
    for _ in replay.play(source, inbox):
        run = jobs.start_realtime(spark, inbox, outbox, checkpoint, fmt="text", available_now=True)
        run.awaitTermination()
    schema = messages.text_times(realtime.window_metrics(source.limit(0)).schema)
    return messages.decode(spark.read.text(outbox), schema, time="window_end_time", kind="timestamp_ntz")


def _letters(table: str) -> Query:
    """Messages with broken ones among them, split into records and dead letters."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        sent = sample.with_broken(messages.encode(sample.telemetry(spark, sf_dir)))
        inbox, outbox = fresh_folder(spark, "inbox"), fresh_folder(spark, "letters")
        checkpoint = fresh_folder(spark, "checkpoint")
        for part in ("seq % 2 = 0", "seq % 2 = 1"):
            sent.filter(part).select("value").write.mode("append").text(inbox)
            jobs.run_letters(messages.read_topic(spark, inbox, "text"), outbox, checkpoint)
        out = spark.read.parquet(f"{outbox}/{table}").drop("batch", "malformed")
        return out.withColumn("timestamp", out["timestamp"].cast("timestamp_ntz")) if table == "records" else out

    return query


def _message_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = messages.encode(sample.telemetry(spark, sf_dir))
    return normalise(messages.decode(encoded)).drop("date")


def _sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "dwd")
    files.write_layer(warehouse.detail_layer(_raw(spark, sf_dir)), path)
    return spark.read.parquet(path)


def _sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "csv")
    files.write_layer(_clean(spark, sf_dir).drop("date"), path, "csv")
    return files.read_csv(spark, path, with_seq=True)


def _sink_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "metrics")
    files.write_metrics(metrics.summary_rows(_daily(spark, sf_dir), RUN_TIME), path)
    return metrics.union_by_name(files.read_metrics(spark, path), RUN_TIME)


def _newest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries in a landing folder; the later one holds no null speed."""
    folder = fresh_folder(spark, "landing")
    raw = sample.telemetry(spark, sf_dir)
    files.write_csv(raw.filter("speed IS NULL").repartition(4), f"{folder}/first")
    files.write_csv(raw.filter("speed IS NOT NULL").repartition(4), f"{folder}/second")
    return files.read_newest(spark, folder, with_seq=True)


def _latest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, report = fresh_folder(spark, "reports"), _report(spark, sf_dir)
    early = report.withColumn("final_record_count", F.lit(0))
    files.write_report(early, f"{folder}/quality_report_20240131_000000")
    files.write_report(report, f"{folder}/quality_report_20240201_000000")
    return reports.quality_stats(files.latest_report(spark, folder, report.schema))


def _warehouse_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = warehouse.run_warehouse(
        sample.telemetry(spark, sf_dir), fresh_folder(spark, "warehouse"), RUN_TIME
    )
    return done["dws"]


#: Records that come with a second delivery: the last day, and late ones of another day.
SECOND = "(date = DATE '2024-01-04' OR date = DATE '2024-01-02' AND seq % 50 = 7)"


def _delivered(layer: str) -> Query:
    """A layer of a warehouse that has taken all records in two deliveries."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw, out = _raw(spark, sf_dir), fresh_folder(spark, "deliveries")
        incremental.deliver(raw.filter(f"NOT {SECOND}"), out, "first")
        return incremental.deliver(raw.filter(SECOND), out, "second")[layer]

    return query


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: raw records to the eight daily metrics of each vehicle."""
    return _daily(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    batch = {
        "telemetry": _raw,
        "derive_status": _derive_status,
        "derive_power": _derive_power,
        "speed_acceleration": _speed_acceleration,
        "dedup": _unique,
        "written_times": _written,
        "written_dedup": lambda s, d: dedup.deduplicate(_written(s, d)),
        "written_duplicates": lambda s, d: dedup.duplicate_counts(_written(s, d)),
        "written_ffill": _fill("ffill", _written),
        "written_pairs": lambda s, d: realtime.pairwise_metrics(_written_clean(s, d), unique=True),
        "written_windows": lambda s, d: realtime.window_metrics(_written_clean(s, d)),
        "ffill": _fill("ffill"),
        "bfill": _fill("bfill"),
        "fill_median": _fill("median"),
        "fill_mean": _fill("mean"),
        "fill_zero": _fill("zero"),
        "clip": lambda s, d: outliers.handle_outliers(_unique(s, d)),
        "remove_outliers": lambda s, d: outliers.handle_outliers(_unique(s, d), action="remove"),
        "null_outliers": lambda s, d: outliers.handle_outliers(_unique(s, d), action="nan"),
        "clip_iqr": _clip_iqr,
        "clean_all": _clean,
        "detail_layer": lambda s, d: warehouse.detail_layer(_raw(s, d)),
        "daily_energy": _metric("daily_energy_consumption"),
        "rapid_acceleration": _metric("rapid_acceleration_count"),
        "high_temp": _metric("high_temp_duration"),
        "daily_mileage": _metric("daily_mileage"),
        "charging_frequency": _metric("charging_frequency"),
        "average_speed": _metric("average_speed"),
        "brake_recovery": _metric("brake_energy_recovery_rate"),
        "battery_health": _metric("battery_health_index"),
        "soc_join": _soc_join,
        "daily_metrics": _daily,
        "dws_union": lambda s, d: metrics.summary_rows(_daily(s, d), RUN_TIME),
        "window_last100": lambda s, d: realtime.window_metrics(_clean(s, d)),
        "latest_per_vehicle": lambda s, d: realtime.latest_metrics(_clean(s, d)),
        "pairwise_metrics": lambda s, d: realtime.pairwise_metrics(_clean(s, d), unique=True),
        "sliding_5s": lambda s, d: realtime.sliding_windows(_clean(s, d), unique=True),
        "fine_daily": lambda s, d: metrics.daily_metrics(cleaning.clean(_fine(s, d))),
        "fine_windows": lambda s, d: realtime.window_metrics(cleaning.clean(_fine(s, d))),
        "fine_mean": _fill("mean", _fine),
        "fine_profile": lambda s, d: reports.column_profile(_fine(s, d)),
        "sliding_30s": lambda s, d: realtime.sliding_windows(_clean(s, d), size=30, unique=True),
    }
    checks = {
        "completeness": lambda s, d: quality.completeness(_raw(s, d)),
        "null_rates": lambda s, d: quality.null_rates(_raw(s, d)),
        "duplicates": lambda s, d: dedup.duplicate_counts(_raw(s, d)),
        "duplicate_examples": lambda s, d: dedup.duplicate_examples(_raw(s, d)),
        "iqr_outliers": lambda s, d: quality.iqr_outliers(_raw(s, d)),
        "physical_outliers": lambda s, d: quality.physical_outliers(_raw(s, d)),
        "outlier_totals": lambda s, d: quality.outlier_totals(_raw(s, d)),
        "cleaning_counters": lambda s, d: cleaning.cleaning_counters(_stages(s, d)),
        "improvement": lambda s, d: cleaning.improvement(_stages(s, d)),
        "quality_gate": lambda s, d: quality.quality_gate(_raw(s, d)),
        "quality_report": lambda s, d: quality.quality_report(_raw(s, d), RUN_TIME),
        "cleaning_report": _report,
        "quality_stats": _quality_stats,
    }
    figures = {
        "summary_statistics": lambda s, d: reports.summary_statistics(_layer(s, d)),
        "vehicle_summary": lambda s, d: reports.vehicle_summary(_daily(s, d)),
        "metric_ranges": lambda s, d: reports.metric_ranges(_daily(s, d)),
        "records_per_day": lambda s, d: reports.records_per_day(_unique(s, d)),
        "top_vehicles": lambda s, d: reports.top_vehicles(_unique(s, d)),
        "daily_trend": lambda s, d: reports.mean_by(_daily(s, d), "date"),
        "vehicle_distribution": lambda s, d: reports.mean_by(_daily(s, d), "vehicle_id"),
        "metric_cards": lambda s, d: reports.metric_cards(_daily(s, d)),
        "null_ranking": lambda s, d: reports.null_ranking(_raw(s, d)),
        "outlier_share": lambda s, d: reports.outlier_share(_raw(s, d)),
        "overview": _overview,
        "profile": lambda s, d: reports.column_profile(_raw(s, d)),
        "value_counts": lambda s, d: reports.value_counts(_raw(s, d), "vehicle_id"),
        "latest_points": lambda s, d: reports.latest_points(_raw(s, d)),
        "head_n": lambda s, d: reports.head(_raw(s, d), 20),
    }
    key = ["window_start", "window_end_time", "vehicle_id"]
    streams = {
        "stream_parse": _wall_clock(_streamed(sample.telemetry, lambda s: s), "timestamp"),
        "stream_dedup": _wall_clock(
            _streamed(
                sample.telemetry,
                lambda s: windows.stream_deduplicate(s).select("vehicle_id", "timestamp"),
            ),
            "timestamp",
        ),
        "stream_derive": _wall_clock(_streamed(_unique, _stream_derive), "timestamp"),
        "stream_sliding": _streamed(_clean, windows.stream_sliding_windows, updates=key),
        "stream_last100": _carried(_clean, carried.window_metrics),
        "stream_pairwise": _carried(_clean, carried.pairwise_metrics),
        "stream_late": _carried(_clean, carried.window_metrics, DELAYED, wait=True),
        "stream_late_records": _carried(_clean, carried.window_metrics, DELAYED, side=True),
        "stream_roundtrip": _stream_roundtrip,
        "stream_letters": _letters("records"),
        "stream_dead_letters": _letters("dead"),
        "written_stream": _carried(_written_clean, carried.window_metrics),
    }
    sinks = {
        "message_roundtrip": _message_roundtrip,
        "sink_roundtrip_parquet": _sink_parquet,
        "sink_roundtrip_csv": _sink_csv,
        "sink_metrics": _sink_metrics,
        "newest_file": _newest_file,
        "latest_report": _latest_report,
        "warehouse_layers": _warehouse_layers,
        "delivered_details": _delivered("dwd"),
        "delivered_metrics": _delivered("dws"),
        "delivered_windows": lambda s, d: _delivered("realtime")(s, d).drop("date"),
    }
    text = {}
    if text_queries:
        text = {**text_queries.QUERIES, "pipeline": corpus_pipeline.run}
    return {**batch, **checks, **figures, **streams, **sinks, **text}


def oracle_sql() -> dict[str, str]:
    found = oracles()
    if text_queries:
        found = {**found, **text_queries.ORACLES}
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
