"""Skew, block borders, exact quantiles and the shape of the plans."""

from __future__ import annotations

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from voltfleet.operators import dedup, metrics, quality, quantiles, realtime
from voltfleet.operators.ordering import in_blocks, with_position, with_previous
from voltfleet.plans.cleaning import clean
from voltfleet.settings import DEFAULTS
from voltfleet.sources.sample import dated
from voltfleet.sources.workspace import materialise


@pytest.fixture(scope="module")
def cleaned(spark):
    return materialise(clean(dated(spark, SF_SMALL)), "test")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_cuts_copies_before_the_shuffle(spark):
    text = plan(dedup.deduplicate(dated(spark, SF_SMALL)))
    partial = text.index("WindowGroupLimit", text.index("Exchange"))
    assert "Partial" in text[partial : partial + 300]
    assert text.count("Exchange hashpartitioning") == 1


def test_daily_metrics_shuffles_records_once(cleaned):
    text = plan(metrics.daily_metrics(cleaned))
    by_day = [l for l in text.splitlines() if "Exchange hashpartitioning" in l]
    assert len(by_day) == 2  # the records by (vehicle, day), then one row per day by vehicle
    assert sum("date" in l for l in by_day) == 1
    assert "Python" not in text and "CartesianProduct" not in text


def test_unused_columns_are_not_read(cleaned):
    text = plan(metrics.metric(metrics.daily_metrics(cleaned), "high_temp_duration"))
    schema = text[text.index("ReadSchema") :]
    assert "battery_temperature" in schema and "speed" not in schema and "Window" not in text


def test_batch_plans_hold_no_python(cleaned):
    for df in (
        realtime.window_metrics(cleaned),
        realtime.latest_metrics(cleaned),
        realtime.pairwise_metrics(cleaned),
        realtime.sliding_windows(cleaned),
    ):
        text = plan(df)
        assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text


def brute_windows(rows, size=100):
    """The count window as a plain loop over one vehicle's records."""
    out = []
    for i in range(1, len(rows)):
        frame = rows[max(0, i - size + 1) : i + 1]
        speeds = [r["speed"] for r in frame]
        wh = sum(r["battery_voltage"] * abs(r["battery_current"]) for r in frame[1:])
        seconds = (frame[-1]["timestamp"] - frame[0]["timestamp"]).total_seconds() or 1.0
        out.append(
            (
                rows[i]["seq"], len(frame), seconds, max(speeds), min(speeds),
                round(sum(speeds) / len(speeds), 2), round(wh / 1000 * 5 / 3600, 4),
                round((frame[-1]["soc"] - frame[0]["soc"]) / seconds * 3600, 4),
            )
        )
    return out


@pytest.mark.parametrize("block_rows", [128, 1000])
def test_count_window_over_blocks_and_days(records, block_rows):
    rng = random.Random(7)
    rows = [
        {
            "at": i * 700, "speed": float(rng.randint(0, 200)), "soc": float(rng.randint(0, 100)),
            "battery_voltage": float(rng.randint(200, 450)),
            "battery_current": float(rng.randint(-200, 200)),
        }
        for i in range(450)
    ]
    df = records(*rows)
    expected = brute_windows(df.orderBy("seq").collect())
    got = realtime.window_metrics(df, replace(DEFAULTS, block_rows=block_rows)).orderBy("seq")
    columns = ["seq", "record_count", "window_duration", "max_speed", "min_speed"]
    columns += ["avg_speed", "energy_consumed", "soc_rate"]
    for row, want in zip(got.select(*columns).collect(), expected, strict=True):
        assert tuple(row) == pytest.approx(want, abs=1.01e-2)
        assert tuple(row)[:5] == want[:5]


def test_blocks_are_bounded_and_complete(records):
    df = with_position(records(*[{"at": i * 400} for i in range(1000)]))
    blocks = in_blocks(df, reach=99, block_rows=128)
    sizes = blocks.groupBy("_block").agg(F.count("*").alias("n"), F.sum(F.col("_own").cast("int")).alias("own"))
    assert sizes.agg(F.max("n")).first()[0] <= 128 + 99
    assert blocks.filter("_own").count() == 1000
    assert column_set(blocks.filter("_own"), "position") == set(range(1000))


def column_set(df, name):
    return {r[name] for r in df.select(name).collect()}


def test_window_rules(records):
    assert realtime.window_metrics(records({})).count() == 0  # needs two records
    same = realtime.window_metrics(records({"at": 0}, {"at": 0})).first()
    assert same["window_duration"] == 1.0 and same["record_count"] == 2
    many = records(*[{"battery_current": float(i)} for i in range(101)])
    last = realtime.window_metrics(many).orderBy(F.desc("seq")).first()
    assert last["record_count"] == 100 and last["window_duration"] == 495.0
    kwh = sum(300.0 * i for i in range(2, 101)) / 1000 * 5 / 3600
    assert last["energy_consumed"] == pytest.approx(kwh, abs=1e-4)
    newest = realtime.latest_metrics(many).first().asDict()
    assert {k: last[k] for k in newest} == newest


def test_previous_record_reaches_over_empty_days(records):
    df = records({"soc": 1.0, "at": 0}, {"soc": 2.0, "at": 9 * 86400}, {"soc": 3.0, "vehicle_id": "EV_2"})
    got = [r["prev"] and r["prev"]["soc"] for r in with_previous(df, ["soc"]).orderBy("seq").collect()]
    assert got == [None, 1.0, None]


def test_pairs(records):
    df = records(
        {"at": 0, "soc": 50.0},
        {"at": 5, "soc": 49.0, "battery_temperature": 30.0},
        {"at": 5, "soc": 48.0},
    )
    first, second, third = realtime.pairwise_metrics(df).orderBy("seq").collect()
    assert first["soc_rate_per_hour"] is None and first["instantaneous_power_kw"] == 3.0
    assert second["soc_rate_per_hour"] == -720.0 and second["battery_temp_rate"] == 1.0
    assert third["soc_rate_per_hour"] is None  # no time between them


def test_sliding_window_of_single_records(records):
    rows = realtime.sliding_windows(records({"at": 0}, {"at": 5})).collect()
    assert len(rows) == 10 and {r["record_count"] for r in rows} == {1}
    assert {r["soc_rate"] for r in rows} == {None}
    wide = realtime.sliding_windows(records({"at": 0}, {"at": 5}), size=10)
    assert wide.filter("record_count = 2").count() == 5


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_are_exact(spark, seed):
    rng = np.random.default_rng(seed)
    wide = rng.normal(size=3000) * 10.0 ** rng.integers(-6, 12, size=3000)
    skewed = np.where(rng.random(3000) < 0.4, 5.0, rng.random(3000))
    df = spark.createDataFrame(
        [(float(a), float(b), 7.0, None if i % 3 else float(i)) for i, (a, b) in enumerate(zip(wide, skewed))],
        "a double, b double, c double, d double",
    )
    probabilities = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = quantiles.exact_quantiles(df, ["a", "b", "c", "d"], probabilities)
    want = {"a": wide, "b": skewed, "c": np.full(3000, 7.0), "d": np.arange(0.0, 3000, 3)}
    for c, values in want.items():
        assert got[c] == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert quantiles.exact_quantiles(df, ["a"], [0.5]) == {"a": [None]}


def test_quantiles_with_infinity(spark, records):
    df = spark.createDataFrame([(float(i),) for i in range(9)] + [(float("inf"),)], "a double")
    assert quantiles.exact_quantiles(df, ["a"], [0.5, 1.0]) == {"a": [4.5, float("inf")]}
    rows = records(*[{"speed": float("inf") if i > 3 else 50.0} for i in range(8)])
    assert quality.iqr_outliers(rows, ["speed"], only_found=False).count() == 1


@pytest.mark.parametrize("block_rows", [16, 64, 100, 8192])
def test_window_does_not_depend_on_blocks(spark, records, block_rows):
    rows = records(*[{"at": 5 * i, "speed": float((i * 37) % 91), "soc": float(i % 77)} for i in range(350)])
    want = sorted(realtime.window_metrics(rows).collect(), key=lambda r: r["seq"])
    got = realtime.window_metrics(rows, replace(DEFAULTS, block_rows=block_rows)).collect()
    assert sorted(got, key=lambda r: r["seq"]) == want


def test_one_vehicle_with_a_third_of_all_rows(spark, records):
    """Chunks stay small: no group of the windows holds more than one day of a vehicle."""
    rows = [{"vehicle_id": "HOT", "at": 5000 * i} for i in range(400)]
    rows += [{"vehicle_id": f"EV_{i % 40}", "at": 5000 * i} for i in range(800)]
    df = records(*rows)
    biggest = df.groupBy("vehicle_id", "date").count().agg(F.max("count")).first()[0]
    assert biggest <= 18
    assert metrics.daily_metrics(df).agg(F.sum("driving_time_hours")).first()[0] == pytest.approx(
        1200 * 5 / 3600
    )
