"""Deduplication, filling, outliers, quality checks and the cleaning report."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from voltfleet.operators import dedup, fill, outliers, quality
from voltfleet.operators.ordering import fill_along_time
from voltfleet.plans import cleaning
from voltfleet.settings import PHYSICAL_RANGES

DAY = 86400


def column(df, name):
    return [r[name] for r in df.orderBy("seq").collect()]


@pytest.fixture(scope="module")
def defects(records):
    """Two vehicles of a hundred rows, with nulls, out-of-range speeds and copies."""
    rows = []
    for i in range(200):
        row = {"vehicle_id": f"EV_{i // 100 + 1:03d}", "at": 5 * (i % 100), "speed": 40.0 + i % 7}
        if i == 10:
            row["speed"] = None
        if i == 20:
            row["battery_voltage"] = None
        if 30 <= i <= 35:
            row["speed"] = 250.0
        rows.append(row)
    return records(*rows, rows[10], rows[20])


def test_injected_defects(defects):
    stages = cleaning.clean_stages(defects)
    assert stages.raw.count() == 202 and stages.cleaned.count() == 200
    assert dedup.duplicate_counts(defects).first()["duplicate_count"] == 2
    before = {r["column_name"]: r for r in quality.physical_outliers(defects).collect()}
    after = {r["column_name"]: r for r in quality.physical_outliers(stages.cleaned).collect()}
    assert before["speed"]["outlier_count"] == 6 and after["speed"]["outlier_count"] == 0
    steps = {
        (r["step"], r["column_name"]): r for r in cleaning.cleaning_counters(stages).collect()
    }
    assert steps["deduplication", "vehicle_id,timestamp"]["count_after"] == 200
    assert steps["null_filling", "speed"]["count_before"] == 1
    assert steps["null_filling", "battery_voltage"]["value"] == 300.0
    assert steps["outlier_handling", "speed"]["count_before"] == 6
    row = stages.cleaned.filter("seq = 10").first()
    assert row["speed"] == 40.0 + 9 % 7  # from the record before
    gain = cleaning.improvement(stages).first()
    assert gain["duplicates_removed"] == 2 and gain["outliers_handled"] == 6
    # Rows 10 and 20 and their copies each lack one value.
    assert quality.completeness(defects).first()["null_cells"] == 4


def test_report_is_one_nested_row(defects):
    report = cleaning.cleaning_report(cleaning.clean_stages(defects), "2024-01-02 00:00:00")
    (row,) = report.collect()
    assert row["final_record_count"] == 200
    assert row["improvement"]["duplicates_removed"] == 2
    examples = row["original_quality"]["duplicates"]["examples"]
    assert [e["vehicle_id"] for e in examples] == ["EV_001"] * 4
    assert row["final_quality"]["duplicates"]["examples"] is None
    assert row["original_quality"]["outliers"]["physical_method"]["speed"]["outlier_count"] == 6


def test_steps_can_be_switched_off(defects):
    assert cleaning.clean(defects, remove_duplicates=False).count() == 202
    kept = cleaning.clean(defects, fill_nulls=False, outliers=False)
    assert kept.filter("speed IS NULL").count() == 1
    assert kept.filter("speed = 250").count() == 6


def test_cleaning_twice_changes_nothing(defects):
    once = cleaning.clean(defects)
    assert cleaning.clean(once).exceptAll(once).count() == 0
    before, after = (quality.completeness(d).first()["completeness"] for d in (defects, once))
    assert after >= before


def test_first_copy_wins_and_missing_key_column_is_no_error(records):
    df = records({"speed": 1.0, "at": 0}, {"speed": 2.0, "at": 0}, {"speed": 3.0, "at": 5})
    assert column(dedup.deduplicate(df), "speed") == [1.0, 3.0]
    assert dedup.deduplicate(df.drop("vehicle_id")).count() == 3
    assert dedup.duplicate_counts(df.drop("vehicle_id")).first()["duplicate_count"] == 0


def test_fill_per_vehicle_over_day_borders(records):
    df = records(
        {"speed": None, "at": 0},
        {"speed": 10.0, "at": 5},
        {"speed": None, "at": DAY + 5},
        {"speed": None, "at": 3 * DAY},
        {"speed": 20.0, "at": 3 * DAY + 5},
        {"speed": None, "vehicle_id": "EV_002", "at": 0},
        {"speed": 7.0, "vehicle_id": "EV_002", "at": DAY},
    )
    assert column(fill.fill_nulls(df, {"default": "ffill"}), "speed") == [
        None, 10.0, 10.0, 10.0, 20.0, None, 7.0
    ]
    assert column(fill.fill_nulls(df, {"default": "bfill"}), "speed") == [
        10.0, 10.0, 20.0, 20.0, 20.0, 7.0, 7.0
    ]
    across = fill.fill_nulls(df, {"default": "ffill"}, scope="table")
    assert column(across, "speed") == [None, 10.0, 10.0, 10.0, 20.0, 20.0, 7.0]


def test_table_scope_over_range_borders(records, monkeypatch):
    monkeypatch.setattr("voltfleet.operators.ordering.TABLE_CHUNK_ROWS", 2)
    df = records(*[{"speed": s} for s in (None, 1.0, None, None, None, 5.0, None)])
    filled = fill_along_time(df, ["speed"], [], scope="table")
    assert column(filled, "speed") == [None, 1.0, 1.0, 1.0, 1.0, 5.0, 5.0]
    filled = fill_along_time(df, [], ["speed"], scope="table")
    assert column(filled, "speed") == [1.0, 1.0, 5.0, 5.0, 5.0, 5.0, None]


def test_constants(records):
    df = records({"speed": 1.0}, {"speed": 4.0}, {"speed": None}, {"speed": 4.0})
    assert column(fill.fill_nulls(df, {"default": "mean"}), "speed")[2] == 3.0
    assert column(fill.fill_nulls(df, {"default": "median"}), "speed")[2] == 4.0
    assert column(fill.fill_nulls(df, {"default": "zero"}), "speed")[2] == 0.0
    flags = records({"charging_status": 0}, {"charging_status": 1}, {"charging_status": None})
    assert column(fill.fill_nulls(flags, {"default": "median"}), "charging_status") == [0, 1, 0]
    with pytest.raises(ValueError):
        fill.fill_nulls(df, {"default": "guess"})


def test_outlier_actions(records):
    df = records({"speed": 250.0}, {"speed": -1.0}, {"speed": None}, {"speed": 200.0})
    assert column(outliers.handle_outliers(df), "speed") == [200.0, 0.0, None, 200.0]
    assert column(outliers.handle_outliers(df, action="nan"), "speed") == [None, None, None, 200.0]
    assert column(outliers.handle_outliers(df, action="remove"), "speed") == [200.0]
    with pytest.raises(ValueError):
        outliers.handle_outliers(df, action="hide")


def test_iqr_fences_of_a_constant_column(records):
    df = records(*[{"battery_temperature": t} for t in (60.0, 60.0, 60.0, 59.0)])
    row = quality.iqr_outliers(df, ["battery_temperature"]).first()
    assert (row["q1"], row["q3"], row["outlier_count"]) == (59.75, 60.0, 1)
    assert (row["lower_bound"], row["upper_bound"]) == (59.38, 60.38)  # 59.375, 60.375
    clipped = outliers.handle_outliers(df, method="iqr")
    assert column(clipped, "battery_temperature")[3] == 59.375


def test_nan_is_null_after_ingest(records):
    df = records({"speed": math.nan}, {"speed": 1.0})
    assert column(df, "speed") == [None, 1.0]
    assert quality.physical_outliers(df).filter("column_name = 'speed'").first()["outlier_count"] == 0


def test_empty_table(records):
    df = records({}).filter("false")
    row = quality.completeness(df).first()
    assert row["completeness"] == 100.0 and row["total_cells"] == 0
    assert quality.outlier_totals(df).first()["total_physical_outlier_rate"] == 0.0
    assert dedup.duplicate_counts(df).first()["duplicate_rate"] == 0.0
    assert quality.iqr_outliers(df).count() == 0
    assert cleaning.clean(df).count() == 0


def test_gate(records):
    good = records({}, {})
    assert quality.quality_gate(good).first()["passed"]
    quality.require_quality(good)
    bad = good.withColumn("speed", F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="quality gate"):
        quality.require_quality(bad)


def test_ranges_cover_every_ranged_field(records):
    found = quality.physical_outliers(records({}))
    assert {r["column_name"] for r in found.collect()} == set(PHYSICAL_RANGES)
