"""Registered queries against their SQL twins at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check_oracles import compare, duck
from conftest import SF_SMALL

# The others differ only in their last step; check_oracles.py runs all of them.
CHECKED = [
    "derive_status", "derive_power", "speed_acceleration", "ffill", "bfill", "fill_median",
    "fill_mean", "remove_outliers", "null_outliers", "clip_iqr", "clean_all", "daily_metrics",
    "dws_union", "soc_join", "window_last100", "latest_per_vehicle", "pairwise_metrics",
    "sliding_5s", "completeness", "null_rates", "duplicates", "duplicate_examples",
    "iqr_outliers", "outlier_totals", "cleaning_counters", "improvement", "quality_gate",
    "quality_stats", "summary_statistics", "vehicle_summary", "metric_ranges", "top_vehicles",
    "metric_cards", "null_ranking", "outlier_share", "overview", "profile", "latest_points",
    "message_roundtrip", "newest_file", "sink_metrics", "stream_last100",
]


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(CHECKED) <= set(entry.oracle_sql())


def test_flagship(spark):
    assert entry.entry(spark).count() == 40


@pytest.mark.parametrize("name", CHECKED)
def test_query(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    assert compare(df, duck(SF_SMALL), entry.oracle_sql()[name]) is None
