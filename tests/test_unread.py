"""Records whose time cannot be read stand behind the newest time read before them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from voltfleet.operators import fill, ordering, realtime


@pytest.fixture(scope="module")
def drive(records):
    return records(
        {"at": 0, "soc": 50.0}, {"at": 5, "soc": 51.0}, {"at": "n/a", "soc": 53.0}, {"at": 10, "soc": 54.0},
        {"at": "?", "soc": 56.0}, {"at": 15, "soc": 58.0},
    )


def test_pairs(drive):
    got = {r["seq"]: r["soc_rate_per_hour"] for r in realtime.pairwise_metrics(drive).collect()}
    assert got == {0: None, 1: 720.0, 2: 1440.0, 3: 720.0, 4: 1440.0, 5: 1440.0}


def test_windows(drive):
    got = {r["seq"]: (r["record_count"], r["window_duration"]) for r in realtime.window_metrics(drive).collect()}
    assert got == {1: (2, 5.0), 2: (3, 1.0), 3: (4, 10.0), 4: (5, 1.0), 5: (6, 15.0)}
    assert realtime.latest_metrics(drive).first()["latest_soc"] == 58.0


def test_acceleration_follows_the_place(records):
    df = records({"at": 0, "speed": 10.0}, {"at": "n/a", "speed": 90.0}, {"at": 10, "speed": 20.0})
    got = {r["seq"]: r["speed_acceleration"] for r in realtime.speed_acceleration(df).collect()}
    assert got[1] is None and got[2] is None  # no time between them can be told


def test_a_leading_null_takes_no_later_value(records):
    df = records({"speed": None}, {"speed": 10.0}, {"at": "n/a", "speed": 99.0}, {"at": 15, "speed": None})
    got = {r["seq"]: r["speed"] for r in fill.fill_nulls(df, {"speed": "ffill", "default": "zero"}).collect()}
    assert got == {0: None, 1: 10.0, 2: 99.0, 3: 99.0}
    back = {r["seq"]: r["speed"] for r in fill.fill_nulls(df, {"speed": "bfill", "default": "zero"}).collect()}
    assert back == {0: 10.0, 1: 10.0, 2: 99.0, 3: None}


def test_nothing_read_before_comes_first(records):
    df = records({"at": "n/a", "soc": 1.0}, {"at": 5, "soc": 2.0}, {"at": "n/a", "soc": 3.0, "vehicle_id": "EV_2"})
    assert [r["seq"] for r in realtime.window_metrics(df).collect()] == [1]
    back = fill.fill_nulls(df.withColumn("soc", F.when(F.col("seq") == 1, F.col("soc"))), {"soc": "bfill"})
    assert {r["seq"]: r["soc"] for r in back.collect()} == {0: 2.0, 1: 2.0, 2: None}


@pytest.mark.parametrize("step", [1, 3, 1_000_000])
def test_places_over_many_stretches(records, monkeypatch, step):
    monkeypatch.setattr(ordering, "PLACE_ROWS", step)
    given = [{"at": "n/a" if i % 4 == 1 else (i * 7919) % 100_000, "vehicle_id": f"EV_{i % 3}"} for i in range(60)]
    df = records(*given)
    newest, want = {}, {}
    for r in df.orderBy("seq").collect():
        own = newest.get(r["vehicle_id"])
        if r["timestamp"] is not None:
            newest[r["vehicle_id"]] = max(own or r["timestamp"], r["timestamp"])
            own = r["timestamp"]
        want[r["seq"]] = own
    assert {r["seq"]: r["place"] for r in ordering.in_time(df).collect()} == want


def test_read_times_cost_nothing(records):
    df = records({}, {})
    assert ordering.in_time(df) is df
