"""Edge cases of the derived columns and the eight metrics."""

from __future__ import annotations

from dataclasses import replace

import pytest

from voltfleet.functions.derive import add_status
from voltfleet.operators import metrics, reports
from voltfleet.operators.metrics import daily_metrics
from voltfleet.settings import DEFAULTS

DAY = 86400


def day(df, cfg=DEFAULTS):
    return [r.asDict() for r in daily_metrics(df, cfg).orderBy("vehicle_id", "date").collect()]


@pytest.mark.parametrize(
    "first, second, seconds, count",
    [(0.0, 25.0, 5, 0), (0.0, 26.0, 5, 1), (10.0, 10.01, 0, 1), (60.0, 0.0, 5, 0)],
)
def test_rapid_acceleration_threshold(records, first, second, seconds, count):
    df = records({"speed": first, "at": 0}, {"speed": second, "at": seconds})
    assert day(df)[0]["rapid_acceleration_count"] == count


def test_event_over_midnight_belongs_to_the_later_day(records):
    df = records(
        {"speed": 0.0, "soc": 90.0, "charging_status": 0, "at": DAY - 2},
        {"speed": 60.0, "soc": 50.0, "charging_status": 1, "at": DAY + 3},
    )
    first, second = day(df)
    names = ("rapid_acceleration_count", "charging_frequency", "soc_cycles")
    assert [first[n] for n in names] == [0, 0, 0]
    assert [second[n] for n in names] == [1, 1, 1]


def test_events_do_not_cross_vehicles(records):
    df = records(
        {"vehicle_id": "EV_001", "speed": 0.0, "at": 0},
        {"vehicle_id": "EV_002", "speed": 90.0, "at": 5},
    )
    assert [d["rapid_acceleration_count"] for d in day(df)] == [0, 0]


@pytest.mark.parametrize(
    "statuses, starts", [([1, 1, 0, 1], 1), ([0, None, 1], 0), ([0, 1, 0, 1], 2), ([1], 0)]
)
def test_charging_starts(records, statuses, starts):
    assert day(records(*[{"charging_status": s} for s in statuses]))[0]["charging_frequency"] == starts


def test_soc_step_must_exceed_twenty(records):
    assert day(records({"soc": 50.0}, {"soc": 30.0}))[0]["soc_cycles"] == 0
    assert day(records({"soc": 50.0}, {"soc": 29.9}))[0]["soc_cycles"] == 1


def test_guards(records):
    idle = day(records({"speed": 0.0}, {"speed": 0.0}))[0]
    assert idle["daily_energy_consumption"] == 0 and idle["driving_time_hours"] == 0
    charging = day(records({"battery_current": -5.0}, {"battery_current": -7.0}))[0]
    assert charging["brake_energy_recovery_rate"] == 0
    assert charging["total_recovered_energy"] > 0 and charging["total_energy_kwh"] > 0
    single = day(records({}))[0]
    assert single["speed_std"] is None and single["average_speed"] == 50.0


def test_values_of_one_day(records):
    df = records(
        {"speed": 72.0, "battery_current": 100.0, "battery_temperature": 46.0},
        {"speed": 36.0, "battery_current": -50.0, "battery_temperature": 45.0},
        {"speed": None, "battery_current": 0.0},
    )
    got = day(df)[0]
    h = 5 / 3600
    assert got["total_energy_kwh"] == pytest.approx((30 + 15) * h)
    assert got["total_distance_km"] == pytest.approx(108 * h)
    assert got["daily_energy_consumption"] == pytest.approx(45 / 108 * 100)
    assert got["high_temp_duration_hours"] == pytest.approx(h)
    assert got["driving_time_hours"] == pytest.approx(2 * h)
    assert got["average_speed"] == 54.0 and got["speed_std"] == 25.46
    assert got["brake_energy_recovery_rate"] == 50.0
    assert got["battery_health_index"] == 100.0


def test_rows_without_vehicle_or_time_belong_to_no_group(records):
    df = records({}, {"vehicle_id": None}, {"at": "no time"})
    assert len(day(df)) == 1


def test_recovery_without_plug_in_charging(records):
    df = records(
        {"battery_current": 100.0},
        {"battery_current": -50.0, "charging_status": 0},
        {"battery_current": -50.0, "charging_status": 1},
    )
    assert day(df)[0]["brake_energy_recovery_rate"] == 100.0
    cfg = replace(DEFAULTS, recovery_includes_charging=False)
    assert day(df, cfg)[0]["brake_energy_recovery_rate"] == 50.0


@pytest.mark.parametrize(
    "change, expected",
    [
        ({"battery_temperature": 45.0}, {"temp_status": "hot", "battery_status": "normal"}),
        ({"battery_temperature": 45.1}, {"battery_status": "high_temp_warning"}),
        ({"soc": 10.0, "battery_temperature": 59.0}, {"battery_status": "low_power"}),
        ({"soc": 81.0, "battery_temperature": 59.0}, {"battery_status": "high_power"}),
        ({"speed": None}, {"driving_status": "highway"}),
        ({"speed": 0.0}, {"driving_status": "idle"}),
        ({"speed": 60.0}, {"driving_status": "fast"}),
        ({"energy_consumption": 20.0}, {"energy_category": "D_poor"}),
        ({"energy_consumption": 9.99}, {"energy_category": "A_excellent"}),
    ],
)
def test_status(records, change, expected):
    row = add_status(records(change)).first()
    assert {k: row[k] for k in expected} == expected


def test_union_in_one_pass_equals_union_by_name(records):
    wide = daily_metrics(records({"at": 0}, {"at": DAY}, {"vehicle_id": "EV_002"}))
    one = metrics.summary_rows(wide, "t")
    many = metrics.union_by_name(metrics.metric_tables(wide), "t").select(*one.columns)
    assert one.count() == many.count() == 24
    assert one.exceptAll(many).count() == 0


def test_health_by_join_equals_wide(records):
    wide = daily_metrics(records({"battery_temperature": 50.0, "soc": 90.0}, {"soc": 10.0}))
    cycles = wide.select("vehicle_id", "date", "soc_cycles")
    joined = metrics.battery_health_by_join(metrics.metric(wide, "high_temp_duration"), cycles)
    assert joined.collect() == metrics.metric(wide, "battery_health_index").collect()
    none = metrics.battery_health_by_join(
        metrics.metric(wide, "high_temp_duration"), cycles.filter("false")
    )
    assert none.first()["soc_cycles"] == 0


def test_a_faulty_reading_does_not_end_the_job(records):
    faulty = 4294967295.0
    df = records({"speed": 0.0}, {"speed": faulty}, {"speed": faulty})
    found = day(df)[0]
    assert found["average_speed"] == pytest.approx(faulty * 2 / 3)
    assert found["speed_std"] == pytest.approx(faulty / 3**0.5)
    profile = {r["column_name"]: r for r in reports.column_profile(df).collect()}
    assert profile["speed"]["std"] == pytest.approx(faulty / 3**0.5)
