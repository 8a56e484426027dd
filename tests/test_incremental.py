from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from conftest import SF_SMALL

from voltfleet.functions.derive import add_status
from voltfleet.operators import fill, metrics, realtime
from voltfleet.plans import cleaning, incremental
from voltfleet.settings import DEFAULTS
from voltfleet.sources import sample

DAY = 86400


def on(*days: int) -> set:
    return {date(2024, 1, d) for d in days}


def same(found, expected) -> bool:
    return sorted(map(str, found.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))


def whole_run(raw, cfg=DEFAULTS):
    dwd = add_status(cleaning.clean(raw, cfg))
    return dwd, metrics.daily_metrics(dwd, cfg), realtime.window_metrics(dwd, cfg)


def agrees(done, raw, cfg=DEFAULTS) -> bool:
    return all(same(done[k], t) for k, t in zip(("dwd", "dws", "realtime"), whole_run(raw, cfg), strict=True))


def four_days(records, **second):
    """Two records a day; the speed of the third day's first one is unknown."""
    rows = [{"at": d * DAY + s, "speed": 10.0 * d + s / 5} for d in range(4) for s in (0, 5)]
    rows[4]["speed"] = None
    return records(*rows, {"at": 10, **second})


@pytest.mark.parametrize("strategy", ["median", "mean"])
def test_deliveries_equal_one_run_over_all(spark, tmp_path, strategy):
    cfg = replace(DEFAULTS, fill_strategy={**DEFAULTS.fill_strategy, "default": strategy})
    raw = sample.dated(spark, SF_SMALL)
    late = "date = DATE '2024-01-04' OR seq % 50 = 7 AND date = DATE '2024-01-02'"
    out = str(tmp_path / "w")
    incremental.deliver(raw.filter(f"NOT ({late})"), out, "one", cfg)
    assert agrees(incremental.deliver(raw.filter(late), out, "two", cfg), raw, cfg)


def test_only_changed_days_are_read(spark, records, tmp_path):
    raw, out = four_days(records, speed=99.0), str(tmp_path / "w")
    cfg = replace(DEFAULTS, window_records=3)
    incremental.deliver(raw.filter("seq < 8"), out, "one", cfg)
    done = incremental.deliver(raw.filter("seq = 8"), out, "two", cfg)
    # The first day's last record counts for the second day's metrics and windows; the third day's null
    # takes the second day's value still, and no window of it reaches the first day.
    assert done["days"]["cleaned"] == on(1)
    assert done["days"]["metrics"] == on(1, 2)
    assert done["days"]["windows"] == done["days"]["window_reads"] == on(1, 2)
    assert agrees(done, raw, cfg)


def test_a_value_travels_over_days_without_one(records, tmp_path):
    rows = [{"at": d * DAY, "speed": None if d else 10.0} for d in range(4)]
    raw, out = records(*rows, {"at": 5, "speed": 77.0}), str(tmp_path / "w")
    incremental.deliver(raw.filter("seq < 4"), out, "one")
    done = incremental.deliver(raw.filter("seq = 4"), out, "two")
    assert done["days"]["cleaned"] == on(1, 2, 3, 4)
    assert agrees(done, raw)


def test_a_new_median_reaches_days_with_nulls_only(records, tmp_path):
    rows = [{"at": d * DAY + s, "battery_voltage": 300.0 + s} for d in range(4) for s in (0, 5)]
    rows[3]["battery_voltage"] = None
    raw, out = records(*rows, {"at": 3 * DAY + 10, "battery_voltage": 400.0}), str(tmp_path / "w")
    incremental.deliver(raw.filter("seq < 8"), out, "one")
    done = incremental.deliver(raw.filter("seq = 8"), out, "two")
    assert done["days"]["cleaned"] == on(2, 4)
    assert agrees(done, raw)


def test_backward_fill_looks_at_later_days(records, tmp_path):
    cfg = replace(DEFAULTS, fill_strategy={"speed": "bfill", "default": "median"})
    rows = [{"at": d * DAY, "speed": None if d == 1 else 10.0 * d} for d in range(3)]
    raw, out = records(*rows, {"at": 2 * DAY - 5, "speed": 5.0}, {"at": DAY + 5, "speed": None}), str(tmp_path / "w")
    incremental.deliver(raw.filter("seq < 3"), out, "one", cfg)
    assert agrees(incremental.deliver(raw.filter("seq >= 3"), out, "two", cfg), raw, cfg)


def test_copies_of_an_earlier_delivery_and_a_second_run(records, tmp_path):
    raw, out = four_days(records, at=0, speed=1.0), str(tmp_path / "w")
    incremental.deliver(raw.filter("seq < 8"), out, "one")
    for _ in range(2):
        assert agrees(incremental.deliver(raw.filter("seq = 8"), out, "two"), raw)


def test_a_run_that_failed_is_put_right(records, tmp_path, monkeypatch):
    raw, out = four_days(records, speed=99.0), str(tmp_path / "w")
    incremental.deliver(raw.filter("seq < 8"), out, "one")

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(incremental, "metrics_of", broken)
        with pytest.raises(OSError):
            incremental.deliver(raw.filter("seq = 8"), out, "two")
    assert agrees(incremental.deliver(raw.filter("seq = 8"), out, "two"), raw)


def test_a_first_null_and_an_unread_time_redo_all_days(records, tmp_path):
    rows = [{"at": d * DAY, "soc": 10.0 * d} for d in range(3)]
    more = [{"at": 5, "motor_rpm": None}, {"at": "n/a"}]
    raw, out = records(*rows, *more), str(tmp_path / "w")
    incremental.deliver(raw.filter("seq < 3"), out, "one")
    second = incremental.deliver(raw.filter("seq = 3"), out, "two")
    assert second["days"]["cleaned"] == on(1, 2, 3)
    assert agrees(second, raw.filter("seq < 4"))
    assert agrees(incremental.deliver(raw.filter("seq = 4"), out, "three"), raw)


def test_null_vehicles_and_empty_deliveries(records, tmp_path):
    raw = records({"at": 0}, {"at": DAY}, {"at": DAY + 5, "vehicle_id": None, "speed": None}, {"at": DAY + 9, "speed": None})
    out = str(tmp_path / "w")
    assert "dwd" not in incremental.deliver(raw.filter("false"), out, "none")
    incremental.deliver(raw.filter("seq < 2"), out, "one")
    assert agrees(incremental.deliver(raw.filter("seq >= 2"), out, "two"), raw)
    assert agrees(incremental.deliver(raw.filter("false"), out, "three"), raw)


def test_a_key_without_the_time_is_refused(records, tmp_path):
    with pytest.raises(ValueError):
        incremental.deliver(records({}), str(tmp_path), "one", replace(DEFAULTS, dedup_key=("vehicle_id",)))


def test_plans_from_counts_equal_plans_from_records(spark, records):
    df = records({"soc": None, "speed": 1.0}, {"soc": 0.1, "speed": None}, {"soc": 0.1}, {"soc": 0.7})
    for m in ("median", "mean"):
        how = fill.methods(df, ["speed", "soc"], {"default": m})
        found = incremental._constants(incremental.value_counts(df, list(how), ["date"]), how)
        assert found == {p["column"]: p["value"] for p in fill.fill_plan(df, {"default": m})}
