"""Files, layers, reports and the whole warehouse run."""

from __future__ import annotations

import os

import pytest

from conftest import SF_SMALL
from voltfleet.operators.dedup import deduplicate
from voltfleet.operators.metrics import METRIC_COLUMNS, daily_metrics, summary_rows
from voltfleet.plans import warehouse
from voltfleet.sources import files, workspace
from voltfleet.sources.sample import telemetry

HEADER = (
    "timestamp,vehicle_id,speed,battery_voltage,battery_current,battery_temperature,"
    "motor_temperature,motor_rpm,soc,throttle,brake,charging_status,energy_consumption,"
    "cabin_temperature,latitude,longitude\n"
)
REST = ",300.0,10.0,25.0,40.0,3000.0,50.0,20.0,0.0,0,15.0,22.0,30.0,104.0\n"


def test_csv_without_seq_keeps_file_order(spark, tmp_path):
    path = tmp_path / "raw.csv"
    lines = [f"2024-01-01 00:00:0{i % 3},EV_001,{i}" + REST for i in range(6)]
    path.write_text(HEADER + "".join(lines) + "not a time,EV_001,fast" + REST)
    df = files.read_csv(spark, str(path))
    kept = deduplicate(df).orderBy("seq").collect()
    assert [r["speed"] for r in kept] == [0.0, 1.0, 2.0, None]
    assert kept[3]["timestamp"] is None and kept[3]["date"] is None


def test_newest_file(spark, tmp_path):
    assert files.read_newest(spark, str(tmp_path)) is None
    for name, speed, age in (("b.csv", 1, 100), ("a.csv", 2, 50)):
        path = tmp_path / name
        path.write_text(HEADER + f"2024-01-01 00:00:00,EV_001,{speed}" + REST)
        stat = os.stat(path)
        os.utime(path, (stat.st_atime, stat.st_mtime - age))
    assert files.read_newest(spark, str(tmp_path)).first()["speed"] == 2.0


def test_overwriting_replaces_only_the_days_written(spark, records, tmp_path):
    path = str(tmp_path / "layer")
    files.write_layer(records({"at": 0}, {"at": 86400}), path)
    files.write_layer(records({"at": 86400, "speed": 1.0}, {"at": 86405, "speed": 1.0}), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 3 and stored.filter("speed = 1.0").count() == 2
    with pytest.raises(ValueError):
        files.write_layer(stored, path, "xls")


def test_metric_tables(spark, records, tmp_path):
    path = str(tmp_path / "metrics")
    files.write_metrics(summary_rows(daily_metrics(records({}, {"at": 86400})), "now"), path)
    tables = files.read_metrics(spark, path)
    assert {n: t.count() for n, t in tables.items()} == dict.fromkeys(METRIC_COLUMNS, 2)


def test_work_folder_comes_from_the_session(spark):
    assert workspace.work_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_warehouse_run(spark, tmp_path):
    done = warehouse.run_warehouse(
        telemetry(spark, SF_SMALL), str(tmp_path), "2024-02-01 00:00:00", fmt="csv"
    )
    assert done["ods"].count() == 1000 and done["dwd"].count() == 920 and done["dws"].count() == 40
    steps = done["steps"].collect()
    assert {s["status"] for s in steps} == {"success"}
    assert {"ods_layer", "data_quality", "dwd_layer", "dws_layer"} <= {s["step"] for s in steps}
    report = files.latest_report(spark, f"{tmp_path}/reports/quality_report_20240201_000000")
    row = report.first()
    assert row["final_record_count"] == 920
    assert row["original_quality"]["original_count"] == 1000
    assert spark.read.parquet(done["paths"]["realtime"]).count() == 910
    hours = done["dws"].agg({"high_temp_duration_hours": "max"}).first()[0]
    assert hours <= 24


def test_a_failed_step_is_logged_and_raised(spark):
    log = warehouse.StepLog()
    with pytest.raises(ZeroDivisionError):
        log.run("bad", lambda: 1 / 0)
    assert log.table(spark).first()["status"] == "failed"
