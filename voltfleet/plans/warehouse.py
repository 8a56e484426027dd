"""The warehouse: raw layer (ODS), detail layer (DWD), daily metrics (DWS)."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from voltfleet.functions.derive import add_status
from voltfleet.operators import reports
from voltfleet.operators.metrics import daily_metrics, summary_rows
from voltfleet.operators.quality import require_quality
from voltfleet.operators.realtime import window_metrics
from voltfleet.plans.cleaning import Stages, clean, clean_stages, cleaning_report
from voltfleet.schema import normalise
from voltfleet.settings import DEFAULTS, Settings
from voltfleet.sources import files


def detail_layer(raw: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Cleaned records with their four state columns."""
    return add_status(clean(raw, cfg))


def build_warehouse(raw: DataFrame, cfg: Settings = DEFAULTS):
    """The three layers as lazy tables: records as read, details, daily metrics."""
    dwd = detail_layer(raw, cfg)
    return normalise(raw), dwd, daily_metrics(dwd, cfg)


class StepLog:
    """Name, status and seconds of each step; a failure is logged and raised."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, str, float, str | None]] = []

    def run(self, name: str, action: Callable[..., Any], *args: Any, **kwargs: Any) -> Any:
        begin = time.monotonic()
        try:
            result = action(*args, **kwargs)
        except Exception as error:
            self.rows.append((name, "failed", round(time.monotonic() - begin, 2), str(error)))
            raise
        self.rows.append((name, "success", round(time.monotonic() - begin, 2), None))
        return result

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.rows, "step string, status string, seconds double, error string"
        )


def run_warehouse(
    raw: DataFrame,
    out: str,
    run_time: str,
    cfg: Settings = DEFAULTS,
    *,
    fmt: str = "parquet",
    gate: bool = False,
) -> dict[str, Any]:
    """Write all layers, reports and real-time metrics under ``out``.

    Every layer is written once and the next step reads the written copy, so no step
    repeats the work of the one before and a lost executor costs one step's tasks.
    ``run_time`` (yyyy-MM-dd HH:mm:ss) tags everything this run writes.
    """
    spark, log = raw.sparkSession, StepLog()
    stamp = run_time.replace("-", "").replace(":", "").replace(" ", "_")
    paths = {
        "ods": f"{out}/ods",
        "dwd": f"{out}/dwd",
        "dws": f"{out}/dws/daily",
        "metrics": f"{out}/dws/metrics",
        "realtime": f"{out}/realtime_metrics",
        "report": f"{out}/reports/quality_report_{stamp}",
        "summary": f"{out}/reports/summary_{stamp}",
    }
    log.run("ods_layer", files.write_parquet, normalise(raw), paths["ods"])
    ods = spark.read.parquet(paths["ods"])

    stages = log.run("data_quality", clean_stages, ods, cfg)
    log.run("dwd_layer", files.write_parquet, add_status(stages.cleaned), paths["dwd"])
    dwd = spark.read.parquet(paths["dwd"])
    if gate:
        log.run("quality_gate", require_quality, dwd, cfg)

    log.run("dws_layer", files.write_parquet, daily_metrics(dwd, cfg), paths["dws"])
    dws = spark.read.parquet(paths["dws"])
    log.run("metric_tables", files.write_metrics, summary_rows(dws, run_time), paths["metrics"])

    realtime = window_metrics(dwd, cfg)
    log.run("realtime", files.write_parquet, realtime, paths["realtime"], by_date=False)

    written = Stages(ods, stages.deduplicated, stages.filled, dwd, stages.fill_plan)
    report = cleaning_report(written, run_time, cfg)
    log.run("quality_report", files.write_report, report, paths["report"])
    log.run("summary", files.write_report, reports.metric_ranges(dws), paths["summary"])
    if fmt == "csv":
        for layer, table in (("ods", ods), ("dwd", dwd), ("dws", dws)):
            log.run(f"{layer}_csv", files.write_csv, table, f"{out}/csv/{layer}")
    return {"paths": paths, "ods": ods, "dwd": dwd, "dws": dws, "steps": log.table(spark)}
