"""A warehouse that takes deliveries: each one redoes only the days that it changes.

A delivery changes the days it has records of. What else changes follows from small tables of
one row per vehicle and day, kept beside the layers:

* a filled value may come from another day, so a day is cleaned anew if it has nulls and what
  its neighbours hand over has changed, or the median or mean that fills them has;
* a day's metrics look at the last record of the vehicle's day before;
* a window of 100 records reaches back over as many days as it takes.

Layers are written by day and all days found are written before the small tables are, so a run
that failed is put right by running it again. The results are those of one run over everything.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltfleet.functions.derive import add_status
from voltfleet.functions.exact import limb_sums, total
from voltfleet.operators.dedup import deduplicate
from voltfleet.operators.fill import apply_fill, methods, plan_of
from voltfleet.operators.metrics import EVE, daily_metrics, daily_sums, metrics_of, with_eve
from voltfleet.operators.ordering import CHUNK, across_chunks, carried_over, edge_values, order_key
from voltfleet.operators.outliers import handle_outliers
from voltfleet.operators.quantiles import quantiles_of, value_counts
from voltfleet.operators.realtime import window_metrics
from voltfleet.plans.cleaning import clean
from voltfleet.schema import FIELDS, normalise
from voltfleet.settings import DEFAULTS, Settings
from voltfleet.sources import files
from voltfleet.sources.workspace import children, materialise

KEYS = list(CHUNK)
_PLAN = "column string, strategy string, value double, filled_count long"


def on_days(days: set) -> Column:
    """Records of some days, None among them; a list of days prunes the folders that are read."""
    known = F.col("date").isin([d for d in days if d is not None])
    return known | F.col("date").isNull() if None in days else known


def _days(df: DataFrame) -> set:
    """The days of a table: as many as the calendar has, however many records there are."""
    return {r["date"] for r in df.select("date").distinct().collect()}


class _State:
    """The small tables of the runs so far; empty before the first one."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.names = set(children(spark, path))
        # The plan is written last: without one, no run has come to its end.
        self.exists = "plan" in self.names

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        reader = self.spark.read.schema(schema)
        if not self.exists:
            return self.spark.createDataFrame([], schema)
        return reader.parquet(f"{self.path}/{name}").select(*schema.names)

    def plan(self) -> dict[str, dict]:
        if not self.exists:
            return {}
        rows = self.spark.read.schema(_PLAN).json(f"{self.path}/plan").collect()
        return {r["column"]: r.asDict() for r in rows}

    def commit(self, tables: dict[str, DataFrame], plan: list[dict]) -> None:
        for name, table in tables.items():
            files.write_parquet(table, f"{self.path}/{name}")
        rows = [(p["column"], p["strategy"], None if p["value"] is None else float(p["value"]), p["filled_count"]) for p in plan]
        self.spark.createDataFrame(rows, _PLAN).coalesce(1).write.mode("overwrite").json(f"{self.path}/plan")


def _replaced(old: DataFrame, new: DataFrame, days: set) -> DataFrame:
    return old.filter(~F.coalesce(on_days(days), F.lit(False))).unionByName(new)


def _edges(unique: DataFrame, ways: dict[str, list[str]]) -> DataFrame:
    """Per vehicle and day: records, nulls of each field, the values handed to other days."""
    fields = [c for c in FIELDS if c in unique.columns]
    counts = [F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in fields]]
    return unique.groupBy(*KEYS).agg(*counts, *edge_values(ways["ffill"], ways["bfill"], order_key(True)))


def _constants(values: DataFrame, how: dict[str, str]) -> dict[str, float | None]:
    """Medians and means out of the counted values of all days."""
    median_of = [c for c, m in how.items() if m == "median"]
    mean_of = [c for c, m in how.items() if m == "mean"]
    found = {}
    if median_of:
        counts = values.filter(F.col("target").isin(median_of)).groupBy("target", "value").agg(F.sum("n").alias("n"))
        found = {c: v[0] for c, v in quantiles_of(counts, median_of, [0.5]).items()}
    if mean_of:
        mean = f"{total(limb_sums('value', wide=True, times='n'))} / CAST(sum(n) AS DOUBLE)"
        rows = values.filter(F.col("target").isin(mean_of)).groupBy("target").agg(F.expr(mean).alias("mean"))
        found.update({c: None for c in mean_of} | {r["target"]: r["mean"] for r in rows.collect()})
    return found


def _changed(old: DataFrame, new: DataFrame, columns: list[str], but: set, also: str = "true") -> set:
    """Days with a vehicle for which one of ``columns`` differs; ``also`` holds of the new row."""
    if not columns:
        return set()
    both = old.select(*KEYS, F.struct(*columns).alias("_old")).join(new.filter(~on_days(but)), KEYS)
    differs = " OR ".join(f"(NOT (_old.{c} <=> {c}) AND {also.format(c)})" for c in columns)
    return _days(both.filter(differs))


def _to_clean(old: DataFrame, edges: DataFrame, ways: dict[str, list[str]], stale: list[str], fresh: set) -> set:
    """Days, besides those of the delivery, in which a null is to be filled with another value."""
    carry = lambda e: carried_over(e, KEYS, across_chunks(e), ways["ffill"], ways["bfill"])
    handed = [f"_before_{c}" for c in ways["ffill"]] + [f"_after_{c}" for c in ways["bfill"]]
    nulls = edges.select(*KEYS, *[F.col(f"nulls_{c.split('_', 2)[2]}").alias(f"_of{c}") for c in handed])
    days = _changed(carry(old), carry(edges).join(nulls, KEYS), handed, fresh, "_of{0} > 0")
    if stale:
        days |= _days(edges.filter(" OR ".join(f"nulls_{c} > 0" for c in stale)))
    return days - fresh


def _window_days(edges: DataFrame, cleaned: set, reach: int) -> tuple[set, DataFrame]:
    """Days whose windows change, and the (vehicle, day) chunks these windows read.

    A record's window reaches back ``reach`` records, over as many days as hold them.
    """
    days = Window.partitionBy("vehicle_id").orderBy("date")
    before, after = days.rowsBetween(Window.unboundedPreceding, -1), days.rowsBetween(1, Window.unboundedFollowing)
    spans = (
        edges.filter("vehicle_id IS NOT NULL AND date IS NOT NULL")
        .select(*KEYS, "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
        .withColumn("end", F.col("begin") + F.col("n"))
    )
    touched = F.max(F.when(on_days(cleaned), F.col("end"))).over(before)
    changed = _days(spans.withColumn("touched", touched).filter(on_days(cleaned) | (F.col("touched") > F.col("begin") - reach)))
    changed.discard(None)
    redone = F.coalesce(on_days(changed), F.lit(False))
    needed = F.min(F.when(redone, F.col("begin"))).over(after)
    chunks = spans.withColumn("needed", needed).filter(redone | (F.col("end") > F.col("needed") - reach))
    return changed, chunks.select(*KEYS)


def _dated_windows(dwd: DataFrame, cfg: Settings, fresh: str | None = None) -> DataFrame:
    return window_metrics(dwd, cfg, fresh).withColumn("date", F.to_date("window_end_time"))


def deliver(
    delivery: DataFrame, out: str, name: str, cfg: Settings = DEFAULTS
) -> dict[str, Any]:
    """Take a delivery of raw records into the warehouse under ``out``.

    ``name`` tells deliveries apart: a run that failed is run again under its name and with its
    records. Returns the layers that hold records, and the ``days`` that were read into or rewritten by each step.
    Tables: ``ods`` (by delivery and day), ``dwd``, ``dws/daily``, ``realtime_metrics`` (by day).

    All days are redone by the first run, when a column has its first null, and while a record
    of a vehicle has a time that cannot be read: its place may lie in any day. Copies are told by
    a key that holds the time, so they lie in one day. An empty delivery changes nothing.
    Quality reports are not made here.
    """
    if "timestamp" not in cfg.dedup_key:
        raise ValueError("deliveries need a key with the time: copies must lie in one day")
    spark, raw = delivery.sparkSession, normalise(delivery)
    paths = {
        "ods": f"{out}/ods",
        "dwd": f"{out}/dwd",
        "dws": f"{out}/dws/daily",
        "realtime": f"{out}/realtime_metrics",
    }
    raw.hint("rebalance", F.col("date")).write.mode("overwrite").partitionBy("date").parquet(f"{paths['ods']}/delivery={name}")
    ods_schema = T.StructType([*raw.schema.fields, T.StructField("delivery", T.StringType())])
    taken = spark.read.schema(ods_schema).parquet(paths["ods"])
    fresh = _days(taken.filter(F.col("delivery") == name))
    ods = taken.drop("delivery")
    state = _State(spark, f"{out}/state")
    if not state.exists:
        fresh = _days(ods)

    if not ods.filter("date IS NULL AND vehicle_id IS NOT NULL").isEmpty():
        days = _redo_all(ods, paths, cfg)
    else:
        days = _redo_some(ods, fresh, state, paths, cfg)
        if days is None:
            days = _redo_some(ods, _days(ods), state, paths, cfg, restart=True)
    days["delivered"] = fresh
    held = [k for k in ("dwd", "dws", "realtime") if any(n.startswith("date=") for n in children(spark, paths[k]))]
    return {"paths": paths, "days": days, "ods": ods, **{k: spark.read.parquet(paths[k]) for k in held}}


def _redo_all(ods: DataFrame, paths: dict[str, str], cfg: Settings) -> dict[str, set]:
    """One plain run over all records."""
    spark = ods.sparkSession
    files.write_parquet(add_status(clean(ods, cfg)), paths["dwd"])
    dwd = spark.read.parquet(paths["dwd"])
    files.write_parquet(daily_metrics(dwd, cfg), paths["dws"])
    files.write_parquet(_dated_windows(dwd, cfg), paths["realtime"])
    everything = _days(ods)
    return dict.fromkeys(("cleaned", "metrics", "windows"), everything)


def _redo_some(
    ods: DataFrame, fresh: set, state: _State, paths: dict[str, str], cfg: Settings, restart: bool = False
) -> dict[str, set] | None:
    """Redo what ``fresh`` days change; None if counted values of the other days are missing."""
    spark = ods.sparkSession
    if not fresh:
        return dict.fromkeys(("cleaned", "metrics", "windows"), set())
    unique = materialise(deduplicate(ods.filter(on_days(fresh)), cfg.dedup_key), "unique")
    every = methods(ods, [c for c in FIELDS if c in ods.columns], cfg=cfg)
    ways = {way: [c for c, m in every.items() if m == way] for way in ("ffill", "bfill")}

    new_edges = materialise(_edges(unique, ways), "edges")
    old_edges = state.read("edges", new_edges.schema)
    edges = _replaced(old_edges, new_edges, fresh)
    counted = edges.agg(*[F.sum(c).alias(c) for c in edges.columns if c.startswith("nulls_")]).first().asDict()
    nulls = {c[len("nulls_") :]: n for c, n in counted.items() if n}
    how = methods(ods, list(nulls), cfg=cfg)
    valued = [c for c, m in how.items() if m in ("median", "mean")]

    old_plan = state.plan()
    if state.exists and not restart and set(valued) - old_plan.keys():
        return None
    new_values = unique.limit(0).selectExpr("date", "'' AS target", "0D AS value", "0L AS n")
    if valued:
        new_values = materialise(value_counts(unique, valued, ["date"]), "values")
    values = _replaced(state.read("values", new_values.schema), new_values, fresh)
    plan = plan_of(ods, how, _constants(values, how), nulls)
    stale = [p["column"] for p in plan if old_plan.get(p["column"], {}).get("value") != p["value"]]

    forward = {way: [c for c in columns if c in how] for way, columns in ways.items()}
    cleaned = fresh | _to_clean(old_edges, edges, forward, stale, fresh)
    if cleaned > fresh:
        unique = unique.unionByName(deduplicate(ods.filter(on_days(cleaned - fresh)), cfg.dedup_key))
    carry = carried_over(edges, KEYS, across_chunks(edges), forward["ffill"], forward["bfill"])
    filled = apply_fill(unique, plan, unique=True, edges=carry.filter(on_days(cleaned)))
    files.write_parquet(add_status(handle_outliers(filled, cfg=cfg)), paths["dwd"])
    dwd = spark.read.schema(_layer_schema(filled)).parquet(paths["dwd"])

    new_sums = materialise(daily_sums(dwd.filter(on_days(cleaned)), cfg), "sums")
    old_sums = state.read("sums", new_sums.schema)
    sums = with_eve(_replaced(old_sums, new_sums, cleaned))
    measured = cleaned | _changed(with_eve(old_sums), sums, list(EVE), cleaned)
    files.write_parquet(metrics_of(sums.filter(on_days(measured)), cfg), paths["dws"])

    windowed, chunks = _window_days(edges, cleaned, cfg.window_records - 1)
    chunks = materialise(chunks, "chunks")
    read = _days(chunks)
    records = dwd.filter(on_days(read)).join(chunks, KEYS, "left_semi").withColumn("fresh", on_days(windowed))
    files.write_parquet(_dated_windows(records, cfg, "fresh"), paths["realtime"])

    state.commit({"edges": new_edges, "values": new_values, "sums": new_sums}, plan)
    return {"cleaned": cleaned, "metrics": measured, "windows": windowed, "window_reads": read}


def _layer_schema(records: DataFrame) -> T.StructType:
    """The detail layer's columns, also where no file tells them; its states are texts."""
    return add_status(records.limit(0)).schema
