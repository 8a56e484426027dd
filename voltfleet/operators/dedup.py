"""Duplicates: removal, counting, examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltfleet.functions.numbers import rate
from voltfleet.schema import with_date
from voltfleet.settings import DEFAULTS, Settings


def deduplicate(df: DataFrame, key: tuple[str, ...] = DEFAULTS.dedup_key) -> DataFrame:
    """Keep the first row, in ingest order, of each key.

    ``row_number() = 1`` is cut to one row per key on the map side already
    (WindowGroupLimit in the plan), so a key with very many copies costs its
    reducer one row per map task. ``date`` follows from the time stamp; having it
    in the partitioning leaves the rows sorted for the (vehicle, date) steps after.
    Records whose time cannot be read are no copies of each other: all of them stay.
    A table without all key columns is returned as it is.
    """
    if any(c not in df.columns for c in key):
        return df
    by = list(key)
    if "timestamp" in key and "vehicle_id" in key:
        df = with_date(df)
        by = ["vehicle_id", "date", *[c for c in key if c != "vehicle_id"]]
    if "timestamp" in key:
        by.append(F.when(F.col("timestamp").isNull(), F.col("seq")))
    first = F.row_number().over(Window.partitionBy(*by).orderBy("seq"))
    return df.withColumn("_copy", first).filter("_copy = 1").drop("_copy")


def duplicate_counts(df: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """One row: records, surplus copies, their rate in percent."""
    if any(c not in df.columns for c in cfg.dedup_key):
        return df.selectExpr(
            "count(*) AS total_records", "0L AS duplicate_count", "0D AS duplicate_rate"
        )
    per_key = df.groupBy(*cfg.dedup_key).agg(F.count("*").alias("n"))
    surplus = "n - 1"
    if "timestamp" in cfg.dedup_key:  # unread times make no copies
        surplus = "CASE WHEN timestamp IS NULL THEN 0 ELSE n - 1 END"
    return per_key.selectExpr(
        "coalesce(sum(n), 0L) AS total_records", f"coalesce(sum({surplus}), 0L) AS duplicate_count"
    ).selectExpr("*", f"{rate('duplicate_count', 'total_records')} AS duplicate_rate")


def duplicate_examples(df: DataFrame, n: int = 5, cfg: Settings = DEFAULTS) -> DataFrame:
    """The first ``n`` rows, in ingest order, among all rows whose key repeats.

    A key repeats exactly if it has a second row, and no key can place more than
    ``n`` rows in the answer: so ``max(n, 2)`` rows per key are enough, and the
    map side keeps no more than those.
    """
    keep = max(n, 2)
    if "timestamp" in cfg.dedup_key:
        df = df.filter("timestamp IS NOT NULL")
    key = Window.partitionBy(*cfg.dedup_key)
    ranked = df.withColumn("_rank", F.row_number().over(key.orderBy("seq"))).filter(
        F.col("_rank") <= keep
    )
    repeated = ranked.withColumn("_copies", F.max("_rank").over(key)).filter("_copies > 1")
    return repeated.drop("_rank", "_copies").orderBy("seq").limit(n)
