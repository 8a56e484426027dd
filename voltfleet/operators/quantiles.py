"""Exact quantiles of whole columns, one path for every size.

``percentile`` sends a map of all values of a column to one task. Here (column, value)
pairs are counted by an ordinary shuffle, the counts are dealt out in order of column and
value over many partitions, and running counts are made inside each partition. One total
per column and partition joins them up; the values at the wanted ranks are then picked out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltfleet.functions.numbers import named, number, rows, text
from voltfleet.sources.workspace import materialise


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float | None]]:
    """Column -> quantiles with linear interpolation; nulls are left out."""
    columns = list(columns)
    return quantiles_of(value_counts(df, columns), columns, probabilities) if columns else {}


def value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """How often each value of each column occurs: target (the column), value, n."""
    pairs = [f"named_struct('target', {text(c)}, 'value', CAST({c} AS DOUBLE))" for c in columns]
    laid_out = df.selectExpr(*by, rows(pairs)).filter("value IS NOT NULL")
    return laid_out.groupBy(*by, "target", "value").agg(F.count("*").alias("n"))


def quantiles_of(
    counts: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float | None]]:
    """Column -> quantiles, from one row per column and distinct value (``value_counts``)."""
    probabilities = list(probabilities)
    # Written, since the borders of the ranges are sampled anew when it is computed anew.
    placed = materialise(
        counts.repartitionByRange("target", "value").withColumn("part", F.spark_partition_id()), "ranks"
    )
    own = placed.groupBy("target", "part").agg(F.sum("n").alias("own"))
    totals = own.selectExpr(
        "target",
        "part",
        "sum(own) OVER (PARTITION BY target ORDER BY part) - own AS before",
        "sum(own) OVER (PARTITION BY target) - 1 AS last",
    )
    here = Window.partitionBy("target", "part").orderBy("value")
    ranked = (
        placed.join(F.broadcast(totals), ["target", "part"])  # a row per column and partition
        .withColumn("upto", F.col("before") + F.sum("n").over(here))
    )
    wanted = {}
    for k, p in enumerate(probabilities):
        place = f"(last * {number(p)})"
        low = f"min(CASE WHEN upto > floor({place}) THEN value END)"
        high = f"min(CASE WHEN upto > ceil({place}) THEN value END)"
        place = f"(max(last) * {number(p)})"
        wanted[f"q{k}"] = (
            f"CASE WHEN floor({place}) = ceil({place}) THEN {low}"
            f" ELSE (ceil({place}) - {place}) * {low} + ({place} - floor({place})) * {high} END"
        )
    found = ranked.groupBy("target").agg(*[F.expr(e) for e in named(wanted)]).collect()
    by_target = {r["target"]: [r[f"q{k}"] for k in range(len(probabilities))] for r in found}
    return {c: by_target.get(c, [None] * len(probabilities)) for c in columns}
