"""Null filling: per column a strategy, applied together in one select."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltfleet.functions.exact import exact_avg
from voltfleet.functions.numbers import named
from voltfleet.operators.ordering import fill_along_time
from voltfleet.operators.quantiles import exact_quantiles
from voltfleet.schema import FIELDS, integer_columns, numeric_columns, with_date
from voltfleet.settings import DEFAULTS, Settings

# Strategy -> name used in the cleaning report.
METHOD_NAMES = {
    "ffill": "forward_fill",
    "bfill": "backward_fill",
    "median": "median_fill",
    "mean": "mean_fill",
    "zero": "zero_fill",
}


def null_counts(df: DataFrame) -> tuple[int, dict[str, int]]:
    """Records, and nulls per field, in one pass."""
    columns = {c: f"count_if({c} IS NULL)" for c in FIELDS if c in df.columns}
    counts = df.selectExpr(*named({"records": "count(*)", **columns})).first().asDict()
    return counts.pop("records"), counts


def fill_plan(
    df: DataFrame, strategy: dict[str, str] | None = None, cfg: Settings = DEFAULTS
) -> list[dict]:
    """What filling would do: column, method, value, nulls found.

    Only columns that have nulls appear; median and mean skip columns that are not
    numeric. Integer columns take the lower of the two middle values, so that a 0/1
    flag never becomes a fraction.
    """
    _, counts = null_counts(df)
    nulls = {c: n for c, n in counts.items() if n > 0}
    how = methods(df, list(nulls), strategy, cfg)
    median_of = [c for c, m in how.items() if m == "median"]
    medians = exact_quantiles(df, median_of, [0.5])
    values = {c: v[0] for c, v in medians.items()}
    mean_of = [c for c, m in how.items() if m == "mean"]
    if mean_of:
        values.update(df.selectExpr(*named({c: exact_avg(c, wide=True) for c in mean_of})).first().asDict())
    return plan_of(df, how, values, nulls)


def methods(
    df: DataFrame, columns: list[str], strategy: dict[str, str] | None = None, cfg: Settings = DEFAULTS
) -> dict[str, str]:
    """How each column is filled; those no strategy can fill are left out."""
    strategy = dict(cfg.fill_strategy if strategy is None else strategy)
    how = {c: strategy.get(c, strategy.get("default", "median")) for c in columns}
    unknown = {m for m in how.values() if m not in METHOD_NAMES}
    if unknown:
        raise ValueError(f"unknown fill strategy: {sorted(unknown)}")
    numeric = set(numeric_columns(df))
    return {c: m for c, m in how.items() if m in ("ffill", "bfill") or c in numeric}


def plan_of(
    df: DataFrame, how: dict[str, str], values: dict[str, float | None], nulls: dict[str, int]
) -> list[dict]:
    """The plan's rows, from medians and means as they were found."""
    values = {**values, **{c: 0.0 for c, m in how.items() if m == "zero"}}
    for c in integer_columns(df) & values.keys():
        values[c] = None if values[c] is None else int(values[c] // 1)
    return [
        {"column": c, "strategy": m, "value": values.get(c), "filled_count": nulls[c]}
        for c, m in how.items()
    ]


def apply_fill(
    df: DataFrame,
    plan: list[dict],
    scope: str = "vehicle",
    unique: bool = False,
    edges: DataFrame | None = None,
) -> DataFrame:
    constants = {p["column"]: p["value"] for p in plan if p["value"] is not None}
    kinds = dict(df.dtypes)
    df = df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(kinds[c])) for c, v in constants.items()}
    ) if constants else df
    forward = [p["column"] for p in plan if p["strategy"] == "ffill"]
    backward = [p["column"] for p in plan if p["strategy"] == "bfill"]
    if forward or backward:
        df = fill_along_time(with_date(df), forward, backward, scope, unique, edges)
    return df


def fill_nulls(
    df: DataFrame,
    strategy: dict[str, str] | None = None,
    cfg: Settings = DEFAULTS,
    scope: str = "vehicle",
    unique: bool = False,
) -> DataFrame:
    """Fill nulls per column. ``scope`` is the reach of ffill and bfill: a null at the
    start of a vehicle's records stays null, or with ``"table"`` takes the value that
    precedes it in ingest order, whichever vehicle that belongs to.
    ``unique`` tells that the records are deduplicated.
    """
    return apply_fill(df, fill_plan(df, strategy, cfg), scope, unique)
