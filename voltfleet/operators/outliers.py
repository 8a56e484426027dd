"""Outlier handling: clip, remove or null out values outside a column's bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltfleet.functions.numbers import number
from voltfleet.operators.quantiles import exact_quantiles
from voltfleet.schema import numeric_columns
from voltfleet.settings import DEFAULTS, Settings

Bounds = dict[str, tuple[float, float]]


def physical_bounds(df: DataFrame, cfg: Settings = DEFAULTS) -> Bounds:
    numeric = set(numeric_columns(df))
    return {c: cfg.ranges[c] for c in df.columns if c in cfg.ranges and c in numeric}


def iqr_bounds(
    df: DataFrame, columns: list[str], factor: float = DEFAULTS.iqr_factor, cfg: Settings = DEFAULTS
) -> Bounds:
    quartiles = exact_quantiles(df, columns, [0.25, 0.75])
    return {
        c: (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
        for c, (q1, q3) in quartiles.items()
        if q1 is not None
    }


def outside(column: str, bounds: tuple[float, float]) -> str:
    """True outside the bounds, null for null."""
    return f"{column} NOT BETWEEN {number(bounds[0])} AND {number(bounds[1])}"


def clipped(column: str, bounds: tuple[float, float]) -> str:
    """Null stays null; ``greatest(lo, least(hi, c))`` would turn it into a bound."""
    lo, hi = (number(b) for b in bounds)
    return f"CASE WHEN {column} < {lo} THEN {lo} WHEN {column} > {hi} THEN {hi} ELSE {column} END"


def handle_outliers(
    df: DataFrame,
    method: str = "physical",
    action: str = "clip",
    cfg: Settings = DEFAULTS,
    bounds: Bounds | None = None,
) -> DataFrame:
    """``method``: physical or iqr. ``action``: clip, remove or nan."""
    if bounds is None:
        bounds = physical_bounds(df, cfg)
        if method == "iqr":
            bounds = iqr_bounds(df, list(bounds), cfg.iqr_factor, cfg)
        elif method != "physical":
            raise ValueError(f"unknown method: {method}")
    if not bounds:
        return df
    if action == "clip":
        return df.withColumns({c: F.expr(clipped(c, b)) for c, b in bounds.items()})
    if action == "remove":
        return df.filter(" AND ".join(f"NOT ({outside(c, b)})" for c, b in bounds.items()))
    if action == "nan":
        return df.withColumns(
            {c: F.expr(f"CASE WHEN NOT ({outside(c, b)}) THEN {c} END") for c, b in bounds.items()}
        )
    raise ValueError(f"unknown action: {action}")
