"""Quality checks, each answered in one or a few rows.

Counts read the table once; quartiles and the values outside their fences twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from voltfleet.functions.numbers import half_up, named, number, rate, row, rows, text
from voltfleet.operators.dedup import duplicate_counts, duplicate_examples
from voltfleet.operators.outliers import Bounds, outside, physical_bounds
from voltfleet.operators.quantiles import exact_quantiles
from voltfleet.schema import FIELDS, numeric_columns
from voltfleet.settings import DEFAULTS, Settings


def checked_columns(df: DataFrame) -> list[str]:
    """The telemetry fields of the table; ``seq`` and ``date`` are not measured data."""
    return [c for c in FIELDS if c in df.columns]


def cell_counts(df: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """One row: records, nulls per column and out-of-range values per ranged column."""
    bounds = physical_bounds(df, cfg)
    columns = {
        "records": "count(*)",
        **{f"null_{c}": f"count_if({c} IS NULL)" for c in checked_columns(df)},
        **{f"out_{c}": f"count_if({outside(c, b)})" for c, b in bounds.items()},
    }
    return df.selectExpr(*named(columns))


def _total(counts: DataFrame, prefix: str) -> str:
    return "(" + " + ".join(["0L", *[c for c in counts.columns if c.startswith(prefix)]]) + ")"


def completeness_columns(counts: DataFrame) -> dict[str, str]:
    width = sum(c.startswith("null_") for c in counts.columns)
    cells, nulls = f"(records * {width}L)", _total(counts, "null_")
    share = f"CASE WHEN {cells} > 0 THEN (1D - try_divide({nulls}, {cells})) * 100D ELSE 100D END"
    return {
        "total_records": "records",
        "total_cells": cells,
        "null_cells": nulls,
        "completeness": half_up(share, 2),
    }


def completeness(df: DataFrame) -> DataFrame:
    counts = cell_counts(df)
    return counts.selectExpr(*named(completeness_columns(counts)))


def _null_figures(column: str) -> dict[str, str]:
    return {"null_count": f"null_{column}", "null_rate": rate(f"null_{column}", "records")}


def null_rates(df: DataFrame) -> DataFrame:
    """Per column: nulls and their rate in percent."""
    found = [row({"column_name": text(c), **_null_figures(c)}) for c in checked_columns(df)]
    return cell_counts(df).selectExpr(rows(found))


def _outlier_figures(column: str) -> dict[str, str]:
    return {"outlier_count": f"out_{column}", "outlier_rate": rate(f"out_{column}", "records")}


def physical_outliers(
    df: DataFrame, cfg: Settings = DEFAULTS, with_total: bool = False
) -> DataFrame:
    """Per ranged column: the range, values outside it and their rate in percent."""
    counts = cell_counts(df, cfg)
    total = {"total": _total(counts, "out_")} if with_total else {}
    found = [
        row(
            {
                "column_name": text(c),
                "lower_bound": number(lo),
                "upper_bound": number(hi),
                **_outlier_figures(c),
                **total,
            }
        )
        for c, (lo, hi) in physical_bounds(df, cfg).items()
    ]
    return counts.selectExpr(rows(found))


def outlier_total_columns(counts: DataFrame) -> dict[str, str]:
    total = _total(counts, "out_")
    return {
        "total_physical_outliers": total,
        "total_physical_outlier_rate": rate(total, "records"),
    }


def outlier_totals(df: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Out-of-range cells over all columns, as a rate of the records (may pass 100)."""
    counts = cell_counts(df, cfg)
    return counts.selectExpr(*named(outlier_total_columns(counts)))


def iqr_outliers(
    df: DataFrame,
    columns: list[str] | None = None,
    factor: float | None = None,
    cfg: Settings = DEFAULTS,
    only_found: bool = True,
) -> DataFrame:
    """Per numeric column: quartiles, fences, values outside the fences."""
    factor = cfg.iqr_factor if factor is None else factor
    columns = columns or [c for c in numeric_columns(df) if c in FIELDS]
    quartiles = exact_quantiles(df, columns, [0.25, 0.75])
    fences: Bounds = {
        c: (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
        for c, (q1, q3) in quartiles.items()
        if q1 is not None
    }
    counts = df.selectExpr(
        "count(*) AS records",
        *named({f"out_{c}": f"count_if({outside(c, b)})" for c, b in fences.items()}),
    )
    found = []
    for c, (lo, hi) in fences.items():
        q1, q3 = quartiles[c]
        shown = {"q1": q1, "q3": q3, "iqr": q3 - q1, "lower_bound": lo, "upper_bound": hi}
        figures = {k: half_up(number(v), 2) for k, v in shown.items()}
        found.append(row({"column_name": text(c), **figures, **_outlier_figures(c)}))
    kind = (
        "array<struct<column_name:string,q1:double,q3:double,iqr:double,lower_bound:double,"
        "upper_bound:double,outlier_count:bigint,outlier_rate:double>>"
    )
    listed = counts.selectExpr(f"inline(CAST(array({', '.join(found)}) AS {kind}))")
    return listed.filter("outlier_count > 0") if only_found else listed


def quality_gate(df: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Completeness and duplicate rate against their thresholds, in one row."""
    complete = completeness(df).selectExpr("1 AS part", "completeness")
    unique = duplicate_counts(df, cfg).selectExpr("1 AS part", "duplicate_rate")
    return (
        complete.join(unique, "part")
        .selectExpr(
            "completeness",
            "duplicate_rate",
            f"completeness >= {cfg.completeness_threshold!r}D AS complete_enough",
            f"duplicate_rate <= {cfg.duplicate_threshold!r}D AS unique_enough",
        )
        .selectExpr("*", "complete_enough AND unique_enough AS passed")
    )


def require_quality(df: DataFrame, cfg: Settings = DEFAULTS) -> None:
    """Raise unless the table passes the gate."""
    found = quality_gate(df, cfg).first()
    if not found["passed"]:
        raise ValueError(
            f"quality gate: completeness {found['completeness']} %, "
            f"duplicates {found['duplicate_rate']} %"
        )


def quality_report(df: DataFrame, report_time: str, cfg: Settings = DEFAULTS) -> DataFrame:
    """All checks of one table as one nested row, ready for the JSON sink.

    Its parts are one-row tables (the examples: five rows), joined on a constant.
    """
    counts = cell_counts(df, cfg)
    nulls = row({c: row(_null_figures(c)) for c in checked_columns(df)})
    physical = {
        c: row(
            {
                "column": text(c),
                "method": "'physical_range'",
                "physical_range": f"array({number(lo)}, {number(hi)})",
                **_outlier_figures(c),
            }
        )
        for c, (lo, hi) in physical_bounds(df, cfg).items()
    }
    whole = counts.selectExpr(
        "1 AS part",
        "records AS original_count",
        row({**completeness_columns(counts), "column_null_rates": nulls}) + " AS completeness",
        row(physical) + " AS physical_method",
        *named(outlier_total_columns(counts)),
    )
    entry = row(
        {
            "column": "column_name",
            "method": "'IQR'",
            "Q1": "q1",
            "Q3": "q3",
            "IQR": "iqr",
            **{c: c for c in ("lower_bound", "upper_bound", "outlier_count", "outlier_rate")},
        }
    )
    iqr = iqr_outliers(df, cfg=cfg).selectExpr(
        "1 AS part",
        f"map_from_entries(collect_list(struct(column_name, {entry}))) AS iqr_method",
    )
    copies = duplicate_counts(df, cfg).selectExpr("1 AS part", "duplicate_count", "duplicate_rate")
    example = f"struct(seq, struct({', '.join(checked_columns(df))}) AS example)"
    examples = duplicate_examples(df, cfg=cfg).selectExpr(
        "1 AS part", f"nullif(array_sort(collect_list({example})).example, array()) AS examples"
    )
    joined = whole.join(iqr, "part").join(copies, "part").join(examples, "part")
    keys = ", ".join(text(c) for c in cfg.dedup_key)
    return joined.selectExpr(
        f"{text(report_time)} AS report_time",
        "original_count",
        "completeness",
        f"struct(duplicate_count, duplicate_rate, array({keys}) AS key_columns, examples)"
        " AS duplicates",
        "struct(iqr_method, physical_method, total_physical_outliers,"
        " total_physical_outlier_rate) AS outliers",
    )
