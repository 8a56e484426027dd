"""Reports over the daily metrics, the layers and the quality figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltfleet.functions.exact import exact_avg, exact_stddev, halves
from voltfleet.functions.numbers import (
    half_up,
    named,
    number,
    row,
    rows,
    text,
)
from voltfleet.operators.metrics import METRIC_COLUMNS
from voltfleet.operators.quality import (
    cell_counts,
    completeness_columns,
    null_rates,
    physical_outliers,
)
from voltfleet.operators.quantiles import exact_quantiles
from voltfleet.schema import FIELDS, numeric_columns, with_date
from voltfleet.settings import DEFAULTS, METRIC_UNITS, Settings


def value_columns(table: DataFrame) -> list[str]:
    """Numeric columns of a metric table."""
    return numeric_columns(table, exclude=("vehicle_id", "date", "update_time", "metric_name"))


def _mean(column: str) -> str:
    return exact_avg(f"CAST({column} AS DOUBLE)")


def _spread(column: str) -> dict[str, str]:
    return {
        "mean": half_up(_mean(column), 2),
        "min": half_up(f"CAST(min({column}) AS DOUBLE)", 2),
        "max": half_up(f"CAST(max({column}) AS DOUBLE)", 2),
    }


def _by_column(df: DataFrame, columns: list[str], figures: dict[str, str]) -> DataFrame:
    """One row of figures per column, out of aggregates over ``x``; also where there are no rows."""
    pairs = [row({"column_name": text(c), "x": f"CAST({c} AS DOUBLE)"}) for c in columns]
    values = df.selectExpr(rows(pairs)).selectExpr("*", *named(halves("x", "x")))
    found = values.groupBy("column_name").agg(*[F.expr(e) for e in named(figures)])
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return names.join(found, "column_name", "left")


def summary_statistics(wide: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Per metric and column: mean, std, min, max, median over all vehicle days."""
    columns = value_columns(wide)
    medians = exact_quantiles(wide, columns, [0.5])
    found = _by_column(wide, columns, {**_spread("x"), "std": half_up(exact_stddev("x", "x"), 2)})
    owners = [
        row({"metric": text(m), "column_name": text(c), "median": half_up(number(medians[c][0]), 2)})
        for m, own in METRIC_COLUMNS.items()
        for c in own
    ]
    listed = wide.sparkSession.range(1).selectExpr(rows(owners))
    names = ("metric", "column_name", "mean", "std", "min", "max", "median")
    return listed.join(F.broadcast(found), "column_name").select(*names)


def mean_by(table: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """Mean of metric columns per day or per vehicle (trend and distribution)."""
    columns = columns or value_columns(table)
    return table.groupBy(key).agg(*[F.expr(e) for e in named({c: _mean(c) for c in columns})])


def vehicle_summary(wide: DataFrame, first: int = 5) -> DataFrame:
    """Per vehicle: mean of the first five metric columns."""
    return mean_by(wide, "vehicle_id", value_columns(wide)[:first])


def metric_ranges(wide: DataFrame) -> DataFrame:
    """Per metric column: mean, min and max over all rows."""
    found = [row({"column_name": text(c), **_spread(c)}) for c in value_columns(wide)]
    figures = wide.selectExpr(f"array({', '.join(found)}) AS found")
    return figures.selectExpr("inline(found)")


def metric_cards(wide: DataFrame) -> DataFrame:
    """Per metric: mean of its first column, with the unit."""
    main = {name: own[0] for name, own in METRIC_COLUMNS.items()}
    found = [
        row(
            {
                "metric": text(name),
                "column_name": text(c),
                "value": half_up(_mean(c), 2),
                "unit": text(METRIC_UNITS[name]),
            }
        )
        for name, c in main.items()
    ]
    return wide.selectExpr(f"array({', '.join(found)}) AS found").selectExpr("inline(found)")


def quality_stats(report: DataFrame) -> DataFrame:
    """Four figures out of a full cleaning report."""
    return report.selectExpr(
        "original_quality.original_count AS original_count",
        "final_record_count AS final_count",
        "final_quality.completeness.completeness AS completeness",
        "original_quality.duplicates.duplicate_rate AS duplicate_rate",
    )


def records_per_day(df: DataFrame) -> DataFrame:
    return with_date(df).groupBy("vehicle_id", "date").agg(F.count("*").alias("record_count"))


def top_vehicles(df: DataFrame, n: int = 10) -> DataFrame:
    counts = df.groupBy("vehicle_id").agg(F.count("*").alias("record_count"))
    return counts.orderBy(F.desc("record_count"), "vehicle_id").limit(n)


def null_ranking(df: DataFrame, n: int = 10) -> DataFrame:
    found = null_rates(df).filter("null_rate > 0")
    return found.orderBy(F.desc("null_rate"), "column_name").limit(n)


def outlier_share(df: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Columns with out-of-range values and each one's share of all of them."""
    found = physical_outliers(df, cfg, with_total=True).filter("outlier_count > 0")
    share = half_up("try_divide(outlier_count * 100D, total)", 2)
    return found.withColumn("share", F.expr(share)).drop("total")


def overview(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows of the raw and the detail layer, number of metrics, final completeness."""
    counts = cell_counts(cleaned)
    share = completeness_columns(counts)["completeness"]
    final = counts.selectExpr("1 AS part", "records AS dwd_rows", f"{share} AS completeness")
    return (
        raw.selectExpr("count(*) AS ods_rows")
        .withColumn("part", F.lit(1))
        .join(final, "part")
        .selectExpr(
            "ods_rows", "dwd_rows", f"{len(METRIC_COLUMNS)}L AS metric_count", "completeness"
        )
    )


def column_profile(df: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Per numeric column: count, mean, std, min, quartiles, max."""
    columns = [c for c in numeric_columns(df) if c in FIELDS]
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    figures = {
        "value_count": "count(x)",
        "mean": half_up(exact_avg("x", wide=True), 4),
        "std": half_up(exact_stddev("x", "x", wide=True), 4),
        "min": "min(x)",
        "max": "max(x)",
    }
    found = _by_column(df, columns, figures)
    known = [
        row({"column_name": text(c), **{k: number(q) for k, q in zip(("q25", "q50", "q75"), quartiles[c])}})
        for c in columns
    ]
    known = df.sparkSession.range(1).selectExpr(rows(known))
    names = ("column_name", "value_count", "mean", "std", "min", "q25", "q50", "q75", "max")
    return known.join(F.broadcast(found.fillna(0, ["value_count"])), "column_name").select(*names)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("record_count"))


def latest_points(df: DataFrame, n: int = 100) -> DataFrame:
    return df.orderBy(F.desc("timestamp"), F.desc("seq")).limit(n)


def head(df: DataFrame, n: int) -> DataFrame:
    """The first rows in ingest order."""
    return df.orderBy("seq").limit(n)
