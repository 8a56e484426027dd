"""Cleaning: duplicates out, nulls filled, outliers handled, each step optional."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from voltfleet.functions.numbers import half_up, named, number, row, rows, text
from voltfleet.operators.dedup import deduplicate, duplicate_counts
from voltfleet.operators.fill import METHOD_NAMES, apply_fill, fill_plan
from voltfleet.operators.outliers import handle_outliers, physical_bounds
from voltfleet.operators.quality import (
    cell_counts,
    completeness_columns,
    outlier_total_columns,
    quality_report,
)
from voltfleet.schema import normalise
from voltfleet.settings import DEFAULTS, Settings
from voltfleet.sources.workspace import materialise


@dataclass(frozen=True)
class Stages:
    """The table after each step; a step that was switched off repeats the one before."""

    raw: DataFrame
    deduplicated: DataFrame
    filled: DataFrame
    cleaned: DataFrame
    fill_plan: list[dict]


def clean_stages(
    df: DataFrame,
    cfg: Settings = DEFAULTS,
    *,
    remove_duplicates: bool = True,
    fill_nulls: bool = True,
    outliers: bool = True,
    method: str = "physical",
    action: str = "clip",
) -> Stages:
    raw = normalise(df)
    unique, plan = raw, []
    if remove_duplicates:
        unique = deduplicate(raw, cfg.dedup_key)
    if fill_nulls:
        if remove_duplicates:
            # Read several times below (nulls, medians, day edges): shuffled once.
            unique = materialise(unique, "deduplicated")
        plan = fill_plan(unique, cfg=cfg)
    filled = apply_fill(unique, plan, unique=remove_duplicates)
    cleaned = handle_outliers(filled, method, action, cfg) if outliers else filled
    return Stages(raw, unique, filled, cleaned, plan)


def clean(df: DataFrame, cfg: Settings = DEFAULTS, **steps) -> DataFrame:
    return clean_stages(df, cfg, **steps).cleaned


def cleaning_counters(
    stages: Stages, cfg: Settings = DEFAULTS, action: str = "clip"
) -> DataFrame:
    """What each step did: one row for dedup, one per filled and per handled column.

    Four one-row counts joined on a constant, then laid out as rows.
    """
    before = stages.raw.selectExpr("1 AS part", "count(*) AS raw_rows")
    after = stages.deduplicated.selectExpr("1 AS part", "count(*) AS unique_rows")
    filled = cell_counts(stages.filled, cfg).drop("records").selectExpr("1 AS part", "*")
    final = cell_counts(stages.cleaned, cfg)
    final = final.selectExpr("1 AS part", *named({f"final_{c}": c for c in final.columns}))
    counts = before.join(after, "part").join(filled, "part").join(final, "part")

    def entry(step, column, method, value, count_before, count_after):
        return row(
            {
                "step": text(step),
                "column_name": text(column),
                "method": text(method),
                "value": number(value),
                "count_before": count_before,
                "count_after": count_after,
            }
        )

    key = ",".join(cfg.dedup_key)
    found = [entry("deduplication", key, "keep_first", None, "raw_rows", "unique_rows")]
    for p in stages.fill_plan:
        c, method = p["column"], METHOD_NAMES[p["strategy"]]
        nulls = f"{p['filled_count']}L"
        found.append(entry("null_filling", c, method, p["value"], nulls, f"null_{c}"))
    for c in physical_bounds(stages.filled, cfg):
        found.append(entry("outlier_handling", c, action, None, f"out_{c}", f"final_out_{c}"))
    listed = counts.selectExpr(rows(found))
    return listed.filter("step <> 'outlier_handling' OR count_before > 0")


def improvement(stages: Stages, cfg: Settings = DEFAULTS) -> DataFrame:
    """Gain in completeness, copies removed, outliers handled, rows left: one row."""
    raw, final = cell_counts(stages.raw, cfg), cell_counts(stages.cleaned, cfg)
    raw = raw.selectExpr(
        "1 AS part",
        f"{completeness_columns(raw)['completeness']} AS before",
        f"{outlier_total_columns(raw)['total_physical_outliers']} AS outliers",
    )
    final = final.selectExpr(
        "1 AS part",
        f"{completeness_columns(final)['completeness']} AS after",
        "records AS final_records",
    )
    copies = duplicate_counts(stages.raw, cfg).selectExpr("1 AS part", "duplicate_count AS copies")
    joined = raw.join(final, "part").join(copies, "part")
    return joined.selectExpr(*named(_gain("before", "after", "copies", "outliers", "final_records")))


def _gain(before: str, after: str, copies: str, outliers: str, rows_left: str) -> dict[str, str]:
    return {
        "completeness_improved": half_up(f"{after} - {before}", 2),
        "duplicates_removed": copies,
        "outliers_handled": outliers,
        "final_record_count": rows_left,
    }


def stored(stages: Stages) -> Stages:
    """The same stages with the cleaned table written out, for reports that read it often."""
    return replace(stages, cleaned=materialise(stages.cleaned, "cleaned"))


def cleaning_report(stages: Stages, report_time: str, cfg: Settings = DEFAULTS) -> DataFrame:
    """Checks before and after, the steps between and the gain, as one nested row.

    The cleaned table is read several times: pass one that is written (``stored``).
    """

    def whole(df: DataFrame, name: str) -> DataFrame:
        return df.selectExpr("1 AS part", f"struct({', '.join(df.columns)}) AS {name}")

    steps = cleaning_counters(stages, cfg)
    listed = f"array_sort(collect_list(struct({', '.join(steps.columns)})))"
    steps = steps.selectExpr("1 AS part", f"{listed} AS cleaning_steps")
    gain = _gain(
        "original_quality.completeness.completeness",
        "final_quality.completeness.completeness",
        "original_quality.duplicates.duplicate_count",
        "original_quality.outliers.total_physical_outliers",
        "final_quality.original_count",
    )
    final_count = gain.pop("final_record_count")
    return (
        whole(quality_report(stages.raw, report_time, cfg), "original_quality")
        .join(whole(quality_report(stages.cleaned, report_time, cfg), "final_quality"), "part")
        .join(steps, "part")
        .selectExpr(
            "original_quality",
            "cleaning_steps",
            "final_quality",
            f"{final_count} AS final_record_count",
            f"{row(gain)} AS improvement",
        )
    )
