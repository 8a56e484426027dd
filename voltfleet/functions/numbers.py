"""Number helpers shared by every operator: SQL text in, SQL text out. Sums are in ``exact``."""

from __future__ import annotations

import math


def half_up(value: str, digits: int) -> str:
    """Round half up; ``round`` on doubles goes through BigDecimal and is slower."""
    scale = f"{10**digits}D"
    return f"(CAST(floor(({value}) * {scale} + 0.5D) AS DOUBLE) / {scale})"


def percent(part: str, whole: str) -> str:
    """part / whole * 100, and 0 where there is nothing to divide by."""
    return f"CASE WHEN ({whole}) > 0 THEN try_divide(({part}) * 100D, ({whole}) * 1D) ELSE 0D END"


def rate(part: str, whole: str) -> str:
    """Percent with two decimals."""
    return half_up(percent(part, whole), 2)


def named(columns: dict[str, str]) -> list[str]:
    """Name -> expression as a select list."""
    return [f"{value} AS `{name}`" for name, value in columns.items()]


def row(columns: dict[str, str]) -> str:
    """Name -> expression as one struct."""
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in columns.items()) + ")"


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value: float | int | None) -> str:
    """A DOUBLE literal with every digit of the value."""
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    value = float(value)
    return f"{value!r}D" if math.isfinite(value) else f"CAST('{value}' AS DOUBLE)"


def rows(items: list[str]) -> str:
    """Structs as rows of a table."""
    return f"inline(array({', '.join(items)}))"
