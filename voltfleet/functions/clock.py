"""Time arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MICROS = 1_000_000


def epoch_micros(at: str) -> str:
    """Microseconds since 1970 by the wall clock of the stamp.

    ``unix_micros`` would read wall-clock stamps in the session zone.
    """
    minutes = f"hour({at}) * 60 + minute({at})"
    days = f"CAST(datediff(to_date({at}), DATE '1970-01-01') AS BIGINT)"
    seconds = f"CAST(date_part('SECOND', {at}) * {MICROS} AS BIGINT)"
    return f"(({days} * 1440 + {minutes}) * 60L * {MICROS}L + {seconds})"


def with_micros(df: DataFrame) -> DataFrame:
    """Add ``at``: the time stamp as a number, taken once and then only subtracted."""
    return df.withColumn("at", F.expr(epoch_micros("timestamp")))


def seconds_between(later: str, earlier: str) -> str:
    """Seconds from one ``at`` to another, as a double."""
    return f"(({later} - {earlier}) / {MICROS}D)"
