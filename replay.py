"""Stored records played back as a stream, for the registered queries and the tests: message files in time order."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltfleet.functions.clock import epoch_micros
from voltfleet.operators.ordering import in_time
from voltfleet.schema import normalise
from voltfleet.sources.messages import send_batch


def width_of(df: DataFrame, slices: int) -> int:
    """Seconds of one slice."""
    at = epoch_micros("CAST(timestamp AS TIMESTAMP_NTZ)")
    lo, hi = df.selectExpr(f"min({at}) AS lo", f"max({at}) AS hi").first()
    return 1 if lo is None else (hi - lo) // 1_000_000 // slices + 1


def time_slices(df: DataFrame, slices: int, late: str = "false") -> list[DataFrame]:
    """The records cut into equal spans of time, oldest first; unread times go with the one read before.

    Records for which ``late`` holds come one slice late, the last ones in a slice of their own.
    """
    placed = in_time(normalise(df))
    at = epoch_micros("place" if "place" in placed.columns else "timestamp")
    placed = placed.withColumn("_at", F.expr(at)).drop("place", "day", "date")
    lo = placed.agg(F.min("_at")).first()[0]
    if lo is None:
        return [placed.drop("_at")]
    width = width_of(placed, slices) * 1_000_000
    slice_ = F.coalesce(F.expr(f"(_at - {lo}L) div {width}L"), F.lit(0)) + F.expr(f"CAST({late} AS INT)")
    placed = placed.withColumn("_slice", slice_).drop("_at")
    last = placed.agg(F.max("_slice")).first()[0]
    return [placed.filter(F.col("_slice") == i).drop("_slice") for i in range(max(last + 1, slices))]


def play(df: DataFrame, folder: str, slices: int = 2, late: str = "false") -> Iterator[int]:
    """Append one slice after another to a folder of messages, pausing after each."""
    for i, part in enumerate(time_slices(df, slices, late)):
        send_batch(part, folder, fmt="text")
        yield i
