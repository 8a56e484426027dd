"""Streams that need no Python: event-time windows, deduplication, derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from voltfleet.functions.derive import add_flags, add_power, add_status
from voltfleet.operators.outliers import handle_outliers
from voltfleet.operators.realtime import sliding_windows
from voltfleet.settings import DEFAULTS, Settings


def stream_sliding_windows(
    stream: DataFrame, delay: str = "10 minutes", cfg: Settings = DEFAULTS, size: int | None = None
) -> DataFrame:
    """Event-time windows; records later than ``delay`` behind the newest one are dropped."""
    return sliding_windows(stream.withWatermark("timestamp", delay), cfg, size)


def stream_deduplicate(
    stream: DataFrame, delay: str = "10 minutes", cfg: Settings = DEFAULTS
) -> DataFrame:
    """One record per key; copies are recognised for ``delay`` of event time."""
    return stream.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(
        list(cfg.dedup_key)
    )


def stream_derive(stream: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Clipping and all row-wise columns; the same code as in batch."""
    return add_flags(add_power(add_status(handle_outliers(stream, cfg=cfg)), cfg), cfg)
