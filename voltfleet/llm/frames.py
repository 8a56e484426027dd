"""Small helpers the text operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ship import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


#: Bytes of a batch that are worked on together.
PIECE = 8 << 20


def give_back() -> None:
    """Return freed memory to the system: workers live on, and the next stage needs room."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about PIECE bytes, or of one row."""
    for batch in batches:
        rows = max(1, batch.num_rows * PIECE // max(batch.nbytes, PIECE))
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def per_batch(
    df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Map every Arrow batch of a table on its own; a batch may vanish."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            if (out := step(batch)) is not None:
                yield out
        give_back()

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def texts(column: pa.Array) -> list[str]:
    """Values of a text column; null is the empty text."""
    return [t or "" for t in column.to_pylist()]


def cut(text: Column, chars: int) -> Column:
    """A text of up to ``chars`` characters whole, a longer one as four parts from all over it."""
    size, part = F.length(text), chars // 4
    parts = [F.substring(text, (F.floor(k * (size - part) / 3) + 1).cast("int"), F.lit(part)) for k in range(4)]
    return F.when(size <= chars, text).when(size > chars, F.concat_ws(" ", *parts)).otherwise("")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, train: Column, per_class: int, chars: int
) -> list[tuple[str, int]]:
    """Texts, cut to ``chars`` characters, and labels of at most ``per_class`` training ids of each class.

    The ids are those with the smallest hash, so the choice does not hang on row order. Ids
    labelled twice with different labels are left out; of rows with one id the least text counts.
    """
    chosen = None
    known = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & train)
        .groupBy("doc_id")
        .agg(F.min(label).alias("low"), F.max(label).alias("label"))
        .filter("low = label")
    )
    for value in (0, 1):
        part = known.filter(F.col("label") == value)
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen.select("doc_id", "label")), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min(cut(F.col("text"), chars)).alias("text"))
        .withColumn("h", F.xxhash64("doc_id"))
        .collect()
    )
    rows.sort(key=lambda r: (r["h"], r["doc_id"]))
    return [(r["text"], r["label"]) for r in rows]
