"""Text quality by a regularised quadratic discriminant.

Every whole text becomes a vector of transformed statistics (logarithms of sizes, square
roots of shares). Spark sums counts, vectors and products by class over all labelled
training rows; each class's covariance is shrunk towards the pooled one and towards its
diagonal. A score is the class-1 probability from the difference of the two log densities,
by Mahalanobis distances with Cholesky factors that are computed once and sent along.

Null and empty texts are vectors of zeros and get a score like any other. With labels of
one class only, every score is that class; without labels every score is 0.5. Ids labelled
twice count once if the labels agree, else not at all. Repeated rows get equal scores; other
columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import materialise
from . import words
from .frames import fold, per_batch, table
from .rules import counts_of, per_text

OWN, ROUND = 0.1, 0.02  # shares of the pooled covariance and of its diagonal in each class's


def _flags(chars: bytes | range) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SETS = {
    "upper": _flags(range(0x41, 0x5B)),
    "digit": _flags(range(0x30, 0x3A)),
    "stop": _flags(b".!?"),
    "comma": _flags(b",;:"),
    "bar": _flags(b"|"),
    "mark": _flags(b"!#*$%&<>"),
}
FEATURES = ["words", "length", "symbols", "twice", "repeats", "lines", "kinds", "usual", *_SETS]


def _vectors(found: words.Words) -> np.ndarray:
    """Transformed statistics of every text of a chunk, one row each."""
    c = counts_of(found)
    n = found.texts
    w = np.maximum(c["n_words"], 1)
    size = np.maximum(np.diff(found.offsets), 1)
    order = np.lexsort((found.hash, found.doc))
    doc, h = found.doc[order], found.hash[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    kinds = np.bincount(doc[new], minlength=n)
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(h)))
    most = np.zeros(n)
    np.maximum.at(most, doc[first], times)
    columns = [
        np.log1p(c["n_words"]),
        np.log1p(c["word_chars"] / w),
        np.sqrt(c["n_symbols"] / w),
        np.sqrt(c["n_dup_lines"] / np.maximum(c["n_lines"], 1)),
        np.sqrt(c["n_repeat_words"] / w),
        np.log1p(w / np.maximum(c["n_lines"], 1)),
        kinds / w,
        np.sqrt(most / w),
        *[np.sqrt(per_text(s[found.data], found.offsets) / size) for s in _SETS.values()],
    ]
    return np.stack(columns, axis=1).astype(np.float64)


def vectors(docs: DataFrame) -> DataFrame:
    """doc_id and the features of every whole text."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.concatenate([_vectors(found) for found in words.scan(batch["text"])])
        return pa.RecordBatch.from_arrays([batch["doc_id"], *[pa.array(x[:, k]) for k in range(len(FEATURES))]], ["doc_id", *FEATURES])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs.select("doc_id", "text"), step, f"doc_id {kind}, " + ", ".join(f"{f} double" for f in FEATURES))


@dataclass(frozen=True)
class Model:
    """By class: log of the prior over the root of the determinant, mean, inverse Cholesky factor."""

    classes: tuple[tuple[float, np.ndarray, np.ndarray], ...]
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        log = [c - 0.5 * (((x - mean) @ inverse.T) ** 2).sum(axis=1) for c, mean, inverse in self.classes]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))


def train(found: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Model from the vectors of all labelled rows outside the held-out fold."""
    known = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 3) != 1))
        .groupBy("doc_id")
        .agg(F.min(label).alias("y"), F.max(label).alias("high"))
        .filter("y = high")
        .select("doc_id", "y")
    )
    pairs = [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]
    sums = [F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    sums += [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}_{j}") for i, j in pairs]
    rows = found.join(known, "doc_id").groupBy("y").agg(F.count("*").alias("n"), *sums).orderBy("y").collect()
    if len(rows) < 2:
        return Model((), float(rows[0]["y"]) if rows else 0.5)
    fitted, pooled, total = [], 0, sum(r["n"] for r in rows)
    for r in rows:
        n = r["n"]
        mean = np.array([r[f"s{i}"] for i in range(len(FEATURES))]) / n
        second = np.zeros((len(FEATURES),) * 2)
        for i, j in pairs:
            second[i, j] = second[j, i] = r[f"p{i}_{j}"] / n
        spread = second - np.outer(mean, mean)
        pooled = pooled + spread * n / total
        fitted.append((n, mean, spread))
    pooled = pooled + np.diag(np.full(len(FEATURES), 1e-6))
    classes = []
    for n, mean, spread in fitted:
        own = max(OWN, len(FEATURES) / (len(FEATURES) + n))
        shrunk = (1 - own - ROUND) * spread + own * pooled + ROUND * np.diag(np.diag(pooled))
        factor = np.linalg.cholesky(shrunk)
        classes.append((math.log(n / total) - float(np.log(np.diag(factor)).sum()), mean, np.linalg.inv(factor)))
    return Model(tuple(classes))


def score(found: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of vectors."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.stack([batch[f].to_numpy(zero_copy_only=False) for f in FEATURES], axis=1)
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.score(x))], ["doc_id", "score"])

    return per_batch(found, step, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, score double")


def op5_quality(spark, sf_dir: str) -> DataFrame:
    found = materialise(vectors(table(spark, sf_dir, "documents")), "vectors")
    scored = score(found, train(found, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
