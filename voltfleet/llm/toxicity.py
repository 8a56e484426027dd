"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text. Both hold the same common
prose; the toxic one also holds the words that stand out in toxic text. Every text is
cut into overlapping windows, each window is compressed with either dictionary, and the
bytes that the toxic one saves over the ordinary one are the window's distance. A
logistic curve, calibrated on labelled texts that did not train the dictionaries, turns
the largest distances of a text into a score from 0 to 1.

Null and empty texts are one empty window and get the score of no saving at all. Without
labels of both classes nothing is known to be toxic: every score is 0. Repeated rows get
equal scores; other columns of the input are never read.

The training sample is bounded: ``PER_CLASS`` ids of each class, about ``TRAIN_CHARS``
characters of each, from four places of the text. Scoring reads whole texts.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .frames import fold, labelled_sample, per_batch, table, texts

WINDOW, STRIDE, LEVEL = 64, 48, 4
COMMON_BYTES, TOXIC_BYTES, FUNCTION_WORDS = 1 << 16, 1 << 13, 60
PER_CLASS, TRAIN_CHARS, MIN_GAIN = 2500, 20_000, 20.0
THRESHOLD = 0.7


def _windows(text: str) -> list[bytes]:
    data = text.lower().encode("utf-8", "replace")
    return [data[i : i + WINDOW] for i in range(0, max(1, len(data) - (WINDOW - STRIDE)), STRIDE)]


@lru_cache(maxsize=4)
def _compressor(content: bytes):
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        dict_data=held, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
    ).compress


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]

    def features(self, text: str) -> list[float]:
        a, b = _compressor(self.ordinary), _compressor(self.toxic)
        saved = sorted([len(a(w)) - len(b(w)) for w in _windows(text)], reverse=True)
        top = [max(0, x) for x in saved[:3]] + [0, 0]
        return [1.0, top[0], top[1], top[2], math.log(len(saved))]

    def score(self, text: str) -> float:
        z = sum(w * x for w, x in zip(self.weights, self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def _surroundings(group: list[str]) -> tuple[Counter, int]:
    """How many different neighbourhoods each word stands in, so copies do not count twice."""
    names: dict[int, bytes] = {}
    triples, total = [], 0
    for found in words.scan(pa.array([t.lower() for t in group], pa.string()), blank=False):
        h, zero = found.hash, np.zeros(1, np.uint64)
        same = found.doc[1:] == found.doc[:-1]
        before = np.concatenate([zero, np.where(same, h[:-1], 0)])
        after = np.concatenate([np.where(same, h[1:], 0), zero])
        if len(h):
            context = words.mix(words.mix(words.mix(before) + h) + after)
            triples.append(np.unique(np.stack([h, context]), axis=1))
            own, first = np.unique(h, return_index=True)
            raw = found.data.tobytes()
            for x, k in zip(own.tolist(), first.tolist(), strict=True):
                if x not in names:
                    names[x] = b" " + raw[found.start[k] : found.end[k]]
    if not triples:
        return Counter(), 0
    whole = np.unique(np.concatenate(triples, axis=1), axis=1)
    own, count = np.unique(whole[0], return_counts=True)
    return Counter({names[x]: c for x, c in zip(own.tolist(), count.tolist(), strict=True)}), whole.shape[1]


def _standing_out(toxic: list[str], ordinary: list[str]) -> bytes:
    """Words far more usual in toxic text, the most telling last (nearest for the coder)."""
    (a, n), (b, m) = _surroundings(toxic), _surroundings(ordinary)
    gain = {}
    for w, c in a.items():
        expected = (b[w] + 0.5) * n / max(m, 1)
        if len(w) > 4 and c > expected:
            g = c * math.log(c / expected) - (c - expected)
            if g >= min(MIN_GAIN, 0.004 * n):
                gain[w] = g
    best = sorted(gain, key=lambda w: (-gain[w], w))
    out: list[bytes] = []
    size = 0
    for w in best:
        if size + len(w) > TOXIC_BYTES:
            break
        out.append(w)
        size += len(w)
    return b"".join(reversed(out))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [1e-2] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (y - p) - ridge @ w
        )
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(sample: list[tuple[str, int]]) -> Model | None:
    """Dictionaries from two thirds of the sample, calibration from the rest."""
    if len({y for _, y in sample}) < 2:
        return None
    teach = [s for i, s in enumerate(sample) if i % 3] or sample
    check = sample[::3]
    toxic, ordinary = ([t for t, y in teach if y == k] for k in (1, 0))
    pieces = [w for t in ordinary for w in _windows(t)]
    order = np.random.default_rng(7).permutation(len(pieces))[:60_000]
    picked = [pieces[i] for i in order]
    try:
        common = zstandard.train_dictionary(COMMON_BYTES, picked, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few samples
        common = b"".join(picked)[-COMMON_BYTES:]
    usual, _ = _surroundings(ordinary)
    tail = b"".join(w for w, _ in reversed(sorted(usual.items(), key=lambda x: (-x[1], x[0]))[:FUNCTION_WORDS]))
    model = Model(common + _standing_out(toxic, ordinary) + tail, common + tail, ())
    if len({y for _, y in check}) < 2:
        check = sample
    x = np.array([model.features(t) for t, _ in check])
    weights = _logistic(x, np.array([y for _, y in check], float))
    return Model(model.toxic, model.ordinary, tuple(map(float, weights)))


def train_on(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Model from the labelled rows outside the held-out fold."""
    return train(labelled_sample(docs, labels, "toxic", fold(F.col("doc_id"), 3) != 1, PER_CLASS, TRAIN_CHARS))


def scores(column: pa.Array, model: Model | None) -> pa.Array:
    found = texts(column)
    return pa.array([model.score(t) if model else 0.0 for t in found], pa.float64())


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every text."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch["doc_id"], scores(batch["text"], model)], ["doc_id", "score"])

    return per_batch(docs.select("doc_id", "text"), step, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def drop_toxic(docs: DataFrame, model: Model | None) -> DataFrame:
    """Rows whose text scores below the threshold, with all their columns."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = [s < THRESHOLD for s in scores(batch["text"], model).to_pylist()]
        return batch.filter(pa.array(kept, pa.bool_()))

    return per_batch(docs, step, docs.schema)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = score(docs, train_on(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id",
        (fold(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
