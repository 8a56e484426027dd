"""Language of whole texts: known words first, character n-grams for the others.

A known word scores by its log frequency in each language. An unseen word backs off: its
character 4-grams score if any is known, else its 3-grams, and so on down to single
characters. A text's language is the one with the largest sum over its words; the score is
that language's posterior share, tempered by the number of words.

Words are runs of ASCII letters and digits and of non-ASCII characters, in lower ASCII case.
Null texts and texts without a letter are ``und`` with score 0; so is every text if no
training row has a language. Repeated rows get equal results; other columns are not read.

Training is bounded: ``PER_LANGUAGE`` ids of each language (those with the smallest hash, each
with its least text), ``TRAIN_CHARS`` characters from all over each, and of each language
``MOST_WORDS`` words and as many n-grams of each length. Only ids are ranked for it, in two steps, so a usual language is no single task's
work. Prediction reads whole texts.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words
from .frames import cut, fold, per_batch, table, texts

PER_LANGUAGE, TRAIN_CHARS, MOST_WORDS, LONGEST, PARTS = 1500, 5000, 50_000, 4, 256
_LETTER = re.compile(r"[^\W\d_]")


def _grams(word: bytes, n: int) -> list[str]:
    text = f"^{word.decode('utf-8', 'replace')}$"
    return [text[i : i + n] for i in range(max(1, len(text) - n + 1))]


def _logs(counts: list[Counter], most: int, least: int) -> dict:
    """Log frequency by language of the most frequent entries of each language."""
    total = Counter()
    for c in counts:
        total.update(c)
    kept = set()
    for c in counts:
        kept.update(heapq.nsmallest(most, (k for k in c if total[k] >= least), key=lambda k: (-c[k], k)))
    kept = sorted(kept)
    sizes = [sum(c.values()) + 0.1 * (len(kept) + 1) for c in counts]
    return {k: [math.log((c[k] + 0.1) / s) for c, s in zip(counts, sizes, strict=True)] for k in kept}


@dataclass
class Model:
    languages: list[str]
    hashes: np.ndarray  # of known words, sorted
    logs: np.ndarray  # a row for each known word
    grams: list[dict[str, list[float]]]  # by length, from 1

    def unseen(self, word: bytes) -> list[float]:
        for n in range(LONGEST, 0, -1):
            found = [g for x in _grams(word, n) if (g := self.grams[n - 1].get(x))]
            if found:
                return [sum(x) / len(found) for x in zip(*found, strict=True)]
        return [0.0] * len(self.languages)


def train(sample: list[tuple[str, str]]) -> Model | None:
    """Model from (text, language) pairs."""
    languages = sorted({lang for _, lang in sample})
    if not languages:
        return None
    place = {lang: k for k, lang in enumerate(languages)}
    seen = [Counter() for _ in languages]
    sample = sorted(sample)
    for found in words.scan(pa.array([t for t, _ in sample], pa.string()), blank=False):
        data, edge = found.data.tobytes(), found.bounds()
        own = [data[a:b] for a, b in zip(found.start.tolist(), found.end.tolist(), strict=True)]
        for k in range(found.texts):
            seen[place[sample[found.first + k][1]]].update(own[edge[k] : edge[k + 1]])
    known = _logs(seen, MOST_WORDS, 2)
    order = list(known)
    grams = []
    for n in range(1, LONGEST + 1):
        counts = [Counter() for _ in languages]
        for c, own in zip(counts, seen, strict=True):
            for word, times in own.items():
                for g in _grams(word, n):
                    c[g] += times
        grams.append(_logs(counts, MOST_WORDS, 1))
    data = np.frombuffer(b"".join(order), np.uint8)
    end = np.cumsum([len(w) for w in order], dtype=np.int64) if order else np.zeros(0, np.int64)
    start = np.append(0, end[:-1]) if order else end
    hashes = words.run_hashes(data, start, end)
    rank = np.argsort(hashes)
    logs = np.array([known[w] for w in order]).reshape(len(order), len(languages))
    return Model(languages, hashes[rank], logs[rank], grams)


def train_on(docs: DataFrame) -> Model | None:
    """Model from a bounded sample of the rows outside the held-out fold."""
    known = docs.filter((fold(F.col("doc_id"), 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = known.select("doc_id", "lang").distinct().withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(PARTS)))
    for by in (["lang", "part"], ["lang"]):  # a usual language is cut down in parts first
        first = Window.partitionBy(*by).orderBy(*order)
        ids = ids.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= PER_LANGUAGE).drop("n")
    rows = (
        known.join(F.broadcast(ids.drop("part")), ["doc_id", "lang"])  # PER_LANGUAGE ids a language
        .groupBy("doc_id", "lang")
        .agg(F.min(cut(F.col("text"), TRAIN_CHARS)).alias("text"))
        .collect()
    )
    return train([(r["text"], r["lang"]) for r in rows])


def predictions(column: pa.Array, model: Model | None, cache: dict[bytes, list[float]]) -> tuple[list[str], list[float]]:
    """Language and score of every text."""
    lang, score = [], []
    lettered = [any(m.group().isalpha() for m in _LETTER.finditer(t)) for t in texts(column)]
    if model is None:
        return ["und"] * len(lettered), [0.0] * len(lettered)
    for found in words.scan(column, blank=False):
        logs = np.zeros((len(found.hash), len(model.languages)))
        at = np.searchsorted(model.hashes, found.hash)
        at[at == len(model.hashes)] = 0
        hit = model.hashes[at] == found.hash if len(model.hashes) else np.zeros(len(at), bool)
        logs[hit] = model.logs[at[hit]]
        missing = np.flatnonzero(~hit)
        if len(missing):
            _, first, inverse = np.unique(found.hash[missing], return_index=True, return_inverse=True)
            rows = []
            for m in missing[first].tolist():
                word = found.data[found.start[m] : found.end[m]].tobytes()
                row = cache.get(word)
                if row is None:
                    row = model.unseen(word)
                    if len(cache) < 300_000 and len(word) < 64:
                        cache[word] = row
                rows.append(row)
            logs[missing] = np.array(rows)[inverse]
        sums = np.stack([np.bincount(found.doc, logs[:, k], found.texts) for k in range(len(model.languages))], axis=1)
        n = np.maximum(np.bincount(found.doc, minlength=found.texts), 1)
        tempered = sums / np.sqrt(n)[:, None]
        share = np.exp(tempered - tempered.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        best = sums.argmax(axis=1)
        for k in range(found.texts):
            known = lettered[found.first + k]
            lang.append(model.languages[best[k]] if known else "und")
            score.append(float(share[k, best[k]]) if known else 0.0)
    return lang, score


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score of every whole text."""
    cache: dict[bytes, list[float]] = {}

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = predictions(batch["text"], model, cache)
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs.select("doc_id", "text"), step, f"doc_id {kind}, lang_pred string, score double")


def op10_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = predict(docs, train_on(docs))
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")
