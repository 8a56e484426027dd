"""Lattice scores against all segmentations, listed one by one."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from voltfleet.llm import lattice

SCHEMA = "doc_id long, text string, lang string, word string, n long, rid string, held_out int"
BLANKS = re.compile("[ \t-\r]+")


def tokens(text: str | None) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in BLANKS.split(lower) if w]


def held(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def segmentations(word: bytes, pieces: dict[bytes, float]):
    """Every way to cut the word, as a list of pieces."""
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        if word[:k] in pieces:
            for rest in segmentations(word[k:], pieces):
                yield [word[:k], *rest]


def plain(rows: list[tuple], start: lattice.Weights) -> dict:
    """(doc_id, text) -> every column, with counts, expectations and sums done the long way."""
    pieces, logs = start
    prior = np.exp(logs)
    prob = dict(zip(pieces, prior))
    learnt, ends = Counter(), 0
    for doc_id, text, *_ in rows:
        if not held(doc_id):
            learnt.update(tokens(text))
            ends += 1
    count = dict(zip(pieces, prior * lattice.PRIOR))
    for word, c in learnt.items():
        ways = [(w, math.prod(prob[p] for p in w)) for w in segmentations(b" " + word.encode(), prob)]
        total = sum(p for _, p in ways)
        for way, p in ways:
            for piece in way:
                count[piece] += c * p / total
    all_ = sum(count.values()) + prior[-1] * lattice.PRIOR + ends
    final = {p: c / all_ for p, c in count.items()}
    end = (prior[-1] * lattice.PRIOR + ends) / all_
    n, v = sum(learnt.values()) + ends, len(learnt) + (ends > 0)
    out = {}
    for doc_id, text, *_ in rows:
        found = tokens(text)
        base = sum(math.log10((learnt[w] + 1) / (n + v + 1)) for w in found) + math.log10((ends + 1) / (n + v + 1))
        marginal = [sum(math.prod(final[p] for p in w) for w in segmentations(b" " + t.encode(), final)) for t in found]
        score = sum(map(math.log10, marginal)) + math.log10(end)
        out[doc_id, text] = (held(doc_id), len(found) + 1, sum(learnt[w] > 0 for w in found) + (ends > 0), n, base, score)
    return out


def small(monkeypatch):
    """A vocabulary so small that every way can be listed."""
    bytes_ = [bytes([b]) for b in range(256)]
    pieces = bytes_ + [b" a", b" ab", b"ab", b"ba", b"bab", b" the", b"he", "é".encode(), b" \xc3"]
    weight = 1 / (np.arange(len(pieces) + 1) % 11 + lattice.SHIFT)
    start = pieces, np.log(weight / weight.sum())
    monkeypatch.setattr(lattice, "vocabulary", lambda path: start)
    return start


def rows_of() -> list[tuple]:
    random.seed(8)
    vocabulary = ["a", "ab", "aba", "the", "The", "THE", "bab", "é", "aé", "ÄB", "x y", "▁a", "\u0085"] + [f"b{i}" for i in range(40)]
    texts = [" ".join(random.choice(vocabulary) for _ in range(random.randint(1, 30))) for _ in range(40)]
    texts += [None, "", " \t\n\x0b\f\r ", "ab\x00ab \x1f", "a\tb\rc\x0bd"]
    rows = [(i, t, "en", "w", 1, "r", 0) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (3, "another text", "en", "w", 1, "r", 0), (None, "ab the", None, None, None, None, None)]


@pytest.mark.parametrize("held_rows,hot", [(300_000, 100_000), (7, 100_000), (7, 3), (300_000, 1)])
def test_scores_are_those_of_all_segmentations(spark, tmp_path, monkeypatch, held_rows, hot):
    monkeypatch.setattr(lattice, "HELD", held_rows)
    monkeypatch.setattr(lattice, "HOT", hot)
    start, rows = small(monkeypatch), rows_of()
    expected = plain(rows, start)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = lattice.op13_lattice(spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    want = Counter((d, *e[:4], round(e[4], 6), round(e[5], 2)) for (d, t, *_) in rows for e in [expected[d, t]])
    assert Counter((*r[:5], round(r[5], 6), round(r[6], 2)) for r in found) == want


def test_log_space_reaches_very_long_words(monkeypatch):
    found = lattice.Lattice(small(monkeypatch))
    log = found.log_probability(b"ab" * 30_000)
    assert math.isfinite(log) and log < -1000
    prob = {p: weight for p, (n, _, weight) in found.nodes.items() if n >= 0}
    ways = sum(math.prod(prob[p] for p in way) for way in segmentations(b" ab", prob))
    assert math.isclose(math.exp(found.log_probability(b"ab")), ways)
    used = found.expected(b"ab" * 50)
    pieces = {n: p for p, (n, *_) in found.nodes.items() if n >= 0}
    assert math.isclose(sum(len(pieces[n]) * k for n, k in used.items()), 101)  # the pieces cover the word
    plain_, logs = found.expected(b"abab\xc3"), found._expected_log(b" abab\xc3")
    assert plain_.keys() == logs.keys() and all(math.isclose(plain_[k], logs[k]) for k in logs)


def test_probabilities_share_one(monkeypatch):
    pieces, logs = lattice.vocabulary(lattice.vocabulary_path())
    assert len(logs) == len(pieces) + 1 and math.isclose(np.exp(logs).sum(), 1)
    assert all(b" " not in p[1:] for p in pieces) and {bytes([b]) for b in range(256)} <= set(pieces)


@pytest.mark.parametrize("rows", [[], [(9, None, "en", "w", 1, "r", 0)]])
def test_empty_tables(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = lattice.op13_lattice(spark, str(tmp_path)).collect()
    assert [r["n_tokens"] for r in found] == [1] * len(rows)


def test_scores_on_real_text_beat_a_shuffled_one(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    scored = {r["doc_id"]: r for r in lattice.op13_lattice(spark, "/root/testdata/sf0.001").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = lattice.Lattice(lattice.vocabulary(lattice.vocabulary_path()))
    better = 0
    rng = random.Random(1)
    out = [i for i, r in scored.items() if r["held_out"] and r["n_tokens"] > 20]
    for i in out:
        start = sum(model.log_probability(w) for w in lattice.words_of(texts[i].encode())) / lattice.LOG10
        better += scored[i]["score"] > start  # learning helps on rows that were not learnt from
    assert len(out) > 10 and better / len(out) > 0.95
    mixed = "".join(rng.sample(texts[out[0]], len(texts[out[0]])))
    own = lambda t: sum(model.log_probability(w) for w in lattice.words_of(t.encode())) / max(1, len(t))
    assert own(texts[out[0]]) > own(mixed)
