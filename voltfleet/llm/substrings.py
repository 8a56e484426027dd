"""Removal of passages that stand earlier in the corpus, by suffix automata.

Words are runs of non-blank characters. A window is ``WINDOW`` words in a row. A word goes
if a window that covers it also starts earlier: in a document with a smaller doc_id, or
further ahead in the same one.

A corpus is its own reference here, and automata of all of it can neither be broadcast nor
be streamed past every document. So reference shards are laid out by content:

1. Every window is assigned to its anchor, the group of ``GRAM`` words in it with the
   smallest hash. Equal windows have equal anchors. Anchors that stand in one place only
   are dropped; a bitmap of fixed size (``FILTER_BITS``) spares most of them the shuffle.
2. The windows of one anchor occurrence make a fragment of at most 2 * WINDOW - GRAM words.
   Fragments go to the shard of their anchor, equal ones of one batch only once.
3. A shard takes each anchor's fragments in document order. It streams a fragment through
   the suffix automaton of the ones before; where the matching statistic reaches WINDOW,
   the window stood earlier. Then the fragment extends the automaton.
4. Removal spans go back to their documents.

An anchor with more than ``HOT`` occurrences would make a large shard: its fragments are cut
into single windows, and these are spread by the hash of the whole window. Equal texts are
one text: all copies but the first lose every word, if they have a window at all.

Null counts as the empty text. A null doc_id counts as the largest. Rows with equal doc_id
and text are one document and get equal results; rows with equal doc_id and different texts
are ordered by a hash of the text. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ship import ship
from ..sources.workspace import materialise
from . import words
from .frames import per_batch, table
from .rules import repeated

WINDOW, GRAM, HOT = 20, 4, 2000
FILTER_BITS = 1 << 26
NO_ID = 2**63 - 1


def anchors(found: words.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, anchor hash, first window and number of windows of every anchor occurrence."""
    none = np.zeros(0, np.int64)
    n, m = len(found.doc), len(found.doc) - WINDOW + 1
    if m < 1:
        return none, none, none, none
    total = np.zeros(n - GRAM + 1, np.uint64)
    for j in range(GRAM):
        total += found.hash[j : j + len(total)] * words._WINDOW[j]
    gram = words.mix(total)
    best, place = gram[:m].copy(), np.arange(m)
    for j in range(1, WINDOW - GRAM + 1):
        lower = gram[j : j + m] < best
        np.copyto(best, gram[j : j + m], where=lower)
        place = np.where(lower, np.arange(j, j + m), place)
    at = np.flatnonzero(found.doc[:m] == found.doc[WINDOW - 1 :])
    if not len(at):
        return none, none, none, none
    own = place[at]
    new = np.append(True, (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1))
    first = np.flatnonzero(new)
    doc = found.doc[at[first]]
    start = at[first] - found.bounds()[doc]
    return doc, gram[own[first]].view(np.int64), start, np.diff(np.append(first, len(at)))


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), F.xxhash64(text).alias("th"), text.alias("text")
    )


_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())


def _lists(values: np.ndarray, doc: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    edges = np.searchsorted(doc, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values, kind))


def anchor_table(docs: DataFrame) -> DataFrame:
    """key, text hash, number of words, and anchors of every row."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, parts = [], []
        for found in words.scan(batch["text"]):
            doc, h, start, size = anchors(found)
            later = repeated(doc, h, True).astype(np.int32)
            counts.append(np.bincount(found.doc, minlength=found.texts))
            parts.append((doc + found.first, h, start, size, later))
        doc, h, start, size, later = (np.concatenate(x) for x in zip(*parts, strict=True))
        n = batch.num_rows
        lists = [_lists(x, doc, n, t) for x, t in ((h, pa.int64()), (start, pa.int32()), (size, pa.int32()), (later, pa.int32()))]
        return pa.RecordBatch.from_arrays(
            [batch["key"], batch["th"], pa.array(np.concatenate(counts).astype(np.int64)), *lists],
            ["key", "th", "n_words", "anchor", "start", "size", "later"],
        )

    return per_batch(
        keyed(docs), step, "key long, th long, n_words long, anchor array<long>, start array<int>, size array<int>, later array<int>"
    )


def _bit(anchor):
    return F.pmod(anchor, F.lit(FILTER_BITS))


def _bitmap(repeats: DataFrame) -> np.ndarray:
    """One bit for each repeated anchor: FILTER_BITS / 64 rows at most reach the driver."""
    bit = _bit(F.col("anchor"))
    one = F.expr(f"shiftleft(1L, cast(pmod(pmod(anchor, {FILTER_BITS}), 64) as int))")
    rows = repeats.groupBy(F.floor(bit / 64).alias("cell")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[rows["cell"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def _repeated_occurrences(found: DataFrame, repeats: DataFrame) -> DataFrame:
    """key, th, anchor, start and size of the occurrences that the bitmap lets through."""
    shared = found.sparkSession.sparkContext.broadcast(_bitmap(repeats))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        held = batch["anchor"]
        h = held.flatten().to_numpy()
        row = np.repeat(np.arange(batch.num_rows), held.value_lengths().fill_null(0).to_numpy())
        at = h.view(np.uint64) % np.uint64(FILTER_BITS)
        hit = (shared.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0
        if not hit.any():
            return None
        take = pa.array(row[hit])
        pick = pa.array(hit)
        return pa.RecordBatch.from_arrays(
            [batch["key"].take(take), batch["th"].take(take), pa.array(h[hit]), batch["start"].flatten().filter(pick), batch["size"].flatten().filter(pick)],
            ["key", "th", "anchor", "start", "size"],
        )

    return per_batch(
        found.select("key", "th", "anchor", "start", "size"), step, "key long, th long, anchor long, start int, size int"
    )


def _route(window: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little", signed=True)


_FRAGMENT = "route long, key long, th long, start int, size int, words binary"


def _fragments(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """Fragments of the texts' repeated anchors. A fragment that the batch holds earlier travels without its words: it goes as a whole."""
    rows = []
    for key, th, text, held in zip(*(batch[c].to_pylist() for c in ("key", "th", "text", "held")), strict=True):
        cut = text.encode().split()
        for x in held:
            start, size = x["start"], x["size"]
            if not x["hot"]:
                rows.append((key, th, start, x["anchor"], size, b" ".join(cut[start : start + size + WINDOW - 1])))
                continue
            for k in range(start, start + size):
                window = b" ".join(cut[k : k + WINDOW])
                rows.append((key, th, k, _route(window), 1, window))
    rows.sort()
    seen, out = {}, []
    for n, (key, th, start, route, size, window) in enumerate(rows):
        first = seen.setdefault((route, window), n)
        if first == n:
            out.append((route, key, th, start, size, window))
        elif rows[first][:3] != (key, th, start):  # else a repeated row
            out.append((th, key, th, start, size, None))
    if not out:
        return None
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["route", "key", "th", "start", "size", "words"]
    )


class Automaton:
    """Suffix automaton of word sequences, one behind the other with separators between them."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.last = [-1], [0], 0

    def _extend(self, word) -> None:
        following, link, length = self.next, self.link, self.length
        now, p = len(following), self.last
        following.append({})
        link.append(0)
        length.append(length[p] + 1)
        while p >= 0 and word not in following[p]:
            following[p][word] = now
            p = link[p]
        if p >= 0:
            q = following[p][word]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                clone = len(following)
                following.append(dict(following[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and following[p].get(word) == q:
                    following[p][word] = clone
                    p = link[p]
                link[q] = link[now] = clone
        self.last = now

    def add(self, sequence: list[bytes]) -> None:
        self._extend(len(self.next))  # a number no word equals
        for word in sequence:
            self._extend(word)

    def statistics(self, sequence: list[bytes]) -> Iterator[int]:
        """Length of the longest match that ends at each word."""
        following, link, length = self.next, self.link, self.length
        state, size = 0, 0
        for word in sequence:
            while state and word not in following[state]:
                state = link[state]
                size = length[state]
            if word in following[state]:
                state = following[state][word]
                size += 1
            yield size


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removal spans of a partition of fragments, sorted by route and document order."""
    current, seen, waiting, automaton = None, {}, [], None
    for batch in batches:
        out = []
        for route, key, th, start, size, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held is None:
                out.append((key, th, start, size))
                continue
            if route != current:
                current, seen, waiting, automaton = route, {}, [], None
            if held in seen:
                if seen[held] != (key, th, start):  # else a repeated row
                    out.append((key, th, start, size))
                continue
            seen[held] = (key, th, start)
            sequence = held.split(b" ")
            if len(seen) > 1:
                if automaton is None:
                    automaton = Automaton()
                for one in waiting:
                    automaton.add(one)
                waiting = []
                for k, match in enumerate(automaton.statistics(sequence)):
                    if match >= WINDOW:
                        out.append((key, th, start + k - WINDOW + 1, 1))
            waiting.append(sequence)
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["key", "th", "start", "size"]
            )


def removals(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts to change, as key, th, whether all goes, and spans of removed windows."""
    found = materialise(anchor_table(docs), "anchors")
    each = found.select("th", F.explode(F.arrays_zip("anchor", "later")).alias("x")).select(
        F.col("x.anchor").alias("anchor"), F.when(F.col("x.later") == 0, F.col("th")).otherwise(F.col("th").bitwiseXOR(F.lit(1).cast("long"))).alias("mark")
    )
    repeats = (
        each.groupBy("anchor")
        .agg(F.min("mark").alias("low"), F.max("mark").alias("high"), F.count("*").alias("n"))
        .filter("low <> high")
        .select("anchor", (F.col("n") > HOT).alias("hot"))
    )
    repeats = materialise(repeats, "repeats")
    texts = found.groupBy("th").agg(F.min("key").alias("first"))
    firsts = materialise(texts, "firsts")
    held = (
        _repeated_occurrences(found, repeats)
        .join(firsts.select("th", F.col("first").alias("key")), ["th", "key"])
        .join(repeats, "anchor")
        .groupBy("key", "th")
        .agg(F.collect_set(F.struct("start", "size", "anchor", "hot")).alias("held"))
    )
    cut = per_batch(keyed(docs).join(held, ["key", "th"]), _fragments, _FRAGMENT)
    ship(docs.sparkSession)
    spans = (
        cut.repartition("route")
        .sortWithinPartitions("route", "key", "th", "start")
        .mapInArrow(_shard, "key long, th long, start int, size int")
        .groupBy("key", "th")
        .agg(F.collect_set(F.struct("start", "size")).alias("spans"))
    )
    copies = (
        found.filter(F.col("n_words") >= WINDOW)
        .select("key", "th")
        .distinct()
        .join(firsts, "th")
        .filter("key <> first")
        .select("key", "th", F.lit(None).cast("array<struct<start:int,size:int>>").alias("spans"))
    )
    return spans.withColumn("whole", F.lit(False)).unionByName(copies.withColumn("whole", F.lit(True)))


def _kept(cut: list[bytes], whole: bool, spans: list | None) -> list[bytes]:
    if whole:
        return []
    if not spans:
        return cut
    edge = np.zeros(len(cut) + 1, np.int64)
    for s in spans:
        edge[s["start"]] += 1
        edge[s["start"] + s["size"] + WINDOW - 1] -= 1
    return list(compress(cut, (np.cumsum(edge[:-1]) == 0).tolist()))


def remove(docs: DataFrame) -> DataFrame:
    """doc_id, number of words, number of removed words, and kept words joined by one space."""
    return _removed(docs, False)


def _removed(docs: DataFrame, digests: bool) -> DataFrame:
    joined = keyed(docs).join(removals(docs), ["key", "th"], "left").select("key", "text", "whole", "spans")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        total, gone, out = [], [], []
        for text, whole, spans in zip(*(batch[c].to_pylist() for c in ("text", "whole", "spans")), strict=True):
            cut = text.encode().split()
            kept = _kept(cut, bool(whole), spans)
            total.append(len(cut))
            gone.append(len(cut) - len(kept))
            line = b" ".join(kept)
            out.append(hashlib.sha256(line).hexdigest() if digests else line.decode())
        return pa.RecordBatch.from_arrays(
            [batch["key"], pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(out, pa.string())],
            ["key", "n_words", "n_removed", "kept"],
        )

    done = per_batch(joined, step, "key long, n_words long, n_removed long, kept string")
    doc_id = F.when(F.col("key") != NO_ID, F.col("key"))
    return done.select(doc_id.alias("doc_id"), "n_words", "n_removed", F.col("kept").alias("kept_sha256" if digests else "text"))


def op4_substrings(spark, sf_dir: str) -> DataFrame:
    return _removed(table(spark, sf_dir, "documents"), True)


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
x AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
s AS (SELECT doc_id, i, word, CASE WHEN count(*) OVER f = 20 THEN md5(string_agg(word, ' ') OVER f) END AS win
  FROM x WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
r AS (SELECT doc_id, i, word, win IS NOT NULL AND row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1 AS again FROM s),
c AS (SELECT doc_id, i, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS 19 PRECEDING) AS gone FROM r),
k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept FROM c GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""
