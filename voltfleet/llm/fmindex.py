"""Benchmark decontamination with an FM-index of every training shard.

Words are runs of letters and digits in lower case (every non-ASCII character counts as a
letter). A phrase is ``PHRASE`` words in a row of a benchmark item; an item with fewer words
is one phrase. A shard is a run of whole texts of one Arrow batch. Its index holds the
suffix order of the shard's words, their Burrows-Wheeler transform as a wavelet tree, and
sampled suffix positions. All phrases are searched backwards at once; occurrences are
located from the samples, and their words merge into removal spans.

Words no phrase has cannot take part in an occurrence: they become separators, and runs of
other words shorter than the shortest phrase are left out of the index. That changes no
result. Nothing is shuffled; phrases travel to the tasks in blocks of about ``BLOCK_WORDS``
words, and tables pass through one block after the other.

Null, empty and wordless texts have no hits; items without words are no items. Items with
one id are one item; a null item id counts as the empty text. Repeated rows get equal
results, other columns pass through unread.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .frames import per_batch, table

PHRASE, BLOCK_WORDS = 10, 2_000_000
SHARD, SAMPLE = 2 << 20, 8


@dataclass
class Phrases:
    """Distinct phrases as numbers of words, and the items that hold them."""

    vocabulary: np.ndarray  # sorted hashes of words; number = place + 1
    symbols: np.ndarray  # one row per phrase, 0 behind its end
    lengths: np.ndarray
    holders: list[list[str]]  # item ids by phrase


def phrases(items: list[tuple[str, str]], size: int = PHRASE) -> Phrases:
    found: dict[tuple, set[str]] = {}
    column = pa.array([t for _, t in items], pa.string())
    for part in words.scan(column, blank=False):
        edge = part.bounds()
        for k in range(part.texts):
            h = part.hash[edge[k] : edge[k + 1]].tolist()
            for i in range(max(len(h) - size, 0) + 1 if h else 0):
                found.setdefault(tuple(h[i : i + size]), set()).add(items[part.first + k][0])
    order = sorted(found)
    vocabulary = np.unique(np.array([x for p in order for x in p], np.uint64))
    lengths = np.array([len(p) for p in order], np.int64)
    symbols = np.zeros((len(order), size), np.int64)
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        values = np.array([order[r] for r in rows], np.uint64)
        symbols[rows, :n] = np.searchsorted(vocabulary, values) + 1
    return Phrases(vocabulary, symbols, lengths, [sorted(found[p]) for p in order])


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Places of the suffixes of a text in order; zeros are separators that differ by place."""
    breaks = np.flatnonzero(text == 0)
    rank = text + len(breaks)
    rank[breaks] = np.arange(len(breaks))
    _, rank = np.unique(rank, return_inverse=True)
    n, step = len(text), 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - step, 0)] = rank[step:] + 1
        key = rank * np.int64(n + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.zeros(n, np.int64)
        new[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1]))
        if step >= n or new[order[-1]] == n - 1:
            return order
        rank, step = new, step * 2


class Wavelet:
    """Ranks of numbers in a sequence: one row of bits per binary digit, zeros moved ahead."""

    def __init__(self, values: np.ndarray, largest: int):
        self.digits = range(max(1, int(largest).bit_length()) - 1, -1, -1)
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for d in self.digits:
            bit = ((values >> d) & 1).astype(bool)
            self.ones.append(np.append(0, np.cumsum(bit)))
            self.zeros.append(int(len(values) - bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])

    def rank(self, value: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each value stands before each place."""
        begin = np.zeros(len(place), np.int64)
        for d, ones, zeros in zip(self.digits, self.ones, self.zeros, strict=True):
            bit = ((value >> d) & 1).astype(bool)
            before, start = ones[place], ones[begin]
            place = np.where(bit, zeros + before, place - before)
            begin = np.where(bit, zeros + start, begin - start)
        return place - begin


class Index:
    """FM-index of a sequence of numbers; zeros separate and are never searched."""

    def __init__(self, text: np.ndarray, largest: int):
        order = suffix_order(text)
        self.last = text[order - 1]
        self.last[order == 0] = 0
        counts = np.bincount(text, minlength=largest + 1)
        self.first = np.append(0, np.cumsum(counts))
        self.tree = Wavelet(self.last, largest)
        starts = np.append(True, text[:-1] == 0)
        sampled = (np.arange(len(text)) % SAMPLE == 0) | starts
        self.sampled = sampled[order]
        self.place = np.cumsum(self.sampled) - 1
        self.samples = order[self.sampled]

    def search(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row, and the row behind the last, of the suffixes that begin with each phrase."""
        low = np.zeros(len(symbols), np.int64)
        high = np.full(len(symbols), len(self.last), np.int64)
        for j in range(symbols.shape[1] - 1, -1, -1):
            live = np.flatnonzero((lengths > j) & (low < high))
            c = symbols[live, j]
            low[live] = self.first[c] + self.tree.rank(c, low[live])
            high[live] = self.first[c] + self.tree.rank(c, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of suffixes by row: step back until a sampled one is met."""
        rows, out, steps = rows.copy(), np.zeros(len(rows), np.int64), 0
        live = np.arange(len(rows))
        while len(live):
            at = rows[live]
            done = self.sampled[at]
            out[live[done]] = self.samples[self.place[at[done]]] + steps
            live, at, steps = live[~done], at[~done], steps + 1
            c = self.last[at]
            rows[live] = self.first[c] + self.tree.rank(c, at)
        return out


def _occurrences(found: words.Words, sought: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Phrase and first word of every occurrence in a shard."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(sought.lengths) or not len(found.hash):
        return none
    slots = np.zeros(1 << 20, bool)
    slots[sought.vocabulary >> np.uint64(44)] = True
    near = np.flatnonzero(slots[found.hash >> np.uint64(44)])
    number = np.searchsorted(sought.vocabulary, found.hash[near])
    number[number == len(sought.vocabulary)] = 0
    known = sought.vocabulary[number] == found.hash[near]
    at, number = near[known], number[known] + 1
    if not len(at):
        return none
    new = np.append(True, (at[1:] != at[:-1] + 1) | (found.doc[at[1:]] != found.doc[at[:-1]]))
    run = np.cumsum(new) - 1
    long = np.bincount(run)[run] >= sought.lengths.min()
    at, number, new = at[long], number[long], new[long]
    if not len(at):
        return none
    place = np.arange(len(at)) + np.cumsum(new) - 1  # a separator behind every run
    text = np.zeros(place[-1] + 2, np.int64)
    text[place] = number
    word = np.zeros(len(text), np.int64)
    word[place] = at
    index = Index(text, len(sought.vocabulary))
    low, high = index.search(sought.symbols, sought.lengths)
    count = high - low
    phrase = np.repeat(np.arange(len(count)), count)
    first = np.cumsum(count) - count
    rows = np.arange(len(phrase)) - first[phrase] + low[phrase]
    return phrase, word[index.locate(rows)]


def _hits(column: pa.Array, sought: Phrases):
    """For every shard: its words, which of them are hit, and (text, item) pairs."""
    for found in words.scan(column, blank=False, size=SHARD):
        phrase, first = _occurrences(found, sought)
        edge = np.zeros(len(found.hash) + 1, np.int64)
        np.add.at(edge, first, 1)
        np.add.at(edge, first + sought.lengths[phrase] if len(phrase) else first, -1)
        pairs = np.unique(np.stack([found.doc[first], phrase]), axis=1) if len(first) else np.zeros((2, 0), int)
        items: dict[int, set[str]] = {}
        for doc, p in pairs.T.tolist():
            items.setdefault(doc, set()).update(sought.holders[p])
        yield found, np.cumsum(edge[:-1]) > 0, items


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS):
    """The benchmark's phrases, block by block; a block is what one pass sends to the tasks."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text"
    ).filter("text IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // (4 * block_words)))
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield phrases([(r["item"], r["text"]) for r in part.collect()])


def _merge(column: pa.Array, sought: Phrases, hits: list, items: list):
    """Add a block's hit words and items to those of the blocks before it; yields each shard's words."""
    for found, hit, held in _hits(column, sought):
        edge = found.bounds()
        some = np.flatnonzero(hit)
        cut = np.searchsorted(some, edge)
        for k in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
            own = some[cut[k] : cut[k + 1]] - edge[k]
            row = found.first + k
            hits[row] = sorted({*(hits[row] or ()), *own.tolist()})
            items[row] = sorted({*(items[row] or ()), *held[k]})
        yield found, edge


def find(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, number of words, hit words (as numbers) and items of every text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").withColumns(
        {"n_words": F.lit(0).cast("long"), "hit": F.lit(None).cast("array<int>"), "items": F.lit(None).cast("array<string>")}
    )
    schema = f"doc_id {kind}, text string, n_words long, hit array<int>, items array<string>"
    for sought in blocks(benchmark, block_words):

        def step(batch: pa.RecordBatch, sought=sought) -> pa.RecordBatch:
            counts, hits, items = [], batch["hit"].to_pylist(), batch["items"].to_pylist()
            for _, edge in _merge(batch["text"], sought, hits, items):
                counts.extend(np.diff(edge).tolist())
            return pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text"], pa.array(counts, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                ["doc_id", "text", "n_words", "hit", "items"],
            )

        out = per_batch(out, step, schema)
    return out.drop("text")


def _without(data: bytes, start: np.ndarray, end: np.ndarray, hit: np.ndarray) -> bytes:
    """A text without its runs of hit words."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    kept, at = [], 0
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        kept.append(data[at : start[a]])
        at = end[b - 1]
    return b"".join([*kept, data[at:]])


def remove(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The table with hit spans cut out of its texts; untouched texts stay as they are.

    Every block is sought in the untouched text; the hit words of all blocks are cut out
    together, in the last pass. ``n_chars``, where the table has it, follows the text.
    """
    schema, name = docs.schema, "hit"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    out = docs.withColumn(name, F.lit(None).cast("array<int>"))
    wide, parts = out.schema, list(blocks(benchmark, block_words))
    for n, sought in enumerate(parts, 1):

        def step(batch: pa.RecordBatch, sought=sought, last=n == len(parts)) -> pa.RecordBatch:
            *columns, hits = batch.columns
            hits, changed = hits.to_pylist(), {}
            for found, edge in _merge(batch["text"], sought, hits, [None] * len(hits)):
                for k in range(found.texts) if last else ():
                    row, low = found.first + k, found.offsets[k]
                    if hits[row]:
                        a, b = edge[k], edge[k + 1]
                        hit = np.zeros(b - a, bool)
                        hit[hits[row]] = True
                        data = batch["text"][row].as_py().encode()
                        changed[row] = _without(data, found.start[a:b] - low, found.end[a:b] - low, hit).decode()
            fields = list(batch.schema)
            if last:
                return with_texts(pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields[:-1])), changed)
            return pa.RecordBatch.from_arrays([*columns, pa.array(hits, fields[-1].type)], schema=batch.schema)

        out = per_batch(out, step, schema if n == len(parts) else wide)
    return out


def with_texts(batch: pa.RecordBatch, changed: dict[int, str]) -> pa.RecordBatch:
    """The batch with some texts replaced, and n_chars, if there, made to fit."""
    if not changed:
        return batch
    found = batch["text"].to_pylist()
    for row, text in changed.items():
        found[row] = text
    place = batch.schema.get_field_index("text")
    batch = batch.set_column(place, batch.schema.field(place), pa.array(found, batch.schema.field(place).type))
    place = batch.schema.get_field_index("n_chars")
    if place >= 0 and pa.types.is_integer(batch.schema.field(place).type):
        sizes = batch["n_chars"].to_pylist()
        for row, text in changed.items():
            sizes[row] = len(text)
        batch = batch.set_column(place, batch.schema.field(place), pa.array(sizes, batch.schema.field(place).type))
    return batch


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.coalesce(F.size("hit"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", F.array().cast("array<string>")), ",").cast("binary"), 256).alias("items_sha256"),
        F.col("hit").isNotNull().alias("contaminated"),
    )
