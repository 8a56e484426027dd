"""Byte-level BPE: ids of whole texts by a table of ranked merges, and back.

Texts are cut by the GPT-2 pattern (``pieces``). Every distinct word is encoded once, by
Spark's higher-order functions: its bytes are an array of ids, and ``aggregate`` folds the
merges over it, each time joining the pair of lowest rank, which a literal map holds. Words
that are one token already take its id. The encoded words, up to ``TABLE`` of them and the
most frequent first, are sent to the tasks as flat arrays; that is the proven bound of the
broadcast. A task looks its texts' words up there and concatenates ids. Decoding
concatenates the binary pieces of the ids.

Two kinds of words are merged inside the task instead, by the same ranks: those beyond the
table, and those of more than ``LONG`` bytes, for which a fold would take quadratic time.
Results are the same either way.

Null counts as the empty text, which has no ids. Repeated rows get equal results. Other
columns are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import json
import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import materialise
from . import words
from .frames import give_back, per_batch, table

TABLE, LONG, SLOTS = 500_000, 128, 1 << 18
NEVER = 2**31 - 1
_LETTER, _NUMBER, _SPACE, _REST = 1, 2, 3, 4


@functools.cache
def _classes() -> np.ndarray:
    """Letter, number, white space or other, of every code point."""
    kind = {"L": _LETTER, "N": _NUMBER}
    out = np.array([kind.get(unicodedata.category(chr(c))[0], _REST) for c in range(sys.maxunicode + 1)], np.uint8)
    # The characters with Unicode's White_Space property.
    out[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _SPACE
    return out


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in bytes, of the pattern's matches in UTF-8 texts laid end to end.

    's|'t|'re|'ve|'m|'ll|'d| ?letters| ?numbers| ?others|spaces before a space or the end|spaces
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)  # bytes that begin a character
    code = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    kind = _classes()[code]
    n = len(code)
    text_start = np.zeros(n + 1, bool)
    text_start[np.searchsorted(at, offsets)] = True
    text_start[n] = True
    new = text_start[:n].copy()
    new[0] = True
    new[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(new)
    end = np.append(run[1:], n)
    is_space = kind[run] == _SPACE
    # The last white space before other characters stands alone, or leads them if it is a blank.
    followed = np.zeros(len(run), bool)
    followed[:-1] = ~text_start[run[1:]]
    alone = np.flatnonzero(is_space & followed)
    last = end[alone] - 1
    leads = code[last] == 0x20
    new[last] = True
    new[end[alone[leads]]] = False
    # A lone apostrophe takes a known ending from the letters behind it.
    mark = np.flatnonzero((code[run] == 0x27) & (end - run == 1) & followed & new[run])
    for ending in ("s", "t", "m", "d", "re", "ve", "ll"):
        size = len(ending)
        p = run[mark]
        fits = np.ones(len(p), bool)
        for k, c in enumerate(ending, 1):
            q = p + k
            inside = q < n
            inside[inside] = ~text_start[q[inside]]
            fits &= inside
            fits[fits] = code[q[fits]] == ord(c)
        hit = p[fits]
        new[hit + 1] = False
        behind = hit + 1 + size
        behind = behind[behind < n]
        new[behind] = True
        mark = mark[~fits]
    start = at[np.flatnonzero(new)]
    return start, np.append(start[1:], len(data))


@dataclass(frozen=True)
class Ranks:
    """Tokens by id, and the id that each pair of ids merges to."""

    tokens: tuple[bytes, ...]

    @classmethod
    def read(cls, path: str) -> Ranks:
        with open(path, "rb") as f:
            found = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in f if line.strip())}
        return cls(tuple(found[k] for k in range(len(found))))

    @functools.cached_property
    def ids(self) -> dict[bytes, int]:
        return {t: k for k, t in enumerate(self.tokens)}

    @functools.cached_property
    def pairs(self) -> dict[tuple[int, int], int]:
        ids = self.ids
        return {
            (ids[t[:i]], ids[t[i:]]): k
            for k, t in enumerate(self.tokens)
            for i in range(1, len(t))
            if t[:i] in ids and t[i:] in ids
        }

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: always join the leftmost pair of lowest rank; a heap holds the pairs."""
        if word in self.ids:
            return [self.ids[word]]
        ids = [self.ids[word[i : i + 1]] for i in range(len(word))]
        after, before = [*range(1, len(ids)), -1], list(range(-1, len(ids) - 1))
        pairs = self.pairs
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (r := pairs.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for p, q in ((before[i], i), (i, after[i])):
                if p >= 0 and q >= 0 and (r := pairs.get((ids[p], ids[q]))) is not None:
                    heapq.heappush(heap, (r, p, ids[p], ids[q]))
        return [k for k in ids if k >= 0]


def _place(key, second: bool):
    """The two places in the literal where a pair's rank may lie; works for numbers and columns."""
    if second:
        return (key % 65_521 * 39_119 + key % 50_021 * 7_919) % 262_133
    return (key % 65_537 * 31_337 + key % 49_999) % 262_139


def _literal(ranks: Ranks) -> Column:
    """The merges as a literal map of pairs to ranks, laid out flat: a cuckoo table.

    An entry is the pair (first id, second id) and its rank in one number, 16 bits each.
    """
    slots = [-1] * SLOTS
    for (a, b), rank in ranks.pairs.items():
        entry, second = (a << 32) + (b << 16) + rank, False
        for _ in range(500):
            at = _place(entry >> 16, second)
            entry, slots[at] = slots[at], entry
            if entry < 0:
                break
            second = _place(entry >> 16, False) == at
        else:
            raise ValueError("the merges do not fit the literal table")
    return F.from_json(F.lit(json.dumps(slots, separators=(",", ":"))), "array<bigint>")


def _fold(word: Column, ranks: Ranks) -> Column:
    """Ids of a binary word by folding merges over its bytes."""
    merges = _literal(ranks)
    single = F.lit([ranks.ids[bytes([b])] for b in range(256)])
    text = F.decode(word, "ISO-8859-1")  # one character per byte

    def ranked(keys: Column) -> Column:
        """Ranks of pairs."""

        def look(key: Column) -> Column:
            places = F.array(*[(_place(key, second) + 1).cast("int") for second in (False, True)])
            entries = F.transform(places, lambda at: F.element_at(merges, at))
            own = F.filter(entries, lambda e: F.shiftright(e, 16) == key)
            return F.coalesce(F.array_max(F.transform(own, lambda e: e.bitwiseAND(65535).cast("int"))), F.lit(NEVER))

        return F.transform(keys, look)

    def key(a: Column, b: Column) -> Column:
        return a.cast("long") * 65536 + b

    size = F.length(word)
    ids = F.transform(
        F.sequence(F.lit(1), size), lambda i: F.element_at(single, F.ascii(F.substring(text, i, F.lit(1))) + 1)
    )
    # t: ids so far; r: ranks of neighbours, set by the first step.
    begin = F.struct(ids.alias("t"), F.lit(None).cast("array<int>").alias("r"))

    def step(s: Column, i: Column) -> Column:
        t, r, low, n = s["t"], s["r"], F.array_min(s["r"]), F.size(s["t"])
        done = F.coalesce(low, F.lit(NEVER)) == NEVER
        p = F.array_position(r, low).cast("int")
        left = F.when(p > 1, key(F.element_at(t, F.greatest(p - 1, F.lit(1))), low)).otherwise(-1)
        right = F.when(p + 2 <= n, key(low, F.element_at(t, F.least(p + 2, n)))).otherwise(-1)
        keys = (
            F.when(i == 0, F.transform(F.slice(t, 1, n - 1), lambda a, j: key(a, F.element_at(t, j + 2))))
            .when(done, F.array().cast("array<bigint>"))
            .otherwise(F.filter(F.array(left, right), lambda k: k >= 0))
        )

        def after(fresh: Column) -> Column:
            joined = F.struct(
                F.concat(F.slice(t, 1, p - 1), F.array(low), F.slice(t, p + 2, n)).alias("t"),
                F.concat(F.slice(r, 1, F.greatest(p - 2, F.lit(0))), fresh, F.slice(r, p + 2, n)).alias("r"),
            )
            return F.when(i == 0, F.struct(t.alias("t"), fresh.alias("r"))).when(done, s).otherwise(joined)

        # Ranks are looked up in one place, so that the plan holds the literal once.
        return F.element_at(F.transform(F.array(ranked(keys)), after), 1)

    return F.aggregate(F.sequence(F.lit(0), size - 1), begin, step, lambda s: s["t"])


def distinct_words(docs: DataFrame) -> DataFrame:
    """word and count of all pieces of the texts; counted within every batch first."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found: list[pa.Table] = []
        for _, data, offsets in words.chunks(batch["text"]):
            start, end = pieces(data, offsets)
            h = words.run_hashes(data, start, end)
            _, first, count = np.unique(h, return_index=True, return_counts=True)
            raw = data.tobytes()
            found.append(pa.table({"word": pa.array([raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)], pa.binary()), "count": pa.array(count, pa.int64())}))
        whole = pa.concat_tables(found).group_by("word").aggregate([("count", "sum")])
        whole = whole.select(["word", "count_sum"]).rename_columns(["word", "count"]).combine_chunks()
        return whole.to_batches()[0] if whole.num_rows else None

    pairs = per_batch(docs.select("text"), step, "word binary, count long")
    return pairs.groupBy("word").agg(F.sum("count").alias("count"))


def encode_words(found: DataFrame, ranks: Ranks) -> DataFrame:
    """word and ids of the words of up to ``LONG`` bytes, by the fold over their bytes."""
    spark = found.sparkSession
    known = spark.createDataFrame(
        pa.table({"word": pa.array(ranks.tokens, pa.binary()), "id": pa.array(range(len(ranks.tokens)), pa.int32())})
    )
    return (
        found.filter(F.length("word").between(1, LONG))
        .join(F.broadcast(known), "word", "left")  # as many rows as the vocabulary has tokens
        .select(
            "word",
            F.when(F.col("id").isNotNull(), F.array("id")).otherwise(_fold(F.col("word"), ranks)).alias("ids"),
        )
    )


@dataclass
class Table:
    """Encoded words as flat arrays: sorted hashes, and where each one's ids lie."""

    hashes: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    ids: np.ndarray


def word_table(docs: DataFrame, ranks: Ranks, most: int = TABLE) -> Table:
    """The most frequent distinct words, at most ``most``, encoded."""
    found = materialise(distinct_words(docs), "words")
    # Counts by quarters of a power of two: a table of some hundred rows.
    step = F.floor(F.log2("count") * 4).alias("step")
    steps = found.groupBy(step).count().orderBy(F.desc("step")).collect()
    total, least = 0, None
    for s in steps:
        total += s["count"]
        if total > most:
            break
        least = s["step"]
    chosen = found.filter(F.floor(F.log2("count") * 4) >= (NEVER if least is None else least))
    spread = chosen.repartition(max(1, min(200, total // 5000)), "word")
    got = encode_words(spread, ranks).toArrow()
    data, offsets = words.flat(got["word"])
    start, end = offsets[:-1], offsets[1:]
    hashes = words.run_hashes(data, start, end)
    lists = got["ids"].combine_chunks()
    ids = lists.values.to_numpy(zero_copy_only=False).astype(np.int32) if len(lists) else np.zeros(0, np.int32)
    edges = lists.offsets.to_numpy().astype(np.int64) if len(lists) else np.zeros(1, np.int64)
    del got, data, lists
    order = np.argsort(hashes)
    return Table(hashes[order], edges[:-1][order], np.diff(edges)[order], ids)


def _gather(begin: np.ndarray, size: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The stretches of values, one behind the other."""
    first = np.cumsum(size) - size
    return values[np.arange(int(size.sum())) - np.repeat(first - begin, size)]


def encode_batch(column: pa.Array, ranks: Ranks, known: Table, cache: dict[bytes, list[int]]):
    """Ids of every text, as one array and its offsets, chunk by chunk."""
    for _, data, offsets in words.chunks(column):
        start, end = pieces(data, offsets)
        h = words.run_hashes(data, start, end)
        place = np.searchsorted(known.hashes, h)
        place[place == len(known.hashes)] = 0
        hit = known.hashes[place] == h if len(known.hashes) else np.zeros(len(h), bool)
        begin, size = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        begin[hit], size[hit] = known.begin[place[hit]], known.size[place[hit]]
        extra: list[int] = []
        missing = np.flatnonzero(~hit)
        if len(missing):
            _, first, inverse = np.unique(h[missing], return_index=True, return_inverse=True)
            own_begin, own_size = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
            for n, m in enumerate(missing[first].tolist()):
                word = data[start[m] : end[m]].tobytes()
                ids = cache.get(word)
                if ids is None:
                    ids = ranks.merge(word)
                    if len(cache) < 50_000 and len(word) <= LONG:
                        cache[word] = ids
                own_begin[n], own_size[n] = len(known.ids) + len(extra), len(ids)
                extra += ids
            begin[missing], size[missing] = own_begin[inverse], own_size[inverse]
        pool = np.concatenate([known.ids, np.array(extra, np.int32)]) if extra else known.ids
        ids = _gather(begin, size, pool)
        edge = np.append(0, np.cumsum(size))
        yield ids, edge[np.searchsorted(start, offsets)]


def _token_bytes(ranks: Ranks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(ranks.tokens), np.uint8)
    size = np.array([len(t) for t in ranks.tokens], np.int64)
    return data, np.cumsum(size) - size, size


def decode_ids(ids: np.ndarray, edges: np.ndarray, pool) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the tokens, and where each text's bytes end."""
    data, begin, size = pool
    own = size[ids]
    return _gather(begin[ids], own, data), np.append(0, np.cumsum(own))[edges]


def encode(docs: DataFrame, path: str, most: int = TABLE) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) and the decoded bytes' digest of every whole text."""
    return _coded(docs, path, most, False)


def _coded(docs: DataFrame, path: str, most: int, digests: bool) -> DataFrame:
    spark: SparkSession = docs.sparkSession
    give_back()  # the driver, too, may come from another stage
    ranks = Ranks.read(path)
    encoded = word_table(docs, ranks, most)
    tokens = ranks.tokens
    del ranks
    give_back()
    shared = spark.sparkContext.broadcast((tokens, encoded))
    del tokens, encoded
    give_back()
    state: dict[str, object] = {}

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not state:
            tokens, known = shared.value
            own = Ranks(tokens)
            state.update(ranks=own, known=known, pool=_token_bytes(own), cache={})
        ids_out, counts, sums, decoded = [], [], [], []
        for ids, edges in encode_batch(batch["text"], state["ranks"], state["known"], state["cache"]):
            raw = ids.astype("<u4").tobytes()
            cut = edges.tolist()
            data, bounds = decode_ids(ids, edges, state["pool"])
            data, bounds = data.tobytes(), bounds.tolist()
            decoded += [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(bounds, bounds[1:], strict=False)]
            if not digests:
                ids_out += [raw[4 * a : 4 * b] for a, b in zip(cut, cut[1:], strict=False)]
                continue
            counts += [b - a for a, b in zip(cut, cut[1:], strict=False)]
            sums += [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(cut, cut[1:], strict=False)]
        if not digests:
            return pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(ids_out, pa.binary()), pa.array(decoded)], ["doc_id", "ids", "decoded_sha256"]
            )
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(sums), pa.array(decoded)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    tail = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids binary, decoded_sha256 string"
    return per_batch(docs.select("doc_id", "text"), step, f"doc_id {kind}, {tail}")


def digest(docs: DataFrame, path: str, most: int = TABLE) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded bytes of every whole text."""
    return _coded(docs, path, most, True)


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"), ranks_path())
