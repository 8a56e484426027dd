"""Join of all pairs of texts with similar word shingles: MinHash with banding.

Shingles are five words in a row (a shorter text is one shingle); words are runs of
non-blank characters. A text's signature has ``TREES`` bands. Texts with equal bands meet at a
node. A band's length is at most ``LONGEST`` values and the longest one with which a pair at
the threshold meets somewhere with the target recall: it hangs on constants only, not on the
data. Matched nodes are then verified exactly, on whole shingle sets.

How it stays bounded:

* Equal texts are one entry with a count of copies, so copies never meet each other.
* Trie nodes that hold the same texts in several trees are verified once.
* A large node is dealt out in blocks; every pair of blocks is a group of its own, and a
  group gives one row per text (links counted, leader of its local component), not pairs.
  A pair that meets in several nodes is counted in the smallest only.

Definitions. Null and empty texts and texts without words have no links and are classes of
their own. A null doc_id is allowed; it gives no class its name (the class id is null if no
other id is in the class). Repeated rows are copies of each other. ``n_links`` counts all
other rows with a similarity of at least the threshold, copies included; ``class_id`` is the
smallest doc_id that can be reached over links. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import materialise
from . import words
from .components import components
from .frames import per_batch, table

SHINGLE, THRESHOLD, RECALL = 5, 0.8, 0.9995
TREES, LONGEST = 24, 8
#: Texts, and shingles, of a block of a large node.
BLOCK_TEXTS, BLOCK_SHINGLES = 256, 2_000_000
NO_ID = 2**63 - 1
_rng = np.random.default_rng(0xF0)
_MULTIPLIERS = _rng.integers(1, 2**63, TREES * LONGEST, dtype=np.uint64) | np.uint64(1)
_SALTS = _rng.integers(1, 2**63, TREES, dtype=np.uint64)


def prefix_length(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Shorten prefixes until a pair at the threshold is found with the recall asked for."""
    length = LONGEST
    while length > 1 and 1 - (1 - threshold**length) ** TREES < recall:
        length -= 1
    return length


def shingles(found: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of the distinct shingles, sorted."""
    at, h = found.windows(SHINGLE)
    parts = [(found.doc[at], h)]
    count = np.bincount(found.doc, minlength=found.texts)
    for n in range(1, SHINGLE):
        if (count == n).any():
            at, h = found.windows(n)
            short = count[found.doc[at]] == n
            parts.append((found.doc[at][short], words.mix(h[short] + np.uint64(n))))
    doc, h = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def _signatures(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of shingles, and the prefix at every tree, of each text."""
    sizes = np.zeros(len(column), np.int64)
    prefixes = np.zeros((len(column), TREES), np.uint64)
    for found in words.scan(column):
        doc, h = shingles(found)
        if not len(doc):
            continue
        own, first = np.unique(doc, return_index=True)
        sizes[found.first + own] = np.diff(np.append(first, len(doc)))
        for tree in range(TREES):
            path = np.full(len(own), _SALTS[tree], np.uint64)
            for j in range(length):
                low = ((h * _MULTIPLIERS[tree * LONGEST + j]) >> np.uint64(32)).astype(np.uint32)
                path = words.mix(path + np.minimum.reduceat(low, first))
            prefixes[found.first + own, tree] = path
    return sizes, prefixes


def signatures(docs: DataFrame) -> DataFrame:
    """key, node (hash of the text), number of shingles and tree prefixes of every row."""
    length = prefix_length()

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, prefixes = _signatures(batch["text"], length)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(0, prefixes.size + 1, TREES), pa.int32()), pa.array(prefixes.view(np.int64).ravel())
        )
        return pa.RecordBatch.from_arrays(
            [batch["key"], batch["node"], pa.array(sizes), lists], ["key", "node", "size", "prefixes"]
        )

    return per_batch(keyed(docs), step, "key long, node binary, size long, prefixes array<long>")


def keyed(docs: DataFrame, payload: Column | str = "text") -> DataFrame:
    """key and node (hash of the text) of every row, and what goes with them."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"),
        F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("node"),
        payload,
    )


def _overlaps(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the shingle sets, and of the intersections of all pairs of a small group."""
    docs, hashes = [], []
    for found in words.scan(column):
        doc, h = shingles(found)
        docs.append(doc + found.first)
        hashes.append(h)
    doc, h = np.concatenate(docs), np.concatenate(hashes)
    m = len(column)
    sizes = np.bincount(doc, minlength=m)
    order = np.argsort(h, kind="stable")
    doc, h = doc[order], h[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(h)))
    # Shingles that stand in the same texts make one column, with a weight.
    marks = words.mix(np.arange(1, m + 1, dtype=np.uint64))
    pattern = np.add.reduceat(marks[doc], first) if len(first) else np.zeros(0, np.uint64)
    shared = np.flatnonzero(count > 1)
    _, chosen, weight = np.unique(pattern[shared], return_index=True, return_counts=True)
    inter = np.zeros((m, m), np.float64)
    for low in range(0, len(chosen), 2048):
        some = shared[chosen[low : low + 2048]]
        rows = np.concatenate([doc[f : f + c] for f, c in zip(first[some], count[some], strict=True)])
        dense = np.zeros((m, len(some)), np.float32)
        dense[rows, np.repeat(np.arange(len(some)), count[some])] = 1
        inter += (dense * weight[low : low + 2048].astype(np.float32)) @ dense.T
    return sizes, inter


def _verify(group: pa.Table) -> pa.Table:
    """One row per text of a group of one or two blocks: its links and its leader."""
    group = group.combine_chunks()
    _, own = np.unique([x.as_py() for x in group["node"]], return_index=True)
    group = group.take(pa.array(own))
    m, bucket = len(own), group["bucket"][0].as_py()
    sizes, inter = _overlaps(group["text"])
    linked = (inter >= THRESHOLD * (sizes[:, None] + sizes[None, :] - inter) - 1e-9) & (inter > 0)
    block = group["block"].to_numpy()
    if group["lo"][0].as_py() != group["hi"][0].as_py():
        linked &= block[:, None] != block[None, :]
    np.fill_diagonal(linked, False)
    others = group["buckets"].combine_chunks()
    row = np.repeat(np.arange(m), np.diff(others.offsets.to_numpy()))
    value = others.flatten().to_numpy()
    row, value = row[value < bucket], value[value < bucket]
    counted = linked
    if len(value):
        _, column = np.unique(value, return_inverse=True)
        held = np.zeros((m, column.max() + 1), np.float32)
        held[row, column] = 1
        counted = linked & ~((held @ held.T) > 0)
    links = counted @ group["copies"].to_numpy()
    leader = np.arange(m)  # rows are in order of node
    while True:
        near = np.where(linked, leader[None, :], m).min(axis=1)
        after = np.minimum(leader, near)
        after = np.minimum(after, after[after])
        if (after == leader).all():
            break
        leader = after
    some = np.flatnonzero(linked.any(axis=1))
    nodes = group["node"].combine_chunks()
    return pa.table(
        {"node": nodes.take(pa.array(some)), "leader": nodes.take(pa.array(leader[some])), "links": pa.array(links[some].astype(np.int64))}
    )


def near_classes(docs: DataFrame) -> DataFrame:
    """key, node, size, copies, n_links, class_key and class_node of every row of the table."""
    rows = materialise(signatures(docs), "signatures")
    texts = rows.groupBy("node").agg(
        F.min("key").alias("rep"), F.count("*").alias("copies"), F.max("size").alias("size")
    )
    texts = materialise(texts, "texts")
    first = Window.partitionBy("node").orderBy("key")
    entry = rows.withColumn("n", F.row_number().over(first)).filter("n = 1 AND size > 0")
    member = entry.select("node", F.col("key").alias("rep"), "size", F.explode("prefixes").alias("bucket"))
    buckets = (
        member.groupBy("bucket")
        .agg(
            F.count("*").alias("n"),
            F.sum("size").alias("total"),
            F.bit_xor(F.xxhash64("node")).alias("x"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
        )
        .filter("n > 1")
        .groupBy("n", "total", "x", "y")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket", "n", "total")
    )
    lists = (
        member.join(buckets, "bucket")
        .groupBy("node", "rep")
        .agg(F.collect_list(F.struct("bucket", "n", "total")).alias("held"))
        .join(texts.select("node", "copies"), "node")
    )
    own = keyed(docs)
    blocks = (
        own.join(lists.withColumnRenamed("rep", "key"), ["key", "node"])
        .select("node", "copies", "text", F.explode("held").alias("h"), F.col("held.bucket").alias("buckets"))
        .select("node", "copies", "text", "buckets", "h.*")
        .withColumn("parts", F.ceil(F.greatest(F.col("n") / BLOCK_TEXTS, F.col("total") / BLOCK_SHINGLES)).cast("long"))
        .withColumn("block", F.pmod(F.xxhash64("node", F.lit(2)), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select("bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "copies", "buckets", "text")
    )
    found = blocks.groupBy("bucket", "lo", "hi").applyInArrow(_verify, "node binary, leader binary, links long")
    found = materialise(found, "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    label = components(found.select("node", "leader"))
    label = texts.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    head = label.groupBy("label").agg(F.min(F.struct("rep", "node")).alias("head"))
    known = (
        label.join(head, "label")
        .join(links, "node", "left")
        .select("node", "copies", "head", F.coalesce("links", F.lit(0)).alias("links"))
    )
    alone = F.col("size") == 0
    return rows.select("key", "node", "size").join(known, "node").select(
        "key",
        "node",
        "size",
        F.when(alone, 0).otherwise(F.col("links") + F.col("copies") - 1).alias("n_links"),
        F.when(alone, F.col("key")).otherwise(F.col("head.rep")).alias("class_key"),
        F.when(alone, F.col("node")).otherwise(F.col("head.node")).alias("class_node"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of the table, one of each class of near duplicates, with all their columns.

    Texts without words are classes of their own: all of them stay, and none is shuffled.
    """
    classes = near_classes(docs).filter("size > 0 AND key = class_key AND node = class_node")
    bare = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    again = Window.partitionBy("key", "node").orderBy(F.xxhash64("row.*"))
    others = keyed(docs.filter(~bare), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    first = (
        others.join(classes.select("key", "node").distinct(), ["key", "node"])
        .withColumn("n", F.row_number().over(again))
        .filter("n = 1")
        .select("row.*")
    )
    return docs.filter(bare).unionByName(first)


def op8_near_join(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = near_classes(docs)
    no = F.lit(None).cast("long")
    return out.select(
        F.when(F.col("key") != NO_ID, F.col("key")).otherwise(no).alias("doc_id"),
        F.when(F.col("class_key") != NO_ID, F.col("class_key")).otherwise(no).alias("class_id"),
        "n_links",
    )
