"""Merkle manifest of a table: a digest of every row, one root, and a proof for every row.

Every group of rows is a tree of ``RUN`` children a node; the groups' roots, in order, are the
leaves of one more such tree. The work is time-forward processing. Nodes carry labels that
place children before their parent, messages are digests addressed to a label, and a priority
queue hands them out in order of the label. The queue is external: Spark's sorted shuffle brings
each block of ``RUN ** height`` neighbouring nodes to one task in order, the digests of block
roots are the messages to the next round. Inside a block a heap holds the messages between its
nodes, never more than a few for each level. The reversed sweep goes through the same labels
backwards: a node hands each child the child's siblings and its own proof suffix.

However large a group is, a task works on one block at a time, and a table of n rows takes
log(n) / log(block) rounds each way (three for 5e10 rows). Each round is a written table.

Defined results: rows of one group with equal keys are ordered by their digest, so repeated
rows give the same tree in any order of arrival. A null is its own value in a digest; a null
group is one group, the first one. An empty table has no rows and a null root. Extra columns
are neither read nor returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..ship import ship
from ..sources.workspace import materialise
from .frames import table

RUN = 3
HEIGHT = 8
#: Rows handed on at once.
ROWS = 4096


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def record_digest(columns: list[Column]) -> Column:
    """Digest of a row: every value as its length in bytes, a colon and its text, or ``-`` if null."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def place(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """Add ``pos``, the rank of a row in its ``grp`` by ``order``, and ``size``, the rows of the group.

    Rows are dealt out in ranges of (grp, order) and numbered range by range, so a group may be
    of any size. One row per group and range says where the range goes on.
    """
    ranged = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    # Written, since the borders of the ranges would be sampled anew.
    placed = materialise(ranged.withColumn("at", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("part", F.shiftright("at", 33))
    starts = placed.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    group, so_far = Window.partitionBy("grp"), Window.partitionBy("grp").orderBy("part")
    starts = starts.select(
        F.col("grp").alias("own"),
        F.col("part").alias("own_part"),
        (F.sum("n").over(so_far) - F.col("n") - F.col("first")).alias("shift"),
        F.sum("n").over(group).alias("size"),
    )
    same = placed["grp"].eqNullSafe(starts["own"]) & (placed["part"] == starts["own_part"])
    joined = placed.join(starts, same).withColumn("pos", F.col("at") + F.col("shift"))
    return joined.drop("own", "own_part", "shift", "at", "part")


def _levels(size: int, height: int) -> int:
    """How far a block is folded: to its root, or by the whole height if its group has more blocks."""
    levels, width = 0, 1
    while width < size and levels < height:
        width *= RUN
        levels += 1
    return levels


def sweep(leaves: list[str], levels: int) -> list[list[str]]:
    """Digests of a block, level by level: children's digests go to their parent through the queue.

    A node's label is (last leaf below it, level): children come before parents, and nodes of
    different subtrees in order of their leaves.
    """
    found: list[list[str]] = [[] for _ in range(levels + 1)]
    queue: list[tuple] = []
    last, widths = len(leaves) - 1, [RUN**k for k in range(levels + 1)]

    def send(level: int, index: int, value: str) -> None:
        found[level].append(value)
        if level < levels:
            parent = index // RUN
            heappush(queue, (min((parent + 1) * widths[level + 1] - 1, last), level + 1, parent, index, value))

    for at, leaf in enumerate(leaves):
        send(0, at, leaf)
        while queue and queue[0][0] == at:
            label, children = queue[0][:3], []
            while queue and queue[0][:3] == label:
                children.append(heappop(queue)[4])
            send(label[1], label[2], digest(children))
    return found


#: A proof suffix: siblings left and right of a node, the suffix of its parent, and all of it as text.
Suffix = tuple[str, str, "Suffix", str] | None


def suffix_of(left: list[str], right: list[str]) -> Suffix:
    suffix = None
    for a, b in zip(reversed(left), reversed(right), strict=True):
        suffix = (a, b, suffix, a + b + (suffix[3] if suffix else ""))
    return suffix


def lists_of(suffix: Suffix) -> tuple[list[str], list[str]]:
    left, right = [], []
    while suffix:
        left.append(suffix[0])
        right.append(suffix[1])
        suffix = suffix[2]
    return left, right


def reversed_sweep(found: list[list[str]], top: Suffix) -> Iterator[tuple[int, Suffix]]:
    """Leaf and proof suffix, last leaf first: each node hands its children their suffixes."""
    levels, last = len(found) - 1, len(found[0]) - 1
    widths = [RUN**k for k in range(levels + 1)]
    # One message a label, so that no two entries are compared beyond it.
    queue: list[tuple] = [(-last, -levels, 0, top)]
    while queue:
        _, level, index, suffix = heappop(queue)
        if level == 0:
            yield index, suffix
            continue
        below = -level - 1
        children = found[below][index * RUN : (index + 1) * RUN]
        above = suffix[3] if suffix else ""
        for k in range(len(children)):
            left, right = "".join(children[:k]), "".join(children[k + 1 :])
            child = index * RUN + k
            end = min((child + 1) * widths[below] - 1, last)
            heappush(queue, (-end, -below, child, (left, right, suffix, left + right + above)))


def fold(leaf: str, suffix: Suffix) -> str:
    """The root that a leaf and its siblings lead to."""
    while suffix:
        leaf = digest([suffix[0], leaf, suffix[1]])
        suffix = suffix[2]
    return leaf


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _written(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    part = []
    for row in rows:
        part.append(row)
        if len(part) == ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema, strict=True)], schema=schema)
            part = []
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema, strict=True)], schema=schema)


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    """Nodes with the number of their block, all of a block in one task and in order."""
    width = RUN**height
    return nodes.withColumn("block", F.expr(f"greatest(pos, 0L) div {width}L"))


def climb(nodes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """grp, pos, size and digest of the nodes ``height`` levels up, or of the roots."""
    width = RUN**height

    def run(batches):
        def out():
            for (grp, block, size), rows in groupby(_rows(batches), itemgetter(0, 1, 2)):
                found = sweep([r[4] for r in rows], _levels(size, height))
                yield grp, block, -(-size // width), found[-1][0]

        yield from _written(out(), _NODE)

    ship(nodes.sparkSession)
    ordered = _blocks(nodes, height).repartition("grp", "block").sortWithinPartitions("grp", "pos")
    return ordered.select("grp", "block", "size", "pos", "digest").mapInArrow(run, "grp string, pos long, size long, digest string")


_NODE = pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("size", pa.int64()), ("digest", pa.string())])


class Tree:
    """The rounds of a forest of groups: nodes of every round, and the groups' roots."""

    def __init__(self, leaves: DataFrame, height: int = HEIGHT):
        self.height = height
        self.rounds, roots = [leaves], []
        while True:
            above = materialise(climb(self.rounds[-1], height), "nodes")
            roots.append(above.filter("size = 1").withColumn("round", F.lit(len(self.rounds) - 1)))
            above = above.filter("size > 1")
            if above.isEmpty():
                break
            self.rounds.append(above)
        self.roots = roots[0]
        for more in roots[1:]:
            self.roots = self.roots.unionAll(more)

    def suffixes(self, tops: DataFrame) -> DataFrame:
        """Proof suffixes for the blocks of the leaves: grp, block, top, left, right.

        ``tops`` holds grp, top (a text carried along), left and right of every group's root.
        """
        tops = tops.withColumnRenamed("grp", "own").join(
            self.roots.select("grp", "round"), F.col("own").eqNullSafe(F.col("grp"))
        )
        own = lambda k: tops.filter(F.col("round") == k).select("grp", F.lit(0).cast("long").alias("block"), "top", "left", "right")
        known = own(len(self.rounds) - 1)
        for k in range(len(self.rounds) - 1, 0, -1):
            below = _descend(self.rounds[k], known, self.height, _hand_down, "grp string, block long, top string, left array<string>, right array<string>")
            known = materialise(below, "suffixes").unionAll(own(k - 1))
        return known

    def descend(self, tops: DataFrame, each, schema: str, carried: tuple[str, ...] = ()) -> DataFrame:
        """The reversed sweep to the leaves; ``each`` makes a row of (node's row, suffix, top)."""
        return _descend(self.rounds[0], self.suffixes(tops), self.height, each, schema, carried)


def _hand_down(row: tuple, suffix: Suffix, top: str) -> tuple:
    return (row[0], row[3], top, *lists_of(suffix))


_TEXTS = pa.list_(pa.string())
_TYPES = {"string": pa.string(), "long": pa.int64(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<string>": _TEXTS}


def _descend(nodes: DataFrame, suffixes: DataFrame, height: int, each, schema: str, carried: tuple[str, ...] = ()) -> DataFrame:
    """A block's own suffix comes first among its rows, so it travels once, not with every node."""
    out_schema = pa.schema([(n, _TYPES[t]) for n, t in (f.split(" ") for f in schema.split(", "))])

    def run(batches):
        def out():
            for _, rows in groupby(_rows(batches), itemgetter(0, 1)):
                head, *rows = rows
                top, left, right = head[5:8]
                found = sweep([r[4] for r in rows], _levels(rows[0][2], height))
                for at, suffix in reversed_sweep(found, suffix_of(left, right)):
                    yield each(rows[at], suffix, top)

        yield from _written(out(), out_schema)

    ship(nodes.sparkSession)
    nodes = _blocks(nodes, height).selectExpr(
        *["grp", "block", "size", "pos", "digest", "CAST(NULL AS STRING) AS top"],
        *["CAST(NULL AS ARRAY<STRING>) AS `left`", "CAST(NULL AS ARRAY<STRING>) AS `right`"],
        *carried,
    )
    kinds = dict(nodes.dtypes)
    heads = suffixes.selectExpr(
        *["grp", "block", "CAST(NULL AS BIGINT) AS size", "-1L AS pos", "CAST(NULL AS STRING) AS digest", "top", "`left`", "`right`"],
        *[f"CAST(NULL AS {kinds[c]}) AS {c}" for c in carried],
    )
    both = nodes.unionAll(heads).repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")
    return both.mapInArrow(run, schema)


def manifest(leaves: DataFrame, key: str, height: int = HEIGHT) -> DataFrame:
    """For rows (grp, key, digest, altered): leaf, subroot, root, proof digest and the altered row's verdict.

    ``altered`` is the digest to be proved, the leaf's own where nothing was changed. The key must
    be of an integer type.
    """
    leaves = materialise(leaves, "leaves")
    placed = materialise(place(leaves, [key, "digest", "altered"], "placed"), "positions")
    forest = Tree(placed, height)
    # One row per group, and the root of all: the only digest that reaches the driver.
    subroots = materialise(forest.roots.select("grp", "digest"), "subroots")
    named = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    crown = Tree(materialise(place(named, ["name"], "crown"), "crown_positions"), height)
    first = crown.roots.first()
    root = first["digest"] if first else None
    none = "CAST(array() AS ARRAY<STRING>)"
    start = crown.roots.selectExpr("grp", "'' AS top", f"{none} AS `left`", f"{none} AS `right`")
    tops = crown.descend(
        start,
        lambda row, suffix, top: (row[8], row[4], *lists_of(suffix)),
        "grp string, top string, left array<string>, right array<string>",
        ("name",),
    )
    tops = materialise(tops, "tops")

    def proof(row: tuple, suffix: Suffix, top: str) -> tuple:
        folded = fold(row[9], suffix)
        return row[8], row[4], top, root, hashlib.sha256((suffix[3] if suffix else "").encode()).hexdigest(), folded, folded == root

    return forest.descend(
        tops,
        proof,
        "key bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
        (key, "altered"),
    ).withColumnRenamed("key", key)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op11_manifest(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    own = [F.col(c) for c in FIELDS]
    known = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    changed = (F.crc32(known) % 2 == 0) & F.col("doc_id").isNotNull()
    leaf = record_digest(own)
    altered = record_digest([*own[:-1], F.replace(F.col("text"), F.lit("\n"), F.lit(""))])
    leaves = docs.select(
        F.col("source").alias("grp"), "doc_id", leaf.alias("digest"), F.when(changed, altered).otherwise(leaf).alias("altered")
    )
    return manifest(leaves, "doc_id")


def oracle(levels: int = 14) -> str:
    """The same in SQL, for groups of up to RUN ** levels rows."""

    def part(c: str) -> str:
        t = f"CAST({c} AS VARCHAR)"
        return f"coalesce(CAST(strlen({t}) AS VARCHAR) || ':' || {t}, '-')"

    def record(text: str) -> str:
        return "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    # Fixed value: the polynomial of CRC-32, in reversed bit order.
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))"
    odd = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {bits}), 4294967295) & 1"
    steps = [
        f"""l0 AS (SELECT doc_id, source, {record("text")} AS leaf,
            CASE WHEN {odd} = 0 THEN {record("replace(text, chr(10), '')")} ELSE {record("text")} END AS altered FROM documents)""",
        """leaves AS (SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY source
            ORDER BY doc_id NULLS FIRST, leaf, altered) - 1 AS pos, count(*) OVER (PARTITION BY source) AS size FROM l0)""",
    ]

    def climb(name: str, base: str, group: str) -> list[str]:
        out = [f"{name}0 AS (SELECT {group}, pos, size, digest FROM ({base}))"]
        for k in range(1, levels + 1):
            out.append(
                f"""{name}{k} AS (SELECT {group}, pos // 3 AS pos, (any_value(size) + 2) // 3 AS size,
                CASE WHEN any_value(size) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
                FROM {name}{k - 1} GROUP BY {group}, pos // 3)"""
            )
        return out

    steps += climb("n", "SELECT source, pos, size, leaf AS digest FROM leaves", "source")
    steps.append(
        f"""subroots AS (SELECT source, digest AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS rank,
        count(*) OVER () AS ranks FROM n{levels})"""
    )
    steps += climb("r", "SELECT 1 AS one, rank AS pos, ranks AS size, subroot AS digest FROM subroots", "one")
    # Siblings of every node left and right of it, then of every leaf's way up, level by level.
    joins, columns = [], []
    for i in range(2 * levels):
        name, group, k = ("n", "source", i) if i < levels else ("r", "one", i - levels)
        run = f"OVER (PARTITION BY {group}, pos // 3 ORDER BY pos ROWS BETWEEN"
        steps.append(
            f"""s{i} AS (SELECT {group}, pos, size > 1 AS c{i},
            coalesce(string_agg(digest, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a{i},
            coalesce(string_agg(digest, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b{i} FROM {name}{k})"""
        )
        match = f"s{i}.source IS NOT DISTINCT FROM l.source AND s{i}.pos = l.pos" if i < levels else f"s{i}.pos = s.rank"
        joins.append(f"JOIN s{i} ON {match} // {3**k}")
        columns.append(f"CASE WHEN c{i} THEN a{i} ELSE '' END AS a{i}, CASE WHEN c{i} THEN b{i} ELSE '' END AS b{i}, c{i}")
    steps.append(
        f"""paths AS (SELECT l.doc_id, l.leaf, l.altered, s.subroot, {", ".join(columns)}
        FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source {" ".join(joins)})"""
    )
    steps.append("f0 AS (SELECT *, altered AS folded FROM paths)")
    for i in range(2 * levels):
        steps.append(f"f{i + 1} AS (SELECT * REPLACE (CASE WHEN c{i} THEN sha256(a{i} || folded || b{i}) ELSE folded END AS folded) FROM f{i})")
    proof = " || ".join(f"a{i} || b{i}" for i in range(2 * levels))
    return f"""WITH {", ".join(steps)}
        SELECT doc_id, leaf, subroot, (SELECT digest FROM r{levels}) AS root, sha256({proof}) AS proof_sha256,
          folded AS folded_root, folded = (SELECT digest FROM r{levels}) AS verified FROM f{2 * levels}"""


ORACLE = oracle()
