"""Secrets in whole texts, told apart by who holds them across the corpus.

Three plain patterns give the base spans. Besides them, long tokens of mixed characters are
candidates. The values of all candidates are hashed and counted over the whole corpus, by
distinct repositories (``doc_id`` here) and distinct owners (``source`` here). A value that
more than ``MOST_OWNERS`` owners hold, or more than ``MOST_REPOSITORIES`` repositories whoever owns
them, is a widely copied example; any other is owner-specific and looks live. Values and rows are
told apart by 128 bits and more. Live candidates become spans of the kind ``other``; base spans always stay.

Only hashes of values are shuffled, with owner and repository, and they are made distinct
before they are counted, so a value in a third of all texts is spread over tasks. Null and
empty texts have no spans; a null owner or repository counts as one of its own. Repeated
rows get equal results. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import materialise
from .frames import per_batch, table, texts

KINDS = ("assign", "access", "hex", "other")
MOST_OWNERS, MOST_REPOSITORIES, LEAST_ENTROPY = 2, 20, 3.2
_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Runs of 20 token characters or more.
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
_KEY = re.compile(r"password|passwd|secret|token|api", re.ASCII | re.IGNORECASE)


def _entropy(token: str) -> float:
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values())


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """Start, number of the kind, end and value of the plain patterns' matches, in order."""
    out = []
    if ("=" in text or ":" in text) and _KEY.search(text):
        out += [(m.start(), 0, m.end(), m.group(1)) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 6]
    out += [(m.start(), 1, m.end(), m.group()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m.group()) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Base matches, and further tokens that mix letters and digits and repeat little."""
    more = []
    for m in _TOKEN.finditer(text):
        token, a, b = m.group(), m.start(), m.end()
        mixed = any(c.isdigit() for c in token) and any(c.isalpha() for c in token)
        if mixed and _entropy(token) >= LEAST_ENTROPY and all(b <= x or y <= a for x, _, y, _ in base):
            more.append((a, 3, b, token))
    return base + more


def _hash(value: str) -> bytes:
    return hashlib.blake2b(value.encode("utf-8", "replace"), digest_size=16).digest()


def _identity(column: str) -> Column:
    return F.coalesce(F.md5(F.col(column).cast("string").cast("binary")), F.lit("-"))


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("value", pa.binary())])


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """doc_id, a hash of the row, owner, repository, base line and candidates of every text."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines, found = [], []
        for text in texts(batch["text"]):
            base = base_spans(text)
            lines.append(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in base))
            found.append([{"start": a, "kind": k, "end": b, "value": _hash(v)} for a, k, b, v in candidates(text, base)])
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["row"], batch["owner"], batch["repository"], pa.array(lines, pa.string()), pa.array(found, pa.list_(_SPAN))],
            ["doc_id", "row", "owner", "repository", "base", "found"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    named = docs.select(
        "doc_id",
        F.concat(_identity("doc_id"), _identity("text")).alias("row"),
        F.xxhash64(F.col(owner)).alias("owner"),
        F.xxhash64(F.col(repository)).alias("repository"),
        "text",
    )
    return per_batch(
        named, step, f"doc_id {kind}, row string, owner long, repository long, base string, "
        "found array<struct<start:int,kind:int,end:int,value:binary>>",
    )


def ownership(found: DataFrame) -> DataFrame:
    """value, repositories and owners: how many distinct ones hold each candidate."""
    held = found.select("owner", "repository", F.explode("found.value").alias("value")).distinct()
    by_owner = held.groupBy("value", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("value").agg(F.sum("n").alias("repositories"), F.count("*").alias("owners"))


def detect(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """doc_id, base line, all spans, and numbers of live and of copied candidates of every row."""
    found = materialise(scan(docs, owner, repository), "secrets")
    single = found.filter(F.size("found") > 0).select("row", F.explode("found").alias("c")).select("row", "c.*").distinct()
    specific = (F.col("owners") <= MOST_OWNERS) & (F.col("repositories") <= MOST_REPOSITORIES)
    judged = single.join(ownership(found), "value").withColumn("live", specific)
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    span = F.struct("start", "kind", F.concat_ws(":", kind, "start", "end").alias("name"))
    by_row = judged.groupBy("row").agg(
        F.collect_set(F.when((F.col("kind") < 3) | F.col("live"), span)).alias("spans"),
        F.count(F.when(F.col("live"), 1)).alias("n_live"),
        F.count(F.when(~F.col("live"), 1)).alias("n_copied"),
    )
    out = found.select("doc_id", "row", "base").join(by_row, "row", "left")
    return out.select(
        "doc_id",
        "base",
        F.coalesce(F.array_join(F.array_sort("spans")["name"], ","), F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"),
    )


def op7_secrets(spark, sf_dir: str) -> DataFrame:
    out = detect(table(spark, sf_dir, "documents"))
    count = lambda kind: F.regexp_count("base", F.lit(kind + ":")).cast("long").alias(f"n_{kind}")
    return out.select(
        "doc_id", *[count(k) for k in KINDS[:3]], F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans", "n_live", "n_copied"
    )
