"""Quality rules per document, and verdicts on hosts shrunk by an empirical beta prior.

Words are runs of non-blank characters. Every document gets counts from its whole text and
two base rules: too few words, too many words in repeated windows. Three further rules
(symbols, repeated lines, length of words) have a mild and a strict limit. A host (any
column; ``source`` here) is judged by the share of its documents that fail each strict
limit: shares are shrunk towards the corpus by a beta prior fitted to all hosts' shares
(method of moments), and a host whose shrunk share passes ``HOST_LIMIT`` is bad for that
rule. Documents of a bad host must meet the strict limit, all others the mild one.

Null and empty texts have zero counts and fail the base rules. A null host counts as the
host named by the empty text. Repeated rows are rows of their own. Hosts are counted with
partial sums before the shuffle; the join back carries narrow rows, and Spark splits a hot
host's rows by itself (adaptive skew join). Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import materialise
from . import words
from .frames import per_batch, table

MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 20, 8, 30
HOST_LIMIT = 0.5
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of flags over each text's stretch."""
    total = np.append(0, np.cumsum(flags))
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated(group: np.ndarray, value: np.ndarray, later: bool) -> np.ndarray:
    """Which entries share group and value with another one; or, if later, with an earlier one."""
    out = np.zeros(len(value), bool)
    if len(value) > 1:
        order = np.lexsort((value, group))
        same = (group[order][1:] == group[order][:-1]) & (value[order][1:] == value[order][:-1])
        out[order[1:]] = same
        if not later:
            out[order[:-1]] |= same
    return out


def counts_of(found: words.Words) -> dict[str, np.ndarray]:
    """The counts of every text of a chunk."""
    data, offsets = found.data, found.offsets
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, found.start, 1)
    np.add.at(inside, found.end, -1)
    inside = np.cumsum(inside[:-1]) > 0
    lead = (data & 0xC0) != 0x80
    at, h = found.windows(REPEAT_WINDOW)
    again = at[repeated(found.doc[at], h, False)]
    edge = np.zeros(len(found.doc) + 1, np.int32)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + REPEAT_WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0
    begin, end = words.runs(data != 0x0A, offsets)
    starts = np.zeros(len(data) + 1, np.int64)
    starts[found.start + 1] = 1
    starts = np.cumsum(starts)
    full = starts[end] > starts[begin] if len(begin) else np.zeros(0, bool)
    begin, end = begin[full], end[full]
    line_doc = np.searchsorted(offsets, begin, "right") - 1
    twice = repeated(line_doc, words.run_hashes(data, begin, end), True)
    n = found.texts
    return {
        "n_words": np.bincount(found.doc, minlength=n),
        "word_chars": per_text(inside & lead, offsets),
        "n_symbols": per_text(_SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(line_doc[twice], minlength=n),
        "n_repeat_words": np.bincount(found.doc[covered], minlength=n),
        "n_lines": np.bincount(line_doc, minlength=n),
    }


def counts(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the counts of every row."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [counts_of(found) for found in words.scan(batch["text"])]
        columns = [pa.array(np.concatenate([p[c] for p in parts]).astype(np.int64)) for c in COUNTS]
        return pa.RecordBatch.from_arrays([batch["doc_id"], batch["host"], *columns], ["doc_id", "host", *COUNTS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    named = docs.select("doc_id", F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), "text")
    return per_batch(named, step, f"doc_id {kind}, host string, " + ", ".join(f"{c} long" for c in COUNTS))


def _rules() -> dict[str, tuple[Column, Column]]:
    """Mild and strict form of each rule; true where a document fails."""
    w, chars, symbols = F.col("n_words"), F.col("word_chars"), F.col("n_symbols")
    twice, lines = F.col("n_dup_lines"), F.col("n_lines")
    return {
        "symbols": (symbols * 100 > w * 30, symbols * 100 > w * 10),
        "lines": (twice * 100 > lines * 50, twice * 100 > lines * 30),
        "length": ((chars > w * 20) | (chars * 2 < w * 3), (chars > w * 15) | (chars < w * 2)),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def host_verdicts(counted: DataFrame) -> DataFrame:
    """host, its number of documents and, by rule, failures, shrunk share and verdict."""
    rules = _rules()
    fails = [F.sum(strict.cast("long")).alias(f"k_{r}") for r, (_, strict) in rules.items()]
    hosts = materialise(counted.groupBy("host").agg(F.count("*").alias("n"), *fails), "hosts")
    moments = []
    for r in rules:
        share = F.col(f"k_{r}") / F.col("n")
        moments += [F.avg(share).alias(f"m_{r}"), F.var_pop(share).alias(f"v_{r}")]
    prior = hosts.agg(*moments).first().asDict()
    for r in rules:
        mean, spread = prior[f"m_{r}"] or 0.0, prior[f"v_{r}"] or 0.0
        weight = 1000.0 if spread <= 0 else min(1000.0, max(1.0, mean * (1 - mean) / spread - 1))
        hosts = hosts.withColumn(f"share_{r}", (F.col(f"k_{r}") + mean * weight) / (F.col("n") + weight))
        hosts = hosts.withColumn(f"bad_{r}", F.col(f"share_{r}") > HOST_LIMIT)
    return hosts


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """The counts of every row, base_failed and kept."""
    counted = materialise(counts(docs, host), "counts")
    verdicts = host_verdicts(counted).select("host", *[f"bad_{r}" for r in _rules()])
    fails = F.lit(False)
    for r, (mild, strict) in _rules().items():
        fails = fails | F.when(F.col(f"bad_{r}"), strict).otherwise(mild)
    return (
        counted.join(verdicts, "host")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~fails)
    )


def op9_rules(spark, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *COUNTS[:5], "base_failed", "kept")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
x AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
g AS (SELECT doc_id, i, CASE WHEN lead(word, 7) OVER s IS NOT NULL THEN list_value(word, lead(word) OVER s,
  lead(word, 2) OVER s, lead(word, 3) OVER s, lead(word, 4) OVER s, lead(word, 5) OVER s,
  lead(word, 6) OVER s, lead(word, 7) OVER s) END AS gram FROM x WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, gram IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, gram) > 1 AS again FROM g),
c AS (SELECT doc_id, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS 7 PRECEDING) AS covered FROM r),
rep AS (SELECT doc_id, count(*) FILTER (covered) AS n FROM c GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
f AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS nth FROM l
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
n AS (SELECT doc_id, count(*) AS lines, count(*) FILTER (nth > 1) AS twice FROM f GROUP BY doc_id),
k AS (SELECT w.doc_id, host, len(words)::BIGINT AS n_words,
  length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  coalesce(twice, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lines, 0) AS n_lines
  FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id LEFT JOIN n ON w.doc_id = n.doc_id),
t AS (SELECT *, n_symbols * 100 > n_words * 30 AS a1, n_symbols * 100 > n_words * 10 AS a2,
  n_dup_lines * 100 > n_lines * 50 AS b1, n_dup_lines * 100 > n_lines * 30 AS b2,
  word_chars > n_words * 20 OR word_chars * 2 < n_words * 3 AS c1, word_chars > n_words * 15 OR word_chars < n_words * 2 AS c2 FROM k),
h AS (SELECT host, count(*) AS n, count(*) FILTER (a2) AS ka, count(*) FILTER (b2) AS kb, count(*) FILTER (c2) AS kc FROM t GROUP BY host),
p AS (SELECT avg(ka / n) AS ma, var_pop(ka / n) AS va, avg(kb / n) AS mb, var_pop(kb / n) AS vb, avg(kc / n) AS mc, var_pop(kc / n) AS vc FROM h),
q AS (SELECT ma, mb, mc,
  CASE WHEN va <= 0 THEN 1000 ELSE least(1000, greatest(1, ma * (1 - ma) / va - 1)) END AS wa,
  CASE WHEN vb <= 0 THEN 1000 ELSE least(1000, greatest(1, mb * (1 - mb) / vb - 1)) END AS wb,
  CASE WHEN vc <= 0 THEN 1000 ELSE least(1000, greatest(1, mc * (1 - mc) / vc - 1)) END AS wc FROM p),
v AS (SELECT host, (ka + ma * wa) / (n + wa) > 0.5 AS ha, (kb + mb * wb) / (n + wb) > 0.5 AS hb, (kc + mc * wc) / (n + wc) > 0.5 AS hc FROM h, q),
j AS (SELECT t.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  (CASE WHEN ha THEN a2 ELSE a1 END) OR (CASE WHEN hb THEN b2 ELSE b1 END) OR (CASE WHEN hc THEN c2 ELSE c1 END) AS fails
  FROM t JOIN v ON t.host = v.host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT fails AS kept FROM j
"""
