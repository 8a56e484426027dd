"""Language-model scores of whole texts: all ways to cut them into pieces of an existing vocabulary.

A text is its words, each with the blank before it, and one end. A word is cut into pieces of the
vocabulary, which never reach over a blank, in every possible way; a way weighs the product of its
pieces' probabilities. The forward recursion, in log space over the bytes of a word, sums them up,
so the score is the log10 of the text's marginal probability. The pieces and the end share a
total of 1, so no more than 1 is given to all texts together.

The vocabulary is read from a public tokenizer, never trained. Its scores order the pieces: the
piece of rank r starts at a weight of 1 / (r + SHIFT), Zipf's law. One forward-backward pass over the
distinct words of the training documents then counts how often each piece is expected to be used, and
the probabilities are these counts smoothed by ``PRIOR`` pieces dealt by the vocabulary's own
weights. Byte pieces make every word possible.

Words travel once: counted over all documents, their probabilities are worked out once per distinct
word. Words that make up at least one in ``HOT`` of all (no more than HOT of them, of no more than
``HOT_BYTES`` bytes) are sent to the tasks; all others meet their documents in a join on the word,
one row per task and word. Sums are exact: logarithms are added as whole numbers in two limbs,
so no result depends on the order of tasks.

Defined results: a null text is the empty text, which is its end alone. Rows are scored each by
itself, also those with equal ids; a null id counts as the empty text for the training fold. Without
training documents every count is 0 and the vocabulary's own weights stand. An empty table has no
rows. Other columns are neither read nor returned.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ship import ship
from ..sources.workspace import materialise
from .frames import fold, table

SHIFT, PRIOR = 3, 32_000
HOT, HOT_BYTES = 100_000, 64
#: Distinct words, or pairs of word and document, that a task holds before it hands them on.
HELD = 500_000
#: Expected counts are added up in whole numbers of 1 / GRAIN.
GRAIN = 1024
SHORT = 32
LOG10 = math.log(10)

#: Pieces as bytes with natural logarithms of their probabilities; the end's comes last.
Weights = tuple[list[bytes], np.ndarray]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str) -> Weights:
    """Pieces that can occur in a word, and their starting log probabilities by the file's scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ranks: dict[bytes, float] = {}
    bytes_ = []
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            bytes_.append(bytes([int(model.id_to_piece(i)[3:5], 16)]))
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            piece = model.id_to_piece(i).replace("▁", " ").encode()
            if b" " not in piece[1:] and piece == piece.lower():
                ranks[piece] = -model.get_score(i)
    last = max(ranks.values(), default=0.0)
    for piece in bytes_ or [bytes([b]) for b in range(256)]:
        ranks.setdefault(piece, last)
    pieces = sorted(ranks)
    weight = np.array([1 / (ranks[p] + SHIFT) for p in pieces] + [1 / (last + SHIFT)])
    return pieces, np.log(weight / weight.sum())


class Lattice:
    """All ways through words, by the pieces' log probabilities."""

    def __init__(self, weights: Weights):
        pieces, logs = weights
        #: Piece or beginning of one -> number, log probability, probability; number -1 for mere beginnings.
        self.nodes: dict[bytes, tuple[int, float, float]] = {}
        for number, (piece, log) in enumerate(zip(pieces, logs.tolist())):
            for k in range(1, len(piece)):
                self.nodes.setdefault(piece[:k], (-1, 0.0, 0.0))
            self.nodes[piece] = (number, log, math.exp(log))

    def forward(self, word: bytes) -> list[float]:
        """Log probability of everything before each place of the word, all ways together."""
        nodes, size = self.nodes, len(word)
        alpha = [-math.inf] * (size + 1)
        alpha[0] = 0.0
        exp, log1p, least = math.exp, math.log1p, -math.inf
        for i in range(size):
            before = alpha[i]
            for j in range(i + 1, size + 1):
                node = nodes.get(word[i:j])
                if node is None:
                    break
                if node[0] >= 0:
                    way, known = before + node[1], alpha[j]
                    if way > known:
                        way, known = known, way
                    alpha[j] = known + log1p(exp(way - known)) if way > least else known
        return alpha

    def log_probability(self, word: bytes) -> float:
        return self.forward(b" " + word)[-1]

    def expected(self, word: bytes) -> dict[int, float]:
        """How often each piece is used in the word, over all ways by their weight.

        Products of a few pieces are far from underflow: words of up to SHORT bytes are done
        without logarithms.
        """
        word = b" " + word
        if len(word) > SHORT:
            return self._expected_log(word)
        nodes, size = self.nodes, len(word)
        alpha, arcs, used = [1.0] + [0.0] * size, [], {}
        for i in range(size):
            before = alpha[i]
            for j in range(i + 1, size + 1):
                node = nodes.get(word[i:j])
                if node is None:
                    break
                if node[0] >= 0:
                    alpha[j] += before * node[2]
                    arcs.append((i, j, node))
        beta = [0.0] * size + [1 / alpha[size]]
        for i, j, (number, _, weight) in reversed(arcs):
            way = weight * beta[j]
            beta[i] += way
            used[number] = used.get(number, 0.0) + alpha[i] * way
        return used

    def _expected_log(self, word: bytes) -> dict[int, float]:
        nodes, size, alpha = self.nodes, len(word), self.forward(word)
        beta, used, total = [-math.inf] * size + [0.0], {}, alpha[-1]
        exp, log1p = math.exp, math.log1p
        for i in range(size - 1, -1, -1):
            behind, before = -math.inf, alpha[i] - total
            for j in range(i + 1, size + 1):
                node = nodes.get(word[i:j])
                if node is None:
                    break
                if node[0] >= 0:
                    way = node[1] + beta[j]
                    used[node[0]] = used.get(node[0], 0.0) + exp(before + way)
                    if way > behind:
                        way, behind = behind, way
                    if way > -math.inf:
                        behind += log1p(exp(way - behind))
            beta[i] = behind
        return used


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words: ASCII letters change, and ASCII blanks divide."""
    return (text or b"").lower().split()


def _binary(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def word_table(docs: DataFrame, train: Column) -> DataFrame:
    """word, n (in all documents) and c (in those for training)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt, other = Counter(), Counter()

        def out():
            found = list(learnt.keys() | other.keys())
            c = [learnt[w] for w in found]
            n = [k + other[w] for k, w in zip(c, found)]
            learnt.clear()
            other.clear()
            return pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(n, pa.int64()), pa.array(c, pa.int64())], ["word", "n", "c"])

        for batch in batches:
            for text, own in zip(_binary(batch["text"]), batch["train"].to_pylist(), strict=True):
                (learnt if own else other).update(words_of(text))
                if len(learnt) + len(other) >= HELD:
                    yield out()
        if learnt or other:
            yield out()

    ship(docs.sparkSession)
    parts = docs.select("text", train.alias("train")).mapInArrow(run, "word binary, n long, c long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))


def learn(words: DataFrame, ends: int, start: Weights) -> Weights:
    """Probabilities by the expected use of every piece in the training words, smoothed by ``start``."""
    sent = words.sparkSession.sparkContext.broadcast(start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, used = Lattice(sent.value), {}
        for batch in batches:
            for word, c in zip(_binary(batch["word"]), batch["c"].to_pylist(), strict=True):
                for piece, share in lattice.expected(word).items():
                    used[piece] = used.get(piece, 0) + round(c * share * GRAIN)
        if used:
            yield pa.RecordBatch.from_arrays([pa.array(list(used), pa.int32()), pa.array(list(used.values()), pa.int64())], ["piece", "used"])

    ship(words.sparkSession)
    parts = words.filter("c > 0").select("word", "c").mapInArrow(run, "piece int, used long")
    rows = parts.groupBy("piece").agg(F.sum("used").alias("used")).collect()  # one a piece at most
    sent.destroy()
    pieces, logs = start
    count = np.exp(logs) * PRIOR
    for r in rows:
        count[r["piece"]] += r["used"] / GRAIN
    count[-1] += ends
    return pieces, np.log(count / count.sum())


def score_words(words: DataFrame, weights: Weights) -> DataFrame:
    """The table of words with ``logp``, the log10 of each word's probability."""
    sent = words.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(sent.value)
        for batch in batches:
            logs = [lattice.log_probability(w) / LOG10 for w in _binary(batch["word"])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logs, pa.float64())], [*batch.schema.names, "logp"])

    ship(words.sparkSession)
    return words.mapInArrow(run, "word binary, n long, c long, logp double")


def _split(docs: DataFrame, hot: dict[bytes, tuple[int, float]]) -> DataFrame:
    """One row per document with sums over its hot words, and rows of other words with their documents."""
    sent = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words = {w: (c > 0, math.log10(c + 1), p) for w, (c, p) in sent.value.items()}
        numbers: dict[bytes, int] = {}
        owner, ids, counts = array("q"), array("q"), array("q")

        def pairs():
            """One row a word: its documents and how often it is in each."""
            own = np.frombuffer(owner, np.int64)
            order = np.argsort(own, kind="stable")
            edges = pa.array(np.searchsorted(own[order], np.arange(len(numbers) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(edges, pa.array(np.frombuffer(x, np.int64)[order])) for x in (ids, counts)]
            none = [pa.nulls(len(numbers), t) for t in _DOC_TYPES]
            return pa.RecordBatch.from_arrays([*none, pa.array(list(numbers), pa.binary()), *lists], _NAMES)

        for batch in batches:
            rows = []
            for rid, text in zip(batch["rid"].to_pylist(), _binary(batch["text"]), strict=True):
                found = words_of(text)
                known, base, score = 0, [], []
                for word, n in Counter(found).items():
                    entry = known_words.get(word)
                    if entry is None:
                        owner.append(numbers.setdefault(word, len(numbers)))
                        ids.append(rid)
                        counts.append(n)
                    else:
                        known += n * entry[0]
                        base.append(n * entry[1])
                        score.append(n * entry[2])
                rows.append((len(found) + 1, known, math.fsum(base), math.fsum(score)))
                if len(ids) >= HELD:
                    yield pairs()
                    numbers, owner, ids, counts = {}, array("q"), array("q"), array("q")
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), _DOC_TYPES[3:])]
            none = [pa.nulls(len(rows), t) for t in (pa.binary(), _LONGS, _LONGS)]
            yield pa.RecordBatch.from_arrays([batch["rid"], batch["doc_id"], batch["held_out"], *columns, *none], _NAMES)
        if numbers:
            yield pairs()

    ship(docs.sparkSession)
    return docs.mapInArrow(run, _SCHEMA)


_LONGS = pa.list_(pa.int64())
_SCHEMA = (
    "rid long, doc_id long, held_out boolean, n_tokens long, known long, base double, own_score double,"
    " word binary, rids array<long>, counts array<long>"
)
_NAMES = [f.strip().split(" ")[0] for f in _SCHEMA.split(",")]
_DOC_TYPES = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

_HIGH, _LOW = 2.0**20, 2.0**40


def _limbs(value: str, name: str) -> list[str]:
    """Sums of a double as whole numbers: exact to 2 ** -60, in any order."""
    scaled = f"({value}) * {_HIGH!r}D"
    return [f"sum(floor({scaled})) AS {name}_high", f"sum(floor(({scaled} - floor({scaled})) * {_LOW!r}D)) AS {name}_low"]


def _joined(name: str) -> str:
    return f"coalesce(({name}_high + {name}_low / {_LOW!r}D) / {_HIGH!r}D, 0D)"


def score(docs: DataFrame, held_out: Column, path: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``held_out`` is a condition on the rows that are not learnt from.
    """
    spark = docs.sparkSession
    words = materialise(word_table(docs, ~held_out), "words")
    ends = docs.filter(~held_out).count()
    sums = words.agg(F.sum("n").alias("n"), F.sum("c").alias("c"), F.expr("count_if(c > 0) AS kinds")).first()
    seen, kinds = (sums["c"] or 0) + ends, sums["kinds"] + (ends > 0)
    weights = learn(words, ends, vocabulary(path))
    scored = materialise(score_words(words, weights), "scored")
    share = (sums["n"] or 0) / HOT
    frequent = scored.filter((F.col("n") >= share) & (F.octet_length("word") <= HOT_BYTES))
    # Counts add up to the number of words: at most HOT of them reach the share.
    hot = {bytes(r["word"]): (r["c"], r["logp"]) for r in frequent.select("word", "c", "logp").collect()}
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", held_out.alias("held_out"), "text")
    parts = materialise(_split(rows, hot), "parts")
    pairs = parts.filter("word IS NOT NULL").select("word", "rids", "counts")
    pairs = pairs.join(scored.select("word", "c", "logp"), "word")
    pairs = pairs.selectExpr("c", "logp", "inline(arrays_zip(rids, counts))").withColumnsRenamed({"rids": "rid", "counts": "n"})
    rare = pairs.groupBy("rid").agg(
        *[F.expr(e) for e in ("sum(CASE WHEN c > 0 THEN n ELSE 0L END) AS rare_known", *_limbs("n * log10(c + 1D)", "rare"), *_limbs("n * logp", "sub"))]
    )
    total = math.log10(seen + kinds + 1)
    out = parts.filter("rid IS NOT NULL").select(*_NAMES[:7]).join(rare, "rid", "left")
    return out.selectExpr(
        "doc_id",
        "held_out",
        "n_tokens",
        f"known + coalesce(rare_known, 0L) + {int(ends > 0)}L AS n_known",
        f"{seen}L AS train_tokens",
        f"base + {_joined('rare')} + {math.log10(ends + 1)!r}D - n_tokens * {total!r}D AS base_score",
        f"own_score + {_joined('sub')} + {float(weights[1][-1]) / LOG10!r}D AS score",
    )


def op13_lattice(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fold(F.col("doc_id"), 7) == 2, vocabulary_path())
