"""Texts of a regular build, on which polynomial hashes collide whatever their numbers are."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from voltfleet.llm import bpe, fmindex, rules, words

SWAP = str.maketrans("ab", "ba")


def thue_morse(n: int) -> tuple[str, str]:
    text = "a"
    while len(text) < n:
        text += text.translate(SWAP)
    return text, text.translate(SWAP)


ONE, TWO = thue_morse(2048)


@pytest.mark.parametrize("n", [64, 1024, 4096])
def test_runs_have_different_hashes(n):
    one, two = (np.frombuffer(t.encode(), np.uint8) for t in thue_morse(n))
    h = [words.run_hashes(t, np.array([0]), np.array([len(t)]))[0] for t in (one, two)]
    assert h[0] != h[1]


def test_hashes_follow_bytes_and_nothing_else():
    rng = np.random.default_rng(3)
    runs = [rng.integers(0, 3, rng.integers(1, 20)).astype(np.uint8).tobytes() for _ in range(4000)]
    data = np.frombuffer(b" ".join(runs), np.uint8)
    ends = np.cumsum([len(r) + 1 for r in runs]) - 1
    h = words.run_hashes(data, ends - [len(r) for r in runs], ends)
    assert len({(r, x) for r, x in zip(runs, h.tolist())}) == len(set(runs)) == len(set(h.tolist()))


def test_byte_bpe_reads_both(spark):
    docs = spark.createDataFrame([(1, f"x {ONE}"), (2, f"x {TWO}"), (3, ONE)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in bpe.digest(docs, bpe.ranks_path()).collect()}
    assert got[1]["ids_sha256"] != got[2]["ids_sha256"] and got[1]["decoded_sha256"] != got[2]["decoded_sha256"]


def test_decontamination_finds_only_its_own(spark):
    docs = spark.createDataFrame([(1, f"{ONE} end"), (2, f"{TWO} end")], "doc_id long, text string")
    items = spark.createDataFrame([("q", ONE)], "item_id string, text string")
    got = {r["doc_id"]: list(r["items"] or []) for r in fmindex.find(docs, items).collect()}
    assert got == {1: ["q"], 2: []}


def test_lines_that_differ_are_no_copies():
    found = rules.counts_of(next(words.scan(pa.array([f"{ONE}\n{TWO}", f"{ONE}\n{ONE}"]))))
    assert list(found["n_dup_lines"]) == [0, 1]


def test_shingles_differ():
    column = pa.array([f"{ONE} b c d e", f"{TWO} b c d e"])
    h = [next(iter(words.scan(column.slice(k, 1)))).windows(5)[1] for k in (0, 1)]
    assert len(h[0]) == len(h[1]) == 1 and h[0][0] != h[1][0]
