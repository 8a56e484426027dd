"""The Merkle manifest against a plain recursive one."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from voltfleet.llm import merkle

FIELDS = merkle.FIELDS


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row: dict) -> str:
    return H(*("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS))


def plain(leaves: list[str]) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    """Root, and per leaf the siblings left and right of its way up."""
    level, ways, at = leaves, [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[i : i + 3] for i in range(0, len(level), 3)]
        for way, k in zip(ways, at):
            way.append((runs[k // 3][: k % 3], runs[k // 3][k % 3 + 1 :]))
        level, at = [H(*run) for run in runs], [k // 3 for k in at]
    return level[0], ways


def brute(rows: list[dict]) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        changed = dict(row)
        if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0 and row["text"] is not None:
            changed["text"] = row["text"].replace("\n", "")
        groups.setdefault(row["source"], []).append((row["doc_id"], leaf_of(row), leaf_of(changed)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    out, subroots = [], []
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        subroots.append(plain([r[1] for r in groups[name]]))
    root, crown = plain([s[0] for s in subroots])
    for name, (subroot, ways), above in zip(names, subroots, crown):
        for (doc_id, leaf, altered), way in zip(groups[name], ways):
            folded, siblings = altered, []
            for left, right in way + above:
                folded = H(*left, folded, *right)
                siblings += left + right
            out.append((doc_id, leaf, subroot, root, H(*siblings), folded, folded == root))
    return sorted(out, key=str)


def docs_of(spark, rows: list[tuple]):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, root string, pos int")


def run(spark, tmp_path, docs, monkeypatch, height: int) -> list[tuple]:
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle.manifest, "__defaults__", (height,))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in merkle.op11_manifest(spark, str(tmp_path)).collect()), key=str)


@pytest.mark.parametrize("height", [1, 2, 8])
def test_manifest_is_the_plain_one(spark, tmp_path, monkeypatch, height):
    rows = [(i, "hot" if i % 2 else f"s{i % 7}", "en", i, f"line {i}\nnext", "r", 1) for i in range(60)]
    rows += [(100, None, None, None, None, None, None), (101, None, "de", 0, "", "r", 2), (None, "é", "xx", 3, "a\n\nb", "r", 3)]
    rows += [(3, "hot", "en", 3, "line 3\nnext", "r", 1)] * 2 + [(3, "hot", "en", 3, "other", "r", 1), (7, "alone", "en", -4, "x\n" * 30_000, "r", 0)]
    docs = docs_of(spark, rows)
    expected = brute([r.asDict() for r in docs.collect()])
    found = run(spark, tmp_path, docs.repartition(3), monkeypatch, height)
    assert found == expected
    assert any(not r[6] for r in found) and any(r[6] for r in found)


@pytest.mark.parametrize("rows", [[], [(5, "one", "en", 1, "only", "r", 0)]])
def test_empty_and_single_tables(spark, tmp_path, monkeypatch, rows):
    docs = docs_of(spark, rows)
    found = run(spark, tmp_path, docs, monkeypatch, 2)
    assert found == (brute([r.asDict() for r in docs.collect()]) if rows else [])
    if rows:  # a lone leaf is its own subroot and root, and has no siblings
        assert found[0][1] == found[0][2] == found[0][3] and found[0][4] == H("")


def test_the_queue_holds_a_few_messages_a_level():
    held, push = [], merkle.heappush
    try:
        merkle.heappush = lambda q, x: (push(q, x), held.append(len(q)))
        found = merkle.sweep([H(str(i)) for i in range(2000)], 7)
    finally:
        merkle.heappush = push
    assert len(found[-1]) == 1 and max(held) <= 3 * 7
