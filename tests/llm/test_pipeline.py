"""The corpus pipeline on the smallest tables, and the registered queries."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
import tiktoken

import corpus_pipeline
from conftest import SF_SMALL
from voltfleet.llm import bpe, fmindex, near, pii, queries
from voltfleet.llm.frames import table
from voltfleet.sources.workspace import materialise


def test_stages(spark):
    docs, kept = table(spark, SF_SMALL, "documents"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF_SMALL), name)
        kept[name] = docs
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "byte_bpe"]
    assert all(df.columns == columns for n, df in kept.items() if n != "byte_bpe")
    assert near.near_classes(kept["near_duplicates"]).filter("n_links > 0").count() == 0
    clean = fmindex.find(kept["decontamination"], table(spark, SF_SMALL, "benchmark"))
    assert clean.filter("hit IS NOT NULL").count() == 0
    texts = {r["doc_id"]: r["text"] or "" for r in kept["pii"].collect()}
    assert not any(pii.base_spans(t) for t in texts.values())
    ranks = bpe.Ranks.read(bpe.ranks_path())
    import public_tokenizers

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ids, special_tokens={})
    for r in kept["byte_bpe"].collect():
        want = library.encode_ordinary(texts[r["doc_id"]])
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want)


def test_last_stage_decodes_its_ids(spark):
    texts = ["some words, 12.5 éß", None, "", "x" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.to_ids(spark, docs, SF_SMALL).collect()}
    assert found == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(texts)}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    from check_oracles import compare, duck

    assert compare(queries.QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), queries.ORACLES[name]) is None


def test_language_on_held_out_rows(spark):
    found = queries.QUERIES["op10_language"](spark, SF_SMALL)
    joined = found.join(table(spark, SF_SMALL, "documents").select("doc_id", "lang"), "doc_id").filter("held_out AND lang IS NOT NULL")
    right, total = joined.filter("lang = lang_pred").count(), joined.count()
    assert right >= 0.9 * total
