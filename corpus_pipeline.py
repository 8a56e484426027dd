"""From raw documents to token ids: five stages, each over all its predecessor kept.

A stage is a function of (spark, docs, sf_dir). ``run`` writes each stage's rows as Parquet
to the work folder and gives the written copy to the next one. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltfleet.llm import bpe, fmindex, near, pii, toxicity
from voltfleet.llm.frames import give_back, table
from voltfleet.sources.workspace import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance does not reject."""
    model = toxicity.train_on(docs, table(spark, sf_dir, "labels"))
    give_back()
    return toxicity.drop_toxic(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id."""
    return near.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages they share with the benchmark."""
    return fmindex.remove(docs, table(spark, sf_dir, "benchmark"))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    model = pii.train_on(docs)
    give_back()
    return pii.mask(docs, model)


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, ids as little-endian unsigned 32-bit integers, digest of what they decode to."""
    ids = bpe.encode(docs, bpe.ranks_path())
    return ids.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", one_of_each),
    ("decontamination", decontaminate),
    ("pii", mask_pii),
    ("byte_bpe", to_ids),
]

#: Compression lengths, a trained tagger and merges over bytes are beyond SQL; tests/llm checks the run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
