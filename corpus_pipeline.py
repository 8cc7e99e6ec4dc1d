"""Preparation of a training corpus: five stages, each written and read again by the next.

Toxic documents go, one document of each group of near duplicates stays, documents that hold
benchmark items go, personal data get surrogates, and what is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dqlake.llm import decontam, ngram_join, packing, pii, toxicity
from dqlake.llm.common import keep
from dqlake.llm.queries import DEMO_KEY, TOXIC_FROM, fold, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The classifier learns from the labelled rows outside its held-out fold."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~fold(4))
    return toxicity.score(docs.select(*COLUMNS), model).where(f"toxicity < {TOXIC_FROM}").drop("toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words a shingle, similarity from 0.8; of a group the smallest doc_id stays."""
    return ngram_join.one_of_each(docs.select(*COLUMNS), 5, 80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_benchmark(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """n_chars follows the new text."""
    return pii.pseudonymise(docs.select(*COLUMNS), DEMO_KEY).selectExpr(
        "doc_id", "text", "lang", "source", "CASE WHEN n_chars IS NOT NULL AND text IS NOT NULL THEN CAST(length(text) AS BIGINT) ELSE n_chars END AS n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("pii", replace_personal_data),
    ("packing", pack_sequences),
]

#: The stages train a model, hash with a key and tokenise, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
