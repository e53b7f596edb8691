"""A corpus pipeline over ``documents``: quality, toxicity, near duplicates, benchmark leaks, tokens.

All stages: an empty table stays empty, texts are read whole however long they are, further columns of any name pass through (the last
stage drops them). Rows that repeat are judged alike; only near duplicates keeps one of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm import bpe, decontaminate, quality, simhash, toxicity
from hourgrid.llm.common import prepare, table
from hourgrid.llm.queries import byte_model
from hourgrid.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules keep; null and empty texts go, as they have no words."""
    prepare(spark)
    return quality.accepted(docs)


def toxic_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; the model is learnt from the labelled documents among all that are left.

    Null and empty texts have no hits and stay; without labels of both kinds the seed words decide."""
    prepare(spark)
    labels = table(spark, sf_dir, "labels")
    return toxicity.accepted(docs, toxicity.learn(docs, labels, toxicity.held_out(labels["doc_id"])))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the least id; null ids come last. Texts without words are one group."""
    prepare(spark)
    return simhash.accepted(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null and empty texts stay, items without id count like others."""
    prepare(spark)
    return decontaminate.accepted(docs, table(spark, sf_dir, "benchmark"))


def byte_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of every document; null and empty texts have no tokens."""
    prepare(spark)
    out, name = bpe.digests(docs, byte_model(), public_tokenizers.PATTERN, carry=["doc_id"])
    return out.select(F.col("doc_id"), f"{name}.*")


STAGES = [("quality rules", quality_rules), ("toxicity", toxic_texts), ("near duplicates", near_duplicates),
          ("benchmark leaks", benchmark_leaks), ("byte-level tokens", byte_tokens)]
#: Posterior weights, learnt lexicons and digests are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each reading what the one before has written."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
