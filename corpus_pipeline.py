"""A corpus from raw documents to token ids: quality rules, near copies, secrets, mixture, encoding.

Every stage takes what its predecessor kept. ``STAGES`` names them in order; ``run`` applies them to ``documents`` and writes each
result below the shared folder, as a stage reads its input more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakekit.llm import jaccard, mixing, pieces_codec, quality, queries, secrets
from lakekit.llm.common import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep (operator 9)."""
    return quality.filter_documents(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id (operator 2): four fifths of their 5-word shingles in common."""
    return jaccard.keep_one(docs, rule=jaccard.Rule(words=5, part=80))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark (operator 10); n_chars follows."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of sources (operator 4) for as many tokens as there are; scarce leaves are read up to three times."""
    return mixing.mix(docs, 1.0, queries.DOMAIN, weights=queries.WEIGHTS, epochs=3)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (operator 8)."""
    return pieces_codec.encode(docs, keep=("doc_id", "lang", "source"))


STAGES = [("quality_rules", keep_good), ("near_copies", one_of_each_group), ("secrets", without_secrets), ("mixture", mixed), ("encoding", encoded)]
ORACLE_SQL = None  # the groups, the network and the encoder are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
