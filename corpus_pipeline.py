"""From raw documents to packed token windows: one operator of `millrace.llm` a stage.

`run` applies the stages to `documents`; what a stage returns is written as Parquet in the shared folder and
read again as the next one's documents. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import cut, held_out, table
from millrace.llm.grace_dedup import deduplicated
from millrace.llm.langid import learn, understood
from millrace.llm.mixing import mixed
from millrace.llm.ngram_join import one_of_each_group
from millrace.llm.packing import pack

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; filters and levels are learned from the stage's own labelled rows."""
    return understood(docs, learn(docs.filter(~held_out(F.col("doc_id")))))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return deduplicated(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each_group(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of tokens."""
    return pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("ngram_join", ngram_join),
    ("mixing", mixing),
    ("packing", packing),
]

# Learned filters, groups by reachability and tokens are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
