"""A training corpus in five stages.

Each stage takes what its predecessor kept and gives whole documents on; the
last one says where each document goes. Toxic documents go first, then all but
one document of each class of near-duplicates, then documents in which a
benchmark item is found; sources are mixed to their weights (documents of a
source may repeat, and one of each source may be cut to fit), and the mix is
put into shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterbell.llm.decontamination import without_leaks
from quarterbell.llm.mixing import mixed_documents
from quarterbell.llm.nearduplicates import without_near_duplicates
from quarterbell.llm.sharding import shard_documents
from quarterbell.llm.tables import saved, table
from quarterbell.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not rejected as toxic."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each row of the mix."""
    return shard_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Most stages can't be said in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each gives is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
