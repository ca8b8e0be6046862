"""A training corpus in five stages, each one of the library's operators.

Every stage gets what its predecessor kept, as Parquet in shared storage, and its
decisions take effect: rejected documents, further copies and contaminated documents
go, the mix repeats or leaves out documents, and the last stage deals the rest to
shards. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lineloom.llm import decontam, mixing, quality, sharding, simhash
from lineloom.session import ship, table
from lineloom.storage import cut


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.keep_one_similar(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take_mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.document_shards(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("source mixing", mixed_sources),
    ("sharding", sharded),
]

#: The classifier and the fingerprints are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``sf_dir`` through all stages."""
    rows = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        rows = cut(stage(spark, rows, sf_dir), f"stage{number}")
    return rows
