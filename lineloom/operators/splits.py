"""Leak-proof dev and test splits over an evidence graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.functions import text as X
from lineloom.operators.components import connected_components


def record_edges(refs: DataFrame) -> DataFrame:
    """Groups that one record cites together, as a star around the smallest; refs are (id, dataset, line_number, group_id)."""
    hub = refs.groupBy("id").agg(F.min("group_id").alias("hub"))
    return refs.join(hub, "id").where("group_id <> hub").select(F.col("hub").alias("src"), F.col("group_id").alias("dst")).distinct()


def line_edges(refs: DataFrame) -> DataFrame:
    """Groups that cite the same line, as a star around the smallest."""
    hub = refs.where("dataset is not null and line_number is not null").groupBy("dataset", "line_number").agg(F.min("group_id").alias("hub"))
    return refs.join(hub, ["dataset", "line_number"]).where("group_id <> hub").select(F.col("hub").alias("src"), F.col("group_id").alias("dst")).distinct()


def group_components(refs: DataFrame) -> DataFrame:
    """``(group_id, component)``, named by the smallest group."""
    found = connected_components(record_edges(refs).unionByName(line_edges(refs)))
    return refs.select("group_id").distinct().join(found.withColumnRenamed("node", "group_id"), "group_id", "left").withColumn("component", F.coalesce("component", "group_id"))


def record_splits(refs: DataFrame, fraction: float = 0.2) -> DataFrame:
    """``(id, component, split)`` of every record with evidence."""
    named = refs.join(group_components(refs), "group_id").groupBy("id").agg(F.min("component").alias("component"))
    return named.withColumn("split", X.test_split(F.col("component"), fraction))
