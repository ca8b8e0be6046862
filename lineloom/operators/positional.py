"""Anchors and windows of consecutive lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lineloom.operators.numbering import ranked


def stride(matches: DataFrame, quota: int) -> DataFrame:
    """Evenly spaced matches of each dataset, at most ``quota``, with their ordinal ``rn`` and pick ``k``."""
    step = F.greatest(F.lit(1).cast("bigint"), F.expr(f"n div {quota}"))
    return ranked(matches).withColumn("step", step).where(f"pmod(rn - 1, step) = 0 and (rn - 1) div step < {quota}").withColumn("k", F.expr("(rn - 1) div step").cast("int")).drop("step")


def context(lines: DataFrame, anchors: DataFrame, keys: list[str], before: int = 5, after: int = 5) -> DataFrame:
    """The lines around each anchor, clipped at the ends of its dataset.

    An anchor asks for its neighbours by number, so the range join is an equi-join
    on (dataset, line_number) and needs no broadcast, however many anchors there are.
    """
    wanted = anchors.select("dataset", *keys, F.col("line_number").alias("anchor"), F.explode(F.sequence(F.col("line_number") - before, F.col("line_number") + after)).alias("line_number"))
    return wanted.join(lines, ["dataset", "line_number"]).select("dataset", *keys, "anchor", "line_number", "text")


def chunk(lines: DataFrame, slots: int, size: int = 50) -> DataFrame:
    """For each slot ``size`` consecutive lines, from evenly spread starts."""
    counts = lines.groupBy("dataset").agg(F.max("line_number").alias("n"))
    starts = counts.select("dataset", "n", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    starts = starts.withColumn("start", F.expr(f"least(slot * greatest(1, n div {slots}), greatest(0, n - 1))")).withColumn("line_number", F.explode(F.expr(f"sequence(start + 1, start + {size})"))).select("dataset", "slot", "line_number")
    return starts.join(lines, ["dataset", "line_number"])


def budget_prefix(lines: DataFrame, keys: list[str], budget: int) -> DataFrame:
    """Whole lines from the start while their characters stay within the budget; one line at least."""
    order = Window.partitionBy(*keys).orderBy("line_number")
    return lines.withColumn("chars", F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("rn", F.row_number().over(order)).where((F.col("chars") <= budget) | (F.col("rn") == 1))


def slots(counts: DataFrame, target: int, per_slot: int = 3) -> DataFrame:
    """Even slots for what is missing to ``target``, the remainder to the first keys; ``counts`` is (key, n), a few rows."""
    every = Window.partitionBy(F.lit(0))
    total = F.sum("n").over(every)
    missing = F.expr(f"greatest(0, {target} - total) div {per_slot}")
    placed = counts.withColumn("total", total).withColumn("m", F.count(F.lit(1)).over(every)).withColumn("rn", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("key"))).withColumn("missing", missing)
    return placed.select("key", "n", F.expr("missing div m + if(rn <= missing % m, 1, 0)").alias("slots"))
