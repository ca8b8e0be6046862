"""Entities in lines: grouping, co-occurrence, salience."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lineloom.functions import text as X
from lineloom.storage import Cut


def keyed(lines: DataFrame, pattern: str, name: str = "key") -> DataFrame:
    """Lines with the first match of the pattern's group; lines without one go."""
    return lines.withColumn(name, X.group_key(F.col("text"), pattern)).where(F.col(name).isNotNull())


def large_groups(rows: DataFrame, key: str, least: int) -> DataFrame:
    return rows.groupBy("dataset", key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def comparative_sets(groups: DataFrame, size: int, most: int) -> DataFrame:
    """Consecutive sets of ``size`` groups by falling count, whole sets only, ``most`` of each dataset."""
    ranked = groups.withColumn("rn", F.row_number().over(Window.partitionBy("dataset").orderBy(F.desc("n"), "key"))).where(F.col("rn") <= size * most)
    sets = ranked.withColumn("set_id", F.expr(f"(rn - 1) div {size}").cast("int"))
    return sets.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("dataset", "set_id"))).where(F.col("m") == size).drop("m")


def proven_pairs(lines: DataFrame, pattern_a: str, pattern_b: str, least: int) -> DataFrame:
    """Distinct pairs that stand on one line and are both in ``least`` lines of the dataset, with their rank.

    Pairs rank by their lines, most first. Ranks are prefix sums over how many pairs
    have each number of lines, so no task holds all pairs of a dataset.
    """
    rows = lines.withColumn("a", X.group_key(F.col("text"), pattern_a)).withColumn("b", X.group_key(F.col("text"), pattern_b))
    na, nb = (large_groups(rows.where(F.col(k).isNotNull()), k, least).withColumnRenamed("n", f"n{k}") for k in ("a", "b"))
    pairs = rows.where("a is not null and b is not null").select("dataset", "a", "b").distinct().join(na, ["dataset", "a"]).join(nb, ["dataset", "b"]).withColumn("both", F.col("na") + F.col("nb"))
    totals = pairs.groupBy("dataset", "both").agg(F.count(F.lit(1)).alias("total"))
    before = Window.partitionBy("dataset").orderBy(F.desc("both")).rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("dataset", "both", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("dataset", "both").orderBy("a", "b"))
    return pairs.withColumn("inside", inside).join(first, ["dataset", "both"]).select("dataset", "a", "b", "na", "nb", (F.col("first") + F.col("inside")).alias("rk"))


def greedy_matching(pairs: DataFrame, most: int | None = None) -> DataFrame:
    """The pairs that taking them by rank, each end once, would take; the first ``most`` of each dataset if given.

    In each round every pair that ranks first at both of its ends is taken, and the
    pairs that share an end with it go. The best pair left is always taken, so rounds
    end, at the latest with as many as there are pairs; in practice they are few.
    Rounds are written to shared storage.
    """
    left, rows = Cut(pairs, "pairs"), []
    while True:
        p = left.df
        best = p.withColumn("ba", F.min("rk").over(Window.partitionBy("dataset", "a"))).withColumn("bb", F.min("rk").over(Window.partitionBy("dataset", "b")))
        won = Cut(best.where("rk = ba and rk = bb").drop("ba", "bb"), "won")
        if not won.df.head(1):
            break
        rows.append(won.df)
        after = Cut(p.join(won.df.select("dataset", "a"), ["dataset", "a"], "left_anti").join(won.df.select("dataset", "b"), ["dataset", "b"], "left_anti").select(*pairs.columns), "pairs")
        left.drop()
        left = after
    taken = reduce(DataFrame.unionByName, rows) if rows else pairs.limit(0)
    if most is None:
        return taken
    return taken.withColumn("nth", F.row_number().over(Window.partitionBy("dataset").orderBy("rk"))).where(F.col("nth") <= most).drop("nth")


def salient(rows: DataFrame, keys: list[str], cap: int) -> DataFrame:
    """The most telling lines of each group, at most ``cap``, with their ``position`` in it (from 0) and ``score``.

    First and last lines score 100; a keyword 2, and 1 more if it differs from that of
    the last line with one; a digit template seen before in the group costs 1. Groups
    within the cap are kept whole.
    """
    by = Window.partitionBy(*keys)
    order = by.orderBy("line_number")
    x = rows.withColumn("position", F.row_number().over(order) - 1).withColumn("size", F.count(F.lit(1)).over(by)).withColumn("category", X.salience(F.col("text"))).withColumn("template", X.template(F.col("text")))
    x = x.withColumn("last_category", F.last("category", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))).withColumn("seen", F.row_number().over(Window.partitionBy(*keys, "template").orderBy("line_number")) > 1)
    ends = (F.col("position") == 0) | (F.col("position") == F.col("size") - 1)
    fresh = F.col("category").isNotNull() & ~F.col("category").eqNullSafe(F.col("last_category"))
    score = F.when(ends, 100).otherwise(0) + F.when(F.col("category").isNotNull(), 2).otherwise(0) + fresh.cast("int") - F.col("seen").cast("int")
    ranked = x.withColumn("score", score).withColumn("rn", F.row_number().over(by.orderBy(F.desc("score"), "position")))
    return ranked.where((F.col("size") <= cap) | (F.col("rn") <= cap)).drop("rn", "template", "last_category", "seen")


#: What stands between lines of a group that don't follow each other.
GAP = "  ... (more lines follow between these) ...\n"


def gap_blocks(kept: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One text for each group of :func:`salient` lines, with a marker where lines are left out."""
    before = F.lag("position").over(Window.partitionBy(*keys).orderBy("position"))
    piece = F.when(F.col("before").isNotNull() & (F.col("position") != F.col("before") + 1), F.concat(F.lit(GAP), "text")).otherwise(F.col("text"))
    pieces = kept.withColumn("before", before).withColumn("piece", piece).groupBy(*keys).agg(F.count(F.lit(1)).alias("shown"), F.array_sort(F.collect_list(F.struct("position", "piece"))).alias("pieces"))
    head = F.concat(F.lit("[Group: "), F.col(name), F.lit("] "), F.col("shown").cast("string"), F.lit(" line(s):\n"))
    return pieces.select(*keys, "shown", F.concat(head, F.array_join(F.transform("pieces", lambda p: p.piece), "\n")).alias("block"))
