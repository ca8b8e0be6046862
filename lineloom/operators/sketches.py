"""Sketches by dataset and hour, stored once and merged when they are read.

A row of the rollup holds what any span of hours needs of its hour: rows, a HyperLogLog
sketch of distinct ids, a KLL sketch of values and the counters of frequent items. Rows
merge into longer spans without the events. All four are of bounded size, so a hot
dataset costs partial aggregates of its hours, never its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the HyperLogLog registers, the KLL size, the most items that are tracked.
BITS, K, ITEMS = 14, 800, 1000
#: Bounds that estimates hold with near certainty: 6 standard errors of 1.04 / sqrt(2^BITS); rank error of KLL at K, with a margin of 3.
DISTINCT_ERROR, RANK_ERROR = 6 * 1.04 / 2 ** (BITS / 2), 0.015
#: KLL sketches are merged in groups of FAN hours, then FAN of those, and what LEVELS - 1 such steps leave, some 30 for a century, at once.
FAN, LEVELS = 32, 4


def rollup(events: DataFrame, dataset: str, time: str, distinct: str, value: str, item: str | Column) -> DataFrame:
    """``(dataset, hour, n, ids, values, items)``: one row for each dataset and hour (long, since 1970).

    Nulls count in ``n`` and in no sketch; a null dataset is one of its own, rows without
    a time are left out. ``value`` is a double, ``item`` anything that can be counted.
    """
    item = F.col(item) if isinstance(item, str) else item
    rows = events.where(F.col(time).isNotNull()).select(
        F.col(dataset).alias("dataset"), F.floor(F.unix_micros(F.col(time).cast("timestamp")) / 3_600_000_000).alias("hour"), F.col(distinct).alias("id"), F.col(value).cast("double").alias("value"), item.alias("item")
    )
    return rows.groupBy("dataset", "hour").agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("id", BITS).alias("ids"), F.kll_sketch_agg_double("value", K).alias("values"), F.expr(f"approx_top_k_accumulate(item, {ITEMS})").alias("items")
    )


def merged(hours: DataFrame) -> DataFrame:
    """``(dataset, n, ids, values, items)``: the rows of a rollup, or of any span of it, as one for each dataset."""
    whole = hours.groupBy("dataset").agg(F.sum("n").alias("n"), F.hll_union_agg("ids").alias("ids"), F.expr(f"approx_top_k_combine(items, {ITEMS})").alias("items"))
    values = hours.select("dataset", F.col("hour").alias("part"), "values")
    for level in range(LEVELS):
        some = F.collect_list("values")
        both = F.aggregate(F.slice(some, 2, F.greatest(F.size(some) - 1, F.lit(0))), F.get(some, F.lit(0)), F.kll_sketch_merge_double)
        values = values.groupBy("dataset", (F.floor(F.col("part") / FAN) if level < LEVELS - 1 else F.lit(0)).alias("part")).agg(both.alias("values"))
    values = values.select(F.col("dataset").alias("of"), "values")
    return whole.join(values, F.col("dataset").eqNullSafe(F.col("of"))).drop("of")


def estimates(whole: DataFrame, ranks: tuple[float, ...] = (0.5, 0.9, 0.99), top: int = 5) -> DataFrame:
    """``(dataset, n, distinct, quantiles, frequent)`` of merged rows; quantiles are those at ``ranks``, null without values, frequent (item, count) pairs."""
    some = F.kll_sketch_get_n_double("values") > 0  # an empty sketch has no quantiles
    at = F.array(*[F.when(some, F.kll_sketch_get_quantile_double("values", F.lit(r))) for r in ranks])
    return whole.select("dataset", "n", F.hll_sketch_estimate("ids").alias("distinct"), at.alias("quantiles"), F.expr(f"approx_top_k_estimate(items, {top})").alias("frequent"))
