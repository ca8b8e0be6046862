"""Connected components by alternating star contraction.

Each round is a handful of shuffles on narrow edges. A large-star step hangs the
larger neighbours of every node on its smallest neighbour, a small-star step does
the same for the smaller ones; after O(log n) rounds every component is one star
around its smallest node. Hubs cause no oversized task: minima are pre-aggregated
on the map side, and the join back is one that adaptive execution can split.
Every round is written to shared storage, so lineage stays short and a lost
executor costs at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.storage import Cut


def _sign(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """One row ``(node, component)`` for every node that has an edge to another.

    ``component`` is the smallest node reachable. Loops and edges with a null end
    are ignored, repeated edges count once; nodes without edges get no row.
    """
    a, b = F.col(src), F.col(dst)
    now = Cut(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    sign = _sign(now.df)
    for _ in range(max_rounds):
        if not sign[0]:
            break
        e = now.df
        both = e.select(F.col("u").alias("n"), F.col("v").alias("x")).unionByName(e.select(F.col("v").alias("n"), F.col("u").alias("x")))
        least = both.groupBy("n").agg(F.min("x").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = both.where("x > n").join(least, "n").select(F.col("x").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lower, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        after = Cut(small, "edges")
        now.drop()
        now, before, sign = after, sign, _sign(after.df)
        if sign == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = now.df
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
