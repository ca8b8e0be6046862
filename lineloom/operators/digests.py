"""A tree of digests over ranges of lines: two corpora are compared where they differ.

A leaf is ``LEAF`` numbers of a dataset; its digest is of the sums of its lines' SHA-256,
each cut into four parts, so lines are combined before they move and no task holds a
dataset, however often a number is repeated. A node of the next level is the digest of
at most ``FAN`` nodes. Levels are Parquet tables; a comparison goes down from the
highest, only below nodes that differ, one join of narrow rows for each level.

Lines without a number are a leaf of their own. Leaves also say whether their numbers
are as they should be, so numbering is told without reading lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineloom.functions import text as X
from lineloom.operators.validation import line_difference, numbering_flaws
from lineloom.sources.store import coarse_ranges
from lineloom.storage import Cut

#: Lines of a leaf, nodes below a node, the leaf of lines without a number.
LEAF, FAN, UNNUMBERED = 256, 16, -(1 << 48)
_NODES = "dataset string, node long, digest string, level int"
_STATS = "dataset string, node long, n long, lo long, hi long, distinct long"


def leaf_of(number: Column) -> Column:
    return F.coalesce(F.floor((number.cast("long") - 1) / LEAF), F.lit(UNNUMBERED))


class DigestTree:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.height = self.spark.read.schema(_NODES).parquet(f"{self.path}/nodes").agg(F.max("level")).first()[0] or 0

    def nodes(self, level: int) -> DataFrame:
        """``(dataset, node, digest)`` of a level; 0 are the leaves."""
        return self.spark.read.schema(_NODES).parquet(f"{self.path}/nodes").where(F.col("level") == level).drop("level")

    def stats(self) -> DataFrame:
        """``(dataset, node, n, lo, hi, distinct)`` of the leaves: lines, smallest and largest number, different numbers."""
        return self.spark.read.schema(_STATS).parquet(f"{self.path}/stats")

    def roots(self) -> DataFrame:
        """``(dataset, corpus_sha256)``: the digest of each dataset, of its nodes of the highest level."""
        return self.nodes(self.height).groupBy("dataset").agg(_over("node", "digest").alias("corpus_sha256"))


def _over(node: str, digest: str) -> Column:
    """One digest of a few nodes with their places."""
    return X.digest(F.to_json(F.array_sort(F.collect_list(F.struct(node, digest)))))


def build(lines: DataFrame, path: str) -> DigestTree:
    """Writes the tree of ``lines`` (dataset, line_number, text)."""
    spark, number = lines.sparkSession, F.col("line_number").cast("long")
    own = F.sha2(F.concat(F.coalesce(number.cast("string"), F.lit("?")), F.when(F.col("text").isNull(), "-").otherwise("+"), F.coalesce("text", F.lit(""))), 256)
    rows = lines.select("dataset", leaf_of(number).alias("node"), number.alias("number"), own.alias("own"), F.pmod(number - 1, F.lit(LEAF)).cast("int").alias("place"))
    lanes = [F.sum(F.conv(F.substring("own", at, 15), 16, 10).cast("decimal(20,0)")).alias(f"lane{at}") for at in (1, 16, 31, 46)]
    places = [F.bit_or(F.when(F.floor(F.col("place") / 64) == k, F.expr("shiftleft(1L, place % 64)")).otherwise(F.lit(0).cast("long"))).alias(f"has{k}") for k in range(LEAF // 64)]
    leaves = rows.groupBy("dataset", "node").agg(F.count(F.lit(1)).alias("n"), F.min("number").alias("lo"), F.max("number").alias("hi"), *lanes, *places)
    leaves = leaves.select("dataset", "node", "n", "lo", "hi", sum(F.coalesce(F.bit_count(f"has{k}"), F.lit(0)) for k in range(LEAF // 64)).cast("long").alias("distinct"), X.digest(F.concat_ws(",", "n", *[f"lane{at}" for at in (1, 16, 31, 46)])).alias("digest"))
    held = Cut(leaves, "leaves")
    held.df.drop("digest").write.parquet(f"{path}/stats")
    nodes, level = held.df.select("dataset", "node", "digest"), 0
    while True:
        nodes.write.parquet(f"{path}/nodes/level={level}")
        nodes = spark.read.schema("dataset string, node long, digest string").parquet(f"{path}/nodes/level={level}")
        least, most = nodes.where(F.col("node") > UNNUMBERED // 2).agg(F.min("node"), F.max("node")).first() if level == 0 else (least, most)
        if most is None or (least // FAN**level, most // FAN**level) in ((0, 0), (-1, -1), (-1, 0)):
            break
        nodes, level = nodes.groupBy("dataset", F.floor(F.col("node") / FAN).alias("up")).agg(_over("node", "digest").alias("digest")).select("dataset", F.col("up").alias("node"), "digest"), level + 1
    held.drop()
    return DigestTree(spark, path)


def _descend(a: DigestTree, b: DigestTree, first: bool) -> tuple[DataFrame, list[int]]:
    """Leaves ``(dataset, node)`` that differ, or just the first of each dataset, and how many nodes each level compared, from the highest on."""
    above, compared = None, []
    for level in range(min(a.height, b.height), -1, -1):
        x, y = (t.nodes(level).select(F.col("dataset").alias(f"d{k}"), F.col("node").alias(f"n{k}"), F.col("digest").alias(f"s{k}")) for k, t in enumerate((a, b)))
        if above is not None:
            x, y = (s.join(above, F.col(f"d{k}").eqNullSafe(F.col("dataset")) & (F.floor(F.col(f"n{k}") / FAN) == F.col("node")), "left_semi") for k, s in enumerate((x, y)))
        both = x.join(y, F.col("d0").eqNullSafe(F.col("d1")) & (F.col("n0") == F.col("n1")), "full_outer")
        side = F.col("n0").isNotNull()
        both = both.select(F.when(side, F.col("d0")).otherwise(F.col("d1")).alias("dataset"), F.coalesce("n0", "n1").alias("node"), (~F.col("s0").eqNullSafe(F.col("s1"))).alias("differs"))
        met = Cut(both, f"level{level}")
        compared.append(met.df.count())
        above = met.df.where("differs").select("dataset", "node")
        above = above.groupBy("dataset").agg(F.min("node").alias("node")) if first else above
    return above, compared


def differing_leaves(a: DigestTree, b: DigestTree) -> DataFrame:
    """``(dataset, node)``: the leaves that aren't the same in both."""
    return _descend(a, b, False)[0]


def first_difference(a: DigestTree, b: DigestTree) -> tuple[DataFrame, list[int]]:
    """``(dataset, lo, hi)``, the numbers of the first leaf of each dataset that differs, and how many nodes each level compared: at most ``FAN`` of a dataset below the highest level. A leaf of lines without a number comes first, with null bounds."""
    leaves, compared = _descend(a, b, True)
    numbered = F.col("node") > UNNUMBERED // 2
    return leaves.select("dataset", F.when(numbered, F.col("node") * LEAF + 1).alias("lo"), F.when(numbered, (F.col("node") + 1) * LEAF).alias("hi")), compared


def difference(a: DigestTree, read_a, b: DigestTree, read_b) -> DataFrame:
    """``(dataset, problem, line_number, n)`` as ``validation.corpus_difference`` gives it, from the lines of differing leaves alone.

    ``read_a`` and ``read_b`` give the lines of ranges (dataset, lo, hi), some hundreds
    at most; what they give beyond is left out here. Lines without a dataset or a number
    equal no other line; they are told only where their leaves differ.
    """
    leaves = Cut(differing_leaves(a, b), "differing").df
    numbered = leaves.where(F.col("node") > UNNUMBERED // 2)
    loose = leaves.where(F.col("node") <= UNNUMBERED // 2).limit(1).count() > 0
    ranges = None if loose else coarse_ranges(numbered, "node", LEAF)  # no range has lines without a number
    wanted = leaves.select(F.col("dataset").alias("of"), "node")
    own = [read(ranges).join(wanted, F.col("dataset").eqNullSafe(F.col("of")) & (leaf_of(F.col("line_number")) == F.col("node")), "left_semi") for read in (read_a, read_b)]
    each = a.stats().groupBy("dataset").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), (F.sum("n") > F.sum("distinct")).alias("repeats"))
    found = line_difference(*own)
    return found.unionByName(numbering_flaws(each, found.schema["line_number"].dataType))
