"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows stand in virtual partitions. How many rows each partition sends to each shard
is drawn exactly: the matrix of counts has the partition sizes and the shard sizes
as its margins and the distribution that a uniform permutation of all rows would
give it. Each partition permutes its rows and sends consecutive runs of the drawn
lengths; each shard permutes what arrives. Every order of all rows is equally
likely, and shard counts are at most one apart whatever the draws.

Scale. Only narrow rows move: they are written once to shared storage together
with their random keys, so a repeated task sees the same keys. The matrix has
``partitions x shards`` counts, drawn on the driver from the partition sizes and
nothing else; partitions number at most ``PARTITIONS``. Shards are permuted in
segments of their random keys, so no task sorts a whole shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lineloom.storage import cut

SHARDS, SEED, PARTITIONS, ROWS, EXACT = 16, 20, 65536, 4096, 500_000_000


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good."""
    if good + bad < EXACT:
        return int(rng.hypergeometric(good, bad, n)) if n else 0
    lo, hi = max(0, n - bad), min(n, good)  # large urns: inversion over the window that holds all but 1e-30 of the mass
    mean, total = n * good / (good + bad), good + bad
    width = 12 * np.sqrt(mean * (bad / total) * max(0.0, (total - n) / (total - 1))) + 40
    k = np.arange(max(lo, int(mean - width)), min(hi, int(mean + width)) + 1, dtype=np.float64)
    up = np.log((good - k[:-1]) * (n - k[:-1])) - np.log((k[:-1] + 1) * (bad - n + k[:-1] + 1))
    logs = np.concatenate([[0.0], np.cumsum(up)])
    mass = np.cumsum(np.exp(logs - logs.max()))
    return int(k[np.searchsorted(mass, rng.random() * mass[-1], side="right")])


def communication_matrix(sizes: list[int], shards: list[int], seed: int = SEED) -> list[list[int]]:
    """Counts with row sums ``sizes`` and column sums ``shards``, as a uniform permutation of all rows gives them."""
    rng, left, out = np.random.default_rng(seed), list(shards), []
    for n in sizes:
        row, rest, open_ = [], n, sum(left)
        for s, room in enumerate(left):
            open_ -= room
            row.append(rest if s == len(left) - 1 else _hypergeometric(rng, room, open_, rest))
            rest -= row[-1]
        left = [a - b for a, b in zip(left, row, strict=True)]
        out.append(row)
    return out


def shard_sizes(n: int, shards: int) -> list[int]:
    """Sizes that add up to ``n`` and are at most one apart."""
    return [n // shards + (s < n % shards) for s in range(shards)]


def shuffle_into_shards(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Adds ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard) to every row.

    Pass narrow rows (keys, sizes, digests), as all columns move twice. Nulls,
    repeated rows and rows without any key are dealt like all others; input columns
    named ``shard`` or ``slot`` are replaced. With fewer rows than shards some
    shards are empty; an empty table stays empty.
    """
    spark = rows.sparkSession
    data = [c for c in rows.columns if c not in ("shard", "slot")]
    keyed = cut(rows.select(F.struct(*data).alias("row"), F.rand(seed).alias("a"), F.rand(seed + 1).alias("b"), F.rand(seed + 2).alias("c")), "keyed")
    n = keyed.count()
    partitions = int(min(PARTITIONS, max(1, n // ROWS)))
    keyed = keyed.withColumn("part", F.floor(F.col("a") * partitions).cast("int"))
    sizes = {r.part: r.n for r in keyed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each virtual partition
    matrix = communication_matrix([sizes.get(p, 0) for p in range(partitions)], shard_sizes(n, shards), seed)
    ends = spark.createDataFrame([(p, np.cumsum(row).tolist()) for p, row in enumerate(matrix)], "part int, ends array<long>")

    local = keyed.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy("b", "c")))
    sent = local.join(F.broadcast(ends), "part").withColumn("shard", F.size(F.filter("ends", lambda e: e < F.col("at"))))  # at most PARTITIONS x shards counts
    segments = max(1, n // shards // ROWS)
    sent = sent.withColumn("segment", F.floor(F.col("c") * segments).cast("int"))
    counts = sent.groupBy("shard", "segment").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("start", F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("shard", "segment", "start")
    placed = sent.withColumn("r", F.row_number().over(Window.partitionBy("shard", "segment").orderBy("c", "b")))
    return placed.join(before, ["shard", "segment"]).select("row.*", "shard", (F.col("start") + F.col("r") - 1).cast("long").alias("slot"))


def document_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``(id_col, size, text_crc32, law, shard, slot, grown_shard)`` of every document.

    The law is ``rows``: shard counts are at most one apart. ``size`` is the UTF-8
    bytes of the text (null: none) plus 1; the checksum of a null text is that of
    an empty one. ``grown_shard`` is null, as a further shard deals all rows anew.
    """
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    narrow = docs.select(F.col(id_col), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    placed = shuffle_into_shards(narrow, shards, seed)
    return placed.select(id_col, "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
