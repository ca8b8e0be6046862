"""Tables replayed as streams, and streams that catch up with what has arrived.

A stream here is a folder that files arrive in. ``catch_up`` takes what is new since its
checkpoint and ends, so a job that is run again and again keeps its state between runs
and reads each file once. The sink writes a folder for each batch and replaces it when a
batch is repeated after a failure, so every row counts once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineloom.storage import cut, new_path

Plan = Callable[[DataFrame], DataFrame]


def _micros(length: str) -> int:
    """A length such as ``90 minutes`` in microseconds."""
    n, unit = length.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}[unit.rstrip("s")] * 1_000_000


def _plus(time: str, micros) -> F.Column:
    return F.timestamp_micros(F.unix_micros(time) + micros)


class Follower:
    """A plan over a folder of arriving Parquet files; ``rows()`` are those it has put out so far."""

    def __init__(self, spark: SparkSession, source: str, schema, time: str, late: str, plan: Plan, state: str, out: str):
        self.spark, self.source, self.schema, self.time, self.late, self.plan, self.state, self.out = spark, source, schema, time, late, plan, state, out
        self.form = self._planned().schema

    def _planned(self) -> DataFrame:
        return self.plan(self.spark.readStream.schema(self.schema).parquet(self.source).withWatermark(self.time, self.late))

    def catch_up(self) -> None:
        out = self.out
        put = lambda df, batch: df.write.mode("overwrite").parquet(f"{out}/batch={batch}")
        self._planned().writeStream.outputMode("append").option("checkpointLocation", self.state).foreachBatch(put).trigger(availableNow=True).start().awaitTermination()

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.form).parquet(self.out).select(*self.form.names)


def arrivals(rows: DataFrame, time: str, late: str, batches: int) -> list[DataFrame]:
    """The rows in ``batches`` of about equal size, by when they arrive: up to half of ``late`` after their time, by hash, so out of order.

    No row of a batch is older than the watermark that the batches before it leave.
    """
    staged = rows.withColumn("__arrival", F.unix_micros(time) + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(_micros(late) // 2 + 1)))
    ends = staged.agg(F.percentile_approx("__arrival", [n / batches for n in range(1, batches)], 1000)).first()[0] if batches > 1 else []
    part = sum((F.when(F.col("__arrival") > e, 1).otherwise(0) for e in ends or []), F.lit(0))
    held = cut(staged.withColumn("__part", part), "arrivals")
    return [held.where(F.col("__part") == n).drop("__part", "__arrival") for n in range(batches)]


def replayed(rows: DataFrame, time: str, plan: Plan, late: str = "1 hour", past: str = "2 days", batches: int = 4, closing: list[dict] | None = None) -> DataFrame:
    """What ``plan`` puts out over ``rows`` as a stream: each batch arrives, then the plan catches up from its checkpoint.

    A last batch of the rows ``closing`` (values by column, others null), ``past`` behind
    all, moves the watermark over everything that is open; ``past`` must be longer than
    ``late`` and whatever the plan waits for. Rows without a time take no part. An empty
    table puts nothing out.
    """
    spark = rows.sparkSession
    rows = rows.where(F.col(time).isNotNull()).withColumn(time, F.col(time).cast("timestamp"))
    source = new_path(spark, "arriving")
    rows.limit(0).write.parquet(source)
    follower = Follower(spark, source, rows.schema, time, late, plan, new_path(spark, "state"), new_path(spark, "out"))
    spark.createDataFrame([], follower.form).write.parquet(f"{follower.out}/batch=-1")
    for arrived in arrivals(rows, time, late, batches):
        arrived.write.mode("append").parquet(source)
        follower.catch_up()
    last = rows.agg(F.max(time).alias(time)).where(F.col(time).isNotNull()).select(_plus(time, _micros(past)).alias(time))
    for values in closing or [{}]:
        last.select(*[F.col(time) if f.name == time else F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in rows.schema]).write.mode("append").parquet(source)
    follower.catch_up()
    return follower.rows()
