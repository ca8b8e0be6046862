"""Structured Streaming over the event log; an extension of the line engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineloom.storage import new_path


def windowed_counts(events: DataFrame, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Tumbling counts by type; works on streams and tables alike."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    e = e.withWatermark("ts", late) if e.isStreaming else e
    return e.groupBy(F.window("ts", length).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def run_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams the events that are there through the windows into shared storage and reads the result."""
    source = f"{sf_dir.rstrip('/')}/events.parquet"
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir.rstrip('/')}/events*.parquet")
    out = new_path(spark, "stream")
    q = windowed_counts(stream).writeStream.outputMode("complete").option("checkpointLocation", new_path(spark, "stream-state")).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out)
