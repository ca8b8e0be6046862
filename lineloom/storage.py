"""Shared scratch storage: where lineage is cut and where intermediate tables live.

Every cut goes to the folder that the session names in ``spark.checkpoint.dir``,
which the driver and all executors share, so a lost executor never loses a cut.
Only where that setting is missing (tests, a single local JVM) is a temporary
folder made and announced to the session.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session, without a trailing slash."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="lineloom-")
        spark.sparkContext.setCheckpointDir(_own[app])
    return f"file://{_own[app]}"


def path_of(spark: SparkSession, at: str):
    """The file system of a path, and the path in it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def new_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder, removed when the session ends."""
    at = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    fs, path = path_of(spark, at)
    fs.deleteOnExit(path)
    return at


def remove(spark: SparkSession, *paths: str) -> None:
    """Drops scratch tables that nothing reads any more."""
    for at in paths:
        fs, path = path_of(spark, at)
        fs.delete(path, True)


class Cut:
    """A DataFrame whose rows now stand in shared storage; ``df`` rereads them."""

    def __init__(self, df: DataFrame, tag: str):
        self.spark = df.sparkSession
        self.path = new_path(self.spark, tag)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Writes ``df`` to shared storage and returns the reread rows."""
    return Cut(df, tag).df
