"""The ``lines`` model: (dataset, line_number, text) from files and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineloom.functions import text as X
from lineloom.operators import digests, trigrams
from lineloom.operators.numbering import number_lines
from lineloom.session import table
from lineloom.sources.store import LineStore
from lineloom.storage import new_path, path_of


def corpus_files(spark: SparkSession, folder: str, pattern: str = "*.log") -> DataFrame:
    """``(dataset, path, sha256, content)`` of each file; the dataset is the stem before ``_2k``, lower-cased."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    stem = F.regexp_replace(F.regexp_extract("path", r"([^/]+)\.[^./]*$", 1), "_2k$", "")
    return files.select(F.lower(stem).alias("dataset"), "path", X.digest(F.col("content")).alias("sha256"), "content")


def file_lines(files: DataFrame) -> DataFrame:
    """Numbered lines of whole files, by the line contract."""
    return files.select("dataset", F.posexplode(X.split_lines(X.decode(F.col("content")))).alias("pos", "text")).select("dataset", (F.col("pos") + 1).alias("line_number"), "text")


def write_lines(lines: DataFrame, path: str) -> None:
    """Replaces the partitions of the datasets that ``lines`` has, and no others; sorted by number for row-group pruning."""
    ordered = lines.repartition("dataset", F.floor(F.col("line_number") / 1_000_000)).sortWithinPartitions("dataset", "line_number")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset").parquet(path)


def read_lines(spark: SparkSession, path: str, dataset: str | None = None) -> DataFrame:
    lines = spark.read.schema("line_number int, text string, dataset string").parquet(path).select("dataset", "line_number", "text")
    return lines if dataset is None else lines.where(F.col("dataset") == dataset)


#: What tells the rows of a table apart: their file and their place in it.
ROW = ("file", "row")
_stores: dict[tuple, LineStore] = {}
_indexes: dict[str, trigrams.TrigramIndex] = {}
_trees: dict[str, digests.DigestTree] = {}


def _records(spark: SparkSession, sf_dir: str, name: str, dataset: Column, order: Column, tie: Column, lines: Column) -> DataFrame:
    rows = table(spark, sf_dir, name)
    return rows.select(dataset.alias("dataset"), order.alias("ord"), tie.alias("tie"), F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), lines.alias("lines"))


def _as_given(lines: DataFrame) -> DataFrame:
    return lines.withColumn("line_number", F.col("line_number").cast("int"))  # the tables' contract; the store itself counts in longs


def store(spark: SparkSession, sf_dir: str, name: str) -> LineStore:
    """The line store of a given table, in shared storage: written at its first use in a session, and again once the table's files change."""
    files = []
    for file in sorted(table(spark, sf_dir, name).inputFiles()):
        fs, path = path_of(spark, file)
        status = fs.getFileStatus(path)
        files.append((file, status.getLen(), status.getModificationTime()))
    key = (spark.sparkContext.applicationId, name, *files)
    if key not in _stores:
        made = LineStore(spark, new_path(spark, f"lines-{name}"))
        made.append(_records(spark, sf_dir, name, *_SHAPES[name]()))
        _stores[key] = made
    return _stores[key]


def index(spark: SparkSession, sf_dir: str, name: str) -> trigrams.TrigramIndex:
    """The trigram index of a table's line store, in shared storage: built at its first use in a session, and again with the store."""
    of = store(spark, sf_dir, name)
    if of.path not in _indexes:
        _indexes[of.path] = trigrams.build(of.lines(), new_path(spark, f"trigrams-{name}"))
    return _indexes[of.path]


def tree(spark: SparkSession, sf_dir: str, name: str) -> digests.DigestTree:
    """The digest tree of a table's line store, kept in the same way."""
    of = store(spark, sf_dir, name)
    if of.path not in _trees:
        _trees[of.path] = digests.build(of.lines(), new_path(spark, f"digests-{name}"))
    return _trees[of.path]


def _event_text() -> Column:
    return F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" user="), F.col("user_id"), F.lit(" type="), F.col("event_type"), F.lit(" props="), F.col("props"))


#: Dataset, order, tie and lines of each table's records.
_SHAPES = {
    "documents": lambda: (F.col("lang"), F.col("doc_id"), F.xxhash64("text"), X.split_lines(F.col("text"))),
    "events": lambda: (F.col("event_type"), F.col("event_id"), F.lit(0), F.array(_event_text())),
    "pages": lambda: (F.regexp_extract("url", "://([^/:]+)", 1), F.col("page_id"), F.lit(0), X.split_lines(F.col("html"))),
    "conversations": lambda: (F.col("role"), F.col("conv_id"), F.col("turn"), X.split_lines(F.col("text"))),
}


def document_lines(spark: SparkSession, sf_dir: str, ranges: DataFrame | None = None) -> DataFrame:
    """Document texts, one dataset for each language; of ``ranges`` (dataset, lo, hi) only those numbers."""
    return _as_given(store(spark, sf_dir, "documents").lines(ranges))


def event_lines(spark: SparkSession, sf_dir: str, ranges: DataFrame | None = None) -> DataFrame:
    """Events as log lines, one dataset for each type."""
    return _as_given(store(spark, sf_dir, "events").lines(ranges))


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pages, one dataset for each host. Hosts are too many for folders, so pages are numbered where they are read."""
    return _as_given(number_lines(_records(spark, sf_dir, "pages", *_SHAPES["pages"]()), row=ROW))


def turn_lines(spark: SparkSession, sf_dir: str, ranges: DataFrame | None = None) -> DataFrame:
    """Conversation turns, one dataset for each role."""
    return _as_given(store(spark, sf_dir, "conversations").lines(ranges))
