"""A numbered line store: lines are numbered once, when they are written.

Lines lie in Parquet, in a folder for each dataset and batch, sorted by number, so that
a dataset is a choice of folders and a range of numbers a choice of row groups. Next to
them stand the range counters: for each dataset and range of the order, how many lines
it has and the number before its first. A batch that is appended goes on from the
counters' totals; nothing that is stored is read or written again.

The counters are also the commit: a batch counts once they have it, so a write that
fails leaves nothing that readers see, and its repetition replaces what it left.

Scale. Texts move once, to ranges of their own order; a range is a join key, not a task
for a whole dataset. Datasets become folders, so they should be few.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lineloom.storage import new_path, path_of, remove

WIDTH = 4096
#: Ranges in one condition: the chain that hundreds make is too deep for the driver's stack, and their code too long for the JVM.
NAMED = 48
_LINES, _COUNTERS = "line_number long, text string, key string, batch int", "part long, first long, n long, key string, batch int"


def _key(dataset: Column) -> Column:
    """Names of folders: they tell null, empty and other datasets apart and need no escapes."""
    return F.when(dataset.isNull(), "n").otherwise(F.concat(F.lit("d"), F.hex(dataset)))


def _dataset() -> Column:
    return F.when(F.col("key") != "n", F.decode(F.unhex(F.substring("key", 2, (1 << 31) - 1)), "UTF-8")).alias("dataset")


def _apart(ranges: list[tuple]) -> list[tuple]:
    """The ranges (key, lo, hi) in order, those that meet as one."""
    found: list[tuple] = []
    for key, lo, hi in sorted(ranges):
        if found and found[-1][0] == key and lo <= found[-1][2] + 1:
            found[-1] = (key, found[-1][1], max(hi, found[-1][2]))
        elif lo <= hi:
            found.append((key, lo, hi))
    return found


def _within(ranges: list[tuple]) -> Column:
    """Whether a line is in one of the ranges (key, lo, hi); a key is named once."""
    of: dict[str, list[Column]] = {}
    for key, lo, hi in ranges:
        of.setdefault(key, []).append(F.col("line_number").between(lo, hi))
    return reduce(or_, [(F.col("key") == key) & reduce(or_, own) for key, own in of.items()])


class LineStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        fs, at = path_of(self.spark, f"{self.path}/{name}")
        if not fs.exists(at):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def _batches(self) -> dict[str, list[int]]:
        """The batches of each dataset that count: from the last one on that began at its first line. Datasets and batches are folders, and so few."""
        found: dict[str, list[int]] = {}
        begun = self._table("counters", _COUNTERS).groupBy("key", "batch").agg(F.min("first").alias("first"))
        for r in sorted(begun.collect(), key=lambda r: (r.key, r.batch)):
            found[r.key] = [r.batch] if r.first == 0 else [*found.get(r.key, []), r.batch]
        return found

    def _committed(self, name: str, schema: str) -> DataFrame:
        these = [f"{key}/{batch}" for key, own in self._batches().items() for batch in own]
        return self._table(name, schema).where(F.concat_ws("/", "key", "batch").isin(these))

    def counters(self) -> DataFrame:
        """``(dataset, batch, part, first, n)``: lines before a range, and in it."""
        return self._committed("counters", _COUNTERS).select(_dataset(), "batch", "part", "first", "n")

    def totals(self) -> DataFrame:
        """``(dataset, lines)``, from the counters alone."""
        return self.counters().groupBy("dataset").agg(F.sum("n").alias("lines"))

    def lines(self, ranges: DataFrame | None = None) -> DataFrame:
        """``(dataset, line_number, text)``; of ``ranges`` (dataset, lo, hi), some hundreds at most, only those numbers.

        Datasets choose folders and numbers choose row groups, before anything is read;
        each ``NAMED`` ranges are a scan.
        """
        rows = self._committed("lines", _LINES)
        if ranges is not None:
            apart = _apart(ranges.select(_key(F.col("dataset")).alias("key"), "lo", "hi").where("lo is not null").collect())
            rows = reduce(DataFrame.unionByName, [rows.where(_within(apart[at : at + NAMED])) for at in range(0, len(apart), NAMED)] or [rows.limit(0)])
        return rows.select(_dataset(), "line_number", "text")

    def _write(self, records: DataFrame, batch: int, bases: DataFrame | None, width: int) -> None:
        none = F.lit(-(1 << 62))  # null orders come first
        keyed = records.select(_key(F.col("dataset")).alias("key"), F.coalesce(F.floor(F.col("ord") / width).cast("long"), none).alias("part"), "ord", "tie", "lines")
        before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        counts = keyed.groupBy("key", "part").agg(F.sum(F.size("lines").cast("long")).alias("n")).where("n > 0")
        counts = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")))
        if bases is not None:
            counts = counts.join(bases, "key", "left").withColumn("first", F.col("first") + F.coalesce("base", F.lit(0))).drop("base")
        held = new_path(self.spark, "counters")
        counts.select("key", "part", "first", "n").write.parquet(held)
        counts = self.spark.read.schema("key string, part long, first long, n long").parquet(held)
        inside = Window.partitionBy("key", "part").orderBy(F.col("ord").asc_nulls_first(), "tie").rowsBetween(Window.unboundedPreceding, 0)
        placed = keyed.withColumn("at", F.sum(F.size("lines").cast("long")).over(inside) - F.size("lines")).join(counts, ["key", "part"])
        texts = placed.select("key", F.lit(batch).alias("batch"), (F.col("first") + F.col("at")).alias("at"), F.posexplode("lines").alias("pos", "text"))
        texts = texts.select((F.col("at") + F.col("pos") + 1).alias("line_number"), "text", "key", "batch").sortWithinPartitions("key", "batch", "line_number")
        texts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("key", "batch").parquet(f"{self.path}/lines")
        done = counts.select("part", "first", "n", "key", F.lit(batch).alias("batch")).repartition("key").sortWithinPartitions("key", "batch")
        done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("key", "batch").parquet(f"{self.path}/counters")
        remove(self.spark, held)

    def append(self, records: DataFrame, width: int = WIDTH) -> None:
        """Adds the lines of ``records`` (dataset, ord, tie, lines), by (ord, tie, position), after those of their datasets."""
        bases = self._committed("counters", _COUNTERS).groupBy("key").agg(F.sum("n").alias("base"))
        self._write(records, self._next(), bases, width)

    def replace(self, records: DataFrame, width: int = WIDTH) -> None:
        """Numbers the datasets that ``records`` has anew, from 1. Files of other datasets stay as they are."""
        before, batch = self._batches(), self._next()
        self._write(records, batch, None, width)
        for key, own in self._batches().items():
            if batch in own:  # readers see the new lines alone from now on
                remove(self.spark, *[f"{self.path}/{name}/key={key}/batch={b}" for name in ("counters", "lines") for b in before.get(key, [])])

    def _next(self) -> int:
        return 1 + max((b for own in self._batches().values() for b in own), default=-1)


def wanted_ranges(refs: DataFrame) -> DataFrame:
    """``(dataset, lo, hi)``: between which numbers the references (dataset, line_number) of each dataset lie."""
    return refs.groupBy("dataset").agg(F.min("line_number").cast("long").alias("lo"), F.max("line_number").cast("long").alias("hi"))


def coarse_ranges(places: DataFrame, node: str, lines: int, most: int = 512) -> DataFrame:
    """``(dataset, lo, hi)``: ranges of numbers that cover the nodes, of ``lines`` lines each, in ``places`` (dataset, node): at most ``most``, or one for each dataset, so that they may be collected."""
    least, last, datasets = places.agg(F.min(node), F.max(node), F.count_distinct(F.coalesce("dataset", F.lit("")))).first()
    wide = -(-((last or 0) - (least or 0) + 1) // max(1, most // max(1, datasets)))
    part = F.floor((F.col(node) - F.lit(least or 0)) / F.lit(wide))
    return places.groupBy("dataset", part).agg((F.min(node) * lines + 1).alias("lo"), ((F.max(node) + 1) * lines).alias("hi")).select("dataset", "lo", "hi")
