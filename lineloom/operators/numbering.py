"""Dense line numbers inside few, large partitions, without one task for each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WIDTH = 4096


def _starts(records: DataFrame, order: str, tie: str, width: int) -> DataFrame:
    """``records`` (dataset, order, tie, n, ...) with ``at``, the number of lines in records before theirs."""
    sized = records.withColumn("part", F.floor(F.col(order) / width))
    totals = sized.groupBy("dataset", "part").agg(F.sum("n").alias("total"))
    ranges = Window.partitionBy("dataset").orderBy(F.col("part").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select(F.col("dataset").alias("d"), F.col("part").alias("p"), F.coalesce(F.sum("total").over(ranges), F.lit(0)).alias("first"))
    inside = Window.partitionBy("dataset", "part").orderBy(F.col(order).asc_nulls_first(), tie).rowsBetween(Window.unboundedPreceding, 0)
    placed = sized.withColumn("before", F.sum("n").over(inside) - F.col("n"))
    joined = placed.join(first, F.col("dataset").eqNullSafe(F.col("d")) & F.col("part").eqNullSafe(F.col("p")))
    return joined.withColumn("at", F.col("first") + F.col("before")).drop("d", "p", "part", "first", "before")


def number_lines(records: DataFrame, order: str = "ord", tie: str = "tie", lines: str = "lines", width: int = WIDTH, row: tuple[str, ...] = ()) -> DataFrame:
    """``(dataset, line_number, text)`` from records ``(dataset, ord, tie, lines)``.

    Numbers run from 1 in each dataset by (ord, tie, position). Records fall into
    ranges of ``ord``; the first number of a range is a prefix sum over range
    totals, so a dataset with most of the rows is numbered by as many tasks as it has
    ranges. Null orders come first.

    With ``row``, columns that tell all records apart, only narrow rows are numbered:
    the text is joined to its numbers afterwards, so conditions on the text hold
    before anything moves, and lines that no one asks for never do.
    """
    size = F.size(lines).cast("long").alias("n")
    if not row:
        numbered = _starts(records.withColumn("n", size), order, tie, width)
        return numbered.select("dataset", "at", F.posexplode(lines).alias("pos", "text")).select("dataset", (F.col("at") + F.col("pos") + 1).alias("line_number"), "text")
    starts = _starts(records.select("dataset", order, tie, *row, size).where("n > 0"), order, tie, width).select(*[F.col(c).alias(f"start_{c}") for c in row], "at")
    texts = records.select("dataset", *row, F.posexplode(lines).alias("pos", "text"))
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"start_{c}") for c in row])
    return texts.join(starts, same).select("dataset", (F.col("at") + F.col("pos") + 1).alias("line_number"), "text")


def ranked(rows: DataFrame, order: str = "line_number", width: int = WIDTH) -> DataFrame:
    """``rows`` (dataset, order, ...) with ``rn``, their rank from 1 by ``order`` in each dataset, and ``n``, how many there are.

    Ranks are prefix sums over ranges of ``order``, as in :func:`number_lines`; ``order``
    tells the rows of a dataset apart.
    """
    sized = rows.withColumn("part", F.floor(F.col(order) / width))
    totals = sized.groupBy("dataset", "part").agg(F.count(F.lit(1)).alias("total"))
    by = Window.partitionBy("dataset")
    ranges = by.orderBy(F.col("part").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select(F.col("dataset").alias("d"), F.col("part").alias("p"), F.coalesce(F.sum("total").over(ranges), F.lit(0)).alias("first"), F.sum("total").over(by).alias("n"))
    inside = Window.partitionBy("dataset", "part").orderBy(order)
    joined = sized.withColumn("before", F.row_number().over(inside)).join(first, F.col("dataset").eqNullSafe(F.col("d")) & F.col("part").eqNullSafe(F.col("p")))
    return joined.withColumn("rn", F.col("first") + F.col("before")).drop("d", "p", "part", "first", "before")
