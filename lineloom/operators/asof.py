"""Joins by time: the nearest earlier row, and intervals that overlap.

Neither is bound to a key: rows are dealt to ranges of time within a key, each range is
looked at alone, and what reaches across its start is carried over from a row or two for
each earlier range. A key with a third of all rows is as many tasks as it has ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_BEFORE = (Window.unboundedPreceding, -1)
_TO_HERE = (Window.unboundedPreceding, 0)


def _seconds(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp")) / 1e6


def nearest_earlier(left: DataFrame, right: DataFrame, by: list[str], time: str, tie: str, take: dict[str, str], unlike: str | None = None, strict: bool = False, width: int = 86_400) -> DataFrame:
    """Each row of ``left`` with columns ``take`` (name in ``right`` to name in the result) of the last row of ``right`` that isn't later.

    Rows meet within equal ``by`` (nulls meet nothing). The order is (time, tie), so it
    has no ties where ``tie`` tells rows apart; of rows that are equal in both, the
    largest ``take`` counts. Without ``strict`` a row at the very same time may be
    taken, whatever its tie; with it, only rows earlier in the order. With ``unlike``, a
    column of both, only rows that differ in it are taken, null being a value of its
    own. Rows of ``left`` without a match, a time or a key stay, with nulls; names that
    ``take`` gives replace columns of ``left``. ``width`` is a range's length in seconds.
    """
    keys = [f"__by{k}" for k in range(len(by))]

    def sides(df: DataFrame, own: Column, here: int, rows: Column) -> DataFrame:
        kind = F.col(unlike) if unlike else F.lit(None).cast("string")
        known = [F.col(b).isNotNull() for b in by] + [F.col(time).isNotNull()]
        at = F.struct(F.col(time).cast("timestamp").alias("time"), *((F.col(tie).alias("tie"), F.lit(here).alias("side")) if strict else (F.lit(here).alias("side"), F.col(tie).alias("tie"))))
        part = F.floor(_seconds(F.col(time)) / width)
        full = known[0]
        for k in known[1:]:
            full = full & k
        return df.select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], part.alias("part"), at.alias("at"), kind.alias("kind"), own.alias("own"), rows.alias("row"), full.alias("known"))

    taken = F.struct(*[F.col(a).alias(b) for a, b in take.items()])
    # at one place in the order, rows of left stand before those of right if strict, and behind them if not
    r = sides(right, taken, 1 if strict else 0, F.lit(None)).where("known")
    inside = Window.partitionBy(*keys, "part").orderBy("at", "own")
    r = r.withColumn("one", F.struct("kind", "own", "at"))
    before = F.lag("one").over(inside)
    if unlike:
        r = r.withColumn("started", F.when(before.isNotNull() & ~before["kind"].eqNullSafe(F.col("kind")), before)).withColumn("two", F.last("started", ignorenulls=True).over(inside.rowsBetween(*_TO_HERE)))
    else:
        r = r.withColumn("two", F.lit(None).cast(r.schema["one"].dataType))
    r = r.select(*keys, "part", "at", "own", F.struct("one", "two").alias("state"))

    # what each range leaves: its last row and, if unlike, the last one of another kind; in order these are enough to tell both at any border
    ends = r.groupBy(*keys, "part").agg(F.max_by("state", F.struct("at", "own")).alias("state"))
    along = Window.partitionBy(*keys).orderBy("part")
    if unlike:
        few = ends.select(*keys, "part", F.posexplode(F.array("state.two", "state.one")).alias("nth", "one")).where("one is not null")
        order = Window.partitionBy(*keys).orderBy("part", "nth")
        prior = F.lag("one").over(order)
        few = few.withColumn("started", F.when(prior.isNotNull() & ~prior["kind"].eqNullSafe(F.col("one.kind")), prior)).withColumn("two", F.last("started", ignorenulls=True).over(order.rowsBetween(*_TO_HERE)))
        ends = few.where("nth = 1").select(*keys, "part", F.struct("one", "two").alias("state"))

    fields = [c for c in left.columns if c not in take.values()]
    rows = sides(left, F.lit(None).cast(r.schema["own"].dataType), 0 if strict else 1, F.struct(*[F.col(c) for c in fields]))
    kept, loose = rows.where("known"), rows.where("not known")
    none = F.lit(None).cast(r.schema["state"].dataType)
    whole = kept.select(*keys, "part", "at", "kind", "row", F.lit(True).alias("asks"), none.alias("state"), "own")
    whole = whole.unionByName(r.select(*keys, "part", "at", F.col("state.one.kind").alias("kind"), F.lit(None).cast(rows.schema["row"].dataType).alias("row"), F.lit(False).alias("asks"), "state", "own"))
    # ranges without a row of right still have rows that look back: the carry of each range that has rows of either side
    spans = whole.select(*keys, "part").distinct().join(ends, [*keys, "part"], "left")
    carry = spans.withColumn("carry", F.last("state", ignorenulls=True).over(along.rowsBetween(*_BEFORE))).drop("state")
    here = Window.partitionBy(*keys, "part").orderBy("at", "own").rowsBetween(*_TO_HERE)
    met = whole.withColumn("last", F.last("state", ignorenulls=True).over(here)).where("asks").join(carry, [*keys, "part"])
    if unlike:
        fits = lambda state: F.when(state["one"].isNotNull() & ~state["one"]["kind"].eqNullSafe(F.col("kind")), state["one"]).otherwise(state["two"])
    else:
        fits = lambda state: state["one"]
    found = F.coalesce(fits(F.col("last")), fits(F.col("carry")))["own"]
    out = met.select("row.*", *[found[n].alias(n) for n in take.values()])
    return out.unionByName(loose.select("row.*", *[F.col("own")[n].alias(n) for n in take.values()]))


def overlapping(a: DataFrame, b: DataFrame, by: list[str], start: str, end: str, base: float = 3600.0, levels: int = 20) -> DataFrame:
    """Pairs ``(a, b)``, structs of the rows, of equal ``by`` whose intervals [start, end) have a time in common.

    An interval belongs to the level whose bins, ``base`` seconds times a power of four,
    are as long as it is, and lies in at most two bins there. Two intervals meet in the
    bins of the higher of their levels, and count in the first bin that both have, so
    long intervals are not copied into each short bin, nor short ones to levels that the
    other side doesn't have. Null keys, null ends and empty
    intervals meet nothing.
    """
    last = levels - 1

    def placed(df: DataFrame, side: str) -> tuple[DataFrame, Column]:
        lo, hi = _seconds(F.col(start)), _seconds(F.col(end))
        rows = df.where(F.col(start) < F.col(end)).select(*[F.col(k).alias(f"{side}_k{n}") for n, k in enumerate(by)], lo.alias(f"{side}_lo"), hi.alias(f"{side}_hi"), F.struct("*").alias(side))
        level = F.least(F.lit(last), F.greatest(F.lit(0), F.ceil(F.log2((F.col(f"{side}_hi") - F.col(f"{side}_lo")) / base) / 2))).cast("int")
        rows = rows.withColumn(f"{side}_level", level)
        return rows, F.array(*[F.lit(r[0]) for r in rows.select(f"{side}_level").distinct().collect()]).cast("array<int>")  # at most ``levels``

    def binned(rows: DataFrame, side: str, others: Column) -> DataFrame:
        own = F.col(f"{side}_level")
        rows = rows.withColumn(f"{side}_at", F.explode(F.array_union(F.array(own), F.filter(others, lambda x: x > own))))
        size = F.lit(base) * F.pow(F.lit(4.0), F.col(f"{side}_at"))
        # an end on a border is in no further bin, as intervals are half open
        first, final = F.floor(F.col(f"{side}_lo") / size), F.greatest(F.floor(F.col(f"{side}_lo") / size), F.ceil(F.col(f"{side}_hi") / size) - 1)
        return rows.withColumn(f"{side}_first", first).withColumn(f"{side}_bin", F.explode(F.sequence(first, final)))

    (x, of_a), (y, of_b) = placed(a, "a"), placed(b, "b")
    x, y = binned(x, "a", of_b), binned(y, "b", of_a)
    same = [F.col(f"a_k{n}") == F.col(f"b_k{n}") for n in range(len(by))]
    met = x.join(y, [*same, F.col("a_at") == F.col("b_at"), F.col("a_bin") == F.col("b_bin")])
    own = (F.col("a_at") == F.greatest("a_level", "b_level")) & (F.col("a_bin") == F.greatest("a_first", "b_first"))
    return met.where(own & (F.col("a_lo") < F.col("b_hi")) & (F.col("b_lo") < F.col("a_hi"))).select("a", "b")
