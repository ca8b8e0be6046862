"""Sessions, streaks and attribution over events, on streams as on tables.

Sessions and attribution are Spark's own windows and joins; the same function works on a
table. Streaks need the order of events, so their state holds back what the watermark
hasn't passed and one open streak for each key. All state ends by time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def sessions(events: DataFrame, by: str = "user_id", gap: str = "6 hours", value: str = "value") -> DataFrame:
    """``(by, first, last, n, total)``: events of a key of which each follows the one before within ``gap``.

    A null key has sessions of its own; events without a time are in none.
    """
    w = events.groupBy(by, F.session_window("ts", gap).alias("w")).agg(F.max("ts").alias("last"), F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 4).alias("total"))
    return w.select(by, F.col("w.start").alias("first"), "last", "n", "total")


def attributed(events: DataFrame, cause: str = "click", effect: str = "purchase", within: str = "12 hours", by: str = "user_id") -> DataFrame:
    """``(effect_id, cause_id, micros)``: each effect with every cause of its key up to ``within`` before it, or with none.

    On a stream an effect without a cause comes out once the watermark has passed it.
    Null keys have no causes.
    """
    effects = events.where(F.col("event_type") == effect).select(F.col("event_id").alias("effect_id"), F.col(by).alias("effect_by"), F.col("ts").alias("effect_ts"))
    causes = events.where(F.col("event_type") == cause).select(F.col("event_id").alias("cause_id"), F.col(by).alias("cause_by"), F.col("ts").alias("cause_ts"))
    near = (F.col("effect_by") == F.col("cause_by")) & (F.col("cause_ts") <= F.col("effect_ts")) & (F.col("cause_ts") >= F.col("effect_ts") - F.expr(f"INTERVAL {within}"))
    return effects.join(causes, near, "left_outer").select("effect_id", "cause_id", (F.unix_micros("effect_ts") - F.unix_micros("cause_ts")).alias("micros"))


_OUT = ["key", "kind", "first_id", "started", "n"]
_STATE = "at array<long>, ids array<long>, kinds array<string>, kind string, first_id long, started long, last long, n long"


def follow(rows: list[tuple[int, int | None, str | None]], run: tuple | None, mark: int, gap: int) -> tuple[list[tuple], list[tuple], tuple | None]:
    """``(ended, held, run)``: streaks that ended, rows not yet passed by ``mark``, and the streak still open.

    ``rows`` are (time, id, kind), ``run`` is (kind, first id, start, last time, n), all
    times are microseconds. A streak goes on with the next row in order of (time, id) if
    that is of its kind and at most ``gap`` later. A null id stands behind the others of its time.
    """
    rows = sorted(rows, key=lambda r: (r[0], r[1] is None, r[1] or 0))
    held = [r for r in rows if r[0] > mark]
    ended = []
    for at, number, kind in rows[: len(rows) - len(held)]:
        if run and run[0] == kind and at - run[3] <= gap:
            run = (kind, run[1], run[2], at, run[4] + 1)
        else:
            if run:
                ended.append(run)
            run = (kind, number, at, at, 1)
    if run and mark >= run[3] + gap:
        ended, run = [*ended, run], None
    return ended, held, run


def streaks(events: DataFrame, by: str = "user_id", gap_hours: int = 24) -> DataFrame:
    """``(by, event_type, first_id, started_us, n)``: runs of events of one type in a key's order of (ts, event_id), each at most ``gap_hours`` after the one before.

    For streams with a watermark on ``ts``: rows are put in order once the watermark has
    passed them. A null key or type is one of its own. State of a key is what arrived
    within the watermark's delay and one streak; it goes when that ends.
    """
    gap = gap_hours * 3_600_000_000

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows, run = [], None
        if state.exists:
            at, ids, kinds, kind, first_id, started, last, n = state.get
            rows, run = list(zip(at, ids, kinds, strict=True)), (kind, first_id, started, last, n) if n else None
        if not state.hasTimedOut:
            for b in batches:
                rows += [(int(t), None if pd.isna(i) else int(i), k) for t, i, k in zip(b["at"], b["id"], b["kind"], strict=True)]
        ended, rows, run = follow(rows, run, state.getCurrentWatermarkMs() * 1000, gap)
        if rows or run:
            state.update(([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], *(run or (None, None, None, None, 0))))
            due = min([r[0] for r in rows] + ([run[3] + gap] if run else []))
            state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs() + 1, due // 1000 + 1))
        elif state.exists:
            state.remove()
        if ended:
            yield pd.DataFrame([(key[0], kind, first_id, started, n) for kind, first_id, started, _, n in ended], columns=_OUT, dtype=object)

    # keys and ids go as strings, as pandas would turn columns of longs with nulls into doubles
    rows = events.select(F.col(by).cast("string").alias("key"), "ts", F.unix_micros("ts").alias("at"), F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("kind"))
    out = rows.groupBy("key").applyInPandasWithState(step, "key string, kind string, first_id long, started long, n long", _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(F.col("key").cast(events.schema[by].dataType).alias(by), F.col("kind").alias("event_type"), "first_id", F.col("started").alias("started_us"), "n")
