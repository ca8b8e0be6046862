import random
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from lineloom import catalog
from lineloom.storage import new_path
from lineloom.streaming import replay as R
from lineloom.streaming import sessions as S

ZERO = datetime(2024, 1, 1)
ROWS = "event_id long, user_id long, event_type string, ts timestamp, value double, w string, key int"
BIG = 2**60 + 1  # not a double


def some(n, seed):
    """Few users, kinds and times, so many ties; null users, kinds and times; names that the operators use themselves."""
    rng = random.Random(seed)
    time = lambda: None if rng.random() < 0.04 else ZERO + timedelta(minutes=rng.randrange(6000))
    return [(BIG + i, rng.choice([BIG, BIG, 2, 3, None]), rng.choice(["click", "click", "purchase", "view", None]), time(), 1.0, "w", 1) for i in range(n)]


def split(rows, gap, kinds):
    """Brute force: (user, [rows]) of maximal runs in order."""
    out = {}
    for r in sorted((r for r in rows if r[3]), key=lambda r: (r[3], r[0])):
        runs = out.setdefault(r[1], [])
        if runs and r[3] - runs[-1][-1][3] <= gap and (not kinds or runs[-1][-1][2] == r[2]):
            runs[-1].append(r)
        else:
            runs.append([r])
    return [(u, run) for u, runs in out.items() for run in runs]


def test_sessions_and_streaks_against_brute_force(spark):
    rows = some(150, 3)
    df = spark.createDataFrame(rows, ROWS)
    want = sorted(((u, run[0][3], run[-1][3], len(run), float(len(run))) for u, run in split(rows, timedelta(hours=6), False)), key=str)
    for got in (S.sessions(df.where("ts is not null")), R.replayed(df, "ts", S.sessions, batches=2)):
        assert sorted(map(tuple, got.collect()), key=str) == want
    streaks = R.replayed(df, "ts", lambda e: S.streaks(e, gap_hours=2), batches=2)
    micros = lambda t: (t - ZERO) // timedelta(microseconds=1) + 1_704_067_200_000_000
    assert sorted(map(tuple, streaks.collect()), key=str) == sorted(((u, run[0][2], run[0][0], micros(run[0][3]), len(run)) for u, run in split(rows, timedelta(hours=2), True)), key=str)


def test_attribution_against_brute_force(spark):
    rows = some(120, 4)
    df = spark.createDataFrame(rows, ROWS)
    want = []
    for p in rows:
        if p[2] == "purchase" and p[3]:
            near = [c for c in rows if c[2] == "click" and c[1] is not None and c[1] == p[1] and c[3] and timedelta() <= p[3] - c[3] <= timedelta(hours=12)]
            want += [(p[0], c[0], (p[3] - c[3]) // timedelta(microseconds=1)) for c in near] or [(p[0], None, None)]
    closing = [{"event_type": "click"}, {"event_type": "purchase"}]
    for got in (S.attributed(df.where("ts is not null")), R.replayed(df, "ts", S.attributed, batches=2, closing=closing)):
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_follow_in_any_order_of_marks():
    """However rows are dealt to steps, each step's rows behind its mark, streaks are those of one pass."""
    rng = random.Random(5)
    rows = sorted((rng.randrange(60), i, rng.choice("ab")) for i in range(80))
    whole, _, _ = S.follow(rows, None, 10**6, 3)
    for _ in range(20):
        ended, held, run, mark = [], [], None, -1
        for stop in sorted(rng.sample(range(60), 5)) + [10**6]:
            own = [r for r in rows if mark < r[0] <= stop]
            rng.shuffle(own)
            more, held, run = S.follow(held + own, run, stop, 3)
            ended, mark = ended + more, stop
        assert ended == whole and not held and run is None


@pytest.mark.parametrize("name", ["user_sessions", "user_sessions_stream", "user_streaks_stream", "attribution_stream"])
def test_queries_against_sql(spark, name):
    at = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{at}/events.parquet'")
    want = db.execute(catalog.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(tuple(r[c] for c in columns) for r in catalog.QUERIES[name](spark, at).collect()) == sorted(want.fetchall()) != []


def test_late_rows_restart_and_repeated_batches(spark):
    """A row behind the watermark is dropped, one within it counts; each catch-up is a restart; nothing new adds nothing."""
    rows = lambda *hours: spark.createDataFrame([(i, 1, "click", ZERO + timedelta(hours=h), 1.0, "w", 1) for i, h in enumerate(hours)], ROWS)
    source = new_path(spark, "late")
    rows(0, 1, 30).write.parquet(source)
    f = R.Follower(spark, source, rows(0).schema, "ts", "2 hours", S.sessions, new_path(spark, "state"), new_path(spark, "out"))
    f.catch_up()
    assert [r.n for r in f.rows().collect()] == [2]
    rows(2, 28.5, 100).write.mode("append").parquet(source)  # 2 is behind 30 - 2, 28.5 isn't
    f.catch_up()
    assert sorted(r.n for r in f.rows().collect()) == [2, 2]
    for _ in range(2):
        f.catch_up()
    assert sorted(r.n for r in f.rows().collect()) == [2, 2]
    written = [r[0] for r in spark.read.parquet(f.out).select("batch").distinct().collect()]
    assert len(written) == len(set(written))


def test_arrivals_lose_nothing_and_are_never_late(spark):
    rows = spark.createDataFrame([r for r in some(300, 6) if r[3]], ROWS)
    parts = R.arrivals(rows, "ts", "1 hour", 5)
    assert sorted(map(tuple, (r for p in parts for r in p.collect())), key=str) == sorted(map(tuple, rows.collect()), key=str)
    ends = [p.agg(F.min("ts"), F.max("ts")).first() for p in parts]
    seen = ends[0][1]
    for low, high in ends[1:]:
        assert low > seen - timedelta(hours=1)
        seen = max(seen, high)
    assert min(low for low, _ in ends[1:]) < max(high for _, high in ends[:-1])  # but out of order
    empty = R.replayed(rows.limit(0), "ts", S.sessions, batches=2)
    assert empty.count() == 0
