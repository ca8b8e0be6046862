import random
from datetime import datetime, timedelta

import pytest

from lineloom.operators import asof as A

ROWS = "id long, who string, kind string, ts timestamp_ntz, at string"
ZERO = datetime(2024, 1, 1)


def some(n, seed, first=0, spread=4000):
    """Few times, so many ties; null keys, kinds and times; the columns carry names that the operator might use."""
    rng = random.Random(seed)
    time = lambda: None if rng.random() < 0.05 else ZERO + timedelta(seconds=rng.randrange(spread))
    return [(first + i, rng.choice(["hot", "hot", "hot", "b", "c", None]), rng.choice(["p", "p", "p", "q", None]), time(), f"v{i}") for i in range(n)]


def brute(left, right, unlike, strict):
    out = []
    for i, who, kind, ts, _ in left:
        fit = [(r[3], r[0]) for r in right if None not in (ts, who, r[3]) and r[1] == who and (not unlike or r[2] != kind) and ((r[3], r[0]) < (ts, i) if strict else r[3] <= ts)]
        out.append((i, max(fit)[1] if fit else None))
    return sorted(out)


@pytest.mark.parametrize("width", [7, 300, 10**6])
@pytest.mark.parametrize(("unlike", "strict"), [(None, False), ("kind", False), (None, True), ("kind", True)])
def test_nearest_against_brute_force(spark, unlike, strict, width):
    for seed in (1, 2):
        left, right = some(250, seed, spread=[4000, 60][seed - 1]), some(200, seed + 10, 1000 * (seed % 2), [4000, 60][seed - 1])
        got = A.nearest_earlier(spark.createDataFrame(left, ROWS), spark.createDataFrame(right, ROWS), ["who"], "ts", "id", {"id": "found", "at": "value"}, unlike, strict, width)
        assert got.columns == ["id", "who", "kind", "ts", "at", "found", "value"]
        rows = got.collect()
        assert sorted((r.id, r.found) for r in rows) == brute(left, right, unlike, strict)
        assert {(r.found, r.value) for r in rows} <= {(r[0], r[4]) for r in right} | {(None, None)}


def test_nearest_in_itself_and_in_nothing(spark):
    rows = some(300, 5)
    df = spark.createDataFrame(rows, ROWS)
    got = A.nearest_earlier(df, df, ["who"], "ts", "id", {"id": "found"}, "kind", True, 500)
    assert sorted((r.id, r.found) for r in got.collect()) == brute(rows, rows, "kind", True)
    assert all(r.found is None for r in A.nearest_earlier(df, df.limit(0), ["who"], "ts", "id", {"id": "found"}).collect())
    assert A.nearest_earlier(df.limit(0), df, ["who"], "ts", "id", {"id": "found"}).count() == 0


def test_a_hot_key_is_many_groups(spark):
    """All windows over rows are dealt by key and range of time; only the one over ranges is dealt by key."""
    df = spark.createDataFrame(some(50, 1), ROWS)
    plan = A.nearest_earlier(df, df, ["who"], "ts", "id", {"id": "found"}, "kind", True)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_overlaps_against_brute_force(spark):
    rng = random.Random(9)
    spans = []
    for i in range(220):
        a = ZERO + timedelta(seconds=rng.randrange(200_000))
        b = a + timedelta(seconds=rng.choice([0, 1, 60, 3600, 14_400, 90_000, 10**7, -5]))
        spans.append((i, rng.choice(["k", "k", "m", None]), None if rng.random() < 0.03 else a, None if rng.random() < 0.03 else b))
    spans += [(500, "k", ZERO, ZERO + timedelta(hours=1)), (501, "k", ZERO + timedelta(hours=1), ZERO + timedelta(hours=2)), (502, "k", datetime(1960, 1, 1), datetime(2030, 1, 1))]
    df = spark.createDataFrame(spans, "id long, k string, lo timestamp_ntz, hi timestamp_ntz")
    for base in (10.0, 3600.0):
        got = sorted((r.a.id, r.b.id) for r in A.overlapping(df, df, ["k"], "lo", "hi", base).collect())
        good = [s for s in spans if None not in s and s[2] < s[3]]
        assert got == sorted((x[0], y[0]) for x in good for y in good if x[1] == y[1] and x[2] < y[3] and y[2] < x[3])
    assert A.overlapping(df, df.limit(0), ["k"], "lo", "hi").count() == 0
