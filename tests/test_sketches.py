import random
from collections import Counter
from datetime import datetime, timedelta

import duckdb

from lineloom import catalog
from lineloom.operators import sketches as K

ROWS = "kind string, ts timestamp, who long, value double, item string, n int, hour string"


def some(n, seed):
    rng = random.Random(seed)
    time = lambda: None if rng.random() < 0.02 else datetime(1969, 12, 20) + timedelta(hours=rng.randrange(900))  # noqa: E731  also before 1970
    return [(rng.choice(["hot", "hot", "hot", "b", None]), time(), rng.choice([None, *range(400)]), rng.choice([None, rng.random()]), rng.choice("aaab") + str(rng.randrange(30)), 1, "x") for _ in range(n)] + [("bare", datetime(1970, 1, 1), None, None, "i0", 1, "x")]


def test_merged_hours_against_exact_values(spark):
    rows = some(4000, 1)
    hours = K.rollup(spark.createDataFrame(rows, ROWS), "kind", "ts", "who", "value", "item")
    assert hours.count() == len({(r[0], r[1]) for r in rows if r[1]})
    told = {r.dataset: r for r in K.estimates(K.merged(hours)).collect()}
    own = [r for r in rows if r[1]]
    assert set(told) == {r[0] for r in own}
    for kind, r in told.items():
        mine = [x for x in own if x[0] == kind]
        users, values = {x[2] for x in mine} - {None}, sorted(x[3] for x in mine if x[3] is not None)
        assert r.n == len(mine) and abs(r.distinct - len(users)) <= max(1, K.DISTINCT_ERROR * len(users))
        for rank, q in zip((0.5, 0.9, 0.99), r.quantiles, strict=True):
            if not values:
                assert q is None
                continue
            assert sum(v < q for v in values) / len(values) - K.RANK_ERROR <= rank <= sum(v <= q for v in values) / len(values) + K.RANK_ERROR
        counts = Counter(x[4] for x in mine)
        assert [c["count"] for c in r.frequent] == sorted(counts.values(), reverse=True)[:5]
        assert all(counts[c["item"]] == c["count"] for c in r.frequent)


def test_spans_and_nothing(spark):
    rows = [r for r in some(600, 2) if r[1]]
    hours = K.rollup(spark.createDataFrame(rows, ROWS), "kind", "ts", "who", "value", "item")
    cut = 100  # hours since 1970
    late = {r.dataset: r.n for r in K.merged(hours.where(f"hour >= {cut}")).collect()}
    assert late == Counter(r[0] for r in rows if r[1] >= datetime(1970, 1, 1) + timedelta(hours=cut))
    assert K.estimates(K.merged(hours.limit(0))).count() == 0


def test_query_against_sql(spark):
    at = "/root/testdata/sf0.01"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{at}/events.parquet'")
    want = db.execute(catalog.SQL["sketch_bounds"])
    columns = [d[0] for d in want.description]
    assert sorted(tuple(r[c] for c in columns) for r in catalog.QUERIES["sketch_bounds"](spark, at).collect()) == sorted(want.fetchall()) != []
