import random
from math import floor

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lineloom.llm import negatives as N
from lineloom.llm.queries import QUERIES, SQL

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, is_anchor, positives=5, negatives=10, low=30, high=90, quantum=256):
    d = len(rows[0][1])
    rows = [(i, [floor(quantum * x) for x in v], y) for i, v, y in rows if i is not None and y is not None and v is not None and len(v) == d and all(x is not None and np.isfinite(x) for x in v)]
    anchors = {}
    for i, v, y in rows:
        if is_anchor(i):
            anchors[i] = min(anchors.get(i, (y, v)), (y, v))
    out = []
    for a, (label, q) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), i, y) for i, v, y in rows if i != a)
        for s, i, _ in [r for r in scored if r[2] == label][:positives]:
            fits = [(t, j) for t, j, y in scored if y != label and low * -s <= 100 * -t <= high * -s][:negatives]
            out += [(a, i, n + 1, j, -s, -t) for n, (t, j) in enumerate(fits)]
    return sorted(out)


def told(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect())


def clustered(n, d, seed, labels=4, scale=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, d)) * 2
    x = (centre[rng.integers(12, size=n)] + rng.normal(size=(n, d)) * 0.4) * scale
    return [(int(i) - 50, [float(v) for v in row], int(rng.integers(labels))) for i, row in enumerate(x)]


@pytest.fixture(autouse=True)
def small(monkeypatch):
    """So small that the given rows have many cells, blocks, split cells and second steps."""
    monkeypatch.setattr(N, "BLOCK", 40)
    monkeypatch.setattr(N, "FIRST", 60)
    monkeypatch.setattr(N, "CELL", 8)


SHAPE = "vec_id long, embedding array<double>, label int, id string, score int, block int, rank int"


def mined(spark, rows, step=20, **more):
    df = spark.createDataFrame([(*r, "clash", 1, 2, 3) for r in rows], SHAPE)
    return told(N.mine(df, F.col("vec_id") % step == 0, **more))


@pytest.mark.parametrize("scale", [0.3, 2e5])
def test_against_brute_force(spark, scale):
    """At the larger scale products leave 53 bits."""
    rows = clustered(700, 6, 3, scale=scale)
    got = mined(spark, rows)
    assert got and got == brute(rows, lambda i: i % 20 == 0)
    assert mined(spark, rows, positives=2, negatives=3, low=50, high=100) == brute(rows, lambda i: i % 20 == 0, 2, 3, 50, 100)


def test_ties_copies_and_rows_without_part(spark):
    rng = random.Random(2)
    few = [[rng.choice([0.0, 0.5, 1.0]) for _ in range(4)] for _ in range(6)]
    rows = [(i, rng.choice(few), rng.randrange(3)) for i in range(300)]
    rows += [(i, [1.0, 1.0, 0.5, 1.0], 1) for i in range(300, 420)] + [(20, few[0], 2), (20, few[1], 0), (41, few[2], 1), (41, few[2], 1)]
    odd = [(None, few[0], 1), (500, None, 1), (501, few[0], None), (502, [1.0, None, 0.0, 0.0], 1), (503, [float("nan"), 1.0, 1.0, 1.0], 1), (504, [float("inf"), 0.0, 0.0, 0.0], 1), (505, [1.0], 1), (506, [], 1), (507, [1e300, 0.0, 0.0, 0.0], 1)]
    assert mined(spark, rows + odd) == brute(rows, lambda i: i % 20 == 0)


def test_few_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0, 0.0], 1)]) == []
    assert mined(spark, [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 0)]) == [(0, 1, 1, 2, 65536, 32768)]
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 0)]) == [(0, 1, 1, 2, 65536, 32768)]
    assert mined(spark, [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 0)]) == []


def test_heap_gives_all_cells_by_falling_bound():
    rng = np.random.default_rng(4)
    index = N.Index((rng.normal(size=(9, 3)), rng.normal(size=(9, 3))), (rng.random(9), rng.random(9)), np.ones(81, np.int64), None, None)
    q = rng.normal(size=6)
    one, two = index.bounds(q)
    found = list(index.cells(q))
    assert sorted(c for _, c in found) == list(range(81))
    assert [b for b, _ in found] == sorted((b for b, _ in found), reverse=True)
    assert np.allclose([b for b, _ in found], [one[c // 9] + two[c % 9] for _, c in found])


def test_cells_are_left_out_and_bounds_hold(spark):
    """On vectors with structure the certificate stops well before all cells, and no row passes its cell's bound."""
    rows = clustered(2000, 6, 9)
    df = spark.createDataFrame(rows, "id long, vec array<double>, label long").selectExpr("id", "label", "transform(vec, c -> floor(c * 256)) AS vec")
    placed, index = N.build(df, len(rows), 6)
    q = np.floor(np.array(rows[7][1]) * 256)
    bounds = {c: b for b, c in index.cells(q)}
    scores = []
    for r in placed.collect():
        scores.append(float(q @ np.array(r.vec, float)))
        assert scores[-1] <= bounds[r.cell]
    need = sorted(scores)[-20]
    asked = index.wanted(q, need)
    assert 0 < len(asked) < np.count_nonzero(index.sizes) / 2


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_against_sql(spark, monkeypatch, sf):
    monkeypatch.setattr(N, "BLOCK", 256)
    at, db = f"/root/testdata/{sf}", duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{at}/embeddings.parquet'")
    want = db.execute(SQL["op12_hard_negatives"])
    order = [[d[0] for d in want.description].index(c) for c in COLUMNS]
    got = told(QUERIES["op12_hard_negatives"](spark, at))
    assert got and got == sorted(tuple(r[i] for i in order) for r in want.fetchall())
