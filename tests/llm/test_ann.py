import numpy as np
from pyspark.sql import functions as F

from lineloom.llm import ann as A

SCHEMA = "vec_id long, embedding array<float>, label int, part string"


def brute(rows, k):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v, *_ in rows if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)]
    out = []
    for q in sorted({i for i, _ in ok if i % 20 == 0}):
        x = min((v.tolist() for i, v in ok if i == q))
        s = sorted((-(np.array(x) * v).sum(), i) for i, v in ok if i != q)[:k]
        out += [(q, n + 1, i, -v) for n, (v, i) in enumerate(s)]
    return out


def table(n, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), 0, "x") for i in range(n)]
    return rows


def equal(got, want):
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [w[:3] for w in want]
    assert np.allclose([r.score for r in got], [w[3] for w in want], rtol=0, atol=1e-12)


def test_small_tables_are_exact(spark):
    rows = table(300)
    rows += [(1000 + i, rows[7][1], 0, "x") for i in range(120)]  # one vector many times: ties go to the smaller id
    rows += [(2000, None, 0, "x"), (2020, [0.0] * 8, 0, "x"), (2040, [1.0] * 7 + [None], 0, "x"), (2060, [float("nan")] * 8, 0, "x"), (2080, [float("inf")] * 8, 0, "x"), (2100, [1.0, 2.0], 0, "x"), (None, [1.0] * 8, 0, "x")]
    got = A.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    equal(got, brute(rows, 20))


def test_fewer_candidates_than_asked(spark):
    rows = table(9)
    got = A.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    equal(got, brute(rows, 20))
    assert len(got) == 8
    assert A.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_over_parts(spark, monkeypatch):
    monkeypatch.setattr(A, "ROWS_PER_PART", 300)
    monkeypatch.setattr(A, "BLOCK", 200)
    rows = table(3000, 2)
    got = A.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0).collect()
    want = {(q, i) for q, _, i, _ in brute(rows, 20)}
    assert len(got) == len(want)
    assert len({(r.query_id, r.vec_id) for r in got} & want) / len(want) >= 0.9


def test_query_id_repeats_inside_many_copies(spark):
    rows = table(200, 3)
    rows += [(20, rows[7][1], 0, "x") for _ in range(40)] + [(1000 + i, rows[7][1], 0, "x") for i in range(60)] + [(1001, rows[7][1], 0, "x") for _ in range(30)]
    rows = [r for r in rows if r[0] != 20 or r[1] == rows[7][1]]  # id 20 asks with the copied vector and holds 40 of its rows
    got = A.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    equal(got, brute(rows, 20))


def test_recall_on_the_given_vectors(spark):
    """Several parts, fewer probes than parts, every query."""
    for sf, size in (("0.01", 500), ("0.1", 2000)):
        df = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet")
        x = np.array([r.embedding for r in df.orderBy("vec_id").collect()], float)
        parts = A.part_count(len(x), 20)
        router = A.train(x, parts, 20)
        assert len(x) == size and parts > 1 and router.probes < parts
        want = {(r.query_id, r.vec_id) for r in A.nearest(df, F.col("vec_id") % 20 == 0, parts=1).collect()}
        got = A.nearest(df, F.col("vec_id") % 20 == 0).collect()
        recall = len({(r.query_id, r.vec_id) for r in got} & want) / len(want)
        print(f"sf{sf}: {parts} parts, {router.probes} probes, recall {recall:.3f}")
        assert len(got) == len(want) and recall >= 0.9


def test_near_ties_of_long_vectors(spark):
    """Products that differ by less than their rounding are ordered by their exact values, whatever the vectors' length."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=8) * 1e6
    rows = [(i, (base + rng.normal(size=8) * 1e-3).tolist(), 0, "x") for i in range(200)]
    df = spark.createDataFrame([(i, v, 0, i) for i, v, *_ in rows], "vec_id long, embedding array<double>, block int, id long")  # names that the search uses itself
    got = A.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    v = {i: np.array(x) for i, x, *_ in rows}
    for q in (0, 20, 180):
        want = sorted((-(v[q] * v[i]).sum(), i) for i in v if i != q)[:20]
        assert [(r.vec_id, r.score) for r in got if r.query_id == q] == [(i, -s) for s, i in want]
