import math
import zlib
from collections import Counter

import numpy as np

from lineloom.llm import sharding as H


def test_exact_counts_and_slots(spark):
    texts = ["", None, "é" * 3, "copy"] + ["copy"] * 700 + [f"text {i}" for i in range(1301)]
    rows = [(i if i % 50 else None, t, "clash", 1) for i, t in enumerate(texts)]
    got = H.document_shards(spark.createDataFrame(rows, "doc_id long, text string, part string, shard int")).collect()
    assert len(got) == len(rows)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(16))
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_small_and_empty_tables(spark):
    df = spark.createDataFrame([(i, "x") for i in range(5)], "doc_id long, text string")
    assert sorted(Counter(r.shard for r in H.document_shards(df).collect()).values()) == [1] * 5
    assert H.document_shards(df.limit(0)).count() == 0


def test_matrix_margins_and_law():
    sizes, shards = [40, 0, 25, 60], H.shard_sizes(125, 4)
    total = np.zeros((4, 4))
    for seed in range(3000):
        m = np.array(H.communication_matrix(sizes, shards, seed))
        assert m.sum(axis=1).tolist() == sizes and m.sum(axis=0).tolist() == shards and (m >= 0).all()
        total += m
    mean = np.outer(sizes, shards) / 125
    assert np.abs(total / 3000 - mean).max() < 0.3


def test_large_urns(monkeypatch):
    monkeypatch.setattr(H, "EXACT", 0)
    rng = np.random.default_rng(5)
    good, bad, n = 300, 700, 100
    x = np.array([H._hypergeometric(rng, good, bad, n) for _ in range(4000)])
    sd = math.sqrt(n * 0.3 * 0.7 * 900 / 999)
    assert abs(x.mean() - 30) < 0.3 and abs(x.std() - sd) < 0.2
    assert H._hypergeometric(rng, 5, 0, 3) == 3 and H._hypergeometric(rng, 0, 5, 3) == 0


def test_uniform(spark):
    df = spark.createDataFrame([(i, "x") for i in range(320)], "doc_id long, text string")
    hits = sum(r.shard == r.doc_id // 20 for seed in range(6) for r in H.document_shards(df, seed=seed).collect())
    assert abs(hits - 6 * 20) < 50
