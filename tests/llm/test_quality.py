import zlib

import numpy as np
import pytest

from lineloom.llm import quality as Q


def rows():
    good = [(i, f"The river number {i} runs past the town and its {i * 7} houses. People meet there in the evening, and they talk about work, weather and {['music', 'games', 'food'][i % 3]}." * (1 + i % 3), "c") for i in range(300)]
    bad = [(1000 + i, " ".join(f"{w}###" if w % 2 else f"BUY{w}!!!" for w in range(i, i + 30)), "c") for i in range(200)]
    return good, bad


@pytest.fixture
def tables(spark):
    good, bad = rows()
    docs = spark.createDataFrame(good + bad + [(5000, "", "c"), (5001, None, "c"), (None, "x" * 10, "c"), (3, good[3][1], "c")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, *_ in good + bad] + [(1, None, 0), (2, 7, 0), (None, 1, 0)], "doc_id long, quality int, score int")
    return docs, labels


def test_held_out_accuracy(tables):
    got = Q.classify(*tables).collect()
    assert len(got) == 504
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out and r.doc_id < 5000]
    assert sum(r.predicted == int(r.doc_id < 1000) for r in held) / len(held) > 0.97


def test_keep_good_agrees(tables):
    docs, labels = tables
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in Q.classify(docs, labels).collect())


def test_held_out_labels_are_not_learnt(tables, spark):
    docs, labels = tables
    flipped = labels.withColumn("quality", (1 - labels.quality).cast("int")).where(Q.held_out(labels.doc_id)).unionByName(labels.where(~Q.held_out(labels.doc_id)))
    a, b = ({(r.doc_id, round(r.score, 9)) for r in Q.classify(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_one_class_no_labels_no_rows(tables):
    docs, labels = tables
    assert {round(r.score, 6) for r in Q.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.predicted for r in Q.classify(docs, labels.where("quality = 1")).collect()} == {1}
    assert Q.classify(docs.limit(0), labels).count() == 0


def test_against_a_plain_discriminant(tables):
    """The same classifier in a few lines: dense matrices, explicit inverses, no Spark."""
    docs, labels = tables
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    truth = {(r.doc_id, r.quality) for r in labels.collect() if r.doc_id is not None and r.quality in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 5}
    x = np.array([Q.statistics(t) for _, t in texts])
    pairs = [(k, y) for k, (i, _) in enumerate(texts) for j, y in truth if i == j]
    rows, y = x[[k for k, _ in pairs]], np.array([y for _, y in pairs])
    centre, scale = rows.mean(axis=0), np.sqrt(np.maximum(rows.var(axis=0), 1e-8))
    z, zx, d = (rows - centre) / scale, (x - centre) / scale, x.shape[1]
    own = [np.cov(z[y == c].T, bias=True) for c in (0, 1)]
    both = sum(own[c] * (y == c).mean() for c in (0, 1))
    logs = []
    for c in (0, 1):
        s = (1 - Q.POOLED) * own[c] + Q.POOLED * both
        s = (1 - Q.RIDGE) * s + Q.RIDGE * np.trace(s) / d * np.eye(d)
        far = zx - z[y == c].mean(axis=0)
        logs.append(-0.5 * (np.einsum("ij,jk,ik->i", far, np.linalg.inv(s), far) + np.linalg.slogdet(s)[1]))
    trust = 1 - np.exp(-np.expm1(x[:, 0]) / Q.WORDS)
    odds = trust * (logs[1] - logs[0]) / Q.TEMPER + np.log((y == 1).mean() / (y == 0).mean())
    want = sorted(((i is None, i or 0), round(float(s), 6)) for (i, _), s in zip(texts, 1 / (1 + np.exp(-np.clip(odds, -700, 700))), strict=True))
    assert sorted(((r.doc_id is None, r.doc_id or 0), round(r.score, 6)) for r in Q.classify(docs, labels).collect()) == want


def test_conflicting_labels_long_texts_and_the_bound(tables, spark, monkeypatch):
    docs, labels = tables
    docs = docs.unionByName(spark.createDataFrame([(6000, "many words and lines\n" * 60_000, "c")], docs.schema))
    both = labels.unionByName(labels.where("doc_id < 40").selectExpr("doc_id", "1 - quality as quality", "score"))
    assert {r.id for r in Q.lessons(both).collect()} == {r.id for r in Q.lessons(labels).collect()}
    assert Q.lessons(both).where("id < 40").count() == 2 * Q.lessons(labels).where("id < 40").count()  # each is learnt
    assert Q.classify(docs, both).where("doc_id = 6000").first().score is not None
    assert 0 < Q.lessons(labels, most=100).count() < 200
    monkeypatch.setattr(Q, "LEARN", 100)
    assert Q.keep_good(docs, labels).count() > 200
