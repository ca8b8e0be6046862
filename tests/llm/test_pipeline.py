import re

import pytest

from lineloom.llm import decontam, mixing, quality, sharding

pipeline = pytest.importorskip("corpus_pipeline")
DIR = "/root/testdata/sf0.001"


def similar(docs):
    """The smallest id of each group of documents with five-word Jaccard similarity of 0.8 or more, by all pairs."""
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and (not sets[i] and not sets[j] or both and both * 5 >= len(sets[i] | sets[j]) * 4):
                a, b = label[i], label[j]
                label = {k: min(a, b) if x in (a, b) else x for k, x in label.items()}
    return set(label.values())


def test_stages_decide_as_the_operators_do(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels, items = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("labels", "benchmark"))
    good = {r.doc_id for r in quality.classify(docs, labels).collect() if r.predicted}
    a = docs.where(docs.doc_id.isin(list(good)))
    assert {r.doc_id for r in pipeline.STAGES[0][1](spark, docs, DIR).collect()} == good
    first = similar([(r.doc_id, r.text) for r in a.collect()])
    assert sorted(r.doc_id for r in pipeline.STAGES[1][1](spark, a, DIR).collect()) == sorted(first)
    b = a.where(a.doc_id.isin(list(first)))
    bad = {r.doc_id for r in decontam.contained_items(b, items).collect()}
    c = b.where(~b.doc_id.isin(list(bad)))
    assert sorted(r.doc_id for r in pipeline.STAGES[2][1](spark, b, DIR).collect()) == sorted(r.doc_id for r in c.collect())
    times = {r.doc_id: r.repeats for r in mixing.mix(c).collect()}
    mixed = pipeline.STAGES[3][1](spark, c, DIR)
    assert mixed.columns == docs.columns
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(i for i, n in times.items() for _ in range(n))
    last = pipeline.run(spark, DIR).collect()
    assert sorted(r.doc_id for r in last) == sorted(i for i, n in times.items() for _ in range(n))
    counts = [sum(r.shard == s for r in last) for s in range(sharding.SHARDS)]
    assert max(counts) - min(counts) <= 1


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, DIR)
    assert docs.count() == 0


def test_odd_documents(spark):
    """Nulls in any column, empty and very long texts, repeated rows and columns with clashing names go through all stages."""
    some = spark.read.parquet(f"{DIR}/documents.parquet").limit(30).collect()
    long = " ".join(r.text or "" for r in some) * 20
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, 1, "x") for r in some]
    rows += [(None, some[0].text, None, None, None, None, None), (1001, None, "en", None, 0, 2, "y"), (1002, "", None, "web", 0, 3, "z"), (None, None, None, None, None, None, None), (1003, long, "en", "web", len(long), 4, "t")] + rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard int, item_id string")
    for _, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, DIR)
        assert after.columns == docs.columns
        docs = spark.createDataFrame(after.collect(), docs.schema)
    ids = [r.doc_id for r in docs.collect()]
    assert set(ids) <= {r[0] for r in rows} and all(ids.count(i) <= 2 for i in set(ids))
