import random
import re

from lineloom.llm import decontam as D


def brute(docs, items):
    def shingles(t):
        w = [x for x in re.split(r"[^a-zé0-9]+", (t or "").lower()) if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = {}
    for i, t in items:
        if i is not None:
            sets[i] = sets.get(i, set()) | shingles(t)
    return sorted({(d if d is not None else -1, i, len(s & x), len(s)) for d, t in docs for x in [shingles(t)] for i, s in sets.items() if s and len(s & x) >= 0.8 * len(s) - 1e-9})


def fixture():
    rng = random.Random(4)
    words = [f"é{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(3, 40)))) for i in range(30)] + [(None, "a b c d e f"), (30, None), (31, ""), (0, "x1 x2 x3 x4 x5 x6")]
    docs = []
    for d in range(60):
        t = [rng.choice(words) for _ in range(rng.randint(0, 150))]
        w = (items[rng.randrange(30)][1] or "").upper().split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = "other"
        docs.append((d, " ".join(t[:50] + w + t[50:])))
    return docs + docs[:3] + [(None, docs[0][1]), (None, None), (99, "")], items


def test_against_brute_force(spark):
    docs, items = fixture()
    df = spark.createDataFrame([(d, t, 0, "x") for d, t in docs], "doc_id long, text string, n int, item string")
    it = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, w0 string")
    for bound in (D.INDEX, 10):  # broadcast, and joined by hash
        got = D.contained_items(df, it, bound=bound).collect()
        assert sorted({(r.doc_id if r.doc_id is not None else -1, r.item_id, r.shared, r.shingles) for r in got}) == brute(docs, items)


def test_clean(spark):
    docs, items = fixture()
    df = spark.createDataFrame([(d, t, 0, "x") for d, t in docs], "doc_id long, text string, n int, item string")
    it = spark.createDataFrame(items, "item_id long, text string")
    bad = {d for d, *_ in brute(docs, items)}
    kept = D.clean(df, it)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(d for d, _ in docs if d is not None and d not in bad)
    assert D.clean(df, it.limit(0)).count() == len(docs) and D.clean(df.limit(0), it).count() == 0
