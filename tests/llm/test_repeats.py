import hashlib
import random
from collections import Counter

import pytest

from lineloom.llm import repeats as R

SCHEMA = "doc_id long, text string, k1 string, raw int"


def brute(texts):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + 400] for r in raws for i in range(len(r) - 399))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - 399):
            if seen[r[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        runs = sum(1 for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(r, gone) if not g)).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [prose(rng.randint(40, 140)) for _ in range(5)]
    texts = ["", None, "short", "x" * 399, "y" * 400, "z" * 401, "q" * 900, "ab" * 500, "abc " * 400, "0123456789" * 90 + prose(20)]
    for _ in range(40):
        t = prose(rng.randint(5, 300))
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(t))
            t = t[:at] + rng.choice(passages)[rng.randint(0, 30) :] + t[at:]
        texts.append(t)
    for t in rng.sample(texts, 12):  # exact and near copies
        texts.append(t)
        if t:
            at = rng.randint(0, len(t))
            texts.append(t[:at] + "ZZ" + t[at:])
            texts.append(prose(3) + t + prose(4) + t[: len(t) // 2])
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    texts = corpus(seed)
    rows = [(i, t, "clash", 7) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == dict(enumerate(brute(texts)))


def test_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(R, "PIECE", 2048)
    texts = corpus(4)
    for raw in [(t or "").encode() for t in texts]:
        monkeypatch.setattr(R, "PIECE", 2048)
        cut = sorted(zip(*[x.tolist() for x in R.blocks(raw)]))
        monkeypatch.setattr(R, "PIECE", 1 << 20)
        assert cut == sorted(zip(*[x.tolist() for x in R.blocks(raw)]))


def test_repeated_rows_null_ids_and_empty_table(spark):
    t = corpus(5)[20] * 3
    rows = [(None, t, "", 0), (None, t, "", 0), (1, t, "", 0), (1, t, "", 0), (2, None, "", 0)]
    got = sorted(((r.doc_id or 0, r.n_bytes, r.n_removed) for r in R.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()))
    n = len(t.encode())
    assert got == [(0, n, n), (0, n, n), (1, n, n), (1, n, n), (2, 0, 0)]
    assert R.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def shares(texts, n):
    """Rows with a run of n words that a row of another text has."""
    grams = {}
    for i, t in enumerate(texts):
        w = (t or "").encode().split()
        for k in range(len(w) - n + 1):
            grams.setdefault(tuple(w[k : k + n]), set()).add(t)
    return {i for i, t in enumerate(texts) for w in [(t or "").encode().split()] if any(len(grams[tuple(w[k : k + n])]) > 1 for k in range(len(w) - n + 1))}


@pytest.mark.parametrize("seed", [6, 7])
def test_passages_of_over_fifty_words(spark, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in (40, 45, 48, 53, 56, 60, 70)]  # 51 words have some 330 bytes here
    texts = [f"{prose(rng.randint(0, 60))} {rng.choice(passages)} {prose(rng.randint(0, 60))}" for _ in range(60)] + [prose(rng.randint(1, 300)) for _ in range(40)] + passages[4:5]
    got = {r.doc_id for r in R.remove_repeats(spark.createDataFrame([(i, t, "", 0) for i, t in enumerate(texts)], SCHEMA)).collect() if r.passage_words}
    assert got == shares(texts, 51) == shares(texts, 53)


def test_one_passage_in_front_of_many_texts(spark, monkeypatch):
    """A group of copies and near copies that every range border cuts."""
    rng = random.Random(9)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8))) for _ in range(n))
    hot = prose(120)
    texts = [prose(rng.randint(0, 9)) + " " + hot[rng.randint(0, 40) :] for _ in range(150)] + [hot[:at] + "#" + hot[at:] for at in rng.sample(range(len(hot)), 150)] + [hot] * 20 + [hot[: rng.randint(300, len(hot))] for _ in range(100)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.remove_repeats(spark.createDataFrame([(i, t, "", 0) for i, t in enumerate(texts)], SCHEMA)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == dict(enumerate(brute(texts)))


def test_open_windows_name_few_others(spark, monkeypatch):
    """Entries of a large group are named by cells; single windows only where an open one may have an equal."""
    rng = random.Random(11)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8))) for _ in range(n))
    before, after = prose(60), prose(80)
    texts = [prose(60) + before[-60:] + after[:240] + prose(60) for _ in range(200)]  # less than a window in common
    for _ in range(40):  # how much is shared on one side says nothing of the other side
        x, y = rng.randint(20, 260), rng.randint(100, 380)
        texts.append(prose(1) + before[-x:] + after[:y] + prose(2))
    kept, cut = {}, R.cut
    monkeypatch.setattr(R, "cut", lambda df, tag: kept.setdefault(tag, []).append(cut(df, tag)) or kept[tag][-1])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.remove_repeats(spark.createDataFrame([(i, t, "", 0) for i, t in enumerate(texts)], SCHEMA)).collect()}
    assert got == dict(enumerate(brute(texts)))
    opened = {r.core: r.cells for r in kept["open"][0].collect()}
    every = sum(opened[r.core] >> x // R.CELL & 1 for r in kept["entries"][0].collect() if r.core in opened for x in range(r.place & 255, (r.place >> 8 & 255) + 1))
    named = kept["cells"][0].count(), kept["windows"][0].count()
    assert opened and every > 2000 and 0 < sum(named) * 2 < every, (every, named)
