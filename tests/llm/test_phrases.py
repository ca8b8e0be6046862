import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from lineloom.llm import phrases as P
from lineloom.llm.queries import QUERIES, SQL

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, most=2000, share=100):
    f = {}
    for lang, text in rows:
        own = f.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(ASCII)):
            words = re.findall("[^ \t]+", piece)
            own.update(tuple(words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    out = []
    for lang, own in f.items():
        n = sum(c for p, c in own.items() if len(p) == 1)
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        inside = {q[i:j]: 0 for q in found for i in range(len(q)) for j in range(i + 2, len(q) + 1) if j - i < len(q)}
        for q, a in found.items():
            for i in range(len(q)):
                for j in range(i + 2, len(q) + 1):
                    if j - i < len(q):
                        inside[q[i:j]] = max(inside[q[i:j]], a)
        rows_ = []
        for p, a in found.items():
            if 100 * inside.get(p, -1) >= share * a:
                continue
            score, k = min((1000 * a * n // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, left, right, n, -s) for r, (s, a, p, left, right) in enumerate(sorted(rows_)[:most])]
    return sorted(out)


def told(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect())


def random_texts(n, seed=4):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "é", " x", "ab", "zu"]
    fixed = ["new york city of the", "one two three four five six", "a  a\ta a a"]
    return [(rng.choice(["en", "de", "und", None]), "".join(rng.choice([*words, rng.choice(fixed)]) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"]) for _ in range(rng.randint(0, 60)))) for _ in range(n)]


def test_against_brute_force(spark):
    rows = [*random_texts(300), ("en", None), ("en", ""), ("en", " .,;"), ("fr", "once only"), *[("de", "Same row twice")] * 40]
    df = spark.createDataFrame([(x, t, 1, "c") for x, t in rows], "lang string, text string, k int, phrase string")
    got = told(P.collocations(df, least=25))
    assert got == brute(rows, 25) and len({r[0] for r in got}) >= 3
    assert told(P.collocations(df, least=25, most=3, share=60)) == brute(rows, 25, 3, 60)


def test_what_the_sample_misses_is_found(spark, monkeypatch):
    """Without proposals, with wrong ones and with a filter that holds everything the counts are the same."""
    rows = random_texts(200, 5)
    texts = P.prepared(spark.createDataFrame(rows, "lang string, text string"), "text", "lang")
    told_ = lambda df: sorted(map(tuple, df.collect()))
    want = told_(P.frequent(texts, 30))
    wrong = spark.createDataFrame([("en", "the"), ("en", "no such"), ("de", "one two three four"), ("de", "two three four five")], "lang string, phrase string")
    assert told_(P.frequent(texts, 30, wrong)) == want
    assert told_(P.frequent(texts, 30, wrong.limit(0))) == want
    assert told_(P.frequent(texts, 30, wrong, size=64)) == want
    assert {r[1] for r in want} == {0, 1, 2, 3, 4, 5}


def test_gains_alone_are_what_a_whole_count_tells():
    """Over random texts, proposals and filters so small that they hold much by mistake."""

    def filled(phrases, size):
        bits = np.zeros(size // 8, np.uint8)
        for phrase in phrases:
            for spot in P._spots(P.reduce(P._joined, [P._word_hashes("en", [w]) for w in phrase.split(b" ")]), size):
                bits[int(spot[0]) >> 3] |= 1 << (int(spot[0]) & 7)
        return bits

    for seed in range(30):
        rng = random.Random(seed)
        words = [rng.choice([*(b"w%d" % i for i in range(12)), P._MARK]) for _ in range(rng.choice([4, 5, 300]))]
        parts = [b" ".join(words[i : i + k]) for k in (1, 2, 3, 4) for i in range(len(words) - k + 1) if P._MARK not in words[i : i + k]]
        size = rng.choice([64, 256, 1 << 16])
        old = filled(rng.sample(parts, len(parts) // rng.choice([1, 2, 3])), size)
        bits = old | filled(rng.sample(parts, len(parts) // rng.choice([4, 8, 30])), size)
        for longest, tail in ((4, 0), (5, 4)):
            whole, gains = Counter(), Counter()
            for found, counts in ((P._count_block("en", list(words), tail, bits, old, False, longest), whole), (P._count_gain(list(words), "en", tail, bits, old, bits & ~old, longest), gains)):
                for _, phrases, n in found:
                    counts.update(dict(zip(phrases.to_pylist(), map(int, n), strict=True)))
            assert whole == gains


def test_languages_of_any_name(spark):
    rows = [(x, "one two\tone two") for x in ("a\tb", "", " ", "\t") for _ in range(3)]
    assert told(P.collocations(spark.createDataFrame(rows, "lang string, text string"), least=5)) == [(x, *r[1:]) for x in sorted({r[0] for r in rows}) for r in brute([("q", r[1]) for r in rows[:3]], 5)]


def test_pieces_longer_than_a_block(spark, monkeypatch):
    """A text of one piece and a word, both longer than a block: no phrase is lost at an edge."""
    rng = random.Random(6)
    rows = [("en", " ".join(rng.choice(["alpha", "beta", "gamma delta", "w" * 300]) for _ in range(4000))), ("en", "x" * 5000 + " beta alpha beta")]
    batch = pa.RecordBatch.from_pydict({"lang": [r[0] for r in rows], "text": [r[1] for r in rows]})
    assert len(list(P._blocks(batch))) == 1
    monkeypatch.setattr(P, "BLOCK", 500)
    counts = Counter()
    for lang, words, tail in P._blocks(batch):
        for k, found, n in P._count_block(lang, list(words), tail, None, None, True):
            counts.update({(k, p): int(c) for p, c in zip(found.to_pylist(), n, strict=True)})
        for k in range(2, 6):
            ids = words[: len(words)]
            counts.update((k, b" ".join(ids[i : i + k])) for i in range(len(ids) - tail) if i + k <= len(ids) and P._MARK not in ids[i : i + k])
    want = Counter()
    for _, t in rows:
        words = t.encode().split()
        want.update((k, b" ".join(words[i : i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
        want[0, b""] += len(words)
    assert counts == want


def test_empty_and_rare(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert P.collocations(df).count() == 0
    assert P.collocations(spark.createDataFrame([("en", "a b c"), (None, None)], "lang string, text string")).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_sql(spark, sf):
    at = f"/root/testdata/{sf}"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{at}/documents.parquet'")
    want = db.execute(SQL["op13_phrase_collocations"])
    order = [[d[0] for d in want.description].index(c) for c in COLUMNS]
    got = told(QUERIES["op13_phrase_collocations"](spark, at))
    assert got and got == sorted(tuple(r[i] for i in order) for r in want.fetchall())


def test_further_passes_join_only_parts_whose_words_are_known(monkeypatch):
    rng = np.random.default_rng(3)
    known = [b"a", b"b", b"c"]
    words = [known[rng.integers(3)] if rng.random() < 0.3 else b"rare%d" % rng.integers(500) for _ in range(4000)] + [b"\xff"]
    h = P._word_hashes("en", known)
    old, gain = (np.zeros(1 << 13, np.uint8) for _ in range(2))
    for bits, hashes in ((old, h), (gain, P._joined(h[:2], h[1::-1]))):
        for spot in P._spots(hashes, len(bits) * 8):
            np.bitwise_or.at(bits, (spot >> np.uint64(3)).astype(np.int64), np.left_shift(np.uint8(1), (spot & np.uint64(7)).astype(np.uint8)))
    now = old | gain
    tell = lambda found: sorted((k, x, n) for k, p, c in found for x, n in zip(p.to_pylist(), c.tolist()))
    want = tell(P._count_block("en", list(words), 0, now, old, False))
    sizes, joined = [], P._joined
    monkeypatch.setattr(P, "_joined", lambda first, word: sizes.append(len(first)) or joined(first, word))
    assert tell(P._count_gain(list(words), "en", 0, now, old, now & ~old)) == want and want
    assert sum(sizes) < len(words)  # three joins of all places before
