import random
import re

import xxhash

from lineloom.llm import simhash as S

SCHEMA = "doc_id long, text string, fp string, component string"


def brute_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows):
    fps = [(i, brute_print(t)) for i, t in rows]
    label = list(range(len(fps)))
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a][1] ^ fps[b][1]).bit_count() <= 3 and label[a] != label[b]:
                old = label[a]
                label = [label[b] if x == old else x for x in label]
    least = {}
    for (i, _), c in zip(fps, label, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return sorted((i if i is not None else -1, f"{f:016x}", least.get(c)) for (i, f), c in zip(fps, label, strict=True))


def corpus():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(80)] + ["Été", "\u00a0x"]
    texts = ["", None, " \t\n", "one", "one two", "ONE two", "same same same same"]
    for _ in range(40):
        t = [rng.choice(words) for _ in range(rng.randint(1, 400))]
        texts.append(" ".join(t))
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = "changed"
            texts.append("  ".join(t))
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts)]
    return rows + rows[:9] + [(None, texts[20]), (None, "only here and without an id")]


def test_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in corpus()], SCHEMA)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id) for r in S.near_duplicates(df).collect())
    assert got == components(corpus())


def test_large_blocks_keep_every_link(spark):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(6)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(20), k)) for c in centres for k in (0, 1, 2, 3, 4) for _ in range(40)}
    fps = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f, f) for f in fps], "id long, fp long")
    small = {r.fp: r.component_id for r in S.fingerprint_classes(df).collect()}
    label = {f: f for f in fps}
    for _ in fps:
        before = dict(label)
        for a in fps:
            label[a] = min(label[b] for b in fps if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
        if label == before:
            break
    assert small == label
    links = S.fingerprint_links(df.select("fp"), block=16)  # many chunks give the same components
    from lineloom.operators.components import connected_components

    got = {r.node: r.component for r in connected_components(links).collect()}
    assert all(got.get(f, f) == label[f] for f in fps)


def test_keep_one(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    kept = S.keep_one(df).collect()
    assert df.columns == list(kept[0].asDict())
    groups = {(c, f) if c is None else c for _, f, c in components(rows)}
    assert len(kept) == len(groups)
    assert S.keep_one(df.limit(0)).count() == 0 and S.near_duplicates(df.limit(0)).count() == 0


def similar(rows):
    """Smallest id of each component of rows whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    sets = []
    for _, t in rows:
        w = (t or "").split()
        sets.append({" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label, found = list(range(len(rows))), []
    for a in range(len(rows)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                found.append((sets[a], sets[b]))
                if label[a] != label[b]:
                    old = label[a]
                    label = [label[b] if x == old else x for x in label]
    return found, sorted(min(i for (i, _), c in zip(rows, label, strict=True) if c == k) for k in set(label))


def test_keep_one_similar_finds_edited_copies(spark):
    rng = random.Random(5)
    rows = [(1, ""), (2, None), (3, "one two"), (4, "ONE two".lower()), (5, "one two three")]
    for n in (30, 60, 120, 400, 1500):
        for _ in range(12):
            t = [f"w{rng.randrange(3000)}" for _ in range(n)]
            for share in (0, 0.01, 0.02, 0.021, 0.022, 0.03):  # up to the edge of similarity 0.8, and beyond
                copy = list(t)
                for at in rng.sample(range(n), int(n * share)):
                    copy[at] = f"new{rng.randrange(10**6)}"
                rows.append((len(rows) * 7 % 1009 + 10, " ".join(copy)))
    found, want = similar(rows)
    far = sum((S.fingerprint(rows[a][1]) ^ S.fingerprint(rows[b][1])).bit_count() > 3 for a in range(5, len(rows)) for b in range(5 + (a - 5) // 6 * 6, a))
    assert far and len(found) > 100
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    assert sorted(r.doc_id for r in S.keep_one_similar(df).collect()) == want
    assert S.keep_one_similar(df.limit(0)).count() == 0


def test_keep_one_similar_in_large_buckets(spark):
    rng = random.Random(6)
    line = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(300):
        t = list(line)
        for at in rng.sample(range(60), rng.choice([0, 1, 1, 2, 3])):
            t[at] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    assert sorted(r.doc_id for r in S.keep_one_similar(df, block=16).collect()) == similar(rows)[1]


def test_keep_one_similar_begins_with_the_pivot_search(spark, monkeypatch):
    """The stage gets pairs from fingerprints within three bits, and the exact check decides on them."""
    rng = random.Random(8)
    rows = [(0, ""), (1, None)]
    for n in (8, 60, 400):
        for _ in range(6):
            t = [f"w{rng.randrange(3000)}" for _ in range(n)]
            for edits in (0, 0, 1, n // 40, n // 20):
                copy = list(t)
                for at in rng.sample(range(n), edits):
                    copy[at] = f"new{rng.randrange(10**6)}"
                rows.append((len(rows), " ".join(copy)))
            rows.append((len(rows), " ".join(t + t)))  # another set, an almost equal fingerprint
    texts = spark.createDataFrame(rows, "id long, text string")
    sets = {r.digest: r for r in S.sketches(texts).collect()}
    assert {r.fp for r in sets.values()} == {S.fingerprint(t, S.WIDE) - (S.fingerprint(t, S.WIDE) >> 63 << 64) for _, t in rows}
    linked = {d: d for d, r in sets.items() if r.n}
    for a in linked:
        for b in linked:
            if linked[a] != linked[b] and ((sets[a].fp ^ sets[b].fp) & (1 << 64) - 1).bit_count() <= S.BITS:
                linked = {k: min(linked[a], linked[b]) if v in (linked[a], linked[b]) else v for k, v in linked.items()}
    pairs = S.pivot_pairs(spark.createDataFrame(list(sets.values())), block=16)
    from lineloom.operators.components import connected_components

    got = {r.node: r.component for r in connected_components(pairs).collect()}
    assert len(got) > 20 and {d: got.get(d, d) for d in linked} == linked
    called, search = [], S.fingerprint_links
    monkeypatch.setattr(S, "fingerprint_links", lambda *a, **k: called.append(1) or search(*a, **k))
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    assert sorted(r.doc_id for r in S.keep_one_similar(df).collect()) == similar(rows)[1]
    assert called
