import random
import re

from lineloom.llm import licenses as Z


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at, labels = [], set()
    for phrase, label in Z.PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        at += found
        labels |= {label} if found else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_base_places(spark):
    rng = random.Random(6)
    bits = ["GNU General Public License", "the MIT-License!", "cc", "by", "CC BY-NC 4.0", "apache license", "gnu general", "public license", "licen\u212a", "été", "x_y", "MIT", "license", "\n\n", "İ"]
    texts = ["", None, "mit license", "license", "cc by cc by"] + [" ".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(120)]
    df = spark.createDataFrame([(i, t, 0, "c", 1) for i, t in enumerate(texts)], "doc_id long, text string, pos int, label string, n int")
    got = {r.doc_id: r for r in Z.scan(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(t), t
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_templates_with_edits(spark):
    mit = Z.TEMPLATES["mit"].split()
    edited = mit[:20] + ["indeed"] + mit[20:35] + mit[36:]
    texts = [" ".join(mit), "noise " * 30 + " ".join(edited), " ".join(mit[:12]), " ".join(reversed(mit)), " ".join(w for x in mit for w in (x, "gap"))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in Z.scan(df).collect()}
    assert [got[i].labels for i in range(5)] == ["mit", "mit", "", "", ""]
    assert got[0].score == 1 and 0.6 < got[1].score < 1


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "mit license"), (1, "mit license"), (None, "cc by"), (None, "cc")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_base) for r in Z.scan(df).collect()) == [(0, 0), (0, 1), (1, 1), (1, 1)]
    assert Z.scan(df.limit(0)).count() == 0


def diagonals(text):
    """Labels and score by a double loop over all word positions of text and templates."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    labels, best = set(brute(text)[4].split(",")) - {""}, 1.0 if brute(text)[1] else 0.0
    for label, template in Z.TEMPLATES.items():
        t = template.split()
        k = Z.SHORT_GRAM if len(t) <= Z.GRAM + 1 else Z.GRAM
        grams, votes = len(t) - k + 1, {}
        for i in range(len(w) - k + 1):
            for j in range(grams):
                if w[i : i + k] == t[j : j + k]:
                    votes.setdefault(i - j, []).append(i)
        if len(t) <= 5:
            hit = any(len(v) == grams for v in votes.values())
            labels |= {label} if hit else set()
            best = max(best, float(hit))
            continue
        run, last = [], None
        for d in [*sorted(votes), None]:
            if run and (d is None or d - last > Z.DRIFT):
                share = min(1.0, len(run) / grams)
                if share >= Z.SHARE and max(run) - min(run) <= 2 * len(t):
                    labels.add(label)
                    best = max(best, share)
                run = []
            if d is not None:
                run += votes[d]
                last = d
    return ",".join(sorted(labels)), best


def test_labels_and_score_by_a_double_loop(spark):
    rng = random.Random(11)
    texts = []
    for _ in range(80):
        words = ["x"] * rng.randint(0, 12)
        for name in rng.sample(sorted(Z.TEMPLATES), rng.randint(0, 2)):
            t = Z.TEMPLATES[name].split()
            t = t[rng.randint(0, len(t) // 2) * rng.randint(0, 1) :]
            for _ in range(rng.randint(0, 4)):
                at = rng.randrange(len(t))
                t[at : at + rng.randint(0, 1)] = rng.choice([["odd"], [], ["The", "license"]])
                t = t or ["x"]
            words += t + ["y"] * rng.randint(0, 9)
        texts.append(" ".join(words))
    texts.append(" ".join([Z.TEMPLATES["isc"]] * 400))  # a long text
    got = {r.doc_id: (r.labels, round(r.score, 9)) for r in Z.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: (a, round(b, 9)) for i, (a, b) in enumerate(map(diagonals, texts))}
    assert len({a for a, _ in got.values()}) > 8
