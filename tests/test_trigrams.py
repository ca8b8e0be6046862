import random
import re

import pytest

from lineloom.catalog import QUERIES
from lineloom.operators import trigrams as T
from lineloom.sources import lines as L

DIR = "/root/testdata/sf0.01"
LINES = "dataset string, line_number int, text string"


@pytest.mark.parametrize(
    ("pattern", "alternatives"),
    [
        ("abcd", [{"abc", "bcd"}]), ("abc|xyz", [{"abc"}, {"xyz"}]), ("(?:abc|xyz)d+efg", [{"abc", "efg"}, {"efg", "xyz"}]), ("abc?de", None), ("abcd?efg", [{"abc", "efg"}]), ("abc+", [{"abc"}]),
        ("(abc)?def", [{"def"}]), ("(abc){2}def", [{"def"}]), ("abc(x|)", [{"abc"}]), ("ab.c", None), (r"a\.bc", [{"a.b", ".bc"}]), (r"\d{3} failed", [{" fa", "fai", "ail", "ile", "led"}]),
        ("[abc]def", [{"def"}]), ("[]abc]def", [{"def"}]), (r"[\]abc]def", [{"def"}]), ("[a[b]c]def", None), ("(?!abc)def", [{"def"}]), ("(?<=abc)def", [{"def"}]), ("(?<key>abc)d", [{"abc"}]), ("(?i)abc", None),
        (r"\Qabc", None), ("abc(", None), ("abc)", None), ("éabcé", [{"abc"}]), ("", None), ("abc|", None), ("ABC", [{"abc"}]), (r"\p{Alpha}abc", [{"abc"}]), (r"\x41abc", None), ("(abc", None),
    ],
)
def test_what_a_regex_needs(pattern, alternatives):
    assert {frozenset(a) for a in T.needed(pattern)} == {frozenset(a) for a in alternatives or [{""}]}


def test_needs_hold_in_every_match():
    """Whatever a random pattern finds holds all trigrams of an alternative."""
    rng, parts, found = random.Random(5), ["ab", "c", "ba?", "(ab|ca)", "[ab]", "c+", ".", "(b|cc)?", "a{2}", "(?:ac|b)+", "bca", "|", "^", "(?=a)"], 0
    for _ in range(3000):
        pattern = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 6)))
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(12)))
        if re.search(pattern, text):
            found += 1
            assert any(all(g in text for g in a) for a in T.needed(pattern)), (pattern, text)
    assert found > 500


def specs_and_lines():
    rng = random.Random(7)
    word = lambda n, of="abAB é%_İıſKΣςσ": "".join(rng.choice(of) for _ in range(n))
    lines = [(rng.choice(["x", "y", None]), i + 1, word(rng.randrange(30))) for i in range(9000)] + [("x", 9500, None), ("y", 20_000, ""), ("x", 300_001, "b" * 50_000 + "ab%_abé😀x")]
    specs = [(rng.choice(["x", "y", None, "none"]), f"s{i}", word(rng.randrange(6)), False, rng.random() < 0.5) for i in range(60)]
    specs += [(None, "empty", "", False, True), (None, "null", None, False, False), (None, "nullre", None, True, False), ("x", "long", "bab%_a", False, False), (None, "emoji", "é😀x", False, True), (None, "case", "AB", False, None)]
    specs += [(None, f"r{i}", r, True, exact) for i, (r, exact) in enumerate([("ab+A", True), ("kis|sik", False), ("aba|bab", False), ("(ba|ab)%_", False), (".", True), ("[aé]bab?a", False), ("σaΣ", False), ("isa", False)])]
    return lines, specs


def test_same_as_a_full_scan(spark, tmp_path):
    lines, specs = specs_and_lines()
    df, wanted = spark.createDataFrame(lines, LINES), spark.createDataFrame(specs, T.SPECS)
    index, asked = T.build(df, str(tmp_path / "i")), []

    def read(ranges):
        asked.extend(ranges.collect())
        wide = ranges.selectExpr("dataset as d", "lo", "hi")
        return df.join(wide, df.dataset.eqNullSafe(wide.d) & df.line_number.between(wide.lo, wide.hi), "left_semi")

    got = {(r.dataset, r.spec_id, r.line_number) for r in index.search(wanted, read).collect()}
    df.createOrReplaceTempView("given_lines")
    wanted.createOrReplaceTempView("given_specs")
    full = spark.sql(
        """SELECT l.dataset, spec_id, line_number FROM given_lines l JOIN given_specs s ON (s.dataset IS NULL OR s.dataset = l.dataset) AND CASE WHEN pattern THEN rlike(text, if(coalesce(case_sensitive, false), literal, '(?iu)' || literal))
        WHEN coalesce(case_sensitive, false) THEN contains(text, literal) ELSE contains(lower(text), lower(literal)) END"""
    )
    want = {(r.dataset, r.spec_id, r.line_number) for r in full.collect()}
    assert got == want and len(want) > 1000 and len(asked) <= T.RANGES + 3
    assert any(i == "long" and n == 300_001 for _, i, n in got) or any(i == "emoji" for _, i, _ in got)
    monitored = {(r.dataset, r.spec_id): (r.read, r.blocks) for r in index.blocks(wanted).collect()}
    assert monitored["x", "long"][0] < monitored["x", "long"][1] and monitored["x", "empty"][0] == monitored["x", "empty"][1]


def test_lists_longer_than_the_pushed_filter(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "LISTED", 3)
    monkeypatch.setattr(T, "RANGES", 2)
    test_same_as_a_full_scan(spark, tmp_path)


def test_no_lines_no_specs(spark, tmp_path):
    lines, specs = spark.createDataFrame([("x", 1, "abc")], LINES), spark.createDataFrame([("x", "s", "abc", False, True)], T.SPECS)
    assert T.build(lines, str(tmp_path / "a")).search(specs.limit(0), lambda r: lines).count() == 0
    assert T.build(lines.limit(0), str(tmp_path / "b")).search(specs, lambda r: lines.limit(0)).count() == 0
    assert T.build(lines, str(tmp_path / "c")).search(specs, lambda r: lines).count() == 1


def test_the_index_prunes_the_tables(spark):
    share = {(r.dataset, r.spec_id): r.read / r.blocks for r in QUERIES["index_blocks"](spark, DIR).collect()}
    assert share["en", "any_license"] < 0.5 and share["en", "presence_absent"] < 0.5 and share["fr", "any_short"] == 1
    plan = L.index(spark, DIR, "documents").candidates(spark.createDataFrame([("en", "a", "License", False, True)], T.SPECS))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(gram, " in plan
