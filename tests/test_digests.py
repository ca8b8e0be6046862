import random

import pytest
from pyspark.sql import functions as F

from lineloom.operators import digests as D
from lineloom.operators import validation as V

LINES = "dataset string, line_number int, text string"


def rows_of(df):
    return sorted(((r.dataset or "", r.problem, r.line_number, r.n) for r in df.collect()), key=repr)


def in_ranges(df):
    def read(ranges):
        if ranges is None:
            return df
        wide = ranges.selectExpr("dataset as d", "lo", "hi")
        return df.join(wide, df.dataset.eqNullSafe(wide.d) & df.line_number.between(wide.lo, wide.hi), "left_semi")

    return read


def corpus(n, seed=1):
    rng = random.Random(seed)
    return [(d, i + 1, rng.choice(["", "a", "b" * 200, None, f"line {i}"])) for d, m in (("x", n), ("y", n // 7), ("é/", 3)) for i in range(m)]


CHANGES = {
    "same": lambda rows: rows, "text": lambda rows: [(d, n, "other" if (d, n) in (("x", 700), ("x", 701), ("y", 2)) else t) for d, n, t in rows], "gone": lambda rows: [r for r in rows if r[:2] != ("x", 900)],
    "more": lambda rows: [*rows, ("x", 40_000, "far"), ("z", 1, "new dataset")], "null": lambda rows: [(d, n, "" if t is None else t) for d, n, t in rows], "fewer": lambda rows: [r for r in rows if r[0] != "y"],
    "twice": lambda rows: [*rows, *[r for r in rows if r[:2] == ("x", 5)]], "thrice": lambda rows: [*rows, *2 * [r for r in rows if r[:2] == ("x", 5)]], "none": lambda rows: [], "zero": lambda rows: [*rows, ("x", 0, "before")],
}


@pytest.mark.parametrize("name", CHANGES)
def test_same_as_a_full_comparison(spark, tmp_path, name):
    before = corpus(2000)
    a, b = spark.createDataFrame(before, LINES), spark.createDataFrame(CHANGES[name](before), LINES)
    trees = [D.build(df, str(tmp_path / k)) for k, df in (("a", a), ("b", b))]
    assert rows_of(D.difference(trees[0], in_ranges(a), trees[1], in_ranges(b))) == rows_of(V.corpus_difference(a, b))
    if name in ("twice", "thrice"):  # repeats are flaws of the table's own numbers
        assert rows_of(D.difference(trees[1], in_ranges(b), trees[0], in_ranges(a))) == rows_of(V.corpus_difference(b, a))


def test_roots_tell_lines_apart_and_not_their_order(spark, tmp_path):
    rows = corpus(900)
    root = lambda k, given: {r.dataset: r.corpus_sha256 for r in D.build(spark.createDataFrame(given, LINES).repartition(3), str(tmp_path / k)).roots().collect()}
    first = root("a", rows)
    assert root("b", rows[::-1]) == first and len(set(first.values())) == 3
    for k, name in enumerate(("text", "gone", "null", "twice")):
        other = root(f"c{k}", CHANGES[name](rows))
        assert other["x"] != first["x"] and other["é/"] == first["é/"]
    assert root("d", CHANGES["thrice"](rows))["x"] != root("e", CHANGES["twice"](rows))["x"]


def test_lines_without_dataset_or_number(spark, tmp_path):
    rows = [(None, 1, "a"), ("x", None, "b"), ("x", 1, "c"), (None, None, None)]
    a, b = spark.createDataFrame(rows, LINES), spark.createDataFrame([*rows[:1], ("x", None, "B"), *rows[2:]], LINES)
    x, y = D.build(a, str(tmp_path / "a")), D.build(b, str(tmp_path / "b"))
    assert D.differing_leaves(x, x).count() == 0
    assert {(r.dataset, r.node) for r in D.differing_leaves(x, y).collect()} == {("x", D.UNNUMBERED)}
    got = [r for r in rows_of(D.difference(x, in_ranges(a), y, in_ranges(b))) if r[1] != "numbering"]
    assert got == [("x", "extra", None, 1), ("x", "missing", None, 1)]
    assert [tuple(r) for r in D.first_difference(x, y)[0].collect()] == [("x", None, None)]


def test_descent_compares_few_ranges(spark, tmp_path, monkeypatch):
    """With small leaves: one change among 20,000 lines is found with at most a fan for each level."""
    monkeypatch.setattr(D, "LEAF", 64)
    monkeypatch.setattr(D, "FAN", 4)
    a = spark.range(20_000).select(F.lit("x").alias("dataset"), (F.col("id") + 1).cast("int").alias("line_number"), F.concat(F.lit("t"), "id").alias("text"))
    b = a.withColumn("text", F.when(F.col("line_number").isin(13_131, 17_000), "changed").otherwise(F.col("text")))
    x, y = D.build(a, str(tmp_path / "a")), D.build(b, str(tmp_path / "b"))
    found, compared = D.first_difference(x, y)
    assert [tuple(r) for r in found.collect()] == [("x", 13_131 // 64 * 64 + 1, 13_131 // 64 * 64 + 64)]
    assert len(compared) == x.height + 1 == 6 and max(compared) <= 4
