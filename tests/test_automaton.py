import functools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lineloom.catalog import QUERIES, SQL
from lineloom.operators import automaton as A

SPECS = "dataset string, spec_id string, literal string, case_sensitive boolean"


def brute(lines, specs):
    out = []
    for d, n, t in lines:
        for own, i, literal, exact in specs:
            if t is not None and literal is not None and own in (None, d) and (literal in t if exact else literal.lower() in t.lower()):
                out.append((d or "", i, literal, n, t))
    return sorted(out)


@pytest.mark.parametrize("part", [8 << 20, 600])
def test_against_brute_force(spark, monkeypatch, part):
    """In one automaton and in several."""
    monkeypatch.setattr(A, "PART", part)
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abAB é%_'") for _ in range(n))
    lines = [(rng.choice(["x", "y", None]), i, word(rng.randrange(30))) for i in range(400)] + [("x", 900, None), ("y", 901, ""), ("x", 902, "a" * 50_000 + "Bé")]
    specs = [(rng.choice(["x", "y", None, "none"]), f"s{i}", word(rng.randrange(5)), rng.random() < 0.5) for i in range(150)]
    specs += [(None, "empty", "", True), (None, "null", None, False), ("x", "twice", "ab", True), ("x", "twice2", "ab", True), (None, "all", "aB", False), (None, "part", "a", True)]
    got = A.many_matches(spark.createDataFrame(lines, "dataset string, line_number int, text string"), spark.createDataFrame(specs, SPECS))
    assert sorted((r.dataset or "", r.spec_id, r.literal, r.line_number, r.text) for r in got.collect()) == brute(lines, specs)


@pytest.mark.parametrize("chunk", [24 << 20, 100])
@pytest.mark.parametrize("part", [8 << 20, 600])
def test_counts_against_brute_force(spark, monkeypatch, part, chunk):
    """In one automaton and by runs: rows that share a number or have none, literals in several runs of a row, characters whose lower case is longer or ASCII, equal specs."""
    monkeypatch.setattr(A, "PART", part)
    monkeypatch.setattr(A, "_runs", functools.partial(chunked, A._runs, chunk))
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice(["a", "b", "A", "B", "é", "É", "ã", " ", "%", "ab", "\u0130", "\u212a", "k", "i", "ΑΣ", "€"]) for _ in range(n))
    lines = [(rng.choice(["x", "y", None]), rng.choice([None, *range(50)]), word(rng.randrange(30))) for _ in range(500)] + [("x", 900, None), ("y", 901, ""), ("x", 902, "ab" * 30_000 + "Bé"), ("x", 903, "ab abab ABab bab")]
    specs = [(rng.choice(["x", "y", None, "none"]), f"s{i % 120}", word(rng.randrange(1, 5)), rng.choice([True, False, None])) for i in range(150)]
    specs += [(None, "all", "ab", True), (None, "all", "ab", True), ("x", "all", "ab", True), (None, "all", "ab", False), (None, "accent", "É", False), (None, "null", None, True), (None, "kelvin", "K", False)] + [(None, "empty", "", True), ("y", "empty", "", False)] * (part == 600)
    got = A.many_counts(spark.createDataFrame(lines, "dataset string, line_number int, text string").repartition(3), spark.createDataFrame(specs, SPECS))
    want = {}
    low = {r.t: r.low for r in spark.createDataFrame([(t,) for t in {t for _, _, t in lines} | {s[2] for s in specs} if t is not None], "t string").select("t", F.lower("t").alias("low")).collect()}
    for d, n, t in lines:
        for own, i, literal, exact in specs:
            if t is not None and literal is not None and own in (None, d) and (literal in t if exact else low[literal] in low[t]):
                want.setdefault((d, i, literal), []).append(n)
    want = {(*k, len(v), min((n for n in v if n is not None), default=None), max((n for n in v if n is not None), default=None)) for k, v in want.items()}
    rows = [tuple(r) for r in got.select("dataset", "spec_id", "literal", "n", "first_line", "last_line").collect()]
    assert set(rows) == want and len(rows) == len(want)


def chunked(runs, chunk, alphabets):
    """Set in the tasks, which don't see what a test patches."""

    def run(batches):
        A.CHUNK, A.PIECE = chunk, 10 * chunk
        yield from runs(alphabets)(batches)

    return run


@pytest.mark.parametrize("part", [8 << 20, 100])
def test_counts_read_lines_once(spark, monkeypatch, part):
    """However many automata there are."""
    monkeypatch.setattr(A, "PART", part)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    lines = spark.range(0, 20_000, 1, 2).select(F.lit("x").alias("dataset"), F.col("id").alias("line_number"), F.concat(F.lit("common words again and again "), F.col("id") % 5).alias("text"))
    specs = spark.createDataFrame([(None, f"{w}{n}", w, n == 0) for w in ("common", "again", "words", "comm", "agai") for n in range(2)], SPECS)
    got = A.many_counts(lines.mapInArrow(counted, lines.schema), specs).collect()
    assert [(r.n, r.first_line, r.last_line) for r in got] == [(20_000, 0, 19_999)] * 10 and read.value == 20_000


def test_no_specs_no_lines(spark):
    lines, specs = spark.createDataFrame([("x", 1, "a")], "dataset string, line_number int, text string"), spark.createDataFrame([("x", "s", "a", True)], SPECS)
    assert A.many_counts(lines, specs.limit(0)).count() == 0 and A.many_counts(lines.limit(0), specs).count() == 0


def test_thousands_of_literals_are_one_scan(spark):
    at = "/root/testdata/sf0.01"
    df = QUERIES["literal_many"](spark, at)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
    db = duckdb.connect()
    for t in ("documents", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet'")
    want = db.execute(SQL["literal_many"])
    order = [d[0] for d in want.description]
    got = sorted(tuple(r[c] for c in order) for r in df.collect())
    assert got == sorted(want.fetchall()) and len({r[order.index("literal")] for r in got}) > 1000
    assert df.where(F.col("n") < 1).count() == 0
