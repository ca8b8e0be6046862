import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from lineloom.catalog import QUERIES, SQL
from lineloom.functions import text as X
from lineloom.operators import groups as G
from lineloom.operators import numbering, positional
from lineloom.operators.components import connected_components
from lineloom.plans import guard
from lineloom.sources import corpus
from lineloom.sources import lines as L

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


def norm(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    one = lambda v: "NULL" if v is None else repr(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(one(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, db, name):
    df = QUERIES[name](spark, DIR)
    want = db.execute(SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert norm([[r[c] for c in columns] for r in df.collect()], columns) == norm(want.fetchall(), columns)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


#: The line contract's vectors, with bytes that aren't UTF-8 and all terminators.
VECTORS = [b"", b"a", b"a\n", b"a\nb", b"a\nb\n", b"a\nb\n\n", b"a\r\nb\r\n", b"a\r\nb", b"mixed\nunix\r\nwindows\rmac\n", b"trailing space \r\n", b"a\xffb\r\n", b"a\rb", b"\xe2\x82", b"x\x0by\x0cz\x1c1\x1d2\x1e3\xc2\x854\xe2\x80\xa85\xe2\x80\xa96"]


def test_line_contract(spark):
    df = spark.createDataFrame([(i, bytearray(v)) for i, v in enumerate(VECTORS)], "i int, content binary")
    got = {r.i: r.ls for r in df.select("i", X.split_lines(X.decode(F.col("content"))).alias("ls")).collect()}
    assert got == {i: v.decode("utf-8", errors="replace").splitlines() for i, v in enumerate(VECTORS)}


def test_corpus_files_and_partitions(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "Linux_2k.log").write_bytes(b"one\r\ntwo\n")
    (tmp_path / "in" / "Apache_2k.log").write_bytes(b"x\ny\nz\n")
    files = L.corpus_files(spark, str(tmp_path / "in"))
    lines = L.file_lines(files)
    L.write_lines(lines, str(tmp_path / "out"))
    L.write_lines(lines.where("dataset = 'linux'").withColumn("text", F.upper("text")), str(tmp_path / "out"))
    assert [(r.line_number, r.text) for r in L.read_lines(spark, str(tmp_path / "out"), "linux").orderBy("line_number").collect()] == [(1, "ONE"), (2, "TWO")]
    assert L.read_lines(spark, str(tmp_path / "out"), "apache").count() == 3
    lock = files.select("dataset", F.when(F.col("dataset") == "apache", F.col("sha256")).otherwise("sha256:0").alias("sha256")).unionByName(spark.createDataFrame([("gone", "sha256:1")], "dataset string, sha256 string"))
    assert {r.dataset: r.status for r in corpus.verify_digests(files, lock, lines).collect()} == {"apache": "ok", "linux": "changed", "gone": "missing"}
    assert corpus.contained_path(str(tmp_path), "in/x.log").name == "x.log"
    with pytest.raises(ValueError):
        corpus.contained_path(str(tmp_path), "../x")


def test_numbering_in_ranges(spark):
    rows = [("a", i, 0, ["x"] * (i % 4)) for i in range(200)] + [("b", None, 0, ["n"]), ("b", 5, 0, ["y", "z"])]
    df = spark.createDataFrame(rows, "dataset string, ord long, tie int, lines array<string>")
    for width in (7, 1000):
        got = numbering.number_lines(df, width=width).collect()
        n = sum(i % 4 for i in range(200))
        assert sorted(r.line_number for r in got if r.dataset == "a") == list(range(1, n + 1))
        assert [(r.line_number, r.text) for r in sorted(got, key=lambda r: r.line_number) if r.dataset == "b"] == [(1, "n"), (2, "y"), (3, "z")]


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000, 1000 + i) for i in range(1, 300)] + [(2000 + i, 2001 + i) for i in range(100)] + [(7, 7), (None, 3)]
    label = {}
    for a, b in [(a, b) for a, b in edges if a is not None and a != b]:
        x, y = label.setdefault(a, {a}), label.setdefault(b, {b})
        if x is not y:
            x |= y
            for n in y:
                label[n] = x
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {n: min(s) for n, s in label.items()}


def test_windows_clip(spark):
    lines = spark.createDataFrame([("d", i, f"l{i}") for i in range(1, 9)], "dataset string, line_number int, text string")
    near = positional.context(lines, lines.where("line_number in (1, 8)"), [], 2, 2)
    assert sorted((r.anchor, r.line_number) for r in near.collect()) == [(1, 1), (1, 2), (1, 3), (8, 6), (8, 7), (8, 8)]


def test_salience_and_gaps(spark):
    texts = ["start", "plain 1", "plain 2", "an ERROR here", "plain 3", "plain 4", "a timeout", "plain 5", "plain 6", "end"]
    rows = spark.createDataFrame([("d", "k", i + 1, t) for i, t in enumerate(texts)], "dataset string, key string, line_number int, text string")
    kept = G.salient(rows, ["dataset", "key"], 4)
    assert sorted(r.line_number for r in kept.collect()) == [1, 4, 7, 10]
    block = G.gap_blocks(kept, ["dataset", "key"], "key").first().block
    assert block.startswith("[Group: k] 4 line(s):\nstart\n  ... (more lines follow between these) ...\nan ERROR here\n")


def test_matching_is_greedy(spark):
    rng = random.Random(2)
    pairs = [("d", f"a{rng.randrange(40)}", f"b{rng.randrange(40)}", i) for i in range(300)]
    used, want = set(), []
    for _, a, b, rk in pairs:
        if a not in used and b not in used:
            used |= {a, b}
            want.append(rk)
    got = G.greedy_matching(spark.createDataFrame(pairs, "dataset string, a string, b string, rk int")).collect()
    assert sorted(r.rk for r in got) == want


def test_text_functions(spark):
    row = spark.range(1).select(
        X.slug(F.lit(" Ab--C.9! ")).alias("slug"), X.evidence_id(F.lit("d"), F.lit(123456789), F.lit("sha256:0123456789abcdefXX")).alias("ref"), X.sentences(F.lit("One. Two?  Three! ")).alias("s"),
        X.labelled_field(F.lit("x\n ENTITY : host a\nentity: b"), "ENTITY").alias("entity"), X.labelled_field(F.lit("OUTCOME:\n"), "OUTCOME").alias("outcome"), X.csv_safe(F.lit("=1")).alias("safe"), X.csv_unsafe(F.lit("'=1")).alias("unsafe"),
        X.verdict(F.lit("1) Yes: fine\n2) no"), 2).alias("v2"), X.verdict(F.lit("1) yes"), 3).alias("v3"), X.without_thinking(F.lit("<think>a\nb</think> c")).alias("t"), X.normal_sql(F.lit("  SELECT\n 1 ")).alias("sql"),
    ).first()
    assert row.asDict() == {"slug": "ab_c_9", "ref": "d:line:123456789:0123456789abcdef", "s": ["One.", "Two?", "Three!"], "entity": "host a", "outcome": "not stated", "safe": "'=1", "unsafe": "=1", "v2": "no", "v3": "partial", "t": "c", "sql": "select 1"}


@pytest.mark.parametrize("bad", ["", "  ", "DROP TABLE x", "SELECT 1; SELECT 2", "WITH a AS (SELECT 1) INSERT INTO b SELECT * FROM a", "set x = 1"])
def test_guard_refuses(bad):
    with pytest.raises(ValueError):
        guard.check(bad)


def test_guard_allows():
    assert guard.check(" select 'drop; it' ; ") == "select 'drop; it'"
    assert guard.check("WITH a AS (SELECT 1) SELECT * FROM a").startswith("WITH")
