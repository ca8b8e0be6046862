import duckdb

from lineloom.llm import mixing as M
from lineloom.llm.queries import SQL

SCHEMA = "doc_id long, text string, source string, size string, order string"


def rows():
    out = [(i, "w " * (i * 37 % 200), f"s{i % 7}" if i % 3 else "hot", "x", "y") for i in range(900)]
    return out + [(1000, None, None, "x", "y"), (1001, "a\u00a0b c", None, "x", "y"), (None, "one two three", "s1", "x", "y"), (None, "one two three", "s1", "x", "y"), (1002, "", "empty", "x", "y"), (5, "w " * 185, "s5", "x", "y")]


def test_against_sql(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = M.mix(df)
    first = sorted(map(str, got.collect()))
    assert first == sorted(map(str, M.mix(df.repartition(5)).collect()))
    db = duckdb.connect()
    documents = df.select("doc_id", "text", "source").toArrow()
    db.register("documents", documents)
    want = db.execute(SQL["op7_source_mixing"]).fetchall()
    names = ["doc_id", "size", "source_size", "target", "taken", "repeats"]
    key = lambda r: tuple(round(v, 6) if isinstance(v, float) else -1 if v is None else v for v in r)
    assert sorted(key(r[n] for n in names) for r in got.collect()) == sorted(map(key, want))


def test_targets_are_met(spark):
    got = M.mix(spark.createDataFrame(rows(), SCHEMA), keep=("source",)).collect()
    total = sum(r["size"] for r in got)
    assert abs(sum({r.source: r.target for r in got}.values()) - 1.5 * total) < 1e-6
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert all(r.taken <= 2 * r["size"] for r in own)
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r["size"] for r in own) / 2 + 1
        assert own[0].target <= 2 * own[0].source_size + 1e-6


def test_flow_prefers_few_repetitions():
    flow = M.cheapest_flow([((0,), 10), ((0, 1), 10)], [15, 10])  # twenty first uses, five repetitions
    assert sum(flow) == 25 and min(flow) >= 10
    assert M.cheapest_flow([((0,), 10), ((1,), 10)], [20, 5]) == [20, 5]
    assert M.cheapest_flow([((0,), 0)], [0]) == [0]


def test_overlapping_sources_and_empty_table(spark):
    df = spark.createDataFrame([(i, "w " * 10, ["a"] if i % 2 else ["a", "b"]) for i in range(200)] + [(999, "w", [])], "doc_id long, text string, source array<string>")
    got = M.mix(df).collect()
    assert abs(sum(r.taken for r in got) - 1.5 * sum(r["size"] for r in got)) <= 40
    assert M.mix(df.limit(0)).count() == 0


def test_take_mix(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    taken = M.take_mix(df)
    assert taken.columns == df.columns
    assert taken.count() == sum(r.repeats for r in M.mix(df).collect())
