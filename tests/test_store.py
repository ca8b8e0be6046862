import random
import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lineloom.catalog import QUERIES
from lineloom.operators.numbering import number_lines
from lineloom.sources import lines as L
from lineloom.sources.store import LineStore, wanted_ranges

DIR = "/root/testdata/sf0.001"
RECORDS = "dataset string, ord long, tie long, lines array<string>"


def rows_of(df):
    return sorted(((r.dataset is not None, r.dataset or "", r.line_number, r.text) for r in df.collect()))


def records(n, names, seed):
    rng = random.Random(seed)
    return [(rng.choice(names), rng.choice([None, *range(40)]), i, [f"{seed}.{i}.{k}" for k in range(rng.randrange(4))]) for i in range(n)]


def files(path, dataset):
    key = "n" if dataset is None else "d" + dataset.encode().hex().upper()
    return {f: f.stat().st_mtime_ns for f in Path(path).glob(f"*/key={key}/**/*.parquet")}


@pytest.mark.parametrize("width", [1, 7, 4096])
def test_same_numbers_as_without_a_store(spark, tmp_path, width):
    df = spark.createDataFrame(records(400, ["a", "B/c=%", "", None, "é"], 1), RECORDS).repartition(5)
    store = LineStore(spark, str(tmp_path / "s"))
    assert store.lines().count() == 0
    store.append(df, width)
    want = number_lines(df)
    assert rows_of(store.lines()) == rows_of(want)
    assert {(r.dataset, r.lines) for r in store.totals().collect()} == {(r.dataset, r["count"]) for r in want.groupBy("dataset").count().collect()}


def test_appended_lines_go_on_from_the_counters(spark, tmp_path):
    store, given = LineStore(spark, str(tmp_path / "s")), []
    for seed in (1, 2, 3):
        batch = records(60, ["a", "b", None][: seed if seed > 1 else 3], seed)
        before = {n: files(tmp_path / "s", n) for n in ("a", "b", None)}
        store.append(spark.createDataFrame(batch, RECORDS), 8)
        for n, old in before.items():
            assert old.items() <= files(tmp_path / "s", n).items()
        given += [(d, (o if o is not None else -1) + 1000 * seed, t, ls) for d, o, t, ls in batch]
    assert rows_of(store.lines()) == rows_of(number_lines(spark.createDataFrame(given, RECORDS)))


def test_replaced_datasets_leave_the_others_alone(spark, tmp_path):
    store, path = LineStore(spark, str(tmp_path / "s")), tmp_path / "s"
    store.append(spark.createDataFrame(records(80, ["a", "b", "c"], 1), RECORDS))
    store.append(spark.createDataFrame(records(80, ["a", "b"], 2), RECORDS))
    kept, untouched = rows_of(store.lines().where("dataset = 'c'")), files(path, "c")
    new = spark.createDataFrame(records(50, ["a", "b", "d"], 3), RECORDS)
    old = set(files(path, "a"))
    store.replace(new)
    assert rows_of(store.lines()) == sorted(kept + rows_of(number_lines(new)))
    assert files(path, "c") == untouched and not old & set(files(path, "a"))
    store.append(spark.createDataFrame([("a", 1, 1, ["last"])], RECORDS))
    assert store.lines().where("dataset = 'a'").orderBy(F.desc("line_number")).first().text == "last"


def test_a_write_that_fails_is_not_seen_and_can_be_repeated(spark, tmp_path, monkeypatch):
    store, first, second = LineStore(spark, str(tmp_path / "s")), records(40, ["a"], 1), records(40, ["a", "b"], 2)
    store.append(spark.createDataFrame(first, RECORDS))
    want = rows_of(store.lines())
    from pyspark.sql.readwriter import DataFrameWriter

    write, fails = DataFrameWriter.parquet, [True]

    def broken(self, path, *args, **more):
        if "/counters" in path and str(tmp_path) in path and fails:
            raise OSError("no space")
        return write(self, path, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", broken)
    with pytest.raises(OSError):
        store.append(spark.createDataFrame(second, RECORDS))
    assert rows_of(store.lines()) == want
    fails.clear()
    store.append(spark.createDataFrame(second, RECORDS))
    assert len(rows_of(store.lines())) == sum(len(r[3]) for r in first + second)


def test_files_are_sorted_and_scans_are_pruned(spark, tmp_path):
    store = LineStore(spark, str(tmp_path / "s"))
    store.append(spark.createDataFrame([(d, i, 0, [f"{d} {i}"]) for d in ("a", "b") for i in range(3000)], RECORDS).repartition(7), 100)
    for file in (tmp_path / "s/lines").rglob("*.parquet"):
        numbers = pq.read_table(file, partitioning=None)["line_number"].to_pylist()
        assert numbers == sorted(numbers)
    refs = spark.createDataFrame([("a", 10), ("a", 20), ("b", None)], "dataset string, line_number int")
    found = store.lines(wanted_ranges(refs))
    assert rows_of(found) == [(True, "a", n, f"a {n - 1}") for n in range(10, 21)]
    plan = found._jdf.queryExecution().explainString(found._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert re.search(r"PartitionFilters: .*key", plan) and re.search(r"PushedFilters: .*line_number,10", plan) and plan.count("Scan parquet") == 2 and "Exchange" not in plan


def test_hundreds_of_ranges(spark, tmp_path):
    """Apart, next to each other, one in another, empty and of a dataset that isn't there."""
    store = LineStore(spark, str(tmp_path / "s"))
    store.append(spark.createDataFrame([(d, i, 0, [f"{d} {i}"]) for d in ("a", "b") for i in range(4000)], RECORDS).repartition(3), 500)
    ranges = [(d, n, n + n % 4) for d in ("a", "b") for n in range(3, 4000, 8)] + [("a", 7, 30), ("a", 31, 33), ("a", 20, 25), ("b", 9, 8), ("none", 1, 5), ("b", None, None)]
    found = rows_of(store.lines(spark.createDataFrame(ranges, "dataset string, lo long, hi long")))
    assert found == [(True, d, n, f"{d} {n - 1}") for d in ("a", "b") for n in sorted({n for of, lo, hi in ranges if of == d and lo for n in range(lo, min(hi, 4000) + 1)})]


@pytest.mark.parametrize("name", ["doc_lines", "line_hash", "event_lines", "turn_lines"])
def test_line_queries_are_one_scan(spark, name):
    df = QUERIES[name](spark, DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan


def test_a_changed_table_is_numbered_anew(spark, tmp_path):
    for text in ("one\ntwo", "three"):
        spark.createDataFrame([(1, "en", text)], "doc_id long, lang string, text string").write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        assert [r.text for r in L.document_lines(spark, str(tmp_path)).orderBy("line_number").collect()] == text.split("\n")
