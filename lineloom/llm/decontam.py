"""Benchmark decontamination by size-partitioned MinHash containment search.

Short test items are searched inside long documents. Items are partitioned by size:
a partition holds those whose number of distinct word shingles has the same binary
logarithm. The sketch of an item holds its smallest shingle hashes, as many as its
partition and the threshold ask for: of an item with n shingles, n - ceil(t n) may be
missing from a document that contains a share t of it, so one of the
n - ceil(t n) + 1 smallest must be there. The partition's largest n sets the length,
so sketches lose no pair, however long the document.

1. Search: the documents' shingles are joined to the sketches alone. A document and
   an item that share a sketch shingle are candidates.
2. Verification: the shingles of candidate documents are joined to all shingles of
   the items, word by word, and the share that candidates hold is counted.

Scale. Documents never move in the search: their shingles are built in the scan and
matched there. Sketches, items and the keys of candidate documents are broadcast only
if their counted rows are within a bound; beyond it the sides are joined by hash, with
repeated shingles merged per document first. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lineloom.llm.rows import text_key
from lineloom.storage import cut

SHINGLE, THRESHOLD, INDEX = 5, 0.8, 1_000_000
SEPARATORS = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; a null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS), lambda w: w != "")


def _shingles(w: Column, size: int) -> Column:
    """Structs of ``size`` consecutive words; none in a shorter text."""
    n = F.size(w) - (size - 1)
    return F.when(n > 0, F.arrays_zip(*[F.slice(w, i + 1, n).alias(f"w{i}") for i in range(size)]))


def _exploded(rows: DataFrame, text_col: str, size: int, keep: list[Column]) -> DataFrame:
    split = rows.select(*keep, words(F.col(text_col)).alias("w"))
    names = [f"w{i}" for i in range(size)]
    zipped = split.select(*[c for c in split.columns if c != "w"], F.explode(_shingles(F.col("w"), size)).alias("s"))
    fields = [f.name for f in zipped.schema["s"].dataType.fields]
    return zipped.select(*[c for c in zipped.columns if c != "s"], *[F.col(f"s.`{f}`").alias(n) for f, n in zip(fields, names, strict=True)]).withColumn("h", F.xxhash64(*names))


def item_index(items: DataFrame, item_id: str = "item_id", text_col: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """A row per item and distinct shingle: ``item``, ``n``, its size partition ``part``, ``h``, the words and ``in_sketch``.

    Items with a null id or fewer than ``size`` words have none. Rows that repeat an
    id are one item with the shingles of all.
    """
    names = [f"w{i}" for i in range(size)]
    rows = _exploded(items.where(F.col(item_id).isNotNull()), text_col, size, [F.col(item_id).alias("item")]).distinct()
    by_hash = Window.partitionBy("item").orderBy("h", *names)
    ranked = rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("item"))).withColumn("r", F.row_number().over(by_hash))
    sized = ranked.withColumn("part", F.floor(F.log2("n")).cast("int"))
    largest = F.pow(F.lit(2), F.col("part") + 1).cast("long") - 1  # of any item of the partition
    sketch = largest - F.ceil(largest * F.lit(threshold) - 1e-9) + 1
    return sized.select("item", "n", "part", "h", *names, (F.col("r") <= sketch).alias("in_sketch"))


def _matches(found: DataFrame, index: DataFrame, names: list[str], bound: int) -> DataFrame:
    """Shingles of documents with the items that have them."""
    if index.count() <= bound:
        index = F.broadcast(index)
    else:
        found = found.distinct()
    d, i = found.alias("d"), index.alias("i")
    same = F.col("d.h") == F.col("i.h")
    for n in names:
        same = same & (F.col(f"d.{n}") == F.col(f"i.{n}"))
    return d.join(i, same).select("d.id", "d.text_hash", "i.item", "i.n", "d.h", *[f"d.{n}" for n in names])


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD, bound: int = INDEX) -> DataFrame:
    """``(id_col, text_hash, item, shingles, shared, containment)`` of pairs at or above ``threshold``.

    Containment is the share of the item's distinct word shingles that the document
    has. Documents are told apart by id (null included) and text, so repeated rows
    give one result. Null and short texts on either side contain nothing. Whole
    texts are read, however long; other columns and their names don't matter.
    """
    names = [f"w{i}" for i in range(size)]
    keys = [F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash")]
    index = cut(item_index(items, item_id, item_text, size, threshold), "items")
    hits = _matches(_exploded(docs, text_col, size, keys), index.where("in_sketch").drop("in_sketch", "part"), names, bound)
    candidates = cut(hits.select("id", "text_hash", "item").distinct(), "candidates")
    few = candidates.select(F.col("id").alias("__lineloom_id"), F.col("text_hash").alias("__lineloom_hash")).distinct()
    some = docs.join(F.broadcast(few) if few.count() <= bound else few, text_key(id_col, text_col, "__lineloom_id", "__lineloom_hash"), "left_semi")
    seen = _matches(_exploded(some, text_col, size, keys), index.drop("in_sketch", "part"), names, bound).distinct().alias("s")
    c = candidates.alias("c")
    pair = F.col("s.id").eqNullSafe(F.col("c.id")) & (F.col("s.text_hash") == F.col("c.text_hash")) & (F.col("s.item") == F.col("c.item"))
    pairs = seen.join(c, pair, "left_semi").groupBy("id", "text_hash", "item", "n").agg(F.count(F.lit(1)).alias("shared"))
    passed = pairs.where(F.col("shared") >= F.ceil(F.col("n") * F.lit(threshold) - 1e-9))
    return passed.select(F.col("id").alias(id_col), "text_hash", F.col("item").alias(item_id), F.col("n").alias("shingles"), "shared", (F.col("shared") / F.col("n")).alias("containment"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = INDEX, **options) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns kept.

    A row leaves only if its own text contains an item; null ids are like any other,
    rows that repeat each other all stay or all leave, and columns of any name are
    kept. The keys of what leaves are broadcast within ``bound``, else joined.
    """
    bad = cut(contained_items(docs, items, id_col, text_col, bound=bound, **options).select(F.col(id_col).alias("__lineloom_id"), F.col("text_hash").alias("__lineloom_hash")).distinct(), "contaminated")
    return docs.join(F.broadcast(bad) if bad.count() <= bound else bad, text_key(id_col, text_col, "__lineloom_id", "__lineloom_hash"), "left_anti")
