"""Hard negatives by an inverted multi-index, exact by certificates.

Vectors are cut into two halves, and each half has a codebook of its own, fitted on a
bounded sample. A pair of codes is a cell; every row lies in one. With the codes'
radii, measured over all rows, the product of a query with a code's centre bounds its
product with every half vector of that code, and the bounds of two halves add up. The
multi-sequence heap gives a query its cells by falling bound.

A search looks for a query's best rows inside a window of scores and has two steps.
The first reads the heap's first cells. Its results bound what can still come: a cell
whose bound is below a window's last row, or below the window, is certified to hold
nothing of it, and the second step reads all other cells. Results are exact.

Scale. Codebooks, radii and cell sizes are bounded (``CODES`` a half). Rows move once
to blocks of about ``BLOCK`` rows, which are runs of cells; a cell with more rows, such
as that of one vector repeated, has several blocks. A query goes to the blocks that
hold cells it asks for, once for each, and each block returns its best rows alone.
How many blocks that is depends on the vectors: with no structure, bounds of halves
exclude little, and a search comes near to all rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lineloom.storage import cut

CODES, SAMPLE, CELL, BLOCK, FIRST, SEED = 256, 32768, 64, 4096, 2048, 12
POSITIVES, NEGATIVES, QUANTUM = 5, 10, 256
#: Rows whose squared norm is beyond this have products that leave 64 bits.
NORM = 1 << 62
#: The window of all scores.
ALL = (-(1 << 63), (1 << 63) - 1)

_SPAN = "array<struct<key: long, lo: long, hi: long>>"
_FOUND = "query_id long, key long, id long, score long"


@dataclass
class Index:
    """Codebooks, radii, cell sizes and where cells lie; all bounded by ``CODES``."""

    centres: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    sizes: np.ndarray
    first: np.ndarray
    splits: np.ndarray

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each half: what its product with a row of each code cannot pass."""
        half = self.centres[0].shape[1]
        out = []
        for part, centre, radius in zip((q[:half], q[half:]), self.centres, self.radii, strict=True):
            size = np.linalg.norm(part)
            slack = 1e-9 * size * (np.linalg.norm(centre, axis=1).max() + radius.max()) + 1e-6
            out.append(centre @ part + size * radius + slack)
        return out[0], out[1]

    def cells(self, q: np.ndarray) -> Iterator[tuple[float, int]]:
        """``(bound, cell)`` by falling bound: the multi-sequence heap over two ordered halves."""
        one, two = self.bounds(q)
        a, b = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
        one, two, codes = one[a].tolist(), two[b].tolist(), len(b)
        a, b = a.tolist(), b.tolist()
        heap, done = [(-(one[0] + two[0]), 0, 0)], [0] * len(a)  # done: cells of each row of the grid that were given
        while heap:
            bound, i, j = heapq.heappop(heap)
            yield -bound, a[i] * codes + b[j]
            done[i] = j + 1
            if j + 1 < codes and (i == 0 or done[i - 1] > j + 1):
                heapq.heappush(heap, (-(one[i] + two[j + 1]), i, j + 1))
            if i + 1 < len(a) and done[i + 1] == j:
                heapq.heappush(heap, (-(one[i + 1] + two[j]), i + 1, j))

    def wanted(self, q: np.ndarray, least: float, skip: int = 0, rows: float = np.inf) -> list[int]:
        """Cells whose bound is ``least`` at least, after the first ones with ``skip`` rows, up to the first with ``rows``."""
        out, before = [], 0
        for bound, cell in self.cells(q):
            if bound < least or before >= rows:
                break
            if before >= skip and self.sizes[cell]:
                out.append(cell)
            before += int(self.sizes[cell])
        return out


def _codebook(x: np.ndarray, codes: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centre = x[rng.choice(len(x), codes, replace=False)]
    for _ in range(rounds):
        near = _nearest(x, centre)
        n = np.bincount(near, minlength=codes)
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        centre = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], x[rng.integers(len(x), size=codes)])
    return centre


def _nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return ((centre**2).sum(axis=1)[None, :] - 2 * x @ centre.T).argmin(axis=1)


def _vectors(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def build(rows: DataFrame, n: int, d: int) -> tuple[DataFrame, Index]:
    """``rows`` (id, label, vec) with their block and cell, written once, and the index."""
    codes = int(min(CODES, max(1, (n / CELL) ** 0.5)))
    half, rng = d // 2, np.random.default_rng(SEED)
    share = min(1.0, 2 * SAMPLE / n)
    drawn = rows.select("vec", F.xxhash64(F.lit(SEED), "id", "vec").alias("h")).where(F.pmod("h", F.lit(1 << 24)) < int(share * (1 << 24))).orderBy("h").limit(SAMPLE).select("vec").toArrow()
    sample = _vectors(drawn.column(0).combine_chunks(), d).astype(np.float64) if drawn.num_rows >= codes else None
    if sample is None:
        codes, sample = 1, np.zeros((1, d))
    centres = (_codebook(sample[:, :half], codes, rng), _codebook(sample[:, half:], codes, rng))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _vectors(b.column(2), d).astype(np.float64)
            parts = (x[:, :half], x[:, half:])
            near = [_nearest(p, c) for p, c in zip(parts, centres, strict=True)]
            away = [np.linalg.norm(p - c[k], axis=1) for p, c, k in zip(parts, centres, near, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(k.astype(np.int32)) for k in near], *[pa.array(r) for r in away]], names=["id", "label", "vec", "a", "b", "ra", "rb"])

    placed = cut(rows.mapInArrow(place, "id long, label long, vec array<long>, a int, b int, ra double, rb double"), "placed")
    cells = placed.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("ra").alias("ra"), F.max("rb").alias("rb")).toArrow()  # a row for each cell
    a, b, count = (cells.column(c).to_numpy() for c in ("a", "b", "n"))
    radii = (np.zeros(codes), np.zeros(codes))
    np.maximum.at(radii[0], a, cells.column("ra").to_numpy())
    np.maximum.at(radii[1], b, cells.column("rb").to_numpy())
    sizes = np.zeros(codes * codes, np.int64)
    sizes[a * codes + b] = count
    splits = np.maximum(1, -(-sizes // BLOCK))
    first, at, room = np.zeros(len(sizes), np.int64), 0, 0
    for cell in np.flatnonzero(sizes):
        if room + sizes[cell] > BLOCK and room:
            at, room = at + 1, 0
        first[cell] = at
        room += sizes[cell]
        if splits[cell] > 1:
            at, room = at + splits[cell], 0
    index = Index(centres, (radii[0] * (1 + 1e-9) + 1e-6, radii[1] * (1 + 1e-9) + 1e-6), sizes, first, splits)
    return placed.withColumn("cell", F.col("a") * codes + F.col("b")).select("id", "label", "vec", "cell"), index


def _in_blocks(placed: DataFrame, index: Index) -> DataFrame:
    """The block of each row; of a cell with several, one by hash."""
    spark = placed.sparkSession
    some = np.flatnonzero(index.sizes)
    where = spark.createDataFrame(pa.table({"cell": pa.array(some.astype(np.int32)), "first": pa.array(index.first[some]), "splits": pa.array(index.splits[some])}))
    joined = placed.join(F.broadcast(where), "cell")  # at most CODES x CODES rows
    return joined.select((F.col("first") + F.pmod(F.xxhash64("id", "vec"), F.col("splits"))).alias("block"), "id", "label", "vec", "cell")


def _asker(index, d: int, step: int):
    """Queries (id, label, vec, spans, least) as rows (block, id, label, vec, spans, cells)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Index = index.value
        for b in batches:
            x = _vectors(b.column(2), d).astype(np.float64)
            at, blocks, cells = [], [], []
            for row, (q, least) in enumerate(zip(x, b.column(4).to_pylist(), strict=True)):
                wanted = held.wanted(q, least, rows=FIRST) if step == 1 else held.wanted(q, least, skip=FIRST)
                by: dict[int, list[int]] = {}
                for cell in wanted:
                    for block in range(held.first[cell], held.first[cell] + held.splits[cell]):
                        by.setdefault(block, []).append(cell)
                at += [row] * len(by)
                blocks += by
                cells += by.values()
            take = pa.array(np.array(at, np.int64))
            columns = [b.column(n).take(take) for n in range(4)]
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), *columns, pa.array(cells, pa.list_(pa.int32()))], names=["block", "id", "label", "vec", "spans", "cells"])

    return run


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact products: in doubles where every partial sum fits 53 bits, else in whole numbers."""
    if float(np.linalg.norm(q.astype(np.float64), axis=1).max()) * float(np.linalg.norm(x.astype(np.float64), axis=1).max()) < 1 << 52:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def _best(k: int, same: bool, d: int):
    """The first ``k`` rows of each window, block by block; rows before queries."""

    def pick(ids, labels, x, cells, queries) -> Iterator[tuple]:
        order = np.argsort(ids, kind="stable")
        ids, labels, x, cells = ids[order], labels[order], x[order], cells[order]
        for at in range(0, len(queries), 256):
            part = queries[at : at + 256]
            scores = _products(np.stack([q[2] for q in part]), x)
            for (own, label, _, spans, asked), s in zip(part, scores, strict=True):
                able = ((labels == label) == same) & (ids != own) & np.isin(cells, asked)
                some = np.flatnonzero(able)
                s = s[some]
                for span in spans:
                    here = np.flatnonzero((s >= span["lo"]) & (s <= span["hi"]))
                    if len(here) > k:
                        edge = np.partition(s[here], len(here) - k)[len(here) - k]
                        here = here[s[here] >= edge]
                    here = here[np.argsort(-s[here], kind="stable")][:k]  # ids rise already
                    yield from ((own, span["key"], int(ids[some[i]]), int(s[i])) for i in here)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, queries = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if rows and queries:
                found = list(pick(*(np.concatenate([r[n] for r in rows]) for n in range(4)), queries))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["query_id", "key", "id", "score"])

        for b in batches:
            blocks, kinds = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.concatenate([[True], (blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1]), [True]])) if len(blocks) else []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if blocks[lo] != block:
                    yield from flush()
                    block, rows, queries = blocks[lo], [], []
                one = b.slice(lo, hi - lo)
                ids, labels, x = one.column(2).to_numpy(), one.column(3).to_numpy(), _vectors(one.column(4), d)
                if kinds[lo]:
                    queries += zip(ids.tolist(), labels.tolist(), x, one.column(5).to_pylist(), one.column(6).to_pylist(), strict=True)
                else:
                    rows.append((ids, labels, x, one.column(7).to_numpy()))
        yield from flush()

    return run


def search(blocks: DataFrame, index: Index, queries: DataFrame, k: int, same: bool, d: int) -> DataFrame:
    """``(query_id, key, id, score, rank)``: of each query (id, label, vec, spans) and window the first ``k`` rows with the query's label, or with others."""
    spark = blocks.sparkSession
    held = spark.sparkContext.broadcast(index)

    def step(asked: DataFrame, number: int) -> DataFrame:
        sent = asked.mapInArrow(_asker(held, d, number), f"block long, id long, label long, vec array<long>, spans {_SPAN}, cells array<int>")
        both = blocks.select("block", F.lit(False).alias("asks"), "id", "label", "vec", F.lit(None).cast(_SPAN).alias("spans"), F.lit(None).cast("array<int>").alias("cells"), "cell")
        both = both.unionByName(sent.select("block", F.lit(True).alias("asks"), "id", "label", "vec", "spans", "cells", F.lit(None).cast("int").alias("cell")))
        return both.repartition("block").sortWithinPartitions("block", "asks").mapInArrow(_best(k, same, d), _FOUND)

    best = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), F.asc("id"))
    first_k = lambda df: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    queries = queries.withColumn("least", F.array_min(F.transform("spans", lambda s: s["lo"])).cast("double"))
    first = cut(first_k(step(queries.select("id", "label", "vec", "spans", "least"), 1)), "first")
    last = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), "key", "score")
    windows = queries.select("id", F.explode("spans").alias("span")).select("id", F.col("span.key").alias("key"), F.col("span.lo").alias("lo"))
    need = windows.join(last, ["id", "key"], "left").groupBy("id").agg(F.min(F.coalesce("score", "lo")).cast("double").alias("least"))
    rest = step(queries.drop("least").join(need, "id").select("id", "label", "vec", "spans", "least"), 2)
    return first_k(first.drop("rank").unionByName(rest))


def mine(table: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = 30, high: int = 90, quantum: int = QUANTUM, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components become ``floor(quantum * x)``, scores are inner products of those. An
    anchor's positives are its first rows of the same label; a positive's negatives
    are the first rows of other labels whose score lies between ``low`` and ``high``
    per cent of the positive's. Higher scores come first, ties go to the smaller id. A
    negative positive score has no window.

    No part take: null ids and labels; vectors that are null or hold null or non-finite
    components, have another dimension than most, or a squared norm beyond 2**62, whose
    products no long holds. Zero and empty vectors are vectors. Rows that repeat an id
    are rows of their own; they are no partners of each other, and an anchor's id asks
    once, with the smallest of its labels and vectors. Other columns are not read,
    whatever their names. An empty table has no rows.
    """
    spark = table.sparkSession
    vec, empty = F.col(f"`{vec_col}`").cast("array<double>"), "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    sound = F.coalesce(vec.isNotNull() & F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    norm = F.aggregate(vec, F.lit(0.0), lambda t, c: t + F.floor(c * quantum).cast("double") * F.floor(c * quantum).cast("double"))
    usable = F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & sound
    rows = table.where(usable).where(norm < NORM).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), F.transform(vec, lambda c: F.floor(c * quantum).cast("long")).alias("vec"), F.coalesce(anchors, F.lit(False)).alias("asks")
    )
    dims = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if dims is None:
        return spark.createDataFrame([], empty)
    d, n = dims
    if d == 0:  # all scores are zero, and so no codes can tell the rows
        rows, d = rows.withColumn("vec", F.array(F.lit(0).cast("long"))), 1
    else:
        rows = rows.where(F.size("vec") == d)
    placed, index = build(rows.drop("asks"), n, d)
    blocks = cut(_in_blocks(placed, index), "blocks")
    asked = cut(rows.where("asks").groupBy("id").agg(F.min(F.struct("label", "vec")).alias("row")).select("id", "row.label", "row.vec"), "asked")
    every = F.array(F.struct(F.lit(0).cast("long").alias("key"), F.lit(ALL[0]).alias("lo"), F.lit(ALL[1]).alias("hi"))).cast(_SPAN)
    near = cut(search(blocks, index, asked.withColumn("spans", every), positives, True, d).select("query_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").cast("long").alias("key")), "near")
    span = F.struct("key", F.ceil(F.col("positive_score").cast("decimal(20,0)") * low / 100).cast("long").alias("lo"), F.floor(F.col("positive_score").cast("decimal(20,0)") * high / 100).cast("long").alias("hi"))
    windows = near.where("positive_score >= 0").groupBy("query_id").agg(F.array_sort(F.collect_list(span)).cast(_SPAN).alias("spans"))  # at most ``positives``
    far = search(blocks, index, asked.join(windows, asked.id == windows.query_id).drop("query_id"), negatives, False, d)
    return far.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).join(near, ["query_id", "key"]).select(F.col("query_id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
