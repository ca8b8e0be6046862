"""Approximate nearest neighbours over learned partitions.

A bounded sample of the vectors gives an exact neighbour graph. The graph is cut
into balanced parts so that neighbours mostly share one, and a softmax classifier
learns to tell, from a vector alone, the parts that its neighbours lie in. Every
vector of the table is indexed under its likeliest part; a query goes to its
several most probable parts, and all their vectors are ranked by exact inner
product in double precision. How many parts a query needs is measured on the
sample, against the sample's exact neighbours.

Scale. The sample and the classifier are bounded (``SAMPLE`` rows, ``PARTS``
classes) whatever the table's size. Vectors move once, to blocks of about ``BLOCK``
rows: a larger part has several blocks, and a part with many queries deals those
too, so a hot part or a vector that a third of all rows repeat is spread over tasks.
Queries that find fewer rows than there are get a second, exact search over all
blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lineloom.storage import cut

SAMPLE, PARTS, ROWS_PER_PART, BLOCK, GOAL, GRAPH, SEED = 32768, 512, 4096, 16384, 0.95, 20, 7
#: A table too small for ``ROWS_PER_PART`` has up to FEW parts of at least LEAST rows; one with under TINY rows for each neighbour asked for isn't cut.
FEW, LEAST, TINY = 32, 64, 24


@dataclass
class Router:
    """Softmax classifier from vectors to parts."""

    weight: np.ndarray
    bias: np.ndarray
    probes: int

    def order(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` most probable parts of each row, best first."""
        logit = x @ self.weight + self.bias
        return np.argsort(-logit, axis=1, kind="stable")[:, :n]


def _neighbours(x: np.ndarray, k: int) -> np.ndarray:
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 1024):
        s = x[at : at + 1024] @ x.T
        s[np.arange(len(s)), at + np.arange(len(s))] = -np.inf
        out[at : at + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def _fill(gain: np.ndarray, room: int) -> np.ndarray:
    """A part for every row, largest gain first, none over ``room``."""
    n, parts = gain.shape
    label, left = np.full(n, -1), np.full(parts, room)
    while (todo := np.flatnonzero(label < 0)).size:
        g = np.where(left[None, :] > 0, gain[todo], -np.inf)
        want = g.argmax(axis=1)
        order = np.argsort(-g[np.arange(len(todo)), want], kind="stable")
        for p in np.unique(want):
            took = order[want[order] == p][: left[p]]
            label[todo[took]] = p
            left[p] -= len(took)
    return label


def _cut_graph(x: np.ndarray, near: np.ndarray, parts: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Balanced parts of the neighbour graph: seeded by centres, refined by what the neighbours vote for."""
    room = int(np.ceil(len(x) / parts * 1.15))
    centre = x[rng.choice(len(x), parts, replace=False)]
    for _ in range(6):
        label = _fill(x @ centre.T, room)
        centre = np.stack([x[label == p].mean(axis=0) if (label == p).any() else x[rng.integers(len(x))] for p in range(parts)])
        centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
    for _ in range(rounds):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (np.repeat(np.arange(len(x)), near.shape[1]), label[near].ravel()), 1.0)
        votes[np.arange(len(x)), label] += 2
        label = _fill(votes + 1e-3 * (x @ centre.T), room)
    return label


def train(x: np.ndarray, parts: int, k: int, goal: float = GOAL) -> Router:
    """Fits the router on sampled vectors; one part needs no training."""
    d = x.shape[1]
    if parts < 2:
        return Router(np.zeros((d, 1)), np.zeros(1), 1)
    rng = np.random.default_rng(SEED)
    near = _neighbours(x, min(GRAPH, len(x) - 1))
    label = _cut_graph(x, near, parts, rng)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), near.shape[1]), label[near].ravel()), 1.0)
    target[np.arange(len(x)), label] += near.shape[1] / 2
    target /= target.sum(axis=1, keepdims=True)
    w, b = np.zeros((d, parts)), np.zeros(parts)
    held = rng.permutation(len(x))
    held, own = held[: max(1, len(x) // 10)], held[len(x) // 10 :]
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    steps, size = 600, 512
    for t in range(1, steps + 1):
        i = own[rng.integers(len(own), size=size)]
        logit = x[i] @ w + b
        p = np.exp(logit - logit.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = (p - target[i]) / size
        for v, grad, m, s in ((w, x[i].T @ g, 0, 1), (b, g.sum(axis=0), 2, 3)):
            state[m] = 0.9 * state[m] + 0.1 * grad
            state[s] = 0.999 * state[s] + 0.001 * grad**2
            v -= 0.5 * (1 - t / (steps + 1)) * (state[m] / (1 - 0.9**t)) / (np.sqrt(state[s] / (1 - 0.999**t)) + 1e-8)
    router = Router(w, b, parts)
    home = router.order(x, 1)[:, 0]
    ranks = np.argsort(router.order(x[held], parts), axis=1)
    place = np.take_along_axis(ranks, home[near[held]], axis=1)
    for probes in range(1, parts + 1):
        if (place < probes).mean() >= goal:
            break
    router.probes = probes
    return router


def part_count(n: int, k: int) -> int:
    """Into how many parts ``n`` rows go."""
    return 1 if n < TINY * k else min(PARTS, max(n // ROWS_PER_PART, min(FEW, n // LEAST)))


def usable(vec: Column) -> Column:
    """Neither null nor zero, without null or non-finite components."""
    ok = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(vec.isNotNull() & ok & F.exists(vec, lambda c: c != 0), F.lit(False))


def _array(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d).astype(np.float64)


def _rank(k: int, d: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, is_query, id, vec) come ordered by block, vectors before queries."""

    def pick(ids: np.ndarray, vecs: np.ndarray, asked: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(ids, kind="stable")
        ids, vecs = ids[order], np.ascontiguousarray(vecs[order])
        _, same = np.unique(vecs.view(np.dtype((np.void, 8 * d))).ravel(), return_inverse=True)
        by = np.argsort(same, kind="stable")  # equal vectors stand together, by id

        def nth(*columns: np.ndarray) -> np.ndarray:
            start = np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)]))
            return np.arange(len(by)) - np.repeat(start, np.diff(np.append(start, len(by))))

        by = by[nth(same[by], ids[by]) < k]  # k rows of an id serve any other id
        keep = np.sort(by[nth(same[by]) < 2 * k])  # a query loses at most the k rows of its own id
        ids, vecs = ids[keep], vecs[keep]
        longest = np.linalg.norm(vecs, axis=1).max()
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in range(0, len(asked), 512):
            s = q[at : at + 512] @ vecs.T
            own = asked[at : at + 512, None] == ids[None, :]
            s[own] = -np.inf
            edge = np.partition(s, max(0, s.shape[1] - k), axis=1)[:, max(0, s.shape[1] - k)]
            error = 4 * d * np.finfo(float).eps * np.linalg.norm(q[at : at + 512], axis=1) * longest  # of a product in another order of addition
            i, j = np.nonzero((s >= (edge - error)[:, None]) & ~own)
            score = (q[at + i] * vecs[j]).sum(axis=1)
            order = np.lexsort((ids[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            start = np.searchsorted(i, np.arange(len(s)))
            best = np.arange(len(i)) - start[i] < k
            out.append((asked[at + i[best]], ids[j[best]], score[best]))
        a, b, c = (np.concatenate([o[n] for o in out]) for n in range(3))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c)], names=["query_id", "vec_id", "score"])

    block, held = None, ([], [], [], [])
    for batch in batches:
        blocks, kinds, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy()
        vecs = _array(batch.column(3), d)
        bounds = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1], [True]])) if len(blocks) else []
        for s, e in zip(bounds[:-1], bounds[1:], strict=True):
            if blocks[s] != block:
                if held[0] and held[2]:
                    yield pick(*map(np.concatenate, held))
                block, held = blocks[s], ([], [], [], [])
            m = s + int((~kinds[s:e]).sum())
            for n, (lo, hi) in ((0, (s, m)), (2, (m, e))):
                if lo < hi:
                    held[n].append(ids[lo:hi])
                    held[n + 1].append(vecs[lo:hi])
    if held[0] and held[2]:
        yield pick(*map(np.concatenate, held))


def _search(placed: DataFrame, asked: DataFrame, k: int, d: int) -> DataFrame:
    """Ranks ``asked`` (part, id, vec) against ``placed`` (part, id, vec), block by block."""
    blocks = lambda df, name: df.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    grid = blocks(placed, "v").join(blocks(asked, "q"), "part").collect()  # a row for each part
    if not grid:
        return placed.sparkSession.createDataFrame([], "query_id long, vec_id long, score double")
    sizes = placed.sparkSession.createDataFrame(grid, "part int, v int, q int")
    both = [placed.join(F.broadcast(sizes), "part"), asked.join(F.broadcast(sizes), "part")]  # at most PARTS rows
    both[0] = both[0].withColumn("a", F.expr("pmod(xxhash64(id, vec), v)")).withColumn("b", F.explode(F.expr("sequence(0, q - 1)")))
    both[1] = both[1].withColumn("b", F.expr("pmod(xxhash64(id, vec), q)")).withColumn("a", F.explode(F.expr("sequence(0, v - 1)")))
    rows = [df.select(F.xxhash64("part", F.col("a").cast("int"), F.col("b").cast("int")).alias("block"), F.lit(bool(n)).alias("is_query"), "id", "vec") for n, df in enumerate(both)]
    ordered = rows[0].unionByName(rows[1]).repartition("block").sortWithinPartitions("block", "is_query")
    found = ordered.mapInArrow(lambda batches: _rank(k, d, batches), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(table: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", parts: int | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each query row.

    Queries are the usable rows where ``queries`` holds; candidates are all usable
    rows with another id. Not usable, on either side: null ids; vectors that are
    null, zero, hold null or non-finite components, or have another dimension than
    most. Ties go to the smaller id. Rows that repeat an id are candidates of their
    own; a query id asks once, with the smallest of its vectors. With fewer than
    ``k`` candidates all of them are returned, and an empty table has no rows. Other
    columns are not read, whatever their names. ``parts`` overrides
    :func:`part_count`; with one part the search is exact.
    """
    spark = table.sparkSession
    rows = table.where(F.col(id_col).isNotNull() & usable(F.col(vec_col))).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(queries, F.lit(False)).alias("asks"))
    dims = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if dims is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, n = dims
    rows = rows.where(F.size("vec") == d)
    parts = part_count(n, k) if parts is None else parts
    most = min(SAMPLE, 512 * parts)
    hashed = rows.select("vec", F.xxhash64(F.lit(SEED), "id", "vec").alias("h")).where(F.col("h").bitwiseAND(0xFFFFFF) < int(min(1.0, 4 * most / n) * (1 << 24)))  # thinned before it is ordered
    drawn = hashed.orderBy("h").limit(most).select("vec")
    router = train(np.array([r[0] for r in drawn.collect()], np.float64).reshape(-1, d) if parts > 1 else np.zeros((0, d)), parts, k)

    def route(n_parts: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = router.order(_array(b.column(1), d), n_parts).astype(np.int32)
                at = np.repeat(np.arange(b.num_rows), n_parts)
                yield pa.RecordBatch.from_arrays([pa.array(found.ravel()), b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at))], names=["part", "id", "vec"])

        return run

    shape = T.StructType.fromDDL("part int, id long, vec array<double>")
    placed = rows.select("id", "vec").mapInArrow(route(1), shape)
    asked = rows.where("asks").groupBy("id").agg(F.min("vec").alias("vec"))
    found = cut(_search(placed, asked.mapInArrow(route(router.probes), shape), k, d), "neighbours")
    due = asked.select("id").join(rows.groupBy("id").agg(F.count(F.lit(1)).alias("own")), "id").select("id", F.least(F.lit(k), F.lit(n) - F.col("own")).alias("due"))
    short = due.join(found.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("have")), "id", "left").where(F.coalesce("have", F.lit(0)) < F.col("due")).select("id")
    if parts > 1 and router.probes < parts and (again := cut(short, "short")).head(1):
        rest = _search(placed, asked.join(again, "id", "left_semi").mapInArrow(route(parts), shape), k, d)
        found = found.join(again.withColumnRenamed("id", "query_id"), "query_id", "left_anti").unionByName(rest)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
