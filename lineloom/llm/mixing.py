"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern, the set of sources they belong to.
A flow carries tokens from patterns to source quotas: the first use of a pattern's
tokens is cheap and each repetition costs more, so the cheapest flow repeats as
little and as evenly as the quotas allow. A pattern's flow then becomes documents:
whole rounds for all of them, and for the rest a seeded choice.

Scale. The flow network has a node for each pattern and source and is solved on the
driver from aggregated sizes alone. The seeded choice needs no sorted source:
documents fall into hash buckets, the bucket in which the quota ends is found from
bucket sums, and only that bucket is ordered. A source that holds a third of all
rows is spread over the same buckets as any other.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lineloom.llm.rows import ID, ROW, with_keys
from lineloom.storage import cut

WEIGHTS, SHARE, ROUNDS, BUCKETS, SEED = (3, 1, 2), (3, 2), 2, 65536, "mix-20"

TIMES = "__lineloom_times"


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: dict, weights: dict, total: float, rounds: int = ROUNDS) -> dict:
    """Shares of ``total`` by weight, none above ``rounds`` times its size; what is above is shared anew by weight."""
    out, open_, left = {}, set(sizes), min(float(total), float(rounds * sum(sizes.values())))
    while open_:
        per = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if per * weights[s] >= rounds * sizes[s]}
        if not full:
            return out | {s: per * weights[s] for s in open_}
        out |= {s: float(rounds * sizes[s]) for s in full}
        left = max(0.0, left - sum(rounds * sizes[s] for s in full))
        open_ -= full
    return out


def cheapest_flow(patterns: list[tuple[tuple[int, ...], int]], quotas: list[int], rounds: int = ROUNDS) -> list[int]:
    """Tokens taken from each pattern ``(sources, size)``; quota ``s`` is met as far as its patterns allow.

    Successive shortest paths; the r-th use of a pattern's tokens costs r squared.
    """
    np_, ns = len(patterns), len(quotas)
    start, end = np_ + ns, np_ + ns + 1
    arcs: list[list] = []
    out: list[list[int]] = [[] for _ in range(end + 1)]

    def add(a: int, b: int, room: int, cost: int) -> None:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            out[x].append(len(arcs))
            arcs.append([y, r, c])

    for p, (members, size) in enumerate(patterns):
        for r in range(1, rounds + 1):
            add(start, p, size, r * r)
        for s in members:
            add(p, np_ + s, rounds * size, 0)
    for s, quota in enumerate(quotas):
        add(np_ + s, end, quota, 0)
    while True:
        dist, came, queued = {start: 0}, {}, deque([start])
        while queued:
            x = queued.popleft()
            for a in out[x]:
                y, room, cost = arcs[a]
                if room > 0 and dist[x] + cost < dist.get(y, 1 << 60):
                    dist[y], came[y] = dist[x] + cost, a
                    queued.append(y)
        if end not in dist:
            break
        path, y = [], end
        while y != start:
            path.append(came[y])
            y = arcs[came[y] ^ 1][0]
        push = min(arcs[a][1] for a in path)
        for a in path:
            arcs[a][1] -= push
            arcs[a ^ 1][1] += push
    return [sum(arcs[a ^ 1][1] for a in out[start] if arcs[a][0] == p) for p in range(np_)]


def seeded_bucket(key: Column, seed: str) -> Column:
    """A bucket from the first 16 bits of an MD5 over seed and key."""
    return F.conv(F.substring(seeded_order(key, seed), 1, 4), 16, 10).cast("int")


def seeded_order(key: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, share: tuple = SHARE, rounds: int = ROUNDS, seed: str = SEED, keep: tuple = ()) -> DataFrame:
    """``(id, size, source_size, target, taken, repeats)`` per row, the source columns those of its (first) source.

    ``source_col`` is a text, or an array of texts for documents in several sources.
    Sources sort by code point, null last, and get ``weights`` in turn. All sources
    together share ``share`` of all sizes; see :func:`targets`. ``repeats`` is how
    often the mix takes the document, ``taken`` the words that gives. A quota that
    ends inside a document takes it if at least half of it fits, so a source
    misses its target by half a document at most. Documents without words are
    never taken. Rows that repeat an id are chosen one by one, equal ones in no
    particular order. The choice depends on ids, sizes and seed only, so reruns
    agree. Columns named in ``keep`` are handed through; others are not read.
    """
    spark = docs.sparkSession
    many = dict(docs.dtypes)[source_col].startswith("array")
    sources = F.when(F.size(F.coalesce(source_col, F.array())) > 0, F.array_sort(F.array_distinct(source_col))).otherwise(F.array(F.lit(None).cast("string"))) if many else F.array(F.col(source_col).cast("string"))
    rows = docs.select(F.col(id_col).alias("id"), word_count(F.col(text_col).cast("string")).alias("size"), sources.alias("members"), F.struct(*[F.col(c) for c in keep], F.lit(0).alias("_")).alias("kept"))
    rows = cut(rows.withColumn("order", seeded_order(F.col("id"), seed)).withColumn("bucket", F.conv(F.substring("order", 1, 4), 16, 10).cast("int")), "sizes")
    totals = [(tuple(r.members), r.size) for r in rows.groupBy("members").agg(F.sum("size").alias("size")).collect()]  # a row for each membership pattern
    totals.sort(key=lambda t: [(s is None, (s or "").encode("utf-32-be")) for s in t[0]])
    names = sorted({s for m, _ in totals for s in m}, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    place = {s: i for i, s in enumerate(names)}
    sizes = {i: sum(n for m, n in totals if s in m) for i, s in enumerate(names)}
    weight = {i: weights[i % len(weights)] for i in sizes}
    aim = targets(sizes, weight, sum(n for _, n in totals) * share[0] / share[1], rounds)
    flow = cheapest_flow([(tuple(place[s] for s in m), n) for m, n in totals], [round(aim[i]) for i in range(len(names))], rounds)
    plan = [(list(m), i, int(f // n) if n else 0, int(f % n) if n else 0, int(sizes[place[m[0]]]), float(aim[place[m[0]]])) for i, ((m, n), f) in enumerate(zip(totals, flow, strict=True))]
    plan_df = spark.createDataFrame(plan, "members array<string>, pattern int, whole int, rest long, source_size long, target double")

    key = lambda c: F.to_json(F.struct(F.col(c).alias("m")), {"ignoreNullFields": "false"})
    known = rows.withColumn("k", key("members")).drop("members").join(F.broadcast(plan_df.withColumn("k", key("members")).drop("members")), "k").drop("k")
    sums = known.where("rest > 0").groupBy("pattern", "rest", "bucket").agg(F.sum("size").alias("n"))
    upto = sums.withColumn("before", F.sum("n").over(Window.partitionBy("pattern").orderBy("bucket")) - F.col("n"))
    edge = upto.where("before < rest AND before + n >= rest").select("pattern", F.col("bucket").alias("edge"), "before")  # at most a bucket for each pattern
    dealt = known.join(F.broadcast(edge), "pattern", "left")  # the patterns of the plan, which the driver holds
    inside = (F.col("bucket") < F.col("edge")) & (F.col("rest") > 0)
    far = dealt.where(~F.coalesce(F.col("bucket") == F.col("edge"), F.lit(False))).withColumn("more", F.coalesce(inside.cast("int"), F.lit(0))).drop("before", "edge")
    near = dealt.where(F.col("bucket") == F.col("edge"))
    so_far = F.sum("size").over(Window.partitionBy("pattern").orderBy("order", "size", "id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    near = near.withColumn("more", ((F.col("before") + so_far) * 2 + F.col("size") <= F.col("rest") * 2).cast("int")).drop("before", "edge")
    repeats = F.when(F.col("size") > 0, F.col("whole") + F.col("more")).otherwise(0)
    both = far.unionByName(near).withColumn("repeats", F.least(repeats, F.lit(rounds)).cast("int"))
    return both.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"), "repeats", *[F.col(f"kept.`{c}`") for c in keep])


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as :func:`mix` takes it, all columns kept.

    Rows are told apart by id and all columns, so rows that differ anywhere are taken
    each for itself, and equal rows together as often as the mix takes them.
    """
    keyed = with_keys(docs, id_col)
    chosen = mix(keyed, id_col, text_col, source_col, keep=(ID, ROW), **options).where("repeats > 0").groupBy(ID, ROW).agg(F.sum("repeats").cast("int").alias(TIMES))
    return keyed.dropDuplicates([ID, ROW]).join(chosen, [ID, ROW]).withColumn(TIMES, F.explode(F.sequence(F.lit(1), F.col(TIMES)))).drop(ID, ROW, TIMES)
