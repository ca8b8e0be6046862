"""Anchors, context windows, chunks and budgets."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineloom.functions import text as X
from lineloom.operators import positional as P
from lineloom.operators.numbering import ranked
from lineloom.plans.base import DL, EL, TL, query
from lineloom.sources import lines as L

QUOTA, ANCHOR, DOC_ANCHOR = 2, '"k": 7', "License"
_MATCH = f"m AS (SELECT dataset, line_number, text FROM el WHERE contains(lower(text), '{ANCHOR}'))"
_PICK = f"""{_MATCH}, r AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY line_number) AS rn, count(*) OVER (PARTITION BY dataset) AS n FROM m),
    a AS (SELECT *, ((rn - 1) // greatest(1, n // {QUOTA}))::INTEGER AS k FROM r WHERE (rn - 1) % greatest(1, n // {QUOTA}) = 0 AND (rn - 1) // greatest(1, n // {QUOTA}) < {QUOTA})"""
_ORD = """CASE WHEN rn <= 10 THEN ['first', 'second', 'third', 'fourth', 'fifth', 'sixth', 'seventh', 'eighth', 'ninth', 'tenth'][rn]
    ELSE rn || CASE WHEN rn % 100 BETWEEN 11 AND 13 THEN 'th' WHEN rn % 10 = 1 THEN 'st' WHEN rn % 10 = 2 THEN 'nd' WHEN rn % 10 = 3 THEN 'rd' ELSE 'th' END END"""


def _matches(spark, d):
    return L.event_lines(spark, d).where(F.lower("text").contains(ANCHOR))


@query(f"WITH {EL}, {_MATCH} SELECT dataset, line_number, row_number() OVER (PARTITION BY dataset ORDER BY line_number) AS nth FROM m")
def anchor_matches(spark, d):
    return ranked(_matches(spark, d)).select("dataset", "line_number", F.col("rn").alias("nth"))


@query(f"WITH {EL}, {_PICK} SELECT dataset, line_number, rn, n, k, {_ORD} AS ordinal FROM a")
def anchor_stride(spark, d):
    return P.stride(_matches(spark, d), QUOTA).select("dataset", "line_number", F.col("rn").cast("long").alias("rn"), "n", "k", X.ordinal(F.col("rn")).alias("ordinal"))


@query(f"WITH {EL}, {_PICK} SELECT a.dataset, k, a.line_number AS anchor, el.line_number, el.text FROM a JOIN el ON el.dataset = a.dataset AND el.line_number BETWEEN a.line_number - 5 AND a.line_number + 5")
def context_window(spark, d):
    anchors = P.stride(_matches(spark, d), QUOTA)
    near = anchors.groupBy("dataset").agg((F.min("line_number") - 5).cast("long").alias("lo"), (F.max("line_number") + 5).cast("long").alias("hi"))
    return P.context(L.event_lines(spark, d, near), anchors, ["k"])


@query(f"WITH {DL}, a AS (SELECT dataset, line_number AS anchor FROM dl WHERE contains(text, '{DOC_ANCHOR}')) SELECT a.dataset, anchor, count(*) AS n, min(dl.line_number) AS lo, max(dl.line_number) AS hi, sum(length(dl.text))::BIGINT AS chars FROM a JOIN dl ON dl.dataset = a.dataset AND dl.line_number BETWEEN anchor - 3 AND anchor + 3 GROUP BY ALL")
def context_profile(spark, d):
    lines = L.document_lines(spark, d)
    near = P.context(lines, lines.where(F.col("text").contains(DOC_ANCHOR)), [], 3, 3)
    return near.groupBy("dataset", "anchor").agg(F.count(F.lit(1)).alias("n"), F.min("line_number").alias("lo"), F.max("line_number").alias("hi"), F.sum(F.length("text")).alias("chars"))


@query(f"WITH {EL} SELECT dataset, line_number, {_ORD.replace('rn', 'line_number')} AS ordinal FROM el")
def ordinal_text(spark, d):
    return L.event_lines(spark, d).select("dataset", "line_number", X.ordinal(F.col("line_number")).alias("ordinal"))


@query(f"WITH {TL}, c AS (SELECT dataset, max(line_number) AS n FROM tl GROUP BY dataset), s AS (SELECT dataset, slot, least(slot * greatest(1, n // 4), greatest(0, n - 1)) AS start FROM c, range(4) AS t(slot)) SELECT s.dataset, slot::INTEGER AS slot, line_number, text FROM s JOIN tl ON tl.dataset = s.dataset AND line_number BETWEEN start + 1 AND start + 50")
def chunk_sample(spark, d):
    return P.chunk(L.turn_lines(spark, d), 4).select("dataset", "slot", F.col("line_number").cast("int").alias("line_number"), "text")


@query(f"WITH {DL}, b AS (SELECT *, line_number // 100 AS block FROM dl), c AS (SELECT *, sum(length(text)) OVER w AS chars, row_number() OVER w AS rn FROM b WINDOW w AS (PARTITION BY dataset, block ORDER BY line_number ROWS UNBOUNDED PRECEDING)) SELECT dataset, block, line_number, chars::BIGINT AS chars FROM c WHERE chars <= 8000 OR rn = 1")
def char_budget_prefix(spark, d):
    """As many whole lines of each hundred as fit 8,000 characters."""
    blocks = L.document_lines(spark, d).withColumn("block", F.expr("line_number div 100"))
    return P.budget_prefix(blocks, ["dataset", "block"], 8000).select("dataset", "block", "line_number", "chars")


@query("WITH c AS (SELECT lang AS key, count(*) AS n FROM documents GROUP BY lang), t AS (SELECT *, greatest(0, 2 * (SELECT sum(n) FROM c) - (SELECT sum(n) FROM c)) // 3 AS missing, count(*) OVER () AS m, row_number() OVER (ORDER BY key) AS rn FROM c) SELECT key, n, (missing // m + CASE WHEN rn <= missing % m THEN 1 ELSE 0 END)::BIGINT AS slots FROM t")
def slot_allocation(spark, d):
    counts = L.table(spark, d, "documents").groupBy(F.col("lang").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return P.slots(counts, 2 * L.table(spark, d, "documents").count())
