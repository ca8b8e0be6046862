"""Entity groups, proven pairs, salience."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineloom.functions import text as X
from lineloom.operators import groups as G
from lineloom.plans.base import DL, EL, query
from lineloom.sources import lines as L

USER, K, LEAST, SIZE, SETS, CAP = r"user=(?P<key>[0-9]+)", r'"k": (?P<key>[0-9]+)', 5, 2, 3, 6
_USERS = "u AS (SELECT dataset, line_number, text, regexp_extract(text, 'user=([0-9]+)', 1) AS key FROM el WHERE regexp_matches(text, 'user=([0-9]+)'))"
_GROUPS = f"{_USERS}, g AS (SELECT dataset, key, count(*) AS n FROM u GROUP BY ALL HAVING count(*) >= {LEAST})"
_PAIRS = f"""x AS (SELECT dataset, regexp_extract(text, 'user=([0-9]+)', 1) AS a, regexp_extract(text, '"k": ([0-9]+)', 1) AS b FROM el),
    ga AS (SELECT dataset, a, count(*) AS na FROM x GROUP BY ALL HAVING count(*) >= {LEAST}), gb AS (SELECT dataset, b, count(*) AS nb FROM x GROUP BY ALL HAVING count(*) >= {LEAST}),
    p AS (SELECT dataset, a, b, na, nb, row_number() OVER (PARTITION BY dataset ORDER BY na + nb DESC, a, b) AS rk FROM (SELECT DISTINCT dataset, a, b FROM x) JOIN ga USING (dataset, a) JOIN gb USING (dataset, b))"""
_CAT = "CASE " + " ".join(f"WHEN contains(lower(text), '{k}') THEN '{k}'" for k in X.SALIENT) + " END"
_SALIENT = f"""c AS (SELECT *, row_number() OVER w - 1 AS position, count(*) OVER (PARTITION BY dataset, key) AS size, {_CAT} AS category, regexp_replace(text, '\\p{{Nd}}+', '#', 'g') AS template FROM u WINDOW w AS (PARTITION BY dataset, key ORDER BY line_number)),
    e AS (SELECT *, last_value(category IGNORE NULLS) OVER (PARTITION BY dataset, key ORDER BY line_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, row_number() OVER (PARTITION BY dataset, key, template ORDER BY line_number) > 1 AS seen FROM c),
    f AS (SELECT *, CASE WHEN position = 0 OR position = size - 1 THEN 100 ELSE 0 END + CASE WHEN category IS NOT NULL THEN 2 ELSE 0 END + CASE WHEN category IS NOT NULL AND category IS DISTINCT FROM before THEN 1 ELSE 0 END - CASE WHEN seen THEN 1 ELSE 0 END AS score FROM e),
    k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset, key ORDER BY score DESC, position) AS rn FROM f) WHERE size <= {CAP} OR rn <= {CAP})"""


@query(f"WITH {EL}, {_GROUPS} SELECT * FROM g")
def key_groups(spark, d):
    return G.large_groups(G.keyed(L.event_lines(spark, d), USER), "key", LEAST)


@query(f"WITH {EL}, {_GROUPS}, r AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY n DESC, key) AS rn FROM g), s AS (SELECT *, ((rn - 1) // {SIZE})::INTEGER AS set_id FROM r WHERE rn <= {SIZE * SETS}) SELECT dataset, key, n, rn, set_id FROM (SELECT *, count(*) OVER (PARTITION BY dataset, set_id) AS m FROM s) WHERE m = {SIZE}")
def comparative_sets(spark, d):
    return G.comparative_sets(key_groups(spark, d), SIZE, SETS).select("dataset", "key", "n", F.col("rn").cast("long").alias("rn"), "set_id")


def _pairs(spark, d):
    return G.proven_pairs(L.event_lines(spark, d), USER, K, LEAST)


@query(f"WITH {EL}, {_PAIRS} SELECT * FROM p")
def proven_pairs(spark, d):
    return _pairs(spark, d)


#: Greedy matching of each dataset as a fold over its pairs in rank order.
_MATCHED = """o AS (SELECT list_reduce(list_prepend([]::STRUCT(dataset VARCHAR, a VARCHAR, b VARCHAR, rk BIGINT)[], list([{'dataset': dataset, 'a': a, 'b': b, 'rk': rk}] ORDER BY rk)),
    lambda acc, x: CASE WHEN list_contains([y.a for y in acc], x[1].a) OR list_contains([y.b for y in acc], x[1].b) THEN acc ELSE list_append(acc, x[1]) END) AS l FROM p GROUP BY dataset),
    mt AS (SELECT e.dataset, e.a, e.b, e.rk FROM (SELECT unnest(l) AS e FROM o))"""


@query(f"WITH {EL}, {_PAIRS}, {_MATCHED} SELECT * FROM mt")
def correlation_matching(spark, d):
    return G.greedy_matching(_pairs(spark, d)).select("dataset", "a", "b", F.col("rk").cast("long").alias("rk"))


@query(f"WITH {DL} SELECT dataset, coalesce({_CAT}, 'none') AS category, count(*) AS n FROM dl GROUP BY ALL")
def salience_category(spark, d):
    return L.document_lines(spark, d).groupBy("dataset", F.coalesce(X.salience(F.col("text")), F.lit("none")).alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {EL} SELECT dataset, regexp_replace(text, '\\p{{Nd}}+', '#', 'g') AS template, count(*) AS n, min(line_number) AS first_line FROM el GROUP BY ALL")
def template_rollup(spark, d):
    return L.event_lines(spark, d).groupBy("dataset", X.template(F.col("text")).alias("template")).agg(F.count(F.lit(1)).alias("n"), F.min("line_number").alias("first_line"))


def _kept(spark, d):
    return G.salient(G.keyed(L.event_lines(spark, d), USER), ["dataset", "key"], CAP)


@query(f"WITH {EL}, {_USERS}, {_SALIENT} SELECT dataset, key, line_number, position, score::INTEGER AS score, category FROM k")
def salience_topk(spark, d):
    return _kept(spark, d).select("dataset", "key", "line_number", F.col("position").cast("long").alias("position"), "score", "category")


@query(f"""WITH {EL}, {_USERS}, {_SALIENT}, b AS (SELECT *, lag(position) OVER (PARTITION BY dataset, key ORDER BY position) AS prev FROM k)
    SELECT dataset, key, count(*) AS shown, '[Group: ' || key || '] ' || count(*) || ' line(s):' || chr(10) || string_agg(CASE WHEN prev IS NOT NULL AND position <> prev + 1 THEN '  ... (more lines follow between these) ...' || chr(10) ELSE '' END || text, chr(10) ORDER BY position) AS block FROM b GROUP BY dataset, key""")
def gap_blocks(spark, d):
    return G.gap_blocks(_kept(spark, d), ["dataset", "key"], "key")
