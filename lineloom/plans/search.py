"""Literals and regexes through the trigram index."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineloom.operators import trigrams as T
from lineloom.plans.base import DL, query, values
from lineloom.plans.core import DOC_SPECS
from lineloom.sources import lines as L

#: Dataset (null: all), name, literal or regex, whether it is a regex, whether case counts.
SPECS = [(d, i, literal, False, exact) for d, i, literal, exact in DOC_SPECS] + [
    (None, "any_license", "Apache License", False, True), (None, "any_the", "the the", False, False), (None, "any_short", "éa", False, False),
    (None, "re_license", "(apache|mit) licen[sc]es?", True, False), (None, "re_words", r"(worthless|pathetic) \|", True, False), ("en", "re_start", "^[A-Z][a-z]+ of ", True, True),
    ("en", "re_group", "thea(shing|and)+ [a-z]*ing", True, False), ("fr", "re_wide", "[aeiou]{4}.*é", True, False), (None, "re_absent", r"(www|http)[^ ]*\.[a-z]{2,}", True, False),
]
_SPECS = values(SPECS, "own, spec_id, literal, regex, cs")
_OWN = "(s.own IS NULL OR s.own = dl.dataset)"
_HIT = "CASE WHEN regex THEN regexp_matches(text, CASE WHEN cs THEN literal ELSE '(?i)' || literal END) WHEN cs THEN contains(text, literal) ELSE contains(lower(text), lower(literal)) END"


def _table(spark):
    return spark.createDataFrame(SPECS, T.SPECS)


@query(f"WITH {DL}, s AS (SELECT * FROM {_SPECS}) SELECT dataset, spec_id, count(*) AS n, min(line_number)::BIGINT AS first_line, max(line_number)::BIGINT AS last_line, min(sha256(text)) AS least FROM dl JOIN s ON {_OWN} AND {_HIT} GROUP BY ALL")
def index_search(spark, d):
    """Every spec of the list, literal or regex, in the blocks of lines that its trigrams leave."""
    found = L.index(spark, d, "documents").search(_table(spark), L.store(spark, d, "documents").lines)
    return found.groupBy("dataset", "spec_id").agg(F.count(F.lit(1)).alias("n"), F.min("line_number").alias("first_line"), F.max("line_number").alias("last_line"), F.min(F.sha2("text", 256)).alias("least"))


@query(f"""WITH {DL}, s AS (SELECT * FROM {_SPECS} WHERE NOT regex), g AS (SELECT own, spec_id, unnest(CASE WHEN len(literal) < 3 THEN [''] ELSE list_distinct(list_transform(range(1, len(literal) - 1), lambda i: substr(lower(literal), i, 3))) END) AS gram FROM s),
    b AS (SELECT dataset, spec_id, gram, (line_number - 1) // {T.BLOCK} AS block, bool_or(contains(lower(text), gram)) AS has FROM dl JOIN g AS s ON {_OWN} GROUP BY ALL),
    r AS (SELECT dataset, spec_id, block, bool_and(has) AS has FROM b GROUP BY ALL)
    SELECT dataset, spec_id, count(*)::BIGINT AS blocks, (count(*) FILTER (WHERE has))::BIGINT AS read FROM r GROUP BY ALL""")
def index_blocks(spark, d):
    """How many blocks of lines there are for each literal, and how many its trigrams leave to be read."""
    return L.index(spark, d, "documents").blocks(_table(spark).where("not pattern"))
