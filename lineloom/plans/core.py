"""Sources, predicates, counts, presence, lookups and scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineloom.functions import text as X
from lineloom.operators import automaton as A
from lineloom.operators import counting as C
from lineloom.plans.base import DL, EL, PL, TL, query, values
from lineloom.sources import lines as L
from lineloom.sources.store import wanted_ranges

#: Literal specs over document lines (datasets are languages) and event lines (datasets are types).
DOC_SPECS = [
    ("en", "count_thand", "thand", False), ("en", "presence_license", "License", True), ("en", "presence_absent", "no such words", False), ("en", "lookup_www", "www", False),
    ("de", "count_und", "und", False), ("de", "presence_lich", "lich", True), ("fr", "count_les", "les ", False), ("fr", "absent", "OutOfMemoryError", True),
    ("es", "count_del", "del", False), ("es", "lookup_mente", "mente", False), ("en", "quoted", "user's", False), ("en", "wild", "a_b%", False),
]
EVENT_SPECS = [
    ("click", "count_user", "user=8", False), ("error", "count_k", '"k": 4', True), ("error", "absent", "kernel panic", False),
    ("purchase", "lookup_k7", '"k": 7', False), ("signup", "count_user1", "USER=1", False), ("view", "case", "USER=1", True),
]
_NAMES = "dataset, spec_id, literal, cs"
_DSPEC, _ESPEC = values(DOC_SPECS, _NAMES), values(EVENT_SPECS, _NAMES)
_HIT = "(CASE WHEN cs THEN contains(text, literal) ELSE contains(lower(text), lower(literal)) END)"
_ANSWER = "CASE WHEN n > 0 THEN 'Yes (' ELSE 'No (' END || n || CASE WHEN n = 1 THEN ' matching line)' ELSE ' matching lines)' END"


@query(f"WITH {DL} SELECT * FROM dl")
def doc_lines(spark, d):
    return L.document_lines(spark, d)


@query(f"WITH {EL} SELECT * FROM el")
def event_lines(spark, d):
    return L.event_lines(spark, d)


@query(f"WITH {PL} SELECT * FROM pl")
def page_lines(spark, d):
    return L.page_lines(spark, d)


@query(f"WITH {TL} SELECT * FROM tl")
def turn_lines(spark, d):
    return L.turn_lines(spark, d)


@query(f"WITH {DL} SELECT dataset, line_number, 'sha256:' || sha256(text) AS line_hash FROM dl")
def line_hash(spark, d):
    return L.document_lines(spark, d).select("dataset", "line_number", X.digest(F.col("text")).alias("line_hash"))


@query("SELECT doc_id, 'sha256:' || sha256(coalesce(text, '')) AS digest, strlen(coalesce(text, '')) AS n_bytes FROM documents")
def corpus_digest(spark, d):
    raw = F.coalesce("text", F.lit(""))
    return L.table(spark, d, "documents").select("doc_id", X.digest(raw).alias("digest"), F.octet_length(raw).cast("long").alias("n_bytes"))


def _counts(spark, d, source, specs):
    return C.spec_counts(source(spark, d), C.literal_specs(spark, specs)).select("dataset", "spec_id", "literal", "n", "answer", F.col("first.line_number").alias("first_line"), F.col("first.text").alias("first_text"), F.col("last.line_number").alias("last_line"), F.col("last.text").alias("last_text"))


def _counts_sql(cte, alias, spec):
    return f"""WITH {cte}, s AS (SELECT * FROM {spec}), m AS (SELECT s.dataset, spec_id, count(*) AS n, min(line_number) AS first_line, arg_min(text, line_number) AS first_text, max(line_number) AS last_line, arg_max(text, line_number) AS last_text
        FROM {alias} JOIN s USING (dataset) WHERE {_HIT} GROUP BY ALL),
        r AS (SELECT s.dataset, s.spec_id, s.literal, coalesce(n, 0) AS n, first_line, first_text, last_line, last_text FROM s LEFT JOIN m USING (dataset, spec_id))
        SELECT dataset, spec_id, literal, n, {_ANSWER} AS answer, first_line, first_text, last_line, last_text FROM r"""


@query(_counts_sql(DL, "dl", _DSPEC))
def literal_count(spark, d):
    return _counts(spark, d, L.document_lines, DOC_SPECS)


@query(_counts_sql(EL, "el", _ESPEC))
def literal_count_events(spark, d):
    return _counts(spark, d, L.event_lines, EVENT_SPECS)


_MANY = "SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]{7,}')) AS literal FROM conversations"


@query(f"""WITH {DL}, s AS ({_MANY}), d AS (SELECT *, lower(text) AS low FROM dl), m AS (SELECT dataset, literal, line_number FROM d JOIN s ON CASE WHEN len(literal) % 2 = 0 THEN contains(text, literal) ELSE contains(low, lower(literal)) END)
    SELECT dataset, literal, count(*) AS n, min(line_number)::BIGINT AS first_line, max(line_number)::BIGINT AS last_line FROM m GROUP BY ALL""")
def literal_many(spark, d):
    """All longer words of the conversations, thousands of them, sought in the lines of every language in one scan; the case of those of even length counts."""
    words = L.table(spark, d, "conversations").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{7,}"), F.lit(0))).alias("literal")).distinct()
    specs = words.select(F.lit(None).cast("string").alias("dataset"), F.col("literal").alias("spec_id"), "literal", (F.length("literal") % 2 == 0).alias("case_sensitive"))
    return A.many_counts(L.document_lines(spark, d), specs).drop("spec_id")


_CITED = f"""WITH {EL}, s AS (SELECT * FROM {_ESPEC}), m AS (SELECT s.dataset, spec_id, line_number, text, row_number() OVER (PARTITION BY s.dataset, spec_id ORDER BY line_number) AS nth FROM el JOIN s USING (dataset) WHERE {_HIT})
    SELECT dataset, spec_id, nth::INTEGER AS nth, dataset || ':line:' || lpad(line_number::VARCHAR, 8, '0') || ':' || substr(sha256(text), 1, 16) AS evidence_id, line_number, 'sha256:' || sha256(text) AS line_hash FROM m WHERE nth <= 5"""


@query(_CITED)
def literal_evidence(spark, d):
    """The first five lines of each spec as evidence references."""
    cited = C.cited_lines(C.literal_matches(L.event_lines(spark, d), C.literal_specs(spark, EVENT_SPECS)), ["dataset", "spec_id"]).withColumn("line_hash", X.digest(F.col("text")))
    return cited.select("dataset", "spec_id", F.col("at").alias("nth"), X.evidence_id(F.col("dataset"), F.col("line_number"), F.col("line_hash")).alias("evidence_id"), "line_number", "line_hash")


@query(f"WITH {DL} SELECT dataset, count(*) AS n, min(line_number) AS first_line, max(line_number) AS last_line FROM dl WHERE regexp_matches(text, '(?i)(www|http)[^ ]*\\.[a-z]{{2,}}') GROUP BY dataset")
def regex_count(spark, d):
    return C.regex_matches(L.document_lines(spark, d), r"(www|http)[^ ]*\.[a-z]{2,}").groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.min("line_number").alias("first_line"), F.max("line_number").alias("last_line"))


@query(f"WITH {DL} SELECT dataset, count(*) AS n FROM dl WHERE regexp_matches(text, '^[A-Z][a-z]+ of ') GROUP BY dataset")
def regex_count_cs(spark, d):
    return C.regex_matches(L.document_lines(spark, d), "^[A-Z][a-z]+ of ", case_sensitive=True).groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {EL} SELECT dataset, count(*) AS n, min(line_number) AS first_line FROM el WHERE regexp_matches(text, '(?i)[[:digit:]]{{2}}:0[0-4]:.*TYPE=[a-z]+ props=.*[3-7]}}') GROUP BY dataset")
def regex_classes(spark, d):
    """A regex with a named class, without regard to case."""
    return C.regex_matches(L.event_lines(spark, d), "[[:digit:]]{2}:0[0-4]:.*TYPE=[a-z]+ props=.*[3-7]}").groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.min("line_number").alias("first_line"))


@query(f"WITH {DL}, s AS (SELECT * FROM {_DSPEC}) SELECT s.dataset, spec_id, count(*) FILTER (WHERE NOT {_HIT}) AS n_without FROM dl JOIN s USING (dataset) GROUP BY ALL")
def absence_count(spark, d):
    hit = X.contains(F.col("text"), F.col("literal"), F.col("case_sensitive"))
    both = L.document_lines(spark, d).join(C.literal_specs(spark, DOC_SPECS), "dataset")
    return both.groupBy("dataset", "spec_id").agg(F.count(F.when(~hit, 1)).alias("n_without"))


@query(f"WITH {DL}, r AS (SELECT lang AS dataset, (doc_id % 997 + 1)::INTEGER AS line_number FROM documents) SELECT dataset, line_number, count(*) AS asked, any_value(text) AS text FROM r LEFT JOIN dl USING (dataset, line_number) GROUP BY ALL")
def point_lookup(spark, d):
    """Many single-line lookups as one join; a missing line has a null text."""
    refs = L.table(spark, d, "documents").select(F.col("lang").alias("dataset"), (F.col("doc_id") % 997 + 1).cast("int").alias("line_number")).groupBy("dataset", "line_number").agg(F.count(F.lit(1)).alias("asked"))
    return refs.join(L.document_lines(spark, d, wanted_ranges(refs)), ["dataset", "line_number"], "left").select("dataset", "line_number", "asked", "text")


@query(f"WITH {EL} SELECT dataset, count(DISTINCT split_part(text, ' ', 3)) AS users, max(length(text)) AS longest, round(avg(length(text)), 6) AS mean, sum(len(regexp_extract_all(text, '[0-9]+'))) ::BIGINT AS numbers FROM el GROUP BY dataset")
def scalar_aggregates(spark, d):
    t = F.col("text")
    return L.event_lines(spark, d).groupBy("dataset").agg(F.count_distinct(F.split_part(t, F.lit(" "), F.lit(3))).alias("users"), F.max(F.length(t)).cast("long").alias("longest"), F.round(F.avg(F.length(t)), 6).alias("mean"), F.sum(F.regexp_count(t, F.lit("[0-9]+"))).alias("numbers"))


@query(f"WITH {DL}, s AS (SELECT * FROM {_DSPEC}), m AS (SELECT s.dataset, spec_id, count(*) FILTER (WHERE {_HIT}) AS n FROM dl JOIN s USING (dataset) GROUP BY ALL) SELECT dataset, (3 * count(*) FILTER (WHERE (spec_id LIKE 'count%' AND n >= 3) OR spec_id LIKE 'presence%' OR (spec_id LIKE 'lookup%' AND n >= 1)))::BIGINT AS records FROM m GROUP BY dataset")
def curated_intents(spark, d):
    """How many records the specs of each dataset will give: three for each one that passes."""
    n = C.spec_counts(L.document_lines(spark, d), C.literal_specs(spark, DOC_SPECS))
    s = F.col("spec_id")
    passes = (s.startswith("count") & (F.col("n") >= 3)) | s.startswith("presence") | (s.startswith("lookup") & (F.col("n") >= 1))
    return n.groupBy("dataset").agg((F.count(F.when(passes, 1)) * 3).alias("records"))


@query(f"WITH s AS (SELECT * FROM {_DSPEC}) SELECT dataset, spec_id, 'SELECT line_number, text FROM lines WHERE dataset = ''' || dataset || ''' AND text ' || CASE WHEN cs THEN 'LIKE' ELSE 'ILIKE' END || ' ''%' || replace(literal, '''', '''''') || '%'' ORDER BY line_number' AS query_sql, n FROM (SELECT s.*, (SELECT count(*) FROM documents WHERE lang = s.dataset) AS n FROM s)")
def query_display(spark, d):
    specs = C.literal_specs(spark, DOC_SPECS)
    n = L.table(spark, d, "documents").groupBy(F.col("lang").alias("dataset")).agg(F.count(F.lit(1)).alias("n"))
    return specs.join(n, "dataset").select("dataset", "spec_id", C.display_sql(F.col("dataset"), F.col("literal"), F.col("case_sensitive")).alias("query_sql"), "n")
