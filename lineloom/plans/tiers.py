"""Records of all tiers, statements as answers, and their verification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineloom.operators import records as R
from lineloom.operators import review as W
from lineloom.operators import statements as T
from lineloom.operators import validation as V
from lineloom.plans import records as Q
from lineloom.plans.base import EL, query, values
from lineloom.plans.entities import _GROUPS, _MATCHED, _PAIRS, _SALIENT, CAP, K, LEAST, SETS, SIZE, USER
from lineloom.sources import lines as L

ANCHOR, QUOTA = "user=12", 4
COMPARE = ["How do {key0} and {key1} differ?", "Compare user {key0} with user {key1}."]
LINK = ["What do {key0} and {key1} have to do with each other?", "Explain how {key0} and {key1} are linked.", "Relate {key0} to {key1}."]


def no_model() -> Column:
    return F.struct(F.lit("rule").alias("name"), F.lit("none").alias("family"), F.lit("sha256:0").alias("digest"), F.lit("sha256:0").alias("prompt_sha256"))


def _drafts(asked: DataFrame) -> DataFrame:
    """Drafts by a rule, which stands in for whoever writes answers."""
    extraction = F.concat(F.lit("EVENT_TYPE: "), "dataset", F.lit("\nentity:   "), F.get("refs", F.lit(0)).group_id, F.lit(" \nOUTCOME:\n"))
    answer = F.concat(F.lit("The evidence has "), F.size("refs").cast("string"), F.lit(" lines. It starts with one and ends with another."))
    return asked.select("id", extraction.alias("extraction"), answer.alias("answer"), no_model().alias("model"))


def _medium(spark, d) -> DataFrame:
    lines = L.event_lines(spark, d)
    return R.medium_evidence(lines, ANCHOR, Q._digests(spark, d), QUOTA)


def _comparative(spark, d) -> DataFrame:
    lines = L.event_lines(spark, d)
    return R.hard_evidence(R.comparative_sides(lines, USER, LEAST, SETS), "users", "Comparison", COMPARE, Q._digests(spark, d), CAP)


def _correlation(spark, d) -> DataFrame:
    lines = L.event_lines(spark, d)
    return R.hard_evidence(R.correlation_sides(lines, USER, K, LEAST, SETS), "user_k", "Correlation", LINK, Q._digests(spark, d), CAP)


_ORDINAL = "CASE WHEN rn <= 10 THEN ['first', 'second', 'third', 'fourth', 'fifth', 'sixth', 'seventh', 'eighth', 'ninth', 'tenth'][rn] ELSE rn || CASE WHEN rn % 100 BETWEEN 11 AND 13 THEN 'th' WHEN rn % 10 = 1 THEN 'st' WHEN rn % 10 = 2 THEN 'nd' WHEN rn % 10 = 3 THEN 'rd' ELSE 'th' END END"
_ASKED = values([(i, t) for i, (_, t) in enumerate(R.WINDOW_PHRASINGS)], "i, template")
_TEXTS = f"{Q._MEDIUM}, w AS (SELECT a.dataset, a.k, any_value(a.rn) AS rn, count(*) AS cited, string_agg(el.text, chr(10) ORDER BY el.line_number) AS evidence_text FROM a JOIN el ON el.dataset = a.dataset AND el.line_number BETWEEN a.line_number - 5 AND a.line_number + 5 GROUP BY ALL)"


@query(f"WITH {_TEXTS} SELECT dataset || '_v1_semantic_user_12_' || k AS id, replace(replace(replace(template, '{{dataset}}', dataset), '{{ordinal}}', {_ORDINAL}), '{{anchor}}', '{ANCHOR}') AS question, cited, evidence_text FROM w JOIN {_ASKED} ON t.i = k % {len(R.WINDOW_PHRASINGS)}")
def medium_evidence(spark, d):
    return _medium(spark, d).select("id", "question", F.size("refs").cast("long").alias("cited"), "evidence_text")


@query(f"WITH {_TEXTS} SELECT dataset || '_v1_semantic_user_12_' || k AS id, 'in_review' AS review_status, 'The evidence has ' || cited || ' lines. It starts with one and ends with another.' AS expected_answer, dataset AS event_type, dataset || ':semantic:user_12_' || k AS entity, 'not stated' AS observed_events, 'not stated' AS outcome, 'rule' AS model FROM w")
def medium_drafted(spark, d):
    asked = _medium(spark, d)
    return R.medium_records(asked, _drafts(asked)).select("id", "review_status", "expected_answer", "structured_summary.*", F.col("gold_provenance.model.name").alias("model"))


def _hard_sql(sides: str, spec: str, task: str, templates: list[str]) -> str:
    asked = values(list(enumerate(templates)), "i, template")
    families = values(list(enumerate(R.GROUP_FAMILIES)), "i, family")
    n = len(templates)
    return f"""{sides}, v AS (SELECT dataset, set_id || ':' || side || ':' || name AS key, set_id, side, name, line_number, text FROM sides), {_SALIENT.replace("FROM u WINDOW", "FROM v WINDOW")},
        b AS (SELECT *, lag(position) OVER (PARTITION BY dataset, key ORDER BY position) AS prev FROM k),
        eb AS (SELECT dataset, set_id, side, name, count(*) AS shown, '[Group: ' || name || '] ' || count(*) || ' line(s):' || chr(10) || string_agg(CASE WHEN prev IS NOT NULL AND position <> prev + 1 THEN '  ... (more lines follow between these) ...' || chr(10) ELSE '' END || text, chr(10) ORDER BY position) AS block FROM b GROUP BY dataset, set_id, side, name),
        hq AS (SELECT dataset, set_id, sum(shown)::BIGINT AS cited, max(name) FILTER (WHERE side = 0) AS key0, max(name) FILTER (WHERE side = 1) AS key1, string_agg(block, chr(10) || chr(10) ORDER BY side) AS evidence_text FROM eb GROUP BY dataset, set_id HAVING count(*) = 2)
        SELECT dataset || '_v1_hard_{spec}_' || set_id AS id, replace(replace(template, '{{key0}}', key0), '{{key1}}', key1) AS question, '{task}' AS task, fam.family AS phrasing_family, cited, evidence_text FROM hq JOIN {asked} ON t.i = set_id % {n} JOIN {families.replace(") AS t(", ") AS fam(")} ON fam.i = (set_id % {n}) % {len(R.GROUP_FAMILIES)}"""


_PAIR_SETS = f"st AS (SELECT dataset, key, set_id, side FROM (SELECT *, count(*) OVER (PARTITION BY dataset, set_id) AS m FROM (SELECT dataset, key, ((rn - 1) // {SIZE})::INTEGER AS set_id, ((rn - 1) % {SIZE})::INTEGER AS side FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY n DESC, key) AS rn FROM g) WHERE rn <= {SIZE * SETS})) WHERE m = {SIZE})"
_COMPARED = f"{EL}, {_GROUPS}, {_PAIR_SETS}, sides AS (SELECT u.dataset, set_id, side, u.key AS name, line_number, text FROM u JOIN st USING (dataset, key))"
_LINKED = f"""{EL}, {_PAIRS}, {_MATCHED}, st AS (SELECT * FROM (SELECT dataset, a, b, (row_number() OVER (PARTITION BY dataset ORDER BY rk) - 1)::INTEGER AS set_id FROM mt) WHERE set_id < {SETS}),
    sides AS (SELECT el.dataset, set_id, 0 AS side, a AS name, line_number, text FROM el JOIN st ON el.dataset = st.dataset AND regexp_extract(text, 'user=([0-9]+)', 1) = a UNION ALL SELECT el.dataset, set_id, 1, b, line_number, text FROM el JOIN st ON el.dataset = st.dataset AND regexp_extract(text, '"k": ([0-9]+)', 1) = b)"""


@query("WITH " + _hard_sql(_COMPARED, "users", "Comparison", COMPARE))
def hard_comparative(spark, d):
    return _comparative(spark, d).select("id", "question", "task", "phrasing_family", F.size("refs").cast("long").alias("cited"), "evidence_text")


@query("WITH " + _hard_sql(_LINKED, "user_k", "Correlation", LINK))
def hard_correlation(spark, d):
    return _correlation(spark, d).select("id", "question", "task", "phrasing_family", F.size("refs").cast("long").alias("cited"), "evidence_text")


def _tiers(spark, d) -> DataFrame:
    """Records of all three tiers."""
    medium, compared = _medium(spark, d), _comparative(spark, d)
    return Q._records(spark, d)[2].unionByName(R.medium_records(medium, _drafts(medium))).unionByName(R.hard_records(compared, _drafts(compared)))


_COUNTS = f"{Q._ER}, {Q._MEDIUM[len(EL) + 2:]}, {_COMPARED[len(EL) + 2:]}, n AS (SELECT 'easy' AS difficulty, (SELECT count(*) FROM er) AS n, 0.7 AS target UNION ALL SELECT 'medium', (SELECT count(*) FROM a), 0.2 UNION ALL SELECT 'hard', (SELECT count(DISTINCT dataset || ':' || set_id) FROM sides), 0.1)"


@query(f"WITH {_COUNTS} SELECT difficulty, n, round(n / (SELECT sum(n) FROM n), 6) AS share, target::DOUBLE AS target FROM n")
def tier_mix(spark, d):
    return R.tier_mix(_tiers(spark, d))


@query()
def generated_records(spark, d):
    """All tiers with their splits; components are beyond plain SQL, and tests hold them against a small union-find."""
    return R.with_splits(_tiers(spark, d)).select("id", "difficulty", "task", "split", "review_status", F.size("evidence.refs").alias("cited"))


#: (slot, dataset, mode, statement, evidence statement): the last four are to be refused.
STATEMENTS = [
    (0, "click", "count", "SELECT line_number, text FROM lines WHERE dataset = 'click' AND text LIKE '%user=8%' ORDER BY line_number", None),
    (1, "error", "presence", "SELECT line_number, text FROM lines WHERE dataset = 'error' AND text LIKE '%kernel panic%'", None),
    (2, "signup", "line_lookup", "SELECT line_number, text FROM lines WHERE dataset = 'signup' AND text LIKE '%\"k\": 7%'", None),
    (3, "view", "scalar", "SELECT max(length(text)) AS longest FROM lines WHERE dataset = 'view'", "SELECT line_number, text FROM lines WHERE dataset = 'view' AND line_number <= 9"),
    (4, "view", "count", "SELECT line_number, text FROM lines WHERE dataset = 'click'", None),
    (5, "view", "scalar", "SELECT line_number, text FROM lines WHERE dataset = 'view'", None),
    (6, "view", "count", "DROP VIEW lines /* 'view' */", None),
    (7, "click", "count", "select LINE_NUMBER, text  from lines where dataset = 'click' and text like '%user=8%' order by line_number", None),
]
_ANSWERED = """sc AS (SELECT count(*) AS n, list(struct_pack(l := line_number, t := text) ORDER BY line_number)[:5] AS c FROM el WHERE dataset = 'click' AND contains(text, 'user=8')),
    sp AS (SELECT count(*) AS n FROM el WHERE dataset = 'error' AND contains(text, 'kernel panic')), sl AS (SELECT count(*) AS n, arg_min(text, line_number) AS t FROM el WHERE dataset = 'signup' AND contains(text, '"k": 7')),
    sv AS (SELECT max(length(text)) AS v FROM el WHERE dataset = 'view'),
    st AS (SELECT 0 AS slot, 'click' AS dataset, 'count' AS mode, n AS rows, n::VARCHAR AS answer, len(c)::BIGINT AS cited FROM sc UNION ALL SELECT 1, 'error', 'presence', n, 'No (' || n || ' matching lines)', 1 FROM sp
    UNION ALL SELECT 2, 'signup', 'line_lookup', n, t, least(n, 5) FROM sl WHERE n > 0 UNION ALL SELECT 3, 'view', 'scalar', 1, v::VARCHAR, 5 FROM sv)"""


@query(f"WITH {EL}, {_ANSWERED} SELECT * FROM st")
def statement_answers(spark, d):
    return T.answers(spark, L.event_lines(spark, d), STATEMENTS).select("slot", "dataset", "mode", "rows", "answer", F.size("cited").cast("long").alias("cited"))


def _stated(spark, d, lines, digests) -> DataFrame:
    asked = spark.createDataFrame([(s, ds, [f"{ds} question {p}" for p in range(3)]) for s, ds, *_ in STATEMENTS], "slot int, dataset string, phrasings array<string>")
    return R.statement_records(T.answers(spark, lines, STATEMENTS), asked, digests)


#: (dataset, pattern, case_sensitive)
PATTERNS = [("click", "user=[0-9]*8 TYPE", False), ("error", "user=[0-9]*8 TYPE", True), ("purchase", "[[:digit:]]:0[0-4]:.*[3-7]}", True)]
_CLAIMED = f"""{Q._ER}, {_ANSWERED}, pt AS (SELECT * FROM {values(PATTERNS, "dataset, pattern, cs")}),
    cp AS (SELECT dataset || '_' || CASE WHEN cs THEN 'cs' ELSE 'ci' END AS id, 'count_regex' AS operator, 1.0 AS claimed, (SELECT count(*) FROM el WHERE el.dataset = pt.dataset AND regexp_matches(text, CASE WHEN cs THEN pattern ELSE '(?i)' || pattern END))::DOUBLE AS n FROM pt)"""


@query(f"WITH {_CLAIMED} SELECT id, 'count_literal' AS operator, n::DOUBLE AS claimed, n::DOUBLE AS n FROM er WHERE kind <> 'lookup' UNION ALL SELECT * FROM cp UNION ALL SELECT dataset || '_v1_modelsql_' || mode || '_' || slot || '_' || p, 'raw_sql', CASE mode WHEN 'scalar' THEN answer::DOUBLE ELSE rows END, CASE mode WHEN 'scalar' THEN answer::DOUBLE ELSE rows END FROM st, range(3) AS r(p) WHERE mode <> 'line_lookup'")
def claims_recomputed(spark, d):
    """Literal, regex and statement claims, with what the lines give."""
    lines, digests, easy = Q._records(spark, d)
    pattern = spark.createDataFrame([(ds + ("_cs" if cs else "_ci"), ds, p, cs) for ds, p, cs in PATTERNS], "id string, dataset string, pattern string, case_sensitive boolean")
    none = F.lit(None).cast("string")
    claim = F.struct(F.lit(1.0).alias("value"), F.struct(F.lit("count_regex").alias("operator"), none.alias("literal"), "pattern", "case_sensitive", none.alias("sql"), none.alias("evidence_sql")).alias("query"))
    ref = F.struct(F.concat("dataset", F.lit(":line:00000001:0")).alias("id"), F.lit(1).alias("line_number"), none.alias("line_hash"), none.alias("group_id"))
    regex = pattern.select("id", F.lit("count").alias("answer_type"), F.struct(F.array(ref).alias("refs"), none.alias("query_sql")).alias("evidence"), F.array(claim).cast(R.CLAIMS).alias("numeric_claims"))
    parts = [x.select("id", "answer_type", "evidence", "numeric_claims") for x in (easy, _stated(spark, d, lines, digests), regex)]
    return V.recomputed(reduce(DataFrame.unionByName, parts), lines).select("id", "operator", "claimed", "n")


def _like(literal: str, case_sensitive: bool) -> str:
    text = literal.replace("'", "''")
    return f"contains(text, '{text}')" if case_sensitive else f"contains(lower(text), '{text.lower()}')"


#: One statement for each spec, as an independent writer might put it, and one that is refused.
CHECKED = [(f"{ds}_v1_{kind}_{lit}_0", f"SELECT {'count(*)' if kind == 'count' else 'count(*) > 0'} FROM lines WHERE dataset = '{ds}' AND {_like(text, cs)}") for ds, kind, _, text, cs in Q.SPECS if kind != "lookup" for lit in ["_".join(x for x in "".join(c if c.isalnum() else " " for c in text.lower()).split())]][:-1] + [("view_v1_count_k_1_0", "DELETE FROM lines")]
_TRIED = values([(i, "DELETE" not in s) for i, s in CHECKED], "id, ok")


@query(f"WITH {Q._ER}, v AS (SELECT id, CASE WHEN kind = 'lookup' THEN 'line_lookup' ELSE kind END AS answer_type, coalesce((SELECT ok FROM {_TRIED} WHERE t.id = er.id), false) AS agrees FROM er) SELECT answer_type, count(*) AS checked, count(*) FILTER (WHERE agrees) AS agreed, count(*) FILTER (WHERE NOT agrees) AS disagreed FROM v GROUP BY answer_type")
def verification_tally(spark, d):
    lines, _, easy = Q._records(spark, d)
    return W.tally(W.verification(easy, T.results(spark, lines, CHECKED)))


#: What is wrong with a row of the sheet, by a number from its id.
_P6 = Q._PICK.format(n=6)
_FLAWS = " UNION ALL ".join([f"SELECT id, 'duplicate_id' AS problem FROM er WHERE {_P6} = 0", f"SELECT '', 'empty_id' FROM er WHERE {_P6} = 1", f"SELECT id || 'x', 'unknown_id' FROM er WHERE {_P6} = 2", f"SELECT id, 'stale' FROM er WHERE {_P6} = 3", f"SELECT id, 'decision' FROM er WHERE {_P6} = 4", f"SELECT id, 'empty_edit' FROM er WHERE {_P6} = 5"])


@query(f"WITH {Q._ER} {_FLAWS}")
def worksheet_flaws(spark, d):
    """A sheet with one flaw in every row."""
    records = Q._records(spark, d)[2].withColumn("review_status", F.lit("in_review"))
    p = Q._pick(6)
    sheet = W.worksheet(records).withColumn("p", p)
    sheet = sheet.withColumns({"decision": F.when(F.col("p") == 4, "maybe").when(F.col("p") == 5, "edit").otherwise("accept"), "draft_sha256": F.when(F.col("p") == 3, "sha256:0").otherwise(F.col("draft_sha256"))})
    sheet = sheet.unionByName(sheet.where("p = 0")).withColumn("id", F.when(F.col("p") == 1, "").when(F.col("p") == 2, F.concat("id", F.lit("x"))).otherwise(F.col("id"))).drop("p")
    return W.worksheet_problems(sheet, records)


@query(f"WITH {EL}, t AS (SELECT dataset, CASE WHEN dataset = 'click' AND line_number > 5 THEN line_number + 1 ELSE line_number END AS line_number, text FROM el) SELECT 'click' AS dataset, 'numbering' AS problem, count(*)::INTEGER AS line_number, count(*) AS n FROM t WHERE dataset = 'click' HAVING count(*) > 5")
def corpus_numbering(spark, d):
    """A table with a gap in one dataset, against itself."""
    lines = L.event_lines(spark, d).withColumn("line_number", F.when((F.col("dataset") == "click") & (F.col("line_number") > 5), F.col("line_number") + 1).otherwise(F.col("line_number")))
    return V.corpus_difference(lines, lines)
