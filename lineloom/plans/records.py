"""Records, evidence graph, splits, validation, review and export."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineloom.functions import text as X
from lineloom.operators import digests as D
from lineloom.operators import positional as P
from lineloom.operators import records as R
from lineloom.operators import review as W
from lineloom.operators import splits as S
from lineloom.operators import validation as V
from lineloom.plans.base import EL, query, values
from lineloom.sources import lines as L
from lineloom.storage import new_path

#: (dataset, kind, position, literal, case_sensitive)
SPECS = [
    ("click", "count", "first", "user=8", False), ("click", "presence", "first", "kernel panic", False), ("error", "count", "first", '"k": 4', True), ("error", "lookup", "first", "USER=1", False),
    ("purchase", "lookup", "last", "user=7", False), ("purchase", "presence", "first", "type=purchase", True), ("signup", "count", "first", "'quoted'", False), ("signup", "presence", "first", '"k": 7', False), ("view", "count", "first", '"k": 1', False), ("view", "lookup", "first", '"k": 9', False),
]
STAMP, REVIEWER, AT = R.CREATED_BY, "reviewer one", "2025-02-01T00:00:00Z"
_N = "'[^a-z0-9]+'"
_SLUG = f"regexp_replace(regexp_replace(lower(literal), {_N}, '_', 'g'), '^_+|_+$', '', 'g')"
_TEMPLATES = values([(k, p, i, f, t) for k, p, ts in (("count", "first", R.COUNT_PHRASINGS), ("presence", "first", R.PRESENCE_PHRASINGS), ("lookup", "first", R.FIRST_PHRASINGS), ("lookup", "last", R.LAST_PHRASINGS)) for i, (f, t) in enumerate(ts)], "kind, position, i, family, template")
_ER = f"""{EL}, s AS (SELECT *, kind || '_' || {_SLUG} AS spec_id, dataset || ':' || kind || ':' || {_SLUG} AS group_id FROM {values(SPECS, "dataset, kind, position, literal, cs")}),
    h AS (SELECT s.dataset, spec_id, kind, position, line_number, text FROM el JOIN s USING (dataset) WHERE CASE WHEN cs THEN contains(text, literal) ELSE contains(lower(text), lower(literal)) END),
    hn AS (SELECT dataset, spec_id, count(*) AS n FROM h GROUP BY ALL),
    hc AS (SELECT dataset, spec_id, line_number, text FROM (SELECT *, row_number() OVER (PARTITION BY dataset, spec_id ORDER BY CASE WHEN position = 'last' THEN -line_number ELSE line_number END) AS nth FROM h) WHERE nth <= CASE WHEN kind = 'lookup' THEN 1 ELSE 5 END),
    sx AS (SELECT s.*, coalesce(n, 0) AS n FROM s LEFT JOIN hn USING (dataset, spec_id) WHERE kind = 'presence' OR (kind = 'count' AND n >= 3) OR (kind = 'lookup' AND n >= 1)),
    cl AS (SELECT sx.dataset, spec_id, group_id, line_number, text FROM sx JOIN hc USING (dataset, spec_id) UNION ALL SELECT sx.dataset, spec_id, group_id, line_number, text FROM sx JOIN el USING (dataset) WHERE n = 0 AND line_number = 1),
    er AS (SELECT sx.dataset || '_v1_' || spec_id || '_' || i AS id, sx.*, family, replace(template, '{{literal}}', literal) AS question,
        CASE sx.kind WHEN 'count' THEN n::VARCHAR WHEN 'presence' THEN CASE WHEN n > 0 THEN 'Yes (' ELSE 'No (' END || n || CASE WHEN n = 1 THEN ' matching line)' ELSE ' matching lines)' END ELSE (SELECT min(text) FROM cl WHERE cl.dataset = sx.dataset AND cl.spec_id = sx.spec_id) END AS answer
        FROM sx JOIN {_TEMPLATES} ON t.kind = sx.kind AND t.position = sx.position)"""
#: Numbers from ids, the same in both engines, that choose what a fixture breaks.
_PICK = "(('0x' || substr(md5(id), 1, 4))::BIGINT % {n})"


def _pick(n: int):
    return F.conv(F.substring(F.md5(F.col("id").cast("binary")), 1, 4), 16, 10).cast("long") % n


def _digests(spark, d):
    """A digest of each dataset: the root of its tree."""
    return L.tree(spark, d, "events").roots()


def _records(spark, d):
    lines = L.event_lines(spark, d)
    specs = spark.createDataFrame(SPECS, "dataset string, kind string, position string, literal string, case_sensitive boolean")
    digests = _digests(spark, d)
    return lines, digests, R.easy_records(lines, specs, digests)


def _split(records):
    return records.drop("split").join(S.record_splits(R.flat_refs(records)).select("id", "split"), "id", "left").select(*records.columns)


@query(f"WITH {_ER} SELECT id, question, CASE WHEN kind = 'count' THEN 'sql' ELSE 'keyword' END AS routing_path, CASE WHEN kind = 'lookup' THEN 'line_lookup' ELSE kind END AS answer_type, family AS phrasing_family, answer AS expected_answer, (SELECT count(*) FROM cl WHERE cl.dataset = er.dataset AND cl.spec_id = er.spec_id) AS cited FROM er")
def easy_records(spark, d):
    return _records(spark, d)[2].select("id", "question", "routing_path", "answer_type", "phrasing_family", "expected_answer", F.size("evidence.refs").cast("long").alias("cited"))


@query(f"WITH {_ER} SELECT er.id, er.dataset || ':line:' || lpad(line_number::VARCHAR, 8, '0') || ':' || substr(sha256(cl.text), 1, 16) AS ref_id, er.dataset, line_number, 'sha256:' || sha256(cl.text) AS line_hash, er.group_id FROM er JOIN cl ON cl.dataset = er.dataset AND cl.spec_id = er.spec_id")
def evidence_refs(spark, d):
    return R.flat_refs(_records(spark, d)[2])


_MEDIUM = f"""{EL}, m AS (SELECT dataset, line_number, row_number() OVER (PARTITION BY dataset ORDER BY line_number) AS rn, count(*) OVER (PARTITION BY dataset) AS n FROM el WHERE contains(lower(text), 'user=12')),
    a AS (SELECT *, (rn - 1) // greatest(1, n // 4) AS k FROM m WHERE (rn - 1) % greatest(1, n // 4) = 0 AND (rn - 1) // greatest(1, n // 4) < 4)"""


@query(f"WITH {_MEDIUM} SELECT dataset || '_v1_semantic_user_12_' || k AS id, dataset || ':semantic:user_12_' || k AS group_id, CASE k WHEN 0 THEN 'explain' WHEN 1 THEN 'describe' WHEN 2 THEN 'summarize' ELSE 'interpret' END AS phrasing_family, (SELECT count(*) FROM el WHERE el.dataset = a.dataset AND el.line_number BETWEEN a.line_number - 5 AND a.line_number + 5) AS cited FROM a")
def medium_records(spark, d):
    lines = L.event_lines(spark, d)
    picks = P.stride(lines.where(F.lower("text").contains("user=12")), 4)
    asked = R.window_questions(picks, "user=12")
    near = P.context(lines, asked, ["id", "group_id", "phrasing_family"])
    return near.groupBy("id", "group_id", "phrasing_family").agg(F.count(F.lit(1)).alias("cited"))


_SLUGS = "trim(regexp_replace(lower({c}), '[^a-z0-9]+', '_', 'g'), '_')"


@query(f"SELECT page_id, {_SLUGS.format(c='url')} AS slug FROM pages")
def slug_ids(spark, d):
    return L.table(spark, d, "pages").select("page_id", X.slug(F.col("url")).alias("slug"))


#: A graph with many small components: groups of one user, or of one value, inside fifty events.
_REFS = """x AS (SELECT event_type, event_id, user_id, regexp_extract(props, '([0-9]+)', 1) AS k, event_id // 50 AS b FROM events),
    refs AS (SELECT event_type || '_' || user_id || '_' || b AS id, event_type AS dataset, event_id::INTEGER AS line_number, event_type || ':user:' || user_id || '_' || b AS group_id FROM x
    UNION ALL SELECT event_type || '_k' || k || '_' || b, event_type, event_id::INTEGER, event_type || ':k:' || k || '_' || b FROM x)"""
_LE = "le AS (SELECT DISTINCT hub AS src, group_id AS dst FROM (SELECT group_id, min(group_id) OVER (PARTITION BY dataset, line_number) AS hub FROM refs) WHERE hub <> group_id)"
_COMP = f"""{_REFS}, {_LE}, links AS (SELECT src, dst FROM le UNION SELECT dst, src FROM le), reach AS (SELECT group_id AS node, group_id AS seen FROM (SELECT DISTINCT group_id FROM refs) UNION SELECT reach.node, links.dst FROM reach JOIN links ON links.src = reach.seen),
    comp AS (SELECT node AS group_id, min(seen) AS component FROM reach GROUP BY node)"""


def _graph_refs(spark, d):
    e = L.table(spark, d, "events").select(F.col("event_type").alias("dataset"), F.col("event_id").cast("int").alias("line_number"), "user_id", F.regexp_extract("props", "([0-9]+)", 1).alias("k"), F.expr("event_id div 50").alias("b"))
    kinds = F.array(F.struct(F.concat_ws("_", "dataset", "user_id", "b").alias("id"), F.concat(F.col("dataset"), F.lit(":user:"), F.concat_ws("_", "user_id", "b")).alias("group_id")), F.struct(F.concat(F.col("dataset"), F.lit("_k"), F.concat_ws("_", "k", "b")).alias("id"), F.concat(F.col("dataset"), F.lit(":k:"), F.concat_ws("_", "k", "b")).alias("group_id")))
    return e.select("dataset", "line_number", F.inline(kinds)).select("id", "dataset", "line_number", "group_id")


@query(f"WITH {_REFS}, {_LE} SELECT * FROM le")
def line_edges(spark, d):
    return S.line_edges(_graph_refs(spark, d))


@query(f"WITH RECURSIVE {_COMP} SELECT group_id, component FROM comp")
def group_components(spark, d):
    return S.group_components(_graph_refs(spark, d))


_SPLIT = "CASE WHEN ('0x' || substr(sha256(component), 1, 8))::BIGINT / 4294967295.0 < 0.2 THEN 'test' ELSE 'dev' END"


@query(f"WITH RECURSIVE {_COMP} SELECT id, component, {_SPLIT} AS split FROM (SELECT id, min(component) AS component FROM refs JOIN comp USING (group_id) GROUP BY id)")
def split_assignment(spark, d):
    return S.record_splits(_graph_refs(spark, d))


@query(f"WITH RECURSIVE {_COMP}, sp AS (SELECT id, {_SPLIT} AS split FROM (SELECT id, min(component) AS component FROM refs JOIN comp USING (group_id) GROUP BY id)) SELECT count(*) AS lines, count(*) FILTER (WHERE n > 1) AS leaks FROM (SELECT dataset, line_number, count(DISTINCT split) AS n FROM refs JOIN sp USING (id) GROUP BY ALL)")
def split_leak_check(spark, d):
    refs = _graph_refs(spark, d)
    per_line = refs.join(S.record_splits(refs), "id").groupBy("dataset", "line_number").agg(F.count_distinct("split").alias("n"))
    return per_line.agg(F.count(F.lit(1)).alias("lines"), F.count(F.when(F.col("n") > 1, 1)).alias("leaks"))


def _broken(spark, d):
    """Records of which some are changed so that exactly one check must object."""
    lines, digests, records = _records(spark, d)
    r, p = _split(records), _pick(12)
    claim = F.transform("numeric_claims", lambda c: F.struct((c.value + 1).alias("value"), c["query"].alias("query")))
    refs = F.transform("evidence.refs", lambda x: F.struct(x.id.alias("id"), x.line_number.alias("line_number"), F.lit("sha256:0").alias("line_hash"), x.group_id.alias("group_id")))
    bad = r.withColumns({
        "difficulty": F.when(p == 0, "odd").otherwise(F.col("difficulty")),
        "expected_answer": F.when(p == 1, "none of it").otherwise(F.col("expected_answer")),
        "numeric_claims": F.when(p == 2, claim).otherwise(F.col("numeric_claims")),
        "evidence": F.when(p == 3, F.struct(refs.alias("refs"), F.col("evidence.query_sql"))).when(p == 4, F.struct(F.col("evidence.refs"), F.lit("SELECT 1").alias("query_sql"))).otherwise(F.col("evidence")),
        "gold_provenance": F.when(p == 5, F.col("gold_provenance").withField("corpus_sha256", F.lit("sha256:0"))).when(p == 6, F.col("gold_provenance").withField("method", F.lit("human"))).otherwise(F.col("gold_provenance")),
        "split": F.when(p == 7, F.when(F.col("split") == "dev", "test").otherwise("dev")).otherwise(F.col("split")),
    })
    return lines, digests, bad


_P = _PICK.format(n=12)
_CASES = " UNION ALL ".join([
    f"SELECT 'schema' AS check, 'error' AS severity, id FROM er WHERE {_P} = 0", f"SELECT 'answer', 'error', id FROM er WHERE {_P} = 1 AND kind <> 'lookup'", f"SELECT 'lookup', 'error', id FROM er WHERE {_P} = 1 AND kind = 'lookup'",
    f"SELECT 'claim', 'error', id FROM er WHERE {_P} = 2 AND kind <> 'lookup'", f"SELECT 'evidence_hash', 'error', id FROM er WHERE {_P} = 3", f"SELECT 'query_sql', 'error', id FROM er WHERE {_P} = 4 AND kind <> 'lookup'",
    f"SELECT 'corpus_digest', 'error', id FROM er WHERE {_P} = 5", f"SELECT 'easy_method', 'warning', id FROM er WHERE {_P} = 6", f"SELECT 'split', 'error', id FROM er WHERE {_P} = 7",
])


@query(f"WITH {_ER} {_CASES}")
def validation_findings(spark, d):
    lines, digests, bad = _broken(spark, d)
    return V.all_findings(bad, lines, digests)


@query(f"WITH {_ER} SELECT count(*) AS records, 0::BIGINT AS findings FROM er")
def validation_clean(spark, d):
    """Unchanged records have no finding."""
    lines, digests, records = _records(spark, d)
    good = _split(records)
    return good.agg(F.count(F.lit(1)).alias("records")).crossJoin(V.all_findings(good, lines, digests).agg(F.count(F.lit(1)).alias("findings")))  # one row each


_DIFFER = f"WITH {EL}, f AS (SELECT dataset, line_number, CASE WHEN line_number % 97 = 0 THEN text || '!' ELSE text END AS text FROM el WHERE line_number % 501 <> 0), b AS (SELECT coalesce(el.dataset, f.dataset) AS dataset, coalesce(el.line_number, f.line_number) AS line_number, CASE WHEN el.dataset IS NULL THEN 'missing' WHEN f.dataset IS NULL THEN 'extra' WHEN el.text IS DISTINCT FROM f.text THEN 'text' END AS problem FROM el FULL JOIN f ON el.dataset = f.dataset AND el.line_number = f.line_number) SELECT dataset, problem, min(line_number) AS line_number, count(*) AS n FROM b WHERE problem IS NOT NULL GROUP BY ALL"


@query(_DIFFER)
def corpus_difference(spark, d):
    lines = L.event_lines(spark, d)
    files = lines.where("line_number % 501 <> 0").withColumn("text", F.when(F.col("line_number") % 97 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    return V.corpus_difference(lines, files)


def _changed(lines):
    """Lines of files that differ from the table in a few places."""
    return lines.where("line_number % 1503 <> 1200").withColumn("text", F.when(F.col("line_number") % 1801 == 1100, F.concat("text", F.lit("!"))).otherwise(F.col("text")))


@query(_DIFFER.replace("% 97 = 0", "% 1801 = 1100").replace("% 501 <> 0", "% 1503 <> 1200"))
def digest_difference(spark, d):
    """The same comparison by digest trees: only lines of leaves that differ are read and compared."""
    read = lambda ranges: L.event_lines(spark, d, ranges)
    files = D.build(_changed(read(None)), new_path(spark, "digests-files"))
    return D.difference(L.tree(spark, d, "events"), read, files, lambda ranges: _changed(read(ranges)))


@query(f"WITH {EL}, x AS (SELECT dataset, min(line_number) - 1 AS z FROM el WHERE line_number % 1503 = 1200 OR line_number % 1801 = 1100 GROUP BY dataset) SELECT dataset, (z // {D.LEAF} * {D.LEAF} + 1)::BIGINT AS lo, (z // {D.LEAF} * {D.LEAF} + {D.LEAF})::BIGINT AS hi FROM x")
def digest_first_difference(spark, d):
    """In which range of numbers each dataset first differs, found by descent."""
    files = D.build(_changed(L.event_lines(spark, d)), new_path(spark, "digests-files"))
    return D.first_difference(L.tree(spark, d, "events"), files)[0]


@query(f"WITH {_ER} SELECT DISTINCT lang AS dataset FROM documents UNION SELECT event_type FROM events EXCEPT SELECT dataset FROM er")
def manifest_coverage(spark, d):
    manifest = L.table(spark, d, "documents").select(F.col("lang").alias("dataset")).unionByName(L.table(spark, d, "events").select(F.col("event_type").alias("dataset"))).distinct()
    return V.uncovered(manifest, _records(spark, d)[2])


_COMPER = f"WITH {_ER}, z AS (SELECT 'easy' AS difficulty, CASE WHEN kind = 'count' THEN 'sql' ELSE 'keyword' END AS routing_path, CASE WHEN kind = 'lookup' THEN 'line_lookup' ELSE kind END AS answer_type, '?' AS split, 'verified' AS review_status FROM er)"


@query(_COMPER + " SELECT field, value, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS value FROM z" for c in ("difficulty", "routing_path", "answer_type", "split", "review_status")) + ") GROUP BY ALL")
def validation_statistics(spark, d):
    return V.statistics(_records(spark, d)[2])


def _in_review(spark, d):
    r, p = _records(spark, d)[2], _pick(3)
    checks = F.array(*[F.struct(F.lit(k).alias("dimension"), F.when(_pick(5) == i, "no").otherwise("yes").alias("verdict"), F.lit(None).cast("string").alias("detail")) for i, k in enumerate(("grounded", "complete"))])
    return r.withColumn("review_status", F.when(p < 2, "in_review").otherwise(F.col("review_status"))).withColumn("validation", F.col("validation").withField("checks", checks))


def _sheet(spark, d):
    p = _pick(7)
    s = W.worksheet(_in_review(spark, d))
    return s.withColumn("decision", F.when(p == 0, "accept").when(p == 1, "edit").when(p == 2, "reject").when(p == 3, "maybe").otherwise("")).withColumn("edited_answer", F.when(p == 1, F.lit("'=1+1")).otherwise(""))


_P3, _P5, _P7 = (_PICK.format(n=n) for n in (3, 5, 7))
_CITED = "(SELECT string_agg(group_id || ' #' || line_number, chr(10) ORDER BY line_number) FROM cl WHERE cl.dataset = er.dataset AND cl.spec_id = er.spec_id)"


@query(f"WITH {_ER} SELECT id, 'easy' AS difficulty, question, answer AS draft_answer, 'sha256:' || sha256(answer) AS draft_sha256, CASE WHEN {_P5} < 2 THEN '1/2' ELSE '2/2' END || ' dimensions supported' AS validation_summary, {_CITED} AS evidence, '' AS decision, '' AS edited_answer, '' AS note FROM er WHERE {_P3} < 2")
def worksheet(spark, d):
    return W.worksheet(_in_review(spark, d))


@query(f"WITH {_ER} SELECT id, 'decision' AS problem FROM er WHERE {_P3} < 2 AND {_P7} = 3 UNION ALL SELECT id, 'accept_over_no' FROM er WHERE {_P3} < 2 AND {_P7} = 0 AND {_P5} < 2")
def worksheet_problems(spark, d):
    return W.worksheet_problems(_sheet(spark, d), _in_review(spark, d))


_DECIDED = f"CASE WHEN {_P3} < 2 AND {_P7} IN (0, 1) THEN 'verified' WHEN {_P3} < 2 AND {_P7} = 2 THEN 'rejected' WHEN {_P3} < 2 THEN 'in_review' ELSE 'verified' END"


@query(f"WITH {_ER} SELECT id, {_DECIDED} AS review_status, CASE WHEN {_P3} < 2 AND {_P7} = 1 THEN '=1+1' ELSE answer END AS expected_answer, CASE WHEN {_P3} < 2 AND {_P7} < 3 THEN 2 ELSE 1 END::INTEGER AS n_reviewers FROM er")
def apply_decisions(spark, d):
    return W.apply_decisions(_in_review(spark, d), _sheet(spark, d), REVIEWER).select("id", "review_status", "expected_answer", F.size("reviewers").alias("n_reviewers"))


@query(f"WITH {_ER} SELECT id, '{REVIEWER}' AS reviewer, '{AT}' AS decided_at, 'in_review' AS was, {_DECIDED} AS now, {_P7} = 1 AS edited, 'sha256:' || sha256(CASE WHEN {_P7} = 1 THEN '=1+1' ELSE answer END) AS answer_sha256 FROM er WHERE {_P3} < 2 AND {_P7} < 3")
def review_events(spark, d):
    before = _in_review(spark, d)
    return W.review_events(before, W.apply_decisions(before, _sheet(spark, d), REVIEWER), REVIEWER, AT)


@query(f"WITH {_ER} SELECT dataset, 1::BIGINT AS digests, count(*)::INTEGER AS questions, min(id) AS first_id, max(id) AS last_id, 0::INTEGER AS humans FROM er GROUP BY dataset")
def payload_by_dataset(spark, d):
    p = W.payload(_records(spark, d)[2], STAMP)
    return p.select("dataset", "digests", F.size("questions").alias("questions"), F.get("questions", F.lit(0)).id.alias("first_id"), F.element_at("questions", -1).id.alias("last_id"), F.aggregate("questions", F.lit(0), lambda a, q: a + F.size(q.reviewers)).alias("humans"))


@query(f"WITH {_ER} SELECT id, CASE WHEN kind = 'lookup' THEN 'line_lookup' ELSE kind END AS answer_type, NOT ({_PICK.format(n=4)} = 0) AS agrees FROM er")
def answer_agreement(spark, d):
    """Independent results against the answers; a quarter of them are missing."""
    r = _records(spark, d)[2]
    value = F.when(F.col("answer_type") == "line_lookup", F.concat(F.lit(" "), "expected_answer")).otherwise(F.get("numeric_claims", F.lit(0)).value.cast("string"))
    return W.agreement(r, r.select("id", F.when(_pick(4) != 0, value).alias("value")))


@query(f"WITH {_ER} SELECT kind, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM er GROUP BY kind")
def composition(spark, d):
    from pyspark.sql.window import Window

    n = _records(spark, d)[2].groupBy(F.when(F.col("answer_type") == "line_lookup", "lookup").otherwise(F.col("answer_type")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(0))), 4))  # a few kinds


@query("SELECT event_type AS dataset, count(*) FILTER (WHERE user_id % 3 = 0) AS easy, count(*) FILTER (WHERE user_id % 3 = 1) AS medium, count(*) FILTER (WHERE user_id % 3 = 2) AS hard, count(*) AS total FROM events GROUP BY event_type")
def dataset_tier_pivot(spark, d):
    e = L.table(spark, d, "events").select(F.col("event_type").alias("dataset"), F.element_at(F.array(F.lit("easy"), F.lit("medium"), F.lit("hard")), (F.col("user_id") % 3 + 1).cast("int")).alias("tier"))
    p = e.groupBy("dataset").pivot("tier", ["easy", "medium", "hard"]).count()
    zero = [F.coalesce(c, F.lit(0)) for c in ("easy", "medium", "hard")]
    return p.select("dataset", *[z.alias(c) for z, c in zip(zero, ("easy", "medium", "hard"), strict=True)], (zero[0] + zero[1] + zero[2]).alias("total"))


@query(f"WITH {_ER} SELECT 'deterministic_aggregation' AS method, '{STAMP}' AS created_by, '(no model)' AS model, count(*) AS n FROM er")
def provenance_table(spark, d):
    g = F.col("gold_provenance")
    return _records(spark, d)[2].groupBy(g["method"].alias("method"), g["created_by"].alias("created_by"), F.coalesce(g["model"]["name"], F.lit("(no model)")).alias("model")).agg(F.count(F.lit(1)).alias("n"))
