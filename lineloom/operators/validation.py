"""Re-derivation and cross-checks of question records.

Every check is one relational step over all records and gives findings
``(check, severity, id)``; lines are joined once for all cited lines, and claims
are recomputed once for each distinct query.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType
from pyspark.sql.window import Window

from lineloom.functions import text as X
from lineloom.operators import counting as C
from lineloom.operators.records import flat_refs
from lineloom.operators.splits import record_splits

#: What a record's fields may be.
ALLOWED = {
    "routing_path": ["sql", "keyword", "semantic"],
    "answer_type": ["count", "presence", "line_lookup", "scalar", "explanation", "synthesis"],
    "task": ["Aggregation", "Lookup", "Summarization", "RootCauseAnalysis", "Comparison", "Correlation"],
    "difficulty": ["easy", "medium", "hard"],
    "review_status": ["verified", "in_review", "rejected"],
}
EASY_METHODS = ("deterministic_aggregation", "model_written_deterministic_sql")
MODEL_METHOD, FAMILIES = "independent_model_then_human", 3


def _found(rows: DataFrame, check: str, severity: str = "error", by: str = "id") -> DataFrame:
    return rows.select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), F.col(by).alias("id"))


def schema_findings(records: DataFrame) -> DataFrame:
    """Fields outside their domain, ids of another form, unreadable times, records without evidence."""
    bad = reduce(lambda a, b: a | b, [~F.coalesce(F.col(c).isin(v), F.lit(False)) for c, v in ALLOWED.items()])
    bad = bad | ~F.coalesce(F.col("id").rlike("^[a-z0-9_]+$"), F.lit(False)) | F.try_to_timestamp("gold_provenance.created_at").isNull() | (F.size("evidence.refs") < 1)
    return _found(records.where(bad), "schema")


def duplicate_findings(records: DataFrame) -> DataFrame:
    return _found(records.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "duplicate_id")


def phrasing_findings(records: DataFrame) -> DataFrame:
    """Groups with fewer than three phrasing families; the id is the group's."""
    groups = records.where(F.col("routing_path").isin("sql", "keyword")).select("phrasing_family", F.explode(F.array_distinct(F.transform("evidence.refs", lambda r: r.group_id))).alias("group_id"))
    few = groups.groupBy("group_id").agg(F.count_distinct("phrasing_family").alias("n")).where(F.col("n") < FAMILIES)
    return _found(few, "phrasing", "warning", "group_id")


def hard_findings(records: DataFrame) -> DataFrame:
    hard = records.where("difficulty = 'hard'")
    one = hard.where(F.size(F.array_distinct(F.transform("evidence.refs", lambda r: r.group_id))) < 2)
    short = hard.where(X.sentence_count(F.col("expected_answer")) < 4)
    return _found(one, "hard_groups").unionByName(_found(short, "hard_sentences", "warning"))


def provenance_findings(records: DataFrame) -> DataFrame:
    method, verified = F.col("gold_provenance.method"), F.col("review_status") == "verified"
    easy = method.isin(*EASY_METHODS)
    open_ = F.coalesce(F.exists("validation.checks", lambda c: c.verdict == "no"), F.lit(False))
    return (
        _found(records.where((F.col("difficulty") == "easy") & ~easy), "easy_method", "warning")
        .unionByName(_found(records.where(F.col("difficulty").isin("medium", "hard") & easy), "tier_method"))
        .unionByName(_found(records.where((method == MODEL_METHOD) & verified & (F.size("reviewers") < 2)), "no_human"))
        .unionByName(_found(records.where(open_ & verified), "open_check"))
    )


def split_findings(records: DataFrame, fraction: float = 0.2) -> DataFrame:
    due = record_splits(flat_refs(records), fraction).select("id", F.col("split").alias("due"))
    return _found(records.select("id", "split").join(due, "id").where(~F.col("split").eqNullSafe(F.col("due"))).distinct(), "split")


def evidence_findings(records: DataFrame, lines: DataFrame, digests: DataFrame) -> DataFrame:
    """Cited lines that don't exist or hash differently, unknown datasets, other corpus digests."""
    refs = flat_refs(records)
    hashed = refs.join(lines, ["dataset", "line_number"], "left").where(~X.digest(F.col("text")).eqNullSafe(F.col("line_hash")))
    cited = refs.groupBy("id").agg(F.min("dataset").alias("dataset"))
    sha = cited.join(records.select("id", F.col("gold_provenance.corpus_sha256").alias("claimed")), "id").join(digests, "dataset", "left")
    return (
        _found(hashed.select("id").distinct(), "evidence_hash")
        .unionByName(_found(sha.where("corpus_sha256 is null"), "no_corpus"))
        .unionByName(_found(sha.where("corpus_sha256 is not null and not corpus_sha256 <=> claimed"), "corpus_digest"))
    )


CLAIM = ["operator", "literal", "pattern", "case_sensitive", "sql", "evidence_sql"]


def claims(records: DataFrame) -> DataFrame:
    """``(id, answer_type, dataset, claimed, operator, literal, pattern, case_sensitive, sql, evidence_sql)`` of every claim."""
    x = records.select("id", "answer_type", F.split_part(F.element_at("evidence.refs", 1).id, F.lit(":"), F.lit(1)).alias("dataset"), F.explode("numeric_claims").alias("c"))
    q = F.col("c.query")
    return x.select("id", "answer_type", "dataset", F.col("c.value").alias("claimed"), *[(F.coalesce(q[k], F.lit(False)) if k == "case_sensitive" else q[k]).alias(k) for k in CLAIM])


def recomputed(records: DataFrame, lines: DataFrame) -> DataFrame:
    """:func:`claims` with ``n``, what the lines give now; every distinct query is run once.

    Literals and patterns are counted by joins with the lines of their dataset. Statements
    are guarded and run as they stand; they are a short list by nature, and ``n`` is null
    for one that can't be run. Claims of any other operator have a null ``n`` too.
    """
    from lineloom.plans import guard

    spark, every = records.sparkSession, claims(records)
    found = F.when(F.col("operator") == "count_literal", X.contains(F.col("text"), F.col("literal"), F.col("case_sensitive"))).otherwise(F.rlike("text", F.concat(F.when(F.col("case_sensitive"), "").otherwise("(?iu)"), C.java_regex(F.col("pattern")))))
    queries = every.where(F.col("operator").isin("count_literal", "count_regex")).select("dataset", "operator", "literal", "pattern", "case_sensitive").distinct()
    hits = queries.join(lines, "dataset").where(found).groupBy("dataset", "operator", "literal", "pattern", "case_sensitive").agg(F.count(F.lit(1)).cast("double").alias("n"))
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"h.{k}")) for k in ("dataset", "operator", "literal", "pattern", "case_sensitive")]
    counted = every.where(F.col("operator").isin("count_literal", "count_regex")).alias("c").join(hits.alias("h"), reduce(lambda a, b: a & b, same), "left").select("c.*", F.coalesce("h.n", F.lit(0.0)).alias("n"))
    stated = every.where("operator = 'raw_sql'")
    parts = [counted, every.where(~F.coalesce(F.col("operator").isin("count_literal", "count_regex", "raw_sql"), F.lit(False))).withColumn("n", F.lit(None).cast("double"))]
    values = []
    for r in stated.select("dataset", "answer_type", "sql", "evidence_sql").distinct().collect():  # statements were run one by one when they were made
        one = spark.range(1).select(F.lit(None).cast("double").alias("n"))
        try:
            if f"'{r.dataset}'" not in r.sql:
                raise ValueError("another dataset")
            result = guard.read_only(spark, lines, r.sql)
            if r.answer_type != "scalar":
                one = result.agg(F.count(F.lit(1)).cast("double").alias("n"))
            elif len(result.columns) == 1:
                one = result.toDF("v").agg(F.when(F.count(F.lit(1)) == 1, F.max(F.expr("try_cast(v as double)"))).alias("n"))
                if r.evidence_sql:
                    held = guard.read_only(spark, lines, r.evidence_sql).agg((F.count(F.lit(1)) > 0).alias("held"))
                    one = one.crossJoin(held).select(F.when(F.col("held"), F.col("n")).alias("n"))  # one row each
        except Exception:  # noqa: S110  a statement that can't be run has no value, which is a finding
            pass
        values.append(one.select(F.lit(r.sql).alias("sql"), F.lit(r.dataset).alias("dataset"), F.lit(r.answer_type).alias("answer_type"), F.lit(r.evidence_sql).cast("string").alias("evidence_sql"), "n"))
    if values:
        run = reduce(DataFrame.unionByName, values)
        same = [F.col(f"c.{k}").eqNullSafe(F.col(f"h.{k}")) for k in ("dataset", "answer_type", "sql", "evidence_sql")]
        parts.append(stated.alias("c").join(F.broadcast(run).alias("h"), reduce(lambda a, b: a & b, same), "left").select("c.*", "h.n"))  # a row for each statement
    return reduce(DataFrame.unionByName, parts)


def shown_statement() -> Column:
    """The statement that a claim of :func:`claims` is shown with."""
    plain = C.display_sql(F.col("dataset"), F.when(F.col("operator") == "count_regex", F.col("pattern")).otherwise(F.col("literal")), F.col("case_sensitive"), F.col("operator") == "count_regex")
    return F.when(F.col("operator") == "raw_sql", F.when(F.coalesce("evidence_sql", F.lit("")) == "", F.col("sql")).otherwise(F.concat("sql", F.lit("\n-- evidence_sql (sample rows for illustration):\n"), "evidence_sql"))).otherwise(plain)


def answer_findings(records: DataFrame, lines: DataFrame) -> DataFrame:
    """Claims and answers that the lines don't give, and shown statements that don't fit the claim."""
    x = records.select("id", "expected_answer", "evidence.query_sql").join(recomputed(records, lines), "id")
    wrong = ~F.coalesce(F.col("claimed") == F.col("n"), F.lit(False))
    due = F.when(F.col("answer_type") == "presence", X.presence_answer(F.col("n").cast("long"))).otherwise(F.col("n").cast("long").cast("string"))
    fits = F.when(F.col("answer_type") == "scalar", F.coalesce(F.expr("try_cast(expected_answer as double)") == F.col("n"), F.lit(False))).when(F.col("answer_type") == "line_lookup", True).otherwise(F.col("expected_answer") == due)
    none = records.where(F.col("answer_type").isin("count", "presence", "scalar") & (F.coalesce(F.size("numeric_claims"), F.lit(0)) < 1))
    texts = flat_refs(records.where("answer_type = 'line_lookup'")).join(lines, ["dataset", "line_number"]).groupBy("id").agg(F.collect_set("text").alias("texts"))
    lookups = records.where("answer_type = 'line_lookup'").select("id", "expected_answer").join(texts, "id", "left").where(~F.coalesce(F.array_contains("texts", F.col("expected_answer")), F.lit(False)))
    return (
        _found(x.where(wrong), "claim")
        .unionByName(_found(x.where(~wrong & ~fits), "answer"))
        .unionByName(_found(x.where(~F.col("query_sql").eqNullSafe(shown_statement())), "query_sql"))
        .unionByName(_found(none, "no_claim"))
        .unionByName(_found(lookups, "lookup"))
    )


def corpus_difference(lines: DataFrame, files: DataFrame) -> DataFrame:
    """``(dataset, problem, line_number, n)``: where the table ``lines`` and the lines of ``files`` differ.

    ``missing`` and ``extra`` lines and other ``text``, with the first line and how many
    there are; ``numbering`` if the table's numbers don't run from 1 without gaps or
    repeats, with the count that they should reach.
    """
    each = lines.groupBy("dataset", "line_number").agg(F.count(F.lit(1)).alias("times")).groupBy("dataset")
    each = each.agg(F.sum("times").alias("n"), F.min("line_number").alias("lo"), F.max("line_number").alias("hi"), (F.max("times") > 1).alias("repeats"))
    found = line_difference(lines, files)
    return found.unionByName(numbering_flaws(each, found.schema["line_number"].dataType))


def line_difference(lines: DataFrame, files: DataFrame) -> DataFrame:
    """``missing``, ``extra`` and other ``text`` of ``corpus_difference``."""
    a = lines.select("dataset", "line_number", F.col("text").alias("t"), F.lit(True).alias("ta"))
    b = files.select("dataset", "line_number", F.col("text").alias("f"), F.lit(True).alias("fa"))
    both = a.join(b, ["dataset", "line_number"], "full_outer")
    problem = F.when(F.col("ta").isNull(), "missing").when(F.col("fa").isNull(), "extra").when(~F.col("t").eqNullSafe(F.col("f")), "text")
    return both.withColumn("problem", problem).where("problem is not null").groupBy("dataset", "problem").agg(F.min("line_number").alias("line_number"), F.count(F.lit(1)).alias("n"))


def numbering_flaws(each: DataFrame, number: DataType) -> DataFrame:
    """``numbering`` of ``corpus_difference``, from ``each`` (dataset, n, lo, hi, repeats)."""
    return each.where("lo <> 1 or hi <> n or repeats").select("dataset", F.lit("numbering").alias("problem"), F.col("n").cast(number).alias("line_number"), "n")


def uncovered(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """Datasets that no record cites; manifest is (dataset)."""
    return manifest.join(flat_refs(records).select("dataset").distinct(), "dataset", "left_anti")


def statistics(records: DataFrame) -> DataFrame:
    """Counts by several fields in one pass of grouping sets."""
    fields = ["difficulty", "routing_path", "answer_type", "split", "review_status"]
    x = records.select(*[F.coalesce(c, F.lit("?")).alias(c) for c in fields])
    sets = x.groupingSets([[F.col(c)] for c in fields], *[F.col(c) for c in fields]).agg(F.count(F.lit(1)).alias("n"), *[F.grouping(c).alias(f"g_{c}") for c in fields])
    name: Column = F.coalesce(*[F.when(F.col(f"g_{c}") == 0, F.lit(c)) for c in fields])
    return sets.select(name.alias("field"), F.coalesce(*[F.when(F.col(f"g_{c}") == 0, F.col(c)) for c in fields]).alias("value"), "n")


def all_findings(records: DataFrame, lines: DataFrame, digests: DataFrame) -> DataFrame:
    parts = [schema_findings(records), duplicate_findings(records), phrasing_findings(records), hard_findings(records), provenance_findings(records), split_findings(records), evidence_findings(records, lines, digests), answer_findings(records, lines)]
    return reduce(DataFrame.unionByName, parts)


def outcome(records: DataFrame, findings: DataFrame) -> DataFrame:
    """``(code, records, errors, warnings)``: 0 if nothing is wrong, 1 with errors, 2 without records."""
    n, kinds = records.agg(F.count(F.lit(1)).alias("records")), findings.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    return n.crossJoin(kinds).select(F.when(F.col("records") == 0, 2).when(F.col("errors") > 0, 1).otherwise(0).alias("code"), "records", "errors", "warnings")  # one row each


def report(findings: DataFrame, most: int = 50) -> DataFrame:
    """``(severity, at, line)``: the findings as text, the first ``most`` of each severity, and how many more there are."""
    at = F.row_number().over(Window.partitionBy("severity").orderBy("check", "id"))
    listed = findings.withColumn("at", at).where(F.col("at") <= most).select("severity", "at", F.concat("check", F.lit(": "), F.coalesce("id", F.lit("?"))).alias("line"))
    more = findings.groupBy("severity").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    return listed.unionByName(more.select("severity", F.lit(most + 1).alias("at"), F.concat(F.lit("... and "), (F.col("n") - most).cast("string"), F.lit(" more")).alias("line")))
