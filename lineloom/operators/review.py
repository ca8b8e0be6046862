"""Human review: worksheets, decisions, and grouped export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.functions import text as X


def worksheet(records: DataFrame) -> DataFrame:
    """The records in review as text columns that a spreadsheet can open."""
    checks = F.col("validation.checks")
    supported = F.size(F.filter(checks, lambda c: c.verdict == "yes"))
    summary = F.when(F.coalesce(F.size(checks), F.lit(0)) < 1, "").otherwise(F.concat(supported.cast("string"), F.lit("/"), F.size(checks).cast("string"), F.lit(" dimensions supported")))
    cited = F.array_join(F.transform("evidence.refs", lambda r: F.concat(F.coalesce(r.group_id, F.lit("?")), F.lit(" #"), F.coalesce(r.line_number.cast("string"), F.lit("?")))), "\n")
    empty = F.lit("")
    return records.where("review_status = 'in_review'").select(
        "id", "difficulty", X.csv_safe(F.col("question")).alias("question"), X.csv_safe(F.col("expected_answer")).alias("draft_answer"), X.digest(F.col("expected_answer")).alias("draft_sha256"),
        summary.alias("validation_summary"), X.csv_safe(cited).alias("evidence"), empty.alias("decision"), empty.alias("edited_answer"), empty.alias("note"),
    )


def worksheet_problems(sheet: DataFrame, records: DataFrame) -> DataFrame:
    """``(id, problem)`` of rows that can't be applied; with any, nothing should be."""
    known = records.select("id", X.digest(F.col("expected_answer")).alias("now"), F.coalesce(F.exists("validation.checks", lambda c: c.verdict == "no"), F.lit(False)).alias("open"))
    x = sheet.join(known, "id", "left")
    decision = F.lower(F.trim(F.coalesce("decision", F.lit(""))))
    cases = {
        "empty_id": F.coalesce("id", F.lit("")) == "",
        "unknown_id": (F.coalesce("id", F.lit("")) != "") & F.col("now").isNull(),
        "stale": (F.coalesce("draft_sha256", F.lit("")) != "") & F.col("now").isNotNull() & (F.col("draft_sha256") != F.col("now")),
        "decision": ~decision.isin("", "accept", "edit", "reject"),
        "empty_edit": (decision == "edit") & (F.trim(F.coalesce("edited_answer", F.lit(""))) == ""),
        "accept_over_no": (decision == "accept") & F.coalesce("open", F.lit(False)),
    }
    single = x.select("id", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in cases.items()]))).alias("problem"))
    twice = sheet.where("id <> ''").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", F.lit("duplicate_id").alias("problem"))
    return single.unionByName(twice)


def apply_decisions(records: DataFrame, sheet: DataFrame, reviewer: str) -> DataFrame:
    """Records with the sheet's decisions: status, answer and reviewer; the rest unchanged."""
    asked = sheet.select("id", F.lower(F.trim(F.coalesce("decision", F.lit("")))).alias("_decision"), X.csv_unsafe(F.coalesce("edited_answer", F.lit(""))).alias("_answer"))
    x = records.join(asked, "id", "left")
    d = F.coalesce("_decision", F.lit(""))
    edited = (d == "edit") & (F.col("_answer") != "")
    status = F.when((d == "accept") | edited, "verified").when(d == "reject", "rejected").otherwise(F.col("review_status"))
    acted = (d == "accept") | edited | (d == "reject")
    return x.withColumns({
        "review_status": status,
        "expected_answer": F.when(edited, F.col("_answer")).otherwise(F.col("expected_answer")),
        "reviewers": F.when(acted, F.array_union("reviewers", F.array(F.lit(reviewer)))).otherwise(F.col("reviewers")),
    }).drop("_decision", "_answer")


def review_events(before: DataFrame, after: DataFrame, reviewer: str, at: str) -> DataFrame:
    """One event for each record that a review changed."""
    a, b = before.select("id", F.col("review_status").alias("was"), F.col("expected_answer").alias("old")), after.select("id", F.col("review_status").alias("now"), F.col("expected_answer").alias("new"))
    x = a.join(b, "id").where("was <> now or old <> new")
    return x.select("id", F.lit(reviewer).alias("reviewer"), F.lit(at).alias("decided_at"), "was", "now", (F.col("old") != F.col("new")).alias("edited"), X.digest(F.col("new")).alias("answer_sha256"))


def human_reviewers(reviewers, generated: str):
    """Reviewers whose name doesn't start with the prefix that generated stamps have."""
    return F.filter(reviewers, lambda r: ~r.startswith(generated))


def payload(records: DataFrame, generated: str, order: str = "id") -> DataFrame:
    """``(dataset, corpus_sha256, digests, questions)``: each dataset's records as one array in the given order.

    The arrays are meant for a review tool, so a dataset's questions must fit one row.
    Records without evidence are left out; more than one corpus digest in a dataset shows in ``digests``.
    """
    x = records.where(F.size("evidence.refs") > 0).withColumn("dataset", F.split_part(F.element_at("evidence.refs", 1).id, F.lit(":"), F.lit(1)))
    q = F.struct(F.col(order).alias("at"), F.struct("id", "question", "expected_answer", "answer_type", "difficulty", "split", human_reviewers(F.col("reviewers"), generated).alias("reviewers")).alias("q"))
    questions = F.transform(F.array_sort(F.collect_list(q)), lambda v: v.q)
    return x.groupBy("dataset").agg(F.min("gold_provenance.corpus_sha256").alias("corpus_sha256"), F.count_distinct("gold_provenance.corpus_sha256").alias("digests"), questions.alias("questions"))


def payload_problems(records: DataFrame, layout: DataFrame) -> DataFrame:
    """``(problem, dataset, id)`` that a payload must not have; ``layout`` is (dataset, path, version).

    Records without evidence, datasets of which the corpus isn't pinned, and datasets whose records name several corpora.
    """
    x = records.withColumn("dataset", F.split_part(F.try_element_at("evidence.refs", F.lit(1)).id, F.lit(":"), F.lit(1)))
    none = x.where(F.coalesce(F.size("evidence.refs"), F.lit(0)) < 1).select(F.lit("no_evidence").alias("problem"), F.lit(None).cast("string").alias("dataset"), "id")
    cited = x.where(F.size("evidence.refs") > 0)
    unpinned = cited.join(layout.where("version is not null"), "dataset", "left_anti").groupBy("dataset").agg(F.min("id").alias("id"))
    several = cited.groupBy("dataset").agg(F.count_distinct("gold_provenance.corpus_sha256").alias("n"), F.min("id").alias("id")).where("n > 1")
    return none.unionByName(unpinned.select(F.lit("unpinned").alias("problem"), "dataset", "id")).unionByName(several.select(F.lit("several_corpora").alias("problem"), "dataset", "id"))


def dataset_layout(manifest: DataFrame) -> DataFrame:
    """``(dataset, path, version)`` of a manifest (name, local_filename, raw_path, pinned_commit)."""
    return manifest.select(F.col("name").alias("dataset"), F.col("local_filename").alias("path"), F.col("pinned_commit").alias("version"))


def attach_checks(records: DataFrame, checks: DataFrame) -> DataFrame:
    """Records with the verdicts of ``checks`` (id, dimension, verdict, detail); any ``no`` puts a record in review."""
    found = checks.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("dimension", "verdict", "detail"))).alias("found"))
    x = records.join(found, "id", "left")
    refused = F.coalesce(F.exists("found", lambda c: c.verdict == "no"), F.lit(False))
    return x.withColumn("validation", F.col("validation").withField("checks", F.coalesce("found", "validation.checks"))).withColumn("review_status", F.when(refused, "in_review").otherwise(F.col("review_status"))).drop("found")


#: Routes whose answers a statement can settle.
SETTLED = ("sql", "keyword")


def verification(records: DataFrame, results: DataFrame, most: int | None = None) -> DataFrame:
    """``(id, answer_type, agrees, problem)`` of the records that statements can settle, the first ``most`` by id if given.

    ``results`` is (id, value, problem); a record without a result disagrees.
    """
    due = records.where(F.col("routing_path").isin(*SETTLED))
    due = due.orderBy("id").limit(most) if most is not None else due
    told = agreement(due, results.select("id", "value"))
    return told.join(results.select("id", "problem"), "id", "left").select("id", "answer_type", "agrees", F.when(~F.col("agrees"), F.coalesce("problem", F.lit("another answer"))).alias("problem"))


def tally(verified: DataFrame) -> DataFrame:
    """``(answer_type, checked, agreed, disagreed)``."""
    return verified.groupBy("answer_type").agg(F.count(F.lit(1)).alias("checked"), F.count_if("agrees").alias("agreed"), F.count_if(~F.col("agrees")).alias("disagreed"))


def agreement(records: DataFrame, results: DataFrame) -> DataFrame:
    """``(id, agrees)``: typed comparison of answers with ``results`` (id, value text); a missing value disagrees."""
    x = records.select("id", "answer_type", "expected_answer").join(results, "id", "left")
    v, gold, number = F.col("value"), F.col("expected_answer"), F.expr("try_cast(value as double)")
    yes = F.coalesce(number > 0, F.lower("value") == "true")
    same = F.when(F.col("answer_type") == "count", number.cast("long").cast("string") == gold).when(F.col("answer_type") == "presence", F.when(yes, gold.startswith("Yes")).otherwise(gold.startswith("No")))
    same = same.when(F.col("answer_type") == "scalar", number == F.expr("try_cast(expected_answer as double)")).otherwise(F.trim(v) == F.trim(gold))
    return x.select("id", "answer_type", F.coalesce(same & v.isNotNull(), F.lit(False)).alias("agrees"))
