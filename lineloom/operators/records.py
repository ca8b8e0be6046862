"""Question records: answers with hashed, line-level evidence, as nested rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lineloom.functions import text as X
from lineloom.operators import counting as C
from lineloom.operators import groups as G
from lineloom.operators import positional as P
from lineloom.operators.splits import record_splits

#: Phrasings of each kind of question.
COUNT_PHRASINGS = [("how-many", "How many log lines contain '{literal}'?"), ("count-the", "Count the lines mentioning '{literal}'."), ("total-of", "What is the total number of '{literal}' occurrences?")]
PRESENCE_PHRASINGS = [("how-many", "Does the log contain any line with '{literal}'?"), ("count-the", "Check whether the log has a line mentioning '{literal}'."), ("imperative", "Tell me if there is at least one occurrence of '{literal}' in the log.")]
FIRST_PHRASINGS = [("how-many", "Show the first line that reports '{literal}'."), ("count-the", "Find the first log line mentioning '{literal}'."), ("imperative", "Give me the first line where '{literal}' appears.")]
LAST_PHRASINGS = [("how-many", "Show the last line that reports '{literal}'."), ("count-the", "Find the last log line mentioning '{literal}'."), ("imperative", "Give me the last line where '{literal}' appears.")]
WINDOW_PHRASINGS = [
    ("explain", "In the {dataset} log, around the {ordinal} occurrence of '{anchor}': what happened and what does it mean?"),
    ("describe", "Describe what is happening in the {dataset} log around the {ordinal} occurrence of '{anchor}'."),
    ("summarize", "Summarize the event shown in the {dataset} log near the {ordinal} occurrence of '{anchor}'."),
    ("interpret", "Looking at the {dataset} log around the {ordinal} occurrence of '{anchor}', what took place and what is its significance?"),
    ("walk-through", "Walk me through what the {dataset} log shows around the {ordinal} occurrence of '{anchor}', and explain what it means."),
]
#: Names of the phrasings of questions about two groups.
GROUP_FAMILIES = ["compare", "how-differ", "contrast", "both-appear", "examine-versus"]
LEAST_MATCHES, CITED, CREATED_AT, CREATED_BY = 3, 5, "2025-01-01T00:00:00Z", "records@v1"
MODEL = "struct<name:string,family:string,digest:string,prompt_sha256:string>"


def _fill(template: Column, **values: Column) -> Column:
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def _phrasings(pairs: list[tuple[str, str]]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f).alias("family"), F.lit(t).alias("template")) for i, (f, t) in enumerate(pairs)])


def _provenance(method: str, sha: Column, model: Column | None = None) -> Column:
    return F.struct(F.lit(method).alias("method"), F.lit(CREATED_BY).alias("created_by"), F.lit(CREATED_AT).alias("created_at"), sha.alias("corpus_sha256"), (F.lit(None) if model is None else model).cast(MODEL).alias("model"))


CHECKS = "array<struct<dimension:string,verdict:string,detail:string>>"
SUMMARY = "struct<event_type:string,entity:string,observed_events:string,outcome:string>"
CLAIMS = "array<struct<value:double,query:struct<operator:string,literal:string,pattern:string,case_sensitive:boolean,sql:string,evidence_sql:string>>>"
#: Drafts of answers, as a model or a person gives them: the extracted fields as labelled lines, the answer, and the model.
DRAFTS = f"id string, extraction string, answer string, model {MODEL}"


def _drafted(x: DataFrame, drafts: DataFrame, difficulty: str, answer_type: str, summary: Column | None) -> DataFrame:
    """Records in review from ``x`` (id, question, task, phrasing_family, corpus_sha256, refs) and their drafts; one without a draft is none."""
    x = x.join(drafts.select("id", "extraction", "answer", "model"), "id")
    text = F.lit(None).cast("string")
    return x.select(
        "id", "question", F.lit("semantic").alias("routing_path"), F.lit(answer_type).alias("answer_type"), "task", F.lit(difficulty).alias("difficulty"), "phrasing_family", text.alias("split"),
        F.lit("in_review").alias("review_status"), F.array(F.lit(CREATED_BY)).alias("reviewers"), F.col("answer").alias("expected_answer"),
        _provenance("independent_model_then_human", F.col("corpus_sha256"), F.col("model")).alias("gold_provenance"), F.lit(None).cast(CLAIMS).alias("numeric_claims"),
        (F.lit(None) if summary is None else summary).cast(SUMMARY).alias("structured_summary"), F.struct("refs", text.alias("query_sql")).alias("evidence"),
        F.struct(F.lit(None).cast(CHECKS).alias("checks"), F.lit(None).cast(MODEL).alias("model")).alias("validation"),
    )


def easy_records(lines: DataFrame, specs: DataFrame, digests: DataFrame) -> DataFrame:
    """Counts, presence and lookups, three phrasings each.

    ``specs`` is ``(dataset, kind, position, literal, case_sensitive)``, ``digests``
    ``(dataset, corpus_sha256)``. Counts below three matches and lookups without one
    give no record; a presence without a match cites the first line.
    """
    keyed = specs.withColumn("spec_id", F.concat_ws("_", "kind", X.slug(F.col("literal"))))
    hits = C.literal_matches(lines, keyed)
    spot = F.when(F.col("position") == "last", -F.col("line_number")).otherwise(F.col("line_number"))
    most = F.when(F.col("kind") == "lookup", 1).otherwise(CITED)
    by = Window.partitionBy("dataset", "spec_id").orderBy(spot)
    cited = hits.withColumn("at", F.row_number().over(by)).where(F.col("at") <= most).groupBy("dataset", "spec_id").agg(F.array_sort(F.collect_list(F.struct("line_number", "text"))).alias("cited"))
    counts = hits.groupBy("dataset", "spec_id").agg(F.count(F.lit(1)).alias("n"))
    first = lines.where("line_number = 1").select("dataset", F.array(F.struct("line_number", "text")).alias("fallback"))
    x = keyed.join(counts, ["dataset", "spec_id"], "left").join(cited, ["dataset", "spec_id"], "left").join(first, "dataset").join(digests, "dataset").withColumn("n", F.coalesce("n", F.lit(0)))
    x = x.where(f"kind = 'presence' or (kind = 'count' and n >= {LEAST_MATCHES}) or (kind = 'lookup' and n >= 1)").withColumn("cited", F.coalesce("cited", "fallback"))
    kind = F.col("kind")
    options = F.when(kind == "count", _phrasings(COUNT_PHRASINGS)).when(kind == "presence", _phrasings(PRESENCE_PHRASINGS)).when(F.col("position") == "last", _phrasings(LAST_PHRASINGS)).otherwise(_phrasings(FIRST_PHRASINGS))
    x = x.withColumn("p", F.explode(options)).withColumn("group_id", F.concat_ws(":", "dataset", "kind", X.slug(F.col("literal"))))
    refs = F.transform("cited", lambda c: X.evidence_ref(F.col("dataset"), c.line_number, X.digest(c.text), F.col("group_id")))
    claim = F.struct(F.col("n").cast("double").alias("value"), F.struct(F.lit("count_literal").alias("operator"), F.col("literal"), F.lit(None).cast("string").alias("pattern"), F.col("case_sensitive"), F.lit(None).cast("string").alias("sql"), F.lit(None).cast("string").alias("evidence_sql")).alias("query"))
    checks = "array<struct<dimension:string,verdict:string,detail:string>>"
    return x.select(
        F.concat_ws("_", "dataset", F.lit("v1"), "spec_id", "p.i").alias("id"),
        _fill(F.col("p.template"), literal=F.col("literal")).alias("question"),
        F.when(kind == "count", "sql").otherwise("keyword").alias("routing_path"),
        F.when(kind == "lookup", "line_lookup").otherwise(kind).alias("answer_type"),
        F.when(kind == "count", "Aggregation").otherwise("Lookup").alias("task"),
        F.lit("easy").alias("difficulty"), F.col("p.family").alias("phrasing_family"), F.lit(None).cast("string").alias("split"),
        F.lit("verified").alias("review_status"), F.array(F.lit(CREATED_BY)).alias("reviewers"),
        F.when(kind == "count", F.col("n").cast("string")).when(kind == "presence", X.presence_answer(F.col("n"))).otherwise(F.element_at("cited", 1).text).alias("expected_answer"),
        _provenance("deterministic_aggregation", F.col("corpus_sha256")).alias("gold_provenance"),
        F.when(kind != "lookup", F.array(claim)).alias("numeric_claims"),
        F.lit(None).cast("struct<event_type:string,entity:string,observed_events:string,outcome:string>").alias("structured_summary"),
        F.struct(refs.alias("refs"), F.when(kind != "lookup", C.display_sql(F.col("dataset"), F.col("literal"), F.col("case_sensitive"))).alias("query_sql")).alias("evidence"),
        F.struct(F.lit(None).cast(checks).alias("checks"), F.lit(None).cast(MODEL).alias("model")).alias("validation"),
    )


def flat_refs(records: DataFrame) -> DataFrame:
    """``(id, ref_id, dataset, line_number, line_hash, group_id)``, a row per cited line."""
    r = records.select("id", F.explode("evidence.refs").alias("r"))
    return r.select("id", F.col("r.id").alias("ref_id"), F.split_part("r.id", F.lit(":"), F.lit(1)).alias("dataset"), "r.line_number", "r.line_hash", "r.group_id")


def window_questions(picks: DataFrame, anchor: str) -> DataFrame:
    """A question for each picked occurrence, phrasings in turn; picks are (dataset, line_number, rn, k)."""
    options = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("template")) for f, t in WINDOW_PHRASINGS])
    p = F.get(options, F.col("k") % len(WINDOW_PHRASINGS))
    text = _fill(p.template, dataset=F.col("dataset"), ordinal=X.ordinal(F.col("rn")), anchor=F.lit(anchor))
    name = X.slug(F.lit(anchor))
    return picks.select("dataset", "line_number", "k", F.concat_ws("_", "dataset", F.lit("v1_semantic"), name, F.col("k")).alias("id"), F.concat(F.col("dataset"), F.lit(":semantic:"), name, F.lit("_"), F.col("k")).alias("group_id"), p.family.alias("phrasing_family"), text.alias("question"))


def medium_evidence(lines: DataFrame, anchor: str, digests: DataFrame, quota: int, before: int = 5, after: int = 5) -> DataFrame:
    """What a medium question needs before its answer is drafted: question, refs and evidence text around each picked occurrence.

    A dataset without an occurrence has no question.
    """
    picks = P.stride(lines.where(X.contains(F.col("text"), F.lit(anchor), F.lit(False))), quota)
    near = P.context(lines, window_questions(picks, anchor), ["id", "group_id", "phrasing_family", "question"], before, after)
    row = F.struct("line_number", "text")
    x = near.groupBy("id", "dataset", "group_id", "phrasing_family", "question").agg(F.array_sort(F.collect_list(row)).alias("shown")).join(digests, "dataset")
    refs = F.transform("shown", lambda c: X.evidence_ref(F.col("dataset"), c.line_number, X.digest(c.text), F.col("group_id")))
    return x.select("id", "dataset", "question", F.lit("Summarization").alias("task"), "phrasing_family", "corpus_sha256", refs.alias("refs"), F.array_join(F.transform("shown", lambda c: c.text), "\n").alias("evidence_text"))


def medium_records(asked: DataFrame, drafts: DataFrame) -> DataFrame:
    """Records of :func:`medium_evidence` with their ``drafts``; the structured summary is read from the extraction's labels."""
    summary = F.struct(*[X.labelled_field(F.col("extraction"), k.upper()).alias(k) for k in ("event_type", "entity", "observed_events", "outcome")])
    return _drafted(asked, drafts, "medium", "explanation", summary)


def comparative_sides(lines: DataFrame, pattern: str, least: int, most: int) -> DataFrame:
    """``(dataset, set_id, side, key, line_number, text)``: the lines of two large groups of one kind, ``most`` such sets of each dataset."""
    rows = G.keyed(lines, pattern)
    sets = G.comparative_sets(G.large_groups(rows, "key", least), 2, most).select("dataset", "set_id", ((F.col("rn") - 1) % 2).cast("int").alias("side"), "key")
    return rows.join(sets, ["dataset", "key"]).select("dataset", "set_id", "side", "key", "line_number", "text")


def correlation_sides(lines: DataFrame, pattern_a: str, pattern_b: str, least: int, most: int) -> DataFrame:
    """As :func:`comparative_sides`, for pairs of groups that a line proves to belong together."""
    taken = G.greedy_matching(G.proven_pairs(lines, pattern_a, pattern_b, least), most)
    numbered = taken.withColumn("set_id", (F.row_number().over(Window.partitionBy("dataset").orderBy("rk")) - 1).cast("int"))  # at most ``most`` rows of a dataset
    sides = [numbered.select("dataset", "set_id", F.lit(i).alias("side"), F.col(c).alias("key")).join(G.keyed(lines, p), ["dataset", "key"]) for i, (c, p) in enumerate((("a", pattern_a), ("b", pattern_b)))]
    return sides[0].unionByName(sides[1]).select("dataset", "set_id", "side", "key", "line_number", "text")


def hard_evidence(sides: DataFrame, spec_id: str, task: str, templates: list[str], digests: DataFrame, cap: int = 10) -> DataFrame:
    """What a hard question needs before its answer is drafted: question, refs and evidence blocks of both groups.

    ``templates`` name the groups ``{key0}`` and ``{key1}`` and take turns. Of each
    group its most telling lines are shown, ``cap`` at most.
    """
    by = ["dataset", "set_id", "side", "key"]
    kept = G.salient(sides, by, cap)
    group = F.concat_ws(":", "dataset", F.lit("hard"), F.lit(spec_id), "set_id", X.slug(F.col("key")))
    refs = kept.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("line_number", "text"))).alias("shown"))
    refs = refs.select(*by, F.transform("shown", lambda c: X.evidence_ref(F.col("dataset"), c.line_number, X.digest(c.text), group)).alias("own"))
    both = refs.join(G.gap_blocks(kept, by, "key"), by).groupBy("dataset", "set_id").agg(F.array_sort(F.collect_list(F.struct("side", "key", "own", "block"))).alias("two")).where(F.size("two") == 2).join(digests, "dataset")
    turn = F.col("set_id") % len(templates)
    question = _fill(F.get(F.array(*[F.lit(t) for t in templates]), turn), key0=F.col("two")[0].key, key1=F.col("two")[1].key)
    family = F.get(F.array(*[F.lit(f) for f in GROUP_FAMILIES]), turn % len(GROUP_FAMILIES))
    return both.select(F.concat_ws("_", "dataset", F.lit(f"v1_hard_{spec_id}"), "set_id").alias("id"), "dataset", question.alias("question"), F.lit(task).alias("task"), family.alias("phrasing_family"), "corpus_sha256", F.flatten(F.transform("two", lambda t: t.own)).alias("refs"), F.array_join(F.transform("two", lambda t: t.block), "\n\n").alias("evidence_text"))


def hard_records(asked: DataFrame, drafts: DataFrame) -> DataFrame:
    """Records of :func:`hard_evidence` with their ``drafts``."""
    return _drafted(asked, drafts, "hard", "synthesis", None)


def statement_records(answers: DataFrame, questions: DataFrame, digests: DataFrame) -> DataFrame:
    """Records of the answers that statements gave, a record for each phrasing of ``questions`` (slot, dataset, phrasings)."""
    mode, lookup = F.col("mode"), F.col("mode") == "line_lookup"
    x = answers.join(questions, ["slot", "dataset"]).join(digests, "dataset").withColumn("group_id", F.concat_ws(":", "dataset", F.lit("modelsql"), "mode", "slot"))
    x = x.withColumn("cited", F.when(lookup, F.slice("cited", 1, 1)).otherwise(F.col("cited"))).select("*", F.posexplode("phrasings").alias("p", "question"))
    refs = F.transform("cited", lambda c: X.evidence_ref(F.col("dataset"), c.line_number, X.digest(c.text), F.col("group_id")))
    none = F.lit(None).cast("string")
    value = F.when(mode == "scalar", F.expr("try_cast(answer as double)")).otherwise(F.col("rows").cast("double"))
    claim = F.struct(value.alias("value"), F.struct(F.lit("raw_sql").alias("operator"), none.alias("literal"), none.alias("pattern"), F.lit(None).cast("boolean").alias("case_sensitive"), F.col("sql"), F.when(mode == "scalar", F.col("evidence_sql")).alias("evidence_sql")).alias("query"))
    shown = F.when(mode == "scalar", F.concat("sql", F.lit("\n-- evidence_sql (sample rows for illustration):\n"), "evidence_sql")).otherwise(F.col("sql"))
    return x.select(
        F.concat_ws("_", "dataset", F.lit("v1_modelsql"), "mode", "slot", "p").alias("id"), "question", F.when(lookup, "keyword").otherwise("sql").alias("routing_path"), mode.alias("answer_type"),
        F.when(lookup, "Lookup").otherwise("Aggregation").alias("task"), F.lit("easy").alias("difficulty"), F.concat(F.lit("model-"), F.col("p") + 1).alias("phrasing_family"), none.alias("split"),
        F.lit("verified").alias("review_status"), F.array(F.lit(CREATED_BY)).alias("reviewers"), F.col("answer").alias("expected_answer"), _provenance("model_written_deterministic_sql", F.col("corpus_sha256")).alias("gold_provenance"),
        F.when(~lookup, F.array(claim)).cast(CLAIMS).alias("numeric_claims"), F.lit(None).cast(SUMMARY).alias("structured_summary"), F.struct(refs.alias("refs"), F.when(~lookup, shown).alias("query_sql")).alias("evidence"),
        F.struct(F.lit(None).cast(CHECKS).alias("checks"), F.lit(None).cast(MODEL).alias("model")).alias("validation"),
    )


#: Target shares of the tiers; they are reported, not enforced.
MIX = {"easy": 0.7, "medium": 0.2, "hard": 0.1}


def tier_mix(records: DataFrame) -> DataFrame:
    """``(difficulty, n, share, target)`` for each tier, those without a record included."""
    names = records.sparkSession.createDataFrame(list(MIX.items()), "difficulty string, target double")
    n = records.groupBy("difficulty").agg(F.count(F.lit(1)).alias("n"))
    x = names.join(n, "difficulty", "full_outer").withColumn("n", F.coalesce("n", F.lit(0)))
    return x.withColumn("share", F.round(F.col("n") / F.nullif(F.sum("n").over(Window.partitionBy(F.lit(0))), F.lit(0)), 6)).select("difficulty", "n", "share", F.coalesce("target", F.lit(0.0)).alias("target"))  # three rows


def with_splits(records: DataFrame, fraction: float = 0.2) -> DataFrame:
    """Records of all tiers with their split."""
    return records.drop("split").join(record_splits(flat_refs(records), fraction).select("id", "split"), "id", "left").select(*records.columns)
