import pytest
from pyspark.sql import functions as F

from lineloom.functions import text as X
from lineloom.operators import counting as C
from lineloom.operators import groups as G
from lineloom.operators import records as R
from lineloom.operators import review as W
from lineloom.operators import splits as S
from lineloom.operators import statements as T
from lineloom.operators import validation as V
from lineloom.plans import guard, tiers
from lineloom.sources import corpus

DIR = "/root/testdata/sf0.001"
FOUR = [
    "Jul 10 16:01:43 combo sshd: authentication failure for root",
    "Jul 10 16:01:44 combo sshd: authentication failure for admin",
    "Jul 10 16:01:45 combo sshd: session opened for user news",
    "Jul 10 16:01:46 combo sshd: authentication failure for guest",
]
SQL = "SELECT line_number, text FROM lines WHERE dataset = 'linux' AND text ILIKE '%failure%'"
SCALAR, SHOWN = "SELECT count(DISTINCT split_part(text, ' ', 5)) FROM lines WHERE dataset = 'linux'", "SELECT line_number, text FROM lines WHERE dataset = 'linux'"


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([("linux", i + 1, t) for i, t in enumerate(FOUR)], "dataset string, line_number int, text string").cache()


@pytest.fixture(scope="module")
def digests(spark):
    return spark.createDataFrame([("linux", "sha256:c")], "dataset string, corpus_sha256 string")


@pytest.fixture(scope="module")
def records(spark, lines, digests):
    """Literal, statement and medium records over four lines."""
    specs = spark.createDataFrame([("linux", "count", "first", "authentication failure", False), ("linux", "presence", "first", "Invalid user", False), ("linux", "lookup", "last", "failure", True)], "dataset string, kind string, position string, literal string, case_sensitive boolean")
    found = T.answers(spark, lines, [(0, "linux", "count", SQL, None), (3, "linux", "scalar", SCALAR, SHOWN)])
    asked = spark.createDataFrame([(s, "linux", ["a?", "b?", "c?"]) for s in (0, 3)], "slot int, dataset string, phrasings array<string>")
    return S_cut(R.with_splits(R.easy_records(lines, specs, digests).unionByName(R.statement_records(found, asked, digests))))


def S_cut(df):
    from lineloom.storage import cut

    return cut(df, "test")


def checks(records, lines, digests):
    return {(r.check, r.id) for r in V.all_findings(records, lines, digests).collect()}


def test_published_answers(records):
    got = {r.id: r.expected_answer for r in records.collect()}
    assert got["linux_v1_count_authentication_failure_0"] == "3"
    assert got["linux_v1_presence_invalid_user_2"] == "No (0 matching lines)"
    assert got["linux_v1_lookup_failure_1"] == FOUR[3]
    assert got["linux_v1_modelsql_count_0_0"] == "3" and got["linux_v1_modelsql_scalar_3_2"] == "1"


def test_unchanged_records_have_no_finding(records, lines, digests):
    assert checks(records, lines, digests) == set()


def changed(records, name, column, value):
    return records.withColumn(column, F.when(F.col("id") == name, value).otherwise(F.col(column)))


def query(field, value):
    return F.transform("numeric_claims", lambda c: F.struct(c.value.alias("value"), c["query"].withField(field, F.lit(value)).alias("query")))


LIT, SQ, SC, LK = "linux_v1_count_authentication_failure_0", "linux_v1_modelsql_count_0_0", "linux_v1_modelsql_scalar_3_0", "linux_v1_lookup_failure_0"


#: Record, column, what it becomes, and the check that must object.
FAULTS = [
    (SQ, "expected_answer", lambda: F.lit("4"), "answer"),
    (SC, "expected_answer", lambda: F.lit("7"), "answer"),
    (LK, "expected_answer", lambda: F.lit("another line"), "lookup"),
    (SQ, "numeric_claims", lambda: F.transform("numeric_claims", lambda c: c.withField("value", F.lit(9.0))), "claim"),
    (SQ, "numeric_claims", lambda: query("sql", "SELECT line_number, text FROM lines WHERE dataset = 'other'"), "claim"),
    (SC, "numeric_claims", lambda: query("evidence_sql", "SELECT line_number, text FROM lines WHERE dataset = 'linux' AND false"), "claim"),
    (LIT, "numeric_claims", lambda: query("operator", "no such operator"), "claim"),
    (LIT, "evidence", lambda: F.col("evidence").withField("query_sql", F.lit("SELECT 1")), "query_sql"),
    (LIT, "evidence", lambda: F.col("evidence").withField("refs", F.transform("evidence.refs", lambda r: r.withField("line_hash", F.lit("sha256:0")))), "evidence_hash"),
    (LIT, "gold_provenance", lambda: F.col("gold_provenance").withField("corpus_sha256", F.lit("sha256:0")), "corpus_digest"),
    (LIT, "gold_provenance", lambda: F.col("gold_provenance").withField("created_at", F.lit("yesterday")), "schema"),
    (LIT, "gold_provenance", lambda: F.col("gold_provenance").withField("method", F.lit("by hand")), "easy_method"),
    (LIT, "difficulty", lambda: F.lit("medium"), "tier_method"),
    (LIT, "numeric_claims", lambda: F.lit(None), "no_claim"),
]


def test_each_fault_is_found(records, lines, digests):
    """A copy of a record for each fault, all in one validation."""
    bad = records
    for k, (name, column, value, _) in enumerate(FAULTS):
        bad = bad.unionByName(records.where(F.col("id") == name).withColumn(column, value().cast(records.schema[column].dataType)).withColumn("id", F.concat("id", F.lit(f"_f{k}"))))
    found = checks(S_cut(bad), lines, digests)
    for k, (name, *_, check) in enumerate(FAULTS):
        assert (check, f"{name}_f{k}") in found, (k, check)
    assert not {i for _, i in found} & {r.id for r in records.collect()}


def test_faults_of_whole_sets(records, lines, digests, spark):
    twice = records.unionByName(records.where(F.col("id") == LIT))
    assert ("duplicate_id", LIT) in checks(twice, lines, digests)
    flipped = changed(records, LIT, "split", F.when(F.col("split") == "dev", "test").otherwise("dev"))
    assert ("split", LIT) in checks(flipped, lines, digests)
    assert ("no_corpus", LIT) in checks(records, lines, digests.limit(0))
    few = records.where(~F.col("phrasing_family").isin("how-many") | ~F.col("id").startswith("linux_v1_count"))
    assert {c for c, _ in checks(few, lines, digests)} == {"phrasing"}
    method = F.col("gold_provenance").withField("method", F.lit("independent_model_then_human"))
    alone = changed(changed(records, LIT, "gold_provenance", method), LIT, "difficulty", F.lit("hard"))
    assert {("no_human", LIT), ("hard_groups", LIT), ("hard_sentences", LIT)} <= checks(alone, lines, digests)
    no = F.struct(F.array(F.struct(F.lit("grounded").alias("dimension"), F.lit("no").alias("verdict"), F.lit(None).cast("string").alias("detail"))).alias("checks"), F.col("validation.model").alias("model"))
    assert ("open_check", LIT) in checks(changed(records, LIT, "validation", no), lines, digests)
    assert V.outcome(records, V.all_findings(twice, lines, digests)).first().code == 1
    assert V.outcome(records, V.all_findings(records, lines, digests)).first().code == 0
    assert V.outcome(records.limit(0), V.all_findings(records.limit(0), lines, digests)).first().code == 2
    many = spark.range(70).select(F.lit("x").alias("check"), F.lit("error").alias("severity"), F.format_string("r%02d", "id").alias("id"))
    assert [r.line for r in V.report(many).orderBy("at").collect()][-2:] == ["x: r49", "... and 20 more"]


def test_regex_claims(records, lines, digests):
    pattern = "AUTHENTICATION .*[[:alpha:]]$"
    claim = F.transform("numeric_claims", lambda c: F.struct(c.value.alias("value"), c["query"].withField("operator", F.lit("count_regex")).withField("pattern", F.lit(pattern)).withField("literal", F.lit(None).cast("string")).alias("query")))
    shown = f"SELECT line_number, text FROM lines WHERE dataset = 'linux' AND text ~* '{pattern}' ORDER BY line_number"
    regex = changed(changed(records, LIT, "numeric_claims", claim), LIT, "evidence", F.col("evidence").withField("query_sql", F.lit(shown)))
    assert checks(regex, lines, digests) == set()


def test_table_against_files(lines, spark):
    assert V.corpus_difference(lines, lines).count() == 0
    files = lines.withColumn("text", F.when(F.col("line_number") == 2, "x").otherwise(F.col("text"))).where("line_number < 4")
    got = {(r.problem, r.line_number, r.n) for r in V.corpus_difference(lines, files).collect()}
    assert got == {("text", 2, 1), ("extra", 4, 1)}
    again = lines.unionByName(lines.where("line_number = 1"))
    assert {r.problem for r in V.corpus_difference(again, again).collect()} == {"numbering"}


def test_statements_are_guarded(spark, lines):
    lines.createOrReplaceTempView("elsewhere")
    refused = ["SELECT * FROM elsewhere", "SELECT * FROM parquet.`/tmp/x`", "SELECT * FROM lines l WHERE EXISTS (SELECT 1 FROM elsewhere)", "WITH lines2 AS (SELECT 1) SELECT * FROM elsewhere", "SELECT reflect('java.lang.Math', 'random')", "SELECT * FROM range(3)", "SELECT * FROM lines elsewhere, elsewhere", "SELECT a FROM (SELECT 1 AS a", "WITH elsewhere AS (SELECT 1) SELECT * FROM elsewhere"]
    for s in refused:
        with pytest.raises(ValueError):
            guard.read_only(spark, lines, s)
    allowed = "WITH a AS (SELECT * FROM -- the lines\n lines) SELECT max(line_number) AS n FROM a WHERE line_number IN (SELECT line_number FROM lines)"
    assert guard.read_only(spark, lines, allowed).first().n == 4
    with pytest.raises(ValueError):
        guard.collect_within(spark, spark.range(20), 60, 10)
    assert len(guard.collect_within(spark, spark.range(10), 60, 10)) == 10
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("lines_")]


def test_statement_shapes(spark, lines):
    specs = [(0, "linux", "scalar", "SELECT line_number FROM lines WHERE dataset = 'linux'", SHOWN), (1, "linux", "scalar", SCALAR, SHOWN + " AND false"), (2, "linux", "line_lookup", SHOWN + " AND false", None), (3, "linux", "count", "SELECT text FROM lines WHERE dataset = 'linux'", None), (4, "linux", "presence", SHOWN + " AND 1 = 0", None), (5, "linux", "line_lookup", SHOWN + " AND line_number > 2", None)]
    got = {r.slot: (r.answer, len(r.cited), r.cited[0].line_number) for r in T.answers(spark, lines, specs).collect()}
    assert got == {4: ("No (0 matching lines)", 1, 1), 5: (FOUR[2], 2, 3)}
    assert [T.slot_mode(s) for s in range(5)] == [("count", False), ("presence", True), ("line_lookup", False), ("scalar", True), ("count", False)]
    assert T.answers(spark, lines, []).count() == 0


def test_verification(spark, lines, records):
    tried = T.results(spark, lines, [(LIT, "SELECT count(*) FROM lines WHERE text LIKE '%failure%'"), (LK, "SELECT text FROM lines ORDER BY line_number"), (SQ, "SELECT * FROM elsewhere_else"), ("linux_v1_presence_invalid_user_0", "SELECT count(*) > 0 FROM lines WHERE text LIKE '%Invalid%'")])
    got = {r.id: (r.agrees, r.problem) for r in W.verification(records, tried).collect()}
    assert got[LIT] == (True, None) and got["linux_v1_presence_invalid_user_0"] == (True, None)
    assert got[LK] == (False, "another answer") and not got[SQ][0] and "not allowed" in got[SQ][1]
    assert W.verification(records, tried, 2).count() == 2
    assert {r.answer_type: (r.checked, r.agreed) for r in W.tally(W.verification(records, tried)).collect()}["count"] == (6, 1)


def test_medium_and_hard_records(spark, digests):
    texts = [f"node{'ABC'[i % 3]} step {i} on rack{'XY'[i % 2]}" + (" error" if i == 7 else "") for i in range(30)]
    lines = spark.createDataFrame([("linux", i + 1, t) for i, t in enumerate(texts)], "dataset string, line_number int, text string")
    asked = R.medium_evidence(lines, "step", digests, 3, 2, 2)
    drafts = asked.select("id", F.lit("OUTCOME: done\nentity: nodeA\nentity: nodeB").alias("extraction"), F.lit("It is done.").alias("answer"), tiers.no_model().alias("model"))
    got = {r.id: r for r in R.medium_records(asked, drafts).collect()}
    assert set(got) == {f"linux_v1_semantic_step_{k}" for k in range(3)}
    one = got["linux_v1_semantic_step_0"]
    assert [r.line_number for r in one.evidence.refs] == [1, 2, 3] and one.structured_summary.asDict() == {"event_type": "not stated", "entity": "nodeA", "observed_events": "not stated", "outcome": "done"}
    assert one.review_status == "in_review" and one.gold_provenance.model.name == "rule" and "first occurrence of 'step'" in one.question
    assert R.medium_evidence(lines, "absent", digests, 3).count() == 0 and R.medium_records(asked, drafts.limit(0)).count() == 0
    sides = R.comparative_sides(lines, "(?P<key>node[A-Z])", 5, 2)
    hard = R.hard_evidence(sides, "nodes", "Comparison", ["{key0} or {key1}?"], digests, 4)
    row = R.hard_records(hard, hard.select("id", F.lit("").alias("extraction"), F.lit("One. Two. Three. Four.").alias("answer"), tiers.no_model().alias("model"))).first()
    assert row.question == "nodeA or nodeB?" and [r.group_id for r in row.evidence.refs] == ["linux:hard:nodes:0:nodea"] * 4 + ["linux:hard:nodes:0:nodeb"] * 4
    assert hard.first().evidence_text.startswith("[Group: nodeA] 4 line(s):\nnodeA step 0 on rackX\n") and "\n\n[Group: nodeB] 4 line(s):\n" in hard.first().evidence_text
    linked = R.hard_evidence(R.correlation_sides(lines, "(?P<key>node[A-Z])", "(?P<key>rack[A-Z])", 5, 9), "links", "Correlation", ["{key0}, {key1}"], digests)
    assert sorted(r.question for r in linked.collect()) == ["nodeA, rackX", "nodeB, rackY"]
    assert {r.difficulty: r.n for r in R.tier_mix(R.medium_records(asked, drafts)).collect()} == {"easy": 0, "medium": 3, "hard": 0}


def test_all_tiers_split_without_leaks(spark):
    """Components of the generated records by a small union-find."""
    records = tiers._tiers(spark, DIR)
    refs = [(r.id, r.dataset, r.line_number, r.group_id) for r in R.flat_refs(records).collect()]
    label = {g: g for *_, g in refs}

    def root(g):
        while label[g] != g:
            g = label[g]
        return g

    for key in ((lambda r: r[0]), (lambda r: r[1:3])):
        first = {}
        for r in refs:
            a, b = root(first.setdefault(key(r), r[3])), root(r[3])
            label[max(a, b)] = min(a, b)
    want = {i: root(g) for i, *_, g in refs}
    got = {r.id: (r.component, r.split) for r in S.record_splits(R.flat_refs(records)).collect()}
    assert {i: c for i, (c, _) in got.items()} == want
    made = {r.id: r.split for r in tiers.generated_records(spark, DIR).collect()}
    assert made == {i: s for i, (_, s) in got.items()}


def test_named_groups(spark):
    for pattern, number in ((r"(a)(?P<key>b)", 2), (r"(?:a)(?P<key>b)", 1), (r"\((?P<x>a)[(](?P<key>b)", 2), (r"(?=a)(?<!c)(?P<key>b)", 1)):
        assert X.group_number(pattern) == number
    with pytest.raises(ValueError):
        X.group_number("(a)")
    df = spark.createDataFrame([("job 12 on n7",), ("job x",)], "text string")
    assert [r.k for r in df.select(X.group_key(F.col("text"), r"(job|task) (?P<key>[0-9]+)").alias("k")).collect()] == ["12", None]
    assert [r.text for r in C.regex_matches(df, "JOB [[:digit:]]+").collect()] == ["job 12 on n7"]
    assert df.select(X.statement_of(F.lit("Here:\n```sql\nSELECT 1;\n```")).alias("s")).first().s == "SELECT 1"


def test_matching_settles_long_chains(spark):
    """Falling ranks along a chain take a round for each second pair."""
    pairs = spark.createDataFrame([("d", f"a{i // 2 + i % 2}", f"b{i // 2}", 40 - i) for i in range(40)], "dataset string, a string, b string, rk int")
    rows, used, want = sorted(pairs.collect(), key=lambda r: r.rk), set(), []
    for r in rows:
        if r.a not in used and r.b not in used:
            used |= {r.a, r.b}
            want.append(r.rk)
    assert sorted(r.rk for r in G.greedy_matching(pairs).collect()) == want
    assert sorted(r.rk for r in G.greedy_matching(pairs, 3).collect()) == want[:3]


def test_sinks(spark, tmp_path, records, lines):
    corpus.write_records(records, str(tmp_path / "records.jsonl"))
    back = corpus.read_records(spark, str(tmp_path / "records.jsonl"))
    assert sorted(r.id for r in back.collect()) == sorted(r.id for r in records.collect()) and "source_file" in back.columns
    assert corpus.read_records(spark).count() == 0
    (tmp_path / "gaps.jsonl").write_text('{"id": "a"}\n\n{"id": "b"}\n')
    assert sorted(r.id for r in corpus.read_records(spark, str(tmp_path / "gaps.jsonl")).collect()) == ["a", "b"]
    (tmp_path / "bad.jsonl").write_text('{"id": "a"}\n{"id": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        corpus.read_records(spark, str(tmp_path / "bad.jsonl")).collect()
    verdicts = spark.createDataFrame([(LIT, "grounded", "no", None), (LIT, "complete", "yes", "fine")], "id string, dimension string, verdict string, detail string")
    checked = W.attach_checks(records, verdicts)
    assert {r.id for r in checked.where("review_status = 'in_review'").collect()} == {LIT}
    corpus.write_reports(checked, str(tmp_path / "reports"))
    assert [(r.question_id, len(r.checks)) for r in spark.read.json(str(tmp_path / "reports")).collect()] == [(LIT, 2)]
    files = spark.createDataFrame([("linux", "sha256:f")], "dataset string, sha256 string")
    corpus.write_lock(files, "abc", str(tmp_path / "lock"))
    (tmp_path / "manifest.json").write_text('{"source": {"owner": "o", "repo": "r", "pinned_commit": "abd", "raw_base_url": "u"}, "datasets": [{"name": "linux", "local_filename": "l.log", "raw_path": "p"}]}')
    manifest = corpus.read_manifest(spark, str(tmp_path / "manifest.json"))
    assert corpus.locked_to(corpus.read_lock(spark, str(tmp_path / "lock")), manifest).first().status == "moved"
    layout = W.dataset_layout(manifest)
    assert layout.first().asDict() == {"dataset": "linux", "path": "l.log", "version": "abd"}
    made = W.payload(records, "records@")
    corpus.write_payload(made, W.payload_problems(records, layout), str(tmp_path / "payload"))
    assert len(spark.read.json(str(tmp_path / "payload")).first().questions) == records.count()
    for problem, rows, where in (("unpinned", records, layout.limit(0)), ("no_evidence", changed(records, LIT, "evidence", F.lit(None)), layout), ("several_corpora", changed(records, LIT, "gold_provenance", F.col("gold_provenance").withField("corpus_sha256", F.lit("sha256:0"))), layout)):
        assert problem in {r.problem for r in W.payload_problems(rows, where).collect()}
        with pytest.raises(ValueError):
            corpus.write_payload(made, W.payload_problems(rows, where), str(tmp_path / "no"))
    with pytest.raises(ValueError):
        corpus.write_payload(made.limit(0), W.payload_problems(records, layout), str(tmp_path / "no"))
    sheet = W.worksheet(checked)
    corpus.write_worksheet(sheet, str(tmp_path / "sheet"))
    assert [r.id for r in corpus.read_worksheet(spark, str(tmp_path / "sheet")).collect()] == [LIT]
    corpus.write_text(lines, str(tmp_path / "text"))
    assert spark.read.text(str(tmp_path / "text")).count() == 4
    order = records.withColumn("ordinal", -F.monotonically_increasing_id())
    ids = [q.id for q in W.payload(order, "records@", "ordinal").first().questions]
    assert ids == [r.id for r in order.orderBy("ordinal").collect()]
