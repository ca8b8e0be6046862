"""Manifests, digests and records: JSON and CSV sources and sinks."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "source struct<owner:string,repo:string,pinned_commit:string,raw_base_url:string>, datasets array<struct<name:string,local_filename:string,raw_path:string>>"
MODEL = "struct<name:string,family:string,digest:string,prompt_sha256:string>"
RECORD = (
    "id string, question string, routing_path string, answer_type string, task string, difficulty string, phrasing_family string, split string, "
    "review_status string, reviewers array<string>, expected_answer string, "
    f"gold_provenance struct<method:string,created_by:string,created_at:string,corpus_sha256:string,model:{MODEL}>, "
    "numeric_claims array<struct<value:double,query:struct<operator:string,literal:string,pattern:string,case_sensitive:boolean,sql:string,evidence_sql:string>>>, "
    "structured_summary struct<event_type:string,entity:string,observed_events:string,outcome:string>, "
    "evidence struct<refs:array<struct<id:string,line_number:int,line_hash:string,group_id:string>>,query_sql:string>, "
    f"validation struct<checks:array<struct<dimension:string,verdict:string,detail:string>>,model:{MODEL}>"
)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(name, local_filename, raw_path, pinned_commit)`` of each dataset."""
    m = spark.read.schema(MANIFEST).json(path, multiLine=True, mode="FAILFAST")
    return m.select("source.pinned_commit", F.inline("datasets")).select("name", "local_filename", "raw_path", "pinned_commit")


def verify_digests(files: DataFrame, lock: DataFrame, lines: DataFrame, least: int = 3) -> DataFrame:
    """``(dataset, status)``: ok, changed, missing, unlocked or quota_unmet."""
    counts = lines.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))
    both = files.select("dataset", F.col("sha256").alias("found")).join(lock.select("dataset", F.col("sha256").alias("locked")), "dataset", "full_outer").join(counts, "dataset", "left")
    status = F.when(F.col("found").isNull(), "missing").when(F.col("locked").isNull(), "unlocked").when(F.col("found") != F.col("locked"), "changed").when(F.coalesce("n", F.lit(0)) < least, "quota_unmet").otherwise("ok")
    return both.select("dataset", status.alias("status"))


def contained_path(root: str, name: str) -> Path:
    """The path of ``name`` below ``root``; refuses one that leads out of it."""
    home = Path(root).resolve()
    at = (home / name).resolve()
    if home != at and home not in at.parents:
        raise ValueError(f"{name} leads out of {root}")
    return at


def read_records(spark: SparkSession, *paths: str) -> DataFrame:
    """Question records from JSON arrays, single objects or ``.jsonl`` files, with their file; a bad record stops the read."""
    if not paths:
        return spark.createDataFrame([], RECORD).withColumn("source_file", F.lit(None).cast("string"))
    whole = [p for p in paths if not p.endswith(".jsonl")]
    by_line = [p for p in paths if p.endswith(".jsonl")]
    reader = spark.read.schema(RECORD)
    found = [reader.json(part, multiLine=multi, mode="FAILFAST") for part, multi in ((whole, True), (by_line, False)) if part]
    rows = [df.select("*", F.col("_metadata.file_path").alias("source_file")) for df in found]
    return rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])


def write_worksheet(worksheet: DataFrame, path: str) -> None:
    worksheet.write.mode("overwrite").csv(path, header=True, escape='"', quote='"', emptyValue="")


def read_worksheet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, multiLine=True, escape='"', quote='"')


def append_events(events: DataFrame, path: str) -> None:
    events.write.mode("append").json(path)


LOCK = "dataset string, sha256 string, pinned_commit string"


def read_lock(spark: SparkSession, path: str) -> DataFrame:
    """``(dataset, sha256, pinned_commit)`` of a lock."""
    return spark.read.schema(LOCK).json(path)


def write_lock(files: DataFrame, commit: str, path: str) -> None:
    """Locks the digests of ``files`` (dataset, sha256) to a commit; the folder is replaced as a whole."""
    files.select("dataset", "sha256", F.lit(commit).alias("pinned_commit")).orderBy("dataset").write.mode("overwrite").json(path)


def locked_to(lock: DataFrame, manifest: DataFrame) -> DataFrame:
    """``(dataset, status)``: ``ok`` where lock and manifest name the same commit, else ``moved``, ``unlocked`` or ``unlisted``."""
    both = lock.select("dataset", F.col("pinned_commit").alias("locked")).join(manifest.select(F.col("name").alias("dataset"), "pinned_commit"), "dataset", "full_outer")
    status = F.when(F.col("locked").isNull(), "unlocked").when(F.col("pinned_commit").isNull(), "unlisted").when(F.col("locked") != F.col("pinned_commit"), "moved").otherwise("ok")
    return both.select("dataset", status.alias("status"))


def write_records(records: DataFrame, path: str) -> None:
    """Records as JSON lines; the folder is replaced as a whole."""
    records.write.mode("overwrite").json(path)


def write_reports(records: DataFrame, path: str) -> None:
    """A report for each record with checks: its groups, its verdicts and the models; a row each in one table."""
    groups = F.array_sort(F.array_distinct(F.transform("evidence.refs", lambda r: r.group_id)))
    reports = records.where("validation.checks is not null").select(F.col("id").alias("question_id"), groups.alias("group_ids"), F.col("validation.model").alias("reviewer_model"), F.col("gold_provenance.model").alias("subject_model"), "validation.checks")
    reports.write.mode("overwrite").json(path)


def write_text(lines: DataFrame, path: str) -> None:
    """The ``text`` of rows as lines of text files; the folder is replaced as a whole."""
    lines.select("text").write.mode("overwrite").text(path)


def write_payload(payload: DataFrame, problems: DataFrame, path: str) -> None:
    """A payload as JSON, one row for each dataset; refused if it is empty or has problems."""
    if found := problems.limit(5).collect():
        raise ValueError(f"the payload has problems: {[tuple(r) for r in found]}")
    if not payload.head(1):
        raise ValueError("the payload is empty")
    payload.write.mode("overwrite").json(path)
