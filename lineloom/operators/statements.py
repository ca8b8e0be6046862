"""Answers that statements over the lines give: counts, presence, lookups and scalars.

Each statement is one guarded Spark query; its result is cut to what an answer needs by
an aggregation, so no result comes to the driver. The statements themselves are a short
list of the caller's.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineloom.functions import text as X
from lineloom.plans import guard

MODES = ("count", "presence", "line_lookup", "scalar")
ANSWER = "slot int, dataset string, mode string, sql string, evidence_sql string, rows long, answer string, cited array<struct<line_number:int,text:string>>"


def slot_mode(slot: int) -> tuple[str, bool]:
    """What a slot asks for, and whether it asks for something absent: modes in turn, every second slot the absent case."""
    return MODES[slot % len(MODES)], slot % 2 == 1


def refusal(spark: SparkSession, lines: DataFrame, dataset: str, mode: str, sql: str, evidence_sql: str | None) -> str | None:
    """Why a statement gives no answer, if it doesn't: its text, its scope or the form of its result."""
    try:
        if mode not in MODES:
            raise ValueError(f"{mode} is no mode")
        for s in [sql] + ([evidence_sql or ""] if mode == "scalar" else []):
            if f"'{dataset}'" not in s:
                raise ValueError(f"the statement is not about {dataset}")
        types = [t for _, t in guard.read_only(spark, lines, sql).dtypes]
        if mode == "scalar" and (len(types) != 1 or not types[0].startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal"))):
            raise ValueError("one number is expected")
        if mode != "scalar" and types != ["int", "string"]:
            raise ValueError("line numbers and texts are expected")
        if mode == "scalar":
            guard.read_only(spark, lines, evidence_sql)
    except Exception as error:  # any fault of the statement, Spark's analysis included, is its refusal
        return str(error).splitlines()[0]
    return None


def answers(spark: SparkSession, lines: DataFrame, specs: list[tuple], cited: int = 5) -> DataFrame:
    """The answer of each allowed statement ``(slot, dataset, mode, sql, evidence_sql)``.

    ``rows`` is how many rows the statement returned and ``cited`` the first lines it or,
    for a scalar, its evidence names; the first line of the dataset if it names none.
    Scalars of other than one row or without evidence, empty lookups and refused
    statements give no row, and of statements that read alike the first one counts.
    """
    found, seen = [], set()
    for slot, dataset, mode, sql, evidence_sql in specs:
        alike = " ".join(sql.lower().split())
        if alike in seen or refusal(spark, lines, dataset, mode, sql, evidence_sql):
            continue
        seen.add(alike)
        result = guard.read_only(spark, lines, sql)
        named = guard.read_only(spark, lines, evidence_sql) if mode == "scalar" else result
        named = named.toDF("line_number", "text").select(F.col("line_number").cast("int").alias("line_number"), "text")
        first = named.orderBy("line_number").limit(cited).agg(F.array_sort(F.collect_list(F.struct("line_number", "text"))).alias("cited"))
        own = result.toDF("value").agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("value").cast("string")).alias("value")) if mode == "scalar" else result.agg(F.count(F.lit(1)).alias("rows"), F.lit(None).cast("string").alias("value"))
        one = own.crossJoin(first)  # one row each
        answer = {"count": F.col("rows").cast("string"), "presence": X.presence_answer(F.col("rows")), "line_lookup": F.get("cited", F.lit(0)).text, "scalar": F.col("value")}[mode]
        fits = {"scalar": (F.col("rows") == 1) & (F.size("cited") > 0), "line_lookup": F.coalesce(answer, F.lit("")) != ""}.get(mode, F.lit(True))
        fallback = lines.where((F.col("dataset") == dataset) & (F.col("line_number") == 1)).select(F.struct(F.col("line_number").cast("int").alias("line_number"), "text").alias("line")).agg(F.array_agg("line").alias("start"))
        row = one.where(fits).crossJoin(fallback)
        found.append(row.select(F.lit(slot).alias("slot"), F.lit(dataset).alias("dataset"), F.lit(mode).alias("mode"), F.lit(sql).alias("sql"), F.lit(evidence_sql).cast("string").alias("evidence_sql"), "rows", answer.alias("answer"), F.when(F.size("cited") > 0, F.col("cited")).otherwise(F.col("start")).alias("cited")))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], ANSWER)


def first_cell(df: DataFrame) -> DataFrame:
    """``(value)``: the first column of the first row as text, null without rows."""
    return df.limit(1).select(F.col(f"`{df.columns[0]}`").cast("string").alias("value")).agg(F.first("value").alias("value"))


def results(spark: SparkSession, lines: DataFrame, statements: list[tuple[str, str]]) -> DataFrame:
    """``(id, value, problem)`` for each ``(id, statement)`` of a short list: the statement's first cell, or why it has none."""
    found = []
    for name, sql in statements:
        try:
            value, problem = first_cell(guard.read_only(spark, lines, sql)), None
        except Exception as error:  # recorded, so that one unusable statement doesn't end the pass
            value, problem = spark.range(1).select(F.lit(None).cast("string").alias("value")), str(error).splitlines()[0]
        found.append(value.select(F.lit(name).alias("id"), "value", F.lit(problem).cast("string").alias("problem")))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "id string, value string, problem string")
