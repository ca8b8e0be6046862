"""Read-only statements over one set of lines.

Spark's own parser reads the statement. It runs only if every node of its plan,
subqueries included, is one that queries are made of, and if it reads no relation but
``lines`` and its own common table expressions.
"""

from __future__ import annotations

import re
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

WRITES = ("insert", "update", "delete", "drop", "alter", "create", "truncate", "grant", "revoke", "copy", "merge", "call", "set", "vacuum", "lock", "execute", "refresh", "load", "cache")
#: What the parser makes of queries.
NODES = set("Project Filter Aggregate Sort GlobalLimit LocalLimit Offset Distinct Deduplicate Union Except Intersect Join SubqueryAlias UnresolvedSubqueryColumnAliases UnresolvedWith UnresolvedHaving UnresolvedRelation UnresolvedInlineTable UnresolvedTableOrView LocalRelation OneRowRelation Generate Window WithWindowDefinition UnresolvedHint CTE Pivot Unpivot Expand Sample LateralJoin".split())
#: Functions that leave the query.
CALLS = ("reflect", "java_method", "try_reflect", "input_file_name")


def check(statement: str) -> str:
    """The statement without its closing semicolon; raises ValueError if its text is not one read."""
    s = statement.strip()
    s = s[:-1].rstrip() if s.endswith(";") else s
    bare = re.sub(r"'(?:[^']|'')*'", "''", s)
    if not re.match(r"(?is)(select|with)\b", bare) or ";" in bare:
        raise ValueError("one SELECT or WITH statement is expected")
    if found := re.search(r"(?i)\b(" + "|".join(WRITES) + r")\b", bare):
        raise ValueError(f"{found[1]} is not allowed")
    return s


def parsed(spark: SparkSession, statement: str) -> str:
    """The statement, if :func:`check` and its parsed plan allow it."""
    s = check(statement)
    try:
        tree = spark._jsparkSession.sessionState().sqlParser().parsePlan(s).treeString()
    except Exception as error:
        raise ValueError("the statement can't be parsed") from error
    own = set()
    for row in tree.splitlines():
        node = re.match(r"[\s:+|-]*'?(\w+)", row)
        if node is None:
            continue
        if node[1] not in NODES:
            raise ValueError(f"{node[1]} is not allowed")
        if node[1] == "CTE" and "[" in row:
            own |= {n.strip().lower() for n in re.search(r"\[(.*)\]", row)[1].split(",")}
    for name in re.findall(r"UnresolvedRelation \[([^\]]*)\]", tree):
        if name.lower() != "lines" and (name.lower() not in own or spark.catalog.tableExists(name)):
            raise ValueError(f"{name} is not allowed")
    if found := re.search(r"(?i)\b(" + "|".join(CALLS) + r")\b", s):
        raise ValueError(f"{found[1]} is not allowed")
    return s


def read_only(spark: SparkSession, lines: DataFrame, statement: str) -> DataFrame:
    """The result of a statement that sees ``lines`` and nothing else."""
    s = parsed(spark, statement)
    view = f"lines_{uuid.uuid4().hex}"
    lines.createOrReplaceTempView(view)
    try:
        given = f"lines AS (SELECT * FROM {view})"
        start = re.match(r"(?is)with\s+(recursive\s+)?", s)
        return spark.sql(f"{start[0]}{given}, {s[start.end():]}" if start else f"WITH {given} {s}")
    finally:
        spark.catalog.dropTempView(view)


def collect_within(spark: SparkSession, df: DataFrame, seconds: float, most: int = 1000) -> list:
    """The rows of a result; the job is cancelled after ``seconds``, and over ``most`` rows are refused."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "read-only statement", True)
    timer = threading.Timer(seconds, spark.sparkContext.cancelJobGroup, [group])
    timer.start()
    try:
        rows = df.limit(most + 1).collect()
    finally:
        timer.cancel()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    if len(rows) > most:
        raise ValueError(f"the result has over {most} rows")
    return rows
