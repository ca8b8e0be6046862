"""Literal and regex counts, presence and first or last lines, for many specs in one scan.

Specs are a short table ``(dataset, spec_id, literal, case_sensitive)``; Spark sends it
to the lines if it is small. Thousands of literals are the automaton's. Lines meet the specs of their own
dataset only, and counts are aggregated before they move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineloom.functions import text as X


def literal_specs(spark, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "dataset string, spec_id string, literal string, case_sensitive boolean")


def literal_matches(lines: DataFrame, specs: DataFrame) -> DataFrame:
    """Lines with each spec of their dataset that they contain."""
    hit = X.contains(F.col("text"), F.col("literal"), F.col("case_sensitive"))
    return lines.join(specs, "dataset").where(hit)


def summarise(matches: DataFrame, *keys: str) -> DataFrame:
    """Count, first and last line and the first five numbers of each key."""
    row = F.struct("line_number", "text")
    return matches.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("first"), F.max(row).alias("last"))


def spec_counts(lines: DataFrame, specs: DataFrame) -> DataFrame:
    """A row per spec, those without a match included: n, presence answer, first and last line."""
    found = summarise(literal_matches(lines, specs), "dataset", "spec_id")
    n = F.coalesce("n", F.lit(0))
    return specs.join(found, ["dataset", "spec_id"], "left").select("dataset", "spec_id", "literal", n.alias("n"), X.presence_answer(n).alias("answer"), "first", "last")


def cited_lines(matches: DataFrame, keys: list[str], most: int = 5) -> DataFrame:
    """The first lines of each key, at most ``most``; rank-limited before the shuffle."""
    from pyspark.sql.window import Window

    order = Window.partitionBy(*keys).orderBy("line_number")
    return matches.withColumn("at", F.row_number().over(order)).where(F.col("at") <= most)


#: The names of character classes in brackets, and theirs in Java.
CLASSES = {"alpha": "Alpha", "digit": "Digit", "alnum": "Alnum", "upper": "Upper", "lower": "Lower", "space": "Space", "punct": "Punct", "xdigit": "XDigit", "blank": "Blank", "cntrl": "Cntrl", "graph": "Graph", "print": "Print"}


#: Word starts, word ends and either in the one spelling, and in Java's.
EDGES = {r"\m": r"\b(?=\w)", r"\M": r"\b(?<=\w)", r"\y": r"\b"}


def java_regex(pattern: Column) -> Column:
    """``[[:digit:]]`` and its like, word edges and named groups, in the spelling that Spark's regexes know."""
    for name, java in CLASSES.items():
        pattern = F.replace(pattern, F.lit(f"[:{name}:]"), F.lit(rf"\p{{{java}}}"))
    for one, other in [*EDGES.items(), ("(?P<", "(?<")]:
        pattern = F.replace(pattern, F.lit(one), F.lit(other))
    return pattern


def regex_matches(lines: DataFrame, pattern: str, case_sensitive: bool = False) -> DataFrame:
    """Lines that the pattern finds anywhere."""
    return lines.where(F.rlike("text", java_regex(F.lit(pattern if case_sensitive else f"(?iu){pattern}"))))


def display_sql(dataset: Column, literal: Column, case_sensitive: Column, pattern: Column | None = None) -> Column:
    """The statement shown for a count of a literal, or of a regex where ``pattern`` holds. It is for reading only: matching uses plain substrings."""
    quoted = F.replace(literal, F.lit("'"), F.lit("''"))
    like = F.concat(F.when(case_sensitive, "LIKE").otherwise("ILIKE"), F.lit(" '%"), quoted, F.lit("%'"))
    if pattern is not None:
        like = F.when(pattern, F.concat(F.when(case_sensitive, "~").otherwise("~*"), F.lit(" '"), quoted, F.lit("'"))).otherwise(like)
    return F.concat(F.lit("SELECT line_number, text FROM lines WHERE dataset = '"), dataset, F.lit("' AND text "), like, F.lit(" ORDER BY line_number"))
