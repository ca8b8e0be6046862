"""A trigram index over numbered lines: literals and regexes read only the blocks that can match.

``BLOCK`` lines are a block, 64 blocks a word. A posting says in which blocks of a word
a trigram occurs, as the bits of one long, so building is one aggregate by ``bit_or``
and searching one by ``bit_and``, both combined before they move. Postings lie sorted
by trigram, so a search reads the row groups of its own trigrams.

A spec is turned into what its matches must hold: alternatives, each a set of trigrams.
Where nothing can be said (short literals, ``.*``) the empty trigram stands, which is in
every block. Blocks that pass are read and verified, so results equal a full scan's.

Trigrams are taken from folded text. Folding works character by character, and what
Spark's lower case or Java's regexes without case hold equal folds equally.
"""

from __future__ import annotations

from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from lineloom.functions import text as X
from lineloom.operators.counting import java_regex
from lineloom.sources.store import coarse_ranges
from lineloom.storage import Cut

#: Lines of a block, blocks of a word, alternatives kept of a regex, trigrams sought by a pushed-down list, ranges of lines read.
BLOCK, WORD, ALTERNATIVES, LISTED, RANGES = 64, 64, 16, 1024, 512
SPECS = "dataset string, spec_id string, literal string, pattern boolean, case_sensitive boolean"


def fold(text: Column) -> Column:
    """Lower case without what depends on neighbours (the last sigma) and with the four characters that Java holds equal to i, k and s."""
    return F.translate(F.lower(text), "ſıς̇", "siσ")


def grams(folded: Column) -> Column:
    """The distinct trigrams of a text, in one pass over it."""
    return F.array_distinct(F.regexp_extract_all(folded, F.lit("(?s)(?=(.{3}))"), F.lit(1)))


def _runs(pattern: str) -> list[frozenset] | None:
    """Alternatives of what a match must hold: sets of runs of ASCII characters. None if the pattern has parts that aren't known here."""
    at = 0

    def both(a: list[frozenset], b: list[frozenset]) -> list[frozenset]:
        return [x | y for x, y in product(a, b)] if len(a) * len(b) <= ALTERNATIVES else min(a, b, key=len)

    def group() -> list[frozenset]:
        nonlocal at
        found, whole, run = [], [frozenset()], ""
        while at < len(pattern) and pattern[at] != ")":
            c, part, one = pattern[at], [frozenset()], ""
            at += 1
            if c == "|":
                found += both(whole, [frozenset([run])])
                whole, run = [frozenset()], ""
                continue
            if c == "\\":
                one = pattern[at : at + 1]
                if one in "QE0cxuNpPk" or not one:
                    if one not in ("p", "P") or pattern[at + 1 : at + 2] != "{":
                        raise ValueError(pattern)
                    at = pattern.index("}", at)
                at += 1
                one = "" if one.isalnum() else one
            elif c == "[":
                at += pattern[at : at + 1] == "^"
                at += pattern[at : at + 1] == "]"
                while pattern[at] != "]":
                    if pattern[at] == "[" or pattern[at : at + 2] in (r"\Q", "&&"):
                        raise ValueError(pattern)
                    at += 1 + (pattern[at] == "\\")
                at += 1
            elif c == "(":
                holds = True
                if pattern[at : at + 1] == "?":
                    named = pattern[at + 1 : at + 2] == "<" and pattern[at + 2 : at + 3].isalpha()
                    holds = named or pattern[at + 1 : at + 2] in (":", ">")
                    if not holds and pattern[at + 1 : at + 2] not in ("=", "!", "<"):
                        raise ValueError(pattern)  # flags
                    at = pattern.index(">", at) + 1 if named else at + 2 + (pattern[at + 1 : at + 2] == "<")
                inner = group()
                if pattern[at : at + 1] != ")":
                    raise ValueError(pattern)
                at += 1
                part = inner if holds else part
            elif c not in ".^$":
                one = c
            one = one if one.isascii() else ""
            times = pattern[at : at + 1]
            if times in ("?", "*", "+", "{"):
                at = pattern.index("}", at) + 1 if times == "{" else at + 1
                at += pattern[at : at + 1] in ("?", "+")
                if times != "+":
                    part, one = [frozenset()], ""
                whole, run = both(both(whole, [frozenset([run + one])]), part), ""
            elif one:
                run += one
            else:
                whole, run = both(both(whole, [frozenset([run])]), part), ""
        return found + both(whole, [frozenset([run])])

    try:
        result = group()
    except (ValueError, IndexError):
        return None
    return result if at == len(pattern) else None


def needed(pattern: str | None) -> list[list[str]]:
    """Alternatives, each a list of trigrams, of which a line that the Java regex finds holds all of at least one."""
    sets = [{r[i : i + 3].lower() for r in runs for i in range(len(r) - 2)} for runs in (_runs(pattern) if pattern is not None else None) or [frozenset()]]
    return [sorted(s) for s in sets] if all(sets) and len(sets) <= ALTERNATIVES else [[""]]


@F.pandas_udf(ArrayType(ArrayType(StringType())))
def _needed(patterns: pd.Series) -> pd.Series:
    return patterns.map(needed)


def _word() -> tuple[Column, Column]:
    block = F.floor((F.col("line_number").cast("long") - 1) / BLOCK)
    return F.floor(block / WORD).alias("word"), F.pmod(block, F.lit(WORD)).cast("int")


def build(lines: DataFrame, path: str) -> TrigramIndex:
    """Writes the postings of ``lines`` (dataset, line_number, text); null texts have none but the empty trigram."""
    word, bit = _word()
    own = F.concat(F.array(F.lit("")), F.coalesce(grams(fold(F.col("text"))), F.array().cast("array<string>")))
    rows = lines.select("dataset", word, bit.alias("bit"), F.explode(own).alias("gram")).withColumn("mask", F.expr("shiftleft(1L, bit)"))
    postings = rows.groupBy("gram", "dataset", "word").agg(F.bit_or("mask").alias("mask"))
    postings.repartitionByRange("gram", "dataset", "word").sortWithinPartitions("gram", "dataset", "word").write.mode("overwrite").parquet(path)
    return TrigramIndex(lines.sparkSession, path)


class TrigramIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def postings(self) -> DataFrame:
        return self.spark.read.schema("gram string, dataset string, word long, mask long").parquet(self.path)

    def candidates(self, specs: DataFrame) -> DataFrame:
        """``(dataset, spec_id, word, mask)``: the blocks in which a spec may have matches.

        ``specs`` (dataset, spec_id, literal, pattern, case_sensitive); a null dataset
        stands for all, a null literal matches nothing, an empty one everything.
        ``spec_id`` tells the specs of a dataset apart.
        """
        given = specs.where("literal is not null")
        literals = given.where("not coalesce(pattern, false)").select(F.col("dataset").alias("own"), "spec_id", F.array(grams(fold(F.col("literal")))).alias("sets"))
        literals = literals.withColumn("sets", F.when(F.size(F.get("sets", F.lit(0))) == 0, F.array(F.array(F.lit("")))).otherwise(F.col("sets")))
        regexes = given.where("pattern").select(F.col("dataset").alias("own"), "spec_id", _needed(java_regex(F.col("literal"))).alias("sets"))
        sets = literals.unionByName(regexes).select("own", "spec_id", F.posexplode("sets").alias("alternative", "set"))
        wants = sets.select("own", "spec_id", "alternative", F.size("set").alias("need"), F.explode("set").alias("gram"))
        sought = [r.gram for r in wants.select("gram").distinct().limit(LISTED + 1).collect()]
        postings = self.postings()
        if len(sought) <= LISTED:  # row groups of other trigrams aren't read; longer lists are left to the join
            postings = postings.where(F.col("gram").isin(sought))
        hits = wants.join(postings, "gram").where("own is null or own <=> dataset")
        held = hits.groupBy("own", "spec_id", "alternative", "need", "dataset", "word").agg(F.bit_and("mask").alias("mask"), F.count(F.lit(1)).alias("n")).where("n = need and mask <> 0")
        return held.groupBy("own", "dataset", "spec_id", "word").agg(F.bit_or("mask").alias("mask"))

    def search(self, specs: DataFrame, read) -> DataFrame:
        """``(dataset, spec_id, line_number, text)``: a row for each spec and line that it matches.

        ``read`` gives the lines of ranges (dataset, lo, hi), at most about ``RANGES`` of them.
        """
        kept = Cut(self.candidates(specs), "candidates").df
        lines = read(coarse_ranges(kept, "word", BLOCK * WORD, RANGES))
        word, bit = _word()
        lines = lines.select(F.col("dataset").alias("of"), "line_number", "text", word.alias("at"), bit.alias("bit"))
        met = kept.join(lines, F.col("dataset").eqNullSafe(F.col("of")) & (F.col("word") == F.col("at"))).where("(shiftright(mask, bit) & 1) = 1")
        what = specs.select(F.col("dataset").alias("own_"), F.col("spec_id").alias("id_"), "literal", F.coalesce("pattern", F.lit(False)).alias("regex"), F.coalesce("case_sensitive", F.lit(False)).alias("exact"))
        met = met.join(what, F.col("own").eqNullSafe(F.col("own_")) & F.col("spec_id").eqNullSafe(F.col("id_")))
        found = F.when(F.col("regex"), F.rlike("text", java_regex(F.concat(F.when(F.col("exact"), "").otherwise("(?iu)"), "literal")))).otherwise(X.contains(F.col("text"), F.col("literal"), F.col("exact")))
        return met.where(found).select("dataset", "spec_id", "line_number", "text")

    def blocks(self, specs: DataFrame) -> DataFrame:
        """``(dataset, spec_id, blocks, read)``: how many blocks a spec's datasets have, and how many a search reads."""
        every = self.postings().where("gram = ''").groupBy(F.col("dataset").alias("of")).agg(F.sum(F.bit_count("mask")).alias("blocks"))
        read = self.candidates(specs).groupBy("own", "dataset", "spec_id").agg(F.sum(F.bit_count("mask")).alias("read"))
        all_of = specs.select(F.col("dataset").alias("own_"), F.col("spec_id").alias("id_")).join(every, F.col("own_").isNull() | F.col("own_").eqNullSafe(F.col("of")))
        both = all_of.join(read, F.col("own").eqNullSafe(F.col("own_")) & F.col("spec_id").eqNullSafe(F.col("id_")) & F.col("dataset").eqNullSafe(F.col("of")), "left")
        return both.select(F.col("of").alias("dataset"), F.col("id_").alias("spec_id"), "blocks", F.coalesce("read", F.lit(0)).alias("read"))
