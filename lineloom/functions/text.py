"""Column expressions over log lines: hashing, matching, naming, rendering.

All of them are built-in expressions and stay inside generated code.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The line terminators of the line contract.
ENDS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
#: One of them, or both characters of ``\\r\\n``. It begins with a single class, so other characters are passed over in one step.
TERMINATORS = "[\\n\\r\\x0B\\x0C\\x1C\\x1D\\x1E\\x85\\u2028\\u2029](?:(?<=\\r)\\n)?"
#: Keywords that make a line salient, in order of preference.
SALIENT = ("error", "fatal", "warn", "fail", "exception", "timeout", "retry", "reconnect", "recover", "corrected", "terminat", "clos", "expir", "disconnect", "denied", "invalid", "looking", "following", "leading")
#: First characters that a spreadsheet would read as a formula.
FORMULA_STARTS = ("=", "+", "-", "@", "\t", "\r")


def split_lines(text: Column) -> Column:
    """Lines of a text: interior blank lines stay, no empty last line, none for an empty or null text."""
    ended = reduce(or_, [F.endswith(text, F.lit(end)) for end in ENDS])
    body = F.when(F.endswith(text, F.lit("\r\n")), F.left(text, F.length(text) - 2)).when(ended, F.left(text, F.length(text) - 1)).otherwise(text)  # so the text is split once
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(body, TERMINATORS, -1))


def decode(content: Column) -> Column:
    """Bytes as text; each malformed sequence becomes U+FFFD."""
    return F.make_valid_utf8(content.cast("string"))


def digest(value: Column) -> Column:
    """``sha256:`` and the hex digest of a text's UTF-8 bytes, or of bytes."""
    return F.concat(F.lit("sha256:"), F.sha2(value, 256))


def contains(text: Column, literal: Column, case_sensitive: Column) -> Column:
    """Plain substring, no wildcards."""
    return F.when(case_sensitive, text.contains(literal)).otherwise(F.lower(text).contains(F.lower(literal)))


def java_pattern(pattern: str) -> str:
    """A named group in the other common spelling."""
    return pattern.replace("(?P<", "(?<")


def group_number(pattern: str, name: str = "key") -> int:
    """The number of a named group: how many groups open up to it."""
    number, at, inside = 0, 0, False
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            at += 1
        elif inside:
            inside = c != "]"
        elif c == "[":
            inside = True
            at += pattern[at + 1 : at + 2] in ("]", "^") or 0
        elif c == "(":
            named = re.match(r"\(\?P?<(\w+)>", pattern[at:])
            number += bool(named) or pattern[at + 1 : at + 2] != "?"
            if named and named[1] == name:
                return number
        at += 1
    raise ValueError(f"{pattern} has no group named {name}")


def group_key(text: Column, pattern: str) -> Column:
    """The first match's group named ``key``, null without a match."""
    return F.nullif(F.regexp_extract(text, java_pattern(pattern), group_number(pattern)), F.lit(""))


def statement_of(reply: Column) -> Column:
    """The statement in a reply: what a fence holds if there is one, without its semicolon."""
    fenced = F.regexp_extract(reply, r"(?s)```(?:sql|SQL)?\s*(.*?)```", 1)
    return F.trim(F.regexp_replace(F.trim(F.when(fenced != "", fenced).otherwise(reply)), r";\s*$", ""))


def slug(text: Column) -> Column:
    """Lower case, runs of other characters than a-z and 0-9 as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def evidence_id(dataset: Column, line_number: Column, line_hash: Column) -> Column:
    """``dataset:line:`` with the number in eight digits at least and 16 hex digits of the hash."""
    return F.concat_ws(":", dataset, F.lit("line"), F.format_string("%08d", line_number), F.substring(line_hash, 8, 16))


def evidence_ref(dataset: Column, line_number: Column, line_hash: Column, group_id: Column) -> Column:
    return F.struct(evidence_id(dataset, line_number, line_hash).alias("id"), line_number.alias("line_number"), line_hash.alias("line_hash"), group_id.alias("group_id"))


def sentences(text: Column) -> Column:
    """Parts after a full stop, question or exclamation mark and white space."""
    return F.filter(F.split(F.trim(text), r"(?<=[.!?])\s+"), lambda s: s != "")


def sentence_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[.!?](\s|$)"))


def presence_answer(n: Column) -> Column:
    """Yes or no, with the number of matching lines."""
    lines = F.when(n == 1, " matching line)").otherwise(" matching lines)")
    return F.concat(F.when(n > 0, "Yes (").otherwise("No ("), n.cast("string"), lines)


def ordinal(n: Column) -> Column:
    """first to tenth in words, then 11th, 21st, 22nd, 23rd, 24th."""
    words = F.array(*[F.lit(w) for w in ("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth")])
    teen, last = (n % 100).between(11, 13), n % 10
    end = F.when(teen, "th").when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th")
    return F.when(n.between(1, 10), F.get(words, (n - 1).cast("int"))).otherwise(F.concat(n.cast("string"), end))


def template(text: Column) -> Column:
    """Digit runs as ``#``."""
    return F.regexp_replace(text, r"\p{Nd}+", "#")


def salience(text: Column) -> Column:
    """The first salient keyword that the lower-cased line contains, else null."""
    low = F.lower(text)
    return F.coalesce(*[F.when(low.contains(k), F.lit(k)) for k in SALIENT])


def csv_safe(text: Column) -> Column:
    """A leading quote keeps spreadsheets from reading a formula."""
    return F.when(F.substring(text, 1, 1).isin(*FORMULA_STARTS), F.concat(F.lit("'"), text)).otherwise(text)


def csv_unsafe(text: Column) -> Column:
    return F.when((F.substring(text, 1, 1) == "'") & F.substring(text, 2, 1).isin(*FORMULA_STARTS), F.substring(text, 2, (1 << 31) - 1)).otherwise(text)


def test_split(component: Column, fraction: float = 0.2) -> Column:
    """``test`` if the first 32 bits of the SHA-256, as a share of the largest value, are below the fraction."""
    share = F.conv(F.substring(F.sha2(component, 256), 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)
    return F.when(share < fraction, "test").otherwise("dev")


def normal_sql(sql: Column) -> Column:
    """Lower case with single spaces, to tell repeated statements."""
    return F.trim(F.regexp_replace(F.lower(sql), r"\s+", " "))


def labelled_field(text: Column, label: str, default: str = "not stated") -> Column:
    """The first non-empty ``label: value`` of a text's lines."""
    found = F.trim(F.regexp_extract(text, rf"(?im)^\s*{label}\s*:[ \t]*(\S.*)$", 1))
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(default))


def without_thinking(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?s)<think>.*?</think>", ""))


def verdict(text: Column, number: int) -> Column:
    """The verdict on a numbered line: yes, no or partial, which is also the default."""
    found = F.lower(F.regexp_extract(text, rf"(?im)^\s*{number}\)\s*(yes|no|partial)\b", 1))
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("partial"))
