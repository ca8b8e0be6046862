"""License scans by diagonal voting.

Every word k-gram of a document is hashed and joined to the positions at which the
templates have the same k-gram. A match at document position i and template
position j votes for the offset diagonal i - j. Votes are summed per document,
template and diagonal; diagonals next to each other are merged, so that an inserted
or missing word doesn't break a match; a merged run is verified by the share of the
template's k-grams that it covers. Short phrases need every k-gram on one diagonal,
that is, all their words in a row.

Scale. The templates are fixed and small, so their gram table is broadcast; the
documents' words are exploded and matched inside the scan, and only votes move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lineloom.storage import cut

#: Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Openings of common licence texts, by label.
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    "apache": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc": "licensed under cc by nc",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
}
GRAM, SHORT_GRAM, SHARE, DRIFT = 4, 2, 0.6, 3
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def license_words(text: Column) -> Column:
    """Runs of characters other than ASCII non-alphanumerics; a null text has none."""
    return F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), SEPARATORS), lambda w: w != "")


def ascii_lower(word: Column) -> Column:
    """Lower-cases A-Z only. ``lower`` also changes other letters, of which only two give ASCII ones; those words take the slow path."""
    odd = word.contains("\u212a") | word.contains("\u0130")
    return F.when(odd, F.translate(word, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.lower(word))


def template_grams(spark: SparkSession, phrases: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """A row per template and k-gram: its number, kind, label, size in words, k-gram count, position, and words (null beyond k)."""
    rows = []
    for number, (text, label, base) in enumerate([(t, x, True) for t, x in phrases.items()] + [(t, x, False) for x, t in templates.items()]):
        w = text.split()
        k = SHORT_GRAM if len(w) <= GRAM + 1 else GRAM
        rows += [(number, base, label, len(w), len(w) - k + 1, at, k, *w[at : at + k], *[None] * (GRAM - k)) for at in range(len(w) - k + 1)]
    return spark.createDataFrame(rows, "tpl int, base boolean, label string, n int, grams int, tpos int, k int, t0 string, t1 string, t2 string, t3 string")


def license_matches(docs: DataFrame, id_col: str, text_col: str, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, share: float = SHARE) -> DataFrame:
    """Verified spans ``(id, text_hash, label, base, start, words, score)``, positions counted in words from 0."""
    w = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), license_words(F.col(text_col)).alias("w")).where(F.size("w") >= SHORT_GRAM)
    n = F.size("w")
    shifted = F.arrays_zip(*[F.slice("w", i + 1, n).alias(f"w{i}") for i in range(GRAM)])
    exploded = w.select("id", "text_hash", F.posexplode(shifted).alias("pos", "s"))
    fields = [f.name for f in exploded.schema["s"].dataType.fields]
    grams = exploded.select("id", "text_hash", "pos", *[ascii_lower(F.col(f"s.`{f}`")).alias(f"w{i}") for i, f in enumerate(fields)]).where("w1 is not null")
    known = template_grams(docs.sparkSession, phrases, templates)
    g, t = grams.withColumn("h", F.xxhash64("w0", "w1")).alias("g"), F.broadcast(known.withColumn("h", F.xxhash64("t0", "t1"))).alias("t")  # a fixed table
    same = (F.col("g.h") == F.col("t.h")) & (F.col("w0") == F.col("t0")) & (F.col("w1") == F.col("t1")) & ((F.col("k") == SHORT_GRAM) | ((F.col("w2") == F.col("t2")) & (F.col("w3") == F.col("t3"))))
    hits = g.join(t, same).select("id", "text_hash", "tpl", "base", "label", "n", "grams", "pos", (F.col("pos") - F.col("tpos")).alias("diagonal")).distinct()  # repeated rows vote once
    votes = cut(hits.groupBy("id", "text_hash", "tpl", "base", "label", "n", "grams", "diagonal").agg(F.count(F.lit(1)).cast("int").alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi")), "votes")  # a few rows for each match; read twice below
    exact = votes.where("n <= 5 and votes = grams").select("id", "text_hash", "label", "base", F.col("diagonal").alias("start"), F.col("n").alias("words"), F.lit(1.0).alias("score"))
    along = Window.partitionBy("id", "text_hash", "tpl").orderBy("diagonal")
    runs = votes.where("n > 5").withColumn("new", (F.col("diagonal") - F.coalesce(F.lag("diagonal").over(along), F.lit(-(1 << 30))) > DRIFT).cast("int")).withColumn("run", F.sum("new").over(along))
    spans = runs.groupBy("id", "text_hash", "tpl", "label", "base", "n", "grams", "run").agg(F.sum("votes").alias("votes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    score = F.least(F.lit(1.0), F.col("votes") / F.col("grams"))
    long = spans.where((score >= share) & (F.col("hi") - F.col("lo") <= 2 * F.col("n"))).select("id", "text_hash", "label", "base", F.col("lo").alias("start"), (F.col("hi") - F.col("lo") + GRAM).alias("words"), score.alias("score"))
    return exact.unionByName(long)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """A row per document: word count, base phrase places and labels, all labels, and the best score.

    Null and empty texts have no words and no labels (empty strings). Repeated rows
    give repeated rows. Other columns are not read.
    """
    spans = license_matches(docs, id_col, text_col, phrases, templates)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")  # noqa: E731  a few fixed labels
    base = F.col("base")
    per_doc = spans.groupBy(F.struct("id", "text_hash").alias("row")).agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"), F.max(F.when(base, F.col("start"))).alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"), joined("label").alias("labels"), F.max("score").alias("score"),
    )
    rows = docs.select(F.col(id_col), F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash")).alias("row"), F.size(license_words(F.col(text_col))).cast("long").alias("n_words"))
    return rows.join(per_doc, "row", "left").select(
        id_col, "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
