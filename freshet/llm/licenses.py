"""License scans by diagonal voting.

All rolling three-word hashes of the documents are joined to their positions in the templates. A hit
votes for the diagonal (document position minus template position). Diagonals of one text and template that
lie next to each other, as after an inserted or lost word, are merged to spans, and a span counts
if it covers enough of the template's words. A phrase that must stand word for word is a template
whose span must cover it whole on one diagonal.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import broadcast_within, split_words, text_key, whole_text, word_ngrams
from freshet.session import cut_lineage

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 3
#: Diagonals up to so many words apart are one span; least share of a template's words in a span.
NEAR, COVER = 4, 0.8

# Phrases and their labels.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

# Sentences of public licenses and the usual notices that name them.
TEMPLATES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
]


def license_words(text: Column) -> Column:
    """Words with A-Z in lower case; other letters stay (the Kelvin sign is no k)."""
    return split_words(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), SEPARATORS)


def template_grams(spark, templates: list[tuple[str, str]], phrases: list[tuple[str, str]]) -> DataFrame:
    """tid, whole, label, tlen, tpos, h: the three-word hashes of templates and phrases by position."""
    rows = [(i, i < len(phrases), label, text) for i, (text, label) in enumerate([*phrases, *templates])]
    t = spark.createDataFrame(rows, "tid int, whole boolean, label string, t string").withColumn("w", license_words(F.col("t")))
    return t.select("tid", "whole", "label", F.size("w").alias("tlen"), F.posexplode(word_ngrams("w", K)).alias("tpos", "h"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES, doc_id: str = "doc_id", text: str = "text", near: int = NEAR, cover: float = COVER) -> tuple[DataFrame, DataFrame]:
    """(documents, spans): doc_id, k1, k2, n_words for every row; and per distinct text its spans.

    Spans: k1, k2, label, whole, first (word at which the span starts), last (word after it), cover. Null texts
    count as empty. Equal texts share their spans, so repeated rows and null ids need nothing
    special; an empty table gives two empty tables.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text")).withColumns(text_key(F.col("text"))).withColumn("words", license_words(F.col("text")))
    grams = cut_lineage(template_grams(spark, templates, phrases).coalesce(1))
    rolled = d.select("k1", "k2", F.posexplode(word_ngrams("words", K)).alias("pos", "h"))
    hits = rolled.join(broadcast_within(grams), "h").select("k1", "k2", "tid", "whole", "label", "tlen", "tpos", "pos").distinct()
    diagonal = ["k1", "k2", "tid", "whole", "label", "tlen", (F.col("pos") - F.col("tpos")).alias("diag")]
    votes = hits.groupBy(*diagonal).agg(F.collect_set("tpos").alias("at"))  # at most tlen positions

    order = Window.partitionBy("k1", "k2", "tid").orderBy("diag")
    step = F.when(F.col("whole") | (F.col("diag") - F.lag("diag").over(order) > near), 1).otherwise(0)
    merged = votes.withColumn("run", F.sum(step).over(order))
    g = merged.groupBy("k1", "k2", "tid", "whole", "label", "tlen", "run").agg(
        F.min(F.col("diag") + F.array_min("at")).alias("first"), F.max(F.col("diag") + F.array_max("at") + K).alias("last"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("at")))).alias("at"),
    )
    at = F.col("at")
    words = F.aggregate(F.transform(at, lambda p, i: F.least(F.lit(K), F.coalesce(F.get(at, i + 1) - p, F.lit(K)))), F.lit(0), lambda a, x: a + x)
    spans = g.withColumn("cover", words / F.col("tlen"))
    spans = spans.where((F.col("whole") & (F.col("cover") == 1.0)) | (~F.col("whole") & (F.col("cover") >= cover)))
    return d.select("doc_id", "k1", "k2", F.size("words").cast("long").alias("n_words")), spans.select("k1", "k2", "label", "whole", "first", "last", "cover")


def digest(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """One row per document: counts and places of the phrases, labels, and the best cover as score."""
    phrase = F.col("whole")

    def joined(c: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(c)), ",")

    per = spans.groupBy("k1", "k2").agg(
        F.count_if(phrase).alias("n_base"), F.min(F.when(phrase, F.col("first"))).cast("long").alias("first_word"), F.max(F.when(phrase, F.col("first"))).cast("long").alias("last_word"),
        joined(F.when(phrase, F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"), F.max("cover").alias("score"),
    )
    per = cut_lineage(per)
    out = rows.join(broadcast_within(per), ["k1", "k2"], "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
