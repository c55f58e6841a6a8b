"""Quality rules: counted base rules, then the log-likelihood ratio of hashed n-grams.

Two multinomials over hashed one- and two-word n-grams are counted: one over trusted documents, one
over the whole corpus. A document's score is the mean log ratio of its n-grams; documents under
a fixed threshold go. Everything runs as column expressions.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import BROADCAST_ROWS, split_words, whole_text, word_ngrams

BUCKETS = 1 << 14
#: Pseudo-counts per bucket of the trusted multinomial, spread as the raw corpus is.
SMOOTHING = 1.0
#: Mean log ratio (nats per n-gram) below which a document goes.
THRESHOLD = -0.35


def _grams(words: str, buckets: int) -> Column:
    w = F.col(words)
    rest = F.greatest(F.size(w) - 1, F.lit(0))
    one = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
    two = F.zip_with(F.slice(w, F.lit(1), rest), F.slice(w, F.lit(2), rest), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int"))
    return F.concat(one, two)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all documents labelled good (quality 1, not toxic), each once."""
    good = labels.where("doc_id is not null and quality = 1 and coalesce(toxic, 0) = 0")
    return good.select(F.col("doc_id").cast("long").alias("trusted_id")).distinct()


def fit(
    docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS, smoothing: float = SMOOTHING, broadcast_rows: int = BROADCAST_ROWS
) -> list[float]:
    """Log ratio per bucket, from the n-grams of every document and of all trusted ones.

    Up to ``broadcast_rows`` trusted ids are broadcast; more of them meet the texts by a sort-merge join.
    Only the ``buckets`` sums reach the driver. Without trusted text all ratios are 0.
    """
    d = docs.select(F.col(doc_id).cast("long").alias("id"), whole_text(text).alias("t"))
    few = trusted.limit(broadcast_rows + 1).count() <= broadcast_rows
    trusted = F.broadcast(trusted) if few else trusted.hint("merge")
    # rows without an id are dealt out by their text and meet none
    d = d.join(trusted, (F.coalesce(d.id, F.xxhash64(d.t)) == trusted.trusted_id) & d.id.isNotNull(), "left")
    # words are split behind the join, so that texts are shuffled and not arrays
    d = d.select(F.col("trusted_id").isNotNull().alias("good"), split_words(F.col("t")).alias("words"))
    g = d.select("good", F.explode(_grams("words", buckets)).alias("b"))
    sums = g.groupBy("b").agg(F.count("*").alias("raw"), F.count_if("good").alias("good")).collect()
    n_good, n_raw = sum(r.good for r in sums), sum(r.raw for r in sums)
    out = [0.0] * buckets
    if n_good:
        # trusted counts are drawn towards the raw shares, so that little trusted text decides little
        prior = smoothing * buckets
        out = [math.log(prior / (n_good + prior))] * buckets
        for r in sums:
            share = r.raw / n_raw
            out[r.b] = math.log((r.good + prior * share) / ((n_good + prior) * share))
    return out


def apply_rules(docs: DataFrame, ratios: list[float], text: str = "text", threshold: float = THRESHOLD, name: str = "rules") -> DataFrame:
    """Adds the struct ``name``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.

    Windows of five words are compared by 64-bit hashes. Null and empty texts have no words, so the
    base rules reject them; score is 0 where there are no n-grams. Each row is judged alone: repeated rows get equal results.
    Columns of ``docs`` stay as they are (a column called ``name`` is replaced).
    """
    t = whole_text(text)
    d = docs.withColumn("__words", split_words(t)).withColumn("__win", word_ngrams("__words", 5))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("__lines", lines)
    # windows are only sorted where one of them repeats
    twice = F.size(F.array_distinct("__win")) < F.size("__win")
    none = F.array().cast("array<struct<h:bigint,p:int>>")
    d = d.withColumn("__sorted", F.when(twice, F.sort_array(F.transform("__win", lambda h, p: F.struct(h.alias("h"), p.alias("p"))))).otherwise(none))
    s, end = F.col("__sorted"), F.size("__sorted") - 1

    def same(x, i):
        before = F.when(i > 0, F.get(s, i - 1)["h"] == x["h"]).otherwise(False)
        return before | F.when(i < end, F.get(s, i + 1)["h"] == x["h"]).otherwise(False)

    d = d.withColumn("__at", F.sort_array(F.transform(F.filter(s, same), lambda x: x["p"])))
    at = F.col("__at")
    covered = F.aggregate(F.transform(at, lambda p, i: F.least(F.lit(5), F.coalesce(F.get(at, i + 1) - p, F.lit(5)))), F.lit(0), lambda a, x: a + x)
    weights = F.lit(np.array(ratios))
    d = d.withColumn("__grams", _grams("__words", len(ratios)))
    total = F.aggregate("__grams", F.lit(0.0), lambda a, b: a + F.get(weights, b))
    length = F.length(t)
    d = d.withColumn(
        name,
        F.struct(
            F.size("__words").cast("long").alias("n_words"),
            (length - F.length(F.regexp_replace(t, r"[^\x20\x09-\x0D]+", ""))).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
            covered.cast("long").alias("n_repeat_words"),
            F.when(F.size("__grams") > 0, total / F.size("__grams")).otherwise(0.0).alias("score"),
        ),
    )
    r = F.col(name)
    failed = (r["n_words"] < 10) | (100 * r["n_repeat_words"] > 20 * r["n_words"])
    d = d.withColumn(name, r.withField("base_failed", failed)).withColumn(name, r.withField("kept", ~r["base_failed"] & (r["score"] >= threshold)))
    return d.drop("__words", "__win", "__lines", "__sorted", "__at", "__grams")



def accepted(docs: DataFrame, ratios: list[float], text: str = "text", **rules) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns.

    Kept rows make one row each in an explode. A filter would be pushed below the columns it is made of
    and would split the text anew for every word.
    """
    once = F.when(F.col("__rules.kept"), F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    d = apply_rules(docs, ratios, text, name="__rules", **rules)
    return d.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(once).alias("__one")).drop("__one")
