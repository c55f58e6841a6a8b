"""Benchmark decontamination: size-partitioned MinHash containment search, then exact containment.

An item's shingles (runs of five words) are sketched by their smallest hashes. Documents fall into
partitions by their number of shingles, doubling from one to the next; an item is looked up only in
partitions that are large enough to hold the shared part it must have. Each of an item's minima is a
uniform draw from its shingles, so it is in a document with probability equal to the containment: at the least containment 0.8
all eight minima miss with probability under 0.2 ** 8. Any hit makes a candidate, and candidates
are settled by comparing the shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import broadcast_within, split_words, text_key, whole_text, word_ngrams
from freshet.session import cut_lineage

SEPARATORS = r"[^\p{L}\p{N}]+"
SHINGLE, CONTAINMENT, MINIMA = 5, 0.8, 8
PARTITIONS = 40


def _words(text: Column) -> Column:
    return split_words(F.lower(text), SEPARATORS)


def _partition(size: Column) -> Column:
    """Sizes 1, 2-3, 4-7, ... are partitions 0, 1, 2, ..."""
    return F.floor(F.log2(size.cast("double") + F.lit(0.5))).cast("int")


def _shingle_texts(words: str) -> Column:
    last = F.size(words) - SHINGLE
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(F.col(words), i + 1, F.lit(SHINGLE)), " "))
    return F.array_distinct(F.when(last >= 0, runs).otherwise(F.array().cast("array<string>")))


def item_sketches(items: DataFrame, minima: int = MINIMA, containment: float = CONTAINMENT) -> DataFrame:
    """(item_id, shingles) -> one row per item, minimum and document partition: part, h, item_id."""
    s = items.select("item_id", F.slice(F.sort_array(F.array_distinct("hashes")), 1, minima).alias("m"), F.size(F.array_distinct("hashes")).alias("q"))
    least = _partition(F.ceil(F.col("q") * F.lit(containment)))
    s = s.where("q > 0").select("item_id", "m", F.explode(F.sequence(least, F.lit(PARTITIONS))).alias("part"))
    return s.select("part", "item_id", F.explode("m").alias("h"))


def leaks_by_text(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """k1, k2 (the text), item_id, n_shared, n_item for each distinct text that holds an item.

    Words are runs of letters and digits in lower case. Items and documents with fewer than five words have no
    shingle and never match; null texts count as empty. Items that share an id and a text count once; of different texts under one id the best counts.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), _words(whole_text(item_text)).alias("words")).distinct()
    items = cut_lineage(items.select("item_id", word_ngrams("words", SHINGLE).alias("hashes"), _shingle_texts("words").alias("item_shingles")))
    sketches = cut_lineage(item_sketches(items, containment=containment))
    keyed = docs.select(whole_text(text).alias("text")).withColumns(text_key(F.col("text")))

    # the array is built inside explode: as a column of its own, a filter on its size would be pushed below the split
    worded = keyed.select("k1", "k2", _words(F.col("text")).alias("words"))
    rolled = worded.select("k1", "k2", _partition(F.size("words") - (SHINGLE - 1)).alias("part"), F.explode(word_ngrams("words", SHINGLE)).alias("h"))
    found = cut_lineage(rolled.join(broadcast_within(sketches), ["part", "h"]).select("k1", "k2", "item_id").distinct())

    held = cut_lineage(found.select("k1", "k2").distinct())
    texts = keyed.select("k1", "k2", "text").join(broadcast_within(held), ["k1", "k2"], "leftsemi").dropDuplicates(["k1", "k2"])
    shingled = texts.select("k1", "k2", _words(F.col("text")).alias("words")).select("k1", "k2", _shingle_texts("words").alias("doc_shingles"))
    same_item = F.col("found.item_id").eqNullSafe(F.col("items.item_id"))
    pairs = shingled.join(found, ["k1", "k2"]).alias("found").join(items.select("item_id", "item_shingles").alias("items"), same_item).select("k1", "k2", "found.item_id", "item_shingles", "doc_shingles")
    n, q = F.size(F.array_intersect("item_shingles", "doc_shingles")).cast("long"), F.size("item_shingles").cast("long")
    sure = pairs.select("k1", "k2", "item_id", n.alias("n_shared"), q.alias("n_item")).where(F.col("n_shared") >= F.lit(containment) * F.col("n_item"))
    best = F.max_by(F.struct("n_shared", "n_item"), F.struct(F.col("n_shared") / F.col("n_item"), "n_item")).alias("m")
    return cut_lineage(sure.groupBy("k1", "k2", "item_id").agg(best).select("k1", "k2", "item_id", "m.*"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment for every document row that holds an item.

    Work is done once per distinct text; every row with that text gets the result, null ids included, and
    rows repeated in ``docs`` repeat. Empty tables give no rows.
    """
    sure = leaks_by_text(docs, benchmark, text, **how)
    keyed = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text")).withColumns(text_key(F.col("text")))
    rows = keyed.select("doc_id", "k1", "k2").join(broadcast_within(sure), ["k1", "k2"])
    return rows.select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, with their columns, whose text holds no item."""
    bad = cut_lineage(leaks_by_text(docs, benchmark, text, **how).select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")).distinct())
    key = text_key(whole_text(text))
    return docs.join(broadcast_within(bad), (key["k1"] == F.col("__k1")) & (key["k2"] == F.col("__k2")), "leftanti")


SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM w),
bw AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
b AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM bw),
n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_item, count(*) / n_item AS containment
FROM s JOIN b USING (g) JOIN n USING (item_id) GROUP BY doc_id, item_id, n_item HAVING count(*) >= 0.8 * n_item
"""
