"""Mixing sources to target weights without sorting documents.

Each source gets a target of words. Whole copies of a source come first; the rest of its target is
taken by a threshold on a hash of the document id. The threshold is found from histograms: words
are summed by source and the first hash digits, the bucket in which the running sum reaches the
budget is refined by the next digits, and so on. Only that bucket is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import broadcast_within, split_words, whole_text
from freshet.session import cut_lineage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Hex digits of the hash per level, and levels: 4,096 buckets a source and level, 60 bits in all.
DIGITS, LEVELS = 3, 5


def word_count(text: Column) -> Column:
    return F.size(split_words(text)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) -> with ``target``: the level at which sum(min(cap, level * weight)) is the total.

    The window runs over one row per source. Sources whose cap is reached first come first; the
    level follows from what the capped ones leave to the others.
    """
    every = Window.orderBy(F.lit(0))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int")).cast("double")
    w = sizes.withColumn("weight", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.lit(float(share)) * F.sum("source_size").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    w = w.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))
    level = F.min(fits).over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))["level"]
    target = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    return w.withColumn("target", target).select("source", "source_size", "target")


def _by_source(rows: DataFrame, per_source: DataFrame, how: str = "inner") -> DataFrame:
    right = broadcast_within(per_source.withColumnRenamed("source", "__source"))
    return rows.join(right, F.col("source").eqNullSafe(F.col("__source")), how).drop("__source")


def _boundary(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """The bucket of each source in which the running sum of words first reaches the budget.

    ``counts``: source, prefix, words; ``limits``: source, budget (of what is left in this bucket),
    prefix so far. Gives the longer prefix and the budget left inside it.
    """
    run = Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = counts.withColumn("upto", F.sum("words").over(run))
    joined = _by_source(c, limits)
    first = F.min(F.when(F.col("upto") >= F.col("budget"), F.struct("prefix", "upto", "words"))).alias("hit")
    got = joined.groupBy("source", "budget").agg(first).where("hit is not null")
    return got.select("source", F.col("hit.prefix").alias("prefix"), (F.col("budget") - F.col("hit.upto") + F.col("hit.words")).alias("budget"), F.col("hit.words").alias("words"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **rule) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: how often the mix takes each document.

    Every document of a source is taken ``floor(target / source_size)`` times, and those whose hash is at or below
    the source's threshold once more, so no document is taken more than twice. The document
    at the threshold is taken if that brings the sum nearer to the target (a tie leaves it out).
    The hash is md5 of the id as text: reruns agree, rows with equal ids go together, null ids count as
    empty text, null sources are one source, null texts have size 0, an empty table gives no rows.
    """
    rows = cut_lineage(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(whole_text(text)).alias("size"), _hash(doc_id).alias("h")))
    return _taken(rows, _picked(rows, **rule)).select("doc_id", "size", "source_size", "target", "taken", "copies")


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **rule) -> DataFrame:
    """The documents that ``mix`` takes, with the columns of ``docs`` and size, source_size, target, taken, copies (which replace columns of these names)."""
    made = ["size", "source_size", "target", "taken", "copies"]
    rows = cut_lineage(docs.select(F.col(source).alias("source"), word_count(whole_text(text)).alias("size"), _hash(doc_id).alias("h")))
    d = docs.drop(*made, "h", "whole", "more", "upper").withColumns({"size": word_count(whole_text(text)), "h": _hash(doc_id)})
    taken = _taken(d.withColumn("source", F.col(source)), _picked(rows, **rule))
    return taken.where("copies > 0").drop("h", "whole", "more", "upper")


def _hash(doc_id: str) -> Column:
    return F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def _taken(rows: DataFrame, picked: DataFrame) -> DataFrame:
    once_more = F.col("more") & (F.col("h") <= F.coalesce("upper", F.lit("")))
    copies = F.when(F.col("size") == 0, 0).otherwise(F.col("whole") + once_more.cast("long"))
    return _by_source(rows, picked).withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))


def _picked(rows: DataFrame, **rule) -> DataFrame:
    """One row per source: target, whole copies, and the highest hash that is taken once more."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut_lineage(source_targets(sizes, **rule))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    edge = targets.where("rest > 0").select("source", F.lit("").alias("prefix"), F.col("rest").alias("budget"), F.col("source_size").alias("words"))
    for level in range(1, LEVELS + 1):
        inside = _by_source(rows.where("size > 0"), edge.select("source", "prefix")).where(F.col("h").startswith(F.col("prefix")))
        counts = inside.groupBy("source", F.substring("h", 1, DIGITS * level).alias("prefix")).agg(F.sum("size").alias("words"))
        edge = cut_lineage(_boundary(counts, edge.select("source", "budget")))
    # the last bucket is one document (or repeats of one id): in if that is nearer
    low, high = F.col("prefix"), F.concat("prefix", F.lit("g"))
    upper = edge.select("source", F.when(F.col("words") - F.col("budget") < F.col("budget"), high).otherwise(low).alias("upper"))
    out = _by_source(targets, upper, "left")
    return cut_lineage(out.select("source", "source_size", "target", "whole", "upper", (F.col("rest") > 0).alias("more")))


SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source),
w AS (SELECT *, CASE k % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT first(level ORDER BY cap / weight) AS level FROM l WHERE level * weight <= cap),
t AS (SELECT source, source_size, least(cap, coalesce(f.level * weight, cap)) AS target FROM l, f),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
r AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
  sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
  sum(d.size) OVER (PARTITION BY d.source, d.h) AS own FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST((CASE WHEN size = 0 THEN 0 ELSE whole + CASE WHEN rest > 0 AND (upto <= rest OR (upto - own < rest AND upto - rest < rest - (upto - own))) THEN 1 ELSE 0 END END) * size AS BIGINT) AS taken
FROM r
"""
