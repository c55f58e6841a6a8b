"""Sorting, ranking and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def active_sorted(df: DataFrame, expires: str, now: Column, newest_first: list[str]) -> DataFrame:
    """Rows not yet expired, newest first; a range-partitioned sort, no single-task window."""
    return df.filter(F.col(expires) > now).orderBy(*[F.col(c).desc() for c in newest_first])


def bucketed_rank(df: DataFrame, keys: list[str], bucket: Column, order: list[Column], out: str = "rank") -> DataFrame:
    """Row number within keys without bringing a key into one task.

    ``bucket`` must not decrease along ``order``: ranks within a bucket are shifted by the sizes of
    the buckets before it, a table with one row per (keys, bucket).
    """
    b = df.withColumn("_b", bucket)
    sizes = b.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select(*keys, "_b", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy(*keys, "_b").orderBy(*order))
    return b.withColumn("_rn", inside).join(before, [*keys, "_b"]).withColumn(out, F.col("_before") + F.col("_rn")).drop("_b", "_rn", "_before")


def uncovered(active: DataFrame, name: str, covered: list[str]) -> DataFrame:
    """Distinct names that contain none of the covered words (any case)."""
    upper = F.upper(F.col(name))
    known = F.lit(False)
    for c in covered:
        known = known | F.contains(upper, F.lit(c.upper()))
    return active.filter(F.col(name).isNotNull() & ~known).select(name).distinct()
