"""Exact ranks and quantiles without gathering a group's values in one task or pairing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from freshet.session import cut_lineage

YEAR = 366
#: Values of one group that may be sorted in one place, and buckets per round above that.
SORTED, BUCKETS = 10_000, 4096


def counts_below(refs: DataFrame, probes: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, below, at_most, total) for every distinct probe: how many of its key's ``refs`` are under it.

    A merge of both sides in one sorted sequence: equal values are counted into one row first, the rows are dealt
    out by ranges of (keys, value), running counts are taken inside each range and the counts of a key's
    earlier ranges are carried over. A key of any size so spans several ranges. Null values on either side are
    left out; a probe whose key has no refs has total 0.
    """
    own = [*keys, "__v"]
    r = refs.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    p = probes.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("__v")).distinct()
    both = r.withColumn("__asked", F.lit(False)).unionByName(p.withColumns({"__n": F.lit(0).cast("long"), "__asked": F.lit(True)}))
    both = both.groupBy(*own).agg(F.sum("__n").alias("__n"), F.max("__asked").alias("__asked"))
    # the number of a range is written with its rows, so both reads below agree on it
    laid = cut_lineage(both.repartitionByRange(*own).withColumn("__range", F.spark_partition_id()))
    per_range = laid.groupBy(*keys, "__range").agg(F.sum("__n").alias("__in"))
    by_key = W.partitionBy(*keys)
    before = F.coalesce(F.sum("__in").over(by_key.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    carried = per_range.select(*keys, "__range", before.alias("__before"), F.sum("__in").over(by_key).alias("total"))
    inside = F.sum("__n").over(W.partitionBy(*keys, "__range").orderBy("__v").rowsBetween(W.unboundedPreceding, W.currentRow))
    # null keys are keys too
    right = carried.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__range").alias("__r"), "__before", "total")
    same = F.col("__range") == F.col("__r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    found = laid.withColumn("__upto", inside).where("__asked").join(right, same)
    at_most = F.col("__before") + F.col("__upto")
    return found.select(*keys, F.col("__v").alias(value), (at_most - F.col("__n")).alias("below"), at_most.alias("at_most"), "total")


def _blocks(first: int, last: int, top: int) -> list[tuple[int, int]]:
    """(level, number) of aligned blocks of 2**level days that make up first..last, as few as there are up to ``top``."""
    out = []
    while first <= last:
        level = 0
        while level < top and first % (2 << level) == 0 and first + (2 << level) - 1 <= last:
            level += 1
        out.append((level, first >> level))
        first += 1 << level
    return out


def season_blocks(spark: SparkSession, k: int) -> DataFrame:
    """(doy, block): the blocks of days that make up the band of ``k`` days around each day of the year, over the turn of the year."""
    top, rows = k.bit_length(), []
    for doy in range(YEAR):
        low, high = doy - k, doy + k
        parts = [(max(low, 0), min(high, YEAR - 1))]
        parts += [(low + YEAR, YEAR - 1)] if low < 0 else []
        parts += [(0, high - YEAR)] if high >= YEAR else []
        rows += [(doy + 1, level * 1000 + number) for a, b in parts for level, number in _blocks(a, b, top)]
    return spark.createDataFrame(rows, "doy int, block int")


def seasonal_shares(history: DataFrame, probes: DataFrame, key: str, day: str, value: str, k: int = 15, at_least: int = 60) -> DataFrame:
    """Rows of ``probes`` (key, day, value), each distinct one once, with n_ref and share: the part of the key's history within k days of the year at or below the value.

    Counting in two dimensions: the year is cut into aligned blocks of 1, 2, 4 ... days. A value of the history is entered
    in the one block of each size that holds its day, a probe asks the few blocks that make up its band, and
    each block counts by value (``counts_below``). No pairs are formed and years of history add no rows to a probe. The share is
    null with fewer than ``at_least`` values; probes without any value of history are left out, as are null values.
    """
    if 2 * k + 1 > YEAR:
        raise ValueError("the band is longer than a year")
    doy0 = F.dayofyear(day) - 1
    sizes = F.array(*[F.lit(level * 1000) + F.shiftright(doy0, level) for level in range(k.bit_length() + 1)])
    refs = history.where(F.col(value).isNotNull()).select(key, F.explode(sizes).alias("block"), value)
    asked = probes.where(F.col(value).isNotNull()).select(key, day, value).distinct().withColumn("__doy", F.dayofyear(day))
    bands = F.broadcast(season_blocks(history.sparkSession, k))
    wide = cut_lineage(asked.join(bands, asked["__doy"] == bands["doy"]).select(key, day, "block", value))
    counts = counts_below(refs, wide, [key, "block"], value)
    per = wide.join(counts, [key, "block", value]).groupBy(key, day, value).agg(F.sum("total").alias("n_ref"), F.sum("at_most").alias("__le"))
    return per.where("n_ref > 0").withColumn("share", F.when(F.col("n_ref") >= at_least, F.col("__le") / F.col("n_ref"))).drop("__le")


def exceedance(preds: DataFrame, residuals: DataFrame, key: str, pred: str, residual: str, thresholds: dict[str, str]) -> DataFrame:
    """``preds`` with the share of the key's residuals r for which pred + r reaches each threshold: r >= threshold - pred.

    Counted by ``counts_below`` on the residuals and the distances to the thresholds. Null where the prediction or
    threshold is null or the key has no residuals.
    """
    out = preds
    far = {name: F.col(thr) - F.col(pred) for name, thr in thresholds.items()}
    asked = preds.select(key, F.explode(F.array(*far.values())).alias("__x"))
    counts = cut_lineage(counts_below(residuals.select(key, F.col(residual).alias("__x")), asked, [key], "__x").where("total > 0"))
    for name, x in far.items():
        share = counts.select(key, F.col("__x").alias(f"__{name}"), ((F.col("total") - F.col("below")) / F.col("total")).alias(name))
        out = out.withColumn(f"__{name}", x).join(share, [key, f"__{name}"], "left").drop(f"__{name}")
    return out.select(*preds.columns, *thresholds)


def exact_quantiles(df: DataFrame, keys: list[str], columns: dict[str, Column], p: float = 0.5, rows_as: str = "n_rows", most: int = SORTED, buckets: int = BUCKETS) -> DataFrame:
    """(keys, rows_as, columns): rows of the group and the quantile ``p`` of each column's values per group, between two neighbours as in a sorted list.

    Selection by refinement: the span of a group's values is cut into buckets, counts find the bucket that
    holds the rank, and only its values go on, until few are left or all are equal; then they are sorted. Counts are
    combined before they are shuffled, so no task gathers a group. Null, NaN and infinite values are left out; a
    group without values has null. Without ``keys`` all rows are one group, in one row with the columns alone.
    """
    long = F.inline(F.array(*[F.struct(F.lit(n).alias("__name"), c.cast("double").alias("__v")) for n, c in columns.items()]))
    marks = [f"__g{i}" for i in range(len(keys))]
    group = [F.struct(k).alias(m) for k, m in zip(keys, marks, strict=True)]
    # read once for the spans and again by every round
    rows = cut_lineage(df.select(*group, long).where(F.abs("__v") < float("inf")))
    on, done = [*marks, "__name"], []
    spans = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    rank = F.lit(float(p)) * (F.col("__n") - 1)
    # rank and weight of the upper neighbour, both from the whole group
    spans = cut_lineage(spans.withColumns({"__rank": F.floor(rank), "__part": rank - F.floor(rank)}))
    while True:
        even = F.col("__lo") == F.col("__hi")
        done.append(spans.where(even).select(*on, F.col("__lo").alias("__q")))
        few = spans.where(~even & (F.col("__n") <= most))
        near = rows.join(few.select(*on, "__rank", "__part", F.col("__lo").alias("__a"), F.col("__hi").alias("__b")), on).where("__v BETWEEN __a AND __b")
        listed = near.groupBy(*on, "__rank", "__part").agg(F.sort_array(F.collect_list("__v")).alias("__l"))
        at = F.col("__rank").cast("int")
        low, high = F.get("__l", at), F.coalesce(F.get("__l", at + 1), F.get("__l", at))
        done.append(listed.select(*on, (low + (high - low) * F.col("__part")).alias("__q")))
        many = spans.where(~even & (F.col("__n") > most))
        if many.isEmpty():
            break
        wide = rows.join(many.select(*on, "__rank", "__part", F.col("__lo").alias("__a"), F.col("__hi").alias("__b")), on).where("__v BETWEEN __a AND __b")
        # in eighths where the whole span is no double
        scale = F.when(F.col("__b") - F.col("__a") == float("inf"), 0.125).otherwise(1.0)
        place = (F.col("__v") * scale - F.col("__a") * scale) / (F.col("__b") * scale - F.col("__a") * scale) * buckets
        bins = wide.withColumn("__bin", F.least(F.floor(place), F.lit(buckets - 1))).groupBy(*on, "__rank", "__part", "__bin").agg(
            F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")
        )
        order = W.partitionBy(*on).orderBy("__bin")
        before = F.coalesce(F.sum("__n").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        bins = bins.withColumns({"__before": before, "__next": F.lead("__lo").over(order)})
        held = cut_lineage(bins.where((F.col("__before") <= F.col("__rank")) & (F.col("__rank") < F.col("__before") + F.col("__n"))))
        # the upper neighbour is the next bucket's least value
        split = (F.col("__rank") == F.col("__before") + F.col("__n") - 1) & (F.col("__part") > 0) & F.col("__next").isNotNull()
        done.append(held.where(split).select(*on, (F.col("__hi") + (F.col("__next") - F.col("__hi")) * F.col("__part")).alias("__q")))
        spans = held.where(~split).select(*on, "__n", "__lo", "__hi", (F.col("__rank") - F.col("__before")).alias("__rank"), "__part")
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    wide = found.groupBy(*marks).agg(*[F.max(F.when(F.col("__name") == n, F.col("__q"))).alias(n) for n in columns])
    if not keys:
        return wide
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(rows_as)).select(*keys, rows_as, *group)
    return groups.join(wide, marks, "left").select(*keys, rows_as, *columns)
