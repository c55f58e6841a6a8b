"""Joins in time and on keys. Every theta condition is turned into an equi-join first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from freshet.operators.chunks import DAY_SECONDS, carry_last, chunk_of, seconds_of


def lagged(df: DataFrame, key: str, order: str, value: str, n: int, out: str) -> DataFrame:
    return df.withColumn(out, F.lag(value, n).over(W.partitionBy(key).orderBy(order)))


def changes(df: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(value) - F.lag(value).over(W.partitionBy(key).orderBy(order)))


def catchment_mean(series: DataFrame, bridge: DataFrame, point: str, basin: str, step: str, value: str, out: str) -> DataFrame:
    """Mean over a basin's points at each step, points without a value skipped."""
    return series.join(bridge, point).groupBy(basin, step).agg(F.avg(value).alias(out))


def aligned(frames: list[DataFrame], on: list[str], values: list[str], at_least: int = 0) -> DataFrame:
    """Inner-align several series, drop rows with any null, keep keys with enough days."""
    joined = reduce(lambda a, b: a.join(b, on), frames).dropna(subset=values)
    if not at_least:
        return joined
    key = on[0]
    enough = joined.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= at_least).drop("_n")
    return joined.join(enough, key, "left_semi")


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    left_id: str,
    right_id: str,
    value: str,
    out: str,
    width: int = DAY_SECONDS,
) -> DataFrame:
    """Last ``value`` of ``right`` at or before each row of ``left``, per key.

    Both sides go into one stream ordered by time (right before left at the same instant), split
    into time chunks, so a hot key is spread over as many tasks as it has chunks.
    """
    asks = left.select(key, ts, F.lit(1).alias("_side"), F.col(left_id).alias("_id"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    gives = right.filter(F.col(value).isNotNull()).select(
        key, ts, F.lit(0).alias("_side"), F.col(right_id).alias("_id"), F.col(value).alias("_v")
    )
    both = asks.unionByName(gives).withColumn("_chunk", chunk_of(ts, width))
    found = carry_last(both, [key], [ts, "_side", "_id"], "_v", "_chunk", out, inclusive=True)
    return found.filter("_side = 1").select(key, ts, F.col("_id").alias(left_id), out)


def nearest_within(
    readings: DataFrame, key: str, ts: str, value: str, hours: float, near: float, far: float, band: float
) -> DataFrame:
    """Change against the reading closest to ``hours`` before the latest one.

    The reference reading lies at least ``near`` hours before the latest and at most ``far`` hours
    from its target, else there is none.
    """
    sec = seconds_of(ts)
    latest = readings.groupBy(key).agg(F.max_by(F.struct(sec.alias("s"), F.col(value).alias("v")), F.col(ts)).alias("_l"))
    back = readings.select(key, F.col(ts), F.col(value), sec.alias("_s")).join(latest, key)
    off = F.abs(F.col("_s") - (F.col("_l.s") - int(hours * 3600)))
    fit = (F.col("_s") <= F.col("_l.s") - int(near * 3600)) & (off <= int(far * 3600))
    ref = F.min_by(F.struct(F.col(ts).alias("t"), F.col(value).alias("v")), F.when(fit, F.struct(off, F.col(ts))))
    g = back.groupBy(key).agg(F.first("_l").alias("_l"), ref.alias("_r"))
    delta = F.col("_l.v") - F.col("_r.v")
    word = F.when(delta >= band, "rising").when(delta <= -band, "falling").when(delta.isNotNull(), "steady")
    return g.select(key, F.col("_l.v").alias("latest"), F.col("_r.t").alias("ref_time"), delta.alias("delta"), word.alias("word"))


def value_at(df: DataFrame, obs: DataFrame, key: str, day: str, value: str, at: dict[str, str]) -> DataFrame:
    """For each ``out: column`` in ``at``, the observed value on that column's day (null if none)."""
    for out, col in at.items():
        side = obs.select(F.col(key), F.col(day).alias(col), F.col(value).alias(out))
        df = df.join(side, [key, col], "left")
    return df


def pre_post_pair(scenes: DataFrame, event: list[str], window: str, orbit: str, order: list[str]) -> DataFrame:
    """First peak scene that has a pre scene of its orbit, with the latest such; else first peak and latest pre.

    ``order`` is (acquired, ids...). Scenes are read once, into one row per (event, orbit).
    """
    o = F.struct(*order)
    by = scenes.groupBy(*event, orbit).agg(
        F.max(F.when(F.col(window) == "pre", o)).alias("pre"), F.min(F.when(F.col(window) == "peak", o)).alias("peak")
    )
    matched = F.when(F.col("pre").isNotNull() & F.col("peak").isNotNull(), F.col("peak"))
    g = by.groupBy(*event).agg(
        F.max("pre").alias("_pre"), F.min("peak").alias("_peak"), F.min_by(F.struct("pre", "peak"), matched).alias("_same")
    )
    return g.filter(F.col("_pre").isNotNull() & F.col("_peak").isNotNull()).select(
        *event,
        F.coalesce("_same.pre", "_pre").alias("pre"),
        F.coalesce("_same.peak", "_peak").alias("peak"),
        F.col("_same").isNotNull().alias("same_orbit"),
    )


def unknown_only(new: DataFrame, archived: DataFrame, key: list[str]) -> DataFrame:
    return new.join(archived.select(*key), key, "left_anti")


def time_grid(entities: DataFrame, lo: Column, hi: Column, step: int, out: str) -> DataFrame:
    """Each entity at every step; a generator per row, not a product of tables."""
    return entities.withColumn(out, F.explode(F.sequence(lo.cast("bigint"), hi.cast("bigint"), F.lit(step).cast("bigint"))))


def seasonal_band(ref: DataFrame, probe: DataFrame, key: str, ref_doy: str, probe_doy: str, k: int) -> DataFrame:
    """Pairs of rows within k days of the year of each other on the 366-day circle, as an equi-join."""
    offs = F.explode(F.sequence(F.lit(-k), F.lit(k))).alias("_o")
    wide = probe.select("*", offs).withColumn(ref_doy, F.pmod(F.col(probe_doy) + F.col("_o") - 1, F.lit(366)) + 1).drop("_o")
    return wide.join(ref, [key, ref_doy])


def manifest_diff(old: DataFrame, new: DataFrame, key: list[str], digest: str) -> DataFrame:
    """Keys added, missing or changed between two catalogs of content hashes."""
    j = old.withColumnRenamed(digest, "_old").join(new.withColumnRenamed(digest, "_new"), key, "full")
    change = (
        F.when(F.col("_new").isNull(), "missing").when(F.col("_old").isNull(), "added").when(F.col("_old") != F.col("_new"), "changed")
    )
    return j.select(*key, change.alias("change")).filter(F.col("change").isNotNull())


def content_hash(df: DataFrame, keys: list[str], columns: list[str], out: str = "digest") -> DataFrame:
    """Order-free digest of each group's rows: hashes of rows are summed, never gathered."""
    # as JSON with nulls kept, different rows never give one text
    row = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"})
    # 15 hex digits fit a bigint; summed as decimals the total cannot overflow
    part = F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.groupBy(*keys).agg(F.concat_ws("-", F.count(F.lit(1)).cast("string"), F.sum(part).cast("string")).alias(out))


def share_inside(spans: DataFrame, rows: DataFrame, keys: list[str], start: str, end: str, day: str, cond: Column, name: str) -> DataFrame:
    """Count and share of rows meeting ``cond`` on the days of each span."""
    days = spans.select("*", F.explode(F.sequence(start, end)).alias(day))
    hit = rows.select(*keys, day, cond.cast("int").alias("_hit"))
    return (
        days.join(hit, [*keys, day])
        .groupBy(*spans.columns)
        .agg(F.count(F.lit(1)).alias("n_steps"), F.sum("_hit").alias(f"n_{name}"), F.avg("_hit").alias(f"{name}_share"))
    )


def carry_forward(keys: DataFrame, current: DataFrame, previous: DataFrame, key: str, value: str, since: str, now: Column) -> DataFrame:
    """Missing current values keep the last honest one, marked stale; with none they are withheld."""
    j = keys.join(current.select(key, F.col(value).alias("_now")), key, "left").join(
        previous.select(key, F.col(value).alias("_was"), F.col(since).alias("_since")), key, "left"
    )
    live, carried = F.col("_now").isNotNull(), F.col("_now").isNull() & F.col("_was").isNotNull()
    return j.select(
        key,
        F.coalesce("_now", "_was").alias(value),
        F.when(live, "live").when(carried, "carried").otherwise("withheld").alias("status"),
        F.when(carried, F.col("_since")).alias("stale_since"),
        F.when(carried, now).alias("checked_at"),
    )
