"""Aggregations and verification measures. Ratios guard their denominators and give null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from freshet.operators.joins import seasonal_band
from freshet.operators.ranks import exact_quantiles, exceedance
from freshet.session import cut_lineage


def ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))


def daily_total(df: DataFrame, keys: list[str], day: Column, value: str, out: str = "total") -> DataFrame:
    """Sum per day; a day of nulls only is 0."""
    return df.groupBy(*keys, day.alias("d")).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(out))


def daily_mean(df: DataFrame, keys: list[str], day: Column, value: str, out: str = "mean") -> DataFrame:
    return df.groupBy(*keys, day.alias("d")).agg(F.avg(value).alias(out))


def offset_day(ts: Column, hours: int = 21) -> Column:
    """Observation day D covers [D-1 03:00, D 03:00)."""
    return (ts + F.make_interval(hours=F.lit(hours))).cast("date")


def rolled_hours(df: DataFrame, key: str, hour: str, value: str, n: int, out: str, partial: bool = False) -> DataFrame:
    """n-row trailing sum; null until n rows are there unless ``partial`` (then by hour range)."""
    w = W.partitionBy(key).orderBy(hour)
    if partial:
        return df.withColumn(out, F.sum(value).over(w.rangeBetween(-(n - 1), 0)))
    w = w.rowsBetween(-(n - 1), 0)
    return df.withColumn(out, F.when(F.count(value).over(w) >= n, F.sum(value).over(w)))


def in_season(day: str | Column, first: int = 6, last: int = 9) -> Column:
    return F.month(day).between(first, last)


def train_quantile(df: DataFrame, keys: list[str], day: str, value: str, before_year: Column, p: float, out: str = "thr") -> DataFrame:
    """Exact linear-interpolated percentile of season values of years before ``before_year``."""
    train = df.filter((F.year(day) < before_year) & in_season(day) & F.col(value).isNotNull())
    return train.groupBy(*keys).agg(F.percentile(value, F.lit(p)).alias(out))


def error_columns(actual: str, pred: str, persistence: str) -> list[Column]:
    """Aggregates over rows with all three present: n, mae, rmse, persistence mae, skill, bias."""
    a, p, s = (F.col(c).cast("double") for c in (actual, pred, persistence))
    ok = a.isNotNull() & p.isNotNull() & s.isNotNull()
    mae = F.avg(F.when(ok, F.abs(p - a)))
    mae_p = F.avg(F.when(ok, F.abs(s - a)))
    return [
        F.count_if(ok).alias("n"),
        mae.alias("mae"),
        F.sqrt(F.avg(F.when(ok, F.pow(p - a, 2)))).alias("rmse"),
        mae_p.alias("mae_persistence"),
        (F.lit(1.0) - ratio(mae, mae_p)).alias("skill"),
        F.avg(F.when(ok, p - a)).alias("bias"),
    ]


def error_metrics(df: DataFrame, keys: list[str], actual: str, pred: str, persistence: str) -> DataFrame:
    return df.groupBy(*keys).agg(*error_columns(actual, pred, persistence))


def contingency_columns(actual: Column, pred: Column) -> list[Column]:
    hits = F.count_if(actual & pred)
    n_act, n_pred = F.count_if(actual), F.count_if(pred)
    return [
        n_act.alias("n_actual"),
        n_pred.alias("n_predicted"),
        hits.alias("n_hits"),
        ratio(hits, n_act).alias("pod"),
        ratio(n_pred - hits, n_pred).alias("far"),
    ]


def contingency(df: DataFrame, keys: list[str], actual: Column, pred: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*contingency_columns(actual, pred))


def gate(df: DataFrame, n: str, at_least: int, metrics: list[str]) -> DataFrame:
    """Too few samples: status insufficient and no metrics."""
    enough = F.col(n) >= at_least
    out = df.withColumn("status", F.when(enough, "ok").otherwise("insufficient"))
    return out.withColumns({m: F.when(enough, F.col(m)) for m in metrics})


def varied_corr(a: Column, b: Column) -> Column:
    """Pearson r over rows with both values, null when either side is constant.

    Built from moments: the engine's own ``corr`` raises on a constant side in ANSI mode.
    """
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    return ratio(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def pair_columns(a: str, b: str, prefix: str = "") -> list[Column]:
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    return [
        varied_corr(x, y).alias(f"{prefix}r"),
        F.avg(x).alias(f"{prefix}mean_a"),
        F.avg(y).alias(f"{prefix}mean_b"),
        F.when(F.avg(y) > 0, F.avg(x) / F.avg(y)).alias(f"{prefix}bias"),
        F.avg(F.abs(x - y)).alias(f"{prefix}mae"),
    ]


def pearson_pair(df: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Correlation, means, ratio of means and mean absolute difference of two series."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *pair_columns(a, b))


def median_by(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Rows and exact medians per group; a group may hold any number of rows."""
    return exact_quantiles(cut_lineage(df.select(*keys, *metrics)), keys, {f"median_{m}": F.col(m) for m in metrics}, rows_as="n")


def seasonal_percentile(
    history: DataFrame, probe: DataFrame, key: str, day: str, value: str, probe_value: str, k: int = 15, at_least: int = 60
) -> DataFrame:
    """Share of history within k days of the year that is at or below the probe's value."""
    ref = history.filter(F.col(value).isNotNull()).select(key, F.dayofyear(day).alias("_doy"), F.col(value).alias("_ref"))
    p = probe.filter(F.col(probe_value).isNotNull()).select(key, F.col(day), F.col(probe_value)).withColumn("_p", F.dayofyear(day))
    pairs = seasonal_band(ref, p, key, "_doy", "_p", k)
    g = pairs.groupBy(key, day, probe_value).agg(
        F.count(F.lit(1)).alias("n_ref"), F.avg((F.col("_ref") <= F.col(probe_value)).cast("double")).alias("_s")
    )
    return g.withColumn("share", F.when(F.col("n_ref") >= at_least, F.col("_s"))).drop("_s")


def residual_exceedance(preds: DataFrame, residuals: DataFrame, key: str, pred: str, residual: str, thresholds: dict[str, str]) -> DataFrame:
    """P(pred + residual >= threshold) over a key's pooled held-out residuals, for predictions and residuals of any number."""
    return exceedance(cut_lineage(preds), residuals, key, pred, residual, thresholds)


def range_status(v: Column, n: Column, lo: Column, hi: Column, p1: Column, p99: Column) -> Column:
    return (
        F.when((n < 30) | v.isNull(), "unknown")
        .when((v > hi) | (v < lo), "out-of-range")
        .when((v > p99) | (v < p1), "extreme")
        .otherwise("in-range")
    )


def drift_status(history: DataFrame, live: DataFrame, key: str, day: str, value: str, k: int = 15) -> DataFrame:
    """Live inputs against history of the same time of year and of the whole season.

    ``history``: (key, input, day, value); ``live``: (key, input, day, v). Overall is the worst
    seasonal status of a key; unknown ranks with in-range.
    """
    # a key that cannot be read in two ways, whatever its parts hold
    both = F.to_json(F.struct(F.col(key).alias("k"), F.col("input").alias("i")))
    h = history.filter(F.col(value).isNotNull()).withColumn("_doy", F.dayofyear(day)).withColumn("_key", both)
    p = live.withColumn("_p", F.dayofyear(day)).withColumn("_key", both).select("_key", "_p", "v")
    cols = lambda: [
        F.count(F.lit(1)).alias("n"),
        F.min(value).alias("lo"),
        F.max(value).alias("hi"),
        F.percentile(value, F.array(F.lit(0.01), F.lit(0.99))).alias("pp"),
        F.avg((F.col(value) <= F.col("v")).cast("double")).alias("share"),
    ]
    seas = seasonal_band(h.select("_key", "_doy", value), p, "_key", "_doy", "_p", k).groupBy("_key").agg(*cols())
    mon = h.filter(in_season(day)).join(p, "_key").groupBy("_key").agg(*cols())
    out = live
    for name, ref in (("seasonal", seas), ("season_all", mon)):
        r = ref.select(F.col("_key"), *[F.col(c).alias(f"_{c}") for c in ("n", "lo", "hi", "pp", "share")])
        out = out.withColumn("_key", both).join(r, "_key", "left").drop("_key")
        n = F.coalesce(F.col("_n"), F.lit(0))
        status = range_status(F.col("v"), n, F.col("_lo"), F.col("_hi"), F.col("_pp")[0], F.col("_pp")[1])
        out = out.withColumn(f"{name}_status", status).withColumn(
            f"{name}_share", F.when(F.col(f"{name}_status") != "unknown", F.col("_share"))
        )
        out = out.drop("_n", "_lo", "_hi", "_pp", "_share")
    worst = F.max(F.when(F.col("seasonal_status") == "out-of-range", 2).when(F.col("seasonal_status") == "extreme", 1).otherwise(0))
    worst = worst.over(W.partitionBy(key))
    return out.withColumn("overall", F.when(worst == 2, "out-of-range").when(worst == 1, "extreme").otherwise("in-range"))


# fixed values: heavy and lenient daily rain, wet day
HEAVY_MM, LENIENT_MM, WET_MM = 25.0, 10.0, 1.0


def heavy_columns(ref: str, test: str) -> list[Column]:
    r, t = F.col(ref), F.col(test)
    heavy = r >= HEAVY_MM
    n = F.count_if(heavy)
    strict, lenient = F.count_if(heavy & (t >= HEAVY_MM)), F.count_if(heavy & (t >= LENIENT_MM))
    return [
        n.alias("heavy_days"),
        strict.alias("hit_strict"),
        lenient.alias("hit_lenient"),
        ratio(strict, n).alias("pod_strict"),
        ratio(lenient, n).alias("pod_lenient"),
        F.count_if((t >= HEAVY_MM) & (r < LENIENT_MM)).alias("false_alarm_days"),
    ]


def wet_day_agreement(gauge_daily: DataFrame, model: DataFrame, keys: list[str], gauge: str, mod: str, min_days: int = 60, min_each: int = 10) -> DataFrame:
    """Share of gauge-wet and gauge-dry days on which the model is wet; only keys with enough of each."""
    gw, mw = F.col(gauge) >= WET_MM, (F.col(mod) >= WET_MM).cast("double")
    s = gauge_daily.join(model, [*keys, "d"]).dropna(subset=[gauge, mod]).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_days"),
        F.count_if(gw).alias("n_wet"),
        F.avg(F.when(gw, mw)).alias("wet_when_wet"),
        F.avg(F.when(~gw, mw)).alias("wet_when_dry"),
    )
    return s.filter((F.col("n_days") >= min_days) & (F.col("n_wet") >= min_each) & (F.col("n_days") - F.col("n_wet") >= min_each))


# fixed values: ratio beyond which two series are not the same water
IMPLAUSIBLE_LOW, IMPLAUSIBLE_HIGH = 0.2, 5.0


def plausibility_flag(r: Column) -> Column:
    return F.coalesce((r > IMPLAUSIBLE_HIGH) | (r < IMPLAUSIBLE_LOW), F.lit(False))


def model_vs_observed(df: DataFrame, keys: list[str], obs: str, mod: str, min_days: int = 5, min_corr: int = 7) -> DataFrame:
    """Ratio, bias, errors and correlation of a modelled against an observed series."""
    o, m = F.col(obs), F.col(mod)
    g = df.dropna(subset=[obs, mod]).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(o).alias("obs_mean"),
        F.avg(m).alias("mod_mean"),
        F.avg(F.abs(m - o)).alias("mae"),
        varied_corr(o, m).alias("corr"),
    )
    g = (
        g.withColumn("ratio", ratio(F.col("mod_mean"), F.col("obs_mean")))
        .withColumn("bias", F.col("mod_mean") - F.col("obs_mean"))
        .withColumn("rel_mae", ratio(F.col("mae"), F.col("obs_mean")))
        .withColumn("corr", F.when(F.col("n") >= min_corr, F.col("corr")))
    )
    g = gate(g, "n", min_days, ["obs_mean", "mod_mean", "ratio", "bias", "mae", "rel_mae", "corr"])
    return g.withColumn("implausible", plausibility_flag(F.col("ratio")))


def plausible_medians(scores: DataFrame, metrics: list[str]) -> DataFrame:
    """Stations, how many are implausible, and medians over the others; there may be any number of stations."""
    scores = cut_lineage(scores)
    ok = (F.col("status") == "ok") & ~F.col("implausible")
    medians = cut_lineage(exact_quantiles(scores, [], {f"median_{m}": F.when(ok, F.col(m)) for m in metrics}))
    counts = scores.agg(F.count(F.lit(1)).alias("n_stations"), F.count_if(F.col("implausible")).alias("n_implausible"))
    return counts.select("*", *[medians.select(c).scalar().alias(c) for c in medians.columns])


def origin_slope(x: Column, y: Column) -> Column:
    """Least squares through the origin over rows with both present; 0 without any."""
    ok = x.isNotNull() & y.isNotNull()
    return F.coalesce(ratio(F.sum(F.when(ok, x * y)), F.sum(F.when(ok, x * x))), F.lit(0.0))


def doy_climatology(df: DataFrame, keys: list[str], day: str, value: str, k: int = 7) -> DataFrame:
    """Mean within k cyclic days for each day of the year 1..366."""
    daily = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.dayofyear(day).alias("_d")).agg(
        F.sum(value).alias("_s"), F.count(F.lit(1)).alias("_n")
    )
    spread = daily.withColumn("_o", F.explode(F.sequence(F.lit(-k), F.lit(k))))
    spread = spread.withColumn("doy", F.pmod(F.col("_d") + F.col("_o") - 1, F.lit(366)) + 1)
    return spread.groupBy(*keys, "doy").agg((F.sum("_s") / F.sum("_n")).alias("clim"))


def gap_report(df: DataFrame, key: str, day: str, value: str, years: DataFrame) -> DataFrame:
    """Rows, expected days, nulls, wet-season nulls and shortfall of every (key, year) of ``years``."""
    have = df.groupBy(key, F.year(day).alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(value).isNull()).alias("n_null"),
        F.count_if(F.col(value).isNull() & F.month(day).between(5, 10)).alias("n_null_season"),
    )
    days = F.dayofyear(F.make_date(F.col("year"), F.lit(12), F.lit(31)))
    out = years.join(have, [key, "year"], "left").withColumn("expected", days)
    return out.select(
        key,
        "year",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        "expected",
        F.coalesce("n_null", F.lit(0)).alias("n_null"),
        F.coalesce("n_null_season", F.lit(0)).alias("n_null_season"),
        F.greatest(F.col("expected") - F.coalesce("n_rows", F.lit(0)), F.lit(0)).alias("n_short"),
        F.col("n_rows").isNull().alias("missing"),
    )


def archive_health(df: DataFrame, keys: list[str], hour: str) -> DataFrame:
    """Hourly continuity: span, missing hours and the longest gap between distinct hours."""
    seen = df.select(*keys, hour).distinct()
    gap = F.lead(hour).over(W.partitionBy(*keys).orderBy(hour)) - F.col(hour)
    g = seen.withColumn("_gap", gap).groupBy(*keys).agg(
        (F.max(hour) - F.min(hour) + 1).alias("span_hours"),
        F.count(F.lit(1)).alias("_n"),
        F.coalesce(F.max("_gap") - 1, F.lit(0)).alias("longest_gap"),
    )
    return g.withColumn("missing_hours", F.col("span_hours") - F.col("_n")).drop("_n")


def quality_by_year(df: DataFrame, day: str, review: Column, impossible: Column) -> DataFrame:
    return df.groupBy(F.year(day).alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(review.cast("double")).alias("review_share"),
        F.avg(impossible.cast("double")).alias("impossible_share"),
    )


COLOURS = ("GREEN", "YELLOW", "RED")


def colour_counts(df: DataFrame, keys: list[str], colour: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_if(F.col(colour) == c).alias(f"n_{c.lower()}") for c in COLOURS])


def saturation_share(df: DataFrame, keys: list[str], colour: str) -> DataFrame:
    up = (F.col(colour) != "GREEN").cast("double")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_steps"), F.sum(up).cast("bigint").alias("n_elevated"), F.avg(up).alias("share"))


def pivot_mean(df: DataFrame, day: str, entity: str, value: str, entities: list, prefix: str) -> DataFrame:
    """Long to wide; the entity list is given, so no pass over the data finds it."""
    named = {e: f"{prefix}{e}" for e in entities}
    wide = df.groupBy(day).pivot(entity, entities).agg(F.avg(value))
    return wide.select(day, *[F.col(f"`{e}`").alias(n) for e, n in named.items()])


def reason_counts(df: DataFrame, reason: str) -> DataFrame:
    return df.filter(F.col(reason).isNotNull()).groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


def live_share(df: DataFrame, source: str, live: Column, at_least: float = 0.5) -> DataFrame:
    """Live points of each source; fails when under half are live."""
    g = df.groupBy(source).agg(F.count_if(live).alias("n_live"), F.count(F.lit(1)).alias("n_all"))
    share = ratio(F.col("n_live"), F.col("n_all"))
    return g.withColumn("share", share).withColumn("passes", F.coalesce(F.col("share") >= at_least, F.lit(False)))
