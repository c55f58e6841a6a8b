"""How many days rain leads discharge: cross-correlation, stability, and an event study."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from freshet.operators import aggregates as A
from freshet.operators.joins import changes
from freshet.operators.windows import peak_after, separated_top

MAX_LAG = 5


def lag_pairs(rain: DataFrame, q: DataFrame, windows: list[str]) -> DataFrame:
    """Rain at d with discharge and its change at row d + lag of the discharge series, lags 0..5.

    ``rain``: (basin, d, windows...), ``q``: (basin, d, q). One row per (basin, d, window, lag).
    """
    w = W.partitionBy("basin").orderBy("d")
    s = changes(q.select("basin", "d", "q"), "basin", "d", "q", "dq")
    ahead = F.array(*[F.struct(F.lit(k).alias("lag"), F.lead("q", k).over(w).alias("q"), F.lead("dq", k).over(w).alias("dq")) for k in range(MAX_LAG + 1)])
    s = s.select("basin", "d", ahead.alias("_a"))
    both = rain.select("basin", "d", F.array(*[F.struct(F.lit(c).alias("win"), F.col(c).alias("r")) for c in windows]).alias("_w"))
    rows = both.join(s, ["basin", "d"]).select("basin", "d", F.inline("_w"), "_a").select("basin", "d", "win", "r", F.inline("_a"))
    return rows.dropna(subset=["r", "q", "dq"])


def cross_correlation(pairs: DataFrame) -> DataFrame:
    """Correlation of rain with discharge and its change per lag, for the season and the whole year."""
    scoped = pairs.withColumn("season", F.explode(F.when(A.in_season("d"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))))
    return scoped.groupBy("basin", "win", "season", "lag").agg(
        A.varied_corr(F.col("r"), F.col("q")).alias("r_q"), A.varied_corr(F.col("r"), F.col("dq")).alias("r_dq"), F.count(F.lit(1)).alias("n")
    )


def best_lag(table: DataFrame, keys: list[str], score: str, out: str) -> DataFrame:
    """Lag of the highest correlation, smallest on ties."""
    return table.filter(F.col(score).isNotNull() & ~F.isnan(score)).groupBy(*keys).agg(
        F.min_by("lag", F.struct((-F.col(score)).alias("s"), F.col("lag").alias("l"))).alias(out)
    )


def leave_one_year_out(pairs: DataFrame, score: str = "dq") -> DataFrame:
    """Best seasonal lag with each year left out in turn.

    Moments are summed per year once; leaving a year out subtracts its moments from the total, so
    the pairs are read once however many years there are.
    """
    x, y = F.col("r"), F.col(score)
    m = {"n": F.lit(1.0), "x": x, "y": y, "xx": x * x, "yy": y * y, "xy": x * y}
    yearly = pairs.filter(A.in_season("d")).groupBy("basin", "win", "lag", F.year("d").alias("left_out")).agg(
        *[F.sum(c).alias(k) for k, c in m.items()]
    )
    # every (basin, window) year is left out at every lag, also where a lag lost that year's rows
    w = W.partitionBy("basin", "win", "lag")
    rest = {k: F.sum(k).over(w) - F.col(k) for k in m}
    r = yearly.select("basin", "win", "lag", "left_out", *[c.alias(k) for k, c in rest.items()])
    cov = F.col("n") * F.col("xy") - F.col("x") * F.col("y")
    var = (F.col("n") * F.col("xx") - F.col("x") * F.col("x")) * (F.col("n") * F.col("yy") - F.col("y") * F.col("y"))
    r = r.withColumn("corr", F.when(var > 0, cov / F.sqrt(var)))
    return best_lag(r, ["basin", "win", "left_out"], "corr", "best_lag")


def event_lags(q: DataFrame, rain: DataFrame, rain_column: str, top: int = 10, back: int = 5) -> DataFrame:
    """Largest separated rises, the peak after each, the heaviest rain day before it, and the lag in days."""
    s = changes(q.select("basin", "d", "q"), "basin", "d", "q", "rise")
    picked = separated_top(s, "basin", "d", "rise", top)
    peaks = picked.join(peak_after(q.select("basin", "d", "q"), "basin", "d", "q"), ["basin", "d"])
    days = peaks.select("basin", "pick", "d", "peak_day", "peak", "before", "rise", F.explode(F.sequence(F.col("peak_day") - back, F.col("peak_day"))).alias("_d"))
    near = days.join(rain.select("basin", F.col("d").alias("_d"), F.col(rain_column).alias("_r")).filter("_r IS NOT NULL"), ["basin", "_d"], "left")
    spike = near.groupBy("basin", "pick", "d", "peak_day", "peak", "before", "rise").agg(
        F.max("_r").alias("spike"), F.min_by("_d", F.when(F.col("_r").isNotNull(), F.struct((-F.col("_r")).alias("v"), F.col("_d").alias("t")))).alias("spike_day")
    )
    return spike.withColumn("lag_days", F.datediff("peak_day", "spike_day"))


def event_study(lags: DataFrame) -> DataFrame:
    lag: Column = F.col("lag_days")
    return lags.groupBy("basin").agg(
        F.count("lag_days").alias("n_events"),
        F.percentile("lag_days", F.lit(0.5)).alias("median_lag"),
        F.min(lag).alias("min_lag"),
        F.max(lag).alias("max_lag"),
        F.count_if(lag == 0).alias("n_same_day"),
        F.count_if(lag == 1).alias("n_next_day"),
    )
