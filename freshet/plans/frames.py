"""The daily modelling frame, its features, and small composed summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from freshet.functions import scalars as S
from freshet.operators.joins import changes
from freshet.operators.windows import full_window_sum, rolling_day_sums


def daily_frame(rain: DataFrame, q: DataFrame, upstream: DataFrame | None = None) -> DataFrame:
    """Rain windows, discharge and upstream discharge on the days of the rain series.

    ``rain``: (basin, d, rain_24h); ``q`` and ``upstream``: (basin, d, q). Upstream changes are
    taken on the upstream's own days, before alignment.
    """
    w = W.partitionBy("basin").orderBy("d")
    frame = rolling_day_sums(rain.withColumn("rain_48h", full_window_sum("rain_24h", w, 2)), ["basin"], "d", "rain_24h")
    frame = frame.join(q.select("basin", "d", "q"), ["basin", "d"], "left")
    if upstream is None:
        return frame
    up = changes(upstream, "basin", "d", "q", "dqup").select("basin", "d", F.col("q").alias("qup"), "dqup")
    return frame.join(up, ["basin", "d"], "left")


RAIN_COLUMNS = ["rain_24h", "rain_48h", "rain_14d", "rain_30d"]
HORIZONS = (1, 2)


def feature_frame(daily: DataFrame) -> DataFrame:
    """Features known at day d and the targets y_h1, y_h2; all shifts are by row of the frame."""
    w = W.partitionBy("basin").orderBy("d")
    q = F.col("q")
    lag = lambda c, n: F.lag(c, n).over(w)
    extra = [c for c in daily.columns if c.startswith(("qup", "dqup"))]
    return daily.select(
        "basin",
        "d",
        "q",
        lag("q", 1).alias("q_lag1"),
        lag("q", 2).alias("q_lag2"),
        (q - lag("q", 1)).alias("dq"),
        (lag("q", 1) - lag("q", 2)).alias("dq_lag1"),
        (F.lit(100.0) * (q - lag("q", 2)) / F.nullif(lag("q", 2), F.lit(0.0))).alias("trend48_pct"),
        *RAIN_COLUMNS,
        lag("rain_24h", 1).alias("rain_24h_lag1"),
        S.day_harmonic(F.col("d"), "sin").alias("doy_sin"),
        S.day_harmonic(F.col("d"), "cos").alias("doy_cos"),
        *extra,
        *[F.lead("q", h).over(w).alias(f"y_h{h}") for h in HORIZONS],
    )


def feature_columns(f: DataFrame) -> list[str]:
    return [c for c in f.columns if c not in ("basin", "d") and not c.startswith("y_h")]


def leakage_rows(daily: DataFrame, probe: Column, make=feature_frame, keys=("basin", "d")) -> DataFrame:
    """Rows at or before the probe day whose features move when everything after it is corrupted.

    The corruption is a hash of the row, so both runs of the features are reproducible.
    """
    values = [c for c in daily.columns if c not in keys]
    noise = {
        c: F.when(F.col("d") > probe, F.pmod(F.xxhash64(*keys, F.lit(c)), F.lit(1_000_000)).cast("double")).otherwise(F.col(c))
        for c in values
    }
    clean, dirty = make(daily), make(daily.withColumns(noise))
    cols = feature_columns(clean)
    a = clean.filter(F.col("d") <= probe)
    b = dirty.filter(F.col("d") <= probe).select(*keys, *[F.col(c).alias(f"_{c}") for c in cols])
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cols])
    return a.join(b, list(keys), "full").filter(~same).select(*keys)


def extent_summary(states: DataFrame, events: DataFrame, places: DataFrame, event: str) -> DataFrame:
    """Places in water, observed dry and outside the observed box, per event."""
    n = F.count("in_water")
    seen = events.join(states, event, "left").groupBy(event).agg(
        F.count_if(F.col("in_water")).alias("n_in_water"), F.count_if(~F.col("in_water")).alias("n_observed_dry"), n.alias("_n")
    )
    total = places.agg(F.count(F.lit(1)).alias("_all"))
    return seen.withColumn("_all", total.scalar()).select(
        event, "n_in_water", "n_observed_dry", (F.col("_all") - F.col("_n")).alias("n_outside")
    )
