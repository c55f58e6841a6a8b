"""Quality screens and gates over readings and series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions import scalars as S
from freshet.operators.chunks import DAY_SECONDS, previous_reading

# fixed values: limits of the gauge screens
MIN_READINGS = 1000
GARBAGE_MM = 1000.0
CUMULATIVE_SHARE = 0.95
SPARSE_PER_DAY = 12
SPIKE_MM = 150.0
DENSE_READINGS, COUNTER_READINGS = 20, 4


def range_reason(v: Column, cap: float = SPIKE_MM, absurd: float = 1e6) -> Column:
    """Why a reading is out of range, or null."""
    return F.when(v < 0, "negative").when(v >= absurd, "absurd").when(v > cap, "over cap")


def station_days(readings: DataFrame, key: str, ts: str, tie: str, value: str, width: int = DAY_SECONDS) -> DataFrame:
    """One row per station and day with all that modes and daily totals need, in one pass.

    Steps between valid readings come from the chunked lag, so a busy station is spread over
    tasks; what follows works on station days.
    """
    v = readings.withColumn("_v", F.when(F.col(value) >= 0, F.col(value)))
    steps = previous_reading(v, key, ts, tie, "_v", "_prev", width)
    step = F.when(F.col("_v").isNotNull(), F.col("_v") - F.col("_prev"))
    rise = F.when(step.isNotNull(), F.greatest(step, F.lit(0.0)))
    calm = F.col("_v") <= SPIKE_MM
    return steps.groupBy(key, F.col(ts).cast("date").alias("d")).agg(
        F.count("_v").alias("n_valid"),
        F.max("_v").alias("max_value"),
        F.count(step).alias("n_steps"),
        F.count_if(step >= 0).alias("n_up"),
        F.sum(F.when(calm, F.col("_v"))).alias("total"),
        F.count_if(calm).alias("n"),
        F.sum(F.when(rise <= SPIKE_MM, rise)).alias("counter_total"),
        F.count_if(rise <= SPIKE_MM).alias("counter_n"),
    )


def sensor_modes(days: DataFrame, key: str, min_rows: int = MIN_READINGS) -> DataFrame:
    """Per station: mode (incremental or cumulative) or the reason it is excluded, tested in order."""
    s = days.groupBy(key).agg(
        F.sum("n_valid").alias("n_readings"),
        F.max("max_value").alias("max_value"),
        (F.sum("n_up") / F.nullif(F.sum("n_steps"), F.lit(0))).alias("nondecreasing"),
        F.percentile(F.when(F.col("n_valid") > 0, F.col("n_valid")), F.lit(0.5)).alias("per_day"),
    )
    counter = F.col("nondecreasing") >= CUMULATIVE_SHARE
    excluded = (
        F.when(F.col("n_readings") < min_rows, "too few valid readings")
        .when(F.col("max_value") > GARBAGE_MM, "implausible extremes")
        .when(counter, F.lit(None).cast("string"))
        .when(F.col("per_day") < SPARSE_PER_DAY, "sparse incremental reporting")
    )
    mode = F.when(F.col("excluded").isNull(), F.when(counter, "cumulative").otherwise("incremental"))
    return s.withColumn("excluded", excluded).withColumn("mode", mode)


def gauge_daily(days: DataFrame, modes: DataFrame, key: str) -> DataFrame:
    """Daily totals of usable stations on densely reported days.

    A counter's total is the sum of its positive steps, exact even when sparse; an incremental
    sensor needs a full day, else an outage looks like a dry spell.
    """
    counter = F.col("mode") == "cumulative"
    j = days.join(modes.filter(F.col("mode").isNotNull()).select(key, "mode"), key)
    out = j.select(
        key,
        "mode",
        "d",
        F.when(counter, F.col("counter_total")).otherwise(F.col("total")).alias("total"),
        F.when(counter, F.col("counter_n")).otherwise(F.col("n")).alias("n"),
    )
    return out.filter(F.col("n") >= F.when(counter, COUNTER_READINGS).otherwise(DENSE_READINGS))


def robust_band(df: DataFrame, key: str, value: str, min_range: float = 0.5) -> DataFrame:
    """Values within half a p2..p98 range of that range, scaled to 0..1; constant entities dropped."""
    p = df.groupBy(key).agg(F.percentile(value, F.array(F.lit(0.02), F.lit(0.98))).alias("_p"))
    lo, hi = F.col("_p")[0], F.col("_p")[1]
    span = hi - lo
    v = F.col(value)
    near = (span >= min_range) & (v >= lo - span * 0.5) & (v <= hi + span * 0.5)
    norm = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (v - lo) / span))
    return df.join(p, key).filter(near).withColumn("norm", norm).drop("_p")


def eligible(data: DataFrame, sidecars: DataFrame, key: str, min_rows: int = 2000) -> DataFrame:
    """Data of stations with a trusted coordinate and enough rows."""
    ok = sidecars.filter(F.col("note").isNull() & (F.col("n_rows") >= min_rows)).select(key)
    return data.join(ok, key, "left_semi")


def without_simulated(df: DataFrame, cls: str) -> DataFrame:
    return df.filter(F.col(cls).isin(S.OBSERVED, S.FORECAST))
