"""Window operators over regular series.

Series here are at hourly or daily grain, so a key's window is bounded by the calendar, not by
the data (8,784 rows per point-year). Anything over raw readings goes through ``chunks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from freshet.functions import scalars as S
from freshet.operators.chunks import DAY_SECONDS, previous_reading

DAY_EPOCH = "1970-01-01"


def day_number(d: str | Column) -> Column:
    """Days since 1970 as an integer, for range frames over dates."""
    return F.datediff(F.col(d) if isinstance(d, str) else d, F.lit(DAY_EPOCH).cast("date"))


def densify(df: DataFrame, keys: list[str], step: str, value: str, fill: float | None = None) -> DataFrame:
    """Every integer step between a key's first and last, missing values null or ``fill``."""
    span = df.groupBy(*keys).agg(F.min(step).alias("_lo"), F.max(step).alias("_hi"))
    grid = span.select(*keys, F.explode(F.sequence("_lo", "_hi")).alias(step))
    full = grid.join(df.select(*keys, step, value), [*keys, step], "left")
    return full if fill is None else full.withColumn(value, F.coalesce(value, F.lit(fill)))


def full_window_sum(value: str, window, n: int, at_least: int | None = None) -> Column:
    """Sum over the last ``n`` rows, null unless enough of them have a value."""
    w = window.rowsBetween(-(n - 1), 0)
    return F.when(F.count(value).over(w) >= (n if at_least is None else at_least), F.sum(value).over(w))


def rolling_hour_sums(df: DataFrame, keys: list[str], hour: str, value: str, windows=(6, 12, 24, 48)) -> DataFrame:
    """Sums of the last w hours at the end of each day: the day's last non-null window."""
    dense = densify(df, keys, hour, value)
    w = W.partitionBy(*keys).orderBy(hour)
    rolled = dense.select(*keys, hour, *[full_window_sum(value, w, n).alias(f"rain_{n}h") for n in windows])
    last = [
        F.max_by(f"rain_{n}h", F.when(F.col(f"rain_{n}h").isNotNull(), F.col(hour))).alias(f"rain_{n}h")
        for n in windows
    ]
    return rolled.groupBy(*keys, F.floor(F.col(hour) / 24).alias("day")).agg(*last)


def rolling_day_sums(df: DataFrame, keys: list[str], day: str, value: str) -> DataFrame:
    """14-day (10 or more) and 30-day (21 or more) sums by row of the frame."""
    w = W.partitionBy(*keys).orderBy(day)
    return df.withColumn("rain_14d", full_window_sum(value, w, 14, 10)).withColumn(
        "rain_30d", full_window_sum(value, w, 30, 21)
    )


def trailing_window_at(
    series: DataFrame, at: DataFrame, key: str, step: str, value: str, hours: tuple[int, ...] = (24, 48)
) -> DataFrame:
    """Sum over (t - H, t] at arbitrary times t of ``at``; 0 where nothing fell."""
    both = series.select(key, step, value, F.lit(False).alias("_ask")).unionByName(
        at.select(key, step, F.lit(None).cast("double").alias(value), F.lit(True).alias("_ask"))
    )
    w = W.partitionBy(key).orderBy(step)
    sums = [F.coalesce(F.sum(value).over(w.rangeBetween(-(n - 1), 0)), F.lit(0.0)).alias(f"sum_{n}h") for n in hours]
    return both.select(key, step, "_ask", *sums).filter("_ask").drop("_ask")


def trailing_n_rows(df: DataFrame, key: str, step: str, value: str, now: int, n: int) -> DataFrame:
    """Sum of the last n rows up to now and of the first n rows after it."""
    past = F.col(step) <= now
    w = W.partitionBy(key, "_past").orderBy(F.when(F.col("_past"), -F.col(step)).otherwise(F.col(step)))
    ranked = df.withColumn("_past", past).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    return ranked.groupBy(key).agg(
        F.coalesce(F.sum(F.when(F.col("_past"), F.col(value))), F.lit(0.0)).alias("observed_sum"),
        F.coalesce(F.sum(F.when(~F.col("_past"), F.col(value))), F.lit(0.0)).alias("forecast_sum"),
    )


def trailing_rank(df: DataFrame, key: str, day: str, value: str, days: int = 30) -> DataFrame:
    """Share of the trailing ``days`` days' values that are at or below the row's own value."""
    w = W.partitionBy(key).orderBy(day_number(day)).rangeBetween(-(days - 1), 0)
    seen = F.collect_list(value).over(w)
    share = F.size(F.filter(F.col("_seen"), lambda v: v <= F.col(value))) / F.size("_seen")
    return df.withColumn("_seen", seen).withColumn("share", F.when(F.col(value).isNotNull(), share)).drop("_seen")


def trailing_rank_every_day(df: DataFrame, key: str, day: str, value: str, days: int = 30) -> DataFrame:
    """As ``trailing_rank`` for every calendar day; a missing day repeats the latest prior one."""
    ranked = trailing_rank(df, key, day, value, days)
    span = df.groupBy(key).agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    grid = span.select(key, F.explode(F.sequence("_lo", "_hi")).alias(day))
    w = W.partitionBy(key).orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    held = F.struct(F.col(value), F.col("share"))
    full = grid.join(ranked, [key, day], "left").withColumn(
        "_held", F.last(F.when(F.col("share").isNotNull(), held), ignorenulls=True).over(w)
    )
    return full.select(key, day, F.col(f"_held.{value}").alias(value), F.col("_held.share").alias("share"))


def latest_rows_stats(df: DataFrame, key: str, day: str, value: str, n: int = 30) -> DataFrame:
    """Over a key's last n rows: latest value and day, its rank share, range, and the 2-step trend."""
    w = W.partitionBy(key).orderBy(F.col(day).desc())
    last = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    latest = F.max(F.when(F.col("_rn") == 1, F.col(value))).over(W.partitionBy(key))
    stats = (
        last.withColumn("_latest", latest)
        .groupBy(key)
        .agg(
            F.max(day).alias("latest_day"),
            F.max("_latest").alias("latest"),
            F.avg((F.col(value) <= F.col("_latest")).cast("double")).alias("share"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
            F.count(F.lit(1)).alias("n_days"),
            F.max(F.when(F.col("_rn") == 3, F.col(value))).alias("before"),
        )
    )
    pct = S.trend_pct(F.col("latest"), F.col("before"))
    return stats.withColumn("trend_pct", pct).withColumn("trend", S.trend_word(F.col("trend_pct")))


def runs_above(df: DataFrame, keys: list[str], order: str, value: str, threshold: Column) -> DataFrame:
    """Contiguous rows at or above the threshold as (onset, end, peak, rows); null ends a run."""
    above = F.coalesce(F.col(value) >= threshold, F.lit(False))
    w = W.partitionBy(*keys).orderBy(order)
    marked = df.withColumn("_above", above).withColumn(
        "_run", F.sum(F.when(F.col("_above"), 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, 0))
    )
    return (
        marked.filter("_above")
        .groupBy(*keys, "_run")
        .agg(
            F.min(order).alias("onset"),
            F.max(order).alias("end"),
            F.max(value).alias("peak"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .drop("_run")
    )


def separated_top(df: DataFrame, key: str, day: str, rise: str, top: int = 10, apart: int = 7) -> DataFrame:
    """Largest rises of a key, greedily, none closer than ``apart`` days to one already taken.

    A pick excludes at most 2*(apart-1) other days, so the last pick lies within the first
    (top-1)*(2*apart-1)+1 rows by size: only those are gathered, and the fold over them is exact.
    """
    reach = (top - 1) * (2 * apart - 1) + 1
    w = W.partitionBy(key).orderBy(F.col(rise).desc(), F.col(day))
    near = df.filter(F.col(rise).isNotNull()).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= reach)
    item = F.struct(F.col("_rn").alias("rn"), day_number(day).alias("n"), F.col(rise).alias("rise"))
    ordered = near.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("_all"))
    kind = "array<struct<rn:int,n:int,rise:double>>"
    chosen = F.aggregate(
        F.col("_all").cast(kind),
        F.array().cast(kind),
        lambda acc, x: F.when(
            (F.size(acc) < top) & ~F.exists(acc, lambda a: F.abs(a["n"] - x["n"]) < apart),
            F.concat(acc, F.array(x)),
        ).otherwise(acc),
    )
    picked = ordered.select(key, F.posexplode(chosen).alias("_pos", "_x"))
    return picked.select(
        key,
        (F.col("_pos") + 1).alias("pick"),
        F.date_add(F.lit(DAY_EPOCH).cast("date"), F.col("_x.n")).alias(day),
        F.col("_x.rise").alias(rise),
    )


def peak_after(df: DataFrame, key: str, day: str, value: str, days: int = 4) -> DataFrame:
    """Highest value (earliest on ties) in [d, d+days] and the value of the calendar day before."""
    w = W.partitionBy(key).orderBy(day_number(day))
    top = F.max(F.struct(F.col(value).alias("v"), (-day_number(day)).alias("n"))).over(w.rangeBetween(0, days))
    out = df.withColumn("_top", top).withColumn("before", F.max(value).over(w.rangeBetween(-1, -1)))
    return out.withColumn("peak", F.col("_top.v")).withColumn(
        "peak_day", F.date_add(F.lit(DAY_EPOCH).cast("date"), -F.col("_top.n"))
    ).drop("_top")


def spike_before(rolled: DataFrame, peaks: DataFrame, key: str, hour: str, value: str, days: int = 5) -> DataFrame:
    """Highest rolling sum (earliest on ties) in [peak day - days, end of the peak day].

    ``rolled`` has one row per (key, hour); ``peaks`` one per (key, peak_day). The window is
    unrolled to whole days, so this is an equi-join.
    """
    days_back = F.explode(F.sequence(F.col("peak_day") - days, F.col("peak_day"))).alias("_day")
    asked = peaks.select(key, "peak_day", days_back)
    hours = rolled.filter(F.col(value).isNotNull()).withColumn("_day", F.floor(F.col(hour) / 24))
    return asked.join(hours, [key, "_day"]).groupBy(key, "peak_day").agg(
        F.max_by(hour, F.struct(F.col(value), -F.col(hour))).alias("spike_hour"),
        F.max(value).alias("spike"),
    )


def record_spikes(df: DataFrame, key: str, hour: str, value: str, start: int, floor_mm: float = 30.0) -> DataFrame:
    """First hour whose 24 h sum beats every 24 h sum of the 30 days before, and each key's peak."""
    w = W.partitionBy(key).orderBy(hour)
    base = w.rangeBetween(-719, -24)
    s = (
        df.withColumn("mm24", F.sum(value).over(w.rangeBetween(-23, 0)))
        .withColumn("prev_max", F.max("mm24").over(base))
        .withColumn("prev_mean", F.avg("mm24").over(base))
    )
    hit = (F.col(hour) >= start) & (F.col("mm24") > F.col("prev_max")) & (F.col("mm24") >= floor_mm)
    first = F.min_by(F.struct(hour, "mm24", "prev_max", "prev_mean"), F.when(hit, F.col(hour)))
    out = s.groupBy(key).agg(
        first.alias("_f"), F.max_by(hour, F.struct(F.col("mm24"), -F.col(hour))).alias("peak_hour"), F.max("mm24").alias("peak_mm24")
    )
    return out.select(
        key,
        F.col(f"_f.{hour}").alias("spike_hour"),
        F.col("_f.mm24").alias("spike_mm24"),
        F.col("_f.prev_max").alias("prev_max"),
        F.col("_f.prev_mean").alias("prev_mean"),
        "peak_hour",
        "peak_mm24",
    )


def first_crossing(df: DataFrame, key: str, order: str, value: str, threshold: Column) -> DataFrame:
    """First row at or above the threshold per key."""
    return (
        df.filter(F.col(value) >= threshold)
        .groupBy(key)
        .agg(F.min(order).alias("first_at"), F.min_by(value, order).alias("first_value"))
    )


def biggest_jump(df: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Largest percent rise over the calendar day before, both days present and the base positive."""
    w = W.partitionBy(key).orderBy(day_number(day)).rangeBetween(-1, -1)
    s = df.withColumn("_was", F.max(value).over(w)).filter(F.col("_was") > 0)
    s = s.withColumn("_pct", S.trend_pct(F.col(value), F.col("_was")))
    best = F.max_by(F.struct(day, "_was", value, "_pct"), F.struct(F.col("_pct"), -day_number(day))).alias("_b")
    return s.groupBy(key).agg(best).select(
        key,
        F.col(f"_b.{day}").alias("jump_day"),
        F.col("_b._was").alias("jump_from"),
        F.col(f"_b.{value}").alias("jump_to"),
        F.col("_b._pct").alias("jump_pct"),
    )


def state_transitions(df: DataFrame, key: str, step: str, state: str, lo: int, hi: int) -> DataFrame:
    """First elevated and first RED step, first GREEN-to-elevated step in [lo, hi], REDs inside it."""
    was = F.lag(state).over(W.partitionBy(key).orderBy(step))
    inside = F.col(step).between(lo, hi)
    up = df.withColumn("_was", was)
    t = F.col(step)
    return (
        up.groupBy(key)
        .agg(
            F.min(step).alias("first_step"),
            F.min(F.when(F.col(state) != "GREEN", t)).alias("first_elevated"),
            F.min(F.when(F.col(state) == "RED", t)).alias("first_red"),
            F.min(F.when(inside & (F.col("_was") == "GREEN") & (F.col(state) != "GREEN"), t)).alias("re_elevated"),
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.when(inside & (F.col(state) == "RED"), t))), lambda x: x.cast("string")
                ),
                ",",
            ).alias("red_steps"),
        )
        .withColumn("already_at_start", F.coalesce(F.col("first_elevated") == F.col("first_step"), F.lit(False)))
        .drop("first_step")
    )


def quietest_week(totals: DataFrame, scope: str, day: str, total: str) -> DataFrame:
    """Seven consecutive entries with the least total (earliest wins), per scope."""
    w = W.partitionBy(scope).orderBy(day).rowsBetween(0, 6)
    s = totals.select(
        scope,
        F.col(day).alias("start_day"),
        F.max(day).over(w).alias("end_day"),
        F.sum(total).over(w).alias("week_total"),
        F.count(F.lit(1)).over(w).alias("_n"),
    ).filter("_n = 7")
    best = F.min_by(F.struct("start_day", "end_day", "week_total"), F.struct("week_total", "start_day")).alias("_b")
    return s.groupBy(scope).agg(best).select(scope, "_b.*")


def counter_increments(
    readings: DataFrame, key: str, ts: str, tie: str, value: str, cap: float = 150.0, width: int = DAY_SECONDS
) -> DataFrame:
    """Steps of a cumulative counter: resets become 0, the first reading and jumps over cap go."""
    p = previous_reading(readings, key, ts, tie, value, "_prev", width)
    return p.withColumn("increment", F.when(F.col("_prev").isNotNull(), F.greatest(F.col(value) - F.col("_prev"), F.lit(0.0)))).filter(
        F.col("increment") <= cap
    ).drop("_prev")


def row_lags(df: DataFrame, key: str, order: str, value: str, prefix: str) -> DataFrame:
    """Value, lags 1/3/4 and changes by report row (not by calendar)."""
    w = W.partitionBy(key).orderBy(order)
    v = F.col(value)
    return df.select(
        key,
        order,
        v.alias(prefix),
        F.lag(v, 1).over(w).alias(f"{prefix}_lag1"),
        (v - F.lag(v, 1).over(w)).alias(f"{prefix}_chg"),
        F.lag(v, 3).over(w).alias(f"{prefix}_lag3"),
        F.lag(v, 4).over(w).alias(f"{prefix}_lag4"),
        (F.lag(v, 3).over(w) - F.lag(v, 4).over(w)).alias(f"{prefix}_chg_lag3"),
    )


def event_leads(df: DataFrame, keys: list[str], day: str, actual: str, pred: str, threshold: str, horizon: str) -> DataFrame:
    """One row per exceedance event: onset, end and lead of its first alarmed day.

    An onset is an exceedance row whose previous row is not one; the event then runs on by
    calendar day. An exceedance after a missing day, following another one, starts no event.
    """
    over = F.coalesce(F.col(actual) >= F.col(threshold), F.lit(False))
    w = W.partitionBy(*keys).orderBy(day)
    rows = df.withColumn("_ex", over).withColumn("_onset", F.col("_ex") & ~F.coalesce(F.lag("_ex").over(w), F.lit(False)))
    rows = rows.filter("_ex").withColumn("_island", day_number(day) - F.row_number().over(w))
    alarm = F.when(F.col(pred) >= F.col(threshold), F.col(day))
    return (
        rows.groupBy(*keys, "_island")
        .agg(
            F.min(day).alias("onset"),
            F.max(day).alias("end"),
            F.min_by("_onset", day).alias("_starts"),
            F.min(alarm).alias("_alarm"),
            F.max(actual).alias("peak"),
            F.first(horizon).alias("_h"),
        )
        .filter("_starts")
        .withColumn("lead_days", F.datediff("onset", "_alarm") + F.col("_h"))
        .drop("_island", "_starts", "_alarm", "_h")
    )
