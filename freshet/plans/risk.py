"""Rule-based risk of places from rain and rivers: live, replayed, and what the replay shows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions import scalars as S
from freshet.operators.ranks import seasonal_shares
from freshet.operators.spatial import idw, nearest_k
from freshet.operators.windows import trailing_rank_every_day
from freshet.session import cut_lineage


def classify(
    places: DataFrame, rain: DataFrame, rivers: DataFrame, models: DataFrame, previous: DataFrame, now: str, pid: str = "pid", rid: str = "rid"
) -> DataFrame:
    """Risk of each place (id, lat, lon).

    ``rain``: (pid, plat, plon, h24, h48, next24, live); ``rivers``: (rid, rlat, rlon, share, basin,
    live); ``models``: (basin, p_elevated, p_extreme, degraded); ``previous``: (id, colour, since,
    honest). Rain is weighted from the two nearest points, discharge comes from the nearest river
    point, a live model of its basin overrides the rule. A place without live inputs keeps its
    last honest colour, marked stale, or is withheld.
    """
    spots = cut_lineage(places.select("lat", "lon").distinct())
    near = nearest_k(spots, rain.select(pid, "plat", "plon"), pid, k=2, distinct=True)
    signals = rain.select(pid, "h24", "h48", "next24", F.when(F.col("live"), 1.0).otherwise(0.0).alias("rain_live"))
    wet = idw(places, "id", near, signals, pid, ["h24", "h48", "next24", "rain_live"])
    river = nearest_k(spots, rivers.select(rid, "rlat", "rlon"), rid, k=1, to=("rlat", "rlon"), distinct=True)
    r = places.select("id", "lat", "lon").join(river, ["lat", "lon"]).join(rivers.select(rid, "share", "basin", "live"), rid)
    r = r.select("id", rid, F.col("km").alias("river_km"), "share", "basin", "live")
    m = models.select("basin", "p_elevated", "p_extreme", F.col("degraded").alias("_deg"))
    j = wet.join(r, "id").join(m, "basin", "left").join(previous, "id", "left")
    rain_s, dis_s = S.rain_score(F.col("h24"), F.col("h48")), S.discharge_score(F.col("share"))
    by_model = F.coalesce(~F.col("_deg"), F.lit(False))
    live = F.col("live") & (F.col("rain_live") > 0.999999)
    rule = S.risk_class(rain_s + dis_s)
    kept = F.coalesce(F.col("honest"), F.lit(False))
    colour = F.when(by_model, S.two_tier_colour(F.col("p_elevated"), F.col("p_extreme"))).when(live, rule).when(kept, F.col("colour"))
    method = F.when(by_model, "model").when(live, "rule").when(kept, "carried").otherwise("withheld")
    return j.select(
        "id",
        "h24",
        "h48",
        "next24",
        rid,
        "river_km",
        F.col("share").alias("discharge_share"),
        rain_s.alias("rain_score"),
        dis_s.alias("discharge_score"),
        colour.alias("risk"),
        method.alias("method"),
        F.when(method == "carried", F.col("since")).alias("stale_since"),
        F.when(method == "carried", F.lit(now)).alias("checked_at"),
    )


def replay_shares(near: DataFrame, history: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """(key, day, value, share, baseline) for every calendar day of ``near``; a missing day repeats the latest prior one.

    The share is the seasonal one (the history's values within 15 days of the year at or below the day's value)
    where the history has 60 values, else the one in the trailing 30 days: ``baseline`` tells which.
    """
    trailing = cut_lineage(trailing_rank_every_day(near, key, day, value))
    seasonal = seasonal_shares(history, trailing, key, day, value).select(key, day, F.col("share").alias("_seasonal"))
    both = trailing.join(seasonal, [key, day], "left")
    baseline = F.when(F.col("_seasonal").isNotNull(), "seasonal").when(F.col("share").isNotNull(), "trailing")
    return both.select(key, day, value, F.coalesce("_seasonal", "share").alias("share"), baseline.alias("baseline"))


def replay(
    places: DataFrame, rain_points: DataFrame, sums: DataFrame, river_points: DataFrame, shares: DataFrame, step_day, pid="pid", rid="rid", rounded: bool = False
) -> DataFrame:
    """The rule at every step of a past window.

    ``sums``: (pid, step, sum_24h, sum_48h); ``shares``: (rid, day, share, ...), whose other columns are passed on. Work is per distinct
    place coordinate, spread to the places at the end. ``step_day`` maps a step column to its day. ``rounded``
    scores sums of 0.1 mm and shares of three digits, as they are published.
    """
    digits = (lambda c, n: F.round(c, n)) if rounded else (lambda c, n: c)
    spots = cut_lineage(places.select("lat", "lon").distinct())
    near = nearest_k(spots, rain_points, pid, k=2, distinct=True)
    w = F.lit(1.0) / F.greatest(F.col("km"), F.lit(1.0))
    mean = lambda c: digits(F.sum(F.col("_w") * digits(F.col(c), 1)) / F.sum("_w"), 1)
    wet = near.withColumn("_w", w).join(sums, pid).groupBy("lat", "lon", "step").agg(mean("sum_24h").alias("rain24"), mean("sum_48h").alias("rain48"))
    river = nearest_k(spots, river_points, rid, k=1, to=("rlat", "rlon"), distinct=True).select("lat", "lon", rid)
    kept = [c for c in shares.columns if c not in (rid, "day", "share")]
    used = shares.withColumn("share", digits(F.col("share"), 3))
    j = wet.withColumn("day", step_day(F.col("step"))).join(river, ["lat", "lon"]).join(used, [rid, "day"])
    total = S.rain_score(F.col("rain24"), F.col("rain48")) + S.discharge_score(F.col("share"))
    scored = j.select("lat", "lon", "step", "rain24", "rain48", "share", *kept, S.risk_class(total).alias("risk"))
    return places.select("id", "lat", "lon").join(scored, ["lat", "lon"]).drop("lat", "lon")


def finding(df: DataFrame, kind: str, entity: str, at: str, value) -> DataFrame:
    """Rows of one kind of finding in the common form (kind, entity, at, value)."""
    return df.select(
        F.lit(kind).alias("kind"), F.col(entity).cast("string").alias("entity"), F.col(at).cast("string").alias("at"), value.cast("double").alias("value")
    ).filter("at IS NOT NULL")


def compare_rules(frozen: DataFrame, now: DataFrame, key: str, metric: str) -> DataFrame:
    """Frozen metrics of the old rule against the new run; lower is better."""
    j = frozen.select(key, F.col(metric).alias("was")).join(now.select(key, F.col(metric).alias("now")), key, "left")
    verdict = F.when(F.col("now").isNull(), "no result").when(F.col("now") < F.col("was"), "reduced").otherwise("not reduced")
    return j.withColumn("verdict", verdict)
