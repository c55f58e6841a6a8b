"""Walk-forward folds, baseline rules and the rule that decides what ships.

All basins, folds and horizons are one plan: a fold is a row of a small array exploded per
input row, never a loop over jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from freshet.operators import aggregates as A
from freshet.operators.windows import event_leads
from freshet.plans.frames import HORIZONS


def train_rows(df: DataFrame, day: str, val_years: list[int]) -> DataFrame:
    """Each row once per fold it trains: folds validating a later year."""
    years = F.filter(F.array(*[F.lit(y) for y in val_years]), lambda y: y > F.year(day))
    return df.withColumn("val_year", F.explode(years))


def validation_rows(df: DataFrame, day: str, val_years: list[int]) -> DataFrame:
    """Season rows of the validation years."""
    return df.filter(F.year(day).isin(val_years) & A.in_season(day)).withColumn("val_year", F.year(day))


def fold_quantiles(df: DataFrame, keys: list[str], day: str, value: str, val_years: list[int], p: float = 0.9, out: str = "thr") -> DataFrame:
    train = train_rows(df.filter(A.in_season(day) & F.col(value).isNotNull()), day, val_years)
    return train.groupBy(*keys, "val_year").agg(F.percentile(value, F.lit(p)).alias(out))


def rain_for(h: Column) -> Column:
    """Rain known when predicting h days ahead."""
    return F.when(h == 1, F.col("rain_24h")).otherwise(F.col("rain_48h"))


def fold_slopes(frame: DataFrame, val_years: list[int], rain: dict[int, str] | None = None) -> DataFrame:
    """Slope through 0 of the coming h-day change on rain, over training seasons: (basin, val_year, h).

    The change is between rows of the training seasons, so a season's last rows look into the
    next season unless that one is not in training.
    """
    rain = rain or {1: "rain_24h", 2: "rain_48h"}
    season = frame.filter(A.in_season("d"))
    w = W.partitionBy("basin").orderBy("d")
    per_h = F.array(
        *[
            F.struct(
                F.lit(h).alias("h"), F.col(c).alias("x"), (F.lead("q", h).over(w) - F.col("q")).alias("y"), F.lead("d", h).over(w).alias("until")
            )
            for h, c in rain.items()
        ]
    )
    rows = train_rows(season.select("basin", "d", per_h.alias("_p")), "d", val_years)
    rows = rows.select("basin", "val_year", F.inline("_p"))
    y = F.when(F.year("until") < F.col("val_year"), F.col("y"))
    return rows.groupBy("basin", "val_year", "h").agg(A.origin_slope(F.col("x"), y).alias("slope"))


def climatology(frame: DataFrame, val_years: list[int], k: int = 7) -> DataFrame:
    return A.doy_climatology(train_rows(frame.select("basin", "d", "q"), "d", val_years), ["basin", "val_year"], "d", "q", k)


def predictions(frame: DataFrame, val_years: list[int]) -> DataFrame:
    """Persistence, climatology and lag rule for every day of the validation seasons.

    One row per (basin, d, h, candidate): actual, pred, pers.
    """
    w = W.partitionBy("basin").orderBy("d")
    per_h = F.array(
        *[
            F.struct(
                F.lit(h).alias("h"),
                F.lag("q", h).over(w).alias("pers"),
                F.lag("rain_24h" if h == 1 else "rain_48h", h).over(w).alias("rain"),
            )
            for h in HORIZONS
        ]
    )
    rows = validation_rows(frame.select("basin", "d", "q", per_h.alias("_p")), "d", val_years)
    rows = rows.select("basin", "d", "val_year", F.col("q").alias("actual"), F.inline("_p"))
    rows = rows.join(fold_slopes(frame, val_years), ["basin", "val_year", "h"], "left")
    rows = rows.withColumn("doy", F.dayofyear("d")).join(climatology(frame, val_years), ["basin", "val_year", "doy"], "left")
    cands = F.array(
        F.struct(F.lit("persistence").alias("candidate"), F.col("pers").alias("pred")),
        F.struct(F.lit("climatology").alias("candidate"), F.col("clim").alias("pred")),
        F.struct(F.lit("lag_rule").alias("candidate"), (F.col("pers") + F.col("slope") * F.col("rain")).alias("pred")),
    )
    return rows.select("basin", "d", "val_year", "h", "actual", "pers", F.inline(cands))


def season_scores(preds: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Errors, exceedance contingency and event leads per (basin, val_year, h, candidate)."""
    keys = ["basin", "val_year", "h", "candidate"]
    full = preds.dropna(subset=["actual", "pred", "pers"]).join(thresholds, ["basin", "val_year"])
    act, hit = F.col("actual") >= F.col("thr"), F.col("pred") >= F.col("thr")
    scores = full.groupBy(*keys).agg(*A.error_columns("actual", "pred", "pers"), *A.contingency_columns(act, hit))
    leads = event_leads(full, keys, "d", "actual", "pred", "thr", "h")
    events = leads.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_events"), F.count("lead_days").alias("n_detected"), F.avg("lead_days").alias("mean_lead")
    )
    out = scores.join(events, keys, "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_events", "n_detected")})


def backtest(frame: DataFrame, val_years: list[int]) -> DataFrame:
    thr = fold_quantiles(frame, ["basin"], "d", "q", val_years)
    return season_scores(predictions(frame, val_years), thr)


def residuals(preds: DataFrame) -> DataFrame:
    """Held-out actual minus prediction per candidate and horizon."""
    return preds.withColumn("residual", F.col("actual") - F.col("pred")).filter(F.col("residual").isNotNull()).select(
        "basin", "val_year", "d", "h", "candidate", "residual"
    )


def ship_rule(scores: DataFrame, challenger: str, wins_needed: int = 3) -> DataFrame:
    """Best baseline by mean h=1 error (tie to the lag rule); the challenger ships on enough season wins."""
    of = lambda name: F.max(F.when(F.col("candidate") == name, F.col("mae")))
    # one row per season: the scores are read once
    seasons = scores.filter("h = 1").groupBy("basin", "val_year").agg(of("persistence").alias("p"), of("lag_rule").alias("r"), of(challenger).alias("c"))
    g = seasons.groupBy("basin").agg(
        F.avg("p").alias("p_mean"),
        F.avg("r").alias("r_mean"),
        *[F.count_if(F.col("c") < F.col(x)).alias(f"{x}_wins") for x in "pr"],
        *[F.count_if(F.col("c").isNotNull() & F.col(x).isNotNull()).alias(f"{x}_seasons") for x in "pr"],
    )
    rule = F.col("r_mean").isNotNull() & (F.col("p_mean").isNull() | (F.col("r_mean") <= F.col("p_mean")))
    pick = lambda a, b: F.when(rule, F.col(a)).otherwise(F.col(b))
    out = g.filter("p_mean IS NOT NULL OR r_mean IS NOT NULL").select(
        "basin",
        F.when(rule, "lag_rule").otherwise("persistence").alias("best_baseline"),
        pick("r_mean", "p_mean").alias("best_mae"),
        pick("r_wins", "p_wins").alias("wins"),
        F.nullif(pick("r_seasons", "p_seasons"), F.lit(0)).alias("seasons"),
    )
    return out.withColumn("shipped", F.when(F.col("wins") >= wins_needed, F.lit(challenger)).otherwise(F.col("best_baseline")))


def both_seasons_rule(scores: DataFrame, gated: str, rule: str, base: str, seasons: list[int], keep: str = "keep") -> DataFrame:
    """Gated learner ships when it beats rule and base in every season, else the rule when it beats base."""
    wide = (
        scores.filter((F.col("h") == 1) & F.col("val_year").isin(seasons))
        .groupBy("basin", "val_year")
        .pivot("candidate", [gated, rule, base])
        .agg(F.first("mae"))
    )
    g, r, b = F.col(f"`{gated}`"), F.col(f"`{rule}`"), F.col(f"`{base}`")
    wins = wide.groupBy("basin").agg(F.count_if((g < r) & (g < b)).alias("gated_wins"), F.count_if(r < b).alias("rule_wins"))
    shipped = (
        F.when(F.col("gated_wins") == len(seasons), F.lit(gated)).when(F.col("rule_wins") == len(seasons), F.lit(rule)).otherwise(F.lit(keep))
    )
    return wins.withColumn("shipped", shipped)


def forecast_rule(frame: DataFrame, issued: DataFrame, val_years: list[int]) -> DataFrame:
    """q(d-1) + slope x rain forecast for d: slope from actual next-day rain, run on issued forecasts.

    ``issued``: (basin, d = target day, fc1).
    """
    w = W.partitionBy("basin").orderBy("d")
    known = frame.withColumn("rain_next", F.lead("rain_24h").over(w))
    slopes = fold_slopes(known, val_years, {1: "rain_next"}).select("basin", "val_year", "slope")
    operational = frame.select("basin", "d", "q").join(issued.select("basin", "d", "fc1"), ["basin", "d"], "left")
    # the forecast for day d is the next-row feature of the frame row before d
    rows = operational.withColumn("pers", F.lag("q").over(w)).withColumn("has_prev", F.lag("d").over(w).isNotNull())
    rows = validation_rows(rows, "d", val_years).join(slopes, ["basin", "val_year"], "left")
    pred = F.when(F.col("has_prev"), F.col("pers") + F.col("slope") * F.col("fc1"))
    return rows.select("basin", "d", "val_year", F.lit(1).alias("h"), F.col("q").alias("actual"), "pers", F.lit("forecast_rule").alias("candidate"), pred.alias("pred"))


def issued_forecast_daily(fc: DataFrame, bridge: DataFrame, columns: list[str]) -> DataFrame:
    """Anchor-daily sums of the forecast columns (nulls as 0), then the mean over a basin's anchors."""
    per_point = fc.groupBy("point_id", "d").agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in columns])
    return per_point.join(bridge, "point_id").groupBy("basin", "d").agg(*[F.avg(c).alias(c) for c in columns])
