"""Learned candidates: boosted trees per basin, fold and horizon, their selection, and what their inputs add.

A fold trains on the days of all earlier years. The models of all basins, folds, horizons and learners
are fitted in one plan, side by side (``boosting.fit``), and applied in another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from freshet.operators import aggregates as A
from freshet.plans import baselines as B
from freshet.plans import boosting
from freshet.plans.boosting import HISTOGRAM, SECOND_ORDER, Learner
from freshet.plans.frames import feature_columns
from freshet.session import cut_lineage

KEYS = ["basin", "val_year", "h"]
LEARNERS = {"histogram": HISTOGRAM, "second_order": SECOND_ORDER}


def _per_horizon(horizons: tuple[int, ...], target: bool) -> Column:
    y = (lambda h: [F.col(f"y_h{h}").alias("y")]) if target else (lambda h: [])
    return F.inline(F.array(*[F.struct(F.lit(h).alias("h"), *y(h)) for h in horizons]))


def training_rows(feats: DataFrame, val_years: list[int], horizons: tuple[int, ...], cols: list[str], drop_null: bool = True, since: int | None = None, season_only: bool = False) -> DataFrame:
    """basin, val_year, h, features and target ``y``: each row once per fold and horizon that it trains.

    ``drop_null`` leaves out rows with a null feature; otherwise nulls are split on. ``since`` and ``season_only``
    narrow the training days to later years and to the season.
    """
    rows = feats.dropna(subset=cols) if drop_null else feats
    rows = rows.where(F.year("d") >= since) if since else rows
    rows = rows.where(A.in_season("d")) if season_only else rows
    return B.train_rows(rows, "d", val_years).select("basin", "val_year", *cols, _per_horizon(horizons, True))


def fit_folds(feats: DataFrame, val_years: list[int], horizons: tuple[int, ...], learners: dict[str, Learner], cols: list[str], drop_null: bool = True, **narrow) -> DataFrame:
    """One model per basin, fold, horizon and learner on its ``training_rows``, as a written table (``boosting.fit``)."""
    train = training_rows(feats, val_years, horizons, cols, drop_null, **narrow)
    # few rows and much work a model: many small tasks, which are not merged again
    train = train.repartition(4 * feats.sparkSession.sparkContext.defaultParallelism, *KEYS)
    return cut_lineage(boosting.fit(train, KEYS, cols, "y", learners))


def predict_folds(models: DataFrame, feats: DataFrame, horizons: tuple[int, ...], val_years: list[int], cols: list[str], drop_null: bool = True) -> DataFrame:
    """(basin, val_year, h, d, candidate, pred) with ``d`` the predicted day, h days after the features."""
    rows = feats.dropna(subset=cols) if drop_null else feats
    rows = rows.select("basin", "d", *cols, _per_horizon(horizons, False)).withColumn("d", F.date_add("d", F.col("h")))
    rows = rows.withColumn("val_year", F.year("d")).where(F.col("val_year").isin(val_years) & A.in_season("d"))
    return boosting.predict(models, rows, KEYS, cols).select(*KEYS, "d", "candidate", "pred")


def season_truth(feats: DataFrame, val_years: list[int], horizons: tuple[int, ...]) -> DataFrame:
    """Actual value and persistence of every season day: basin, d, val_year, h, actual, pers."""
    w = W.partitionBy("basin").orderBy("d")
    pers = F.array(*[F.struct(F.lit(h).alias("h"), F.lag("q", h).over(w).alias("pers")) for h in horizons])
    rows = feats.select("basin", "d", F.col("q").alias("actual"), pers.alias("p"))
    return B.validation_rows(rows, "d", val_years).select("basin", "d", "val_year", "actual", F.inline("p"))


def _against_truth(preds: DataFrame, truth: DataFrame, names: list[str]) -> DataFrame:
    days = truth.withColumn("candidate", F.explode(F.array(*[F.lit(n) for n in names])))
    return days.join(preds, [*KEYS, "d", "candidate"], "left").select("basin", "d", "val_year", "h", "actual", "pers", "candidate", "pred")


def walk_forward(feats: DataFrame, val_years: list[int], horizons: tuple[int, ...] = (1, 2), learners: dict[str, Learner] | None = None, cols: list[str] | None = None, drop_null: bool = True) -> DataFrame:
    """Held-out season predictions of learners, in the form of ``baselines.predictions``."""
    learners, cols = learners or {"histogram": HISTOGRAM}, cols or feature_columns(feats)
    feats = cut_lineage(feats)
    models = fit_folds(feats, val_years, horizons, learners, cols, drop_null)
    preds = predict_folds(models, feats, horizons, val_years, cols, drop_null)
    return _against_truth(preds, season_truth(feats, val_years, horizons), list(learners))


def with_next_rain(feats: DataFrame, rain: DataFrame) -> DataFrame:
    """``rain_next``: the rain of the following calendar day, from (basin, d, rain), actual or as forecast; null where there is none."""
    ahead = rain.select("basin", F.date_sub("d", 1).alias("d"), F.col("rain").cast("double").alias("rain_next"))
    return feats.join(ahead, ["basin", "d"], "left")


def select_over_folds(feats: DataFrame, val_years: list[int], learners: dict[str, Learner] | None = None, operational: DataFrame | None = None) -> DataFrame:
    """Which learner an inner season chooses before each fold, and how each does in the fold's own season.

    Learners train on ``feats`` (where rain ahead is the actual one). Before a fold the last training season
    is held out: its error is ``mae``, the least one is ``chosen``, and the choice before the first fold is ``gated``
    and stays. In the fold the learners see ``operational`` (rain ahead as it was forecast; ``feats`` if not given): ``fold_mae``;
    ``bound_mae`` is their error on ``feats`` there, a bound for a perfect forecast. The model that a later fold holds its inner
    season out of is the model of the fold before, so each is fitted once.
    """
    learners = learners or LEARNERS
    cols = feature_columns(feats)
    feats = cut_lineage(feats)
    operational = feats if operational is None else cut_lineage(operational)
    years = sorted({*val_years, *(y - 1 for y in val_years)})
    models = fit_folds(feats, years, (1,), learners, cols)
    truth = season_truth(feats, years, (1,))

    def errors(asked: DataFrame, n: str, mae: str) -> DataFrame:
        rows = _against_truth(predict_folds(models, asked, (1,), years, cols), truth, list(learners))
        s = A.error_metrics(rows, ["basin", "val_year", "candidate"], "actual", "pred", "pers")
        return s.select("basin", "val_year", "candidate", F.col("n").alias(n), F.col("mae").alias(mae))

    bound = cut_lineage(errors(feats, "n", "mae"))
    inner = bound.withColumns({"inner_year": F.col("val_year"), "val_year": F.col("val_year") + 1})
    order = F.array_position(F.array(*[F.lit(n) for n in learners]), F.col("candidate"))
    best = inner.where("mae IS NOT NULL").groupBy("basin", "val_year").agg(F.min_by("candidate", F.struct("mae", order)).alias("chosen"))
    on = ["basin", "val_year", "candidate"]
    out = errors(operational, "fold_n", "fold_mae").where(F.col("val_year").isin(val_years))
    out = out.join(bound.select(*on, F.col("mae").alias("bound_mae")), on, "left").join(inner, on, "left").join(best, ["basin", "val_year"], "left")
    out = cut_lineage(out)
    first = out.groupBy("basin").agg(F.min_by("chosen", F.when(F.col("chosen").isNotNull(), F.col("val_year"))).alias("gated"))
    return out.join(first, "basin", "left")


def selection_wins(selected: DataFrame, rules: DataFrame) -> DataFrame:
    """``select_over_folds`` beside the simple rules' errors, and whether each learner beats both of them.

    ``rules``: basin, val_year, lag_rule_mae, forecast_rule_mae.
    """
    both = selected.join(rules, ["basin", "val_year"], "left")
    beats = (F.col("fold_mae") < F.col("forecast_rule_mae")) & (F.col("fold_mae") < F.col("lag_rule_mae"))
    return both.withColumn("wins", F.coalesce(beats, F.lit(False)))


def ship_selected(won: DataFrame, rule: str = "forecast_rule", keep: str = "keep") -> DataFrame:
    """Per basin: the gated learner ships if it won every season, else the forecast rule if it beat the lag rule in every season, else what is there stays."""
    gated = F.col("candidate") == F.col("gated")
    rule_won = gated & (F.col("forecast_rule_mae") < F.col("lag_rule_mae"))
    s = won.groupBy("basin").agg(F.first("gated").alias("gated"), F.countDistinct("val_year").alias("seasons"), F.count_if(gated & F.col("wins")).alias("gated_wins"), F.count_if(rule_won).alias("rule_wins"))
    return s.withColumn("shipped", F.when(F.col("gated_wins") == F.col("seasons"), F.col("gated")).when(F.col("rule_wins") == F.col("seasons"), F.lit(rule)).otherwise(F.lit(keep)))


def ablation_folds(feats: DataFrame, extra: list[str], val_years: list[int], min_train: int = 60, min_test: int = 30, min_cover: float = 0.5, since: int | None = None, season_only: bool = False) -> DataFrame:
    """What a comparison with extra columns rests on, per basin and fold: n_train, n_test, coverage, persistence, skipped.

    Rows count by the day of their features, if the next day's value is known. Coverage is the mean
    share of extra values that are there on test days; persistence the error of today's value for tomorrow.
    """
    known = feats.where("y_h1 IS NOT NULL")
    early = known.where(F.year("d") >= since) if since else known
    early = early.where(A.in_season("d")) if season_only else early
    n_train = B.train_rows(early, "d", val_years).groupBy("basin", "val_year").agg(F.count(F.lit(1)).alias("n_train"))
    there = sum((F.col(c).isNotNull().cast("double") for c in extra), F.lit(0.0)) / len(extra)
    tested = B.validation_rows(known, "d", val_years).groupBy("basin", "val_year").agg(
        F.count(F.lit(1)).alias("n_test"), F.avg(there).alias("coverage"), F.avg(F.abs(F.col("y_h1") - F.col("q"))).alias("persistence")
    )
    every = feats.select("basin").distinct().withColumn("val_year", F.explode(F.array(*[F.lit(y) for y in val_years])))
    out = every.join(n_train, ["basin", "val_year"], "left").join(tested, ["basin", "val_year"], "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_train", "n_test")})
    thin = (F.col("n_test") < min_test) | (F.coalesce("coverage", F.lit(0.0)) < min_cover)
    return out.withColumn("skipped", F.when(F.col("n_train") < min_train, "few training rows").when(thin, "thin coverage"))


def ablation(feats: DataFrame, extra: list[str], val_years: list[int], learner: Learner = HISTOGRAM, **rule) -> DataFrame:
    """``ablation_folds`` with the learner's error without (``plain``) and with the extra columns, and whether these beat persistence and plain.

    Nulls in features are split on, not dropped. Skipped folds have no errors and no verdict.
    """
    plain = [c for c in feature_columns(feats) if c not in extra]
    feats = cut_lineage(feats)
    folds = cut_lineage(ablation_folds(feats, extra, val_years, **rule))
    narrow = {k: v for k, v in rule.items() if k in ("since", "season_only")}
    truth = B.validation_rows(feats.where("y_h1 IS NOT NULL"), "d", val_years).select("basin", "val_year", F.lit(1).alias("h"), "d", "y_h1")
    judged = folds.where("skipped IS NULL").select("basin", "val_year")
    out = folds
    for name, cols in (("plain", plain), ("extra", [*plain, *extra])):
        models = fit_folds(feats, val_years, (1,), {name: learner}, cols, drop_null=False, **narrow)
        asked = B.validation_rows(feats, "d", val_years).withColumn("h", F.lit(1)).join(judged, ["basin", "val_year"], "left_semi").select(*KEYS, "d", *cols)
        rows = truth.join(boosting.predict(models, asked, KEYS, cols).select(*KEYS, "d", "pred"), [*KEYS, "d"])
        err = rows.groupBy("basin", "val_year").agg(F.avg(F.abs(F.col("pred") - F.col("y_h1"))).alias(name))
        out = out.join(err, ["basin", "val_year"], "left")
    out = out.withColumn("beats_persistence", F.when(F.col("skipped").isNull(), F.col("extra") < F.col("persistence")))
    return out.withColumn("beats_plain", F.when(F.col("skipped").isNull(), F.col("extra") < F.col("plain")))
