"""Scoring issued forecasts and predictions against what was observed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from freshet.operators import aggregates as A
from freshet.operators.joins import content_hash, value_at
from freshet.operators.windows import event_leads

# fixed values: lead buckets as half-open ranges, and the scored lead days
LEAD_BUCKETS = {"6h": (3, 9), "12h": (9, 18), "24h": (18, 36), "48h": (36, 60), "72h": (60, 96), "7d": (96, 192)}
LEAD_DAYS = (1, 2, 3, 5, 7)
MIN_PAIRS = 12


def held_value(asks: DataFrame, obs: DataFrame, key: str, ask: str, day: str, value: str, out: str) -> DataFrame:
    """Last observation at or before each asked day.

    Asks are reduced to distinct (key, day) first, so the window holds one row per calendar day
    however many forecasts were issued on it; the answer comes back by an equi-join.
    """
    distinct = asks.select(key, F.col(ask).alias("_t")).distinct().withColumn("_side", F.lit(1)).withColumn("_v", F.lit(None).cast("double"))
    given = obs.filter(F.col(value).isNotNull()).select(key, F.col(day).alias("_t"), F.lit(0).alias("_side"), F.col(value).cast("double").alias("_v"))
    w = W.partitionBy(key).orderBy("_t", "_side").rowsBetween(W.unboundedPreceding, 0)
    held = distinct.unionByName(given).withColumn(out, F.last("_v", ignorenulls=True).over(w)).filter("_side = 1")
    return asks.join(held.select(key, F.col("_t").alias(ask), out), [key, ask], "left")


def _score(rows: DataFrame, keys: list[str], has_events: str, min_pairs: int) -> DataFrame:
    """Errors, and threshold events where ``has_events``, in one grouping.

    The event status says why there is no score: no mark, no forecast whose target is observed, or no
    crossing. Rows without events have none.
    """
    known = F.col("obs").isNotNull() & F.col("fc").isNotNull() & F.col(has_events)
    act, fc = known & (F.col("obs") >= F.col("thr")), known & (F.col("fc") >= F.col("thr"))
    g = rows.groupBy(*keys).agg(
        *A.error_columns("obs", "fc", "pers"), *A.contingency_columns(act, fc), F.max("thr").alias("_thr"), F.count_if(known).alias("_known"), F.bool_or(has_events).alias("_asked")
    )
    g = A.gate(g.drop("rmse", "n_hits"), "n", min_pairs, ["mae", "mae_persistence", "skill", "bias"])
    status = F.when(F.col("_thr").isNull(), "no threshold").when(F.col("_known") == 0, "no pairs")
    status = status.when((F.col("n_actual") == 0) & (F.col("n_predicted") == 0), "no crossings").otherwise("ok")
    g = g.withColumn("ev_status", F.when(F.col("_asked"), status))
    ok = F.col("ev_status") == "ok"
    events = {"observed_above": "n_actual", "forecast_above": "n_predicted", "pod": "pod", "far": "far"}
    return g.withColumns({out: F.when(ok, F.col(c)) for out, c in events.items()}).drop("n_actual", "n_predicted", "_thr", "_known", "_asked")


def _with_every(rows: DataFrame, leads: DataFrame) -> DataFrame:
    # a row without a forecast per site and lead: it counts for nothing, but the lead is scored
    return rows.unionByName(leads, allowMissingColumns=True)


def lead_bucket_score(
    forecasts: DataFrame, obs: DataFrame, marks: DataFrame, key: str = "site", event_bucket: str = "24h", min_pairs: int = MIN_PAIRS
) -> DataFrame:
    """Per site and lead bucket: error, persistence error, skill, bias; warning events in one bucket.

    ``forecasts``: (site, issued, target, lead, fc); ``obs``: (site, d, q); ``marks``: (site, thr).
    Persistence is the last observation at or before the issue time. Every site with a forecast has
    all the buckets, those without one being insufficient with n = 0.
    """
    bands = F.array(*[F.struct(F.lit(b).alias("bucket"), F.lit(lo).alias("_lo"), F.lit(hi).alias("_hi")) for b, (lo, hi) in LEAD_BUCKETS.items()])
    rows = forecasts.select("*", F.inline(bands)).filter((F.col("lead") >= F.col("_lo")) & (F.col("lead") < F.col("_hi")))
    rows = _with_every(rows, forecasts.select(key).distinct().select(key, F.inline(bands)).drop("_lo", "_hi"))
    rows = held_value(value_at(rows, obs, key, "d", "q", {"obs": "target"}), obs, key, "issued", "d", "q", "pers")
    rows = rows.join(marks, key, "left").withColumn("_ev", F.col("bucket") == event_bucket)
    return _score(rows, [key, "bucket"], "_ev", min_pairs)


def lead_day_score(forecasts: DataFrame, obs: DataFrame, marks: DataFrame, key: str = "site", min_pairs: int = MIN_PAIRS) -> DataFrame:
    """Per site and lead day: same measures (and rows without a forecast), persistence being the value of the issue day itself."""
    rows = forecasts.filter(F.col("lead").isin(*LEAD_DAYS))
    rows = _with_every(rows, forecasts.select(key).distinct().select(key, F.explode(F.array(*[F.lit(n) for n in LEAD_DAYS])).alias("lead")))
    rows = value_at(rows, obs, key, "d", "q", {"obs": "target", "pers": "issued"})
    rows = rows.join(marks, key, "left").withColumn("_ev", F.col("lead") == 1)
    return _score(rows, [key, "lead"], "_ev", min_pairs)


def out_of_sample_report(preds: DataFrame, residuals: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Held-out window per basin: exceedance and alarm days, onsets with leads, first alarm, mean P(exceed).

    ``preds`` are h = 1 rows (basin, d, actual, pred); an alarm for d is issued the day before.
    """
    p = preds.join(thresholds, "basin")
    p = A.residual_exceedance(p, residuals, "basin", "pred", "residual", {"p_exceed": "thr"})
    act = F.coalesce(F.col("actual") >= F.col("thr"), F.lit(False))
    alarm = F.coalesce(F.col("pred") >= F.col("thr"), F.lit(False))
    g = p.groupBy("basin").agg(
        F.count(F.lit(1)).alias("n_days"),
        F.count_if(act).alias("n_exceed"),
        F.count_if(alarm & act).alias("n_correct"),
        F.count_if(alarm & ~act).alias("n_false"),
        F.avg("p_exceed").alias("mean_p"),
        F.date_sub(F.min(F.when(alarm, F.col("d"))), 1).alias("first_alarm"),
    )
    ev = event_leads(p.withColumn("h", F.lit(1)), ["basin"], "d", "actual", "pred", "thr", "h")
    e = ev.groupBy("basin").agg(F.count(F.lit(1)).alias("n_onsets"), F.count("lead_days").alias("n_detected"), F.avg("lead_days").alias("mean_lead"))
    out = g.join(e, "basin", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_onsets", "n_detected")})


def stamp_metrics(metrics: DataFrame, data: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Metric rows stamped with the content hash of the data of their key."""
    return metrics.join(content_hash(data, keys, columns, "data_hash"), keys, "left")


def metric_mismatches(now: DataFrame, golden: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Golden rows that the new run does not reproduce exactly, null matching null."""
    g = golden.select(*keys, F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("golden")) for m in metrics])))
    n = now.select(*keys, F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("now")) for m in metrics])))
    return g.join(n, [*keys, "metric"], "left").filter(~F.col("golden").eqNullSafe(F.col("now")))
