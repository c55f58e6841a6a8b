"""Modelling and verification jobs (2.8, M1-M19 and M24)."""

from pyspark.sql import functions as F

from freshet.catalog.aggregates import SLOPES_SQL, THR_SQL
from freshet.catalog.joins import FRAME_NUM, daily_frame, stored_frame
from freshet.catalog.registry import entry
from freshet.catalog.screens import VAL_YEARS
from freshet.operators import aggregates as A
from freshet.operators import joins as J
from freshet.operators import windows as Wn
from freshet.plans import baselines as B
from freshet.plans import frames as Fr
from freshet.plans import labels as Lb
from freshet.plans import lags as Lg
from freshet.plans import learning as Ln
from freshet.plans import verification as V

FOLDS = "(VALUES (1998), (1999), (2000), (2001)) f(y)"


@entry(
    "lag_lead_features",
    """SELECT basin, d, q, lag(q) OVER w AS q_lag1, lag(q, 2) OVER w AS q_lag2, q - lag(q) OVER w AS dq, lag(q) OVER w - lag(q, 2) OVER w AS dq_lag1,
         100 * (q - lag(q, 2) OVER w) / NULLIF(lag(q, 2) OVER w, 0) AS trend48_pct, rain_24h, rain_48h, rain_14d, rain_30d, lag(rain_24h) OVER w AS rain_24h_lag1,
         sin(2 * pi() * dayofyear(d) / 365.25::DOUBLE) AS doy_sin, cos(2 * pi() * dayofyear(d) / 365.25::DOUBLE) AS doy_cos, qup, dqup, lead(q, 1) OVER w AS y_h1, lead(q, 2) OVER w AS y_h2
       FROM frame WINDOW w AS (PARTITION BY basin ORDER BY d)""",
    num=f"{FRAME_NUM} q_lag1 q_lag2 dq dq_lag1 trend48_pct rain_24h_lag1 doy_sin doy_cos y_h1 y_h2",
    text="d",
)
def _(t):
    return Fr.feature_frame(daily_frame(t))


@entry("baseline_persistence", "SELECT site, d, lag(q, 1) OVER w AS pred_h1, lag(q, 2) OVER w AS pred_h2 FROM v2 WINDOW w AS (PARTITION BY site ORDER BY d)", num="pred_h1 pred_h2", text="d")
def _(t):
    p = J.lagged(J.lagged(t.v2, "site", "d", "q", 1, "pred_h1"), "site", "d", "q", 2, "pred_h2")
    return p.drop("q")


CLIM_SQL = f"""clim AS (SELECT basin, f.y AS val_year, doy, avg(q) AS clim FROM frame, {FOLDS}, range(1, 367) r(doy)
         WHERE year(d) < f.y AND q IS NOT NULL AND least(abs(dayofyear(d) - doy), 366 - abs(dayofyear(d) - doy)) <= 7 GROUP BY 1, 2, 3)"""
PREDS_SQL = f"""{SLOPES_SQL}, {CLIM_SQL},
       p0 AS (SELECT basin, d, q AS actual, h, CASE h WHEN 1 THEN l1 ELSE l2 END AS pers, CASE h WHEN 1 THEN r1 ELSE r2 END AS rain FROM
         (SELECT basin, d, q, lag(q, 1) OVER w AS l1, lag(q, 2) OVER w AS l2, lag(rain_24h, 1) OVER w AS r1, lag(rain_48h, 2) OVER w AS r2 FROM frame WINDOW w AS (PARTITION BY basin ORDER BY d)), (VALUES (1), (2)) hh(h)
         WHERE year(d) BETWEEN 1998 AND 2001 AND month(d) BETWEEN 6 AND 9),
       preds AS (SELECT p.basin, p.d, year(p.d) AS val_year, p.h, p.actual, p.pers, c.candidate, CASE c.candidate WHEN 'persistence' THEN p.pers WHEN 'climatology' THEN clim.clim ELSE p.pers + s.slope * p.rain END AS pred
         FROM p0 p CROSS JOIN (VALUES ('persistence'), ('climatology'), ('lag_rule')) c(candidate)
         LEFT JOIN slopes s ON s.basin = p.basin AND s.val_year = year(p.d) AND s.h = p.h LEFT JOIN clim ON clim.basin = p.basin AND clim.val_year = year(p.d) AND clim.doy = dayofyear(p.d)),
       thr4 AS (SELECT basin, f.y AS val_year, quantile_cont(q, 0.9) AS thr FROM frame, {FOLDS} WHERE year(d) < f.y AND month(d) BETWEEN 6 AND 9 AND q IS NOT NULL GROUP BY 1, 2)"""
SCORES_SQL = """full_ AS (SELECT preds.*, thr FROM preds JOIN thr4 USING (basin, val_year) WHERE actual IS NOT NULL AND pred IS NOT NULL AND pers IS NOT NULL),
       sc AS (SELECT basin, val_year, h, candidate, count(*) AS n, avg(abs(pred - actual)) AS mae, sqrt(avg(pow(pred - actual, 2))) AS rmse, avg(abs(pers - actual)) AS mae_persistence,
         1 - avg(abs(pred - actual)) / avg(abs(pers - actual)) AS skill, avg(pred - actual) AS bias, count(*) FILTER (actual >= thr) AS n_actual, count(*) FILTER (pred >= thr) AS n_predicted,
         count(*) FILTER (actual >= thr AND pred >= thr) AS n_hits, count(*) FILTER (actual >= thr AND pred >= thr) / NULLIF(count(*) FILTER (actual >= thr), 0) AS pod,
         count(*) FILTER (actual < thr AND pred >= thr) / NULLIF(count(*) FILTER (pred >= thr), 0) AS far FROM full_ GROUP BY 1, 2, 3, 4),
       ex AS (SELECT *, actual >= thr AS e, COALESCE(lag(actual >= thr) OVER w, false) AS pe FROM full_ WINDOW w AS (PARTITION BY basin, val_year, h, candidate ORDER BY d)),
       isl AS (SELECT *, d - CAST(row_number() OVER (PARTITION BY basin, val_year, h, candidate ORDER BY d) AS INT) AS g FROM ex WHERE e),
       ev AS (SELECT basin, val_year, h, candidate, min(d) AS onset, min(d) FILTER (pred >= thr) AS al, arg_min(NOT pe, d) AS st FROM isl GROUP BY basin, val_year, h, candidate, g),
       le AS (SELECT basin, val_year, h, candidate, count(*) AS n_events, count(al) AS n_detected, avg(onset - al + h) AS mean_lead FROM ev WHERE st GROUP BY 1, 2, 3, 4),
       scores AS (SELECT sc.*, COALESCE(n_events, 0) AS n_events, COALESCE(n_detected, 0) AS n_detected, mean_lead FROM sc LEFT JOIN le USING (basin, val_year, h, candidate))"""
SCORE_NUM = "mae rmse mae_persistence skill bias pod far mean_lead"


@entry("baseline_lag_rule", f"WITH {PREDS_SQL} SELECT basin, d, h, pred FROM preds WHERE candidate = 'lag_rule'", num="pred", text="d")
def _(t):
    return B.predictions(stored_frame(t), VAL_YEARS).filter("candidate = 'lag_rule'").select("basin", "d", "h", "pred")


ISSUED_SQL = """issued AS (SELECT basin, d, avg(fc1) AS fc1, avg(fc2) AS fc2 FROM (SELECT site AS point_id, target AS d, COALESCE(sum(CASE WHEN lead_d <= 96 THEN fc END), 0) / 10 AS fc1, COALESCE(sum(CASE WHEN lead_d > 48 THEN fc END), 0) / 10 AS fc2
       FROM v4 GROUP BY 1, 2) JOIN bridge USING (point_id) GROUP BY 1, 2)"""


def issued(t):
    lead, fc = F.col("lead_d"), F.col("fc")
    f = t.v4.select(
        F.col("site").alias("point_id"), F.col("target").alias("d"), F.when(lead <= 96, fc).alias("fc1"), F.when(lead > 48, fc).alias("fc2")
    )
    out = B.issued_forecast_daily(f, t.bridge(), ["fc1", "fc2"])
    return out.withColumn("fc1", F.col("fc1") / 10).withColumn("fc2", F.col("fc2") / 10)


@entry("issued_forecast_daily", f"WITH {ISSUED_SQL} SELECT * FROM issued", num="fc1 fc2", text="d")
def _(t):
    return issued(t)


FC_RULE_SQL = f"""{ISSUED_SQL}, nx AS (SELECT basin, d, q, lead(rain_24h) OVER (PARTITION BY basin ORDER BY d) AS x FROM frame),
       nc AS (SELECT basin, d, x, lead(q) OVER w - q AS dy, lead(d) OVER w AS u FROM nx WHERE month(d) BETWEEN 6 AND 9 WINDOW w AS (PARTITION BY basin ORDER BY d)),
       b4 AS (SELECT basin, f.y AS val_year, COALESCE(sum(x * dy) FILTER (year(u) < f.y) / NULLIF(sum(x * x) FILTER (year(u) < f.y AND dy IS NOT NULL), 0), 0) AS slope FROM nc, {FOLDS} WHERE year(d) < f.y GROUP BY 1, 2),
       fr AS (SELECT g.basin, g.d, year(g.d) AS val_year, g.q AS actual, g.pers, g.pers + b4.slope * i.fc1 AS pred FROM
         (SELECT basin, d, q, lag(q) OVER (PARTITION BY basin ORDER BY d) AS pers FROM frame) g LEFT JOIN issued i USING (basin, d)
         LEFT JOIN b4 ON b4.basin = g.basin AND b4.val_year = year(g.d) WHERE year(g.d) BETWEEN 1998 AND 2001 AND month(g.d) BETWEEN 6 AND 9)"""


@entry("baseline_fc_rule", f"WITH {FC_RULE_SQL} SELECT * FROM fr", num="actual pers pred", text="d")
def _(t):
    return B.forecast_rule(stored_frame(t), issued(t), VAL_YEARS).drop("h", "candidate")


@entry("walk_forward_backtest", f"WITH {PREDS_SQL}, {SCORES_SQL} SELECT * FROM scores", num=SCORE_NUM)
def _(t):
    return B.backtest(stored_frame(t), VAL_YEARS)


@entry("gbt_walk_forward", num=SCORE_NUM)
def _(t):
    f = stored_frame(t)
    feats = Fr.feature_frame(f)
    preds = Ln.walk_forward(feats, VAL_YEARS)
    return B.season_scores(preds, B.fold_quantiles(f, ["basin"], "d", "q", VAL_YEARS))


FEATURES_SQL = """feats AS (SELECT *, lead(q, 1) OVER w AS y_h1, lead(q, 2) OVER w AS y_h2, q + lag(q) OVER w + lag(q, 2) OVER w + rain_24h + rain_48h + rain_14d + rain_30d + lag(rain_24h) OVER w + qup + dqup
         + 100 * (q - lag(q, 2) OVER w) / NULLIF(lag(q, 2) OVER w, 0) AS whole FROM frame WINDOW w AS (PARTITION BY basin ORDER BY d))"""


@entry(
    "gbt_fold_rows",
    f"""WITH {FEATURES_SQL}, e AS (SELECT basin, f.y AS val_year, hh.h, CASE hh.h WHEN 1 THEN y_h1 ELSE y_h2 END AS y FROM feats, {FOLDS}, (VALUES (1), (2)) hh(h) WHERE whole IS NOT NULL AND year(d) < f.y)
        SELECT basin, val_year, h, count(y) AS n_train, max(y) AS max_y FROM e GROUP BY 1, 2, 3 HAVING count(y) > 0""",
    num="max_y",
)
def _(t):
    feats = Fr.feature_frame(daily_frame(t))
    return Ln.training_rows(feats, VAL_YEARS, (1, 2), Fr.feature_columns(feats)).groupBy(*Ln.KEYS).agg(F.count("y").alias("n_train"), F.max("y").alias("max_y")).filter("n_train > 0")


def selection(t):
    """Learners trained on the actual rain of the next day and asked with the one that was forecast."""
    frame = stored_frame(t)
    feats = Fr.feature_frame(frame)
    actual = Ln.with_next_rain(feats, frame.select("basin", "d", F.col("rain_24h").alias("rain")))
    forecast = Ln.with_next_rain(feats, issued(t).select("basin", "d", F.col("fc1").alias("rain")))
    preds = B.predictions(frame, VAL_YEARS).filter("h = 1 AND candidate = 'lag_rule'").unionByName(B.forecast_rule(frame, issued(t), VAL_YEARS))
    mae = A.error_metrics(preds, ["basin", "val_year", "candidate"], "actual", "pred", "pers")
    of = lambda c: F.max(F.when(F.col("candidate") == c, F.col("mae"))).alias(f"{c}_mae")
    rules = mae.groupBy("basin", "val_year").agg(of("lag_rule"), of("forecast_rule"))
    return Ln.selection_wins(Ln.select_over_folds(actual, VAL_YEARS, operational=forecast), rules)


@entry("candidate_selection", num="mae fold_mae bound_mae lag_rule_mae forecast_rule_mae")
def _(t):
    return selection(t)


@entry("ship_rule_learned")
def _(t):
    return Ln.ship_selected(selection(t))


@entry(
    "ship_rule",
    f"""WITH {PREDS_SQL}, {SCORES_SQL}, m AS (SELECT basin, candidate, avg(mae) AS mm FROM scores WHERE h = 1 AND candidate IN ('persistence', 'lag_rule') GROUP BY 1, 2),
        b AS (SELECT basin, candidate AS best_baseline, mm AS best_mae FROM m QUALIFY row_number() OVER (PARTITION BY basin ORDER BY mm, candidate <> 'lag_rule') = 1),
        w AS (SELECT o.basin, count(*) FILTER (o.mae < r.mae) AS wins, count(*) AS seasons FROM scores o JOIN b USING (basin) JOIN scores r ON r.basin = o.basin AND r.val_year = o.val_year AND r.h = 1 AND r.candidate = best_baseline
              WHERE o.h = 1 AND o.candidate = 'climatology' GROUP BY 1)
        SELECT b.basin, best_baseline, best_mae, COALESCE(wins, 0) AS wins, seasons, CASE WHEN wins >= 3 THEN 'climatology' ELSE best_baseline END AS shipped FROM b LEFT JOIN w USING (basin)""",
    num="best_mae",
)
def _(t):
    return B.ship_rule(B.backtest(stored_frame(t), VAL_YEARS), "climatology")


@entry(
    "ship_rule_both_seasons",
    f"""WITH {PREDS_SQL}, {SCORES_SQL}, w AS (SELECT basin, val_year, max(mae) FILTER (candidate = 'climatology') AS g, max(mae) FILTER (candidate = 'lag_rule') AS r, max(mae) FILTER (candidate = 'persistence') AS b
          FROM scores WHERE h = 1 AND val_year IN (1999, 2000) GROUP BY 1, 2), k AS (SELECT basin, count(*) FILTER (g < r AND g < b) AS gated_wins, count(*) FILTER (r < b) AS rule_wins FROM w GROUP BY 1)
        SELECT *, CASE WHEN gated_wins = 2 THEN 'climatology' WHEN rule_wins = 2 THEN 'lag_rule' ELSE 'keep' END AS shipped FROM k""",
)
def _(t):
    return B.both_seasons_rule(B.backtest(stored_frame(t), VAL_YEARS), "climatology", "lag_rule", "persistence", [1999, 2000])


@entry("pooled_residuals", f"WITH {PREDS_SQL} SELECT basin, val_year, d, h, candidate, actual - pred AS residual FROM preds WHERE actual - pred IS NOT NULL", num="residual", text="d")
def _(t):
    return B.residuals(B.predictions(stored_frame(t), VAL_YEARS))


@entry("leakage_check", "SELECT count(*) AS n_rows, 0 AS n_violations FROM frame WHERE d <= DATE '1999-06-30'")
def _(t):
    f = stored_frame(t)
    probe = F.lit("1999-06-30").cast("date")
    bad = Fr.leakage_rows(f, probe).agg(F.count(F.lit(1)).alias("n"))
    rows = f.filter(F.col("d") <= probe).agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.withColumn("n_violations", bad.scalar())


XCORR_SQL = """qs AS (SELECT *, row_number() OVER (PARTITION BY basin ORDER BY d) AS rn FROM (SELECT site AS basin, d, q, q - lag(q) OVER (PARTITION BY site ORDER BY d) AS dq FROM v2)),
       pr AS (SELECT a.basin, a.d, win, l AS lag, r, b.q, b.dq FROM (SELECT basin, d, win, CASE win WHEN 'rain_24h' THEN rain_24h ELSE rain_48h END AS r FROM frame, (VALUES ('rain_24h'), ('rain_48h')) w(win)) f
         JOIN qs a USING (basin, d) CROSS JOIN range(0, 6) g(l) JOIN qs b ON b.basin = a.basin AND b.rn = a.rn + l WHERE r IS NOT NULL AND b.q IS NOT NULL AND b.dq IS NOT NULL),
       xc AS (SELECT basin, win, season, lag, corr(r, q) AS r_q, corr(r, dq) AS r_dq, count(*) AS n FROM pr, (VALUES (true), (false)) s(season) WHERE NOT season OR month(d) BETWEEN 6 AND 9 GROUP BY 1, 2, 3, 4)"""


def pairs(t):
    return Lg.lag_pairs(daily_frame(t), t.stored("v2").withColumnRenamed("site", "basin"), ["rain_24h", "rain_48h"])


@entry("lag_crosscorr", f"WITH {XCORR_SQL} SELECT * FROM xc", num="r_q r_dq")
def _(t):
    return Lg.cross_correlation(pairs(t))


@entry(
    "best_lag",
    f"WITH {XCORR_SQL} SELECT basin, win, season, lag AS best_lag FROM xc QUALIFY row_number() OVER (PARTITION BY basin, win, season ORDER BY r_dq DESC, lag) = 1",
)
def _(t):
    return Lg.best_lag(Lg.cross_correlation(pairs(t)), ["basin", "win", "season"], "r_dq", "best_lag")


@entry(
    "leave_one_year_out",
    f"""WITH {XCORR_SQL}, ys AS (SELECT DISTINCT basin, win, lag, year(d) AS left_out FROM pr WHERE month(d) BETWEEN 6 AND 9),
        lo AS (SELECT ys.basin, ys.win, ys.left_out, ys.lag, corr(r, dq) AS c FROM ys JOIN pr ON pr.basin = ys.basin AND pr.win = ys.win AND pr.lag = ys.lag AND month(d) BETWEEN 6 AND 9 AND year(d) <> ys.left_out GROUP BY 1, 2, 3, 4)
        SELECT basin, win, left_out, lag AS best_lag FROM lo QUALIFY row_number() OVER (PARTITION BY basin, win, left_out ORDER BY c DESC, lag) = 1""",
)
def _(t):
    return Lg.leave_one_year_out(pairs(t))


@entry(
    "event_study",
    """WITH RECURSIVE r AS (SELECT site, d, rise, row_number() OVER (PARTITION BY site ORDER BY rise DESC, d) AS rn FROM (SELECT site, d, q - lag(q) OVER (PARTITION BY site ORDER BY d) AS rise FROM v2) WHERE rise IS NOT NULL),
       g AS (SELECT site, 1 AS pick, rn, [d] AS taken, d FROM r WHERE rn = 1 UNION ALL SELECT g.site, g.pick + 1, n.rn, list_append(g.taken, n.d), n.d FROM g, LATERAL (
           SELECT r.rn, r.d FROM r WHERE r.site = g.site AND r.rn > g.rn AND len(list_filter(g.taken, lambda x: abs(x - r.d) < 7)) = 0 ORDER BY r.rn LIMIT 1) n WHERE g.pick < 10),
       pk AS (SELECT g.site, g.d, b.d AS peak_day FROM g JOIN v2 b ON b.site = g.site AND b.d BETWEEN g.d AND g.d + 4 QUALIFY row_number() OVER (PARTITION BY g.site, g.d ORDER BY b.q DESC, b.d) = 1),
       sp AS (SELECT pk.site, pk.d, pk.peak_day - r.d AS lag_days FROM pk LEFT JOIN rainday r ON r.basin = pk.site AND r.d BETWEEN pk.peak_day - 5 AND pk.peak_day QUALIFY row_number() OVER (PARTITION BY pk.site, pk.d ORDER BY r.rain DESC NULLS LAST, r.d) = 1)
       SELECT site AS basin, count(lag_days) AS n_events, median(lag_days) AS median_lag, min(lag_days) AS min_lag, max(lag_days) AS max_lag, count(*) FILTER (lag_days = 0) AS n_same_day, count(*) FILTER (lag_days = 1) AS n_next_day FROM sp GROUP BY 1""",
    num="median_lag",
)
def _(t):
    rain = J.catchment_mean(t.v3, t.bridge(), "point_id", "basin", "d", "mm", "rain")
    return Lg.event_study(Lg.event_lags(t.v2.withColumnRenamed("site", "basin"), rain, "rain"))


EXTRA = ["dam", "dam_lag1", "dam_chg"]


def extra_features(t):
    """Features with another site's level, which is missing on some days."""
    feats = Fr.feature_frame(daily_frame(t))
    dam = Wn.row_lags(t.v2.filter("day(d) % 4 <> 0").select(((F.col("site") + 2) % 4).alias("basin"), "d", "q"), "basin", "d", "q", "dam")
    return feats.join(dam.select("basin", "d", *EXTRA), ["basin", "d"], "left")


@entry("feature_ablation", num="coverage persistence plain extra")
def _(t):
    return Ln.ablation(extra_features(t), EXTRA, VAL_YEARS)


@entry(
    "feature_ablation_folds",
    f"""WITH {FEATURES_SQL}, dam AS (SELECT (site + 2) % 4 AS basin, d, q AS dam, lag(q) OVER w AS dam_lag1, q - lag(q) OVER w AS dam_chg FROM v2 WHERE day(d) % 4 <> 0 WINDOW w AS (PARTITION BY site ORDER BY d)),
        x AS (SELECT basin, d, q, y_h1, (CAST(dam IS NOT NULL AS INT) + CAST(dam_lag1 IS NOT NULL AS INT) + CAST(dam_chg IS NOT NULL AS INT)) / 3.0::DOUBLE AS there FROM feats LEFT JOIN dam USING (basin, d) WHERE y_h1 IS NOT NULL),
        tr AS (SELECT basin, f.y AS val_year, count(*) AS n_train FROM x, {FOLDS} WHERE year(d) < f.y GROUP BY 1, 2),
        te AS (SELECT basin, year(d) AS val_year, count(*) AS n_test, avg(there) AS coverage, avg(abs(y_h1 - q)) AS persistence FROM x WHERE month(d) BETWEEN 6 AND 9 GROUP BY 1, 2),
        j AS (SELECT b.basin, f.y AS val_year, COALESCE(n_train, 0) AS n_train, COALESCE(n_test, 0) AS n_test, coverage, persistence FROM (SELECT DISTINCT basin FROM feats) b CROSS JOIN {FOLDS}
          LEFT JOIN tr ON tr.basin = b.basin AND tr.val_year = f.y LEFT JOIN te ON te.basin = b.basin AND te.val_year = f.y)
        SELECT *, CASE WHEN n_train < 60 THEN 'few training rows' WHEN n_test < 30 OR COALESCE(coverage, 0) < 0.5 THEN 'thin coverage' END AS skipped FROM j""",
    num="coverage persistence",
)
def _(t):
    return Ln.ablation_folds(extra_features(t), EXTRA, VAL_YEARS)


MARKS_SQL = "(SELECT site, CASE WHEN site <> 3 THEN 180.0 END AS thr FROM (SELECT DISTINCT site FROM v2))"


def warning_marks(t):
    return t.stored("v2").select("site").distinct().withColumn("thr", F.when(F.col("site") != 3, 180.0))


def forecasts(t):
    return t.v4.withColumnRenamed("lead_d", "lead")


@entry(
    "lead_bucket_score",
    f"""WITH b AS (SELECT * FROM (VALUES ('6h', 3, 9), ('12h', 9, 18), ('24h', 18, 36), ('48h', 36, 60), ('72h', 60, 96), ('7d', 96, 192)) v(bucket, lo, hi)),
       p AS (SELECT f.site, bucket, f.fc, o.q AS obs, i.q AS pers FROM v4 f JOIN b ON lead_d >= lo AND lead_d < hi LEFT JOIN v2 o ON o.site = f.site AND o.d = f.target ASOF LEFT JOIN v2 i ON i.site = f.site AND f.issued >= i.d
         UNION ALL SELECT DISTINCT site, bucket, NULL, NULL, NULL FROM v4, b),
       s AS (SELECT site, bucket, count(*) FILTER (obs IS NOT NULL AND pers IS NOT NULL) AS n, avg(abs(fc - obs)) FILTER (pers IS NOT NULL) AS mae, avg(abs(pers - obs)) AS mp, avg(fc - obs) FILTER (pers IS NOT NULL) AS bias FROM p GROUP BY 1, 2),
       e AS (SELECT site, thr, count(*) FILTER (obs IS NOT NULL AND fc IS NOT NULL) AS n, count(*) FILTER (obs >= thr AND fc IS NOT NULL) AS a, count(*) FILTER (fc >= thr AND obs IS NOT NULL) AS c, count(*) FILTER (obs >= thr AND fc >= thr) AS h FROM p JOIN {MARKS_SQL} USING (site) WHERE bucket = '24h' GROUP BY 1, 2)
       SELECT s.site, s.bucket, s.n, CASE WHEN s.n >= 12 THEN 'ok' ELSE 'insufficient' END AS status, CASE WHEN s.n >= 12 THEN mae END AS mae, CASE WHEN s.n >= 12 THEN mp END AS mae_persistence, CASE WHEN s.n >= 12 THEN 1 - mae / mp END AS skill,
         CASE WHEN s.n >= 12 THEN bias END AS bias, CASE WHEN e.site IS NOT NULL THEN CASE WHEN thr IS NULL THEN 'no threshold' WHEN e.n = 0 THEN 'no pairs' WHEN a = 0 AND c = 0 THEN 'no crossings' ELSE 'ok' END END AS ev_status,
         CASE WHEN thr IS NOT NULL AND a + c > 0 THEN a END AS observed_above, CASE WHEN thr IS NOT NULL AND a + c > 0 THEN c END AS forecast_above, CASE WHEN a + c > 0 THEN h / NULLIF(a, 0) END AS pod, CASE WHEN a + c > 0 THEN (c - h) / NULLIF(c, 0) END AS far
       FROM s LEFT JOIN e ON e.site = s.site AND s.bucket = '24h'""",
    num="mae mae_persistence skill bias pod far",
)
def _(t):
    return V.lead_bucket_score(forecasts(t), t.stored("v2"), warning_marks(t))


@entry(
    "lead_day_score",
    f"""WITH p AS (SELECT f.site, lead_d AS lead, f.fc, o.q AS obs, i.q AS pers FROM v4 f LEFT JOIN v2 o ON o.site = f.site AND o.d = f.target LEFT JOIN v2 i ON i.site = f.site AND f.issued = i.d WHERE lead_d IN (1, 2, 3, 5, 7)
         UNION ALL SELECT DISTINCT site, l.lead, NULL, NULL, NULL FROM v4, (VALUES (1), (2), (3), (5), (7)) l(lead)),
       s AS (SELECT site, lead, count(*) FILTER (obs IS NOT NULL AND pers IS NOT NULL) AS n, avg(abs(fc - obs)) FILTER (pers IS NOT NULL) AS mae, avg(abs(pers - obs)) AS mp, avg(fc - obs) FILTER (pers IS NOT NULL) AS bias FROM p GROUP BY 1, 2),
       e AS (SELECT site, thr, count(*) FILTER (obs IS NOT NULL AND fc IS NOT NULL) AS n, count(*) FILTER (obs >= thr AND fc IS NOT NULL) AS a, count(*) FILTER (fc >= thr AND obs IS NOT NULL) AS c, count(*) FILTER (obs >= thr AND fc >= thr) AS h FROM p JOIN {MARKS_SQL} USING (site) WHERE lead = 1 GROUP BY 1, 2)
       SELECT s.site, s.lead, s.n, CASE WHEN s.n >= 8 THEN 'ok' ELSE 'insufficient' END AS status, CASE WHEN s.n >= 8 THEN mae END AS mae, CASE WHEN s.n >= 8 THEN mp END AS mae_persistence, CASE WHEN s.n >= 8 THEN 1 - mae / mp END AS skill,
         CASE WHEN s.n >= 8 THEN bias END AS bias, CASE WHEN e.site IS NOT NULL THEN CASE WHEN thr IS NULL THEN 'no threshold' WHEN e.n = 0 THEN 'no pairs' WHEN a = 0 AND c = 0 THEN 'no crossings' ELSE 'ok' END END AS ev_status,
         CASE WHEN thr IS NOT NULL AND a + c > 0 THEN a END AS observed_above, CASE WHEN thr IS NOT NULL AND a + c > 0 THEN c END AS forecast_above, CASE WHEN a + c > 0 THEN h / NULLIF(a, 0) END AS pod, CASE WHEN a + c > 0 THEN (c - h) / NULLIF(c, 0) END AS far
       FROM s LEFT JOIN e ON e.site = s.site AND s.lead = 1""",
    num="mae mae_persistence skill bias pod far",
)
def _(t):
    return V.lead_day_score(forecasts(t), t.stored("v2"), warning_marks(t), min_pairs=8)


@entry(
    "out_of_sample_report",
    f"""WITH {PREDS_SQL}, r AS (SELECT basin, actual - pred AS e FROM preds WHERE candidate = 'lag_rule' AND h = 1 AND val_year < 2001 AND actual - pred IS NOT NULL),
       p AS (SELECT preds.basin, d, actual, pred, thr FROM preds JOIN thr4 USING (basin, val_year) WHERE candidate = 'lag_rule' AND h = 1 AND val_year = 2001),
       pe AS (SELECT p.basin, p.d, avg((pred + e >= thr)::INT) AS pp FROM p JOIN r ON r.basin = p.basin WHERE pred IS NOT NULL GROUP BY 1, 2),
       g AS (SELECT p.basin, count(*) AS n_days, count(*) FILTER (actual >= thr) AS n_exceed, count(*) FILTER (actual >= thr AND pred >= thr) AS n_correct, count(*) FILTER (pred >= thr AND NOT COALESCE(actual >= thr, false)) AS n_false, avg(pp) AS mean_p, min(d) FILTER (pred >= thr) - 1 AS first_alarm
         FROM p LEFT JOIN pe USING (basin, d) GROUP BY 1),
       ex AS (SELECT *, COALESCE(actual >= thr, false) AS e, COALESCE(lag(COALESCE(actual >= thr, false)) OVER (PARTITION BY basin ORDER BY d), false) AS pex FROM p),
       isl AS (SELECT *, d - CAST(row_number() OVER (PARTITION BY basin ORDER BY d) AS INT) AS k FROM ex WHERE e), ev AS (SELECT basin, min(d) AS onset, min(d) FILTER (pred >= thr) AS al, arg_min(NOT pex, d) AS st FROM isl GROUP BY basin, k),
       le AS (SELECT basin, count(*) AS n_onsets, count(al) AS n_detected, avg(onset - al + 1) AS mean_lead FROM ev WHERE st GROUP BY 1)
       SELECT g.*, COALESCE(n_onsets, 0) AS n_onsets, COALESCE(n_detected, 0) AS n_detected, mean_lead FROM g LEFT JOIN le USING (basin)""",
    num="mean_p mean_lead",
    text="first_alarm",
)
def _(t):
    f = stored_frame(t)
    p = B.predictions(f, VAL_YEARS).filter("candidate = 'lag_rule' AND h = 1")
    res = B.residuals(p.filter("val_year < 2001"))
    thr = B.fold_quantiles(f, ["basin"], "d", "q", [2001]).drop("val_year")
    return V.out_of_sample_report(p.filter("val_year = 2001").select("basin", "d", "actual", "pred"), res, thr)


@entry(
    "metric_registry",
    f"""WITH {THR_SQL}, h AS (SELECT site, count(*) || '-' || sum(('0x' || substr(md5('{{"site":"' || site || '","d":"' || d || '","q":"' || CAST(q AS BIGINT) || '"}}'), 1, 15))::BIGINT::HUGEINT) AS data_hash FROM v2 GROUP BY 1)
        SELECT site, val_year, data_hash FROM thr JOIN h USING (site)""",
)
def _(t):
    thr = B.fold_quantiles(t.v2, ["site"], "d", "q", VAL_YEARS)
    return V.stamp_metrics(thr, t.v2.withColumn("q", F.col("q").cast("bigint")), ["site"], ["site", "d", "q"]).drop("thr")


@entry(
    "metric_golden_mismatch",
    f"WITH {THR_SQL} SELECT site, val_year, 'thr' AS metric, thr + 1 AS golden, thr AS now FROM thr WHERE site = 1 UNION ALL SELECT site, 2002, 'thr', thr, NULL FROM thr WHERE val_year = 2001",
    num="golden now",
)
def _(t):
    thr = B.fold_quantiles(t.v2, ["site"], "d", "q", VAL_YEARS)
    # a golden table that differs for one site and knows a season this run does not have
    golden = thr.withColumn("thr", F.col("thr") + F.when(F.col("site") == 1, 1.0).otherwise(0.0)).unionByName(
        thr.filter("val_year = 2001").withColumn("val_year", F.lit(2002))
    )
    return V.metric_mismatches(thr, golden, ["site", "val_year"], ["thr"])


@entry(
    "label_store_build",
    """WITH a AS (SELECT *, COALESCE(q >= 200, false) AS up, row_number() OVER (PARTITION BY site ORDER BY d) AS rn FROM v2), b AS (SELECT *, rn - row_number() OVER (PARTITION BY site ORDER BY d) AS g FROM a WHERE up),
       m AS (SELECT 'model_' || site || '_' || min(d) AS event_id, CAST(site AS VARCHAR) AS basin, CAST(min(d) AS VARCHAR) AS onset, CAST(max(d) AS VARCHAR) AS "end", max(q) AS peak, 'modelled series' AS source, 'medium' AS confidence FROM b GROUP BY site, g),
       c AS (SELECT *, mm >= 100 AS up, row_number() OVER (PARTITION BY point_id ORDER BY h) AS rn FROM v1), e AS (SELECT *, rn - row_number() OVER (PARTITION BY point_id ORDER BY h) AS g FROM c WHERE up),
       o AS (SELECT 'gauge_' || point_id || '_' || min(h) AS event_id, CAST(point_id AS VARCHAR) AS basin, CAST(min(h) AS VARCHAR) AS onset, CAST(max(h) AS VARCHAR) AS "end", max(mm) AS peak, 'official gauge' AS source, 'high' AS confidence FROM e GROUP BY point_id, g)
       SELECT * FROM m UNION ALL SELECT event_id, basin, onset, "end", peak + CASE WHEN CAST(onset AS INT) < 300 THEN 1 ELSE 0 END, source, confidence FROM o""",
    num="peak",
)
def _(t):
    modelled = Lb.event_rows(t.v2, "site", "d", "q", F.lit(200.0), "model", "modelled series", "medium")
    crossings = Lb.event_rows(t.v1, "point_id", "h", "mm", F.lit(100.0), "gauge", "official gauge", "high")
    # the archived store: early crossings (with their own peak, which must stay) and an old modelled slice
    known = crossings.filter("CAST(onset AS INT) < 300").withColumn("peak", F.col("peak") + 1).unionByName(modelled.filter("basin = '0'").withColumn("peak", F.lit(0.0)))
    return Lb.build_store(known, modelled, crossings, "official gauge")
