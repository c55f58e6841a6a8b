"""Aggregations (2.5)."""

from pyspark.sql import functions as F

from freshet.catalog.joins import daily_frame
from freshet.catalog.registry import entry
from freshet.catalog.screens import MODES_SQL, VAL_YEARS, gauge_days
from freshet.catalog.windows import STATES_SQL, states
from freshet.operators import aggregates as A
from freshet.operators import joins as J
from freshet.operators import quality as Q
from freshet.operators import raster as X
from freshet.plans import baselines as B


@entry(
    "daily_total",
    "SELECT point_id, h // 24 AS d, COALESCE(SUM(CASE WHEN NOT (point_id = 3 AND h // 24 % 5 = 0) THEN mm END), 0) AS total FROM v1 GROUP BY 1, 2",
    num="total",
)
def _(t):
    silent = (F.col("point_id") == 3) & (F.floor(F.col("h") / 24) % 5 == 0)
    return A.daily_total(t.v1.withColumn("mm", F.when(~silent, F.col("mm"))), ["point_id"], F.floor(F.col("h") / 24), "mm")


@entry("daily_mean", "SELECT station, CAST(ts - INTERVAL 330 MINUTE AS DATE) AS d, AVG(value) AS mean FROM v1r GROUP BY 1, 2", num="mean", text="d")
def _(t):
    from freshet.functions.scalars import local_to_utc

    return A.daily_mean(t.v1r, ["station"], local_to_utc(F.col("ts")).cast("date"), "value")


@entry("offset_day_total", "SELECT station, CAST(ts + INTERVAL 21 HOUR AS DATE) AS d, SUM(value) AS total FROM v1r GROUP BY 1, 2", num="total", text="d")
def _(t):
    return A.daily_total(t.v1r, ["station"], A.offset_day(F.col("ts")), "value")


THR_SQL = """thr AS (SELECT site, y AS val_year, quantile_cont(q, 0.9) AS thr FROM v2, (VALUES (1998), (1999), (2000), (2001)) f(y)
       WHERE year(d) < y AND month(d) BETWEEN 6 AND 9 GROUP BY 1, 2)"""


@entry("train_quantile", f"WITH {THR_SQL} SELECT * FROM thr", num="thr")
def _(t):
    return B.fold_quantiles(t.v2, ["site"], "d", "q", VAL_YEARS)


@entry(
    "error_metrics",
    """WITH p AS (SELECT site, q AS a, lag(q, 2) OVER w AS p, lag(q) OVER w AS s FROM v2 WINDOW w AS (PARTITION BY site ORDER BY d)), c AS (SELECT * FROM p WHERE p IS NOT NULL)
       SELECT site, count(*) AS n, avg(abs(p - a)) AS mae, sqrt(avg(pow(p - a, 2))) AS rmse, avg(abs(s - a)) AS mae_persistence, 1 - avg(abs(p - a)) / avg(abs(s - a)) AS skill, avg(p - a) AS bias FROM c GROUP BY 1""",
    num="mae rmse mae_persistence skill bias",
)
def _(t):
    p = J.lagged(J.lagged(t.v2, "site", "d", "q", 2, "pred"), "site", "d", "q", 1, "pers")
    return A.error_metrics(p, ["site"], "q", "pred", "pers")


@entry(
    "contingency",
    """SELECT doc_id % 5 AS g, count(*) FILTER (a) AS n_actual, count(*) FILTER (p) AS n_predicted, count(*) FILTER (a AND p) AS n_hits,
         count(*) FILTER (a AND p) / NULLIF(count(*) FILTER (a), 0) AS pod, count(*) FILTER (p AND NOT a) / NULLIF(count(*) FILTER (p), 0) AS far
       FROM (SELECT doc_id, quality = 1 AND doc_id % 5 <> 4 AS a, toxic = 1 OR doc_id % 3 = 0 AS p FROM v9) GROUP BY 1""",
    num="pod far",
)
def _(t):
    g = F.col("doc_id") % 5
    actual = (F.col("quality") == 1) & (g != 4)
    return A.contingency(t.v9.withColumn("g", g), ["g"], actual, (F.col("toxic") == 1) | (F.col("doc_id") % 3 == 0))


@entry(
    "pearson_pair",
    """SELECT a.site, count(*) AS n, corr(a.q, b.q) AS r, avg(a.q) AS mean_a, avg(b.q) AS mean_b, avg(a.q) / avg(b.q) AS bias, avg(abs(a.q - b.q)) AS mae
       FROM v2 a JOIN v2 b ON b.site = (a.site + 1) % 4 AND b.d = a.d GROUP BY 1""",
    num="r mean_a mean_b bias mae",
)
def _(t):
    other = t.v2.select(((F.col("site") + 3) % 4).alias("site"), "d", F.col("q").alias("other"))
    return A.pearson_pair(t.v2.join(other, ["site", "d"]), ["site"], "q", "other")


@entry(
    "median_of_metrics",
    """WITH s AS (SELECT user_id, user_id % 3 AS org, avg(value) AS mean, max(value) AS peak FROM events GROUP BY 1)
       SELECT org, count(*) AS n, median(mean) AS median_mean, median(peak) AS median_peak FROM s GROUP BY 1""",
    num="median_mean median_peak",
)
def _(t):
    per = t.table("events").groupBy("user_id").agg(F.avg("value").alias("mean"), F.max("value").alias("peak"))
    return A.median_by(per.withColumn("org", F.col("user_id") % 3), ["org"], ["mean", "peak"])


@entry(
    "empirical_percentile",
    """SELECT p.site, p.d, count(*) AS n_ref, CASE WHEN count(*) >= 60 THEN avg((r.q <= p.q)::INT) END AS share FROM (SELECT * FROM v2 WHERE year(d) >= 1997) p
       JOIN v2 r ON r.site = p.site AND year(r.d) < 1997 AND least(abs(dayofyear(r.d) - dayofyear(p.d)), 366 - abs(dayofyear(r.d) - dayofyear(p.d))) <= 15 GROUP BY 1, 2""",
    num="share",
    text="d",
)
def _(t):
    probe = t.v2.filter("year(d) >= 1997").withColumnRenamed("q", "v")
    return A.seasonal_percentile(t.v2.filter("year(d) < 1997"), probe, "site", "d", "q", "v").drop("v")


@entry(
    "residual_exceedance",
    """WITH l AS (SELECT *, lag(q) OVER (PARTITION BY site ORDER BY d) AS p FROM v2), r AS (SELECT site, q - p AS e FROM l WHERE year(d) BETWEEN 1998 AND 2000 AND month(d) BETWEEN 6 AND 9 AND p IS NOT NULL)
       SELECT l.site, l.d, avg((p + e >= 200)::INT) AS p_elevated, avg((p + e >= 260)::INT) AS p_extreme FROM l JOIN r USING (site) WHERE year(d) = 2001 GROUP BY 1, 2""",
    num="p_elevated p_extreme",
    text="d",
)
def _(t):
    lagged = J.lagged(t.v2, "site", "d", "q", 1, "p")
    res = lagged.filter(F.year("d").between(1998, 2000) & A.in_season("d")).select("site", (F.col("q") - F.col("p")).alias("e"))
    preds = lagged.filter("year(d) = 2001").withColumn("thr", F.lit(200.0)).withColumn("thr_hi", F.lit(260.0))
    out = A.residual_exceedance(preds, res, "site", "p", "e", {"p_elevated": "thr", "p_extreme": "thr_hi"})
    return out.select("site", "d", "p_elevated", "p_extreme")


DRIFT_SQL = """hist AS (SELECT site, 'q' AS input, d, q AS value FROM v2 WHERE year(d) < 2001 UNION ALL SELECT point_id, 'rain', d, CASE WHEN NOT (point_id = 2 AND month(d) BETWEEN 5 AND 8) THEN mm END FROM v3 WHERE year(d) < 2001),
       live AS (SELECT site, 'q' AS input, d, q * (0.8 + site * 0.4) AS v FROM v2 WHERE d = DATE '2001-06-30'
         UNION ALL SELECT p, 'rain', d, q * 0.2 FROM v2, (VALUES (0, 0), (1, 1), (2, 2), (3, 3), (0, 4), (1, 5)) x(s, p) WHERE site = s AND d = DATE '2001-06-30'),
       refs AS (SELECT l.site, l.input, 'seasonal' AS kind, h.value, l.v FROM live l JOIN hist h ON h.site = l.site AND h.input = l.input
           AND least(abs(dayofyear(h.d) - dayofyear(l.d)), 366 - abs(dayofyear(h.d) - dayofyear(l.d))) <= 15
         UNION ALL SELECT l.site, l.input, 'all', h.value, l.v FROM live l JOIN hist h ON h.site = l.site AND h.input = l.input AND month(h.d) BETWEEN 6 AND 9),
       st AS (SELECT site, input, kind, count(value) AS n, avg((value <= v)::INT) AS share, any_value(v) AS v, min(value) AS lo, max(value) AS hi, quantile_cont(value, 0.01) AS a, quantile_cont(value, 0.99) AS b FROM refs GROUP BY 1, 2, 3),
       sx AS (SELECT *, CASE WHEN n < 30 OR v IS NULL THEN 'unknown' WHEN v > hi OR v < lo THEN 'out-of-range' WHEN v > b OR v < a THEN 'extreme' ELSE 'in-range' END AS status FROM st),
       drift AS (SELECT live.site, live.input, live.v, COALESCE(s.status, 'unknown') AS seasonal_status, CASE WHEN s.status <> 'unknown' THEN s.share END AS seasonal_share,
         COALESCE(m.status, 'unknown') AS season_all_status, CASE WHEN m.status <> 'unknown' THEN m.share END AS season_all_share
       FROM live LEFT JOIN sx s ON s.site = live.site AND s.input = live.input AND s.kind = 'seasonal' LEFT JOIN sx m ON m.site = live.site AND m.input = live.input AND m.kind = 'all')"""


@entry(
    "drift_status",
    f"""WITH {DRIFT_SQL} SELECT *, CASE max(CASE seasonal_status WHEN 'out-of-range' THEN 2 WHEN 'extreme' THEN 1 ELSE 0 END) OVER (PARTITION BY site)
        WHEN 2 THEN 'out-of-range' WHEN 1 THEN 'extreme' ELSE 'in-range' END AS overall FROM drift""",
    num="v seasonal_share season_all_share",
)
def _(t):
    # one point misses its values of the season
    rain = t.v3.withColumn("mm", F.expr("CASE WHEN NOT (point_id = 2 AND month(d) BETWEEN 5 AND 8) THEN mm END"))
    hist = t.stored("v2").select("site", F.lit("q").alias("input"), "d", F.col("q").alias("value")).unionByName(
        rain.select(F.col("point_id").alias("site"), F.lit("rain").alias("input"), "d", F.col("mm").alias("value"))
    )
    q = t.stored("v2")
    last = q.filter("d = date'2001-06-30'")
    live = last.select("site", F.lit("q").alias("input"), "d", (F.col("q") * (F.lit(0.8) + F.col("site") * 0.4)).alias("v")).unionByName(
        last.select(F.expr("explode(filter(array(site, site + 4), p -> p < 6))").alias("site"), F.lit("rain").alias("input"), "d", (F.col("q") * 0.2).alias("v"))
    )
    return A.drift_status(hist.filter("year(d) < 2001"), live, "site", "d", "value").drop("d")


@entry(
    "heavy_day_detection",
    """SELECT a.point_id, month(a.d) BETWEEN 6 AND 9 AS season, count(*) FILTER (a.mm >= 25) AS heavy_days, count(*) FILTER (a.mm >= 25 AND b.mm >= 25) AS hit_strict,
         count(*) FILTER (a.mm >= 25 AND b.mm >= 10) AS hit_lenient, count(*) FILTER (a.mm >= 25 AND b.mm >= 25) / NULLIF(count(*) FILTER (a.mm >= 25), 0) AS pod_strict,
         count(*) FILTER (a.mm >= 25 AND b.mm >= 10) / NULLIF(count(*) FILTER (a.mm >= 25), 0) AS pod_lenient, count(*) FILTER (b.mm >= 25 AND a.mm < 10) AS false_alarm_days
       FROM (SELECT point_id, d, mm % 64 AS mm FROM v3) a JOIN (SELECT point_id, d, mm % 64 AS mm FROM v3) b ON b.point_id = (a.point_id + 1) % 6 AND b.d = a.d GROUP BY 1, 2""",
    num="pod_strict pod_lenient",
)
def _(t):
    rain = t.v3.withColumn("mm", F.col("mm") % 64)
    test = rain.select(((F.col("point_id") + 5) % 6).alias("point_id"), "d", F.col("mm").alias("fc"))
    j = rain.join(test, ["point_id", "d"]).withColumn("season", A.in_season("d"))
    return j.groupBy("point_id", "season").agg(*A.heavy_columns("mm", "fc"))


@entry(
    "wet_day_agreement",
    """WITH g AS (SELECT point_id, d, CASE WHEN NOT (point_id = 2 AND year(d) > 1995) THEN greatest(mm % 32 - 16, 0) END AS gauge FROM v3), m AS (SELECT (point_id + 3) % 6 AS point_id, d, greatest(mm % 32 - 16, 0) AS model FROM v3)
       SELECT point_id, count(*) AS n_days, count(*) FILTER (gauge >= 1) AS n_wet, avg((model >= 1)::INT) FILTER (gauge >= 1) AS wet_when_wet, avg((model >= 1)::INT) FILTER (gauge < 1) AS wet_when_dry
       FROM g JOIN m USING (point_id, d) WHERE gauge IS NOT NULL GROUP BY 1 HAVING count(*) >= 400 AND count(*) FILTER (gauge >= 1) >= 10 AND count(*) FILTER (gauge < 1) >= 10""",
    num="wet_when_wet wet_when_dry",
)
def _(t):
    less = F.greatest(F.col("mm") % 32 - 16, F.lit(0.0))
    # one gauge stops early; the model is read at another point
    g = t.v3.select("point_id", "d", F.when(~((F.col("point_id") == 2) & (F.year("d") > 1995)), less).alias("gauge"))
    m = t.v3.select(((F.col("point_id") + 3) % 6).alias("point_id"), "d", less.alias("model"))
    return A.wet_day_agreement(g, m, ["point_id"], "gauge", "model", min_days=400)


MVO_SQL = """WITH j AS (SELECT site * 100 + month(v2.d) AS st, q AS o, mm * CASE WHEN site = 1 THEN 40 ELSE 5 END AS m FROM v2 JOIN v3 ON point_id = site AND v3.d = v2.d
           WHERE NOT (site = 2 AND day(v2.d) > 1) AND NOT (site = 3 AND (day(v2.d) > 1 OR year(v2.d) > 1998))),
       g AS (SELECT st, count(*) AS n, avg(o) AS obs_mean, avg(m) AS mod_mean, avg(abs(m - o)) AS mae, corr(o, m) AS c FROM j GROUP BY 1),
       s AS (SELECT st, n, CASE WHEN n >= 5 THEN 'ok' ELSE 'insufficient' END AS status, CASE WHEN n >= 5 THEN mod_mean / obs_mean END AS ratio, CASE WHEN n >= 5 THEN mod_mean - obs_mean END AS bias,
         CASE WHEN n >= 5 THEN mae END AS mae, CASE WHEN n >= 5 THEN mae / obs_mean END AS rel_mae, CASE WHEN n >= 7 THEN c END AS corr FROM g),
       scores AS (SELECT *, COALESCE(ratio > 5 OR ratio < 0.2, false) AS implausible FROM s)"""


def model_scores(t):
    j = t.v2.join(t.v3.withColumnRenamed("point_id", "site"), ["site", "d"])
    there = F.expr("NOT (site = 2 AND day(d) > 1) AND NOT (site = 3 AND (day(d) > 1 OR year(d) > 1998))")
    model = F.when(there, F.col("mm") * F.when(F.col("site") == 1, 40).otherwise(5))
    j = j.select((F.col("site") * 100 + F.month("d")).alias("st"), F.col("q").alias("o"), model.alias("m"))
    return A.model_vs_observed(j, ["st"], "o", "m")


@entry("model_vs_observed", f"{MVO_SQL} SELECT * FROM scores", num="ratio bias mae rel_mae corr")
def _(t):
    return model_scores(t).drop("obs_mean", "mod_mean")


@entry(
    "model_vs_observed_medians",
    f"""{MVO_SQL} SELECT count(*) AS n_stations, count(*) FILTER (implausible) AS n_implausible, median(ratio) FILTER (status = 'ok' AND NOT implausible) AS median_ratio,
        median(rel_mae) FILTER (status = 'ok' AND NOT implausible) AS median_rel_mae, median(corr) FILTER (status = 'ok' AND NOT implausible) AS median_corr FROM scores""",
    num="median_ratio median_rel_mae median_corr",
)
def _(t):
    return A.plausible_medians(model_scores(t), ["ratio", "rel_mae", "corr"])


SLOPES_SQL = """season AS (SELECT basin, d, q, rain_24h, rain_48h FROM frame WHERE month(d) BETWEEN 6 AND 9),
       ch AS (SELECT basin, d, 1 AS h, rain_24h AS x, lead(q, 1) OVER w - q AS dy, lead(d, 1) OVER w AS u FROM season WINDOW w AS (PARTITION BY basin ORDER BY d)
         UNION ALL SELECT basin, d, 2, rain_48h, lead(q, 2) OVER w - q, lead(d, 2) OVER w FROM season WINDOW w AS (PARTITION BY basin ORDER BY d)),
       slopes AS (SELECT basin, f.y AS val_year, h, COALESCE(sum(x * dy) FILTER (year(u) < f.y) / NULLIF(sum(x * x) FILTER (year(u) < f.y AND dy IS NOT NULL), 0), 0) AS slope
         FROM ch, (VALUES (1998), (1999), (2000), (2001)) f(y) WHERE year(d) < f.y GROUP BY 1, 2, 3)"""


@entry("origin_slope", f"WITH {SLOPES_SQL} SELECT * FROM slopes", num="slope")
def _(t):
    return B.fold_slopes(daily_frame(t), VAL_YEARS)


@entry(
    "doy_climatology",
    """SELECT site AS basin, f.y AS val_year, doy, avg(q) AS clim FROM v2, (VALUES (1998), (1999), (2000), (2001)) f(y), range(1, 367) r(doy)
       WHERE year(d) < f.y AND least(abs(dayofyear(d) - doy), 366 - abs(dayofyear(d) - doy)) <= 7 GROUP BY 1, 2, 3""",
    num="clim",
)
def _(t):
    return B.climatology(t.v2.withColumnRenamed("site", "basin"), VAL_YEARS)


@entry(
    "gap_report",
    """WITH x AS (SELECT site, d, CASE WHEN dayofyear(d) % 50 <> 0 THEN q END AS q FROM v2),
       s AS (SELECT site, unnest(range(1994, 2003)) AS year FROM (SELECT DISTINCT site FROM v2)), g AS (SELECT site, year(d) AS year, count(*) AS n, count(*) FILTER (q IS NULL) AS k, count(*) FILTER (q IS NULL AND month(d) BETWEEN 5 AND 10) AS ks FROM x GROUP BY 1, 2)
       SELECT site, year, COALESCE(n, 0) AS n_rows, dayofyear(make_date(year, 12, 31)) AS expected, COALESCE(k, 0) AS n_null, COALESCE(ks, 0) AS n_null_season,
         greatest(dayofyear(make_date(year, 12, 31)) - COALESCE(n, 0), 0) AS n_short, n IS NULL AS missing FROM s LEFT JOIN g USING (site, year)""",
)
def _(t):
    x = t.v2.withColumn("q", F.when(F.dayofyear("d") % 50 != 0, F.col("q")))
    years = t.v2.select("site").distinct().withColumn("year", F.explode(F.sequence(F.lit(1994), F.lit(2002))))
    return A.gap_report(x, "site", "d", "q", years)


@entry(
    "archive_health",
    """SELECT point_id, max(h) - min(h) + 1 AS span_hours, COALESCE(max(gap) - 1, 0) AS longest_gap, max(h) - min(h) + 1 - count(*) AS missing_hours FROM
       (SELECT point_id, h, lead(h) OVER (PARTITION BY point_id ORDER BY h) - h AS gap FROM v1) GROUP BY 1""",
)
def _(t):
    return A.archive_health(t.v1, ["point_id"], "h")


@entry(
    "quality_by_year",
    "SELECT year(d) AS year, count(*) AS n_rows, avg((q % 10 = 0)::INT) AS review_share, avg((q > 250)::INT) AS impossible_share FROM v2 GROUP BY 1",
    num="review_share impossible_share",
)
def _(t):
    return A.quality_by_year(t.v2, "d", F.col("q") % 10 == 0, F.col("q") > 250)


@entry(
    "colour_counts",
    """SELECT district, count(*) FILTER (c = 'GREEN') AS n_green, count(*) FILTER (c = 'YELLOW') AS n_yellow, count(*) FILTER (c = 'RED') AS n_red FROM
       (SELECT district, CASE WHEN level >= 7000 THEN 'RED' WHEN level >= 4000 THEN 'YELLOW' ELSE 'GREEN' END AS c FROM v5v) GROUP BY 1""",
)
def _(t):
    lvl = F.col("level")
    c = F.when(lvl >= 7000, "RED").when(lvl >= 4000, "YELLOW").otherwise("GREEN")
    return A.colour_counts(t.v5v.withColumn("c", c), ["district"], "c")


@entry(
    "saturation_share",
    f"SELECT point_id, count(*) AS n_steps, count(*) FILTER (state <> 'GREEN') AS n_elevated, avg((state <> 'GREEN')::INT) AS share FROM ({STATES_SQL}) GROUP BY 1",
    num="share",
)
def _(t):
    return A.saturation_share(states(t), ["point_id"], "state")


@entry(
    "pivot_entities",
    "SELECT d, max(q) FILTER (site = 0) AS q0, max(q) FILTER (site = 1) AS q1, max(q) FILTER (site = 2) AS q2, max(q) FILTER (site = 3) AS q3 FROM v2 GROUP BY 1",
    num="q0 q1 q2 q3",
    text="d",
)
def _(t):
    return A.pivot_mean(t.v2, "d", "site", "q", [0, 1, 2, 3], "q")


@entry("reason_counts", f"WITH {MODES_SQL} SELECT excluded AS reason, count(*) AS n FROM modes WHERE excluded IS NOT NULL GROUP BY 1")
def _(t):
    modes = Q.sensor_modes(gauge_days(t), "station", min_rows=200)
    return A.reason_counts(modes.withColumnRenamed("excluded", "reason"), "reason")


@entry("block_average", "SELECT vec_id, r // 3 AS r, c // 3 AS c, avg(v) AS v FROM v6 WHERE r < 6 AND c < 6 AND v < 0.1 GROUP BY 1, 2, 3", num="v")
def _(t):
    return X.block_average(t.v6.withColumn("v", F.when(F.col("v") < 0.1, F.col("v"))), ["vec_id"], "r", "c", "v", 3).filter("v IS NOT NULL")


@entry(
    "coarsen_or",
    """WITH m AS (SELECT vec_id, f AS factor, r // f AS r, c // f AS c FROM v6, (VALUES (1), (2), (4), (8)) x(f) WHERE v < 0 GROUP BY 1, 2, 3, 4),
       k AS (SELECT vec_id, factor, r, min(c) AS c_from, max(c) + 1 AS c_to FROM (SELECT *, c - row_number() OVER (PARTITION BY vec_id, factor, r ORDER BY c) AS g FROM m) GROUP BY vec_id, factor, r, g),
       n AS (SELECT vec_id, min(factor) AS factor FROM (SELECT vec_id, factor, count(*) AS n FROM k GROUP BY 1, 2) WHERE n <= 17 OR factor = 8 GROUP BY 1)
       SELECT k.* FROM k JOIN n USING (vec_id, factor)""",
)
def _(t):
    return X.coarsened_runs(t.v6.withColumn("water", F.col("v") < 0), ["vec_id"], "r", "c", "water", 17)


@entry(
    "live_share_gate",
    """SELECT source, count(*) FILTER (live) AS n_live, count(*) AS n_all, count(*) FILTER (live) / count(*) AS share, count(*) FILTER (live) / count(*) >= 0.5 AS passes
       FROM (SELECT CASE WHEN point_id < 4 THEN 'rain' ELSE 'rivers' END AS source, mm >= CASE WHEN point_id < 4 THEN 10 ELSE 40 END AS live FROM v1 WHERE h >= 696) GROUP BY 1""",
    num="share",
)
def _(t):
    p = F.col("point_id") < 4
    x = t.v1.filter("h >= 696").withColumn("source", F.when(p, "rain").otherwise("rivers"))
    return A.live_share(x, "source", F.col("mm") >= F.when(p, 10).otherwise(40))
