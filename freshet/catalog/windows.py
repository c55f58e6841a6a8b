"""Window functions (2.6)."""

from pyspark.sql import functions as F

from freshet.catalog.registry import entry
from freshet.operators import aggregates as A
from freshet.operators import archive_rows as R
from freshet.operators import joins as J
from freshet.operators import raster as X
from freshet.operators import spatial as P
from freshet.operators import windows as Wn
from freshet.operators.chunks import chunk_width


@entry(
    "rolling_hour_sums",
    """WITH g AS (SELECT point_id, unnest(range(lo, hi + 1)) AS h FROM (SELECT point_id, min(h) AS lo, max(h) AS hi FROM v1 GROUP BY 1)),
       x AS (SELECT g.point_id, g.h, v1.mm FROM g LEFT JOIN v1 ON v1.point_id = g.point_id AND v1.h = g.h),
       r AS (SELECT point_id, h,
         CASE WHEN count(mm) OVER a = 6 THEN sum(mm) OVER a END AS r6, CASE WHEN count(mm) OVER b = 12 THEN sum(mm) OVER b END AS r12,
         CASE WHEN count(mm) OVER c = 24 THEN sum(mm) OVER c END AS r24, CASE WHEN count(mm) OVER e = 48 THEN sum(mm) OVER e END AS r48
         FROM x WINDOW a AS (PARTITION BY point_id ORDER BY h ROWS 5 PRECEDING), b AS (PARTITION BY point_id ORDER BY h ROWS 11 PRECEDING),
           c AS (PARTITION BY point_id ORDER BY h ROWS 23 PRECEDING), e AS (PARTITION BY point_id ORDER BY h ROWS 47 PRECEDING))
       SELECT point_id, h // 24 AS day, max_by(r6, h) FILTER (r6 IS NOT NULL) AS rain_6h, max_by(r12, h) FILTER (r12 IS NOT NULL) AS rain_12h,
         max_by(r24, h) FILTER (r24 IS NOT NULL) AS rain_24h, max_by(r48, h) FILTER (r48 IS NOT NULL) AS rain_48h FROM r GROUP BY 1, 2""",
    num="rain_6h rain_12h rain_24h rain_48h",
)
def _(t):
    return Wn.rolling_hour_sums(t.v1, ["point_id"], "h", "mm")


@entry(
    "rolling_day_sums",
    """SELECT point_id, d, CASE WHEN count(mm) OVER a >= 10 THEN sum(mm) OVER a END AS rain_14d,
         CASE WHEN count(mm) OVER b >= 21 THEN sum(mm) OVER b END AS rain_30d FROM v3
       WINDOW a AS (PARTITION BY point_id ORDER BY d ROWS 13 PRECEDING), b AS (PARTITION BY point_id ORDER BY d ROWS 29 PRECEDING)""",
    num="rain_14d rain_30d",
    text="d",
)
def _(t):
    return Wn.rolling_day_sums(t.v3, ["point_id"], "d", "mm").drop("mm")


def six_hour_steps(t):
    return t.v1.groupBy("point_id").agg(F.max("h").alias("hi")).select("point_id", F.expr("explode(sequence(0L, hi, 6L))").alias("h"))


@entry(
    "trailing_window_at",
    """SELECT a.point_id, a.h, COALESCE(SUM(CASE WHEN v1.h > a.h - 24 THEN mm END), 0) AS sum_24h, COALESCE(SUM(mm), 0) AS sum_48h
       FROM (SELECT point_id, unnest(range(0, hi + 1, 6)) AS h FROM (SELECT point_id, max(h) AS hi FROM v1 GROUP BY 1)) a
       LEFT JOIN v1 ON v1.point_id = a.point_id AND v1.h > a.h - 48 AND v1.h <= a.h GROUP BY 1, 2""",
    num="sum_24h sum_48h",
)
def _(t):
    return Wn.trailing_window_at(t.v1, six_hour_steps(t), "point_id", "h", "mm")


@entry(
    "trailing_n_rows",
    """SELECT point_id, COALESCE(SUM(mm) FILTER (h <= 360), 0) AS observed_sum, COALESCE(SUM(mm) FILTER (h > 360), 0) AS forecast_sum
       FROM (SELECT *, row_number() OVER (PARTITION BY point_id, h <= 360 ORDER BY CASE WHEN h <= 360 THEN -h ELSE h END) AS rn FROM v1)
       WHERE rn <= 24 GROUP BY 1""",
    num="observed_sum forecast_sum",
)
def _(t):
    return Wn.trailing_n_rows(t.v1, "point_id", "h", "mm", now=360, n=24)


RANK_SQL = """WITH r AS (SELECT a.site, a.d, any_value(a.q) AS q, avg(CASE WHEN b.q <= a.q THEN 1.0 ELSE 0.0 END) AS share FROM v2 a
         JOIN v2 b ON b.site = a.site AND b.d BETWEEN a.d - 29 AND a.d GROUP BY 1, 2),
       g AS (SELECT site, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT site, min(d) AS lo, max(d) AS hi FROM v2 GROUP BY 1)),
       pctl AS (SELECT g.site, g.d, r.q, r.share FROM g ASOF LEFT JOIN r ON g.site = r.site AND g.d >= r.d)"""


@entry("trailing_rank_pctl", f"{RANK_SQL} SELECT * FROM pctl", num="q share", text="d")
def _(t):
    return Wn.trailing_rank_every_day(t.v2, "site", "d", "q")


@entry(
    "latest30_stats",
    """WITH l AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY d DESC) AS rn FROM v2 WHERE d <= DATE '2001-06-30'),
       z AS (SELECT site, max(d) AS latest_day, max(q) FILTER (rn = 1) AS latest, min(q) AS low, max(q) AS high, count(*) AS n_days,
               max(q) FILTER (rn = 3) AS before FROM l WHERE rn <= 30 GROUP BY 1),
       s AS (SELECT z.site, (SELECT avg((q <= z.latest)::INT) FROM l WHERE l.site = z.site AND rn <= 30) AS share,
               (SELECT CASE WHEN count(*) >= 60 THEN avg((q <= z.latest)::INT) END FROM v2 WHERE v2.site = z.site AND year(v2.d) < 2001
                 AND least(abs(dayofyear(v2.d) - dayofyear(z.latest_day)), 366 - abs(dayofyear(v2.d) - dayofyear(z.latest_day))) <= 15) AS seasonal FROM z)
       SELECT site, latest_day, latest, low, high, n_days, share, seasonal, COALESCE(seasonal, share) AS used,
         CASE WHEN 100 * (latest - before) / before >= 5 THEN 'rising' WHEN 100 * (latest - before) / before <= -5 THEN 'falling' ELSE 'steady' END AS trend
       FROM z JOIN s USING (site)""",
    num="latest low high share seasonal used",
    text="latest_day",
)
def _(t):
    q = t.stored("v2")
    recent = Wn.latest_rows_stats(q.filter("d <= date'2001-06-30'"), "site", "d", "q").drop("before", "trend_pct")
    history = q.filter("year(d) < 2001")
    probe = recent.select("site", F.col("latest_day").alias("d"), F.col("latest").alias("v"))
    seas = A.seasonal_percentile(history, probe, "site", "d", "q", "v").select("site", F.col("share").alias("seasonal"))
    return recent.join(seas, "site", "left").withColumn("used", F.coalesce("seasonal", "share"))


@entry(
    "runs_above",
    """WITH x AS (SELECT site, d, CASE WHEN dayofyear(d) % 50 <> 0 THEN q END AS q FROM v2),
       y AS (SELECT *, COALESCE(q >= 180, false) AS up, row_number() OVER (PARTITION BY site ORDER BY d) AS rn FROM x),
       z AS (SELECT *, rn - row_number() OVER (PARTITION BY site ORDER BY d) AS g FROM y WHERE up)
       SELECT site, min(d) AS onset, max(d) AS "end", max(q) AS peak, count(*) AS n_rows FROM z GROUP BY site, g""",
    num="peak",
    text='onset "end"',
)
def _(t):
    q = t.v2.withColumn("q", F.when(F.dayofyear("d") % 50 != 0, F.col("q")))
    return Wn.runs_above(q, ["site"], "d", "q", F.lit(180.0))


@entry(
    "event_lead_time",
    """WITH p AS (SELECT site, d, q, lag(q) OVER (PARTITION BY site ORDER BY d) + CASE WHEN day(d) % 3 = 0 THEN 60 ELSE 0 END AS pred FROM v2),
       x AS (SELECT *, q >= 200 AS ex, COALESCE(lag(q >= 200) OVER (PARTITION BY site ORDER BY d), false) AS pex FROM p),
       e AS (SELECT *, d - CAST(row_number() OVER (PARTITION BY site ORDER BY d) AS INT) AS isl FROM x WHERE ex)
       SELECT site, onset, "end", CASE WHEN first_alarm IS NOT NULL THEN onset - first_alarm + 1 END AS lead_days, peak FROM (
         SELECT site, min(d) AS onset, max(d) AS "end", max(q) AS peak, min(d) FILTER (pred >= 200) AS first_alarm, arg_min(NOT pex, d) AS starts
         FROM e GROUP BY site, isl) WHERE starts""",
    num="peak",
    text='onset "end"',
)
def _(t):
    f = J.lagged(t.v2, "site", "d", "q", 1, "pred").withColumn(
        "pred", F.col("pred") + F.when(F.dayofmonth("d") % 3 == 0, 60).otherwise(0)
    )
    f = f.withColumn("thr", F.lit(200.0)).withColumn("h", F.lit(1))
    return Wn.event_leads(f, ["site"], "d", "q", "pred", "thr", "h")


def rises(t):
    return J.changes(t.v2, "site", "d", "q", "rise")


@entry(
    "top_separated_events",
    """WITH RECURSIVE r AS (SELECT site, d, rise, row_number() OVER (PARTITION BY site ORDER BY rise DESC, d) AS rn
         FROM (SELECT site, d, q - lag(q) OVER (PARTITION BY site ORDER BY d) AS rise FROM v2) WHERE rise IS NOT NULL),
       g AS (SELECT site, 1 AS pick, rn, [d] AS taken, d, rise FROM r WHERE rn = 1
         UNION ALL
         SELECT g.site, g.pick + 1, n.rn, list_append(g.taken, n.d), n.d, n.rise FROM g, LATERAL (
           SELECT r.rn, r.d, r.rise FROM r WHERE r.site = g.site AND r.rn > g.rn
             AND len(list_filter(g.taken, lambda x: abs(x - r.d) < 7)) = 0 ORDER BY r.rn LIMIT 1) n WHERE g.pick < 10)
       SELECT site, pick, d, rise FROM g""",
    num="rise",
    text="d",
)
def _(t):
    return Wn.separated_top(rises(t), "site", "d", "rise")


@entry(
    "peak_after",
    """SELECT a.site, a.d, max(b.q) AS peak, min(b.d) FILTER (b.q = m.mq) AS peak_day, any_value(p.q) AS before FROM v2 a
       JOIN (SELECT x.site, x.d, max(y.q) AS mq FROM v2 x JOIN v2 y ON x.site = y.site AND y.d BETWEEN x.d AND x.d + 4 GROUP BY 1, 2) m
         ON m.site = a.site AND m.d = a.d
       JOIN v2 b ON b.site = a.site AND b.d BETWEEN a.d AND a.d + 4 LEFT JOIN v2 p ON p.site = a.site AND p.d = a.d - 1 GROUP BY 1, 2""",
    num="peak before",
    text="d peak_day",
)
def _(t):
    return Wn.peak_after(t.v2, "site", "d", "q").drop("q")


def dense_hours(t):
    return Wn.densify(t.stored("v1"), ["point_id"], "h", "mm", fill=0.0)


@entry(
    "spike_before",
    """WITH r AS (SELECT point_id, h, CASE WHEN count(mm) OVER w = 24 THEN sum(mm) OVER w END AS mm24 FROM v1d
           WINDOW w AS (PARTITION BY point_id ORDER BY h ROWS 23 PRECEDING)),
       p AS (SELECT point_id, h // 24 AS peak_day FROM v1d GROUP BY 1, 2 HAVING sum(mm) > 100)
       SELECT p.point_id, p.peak_day, max(mm24) AS spike, arg_max(h, mm24 * 1000 - h / 10000.0) AS spike_hour FROM p
       JOIN r ON r.point_id = p.point_id AND r.h // 24 BETWEEN p.peak_day - 5 AND p.peak_day AND mm24 IS NOT NULL GROUP BY 1, 2""",
    num="spike",
)
def _(t):
    dense = dense_hours(t)
    rolled = A.rolled_hours(dense, "point_id", "h", "mm", 24, "mm24")
    peaks = dense.groupBy("point_id", F.floor(F.col("h") / 24).alias("peak_day")).agg(F.sum("mm").alias("s")).filter("s > 100").drop("s")
    return Wn.spike_before(rolled, peaks, "point_id", "h", "mm24")


SPIKES_SQL = """WITH s AS (SELECT point_id, h, SUM(mm) OVER (PARTITION BY point_id ORDER BY h RANGE BETWEEN 23 PRECEDING AND CURRENT ROW) AS mm24 FROM v1),
       b AS (SELECT *, MAX(mm24) OVER w AS pm, AVG(mm24) OVER w AS pa FROM s
             WINDOW w AS (PARTITION BY point_id ORDER BY h RANGE BETWEEN 719 PRECEDING AND 24 PRECEDING)),
       f AS (SELECT * FROM b WHERE h >= 240 AND mm24 > pm AND mm24 >= 30 QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY h) = 1),
       spikes AS (SELECT p.point_id, f.h AS spike_hour, f.mm24 AS spike_mm24, f.pm AS prev_max, f.pa AS prev_mean, p.peak_hour, p.peak_mm24
       FROM (SELECT point_id, max(mm24) AS peak_mm24, min(h) FILTER (mm24 = m) AS peak_hour
             FROM (SELECT *, max(mm24) OVER (PARTITION BY point_id) AS m FROM s) GROUP BY 1) p LEFT JOIN f USING (point_id))"""


@entry("first_record_spike", f"{SPIKES_SQL} SELECT * FROM spikes", num="spike_mm24 prev_max prev_mean peak_mm24")
def _(t):
    return Wn.record_spikes(t.v1, "point_id", "h", "mm", start=240)


@entry(
    "first_crossing",
    f"""{RANK_SQL} SELECT site, min(d) AS first_at, arg_min(share, d) AS first_value FROM pctl
        WHERE d BETWEEN DATE '1998-06-01' AND DATE '1998-09-30' AND share >= 0.9 GROUP BY 1""",
    num="first_value",
    text="first_at",
)
def _(t):
    # 29 more days in front feed the first ranks
    near = t.v2.filter("d BETWEEN date'1998-04-01' AND date'1998-09-30'")
    ranked = Wn.trailing_rank_every_day(near, "site", "d", "q").filter("d >= date'1998-06-01'")
    return Wn.first_crossing(ranked, "site", "d", "share", F.lit(0.9))


JUMP_SQL = """SELECT site, d AS jump_day, p AS jump_from, q AS jump_to, pct AS jump_pct FROM (
         SELECT a.site, a.d, b.q AS p, a.q, 100.0 * (a.q - b.q) / b.q AS pct FROM v2 a JOIN v2 b ON a.site = b.site AND b.d = a.d - 1
         WHERE b.q > 0 AND a.d BETWEEN DATE '1998-06-01' AND DATE '1998-09-30' AND b.d >= DATE '1998-06-01')
       QUALIFY row_number() OVER (PARTITION BY site ORDER BY pct DESC, d) = 1"""


@entry("biggest_jump", JUMP_SQL, num="jump_from jump_to jump_pct", text="jump_day")
def _(t):
    return Wn.biggest_jump(t.v2.filter("d BETWEEN date'1998-06-01' AND date'1998-09-30'"), "site", "d", "q")


STATES_SQL = """SELECT point_id, h, CASE WHEN s % 3000 >= 2600 THEN 'RED' WHEN s % 3000 >= 2100 THEN 'YELLOW' ELSE 'GREEN' END AS state FROM (
      SELECT point_id, h, SUM(mm) OVER (PARTITION BY point_id ORDER BY h RANGE BETWEEN 23 PRECEDING AND CURRENT ROW) AS s FROM v1d) WHERE h % 6 = 0"""


def states(t):
    s = A.rolled_hours(dense_hours(t), "point_id", "h", "mm", 24, "s", partial=True).filter("h % 6 = 0")
    return s.select("point_id", "h", F.expr("CASE WHEN s % 3000 >= 2600 THEN 'RED' WHEN s % 3000 >= 2100 THEN 'YELLOW' ELSE 'GREEN' END").alias("state"))


TRANSITIONS_SQL = f"""WITH st AS ({STATES_SQL}), x AS (SELECT *, lag(state) OVER (PARTITION BY point_id ORDER BY h) AS was FROM st),
       moves AS (SELECT point_id, min(h) FILTER (state <> 'GREEN') AS first_elevated, min(h) FILTER (state = 'RED') AS first_red,
         min(h) FILTER (h BETWEEN 240 AND 480 AND was = 'GREEN' AND state <> 'GREEN') AS re_elevated,
         COALESCE(string_agg(CAST(h AS VARCHAR), ',' ORDER BY h) FILTER (h BETWEEN 240 AND 480 AND state = 'RED'), '') AS red_steps,
         COALESCE(min(h) FILTER (state <> 'GREEN') = min(h), false) AS already_at_start FROM x GROUP BY 1)"""


@entry("state_transitions", f"{TRANSITIONS_SQL} SELECT * FROM moves")
def _(t):
    return Wn.state_transitions(states(t), "point_id", "h", "state", 240, 480)


WEEK_SQL = """WITH tot AS (SELECT year(d) AS y, d, sum(mm) AS s FROM v3 WHERE month(d) BETWEEN 6 AND 9 GROUP BY 1, 2),
       w AS (SELECT y, d AS start_day, max(d) OVER k AS end_day, sum(s) OVER k AS week_total, count(*) OVER k AS n FROM tot
             WINDOW k AS (PARTITION BY y ORDER BY d ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING)),
       weeks AS (SELECT y, start_day, end_day, week_total FROM w WHERE n = 7 QUALIFY row_number() OVER (PARTITION BY y ORDER BY week_total, start_day) = 1)"""


@entry(
    "quietest_week",
    f"""{WEEK_SQL} SELECT k.*, count(*) AS n_steps, count(*) FILTER (mm >= 25) AS n_elevated, avg((mm >= 25)::INT) AS elevated_share
        FROM weeks k JOIN v3 ON v3.d BETWEEN k.start_day AND k.end_day GROUP BY ALL""",
    num="week_total elevated_share",
    text="start_day end_day",
)
def _(t):
    season = t.v3.filter(F.month("d").between(6, 9)).withColumn("y", F.year("d"))
    weeks = Wn.quietest_week(season.groupBy("y", "d").agg(F.sum("mm").alias("s")), "y", "d", "s")
    return J.share_inside(weeks, season, ["y"], "start_day", "end_day", "d", F.col("mm") >= 25, "elevated")


@entry(
    "counter_increments",
    """SELECT event_id, greatest(value - p, 0) AS increment FROM (SELECT *, lag(value) OVER (PARTITION BY station ORDER BY ts, event_id) AS p FROM v1r)
       WHERE p IS NOT NULL AND greatest(value - p, 0) <= 30""",
    num="increment",
)
def _(t):
    width = chunk_width(t.v1r, "ts")
    inc = Wn.counter_increments(t.v1r, "station", "ts", "event_id", "value", cap=30.0, width=width)
    return inc.select("event_id", "increment")


@entry(
    "latest_per_key",
    """SELECT * FROM (SELECT site, target AS last_target, fc AS last_fc FROM v4
         QUALIFY row_number() OVER (PARTITION BY site ORDER BY issued DESC, target DESC, l_orderkey DESC, l_linenumber DESC, fc DESC) = 1)
       JOIN (SELECT site, target AS peak_target, fc AS peak_fc FROM v4
         QUALIFY row_number() OVER (PARTITION BY site ORDER BY fc DESC, target, l_orderkey, l_linenumber) = 1) USING (site)""",
    num="last_fc peak_fc",
    text="last_target peak_target",
)
def _(t):
    last = R.newest(t.v4, ["site"], ["issued", "target", "l_orderkey", "l_linenumber", "fc"])
    peak = R.highest(t.v4, ["site"], "fc", ["target", "l_orderkey", "l_linenumber"])
    a = last.select("site", F.col("target").alias("last_target"), F.col("fc").alias("last_fc"))
    return a.join(peak.select("site", F.col("target").alias("peak_target"), F.col("fc").alias("peak_fc")), "site")


@entry(
    "collision_guard",
    """SELECT id, CASE WHEN rn = 1 THEN lat ELSE lat + 0.001 + id / 1e6 END AS lat, CASE WHEN rn = 1 THEN lon ELSE lon + 0.002 END AS lon,
         CASE WHEN rn = 1 THEN 'matched' ELSE 'approximate' END AS precision FROM (
       SELECT *, row_number() OVER (PARTITION BY floor(lat * 1e5 + 0.5), floor(lon * 1e5 + 0.5) ORDER BY id) AS rn FROM v5v)""",
    num="lat lon",
)
def _(t):
    v = t.v5v.withColumn("flat", F.col("lat") + 0.001 + F.col("id") / 1e6).withColumn("flon", F.col("lon") + 0.002)
    return P.collision_guard(v, "id").select("id", "lat", "lon", "precision")


@entry(
    "mask_row_runs",
    """SELECT vec_id, r, min(c) AS c_from, max(c) + 1 AS c_to FROM (
         SELECT *, c - row_number() OVER (PARTITION BY vec_id, r ORDER BY c) AS g FROM v6 WHERE v < 0) GROUP BY vec_id, r, g""",
)
def _(t):
    return X.row_runs(t.v6.withColumn("water", F.col("v") < 0), ["vec_id"], "r", "c", "water")


@entry(
    "entity_lag_features",
    """SELECT site, d, q AS dam, lag(q) OVER w AS dam_lag1, q - lag(q) OVER w AS dam_chg, lag(q, 3) OVER w AS dam_lag3, lag(q, 4) OVER w AS dam_lag4,
         lag(q, 3) OVER w - lag(q, 4) OVER w AS dam_chg_lag3 FROM v2 WINDOW w AS (PARTITION BY site ORDER BY d)""",
    num="dam dam_lag1 dam_chg dam_lag3 dam_lag4 dam_chg_lag3",
    text="d",
)
def _(t):
    return Wn.row_lags(t.v2, "site", "d", "q", "dam")


@entry(
    "carry_forward_stale",
    """WITH cur AS (SELECT point_id, sum(mm) AS total FROM v1 WHERE h BETWEEN 696 AND 719 AND point_id % 3 <> 0 GROUP BY 1),
       prev AS (SELECT point_id, sum(mm) AS total, max(h) AS since FROM v1 WHERE h BETWEEN 600 AND 695 AND point_id <> 6 GROUP BY 1)
       SELECT COALESCE(a.point_id, b.point_id) AS point_id, COALESCE(cur.total, prev.total) AS total,
         CASE WHEN cur.total IS NOT NULL THEN 'live' WHEN prev.total IS NOT NULL THEN 'carried' ELSE 'withheld' END AS status,
         CASE WHEN cur.total IS NULL AND prev.total IS NOT NULL THEN prev.since END AS stale_since,
         CASE WHEN cur.total IS NULL AND prev.total IS NOT NULL THEN 720 END AS checked_at
       FROM (SELECT DISTINCT point_id FROM v1) a LEFT JOIN cur ON cur.point_id = a.point_id LEFT JOIN prev ON prev.point_id = a.point_id
       LEFT JOIN (SELECT NULL::BIGINT AS point_id) b ON false""",
    num="total",
)
def _(t):
    v1 = t.stored("v1")
    cur = v1.filter("h BETWEEN 696 AND 719 AND point_id % 3 <> 0").groupBy("point_id").agg(F.sum("mm").alias("total"))
    prev = v1.filter("h BETWEEN 600 AND 695 AND point_id <> 6").groupBy("point_id").agg(
        F.sum("mm").alias("total"), F.max("h").alias("since")
    )
    keys = v1.select("point_id").distinct()
    return J.carry_forward(keys, cur, prev, "point_id", "total", "since", F.lit(720))
