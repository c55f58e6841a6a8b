"""Filters and quality screens (2.3)."""

from pyspark.sql import functions as F

from freshet.catalog.registry import entry
from freshet.functions import scalars as S
from freshet.operators import aggregates as A
from freshet.operators import joins as J
from freshet.operators import quality as Q
from freshet.operators import raster as X
from freshet.operators.chunks import chunk_width
from freshet.session import cut_lineage

VAL_YEARS = [1998, 1999, 2000, 2001]


@entry("season_filter", "SELECT site, d, q FROM v2 WHERE month(d) BETWEEN 6 AND 9", num="q", text="d")
def _(t):
    return t.v2.filter(A.in_season("d"))


@entry(
    "range_screen",
    """SELECT station, count(*) FILTER (v < 0) AS n_negative, count(*) FILTER (v > 30 AND v < 60) AS n_over, count(*) FILTER (v >= 60) AS n_absurd,
         count(*) FILTER (v BETWEEN 0 AND 30) AS n_kept, sum(v) FILTER (v BETWEEN 0 AND 30) AS kept_sum FROM (SELECT *, value - 2 AS v FROM v1r) GROUP BY 1""",
    num="kept_sum",
)
def _(t):
    r = t.v1r.withColumn("v", F.col("value") - 2)
    r = r.withColumn("why", Q.range_reason(F.col("v"), cap=30.0, absurd=60.0))
    ok = F.col("why").isNull()
    return r.groupBy("station").agg(
        F.count_if(F.col("why") == "negative").alias("n_negative"),
        F.count_if(F.col("why") == "over cap").alias("n_over"),
        F.count_if(F.col("why") == "absurd").alias("n_absurd"),
        F.count_if(ok).alias("n_kept"),
        F.sum(F.when(ok, F.col("v"))).alias("kept_sum"),
    )


# stations made to behave differently: a counter, a broken one, one mostly invalid, a sparse one
GAUGES_SQL = """g AS (SELECT event_id, station, ts, CASE station WHEN 0 THEN event_id / 64 % 40 WHEN 1 THEN value * 100 WHEN 2 THEN CASE WHEN event_id % 200 = 2 THEN value ELSE -9 END
       WHEN 3 THEN CASE WHEN event_id % 5 = 3 THEN value ELSE -9 END ELSE value END AS v FROM v1r)"""


def gauges(t):
    e, s, v = F.col("event_id"), F.col("station"), F.col("value")
    read = (
        F.when(s == 0, e / 64 % 40)
        .when(s == 1, v * 100)
        .when(s == 2, F.when(e % 200 == 2, v).otherwise(-9.0))
        .when(s == 3, F.when(e % 5 == 3, v).otherwise(-9.0))
        .otherwise(v)
    )
    return t.v1r.select("event_id", "station", "ts", read.alias("v"))


def gauge_days(t):
    g = gauges(t)
    return Q.station_days(g, "station", "ts", "event_id", "v", width=chunk_width(g, "ts"))


MODES_SQL = f"""{GAUGES_SQL}, p AS (SELECT *, lag(v) OVER (PARTITION BY station ORDER BY ts, event_id) AS pv FROM g WHERE v >= 0),
       s AS (SELECT station, count(*) AS n_readings, max(v) AS max_value, avg((v >= pv)::INT) AS nondecreasing FROM p GROUP BY 1),
       m AS (SELECT station, median(n) AS per_day FROM (SELECT station, CAST(ts AS DATE) AS d, count(*) AS n FROM p GROUP BY 1, 2) GROUP BY 1),
       a0 AS (SELECT DISTINCT station FROM g),
       e AS (SELECT station, COALESCE(n_readings, 0) AS n_readings, max_value, nondecreasing, per_day, CASE WHEN COALESCE(n_readings, 0) < 200 THEN 'too few valid readings' WHEN max_value > 1000 THEN 'implausible extremes'
              WHEN nondecreasing >= 0.95 THEN NULL WHEN per_day < 12 THEN 'sparse incremental reporting' END AS excluded FROM a0 LEFT JOIN s USING (station) LEFT JOIN m USING (station)),
       modes AS (SELECT *, CASE WHEN excluded IS NULL THEN CASE WHEN nondecreasing >= 0.95 THEN 'cumulative' ELSE 'incremental' END END AS mode FROM e)"""


@entry("sensor_mode_classify", f"WITH {MODES_SQL} SELECT * FROM modes", num="max_value nondecreasing per_day")
def _(t):
    return Q.sensor_modes(gauge_days(t), "station", min_rows=200)


@entry(
    "dense_day_filter",
    f"""WITH {MODES_SQL}, a AS (SELECT station, mode, CAST(ts AS DATE) AS d, CASE WHEN mode = 'cumulative' THEN CASE WHEN pv IS NOT NULL THEN greatest(v - pv, 0) END ELSE v END AS amount
         FROM p JOIN modes USING (station) WHERE mode IS NOT NULL)
       SELECT station, d, sum(amount) AS total, count(*) AS n FROM a WHERE amount <= 150 GROUP BY station, mode, d HAVING count(*) >= CASE WHEN mode = 'cumulative' THEN 4 ELSE 20 END""",
    num="total",
    text="d",
)
def _(t):
    days = cut_lineage(gauge_days(t))
    return Q.gauge_daily(days, Q.sensor_modes(days, "station", min_rows=200), "station").drop("mode")


@entry(
    "robust_band_filter",
    """WITH x AS (SELECT site, d, CASE WHEN site = 3 THEN 7 ELSE q END AS q FROM v2), p AS (SELECT site, quantile_cont(q, 0.02) AS lo, quantile_cont(q, 0.98) AS hi FROM x GROUP BY 1)
       SELECT site, d, q, greatest(0, least(1, (q - lo) / (hi - lo))) AS norm FROM x JOIN p USING (site)
       WHERE hi - lo >= 0.5 AND q BETWEEN lo - (hi - lo) * 0.5 AND hi + (hi - lo) * 0.5""",
    num="q norm",
    text="d",
)
def _(t):
    x = t.v2.withColumn("q", F.when(F.col("site") == 3, 7.0).otherwise(F.col("q")))
    return Q.robust_band(x, "site", "q")


@entry(
    "plausibility_flag",
    """WITH r AS (SELECT site, 5 * mm / q AS ratio FROM v2 JOIN v3 ON point_id = site AND v3.d = v2.d WHERE q > 0)
       SELECT site, count(*) AS n, count(*) FILTER (ratio > 5 OR ratio < 0.2) AS n_implausible, median(ratio) FILTER (NOT (ratio > 5 OR ratio < 0.2)) AS median_ratio FROM r GROUP BY 1""",
    num="median_ratio",
)
def _(t):
    r = t.v2.join(t.v3.withColumnRenamed("point_id", "site"), ["site", "d"]).withColumn("ratio", A.ratio(F.col("mm") * 5, F.col("q")))
    bad = A.plausibility_flag(F.col("ratio"))
    return r.filter("ratio IS NOT NULL").groupBy("site").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(bad).alias("n_implausible"),
        F.percentile(F.when(~bad, F.col("ratio")), F.lit(0.5)).alias("median_ratio"),
    )


@entry(
    "min_sample_gate",
    """WITH p AS (SELECT v4.site, lead_d, fc, o.q AS obs, i.q AS pers FROM v4 LEFT JOIN v2 o ON o.site = v4.site AND o.d = target LEFT JOIN v2 i ON i.site = v4.site AND i.d = issued WHERE lead_d BETWEEN 1 AND 7),
       s AS (SELECT site, lead_d, count(*) FILTER (obs IS NOT NULL AND pers IS NOT NULL) AS n, avg(abs(fc - obs)) FILTER (pers IS NOT NULL) AS mae, avg(fc - obs) FILTER (pers IS NOT NULL) AS bias FROM p GROUP BY 1, 2)
       SELECT site, lead_d, n, CASE WHEN n >= 7 THEN 'ok' ELSE 'insufficient' END AS status, CASE WHEN n >= 7 THEN mae END AS mae, CASE WHEN n >= 7 THEN bias END AS bias FROM s""",
    num="mae bias",
)
def _(t):
    p = J.value_at(t.v4.filter("lead_d BETWEEN 1 AND 7"), t.v2, "site", "d", "q", {"obs": "target", "pers": "issued"})
    s = A.error_metrics(p, ["site", "lead_d"], "obs", "fc", "pers").select("site", "lead_d", "n", "mae", "bias")
    return A.gate(s, "n", 7, ["mae", "bias"])


RASTERS_SQL = """x AS (SELECT vec_id, r, c, CASE vec_id % 5 WHEN 0 THEN CASE WHEN r = 0 AND c < 3 THEN abs(v) END WHEN 1 THEN 0.5 WHEN 2 THEN abs(v) * 120
          WHEN 3 THEN abs(v) / 10 ELSE abs(v) END AS v FROM v6)"""


@entry(
    "raster_sanity_gate",
    f"""WITH {RASTERS_SQL}, s AS (SELECT vec_id, count(*) AS n_cells, count(*) FILTER (v > 1e-12) AS n_valid, count(*) FILTER (v > 1e-12 AND v < 0.05) AS n_water,
         stddev_pop(v) FILTER (v > 1e-12) AS sd, median(v) FILTER (v > 1e-12) AS med FROM x GROUP BY 1)
       SELECT vec_id, n_cells, n_valid, n_water, CASE WHEN n_valid < 0.05 * n_cells THEN 'no imagery' WHEN sd < 1e-9 OR med > 10 THEN 'degenerate'
         WHEN n_water > 0.9 * n_valid THEN 'implausible water share' END AS reason FROM s""",
)
def _(t):
    k, a = F.col("vec_id") % 5, F.abs("v")
    v = (
        F.when(k == 0, F.when((F.col("r") == 0) & (F.col("c") < 3), a))
        .when(k == 1, F.lit(0.5))
        .when(k == 2, a * 120)
        .when(k == 3, a / 10)
        .otherwise(a)
    )
    x = t.v6.withColumn("v", v).withColumn("water", F.col("v") < 0.05)
    return X.sanity_gate(x, ["vec_id"], "v", "water")


@entry(
    "station_eligibility",
    """SELECT event_id, user_id FROM events WHERE user_id % 7 <> 3 AND user_id IN (SELECT user_id FROM events GROUP BY 1 HAVING count(*) >= 70)""",
)
def _(t):
    e = t.table("events").select("event_id", "user_id")
    side = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "note", F.when(F.col("user_id") % 7 == 3, "coordinates outside the region")
    )
    return Q.eligible(e, side, "user_id", min_rows=70)


@entry(
    "exclude_simulated",
    "SELECT point_id, h, CASE WHEN h <= 360 THEN 'OBSERVED' ELSE 'FORECAST' END AS cls FROM v1 WHERE point_id % 3 <> 0 AND h % 10 <> 0",
)
def _(t):
    cls = F.when(F.col("point_id") % 3 == 0, S.SIMULATED).when(F.col("h") % 10 != 0, S.past_or_future(F.col("h"), F.lit(360)))
    return Q.without_simulated(t.v1.select("point_id", "h", cls.alias("cls")), "cls")
