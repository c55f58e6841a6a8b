"""Risk classification, replay and the quality gates (2.8 M20-M23, 2.9)."""

from pyspark.sql import functions as F

from freshet.catalog.aggregates import states
from freshet.catalog.registry import ENTRIES, entry
from freshet.catalog.scalars import hav
from freshet.catalog.windows import JUMP_SQL, RANK_SQL, SPIKES_SQL, STATES_SQL, TRANSITIONS_SQL, WEEK_SQL, dense_hours
from freshet.operators import aggregates as A
from freshet.operators import windows as Wn
from freshet.plans import gates as Gt
from freshet.plans import risk as Rk

NOW = 600


def rain_points(t):
    """Every rain point with the trailing and coming sums of its series (point pid % 8), in mm / 40."""
    v1 = t.stored("v1")
    a = Wn.trailing_n_rows(v1, "point_id", "h", "mm", NOW, 24)
    b = Wn.trailing_n_rows(v1, "point_id", "h", "mm", NOW, 48).select("point_id", F.col("observed_sum").alias("s48"))
    s = a.join(b, "point_id").select(
        "point_id", (F.col("observed_sum") / 40).alias("h24"), (F.col("s48") / 40).alias("h48"), (F.col("forecast_sum") / 40).alias("next24")
    )
    p = t.v5p.withColumn("point_id", F.col("pid") % 8).withColumn("live", F.col("pid") % 17 != 5)
    return p.join(s, "point_id").select("pid", "plat", "plon", "h24", "h48", "next24", "live")


def river_points(t):
    return t.v5n.select(F.col("poly").alias("rid"), F.col("clat").alias("rlat"), F.col("clon").alias("rlon"), (F.col("poly") % 4).cast("bigint").alias("site"))


def rivers(t):
    q = t.stored("v2")
    recent = Wn.latest_rows_stats(q.filter("d <= date'2001-06-30'"), "site", "d", "q")
    probe = recent.select("site", F.col("latest_day").alias("d"), F.col("latest").alias("v"))
    seas = A.seasonal_percentile(q.filter("year(d) < 2001"), probe, "site", "d", "q", "v").select("site", F.col("share").alias("seasonal"))
    used = recent.join(seas, "site", "left").select("site", F.coalesce("seasonal", "share").alias("share"))
    r = river_points(t).join(used, "site")
    return r.withColumn("basin", F.when(F.col("rid") % 3 == 0, F.col("site"))).withColumn("live", F.col("rid") % 15 != 7)


def models(t):
    q = F.col("q")
    m = t.stored("v2").filter("year(d) = 2001").groupBy(F.col("site").alias("basin")).agg(
        F.avg((q >= 180).cast("double")).alias("p_elevated"), F.avg((q >= 150).cast("double")).alias("p_extreme")
    )
    return m.withColumn("degraded", F.col("basin") == 1)


def previous(t):
    i = F.col("id")
    return t.v5v.filter("id % 3 <> 1").select(
        "id", F.when(i % 2 == 0, "YELLOW").otherwise("GREEN").alias("colour"), F.lit("2024-01-30T00:00Z").alias("since"), (i % 3 == 0).alias("honest")
    )


RIVER_SQL = f"""used AS (SELECT site, used AS share FROM ({ENTRIES['latest30_stats'].sql})),
   rv AS (SELECT poly AS rid, clat AS rlat, clon AS rlon, poly % 4 AS site FROM v5n),
   near_rv AS (SELECT id, rid, site, {hav('lat', 'lon', 'rlat', 'rlon')} AS river_km FROM v5v, rv QUALIFY row_number() OVER (PARTITION BY id ORDER BY floor({hav('lat', 'lon', 'rlat', 'rlon')} * 1e6), rid) = 1),
   near_rp AS (SELECT id, pid, {hav('lat', 'lon', 'plat', 'plon')} AS km FROM v5v, v5p QUALIFY row_number() OVER (PARTITION BY id ORDER BY floor({hav('lat', 'lon', 'plat', 'plon')} * 1e6), pid) <= 2)"""


@entry(
    "risk_classification",
    f"""WITH {RIVER_SQL}, tr AS (SELECT point_id, COALESCE(sum(mm) FILTER (past AND rn <= 24), 0) / 40 AS h24, COALESCE(sum(mm) FILTER (past AND rn <= 48), 0) / 40 AS h48, COALESCE(sum(mm) FILTER (NOT past AND rn <= 24), 0) / 40 AS next24
          FROM (SELECT *, h <= {NOW} AS past, row_number() OVER (PARTITION BY point_id, h <= {NOW} ORDER BY CASE WHEN h <= {NOW} THEN -h ELSE h END) AS rn FROM v1) GROUP BY 1),
        wet AS (SELECT id, sum(h24 / greatest(km, 1)) / sum(1 / greatest(km, 1)) AS h24, sum(h48 / greatest(km, 1)) / sum(1 / greatest(km, 1)) AS h48, sum(next24 / greatest(km, 1)) / sum(1 / greatest(km, 1)) AS next24, bool_and(pid % 17 <> 5) AS rain_live
          FROM near_rp JOIN tr ON point_id = pid % 8 GROUP BY 1),
        mo AS (SELECT site AS basin, avg((q >= 180)::INT) AS pe, avg((q >= 150)::INT) AS px, site = 1 AS degraded FROM v2 WHERE year(d) = 2001 GROUP BY 1),
        pv AS (SELECT id, CASE WHEN id % 2 = 0 THEN 'YELLOW' ELSE 'GREEN' END AS colour, id % 3 = 0 AS honest FROM v5v WHERE id % 3 <> 1),
        j AS (SELECT wet.*, rid, river_km, share, COALESCE(NOT degraded, false) AS by_model, pe, px, rid % 15 <> 7 AND rain_live AS live, COALESCE(honest, false) AS honest, colour,
            CASE WHEN h24 >= 60 OR h48 >= 100 THEN 2 WHEN h24 >= 30 OR h48 >= 60 THEN 1 ELSE 0 END AS rs, CASE WHEN share >= 0.9 THEN 2 WHEN share >= 0.7 THEN 1 ELSE 0 END AS ds
          FROM wet JOIN near_rv USING (id) JOIN used ON used.site = near_rv.site LEFT JOIN mo ON rid % 3 = 0 AND mo.basin = near_rv.site LEFT JOIN pv USING (id))
        SELECT id, h24, h48, next24, rid, river_km, share AS discharge_share, rs AS rain_score, ds AS discharge_score,
          CASE WHEN by_model THEN CASE WHEN px >= 0.5 THEN 'RED' WHEN pe >= 0.2 THEN 'YELLOW' ELSE 'GREEN' END WHEN live THEN CASE WHEN rs + ds >= 3 THEN 'RED' WHEN rs + ds = 2 THEN 'YELLOW' ELSE 'GREEN' END WHEN honest THEN colour END AS risk,
          CASE WHEN by_model THEN 'model' WHEN live THEN 'rule' WHEN honest THEN 'carried' ELSE 'withheld' END AS method,
          CASE WHEN NOT by_model AND NOT live AND honest THEN '2024-01-30T00:00Z' END AS stale_since, CASE WHEN NOT by_model AND NOT live AND honest THEN '2024-01-31T00:00Z' END AS checked_at FROM j""",
    num="h24 h48 next24 river_km discharge_share",
)
def _(t):
    places = t.v5v.select("id", "lat", "lon")
    return Rk.classify(places, rain_points(t), rivers(t).drop("site"), models(t), previous(t), "2024-01-31T00:00Z")


REPLAY_DAY = "2001-06-01"
#: Odd sites miss most values of the history, so the replay meets both kinds of share.
HISTORY = "CASE WHEN site % 2 = 0 OR year(d) < 1997 AND day(d) < 24 THEN q END"


def replay(t):
    v1 = t.stored("v1")
    steps = v1.groupBy("point_id").agg(F.max("h").alias("hi")).select("point_id", F.expr("explode(sequence(24L, hi, 6L))").alias("h"))
    sums = Wn.trailing_window_at(v1, steps, "point_id", "h", "mm")
    sums = t.v5p.select("pid", (F.col("pid") % 8).alias("point_id")).join(sums, "point_id").select(
        "pid", F.col("h").alias("step"), (F.col("sum_24h") / 40).alias("sum_24h"), (F.col("sum_48h") / 40).alias("sum_48h")
    )
    near = t.v2.filter("d BETWEEN date'2001-04-01' AND date'2001-07-31'")
    share = Rk.replay_shares(near, t.stored("v2").filter("year(d) < 2001").withColumn("q", F.expr(HISTORY)), "site", "d", "q").withColumnRenamed("d", "day")
    points = river_points(t)
    shares = points.select("rid", "site").join(share, "site").select("rid", "day", "share", "q", "baseline")
    day = lambda step: F.date_add(F.lit(REPLAY_DAY).cast("date"), F.floor(step / 24).cast("int"))
    return Rk.replay(t.v5v.select("id", "lat", "lon"), t.v5p.select("pid", "plat", "plon"), sums, points.drop("site"), shares, day)


@entry(
    "replay_classification",
    f"""WITH {RIVER_SQL}, tail AS (SELECT site, d, q, share FROM ({RANK_SQL} SELECT * FROM pctl)),
        seas AS (SELECT p.site, p.d, count(r.q) AS n, avg((r.q <= p.q)::INT) AS s FROM tail p JOIN (SELECT site, d, {HISTORY} AS q FROM v2 WHERE year(d) < 2001) r ON r.site = p.site
          AND least(abs(dayofyear(r.d) - dayofyear(p.d)), 366 - abs(dayofyear(r.d) - dayofyear(p.d))) <= 15 WHERE p.d BETWEEN DATE '2001-04-01' AND DATE '2001-07-31' GROUP BY 1, 2),
        pctl AS (SELECT site, d, q, CASE WHEN n >= 60 THEN s ELSE share END AS share, CASE WHEN n >= 60 THEN 'seasonal' ELSE 'trailing' END AS baseline FROM tail LEFT JOIN seas USING (site, d)),
        st AS (SELECT point_id, unnest(range(24, hi + 1, 6)) AS h FROM (SELECT point_id, max(h) AS hi FROM v1 GROUP BY 1)),
        su AS (SELECT st.point_id, st.h AS step, COALESCE(sum(CASE WHEN v1.h > st.h - 24 THEN mm END), 0) / 40 AS a, COALESCE(sum(mm), 0) / 40 AS b FROM st LEFT JOIN v1 ON v1.point_id = st.point_id AND v1.h > st.h - 48 AND v1.h <= st.h GROUP BY 1, 2),
        wet AS (SELECT id, step, sum(a / greatest(km, 1)) / sum(1 / greatest(km, 1)) AS rain24, sum(b / greatest(km, 1)) / sum(1 / greatest(km, 1)) AS rain48 FROM near_rp JOIN su ON su.point_id = pid % 8 GROUP BY 1, 2)
        SELECT wet.id, step, rain24, rain48, share, p.q, baseline, CASE WHEN t >= 3 THEN 'RED' WHEN t = 2 THEN 'YELLOW' ELSE 'GREEN' END AS risk FROM wet JOIN near_rv USING (id)
        JOIN pctl p ON p.site = near_rv.site AND p.d = DATE '{REPLAY_DAY}' + CAST(step // 24 AS INT),
        LATERAL (SELECT CASE WHEN rain24 >= 60 OR rain48 >= 100 THEN 2 WHEN rain24 >= 30 OR rain48 >= 60 THEN 1 ELSE 0 END + CASE WHEN share >= 0.9 THEN 2 WHEN share >= 0.7 THEN 1 ELSE 0 END AS t) x""",
    num="rain24 rain48 share q",
)
def _(t):
    return replay(t)


@entry(
    "replay_findings",
    f"""SELECT 'record_spike' AS kind, CAST(point_id AS VARCHAR) AS entity, CAST(spike_hour AS VARCHAR) AS "at", spike_mm24 AS value FROM ({SPIKES_SQL} SELECT * FROM spikes) WHERE spike_hour IS NOT NULL
        UNION ALL SELECT 'first_crossing', CAST(site AS VARCHAR), CAST(min(d) AS VARCHAR), arg_min(share, d) FROM ({RANK_SQL} SELECT * FROM pctl) WHERE d BETWEEN DATE '1998-06-01' AND DATE '1998-09-30' AND share >= 0.9 GROUP BY 2
        UNION ALL SELECT 'biggest_jump', CAST(site AS VARCHAR), CAST(jump_day AS VARCHAR), jump_pct FROM ({JUMP_SQL})
        UNION ALL SELECT 'first_red', CAST(point_id AS VARCHAR), CAST(first_red AS VARCHAR), CAST(already_at_start AS INT) FROM ({TRANSITIONS_SQL} SELECT * FROM moves) WHERE first_red IS NOT NULL
        UNION ALL SELECT 'quietest_week', CAST(y AS VARCHAR), CAST(start_day AS VARCHAR), week_total FROM ({WEEK_SQL} SELECT * FROM weeks)""",
    num="value",
)
def _(t):
    spikes = Wn.record_spikes(t.stored("v1"), "point_id", "h", "mm", start=240)
    near = t.v2.filter("d BETWEEN date'1998-04-01' AND date'1998-09-30'")
    ranked = Wn.trailing_rank_every_day(near, "site", "d", "q").filter("d >= date'1998-06-01'")
    cross = Wn.first_crossing(ranked, "site", "d", "share", F.lit(0.9))
    jump = Wn.biggest_jump(near.filter("d >= date'1998-06-01'"), "site", "d", "q")
    moves = Wn.state_transitions(states(t), "point_id", "h", "state", 240, 480)
    season = t.v3.filter(F.month("d").between(6, 9)).groupBy(F.year("d").alias("y"), "d").agg(F.sum("mm").alias("s"))
    weeks = Wn.quietest_week(season, "y", "d", "s")
    parts = [
        Rk.finding(spikes, "record_spike", "point_id", "spike_hour", F.col("spike_mm24")),
        Rk.finding(cross, "first_crossing", "site", "first_at", F.col("first_value")),
        Rk.finding(jump, "biggest_jump", "site", "jump_day", F.col("jump_pct")),
        Rk.finding(moves, "first_red", "point_id", "first_red", F.col("already_at_start").cast("int")),
        Rk.finding(weeks, "quietest_week", "y", "start_day", F.col("week_total")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@entry(
    "rule_comparison",
    f"""WITH n AS (SELECT point_id, avg((state <> 'GREEN')::INT) AS now FROM ({STATES_SQL}) GROUP BY 1),
        o AS (SELECT point_id, avg((s >= 1900 + point_id * 50)::INT) AS was FROM (SELECT point_id, h, SUM(mm) OVER (PARTITION BY point_id ORDER BY h RANGE BETWEEN 23 PRECEDING AND CURRENT ROW) AS s FROM v1d) WHERE h % 6 = 0 GROUP BY 1)
        SELECT point_id, was, now, CASE WHEN now < was THEN 'reduced' ELSE 'not reduced' END AS verdict FROM o JOIN n USING (point_id)""",
    num="was now",
)
def _(t):
    s = A.rolled_hours(dense_hours(t), "point_id", "h", "mm", 24, "s", partial=True).filter("h % 6 = 0")
    old = s.withColumn("state", F.when(F.col("s") >= 1900 + F.col("point_id") * 50, "YELLOW").otherwise("GREEN"))
    frozen = A.saturation_share(old, ["point_id"], "state")
    return Rk.compare_rules(frozen, A.saturation_share(states(t), ["point_id"], "state"), "point_id", "share")


@entry(
    "provenance_gate",
    """WITH x AS (SELECT point_id, h, CASE h % 3 WHEN 0 THEN 'risk' WHEN 1 THEN 'signal' ELSE 'archive' END AS role, CASE (h * 7 + point_id) % 5 WHEN 0 THEN 'OBSERVED' WHEN 1 THEN 'FORECAST' WHEN 2 THEN 'SIMULATED' WHEN 3 THEN 'GUESSED' END AS cls,
         CASE WHEN h % 11 = 0 THEN '' ELSE 'feed' END AS source, CASE WHEN h % 13 <> 0 THEN '2024' END AS retrieved_at FROM v1)
       SELECT point_id, h, 'missing source' AS violation FROM x WHERE source = '' UNION ALL SELECT point_id, h, 'missing retrieved_at' FROM x WHERE retrieved_at IS NULL
       UNION ALL SELECT point_id, h, 'bad class' FROM x WHERE cls IS NULL OR cls = 'GUESSED' UNION ALL SELECT point_id, h, 'risk must be SIMULATED' FROM x WHERE role = 'risk' AND cls IN ('OBSERVED', 'FORECAST')
       UNION ALL SELECT point_id, h, 'archive must be OBSERVED' FROM x WHERE role = 'archive' AND cls IN ('SIMULATED', 'FORECAST')""",
)
def _(t):
    h = F.col("h")
    c = (h * 7 + F.col("point_id")) % 5
    x = t.v1.select(
        "point_id",
        "h",
        F.when(h % 3 == 0, "risk").when(h % 3 == 1, "signal").otherwise("archive").alias("role"),
        F.when(c == 0, "OBSERVED").when(c == 1, "FORECAST").when(c == 2, "SIMULATED").when(c == 3, "GUESSED").alias("cls"),
        F.when(h % 11 == 0, "").otherwise("feed").alias("source"),
        F.when(h % 13 != 0, "2024").alias("retrieved_at"),
    )
    return Gt.provenance_gate(x, ["point_id", "h"], {"risk": ("SIMULATED",), "archive": ("OBSERVED",)})


@entry(
    "partition_sidecar_gate",
    """WITH p AS (SELECT DISTINCT site, year(d) AS year FROM v2), s AS (SELECT site, year, CASE (site + year) % 4 WHEN 0 THEN 'SIMULATED' WHEN 1 THEN 'FORECAST' ELSE 'OBSERVED' END AS cls, year % 2 = 0 AS archived, CASE WHEN (site * 3 + year) % 5 <> 0 THEN 'feed' ELSE '' END AS source, site = 0 AS partial FROM p WHERE (site + year) % 7 <> 0)
       SELECT p.site, p.year, 'sidecar missing' AS violation FROM p LEFT JOIN s USING (site, year) WHERE s.cls IS NULL
       UNION ALL SELECT site, year, 'sidecar incomplete' FROM s WHERE NOT (cls = 'OBSERVED' OR (cls = 'FORECAST' AND archived)) OR source = ''
       UNION ALL SELECT site, year, 'partial year not flagged' FROM s WHERE year = 2001 AND NOT partial""",
)
def _(t):
    p = t.v2.select("site", F.year("d").alias("year")).distinct()
    k = (F.col("site") + F.col("year")) % 4
    s = p.filter("(site + year) % 7 <> 0").select(
        "site",
        "year",
        F.when(k == 0, "SIMULATED").when(k == 1, "FORECAST").otherwise("OBSERVED").alias("cls"),
        (F.col("year") % 2 == 0).alias("archived"),
        F.when((F.col("site") * 3 + F.col("year")) % 5 != 0, "feed").otherwise("").alias("source"),
        F.lit("2024").alias("retrieved_at"),
        (F.col("site") == 0).alias("partial"),
    )
    return Gt.sidecar_gate(p, s, ["site", "year"], 2001)


@entry(
    "colour_consistency_gate",
    """WITH x AS (SELECT id, CASE id % 5 WHEN 0 THEN 'model-a' WHEN 1 THEN 'model-b' WHEN 4 THEN 'guess' ELSE 'heuristic' END AS method, CASE WHEN level >= 7000 THEN 'RED' WHEN level >= 4000 THEN 'YELLOW' ELSE 'GREEN' END AS colour, id % 5 AS score,
          CASE WHEN id % 10 <> 0 THEN (id % 7) / 20 END AS pe, (id % 4) / 5 AS px, CASE WHEN id % 2 = 0 THEN 'to stay in its normal range' ELSE 'a raised chance of high water' END AS basis FROM v5v),
       y AS (SELECT *, CASE WHEN px >= 0.5 THEN 'RED' WHEN pe >= 0.2 THEN 'YELLOW' ELSE 'GREEN' END AS cp, CASE WHEN score >= 3 THEN 'RED' WHEN score = 2 THEN 'YELLOW' ELSE 'GREEN' END AS cs FROM x)
       SELECT id, 'model without probabilities' AS violation FROM y WHERE method LIKE 'model%' AND pe IS NULL UNION ALL SELECT id, 'colour differs from probabilities' FROM y WHERE method LIKE 'model%' AND pe IS NOT NULL AND cp <> colour
       UNION ALL SELECT id, 'colour differs from score' FROM y WHERE method = 'heuristic' AND cs <> colour UNION ALL SELECT id, 'unknown method' FROM y WHERE method = 'guess'
       UNION ALL SELECT id, 'red with calm text' FROM y WHERE colour = 'RED' AND id % 2 = 0 UNION ALL SELECT id, 'green with alarming text' FROM y WHERE colour = 'GREEN' AND id % 2 = 1""",
)
def _(t):
    i, lvl = F.col("id"), F.col("level")
    x = t.v5v.select(
        "id",
        F.when(i % 5 == 0, "model-a").when(i % 5 == 1, "model-b").when(i % 5 == 4, "guess").otherwise("heuristic").alias("method"),
        F.when(lvl >= 7000, "RED").when(lvl >= 4000, "YELLOW").otherwise("GREEN").alias("colour"),
        (i % 5).alias("score"),
        F.when(i % 10 != 0, (i % 7) / 20).alias("p_elevated"),
        ((i % 4) / 5).alias("p_extreme"),
        F.when(i % 2 == 0, "to stay in its normal range").otherwise("a raised chance of high water").alias("basis"),
    )
    return Gt.colour_gate(x, "id")


@entry(
    "mark_consistency_gate",
    """WITH x AS (SELECT id, CASE WHEN id % 5 <> 0 THEN level END AS warning, 5000 AS danger, CASE id % 4 WHEN 0 THEN 'rising' WHEN 1 THEN 'up' WHEN 2 THEN 'steady' END AS trend, level + 500 AS peak, CASE WHEN id % 3 = 0 THEN '2024-01-30' END AS peak_at,
         lat, lon, lat + (id % 10) / 1000 AS plat, id % 6 = 0 AS stale, CASE WHEN id % 12 = 0 THEN '2024' END AS since FROM v5v)
       SELECT id, 'warning above danger' AS violation FROM x WHERE warning > danger UNION ALL SELECT id, 'bad trend word' FROM x WHERE trend = 'up'
       UNION ALL SELECT id, 'peak above danger without time' FROM x WHERE warning IS NOT NULL AND peak >= danger AND peak_at IS NULL
       UNION ALL SELECT id, 'pin away from gauge' FROM x WHERE abs(plat - lat) * 111 > 0.5 UNION ALL SELECT id, 'stale without since' FROM x WHERE stale AND since IS NULL""",
)
def _(t):
    i = F.col("id")
    x = t.v5v.select(
        "id",
        F.when(i % 5 != 0, F.col("level")).alias("warning"),
        F.lit(5000.0).alias("danger"),
        F.when(i % 4 == 0, "rising").when(i % 4 == 1, "up").when(i % 4 == 2, "steady").alias("trend"),
        (F.col("level") + 500).alias("peak"),
        F.when(i % 3 == 0, "2024-01-30").alias("peak_at"),
        F.col("lat").alias("gauge_lat"),
        F.col("lon").alias("gauge_lon"),
        (F.col("lat") + (i % 10) / 1000).alias("pin_lat"),
        F.col("lon").alias("pin_lon"),
        (i % 6 == 0).alias("stale"),
        F.when(i % 12 == 0, "2024").alias("since"),
        F.lit("2024-01-31").alias("checked_at"),
    )
    return Gt.marks_gate(x, "id")
