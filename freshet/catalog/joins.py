"""Joins (2.4)."""

from pyspark.sql import functions as F

from freshet.catalog.registry import entry
from freshet.catalog.scalars import hav
from freshet.functions import geometry as G
from freshet.operators import joins as J
from freshet.operators import spatial as P
from freshet.operators.chunks import chunk_width
from freshet.plans import frames
from freshet.session import cut_lineage


@entry(
    "catchment_mean_join",
    "SELECT basin, h, AVG(mm) AS rain FROM v1 JOIN bridge USING (point_id) GROUP BY 1, 2",
    num="rain",
)
def _(t):
    return J.catchment_mean(t.v1, t.bridge(), "point_id", "basin", "h", "mm", "rain")


FRAME_NUM = "rain_24h rain_48h rain_14d rain_30d q qup dqup"


def daily_frame(t):
    rain = J.catchment_mean(t.v3, t.bridge(), "point_id", "basin", "d", "mm", "rain_24h")
    q = t.stored("v2").withColumnRenamed("site", "basin")
    # the next site is upstream of each basin
    return frames.daily_frame(rain, q, q.withColumn("basin", (F.col("basin") + 3) % 4))


def stored_frame(t):
    """The daily frame as a table, for plans that read it several times."""
    return cut_lineage(daily_frame(t))


@entry("daily_frame_join", "SELECT * FROM frame", num=FRAME_NUM, text="d")
def _(t):
    return daily_frame(t)


@entry(
    "threeway_inner",
    """WITH a AS (SELECT site, d, q FROM v2), b AS (SELECT point_id AS site, d, mm AS m1 FROM v3),
       c AS (SELECT point_id - 1 AS site, d, mm AS m2 FROM v3), j AS (SELECT * FROM a JOIN b USING (site, d) JOIN c USING (site, d))
       SELECT * FROM j WHERE site IN (SELECT site FROM j GROUP BY 1 HAVING count(*) >= 300)""",
    num="q m1 m2",
    text="d",
)
def _(t):
    b = t.v3.select(F.col("point_id").alias("site"), "d", F.col("mm").alias("m1"))
    c = t.v3.select((F.col("point_id") - 1).alias("site"), "d", F.col("mm").alias("m2"))
    return J.aligned([t.v2, b, c], ["site", "d"], ["q", "m1", "m2"], at_least=300)


@entry(
    "asof_backward",
    """SELECT p.event_id, c.value AS last_value FROM (SELECT * FROM v1r WHERE event_type = 'purchase') p
       ASOF LEFT JOIN (SELECT * FROM v1r WHERE event_type = 'click') c ON p.station = c.station AND p.ts >= c.ts""",
    num="last_value",
)
def _(t):
    r = t.v1r
    asks, gives = r.filter("event_type = 'purchase'"), r.filter("event_type = 'click'")
    out = J.asof_backward(asks, gives, "station", "ts", "event_id", "event_id", "value", "last_value", width=chunk_width(r, "ts"))
    return out.select("event_id", "last_value")


@entry(
    "nearest_within_tolerance",
    """WITH s AS (SELECT *, floor(epoch(date_trunc('second', ts)))::BIGINT AS s FROM v1r), l AS (SELECT station, max(ts) AS t, arg_max(value, ts) AS v, max(s) AS ls FROM s GROUP BY 1),
       c AS (SELECT s.station, s.ts, s.value, l.v, abs(s.s - (l.ls - 86400)) AS off FROM s JOIN l USING (station)
             WHERE s.s <= l.ls - 64800 AND abs(s.s - (l.ls - 86400)) <= 28800 QUALIFY row_number() OVER (PARTITION BY s.station ORDER BY off, s.ts) = 1)
       SELECT l.station, l.v AS latest, c.ts AS ref_time, l.v - c.value AS delta,
         CASE WHEN l.v - c.value >= 0.05 THEN 'rising' WHEN l.v - c.value <= -0.05 THEN 'falling' WHEN c.ts IS NOT NULL THEN 'steady' END AS word
       FROM l LEFT JOIN c USING (station)""",
    num="latest delta",
    text="ref_time",
)
def _(t):
    return J.nearest_within(t.v1r, "station", "ts", "value", hours=24, near=18, far=8, band=0.05)


KNN_SQL = f"""SELECT id, pid, km, rn FROM (SELECT id, pid, {hav('lat', 'lon', 'plat', 'plon')} AS km,
   row_number() OVER (PARTITION BY id ORDER BY floor({hav('lat', 'lon', 'plat', 'plon')} * 1e6), pid) AS rn FROM v5v, v5p) WHERE rn <= 2"""


@entry(
    "knn2_idw",
    f"""SELECT id, sum(plevel / greatest(km, 1)) / sum(1 / greatest(km, 1)) AS level, sum(plevel % 100 / greatest(km, 1)) / sum(1 / greatest(km, 1)) AS rest
        FROM ({KNN_SQL}) JOIN v5p USING (pid) GROUP BY 1""",
    num="level rest",
)
def _(t):
    near = P.nearest_k(t.v5v, t.v5p, "pid", k=2)
    signals = t.v5p.select("pid", F.col("plevel").alias("level"), (F.col("plevel") % 100).alias("rest"))
    return P.idw(t.v5v, "id", near, signals, "pid", ["level", "rest"])


@entry(
    "nearest_point",
    f"""SELECT id, pid, km, CASE WHEN pid % 10 < 4 THEN pid % 10 END AS basin FROM ({KNN_SQL}) WHERE rn = 1""",
    num="km",
)
def _(t):
    near = P.nearest_k(t.v5v, t.v5p, "pid", k=1)
    targets = t.v5p.select("pid", F.when(F.col("pid") % 10 < 4, F.col("pid") % 10).alias("basin"))
    own = t.v5v.select("id", "lat", "lon").join(near, ["lat", "lon"]).join(targets, "pid", "left")
    return own.select("id", "pid", "km", "basin")


@entry(
    "nearest_vertex_boxed",
    f"""SELECT v.id, n.vid, n.km FROM v5v v LEFT JOIN (SELECT id, vid, {hav('lat', 'lon', 'vlat', 'vlon')} AS km FROM v5v, (SELECT vid, vlat, CASE WHEN vlat < 25.3 THEN vlon ELSE vlon + 5 END AS vlon FROM v5r) r
          WHERE abs(vlat - lat) <= 0.6 AND abs(vlon - lon) <= 0.6
          QUALIFY row_number() OVER (PARTITION BY id ORDER BY floor({hav('lat', 'lon', 'vlat', 'vlon')} * 1e6), vid) = 1) n USING (id)""",
    num="km",
)
def _(t):
    # in the north the river runs five degrees further east, so that boxes there are empty
    river = t.v5r.withColumn("vlon", F.when(F.col("vlat") < 25.3, F.col("vlon")).otherwise(F.col("vlon") + 5))
    near = P.nearest_k(t.v5v, river, "vid", k=1, box=0.6, to=("vlat", "vlon"))
    return t.v5v.select("id", "lat", "lon").join(near, ["lat", "lon"], "left").select("id", "vid", "km")


def diamond(lat, lon, r):
    """Edges of the diamond of radius r (degrees) around a centre."""
    p = lambda dx, dy: F.struct((lon + dx).alias("x"), (lat + dy).alias("y"))
    return G.ring_edges(F.array(p(0.0, -r), p(r, 0.0), p(0.0, r), p(-r, 0.0)))


def polygons(t, outer=0.4, hole=0.1, box=0.5):
    lat, lon = F.col("clat"), F.col("clon")
    part = F.struct(diamond(lat, lon, outer).alias("outer"), F.array(diamond(lat, lon, hole)).alias("holes"))
    return t.v5n.select(
        "poly",
        (lat - box).alias("south"),
        (lat + box).alias("north"),
        (lon - box).alias("west"),
        (lon + box).alias("east"),
        F.array(part).alias("parts"),
    )


POLY_SQL = """WITH ring AS (SELECT poly, kind, unnest([[clon, clat - r, clon + r, clat], [clon + r, clat, clon, clat + r],
                [clon, clat + r, clon - r, clat], [clon - r, clat, clon, clat - r]]) AS e
              FROM v5n, (VALUES ('outer', 0.4::DOUBLE), ('hole', 0.1::DOUBLE)) k(kind, r)),
       seen AS (SELECT id, lat, lon, poly FROM v5v, v5n WHERE lat BETWEEN clat - 0.5::DOUBLE AND clat + 0.5::DOUBLE AND lon BETWEEN clon - 0.5::DOUBLE AND clon + 0.5::DOUBLE),
       cross_ AS (SELECT s.id, s.poly, kind, sum(CASE WHEN (e[2] > lat) <> (e[4] > lat) AND lon < (e[3] - e[1]) * (lat - e[2]) / NULLIF(e[4] - e[2], 0) + e[1] THEN 1 ELSE 0 END) % 2 = 1 AS ins
              FROM seen s JOIN ring USING (poly) GROUP BY 1, 2, 3),
       states AS (SELECT id, poly, bool_or(kind = 'outer' AND ins) AND NOT bool_or(kind = 'hole' AND ins) AS in_water FROM cross_ GROUP BY 1, 2)"""


@entry("point_in_polygon", f"{POLY_SQL} SELECT * FROM states")
def _(t):
    return P.inside_polygons(t.v5v, polygons(t), "id", "poly")


@entry(
    "assess_extent",
    f"""{POLY_SQL} SELECT n.poly, count(*) FILTER (in_water) AS n_in_water, count(*) FILTER (NOT in_water) AS n_observed_dry,
        (SELECT count(*) FROM v5v) - count(in_water) AS n_outside FROM v5n n LEFT JOIN states USING (poly) GROUP BY 1""",
)
def _(t):
    states = P.inside_polygons(t.v5v, polygons(t), "id", "poly")
    return frames.extent_summary(states, t.v5n.select("poly"), t.v5v, "poly")


def scene_inputs(t, half=0.2):
    lat, lon = F.col("clat"), F.col("clon")
    events = t.v5n.select(
        F.col("poly").alias("event"),
        (lat - 0.2).alias("south"),
        (lat + 0.2).alias("north"),
        (lon - half).alias("west"),
        (lon + half).alias("east"),
        F.lit("2024-01-25").alias("prefer_after"),
        lat.alias("clat"),
        lon.alias("clon"),
    )
    i = F.col("pid")
    w = F.lit(0.15) + (i % 5) * 0.05
    sx, sy = F.col("clon") + ((i % 7) - 3) * 0.06, F.col("clat") + ((i % 3) - 1) * 0.05
    p = lambda dx, dy: F.struct((sx + dx).alias("x"), (sy + dy).alias("y"))
    ring = F.array(p(-w, -w - 0.02), p(w, -w + 0.02), p(w, w + 0.02), p(-w, w - 0.02))
    scenes = (
        t.v5p.withColumn("event", F.col("pdistrict"))
        .join(events.select("event", "clat", "clon"), "event")
        .select(
            "event",
            i.alias("scene"),
            G.ring_edges(ring).alias("edges"),
            (sy - w - 0.02).alias("s_south"),
            (sy + w + 0.02).alias("s_north"),
            (sx - w).alias("s_west"),
            (sx + w).alias("s_east"),
            (i % 4 != 3).alias("platform_ok"),
            F.date_add(F.lit("2024-01-01").cast("date"), (i * 7 % 60).cast("int")).cast("string").alias("acquired"),
        )
    )
    return events.drop("clat", "clon"), scenes


SCENE_SQL = """WITH sc AS (SELECT pid AS scene, poly AS event, clat, clon, 0.15::DOUBLE + (pid % 5) * 0.05::DOUBLE AS w,
         clon + ((pid % 7) - 3) * 0.06::DOUBLE AS sx, clat + ((pid % 3) - 1) * 0.05::DOUBLE AS sy, pid % 4 <> 3 AS platform_ok,
         CAST(DATE '2024-01-01' + CAST(pid * 7 % 60 AS INT) AS VARCHAR) AS acquired FROM v5p JOIN v5n ON poly = pdistrict),
       ed AS (SELECT scene, unnest([[sx + -w, sy + (-w - 0.02::DOUBLE), sx + w, sy + (-w + 0.02::DOUBLE)], [sx + w, sy + (-w + 0.02::DOUBLE), sx + w, sy + (w + 0.02::DOUBLE)],
         [sx + w, sy + (w + 0.02::DOUBLE), sx + -w, sy + (w - 0.02::DOUBLE)], [sx + -w, sy + (w - 0.02::DOUBLE), sx + -w, sy + (-w - 0.02::DOUBLE)]]) AS e FROM sc),
       co AS (SELECT scene, k, CASE WHEN k IN (0, 3) THEN clon - 0.2::DOUBLE ELSE clon + 0.2::DOUBLE END AS x, CASE WHEN k IN (0, 1) THEN clat - 0.2::DOUBLE ELSE clat + 0.2::DOUBLE END AS y FROM sc, range(4) r(k)),
       ins AS (SELECT scene, k, sum(CASE WHEN (e[2] > y) <> (e[4] > y) AND x < (e[3] - e[1]) * (y - e[2]) / NULLIF(e[4] - e[2], 0) + e[1] THEN 1 ELSE 0 END) % 2 = 1 AS i FROM co JOIN ed USING (scene) GROUP BY 1, 2),
       j AS (SELECT sc.*, f.full_ AS "full", greatest(least(clon + 0.2::DOUBLE, sx + w) - greatest(clon - 0.2::DOUBLE, sx - w), 0)
             * greatest(least(clat + 0.2::DOUBLE, sy + w + 0.02::DOUBLE) - greatest(clat - 0.2::DOUBLE, sy - w - 0.02::DOUBLE), 0) AS overlap
             FROM sc JOIN (SELECT scene, bool_and(i) AS full_ FROM ins GROUP BY 1) f USING (scene)),
       b AS (SELECT event, scene, "full", overlap FROM j QUALIFY row_number() OVER (PARTITION BY event ORDER BY NOT "full", "full" AND acquired < '2024-01-25',
             "full" AND NOT platform_ok, CASE WHEN "full" THEN 0 ELSE -overlap END, acquired, scene) = 1)
       SELECT * FROM b WHERE "full" OR overlap >= 0.0004"""


@entry("best_scene_per_event", SCENE_SQL, num="overlap")
def _(t):
    return P.best_scene(*scene_inputs(t), "event", "scene")


CLIP_SQL = SCENE_SQL.replace("clon - 0.2::DOUBLE", "clon - 0.4::DOUBLE").replace("clon + 0.2::DOUBLE", "clon + 0.4::DOUBLE")
INSIDE_SQL = "sum(CASE WHEN (e[2] > y) <> (e[4] > y) AND x < (e[3] - e[1]) * (y - e[2]) / NULLIF(e[4] - e[2], 0) + e[1] THEN 1 ELSE 0 END) % 2 = 1"


@entry(
    "clip_to_footprint",
    f"""WITH best AS ({CLIP_SQL}), ar AS (SELECT event, scene, clon - 0.4::DOUBLE AS w, clon + 0.4::DOUBLE AS e_, clat - 0.2::DOUBLE AS s, clat + 0.2::DOUBLE AS n FROM best JOIN v5n ON poly = event),
        sh AS (SELECT pid AS scene, 0.15::DOUBLE + (pid % 5) * 0.05::DOUBLE AS w, clon + ((pid % 7) - 3) * 0.06::DOUBLE AS sx, clat + ((pid % 3) - 1) * 0.05::DOUBLE AS sy FROM v5p JOIN v5n ON poly = pdistrict),
        ed AS (SELECT scene, unnest([[sx + -w, sy + (-w - 0.02::DOUBLE), sx + w, sy + (-w + 0.02::DOUBLE)], [sx + w, sy + (-w + 0.02::DOUBLE), sx + w, sy + (w + 0.02::DOUBLE)],
          [sx + w, sy + (w + 0.02::DOUBLE), sx + -w, sy + (w - 0.02::DOUBLE)], [sx + -w, sy + (w - 0.02::DOUBLE), sx + -w, sy + (-w - 0.02::DOUBLE)]]) AS e FROM sh),
        l1 AS (SELECT event, scene, w + (e_ - w) * i / 119 AS x, s + (n - s) * j / 59 AS y FROM ar, range(120) a(i), range(60) b(j)),
        i1 AS (SELECT event, x, y FROM l1 JOIN ed USING (scene) GROUP BY 1, 2, 3 HAVING {INSIDE_SQL}),
        we AS (SELECT ar.event, greatest(any_value(w), max(a)) AS cw, least(any_value(e_), min(b)) AS ce FROM ar JOIN (SELECT event, y, min(x) AS a, max(x) AS b FROM i1 GROUP BY 1, 2) k USING (event) GROUP BY 1),
        l2 AS (SELECT ar.event, scene, cw + (ce - cw) * i / 59 AS x, s + (n - s) * j / 59 AS y FROM ar JOIN we USING (event), range(60) a(i), range(60) b(j) WHERE ce > cw),
        i2 AS (SELECT event, x, y FROM l2 JOIN ed USING (scene) GROUP BY 1, 2, 3 HAVING {INSIDE_SQL}),
        sn AS (SELECT ar.event, greatest(any_value(s), max(a)) AS cs, least(any_value(n), min(b)) AS cn FROM ar JOIN (SELECT event, x, min(y) AS a, max(y) AS b FROM i2 GROUP BY 1, 2) k USING (event) GROUP BY 1),
        bx AS (SELECT event, scene, cw + 0.01::DOUBLE AS west, cs + 0.01::DOUBLE AS south, ce - 0.01::DOUBLE AS east, cn - 0.01::DOUBLE AS north FROM ar JOIN we USING (event) JOIN sn USING (event)),
        ck AS (SELECT event, k, CASE WHEN k IN (0, 3) THEN west ELSE east END AS x, CASE WHEN k IN (0, 1) THEN south ELSE north END AS y, scene FROM bx, range(4) r(k)),
        ok AS (SELECT event FROM (SELECT event, k FROM ck JOIN ed USING (scene) GROUP BY event, k, x, y HAVING {INSIDE_SQL}) GROUP BY 1 HAVING count(*) = 4)
        SELECT event, west, south, east, north FROM bx JOIN ok USING (event) WHERE east - west >= 0.05 AND north - south >= 0.05""",
    num="west south east north",
)
def _(t):
    # an area too wide for any one scene
    events, scenes = scene_inputs(t, half=0.4)
    best = P.best_scene(events, scenes, "event", "scene").select("event", "scene")
    chosen = events.join(best, "event").join(scenes.select("event", "scene", "edges"), ["event", "scene"])
    return P.clip_to_footprint(chosen, "event")


@entry(
    "prepost_pair",
    """WITH s AS (SELECT site, year(issued) AS y, CASE WHEN lead_d <= 90 THEN 'pre' ELSE 'peak' END AS w, CASE WHEN lead_d <= 90 THEN l_linenumber % 2 ELSE l_orderkey % 3 END AS orbit, issued, l_orderkey, l_linenumber FROM v4),
       pk AS (SELECT p.*, EXISTS (SELECT 1 FROM s x WHERE x.site = p.site AND x.y = p.y AND x.w = 'pre' AND x.orbit = p.orbit) AS same FROM s p WHERE w = 'peak'),
       ch AS (SELECT * FROM pk QUALIFY row_number() OVER (PARTITION BY site, y ORDER BY NOT same, issued, l_orderkey, l_linenumber) = 1)
       SELECT c.site, c.y, c.l_orderkey AS peak_key, p.l_orderkey AS pre_key, p.issued AS pre_issued, c.same AS same_orbit FROM ch c JOIN s p
         ON p.site = c.site AND p.y = c.y AND p.w = 'pre' AND (NOT c.same OR p.orbit = c.orbit)
       QUALIFY row_number() OVER (PARTITION BY c.site, c.y ORDER BY p.issued DESC, p.l_orderkey DESC, p.l_linenumber DESC) = 1""",
    text="pre_issued",
)
def _(t):
    pre = F.col("lead_d") <= 90
    s = t.v4.select(
        "site",
        F.year("issued").alias("y"),
        F.when(pre, "pre").otherwise("peak").alias("w"),
        F.when(pre, F.col("l_linenumber") % 2).otherwise(F.col("l_orderkey") % 3).alias("orbit"),
        "issued",
        "l_orderkey",
        "l_linenumber",
    )
    p = J.pre_post_pair(s, ["site", "y"], "w", "orbit", ["issued", "l_orderkey", "l_linenumber"])
    return p.select(
        "site",
        "y",
        F.col("peak.l_orderkey").alias("peak_key"),
        F.col("pre.l_orderkey").alias("pre_key"),
        F.col("pre.issued").alias("pre_issued"),
        "same_orbit",
    )


@entry(
    "value_at_target",
    """SELECT l_orderkey, l_linenumber, o.q AS obs, p.q AS pers FROM v4 LEFT JOIN v2 o ON o.site = v4.site AND o.d = target LEFT JOIN v2 p ON p.site = v4.site AND p.d = issued""",
    num="obs pers",
)
def _(t):
    j = J.value_at(t.v4, t.v2, "site", "d", "q", {"obs": "target", "pers": "issued"})
    return j.select("l_orderkey", "l_linenumber", "obs", "pers")


@entry("anti_known", """SELECT l_orderkey, l_linenumber FROM v4 a WHERE NOT EXISTS (SELECT 1 FROM v4 b
    WHERE b.lead_d > 100 AND b.l_linenumber <= 3 AND b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber)""")
def _(t):
    return J.unknown_only(t.v4.select("l_orderkey", "l_linenumber"), t.v4.filter("lead_d > 100 AND l_linenumber <= 3"), ["l_orderkey", "l_linenumber"])


@entry(
    "entity_time_grid",
    """WITH g AS (SELECT pid, pid % 8 AS point_id, unnest(range(0, 715, 6)) AS h FROM v5p)
       SELECT g.pid, g.h, COALESCE(SUM(v1.mm), 0) AS rain_24h FROM g LEFT JOIN v1 ON v1.point_id = g.point_id AND v1.h > g.h - 24 AND v1.h <= g.h GROUP BY 1, 2""",
    num="rain_24h",
)
def _(t):
    grid = J.time_grid(t.v5p.select("pid", (F.col("pid") % 8).alias("point_id")), F.lit(0), F.lit(714), 6, "h")
    steps = grid.select("point_id", "h").distinct()
    from freshet.operators.windows import trailing_window_at

    sums = trailing_window_at(t.v1, steps, "point_id", "h", "mm", (24,)).withColumnRenamed("sum_24h", "rain_24h")
    return grid.join(sums, ["point_id", "h"]).select("pid", "h", "rain_24h")


PLACE_SQL = """WITH pl AS (SELECT c_custkey AS id, c_nationkey % 5 AS district, CASE c_custkey % 4 WHEN 0 THEN p_name WHEN 1 THEN 'old ' || p_name WHEN 2 THEN split_part(p_name, ' ', 1) ELSE 'nowhere' END AS name,
           lat, lon FROM customer JOIN part ON p_partkey = c_custkey JOIN v5v ON id = c_custkey),
       gz AS (SELECT p_partkey AS gid, p_partkey % 5 AS district, p_name AS name, vlat, vlon FROM part JOIN v5r ON vid = p_partkey),
       al AS (SELECT DISTINCT 'old ' || p_name AS name, p_name AS alias FROM part),
       hit AS (SELECT pl.id, gid, 0 AS tier, vlat, vlon FROM pl JOIN gz ON gz.district = pl.district AND gz.name = pl.name
         UNION ALL SELECT pl.id, gid, 1, vlat, vlon FROM pl JOIN al ON al.name = pl.name JOIN gz ON gz.district = pl.district AND gz.name = al.alias
         UNION ALL SELECT pl.id, gid, 2, vlat, vlon FROM pl JOIN gz ON gz.district = pl.district AND starts_with(gz.name, pl.name || ' ')),
       b AS (SELECT hit.* FROM hit JOIN pl USING (id) QUALIFY row_number() OVER (PARTITION BY id ORDER BY tier, floor(sqrt(pow(vlat - lat, 2) + pow(vlon - lon, 2)) * 1e6), gid) = 1)
       SELECT pl.id, b.gid, COALESCE(vlat, lat) AS lat, COALESCE(vlon, lon) AS lon, CASE WHEN gid IS NULL THEN 'approximate' ELSE 'matched' END AS precision FROM pl LEFT JOIN b USING (id)"""


@entry("fuzzy_place_match", PLACE_SQL, num="lat lon")
def _(t):
    part = t.table("part").select("p_partkey", "p_name")
    name, i = F.col("p_name"), F.col("id") % 4
    places = t.v5v.join(part, F.col("id") == F.col("p_partkey")).select(
        "id",
        (F.col("district") % 5).alias("district"),
        F.when(i == 0, name)
        .when(i == 1, F.concat(F.lit("old "), name))
        .when(i == 2, F.split_part(name, F.lit(" "), F.lit(1)))
        .otherwise("nowhere")
        .alias("name"),
        "lat",
        "lon",
    )
    gaz = part.join(t.v5r, F.col("vid") == F.col("p_partkey")).select(
        F.col("vid").alias("gid"), (F.col("vid") % 5).alias("district"), name.alias("name"), F.col("vlat").alias("plat"), F.col("vlon").alias("plon")
    )
    alias = part.select(F.concat(F.lit("old "), name).alias("name"), name.alias("alias"), F.lit(1).alias("tier")).distinct()
    return P.match_places(places, gaz, alias, "name", "district", "gid").select("id", "gid", "lat", "lon", "precision")


@entry(
    "seasonal_band_join",
    """SELECT p.site, p.d, count(*) AS n, sum(r.q) AS s FROM (SELECT * FROM v2 WHERE year(d) = 2000) p JOIN v2 r ON r.site = p.site AND year(r.d) < 2000
       AND least(abs(dayofyear(r.d) - dayofyear(p.d)), 366 - abs(dayofyear(r.d) - dayofyear(p.d))) <= 15 GROUP BY 1, 2""",
    num="s",
    text="d",
)
def _(t):
    ref = t.v2.filter("year(d) < 2000").select("site", F.dayofyear("d").alias("doy"), "q")
    probe = t.v2.filter("year(d) = 2000").select("site", "d", F.dayofyear("d").alias("pdoy"))
    return J.seasonal_band(ref, probe, "site", "doy", "pdoy", 15).groupBy("site", "d").agg(F.count(F.lit(1)).alias("n"), F.sum("q").alias("s"))


@entry(
    "manifest_full_outer",
    """WITH o AS (SELECT site, issued, sum(l_orderkey) AS s, count(*) AS n FROM v4 WHERE day(issued) <> 5 GROUP BY 1, 2),
       n AS (SELECT site, issued, sum(l_orderkey + CASE WHEN day(issued) = 9 THEN 1 ELSE 0 END) AS s, count(*) AS n FROM v4 WHERE day(issued) <> 20 GROUP BY 1, 2)
       SELECT site, issued, CASE WHEN n.s IS NULL THEN 'missing' WHEN o.s IS NULL THEN 'added' ELSE 'changed' END AS change
       FROM o FULL JOIN n USING (site, issued) WHERE n.s IS DISTINCT FROM o.s""",
    text="issued",
)
def _(t):
    f = t.v4.select("site", "issued", "l_orderkey", "l_linenumber")
    new = f.withColumn("l_orderkey", F.col("l_orderkey") + F.when(F.dayofmonth("issued") == 9, 1).otherwise(0))
    cols = ["l_orderkey", "l_linenumber"]
    old = J.content_hash(f.filter("day(issued) <> 5"), ["site", "issued"], cols)
    return J.manifest_diff(old, J.content_hash(new.filter("day(issued) <> 20"), ["site", "issued"], cols), ["site", "issued"], "digest")


@entry(
    "best_cell_in_band",
    """WITH c AS (SELECT pdistrict AS poly, pid, plat, plon, CASE WHEN pdistrict % 6 <> 0 THEN avg(c_acctbal) END AS mean FROM v5p LEFT JOIN customer ON c_custkey // 15 = pid GROUP BY 1, 2, 3, 4),
       s AS (SELECT *, 4400 + poly * 20 AS qmin, CASE WHEN poly % 2 = 0 THEN 4700 + poly * 20 END AS qmax FROM v5n),
       j AS (SELECT s.poly, clat, clon, plat, plon, mean, mean >= qmin AND (qmax IS NULL OR mean <= qmax) AS fits,
               floor(sqrt(pow(plat - clat, 2) + pow(plon - clon, 2)) * 1e6) AS d FROM s LEFT JOIN c USING (poly)),
       b AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY poly ORDER BY NOT COALESCE(fits, false), CASE WHEN fits THEN d END,
             CASE WHEN fits THEN plat END, CASE WHEN fits THEN plon END, mean DESC NULLS LAST, plat, plon) = 1)
       SELECT poly, COALESCE(CASE WHEN mean IS NOT NULL THEN plat END, clat) AS clat, COALESCE(CASE WHEN mean IS NOT NULL THEN plon END, clon) AS clon, mean,
         CASE WHEN fits THEN 'in band' WHEN mean IS NOT NULL THEN 'largest' ELSE 'anchor' END AS how FROM b""",
    num="clat clon mean",
)
def _(t):
    # fifteen customers make a cell's mean; cells of every sixth district have none
    means = t.table("customer").groupBy(F.expr("c_custkey div 15").alias("pid")).agg(F.avg("c_acctbal").alias("mean"))
    cells = t.v5p.join(means, "pid", "left").select(
        F.col("pdistrict").alias("poly"), F.col("plat").alias("clat"), F.col("plon").alias("clon"), F.when(F.col("pdistrict") % 6 != 0, F.col("mean")).alias("mean")
    )
    p = F.col("poly")
    stations = t.v5n.select(
        "poly",
        F.col("clat").alias("lat"),
        F.col("clon").alias("lon"),
        (F.lit(4400.0) + p * 20).alias("qmin"),
        F.when(p % 2 == 0, F.lit(4700.0) + p * 20).alias("qmax"),
    )
    return P.best_cell_in_band(stations, cells, "poly")


@entry(
    "dedupe_candidate_cells",
    """SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY floor(lat * 100 + 0.5), floor(lon * 100 + 0.5) ORDER BY id) AS rn FROM v5v
         WHERE level >= 2000 AND (id % 3 = 0 OR level <= 8000)) WHERE rn = 1""",
)
def _(t):
    c = t.v5v.select(
        "id", "lat", "lon", F.col("level").alias("mean"), F.lit(2000.0).alias("qmin"), F.when(F.col("id") % 3 != 0, 8000.0).alias("qmax")
    )
    return P.distinct_cells(c, "id").select("id")
