"""Projections and scalar functions (2.2)."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from freshet.catalog.registry import entry
from freshet.functions import geometry as G
from freshet.functions import scalars as S

HAVERSINE_SQL = (
    "2 * 6371.0::DOUBLE * asin(sqrt(pow(sin(radians({b} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({b}))"
    " * pow(sin(radians({d} - {c}) / 2), 2)))"
)


def hav(a, c, b, d):
    """Oracle text of the distance between (a, c) and (b, d)."""
    return HAVERSINE_SQL.format(a=a, b=b, c=c, d=d)


@entry(
    "classify_past_future",
    "SELECT point_id, h, CASE WHEN h <= 360 THEN 'OBSERVED' ELSE 'FORECAST' END AS cls FROM v1",
)
def _(t):
    return t.v1.select("point_id", "h", S.past_or_future(F.col("h"), F.lit(360)).alias("cls"))


@entry(
    "parse_multiformat_time",
    """SELECT event_id, CASE event_id % 4
         WHEN 0 THEN date_trunc('second', ts) - INTERVAL 330 MINUTE
         WHEN 3 THEN NULL ELSE date_trunc('minute', ts) - INTERVAL 330 MINUTE END AS utc FROM v1r""",
    text="utc",
)
def _(t):
    e = F.col("event_id") % 4
    txt = (
        F.when(e == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(e == 1, F.date_format("ts", "yyyy-MM-dd HH:mm"))
        .when(e == 2, F.concat(F.lit(" "), F.date_format("ts", "dd/MM/yy HH:mm"), F.lit(" ")))
        .otherwise("not reported")
    )
    return t.v1r.select("event_id", S.parse_station_time(txt).alias("utc"))


@entry("fixed_offset_shift", "SELECT event_id, CAST(ts - INTERVAL 330 MINUTE AS DATE) AS d FROM v1r", text="d")
def _(t):
    return t.v1r.select("event_id", S.local_to_utc(F.col("ts")).cast("date").alias("d"))


@entry(
    "safe_number",
    "SELECT event_id, CASE event_id % 4 WHEN 0 THEN k WHEN 3 THEN k + 0.5 END AS v FROM v8",
    num="v",
)
def _(t):
    k = F.col("k").cast("string")
    e = F.col("event_id") % 4
    txt = F.when(e == 0, k).when(e == 1, F.lit("NaN")).when(e == 2, F.concat(k, F.lit("x"))).otherwise(F.concat(k, F.lit(".5")))
    return t.v8.select("event_id", S.number_or_null(txt).alias("v"))


@entry(
    "key_sanitise",
    r"""SELECT c_custkey, COALESCE(NULLIF(left(lower(trim(regexp_replace('  ' || CASE WHEN c_custkey % 9 = 0 THEN '' ELSE c_name || ' -- ' || c_mktsegment END || '!',
         '[^A-Za-z0-9]+', '_', 'g'), '_')), 20), ''), 'unnamed') AS k FROM customer""",
)
def _(t):
    raw = F.when(F.col("c_custkey") % 9 == 0, "").otherwise(F.concat_ws(" -- ", "c_name", "c_mktsegment"))
    raw = F.concat(F.lit("  "), raw, F.lit("!"))
    return t.table("customer").select("c_custkey", S.key_of(raw, lower=True, limit=20, default="unnamed").alias("k"))


@entry(
    "fold_diacritics",
    r"""SELECT doc_id, regexp_replace(replace(lower(strip_accents(text)), 'ß', 'ss'), '^\s+|\s+$', '', 'g') AS folded FROM documents""",
)
def _(t):
    return t.table("documents").select("doc_id", S.fold_text(F.col("text")).alias("folded"))


PAIR_SQL = "SELECT id, lat, lon, clat, clon FROM v5v JOIN v5n ON district = poly"


def _pair(t):
    return t.v5v.join(t.v5n, F.col("district") == F.col("poly"))


@entry("haversine_km", f"SELECT id, {hav('lat', 'lon', 'clat', 'clon')} AS km FROM ({PAIR_SQL})", num="km")
def _(t):
    return _pair(t).select("id", G.haversine_km(F.col("lat"), F.col("lon"), F.col("clat"), F.col("clon")).alias("km"))


@entry(
    "planar_offset_km",
    f"SELECT id, sqrt(pow((clat - lat) * 111, 2) + pow((clon - lon) * 111 * cos(radians(lat)), 2)) AS km FROM ({PAIR_SQL})",
    num="km",
)
def _(t):
    return _pair(t).select("id", G.planar_km(F.col("clat"), F.col("clon"), F.col("lat"), F.col("lon")).alias("km"))


@entry(
    "snap_quarter_degree",
    "SELECT id, round_even(lat * 4, 0) / 4 AS glat, round_even(lon * 4, 0) / 4 AS glon FROM v5v",
    num="glat glon",
)
def _(t):
    return t.v5v.select("id", G.snap_quarter(F.col("lat")).alias("glat"), G.snap_quarter(F.col("lon")).alias("glon"))


@entry(
    "cyclic_doy_distance",
    "SELECT site, d, least(abs(dayofyear(d) - 15), 366 - abs(dayofyear(d) - 15)) AS gap FROM v2",
    text="d",
)
def _(t):
    return t.v2.select("site", "d", S.cyclic_day_distance(F.dayofyear("d"), F.lit(15)).alias("gap"))


@entry(
    "doy_harmonics",
    "SELECT site, d, sin(2 * pi() * dayofyear(d) / 365.25::DOUBLE) AS s, cos(2 * pi() * dayofyear(d) / 365.25::DOUBLE) AS c FROM v2",
    num="s c",
    text="d",
)
def _(t):
    d = F.col("d")
    return t.v2.select("site", "d", S.day_harmonic(d, "sin").alias("s"), S.day_harmonic(d, "cos").alias("c"))


@entry(
    "rain_score",
    """SELECT point_id, h, CASE WHEN a >= 60 OR b >= 100 THEN 2 WHEN a >= 30 OR b >= 60 THEN 1 ELSE 0 END AS score FROM (
         SELECT point_id, h, SUM(mm) OVER (PARTITION BY point_id ORDER BY h RANGE BETWEEN 23 PRECEDING AND CURRENT ROW) / 40 AS a,
                SUM(mm) OVER (PARTITION BY point_id ORDER BY h RANGE BETWEEN 47 PRECEDING AND CURRENT ROW) / 40 AS b FROM v1)""",
)
def _(t):
    w = W.partitionBy("point_id").orderBy("h")
    a = F.sum("mm").over(w.rangeBetween(-23, 0)) / 40
    b = F.sum("mm").over(w.rangeBetween(-47, 0)) / 40
    return t.v1.select("point_id", "h", S.rain_score(a, b).alias("score"))


@entry(
    "discharge_score",
    "SELECT site, d, CASE WHEN p >= 0.9 THEN 2 WHEN p >= 0.7 THEN 1 ELSE 0 END AS score FROM (SELECT *, (q % 100) / 100::DOUBLE AS p FROM v2)",
    text="d",
)
def _(t):
    return t.v2.select("site", "d", S.discharge_score((F.col("q") % 100) / 100).alias("score"))


@entry(
    "risk_class",
    "SELECT site, d, CASE WHEN s >= 3 THEN 'RED' WHEN s = 2 THEN 'YELLOW' ELSE 'GREEN' END AS cls FROM (SELECT *, q % 5 AS s FROM v2)",
    text="d",
)
def _(t):
    return t.v2.select("site", "d", S.risk_class(F.col("q") % 5).alias("cls"))


@entry(
    "two_tier_colour",
    """SELECT site, d, CASE WHEN hi >= 0.5 THEN 'RED' WHEN lo >= 0.2 THEN 'YELLOW' ELSE 'GREEN' END AS colour
       FROM (SELECT *, (q * 3 % 100) / 100::DOUBLE AS hi, (q * 7 % 100) / 100::DOUBLE AS lo FROM v2)""",
    text="d",
)
def _(t):
    q = F.col("q")
    return t.v2.select("site", "d", S.two_tier_colour((q * 7 % 100) / 100, (q * 3 % 100) / 100).alias("colour"))


@entry(
    "trend_word_pct",
    """SELECT site, d, pct, CASE WHEN pct >= 5 THEN 'rising' WHEN pct <= -5 THEN 'falling' WHEN pct IS NOT NULL THEN 'steady' END AS word
       FROM (SELECT site, d, CASE WHEN b > 0 THEN 100.0 * (q - b) / b END AS pct
             FROM (SELECT *, lag(q, 2) OVER (PARTITION BY site ORDER BY d) AS b FROM v2))""",
    num="pct",
    text="d",
)
def _(t):
    before = F.lag("q", 2).over(W.partitionBy("site").orderBy("d"))
    pct = S.trend_pct(F.col("q"), before)
    return t.v2.select("site", "d", pct.alias("pct")).withColumn("word", S.trend_word(F.col("pct")))


MARKS_SQL = """SELECT id, level, CASE WHEN id % 5 <> 0 THEN 3000.0 + id % 7 * 100 END AS warning,
               CASE WHEN id % 7 <> 0 THEN 6000.0 + id % 3 * 500 END AS danger FROM v5v"""


def marks(t):
    i = F.col("id")
    return t.v5v.select(
        "id",
        "level",
        F.when(i % 5 != 0, F.lit(3000.0) + i % 7 * 100).alias("warning"),
        F.when(i % 7 != 0, F.lit(6000.0) + i % 3 * 500).alias("danger"),
    )


@entry(
    "official_mark_status",
    f"""SELECT id, CASE WHEN danger IS NOT NULL AND level >= danger THEN 'above_danger'
          WHEN warning IS NOT NULL AND level >= warning THEN 'above_warning' ELSE 'below_warning' END AS status,
          warning - level AS margin FROM ({MARKS_SQL})""",
    num="margin",
)
def _(t):
    lvl, warn, danger = F.col("level"), F.col("warning"), F.col("danger")
    return marks(t).select("id", S.mark_status(lvl, warn, danger).alias("status"), (warn - lvl).alias("margin"))


@entry(
    "exposure_tier",
    f"""SELECT id, CASE WHEN dr IS NULL THEN NULL WHEN dr <= 6 AND km <= 8 THEN 'higher'
          WHEN dr >= 20 OR km >= 20 THEN 'lower' ELSE 'moderate' END AS tier
        FROM (SELECT id, (level - plevel) / 100 AS dr, {hav('lat', 'lon', 'plat', 'plon')} / 20 AS km
              FROM v5v LEFT JOIN v5p ON pid = id % 120)""",
)
def _(t):
    # a few places refer to a river point without an elevation
    v = t.v5v.withColumn("pid", F.col("id") % 120)
    j = v.join(t.v5p, "pid", "left")
    km = G.haversine_km(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon")) / 20
    return j.select("id", S.exposure_tier(F.col("level") / 100, F.col("plevel") / 100, km).alias("tier"))


@entry(
    "basis_sentence",
    f"""SELECT id, CASE id % 3 WHEN 0 THEN '{S.SENTENCE_RED.replace("%s", "' || name || '")}'
        WHEN 1 THEN '{S.SENTENCE_YELLOW.replace("%s", "' || name || '")}'
        ELSE '{S.SENTENCE_GREEN.replace("%s", "' || name || '", 1).replace("%s", "' || CASE id % 2 WHEN 0 THEN 'rising' ELSE 'steady' END || '")}' END AS basis FROM v5v""",
)
def _(t):
    i = F.col("id")
    colour = F.when(i % 3 == 0, "RED").when(i % 3 == 1, "YELLOW").otherwise("GREEN")
    word = F.when(i % 2 == 0, "rising").otherwise("steady")
    return t.v5v.select("id", S.basis_sentence(colour, F.col("name"), word).alias("basis"))


HEADLINE_SQL = r"""SELECT page_id, html, url, CASE WHEN page_id % 3 = 0 THEN 'No river named: ' || title
  ELSE 'Above normal: River ' || regexp_extract(url, '//([a-z.]*)', 1) || ' (' || regexp_extract(title, '([A-Za-z]+)', 1) || ') at Station ' || page_id END AS headline FROM v7"""


def headlines(t):
    host = F.regexp_extract("url", "//([a-z.]*)", 1)
    word = F.regexp_extract("title", "([A-Za-z]+)", 1)
    named = F.concat(F.lit("Above normal: River "), host, F.lit(" ("), word, F.lit(") at Station "), F.col("page_id"))
    return t.v7.select(
        "page_id",
        "html",
        "url",
        F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("No river named: "), "title")).otherwise(named).alias("headline"),
    )


@entry(
    "extract_river",
    rf"""SELECT page_id, NULLIF(trim(regexp_extract(replace(headline, '.', ' '), 'River\s+([A-Za-z()\- ]+?)\s+at\s', 1)), '') AS river
         FROM ({HEADLINE_SQL})""",
)
def _(t):
    return headlines(t).select("page_id", S.river_named(F.translate("headline", ".", " ")).alias("river"))


@entry(
    "bbox_flag",
    """SELECT id, lat BETWEEN 25 AND 27 AND lon BETWEEN 91 AND 95 AS trusted,
       CASE WHEN lat BETWEEN 25 AND 27 AND lon BETWEEN 91 AND 95 THEN NULL ELSE 'coordinates outside the region' END AS note FROM v5v""",
)
def _(t):
    ok = G.within_box(F.col("lat"), F.col("lon"), 25, 91, 27, 95)
    return t.v5v.select("id", ok.alias("trusted"), F.when(~ok, "coordinates outside the region").alias("note"))


UTM_SQL = """
WITH k AS (SELECT *, 6378137.0::DOUBLE AS a, 2 * f - f * f AS e2 FROM (
       SELECT vec_id, r, c, 500000.0::DOUBLE + (c - 4) * 30000 + vec_id AS x, 2900000.0::DOUBLE - r * 40000 AS y, 46 AS zone,
              1 / 298.257223563::DOUBLE AS f FROM v6)),
k2 AS (SELECT *, e2 / (1 - e2) AS ep2, (1 - sqrt(1 - e2)) / (1 + sqrt(1 - e2)) AS e1 FROM k),
k3 AS (SELECT *, (y / 0.9996::DOUBLE) / (a * (1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256)) AS mu, (x - 500000) / 0.9996::DOUBLE AS xx FROM k2),
k4 AS (SELECT *, mu + (3 * e1 / 2 - 27 * e1 ** 3 / 32) * sin(2 * mu) + (21 * e1 ** 2 / 16 - 55 * e1 ** 4 / 32) * sin(4 * mu)
        + (151 * e1 ** 3 / 96) * sin(6 * mu) + (1097 * e1 ** 4 / 512) * sin(8 * mu) AS p FROM k3),
k5 AS (SELECT *, a / sqrt(1 - e2 * sin(p) ** 2) AS n, tan(p) ** 2 AS t, ep2 * cos(p) ** 2 AS cc,
        a * (1 - e2) / (1 - e2 * sin(p) ** 2) ** 1.5::DOUBLE AS rr FROM k4),
k6 AS (SELECT *, xx / n AS dd FROM k5)
SELECT vec_id, r, c,
  degrees(p - (n * tan(p) / rr) * (dd ** 2 / 2 - (5 + 3 * t + 10 * cc - 4 * cc ** 2 - 9 * ep2) * dd ** 4 / 24
     + (61 + 90 * t + 298 * cc + 45 * t ** 2 - 252 * ep2 - 3 * cc ** 2) * dd ** 6 / 720)) AS lat,
  degrees(radians((zone - 1) * 6 - 180 + 3) + (dd - (1 + 2 * t + cc) * dd ** 3 / 6
     + (5 - 2 * cc + 28 * t - 3 * cc ** 2 + 8 * ep2 + 24 * t ** 2) * dd ** 5 / 120) / cos(p)) AS lon FROM k6"""


@entry("utm_to_lonlat", UTM_SQL, num="lat lon")
def _(t):
    x = F.lit(500000.0) + (F.col("c") - 4) * 30000 + F.col("vec_id")
    y = F.lit(2900000.0) - F.col("r") * 40000
    lon, lat = G.utm_to_lonlat(x, y, F.lit(46))
    return t.v6.select("vec_id", "r", "c", lat.alias("lat"), lon.alias("lon"))


@entry(
    "db_threshold",
    "SELECT vec_id, r, c, pow(10, v * 100 / 10) AS sigma0, pow(10, v * 100 / 10) < pow(10, -1.8) AS water FROM v6",
    num="sigma0",
)
def _(t):
    s0 = G.decibel_to_linear(F.col("v") * 100)
    return t.v6.select("vec_id", "r", "c", s0.alias("sigma0"), G.is_water(s0).alias("water"))


@entry("satellite_unit_scale", "SELECT vec_id, r, c, CASE WHEN v < 0.1 THEN v * 2.4::DOUBLE END AS mm FROM v6", num="mm")
def _(t):
    return t.v6.select("vec_id", "r", "c", G.satellite_mm(F.col("v"), fill=0.1).alias("mm"))
