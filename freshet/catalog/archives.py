"""Sources, parsing jobs and sinks (2.1)."""

from pyspark.sql import functions as F

from freshet.catalog.registry import entry
from freshet.session import fresh_path
from freshet.sources import archive as Ar
from freshet.sources import documents as D
from freshet.sources import grids as Gr
from freshet.sources import points as P

EPOCH = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"


@entry("scan_hourly_points", "SELECT point_id, h, mm FROM v1 WHERE h // 240 IN (0, 2) AND point_id IN (1, 3, 5)", num="mm")
def _(t):
    table = t.v1.withColumn("part", F.floor(F.col("h") / 240).cast("int"))
    path = P.write_partitioned(table, fresh_path(t.spark, "hourly"), "part")
    return P.scan_points(t.spark, path, table.schema, "part", [0, 2], "point_id", [1, 3, 5]).drop("part")


@entry("scan_daily_site", "SELECT site, d, q FROM v2 WHERE year(d) IN (1996, 1999, 2001) AND site = 2", num="q", text="d")
def _(t):
    table = t.v2.withColumn("year", F.year("d"))
    path = P.write_partitioned(table, fresh_path(t.spark, "daily"), "year")
    return P.scan_points(t.spark, path, table.schema, "year", [1996, 1999, 2001], "site", [2]).drop("year")


@entry(
    "explode_parallel_arrays",
    """SELECT point_id, TIMESTAMP '2024-01-01' + INTERVAL (h) HOUR AS t, mm, CASE WHEN h <= 360 THEN 'OBSERVED' ELSE 'FORECAST' END AS cls
       FROM v1 WHERE h BETWEEN 288 AND 408 AND h % 6 <> 0""",
    num="mm",
    text="t",
)
def _(t):
    hour = F.struct("h", F.when(F.col("h") % 6 != 0, F.col("mm")).alias("mm"))
    g = t.v1.groupBy("point_id").agg(F.array_sort(F.collect_list(hour)).alias("a"))
    times = F.expr(f"transform(a, x -> date_format(timestampadd(HOUR, x.h, {EPOCH}), \"yyyy-MM-dd'T'HH:mm\"))")
    doc = F.to_json(F.struct(F.struct(times.alias("time"), F.col("a.mm").alias("precipitation")).alias("hourly")))
    now = F.expr("TIMESTAMP_NTZ'2024-01-16 00:00:00'")
    return D.hourly_rows(g.select("point_id", doc.alias("doc")), "point_id", "doc", now)


@entry(
    "explode_ensemble_daily",
    """SELECT site, d, q, CASE WHEN d <= DATE '2000-06-30' THEN 'OBSERVED' ELSE 'FORECAST' END AS cls, CASE WHEN day(d) % 3 = 0 THEN q - 10 END AS e_min,
         CASE WHEN day(d) % 2 = 0 THEN q + 1 END AS e_median, CASE WHEN day(d) % 3 = 0 THEN q + 10 END AS e_max, day(d) % 3 = 0 OR day(d) % 2 = 0 AS has_ensemble
       FROM v2 WHERE dayofyear(d) % 50 <> 0""",
    num="q e_min e_median e_max",
    text="d",
)
def _(t):
    q, third, second = F.col("q"), F.dayofmonth("d") % 3 == 0, F.dayofmonth("d") % 2 == 0
    row = F.struct(
        F.col("d").cast("string").alias("time"),
        F.when(F.dayofyear("d") % 50 != 0, q).alias("river_discharge"),
        F.when(third, q - 10).alias("river_discharge_min"),
        F.when(second, q + 1).alias("river_discharge_median"),
        F.lit(None).cast("double").alias("river_discharge_mean"),
        F.when(third, q + 10).alias("river_discharge_max"),
    )
    g = t.v2.groupBy("site", F.year("d").alias("y")).agg(F.array_sort(F.collect_list(row)).alias("a"))
    names = ["time", "river_discharge", *[f"river_discharge_{p}" for p in ("min", "median", "mean", "max")]]
    doc = F.to_json(F.struct(F.struct(*[F.col(f"a.{n}").alias(n) for n in names]).alias("daily")))
    rows = D.daily_rows(g.select("site", doc.alias("doc")), ["site"], "doc", F.lit("2000-06-30").cast("date"))
    e = F.col("ensemble")
    return rows.select(
        "site", "d", "q", "cls", e["min"].alias("e_min"), e["median"].alias("e_median"), e["max"].alias("e_max"), e.isNotNull().alias("has_ensemble")
    )


@entry(
    "ingest_telemetry_csv",
    """SELECT CAST(station AS VARCHAR) AS station, date_trunc('minute', ts) AS t, CASE WHEN event_type IN ('click', 'view') THEN value ELSE value + 1 END AS value
       FROM v1r WHERE event_id % 10 NOT IN (3, 4)""",
    num="value",
    text="t",
)
def _(t):
    i = F.col("event_id") % 10
    text = t.v1r.select(
        "event_type",
        F.col("station").alias("Station"),
        F.when(i == 3, "soon").otherwise(F.date_format("ts", "dd-MM-yyyy HH:mm")).alias("Data Acquisition Time"),
        F.when(i != 4, F.col("value")).alias("value"),
    )
    a = text.filter("event_type IN ('click', 'view')").select("Station", "Data Acquisition Time", F.col("value").alias("Rainfall (mm)"))
    b = text.filter("event_type NOT IN ('click', 'view')").select(
        F.lit("x").alias("District"), "Station", "Data Acquisition Time", (F.col("value") + 1).alias("Level")
    )
    parts = []
    for name, df in (("rain", a), ("level", b)):
        path = fresh_path(t.spark, f"telemetry-{name}")
        df.write.option("header", "true").csv(path)
        parts.append(P.read_telemetry(t.spark, path))
    rows = parts[0].unionByName(parts[1])
    out = fresh_path(t.spark, "stations")
    P.write_partitioned(rows, out, "station")
    return t.spark.read.schema(rows.schema).parquet(out)


def telemetry_files(t):
    """Readings in folders of three layouts: as published, with odd letters and blanks in the header, and without a header."""
    i = F.col("event_id") % 10
    card = F.struct(
        (24 + F.col("station") / 4).alias("Latitude"), F.when(F.col("station") == 5, 110.0).otherwise(90.0).alias("Longitude"), F.concat(F.lit("D"), F.col("station") % 3).alias("District")
    )
    cells = t.v1r.select("event_id", "station", card.alias("c"), F.when(i == 3, "soon").otherwise(F.date_format("ts", "dd-MM-yyyy HH:mm")).alias("at"), F.when(i != 4, F.col("value")).alias("v"))
    head = {"plain": ["Station", "District", "Latitude", "Longitude", "Data Acquisition Time", "Rainfall (mm)"], "odd": [" station ", "DISTRICT", "latitude", "Longitude ", "data acquisition TIME", "Level"]}
    # each layout in one file, so the accounts do not depend on how the rows were dealt out
    paths = {}
    for k, (name, titled) in enumerate((("plain", True), ("odd", True), ("bare", False))):
        own = cells.filter(F.col("event_id") % 3 == k).select("station", "c.District", "c.Latitude", "c.Longitude", "at", "v")
        paths[name] = f"{fresh_path(t.spark, 'telemetry')}/{name}"
        keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        own.toDF(*head.get(name, head["plain"])).coalesce(1).write.options(header=titled, **keep).csv(paths[name])
    return list(paths.values())


@entry(
    "telemetry_account",
    """SELECT CASE event_id % 3 WHEN 0 THEN 'plain' WHEN 1 THEN 'odd' ELSE 'bare' END AS layout, count(*) AS n_rows, CASE WHEN event_id % 3 = 2 THEN 0 ELSE count(*) FILTER (event_id % 10 NOT IN (3, 4)) END AS kept,
         CASE WHEN event_id % 3 = 2 THEN 0 ELSE count(*) FILTER (event_id % 10 = 3) END AS bad_time, CASE WHEN event_id % 3 = 2 THEN 0 ELSE count(*) FILTER (event_id % 10 = 4) END AS no_value,
         CASE WHEN event_id % 3 = 2 THEN 'no header' END AS reason FROM v1r GROUP BY event_id % 3""",
)
def _(t):
    account = P.telemetry_account(t.spark, telemetry_files(t))
    return account.select(F.regexp_extract("file", "/([a-z]+)/[^/]*$", 1).alias("layout"), "n_rows", "kept", "bad_time", "no_value", "reason")


@entry(
    "telemetry_stations",
    """SELECT CAST(station AS VARCHAR) AS station, 'D' || (station % 3) AS district, 24 + station / 4 AS lat, CASE WHEN station = 5 THEN 110.0 ELSE 90.0 END AS lon, count(*) AS n_rows,
         min(date_trunc('minute', ts)) AS "first", max(date_trunc('minute', ts)) AS "last", station <> 5 AS position_trusted FROM v1r WHERE event_id % 10 NOT IN (3, 4) AND event_id % 3 < 2 GROUP BY station""",
    num="lat lon",
    text="first last",
)
def _(t):
    return P.station_cards(P.read_telemetry(t.spark, telemetry_files(t), located=True), (20.0, 85.0, 500.0, 100.0))


@entry(
    "ingest_station_marks",
    """SELECT name AS "Station", 'North, upper' AS "District", lat AS "Latitude", CASE WHEN id % 5 <> 0 THEN level END AS "WarningLevel" FROM v5v WHERE id % 9 <> 4""",
    num="Latitude WarningLevel",
)
def _(t):
    i = F.col("id")
    line = F.concat_ws(",", F.concat("name", F.lit(" ")), F.lit('"North, upper"'), "lat", F.when(i % 5 != 0, F.col("level").cast("string")).otherwise("-"))
    line = F.when(i % 9 == 4, F.concat_ws(",", "name", F.lit("short"))).when(i % 9 == 5, F.concat(line, F.lit(",7.1,7.2"))).otherwise(line)
    path = fresh_path(t.spark, "marks")
    # whole lines as one unquoted column: every file of the folder starts with the header
    raw = {"header": True, "sep": "\u0001", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    t.v5v.select(line.alias("Station,District,Latitude,WarningLevel")).write.options(**raw).csv(path)
    return P.read_station_marks(t.spark, path)


@entry(
    "split_observed_forecast",
    """SELECT l_orderkey, l_linenumber, 'observed' AS kind FROM v4 WHERE lead_d % 3 <> 0 UNION ALL SELECT l_orderkey, l_linenumber, 'forecast' FROM v4 WHERE target > DATE '1999-01-01'""",
)
def _(t):
    wide = t.v4.withColumn("obs", F.when(F.col("lead_d") % 3 != 0, F.col("fc"))).withColumn("tof", F.lit("1999-01-01").cast("date"))
    obs, fc = P.split_observed_forecast(wide, "target", "obs", "tof")
    cols = ["l_orderkey", "l_linenumber"]
    return obs.select(*cols, F.lit("observed").alias("kind")).unionByName(fc.select(*cols, F.lit("forecast").alias("kind")))


@entry(
    "extract_alert_fields",
    """SELECT page_id, CASE WHEN page_id % 10 = 0 THEN CAST(page_id AS VARCHAR) ELSE 'A-' || page_id END AS identifier, '' AS sender, url AS event, trim(title) AS headline,
         trim('line one' || chr(10) || 'line two of ' || page_id) AS description, CASE WHEN page_id % 4 <> 0 THEN 25 + page_id / 100 END AS approx_lat, CASE WHEN page_id % 4 <> 0 THEN 91.5 END AS approx_lon FROM v7""",
    num="approx_lat approx_lon",
)
def _(t):
    p = F.col("page_id")
    tag = lambda n, v: F.concat(F.lit(f"<cap:{n}>"), v, F.lit(f"</cap:{n}>"))
    doc = F.concat(
        F.lit("<alert>"),
        tag("identifier", F.when(p % 10 == 0, "").otherwise(F.concat(F.lit("A-"), p.cast("string")))),
        tag("event", F.col("url")),
        tag("headline", F.concat(F.lit("\n "), F.col("title"), F.lit(" "))),
        tag("description", F.concat(F.lit("line one\nline two of "), p.cast("string"), F.lit("\n"))),
        tag("altitude", F.when(p % 4 == 0, "not given").otherwise((F.lit(25) + p / 100).cast("string"))),
        tag("ceiling", F.lit("91.5")),
        F.col("html"),
        F.lit("</alert>"),
    )
    out = D.alert_fields(t.v7.select("page_id", doc.alias("doc")), "page_id", "doc")
    ident = F.regexp_extract("description", r"of (\d+)$", 1).cast("bigint").alias("page_id")
    return out.select(ident, "identifier", "sender", "event", "headline", "description", "approx_lat", "approx_lon")


@entry(
    "feed_item_relevance",
    r"""WITH u AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM v7), x AS (SELECT page_id, unnest(range(0, len(l))) AS i, unnest(l) AS u FROM u)
        SELECT page_id, CAST(page_id * 1000 + i AS VARCHAR) AS identifier FROM x WHERE i % 4 <> 3 AND regexp_matches(lower(u), '/(de|the|un)')""",
)
def _(t):
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    item = lambda u, i: F.concat(
        F.lit("<item><link>\n"),
        u,
        F.when(i % 4 != 3, F.concat(F.lit(" FetchXMLFile?identifier="), (F.col("page_id") * 1000 + i).cast("string"))).otherwise(""),
        F.lit("</link></item>"),
    )
    feed = F.concat(F.lit("<rss>"), F.array_join(F.transform(links, item), ""), F.lit("</rss>"))
    return D.relevant_items(t.v7.select("page_id", feed.alias("feed")), "page_id", "feed", "/(de|the|un)").drop("item")


@entry(
    "grid_to_rows",
    "SELECT vec_id, 24 + r * 0.25 AS lat, 90 + c * 0.25 AS lon, v FROM v6 WHERE r BETWEEN 1 AND 6 AND c BETWEEN 2 AND 7 AND v >= 0",
    num="lat lon v",
)
def _(t):
    grid = F.expr("transform(sequence(0, 7), r -> slice(embedding, r * 8 + 1, 8))")
    df = t.table("embeddings").select("vec_id", grid.cast("array<array<double>>").alias("grid"))
    return Gr.grid_rows(df, ["vec_id"], "grid", 24.0, 90.0, 0.25, (24.2, 90.4, 25.6, 92.0))


@entry(
    "sample_grid_at_points",
    """WITH c AS (SELECT CAST(round_even((90 - vlat) / 0.1::DOUBLE, 0) AS BIGINT) AS r, CAST(round_even((vlon + 180) / 0.1::DOUBLE, 0) AS BIGINT) AS c, max(vid % 97) AS raw FROM v5r GROUP BY 1, 2)
       SELECT id, CASE WHEN raw < 90 THEN raw * 2.4 END AS mm FROM v5v LEFT JOIN c ON c.r = round_even((90 - lat) / 0.1::DOUBLE, 0) AND c.c = round_even((lon + 180) / 0.1::DOUBLE, 0)""",
    num="mm",
)
def _(t):
    row = F.bround((F.lit(90.0) - F.col("vlat")) / 0.1).cast("bigint").alias("row")
    col = F.bround((F.col("vlon") + 180) / 0.1).cast("bigint").alias("col")
    cells = t.v5r.groupBy(row, col).agg(F.max(F.col("vid") % 97).alias("raw"))
    return Gr.sample_at_points(t.v5v.select("id", "lat", "lon"), cells, fill=90.0).select("id", "mm")


ENTITIES = ["the", "la", "der", "of", "de", "die", "el"]
ENTITY_SQL = "[" + ", ".join(f"'{e}'" for e in ENTITIES) + "]"


@entry(
    "word_table_to_rows",
    f"""WITH w AS (SELECT doc_id, unnest(range(0, len(l))) AS i, unnest(l) AS w FROM (SELECT doc_id, string_split(text, ' ') AS l FROM documents)),
        p AS (SELECT doc_id, i // 8 AS line, (i * 3) % 8 AS x, CASE WHEN i % 8 < 3 THEN w ELSE CAST(length(w) AS VARCHAR) END AS w FROM w),
        g AS (SELECT doc_id, line, string_agg(w, ' ' ORDER BY x) AS raw, count(*) FILTER (regexp_full_match(w, '-?\\d+(\\.\\d+)?')) AS n_numbers,
               sum(CASE WHEN regexp_full_match(w, '-?\\d+(\\.\\d+)?') THEN least(CAST(w AS DOUBLE), 1000) END) AS total FROM p GROUP BY 1, 2),
        e AS (SELECT *, list_filter({ENTITY_SQL}, lambda e: starts_with(raw, e) OR contains(' ' || raw || ' ', ' ' || e || ' '))[1] AS entity FROM g)
        SELECT doc_id, line, entity, n_numbers, total, raw FROM e WHERE entity IS NOT NULL AND n_numbers >= 4""",
    num="total",
)
def _(t):
    words = t.table("documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("i", "w"))
    i = F.col("i")
    words = words.select(
        "doc_id",
        (F.floor(i / 8) * 3 + (i % 2) * 0.4).alias("top"),
        (i * 3 % 8).alias("x"),
        F.when(i % 8 < 3, F.col("w")).otherwise(F.length("w").cast("string")).alias("text"),
    )
    lines = D.line_table(words, "doc_id", "top", "x", "text", ENTITIES)
    total = F.aggregate("numbers", F.lit(0.0), lambda a, x: a + F.least(x, F.lit(1000.0)))
    return lines.select("doc_id", "line", "entity", F.size("numbers").alias("n_numbers"), total.alias("total"), "raw")


@entry(
    "label_positional_numbers",
    """WITH x AS (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b, embedding[3]::DOUBLE AS de, embedding[4]::DOUBLE AS p, embedding[5]::DOUBLE AS s, 6 + vec_id % 4 AS n FROM embeddings)
       SELECT vec_id, a AS mddl_m, b AS frl_m, de AS designed_mu, p AS present_level_m, CASE WHEN de > 0 AND n >= 9 THEN s END AS present_storage_mu,
         CASE WHEN b > a AND p >= a AND p <= b + 1 THEN (p - a) / (b - a) END AS fill_fraction, n AS n_raw, n NOT IN (6, 9) AS needs_review FROM x""",
    num="mddl_m frl_m designed_mu present_level_m present_storage_mu fill_fraction",
)
def _(t):
    nums = F.slice("embedding", 1, (F.lit(6) + F.col("vec_id") % 4).cast("int")).cast("array<double>")
    return D.label_numbers(t.table("embeddings").select("vec_id", nums.alias("nums")), "nums").drop("nums")


@entry(
    "flatten_snapshot",
    """SELECT event_id, CAST(ts AS DATE) AS generated_at, 'b' || station AS basin, event_id % 11 = 0 AS degraded, CASE WHEN event_id % 2 = 0 THEN 'lag_rule' ELSE 'm' || k END AS shipped,
         CASE WHEN event_id % 5 <> 0 THEN k END AS q_now_m3s, value AS predicted_h1_m3s, CASE WHEN event_id % 7 <> 0 THEN k / 100 END AS p_exceed_h1, 60.5 AS threshold_m3s,
         CASE WHEN event_id % 3 = 0 THEN 'RED' WHEN event_id % 3 = 1 THEN 'GREEN' END AS colour, CASE WHEN event_id % 11 = 0 THEN 'no input' END AS error FROM v8""",
    num="q_now_m3s predicted_h1_m3s p_exceed_h1 threshold_m3s",
    text="generated_at",
)
def _(t):
    e, k = F.col("event_id"), F.col("k").cast("string")
    num = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    wrap = lambda c: F.concat(F.lit('{"value":'), c, F.lit(',"class":"FORECAST","source":"x"}'))
    either = lambda c: F.when(e % 2 == 0, wrap(c)).otherwise(c)
    quoted = F.when(e % 3 == 0, '"RED"').when(e % 3 == 1, '"GREEN"').otherwise("null")
    doc = F.concat(
        F.lit('{"generated_at":"'), F.col("ts").cast("date").cast("string"),
        F.lit('","basin":"b'), F.col("station").cast("string"),
        F.when(e % 11 == 0, '","degraded":true,"error":"no input"').otherwise('"'),
        F.when(e % 2 == 0, ',"shipped":"lag_rule"').otherwise(F.concat(F.lit(',"model":"m'), k, F.lit('"'))),
        F.lit(',"inputs":{"q_today_m3s":'), either(F.when(e % 5 != 0, k).otherwise("null")),
        F.lit('},"predictions":{"h1":{"q_m3s":'), either(num(F.col("value"))),
        F.lit(',"p_exceed_threshold":'), either(F.when(e % 7 != 0, num(F.col("k") / 100)).otherwise("null")),
        F.lit('}},"threshold_m3s":'), either(F.lit("60.5")), F.lit(',"colour":'), either(quoted), F.lit("}"),
    )
    return D.flatten_snapshot(t.v8.select("event_id", doc.alias("doc")), "event_id", "doc")


MERGE_SQL = """u AS (SELECT 0 AS b, site, issued, target, fc, l_orderkey, l_linenumber FROM v4 WHERE lead_d <= 100
      UNION ALL SELECT 1, site, issued, target, fc + 1, l_orderkey, l_linenumber FROM v4 WHERE lead_d > 60)"""


def merge_sides(t):
    cols = ["site", "issued", "target", "fc", "l_orderkey", "l_linenumber"]
    old = t.v4.filter("lead_d <= 100").select(*cols)
    new = t.v4.filter("lead_d > 60").withColumn("fc", F.col("fc") + 1).select(*cols)
    return old, new


KEYS, ORDER = ["site", "issued", "target"], ["l_orderkey", "l_linenumber", "fc"]


def merged(t, keep):
    """An archive by year of issue after two batches, the second one sent twice."""
    old, new = merge_sides(t)
    archive = Ar.Archive(t.spark, fresh_path(t.spark, "archive"), old.schema, KEYS, ORDER, F.year("issued"), keep)
    for name, batch in (("old", old), ("new", new), ("new", new)):
        archive.merge(batch, name)
    return archive.read()


@entry(
    "merge_archive_keep_last",
    f"""WITH {MERGE_SQL} SELECT site, issued, target, fc, l_orderkey, l_linenumber FROM u
        QUALIFY row_number() OVER (PARTITION BY site, issued, target ORDER BY b DESC, l_orderkey DESC, l_linenumber DESC, fc DESC) = 1""",
    num="fc",
    text="issued target",
)
def _(t):
    return merged(t, "last")


@entry(
    "merge_archive_keep_first",
    f"""WITH {MERGE_SQL} SELECT site, issued, target, fc, l_orderkey, l_linenumber FROM u
        QUALIFY row_number() OVER (PARTITION BY site, issued, target ORDER BY b, l_orderkey, l_linenumber, fc) = 1""",
    num="fc",
    text="issued target",
)
def _(t):
    return merged(t, "first")


@entry(
    "merge_empty_safe",
    f"""WITH {MERGE_SQL} SELECT site, issued, fc, l_orderkey, l_linenumber FROM u WHERE b = 1
        QUALIFY row_number() OVER (PARTITION BY site, issued ORDER BY l_orderkey DESC, l_linenumber DESC, fc DESC) = 1""",
    num="fc",
    text="issued",
)
def _(t):
    new = merge_sides(t)[1].drop("target")
    nothing = t.spark.createDataFrame([], new.schema)
    archive = Ar.Archive(t.spark, fresh_path(t.spark, "archive"), new.schema, ["site", "issued"], ORDER, F.year("issued"))
    for name, batch in (("empty", nothing), ("new", new), ("again empty", nothing)):
        archive.merge(batch, name)
    return archive.read()


@entry(
    "partition_sidecar",
    """SELECT v2.site, year(v2.d) AS year, count(*) AS n_rows, min(v2.d) AS first, max(v2.d) AS last, 'site,d,q,year,issued' AS columns, count(CASE WHEN dayofyear(v2.d) % 50 <> 0 THEN q END) AS n_q, count(DISTINCT month(v2.d)) AS n_issued FROM v2 GROUP BY 1, 2""",
    text="first last",
)
def _(t):
    df = t.v2.withColumn("q", F.when(F.dayofyear("d") % 50 != 0, F.col("q"))).withColumn("year", F.year("d")).withColumn("issued", F.month("d"))
    return P.partition_sidecar(df, ["site", "year"], "d", ["q"], "issued")


@entry(
    "publish_wrapped",
    """SELECT '{"id":' || id || ',"lat":{"value":' || lat || ',"class":"OBSERVED","source":"gazetteer","retrieved_at":"2024-01-31T00:00Z"},"level":{"value":' || level
         || ',"class":"SIMULATED","source":"gazetteer","retrieved_at":"2024-01-31T00:00Z"}}' AS document FROM v5v""",
)
def _(t):
    docs = Ar.publish_documents(t.v5v, {"lat": "OBSERVED", "level": "SIMULATED"}, F.lit("gazetteer"), F.lit("2024-01-31T00:00Z"), ["id"])
    return Ar.write_documents(docs, fresh_path(t.spark, "published"))


@entry(
    "catalog_diff",
    """WITH s AS (SELECT site, unnest(range(1994, 2003)) AS year FROM (SELECT DISTINCT site FROM v2)), g AS (SELECT site, year(d) AS year, count(*) AS n FROM v2 GROUP BY 1, 2)
       SELECT site, year, COALESCE(n, 0) AS n_rows, dayofyear(make_date(year, 12, 31)) AS expected FROM s LEFT JOIN g USING (site, year)
       WHERE COALESCE(n, 0) < dayofyear(make_date(year, 12, 31)) * 0.98""",
)
def _(t):
    have = P.partition_sidecar(t.v2.withColumn("year", F.year("d")), ["site", "year"], "d", ["q"])
    return P.catalog_diff(have, t.v2.select("site").distinct(), "site", (1994, 2002))
