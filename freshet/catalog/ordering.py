"""Sort, limit and set operations (2.7)."""

from pyspark.sql import functions as F

from freshet.catalog.registry import entry
from freshet.catalog.scalars import HEADLINE_SQL, headlines
from freshet.functions import scalars as S
from freshet.operators import archive_rows as R
from freshet.operators import ordering as O
from freshet.session import fresh_path
from freshet.sources import archive as Ar
from freshet.sources import points as P


@entry("active_sorted", "SELECT point_id, h, h + point_id * 24 AS expires FROM v1 WHERE h + point_id * 24 > 600 ORDER BY h DESC, point_id DESC")
def _(t):
    a = t.v1.select("point_id", "h", (F.col("h") + F.col("point_id") * 24).alias("expires"))
    return O.active_sorted(a, "expires", F.lit(600), ["h", "point_id"])


@entry(
    "ranked_report",
    """SELECT id, district, row_number() OVER (PARTITION BY district ORDER BY COALESCE(CASE WHEN id % 10 <> 0 THEN level END, 0) DESC, name) AS rank FROM v5v""",
)
def _(t):
    r = F.coalesce(F.when(F.col("id") % 10 != 0, F.col("level")), F.lit(0.0))
    df = t.v5v.withColumn("r", r)
    # rows without a score all tie at 0 and may be many: within that tie the name goes on splitting
    tie = F.col("r") == 0
    bucket = F.struct(F.floor(-F.col("r") / 500).alias("a"), (~tie).alias("b"), F.when(tie, F.left("name", F.lit(14))).otherwise("").alias("c"))
    ranked = O.bucketed_rank(df, ["district"], bucket, [F.col("r").desc(), F.col("name")])
    return ranked.select("id", "district", "rank").orderBy("district", "rank")


@entry("union_partitions", "SELECT site, d, CASE WHEN year(d) < 1999 THEN q END AS q FROM v2 WHERE year(d) IN (1996, 1998, 2000)", num="q", text="d")
def _(t):
    root = fresh_path(t.spark, "parts")
    for y in (1996, 1998, 2000):
        part = t.v2.filter(F.year("d") == y)
        # a later part that lacks a column
        (part if y < 1999 else part.drop("q")).write.parquet(f"{root}/{y}")
    return P.union_parts(t.spark, [f"{root}/{y}" for y in range(1996, 2003)], t.v2.schema)


@entry(
    "union_partitions_account",
    """SELECT y AS part, CASE WHEN y = 1998 THEN 2 WHEN y = 2000 THEN 0 ELSE 1 END AS n_files, CASE WHEN y IN (1996, 1998) THEN (SELECT count(*) FROM v2 WHERE year(d) = y) ELSE 0 END AS n_rows,
         CASE y WHEN 1997 THEN 'unreadable' WHEN 1998 THEN 'unreadable' WHEN 2000 THEN 'missing' END AS lost FROM (VALUES (1996), (1997), (1998), (2000)) f(y)""",
)
def _(t):
    root = fresh_path(t.spark, "parts")
    # one part is whole, one is no table at all, one has a file that is none among its files, one is not there
    for y in (1996, 1998):
        t.v2.filter(F.year("d") == y).coalesce(1).write.parquet(f"{root}/{y}")
    for y in (1997, 1998):
        t.v2.filter(F.year("d") == y).select(F.col("d").cast("string")).coalesce(1).write.mode("append").text(f"{root}/{y}")
    account = P.parts_account(t.spark, [f"{root}/{y}" for y in (1996, 1997, 1998, 2000)])
    part = F.regexp_extract("path", "/([0-9]+)$", 1).cast("bigint")
    return account.groupBy(part.alias("part")).agg(F.count("file").alias("n_files"), F.sum(F.coalesce("n_rows", F.lit(0))).alias("n_rows"), F.max("reason").alias("lost"))


COVERED = ["ANAND", "EN", "TION"]


@entry(
    "coverage_gap",
    rf"""WITH r AS (SELECT DISTINCT NULLIF(trim(regexp_extract(replace(headline, '.', ' '), 'River\s+([A-Za-z()\- ]+?)\s+at\s', 1)), '') AS river FROM ({HEADLINE_SQL}))
        SELECT river FROM r WHERE river IS NOT NULL AND NOT (upper(river) LIKE '%ANAND%' OR upper(river) LIKE '%EN%' OR upper(river) LIKE '%TION%')""",
)
def _(t):
    named = headlines(t).select(S.river_named(F.translate("headline", ".", " ")).alias("river"))
    return O.uncovered(named, "river", COVERED)


@entry(
    "missing_dates",
    """WITH k AS (SELECT site, d FROM v2 WHERE day(d) <> 13) SELECT site, d FROM (SELECT site, CAST(unnest(generate_series(DATE '1995-06-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT DISTINCT site FROM k))
       WHERE (site, d) NOT IN (SELECT (site, d) FROM k)""",
    text="d",
)
def _(t):
    have = t.v2.filter("day(d) <> 13")
    return P.missing_days(have, ["site"], "d", F.lit("1995-06-01").cast("date"), F.lit("2001-12-31").cast("date"))


@entry(
    "distinct_keys",
    "SELECT id, lat, lon FROM v5v QUALIFY row_number() OVER (PARTITION BY floor(lat * 4), floor(lon * 4) ORDER BY id) = 1",
    num="lat lon",
)
def _(t):
    v = t.v5v.select("id", "lat", "lon", F.floor(F.col("lat") * 4).alias("a"), F.floor(F.col("lon") * 4).alias("b"))
    return R.first_distinct(v, ["a", "b"], ["id"]).drop("a", "b")


@entry(
    "replace_source_slice",
    """WITH old AS (SELECT l_orderkey * 10 + l_linenumber AS eid, CASE WHEN l_linenumber % 2 = 0 THEN 'official' ELSE 'model' END AS source, issued, fc FROM v4 WHERE lead_d <= 120),
       new AS (SELECT l_orderkey * 10 + l_linenumber AS eid, 'model' AS source, issued, fc + 1 AS fc FROM v4 WHERE lead_d > 80)
       SELECT eid, source, issued, fc FROM (SELECT 0 AS b, * FROM new UNION ALL SELECT 1, * FROM old WHERE source = 'official')
       QUALIFY row_number() OVER (PARTITION BY eid ORDER BY b DESC, issued DESC, fc DESC) = 1""",
    num="fc",
    text="issued",
)
def _(t):
    eid = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("eid")
    src = F.when(F.col("l_linenumber") % 2 == 0, "official").otherwise("model").alias("source")
    old = t.v4.filter("lead_d <= 120").select(eid, src, "issued", "fc")
    new = t.v4.filter("lead_d > 80").select(eid, F.lit("model").alias("source"), "issued", (F.col("fc") + 1).alias("fc"))
    return Ar.replace_slice(old, new, F.col("source") == "official", "eid", ["issued", "fc"])
