"""Inputs of the registered queries, derived from the driver's tables (FIXTURES.md, part B).

Rain depths are quantised to 1/64 mm and discharges are whole numbers, so that sums of doubles
are exact in any order and thresholds compare the same in every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freshet.session import cut_lineage

EPOCH = "2024-01-01 00:00:00"

SPARK_VIEWS = {
    # hourly series of 8 points over 30 days, with gaps
    "v1": f"""
        SELECT user_id % 8 AS point_id,
               timestampdiff(HOUR, TIMESTAMP_NTZ'{EPOCH}', ts) AS h,
               floor(CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) * 64) / 64.0D AS mm
        FROM events GROUP BY 1, 2""",
    # irregular telemetry readings
    "v1r": """
        SELECT event_id, user_id % 8 AS station, ts, floor(value * 64) / 64.0D AS value, event_type
        FROM events""",
    # daily discharge of 4 sites
    "v2": """
        SELECT l_suppkey % 4 AS site, CAST(l_shipdate AS DATE) AS d, SUM(l_quantity) AS q
        FROM lineitem GROUP BY 1, 2""",
    # daily rain of 6 points
    "v3": """
        SELECT o_custkey % 6 AS point_id, CAST(o_orderdate AS DATE) AS d,
               floor(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 10000.0D * 64) / 64.0D AS mm
        FROM orders GROUP BY 1, 2""",
    # issued forecasts with lead time, which may be negative: a target that was past when issued
    "v4": """
        SELECT l_suppkey % 4 AS site, CAST(o_orderdate AS DATE) AS issued,
               CAST(l_shipdate AS DATE) AS target, datediff(l_shipdate, o_orderdate) AS lead_d,
               l_quantity * 6 AS fc, l_orderkey, l_linenumber
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    # villages, rain points, river vertices
    "v5v": """
        SELECT c_custkey AS id, c_name AS name, c_nationkey AS district, c_acctbal AS level,
               24.0D + (c_custkey * 37 % 400) / 100.0D AS lat,
               90.0D + (c_custkey * 53 % 600) / 100.0D AS lon FROM customer""",
    "v5p": """
        SELECT s_suppkey AS pid, s_name AS pname, s_nationkey AS pdistrict, s_acctbal AS plevel,
               24.0D + (s_suppkey * 37 % 400) / 100.0D AS plat,
               90.0D + (s_suppkey * 53 % 600) / 100.0D AS plon FROM supplier""",
    "v5r": """
        SELECT p_partkey AS vid, p_name AS vname,
               24.0D + (p_partkey * 37 % 400) / 100.0D AS vlat,
               90.0D + (p_partkey * 53 % 600) / 100.0D AS vlon FROM part""",
    "v5n": """
        SELECT n_nationkey AS poly, 24.0D + (n_nationkey * 37 % 400) / 100.0D AS clat,
               90.0D + (n_nationkey * 53 % 600) / 100.0D AS clon FROM nation""",
    # 8x8 rasters
    "v6": """
        SELECT vec_id, label, CAST(pos DIV 8 AS BIGINT) AS r, CAST(pos % 8 AS BIGINT) AS c, CAST(v AS DOUBLE) AS v
        FROM embeddings LATERAL VIEW posexplode(embedding) t AS pos, v""",
    "v7": r"""
        SELECT page_id, url, html, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title
        FROM pages""",
    "v8": """
        SELECT event_id, user_id % 8 AS station, ts, event_type, floor(value * 64) / 64.0D AS value, props,
               CAST(get_json_object(props, '$.k') AS BIGINT) AS k
        FROM events""",
    "v9": "SELECT doc_id, quality, toxic FROM labels",
}

ORACLE_VIEWS = {
    "v1": f"""SELECT user_id % 8 AS point_id, date_diff('hour', TIMESTAMP '{EPOCH}', ts) AS h,
        FLOOR(CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) * 64) / 64 AS mm FROM events GROUP BY 1, 2""",
    "v1r": """SELECT event_id, user_id % 8 AS station, ts, FLOOR(value * 64) / 64 AS value, event_type
        FROM events""",
    "v2": """SELECT l_suppkey % 4 AS site, CAST(l_shipdate AS DATE) AS d, SUM(l_quantity) AS q
        FROM lineitem GROUP BY 1, 2""",
    "v3": """SELECT o_custkey % 6 AS point_id, CAST(o_orderdate AS DATE) AS d,
        FLOOR(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1e4 * 64) / 64 AS mm
        FROM orders GROUP BY 1, 2""",
    "v4": """SELECT l_suppkey % 4 AS site, CAST(o_orderdate AS DATE) AS issued,
        CAST(l_shipdate AS DATE) AS target, date_diff('day', o_orderdate, l_shipdate) AS lead_d,
        l_quantity * 6 AS fc, l_orderkey, l_linenumber
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v5v": """SELECT c_custkey AS id, c_name AS name, c_nationkey AS district, c_acctbal AS level,
        24.0::DOUBLE + (c_custkey * 37 % 400) / 100.0::DOUBLE AS lat,
        90.0::DOUBLE + (c_custkey * 53 % 600) / 100.0::DOUBLE AS lon FROM customer""",
    "v5p": """SELECT s_suppkey AS pid, s_name AS pname, s_nationkey AS pdistrict, s_acctbal AS plevel,
        24.0::DOUBLE + (s_suppkey * 37 % 400) / 100.0::DOUBLE AS plat,
        90.0::DOUBLE + (s_suppkey * 53 % 600) / 100.0::DOUBLE AS plon FROM supplier""",
    "v5r": """SELECT p_partkey AS vid, p_name AS vname,
        24.0::DOUBLE + (p_partkey * 37 % 400) / 100.0::DOUBLE AS vlat,
        90.0::DOUBLE + (p_partkey * 53 % 600) / 100.0::DOUBLE AS vlon FROM part""",
    "v5n": """SELECT n_nationkey AS poly, 24.0::DOUBLE + (n_nationkey * 37 % 400) / 100.0::DOUBLE AS clat,
        90.0::DOUBLE + (n_nationkey * 53 % 600) / 100.0::DOUBLE AS clon FROM nation""",
    "v6": """SELECT vec_id, label, (pos - 1) // 8 AS r, (pos - 1) % 8 AS c, CAST(embedding[pos] AS DOUBLE) AS v
        FROM (SELECT *, unnest(range(1, 65)) AS pos FROM embeddings)""",
    "v7": r"""SELECT page_id, url, html, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title
        FROM pages""",
    "v8": """SELECT event_id, user_id % 8 AS station, ts, event_type, FLOOR(value * 64) / 64 AS value, props,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "v9": "SELECT doc_id, quality, toxic FROM labels",
    # v1 with missing hours as zero
    "v1d": """SELECT g.point_id, g.h, COALESCE(v1.mm, 0) AS mm FROM
        (SELECT point_id, unnest(range(lo, hi + 1)) AS h FROM (SELECT point_id, min(h) AS lo, max(h) AS hi FROM v1 GROUP BY 1)) g
        LEFT JOIN v1 ON v1.point_id = g.point_id AND v1.h = g.h""",
    # rain points of each basin, the basin's rain by day, and the daily modelling frame
    "rainday": "SELECT basin, d, AVG(mm) AS rain FROM v3 JOIN bridge USING (point_id) GROUP BY 1, 2",
    "upq": "SELECT site, d, q AS qup, q - lag(q) OVER (PARTITION BY site ORDER BY d) AS dqup FROM v2",
    "frame": """SELECT w.*, v2.q, u.qup, u.dqup FROM (
          SELECT basin, d, rain AS rain_24h,
            CASE WHEN count(rain) OVER w2 >= 2 THEN sum(rain) OVER w2 END AS rain_48h,
            CASE WHEN count(rain) OVER w14 >= 10 THEN sum(rain) OVER w14 END AS rain_14d,
            CASE WHEN count(rain) OVER w30 >= 21 THEN sum(rain) OVER w30 END AS rain_30d
          FROM rainday WINDOW w2 AS (PARTITION BY basin ORDER BY d ROWS 1 PRECEDING),
            w14 AS (PARTITION BY basin ORDER BY d ROWS 13 PRECEDING), w30 AS (PARTITION BY basin ORDER BY d ROWS 29 PRECEDING)) w
        LEFT JOIN v2 ON v2.site = w.basin AND v2.d = w.d
        LEFT JOIN upq u ON u.site = (w.basin + 1) % 4 AND u.d = w.d""",
    "bridge": "SELECT b AS basin, unnest(range(b, b + 3)) AS point_id FROM range(4) t(b)",
}

#: Tables of a view that grow with each other, with the keys of their join. An estimate from compressed files takes millions
#: of orders for small and puts them whole into each executor, so both are dealt by the key and merged at every size.
MERGED = {"v4": {"lineitem": "l_orderkey", "orders": "o_orderkey"}}
#: Rows of these tables that one task sorts, about: tasks grow in number with the input and not in memory.
ROWS_PER_TASK = 500_000

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


class Inputs:
    """Tables and fixture views of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._stored: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        sql = SPARK_VIEWS[name]
        used = {t: self.table(t) for t in TABLES if f" {t}" in sql}
        if keys := MERGED.get(name):
            parts = max(self.spark.sparkContext.defaultParallelism, sum(used[t].count() for t in keys) // ROWS_PER_TASK + 1)
            used |= {t: used[t].repartition(parts, key).hint("merge") for t, key in keys.items()}
        for t in used:
            sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
        return self.spark.sql(sql, **used)

    def __getattr__(self, name: str) -> DataFrame:
        if name in SPARK_VIEWS:
            return self.view(name)
        raise AttributeError(name)

    def stored(self, name: str) -> DataFrame:
        """A view written once and read back, for queries that use it several times.

        The aggregated series are far smaller than their tables, so one pass over the table and a
        small write beat a scan per use.
        """
        if name not in self._stored:
            self._stored[name] = cut_lineage(self.view(name))
        return self._stored[name]

    def bridge(self, width: int = 3) -> DataFrame:
        """Basin s of the four configured ones draws on the rain points s .. s+width-1."""
        return self.spark.range(4).selectExpr("id AS basin", f"explode(sequence(id, id + {width - 1})) AS point_id")
