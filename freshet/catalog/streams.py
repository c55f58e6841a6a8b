"""Streaming jobs (2.10). Each run drains its source into the shared folder and reads the sink."""

from pyspark.sql import functions as F

from freshet.catalog.registry import entry
from freshet.streaming import jobs as Jb
from freshet.streaming.runs import drain, drain_newest, file_stream, land


def readings(t):
    """The events table as a stream of readings."""
    e = file_stream(t.spark, f"{t.sf_dir}/events.parquet*", t.table("events").schema)
    return e.select(
        "event_id", (F.col("user_id") % 8).alias("station"), F.col("ts").cast("timestamp").alias("ts"), (F.floor(F.col("value") * 64) / 64).alias("value")
    )


@entry("stream_archive_dedupe", "SELECT event_id, station, ts, value + CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS value FROM v1r", num="value", text="ts")
def _(t):
    # the rolling feed sends rows again that it has already delivered, some of them corrected
    feed = readings(t).withColumn("version", F.lit(1))
    again = readings(t).filter("event_id % 3 = 0").withColumns({"value": F.col("value") + 1, "version": F.lit(2)})
    archive = drain_newest(feed.unionByName(again), "dedupe", ["event_id"], ["version"])
    return archive.drop("version").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@entry(
    "stream_daily_totals",
    "SELECT station, date_trunc('day', ts)::TIMESTAMP AS day, sum(value) AS total, count(*) AS n FROM v1r GROUP BY 1, 2",
    num="total",
    text="day",
)
def _(t):
    return drain_newest(Jb.totals(readings(t), "station", "ts", "value"), "daily", ["station", "start"]).withColumnRenamed("start", "day")


@entry(
    "stream_trailing_24h",
    """SELECT station, "at", sum(value) AS total FROM (SELECT station, value, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 6 HOUR + INTERVAL (k * 6) HOUR AS "at" FROM v1r, range(4) r(k))
        GROUP BY 1, 2""",
    num="total",
    text='"at"',
)
def _(t):
    return drain_newest(Jb.trailing_windows(readings(t), "station", "ts", "value"), "trailing", ["station", "at"])


@entry(
    "stream_threshold_events",
    """WITH x AS (SELECT station, date_trunc('hour', ts)::TIMESTAMP AS hour, sum(value) AS total FROM v1r GROUP BY 1, 2),
       z AS (SELECT *, total >= 100 AS up, row_number() OVER w AS rn, max(hour) OVER (PARTITION BY station) AS newest FROM x WINDOW w AS (PARTITION BY station ORDER BY hour)),
       g AS (SELECT *, rn - row_number() OVER (PARTITION BY station ORDER BY hour) AS k FROM z WHERE up)
       SELECT station, min(hour) AS onset, max(hour) AS "end", max(total) AS peak, count(*) AS n_hours, max(hour) = max(newest) AS is_open FROM g GROUP BY station, k""",
    num="peak",
    text='onset "end"',
)
def _(t):
    hourly = Jb.totals(readings(t), "station", "ts", "value", "1 hour").select("station", F.col("start").alias("hour"), "total")
    return Jb.events_so_far(drain_newest(hourly, "hours", ["station", "hour"]), 100.0)


@entry(
    "stream_forecast_verify",
    "SELECT l_orderkey, l_linenumber, v4.site, target, fc, fc - q AS error FROM v4 JOIN v2 ON v2.site = v4.site AND v2.d = target WHERE lead_d BETWEEN 0 AND 192",
    num="fc error",
    text="target",
)
def _(t):
    ts = lambda c: F.col(c).cast("timestamp")
    f = t.v4.select("site", "l_orderkey", "l_linenumber", ts("issued").alias("issued_ts"), ts("target").alias("target_ts"), "fc")
    o = t.v2.select("site", ts("d").alias("obs_ts"), F.col("q").alias("obs"))
    fs = file_stream(t.spark, land(f, "forecasts"), f.schema)
    os_ = file_stream(t.spark, land(o, "observed"), o.schema)
    out = drain(Jb.verify_forecasts(fs, os_, "site"), "verify")
    return out.select("l_orderkey", "l_linenumber", "site", F.col("target_ts").cast("date").alias("target"), "fc", "error")


@entry(
    "stream_carry_forward",
    """WITH x AS (SELECT point_id AS village, h AS run, CASE WHEN h % 5 <> 0 AND NOT (point_id = 2 AND h < 100) THEN mm END AS v FROM v1),
       y AS (SELECT *, last_value(v IGNORE NULLS) OVER w AS held, last_value(CASE WHEN v IS NOT NULL THEN run END IGNORE NULLS) OVER w AS since FROM x WINDOW w AS (PARTITION BY village ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
       SELECT village, run, held AS value, CASE WHEN v IS NOT NULL THEN 'live' WHEN held IS NOT NULL THEN 'carried' ELSE 'withheld' END AS status, CASE WHEN v IS NULL AND held IS NOT NULL THEN since END AS stale_since FROM y""",
    num="value",
)
def _(t):
    have = (F.col("h") % 5 != 0) & ~((F.col("point_id") == 2) & (F.col("h") < 100))
    x = t.v1.select(F.col("point_id").alias("village"), F.col("h").alias("run"), F.when(have, F.col("mm")).alias("value"))
    return drain(Jb.carry_forward(file_stream(t.spark, land(x, "estimates"), x.schema)), "carry")


@entry("stream_alert_expiry", "SELECT event_id, user_id % 8 AS station, value + event_id % 500 AS expires FROM events WHERE value + event_id % 500 > 300", num="expires")
def _(t):
    e = file_stream(t.spark, f"{t.sf_dir}/events.parquet*", t.table("events").schema)
    alerts = e.select("event_id", (F.col("user_id") % 8).alias("station"), (F.col("value") + F.col("event_id") % 500).alias("expires"))
    # an alert re-sent with another expiry does not replace the archived one
    resent = alerts.withColumn("expires", F.col("expires") + 1000)
    archive = Jb.alert_archive(alerts.unionByName(resent), "event_id", ["expires"])
    return Jb.active_alerts(archive.read(), "expires", F.lit(300.0), ["event_id"])
