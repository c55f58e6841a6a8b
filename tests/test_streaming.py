"""Jobs resumed over several batches give what one batch over everything gives."""

import datetime as dt
import random

import pandas as pd
from conftest import rows
from pyspark.sql import functions as F

from freshet.session import fresh_path
from freshet.streaming import jobs as Jb
from freshet.streaming.runs import drain, drain_newest, file_stream

T0 = dt.datetime(2024, 1, 1)


def test_dedupe_over_overlapping_polls(spark, table):
    inbox, sink, check = (fresh_path(spark, n) for n in ("inbox", "sink", "check"))
    schema = "i int, ts timestamp, v double"
    every = [(i, T0 + dt.timedelta(hours=i), float(i)) for i in range(300)]
    for lo, hi in ((0, 120), (80, 200), (170, 300)):
        table(schema, every[lo:hi]).coalesce(1).write.mode("append").parquet(inbox)
        feed = file_stream(spark, inbox, table(schema, []).schema)
        out = drain(Jb.archive_once(feed, ["i"], "ts"), "dedupe", sink, check)
    assert rows(out.select("i")) == [(i,) for i in range(300)]


def test_runs_stay_open_between_batches(spark, table):
    inbox, sink, check = (fresh_path(spark, n) for n in ("inbox", "sink", "check"))
    schema = "station bigint, hour timestamp, total double"
    vals = [1, 9, 9, 8, 9, 1, 7, 7]
    data = [(1, T0 + dt.timedelta(hours=h), float(v)) for h, v in enumerate(vals)] + [(2, T0, 9.0)]
    for part in (data[:3], data[3:5] + data[8:], data[5:8]):
        table(schema, part).coalesce(1).write.mode("append").parquet(inbox)
        out = drain(Jb.threshold_events(file_stream(spark, inbox, table(schema, []).schema), 7.0), "runs", sink, check)
    got = rows(out)
    # the run from hour 6 and station 2's are still open
    assert got == [(1, T0 + dt.timedelta(hours=1), T0 + dt.timedelta(hours=4), 9.0, 4)]


def test_runs_are_the_same_however_the_hours_are_cut():
    rng = random.Random(3)
    for _ in range(60):
        totals = [rng.choice([1.0, 7.0, 8.0, 9.0, None]) for _ in range(rng.randrange(1, 14))]
        hours = pd.DataFrame({"hour": [T0 + dt.timedelta(hours=h) for h in range(len(totals))], "total": pd.Series(totals, dtype="float64")})
        want, now = [], None
        for h, v in zip(hours["hour"], totals):
            if v is not None and v >= 7.0:
                now = (h, h, v, 1) if now is None else (now[0], h, max(now[2], v), now[3] + 1)
            elif now is not None:
                want, now = [*want, now], None
        cuts = sorted(rng.choices(range(len(totals) + 1), k=rng.randrange(3)))
        got, run = [], None
        for a, b in zip([0, *cuts], [*cuts, len(totals)]):
            closed, run = Jb.run_step(hours[a:b].sample(frac=1, random_state=1), run, 7.0)
            got += list(closed.itertuples(index=False, name=None))
        assert (got, run) == (want, now)


def test_carry_remembers_since_when(spark, table):
    inbox, sink, check = (fresh_path(spark, n) for n in ("inbox", "sink", "check"))
    schema = "village bigint, run bigint, value double"
    for part in ([(1, 0, None), (1, 1, 5.0)], [(1, 2, None)], [(1, 3, None), (1, 4, 6.0)]):
        table(schema, part).coalesce(1).write.mode("append").parquet(inbox)
        out = drain(Jb.carry_forward(file_stream(spark, inbox, table(schema, []).schema)), "carry", sink, check)
    assert rows(out, "run") == [(1, 0, None, "withheld", None), (1, 1, 5.0, "live", None), (1, 2, 5.0, "carried", 1), (1, 3, 5.0, "carried", 1), (1, 4, 6.0, "live", None)]


def test_alerts_keep_their_first_version_over_batches(spark, table):
    inbox = fresh_path(spark, "inbox")
    schema = "id int, expires double"
    for part in ([(1, 5.0), (2, 9.0)], [(1, 99.0), (3, 7.0)]):
        table(schema, part).coalesce(1).write.mode("append").parquet(inbox)
    stream = file_stream(spark, inbox, table(schema, []).schema, files_per_batch=1)
    kept = Jb.alert_archive(stream, "id", ["expires"])
    archive = kept.read()
    # each batch is one merge
    assert kept.version() == 2
    assert rows(archive) == [(1, 5.0), (2, 9.0), (3, 7.0)]
    assert [r["id"] for r in Jb.active_alerts(archive, "expires", F.lit(6.0), ["id"]).collect()] == [3, 2]


def test_days_inside_the_watermark_are_held_back(spark, table):
    inbox = fresh_path(spark, "inbox")
    schema = "s int, ts timestamp, v double"
    data = [(1, T0 + dt.timedelta(hours=h), 1.0) for h in range(24 * 5)]
    table(schema, data).write.parquet(inbox)
    out = drain(Jb.totals(file_stream(spark, inbox, table(schema, []).schema), "s", "ts", "v"), "daily")
    assert rows(out.select("total", "start")) == [(24.0, T0), (24.0, T0 + dt.timedelta(days=1))]


def test_archive_takes_corrections_however_late(spark, table):
    inbox, sink, check = (fresh_path(spark, n) for n in ("inbox", "sink", "check"))
    schema = "i int, ts timestamp, v double, version int"
    old, new = T0, T0 + dt.timedelta(days=30)
    for part in ([(1, old, 1.0, 1), (2, old, 2.0, 1)], [(3, new, 3.0, 1), (2, old, 2.5, 2), (2, old, 2.2, 1)], [(1, old, 1.5, 2)]):
        table(schema, part).coalesce(1).write.mode("append").parquet(inbox)
        out = drain_newest(file_stream(spark, inbox, table(schema, []).schema), "archive", ["i"], ["version"], sink, check)
    assert rows(out.select("i", "v")) == [(1, 1.5), (2, 2.5), (3, 3.0)]


def test_open_windows_are_published_and_replaced(spark, table):
    inbox, sink, check = (fresh_path(spark, n) for n in ("inbox", "sink", "check"))
    schema = "station int, ts timestamp, v double"
    at = lambda h: T0 + dt.timedelta(hours=h)
    seen = []
    # the second batch brings a late reading for hour 1 and goes on with hour 2; the third ends the run
    for part in ([(1, at(0), 8.0), (1, at(1), 4.0)], [(1, at(1), 5.0), (1, at(2), 7.0)], [(1, at(3), 1.0)]):
        table(schema, part).coalesce(1).write.mode("append").parquet(inbox)
        hourly = Jb.totals(file_stream(spark, inbox, table(schema, []).schema), "station", "ts", "v", "1 hour").select("station", F.col("start").alias("hour"), "total")
        hours = drain_newest(hourly, "hours", ["station", "hour"], sink=sink, checkpoint=check)
        seen.append(rows(Jb.events_so_far(hours, 7.0).select("station", "onset", "end", "peak", "n_hours", "is_open")))
    assert seen == [[(1, at(0), at(0), 8.0, 1, False)], [(1, at(0), at(2), 9.0, 3, True)], [(1, at(0), at(2), 9.0, 3, False)]]
    assert rows(hours.select("total")) == [(1.0,), (7.0,), (8.0,), (9.0,)]


def test_nothing_has_arrived(spark, table):
    empty = table("i int, ts timestamp, v double", [])
    inbox = fresh_path(spark, "inbox")
    empty.write.parquet(inbox)
    assert rows(drain_newest(file_stream(spark, inbox, empty.schema), "none", ["i"])) == []
