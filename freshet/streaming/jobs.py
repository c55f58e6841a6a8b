"""Streaming twins of the incremental jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from freshet.operators.ordering import active_sorted
from freshet.operators.windows import runs_above
from freshet.session import fresh_path
from freshet.sources.archive import Archive
from freshet.streaming.runs import LATENESS, drain_batches


def archive_once(feed: DataFrame, keys: list[str], ts: str, lateness: str = LATENESS) -> DataFrame:
    """Rows of a rolling feed, each key once within the lateness and the first one kept.

    For an archive in which corrections count, whenever they come, run the feed itself through ``drain_newest``.
    """
    return feed.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(keys)


def totals(readings: DataFrame, key: str, ts: str, value: str, width: str = "1 day", lateness: str = LATENESS) -> DataFrame:
    """Sums per day (or hour).

    Run in append mode (``drain``) a window is emitted once, when the watermark has passed its end; in update
    mode (``drain_newest`` by key and start) it is there at once and replaced as readings come in.
    """
    w = F.window(ts, width)
    g = readings.withWatermark(ts, lateness).groupBy(w, key).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))
    return g.select(key, F.col("window.start").alias("start"), "total", "n")


def trailing_windows(readings: DataFrame, key: str, ts: str, value: str, span: str = "24 hours", every: str = "6 hours", lateness: str = LATENESS) -> DataFrame:
    """Trailing sums at fixed steps, as sliding windows named by their end; modes as for ``totals``."""
    w = F.window(ts, span, every)
    g = readings.withWatermark(ts, lateness).groupBy(w, key).agg(F.sum(value).alias("total"))
    return g.select(key, F.col("window.end").alias("at"), "total")


RUN_OUTPUT = "station long, onset timestamp, end timestamp, peak double, n_hours long"
RUN_STATE = "onset timestamp, end timestamp, peak double, n_hours long"


def run_step(rows: pd.DataFrame, run: tuple | None, threshold: float) -> tuple[pd.DataFrame, tuple | None]:
    """Runs that a batch of hourly totals (hour, total) closes, and the run that is open after it.

    ``run`` is the open run before the batch (onset, end, peak, hours). A missing total is below every threshold.
    """
    rows = rows.sort_values("hour", ignore_index=True)
    up = rows["total"] >= threshold
    # hours below so far in the batch: one number per run, 0 for what continues the open one
    below = (~up).cumsum()
    runs = rows[up].groupby(below[up]).agg(onset=("hour", "min"), end=("hour", "max"), peak=("total", "max"), n_hours=("hour", "size"))
    if run is not None:
        open_ = pd.DataFrame([run], columns=list(runs.columns), index=[0])
        runs = pd.concat([open_, runs]) if len(runs) else open_
        runs = runs.groupby(level=0).agg({"onset": "min", "end": "max", "peak": "max", "n_hours": "sum"})
    last = below.iloc[-1] if len(rows) else 0
    still = runs[runs.index == last]
    return runs[runs.index < last], tuple(still.iloc[0]) if len(still) else None


def _runs(threshold: float) -> Callable:
    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # hourly sums of one station: at most a few per batch, whatever its readings
        closed, run = run_step(pd.concat(list(chunks)), state.get if state.exists else None, threshold)
        if run is not None:
            state.update((pd.Timestamp(run[0]).to_pydatetime(), pd.Timestamp(run[1]).to_pydatetime(), float(run[2]), int(run[3])))
        elif state.exists:
            state.remove()
        yield closed.assign(station=key[0])[["station", "onset", "end", "peak", "n_hours"]]

    return step


def threshold_events(hours: DataFrame, threshold: float) -> DataFrame:
    """Runs of reported hours whose total reaches the threshold, emitted when an hour below it closes them.

    ``hours`` streams the final hourly totals of ``totals`` (station, hour, total), so the keyed
    state sees one row per station and hour however many readings there are, and the hours of
    later batches are later ones. The open run (onset, end, peak, length) is all the state.
    """
    return hours.groupBy("station").applyInPandasWithState(_runs(threshold), RUN_OUTPUT, RUN_STATE, "append", GroupStateTimeout.NoTimeout)


def events_so_far(hours: DataFrame, threshold: float) -> DataFrame:
    """Runs of the newest hourly totals, those still going on included (``is_open``: no hour below has come).

    ``hours`` is what ``drain_newest`` gives for hourly totals: one row per station and hour, open hours
    too, so a run may still grow or, after a late reading, join its neighbour.
    """
    runs = runs_above(hours, ["station"], "hour", "total", F.lit(threshold)).withColumnRenamed("n_rows", "n_hours")
    last = hours.groupBy("station").agg(F.max("hour").alias("_last"))
    return runs.join(last, "station").withColumn("is_open", F.col("end") == F.col("_last")).drop("_last")


def verify_forecasts(forecasts: DataFrame, observed: DataFrame, key: str, horizon: str = "192 days", lateness: str = LATENESS) -> DataFrame:
    """Forecasts (key, id, issued_ts, target_ts, fc) scored as their target (key, obs_ts, obs) is observed.

    Issue times lie before their targets by at most the horizon; the bound lets both sides' state expire.
    """
    f = forecasts.withWatermark("issued_ts", lateness).withColumnRenamed(key, "_k")
    o = observed.withWatermark("obs_ts", lateness)
    match = (
        (F.col("_k") == F.col(key))
        & (F.col("target_ts") == F.col("obs_ts"))
        & (F.col("obs_ts") >= F.col("issued_ts"))
        & (F.col("obs_ts") <= F.col("issued_ts") + F.expr(f"INTERVAL {horizon}"))
    )
    return f.join(o, match).drop("_k").withColumn("error", F.col("fc") - F.col("obs"))


CARRY_OUTPUT = "village long, run long, value double, status string, stale_since long"
CARRY_STATE = "value double, run long, since long"


def _carry(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    value, last, _ = state.get if state.exists else (None, None, None)
    rows = pd.concat(list(chunks)).sort_values("run", ignore_index=True)
    live = rows["value"].notna()
    # the last real value and its run at every row, those of the state before the first one
    held = rows["value"].ffill()
    source = rows["run"].where(live).astype("Int64").ffill()
    if value is not None:
        held, source = held.fillna(value), source.fillna(last)
    status = live.map({True: "live", False: "carried"}).where(held.notna(), "withheld")
    yield pd.DataFrame({"village": key[0], "run": rows["run"], "value": held, "status": status, "stale_since": source.where(status == "carried")})
    if len(rows) and pd.notna(held.iloc[-1]):
        now = int(source.iloc[-1])
        state.update((float(held.iloc[-1]), now, None if live.iloc[-1] else now))


def carry_forward(estimates: DataFrame) -> DataFrame:
    """Estimates (village, run, value or null): a missing one repeats the last real one, marked stale.

    One row per village and run arrives, so a key's batch is as long as the runs it spans.
    """
    return estimates.groupBy("village").applyInPandasWithState(_carry, CARRY_OUTPUT, CARRY_STATE, "append", GroupStateTimeout.NoTimeout)


def alert_archive(alerts: DataFrame, key: str, order: list[str], root: str | None = None, checkpoint: str | None = None, buckets: int = 64) -> Archive:
    """Merge each batch of alerts into an immutable archive (what is archived stays).

    The archive lies in buckets of the key: a batch reads those of its own keys and adds what is new, and is known by its id when
    it is repeated. Pass ``root`` and ``checkpoint`` again to go on from an earlier run.
    """
    spark = alerts.sparkSession
    root = root or fresh_path(spark, "alerts")
    archive = Archive(spark, root, alerts.schema, [key], order, F.pmod(F.xxhash64(key), F.lit(buckets)), keep="first")
    drain_batches(alerts, "alerts", lambda batch, batch_id: archive.merge(batch, f"batch-{batch_id}"), checkpoint)
    return archive


def active_alerts(archive: DataFrame, expires: str, now: Column, newest_first: list[str]) -> DataFrame:
    return active_sorted(archive, expires, now, newest_first)
