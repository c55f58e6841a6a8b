"""Windows over unbounded keys, split by time.

Raw readings have no bound per station, so a window over the whole station would pull it into one
task. Here each (key, time chunk) is a window of its own, and what a chunk needs from before it is
carried over in a table with one row per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"
DAY_SECONDS = 86_400


def seconds_of(ts: str) -> Column:
    """Whole seconds since 1970 of a time column without zone (floor, also before 1970)."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'{EPOCH}', date_trunc('SECOND', `{ts}`)::timestamp_ntz)")


def hours_of(ts: str, origin: str) -> Column:
    return F.expr(f"timestampdiff(HOUR, TIMESTAMP_NTZ'{origin}', `{ts}`)")


def chunk_of(ts: str, seconds: int) -> Column:
    return F.floor(seconds_of(ts) / seconds).cast("bigint")


def chunk_width(df: DataFrame, ts: str, rows_per_chunk: int = 1_000_000) -> int:
    """Seconds per chunk such that even one key holding every row stays near ``rows_per_chunk``.

    One pass that only counts (min, max and count, no shuffle of rows).
    """
    lo, hi, n = df.agg(F.min(seconds_of(ts)), F.max(seconds_of(ts)), F.count(F.lit(1))).first()
    if not n:
        return DAY_SECONDS
    return int(max(1, min(DAY_SECONDS, (hi - lo + 1) * rows_per_chunk // n)))


def carry_last(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    chunk: str,
    out: str,
    inclusive: bool = False,
) -> DataFrame:
    """The last non-null ``value`` before each row (or at it, if ``inclusive``) within its key."""
    start = W.unboundedPreceding
    here = W.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(start, 0 if inclusive else -1)
    tails = df.groupBy(*keys, chunk).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_tail")
    )
    before = W.partitionBy(*keys).orderBy(chunk).rowsBetween(start, -1)
    carried = tails.select(*keys, chunk, F.last("_tail", ignorenulls=True).over(before).alias("_carried"))
    within = df.withColumn("_within", F.last(value, ignorenulls=True).over(here))
    return (
        within.join(carried, [*keys, chunk], "left")
        .withColumn(out, F.coalesce("_within", "_carried"))
        .drop("_within", "_carried")
    )


def previous_reading(
    df: DataFrame, key: str, ts: str, tie: str, value: str, out: str = "previous", width: int = DAY_SECONDS
) -> DataFrame:
    """Lag by one reading over irregular readings of any length."""
    d = df.withColumn("_chunk", chunk_of(ts, width))
    return carry_last(d, [key], [ts, tie], value, "_chunk", out).drop("_chunk")
