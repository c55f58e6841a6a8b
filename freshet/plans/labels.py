"""The event label store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.operators.joins import unknown_only
from freshet.operators.windows import runs_above
from freshet.sources.archive import replace_slice


def event_rows(series: DataFrame, key: str, order: str, value: str, threshold: Column, tag: str, source: str, confidence: str) -> DataFrame:
    """Threshold runs of a series as label rows; ids name the source, the key and the onset."""
    runs = runs_above(series, [key], order, value, threshold)
    eid = F.concat_ws("_", F.lit(tag), F.col(key).cast("string"), F.col("onset").cast("string"))
    return runs.select(
        eid.alias("event_id"),
        F.col(key).cast("string").alias("basin"),
        F.col("onset").cast("string").alias("onset"),
        F.col("end").cast("string").alias("end"),
        F.col("peak"),
        F.lit(source).alias("source"),
        F.lit(confidence).alias("confidence"),
    )


def build_store(known: DataFrame, modelled: DataFrame, crossings: DataFrame, observed_source: str) -> DataFrame:
    """Refresh the modelled slice, keep archived crossings and append those not yet known."""
    fresh = unknown_only(crossings, known, ["event_id"])
    kept = replace_slice(known, modelled, F.col("source") == observed_source, "event_id", ["onset", "end", "peak"])
    return kept.unionByName(fresh)
