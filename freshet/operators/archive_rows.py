"""One row per key. All of it is aggregation, so a hot key is combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], by: Column, agg) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(agg(F.struct(*rest), by).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def newest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _pick(df, keys, F.struct(*order), F.max_by)


def oldest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _pick(df, keys, F.struct(*order), F.min_by)


def highest(df: DataFrame, keys: list[str], value: str, ties: list[str]) -> DataFrame:
    """Row with the largest value; the first by ``ties`` among equals."""
    return _pick(df.filter(F.col(value).isNotNull()), keys, F.struct((-F.col(value)).alias("_v"), *ties), F.min_by)


def first_distinct(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Duplicates of a key dropped, first occurrence by ``order`` kept."""
    return oldest(df, keys, order)
