"""Rasters as cell tables (raster, row, column, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def block_average(cells: DataFrame, keys: list[str], r: str, c: str, v: str, n: int) -> DataFrame:
    """Mean of each n x n block, nulls skipped; rows and columns that fill no block are cut off."""
    size = cells.groupBy(*keys).agg((F.max(r) + 1).alias("_h"), (F.max(c) + 1).alias("_w"))
    blocks = cells.join(size, keys).filter(
        (F.floor(F.col(r) / n) < F.floor(F.col("_h") / n)) & (F.floor(F.col(c) / n) < F.floor(F.col("_w") / n))
    )
    return blocks.groupBy(*keys, F.floor(F.col(r) / n).alias(r), F.floor(F.col(c) / n).alias(c)).agg(F.avg(v).alias(v))


def row_runs(cells: DataFrame, keys: list[str], r: str, c: str, flag: str) -> DataFrame:
    """Runs of true cells within a raster row as half-open column spans."""
    w = W.partitionBy(*keys, r).orderBy(c)
    marked = cells.filter(F.col(flag)).withColumn("_g", F.col(c) - F.row_number().over(w))
    return marked.groupBy(*keys, r, "_g").agg(F.min(c).alias("c_from"), (F.max(c) + 1).alias("c_to")).drop("_g")


def coarsened_runs(cells: DataFrame, keys: list[str], r: str, c: str, flag: str, limit: int) -> DataFrame:
    """Row runs at the finest of 1, 2, 4, 8 cells per side that has at most ``limit`` of them (else 8).

    A coarse cell is set when any of its cells is; incomplete edge blocks are cut off.
    """
    size = cells.groupBy(*keys).agg((F.max(r) + 1).alias("_h"), (F.max(c) + 1).alias("_w"))
    f = F.col("factor")
    levels = cells.join(size, keys).withColumn("factor", F.explode(F.array(*[F.lit(x).cast("bigint") for x in (1, 2, 4, 8)])))
    levels = levels.withColumn("_r", F.floor(F.col(r) / f)).withColumn("_c", F.floor(F.col(c) / f))
    levels = levels.filter((F.col("_r") < F.floor(F.col("_h") / f)) & (F.col("_c") < F.floor(F.col("_w") / f)))
    masks = levels.groupBy(*keys, "factor", F.col("_r").alias(r), F.col("_c").alias(c)).agg(F.bool_or(flag).alias(flag))
    runs = row_runs(masks, [*keys, "factor"], r, c, flag)
    fits = runs.groupBy(*keys, "factor").agg(F.count(F.lit(1)).alias("_n"))
    chosen = fits.filter((F.col("_n") <= limit) | (f == 8)).groupBy(*keys).agg(F.min("factor").alias("factor"))
    return runs.join(chosen, [*keys, "factor"], "left_semi")


def sanity_gate(cells: DataFrame, keys: list[str], v: str, water: str) -> DataFrame:
    """Reason to reject a raster, or null: too few valid cells, degenerate values, or nearly all water.

    The median test needs no gathering: with as many values at or below 10 as above it, the median
    is the mean of the largest below and the smallest above.
    """
    valid = F.coalesce(F.col(v) > 1e-12, F.lit(False))
    low, high = valid & (F.col(v) <= 10), valid & (F.col(v) > 10)
    s = cells.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.count_if(valid).alias("n_valid"),
        F.coalesce(F.stddev_pop(F.when(valid, F.col(v))), F.lit(0.0)).alias("_std"),
        F.count_if(low).alias("_low"),
        F.max(F.when(low, F.col(v))).alias("_a"),
        F.min(F.when(high, F.col(v))).alias("_b"),
        F.count_if(valid & F.col(water)).alias("n_water"),
    )
    above = (F.col("_low") * 2 < F.col("n_valid")) | ((F.col("_low") * 2 == F.col("n_valid")) & (F.col("_a") + F.col("_b") > 20))
    reason = (
        F.when(F.col("n_valid") < 0.05 * F.col("n_cells"), "no imagery")
        .when((F.col("_std") < 1e-9) | above, "degenerate")
        .when(F.col("n_water") > 0.9 * F.col("n_valid"), "implausible water share")
    )
    return s.select(*keys, "n_cells", "n_valid", "n_water", reason.alias("reason"))
