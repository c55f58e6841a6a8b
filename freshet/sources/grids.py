"""Grids held as array columns, to rows and to points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions import geometry as G


def grid_rows(
    df: DataFrame, keys: list[str], grid: str, lat0: float, lon0: float, step: float, box: tuple[float, float, float, float], fill: float = 0.0
) -> DataFrame:
    """2-D arrays to (keys, lat, lon, v) inside (south, west, north, east); values under ``fill`` are missing."""
    r = df.select(*keys, F.posexplode(grid).alias("_r", "_row"))
    r = r.withColumn("lat", F.lit(lat0) + F.col("_r") * step).filter(F.col("lat").between(box[0], box[2]))
    c = r.select(*keys, "lat", F.posexplode("_row").alias("_c", "v"))
    c = c.withColumn("lon", F.lit(lon0) + F.col("_c") * step).filter(F.col("lon").between(box[1], box[3]))
    return c.filter((F.col("v") >= fill) & ~F.isnan("v")).select(*keys, "lat", "lon", "v")


def sample_at_points(points: DataFrame, cells: DataFrame, step: float = 0.1, fill: float = 29999.0, scale: float = 2.4) -> DataFrame:
    """Value of a global raster (cells: row from the north pole, col from 180 W, raw) at each point.

    The cell of a point is computed, so this is an equi-join on (row, col).
    """
    keyed = points.withColumn("row", F.bround((F.lit(90.0) - F.col("lat")) / step).cast("bigint")).withColumn(
        "col", F.bround((F.col("lon") + 180) / step).cast("bigint")
    )
    return keyed.join(cells, ["row", "col"], "left").withColumn("mm", G.satellite_mm(F.col("raw"), fill, scale)).drop("raw")
