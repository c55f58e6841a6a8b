"""First come, first kept among spots that lie close to each other, settled tile by tile.

A spot is kept when no earlier kept one is close. Spots with nobody around are kept at once, by counts per
box. The others are dealt to square tiles of boxes; a task streams a tile in order and holds only the spots
kept so far and the boxes that are in doubt, both bounded by the size of the tile and not by its rows. What
depends on a spot outside its tile stays open for the next round, whose tiles are four times as wide and
shifted by half a tile, up to the widest ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.session import cut_lineage, fresh_path

#: Boxes along a tile: of the first round, and of the widest tiles (at most some million kept spots in a task).
FIRST_TILE = 64
WIDEST_TILE = 1024

_AROUND = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]


def _box(degrees: Column, tol: float) -> Column:
    # two tolerances wide, so that rounding never parts close spots by more than one box
    return F.floor(degrees / F.lit(tol * 2)).cast("long")


def _around(df: DataFrame) -> DataFrame:
    off = F.array(*[F.struct(F.lit(dy).alias("y"), F.lit(dx).alias("x")) for dy, dx in _AROUND])
    moved = df.withColumn("_o", F.explode(off))
    return moved.withColumn("_by", F.col("_by") + F.col("_o.y")).withColumn("_bx", F.col("_bx") + F.col("_o.x")).drop("_o")


def _tiles(spots: DataFrame, side: int, shift: int) -> DataFrame:
    """Every spot in its own tile (``_home``) and in those that its neighbouring boxes reach into."""

    def tile(box: str, step: int) -> Column:
        return F.floor((F.col(box) + (step + shift)) / F.lit(side)).cast("long")

    reach = F.array_distinct(F.array(*[F.struct(tile("_by", dy).alias("y"), tile("_bx", dx).alias("x")) for dy, dx in _AROUND]))
    dealt = spots.withColumn("_t", F.explode(reach)).withColumn("_ty", F.col("_t.y")).withColumn("_tx", F.col("_t.x")).drop("_t")
    return dealt.withColumn("_home", (F.col("_ty") == tile("_by", 0)) & (F.col("_tx") == tile("_bx", 0)))


def _settle(order: str, tol: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, kept, doubt = None, {}, set()
        for batch in batches:
            verdict = []
            for ty, tx, by, bx, lat, lon, home in zip(*(batch[c] for c in ("_ty", "_tx", "_by", "_bx", "lat", "lon", "_home"))):
                if here != (ty, tx):
                    here, kept, doubt = (ty, tx), {}, set()
                boxes = [(by + dy, bx + dx) for dy, dx in _AROUND]
                if any(abs(lat - y) < tol and abs(lon - x) < tol for b in boxes for y, x in kept.get(b, ())):
                    verdict.append("dropped")
                elif not home or any(b in doubt for b in boxes):
                    doubt.add((by, bx))
                    verdict.append("open")
                else:
                    kept.setdefault((by, bx), []).append((lat, lon))
                    verdict.append("kept")
            told = batch[[order, "lat", "lon", "_by", "_bx"]].assign(verdict=verdict)
            yield told[batch["_home"] & (told["verdict"] != "dropped")]

    return run


def first_come(spots: DataFrame, order: str, tol: float, first_tile: int = FIRST_TILE, widest_tile: int = WIDEST_TILE) -> DataFrame:
    """The spots (order, lat, lon) without an earlier kept one less than ``tol`` away in both degrees.

    Orders are unique. A spot without a coordinate, or with NaN or an infinite one, is close to nothing and kept.
    Spots with neighbours are read once a round: the widths grow fourfold, so a chain of close spots that
    follows the order settles in the logarithm of its length up to the widest tile, and then a widest tile
    a round. The earliest open spot is settled in every round, so the rounds end.
    """
    spark = spots.sparkSession
    real = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    for c in ("lat", "lon"):
        real = real & ~F.isnan(c) & (F.abs(F.col(c)) < F.lit(math.inf))
    boxed = spots.select(order, "lat", "lon").withColumn("_real", F.coalesce(real, F.lit(False)))
    boxed = cut_lineage(boxed.withColumn("_by", F.when(F.col("_real"), _box(F.col("lat"), tol))).withColumn("_bx", F.when(F.col("_real"), _box(F.col("lon"), tol))))
    counts = boxed.filter("_real").groupBy("_by", "_bx").agg(F.count(F.lit(1)).alias("_n"))
    crowded = _around(counts).groupBy("_by", "_bx").agg(F.sum("_n").alias("_n")).filter("_n > 1").drop("_n")
    kept = fresh_path(spark, "kept")
    alone = boxed.join(crowded, ["_by", "_bx"], "left_anti").select(order)
    alone.write.mode("append").parquet(kept)
    left = cut_lineage(boxed.join(crowded, ["_by", "_bx"], "left_semi").select(order, "lat", "lon", "_by", "_bx"))
    result = T.StructType([*left.schema.fields, T.StructField("verdict", T.StringType())])
    side, turn = first_tile, 0
    while not left.isEmpty():
        dealt = _tiles(left, side, side // 2 * (turn % 2))
        streams = dealt.repartition("_ty", "_tx").sortWithinPartitions("_ty", "_tx", order)
        told = cut_lineage(streams.mapInPandas(_settle(order, tol), result))
        now = told.filter(F.col("verdict") == "kept")
        now.select(order).write.mode("append").parquet(kept)
        # a tile keeps a bounded number of spots in a box, so this join stays in proportion to what is open
        near = _around(now.select(F.col("lat").alias("_la"), F.col("lon").alias("_lo"), "_by", "_bx"))
        close = (F.abs(F.col("lat") - F.col("_la")) < tol) & (F.abs(F.col("lon") - F.col("_lo")) < tol)
        open_ = told.filter(F.col("verdict") == "open").drop("verdict").alias("o")
        same = (F.col("o._by") == F.col("n._by")) & (F.col("o._bx") == F.col("n._bx"))
        left = cut_lineage(open_.join(near.alias("n"), same & close, "left_anti"))
        side, turn = min(side * 4, widest_tile), turn + 1
    return spark.read.schema(alone.schema).parquet(kept)
