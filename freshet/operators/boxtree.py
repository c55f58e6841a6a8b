"""Nearest points by a tree of boxes, for places that lie far from all points.

Points are laid out along a space-filling curve and numbered; runs of numbers are the nodes of the tree, each
with the box that holds its points. Places go down from the few boxes at the top: a box is left out if even
its nearest corner or side is farther than the k-th point can be, which follows from the farthest corners of
the boxes at hand. Every step is an equality join on the node, so no places are paired with all points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from freshet.session import cut_lineage

#: Points of a leaf, and boxes under a box.
LEAF, FAN = 128, 32
#: What counts as equal in chords of the unit sphere and in degrees: over a millimetre, over a millionth.
SPHERE_SLACK, PLANE_SLACK = 4e-10, 2e-6
_AXES = ("x", "y", "z")


def coordinates(lat: str, lon: str, planar: bool) -> list[Column]:
    """A point in space: on the unit sphere, or on the plane of degrees."""
    if planar:
        return [F.col(lat), F.col(lon), F.lit(0.0)]
    a, b = F.radians(lat), F.radians(lon)
    return [F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a)]


def curve(lat: str, lon: str, bits: int = 16) -> Column:
    """Place on a space-filling curve: the bits of both coordinates in turns."""
    steps = float(1 << bits)
    y = F.least(F.floor((F.col(lat) + 90) / 180 * steps), F.lit(int(steps) - 1)).cast("long")
    x = F.least(F.floor(F.pmod(F.col(lon) + 180, F.lit(360.0)) / 360 * steps), F.lit(int(steps) - 1)).cast("long")
    out = F.lit(0).cast("long")
    for i in range(bits):
        for c, at in ((y, 2 * i + 1), (x, 2 * i)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(c, i).bitwiseAND(F.lit(1)), at))
    return out


def numbered(points: DataFrame, keys: list[str], lat: str, lon: str) -> DataFrame:
    """Points with ``_at``, their place 0, 1, 2 ... along the curve among the points of their keys."""
    laid = points.withColumn("_z", curve(lat, lon)).repartitionByRange(*keys, "_z", lat, lon)
    # the number of a range is written with its rows, so both reads below agree on it
    laid = cut_lineage(laid.withColumn("_range", F.spark_partition_id()))
    every = W.partitionBy(*keys, "_range")
    counts = laid.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    # without keys this window runs over one row per range
    before = F.sum("_n").over(W.partitionBy(*keys, F.lit(0)).orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    carried = counts.select(*keys, "_range", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(every.orderBy("_z", lat, lon)) - 1
    return laid.withColumn("_in", inside).join(carried, [*keys, "_range"]).withColumn("_at", F.col("_before") + F.col("_in")).drop("_z", "_range", "_in", "_before")


def _bounds(place: str) -> tuple[Column, Column]:
    """Squares of the least and greatest distance from a point in space to a box."""
    near = far = F.lit(0.0)
    for c in _AXES:
        p, lo, hi = F.col(f"{place}.{c}"), F.col(f"_lo.{c}"), F.col(f"_hi.{c}")
        near = near + F.pow(F.greatest(lo - p, p - hi, F.lit(0.0)), 2)
        far = far + F.pow(F.greatest(F.abs(lo - p), F.abs(hi - p)), 2)
    return near, far


def nearest_by_boxes(
    places: DataFrame, points: DataFrame, pid: str, k: int, keys: list[str], at: tuple[str, str], to: tuple[str, str], gap: Column, planar: bool, leaf: int = LEAF, fan: int = FAN
) -> DataFrame:
    """(keys, place, pid, km) candidates that hold the k nearest points of each distinct place, and those that tie with them.

    Places whose keys have fewer than k points get all of them; those whose keys have none are absent.
    """
    place = [*keys, *at]
    own = points.where(F.col(to[0]).isNotNull() & F.col(to[1]).isNotNull())
    stock = cut_lineage(numbered(own, keys, *to).withColumn("_node", F.floor(F.col("_at") / leaf)).drop("_at"))
    space = F.struct(*[c.alias(n) for n, c in zip(_AXES, coordinates(*to, planar), strict=True)])
    corner = lambda agg, c: F.struct(*[agg(f"{c}.{n}").alias(n) for n in _AXES])
    boxes = stock.withColumn("_p", space).groupBy(*keys, "_node").agg(corner(F.min, "_p").alias("_lo"), corner(F.max, "_p").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    levels = [cut_lineage(boxes.withColumn("_up", F.floor(F.col("_node") / fan)))]
    while not levels[-1].where(F.col("_node") >= fan).isEmpty():
        up = levels[-1].groupBy(*keys, F.col("_up").alias("_node")).agg(corner(F.min, "_lo").alias("_lo"), corner(F.max, "_hi").alias("_hi"), F.sum("_n").alias("_n"))
        levels.append(cut_lineage(up.withColumn("_up", F.floor(F.col("_node") / fan))))
    # at the top every key has at most ``fan`` boxes: they travel as one array
    top = levels[-1].groupBy(*keys).agg(F.collect_list(F.struct("_node", "_lo", "_hi", "_n")).alias("_top"))
    here = F.struct(*[c.alias(n) for n, c in zip(_AXES, coordinates(*at, planar), strict=True)])
    asked = places.select(*place, here.alias("_here"))
    asked = asked.join(top, keys) if keys else asked.withColumn("_top", top.select("_top").scalar())
    front = asked.select(*place, "_here", F.inline("_top"))
    slack = F.lit(PLANE_SLACK if planar else SPHERE_SLACK)
    w = W.partitionBy(*place)
    for depth in range(len(levels) - 1, -1, -1):
        near, far = _bounds("_here")
        counted = front.withColumns({"_near": near, "_far": far}).withColumn("_so_far", F.sum("_n").over(w.orderBy("_far", "_node").rowsBetween(W.unboundedPreceding, W.currentRow)))
        reach = F.min(F.when(F.col("_so_far") >= k, F.col("_far"))).over(w)
        kept = counted.withColumn("_reach", reach).where(F.col("_reach").isNull() | (F.col("_near") <= F.pow(F.sqrt("_reach") + slack, 2)))
        kept = kept.select(*place, "_here", "_node")
        if depth:
            below = levels[depth - 1].withColumnRenamed("_node", "_below").withColumnRenamed("_up", "_node")
            front = cut_lineage(kept).join(below, [*keys, "_node"]).drop("_node").withColumnRenamed("_below", "_node")
    return kept.join(stock, [*keys, "_node"]).select(*place, pid, gap.alias("km"))
