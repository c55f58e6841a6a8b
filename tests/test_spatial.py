import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from freshet.functions import geometry as G
from freshet.operators import boxtree as BT
from freshet.operators import closecells
from freshet.operators import raster as X
from freshet.operators import spatial as P
from freshet.operators.closecells import first_come
from freshet.session import cut_lineage


def km(a, b, c, d):
    s = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(s))


def brute(left, right, k, box=None):
    out = {}
    for lat, lon in set(left):
        near = sorted((math.floor(km(lat, lon, y, x) * 1e6), i) for i, y, x in right if box is None or (abs(y - lat) <= box and abs(x - lon) <= box))
        if near:
            out[(lat, lon)] = [i for _, i in near[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["nth"]):
        out.setdefault((r["lat"], r["lon"]), []).append(r["pid"])
    return out


@pytest.mark.parametrize("seed,k", [(1, 1), (2, 3)])
def test_nearest_is_exact_for_clusters_outliers_and_the_date_line(table, seed, k):
    rng = random.Random(seed)
    right = [(i, 10 + rng.gauss(0, 0.02), 20 + rng.gauss(0, 0.02)) for i in range(150)]
    right += [(200 + i, rng.uniform(-60, 60), rng.uniform(-180, 180)) for i in range(25)]
    right += [(300, 5.0, 179.9), (301, 5.0, -179.9), (302, 5.0, -179.9)]
    left = [(10 + rng.gauss(0, 0.05), 20 + rng.gauss(0, 0.05)) for _ in range(40)]
    left += [(rng.uniform(-60, 60), rng.uniform(-180, 180)) for _ in range(40)] + [(5.0, 179.95), (5.0, -179.99), (85.0, 3.0)]
    got = found(P.nearest_k(table("lat double, lon double", left * 2), table("pid int, plat double, plon double", right), "pid", k))
    assert got == brute(left, right, k)


def test_fewer_points_than_asked(table):
    left, right = [(0.0, 0.0), (50.0, 100.0)], [(7, 1.0, 1.0)]
    got = found(P.nearest_k(table("lat double, lon double", left), table("pid int, plat double, plon double", right), "pid", 2))
    assert got == {(0.0, 0.0): [7], (50.0, 100.0): [7]}


@pytest.mark.parametrize(("leaf", "fan", "planar"), [(1, 2, False), (4, 3, False), (4, 3, True), (128, 32, True)])
def test_boxes_hold_the_nearest_of_far_places(spark, table, monkeypatch, leaf, fan, planar):
    rng = random.Random(leaf)
    spots = [(rng.choice([10, -40, 70]) + rng.gauss(0, 3), rng.choice([20, 179, -120]) + rng.gauss(0, 3)) for _ in range(150)]
    spots += [(5.0, 5.0)] * 4 + [(89.9, 0.0), (-89.9, 100.0)]
    right = [(("hot", "b", "few")[0 if i % 4 else 1 + (i % 8 == 0)], i, y, (x + 180) % 360 - 180) for i, (y, x) in enumerate(spots)]
    right = [r for r in right if r[0] != "few" or r[1] < 20] + [("b", 900, None, 1.0)]
    left = [(t, rng.uniform(-89, 89), rng.uniform(-180, 180)) for t in ("hot", "hot", "b", "few", "none") for _ in range(12)] + [("hot", 5.0, 5.0), ("b", 90.0, 0.0), ("b", 0.0, -180.0)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    a, b = F.col("lat"), F.col("plat")
    gap = F.sqrt(F.pow(a - b, 2) + F.pow(F.col("lon") - F.col("plon"), 2)) if planar else G.haversine_km(a, F.col("lon"), b, F.col("plon"))
    far = (lambda y, x, v, u: math.hypot(y - v, x - u)) if planar else km
    for keys in (["t"], []):
        lt = table("t string, lat double, lon double", left).select(*keys, "lat", "lon").distinct()
        rt = table("t string, pid int, plat double, plon double", right).select(*keys, "pid", "plat", "plon")
        near = BT.nearest_by_boxes(lt, rt, "pid", 3, keys, ("lat", "lon"), ("plat", "plon"), gap, planar, leaf, fan)
        got = {}
        for r in near.collect():
            got.setdefault((r["t"] if keys else None, r["lat"], r["lon"]), []).append((math.floor(r["km"] * 1e6), r["pid"]))
        for t, y, x in left:
            own = sorted((math.floor(far(y, x, v, u) * 1e6), i) for s, i, v, u in right if v is not None and (s == t or not keys))[:3]
            have = sorted(got.get((t if keys else None, y, x), []))[:3]
            assert [i for _, i in have] == [i for _, i in own] or [d for d, _ in have] == pytest.approx([d for d, _ in own], abs=2)
        if leaf < 128 and keys:
            # most points are never looked at
            assert sum(map(len, got.values())) < 0.7 * sum(sum(s == t and v is not None for s, _, v, _ in right) for t, _, _ in left)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_box_leaves_far_places_out(table):
    rng = random.Random(9)
    right = [(i, rng.uniform(0, 2), rng.uniform(0, 2)) for i in range(40)]
    left = [(rng.uniform(0, 4), rng.uniform(0, 4)) for _ in range(40)]
    got = found(P.nearest_k(table("lat double, lon double", left), table("pid int, plat double, plon double", right), "pid", 1, box=0.6))
    assert got == brute(left, right, 1, 0.6)
    assert len(got) < len(left)


def test_weights_of_a_place_on_a_point(table):
    v = table("id int, lat double, lon double", [(1, 0.0, 0.0)])
    near = table("lat double, lon double, pid int, km double, nth int", [(0.0, 0.0, 1, 0.2, 1), (0.0, 0.0, 2, 3.0, 2)])
    sig = table("pid int, s double", [(1, 8.0), (2, 4.0)])
    # a distance under a kilometre counts as one
    assert rows(P.idw(v, "id", near, sig, "pid", ["s"])) == [(1, pytest.approx((8 + 4 / 3) / (4 / 3)))]


def ring(*pts):
    return G.ring_edges(F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in pts]))


def test_holes_parts_and_boxes(table):
    square = ring((0, 0), (4, 0), (4, 4), (0, 4))
    hole = ring((1, 1), (2, 1), (2, 2), (1, 2))
    island = ring((6, 0), (7, 0), (7, 1), (6, 1))
    none = F.array().cast("array<array<struct<x1:double,y1:double,x2:double,y2:double>>>")
    parts = F.array(F.struct(square.alias("outer"), F.array(hole).alias("holes")), F.struct(island.alias("outer"), none.alias("holes")))
    poly = table("poly int, south double, west double, north double, east double", [(1, 0.0, 0.0, 4.0, 8.0)]).withColumn("parts", parts)
    pts = table("id int, lat double, lon double", [(1, 3.0, 3.0), (2, 1.5, 1.5), (3, 0.5, 6.5), (4, 3.0, 6.5), (5, 9.0, 9.0), (6, 0.0, 2.0), (7, 4.0, 2.0)])
    got = {r["id"]: r["in_water"] for r in P.inside_polygons(pts, poly, "id", "poly").collect()}
    # the lower edge belongs to the square, the upper one does not (half-open crossing rule)
    assert got == {1: True, 2: False, 3: True, 4: False, 6: True, 7: False}


def test_rings_of_many_edges(spark, table):
    rng = random.Random(6)

    def star(cx, cy, n, r):
        out = [(cx + r * rng.uniform(0.3, 1) * math.cos(2 * math.pi * i / n), cy + r * rng.uniform(0.3, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]
        return [(round(x, 2), round(y, 2)) for x, y in out]

    def edges(ring):
        return [(*a, *b) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]

    tall = [(20 + (i % 2) * 0.5 + i / 100, -5.0 + 10.0 * (i % 2)) for i in range(101)]
    polys = [(1, [(star(0, 0, 300, 4), [star(0.5, 0.5, 40, 0.5), star(-1, 0, 30, 0.4)]), (star(9, 0, 50, 2), [])]), (2, [(tall, [])]), (3, [(star(1, 1, 3, 5), [])])]
    rows_ = []
    for i, parts in polys:
        xy = [p for o, _ in parts for p in o]
        rows_.append((i, min(y for _, y in xy), min(x for x, _ in xy), max(y for _, y in xy), max(x for x, _ in xy), [(edges(o), [edges(h) for h in hs]) for o, hs in parts]))
    edge = "array<struct<x1:double,y1:double,x2:double,y2:double>>"
    df = table(f"poly int, south double, west double, north double, east double, parts array<struct<outer:{edge},holes:array<{edge}>>>", rows_)
    pts = [(i, round(rng.uniform(-6, 6), 2), round(rng.uniform(-6, 25), 2)) for i in range(700)]
    pts += [(1000 + i, y, x) for i, (x, y) in enumerate(p for _, parts in polys for o, _ in parts for p in o[:20])] + [(2000, *pts[0][1:])]

    def inside(x, y, ring):
        return sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for x1, y1, x2, y2 in edges(ring)) % 2 == 1

    want = {}
    for (i, parts), (_, south, west, north, east, _) in zip(polys, rows_, strict=True):
        for p, y, x in pts:
            if south <= y <= north and west <= x <= east:
                want[p, i] = any(inside(x, y, o) and not any(inside(x, y, h) for h in hs) for o, hs in parts)
    got = {(r.id, r.poly): r.in_water for r in P.inside_polygons(table("id int, lat double, lon double", pts), df, "id", "poly").collect()}
    assert got == want and set(want.values()) == {True, False}
    laid, _ = P.banded_edges(df, "poly")
    for i, parts in polys:
        assert laid.where(F.col("poly") == i).count() <= 5 * sum(len(o) + sum(map(len, hs)) for o, hs in parts)


def test_collision_keeps_the_first(table):
    df = table("id int, lat double, lon double, flat double, flon double", [(2, 1.0, 1.0, 9.0, 9.0), (1, 1.000001, 1.0, 8.0, 8.0), (3, 2.0, 1.0, 7.0, 7.0)])
    got = {r["id"]: (r["lat"], r["precision"]) for r in P.collision_guard(df, "id").collect()}
    assert got == {1: (1.000001, "matched"), 2: (9.0, "approximate"), 3: (2.0, "matched")}


def test_chains_of_close_cells_follow_the_greedy_order(table):
    # 1 keeps, 2 is near 1, 3 is near 2 only and so stays, 4 duplicates 3, 5 is implausible
    c = [(1, 0.0), (2, 0.0008), (3, 0.0016), (4, 0.0016), (5, 0.5), (6, 0.5)]
    df = table(
        "i int, lat double, lon double, mean double, qmin double, qmax double",
        [(i, y, 5.0, 1.0 if i == 5 else 10.0, 5.0, None if i % 2 else 20.0) for i, y in c],
    )
    assert rows(P.distinct_cells(df, "i").select("i")) == [(1,), (3,), (6,)]


def greedy(spots, tol):
    kept = []
    for i, y, x in sorted(spots):
        if not any(abs(y - b) < tol and abs(x - c) < tol for _, b, c in kept):
            kept.append((i, y, x))
    return sorted((i,) for i, _, _ in kept)


@pytest.mark.parametrize("tiles", [(4, 4), (2, 16), (64, 1024)])
def test_close_spots_are_kept_first_come(table, tiles):
    rng = random.Random(7)
    # a crowd, a chain in order, one against it, one back and forth over tile borders, and lone spots
    spots = [(rng.uniform(-0.006, 0.006), rng.uniform(-0.006, 0.006)) for _ in range(400)]
    chain = [(1.0, 0.0008 * j) for j in range(40)]
    zigzag = [(2.0 + 0.0007 * (j % 2), 0.0005 * j) for j in range(40)]
    spots += chain + [(3.0, x) for _, x in reversed(chain)] + zigzag + [(float(10 + j), 5.0) for j in range(5)]
    spots = [(i, y, x) for i, (y, x) in enumerate(spots)]
    got = first_come(table("i int, lat double, lon double", spots), "i", 0.001, *tiles)
    assert rows(got) == greedy(spots, 0.001)


def test_a_long_chain_needs_few_rounds(table, monkeypatch):
    written = []
    monkeypatch.setattr(closecells, "cut_lineage", lambda df: (written.append(1), cut_lineage(df))[1])
    spots = [(i, 1.0, 0.0008 * i) for i in range(2000)]
    assert rows(first_come(table("i int, lat double, lon double", spots), "i", 0.001)) == [(i,) for i in range(0, 2000, 2)]
    # two tables before the rounds and two a round: tiles of 64, 256 and 1024 boxes
    assert len(written) <= 2 + 2 * 3


def test_spots_without_a_place_are_kept(table):
    nan, inf = float("nan"), float("inf")
    spots = [(1, None, 1.0), (2, None, 1.0), (3, nan, 1.0), (4, nan, 1.0), (5, inf, 1.0), (6, 1.0, 1.0), (7, 1.0, 1.0005)]
    assert rows(first_come(table("i int, lat double, lon double", spots), "i", 0.001)) == [(1,), (2,), (3,), (4,), (5,), (6,)]
    assert rows(first_come(table("i int, lat double, lon double", []), "i", 0.001)) == []


def test_places_take_the_first_tier_and_the_first_alias(table):
    places = table(
        "id int, d int, name string, lat double, lon double",
        [(1, 1, "ford", 0.0, 0.0), (2, 1, "mill", 0.0, 0.0), (3, 1, "old", 0.0, 0.0), (4, 2, "ford", 5.0, 5.0), (5, 1, "hill", 0.0, 0.0)],
    )
    gaz = table(
        "gid int, d int, name string, plat double, plon double",
        [(10, 1, "ford", 3.0, 0.0), (11, 1, "ford", 1.0, 0.0), (12, 1, "mill race", 0.1, 0.0), (13, 1, "elder", 9.0, 0.0), (14, 1, "aged", 0.1, 0.0), (15, 1, "hilltop", 0.0, 0.0), (16, 1, "ford road", 0.0, 0.0)],
    )
    alias = table("name string, alias string, tier int", [("old", "missing", 1), ("old", "elder", 2), ("old", "aged", 3)])
    got = {r["id"]: (r["gid"], r["precision"]) for r in P.match_places(places, gaz, alias, "name", "d", "gid").collect()}
    assert got == {1: (11, "matched"), 2: (12, "matched"), 3: (13, "matched"), 4: (None, "approximate"), 5: (None, "approximate")}


def test_clip_stays_inside_a_tilted_footprint(table):
    tilted = ring((0.0, 0.0), (1.0, 0.3), (0.7, 1.3), (-0.3, 1.0))
    ev = table("event int, south double, north double, west double, east double", [(1, 0.35, 0.95, -0.2, 0.9), (2, 8.0, 9.0, 8.0, 9.0)])
    got = P.clip_to_footprint(ev.withColumn("edges", tilted), "event").collect()
    assert [r["event"] for r in got] == [1]
    r = got[0]
    assert -0.2 <= r["west"] < r["east"] <= 0.9 and 0.35 <= r["south"] < r["north"] <= 0.95


def test_best_cell_prefers_the_band_then_the_largest(table):
    st = table("s int, lat double, lon double, qmin double, qmax double", [(1, 0.0, 0.0, 5.0, 9.0), (2, 0.0, 0.0, 50.0, None), (3, 0.0, 0.0, 1.0, None)])
    cells = table("s int, clat double, clon double, mean double", [(1, 1.0, 0.0, 6.0), (1, 2.0, 0.0, 7.0), (1, 0.1, 0.0, 99.0), (2, 1.0, 0.0, 6.0), (2, 2.0, 0.0, 7.0), (2, 3.0, 0.0, None)])
    got = {r["s"]: (r["clat"], r["how"]) for r in P.best_cell_in_band(st, cells, "s").collect()}
    assert got == {1: (1.0, "in band"), 2: (2.0, "largest"), 3: (0.0, "anchor")}


def grid(table, values):
    return table("i int, r int, c int, v double", [(1, r, c, None if v is None else float(v)) for r, line in enumerate(values) for c, v in enumerate(line)])


def test_runs_and_coarsening(table):
    g = grid(table, [[1, 1, 0, 1, 1], [0, 0, 0, 0, 0], [1, 0, 1, 0, 1]]).withColumn("w", F.col("v") > 0)
    assert rows(X.row_runs(g, ["i"], "r", "c", "w")) == [(1, 0, 0, 2), (1, 0, 3, 5), (1, 2, 0, 1), (1, 2, 2, 3), (1, 2, 4, 5)]
    # 3 x 5 at factor 2 keeps one row of two blocks, both set: one run
    assert rows(X.coarsened_runs(g, ["i"], "r", "c", "w", 4).select("factor", "r", "c_from", "c_to")) == [(2, 0, 0, 2)]


def test_median_of_an_even_raster_decides_by_its_middle_pair(table):
    def reason(vals):
        g = grid(table, [vals]).withColumn("w", F.lit(False))
        return X.sanity_gate(g, ["i"], "v", "w").collect()[0]["reason"]

    assert reason([1.0, 9.0, 12.0, 50.0]) == "degenerate"  # median 10.5
    assert reason([1.0, 8.0, 12.0, 50.0]) is None  # median exactly 10
    assert reason([1.0, 9.0, 10.0]) is None
    assert reason([3.0, 3.0, 3.0, None]) == "degenerate"
    assert reason([None] * 24 + [1.0]) == "no imagery"


def test_block_average_skips_nulls_and_cuts_edges(table):
    g = grid(table, [[1.0, None, 5.0], [3.0, None, 5.0], [9.0, 9.0, 9.0]])
    assert rows(X.block_average(g, ["i"], "r", "c", "v", 2)) == [(1, 0, 0, 2.0)]
