import datetime as dt
import unicodedata

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freshet.functions import geometry as G
from freshet.functions import scalars as S


def one(df, c):
    return df.select(c.alias("x")).collect()[0][0]


def test_station_times(table):
    df = table("s string", [("2024-07-01 05:30:00",), ("2024-07-01 05:30",), (" 01/07/24 05:30 ",), ("soon",), (None,), ("2024-13-01 00:00",)])
    got = [r[0] for r in df.select(S.parse_station_time(F.col("s"))).collect()]
    midnight = dt.datetime(2024, 7, 1)
    assert got == [midnight, midnight, midnight, None, None, None]


def test_numbers(table):
    df = table("s string", [("1.5",), ("NaN",), ("x",), ("",), (None,), (" 2 ",)])
    assert [r[0] for r in df.select(S.number_or_null(F.col("s"))).collect()] == [1.5, None, None, None, None, 2.0]


def test_keys(table):
    df = table("s string", [("  Dam (A) - 2!",), ("!!",), ("ab" * 50,)])
    got = [r[0] for r in df.select(S.key_of(F.col("s"), lower=True, limit=60, default="none")).collect()]
    assert got == ["dam_a_2", "none", ("ab" * 50)[:60]]


def test_fold_composed_decomposed_and_sharp_s(table):
    df = table("s string", [("  Éclair\n",), ("Éclair",), ("STRAßE",), ("Ångström",), ("ngày",)])
    assert [r[0] for r in df.select(S.fold_text(F.col("s"))).collect()] == ["eclair", "eclair", "strasse", "angstrom", "ngay"]


def test_cyclic_distance_wraps(table):
    df = table("a int, b int", [(1, 366), (366, 1), (10, 200), (183, 366)])
    assert [r[0] for r in df.select(S.cyclic_day_distance(F.col("a"), F.col("b"))).collect()] == [1, 1, 176, 183]


def test_scores_at_their_edges(table):
    df = table("a double, b double", [(29.9, 59.9), (30.0, 0.0), (0.0, 60.0), (60.0, 0.0), (0.0, 100.0), (None, None)])
    assert [r[0] for r in df.select(S.rain_score(F.col("a"), F.col("b"))).collect()] == [0, 1, 1, 2, 2, 0]
    df = table("p double", [(0.69,), (0.7,), (0.9,), (None,)])
    assert [r[0] for r in df.select(S.discharge_score(F.col("p"))).collect()] == [0, 1, 2, 0]
    df = table("hi double, lo double", [(0.5, 0.0), (0.49, 0.2), (0.49, 0.19), (None, 0.3)])
    assert [r[0] for r in df.select(S.two_tier_colour(F.col("lo"), F.col("hi"))).collect()] == ["RED", "YELLOW", "GREEN", "YELLOW"]


def test_marks_may_be_missing(table):
    df = table("l double, w double, d double", [(5.0, 4.0, 6.0), (7.0, 4.0, 6.0), (7.0, None, None), (3.0, 4.0, None), (None, 1.0, 2.0), (6.0, None, 6.0)])
    got = [r[0] for r in df.select(S.mark_status(F.col("l"), F.col("w"), F.col("d"))).collect()]
    assert got == ["above_warning", "above_danger", "below_warning", "below_warning", None, "above_danger"]


def test_exposure(table):
    df = table("v double, r double, km double", [(6.0, 0.0, 8.0), (6.0, 0.0, 8.1), (20.0, 0.0, 1.0), (0.0, 0.0, 20.0), (None, 0.0, 1.0)])
    got = [r[0] for r in df.select(S.exposure_tier(F.col("v"), F.col("r"), F.col("km"))).collect()]
    assert got == ["higher", "moderate", "lower", "lower", None]


def test_trend(table):
    df = table("n double, b double", [(105.0, 100.0), (95.0, 100.0), (104.9, 100.0), (1.0, 0.0), (1.0, None)])
    words = [r[0] for r in df.select(S.trend_word(S.trend_pct(F.col("n"), F.col("b")))).collect()]
    assert words == ["rising", "falling", "steady", None, None]


def test_river_names(table):
    df = table("h string", [("Flood: River Old Dun (upper) at Bridge",), ("River at sea",), ("none",)])
    assert [r[0] for r in df.select(S.river_named(F.col("h"))).collect()] == ["Old Dun (upper)", None, None]


def test_utm_round_numbers(spark):
    # central meridian of zone 46 at the equator, and a point on it further north
    lon, lat = G.utm_to_lonlat(F.lit(500000.0), F.lit(0.0), F.lit(46))
    r = spark.range(1).select(lon, lat).collect()[0]
    assert r[0] == pytest.approx(93.0) and r[1] == pytest.approx(0.0)
    lon, lat = G.utm_to_lonlat(F.lit(500000.0), F.lit(2_765_000.0), F.lit(46))
    r = spark.range(1).select(lon, lat).collect()[0]
    assert r[0] == pytest.approx(93.0) and r[1] == pytest.approx(25.0, abs=0.01)


def test_haversine_quarter_of_the_globe(spark):
    assert one(spark.range(1), G.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))) == pytest.approx(6371 * 3.141592653589793 / 2)


@settings(max_examples=20, deadline=None)
@given(st.floats(-10, 10), st.floats(-10, 10))
def test_ring_parity_matches_a_diamond(spark, x, y):
    # |x| + |y| < 5, away from its edge
    if abs(abs(x) + abs(y) - 5) < 1e-6:
        return
    p = lambda a, b: F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y"))
    ring = F.array(p(0, -5), p(5, 0), p(0, 5), p(-5, 0))
    assert one(spark.range(1), G.inside_ring(F.lit(x), F.lit(y), G.ring_edges(ring))) == (abs(x) + abs(y) < 5)


def test_water_is_never_fill(table):
    df = table("s double", [(0.001,), (0.0,), (1e-13,), (None,), (0.02,)])
    assert [r[0] for r in df.select(G.is_water(F.col("s"))).collect()] == [True, False, False, False, False]
    assert rows(table("r double", [(29999.0,), (10.0,)]).select(G.satellite_mm(F.col("r")))) == [(None,), (24.0,)]


def test_published_parsing_rules(table):
    n = table("s string", [("5d",), ("5f",), (" 1e3 ",), (".5",), ("",), (None,)])
    assert [r[0] for r in n.select(S.number_or_null(F.col("s"))).collect()] == [None, None, 1000.0, 0.5, None, None]
    t = table("s string", [("1/6/26 05:30",), ("01/06/26 5:30",), ("2026-6-1 5:30",), ("1/6/69 05:30",)])
    assert [str(r[0])[:10] for r in t.select(S.parse_station_time(F.col("s"))).collect()] == ["2026-06-01"] * 3 + ["1969-06-01"]
    f = table("s string", [("গুৱাহাটী",), ("दुर्ग",), ("ſ ",), ("ﬁre",), ("ΟΔΟΣ",)])
    want = ["".join(c for c in unicodedata.normalize("NFD", x) if not unicodedata.combining(c)).casefold().strip() for x in ("গুৱাহাটী", "दुर्ग", "ſ ", "ﬁre", "ΟΔΟΣ")]
    assert [r[0] for r in f.select(S.fold_text(F.col("s"))).collect()] == want


def test_digest_tells_rows_apart(table):
    from freshet.operators.joins import content_hash

    df = table("k int, a string, b string", [(1, "a|b", "c"), (2, "a", "b|c"), (3, None, "c"), (4, "~", "c")])
    assert content_hash(df, ["k"], ["a", "b"]).select("digest").distinct().count() == 4


def test_telemetry_layouts_in_one_folder(spark, tmp_path):
    from freshet.sources.points import read_telemetry

    (tmp_path / "a.csv").write_text("Station,Data Acquisition Time,Rain\nA,01-02-2024 05:00,1.5\n")
    (tmp_path / "b.csv").write_text('District,Station,Data Acquisition Time,Level\n"x, y",B,1-2-2024 6:00,2.5\n')
    assert sorted((r.station, r.value) for r in read_telemetry(spark, str(tmp_path)).collect()) == [("A", 1.5), ("B", 2.5)]


def test_telemetry_headers_and_accounts(spark, tmp_path):
    from freshet.sources import points as P

    (tmp_path / "a.csv").write_text("Station,Data Acquisition Time,Rain\nA,01-02-2024 05:00,1.5\nA,soon,2\nA,01-02-2024 06:00,\n\n")
    (tmp_path / "b.csv").write_text(' station , DISTRICT,"data acquisition time",latitude,Longitude,Level\nB,"x, y",1-2-2024 6:00,26.5,93.0,2.5\nB,z,1-2-2024 5:00,10,93,3\n')
    (tmp_path / "c.csv").write_text("C,01-02-2024 05:00,9\n")
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv").write_text("Station,Data Acquisition Time,Rain\n")
    path = str(tmp_path)
    assert sorted((r.station, r.value) for r in P.read_telemetry(spark, path).collect()) == [("A", 1.5), ("B", 2.5), ("B", 3.0)]
    got = {r.file[-5]: (r.n_rows, r.kept, r.bad_time, r.no_value, r.reason) for r in P.telemetry_account(spark, path).collect()}
    assert got == {"a": (3, 1, 1, 1, None), "b": (2, 2, 0, 0, None), "c": (1, 0, 0, 0, "no header"), "d": (0, 0, 0, 0, "empty"), "e": (0, 0, 0, 0, "no rows")}
    cards = {r.station: r for r in P.station_cards(P.read_telemetry(spark, path, located=True), (20.0, 85.0, 30.0, 100.0)).collect()}
    assert (cards["B"].lat, cards["B"].district, cards["B"].n_rows, cards["B"].position_trusted) == (10.0, "z", 2, False)
    assert cards["A"].lat is None and cards["A"].position_trusted is False
