import datetime as dt
import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from freshet.operators import aggregates as A
from freshet.operators import quality as Q
from freshet.plans import baselines as B
from freshet.plans import frames as Fr
from freshet.plans import lags as Lg
from freshet.plans import verification as V

D = dt.date(2020, 6, 1)


def day(n):
    return D + dt.timedelta(days=n)


def test_a_day_of_nulls_is_zero(table):
    df = table("k int, d date, v double", [(1, day(0), None), (1, day(0), None), (1, day(1), 2.0), (1, day(1), None)])
    assert rows(A.daily_total(df, ["k"], F.col("d"), "v")) == [(1, day(0), 0.0), (1, day(1), 2.0)]


def test_zero_denominators_give_null(table):
    df = table("a boolean, p boolean", [(False, False)])
    r = A.contingency(df.withColumn("k", F.lit(1)), ["k"], F.col("a"), F.col("p")).collect()[0]
    assert (r["pod"], r["far"], r["n_actual"]) == (None, None, 0)
    flat = table("k int, o double, p double, s double", [(1, 1.0, 1.0, 1.0), (1, 2.0, None, 2.0)])
    r = A.error_metrics(flat, ["k"], "o", "p", "s").collect()[0]
    assert (r["n"], r["mae"], r["skill"]) == (1, 0.0, None)


def test_gate_hides_metrics(table):
    df = table("n bigint, mae double", [(11, 1.0), (12, 2.0)])
    assert rows(A.gate(df, "n", 12, ["mae"])) == [(11, None, "insufficient"), (12, 2.0, "ok")]


def test_constant_series_have_no_correlation(table):
    df = table("k int, a double, b double", [(1, 1.0, 5.0), (1, 2.0, 5.0)])
    assert A.pearson_pair(df, ["k"], "a", "b").collect()[0]["r"] is None


def test_seasonal_share_needs_sixty(table):
    hist = table("k int, d date, q double", [(1, dt.date(2000 + y, 1, 1) + dt.timedelta(days=i), float(i)) for y in range(2) for i in range(31)])
    probe = table("k int, d date, v double", [(1, dt.date(2010, 1, 16), 15.0), (1, dt.date(2010, 2, 10), 15.0)])
    got = {r["d"]: (r["n_ref"], r["share"]) for r in A.seasonal_percentile(hist, probe, "k", "d", "q", "v").collect()}
    assert got[dt.date(2010, 1, 16)] == (62, pytest.approx(32 / 62))
    assert got[dt.date(2010, 2, 10)][1] is None


def test_seasons_wrap_around_new_year(table):
    df = table("k int, d date, q double", [(1, dt.date(2019, 12, 30), 4.0), (1, dt.date(2020, 1, 3), 8.0)])
    got = {r["doy"]: r["clim"] for r in A.doy_climatology(df, ["k"], "d", "q").collect()}
    assert got[366] == 6.0 and got[1] == 6.0 and got[10] == 8.0 and 100 not in got


def test_drift_of_few_references_is_unknown_and_ranks_low(table):
    hist = table("k int, input string, d date, value double", [(1, "q", day(i % 10), float(i)) for i in range(40)] + [(1, "r", day(0), 1.0)] + [(2, "q", day(i % 10), float(i)) for i in range(40)])
    live = table("k int, input string, d date, v double", [(1, "q", day(5), 20.0), (1, "r", day(5), 99.0), (2, "q", day(5), 100.0)])
    got = {(r["k"], r["input"]): (r["seasonal_status"], r["overall"]) for r in A.drift_status(hist, live, "k", "d", "value").collect()}
    assert got == {(1, "q"): ("in-range", "in-range"), (1, "r"): ("unknown", "in-range"), (2, "q"): ("out-of-range", "out-of-range")}


def test_exceedance_counts_equality(table):
    p = table("k int, pred double, thr double", [(1, 8.0, 10.0), (2, 8.0, 10.0), (1, None, 10.0)])
    res = table("k int, e double", [(1, 2.0), (1, 1.9), (1, None), (1, 5.0), (1, -3.0)])
    got = rows(A.residual_exceedance(p, res, "k", "pred", "e", {"pr": "thr"}).select("k", "pred", "pr"))
    assert got == [(1, None, None), (1, 8.0, 0.5), (2, 8.0, None)]


def gauge(kind, n=40):
    t0 = dt.datetime(2020, 1, 1)
    val = {"cum": lambda i: float(i % 30), "inc": lambda i: float((i * 7) % 5), "bad": lambda i: 2000.0 if i == 3 else 1.0 * (i % 3), "neg": lambda i: -1.0}[kind]
    return [(kind, t0 + dt.timedelta(minutes=30 * i), i, val(i)) for i in range(n)]


def test_sensor_modes_in_order(table):
    data = gauge("cum", 100) + gauge("inc", 100) + gauge("bad", 100) + gauge("neg", 100)
    data += [("few", dt.datetime(2020, 1, 1), 0, 1.0)] + [("sparse", dt.datetime(2020, 1, 1) + dt.timedelta(hours=5 * i), i, float(i % 2)) for i in range(60)]
    days = Q.station_days(table("s string, ts timestamp_ntz, i int, v double", data), "s", "ts", "i", "v", width=7200)
    modes = Q.sensor_modes(days, "s", min_rows=50)
    got = {r["s"]: (r["mode"], r["excluded"]) for r in modes.collect()}
    assert got["cum"] == ("cumulative", None) and got["inc"] == ("incremental", None)
    assert got["bad"][1] == "implausible extremes" and got["neg"][1] == got["few"][1] == "too few valid readings"
    assert got["sparse"][1] == "sparse incremental reporting"
    totals = {(r["s"], r["d"].day): (r["total"], r["n"]) for r in Q.gauge_daily(days, modes, "s").collect()}
    # day 1 of the counter: 47 steps, one reset at 30 counted as 0
    assert totals[("cum", 1)] == (29.0 + 17.0, 47)
    # the incremental sensor's third day has only 4 readings, the counter's has 4 steps
    assert ("inc", 3) not in totals and ("cum", 3) in totals and ("sparse", 1) not in totals


def test_band_drops_constant_entities(table):
    df = table("k int, v double", [(1, 5.0)] * 10 + [(2, float(i)) for i in range(101)] + [(2, 1000.0)])
    got = Q.robust_band(df, "k", "v").agg(F.count("*"), F.min("k"), F.max("v"), F.max("norm"), F.min("norm")).collect()[0]
    assert tuple(got) == (101, 2, 100.0, 1.0, 0.0)


def frame(table, n=900, basins=(0, 1)):
    out = []
    for b in basins:
        for i in range(n):
            d = dt.date(2018, 1, 1) + dt.timedelta(days=i)
            if i % 97 != 5:
                out.append((b, d, float((i * 37 + b) % 50), 100 + 50 * math.sin(i / 9) + (i * 13 % 17)))
    df = table("basin int, d date, rain_24h double, q double", out)
    return Fr.daily_frame(df.select("basin", "d", "rain_24h"), df.select("basin", "d", "q"), df.select("basin", "d", "q"))


def test_features_do_not_see_the_future_and_the_check_would_notice(table):
    f = frame(table)
    probe = F.lit("2019-06-01").cast("date")
    assert Fr.leakage_rows(f, probe).count() == 0
    leaky = lambda d: Fr.feature_frame(d).withColumn("peek", F.col("y_h1"))
    # only the last day before the probe looks past it, once per basin
    assert Fr.leakage_rows(f, probe, leaky).count() == 2


def test_persistence_has_no_lead_and_zero_skill(table):
    s = B.backtest(frame(table), [2019, 2020])
    p = s.filter("candidate = 'persistence' AND n_events > 0").collect()
    assert p and all(abs(r["skill"]) < 1e-12 for r in p)
    assert all(r["mean_lead"] is None or r["mean_lead"] <= 0 for r in p if r["h"] == 1)


def test_thresholds_use_earlier_seasons_only(table):
    df = table("k int, d date, q double", [(1, dt.date(2018, 7, 1), 1.0), (1, dt.date(2018, 1, 1), 50.0), (1, dt.date(2019, 7, 1), 3.0), (1, dt.date(2020, 7, 1), 99.0)])
    assert rows(B.fold_quantiles(df, ["k"], "d", "q", [2018, 2019, 2020], 0.5)) == [(1, 2019, 1.0), (1, 2020, 2.0)]


def test_slope_through_zero(table):
    f = table("basin int, d date, q double, rain_24h double, rain_48h double", [(1, dt.date(2018, 7, i), 10.0 * i, 5.0, 10.0) for i in range(1, 5)] + [(2, dt.date(2018, 7, 1), 1.0, 0.0, 0.0)])
    got = {(r["basin"], r["h"]): r["slope"] for r in B.fold_slopes(f, [2019]).collect()}
    assert got == {(1, 1): 2.0, (1, 2): 2.0, (2, 1): 0.0, (2, 2): 0.0}


def test_ship_rule_ties_go_to_the_lag_rule(table):
    s = "basin int, val_year int, h int, candidate string, mae double"
    rws = [(1, y, 1, c, m) for y in range(4) for c, m in (("persistence", 5.0), ("lag_rule", 5.0), ("new", 4.0 if y < 3 else 6.0))]
    rws += [(2, y, 1, c, m) for y in range(4) for c, m in (("persistence", 3.0), ("lag_rule", 5.0), ("new", 2.0 if y < 2 else 6.0))]
    got = {r["basin"]: (r["best_baseline"], r["wins"], r["shipped"]) for r in B.ship_rule(table(s, rws), "new").collect()}
    assert got == {1: ("lag_rule", 3, "new"), 2: ("persistence", 2, "persistence")}


def test_best_lag_recovers_a_shift_and_keeps_it_without_any_year(table):
    rain, q = [], []
    for i in range(1100):
        d = dt.date(2017, 1, 1) + dt.timedelta(days=i)
        r = float((i * 7919) % 101)
        rain.append((1, d, r))
        q.append((1, d + dt.timedelta(days=2), 10 * r))
    pairs = Lg.lag_pairs(table("basin int, d date, r double", rain), table("basin int, d date, q double", q), ["r"])
    best = Lg.best_lag(Lg.cross_correlation(pairs), ["basin", "win", "season"], "r_q", "lag")
    assert {r["lag"] for r in best.collect()} == {2}
    assert {r["best_lag"] for r in Lg.leave_one_year_out(pairs, "q").collect()} == {2}


def test_lead_buckets_are_half_open(table):
    obs = table("site int, d date, q double", [(1, day(i), float(i)) for i in range(60)])
    f = table("site int, issued date, target date, lead int, fc double", [(1, day(0), day(n), n, float(n)) for n in (2, 3, 8, 9, 17, 18)])
    marks = table("site int, thr double", [(1, 15.0)])
    got = {r["bucket"]: (r["n"], r["status"]) for r in V.lead_bucket_score(f, obs, marks, min_pairs=2).collect()}
    # a bucket without a forecast is there too
    none = {b: (0, "insufficient") for b in ("48h", "72h", "7d")}
    assert got == {"6h": (2, "ok"), "12h": (2, "ok"), "24h": (1, "insufficient")} | none


def test_event_statuses(table):
    obs = table("site int, d date, q double", [(s, day(i), 1.0) for s in (1, 2, 3) for i in range(5)])
    f = table("site int, issued date, target date, lead int, fc double", [(s, day(0), day(1), 1, 2.0) for s in (1, 2, 3)])
    marks = table("site int, thr double", [(1, 9.0), (2, 1.5), (3, None)])
    got = {r["site"]: (r["ev_status"], r["forecast_above"], r["far"]) for r in V.lead_day_score(f, obs, marks).where("lead = 1").collect()}
    assert got == {1: ("no crossings", None, None), 2: ("ok", 1, 1.0), 3: ("no threshold", None, None)}


def test_events_without_pairs_say_so(table):
    # site 1: the target is not observed; 2: the forecast is missing; 3: neither pairs nor a mark; lead 2 has no events
    obs = table("site int, d date, q double", [(s, day(0), 1.0) for s in (1, 2, 3)] + [(2, day(1), 9.0)])
    f = table(
        "site int, issued date, target date, lead int, fc double",
        [(1, day(0), day(1), 1, 2.0), (2, day(0), day(1), 1, None), (3, day(0), day(1), 1, 2.0), (1, day(0), day(2), 2, 2.0)],
    )
    marks = table("site int, thr double", [(1, 1.5), (2, 1.5), (3, None)])
    scores = V.lead_day_score(f, obs, marks)
    assert {(r["n"], r["status"], r["ev_status"]) for r in scores.where("lead > 2").collect()} == {(0, "insufficient", None)}
    got = {(r["site"], r["lead"]): (r["ev_status"], r["observed_above"], r["pod"]) for r in scores.where("lead = 1 OR site = 1 AND lead = 2").collect()}
    assert got == {(1, 1): ("no pairs", None, None), (2, 1): ("no pairs", None, None), (3, 1): ("no threshold", None, None), (1, 2): (None, None, None)}


def test_golden_rows(table):
    g = table("k int, a double, b double", [(1, 1.0, None), (2, 2.0, 3.0)])
    n = table("k int, a double, b double", [(1, 1.0, None), (2, 2.0, 4.0)])
    assert rows(V.metric_mismatches(n, g, ["k"], ["a", "b"])) == [(2, "b", 3.0, 4.0)]
