import datetime as dt
import random

from conftest import rows
from pyspark.sql import functions as F

from freshet.operators import aggregates as A
from freshet.operators import windows as Wn
from freshet.operators.chunks import carry_last, chunk_of, chunk_width, previous_reading
from freshet.operators.joins import asof_backward, nearest_within
from freshet.plans.verification import held_value

D = dt.date(2020, 1, 1)


def day(n):
    return D + dt.timedelta(days=n)


def test_rolling_hours_need_every_row_and_take_the_last_value(table):
    # hours 0..24, hour 10 missing: six-row sums exist before it and from hour 16 on
    df = table("p int, h bigint, mm double", [(1, h, 1.0) for h in range(25) if h != 10])
    got = {r["day"]: r for r in Wn.rolling_hour_sums(df, ["p"], "h", "mm", (6, 12)).collect()}
    assert got[0]["rain_6h"] == 6.0 and got[0]["rain_12h"] == 12.0
    early = df.filter("h < 16")
    assert Wn.rolling_hour_sums(early, ["p"], "h", "mm", (6,)).collect()[0]["rain_6h"] == 6.0
    assert Wn.rolling_hour_sums(df.filter("h < 3"), ["p"], "h", "mm", (6,)).collect()[0]["rain_6h"] is None


def test_trailing_sum_before_anything_is_zero(table):
    s = table("p int, h bigint, mm double", [(1, 10, 5.0), (1, 34, 2.0)])
    at = table("p int, h bigint", [(1, 0), (1, 10), (1, 33), (1, 34), (2, 5)])
    got = rows(Wn.trailing_window_at(s, at, "p", "h", "mm"), "p", "h")
    assert got == [(1, 0, 0.0, 0.0), (1, 10, 5.0, 5.0), (1, 33, 5.0, 5.0), (1, 34, 2.0, 7.0), (2, 5, 0.0, 0.0)]


def test_last_and_first_rows(table):
    s = table("p int, h bigint, mm double", [(1, h, float(h)) for h in range(10)])
    assert rows(Wn.trailing_n_rows(s, "p", "h", "mm", 4, 2)) == [(1, 7.0, 11.0)]
    assert rows(Wn.trailing_n_rows(s, "p", "h", "mm", 20, 3)) == [(1, 24.0, 0.0)]


def test_runs_end_at_nulls_and_at_the_end_of_the_series(table):
    v = [1, 5, 6, None, 7, 2, 5, 5]
    df = table("k int, d int, q double", [(1, i, None if x is None else float(x)) for i, x in enumerate(v)] + [(2, 0, 9.0), (3, 0, 1.0)])
    got = rows(Wn.runs_above(df, ["k"], "d", "q", F.lit(5.0)), "k", "onset")
    assert got == [(1, 1, 2, 6.0, 2), (1, 4, 4, 7.0, 1), (1, 6, 7, 5.0, 2), (2, 0, 0, 9.0, 1)]


def leads(table, values, preds, horizon=1, thr=5.0):
    rws = [(1, day(n), v, p, thr, horizon) for (n, v), p in zip(values, preds)]
    df = table("k int, d date, a double, p double, thr double, h int", rws)
    return rows(Wn.event_leads(df, ["k"], "d", "a", "p", "thr", "h").select("onset", "end", "lead_days"), "onset")


def test_event_lead_is_zero_for_an_alarm_on_the_day_before_plus_horizon(table):
    got = leads(table, [(0, 1.0), (1, 6.0), (2, 7.0)], [0.0, 0.0, 9.0])
    # alarmed day 2 was predicted on day 1, the onset
    assert got == [(day(1), day(2), 0)]
    assert leads(table, [(0, 1.0), (1, 6.0)], [0.0, 9.0]) == [(day(1), day(1), 1)]


def test_exceedance_after_a_gap_is_no_onset_and_ends_the_run(table):
    got = leads(table, [(0, 6.0), (1, 6.0), (4, 6.0), (5, 1.0), (6, 8.0)], [9.0] * 5)
    assert [(a, b) for a, b, _ in got] == [(day(0), day(1)), (day(6), day(6))]


def test_no_event_below_threshold(table):
    assert leads(table, [(0, 1.0), (1, None)], [9.0, 9.0]) == []


def greedy(rises, top, apart):
    chosen = []
    for d, r in sorted(rises.items(), key=lambda x: (-x[1], x[0])):
        if len(chosen) < top and all(abs(d - c) >= apart for c in chosen):
            chosen.append(d)
    return chosen


def test_separated_top_is_the_greedy_choice(table):
    rng = random.Random(5)
    data, want = [], {}
    for k in range(4):
        # a block of large neighbours first, so that the greedy choice has to look far down
        rises = {d: (1000 - abs(d - 50) if d < 100 else rng.uniform(0, 100)) for d in rng.sample(range(400), 300)}
        want[k] = greedy(rises, 10, 7)
        data += [(k, day(d), float(r)) for d, r in rises.items()]
    got = {}
    for k, pick, d, _ in rows(Wn.separated_top(table("k int, d date, rise double", data), "k", "d", "rise"), "k", "pick"):
        got.setdefault(k, []).append((d - D).days)
    assert got == want


def test_peak_takes_the_earliest_of_equals_and_spans_gaps(table):
    df = table("k int, d date, q double", [(1, day(0), 1.0), (1, day(1), 9.0), (1, day(3), 9.0), (1, day(9), 2.0)])
    got = {r["d"]: r for r in Wn.peak_after(df, "k", "d", "q").collect()}
    assert (got[day(0)]["peak"], got[day(0)]["peak_day"], got[day(0)]["before"]) == (9.0, day(1), None)
    assert (got[day(3)]["peak"], got[day(3)]["before"]) == (9.0, None)
    assert (got[day(9)]["peak"], got[day(9)]["peak_day"]) == (2.0, day(9))


def test_trailing_rank_falls_back_to_the_latest_day(table):
    df = table("k int, d date, q double", [(1, day(0), 3.0), (1, day(1), 1.0), (1, day(4), 2.0)])
    got = rows(Wn.trailing_rank_every_day(df, "k", "d", "q"), "d")
    assert [round(r[3], 3) for r in got] == [1.0, 0.5, 0.5, 0.5, 0.667]


def test_quietest_week_ties_go_to_the_earliest(table):
    df = table("s int, d date, t double", [(1, day(i), 1.0) for i in range(10)] + [(2, day(i), 0.0) for i in range(6)])
    assert rows(Wn.quietest_week(df, "s", "d", "t")) == [(1, day(0), day(6), 7.0)]


def test_counter_resets_and_first_reading(table):
    t0 = dt.datetime(2020, 1, 1)
    vals = [5.0, 8.0, 2.0, 400.0, 401.5]
    df = table("s int, ts timestamp_ntz, i int, v double", [(1, t0 + dt.timedelta(hours=7 * i), i, v) for i, v in enumerate(vals)])
    got = rows(Wn.counter_increments(df, "s", "ts", "i", "v", width=3600).select("i", "increment"))
    assert got == [(1, 3.0), (2, 0.0), (4, 1.5)]


def test_jump_needs_the_day_before(table):
    df = table("k int, d date, q double", [(1, day(0), 1.0), (1, day(2), 50.0), (1, day(3), 60.0), (1, day(4), 72.0), (2, day(0), 0.0), (2, day(1), 5.0)])
    assert rows(Wn.biggest_jump(df, "k", "d", "q")) == [(1, day(3), 50.0, 60.0, 20.0)]


def test_states(table):
    df = table("v int, t int, s string", [(1, i, s) for i, s in enumerate(["GREEN", "YELLOW", "GREEN", "RED", "RED"])] + [(2, 0, "RED"), (3, 0, "GREEN")])
    got = {r["v"]: r for r in Wn.state_transitions(df, "v", "t", "s", 2, 4).collect()}
    assert (got[1]["first_elevated"], got[1]["first_red"], got[1]["re_elevated"], got[1]["red_steps"]) == (1, 3, 3, "3,4")
    assert got[2]["already_at_start"] and not got[3]["already_at_start"] and got[3]["first_red"] is None


def readings(rng, n, keys=2):
    t0 = dt.datetime(2020, 1, 1)
    # many readings share an instant, many chunks are empty
    return [(rng.randrange(keys), t0 + dt.timedelta(seconds=rng.choice([0, 1, 50, 5000, 90000]) * rng.randrange(6)), i, rng.choice([None, float(i)])) for i in range(n)]


def test_chunked_lag_equals_the_plain_one(table):
    rng = random.Random(3)
    data = readings(rng, 300)
    df = table("s int, ts timestamp_ntz, i int, v double", data)
    want = {}
    for s in (0, 1):
        last = None
        for r in sorted((r for r in data if r[0] == s), key=lambda r: (r[1], r[2])):
            want[r[2]] = last
            last = r[3] if r[3] is not None else last
    for width in (1, 60, 86400):
        got = {r["i"]: r["previous"] for r in previous_reading(df, "s", "ts", "i", "v", width=width).collect()}
        assert got == want


def test_asof_takes_the_same_instant_and_knows_empty_sides(table):
    t0 = dt.datetime(2020, 1, 1)
    at = lambda h: t0 + dt.timedelta(hours=h)
    left = table("k int, ts timestamp_ntz, i int", [(1, at(0), 1), (1, at(5), 2), (1, at(100), 3), (2, at(1), 4)])
    right = table("k int, ts timestamp_ntz, j int, v double", [(1, at(5), 1, 7.0), (1, at(6), 2, 8.0), (1, at(50), 3, None)])
    got = {r["i"]: r["x"] for r in asof_backward(left, right, "k", "ts", "i", "j", "v", "x", width=3600).collect()}
    assert got == {1: None, 2: 7.0, 3: 8.0, 4: None}
    none = asof_backward(left, right.filter("false"), "k", "ts", "i", "j", "v", "x")
    assert none.filter("x IS NOT NULL").count() == 0 and none.count() == 4


def test_carry_last_inclusive(table):
    df = table("k int, t int, v double, c int", [(1, 0, 1.0, 0), (1, 1, None, 0), (1, 2, None, 5), (1, 3, 4.0, 5)])
    got = {r["t"]: r["x"] for r in carry_last(df, ["k"], ["t"], "v", "c", "x", inclusive=True).collect()}
    assert got == {0: 1.0, 1: 1.0, 2: 1.0, 3: 4.0}


def test_chunk_width_keeps_a_single_hot_key_bounded(spark):
    df = spark.range(10000).selectExpr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts")
    assert chunk_width(df, "ts", rows_per_chunk=100) == 100
    assert df.groupBy(chunk_of("ts", 100)).count().agg(F.max("count")).first()[0] <= 100
    assert chunk_width(df.filter("false"), "ts") == 86400


def test_nearest_reading_respects_both_tolerances(table):
    t0 = dt.datetime(2020, 1, 3)
    back = lambda h: t0 - dt.timedelta(hours=h)
    df = table(
        "s int, ts timestamp_ntz, v double",
        [(1, t0, 5.0), (1, back(10), 9.0), (1, back(20), 4.9), (1, back(30), 1.0), (2, t0, 5.0), (2, back(40), 1.0), (3, t0, 2.0), (3, back(24), 2.01)],
    )
    got = {r["s"]: (r["ref_time"], r["word"]) for r in nearest_within(df, "s", "ts", "v", 24, 18, 8, 0.05).collect()}
    assert got == {1: (back(20), "rising"), 2: (None, None), 3: (back(24), "steady")}


def test_held_value(table):
    asks = table("k int, i date", [(1, day(0)), (1, day(5)), (1, day(5)), (2, day(5))])
    obs = table("k int, d date, q double", [(1, day(1), 3.0), (1, day(5), None), (1, day(6), 9.0)])
    assert rows(held_value(asks, obs, "k", "i", "d", "q", "x")) == [(1, day(0), None), (1, day(5), 3.0), (1, day(5), 3.0), (2, day(5), None)]


def test_rolled_hours_partial(table):
    df = table("p int, h bigint, mm double", [(1, 0, 1.0), (1, 30, 2.0)])
    assert rows(A.rolled_hours(df, "p", "h", "mm", 24, "s", partial=True).select("h", "s")) == [(0, 1.0), (30, 2.0)]
    assert A.rolled_hours(df, "p", "h", "mm", 2, "s").filter("s IS NOT NULL").count() == 1
