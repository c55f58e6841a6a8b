"""Ranks, seasonal shares, exceedance and quantiles against brute force, over several ranges and rounds."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from freshet.operators import ranks
from freshet.plans import risk


@pytest.fixture
def apart(spark):
    """Ranges stay apart however small they are."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_counts_below(spark, apart):
    rng = random.Random(1)
    key = lambda: rng.choice(["hot", "hot", "hot", "b", None])
    refs = [(key(), rng.choice([None, 0.0, -0.0, 1.5, *(float(i) for i in range(60))])) for _ in range(900)]
    refs += [("hot", 7.0)] * 300
    probes = [(key(), rng.choice([None, -1.0, 7.0, 7.5, 59.0, 100.0, 0.0])) for _ in range(80)] + [("none", 3.0)]
    schema = "k string, v double"
    got = ranks.counts_below(spark.createDataFrame(refs, schema), spark.createDataFrame(probes, schema), ["k"], "v")
    want = set()
    for k, v in set(probes):
        if v is not None:
            own = [x for j, x in refs if j == k and x is not None]
            want.add((k, v, sum(x < v for x in own), sum(x <= v for x in own), len(own)))
    assert {tuple(r) for r in got.collect()} == want
    assert ranks.counts_below(spark.createDataFrame([], schema), spark.createDataFrame([], schema), ["k"], "v").collect() == []


def ring(a, b):
    return min(abs(a - b), 366 - abs(a - b))


def test_blocks_make_up_each_band(spark):
    for k in (0, 1, 7, 15, 20):
        days = {}
        for doy, block in ranks.season_blocks(spark, k).collect():
            level, number = divmod(block, 1000)
            first = number << level
            assert not days.setdefault(doy, set()) & set(range(first, first + (1 << level)))
            days[doy] |= set(range(first, first + (1 << level)))
        assert all(days[d] == {x for x in range(366) if ring(x + 1, d) <= k} for d in range(1, 367))


def test_seasonal_shares(spark, apart):
    rng = random.Random(2)
    start = dt.date(2015, 1, 1)
    history = [(s, start + dt.timedelta(i), rng.choice([None, float(rng.randrange(30))])) for s in (1, 2) for i in range(0, 365 * 9, 2 if s == 1 else 11)]
    probes = [(s, dt.date(2024, m, d), float(rng.randrange(30))) for s in (1, 2, 3) for m, d in [(1, 1), (1, 15), (2, 29), (7, 4), (12, 31), (12, 20)]]
    probes += [(1, dt.date(2024, 5, 5), None), probes[0]]
    schema = "s int, d date, q double"
    got = ranks.seasonal_shares(spark.createDataFrame(history, schema), spark.createDataFrame(probes, schema), "s", "d", "q").collect()
    want = {}
    for s, d, q in probes:
        own = [x for t, e, x in history if t == s and x is not None and ring(e.timetuple().tm_yday, d.timetuple().tm_yday) <= 15]
        if q is not None and own:
            want[s, d, q] = (len(own), sum(x <= q for x in own) / len(own) if len(own) >= 60 else None)
    assert {(r.s, r.d, r.q): (r.n_ref, r.share) for r in got} == want and len(got) == len(want)
    assert {v[1] is None for v in want.values()} == {True, False}


def test_replay_takes_the_seasonal_share_first(spark):
    day = lambda i: dt.date(2020, 6, 1) + dt.timedelta(i)
    near = spark.createDataFrame([(s, day(i), float(i % 5)) for s in (1, 2) for i in range(40) if i != 33], "s int, d date, q double")
    history = spark.createDataFrame([(1, dt.date(y, 6, 20) + dt.timedelta(i), 2.5) for y in (2010, 2011, 2012) for i in range(30)], "s int, d date, q double")
    got = {(r.s, r.d): r for r in risk.replay_shares(near, history, "s", "d", "q").collect()}
    a, b = got[1, day(33)], got[2, day(33)]
    assert (a.q, a.baseline, a.share) == (2.0, "seasonal", 0.0)
    assert (b.q, b.baseline) == (2.0, "trailing") and 0 < b.share < 1
    # too few values of history within 15 days
    assert got[1, day(0)].baseline == "trailing"


def test_exceedance_counts_every_residual(spark, apart):
    rng = random.Random(3)
    res = [(rng.choice(["a", "a", "b"]), rng.choice([None, float(rng.randrange(-20, 20))])) for _ in range(700)]
    preds = [(rng.choice(["a", "b", "c"]), rng.choice([None, float(rng.randrange(50))]), rng.choice([None, 30.0, 40.0]), 45.0) for _ in range(120)]
    got = ranks.exceedance(spark.createDataFrame(preds, "k string, p double, low double, high double"), spark.createDataFrame(res, "k string, e double"), "k", "p", "e", {"x": "low", "y": "high"})

    def share(k, p, t):
        own = [e for j, e in res if j == k and e is not None]
        return sum(p + e >= t for e in own) / len(own) if own and p is not None and t is not None else None

    assert rows(got) == sorted(((*r, share(r[0], r[1], r[2]), share(r[0], r[1], r[3])) for r in preds), key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize(("most", "buckets"), [(5, 64), (1, 1000), (10_000, 4096)])
def test_exact_quantiles(spark, most, buckets):
    rng = random.Random(4)
    kinds = {"even": lambda: 3.0, "wide": lambda: rng.choice([1e-300, 1e300, -1e300, 1.0, 2.0]), "plain": lambda: float(rng.randrange(40)), "none": lambda: None, "steep": lambda: math.exp(rng.uniform(-50, 50))}
    data = [(g, rng.choice([None, f()]) if g != "even" else f(), rng.choice([float("nan"), float("inf"), rng.random()])) for g, f in kinds.items() for _ in range(rng.randrange(30, 90))]
    data += [("one", 4.0, None), (None, 1.0, 2.0), (None, 2.0, 4.0)]
    df = spark.createDataFrame(data, "g string, a double, b double")
    for p in (0.5, 0.0, 0.9, 1.0):
        got = ranks.exact_quantiles(df, ["g"], {"qa": F.col("a"), "qb": F.col("b")}, p, most=most, buckets=buckets).collect()
        assert len(got) == len({r[0] for r in data})
        for r in got:
            assert r.n_rows == sum(x[0] == r.g for x in data)
            for i, q in ((1, r.qa), (2, r.qb)):
                own = [x[i] for x in data if x[0] == r.g and x[i] is not None and math.isfinite(x[i])]
                assert (q is None) == (not own)
                if own:
                    assert q == pytest.approx(float(np.quantile(own, p)), rel=1e-12)
    whole = ranks.exact_quantiles(df, [], {"q": F.col("b")}, most=most, buckets=buckets).collect()
    assert whole[0].q == pytest.approx(float(np.median([x[2] for x in data if x[2] is not None and math.isfinite(x[2])])))
    assert ranks.exact_quantiles(df.limit(0), ["g"], {"q": F.col("a")}).collect() == []
