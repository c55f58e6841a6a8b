"""Learners: trees against exhaustive search, the published rounds, and selection that goes on over the folds."""

import datetime as dt

import numpy as np
import pytest

from freshet.plans import boosting, learning
from freshet.plans.boosting import Learner

SMALL = {"histogram": Learner(rounds=2, leaves=4), "second_order": Learner(rounds=2, leaves=None, depth=2, least_rows=1, shrink=1.0, share=0.9)}


def test_learners_have_the_published_rounds():
    assert all((k.rounds, k.rate) == (400, 0.05) for k in learning.LEARNERS.values())
    assert (boosting.HISTOGRAM.leaves, boosting.HISTOGRAM.least_rows) == (31, 20)
    assert (boosting.SECOND_ORDER.depth, boosting.SECOND_ORDER.share, boosting.SECOND_ORDER.shrink) == (4, 0.9, 1.0)


def every_split(x, g, rows, how):
    """The best split by trying every feature, value and side of the nulls: (gain, rows to the left)."""
    score = lambda at: g[at].sum() ** 2 / (len(at) + how.shrink)
    best = (0.0, None)
    for f in range(x.shape[1]):
        v = x[rows, f]
        for cut in np.unique(v[~np.isnan(v)]):
            for null_left in (False, True):
                left = (v <= cut) | (np.isnan(v) & null_left)
                if min(left.sum(), (~left).sum()) < how.least_rows:
                    continue
                gain = score(rows[left]) + score(rows[~left]) - score(rows)
                if gain > best[0] + 1e-9:
                    best = (gain, set(rows[left].tolist()))
    return best


@pytest.mark.parametrize("how", [Learner(least_rows=3), Learner(least_rows=1, shrink=1.0), Learner(least_rows=5, shrink=0.3)])
def test_best_split_is_that_of_every_split(how):
    rng = np.random.default_rng(how.least_rows)
    for _ in range(25):
        x = rng.integers(0, 9, (40, 3)).astype(float)
        x[rng.random(x.shape) < 0.2] = np.nan
        g, rows = rng.normal(size=40), np.arange(40)
        grower = boosting.Grower(x, how)
        found = grower.best_split(grower._sums(rows, g))
        gain, left = every_split(x, g, rows, how)
        if left is None:
            assert found is None
            continue
        assert abs(found[0] - gain) < 1e-9
        _, f, b, null_left = found
        goes = (x[:, f] <= grower.edges[f][b]) | (np.isnan(x[:, f]) & null_left)
        got = every = set(np.flatnonzero(goes).tolist())
        # another split may gain the same: then both sides must score alike
        assert got == left or abs(sum(g[list(s)].sum() ** 2 / (len(s) + how.shrink) for s in (every, set(range(40)) - every)) - g.sum() ** 2 / (40 + how.shrink) - gain) < 1e-9


def test_tree_grows_at_the_leaf_that_gains_most():
    rng = np.random.default_rng(7)
    x, how = rng.integers(0, 12, (60, 2)).astype(float), Learner(leaves=6, least_rows=2, rate=1.0)
    g = rng.normal(size=60)
    tree = boosting.Grower(x, how).tree(np.arange(60), g)
    parts = [np.arange(60)]
    while len(parts) < 6:
        k = max(range(len(parts)), key=lambda i: every_split(x, g, parts[i], how)[0])
        left = every_split(x, g, parts[k], how)[1]
        p = parts.pop(k)
        parts += [np.array(sorted(left)), np.array(sorted(set(p.tolist()) - left))]
    want = np.zeros(60)
    for p in parts:
        want[p] = -g[p].mean()
    assert np.allclose(boosting.values_at(x, [tree]), want)


def test_boosting_fits_and_takes_nulls():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 4))
    x[rng.random(600) < 0.3, 1] = np.nan
    y = 3 * x[:, 0] + np.where(np.isnan(x[:, 1]), 5.0, 0.0)
    for how in (Learner(rounds=150, rate=0.1), Learner(rounds=150, rate=0.1, leaves=None, depth=4, least_rows=1, shrink=1.0, share=0.9)):
        got = boosting.values_at(x[500:], list(boosting.boost(x[:500], y[:500], how)))
        assert np.abs(got - y[500:]).mean() < 0.5
    flat = list(boosting.boost(np.full((50, 2), np.nan), np.arange(50.0), Learner(rounds=3)))
    assert np.allclose(boosting.values_at(np.zeros((2, 2)), flat), 24.5)


def days(spark, years=(1996, 1997, 1998, 1999), basins=(0,)):
    day = lambda y, i: dt.date(y, 6, 1) + dt.timedelta(i)
    q = lambda i: float(10 + i * 7 % 20)
    rows = [(b, day(y, i), q(i + b), float(i % 5), q(i + 1 + b)) for b in basins for y in years for i in range(100)]
    return spark.createDataFrame(rows, "basin int, d date, q double, x double, y_h1 double")


def test_models_are_apart_and_see_no_later_year(spark):
    feats = days(spark, basins=(0, 1))
    got = {(r.basin, r.val_year, r.d): r.pred for r in learning.walk_forward(feats, [1998, 1999], (1,), SMALL).where("candidate = 'histogram'").collect()}
    from pyspark.sql import functions as F

    changed = feats.withColumn("y_h1", F.when((F.year("d") >= 1998) | (F.col("basin") == 1), F.lit(1e6)).otherwise(F.col("y_h1")))
    other = {(r.basin, r.val_year, r.d): r.pred for r in learning.walk_forward(changed, [1998, 1999], (1,), SMALL).where("candidate = 'histogram'").collect()}
    assert all(other[k] == v for k, v in got.items() if k[0] == 0 and k[1] == 1998)
    assert any(other[k] != v for k, v in got.items() if k[0] == 0 and k[1] == 1999 and v is not None)


def test_selection_goes_on_over_the_folds(spark):
    got = learning.select_over_folds(days(spark), [1998, 1999], SMALL).collect()
    assert {(r.val_year, r.candidate) for r in got} == {(y, k) for y in (1998, 1999) for k in SMALL}
    assert all(r.inner_year == r.val_year - 1 and r.fold_n > 90 and r.fold_mae is not None and r.mae is not None for r in got)
    assert {r.gated for r in got} == {min((r.mae, list(SMALL).index(r.candidate), r.candidate) for r in got if r.val_year == 1998)[2]}
    # without another table for the folds the bound is the error itself
    assert all(abs(r.fold_mae - r.bound_mae) < 1e-12 for r in got)
    # what a later fold holds its inner season out of is the earlier fold's model
    by = {(r.val_year, r.candidate): r for r in got}
    assert all(by[1999, k].mae == by[1998, k].bound_mae for k in SMALL)


def test_shipping_on_every_season(spark):
    rows = [(b, y, c, "a", m, lag, rule) for b, wins in ((0, (1, 1)), (1, (1, 0)), (2, (0, 0))) for y, won in zip((1998, 1999), wins, strict=True) for c, m in (("a", 1.0 if won else 9.0), ("b", 0.5)) for lag, rule in [(5.0, 4.0 if b == 1 else 6.0)]]
    won = spark.createDataFrame(rows, "basin int, val_year int, candidate string, gated string, fold_mae double, lag_rule_mae double, forecast_rule_mae double")
    rules = won.select("basin", "val_year", "lag_rule_mae", "forecast_rule_mae").distinct()
    got = learning.ship_selected(learning.selection_wins(won.drop("lag_rule_mae", "forecast_rule_mae"), rules)).collect()
    assert {r.basin: (r.shipped, r.gated_wins, r.rule_wins, r.seasons) for r in got} == {0: ("a", 2, 0, 2), 1: ("forecast_rule", 1, 2, 2), 2: ("keep", 0, 0, 2)}


def test_ablation_reports_thin_folds(spark):
    from pyspark.sql import functions as F

    feats = days(spark).withColumn("e", F.when((F.year("d") < 1999) & (F.dayofyear("d") % 3 != 0), F.col("q")))
    got = {r.val_year: r for r in learning.ablation(feats, ["e"], [1996, 1998, 1999], learner=SMALL["histogram"]).collect()}
    assert got[1996].skipped == "few training rows" and got[1999].skipped == "thin coverage" and got[1998].skipped is None
    assert got[1998].n_train == 200 and got[1998].n_test == 100 and got[1998].plain is not None and got[1998].extra is not None
    assert got[1999].extra is None and got[1999].beats_plain is None
