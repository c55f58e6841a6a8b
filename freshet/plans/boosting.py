"""Boosted regression trees grown from histograms, one model per group of rows.

Features are binned once per model. A tree is grown from sums of gradients and curvature per node, feature
and bin, always at the leaf whose best split gains most; nulls go to the side that gains more. All models of a
plan (every basin, fold, horizon and learner) are groups of one shuffle and are fitted side by side;
a group holds one row per day of its basin, so the calendar bounds it. A fitted model is a
table with one row per tree, so it can be written and read like any other.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Learner:
    """How a model is grown; the defaults are those of the first learner (fixed values of the published models)."""

    rounds: int = 400
    rate: float = 0.05
    leaves: int | None = 31
    depth: int | None = None
    least_rows: int = 20
    #: Added to the curvature of a leaf, which shrinks its value and the gain of a split.
    shrink: float = 0.0
    #: Share of the rows that a round looks at.
    share: float = 1.0
    bins: int = 255
    seed: int = 0


HISTOGRAM = Learner()
SECOND_ORDER = Learner(leaves=None, depth=4, least_rows=1, shrink=1.0, share=0.9)

TREE = [
    ("tree", T.IntegerType()), ("feature", T.ArrayType(T.IntegerType())), ("cut", T.ArrayType(T.DoubleType())),
    ("null_left", T.ArrayType(T.BooleanType())), ("left", T.ArrayType(T.IntegerType())), ("right", T.ArrayType(T.IntegerType())), ("value", T.ArrayType(T.DoubleType())),
]


def bin_edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Upper ends of all bins: between neighbouring values, or quantiles if there are too many; the last has no end.

    A cut at the last bin parts what is known from the nulls.
    """
    values = np.unique(column[~np.isnan(column)])
    if len(values) <= bins:
        inner = (values[:-1] + values[1:]) / 2
    else:
        inner = np.unique(np.quantile(values, np.arange(1, bins) / bins))
    return np.append(inner, np.inf)


class Grower:
    """Bins of one training table and the trees grown on it."""

    def __init__(self, x: np.ndarray, how: Learner):
        self.x, self.how, self.width = x, how, how.bins + 1
        self.edges = [bin_edges(x[:, f], how.bins) for f in range(x.shape[1])]
        codes = [np.where(np.isnan(x[:, f]), how.bins, np.searchsorted(e, x[:, f], "left")) for f, e in enumerate(self.edges)]
        # each feature has its own range of numbers, so one count serves all features
        self.codes = np.stack(codes, axis=1).astype(np.int64) + np.arange(x.shape[1]) * self.width if codes else np.zeros((len(x), 0), np.int64)

    def _sums(self, rows: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        """(2, features, bins): gradients and rows. Squared error curves by one per row, so rows are also the curvature."""
        features = self.codes.shape[1]
        at, size = self.codes[rows].ravel(), features * self.width
        out = np.empty((2, size))
        out[0], out[1] = np.bincount(at, np.repeat(gradient[rows], features), size), np.bincount(at, minlength=size)
        return out.reshape(2, features, self.width)

    def best_split(self, sums: np.ndarray) -> tuple[float, int, int, bool] | None:
        """(gain, feature, last bin to the left, nulls to the left) of the split that gains most."""
        if not sums.shape[1]:
            return None
        shrink, least = self.how.shrink, self.how.least_rows
        slope, rows = sums[:, 0, :].sum(axis=1)
        if rows < 2 * least:
            return None
        known, nulls = sums[:, :, :-1].cumsum(axis=2), sums[:, :, -1:]
        whole, best = slope * slope / (rows + shrink), None
        for null_left in (False, True) if nulls[1].any() else (False,):
            s, n = known + nulls if null_left else known
            few = (n < least) | (n > rows - least)
            gain = s * s / np.maximum(n + shrink, 1e-9) + (slope - s) ** 2 / np.maximum(rows - n + shrink, 1e-9)
            gain[few] = -1.0
            at = int(gain.argmax())
            f, b = divmod(at, self.width - 1)
            won = float(gain[f, b] - whole)
            if won > 1e-9 * max(whole, 1e-9) and (best is None or won > best[0]):
                # where no nulls were seen they follow the larger side
                best = (won, f, b, null_left if nulls[1, f, 0] else bool(2 * n[f, b] > rows))
        return best

    def tree(self, rows: np.ndarray, gradient: np.ndarray) -> dict[str, list]:
        how, nodes = self.how, {n: [] for n, _ in TREE[1:]}
        waiting: list = []

        def add(rows: np.ndarray, sums: np.ndarray, depth: int) -> int:
            node = len(nodes["value"])
            step = -how.rate * gradient[rows].sum() / (len(rows) + how.shrink)
            for name, v in (("feature", -1), ("cut", 0.0), ("null_left", False), ("left", -1), ("right", -1), ("value", float(step))):
                nodes[name].append(v)
            split = self.best_split(sums) if how.depth is None or depth < how.depth else None
            if split:
                heapq.heappush(waiting, (-split[0], node, depth, rows, sums, split))
            return node

        add(rows, self._sums(rows, gradient), 0)
        leaves = 1
        while waiting and (how.leaves is None or leaves < how.leaves):
            _, node, depth, rows, sums, (_, f, b, null_left) = heapq.heappop(waiting)
            code = self.codes[rows, f] - f * self.width
            goes_left = (code <= b) | ((code == how.bins) & null_left)
            parts = rows[goes_left], rows[~goes_left]
            small = int(len(parts[0]) > len(parts[1]))
            less = self._sums(parts[small], gradient)
            both = (less, sums - less) if small == 0 else (sums - less, less)
            nodes["feature"][node], nodes["cut"][node], nodes["null_left"][node] = f, float(self.edges[f][b]), null_left
            nodes["left"][node], nodes["right"][node] = (add(p, s, depth + 1) for p, s in zip(parts, both, strict=True))
            leaves += 1
        return nodes


def values_at(x: np.ndarray, trees: list[dict[str, list]]) -> np.ndarray:
    """Sum of the leaf values that each row of ``x`` reaches, all trees at once."""
    starts = np.cumsum([0, *(len(t["value"]) for t in trees)])[:-1]
    flat = {n: np.concatenate([np.asarray(t[n]) for t in trees]) for n, _ in TREE[1:]}
    shift = np.repeat(starts, [len(t["value"]) for t in trees])
    left, right = flat["left"] + shift, flat["right"] + shift
    at, row = np.tile(starts, (len(x), 1)), np.arange(len(x))[:, None]
    while (flat["feature"][at] >= 0).any():
        f = flat["feature"][at]
        v = x[row, np.maximum(f, 0)]
        goes_left = np.where(np.isnan(v), flat["null_left"][at], v <= flat["cut"][at])
        at = np.where(f < 0, at, np.where(goes_left, left[at], right[at]))
    return flat["value"][at].sum(axis=1)


def boost(x: np.ndarray, y: np.ndarray, how: Learner) -> Iterator[dict[str, list]]:
    """The trees of one model for squared error; the first is the mean of ``y``."""
    yield {"feature": [-1], "cut": [0.0], "null_left": [False], "left": [-1], "right": [-1], "value": [float(y.mean())]}
    grower, at, rng = Grower(x, how), np.full(len(y), y.mean()), np.random.default_rng(how.seed)
    for _ in range(how.rounds):
        rows = np.arange(len(y)) if how.share >= 1 else np.flatnonzero(rng.random(len(y)) < how.share)
        if not len(rows):
            continue
        tree = grower.tree(rows, at - y)
        at = at + values_at(x, [tree])
        yield tree


def fit(train: DataFrame, keys: list[str], cols: list[str], target: str, learners: dict[str, Learner]) -> DataFrame:
    """keys, candidate and one row per tree, for each group of ``keys`` and each learner.

    Rows without a target are left out, null and NaN features are nulls; a group without rows has no
    model. The rows of a group are brought into one order first, so that fits agree from run to run.
    """
    rows = train.where(F.col(target).isNotNull()).select(*keys, *[F.col(c).cast("double").alias(c) for c in cols], F.col(target).cast("double").alias(target))
    rows = rows.withColumn("candidate", F.explode(F.array(*[F.lit(k) for k in learners])))
    fields = [f for f in rows.schema.fields if f.name in (*keys, "candidate")]

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values([*cols, target], kind="stable")
        how = learners[group["candidate"].iloc[0]]
        trees = boost(group[cols].to_numpy(float), group[target].to_numpy(float), how)
        out = pd.DataFrame([{"tree": i, **t} for i, t in enumerate(trees)])
        for f in fields:
            out[f.name] = group[f.name].iloc[0]
        return out[[f.name for f in fields] + [n for n, _ in TREE]]

    schema = T.StructType(fields + [T.StructField(n, t) for n, t in TREE])
    return rows.groupBy(*keys, "candidate").applyInPandas(grow, schema)


def predict(models: DataFrame, rows: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """``rows`` once per model of their group, with candidate and ``pred``; rows of groups without a model are left out."""
    asked = rows.withColumns({c: F.col(c).cast("double") for c in cols})
    fields = asked.schema.fields

    def ask(trees: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for candidate, own in trees.groupby("candidate", sort=True):
            x = group[cols].to_numpy(float)
            got = values_at(x, own.sort_values("tree").to_dict("records")) if len(x) else np.zeros(0)
            parts.append(group.assign(candidate=candidate, pred=got))
        return pd.concat(parts) if parts else group.assign(candidate="", pred=0.0).iloc[:0]

    schema = T.StructType([*fields, T.StructField("candidate", T.StringType()), T.StructField("pred", T.DoubleType())])
    return models.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(ask, schema)
