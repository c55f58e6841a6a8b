"""Quality classification by a factorisation machine.

Inputs are hashed words, structure statistics and metadata. A pair of inputs interacts through the
product of their factor vectors; all pairs are summed in linear time as half of (sum of v x) squared minus
sum of (v x) squared, per factor. Fitted on a bounded sample by Adagrad, scored in Arrow batches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.arrays import Words, slices
from freshet.llm.common import whole_text

BUCKETS, FACTORS = 1 << 16, 6
EPOCHS, BATCH, RATE, DECAY = 12, 128, 0.05, 1e-5
STATISTICS = ("words", "word_length", "upper", "digits", "symbols", "punctuation", "line_ends", "distinct", "top", "marks")


def _class(*bytes_: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in "".join(bytes_)]] = True
    return out


_KINDS = {"upper": _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": _class("0123456789"), "symbols": _class("#*$%&|<>"), "punctuation": _class(".,;:?"), "line_ends": _class("\n"), "marks": _class("!")}


def features(texts: list[str], metadata: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, input number, value) of each non-zero input; rows come in order.

    Words: bucket of the lower-case word's hash, 1 + log of its count, scaled to length one. Statistics: in 0..1, each
    as five steps so that weights can fit a curve.
    """
    n = len(texts)
    sums = {k: np.zeros(n) for k in ("chars", "words", "word_bytes", *_KINDS)}
    rows, buckets = [], []
    for part_rows, parts in slices(texts):
        r = np.array(part_rows)
        plain, low = Words(parts), Words(parts, lower=True)
        of = np.repeat(r, np.diff(plain.offsets))
        sums["chars"] += np.bincount(of, minlength=n)
        for k, kind in _KINDS.items():
            sums[k] += np.bincount(of[kind[plain.raw]], minlength=n)
        sums["words"] += np.bincount(r[plain.rows], minlength=n)
        sums["word_bytes"] += np.bincount(r[plain.rows], plain.ends - plain.starts, n)
        keys, counts = np.unique(r[low.rows] * BUCKETS + (low.hashes % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
        rows.append(keys)
        buckets.append(counts)
    keys, inverse = np.unique(np.concatenate([*rows, np.zeros(0, np.int64)]), return_inverse=True)
    counts = np.bincount(inverse, np.concatenate([*buckets, np.zeros(0)]), len(keys))
    row, value = keys // BUCKETS, 1 + np.log(np.maximum(counts, 1))
    value /= np.sqrt(np.bincount(row, value**2, n))[row]
    words, chars = np.maximum(sums["words"], 1), np.maximum(sums["chars"], 1)
    top = np.zeros(n)
    np.maximum.at(top, row, counts)
    s = np.stack([
        np.log1p(sums["words"]) / 12, sums["word_bytes"] / words / 20, sums["upper"] / chars, 5 * sums["digits"] / chars, 5 * sums["symbols"] / chars, 5 * sums["punctuation"] / chars,
        20 * np.maximum(sums["line_ends"] - 1, 0) / chars, np.bincount(row, minlength=n) / words, top / words, 5 * sums["marks"] / chars,
    ], axis=1)
    if metadata is not None:
        s = np.concatenate([s, metadata], axis=1)
    s = np.nan_to_num(np.clip(s, 0, 1))
    steps = np.clip(s[:, :, None] * 5 - np.arange(5), 0, 1).reshape(n, 5 * s.shape[1])
    r, c = np.nonzero(steps)
    row, inputs, value = np.concatenate([row, r]), np.concatenate([keys % BUCKETS, BUCKETS + c]), np.concatenate([value, steps[r, c]])
    order = np.argsort(row, kind="stable")
    return row[order], inputs[order], value[order]


class Machine:
    def __init__(self, inputs: int, factors: int = FACTORS, seed: int = 7):
        self.bias, self.w = 0.0, np.zeros(inputs)
        self.v = np.random.default_rng(seed).normal(0, 0.02, (inputs, factors))

    def margin(self, row: np.ndarray, at: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        return self._margin(row, at, x, n)[0]

    def _margin(self, row, at, x, n):
        linear = np.bincount(row, self.w[at] * x, n)
        vx = self.v[at] * x[:, None]
        total = np.stack([np.bincount(row, vx[:, k], n) for k in range(vx.shape[1])], axis=1)
        squares = np.bincount(row, (vx**2).sum(axis=1), n)
        return self.bias + linear + 0.5 * ((total**2).sum(axis=1) - squares), total

    def fit(self, row, at, x, y, epochs: int = EPOCHS, seed: int = 11) -> Machine:
        """Adagrad on the log loss, classes weighted alike."""
        n = len(y)
        start = np.searchsorted(row, np.arange(n + 1))
        weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6))
        gw, gv, gb = np.full(len(self.w), 1e-6), np.full(self.v.shape, 1e-6), 1e-6
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            order = rng.permutation(n)
            for k in range(0, n, BATCH):
                some = order[k : k + BATCH]
                entries = np.concatenate([np.arange(start[i], start[i + 1]) for i in some])
                r = np.repeat(np.arange(len(some)), start[some + 1] - start[some])
                a, z = at[entries], x[entries]
                m, total = self._margin(r, a, z, len(some))
                err = weight[some] * (1 / (1 + np.exp(-np.clip(m, -30, 30))) - y[some]) / len(some)
                used, inverse = np.unique(a, return_inverse=True)
                dw = np.bincount(inverse, err[r] * z, len(used)) + DECAY * self.w[used]
                dv = (err[r] * z)[:, None] * (total[r] - self.v[a] * z[:, None])
                dv = np.stack([np.bincount(inverse, dv[:, f], len(used)) for f in range(dv.shape[1])], axis=1) + DECAY * self.v[used]
                gw[used] += dw**2
                gv[used] += dv**2
                gb += err.sum() ** 2
                self.w[used] -= RATE * dw / np.sqrt(gw[used])
                self.v[used] -= RATE * dv / np.sqrt(gv[used])
                self.bias -= RATE * err.sum() / np.sqrt(gb)
        return self


class Quality:
    """A fitted machine with the slope and shift that bring its margins to probabilities."""

    def __init__(self, machine: Machine, slope: float, shift: float):
        self.machine, self.slope, self.shift = machine, slope, shift

    def score(self, texts: list[str], metadata: np.ndarray | None = None) -> np.ndarray:
        m = self.machine.margin(*features(texts, metadata), len(texts))
        return 1 / (1 + np.exp(-np.clip(self.slope * m + self.shift, -30, 30)))


def fit(texts: pd.DataFrame, metadata: list[str] = ()) -> Quality | None:
    """From text, y (1 good) and metadata columns in 0..1. A fifth of the sample calibrates. None if a class is missing."""
    from freshet.llm.toxicity import _logistic

    meta = texts[list(metadata)].to_numpy(float) if metadata else None
    row, at, x = features(texts["text"].tolist(), meta)
    y = texts["y"].to_numpy(float)
    held = np.arange(len(y)) % 5 == 4
    if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
        return None
    number = np.cumsum(~held) - 1
    keep = ~held[row]
    machine = Machine(BUCKETS + 5 * (len(STATISTICS) + len(metadata))).fit(number[row[keep]], at[keep], x[keep], y[~held])
    m = machine.margin(row, at, x, len(y))[held]
    (shift, slope), _ = _logistic(np.stack([np.ones(len(m)), m], axis=1), y[held], np.where(y[held] > 0, 0.5 / y[held].mean(), 0.5 / (1 - y[held].mean())))
    return Quality(machine, float(slope), float(shift))


def score(docs: DataFrame, model: Quality | None, doc_id: str = "doc_id", text: str = "text", metadata: list[str] = ()) -> DataFrame:
    """doc_id, score for every row from its whole text (and metadata columns); null texts count as empty, without a model the score is 1."""
    d = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"), *[F.col(c).cast("double").alias(f"m{i}") for i, c in enumerate(metadata)])
    if model is None:
        return d.select("doc_id", F.lit(1.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    k = len(metadata)

    def scored(batches):
        for b in batches:
            out = np.zeros(len(b))
            texts = b["text"].tolist()
            meta = b[[f"m{i}" for i in range(k)]].to_numpy(float) if k else None
            for i in range(0, len(texts), 500):
                out[i : i + 500] = shared.value.score(texts[i : i + 500], meta[i : i + 500] if k else None)
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": out})

    return d.mapInPandas(scored, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, score double")


def probability(docs: DataFrame, model: Quality | None, text: str = "text"):
    """The score as a column, for filters that keep all columns of ``docs``."""
    if model is None:
        return F.lit(1.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        t = texts.tolist()
        return pd.Series(np.concatenate([np.zeros(0), *[shared.value.score(t[i : i + 500]) for i in range(0, len(t), 500)]]))

    return scored(whole_text(text))
