"""Language identification by interpolated Kneser-Ney models over characters.

One model per language, fitted on a bounded sample of labelled texts: Spark counts the longest
n-grams, and the bounded count table becomes sorted arrays of hashes with interpolated log probabilities and
backoff weights. A text gets the language with the lowest cross-entropy per character. Entropies of
texts left out of the fit give the scale of the score and, per language, the entropy above which a text is
rejected as unlike any learned language.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.arrays import lookup, mixed
from freshet.llm.common import crc_fold, whole_text
from freshet.session import cut_lineage

ORDER = 4
#: Different labelled texts per language that the models and their calibration are fitted on, at most (about).
SAMPLE = 2000
#: Share of known texts that calibration may reject.
REJECT = 0.001
#: Characters handled at once.
CHUNK = 1 << 20
UNKNOWN = "und"
_BASE = np.uint64(0xD6E8FEB86659FD93)


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _streams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, rows): lower-case letters with single blanks, ORDER - 1 blanks before each text.

    Texts longer than a chunk come in pieces; each piece starts anew, which changes three of a million contexts.
    """
    part, rows, size = [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, len(t), CHUNK):
            low = t[at : at + CHUNK].lower()
            part.append(low)
            rows.append(i)
            size += len(low)
            if size >= CHUNK:
                yield _stream(part, rows)
                part, rows, size = [], [], 0
    if part:
        yield _stream(part, rows)


def _stream(part: list[str], rows: list[int]) -> tuple[np.ndarray, np.ndarray]:
    pad = " " * (ORDER - 1)
    joined = "".join(x for p in part for x in (pad, p, " "))
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(p) for p in part]) + ORDER
    row = np.repeat(np.array(rows), lengths)
    start = np.cumsum(lengths) - lengths
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    for k in range(ORDER - 1):
        keep[start + k] = True
    return np.where(letter, codes, 32)[keep].astype(np.uint32), row[keep]


def _windows(codes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and end position of each window of ORDER codes inside one text piece, and its row."""
    n = len(codes) - ORDER + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(ORDER):
        h = h * _BASE + codes[k : k + n] + np.uint64(1)
    last = np.arange(n) + ORDER - 1
    # windows that reach into the next piece's leading blanks end in a blank that is not a text's own
    ok = (rows[last] == rows[last - ORDER + 1]) & ((codes[last] != 32) | (codes[last - 1] != 32))
    return mixed(h[ok]), last[ok], rows[last[ok]]


def hashed(grams: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of character codes."""
    h = np.zeros(len(grams), np.uint64)
    for k in range(grams.shape[1]):
        h = h * _BASE + grams[:, k] + np.uint64(1)
    return mixed(h)


class KneserNey:
    """Interpolated Kneser-Ney from the counts of the longest n-grams (rows of codes)."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        levels = [(grams, counts.astype(float))]
        for _ in range(ORDER - 1):
            _, first, kinds = np.unique(hashed(levels[0][0][:, 1:]), return_index=True, return_counts=True)
            levels.insert(0, (levels[0][0][first][:, 1:], kinds.astype(float)))
        self.keys, self.log_p, self.contexts, self.backoff = [], [], [], []
        lower = np.full(1, 1 / (len(levels[0][0]) + 1))  # uniform, with one place for unseen characters
        self.unseen = float(np.log(lower[0]))
        lower_keys = None
        for g, c in levels:
            once, twice = (c == 1).sum(), (c == 2).sum()
            d = once / (once + 2 * twice) if once else 0.5
            ctx, inverse = np.unique(hashed(g[:, :-1]), return_inverse=True)
            total, kinds = np.bincount(inverse, c), np.bincount(inverse)
            weight = d * kinds / total
            below = lower[0] if lower_keys is None else lower[lookup(lower_keys, hashed(g[:, 1:]))[0]]
            p = (c - d) / total[inverse] + weight[inverse] * below
            keys = hashed(g)
            order = np.argsort(keys)
            self.keys.append(keys[order])
            self.log_p.append(np.log(p[order]))
            self.contexts.append(ctx)
            self.backoff.append(np.log(weight))
            lower, lower_keys = p[order], keys[order]

    def log_probs(self, grams: np.ndarray) -> np.ndarray:
        """log P(last code | the codes before it) of each row."""
        out, left = np.zeros(len(grams)), np.arange(len(grams))
        for n in range(ORDER, 0, -1):
            g = grams[left, ORDER - n :]
            place, there = lookup(self.keys[n - 1], hashed(g))
            out[left[there]] += self.log_p[n - 1][place[there]]
            left, g = left[~there], g[~there]
            place, there = lookup(self.contexts[n - 1], hashed(g[:, :-1]))
            out[left[there]] += self.backoff[n - 1][place[there]]
        out[left] += self.unseen
        return out


class Languages:
    """The models, and what calibration found."""

    def __init__(self, models: dict[str, KneserNey]):
        self.names = sorted(models)
        self.models = [models[k] for k in self.names]
        self.scale, self.limits = 1.0, {k: np.inf for k in self.names}

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per character of each text under each language, characters); no letters: 0 characters."""
        total, n = np.zeros((len(texts), len(self.models))), np.zeros(len(texts))
        for codes, rows in _streams(texts):
            h, last, row = _windows(codes, rows)
            _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            grams = codes[last[first][:, None] + np.arange(-ORDER + 1, 1)] if len(h) else np.zeros((0, ORDER), np.uint32)
            for k, m in enumerate(self.models):
                total[:, k] -= np.bincount(row, m.log_probs(grams)[inverse], len(texts))
            n += np.bincount(row, minlength=len(texts))
        return total / np.maximum(n, 1)[:, None], n

    def shares(self, entropy: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Probability of each language: softmax of the entropies, sharper for longer texts."""
        z = -entropy * (np.sqrt(n) * self.scale)[:, None]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def calibrate(self, names: np.ndarray, entropy: np.ndarray, n: np.ndarray, reject: float = REJECT) -> None:
        """Scale by log loss over a grid; per language the entropy that ``1 - reject`` of its own texts stay under, and a tenth."""
        ok = n > 0
        at, entropy, n = np.array([self.names.index(x) for x in names[ok]], int), entropy[ok], n[ok]
        if len(at):

            def loss(scale: float) -> float:
                self.scale = scale
                return float(-np.log(np.maximum(self.shares(entropy, n)[np.arange(len(at)), at], 1e-9)).mean())

            self.scale = min((0.1, 0.2, 0.5, 1.0, 2.0, 5.0, 10.0), key=loss)
            self.limits |= {k: float(np.quantile(entropy[at == i, i], 1 - reject)) * 1.1 for i, k in enumerate(self.names) if (at == i).any()}


def sampled(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """text, lang, fold: about ``sample`` different texts of each language, each once however often it is copied.

    Fold 0 is for calibration; a language of fewer than ten texts in all has none there.
    """
    d = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    key = F.xxhash64("text")
    sizes = {r.lang: r.n for r in d.select("lang", key.alias("key")).distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()}
    parts = 1_000_000_000_000
    at = lambda f: F.coalesce(*[F.when(F.col("lang") == k, F.lit(f(n))) for k, n in sorted(sizes.items())], F.lit(0))
    d = d.where(F.pmod(key, F.lit(parts)) < at(lambda n: int(parts * min(1.0, sample / n)))).distinct()
    return d.withColumn("fold", F.when(at(lambda n: int(n >= 10)) == 1, F.pmod(F.xxhash64(F.lit("fold"), "text"), F.lit(10))).otherwise(1))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Languages:
    """Learns from the different texts with a language; one in ten of the sample is kept for calibration.

    Sizes: ``sample`` texts per language bound the count table that reaches the driver.
    """
    d = cut_lineage(sampled(docs, text, lang, sample))

    def counted(batches):
        for b in batches:
            for lang, group in b.groupby("lang"):
                for codes, rows in _streams(group["text"].tolist()):
                    h, last, _ = _windows(codes, rows)
                    _, first, n = np.unique(h, return_index=True, return_counts=True)
                    grams = codes[last[first][:, None] + np.arange(-ORDER + 1, 1)]
                    yield pd.DataFrame({"lang": lang, **{f"c{k}": grams[:, k].astype(np.int32) for k in range(ORDER)}, "n": n})

    codes = [f"c{k}" for k in range(ORDER)]
    counts = d.where("fold > 0").select("text", "lang").mapInPandas(counted, f"lang string, {', '.join(f'{c} int' for c in codes)}, n long")
    got = counts.groupBy("lang", *codes).agg(F.sum("n").alias("n")).toPandas()
    found = Languages({k: KneserNey(g[codes].to_numpy().astype(np.uint32), g["n"].to_numpy()) for k, g in got.groupby("lang")})
    if not found.names:
        return found
    held = d.where("fold = 0").select("text", "lang").mapInPandas(lambda batches: _entropies(batches, found), "lang string, n double, e array<double>").toPandas()
    held = held[held["lang"].isin(found.names)]
    if len(held):
        found.calibrate(held["lang"].to_numpy(), np.stack(held["e"].to_list()), held["n"].to_numpy())
    return found


def _entropies(batches, found: Languages):
    for b in batches:
        e, n = found.entropies(b["text"].tolist())
        yield pd.DataFrame({"lang": b["lang"], "n": n, "e": list(e)})


def identify(docs: DataFrame, found: Languages, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, entropy, rejected for every row, from the whole text alone.

    Null texts and texts without letters are ``und`` with score 0, and so is every text if no language was
    learned. Ties go to the first language by name. ``rejected`` marks texts above the language's limit.
    """
    model = docs.sparkSession.sparkContext.broadcast(found)

    def predicted(batches):
        langs = model.value
        for b in batches:
            e, n = langs.entropies(b["text"].tolist())
            out = pd.DataFrame({"doc_id": b["doc_id"], "lang_pred": UNKNOWN, "score": 0.0, "entropy": np.nan, "rejected": False})
            at = np.flatnonzero(n > 0)
            if langs.names and len(at):
                best = e[at].argmin(axis=1)
                lowest = e[at, best]
                out.loc[at, "lang_pred"] = np.array(langs.names, object)[best]
                out.loc[at, "score"] = langs.shares(e[at], n[at])[np.arange(len(at)), best]
                out.loc[at, "entropy"] = lowest
                out.loc[at, "rejected"] = lowest > np.array([langs.limits[k] for k in langs.names])[best]
            yield out

    d = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInPandas(predicted, f"doc_id {kind}, lang_pred string, score double, entropy double, rejected boolean")


def held_out(doc_id: str = "doc_id"):
    return crc_fold(doc_id, 3) == 1
