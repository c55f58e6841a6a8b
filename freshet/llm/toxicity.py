"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows of toxic text and one on windows of ordinary text.
The length of a window, and whether the toxic dictionary is made of all toxic windows or of the marking words alone (found in
many toxic and few ordinary texts of the sample), are chosen by held-out loss. A window that the toxic dictionary
compresses to fewer bytes than the ordinary one, by a calibrated threshold, counts as toxic; a logistic curve in that count and the text's
length gives the score. Windows stand between two fixed strings that end both dictionaries: the
compressor does not look for matches in the last bytes of its input.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import whole_text

#: Labelled texts per class in the sample, and their characters, at most (about).
SAMPLE_TEXTS, SAMPLE_CHARS = 3000, 30_000_000
#: Words of a window that are tried.
WINDOWS = (1, 2, 4)
DICTIONARY = 8192
#: Windows that a dictionary is trained on, at most: an even spread over the texts.
TRAINED = 400_000
#: A marking word is in so many toxic texts (and, in the narrower rule, this share of them), and so many times more often than in ordinary ones.
LEAST_TEXTS, LEAST_SHARE, LEAST_RATIO = 8, 0.0125, 10
FRAME = b" 0123456789abcdefghijklmnopqrstuvwxyz 9876543210zyxwvutsrqponmlkjihgfedcba "
#: Windows whose distance a task remembers.
REMEMBERED = 1_000_000


def windows(text: str, words: int = 1) -> list[bytes]:
    w = text.lower().encode("utf-8", "surrogatepass").split()
    if words == 1:
        return w
    return [b" ".join(w[i : i + words]) for i in range(0, len(w), words)]


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """Trained on runs of six windows (shorter samples are ignored by the trainer); raw samples where there are too few to train on."""
    runs = [b" " + b" ".join(samples[i : i + 6]) + b" " for i in range(0, len(samples), 6)]
    if len(samples) > TRAINED:
        runs = [runs[i * len(samples) // TRAINED] for i in range(TRAINED // 6) if i * len(samples) // TRAINED < len(runs)]
    try:
        return zstandard.train_dictionary(size, runs, d=6, k=16).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(dict.fromkeys(samples))[-size:]


class Distance:
    """Compressed length under the ordinary dictionary minus that under the toxic one."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = toxic, ordinary
        self._ready = None
        self._known: dict[bytes, int] = {}

    def __getstate__(self):
        return {"toxic": self.toxic, "ordinary": self.ordinary, "_ready": None, "_known": {}}

    def _compressors(self):
        p = zstandard.ZstdCompressionParameters(
            window_log=15, chain_log=12, hash_log=12, search_log=6, min_match=4, target_length=64, strategy=zstandard.STRATEGY_LAZY,
            write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )
        kinds = [zstandard.ZstdCompressionDict(d + FRAME, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for d in (self.ordinary, self.toxic)]
        return [zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress for d in kinds]

    def of(self, found: list[bytes]) -> np.ndarray:
        if self._ready is None:
            self._ready = self._compressors()
        if len(self._known) > REMEMBERED:
            self._known.clear()
        known, (plain, toxic) = self._known, self._ready
        for w in set(found):
            if w not in known:
                framed = FRAME + w + FRAME
                known[w] = len(plain(framed)) - len(toxic(framed))
        return np.array([known[w] for w in found], np.int64)


class Toxicity:
    def __init__(self, distance: Distance, threshold: int, weights: np.ndarray, words: int = 1, tried: list[dict] | None = None):
        self.distance, self.threshold, self.weights, self.words = distance, threshold, weights, words
        #: What was tried: words of a window, rule, held-out loss and recall.
        self.tried = [] if tried is None else tried

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        n = np.zeros((len(texts), 2))
        for i, t in enumerate(texts):
            d = self.distance.of(windows(t, self.words))
            n[i] = (d >= self.threshold).sum(), len(d)
        return 1 / (1 + np.exp(-_inputs(n[:, 0], n[:, 1]) @ self.weights)), n[:, 0]


def _inputs(over: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(n)), np.minimum(over, 3), over / np.sqrt(n + 1.0), np.log1p(over)], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Newton steps for a ridge logistic regression; gives the weights and the mean log loss."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * (weight * p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * w)
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-9, 1 - 1e-9)
    return w, float(-(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum())


def sample(docs: DataFrame, labels: DataFrame, label: str, allowed, doc_id: str = "doc_id", text: str = "text", most: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> pd.DataFrame:
    """text, y: distinct labelled texts of allowed ids, about ``most`` and ``chars`` per class, picked by a hash of the id."""
    wanted = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).where(allowed).select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y"))
    pick = F.pmod(F.xxhash64(F.lit("pick"), "id"), F.lit(1_000_000))
    sizes = {r.y: r.n for r in wanted.groupBy("y").agg(F.count("*").alias("n")).collect()}
    # the id list is cut to a bounded length first, so it may be broadcast
    few = wanted.where(pick < F.coalesce(*[F.when(F.col("y") == y, F.lit(int(1e6 * min(1.0, most / n)))) for y, n in sorted(sizes.items())], F.lit(0))).distinct()
    d = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).where("text is not null").join(F.broadcast(few), "id")
    total = {r.y: r.n for r in d.groupBy("y").agg(F.sum(F.length("text")).alias("n")).collect()}
    part = {y: int(1e6 * min(1.0, chars / max(1, n))) for y, n in total.items()}
    thin = F.pmod(F.xxhash64(F.lit("thin"), "id"), F.lit(1_000_000))
    d = d.where(thin < F.coalesce(*[F.when(F.col("y") == y, F.lit(n)) for y, n in sorted(part.items())], F.lit(0)))
    got = d.select("id", "text", "y").toPandas().sort_values("id")
    return got.drop_duplicates("text")[["text", "y"]].reset_index(drop=True)


def fit(texts: pd.DataFrame) -> Toxicity | None:
    """From text, y (1 toxic): two thirds train the dictionaries, one third calibrates. None if a class is missing."""
    third = np.arange(len(texts)) % 3 == 2
    train, held = texts[~third], texts[third]
    if set(train["y"]) != {0, 1} or held["y"].nunique() < 2:
        return None
    y = held["y"].to_numpy(float)
    best, tried = None, []
    for words in WINDOWS:
        groups = {k: [windows(t, words) for t in train[train["y"] == k]["text"]] for k in (0, 1)}
        ordinary = _dictionary([w for doc in groups[0] for w in doc], DICTIONARY)
        ways = {"all toxic text": [w for doc in groups[1] for w in doc]}
        if words == 1:
            ways |= {"marking words": _marks(groups, 0.0), "frequent marking words": _marks(groups, LEAST_SHARE)}
        for rule, samples in ways.items():
            distance = Distance(_dictionary(samples, DICTIONARY), ordinary)
            found = [distance.of(windows(t, words)) for t in held["text"]]
            of_rule = None
            for threshold in range(1, 9):
                x = _inputs(np.array([(d >= threshold).sum() for d in found], float), np.array([len(d) for d in found], float))
                w, loss = _logistic(x, y, np.ones(len(y)))
                if of_rule is None or loss < of_rule[0]:
                    of_rule = loss, float((x @ w >= 0)[y == 1].mean()), Toxicity(distance, threshold, w, words, tried)
            tried.append({"words": words, "rule": rule, "loss": of_rule[0], "recall": of_rule[1]})
            if best is None or of_rule[0] < best[0]:
                best = of_rule
    return best[2]


def _marks(groups: dict[int, list[list[bytes]]], share: float) -> list[bytes]:
    in_toxic, in_plain = (Counter(w for doc in groups[y] for w in set(doc)) for y in (1, 0))
    nt, n0 = len(groups[1]), len(groups[0])
    marking = {w for w, n in in_toxic.items() if n >= max(LEAST_TEXTS, share * nt) and n / nt > LEAST_RATIO * (in_plain[w] + 1) / n0}
    return [w for doc in groups[1] for w in doc if w in marking]


def score(docs: DataFrame, model: Toxicity | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, toxic_windows for every row, from the whole text; null texts count as empty, without a model the score is 0."""
    d = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    if model is None:
        return d.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("toxic_windows"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        m = shared.value
        for b in batches:
            s, n = m.score(b["text"].tolist())
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": s, "toxic_windows": n.astype(np.int64)})

    return d.mapInPandas(scored, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, score double, toxic_windows long")
