"""Language-model scoring by a subword lattice.

The pieces of an existing vocabulary are the arcs of a lattice over each word (with its leading word
mark). The score of a text is its marginal probability: the forward recursion sums over all
segmentations in log space. Piece probabilities come from the vocabulary's own scores as a prior
and from how often the training texts use each piece. Words do not share pieces, so a
word's marginal is computed once for the whole corpus; texts then look words up. The most frequent
words, a bounded number, travel to the tasks as sorted hash arrays; all others are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.arrays import Words, lookup, mixed, powers, slices
from freshet.llm.common import crc_fold, whole_text
from freshet.session import cut_lineage

MARK = "▁"
#: Most frequent words that go to every task, at most.
HEAD_WORDS = 500_000
#: Weight, in pieces, of the vocabulary's own scores against counts.
PRIOR = 1000.0
LN10 = float(np.log(10))


class Pieces:
    """Sorted hashes of a vocabulary's pieces with their log probabilities, and byte fallbacks."""

    def __init__(self, path: str, counts: dict[int, int], ends: int):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        ranks = np.array([-sp.get_score(i) for i in range(n)], float)
        byte_ids = np.array([i for i in range(n) if sp.is_byte(i)])
        special = np.array([sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)])
        ranks[byte_ids] = ranks.max() + 1
        prior = np.where(special, 0.0, 1 / (10 + ranks - ranks[~special].min()))
        seen = np.zeros(n + 1)
        for i, c in counts.items():
            seen[i] = 0 if special[i] else c
        seen[n] = ends  # the end of a text
        prior = np.append(prior, prior.max())
        log_p = np.log(np.maximum(seen + PRIOR * prior / prior.sum(), 1e-300) / (seen.sum() + PRIOR))
        self.end = float(log_p[n])
        self.bytes = log_p[byte_ids]
        self.byte_of = {int(sp.id_to_piece(int(i))[1:-1], 16): k for k, i in enumerate(byte_ids)}
        texts = [(sp.id_to_piece(i), i) for i in range(n) if not special[i] and not sp.is_byte(i)]
        texts = [(t, i) for t, i in texts if MARK not in t[1:]]
        self.longest = max(len(t) for t, _ in texts)
        hashes = np.array([self._hash(t) for t, _ in texts], np.uint64)
        order = np.argsort(hashes)
        self.keys, self.log_p = hashes[order], log_p[[i for _, i in texts]][order]

    @staticmethod
    def _hash(t: str) -> np.uint64:
        c = np.frombuffer(t.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        return mixed(np.array([(c * powers(len(c))[: len(c)]).sum()], np.uint64))[0]

    def fallback(self, code: int) -> float:
        return float(sum(self.bytes[self.byte_of[b]] for b in chr(code).encode("utf-8", "surrogatepass")))

    def marginals(self, words: list[str]) -> np.ndarray:
        """Natural log of the probability of each word, summed over all its segmentations."""
        out = np.zeros(len(words))
        marked = [MARK + w for w in words]
        lengths = np.array([len(w) for w in marked])
        for size in np.unique(lengths):
            at = np.flatnonzero(lengths == size)
            step = max(1, 400_000 // int(size))
            for k in range(0, len(at), step):
                some = at[k : k + step]
                joined = "".join([marked[i] for i in some]).encode("utf-32-le", "surrogatepass")
                out[some] = self._forward(np.frombuffer(joined, np.uint32).reshape(len(some), size))
        return out

    def _forward(self, codes: np.ndarray) -> np.ndarray:
        n, size = codes.shape
        run = np.zeros((n, size + 1), np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers(size)[:size], axis=1, out=run[:, 1:])
        back = powers(size, True)[: size + 1]
        arcs = []
        for k in range(1, min(size, self.longest) + 1):
            h = mixed((run[:, k:] - run[:, :-k]) * back[: size + 1 - k])
            place, there = lookup(self.keys, h.ravel())
            score = np.where(there, self.log_p[place], -np.inf).reshape(h.shape)
            if k == 1:
                lone = ~there.reshape(h.shape)
                if lone.any():
                    values, inverse = np.unique(codes[lone], return_inverse=True)
                    score[lone] = np.array([self.fallback(int(v)) for v in values])[inverse]
            arcs.append(score)
        alpha = np.full((n, size + 1), -np.inf)
        alpha[:, 0] = 0
        for j in range(1, size + 1):
            ways = np.stack([alpha[:, j - k] + arcs[k - 1][:, j - k] for k in range(1, min(j, self.longest) + 1)])
            top = ways.max(axis=0)
            alpha[:, j] = top + np.log(np.exp(ways - top).sum(axis=0))
        return alpha[:, size]


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        learn = b["learn"].to_numpy(bool)
        for rows, parts in slices(b["text"].tolist()):
            w = Words(parts, lower=True)
            keys, first, inverse = np.unique(w.hashes, return_index=True, return_inverse=True)
            counted = np.bincount(inverse, learn[np.array(rows)][w.rows].astype(float), len(keys))
            yield pd.DataFrame({"h": keys.view(np.int64), "word": [w.text(i) for i in first], "c": counted.astype(np.int64), "uses": np.bincount(inverse, minlength=len(keys))})


def count_words(docs: DataFrame) -> DataFrame:
    """(text, learn) -> h, word, c (uses in learning texts), uses (in all): combined in each task before the shuffle."""
    part = docs.select("text", "learn").mapInPandas(_counted, "h long, word string, c long, uses long")
    return part.groupBy("h", "word").agg(F.sum("c").alias("c"), F.sum("uses").alias("uses"))


def piece_counts(words: DataFrame, path: str) -> dict[int, int]:
    """How often the learning texts use each piece, by the vocabulary's own segmentation; one number per piece reaches the driver."""

    def pieces(batches):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        total = np.zeros(sp.get_piece_size(), np.int64)
        for b in batches:
            coded = sp.encode(b["word"].tolist(), num_threads=1)
            total += np.bincount(np.concatenate([np.array(x, int) for x in coded]), np.repeat(b["c"].to_numpy(), [len(x) for x in coded]), len(total)).astype(np.int64)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"piece": some, "n": total[some]})

    got = words.where("c > 0").select("word", "c").mapInPandas(pieces, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    return {r.piece: r.n for r in got}


def score(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", fold: tuple[int, int] = (5, 1), head_words: int = HEAD_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Texts whose crc32(id) has the remainder ``fold[1]`` modulo ``fold[0]`` are held out. Tokens are
    words in lower case (A-Z) and one end. Null texts are empty (one token). Each row is scored for itself,
    so repeated rows and null ids (never held out here) are fine. Without learning texts the
    vocabulary's own scores stand alone. ``docs`` must give the same rows when read twice.
    """
    spark = docs.sparkSession
    held = crc_fold(doc_id, fold[0]) == fold[1]
    d = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"), held.alias("held"))
    words = cut_lineage(count_words(d.select("text", (~F.col("held")).alias("learn"))))
    sums = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    ends = d.where("not held").count()
    total, kinds = sums.n + ends, sums.v + (ends > 0)
    pieces = spark.sparkContext.broadcast(Pieces(path, piece_counts(words, path), ends))

    def with_marginals(batches):
        for b in batches:
            yield pd.DataFrame({"h": b["h"], "c": b["c"], "uses": b["uses"], "lm": pieces.value.marginals(b["word"].tolist())})

    known = cut_lineage(words.select("h", "word", "c", "uses").mapInPandas(with_marginals, "h long, c long, uses long, lm double"))
    least = _head_limit(known, head_words)
    head = known.where(F.col("uses") >= least).select("h", "c", "lm").toPandas()
    keys = head["h"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    table = spark.sparkContext.broadcast((keys[order], head["c"].to_numpy()[order], head["lm"].to_numpy()[order]))
    below = 0.5 * (kinds + 1) + total
    end_base, end_lm = float(np.log10((ends + 0.5) / below)), pieces.value.end

    def looked_up(batches):
        keys, counts, marginals = table.value
        base = np.log10((counts + 0.5) / below)
        for b in batches:
            n = len(b)
            sums = {"n_tokens": np.ones(n), "n_known": np.full(n, float(ends > 0)), "base": np.full(n, end_base), "lm": np.full(n, end_lm)}
            for rows, parts in slices(b["text"].tolist()):
                w = Words(parts, lower=True)
                row = np.array(rows)[w.rows]
                place, there = lookup(keys, w.hashes)
                sums["n_tokens"] += np.bincount(row, minlength=n)
                at, hit = place[there], row[there]
                if len(hit):
                    sums["n_known"] += np.bincount(hit, counts[at] > 0, n)
                    sums["base"] += np.bincount(hit, base[at], n)
                    sums["lm"] += np.bincount(hit, marginals[at], n)
                rare = pd.DataFrame({"rid": b["rid"].to_numpy()[row[~there]], "h": w.hashes[~there].view(np.int64)})
                rare = rare.groupby(["rid", "h"], as_index=False, sort=False).size()
                yield pd.DataFrame({"rid": rare["rid"], "h": rare["h"], "tf": rare["size"].astype(np.int32), "n_tokens": 0, "n_known": 0, "base": 0.0, "lm": 0.0, "doc_id": None, "held": None})
            # the document's own row; its key meets no word, which tf = 0 makes sure of
            own = mixed(b["rid"].to_numpy().astype(np.uint64)).view(np.int64)
            yield pd.DataFrame({"rid": b["rid"], "h": own, "tf": np.int32(0), **{k: v.astype(np.int64) if k[0] == "n" else v for k, v in sums.items()}, "doc_id": b["doc_id"], "held": b["held"]})

    kind = d.schema["doc_id"].dataType.simpleString()
    flat = d.withColumn("rid", F.monotonically_increasing_id()).mapInPandas(looked_up, f"rid long, h long, tf int, n_tokens long, n_known long, base double, lm double, doc_id {kind}, held boolean")
    rare = known.where(F.col("uses") < least).select("h", (F.col("c") > 0).cast("long").alias("is_known"), F.log10((F.col("c") + 0.5) / below).alias("w_base"), F.col("lm").alias("w_lm"))
    tf = F.col("tf")
    got = flat.join(rare, "h", "left").select(
        "rid", "doc_id", "held", "n_tokens", (F.col("n_known") + F.when(tf > 0, tf * F.col("is_known")).otherwise(0)).alias("n_known"),
        (F.col("base") + F.when(tf > 0, tf * F.col("w_base")).otherwise(0.0)).alias("base"), (F.col("lm") + F.when(tf > 0, tf * F.col("w_lm")).otherwise(0.0)).alias("lm"),
    )
    out = got.groupBy("rid").agg(F.max("doc_id").alias("doc_id"), F.max("held").alias("held_out"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "lm")])
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), (F.col("lm") / LN10).alias("score"))


def _head_limit(words: DataFrame, most: int) -> int:
    """The least power of two such that at most ``most`` words are used so often."""
    bins = {r.b: r.n for r in words.groupBy(F.floor(F.log2("uses")).alias("b")).agg(F.count("*").alias("n")).collect()}
    total, b = 0, 63
    while b >= 0 and total + bins.get(b, 0) <= most:
        total += bins.get(b, 0)
        b -= 1
    return 1 << (b + 1)
