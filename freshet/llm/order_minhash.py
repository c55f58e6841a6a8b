"""Near-duplicate detection by Order MinHash.

A text's k-mers are its runs of three words, labelled with how often the run has occurred before. For each of
several hash functions the smallest labelled k-mers are taken and kept in text order; the key
made of them is shared by two texts the likelier, the smaller their edit distance. Texts of up to ``MIDDLE`` words
have keys of two-word runs besides. Texts of up to ``SHORT`` words have, as an exact way, one key for each way of leaving out as many
words as a link may differ by. Texts with a common key are candidates, and a banded alignment of their words settles them.

Equal texts are one node. In a bucket (texts with one key) of up to ``SMALL`` texts all pairs are tried. In
a larger one every text is tried against the centre, the one that shares most keys with the rest. Buckets that then still hold
several classes are gone through block by block: a link of 0.8 means that two thirds of all the words of both are common, which a mark of
64 bytes estimates, so all pairs of different classes are compared by their marks and the likely ones aligned at once, nearest first. A task
unites the classes that it finds linked and goes on without them; only the links that united two leave it, so fewer rows than texts come out. A pair
that shares several buckets is looked at in the least of them.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.arrays import Words, mix_in_place, mixed, slices
from freshet.llm.common import broadcast_within, whole_text
from freshet.session import cut_lineage

SHINGLE, SKETCHES, PICKED = 3, 48, 2
#: Texts of up to so many words have keys of words left out, and keys of two-word runs.
SHORT, MIDDLE = 14, 60
#: Least share of equal words in an alignment: 1 - edit distance / longer length.
SIMILARITY = 0.8
SMALL = 8
#: Bytes of a mark, and how many of them two texts must share to be tried: two thirds are expected at the least similarity, this is four standard errors under it.
MARK, LIKE = 64, 28
#: Texts and bytes of words of a large bucket that one side of a task holds, about.
BLOCK, BLOCK_BYTES = 2000, 1 << 24
_SEEDS = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
_STEP = np.uint64(0xA0761D6478BD642F)
_MARKS = mixed(np.arange(1, MARK + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB))


def _word_hashes(texts: list[str]) -> list[np.ndarray]:
    """64-bit hashes of the words (A-Z in lower case) of each text."""
    parts: list[list[np.ndarray]] = [[] for _ in texts]
    for rows, some in slices(texts):
        w = Words(some, lower=True)
        cuts = np.searchsorted(w.rows, np.arange(len(some) + 1))
        for i, r in enumerate(rows):
            parts[r].append(w.hashes[cuts[i] : cuts[i + 1]])
    return [np.concatenate(p) if p else np.zeros(0, np.uint64) for p in parts]


def _labelled(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words in text order, each with how often it has occurred before."""
    n = len(words) - size + 1
    grams = np.zeros(n, np.uint64)
    for k in range(size):
        grams = mixed(grams * _STEP + words[k : k + n])
    order = np.argsort(grams, kind="stable")
    ordered = grams[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    labelled = np.empty(n, np.uint64)
    labelled[order] = mixed(ordered + (np.arange(n) - start).astype(np.uint64) * _STEP)
    return labelled


def sketch(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """One key per hash function for the word hashes of a text (none for an empty text).

    A text of fewer than ``size`` words is one k-mer.
    """
    if not len(words):
        return np.zeros(0, np.uint64)
    labelled = _labelled(words, min(size, len(words)))
    n = len(labelled)
    keys = np.empty(SKETCHES, np.uint64)
    take = min(PICKED, n)
    step = max(1, 4_000_000 // n)
    for k in range(0, SKETCHES, step):
        h = mix_in_place(labelled[None, :] ^ _SEEDS[k : k + step, None])
        places = np.empty((len(h), take), np.int64)
        for j in range(take):
            places[:, j] = h.argmin(axis=1)
            h[np.arange(len(h)), places[:, j]] = np.iinfo(np.uint64).max
        places.sort(axis=1)
        key = np.zeros(len(h), np.uint64)
        for j in range(take):
            key = mixed(key * _STEP + labelled[places[:, j]])
        keys[k : k + step] = key
    return keys


@functools.cache
def _kept(n: int, out: int) -> np.ndarray:
    return np.array(list(itertools.combinations(range(n), n - out)))


def left_out(words: np.ndarray) -> np.ndarray:
    """A key for each way of leaving out up to as many words as a link may differ by: two short texts that link share one."""
    n, keys = len(words), []
    for out in range(int((1 - SIMILARITY) * n + 1e-9) + 1):
        some = words[_kept(n, out)]
        key = np.full(len(some), n - out, np.uint64)
        for k in range(n - out):
            key = mixed(key * _STEP + some[:, k])
        keys.append(key)
    return np.unique(np.concatenate(keys))


def buckets_of(words: np.ndarray) -> np.ndarray:
    """All keys of a text; each kind and each hash function has keys of its own."""
    n = len(words)
    parts = []
    if 0 < n <= SHORT:
        parts.append(mixed(left_out(words) + np.uint64(1)))
    # shorter ones link to no text of more than SHORT words
    if n >= SIMILARITY * (SHORT + 1) - 1e-9:
        parts.append(mixed(sketch(words) + _SEEDS))
        if n <= MIDDLE:
            parts.append(mixed(sketch(words, 2) ^ _SEEDS))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def alignment(a: list, b: list, least: float = SIMILARITY) -> float:
    """1 - edit distance / longer length, or 0 if that is under ``least``.

    Diagonal by diagonal within the band that the least similarity allows: after d edits, how far each
    diagonal reaches (equal words cost nothing).
    """
    n, m = len(a), len(b)
    longest = max(n, m)
    if not longest:
        return 1.0
    most = int((1 - least) * longest + 1e-9)
    if abs(n - m) > most:
        return 0.0
    goal = m - n
    reach: dict[int, int] = {}
    for d in range(most + 1):
        now: dict[int, int] = {}
        # a diagonal that cannot come back to the goal with the edits left is outside the band
        spare = most - d
        for k in range(max(-d, goal - spare), min(d, goal + spare) + 1):
            if d == 0:
                i = 0
            else:
                i = max(reach.get(k, -2) + 1, reach.get(k - 1, -2), reach.get(k + 1, -2) + 1)
                if i < 0:
                    continue
                i = min(i, n, m - k)
                if i < 0 or i + k < 0:
                    continue
            j = i + k
            while i < n and j < m and a[i] == b[j]:
                i += 1
                j += 1
            now[k] = i
        if now.get(goal, -1) >= n:
            return 1 - d / longest
        reach = now
    return 0.0


def _bound(a: np.ndarray, b: np.ndarray) -> float:
    """The most that an alignment can reach, from the words that both have."""
    values, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    both = np.minimum(np.bincount(inverse[: len(a)], minlength=len(values)), np.bincount(inverse[len(a) :], minlength=len(values))).sum()
    return both / max(len(a), len(b), 1)


def _sketched(batches):
    for b in batches:
        for i in range(0, len(b), 500):
            some = b.iloc[i : i + 500]
            keys = [buckets_of(w) for w in _word_hashes(some["text"].tolist())]
            yield pd.DataFrame({"k": np.repeat(some["k"].to_numpy(object), [len(k) for k in keys]), "b": np.concatenate(keys).view(np.int64)})


def mark(words: np.ndarray) -> bytes:
    """A byte of the smallest labelled word under each of ``MARK`` hash functions."""
    if not len(words):
        return bytes(MARK)
    labelled = _labelled(words, 1)
    least = np.full(MARK, np.iinfo(np.uint64).max)
    for i in range(0, len(labelled), 50_000):
        least = np.minimum(least, mix_in_place(labelled[None, i : i + 50_000] ^ _MARKS[:, None]).min(axis=1))
    return (least & np.uint64(255)).astype(np.uint8).tobytes()


def _hashed(batches):
    for b in batches:
        yield pd.DataFrame({"k": b["k"], "w": [w.tobytes() for w in _word_hashes(b["text"].tolist())]})


def _packed(batches):
    """Marks, and words as numbers of four bytes."""
    for b in batches:
        words = [np.frombuffer(w, np.uint64) for w in b["w"]]
        yield pd.DataFrame({"k": b["k"], "s": [mark(w) for w in words], "w": [(w >> np.uint64(32)).astype(np.uint32).tobytes() for w in words]})


def _uniting(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between texts of different classes in a pair of blocks, as far as each unites two that no earlier one has."""
    bucket, p, q = rows.loc[rows.index[0], ["b", "p", "q"]]
    keys, part = rows["k"].to_numpy(object), rows["part"].to_numpy()
    marks = np.frombuffer(b"".join(rows["s"]), np.uint8).reshape(len(rows), MARK)
    words = [np.frombuffer(w, np.uint32) for w in rows["w"]]
    shared = [np.asarray(x) for x in rows["buckets"]]
    length = np.array([len(w) for w in words])
    above = list(range(len(rows)))
    group = pd.factorize(rows["root"])[0]

    def top(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    left, right = np.flatnonzero(part == p), np.flatnonzero(part == q)
    other = marks[right].T
    links = []
    for i in left:
        same = np.zeros(len(right), np.uint8)
        for x, column in zip(marks[i], other, strict=True):
            same += column == x
        near = np.abs(length[right] - length[i]) <= (1 - SIMILARITY) * np.maximum(length[right], length[i]) + 1e-9
        at = np.flatnonzero((same >= LIKE) & near & (group[right] != group[i]) & ((right > i) | (p != q)))
        for j in right[at[np.argsort(-same[at].astype(np.int16), kind="stable")]]:
            if top(group[i]) == top(group[j]) or np.intersect1d(shared[i], shared[j], assume_unique=True)[0] != bucket:
                continue
            if _links(words[i], words[j]):
                above[top(group[i])] = top(group[j])
                links.append(sorted((keys[i], keys[j])))
    return pd.DataFrame(links, columns=["a", "b"], dtype=object)


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of buckets (b, n, size, k) in pairs of blocks p <= q of the bucket, so that any two texts of a bucket meet in one."""
    parts = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("size") / BLOCK_BYTES)).cast("int")
    cut = rows.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "k"), parts).cast("int"))
    cut = cut.withColumn("with", F.explode(F.sequence(F.lit(0), parts - 1)))
    return cut.withColumn("p", F.least("part", "with")).withColumn("q", F.greatest("part", "with")).drop("with", "n", "size")


def _settled(keyed: DataFrame, large: DataFrame, links: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes after all likely pairs of different classes in large buckets have been tried."""
    rows = cut_lineage(large.join(classes, "k", "left").withColumn("root", F.coalesce("root", "k")))
    # buckets of the same texts count once
    kinds = rows.groupBy("b").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("n"), F.sum(F.xxhash64("k").cast("decimal(38,0)")).alias("same")).where("x <> y")
    open_ = cut_lineage(kinds.groupBy("n", "same").agg(F.min("b").alias("b")).select("b", "n"))
    rows = cut_lineage(rows.join(open_, "b").select("b", "n", "k", "root"))
    if rows.isEmpty():
        return classes
    nodes = cut_lineage(rows.groupBy("k").agg(F.array_sort(F.collect_set("b")).alias("buckets")))
    held = _texts(keyed, nodes.select("k")).mapInPandas(_packed, "k binary, s binary, w binary")
    held = cut_lineage(held.join(nodes, "k"))
    sizes = rows.select("b", "k").join(held.select("k", F.length("w").alias("size")), "k").groupBy("b").agg(F.sum("size").alias("size"))
    blocks = _in_blocks(rows.join(sizes, "b")).join(held, "k").groupBy("b", "p", "q").applyInPandas(_uniting, "a binary, b binary")
    return components(cut_lineage(links.union(blocks.distinct())))


def _links(a: np.ndarray, b: np.ndarray) -> bool:
    return _bound(a, b) >= SIMILARITY - 1e-9 and alignment(a.tolist(), b.tolist()) >= SIMILARITY - 1e-9


def _aligned(batches):
    for b in batches:
        good = [_links(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(b["wa"], b["wb"], strict=True)]
        yield b.loc[good, ["a", "b"]]


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> k, root: the smallest node that each node of the edges is linked to, by labels that jump."""
    both = cut_lineage(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = cut_lineage(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("k"), F.least("a", "b").alias("root")))
    while True:
        near = both.join(labels.withColumnRenamed("k", "b"), "b").groupBy(F.col("a").alias("k")).agg(F.min("root").alias("near"))
        step = labels.join(near, "k").select("k", "root", F.least("root", "near").alias("new"))
        jump = labels.select(F.col("k").alias("new"), F.col("root").alias("far"))
        moved = cut_lineage(step.join(jump, "new", "left").select("k", F.least("new", "far").alias("new"), F.col("root").alias("old")))
        labels = moved.select("k", F.col("new").alias("root"))
        if moved.where("new <> old").isEmpty():
            return labels


def _candidates(buckets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bucket b, node k) -> pairs a < b to try, linear in the rows; and the rows of shared buckets with their size n."""
    sizes = buckets.groupBy("b").agg(F.count("*").alias("n")).where("n > 1")
    inside = cut_lineage(buckets.join(sizes, "b"))
    small = inside.where(F.col("n") <= SMALL).select("b", "k")
    pairs = small.join(small.withColumnRenamed("k", "o"), "b").where("k < o").select(F.col("k").alias("a"), F.col("o").alias("b"))
    large = inside.where(F.col("n") > SMALL)
    weight = large.groupBy("k").agg(F.sum("n").alias("weight"))
    centres = large.join(weight, "k").groupBy("b").agg(F.max_by("k", F.struct("weight", "k")).alias("hub"))
    # most buckets of one text have the same centre: gather the different ones before they become rows
    others = large.join(centres, "b").groupBy("k").agg(F.collect_set("hub").alias("o"))
    starred = others.select("k", F.explode("o").alias("o")).where("k <> o")
    return cut_lineage(pairs.union(starred.select(F.least("k", "o").alias("a"), F.greatest("k", "o").alias("b"))).distinct()), inside


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, classes): doc_id and text key k of every row; k, class_id for every distinct text.

    class_id is the smallest document id of the class (null if all are null). Null texts count as
    empty, and empty texts are copies of each other. Rows repeated in ``docs`` are copies too. An empty table has no classes.
    """
    keyed = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text")).withColumn("k", F.unhex(F.md5(F.col("text").cast("binary"))))
    sketches = cut_lineage(keyed.select("k", "text").mapInPandas(_sketched, "k binary, b long").distinct())
    tried, inside = _candidates(sketches)
    links = _verified(keyed, tried)
    classes = components(links)
    classes = _settled(keyed, inside.where(F.col("n") > SMALL).select("b", "k"), links, classes)
    ids = keyed.groupBy("k").agg(F.min("doc_id").alias("least")).join(classes, "k", "left").withColumn("root", F.coalesce("root", "k"))
    ids = cut_lineage(ids)
    least = ids.groupBy("root").agg(F.min("least").alias("class_id"))
    return keyed.select("doc_id", "k"), cut_lineage(ids.join(least, "root").select("k", "root", "class_id"))


def _texts(keyed: DataFrame, nodes: DataFrame) -> DataFrame:
    """k, w: the word hashes of the texts in ``nodes``."""
    nodes = cut_lineage(nodes)
    return cut_lineage(keyed.select("k", "text").join(broadcast_within(nodes), "k", "leftsemi").mapInPandas(_hashed, "k binary, w binary").dropDuplicates(["k"]))


def _linked(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    joined = pairs.join(texts.select(F.col("k").alias("a"), F.col("w").alias("wa")), "a").join(texts.select(F.col("k").alias("b"), F.col("w").alias("wb")), "b")
    return cut_lineage(joined.select("a", "b", "wa", "wb").mapInPandas(_aligned, "a binary, b binary"))


def _verified(keyed: DataFrame, pairs: DataFrame) -> DataFrame:
    return _linked(_texts(keyed, pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct()), pairs)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class: the one with the smallest id, with all columns of ``docs``."""
    _, classes = near_classes(docs, doc_id, text)
    k = F.unhex(F.md5(whole_text(text).cast("binary")))
    d = docs.withColumn("__k", k).join(broadcast_within(classes.select(F.col("k").alias("__k"), "root", F.col("class_id").alias("__least")).withColumnRenamed("root", "__root")), "__k")
    return d.where(F.col(doc_id).eqNullSafe(F.col("__least"))).dropDuplicates(["__root"]).select(*[F.col(f"`{c}`") for c in docs.columns])
