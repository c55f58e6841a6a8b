"""Token counts as rollups kept up to date by signed changes.

A change is an insert, a delete or a revision (a delete of the old counts and an insert of the
new) of one document. Each batch of changes is summed to additive deltas by source, language and
tokenizer version and written to its own folder, named by the batch. Committing a batch again replaces the same folder, so
it never counts twice; totals are the sum over all batches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import broadcast_within, split_words, whole_text
from freshet.session import cut_lineage

KEYS = ("source", "lang", "tokenizer")
SUMS = ("documents", "tokens", "characters")
WORDS = "words-1"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"


def bpe_counts(path: str, name: str):
    """A column function: tokens of a text by a byte-pair vocabulary in tiktoken's format.

    Texts go to the tokenizer in pieces of about a megabyte, cut at line ends.
    """

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        encoder = _encoder(path, name)
        out = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                out[i] = sum(len(encoder.encode_ordinary(p)) for p in _pieces(t))
        return pd.Series(out)

    return count


_ENCODERS: dict = {}


def _encoder(path: str, name: str):
    if path not in _ENCODERS:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def _pieces(text: str, size: int = 1 << 20):
    at = 0
    while at < len(text):
        end = len(text) if len(text) - at <= size else text.find("\n", at + size) + 1 or len(text)
        yield text[at:end]
        at = end


def counted(docs: DataFrame, tokenizers: dict[str, object], text: str = "text", sign: int = 1) -> DataFrame:
    """One change per document and tokenizer: source, lang, tokenizer, sign, tokens, characters.

    Null texts count as empty; null sources and languages are groups of their own.
    """
    t = whole_text(text)
    made = F.array(*[F.struct(F.lit(k).alias("tokenizer"), f(t).cast("long").alias("tokens")) for k, f in sorted(tokenizers.items())])
    d = docs.select("source", "lang", F.length(t).cast("long").alias("characters"), made.alias("made"))
    return d.select("source", "lang", "characters", F.inline("made")).withColumn("sign", F.lit(sign))


def word_tokens(text: Column) -> Column:
    return F.size(split_words(text))


def commit(root: str, batch: str, changes: DataFrame) -> None:
    """Writes the batch's deltas; the same batch name always means the same folder, which is replaced as a whole."""
    sign = F.col("sign").cast("long")
    deltas = changes.groupBy(*KEYS).agg(F.sum(sign).alias("documents"), F.sum(sign * F.col("tokens")).alias("tokens"), F.sum(sign * F.col("characters")).alias("characters"))
    deltas.write.mode("overwrite").parquet(f"{root}/batch={batch}")


def totals(spark: SparkSession, root: str) -> DataFrame:
    """source, lang, tokenizer and the current sums; groups that have come down to nothing are left out."""
    schema = "source string, lang string, tokenizer string, documents long, tokens long, characters long, batch string"
    found = spark.read.schema(schema).parquet(root).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
    return found.where(" or ".join(f"{c} <> 0" for c in SUMS))


def deduplicated_rollup(docs: DataFrame, tokenizers: dict[str, object], root: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rollup of a corpus that lost its exact repeats and had its addresses masked, as three batches of changes.

    Batch one inserts every document. Batch two deletes repeats: all but the smallest id of each
    text. Batch three revises what is left and holds an e-mail address: the counts of the old text go, those of the masked text come. Documents are
    counted where they change, so the later batches read only those documents. Batch two is sent twice, as after a lost answer, and counts once. Rows with one id and text are repeats of each other and leave one.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"))
    commit(root, "1-insert", counted(d, tokenizers))
    key = F.unhex(F.md5(F.col("text").cast("binary")))
    # per text and (source, lang): how many rows there are; the row that stays is the smallest (id, source, lang) of its text
    groups = d.select(key.alias("k"), "doc_id", "source", "lang").groupBy("k").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "source", "lang")).alias("first")).where("n > 1")
    groups = broadcast_within(cut_lineage(groups))
    repeats = d.withColumn("k", key).join(groups, "k")
    own = F.struct("doc_id", "source", "lang")
    gone = repeats.where(~own.eqNullSafe(F.col("first")))
    # rows equal in everything: all of them match ``first``; take away their number less one
    extra = repeats.where(own.eqNullSafe(F.col("first"))).groupBy("k", "source", "lang").agg(F.count("*").alias("same"), F.first("text").alias("text")).where("same > 1")
    extra = extra.select("text", "source", "lang", F.explode(F.sequence(F.lit(2), F.col("same").cast("int"))).alias("i")).drop("i")
    # a batch that is sent again is the same batch: its texts are tokenized once
    deleted = cut_lineage(counted(gone.select("text", "source", "lang").union(extra), tokenizers, sign=-1))
    for _ in range(2):
        commit(root, "2-delete", deleted)
    masked = d.where(F.col("text").rlike(EMAIL)).withColumn("k", key)
    left = masked.join(groups.select("k", "first"), "k", "left").where("first is null or struct(doc_id, source, lang) <=> first").dropDuplicates(["k"])
    after = left.withColumn("text", F.regexp_replace("text", EMAIL, "<email>"))
    commit(root, "3-revise", counted(left, tokenizers, sign=-1).unionByName(counted(after, tokenizers)))
    return totals(spark, root)
