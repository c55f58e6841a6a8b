"""Column helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
#: Rows of keys (a few longs each) that may be broadcast; above it joins shuffle.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text (remainder 0)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts


def whole_text(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def split_words(text: Column, separators: str = SPACE) -> Column:
    """The runs of characters between separators, as an array without empty words."""
    return F.array_remove(F.split(text, separators), "")


def word_ngrams(words: str, n: int) -> Column:
    """64-bit hashes of all runs of ``n`` words of an array column, in text order."""
    last = F.size(words) - n
    hashed = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(n)]))
    return F.when(last >= 0, hashed).otherwise(F.array().cast("array<bigint>"))


def text_key(text: Column) -> dict[str, Column]:
    """Two independent 64-bit hashes that stand for a text: equal texts share them, so work is done once per text."""
    return {"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit("second"), text)}


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def broadcast_within(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a written table for broadcast only if it has at most ``limit`` rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
