"""Exact duplicates by distributed radix partitioning on successive bytes.

All documents start in one group. Each round reads the next run of bytes and splits every group by
it; a group of one row is settled, and so is a group whose texts have ended, since its rows agree in
every byte. Equality is that of the bytes themselves, no digest is involved. The runs get longer from
round to round, so the rounds grow with the logarithm of the longest shared text up to runs of
``WIDEST`` bytes, and linearly beyond.

A round groups before it shuffles, so a run that many rows share is sent once per task. Rows whose
group holds more than a ``HOT``th of the open rows find it by a broadcast of fewer than ``HOT`` runs
and stay where they are; the others are joined by group and run. The texts of settled rows are not
carried any further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import whole_text
from freshet.session import cut_lineage

#: Bytes read in the first round, factor from round to round, and the longest run.
FIRST, GROWTH, WIDEST = 64, 4, 1 << 18
#: A group is hot if it has more than this part of the rows that share a run; fewer than HOT groups can be.
HOT = 64
_REST = 2**31 - 1


def label_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: the columns of ``carry`` (the id by default), keep_id, group_size, kept.

    Of rows with equal text the one with the largest id stays, null ids last; of repeated rows that tie
    there exactly one stays. Null texts count as empty and are equal to each other and to empty texts. Texts of any
    length are read whole. An empty table gives no rows. Other columns of ``docs`` are not looked at, whatever
    their names; a column of ``carry`` named as one of the three made ones gives way to it.
    """
    carry = {doc_id: F.col(doc_id)} if carry is None else carry
    own = [c.alias(n) for n, c in carry.items() if n not in ("keep_id", "group_size", "kept")]
    rows = docs.select(F.struct(F.lit(0).alias("_"), *own).alias("row"), F.col(doc_id).alias("id"), whole_text(text).cast("binary").alias("rest"))
    found = _settled(rows)
    kept = F.coalesce(F.col("keep_k") == F.col("k"), F.lit(True))
    return found.select("row.*", F.when(F.col("keep_k").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), kept.alias("kept")).drop("_")


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    whole = F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns])
    return label_copies(docs, doc_id, text, {"whole": whole}).where("kept").select("whole.*")


def _settled(rows: DataFrame) -> DataFrame:
    """row, id, k (a number of its own for each row that met another), n, keep_id, keep_k: null for rows that are alone."""
    width, done = FIRST, []
    rows = rows.withColumn("group", F.lit(0).cast("long")).withColumn("k", F.lit(None).cast("long"))
    first = True
    while first or not rows.isEmpty():
        cut = rows.withColumn("run", F.substring("rest", 1, width))
        groups = _groups(cut, first)
        met = _meet(cut, groups)
        # rows get their numbers once they are written; texts that end in the first run wait for the second round
        ended = F.lit(False) if first else F.length("run") < width
        number = F.monotonically_increasing_id() if first else F.col("k")
        goes_on = F.col("n").isNotNull() & ~ended
        state = cut_lineage(
            met.select(
                "row", "id", number.alias("k"), "n", "keep_id", "keep_k",
                F.when(goes_on, F.col("to")).alias("group"),
                F.when(goes_on, F.substring("rest", width + 1, _REST)).alias("rest"),
            )
        )
        done.append(state.where("group IS NULL").select("row", "id", "k", "n", "keep_id", "keep_k"))
        rows = state.where("group IS NOT NULL").select("row", "id", "k", "group", "rest")
        first, width = False, min(width * GROWTH, WIDEST)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _groups(cut: DataFrame, first: bool) -> DataFrame:
    """Groups of two rows or more by (group, run), with a new number, their size and the row that would stay."""
    if first:
        keep = [F.max("id").alias("keep_id"), F.max("k").alias("keep_k")]
    else:
        # max_by passes over null ids: if there is no other, any one row of the group will do
        keep = [F.max("id").alias("keep_id"), F.coalesce(F.max_by("k", "id"), F.max("k")).alias("keep_k")]
    counted = cut.groupBy("group", "run").agg(F.count(F.lit(1)).alias("n"), *keep).where("n > 1")
    return cut_lineage(counted.withColumn("to", F.monotonically_increasing_id()))


def _meet(cut: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows with their groups (null for a row that is alone); rows of hot groups are not shuffled."""
    shared = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    on = ["group", "run"]
    hot = F.broadcast(groups.where(F.col("n") * HOT > shared))
    by_broadcast = cut.join(hot, on)
    # always by a sort-merge join: the other groups grow with the input, so no size calls for another plan
    others = groups.where(F.col("n") * HOT <= shared).hint("merge")
    by_shuffle = cut.join(hot.select(*on), on, "left_anti").join(others, on, "left")
    return by_broadcast.unionByName(by_shuffle)


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, CAST(count(*) OVER (PARTITION BY t) AS BIGINT) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""
