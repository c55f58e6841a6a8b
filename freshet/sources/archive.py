"""Archives that grow by merging: upserts, immutable ledgers, label slices, snapshots."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from freshet.functions import scalars as S
from freshet.operators.archive_rows import newest, oldest
from freshet.session import cut_lineage


def _batches(parts: list[DataFrame]) -> DataFrame:
    marked = [p.withColumn("_batch", F.lit(i)) for i, p in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)


def merge_keep_last(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Union with the newest batch winning per key; ``order`` settles duplicates within a batch."""
    return newest(_batches([old, new]), keys, ["_batch", *order]).drop("_batch")


def merge_keep_first(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Immutable ledger: what is archived stays."""
    return oldest(_batches([old, new]), keys, ["_batch", *order]).drop("_batch")


def write_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write a merged archive to a new folder (never over its own input) and read it back."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Name of the folders of an archive's parts.
PART = "archive_part"


class Archive:
    """A table by key that grows by batches, laid out in parts, with a log that says which folders are live.

    ``part`` is an expression of the key columns (a year, a bucket), so a key never changes its part. A merge reads and
    writes only the parts that its batch touches: with ``keep="last"`` it replaces them, with ``keep="first"`` it
    adds the keys that are not there. It writes them to a fresh folder and then adds one row to the log, in one file: readers see
    a version whole or not at all, and folders of a merge that did not come so far are never read. A batch that the
    log knows by its id is not merged again. There may be any number of readers, but one writer.
    """

    LOG = T.StructType([T.StructField("version", T.LongType()), T.StructField("batch", T.StringType()), T.StructField("folder", T.StringType()), T.StructField("replaces", T.BooleanType()), T.StructField("parts", T.ArrayType(T.StringType()))])

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], order: list[str], part: Column, keep: str = "last"):
        self.spark, self.root, self.schema, self.keys, self.order, self.keep = spark, root, schema, keys, order, keep
        # part names are folder names
        self.part = F.coalesce(F.regexp_replace(part.cast("string"), "[^A-Za-z0-9-]", "_"), F.lit("none"))

    def log(self) -> DataFrame:
        """version, batch, folder, replaces, parts: one row per merge."""
        try:
            return self.spark.read.schema(self.LOG).parquet(f"{self.root}/log")
        except AnalysisException:
            return self.spark.createDataFrame([], self.LOG)

    def version(self) -> int:
        """Number of merges so far."""
        return self.log().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def live(self, version: int | None = None) -> DataFrame:
        """(part, folder) of a version, the last one by default: of each part what replaced it last and what was added since."""
        log = self.log() if version is None else self.log().where(F.col("version") <= version)
        steps = log.select("version", "folder", "replaces", F.explode("parts").alias("part"))
        last = steps.groupBy("part").agg(F.max(F.when(F.col("replaces"), F.col("version"))).alias("_from"))
        return steps.join(last, "part").where("_from IS NULL OR version >= _from").select("part", "folder")

    def _rows(self, live: DataFrame) -> DataFrame:
        # as many paths as parts and additions: the calendar or the number of buckets bounds them
        paths = [f"{self.root}/data/{r.folder}/{PART}={r.part}" for r in live.collect()]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.live(version))

    def merge(self, batch: DataFrame, batch_id: str) -> int:
        """Merges a batch and gives the version that holds it. An empty batch changes nothing but the log."""
        known = self.log().where(F.col("batch") == batch_id).select("version").head()
        if known:
            return known[0]
        fresh = batch.select(*self.schema.names)
        fresh = cut_lineage((newest if self.keep == "last" else oldest)(fresh, self.keys, self.order).withColumn(PART, self.part))
        touched = self.live().join(fresh.select(F.col(PART).alias("part")).distinct(), "part", "left_semi")
        old = self._rows(touched).withColumn(PART, self.part)
        if self.keep == "last":
            merged = merge_keep_last(old, fresh, self.keys, self.order)
        else:
            same = reduce(lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in self.keys])
            merged = fresh.alias("n").join(old.select(*self.keys).alias("o"), same, "left_anti")
        version, folder = self.version() + 1, uuid.uuid4().hex
        merged.write.partitionBy(PART).parquet(f"{self.root}/data/{folder}")
        written = merged if self.keep == "first" else fresh
        row = written.agg(F.collect_set(PART).alias("parts")).select(
            F.lit(version).cast("long").alias("version"), F.lit(batch_id).alias("batch"), F.lit(folder).alias("folder"), F.lit(self.keep == "last").alias("replaces"), "parts"
        )
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        return version


def replace_slice(store: DataFrame, new: DataFrame, keep: Column, key: str, order: list[str]) -> DataFrame:
    """Keep the rows of one source, replace all others, last per id."""
    return newest(_batches([new, store.filter(keep)]), [key], ["_batch", *order]).drop("_batch")


def publish_documents(df: DataFrame, values: dict[str, str], source: Column, retrieved_at: Column, keys: list[str]) -> DataFrame:
    """Each value wrapped with its provenance, one JSON document per row; ``values`` maps column to class."""
    wrapped = [S.provenance(F.col(c), F.lit(cls), source, retrieved_at).alias(c) for c, cls in values.items()]
    return df.select(*keys, F.to_json(F.struct(*keys, *wrapped)).alias("document"))


def write_documents(docs: DataFrame, path: str, document: str = "document") -> DataFrame:
    """Documents as a text sink, one per line, and read back."""
    docs.select(document).write.mode("errorifexists").text(path)
    return docs.sparkSession.read.text(path).withColumnRenamed("value", document)
