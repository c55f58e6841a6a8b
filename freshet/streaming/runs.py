"""Running a streaming job over what has arrived, and its sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from freshet.operators.archive_rows import newest
from freshet.session import fresh_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# readings are polled from a feed that keeps about two days, so later rows cannot arrive
LATENESS = "48 hours"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Files of a folder (or glob) as a stream."""
    r = spark.readStream.schema(schema)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(path)


def land(df: DataFrame, name: str) -> str:
    """Write rows to a fresh landing folder."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def drain(stream: DataFrame, name: str, sink: str | None = None, checkpoint: str | None = None, timeout: int | None = None) -> DataFrame:
    """Process everything available into a parquet sink and read it back.

    Sink and checkpoint live in the shared folder; passing them again resumes the job. Without a
    ``timeout`` (seconds) a run takes as long as its backlog.
    """
    spark = stream.sparkSession
    _use_rocksdb(spark)
    sink = sink or fresh_path(spark, f"{name}-sink")
    q = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink)
        .option("checkpointLocation", checkpoint or fresh_path(spark, f"{name}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    _finish(q, timeout)
    try:
        return spark.read.schema(stream.schema).parquet(sink)
    except AnalysisException:
        # nothing has arrived yet, so there is no sink
        return spark.createDataFrame([], stream.schema)


def drain_newest(
    stream: DataFrame, name: str, keys: list[str], order: list[str] | None = None, sink: str | None = None, checkpoint: str | None = None, timeout: int | None = None
) -> DataFrame:
    """Process everything available in update mode and give back the newest version of every key.

    Each batch appends its rows to a folder of its own (a repeated batch replaces that folder), so
    nothing older is read or rewritten, no version is ever forgotten, and sums of windows that are still open
    are there until a later batch replaces them. Within one batch the row with the largest ``order`` wins.
    """
    spark = stream.sparkSession
    sink = sink or fresh_path(spark, f"{name}-sink")

    def publish(batch: DataFrame, batch_id: int) -> None:
        rows = newest(batch, keys, order) if order else batch
        rows.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    drain_batches(stream, name, publish, checkpoint, timeout, "update")
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    try:
        return newest(spark.read.schema(schema).parquet(sink), keys, ["batch"]).select(*stream.columns)
    except AnalysisException:
        # nothing has arrived yet, so there is no sink
        return spark.createDataFrame([], stream.schema)


def drain_batches(
    stream: DataFrame, name: str, each: Callable[[DataFrame, int], None], checkpoint: str | None = None, timeout: int | None = None, mode: str = "append"
) -> None:
    """Process everything available through ``each(batch, batch_id)``, which must be repeatable."""
    spark = stream.sparkSession
    _use_rocksdb(spark)
    q = (
        stream.writeStream.foreachBatch(each)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint or fresh_path(spark, f"{name}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    _finish(q, timeout)


def _use_rocksdb(spark: SparkSession) -> None:
    if spark.conf.get(STATE_PROVIDER, ROCKSDB).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_PROVIDER, ROCKSDB)


def _finish(query, timeout: int | None) -> None:
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"streaming run did not finish in {timeout} s")
