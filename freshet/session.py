"""Session building and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "freshet", **conf: str) -> SparkSession:
    """A session with the settings every operator here relies on.

    ``master=None`` leaves the master to ``spark-submit``; shuffle partitions are only set for a
    local master, on a cluster AQE coalesces from the cluster's own default.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
    )
    if master is not None:
        b = b.master(master)
        if master.startswith("local"):
            b = (
                b.config("spark.sql.shuffle.partitions", "8")
                .config("spark.driver.memory", os.environ.get("FRESHET_DRIVER_MEMORY", "8g"))
                .config("spark.ui.enabled", "false")
                .config("spark.ui.showConsoleProgress", "false")
            )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset (tests on one
    machine) a fresh local folder is made and recorded in the session.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="freshet-")
        spark.conf.set(CHECKPOINT_KEY, root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the working folder that no other run uses."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: survives executor loss."""
    spark = df.sparkSession
    path = fresh_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
