"""Physical plans: nothing that pairs whole tables, runs row-wise Python or windows over one task."""

import os
import re

import pytest

from pyspark.sql.readwriter import DataFrameWriter

import __spark_entry__  # noqa: F401  (fills the registry)
from freshet.catalog.registry import ENTRIES, run

SF = "/root/testdata/sf0.001"
#: Fitted per group by design, see test_learning.
LEARNED = {"gbt_walk_forward", "candidate_selection", "feature_ablation", "ship_rule_learned"}
NAMES = sorted(n for n in ENTRIES if n not in LEARNED and not n.startswith("stream_"))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(plan):
    plan = plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def whole_windows(df):
    """Windows without a partition: all rows in one task."""
    every = nodes(df._jdf.queryExecution().executedPlan())
    return [n.simpleString(200) for n in every if n.nodeName().startswith("Window") and n.partitionSpec().isEmpty()]


@pytest.fixture
def written(monkeypatch):
    """Every table that is written while a query is built, so that plans before a cut are seen too."""
    seen = []
    parquet = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(self._df), parquet(self, *a, **k))[1])
    return seen


@pytest.mark.parametrize("name", NAMES)
def test_plan(spark, written, name):
    for df in [run(name, spark, SF), *written]:
        plan = plan_of(df)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
            assert bad not in plan, bad
        assert whole_windows(df) == []


@pytest.mark.parametrize("name", ["split_observed_forecast", "anti_known", "value_at_target"])
def test_orders_are_merged_in_tasks_of_bounded_rows(spark, monkeypatch, name):
    from freshet.catalog import fixtures

    monkeypatch.setattr(fixtures, "ROWS_PER_TASK", 250)
    every = list(nodes(run(name, spark, SF)._jdf.queryExecution().executedPlan()))
    joins = [n for n in every if "Join" in n.nodeName() and "o_orderkey" in n.simpleString(200)]
    assert joins and {n.nodeName() for n in joins} == {"SortMergeJoin"}
    rows = sum(spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("lineitem", "orders"))
    for side in [x for n in joins for x in (n.left(), n.right())]:
        assert side.outputPartitioning().numPartitions() >= rows / 250


def test_window_over_one_task_is_seen(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(10).withColumn("k", F.col("id") % 2)
    assert len(whole_windows(df.withColumn("n", F.row_number().over(Window.orderBy("id"))))) == 1
    assert whole_windows(df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("id")))) == []


def test_filters_reach_the_scan(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from freshet.sources.points import scan_points, write_partitioned

    from freshet.session import fresh_path

    df = spark.range(1000).select((F.col("id") % 5).alias("point_id"), F.col("id").alias("h"), F.col("id").cast("double").alias("mm"), (F.col("id") % 3).cast("int").alias("part"))
    path = write_partitioned(df, fresh_path(spark, "scan"), "part")
    plan = plan_of(scan_points(spark, path, T.StructType(df.schema.fields), "part", [1], "point_id", [2]).select("h"))
    assert re.search(r"PartitionFilters: \[.*part", plan)
    assert "In(point_id" in plan or "EqualTo(point_id" in plan
    assert "mm" not in re.search(r"ReadSchema: (.*)", plan).group(1)


def test_top_rows_are_limited_before_the_shuffle(spark):
    from freshet.operators.windows import separated_top

    # more rows than the limit, else the optimiser leaves it out
    df = spark.range(1000).selectExpr("id % 2 AS k", "date_add(date'2020-01-01', cast(id as int)) AS d", "cast(id AS double) AS rise")
    assert plan_of(separated_top(df, "k", "d", "rise")).count("WindowGroupLimit") >= 2
