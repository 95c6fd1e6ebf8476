from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tablewright import runtime
from tablewright.operators import skew
from tests.conftest import plan_text


def test_local_session_gets_a_folder_of_its_own(spark):
    folder = runtime.shared_dir(spark)
    assert folder == runtime.shared_dir(spark)
    assert runtime.scratch_path(spark, "x") != runtime.scratch_path(spark, "x")


def _session(master, configured=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    conf = SimpleNamespace(get=lambda key, default: configured)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_cluster_folder_comes_from_the_session():
    session = _session("yarn", "hdfs:///shared/checkpoints")
    assert runtime.shared_dir(session) == "hdfs:///shared/checkpoints"
    assert runtime.scratch_path(session, "x").startswith("hdfs:///shared/checkpoints/x-")


def test_cluster_without_a_folder_is_refused():
    with pytest.raises(ValueError):
        runtime.shared_dir(_session("yarn"))


def test_cut_lineage_forgets_the_plan(spark):
    df = runtime.cut_lineage(spark.range(10).selectExpr("id % 2 AS k").distinct())
    assert "Exchange" not in plan_text(df)
    assert df.count() == 2


def test_measures_come_with_the_write(spark):
    df = spark.range(10).toDF("id")
    written, state = runtime.cut_and_measure(df, total=F.sum("id"), none=F.sum(F.when(F.col("id") > 99, 1)))
    assert (state["rows"], state["total"], state["none"]) == (10, 45, None)
    assert written.count() == 10


def test_file_size_decides_the_broadcast(spark):
    small = runtime.cut_lineage(spark.range(10).toDF("id"))
    joined = spark.range(100).toDF("id").join(small, "id")
    assert "BroadcastHashJoin" in plan_text(joined)


def test_hot_groups(spark, rows):
    df = spark.createDataFrame([("a",)] * 5 + [(None,)] * 4 + [("b",)], "k string")
    assert skew.hot_groups(df, ["k"], 5) is None
    hot = skew.hot_groups(df, ["k"], 3)
    assert rows(hot, "k", skew.GROUP_ROWS) == [(None, 4), ("a", 5)]
    ordinary, heavy = skew.split_hot(df, hot, ["k"])
    assert rows(ordinary) == [("b",)]
    assert heavy.count() == 9
    assert heavy.select(skew.GROUP_ID).distinct().count() == 2


def test_a_share_of_the_rows_rules_groups_out(spark, rows, monkeypatch):
    monkeypatch.setattr(skew, "SAMPLE_ROWS", 50)
    key = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, "hot").otherwise(
        F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))
    )
    df = spark.range(6000, numPartitions=4).select(key.alias("k"))
    hot = skew.hot_groups(df, ["k"], 500)
    assert rows(hot, "k", skew.GROUP_ROWS) == [(None, 2000), ("hot", 2000)]
    # Likely groups are still counted: 2,000 rows pass the share but not this limit.
    assert skew.hot_groups(df, ["k"], 2000) is None
    assert skew.hot_groups(df, ["k"], 5000) is None


def test_no_local_checkpoints_or_driver_loops_in_the_library():
    root = Path(runtime.__file__).parent
    text = "".join(file.read_text() for file in root.rglob("*.py"))
    for word in ("localCheckpoint", "crossJoin", ".collect()", ".toPandas(", ".rdd"):
        assert word not in text


def test_short_rows_are_dealt_by_their_number(spark, monkeypatch):
    """Sixty parts were merged into one for each core, by their bytes, and each task's memory grew with the rows."""
    monkeypatch.setattr(runtime, "ROWS_PER_TASK", 1_000)
    df = spark.range(60_000).selectExpr("id % 500 AS k", "id AS v")
    summed = runtime.dealt(df, 60_000, "k").groupBy("k").count()
    assert summed.rdd.getNumPartitions() == 60
    assert summed.count() == 500 and summed.agg({"count": "sum"}).first()[0] == 60_000
    assert runtime.dealt(df, 1_000, "k") is df
