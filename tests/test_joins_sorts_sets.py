from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablewright.operators import joins as J
from tablewright.operators import layout as L
from tablewright.operators import ordering as O
from tests.conftest import plan_text


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "Ann"), (2, "Bob"), (3, "Cy"), (None, "Di")], "id int, name string")


@pytest.fixture
def orders(spark):
    return spark.createDataFrame([(1, 10), (1, 20), (3, 5), (9, 1), (None, 2)], "id int, amount int")


def test_joins(people, orders, rows):
    assert rows(J.inner_join(people, orders, "id")) == [(1, "Ann", 10), (1, "Ann", 20), (3, "Cy", 5)]
    assert rows(J.inner_join(people, orders, "id", 3)) == rows(J.inner_join(people, orders, "id"))
    assert J.left_join(people, orders, "id").count() == 5
    assert rows(J.no_match(people, orders, "id")) == [(None, "Di"), (2, "Bob")]


def test_fixed_partitions_need_no_second_shuffle(spark):
    big = spark.range(1000).selectExpr("id % 10 AS id", "id AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan_text(J.inner_join(big, big.withColumnRenamed("v", "w"), "id", 5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange") == 2


def test_lookup_default_and_repeated_keys(people, orders, spark, rows):
    got = J.lookup(orders, people, "id", "name", "Unknown")
    assert rows(got, "amount", "name") == [
        (1, "Unknown"), (2, "Unknown"), (5, "Cy"), (10, "Ann"), (20, "Ann"),
    ]
    twice = people.unionByName(people)
    assert J.lookup(orders, twice, "id", "name", "Unknown").count() == 5


def test_small_dimension_is_broadcast_by_size_not_by_force(spark, tmp_path):
    spark.range(200).selectExpr("id AS key", "id AS v").write.parquet(str(tmp_path / "fact"))
    spark.range(20).selectExpr("id AS key", "'n' AS name").write.parquet(str(tmp_path / "dim"))
    fact, dim = (spark.read.parquet(str(tmp_path / part)) for part in ("fact", "dim"))
    assert "BroadcastHashJoin" in plan_text(J.lookup(fact, dim, "key", "name", "?"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10)
    try:
        assert "SortMergeJoin" in plan_text(J.lookup(fact, dim, "key", "name", "?"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_bottom_argmax(orders, rows):
    assert rows(O.top_k(orders, ["-amount"], 2), "amount") == [(10,), (20,)]
    assert rows(O.bottom_k(orders, ["-amount"], 2), "amount") == [(1,), (2,)]
    assert rows(O.argmax(orders, ["-amount"]), "amount") == [(20,)]
    assert "TakeOrderedAndProject" in plan_text(O.top_k(orders, ["-amount"], 2))


def test_min_ties(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "id string, n int")
    assert rows(O.min_ties(df, "n"), "id") == [("a",), ("b",)]
    assert O.min_ties(df.filter("n > 5"), "n").count() == 0


def test_sort_all_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame([(1, 3), (1, 1), (0, 2)], "a int, b int")
    assert [tuple(r) for r in O.sort_all(df, ["-a"]).collect()] == [(1, 1), (1, 3), (0, 2)]


def test_union_and_intersect(spark, rows):
    a = spark.createDataFrame([(1,), (2,), (2,)], "v int")
    b = spark.createDataFrame([(2,), (2,), (3,)], "v int")
    assert rows(L.union_all(a, b)) == [(1,), (2,), (2,), (2,), (2,), (3,)]
    assert rows(L.intersect(a, b)) == [(2,)]


def test_partition_operators(spark, rows):
    df = spark.range(20, numPartitions=4).toDF("id")
    assert rows(L.partition_profile(df)) == [(0, 5), (1, 5), (2, 5), (3, 5)]
    assert L.partition_profile(L.shrink(df, 2)).count() == 2
    assert "Exchange" not in plan_text(L.shrink(df, 2))
    assert L.partition_profile(L.spread(df, 8)).agg(F.sum("rows")).first()[0] == 20
    keyed = L.with_partition_id(L.spread(df.selectExpr("id % 3 AS k"), 3, "k"))
    assert keyed.groupBy("k").agg(F.countDistinct("pid").alias("n")).filter("n > 1").count() == 0


def test_keep_caches_until_released(spark):
    kept = L.keep(spark.range(5).toDF("id"))
    assert kept.is_cached
    assert not kept.unpersist().is_cached


def test_uneven_join_keys_are_split_at_run_time(spark):
    """A third of the rows share one key; the join still runs in even pieces."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
        facts = spark.range(300_000, numPartitions=8).select(key.alias("key"), F.xxhash64("id").alias("v"))
        dim = spark.range(5000).select(F.col("id").alias("key"), F.lit("n").alias("name"))
        joined = J.lookup(facts, dim, "key", "name", "?")
        joined.write.format("noop").mode("overwrite").save()
        assert joined.count() == 300_000
        joined.collect()
        assert "skew=true" in plan_text(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_search_and_grouping_of_nothing(spark):
    empty = spark.createDataFrame([], "id int, amount int")
    assert O.top_k(empty, ["id"], 3).count() == 0
    assert J.no_match(empty, empty, "id").count() == 0
    assert L.intersect(empty, empty).count() == 0


# Given partitions and hot keys


def task_rows(df, partitions):
    counted = {r["pid"]: r["rows"] for r in L.partition_profile(df).collect()}
    return sorted(counted.get(n, 0) for n in range(partitions))


def test_join_in_given_partitions_cuts_hot_keys(spark, rows):
    left = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id % 500 END AS k", "id AS a")
    right = spark.range(700).selectExpr("CASE WHEN id < 200 THEN id - 1 WHEN id < 230 THEN -1 ELSE NULL END AS k", "id AS b")
    plain = left.join(right, "k")
    split = J.inner_join(left, right, "k", 8)
    assert split.columns == plain.columns
    assert split.groupBy("k").agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")).exceptAll(
        plain.groupBy("k").agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    ).isEmpty()
    assert split.count() == plain.count()
    sizes = task_rows(split, 8)
    assert sizes[-1] < 2 * sizes[4]
    assert task_rows(left.repartition(8, "k").join(right.repartition(8, "k"), "k"), 8)[-1] > 3 * sizes[4]


def test_spread_can_split_hot_keys(spark, rows):
    df = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id % 300 END AS k", "id")
    split = L.spread(df, 6, "k", split_hot=True)
    assert split.columns == df.columns and rows(split) == rows(df)
    sizes = task_rows(split, 6)
    assert sizes[-1] < 2 * sizes[3]


def test_positions_equal_a_sort(spark):
    df = spark.range(500).selectExpr("id * 37 % 50 AS v", "id % 7 AS w", "id").repartition(6)
    placed = O.with_position(df, ["-v", "w"]).orderBy("position").collect()
    wanted = sorted(((r["v"], r["w"], r["id"]) for r in df.collect()), key=lambda r: (-r[0], r[1], r[2]))
    assert [(r["v"], r["w"], r["id"], r["position"]) for r in placed] == [(*row, n) for n, row in enumerate(wanted, 1)]
    assert O.with_position(df.limit(0), ["v"]).count() == 0
