from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from tablewright.operators import aggregates as A
from tests.conftest import plan_text

DDL = "k string, v int"


def test_counts_and_null_groups(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], DDL)
    assert rows(A.group_count(df, "k")) == [(None, 1), ("a", 2)]
    assert rows(A.count_non_null(df, "k", "v")) == [(None, 1), ("a", 1)]
    assert rows(A.count_non_null(df, "k", "k")) == [(None, 0), ("a", 2)]


def test_sums_averages_extremes(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], DDL)
    assert rows(A.group_sum(df, "k", "v")) == [("a", 3), ("b", None)]
    assert rows(A.group_avg(df, "k", "v", digits=1)) == [("a", 1.5), ("b", None)]
    assert rows(A.group_min_max(df, "k", "v")) == [("a", 1, 2), ("b", None, None)]


def test_histogram_is_ordered(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (2,), (1,), (3,)], "v int")
    assert [tuple(r) for r in A.value_histogram(df, "v").collect()] == [(3, 3), (1, 2), (2, 1)]


def test_reduce_and_fold(spark, rows):
    df = spark.createDataFrame([(10,), (5,), (8,)], "v int")
    assert rows(A.global_reduce(df, "v")) == [(23, 10, 5, 3)]
    assert rows(A.fold_sum(df, "v")) == [(23,)]
    assert rows(A.fold_sum(df, "v", 100)) == [(123,)]
    assert rows(A.fold_sum(df.filter("v < 0"), "v")) == [(0,)]


def test_collect_values_sorts_and_drops_nulls(spark, rows):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", None), ("a", 1)], DDL)
    got = rows(A.collect_values(df, "k", "v"))
    assert got == [("a", 0, [1, 1, 3])]


def test_collect_values_cuts_every_key_by_one_rule(spark):
    rng = random.Random(3)
    data = [("hot", 7)] * 120 + [("hot", rng.randrange(40)) for _ in range(85)]
    data += [("cold", 5), ("cold", 4), (None, 1), ("full", None)] + [("full", n) for n in range(40)]
    df = spark.createDataFrame(data, DDL).repartition(4)
    got = A.collect_values(df, "k", "v", hot_rows=20).collect()
    for key in ("hot", "cold", None, "full"):
        values = sorted(v for k, v in data if k == key and v is not None)
        wanted = [values[i : i + 20] for i in range(0, len(values), 20)]
        chunks = sorted((row["chunk"], row["values"]) for row in got if row["k"] == key)
        assert chunks == list(enumerate(wanted))


def test_exact_quantiles(spark):
    values = [5] * 50 + list(range(100, 130)) + [-3] * 19 + [None] * 7
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(3)
    kept = sorted(v for v in values if v is not None)
    shares = [0.0, 0.19, 0.2, 0.5, 0.7, 0.75, 1.0]
    wanted = {s: kept[max(1, math.ceil(round(s * len(kept), 9))) - 1] for s in shares}
    for hot_rows in (None, 4):
        assert {r["share"]: r["value"] for r in A.exact_quantiles(df, "v", shares, hot_rows).collect()} == wanted
    assert A.exact_quantiles(df.filter("v > 999"), "v", [0.5]).collect() == [(0.5, None)]


def test_pivot_fills_gaps(spark, rows):
    df = spark.createDataFrame(
        [("Jan", "pen", 2), ("Jan", "pen", 3), ("Feb", "ink", 4)], "month string, product string, sales int"
    )
    for values in (["ink", "pen"], None):
        wide = A.pivot_sum(df, "month", "product", "sales", values)
        assert wide.columns == ["month", "ink", "pen"]
        assert rows(wide) == [("Feb", 4, 0), ("Jan", 0, 5)]


def test_split_duplicates(spark, rows):
    df = spark.createDataFrame([("x",), ("y",), ("x",), (None,), (None,)], "email string")
    repeated, single = A.split_duplicates(df, "email")
    assert rows(repeated) == [("x", 2)]
    assert rows(single) == [(None, 0), ("y", 1)]


def test_summary_stats_quartiles_are_values(spark):
    df = spark.createDataFrame([(25,), (30,), (28,), (96,), (32,), (None,)], "age int")
    got = A.summary_stats(df, "age").first().asDict()
    assert (got["count"], got["min"], got["q1"], got["median"], got["q3"], got["max"]) == (
        5, 25, 28, 30, 32, 96,
    )
    assert round(got["std"], 4) == 30.1861


def test_salted_sum_equals_plain_sum(spark, rows):
    rng = random.Random(5)
    data = [(rng.choice(["hot"] * 8 + ["a", None]), rng.randrange(100)) for _ in range(500)]
    df = spark.createDataFrame(data, DDL)
    assert rows(A.salted_sum(df, "k", "v", 16)) == rows(A.group_sum(df, "k", "v"))


def test_grouping_combines_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    assert "partial_sum" in plan_text(A.group_sum(df, "k", "v"))
    assert "partial_sum" in plan_text(A.pivot_sum(df.withColumn("p", F.lit("x")), "k", "p", "v", ["x"]))
