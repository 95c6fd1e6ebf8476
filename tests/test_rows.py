from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import rows as R
from tests.conftest import plan_text


def test_map_and_flat_map(spark, rows):
    df = spark.createDataFrame([("a b",), (None,), ("c",)], "value string")
    assert rows(R.map_values(df, F.length("value"))) == [(None,), (1,), (3,)]
    assert rows(R.flat_map(df, F.split("value", " "))) == [("a",), ("b",), ("c",)]


def test_filters_on_text(spark, rows):
    df = spark.createDataFrame([("TMAX",), ("",), (None,), ("xTMAXx",)], "kind string")
    assert rows(R.containing(df, "kind", "TMAX")) == [("TMAX",), ("xTMAXx",)]
    assert rows(R.non_empty(df, "kind")) == [("TMAX",), ("xTMAXx",)]


def test_log_words_of_a_level(spark, rows):
    df = spark.createDataFrame(
        [("INFO: fine",), ("ERROR: disk full",), ("no ERROR here",)], "value string"
    )
    assert rows(R.log_words(df, "value", "ERROR")) == [("DISK",), ("ERROR:",), ("FULL",)]


def test_dedup_default_keeps_the_smallest_row(spark, rows):
    df = spark.createDataFrame(
        [(1, "b", 1), (1, "a", 9), (1, "a", 2), (None, "z", 1), (None, None, 5)],
        "id int, name string, n int",
    )
    assert rows(R.dedup(df, ["id"])) == [(None, None, 5), (1, "a", 2)]
    assert R.dedup(df, ["id"]).columns == df.columns


def test_dedup_by_a_given_order(spark, rows):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 9)], "id int, name string, n int")
    assert rows(R.dedup(df, ["id"], ["-name"])) == [(1, "b", 1)]
    assert rows(R.dedup(df, ["id"], ["n"])) == [(1, "b", 1)]
    assert rows(R.dedup(df, ["id"], ["-n"])) == [(1, "a", 9)]


def test_dedup_does_not_depend_on_the_spread_and_is_idempotent(spark, rows):
    rng = random.Random(1)
    data = [(rng.randrange(20), rng.choice("xyz"), rng.random()) for _ in range(300)]
    df = spark.createDataFrame(data, "k int, a string, b double")
    expected = rows(R.dedup(df, ["k"]))
    assert rows(R.dedup(df.repartition(7, "b"), ["k"])) == expected
    assert rows(R.dedup(R.dedup(df, ["k"]), ["k"])) == expected
    assert rows(R.dedup(df, ["k", "a", "b"])) == rows(df.distinct())


def test_dedup_combines_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS v")
    assert "partial_min" in plan_text(R.dedup(df, ["k"]))


def test_null_handling(spark, rows):
    df = spark.createDataFrame([(1, None), (None, "x"), (2, "y")], "a int, b string")
    assert rows(R.drop_nulls(df)) == [(2, "y")]
    assert rows(R.drop_nulls(df, ["a"])) == [(1, None), (2, "y")]
    assert rows(R.fill_nulls(df, 0)) == [(0, "x"), (1, None), (2, "y")]
    assert rows(R.fill_nulls(df, {"b": "none"}), "b") == [("none",), ("x",), ("y",)]


def test_impute_mean_rounds_after_distinct(spark, rows):
    df = spark.createDataFrame([(1, 30), (1, 30), (2, 41), (3, None)], "id int, age int")
    filled = R.impute_mean(R.distinct_rows(df), "age")
    assert rows(filled) == [(1, 30), (2, 41), (3, 36)]
    assert "CartesianProduct" not in plan_text(filled)
    assert "NestedLoop" not in plan_text(filled)


def test_impute_mean_of_nothing_stays_null(spark, rows):
    df = spark.createDataFrame([(1, None)], "id int, age int")
    assert rows(R.impute_mean(df, "age")) == [(1, None)]


def test_flatten_struct(spark, rows):
    df = spark.createDataFrame(
        [((7, ("x", 2.5)),)], "c struct<id: int, o: struct<name: string, amount: double>>"
    )
    flat = R.flatten_struct(df, {"id": "c.id", "amount": "c.o.amount"})
    assert flat.columns == ["id", "amount"]
    assert rows(flat) == [(7, 2.5)]


def test_split_fields_gives_null_for_missing_tokens(spark, rows):
    df = spark.createDataFrame([("a b c",), ("a",)], "value string")
    got = R.split_fields(df, "value", " ", ["x", "y", "z"])
    assert rows(got) == [("a", None, None), ("a", "b", "c")]


def test_parse_delimited(spark, rows):
    df = spark.createDataFrame([("p1,Pen,1.5,3",), ("p2,Ink,x,4",)], "value string")
    got = R.parse_delimited(df, "value", "id string, name string, price double, quantity int")
    assert rows(got) == [("p1", "Pen", 1.5, 3), ("p2", "Ink", None, 4)]


def test_explode_list_keeps_other_columns(spark, rows):
    df = spark.createDataFrame([("Ann", "Math,Art"), ("Bob", None)], "name string, subjects string")
    got = R.explode_list(df, "subjects", ",", "subject")
    assert got.columns == ["name", "subject"]
    assert rows(got) == [("Ann", "Art"), ("Ann", "Math")]


@pytest.mark.parametrize("operator", [R.distinct_rows, lambda d: R.dedup(d, ["a"]), R.drop_nulls])
def test_empty_input(spark, operator):
    assert operator(spark.createDataFrame([], "a int, b string")).count() == 0
