from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablewright.functions import registered
from tablewright.functions import scalars as S
from tablewright.functions import text as T
from tablewright.plans.text import log_profile, word_count


def apply(spark, column, values, kind="string"):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")
    return [row[0] for row in df.orderBy("n").select(column.alias("r")).collect()]


def test_email(spark):
    values = [" a.b+c@x-y.co.uk ", "no at", "a@b", None, "a b@c.de"]
    assert apply(spark, S.email_or_null("v"), values) == ["a.b+c@x-y.co.uk", None, None, None, None]


def test_phone(spark):
    values = ["(555) 123-4567", "+44 555 123 4567", "1-555-123-4567", "12-34", None, "5551234567 "]
    assert apply(spark, S.phone_or_null("v"), values) == [
        "+15551234567", "+445551234567", "+115551234567", None, None, "+15551234567",
    ]
    assert apply(spark, S.phone_or_null("v", dedupe_country_code=True), values)[2] == "+15551234567"


def test_money_and_percent(spark):
    got = apply(spark, S.money("v"), ["$1,234.50", "12.999", "free", None])
    assert [None if v is None else str(v) for v in got] == ["1234.50", "13.00", None, None]
    whole = apply(spark, S.money("v", "decimal(10,0)"), ["12.50"])
    assert str(whole[0]) == "13"
    assert apply(spark, S.percent("v"), ["12.5", "150", "-5", "ten", None]) == [12.5, 100.0, None, None, None]


def test_clamps(spark):
    assert apply(spark, S.at_least_zero("v"), [-3, 4, None], "int") == [0, 4, 0]
    assert apply(spark, S.at_least_zero("v", False), [-3, None], "int") == [0, None]
    assert apply(spark, S.clamp("v", 0, 100), [-1.0, 5.0, 101.0, None], "double") == [0.0, 5.0, 100.0, None]


def test_truth_words(spark):
    values = ["TRUE", "Yes", "y", " Yes", "no", None]
    assert apply(spark, S.truth("v"), values) == [True, True, True, False, False, False]
    assert apply(spark, S.truth("v", trim=True), values)[3] is True


def test_labels(spark):
    assert apply(spark, S.label_bucket("v"), [29, 30, 64, 65], "int") == [
        "Spring Chicken", "Senior Dev", "Senior Dev", "DEAD",
    ]
    assert apply(spark, S.format_label("<{}>", "v"), ["x", None]) == ["<x>", "<None>"]
    with pytest.raises(ValueError):
        S.format_label("{}{}", "v")


def test_division_and_seconds(spark):
    df = spark.createDataFrame([(6.0, 3.0), (1.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(S.safe_divide("a", "b")).collect()] == [2.0, 0.0]
    times = spark.sql("SELECT timestamp'2024-01-01 00:00:01.9' AS a, timestamp'2024-01-01 00:00:03.1' AS b")
    assert times.select(S.seconds_between("b", "a")).first()[0] == 2


@pytest.mark.parametrize(
    ("tokenizer", "expected"),
    [
        ("whitespace", {"Don't": 1, "don't": 1, "naïve,": 1, "X_1": 1}),
        ("ascii", {"don": 2, "t": 2, "na": 1, "ve": 1, "x_1": 1}),
        ("regex", {"don": 2, "t": 2, "naïve": 1, "x_1": 1}),
    ],
)
def test_word_counts(spark, tokenizer, expected):
    df = spark.createDataFrame([("Don't  don't naïve, X_1 ",), (None,), ("",)], "text string")
    got = word_count(df, "text", tokenizer)
    assert {row["word"]: row["count"] for row in got.collect()} == expected


def test_word_pattern_keeps_a_spaced_apostrophe(spark):
    df = spark.createDataFrame([("rock 'n roll",)], "text string")
    assert {row["word"] for row in word_count(df, "text", "regex").collect()} == {"rock 'n", "roll"}


def test_word_counts_are_ordered(spark):
    df = spark.createDataFrame([("b a b c a b",)], "text string")
    assert [tuple(r) for r in word_count(df, "text").collect()] == [("b", 3), ("a", 2), ("c", 1)]
    with pytest.raises(ValueError):
        word_count(df, "text", "other")


TAGS = ["Learn #AI with #ML", "none", None, "", "#été!"]


def test_hashtags(spark, rows):
    df = spark.createDataFrame([(t,) for t in TAGS], "text string")
    assert rows(T.hashtags(df, "text"), "hashtag") == [("#AI",), ("#ML",), ("#été",)]
    assert apply(spark, T.hashtag_count("v"), TAGS) == [2, 0, None, None, 1]


def test_registered_functions_agree_with_built_ins(spark, rows):
    registered.register_functions(spark)
    df = spark.createDataFrame([(t,) for t in TAGS], "text string")
    df.createOrReplaceTempView("tag_texts")
    counted = df.selectExpr(f"{registered.COUNT_HASHTAG}(text) AS n")
    assert rows(counted) == rows(df.select(T.hashtag_count("text")))
    lateral = spark.sql(f"SELECT hashtag FROM tag_texts, LATERAL {registered.HASHTAG_TABLE}(text)")
    assert rows(lateral) == rows(T.hashtags(df, "text"), "hashtag")


def test_registered_functions_in_plain_sql(spark, rows):
    registered.register_functions(spark)
    one = spark.sql(f"SELECT {registered.COUNT_HASHTAG}('to #Spark and #BigData') AS n")
    assert rows(one) == [(2,)]
    table = spark.sql(f"SELECT * FROM {registered.HASHTAG_TABLE}('to #Spark and #BigData!')")
    assert rows(table) == [("#BigData",), ("#Spark",)]
    label = spark.sql(f"SELECT {registered.LABEL}('Ann', CAST(NULL AS string)) AS l")
    assert rows(label) == [("Name: Ann, Age: None",)]


def test_log_profile(spark, rows):
    lines = [
        '1.1.1.1 - - [d z] "GET /a HTTP/1.1" 200 5',
        '1.1.1.1 - - [d z] "GET /b HTTP/1.1" 404 5',
        "2.2.2.2 short",
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    assert rows(log_profile(df)) == [
        ("endpoint", None, 0), ("endpoint", "/a", 1), ("endpoint", "/b", 1),
        ("ip", "1.1.1.1", 2), ("ip", "2.2.2.2", 1),
        ("status", None, 0), ("status", "200", 1), ("status", "404", 1),
    ]


def test_pandas_frames_go_both_ways(spark):
    df = spark.createDataFrame([(25, 1), (96, 2)], "age int, id int")
    frame = df.pandas_api()
    assert frame["age"].mean() == 60.5
    frame["later"] = frame["age"].transform(lambda x: x + 10)
    frame["bracket"] = frame["age"].apply(lambda age: "old" if age > 65 else "young")
    back = frame[frame["age"] > 30].to_spark()
    assert [tuple(r) for r in back.collect()] == [(96, 2, 106, "old")]
    assert df.select(F.avg("age")).first()[0] == 60.5


def test_one_word_class_in_every_form(spark):
    """Built-in, registered and table function against Python, in many scripts."""
    import re

    from tablewright.functions import registered, text as texts

    samples = ["#हिन्दी #x² #½a #naïve", "#ж_1 #日本 # #é!", "no tags", "#١٢ #Ⅷ a#b##c", ""]
    registered.register_functions(spark)
    df = spark.createDataFrame(list(enumerate(samples)), "n int, text string")
    df.createOrReplaceTempView("word_class_texts")
    expected = sorted((n, tag) for n, sample in enumerate(samples) for tag in re.findall(r"#\w+", sample))
    assert sorted(tuple(r) for r in texts.hashtags(df, "text").select("n", "hashtag").collect()) == expected
    table = spark.sql(f"SELECT n, hashtag FROM word_class_texts, LATERAL {registered.HASHTAG_TABLE}(text)")
    assert sorted(tuple(r) for r in table.collect()) == expected
    words = df.select("n", texts.words("text", "regex").alias("w")).collect()
    for n, found in words:
        assert list(found) == re.findall(r"\b\w+(?: '\w+)*\b", samples[n].lower())
