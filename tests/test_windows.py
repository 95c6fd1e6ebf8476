"""Windows: small cases by hand, and hot groups against the ordinary window."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright.operators import windows as W
from tests.conftest import plan_text

DDL = "user string, ts timestamp, amount int"


def at(minute: float) -> datetime.datetime:
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute)


def skewed(seed: int, rows: int = 400, ties: bool = False):
    """Events where one user, and the null user, own most rows; some values are null."""
    rng = random.Random(seed)
    result = []
    for number in range(rows):
        user = rng.choice(["hot"] * 6 + [None, None, "a", "b", "c"])
        minute = rng.randrange(80) * 7 if ties else number * 11 + rng.random() * 10
        amount = None if rng.random() < 0.1 else rng.randrange(-50, 100)
        result.append((user, at(minute), amount))
    return result


def test_running_total_shares_tied_rows(spark, rows):
    df = spark.createDataFrame(
        [("a", at(0), 1), ("a", at(1), 2), ("a", at(1), 3), ("a", at(2), None), ("b", at(0), None)], DDL
    )
    got = rows(W.running_total(df, "user", "ts", "amount"), "user", "amount", "running_total")
    assert got == [
        ("a", None, 6), ("a", 1, 1), ("a", 2, 6), ("a", 3, 6), ("b", None, None),
    ]


def test_running_total_by_rows(spark, rows):
    df = spark.createDataFrame([("a", at(0), 1), ("a", at(1), 2), ("a", at(2), 3)], DDL)
    got = rows(W.running_total(df, "user", "ts", "amount", frame="rows"), "running_total")
    assert got == [(1,), (3,), (6,)]


def test_previous_and_delta(spark, rows):
    df = spark.createDataFrame([("a", at(0), 5), ("a", at(1), 7), ("b", at(0), 4)], DDL)
    assert rows(W.previous_value(df, "user", "ts", "amount"), "user", "amount", "previous") == [
        ("a", 5, None), ("a", 7, 5), ("b", 4, None),
    ]
    assert rows(W.delta(df, "user", "ts", "amount"), "user", "difference") == [
        ("a", 2), ("a", 5), ("b", 4),
    ]


def test_moving_avg_counts_rows_not_days(spark, rows):
    df = spark.createDataFrame([("a", at(n * 60 * 48), n) for n in range(1, 10)], DDL)
    got = rows(W.moving_avg(df, "user", "ts", "amount"), "amount", "moving_avg")
    assert got[0] == (1, 1.0)
    assert got[6] == (7, 4.0)
    assert got[8] == (9, 6.0)


def test_sessions_break_only_above_the_gap(spark, rows):
    df = spark.createDataFrame(
        [("a", at(0), 0), ("a", at(30), 0), ("a", at(60.05), 0), ("a", at(60.05), 1), ("b", at(5), 0)], DDL
    )
    assert rows(W.sessionize(df, "user", "ts"), "user", "session_num") == [
        ("a", 1), ("a", 1), ("a", 2), ("a", 2), ("b", 1),
    ]


def test_sessions_cut_times_to_whole_seconds(spark, rows):
    first = datetime.datetime(2024, 1, 1, 0, 0, 0, 900_000)
    later = datetime.datetime(2024, 1, 1, 0, 30, 1, 100_000)
    df = spark.createDataFrame([("a", first, 0), ("a", later, 0)], DDL)
    assert rows(W.sessionize(df, "user", "ts"), "session_num") == [(1,), (2,)]


OPERATORS = {
    "running_total": lambda df, hot: W.running_total(df, "user", "ts", "amount", hot_rows=hot),
    "previous": lambda df, hot: W.previous_value(df, "user", "ts", "amount", hot_rows=hot),
    "three_back": lambda df, hot: W.previous_value(
        df, "user", "ts", "amount", offset=3, default=-1, hot_rows=hot
    ),
    "delta": lambda df, hot: W.delta(df, "user", "ts", "amount", hot_rows=hot),
    "moving_avg": lambda df, hot: W.moving_avg(df, "user", "ts", "amount", hot_rows=hot),
    "sessionize": lambda df, hot: W.sessionize(df, "user", "ts", hot_rows=hot),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
@pytest.mark.parametrize("hot", [0, 3, 60])
def test_hot_groups_give_the_ordinary_result(spark, rows, name, hot):
    df = spark.createDataFrame(skewed(seed=hot), DDL).repartition(5)
    plain, split = OPERATORS[name](df, None), OPERATORS[name](df, hot)
    assert split.schema.simpleString() == plain.schema.simpleString()
    assert rows(split) == rows(plain)


@pytest.mark.parametrize("name", ["running_total", "sessionize"])
def test_hot_groups_with_tied_times(spark, rows, name):
    df = spark.createDataFrame(skewed(seed=9, ties=True), DDL)
    assert rows(OPERATORS[name](df, 4)) == rows(OPERATORS[name](df, None))


def test_hot_groups_along_dates_and_with_null_times(spark, rows):
    data = [("hot", None if n % 9 == 0 else datetime.date(2024, 1, 1 + n % 28), n) for n in range(90)]
    df = spark.createDataFrame(data, "user string, day date, amount int")
    plain = W.running_total(df, "user", "day", "amount", hot_rows=None)
    assert rows(W.running_total(df, "user", "day", "amount", hot_rows=5)) == rows(plain)


def test_bursts_in_one_block_stay_right(spark, rows):
    data = [("hot", at(0 if n < 50 else n * n), n) for n in range(80)]
    df = spark.createDataFrame(data, DDL)
    assert rows(OPERATORS["running_total"](df, 2)) == rows(OPERATORS["running_total"](df, None))


def test_hot_groups_along_numbers_with_every_special_value(spark, rows):
    special = [None, float("-inf"), float("inf"), float("nan")]
    data = [("hot", special[n % 4] if n % 5 == 0 else float(n * n % 37), n) for n in range(80)]
    df = spark.createDataFrame(data, "user string, at double, amount int")
    plain = W.running_total(df, "user", "at", "amount", hot_rows=None)
    split = W.running_total(df, "user", "at", "amount", hot_rows=4)
    assert rows(split, "amount", "running_total") == rows(plain, "amount", "running_total")


def test_hot_groups_along_text_order(spark, rows):
    data = [("a", f"t{n * 7 % 30:02d}", n) for n in range(60)] + [("b", None, 1), ("b", "x", 2)]
    df = spark.createDataFrame(data, "user string, ts string, amount int")
    plain = W.running_total(df, "user", "ts", "amount", hot_rows=None)
    assert rows(W.running_total(df, "user", "ts", "amount", hot_rows=1)) == rows(plain)


def test_top_n_rows_and_ties(spark, rows):
    df = spark.createDataFrame(
        [("x", "p", 9), ("x", "q", 9), ("x", "r", 8), ("x", "s", 7), ("y", "t", 1), (None, "u", 2)],
        "department string, employee string, salary int",
    )
    best = W.top_n_per_group(df, "department", ["-salary", "employee"], 1)
    assert rows(best, "department", "employee") == [(None, "u"), ("x", "p"), ("y", "t")]
    tied = W.top_n_per_group(df, "department", ["-salary"], 1, ties="rank")
    assert rows(tied, "employee") == [("p",), ("q",), ("t",), ("u",)]
    three = W.top_n_per_group(df, "department", ["-salary"], 3, ties="rank")
    assert rows(three.filter("department = 'x'"), "employee", "rank") == [("p", 1), ("q", 1), ("r", 3)]
    two = W.top_n_per_group(df, "department", ["-salary"], 2, ties="rank")
    assert rows(two.filter("department = 'x'"), "employee") == [("p",), ("q",)]


@pytest.mark.parametrize("n", [1, 2, 5])
def test_ties_equal_the_rank_window(spark, rows, n):
    rng = random.Random(n)
    data = [(rng.choice("ab"), rng.choice([None, 1, 2, 3]), i) for i in range(60)]
    df = spark.createDataFrame(data, "g string, v int, id int")
    got = W.top_n_per_group(df, "g", ["-v"], n, ties="rank")
    window = W.Window.partitionBy("g").orderBy(F.col("v").desc())
    expected = df.withColumn("rank", F.rank().over(window)).filter(F.col("rank") <= n)
    assert rows(got) == rows(expected)


def test_top_n_is_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS g", "id AS v")
    text = plan_text(W.top_n_per_group(df, "g", ["-v"], 2))
    partial, shuffle = text.index("Partial"), text.index("Exchange")
    assert shuffle < partial  # printed from the top, so the cut lies below the shuffle


def test_windows_over_one_partitioning_share_one_shuffle(spark):
    df = spark.createDataFrame([("a", at(0), 1)], DDL)
    chained = W.running_total(df, "user", "ts", "amount", hot_rows=None)
    for operator in (W.previous_value, W.delta, W.moving_avg):
        chained = operator(chained, "user", "ts", "amount", hot_rows=None)
    assert plan_text(chained).count("Exchange") == 1


def test_sessions_per_user_equal_breaks_plus_one(spark, rows):
    df = spark.createDataFrame([r for r in skewed(4) if r[0]], DDL)
    numbered = W.sessionize(df, "user", "ts", 3600)
    lagged = W.previous_value(df.withColumn("s", F.unix_timestamp("ts")), "user", "ts", "s")
    breaks = lagged.groupBy("user").agg(
        (F.count(F.when(F.col("s") - F.col("previous") > 3600, 1)) + 1).alias("n")
    )
    assert rows(numbered.groupBy("user").agg(F.max("session_num"))) == rows(breaks)


@pytest.mark.parametrize("hot", [None, 0, 5])
def test_empty_and_single_rows(spark, rows, hot):
    empty = spark.createDataFrame([], DDL)
    single = spark.createDataFrame([("a", at(0), 4)], DDL)
    for operator in OPERATORS.values():
        assert operator(empty, hot).count() == 0
        assert operator(single, hot).count() == 1
    assert rows(OPERATORS["moving_avg"](single, hot), "moving_avg") == [(4.0,)]
    assert rows(OPERATORS["sessionize"](single, hot), "session_num") == [(1,)]


def test_a_hot_group_moves_once_and_in_blocks(spark):
    df = spark.createDataFrame(skewed(1), DDL)
    text = plan_text(W.running_total(df, "user", "ts", "amount", hot_rows=50))
    assert "Exchange hashpartitioning(_group" in text
    # One shuffle for ordinary groups, one for hot rows, and the block table's own.
    assert text.count("Exchange hashpartitioning") <= 5


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "timestamp_ntz", "double"])
def test_results_do_not_depend_on_the_limit(spark, zone, kind):
    """Text, dates, times with and without a zone, across both clock changes, with ties."""
    ordered = {
        "string": "concat('k', lpad(cast(t as string), 6, '0'))",
        "date": "date_add(date'2024-03-01', cast(t / 6 as int))",
        "timestamp": "timestamp_seconds(1709942400 + t * 1800)",
        "timestamp_ntz": "timestampadd(MINUTE, cast(t * 30 as int), timestamp_ntz'2024-03-09 12:00:00')",
        "double": "cast(t as double) / 7",
    }[kind]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.range(150).selectExpr("cast(id % 3 as int) g", "cast(id / 3 as int) DIV 2 t", "id * 7 % 11 v", "id")
        df = rows.selectExpr("g", f"{ordered} AS o", "v", "id").repartition(3)
        calls = [
            lambda limit: W.running_total(df, "g", "o", "v", hot_rows=limit),
            lambda limit: W.previous_value(df, "g", "o", "v", hot_rows=limit),
            lambda limit: W.delta(df, "g", "o", "v", hot_rows=limit),
            lambda limit: W.moving_avg(df, "g", "o", "v", 4, hot_rows=limit),
        ]
        if kind.startswith("timestamp"):
            calls.append(lambda limit: W.sessionize(df, "g", "o", 1799, hot_rows=limit))
        for call in calls:
            plain = sorted(map(tuple, call(None).collect()), key=lambda row: row[3])
            assert sorted(map(tuple, call(40).collect()), key=lambda row: row[3]) == plain
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_gaps_of_zoneless_times_ignore_the_session_zone(spark):
    times = spark.sql("SELECT 1 AS u, explode(array(timestamp_ntz'2024-03-10 01:45:00', timestamp_ntz'2024-03-10 03:10:00')) AS ts")
    before = spark.conf.get("spark.sql.session.timeZone")
    found = []
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        found.append(sorted(row["session_num"] for row in W.sessionize(times, "u", "ts", 1800).collect()))
    spark.conf.set("spark.sql.session.timeZone", before)
    assert found == [[1, 2], [1, 2]]


def test_one_outlier_does_not_void_the_blocks(spark):
    df = spark.range(20_000).selectExpr(
        "1 AS g", "CASE WHEN id = 0 THEN timestamp'1970-01-01' ELSE timestamp_seconds(1700000000 + id) END AS o", "id AS v"
    )
    _, heavy = W._with_blocks(df, ["g"], ["o"], 1000)
    assert max(row["count"] for row in heavy.groupBy(W.BLOCK).count().collect()) < 2000


# Numbers and best rows of groups of any size


def numbered_rows():
    rng = random.Random(6)
    return [(rng.choice(["hot"] * 9 + ["a", None]), rng.choice([None, *range(30)]), n) for n in range(600)]


@pytest.mark.parametrize("hot_rows", [None, 5, 100])
def test_row_numbers(spark, rows, hot_rows):
    data = numbered_rows()
    df = spark.createDataFrame(data, "g string, v int, n int").repartition(5)
    wanted = []
    for group in {g for g, _, _ in data}:
        members = sorted((row for row in data if row[0] == group), key=lambda row: (row[1] is None, -(row[1] or 0), row[2]))
        wanted += [(n, number) for number, (_, _, n) in enumerate(members, 1)]
    got = W.row_numbers(df, "g", ["-v"], hot_rows=hot_rows)
    assert rows(got, "n", "row_number") == sorted(wanted)


@pytest.mark.parametrize("ties", ["row", "rank"])
@pytest.mark.parametrize("n", [1000, 1001, 1500])
def test_top_n_beyond_the_group_limit(spark, rows, ties, n):
    df = spark.range(6000).selectExpr("id % 4 < 3 AS g", "id * 7919 % 700 AS v", "id")
    function = F.rank() if ties == "rank" else F.row_number()
    window = Window.partitionBy("g").orderBy(F.desc("v"), *([] if ties == "rank" else ["id"]))
    wanted = df.withColumn("rank", function.over(window)).filter(F.col("rank") <= n)
    assert rows(W.top_n_per_group(df, "g", ["-v"], n, ties=ties, hot_rows=300)) == rows(wanted)


def test_no_task_holds_a_hot_group(spark):
    df = spark.range(40_000).selectExpr("0 AS g", "id * 7919 % 40009 AS v")
    _, heavy = W._with_blocks(df, ["g"], ["-v"], 1000)
    sizes = [row["count"] for row in heavy.groupBy(W.BLOCK).count().collect()]
    assert len(sizes) > 40 and max(sizes) <= 1000
    best = W.top_n_per_group(df, "g", ["-v"], 1001, hot_rows=1000)
    assert [row["v"] for row in best.orderBy("rank").collect()] == sorted((r["v"] for r in df.collect()), reverse=True)[:1001]


def test_a_low_limit_makes_no_more_blocks_than_tasks(spark, rows):
    """Ten thousand rows above a limit of one would be 20,000 blocks, each a task and a file."""
    df = spark.range(10_000).selectExpr("id % 2 AS part", "id", "id % 7 AS value")
    _, heavy = W._with_blocks(df, ["part"], ["id"], 1)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert heavy.count() == 10_000
    assert 2 < heavy.select("_block").distinct().count() <= tasks * W.OVERSPLIT
    best = W.top_n_per_group(df, "part", ["-id"], 1001, hot_rows=1)
    assert rows(best.filter("rank = 1001"), "part", "id") == [(0, 7998), (1, 7999)]
