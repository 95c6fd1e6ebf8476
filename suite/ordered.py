"""Window analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.tables import as_double, as_long, cents, from_cents, money, table
from tablewright.operators import windows as W
from tablewright.operators.ordering import with_position

# Small enough that every user of the test tables counts as hot and is cut into blocks.
BLOCKED = 80


def _events(spark, folder):
    return table(spark, folder, "events").select("user_id", "ts", cents("value").alias("value"))


def _priced_events(spark, folder):
    return table(spark, folder, "events").select("user_id", "ts", money("value").alias("value"))


def _customers(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")


def top_per_group(spark, folder):
    best = W.top_n_per_group(_customers(spark, folder), "c_nationkey", ["-c_acctbal", "c_custkey"], 3)
    return best.withColumns(as_long("c_nationkey", "rank"))


def top_per_group_ties(spark, folder):
    """Ties are made by rounding balances to thousands."""
    rough = _customers(spark, folder).withColumn("c_acctbal", F.floor(F.col("c_acctbal") / 1000))
    best = W.top_n_per_group(rough, "c_nationkey", ["-c_acctbal"], 2, ties="rank")
    return best.withColumns(as_long("c_nationkey", "rank"))


def top_per_group_many(spark, folder):
    """More rows per group than Spark cuts to before the shuffle, groups in blocks."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    best = W.top_n_per_group(
        orders, "o_orderpriority", ["-o_totalprice", "o_orderkey"], 1500, hot_rows=1000
    )
    return best.withColumns(as_long("rank"))


def top_per_group_many_ties(spark, folder):
    """Prices in ten thousands tie often, also at the last rank."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority", F.floor(F.col("o_totalprice") / 10000).alias("price")
    )
    best = W.top_n_per_group(orders, "o_orderpriority", ["-price"], 1001, ties="rank", hot_rows=500)
    return best.withColumns(as_long("rank"))


def sort_all_position(spark, folder):
    customers = _customers(spark, folder).withColumn("c_acctbal", F.floor(F.col("c_acctbal") / 100))
    return with_position(customers.withColumns(as_long("c_nationkey")), ["-c_acctbal", "c_custkey"]).withColumns(as_long("position"))


def running_total(spark, folder):
    return W.running_total(_events(spark, folder), "user_id", "ts", "value").withColumns(
        from_cents("value", "running_total")
    )


def running_total_ties(spark, folder):
    """Rows of one day share their total."""
    daily = table(spark, folder, "events").select(
        "event_id", "user_id", F.col("ts").cast("date").alias("day"), cents("value").alias("value")
    )
    return W.running_total(daily, "user_id", "day", "value").withColumns(
        from_cents("value", "running_total")
    )


def running_total_blocked(spark, folder):
    total = W.running_total(_events(spark, folder), "user_id", "ts", "value", hot_rows=BLOCKED)
    return total.withColumns(from_cents("value", "running_total"))


def previous_value(spark, folder):
    return W.previous_value(_events(spark, folder), "user_id", "ts", "value").withColumns(
        from_cents("value", "previous")
    )


def previous_value_blocked(spark, folder):
    lagged = W.previous_value(_events(spark, folder), "user_id", "ts", "value", hot_rows=BLOCKED)
    return lagged.withColumns(from_cents("value", "previous"))


def delta(spark, folder):
    return W.delta(_events(spark, folder), "user_id", "ts", "value").withColumns(
        from_cents("value", "difference")
    )


def moving_avg_7(spark, folder):
    return W.moving_avg(_priced_events(spark, folder), "user_id", "ts", "value").withColumns(
        as_double("value", "moving_avg")
    )


def moving_avg_7_blocked(spark, folder):
    means = W.moving_avg(_priced_events(spark, folder), "user_id", "ts", "value", hot_rows=BLOCKED)
    return means.withColumns(as_double("value", "moving_avg"))


def sessionize(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    return W.sessionize(events, "user_id", "ts", 1800)


def sessionize_blocked(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    return W.sessionize(events, "user_id", "ts", 1800, hot_rows=BLOCKED)


QUERIES = {
    "top_per_group": top_per_group,
    "top_per_group_ties": top_per_group_ties,
    "top_per_group_many": top_per_group_many,
    "top_per_group_many_ties": top_per_group_many_ties,
    "sort_all_position": sort_all_position,
    "running_total": running_total,
    "running_total_ties": running_total_ties,
    "running_total_blocked": running_total_blocked,
    "previous_value": previous_value,
    "previous_value_blocked": previous_value_blocked,
    "delta": delta,
    "moving_avg_7": moving_avg_7,
    "moving_avg_7_blocked": moving_avg_7_blocked,
    "sessionize": sessionize,
    "sessionize_blocked": sessionize_blocked,
}

_V = "CAST(value AS DECIMAL(18, 2))"
_RUNNING = f"""SELECT user_id, ts, CAST({_V} AS DOUBLE) AS value,
    CAST(sum({_V}) OVER (PARTITION BY user_id ORDER BY ts) AS DOUBLE) AS running_total FROM events"""
_PREVIOUS = f"""SELECT user_id, ts, CAST({_V} AS DOUBLE) AS value,
    CAST(lag({_V}) OVER (PARTITION BY user_id ORDER BY ts) AS DOUBLE) AS previous FROM events"""
_MOVING = f"""SELECT user_id, ts, CAST({_V} AS DOUBLE) AS value,
    CAST(round(CAST(CAST(sum({_V}) OVER w AS DOUBLE) / count(*) OVER w AS DECIMAL(22, 6)), 2) AS DOUBLE)
        AS moving_avg
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""
_SESSIONS = """
    WITH marked AS (
        SELECT event_id, user_id, ts, CASE WHEN lag(ts) OVER w IS NULL
            OR floor(epoch(ts)) - floor(epoch(lag(ts) OVER w)) > 1800 THEN 1 ELSE 0 END AS start
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
    SELECT event_id, user_id, ts,
        CAST(sum(start) OVER (PARTITION BY user_id ORDER BY ts) AS BIGINT) AS session_num FROM marked"""

ORACLE = {
    "top_per_group": """SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal,
        row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank
        FROM customer QUALIFY rank <= 3""",
    "top_per_group_ties": """SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
        CAST(floor(c_acctbal / 1000) AS BIGINT) AS c_acctbal,
        rank() OVER (PARTITION BY c_nationkey ORDER BY floor(customer.c_acctbal / 1000) DESC) AS rank
        FROM customer QUALIFY rank <= 2""",
    "top_per_group_many": """SELECT o_orderkey, o_orderpriority, o_totalprice,
        row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank
        FROM orders QUALIFY rank <= 1500""",
    "top_per_group_many_ties": """SELECT o_orderkey, o_orderpriority, CAST(floor(o_totalprice / 10000) AS BIGINT) AS price,
        rank() OVER (PARTITION BY o_orderpriority ORDER BY floor(o_totalprice / 10000) DESC) AS rank
        FROM orders QUALIFY rank <= 1001""",
    "sort_all_position": """SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
        CAST(floor(c_acctbal / 100) AS BIGINT) AS c_acctbal,
        row_number() OVER (ORDER BY floor(customer.c_acctbal / 100) DESC, c_custkey) AS position FROM customer""",
    "running_total": _RUNNING,
    "running_total_ties": f"""SELECT event_id, user_id, CAST(ts AS DATE) AS day,
        CAST({_V} AS DOUBLE) AS value,
        CAST(sum({_V}) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS DOUBLE) AS running_total
        FROM events""",
    "running_total_blocked": _RUNNING,
    "previous_value": _PREVIOUS,
    "previous_value_blocked": _PREVIOUS,
    "delta": f"""SELECT user_id, ts, CAST({_V} AS DOUBLE) AS value,
        CAST({_V} - lag({_V}, 1, 0) OVER (PARTITION BY user_id ORDER BY ts) AS DOUBLE) AS difference
        FROM events""",
    "moving_avg_7": _MOVING,
    "moving_avg_7_blocked": _MOVING,
    "sessionize": _SESSIONS,
    "sessionize_blocked": _SESSIONS,
}
