"""Rows, joins, aggregates, sorts, sets and partition layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.tables import as_double, as_long, cents, from_cents, money, table
from tablewright.functions import scalars as S
from tablewright.operators import aggregates as A
from tablewright.operators import joins as J
from tablewright.operators import layout as L
from tablewright.operators import ordering as O
from tablewright.operators import rows as R
from tablewright.plans import reports

# All orders; two of three customers have none.
OWNER = "o_custkey - o_custkey % 3"


def _placed_orders(spark, folder):
    return table(spark, folder, "orders").selectExpr("o_orderkey", f"{OWNER} AS c_custkey", "o_totalprice")


def _customers(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", "c_name")


def select_columns(spark, folder):
    return table(spark, folder, "part").select("p_partkey", "p_name").drop("p_name")


def computed_column(spark, folder):
    part = table(spark, folder, "part")
    return part.select(
        "p_partkey",
        (F.col("p_size") + 100).cast("long").alias("size_plus"),
        (money("p_retailprice") * F.lit(0.1).cast("decimal(2,1)")).cast("double").alias("bonus"),
    )


def map_values(spark, folder):
    size = F.col("p_size").cast("long")
    return R.map_values(table(spark, folder, "part"), size * size, "square")


def prefixed_values(spark, folder):
    prefixed = F.concat(F.lit("num_"), F.col("p_size").cast("string"))
    return R.map_values(table(spark, folder, "part"), prefixed, "label")


def flat_map(spark, folder):
    words = R.flat_map(table(spark, folder, "part"), F.split("p_name", " "), "word")
    return words.select("word", F.length("word").cast("long").alias("length"))


def filter_rows(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_type")
    wanted = ((F.col("p_size") <= 35) & (F.col("p_type") == "PROMO")) | (F.col("p_size") % 2 == 0)
    return part.filter(wanted).withColumns(as_long("p_size"))


def containing(spark, folder):
    return R.containing(table(spark, folder, "part").select("p_partkey", "p_name"), "p_name", "ring")


def non_empty(spark, folder):
    part = table(spark, folder, "part").select(
        "p_partkey", F.expr("CASE WHEN p_size % 4 = 0 THEN '' WHEN p_size % 4 = 1 THEN NULL ELSE p_name END").alias("p_name")
    )
    return R.non_empty(part, "p_name")


def distinct_rows(spark, folder):
    return R.distinct_rows(table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey"))


def dedup(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    return R.dedup(lines, ["l_orderkey"])


def drop_nulls(spark, folder):
    part = table(spark, folder, "part").select(
        "p_partkey",
        F.expr("nullif(p_size, 7)").cast("long").alias("size"),
        F.expr("nullif(p_brand, 'Brand#4')").alias("brand"),
    )
    return R.drop_nulls(part, ["size", "brand"])


def fill_nulls(spark, folder):
    part = table(spark, folder, "part").select(
        "p_partkey",
        F.expr("nullif(p_size, 7)").cast("long").alias("size"),
        F.expr("nullif(p_brand, 'Brand#4')").alias("brand"),
    )
    return R.fill_nulls(part, {"size": 0, "brand": "none"})


def impute_mean(spark, folder):
    part = table(spark, folder, "part").select(
        "p_partkey", F.expr("CASE WHEN p_partkey % 5 <> 0 THEN p_size END").alias("p_size")
    )
    return R.impute_mean(part, "p_size").withColumns(as_long("p_size"))


def flatten_struct(spark, folder):
    events = table(spark, folder, "events").select(
        F.struct(
            F.col("event_id").alias("id"),
            F.struct(
                F.from_json("props", "k int").alias("props"), F.col("event_type").alias("kind")
            ).alias("detail"),
        ).alias("event")
    )
    flat = R.flatten_struct(
        events, {"id": "event.id", "kind": "event.detail.kind", "k": "event.detail.props.k"}
    )
    return flat.withColumns(as_long("k"))


def explode_list(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    return R.explode_list(part, "p_name", " ", "word")


def join_inner(spark, folder):
    return J.inner_join(_customers(spark, folder), _placed_orders(spark, folder), "c_custkey")


def join_partitioned(spark, folder):
    return J.inner_join(_customers(spark, folder), _placed_orders(spark, folder), "c_custkey", 16)


_ONE_BUYER = "CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END"


def join_partitioned_hot(spark, folder):
    """A third of all orders belongs to one customer."""
    orders = table(spark, folder, "orders").selectExpr(f"{_ONE_BUYER} AS c_custkey", "o_orderkey", "o_totalprice")
    return J.inner_join(_customers(spark, folder), orders, "c_custkey", 16)


def join_left(spark, folder):
    return J.left_join(_customers(spark, folder), _placed_orders(spark, folder), "c_custkey")


def join_anti(spark, folder):
    return J.no_match(_customers(spark, folder), _placed_orders(spark, folder), "c_custkey")


def join_chain(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customer = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("n_nationkey"),
        F.concat("c_name", F.lit(" "), "c_mktsegment").alias("customer_name"),
    )
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    chained = J.left_join(J.left_join(orders, customer, "c_custkey"), nation, "n_nationkey")
    return chained.select("o_orderkey", "c_custkey", "customer_name", "n_name")


# Every fourth supplier is in a nation that the table doesn't have.
_MOVED = "CASE WHEN s_suppkey % 4 = 0 THEN s_nationkey + 100 ELSE s_nationkey END"


def lookup_default(spark, folder):
    supplier = table(spark, folder, "supplier").selectExpr("s_suppkey", f"{_MOVED} AS s_nationkey")
    nation = table(spark, folder, "nation")
    named = J.lookup(supplier, nation, "s_nationkey", "n_name", "Unknown", dim_key="n_nationkey")
    return named.withColumns(as_long("s_nationkey"))


def group_count(spark, folder):
    return A.group_count(table(spark, folder, "orders"), "o_orderpriority")


def group_sum(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", cents("o_totalprice").alias("price"))
    return A.group_sum(orders, "o_custkey", "price", digits=2).withColumns(from_cents("total"))


def group_avg(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderstatus", cents("o_totalprice").alias("price"))
    return A.group_avg(orders, "o_orderstatus", "price").withColumns(from_cents("average"))


def group_avg_rounded(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderstatus", money("o_totalprice").alias("price"))
    return A.group_avg(orders, "o_orderstatus", "price", digits=2).withColumns(as_double("average"))


def group_min_max(spark, folder):
    return A.group_min_max(table(spark, folder, "orders"), "o_custkey", "o_totalprice")


def count_non_null(spark, folder):
    part = table(spark, folder, "part").select(
        F.expr("nullif(p_brand, 'Brand#7')").alias("brand")
    )
    return A.count_non_null(part, "brand", "brand")


def collect_values(spark, folder):
    sizes = R.distinct_rows(table(spark, folder, "part").select("p_brand", "p_size"))
    lists = A.collect_values(sizes, "p_brand", "p_size", "sizes")
    joined = F.array_join(F.transform("sizes", lambda size: size.cast("string")), ",")
    return lists.select("p_brand", "chunk", joined.alias("sizes"))


def collect_values_chunks(spark, folder):
    """Keys with many values, in chunks of a thousand."""
    lists = A.collect_values(table(spark, folder, "lineitem"), "l_returnflag", "l_suppkey", "suppliers", 1000)
    joined = F.array_join(F.transform("suppliers", lambda key: key.cast("string")), ",")
    return lists.select("l_returnflag", "chunk", joined.alias("suppliers"))


def exact_quantiles(spark, folder):
    """Quartiles and tails of a column that ties often, and of one that hardly does."""
    lines = table(spark, folder, "lineitem").select("l_quantity", cents("l_extendedprice").alias("price"))
    shares = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    tied = A.exact_quantiles(lines, "l_quantity", shares).select(F.lit("quantity").alias("column"), "share", F.col("value").cast("double"))
    rare = A.exact_quantiles(lines, "price", shares, hot_rows=1000).withColumns(from_cents("value"))
    return tied.unionByName(rare.select(F.lit("price").alias("column"), "share", "value"))


def value_histogram_position(spark, folder):
    return O.with_position(A.value_histogram(table(spark, folder, "lineitem"), "l_quantity"), ["-count", "l_quantity"]).withColumns(as_long("position"))


def value_histogram(spark, folder):
    return A.value_histogram(table(spark, folder, "lineitem"), "l_quantity")


def global_reduce(spark, folder):
    lines = table(spark, folder, "lineitem").select(money("l_extendedprice").alias("price"))
    return A.global_reduce(lines, "price").withColumns(as_double("total", "high", "low"))


def fold_sum(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_quantity", money("l_extendedprice").alias("price"))
    none = A.fold_sum(lines.filter("l_quantity < 0"), "price", 0, "total")
    every = A.fold_sum(lines, "price", 10, "total")
    result = none.withColumn("case", F.lit("none")).unionByName(every.withColumn("case", F.lit("all")))
    return result.withColumns(as_double("total"))


def pivot_sum(spark, folder):
    events = table(spark, folder, "events").select(
        F.col("ts").cast("date").alias("day"), "event_type", cents("value").alias("value")
    )
    kinds = ["click", "error", "purchase", "signup", "view"]
    wide = A.pivot_sum(events, "day", "event_type", "value", kinds)
    return wide.withColumns(from_cents(*kinds))


def pivot_sum_found(spark, folder):
    """Pivot whose columns are found in the data."""
    events = table(spark, folder, "events").select(
        "user_id", "event_type", cents("value").alias("value")
    )
    wide = A.pivot_sum(events, "user_id", "event_type", "value")
    return wide.withColumns(from_cents(*(c for c in wide.columns if c != "user_id")))


# Every fourth order has a customer of its own.
_BUYER = "CASE WHEN o_orderkey % 4 = 0 THEN -o_orderkey ELSE o_custkey END"


def _span(spark, folder):
    return table(spark, folder, "orders").selectExpr(f"{_BUYER} AS o_custkey")


def duplicate_keys(spark, folder):
    return A.split_duplicates(_span(spark, folder), "o_custkey")[0]


def unique_keys(spark, folder):
    return A.split_duplicates(_span(spark, folder), "o_custkey")[1]


def summary_stats(spark, folder):
    stats = A.summary_stats(table(spark, folder, "part"), "p_size")
    rounded = {name: F.round(name, 6) for name in ("mean", "std")}
    return stats.withColumns({**rounded, **as_long("min", "q1", "median", "q3", "max")})


def pandas_bridge(spark, folder):
    """To a pandas-on-Spark frame, a derived column and a filter there, and back."""
    sizes = table(spark, folder, "part").select("p_partkey", F.col("p_size").cast("long").alias("size"))
    frame = sizes.pandas_api()
    frame["in_ten"] = frame["size"] + 10
    return frame[frame["size"] > 30].to_spark()


def salted_sum(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_partkey", cents("l_extendedprice").alias("price")
    )
    total = A.salted_sum(lines, "l_returnflag", "price", salt_by=["l_orderkey", "l_partkey"])
    return total.withColumns(from_cents("total"))


def sort_all(spark, folder):
    return O.sort_all(table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"), ["o_orderpriority"])


def top_k(spark, folder):
    return O.top_k(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 10)


def bottom_k(spark, folder):
    return O.bottom_k(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 10)


def argmax(spark, folder):
    counts = A.group_count(table(spark, folder, "lineitem"), "l_suppkey")
    return O.argmax(counts, ["-count", "l_suppkey"])


def min_ties(spark, folder):
    counts = A.group_count(table(spark, folder, "orders"), "o_custkey")
    return O.min_ties(counts, "count")


def _buyers(spark, folder, status):
    return table(spark, folder, "orders").filter(F.col("o_orderstatus") == status).select("o_custkey")


def union_all(spark, folder):
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return L.union_all(table(spark, folder, "orders").select("o_custkey"), customers)


def intersect(spark, folder):
    return L.intersect(_buyers(spark, folder, "O"), _buyers(spark, folder, "F"))


def partition_profile(spark, folder):
    """Row total over all partitions of a round-robin spread, shrunk again."""
    lines = L.shrink(L.spread(table(spark, folder, "lineitem").select("l_orderkey"), 16), 4)
    return L.partition_profile(lines).agg(F.sum("rows").alias("rows"))


def partition_by_key(spark, folder):
    """Keys that ended in more than one partition (none) and the row total."""
    lines = L.spread(table(spark, folder, "lineitem").select("l_orderkey"), 16, "l_orderkey")
    placed = L.with_partition_id(lines).groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("pid").alias("first"), F.max("pid").alias("last")
    )
    return placed.agg(
        F.sum("n").alias("rows"), F.count(F.when(F.col("first") != F.col("last"), 1)).alias("torn_keys")
    )


def label_bucket(spark, folder):
    return table(spark, folder, "part").select("p_partkey", S.label_bucket("p_size").alias("label"))


def format_label(spark, folder):
    size = F.expr("nullif(p_size, 7)")
    label = S.format_label("Name: {}, Age: {}", "p_name", size)
    return table(spark, folder, "part").select("p_partkey", label.alias("label"))


def spend_by_customer(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", cents("o_totalprice").alias("price"))
    return reports.spend_by_customer(orders, "o_custkey", "price").withColumns(from_cents("total"))


_PEOPLE = [
    "c_name AS name",
    "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(18 + c_custkey * 13 % 60 AS INT) END AS age",
    "c_mktsegment AS city",
]


def people(spark, folder):
    """Repeated people removed, missing ages filled with the mean, the young left out."""
    listed = table(spark, folder, "customer").selectExpr(*_PEOPLE)
    once = R.distinct_rows(listed.unionByName(listed.filter("age > 40 OR age IS NULL")))
    return R.impute_mean(once, "age").filter("age > 30").withColumns(as_long("age"))


def spend_by_customer_position(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", cents("o_totalprice").alias("price"))
    placed = O.with_position(reports.spend_by_customer(orders, "o_custkey", "price"), ["-total", "o_custkey"])
    return placed.withColumns(from_cents("total") | as_long("position"))


def extreme_by_key(spark, folder):
    events = table(spark, folder, "events")
    kind = F.col("event_type").isin("click", "view")
    return reports.extremes_by_key(events, "user_id", "value", kind)


def _segment_input(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("custy_id"), F.col("c_nationkey").cast("long").alias("city"),
        F.col("c_mktsegment").alias("segment"),
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("custy_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.expr("CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END").alias("amount"),
    )
    # Both inputs get repeated rows for the report to remove.
    return (
        customers.unionByName(customers.filter("custy_id % 10 = 0")),
        orders.unionByName(orders.filter("order_id % 10 = 0")),
    )


def segment_totals_by_city(spark, folder):
    report = reports.segment_report(*_segment_input(spark, folder))
    return report.totals_by_city.withColumns(as_double("total_spendings"))


def segment_average(spark, folder):
    report = reports.segment_report(*_segment_input(spark, folder))
    return report.average_by_segment.withColumns(as_double("avg_spending"))


def segment_top_customers(spark, folder):
    report = reports.segment_report(*_segment_input(spark, folder))
    return report.top_customers.withColumns(as_double("total_spendings"))


QUERIES = {
    name: query
    for name, query in list(globals().items())
    if callable(query) and getattr(query, "__module__", None) == __name__ and not name.startswith("_")
}

_PLACED = f"(SELECT o_orderkey, {OWNER} AS c_custkey, o_totalprice FROM orders) AS r"
_PRICE = "CAST(o_totalprice AS DECIMAL(18, 2))"
_LINE_PRICE = "CAST(l_extendedprice AS DECIMAL(18, 2))"
_VALUE = "CAST(value AS DECIMAL(18, 2))"
_SPOILED = (
    "(SELECT p_partkey, CAST(nullif(p_size, 7) AS BIGINT) AS size, "
    "nullif(p_brand, 'Brand#4') AS brand FROM part) AS s"
)
_SEGMENT = """
    FROM (SELECT DISTINCT c_custkey AS custy_id, CAST(c_nationkey AS BIGINT) AS city,
            c_mktsegment AS segment FROM customer) AS c
    JOIN (SELECT o_custkey AS custy_id, CAST(o_totalprice AS DECIMAL(18, 2)) AS amount
          FROM orders WHERE o_orderkey % 9 <> 0) AS o USING (custy_id)"""


def _pivot(row: str) -> str:
    kinds = ", ".join(
        f"CAST(coalesce(sum({_VALUE}) FILTER (event_type = '{kind}'), 0) AS DOUBLE) AS {kind}"
        for kind in ("click", "error", "purchase", "signup", "view")
    )
    return f"SELECT {row}, {kinds} FROM events GROUP BY 1"


ORACLE = {
    "select_columns": "SELECT p_partkey FROM part",
    "computed_column": """SELECT p_partkey, CAST(p_size + 100 AS BIGINT) AS size_plus,
        CAST(CAST(p_retailprice AS DECIMAL(18, 2)) * CAST(0.1 AS DECIMAL(2, 1)) AS DOUBLE) AS bonus
        FROM part""",
    "map_values": "SELECT CAST(p_size AS BIGINT) * p_size AS square FROM part",
    "prefixed_values": "SELECT 'num_' || CAST(p_size AS VARCHAR) AS label FROM part",
    "flat_map": """SELECT word, CAST(length(word) AS BIGINT) AS length
        FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) AS w""",
    "filter_rows": """SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, p_type FROM part
        WHERE (p_size <= 35 AND p_type = 'PROMO') OR p_size % 2 = 0""",
    "containing": "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')",
    "non_empty": """SELECT p_partkey, p_name FROM part
        WHERE p_size % 4 NOT IN (0, 1) AND p_name <> ''""",
    "distinct_rows": "SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem",
    "dedup": """SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_partkey, l_quantity, l_extendedprice) = 1""",
    "drop_nulls": f"SELECT * FROM {_SPOILED} WHERE size IS NOT NULL AND brand IS NOT NULL",
    "fill_nulls": f"SELECT p_partkey, coalesce(size, 0) AS size, coalesce(brand, 'none') AS brand FROM {_SPOILED}",
    "impute_mean": """
        WITH holes AS (SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS p_size FROM part)
        SELECT p_partkey, CAST(coalesce(p_size, (SELECT round(avg(p_size)) FROM holes)) AS BIGINT) AS p_size
        FROM holes""",
    "flatten_struct": """SELECT event_id AS id, event_type AS kind,
        CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
    "explode_list": "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part",
    "join_inner": f"SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN {_PLACED} USING (c_custkey)",
    "join_partitioned": f"SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN {_PLACED} USING (c_custkey)",
    "join_partitioned_hot": f"""SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer
        JOIN (SELECT {_ONE_BUYER} AS c_custkey, o_orderkey, o_totalprice FROM orders) AS o USING (c_custkey)""",
    "join_left": f"SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN {_PLACED} USING (c_custkey)",
    "join_anti": f"SELECT c_custkey, c_name FROM customer ANTI JOIN {_PLACED} USING (c_custkey)",
    "join_chain": """SELECT o_orderkey, c_custkey, c_name || ' ' || c_mktsegment AS customer_name, n_name
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "lookup_default": f"""SELECT s_suppkey, CAST(s.s_nationkey AS BIGINT) AS s_nationkey,
        coalesce(n_name, 'Unknown') AS n_name FROM (SELECT s_suppkey, {_MOVED} AS s_nationkey FROM supplier) AS s
        LEFT JOIN nation ON s.s_nationkey = n_nationkey""",
    "group_count": "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1",
    "group_sum": f"SELECT o_custkey, CAST(sum({_PRICE}) AS DOUBLE) AS total FROM orders GROUP BY 1",
    "group_avg": f"SELECT o_orderstatus, CAST(100 * sum({_PRICE}) AS DOUBLE) / count({_PRICE}) / 100 AS average FROM orders GROUP BY 1",
    "group_avg_rounded": f"""SELECT o_orderstatus,
        CAST(round(CAST(CAST(sum({_PRICE}) AS DOUBLE) / count(*) AS DECIMAL(22, 6)), 2) AS DOUBLE) AS average
        FROM orders GROUP BY 1""",
    "group_min_max": "SELECT o_custkey, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY 1",
    "count_non_null": """SELECT brand, count(brand) AS count
        FROM (SELECT nullif(p_brand, 'Brand#7') AS brand FROM part) AS p GROUP BY 1""",
    "collect_values": """SELECT p_brand, CAST(0 AS BIGINT) AS chunk,
        string_agg(CAST(p_size AS VARCHAR), ',' ORDER BY p_size) AS sizes
        FROM (SELECT DISTINCT p_brand, p_size FROM part) AS d GROUP BY 1""",
    "collect_values_chunks": """SELECT l_returnflag, place // 1000 AS chunk,
        string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY place) AS suppliers
        FROM (SELECT l_returnflag, l_suppkey,
            row_number() OVER (PARTITION BY l_returnflag ORDER BY l_suppkey) - 1 AS place FROM lineitem) AS t
        GROUP BY 1, 2""",
    "exact_quantiles": """WITH shares AS (SELECT unnest([0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]) AS share),
        ranked AS (SELECT 'quantity' AS "column", CAST(l_quantity AS DOUBLE) AS value,
                row_number() OVER (ORDER BY l_quantity) AS place, count(*) OVER () AS n FROM lineitem
            UNION ALL SELECT 'price', CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS DOUBLE),
                row_number() OVER (ORDER BY CAST(l_extendedprice AS DECIMAL(18, 2))), count(*) OVER () FROM lineitem)
        SELECT "column", CAST(share AS DOUBLE) AS share, value FROM ranked, shares
        WHERE place = greatest(1, ceil(share * n))""",
    "value_histogram_position": """SELECT l_quantity, count(*) AS count,
        row_number() OVER (ORDER BY count(*) DESC, l_quantity) AS position FROM lineitem GROUP BY 1""",
    "value_histogram": "SELECT l_quantity, count(*) AS count FROM lineitem GROUP BY 1",
    "global_reduce": f"""SELECT CAST(sum({_LINE_PRICE}) AS DOUBLE) AS total,
        CAST(max({_LINE_PRICE}) AS DOUBLE) AS high, CAST(min({_LINE_PRICE}) AS DOUBLE) AS low,
        count(*) AS rows FROM lineitem""",
    "fold_sum": f"""SELECT CAST(0 AS DOUBLE) AS total, 'none' AS "case"
        UNION ALL SELECT CAST(10 + sum({_LINE_PRICE}) AS DOUBLE), 'all' FROM lineitem""",
    "pivot_sum": _pivot("CAST(ts AS DATE) AS day"),
    "pivot_sum_found": _pivot("user_id"),
    "duplicate_keys": f"SELECT {_BUYER} AS o_custkey, count(*) AS num_times FROM orders GROUP BY 1 HAVING count(*) > 1",
    "unique_keys": f"SELECT {_BUYER} AS o_custkey, count(*) AS num_times FROM orders GROUP BY 1 HAVING count(*) < 2",
    "summary_stats": """SELECT count(p_size) AS count, round(avg(p_size), 6) AS mean,
        round(stddev_samp(p_size), 6) AS std, CAST(min(p_size) AS BIGINT) AS min,
        CAST(quantile_disc(p_size, 0.25) AS BIGINT) AS q1,
        CAST(quantile_disc(p_size, 0.5) AS BIGINT) AS median,
        CAST(quantile_disc(p_size, 0.75) AS BIGINT) AS q3, CAST(max(p_size) AS BIGINT) AS max
        FROM part""",
    "pandas_bridge": """SELECT p_partkey, CAST(p_size AS BIGINT) AS size,
        CAST(p_size + 10 AS BIGINT) AS in_ten FROM part WHERE p_size > 30""",
    "salted_sum": f"SELECT l_returnflag, CAST(sum({_LINE_PRICE}) AS DOUBLE) AS total FROM lineitem GROUP BY 1",
    "sort_all": "SELECT o_orderkey, o_orderpriority FROM orders",
    "top_k": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "bottom_k": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey DESC LIMIT 10",
    "argmax": """SELECT l_suppkey, count(*) AS count FROM lineitem GROUP BY 1
        ORDER BY count(*) DESC, l_suppkey LIMIT 1""",
    "min_ties": """WITH c AS (SELECT o_custkey, count(*) AS count FROM orders GROUP BY 1)
        SELECT * FROM c WHERE count = (SELECT min(count) FROM c)""",
    "union_all": "SELECT o_custkey FROM orders UNION ALL SELECT c_custkey FROM customer",
    "intersect": """SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'
        INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""",
    "partition_profile": "SELECT count(*) AS rows FROM lineitem",
    "partition_by_key": "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS torn_keys FROM lineitem",
    "label_bucket": """SELECT p_partkey, CASE WHEN p_size < 30 THEN 'Spring Chicken'
        WHEN p_size < 65 THEN 'Senior Dev' ELSE 'DEAD' END AS label FROM part""",
    "format_label": """SELECT p_partkey, 'Name: ' || p_name || ', Age: ' ||
        coalesce(CAST(nullif(p_size, 7) AS VARCHAR), 'None') AS label FROM part""",
    "spend_by_customer": f"SELECT o_custkey, CAST(sum({_PRICE}) AS DOUBLE) AS total FROM orders GROUP BY 1",
    "people": f"""WITH p AS (SELECT DISTINCT {', '.join(_PEOPLE)} FROM customer),
        filled AS (SELECT name, coalesce(age, (SELECT round(avg(age)) FROM p)) AS age, city FROM p)
        SELECT name, CAST(age AS BIGINT) AS age, city FROM filled WHERE age > 30""",
    "spend_by_customer_position": f"""SELECT o_custkey, CAST(sum({_PRICE}) AS DOUBLE) AS total,
        row_number() OVER (ORDER BY sum({_PRICE}) DESC, o_custkey) AS position FROM orders GROUP BY 1""",
    "extreme_by_key": """SELECT user_id, min(value) AS low, max(value) AS high FROM events
        WHERE event_type IN ('click', 'view') GROUP BY 1""",
    "segment_totals_by_city": f"SELECT city, CAST(sum(amount) AS DOUBLE) AS total_spendings {_SEGMENT} GROUP BY 1",
    "segment_average": f"""SELECT segment,
        CAST(round(CAST(CAST(sum(amount) AS DOUBLE) / count(*) AS DECIMAL(22, 6)), 2) AS DOUBLE) AS avg_spending
        {_SEGMENT} GROUP BY 1""",
    "segment_top_customers": f"""SELECT custy_id, CAST(sum(amount) AS DOUBLE) AS total_spendings
        {_SEGMENT} GROUP BY 1 ORDER BY sum(amount) DESC, custy_id LIMIT 3""",
}
