"""Files, catalog tables and views: written under the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from suite.tables import as_long, money, table
from tablewright.plans.reports import revenue_lines as lines_of_revenue
from tablewright.plans.reports import segment_report
from tablewright.runtime import scratch_path
from tablewright.sinks import catalog as C
from tablewright.sinks import files as W
from tablewright.sources import files as S

ORDER_DDL = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"


def _orders(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


def csv_roundtrip(spark, folder):
    path = scratch_path(spark, "csv")
    W.write_csv(_orders(spark, folder), path)
    return S.read_csv(spark, path, ORDER_DDL)


def csv_no_header(spark, folder):
    path = scratch_path(spark, "csv-bare")
    W.write_csv(_orders(spark, folder), path, header=False)
    return S.read_csv(spark, path, ORDER_DDL, header=False)


def csv_inferred(spark, folder):
    path = scratch_path(spark, "csv-inferred")
    W.write_csv(_orders(spark, folder), path)
    return S.read_csv(spark, path, infer=True).withColumns(as_long("o_orderkey", "o_custkey"))


def csv_strings(spark, folder):
    path = scratch_path(spark, "csv-strings")
    W.write_csv(table(spark, folder, "part").select("p_partkey", "p_name", "p_size"), path)
    return S.read_csv(spark, path)


def csv_tab(spark, folder):
    path = scratch_path(spark, "csv-tab")
    W.write_csv(_orders(spark, folder), path, header=False, sep="\t")
    return S.read_csv(spark, path, ORDER_DDL, header=False, sep="\t")


def csv_long_separator(spark, folder):
    """``::`` between fields, and one field more in the file than in the schema."""
    path = scratch_path(spark, "csv-double-colon")
    lines = table(spark, folder, "orders").select(
        F.concat_ws("::", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").alias("value")
    )
    lines.write.text(path)
    return S.read_csv(spark, path, "o_orderkey bigint, o_custkey bigint, o_orderstatus string", header=False, sep="::")


def csv_latin1(spark, folder):
    """``|`` between fields, accented letters in ISO-8859-1."""
    path = scratch_path(spark, "csv-latin1")
    titles = table(spark, folder, "part").select("p_partkey", F.concat(F.lit("Pièce "), "p_name").alias("title"))
    W.write_csv(titles, path, header=False, sep="|", encoding="ISO-8859-1")
    return S.read_csv(
        spark, path, "p_partkey bigint, title string", header=False, sep="|", encoding="ISO-8859-1"
    )


def csv_space(spark, folder):
    path = scratch_path(spark, "csv-space")
    W.write_csv(table(spark, folder, "part").select("p_partkey", "p_name"), path, header=False, sep=" ")
    return S.read_csv(spark, path, "p_partkey bigint, p_name string", header=False, sep=" ")


def csv_glob(spark, folder):
    """Two folders read through one pattern."""
    base = scratch_path(spark, "csv-glob")
    orders = _orders(spark, folder)
    W.write_csv(orders.filter("o_orderkey % 2 = 0"), f"{base}/even")
    W.write_csv(orders.filter("o_orderkey % 2 = 1"), f"{base}/odd")
    return S.read_csv(spark, f"{base}/*", ORDER_DDL)


# Some lines lack a field, have one too many, or hold text where a number belongs.
BAD_LINE = (
    "CASE WHEN o_orderkey % 10 = 1 THEN CAST(o_orderkey AS STRING) "
    "WHEN o_orderkey % 10 = 2 THEN concat_ws(',', CAST(o_orderkey AS STRING), CAST(o_custkey AS STRING), o_orderstatus, 'more') "
    "WHEN o_orderkey % 10 = 3 THEN concat_ws(',', CAST(o_orderkey AS STRING), 'abc', o_orderstatus) "
    "ELSE concat_ws(',', CAST(o_orderkey AS STRING), CAST(o_custkey AS STRING), o_orderstatus) END AS value"
)
BAD_DDL = "o_orderkey bigint, o_custkey bigint, o_orderstatus string"


def _bad_file(spark, folder):
    path = scratch_path(spark, "csv-bad")
    table(spark, folder, "orders").selectExpr(BAD_LINE).write.text(path)
    return path


def csv_bad_rows(spark, folder):
    path = _bad_file(spark, folder)
    return S.read_csv(spark, path, BAD_DDL, header=False, mode="DROPMALFORMED")


def csv_bad_rows_one_column(spark, folder):
    path = _bad_file(spark, folder)
    rows = S.read_csv(spark, path, BAD_DDL, header=False, mode="DROPMALFORMED")
    return rows.select("o_orderstatus").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("count"))


def csv_quarantine(spark, folder):
    return S.checked_csv(spark, _bad_file(spark, folder), BAD_DDL, header=False)[1]


def csv_permissive(spark, folder):
    return S.read_csv(spark, _bad_file(spark, folder), BAD_DDL, header=False)


def json_roundtrip(spark, folder):
    path = scratch_path(spark, "json")
    nested = table(spark, folder, "customer").select(
        F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                 F.struct(F.col("c_acctbal").alias("amount")).alias("orders")).alias("customer")
    )
    W.write_json(nested, path)
    ddl = "customer struct<id: bigint, name: string, orders: struct<amount: double>>"
    back = S.read_json(spark, path, ddl, multiline=False)
    return back.select("customer.id", "customer.name", "customer.orders.amount")


def json_multiline(spark, folder):
    """Arrays spread over lines, one file per 10,000 customer numbers."""
    path = scratch_path(spark, "json-lines")
    records = table(spark, folder, "customer").select(
        F.floor(F.col("c_custkey") / 10_000).alias("batch"),
        F.to_json(F.struct(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).alias("customer"))).alias("record"),
    )
    arrays = records.groupBy("batch").agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list("record"), ",\n"), F.lit("\n]")).alias("value")
    )
    arrays.write.partitionBy("batch").text(path)
    back = S.read_json(spark, path, "customer struct<id: bigint, name: string>")
    return back.select("customer.id", "customer.name")


def text_roundtrip(spark, folder):
    path = scratch_path(spark, "text")
    table(spark, folder, "part").select(F.col("p_name").alias("value")).write.text(path)
    return S.read_text(spark, path)


def skip_header(spark, folder):
    path = scratch_path(spark, "text-header")
    W.write_csv(table(spark, folder, "part").select("p_name"), path)
    return S.skip_header(S.read_text(spark, path, "\n"), "p_name")


def source_file(spark, folder):
    """Rows per kind of file name (all files are Parquet files)."""
    named = S.with_source_file(table(spark, folder, "orders").select("o_orderkey"))
    kind = F.regexp_extract("source_file", r"([a-z]+)\.parquet$", 1)
    return named.groupBy(kind.alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def revenue_lines(spark, folder):
    path = scratch_path(spark, "revenue")
    sales = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("product_id"), F.col("l_returnflag").alias("name"),
        money("l_extendedprice").alias("price"), F.col("l_quantity").cast("decimal(4,0)").alias("quantity"),
    )
    W.write_text_lines(lines_of_revenue(sales), ["value"], path)
    return S.read_text(spark, path)


def parquet_roundtrip(spark, folder):
    path = scratch_path(spark, "parquet")
    W.write_parquet(_orders(spark, folder), path)
    return spark.read.parquet(path)


def parquet_partitioned(spark, folder):
    path = scratch_path(spark, "parquet-by-status")
    W.write_parquet(_orders(spark, folder), path, partition_by="o_orderstatus")
    return spark.read.parquet(path).filter("o_orderstatus = 'F'")


def segment_report_written(spark, folder):
    path = scratch_path(spark, "segments")
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("custy_id"), F.concat(F.lit("C"), "c_nationkey").alias("city"),
        F.col("c_mktsegment").alias("segment"),
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("custy_id"),
        F.col("o_orderdate").cast("date").alias("date"), F.col("o_totalprice").alias("amount"),
    )
    segment_report(customers, orders, path=path)
    return spark.read.parquet(path)


def _namespace(spark):
    name = f"space_{uuid.uuid4().hex[:12]}"
    C.ensure_namespace(spark, name, scratch_path(spark, name))
    return name


def table_roundtrip(spark, folder):
    """Published twice: the second write replaces the first."""
    name = f"{_namespace(spark)}.orders"
    C.publish_table(table(spark, folder, "orders").select("o_orderkey"), name)
    C.publish_table(_orders(spark, folder), name)
    return spark.table(name)


def register_table(spark, folder):
    name = f"{_namespace(spark)}.parts"
    return C.register_table(spark, name, f"{folder}/part.parquet").select("p_partkey", "p_name")


def verify_counts(spark, folder):
    space = _namespace(spark)
    for name in ("orders", "customer"):
        C.register_table(spark, f"{space}.{name}", f"{folder}/{name}.parquet")
    counts = C.verify_counts(spark, {f"{space}.orders": None, f"{space}.customer": None})
    return counts.select(F.substring_index("table_name", ".", -1).alias("table_name"), "rows")


def sql_view(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", money("o_totalprice").alias("price"))
    return C.sql_over(
        orders, "order_prices",
        "SELECT o_custkey, CAST(sum(price) AS DOUBLE) AS total FROM order_prices GROUP BY o_custkey ORDER BY total DESC",
    )


QUERIES = {
    name: query
    for name, query in list(globals().items())
    if callable(query) and getattr(query, "__module__", None) == __name__ and not name.startswith("_")
}

_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
_GOOD = "FROM orders WHERE o_orderkey % 10 NOT IN (1, 2, 3)"

ORACLE = {
    "csv_latin1": "SELECT p_partkey, 'Pièce ' || p_name AS title FROM part",
    "csv_space": "SELECT p_partkey, p_name FROM part",
    "csv_glob": _ORDERS,
    "json_multiline": "SELECT c_custkey AS id, c_name AS name FROM customer",
    "csv_roundtrip": _ORDERS,
    "csv_no_header": _ORDERS,
    "csv_inferred": _ORDERS,
    "csv_strings": """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name,
        CAST(p_size AS VARCHAR) AS p_size FROM part""",
    "csv_tab": _ORDERS,
    "csv_long_separator": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "csv_bad_rows": f"SELECT o_orderkey, o_custkey, o_orderstatus {_GOOD}",
    "csv_bad_rows_one_column": f"SELECT o_orderstatus, count(*) AS count {_GOOD} GROUP BY 1",
    "csv_quarantine": f"SELECT value AS record FROM (SELECT o_orderkey, {BAD_LINE} FROM orders) AS b WHERE o_orderkey % 10 IN (1, 2, 3)",
    "csv_permissive": """SELECT o_orderkey,
        CASE WHEN o_orderkey % 10 NOT IN (1, 3) THEN o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 10 <> 1 THEN o_orderstatus END AS o_orderstatus FROM orders""",
    "json_roundtrip": "SELECT c_custkey AS id, c_name AS name, c_acctbal AS amount FROM customer",
    "text_roundtrip": "SELECT p_name AS value FROM part",
    "skip_header": "SELECT p_name AS value FROM part",
    "source_file": "SELECT 'orders' AS file, count(*) AS rows FROM orders",
    "revenue_lines": """SELECT concat_ws(',', CAST(l_orderkey AS VARCHAR), l_returnflag,
        CAST(CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) * CAST(l_quantity AS DECIMAL(4, 0))
             AS DECIMAL(18, 2)) AS VARCHAR)) AS value FROM lineitem""",
    "parquet_roundtrip": _ORDERS,
    "parquet_partitioned": f"{_ORDERS} WHERE o_orderstatus = 'F'",
    "segment_report_written": """SELECT c_custkey AS custy_id, 'C' || CAST(c_nationkey AS VARCHAR) AS city,
        c_mktsegment AS segment, o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS date,
        o_totalprice AS amount FROM customer JOIN orders ON c_custkey = o_custkey""",
    "table_roundtrip": _ORDERS,
    "register_table": "SELECT p_partkey, p_name FROM part",
    "verify_counts": """SELECT 'orders' AS table_name, count(*) AS rows FROM orders
        UNION ALL SELECT 'customer', count(*) FROM customer""",
    "sql_view": """SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
        FROM orders GROUP BY 1""",
}
