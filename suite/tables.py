"""Input tables of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def money(name: str) -> Column:
    """A money column as an exact number, so sums do not depend on their order."""
    return F.col(name).cast("decimal(18,2)")


def cents(name: str) -> Column:
    """A money column in whole cents: exact, and much cheaper than a decimal."""
    return F.rint(F.col(name) * 100).cast("long")


def from_cents(*names: str) -> dict[str, Column]:
    return {name: F.col(name) / 100 for name in names}


def as_double(*names: str) -> dict[str, Column]:
    return {name: F.col(name).cast("double") for name in names}


def as_long(*names: str) -> dict[str, Column]:
    return {name: F.col(name).cast("long") for name in names}


# Retail-shaped, deliberately dirty tables. The expressions are valid in Spark
# and in DuckDB, so both sides of a check start from the same rows.
DIRTY_CUSTOMERS = [
    "CAST(c_custkey AS INT) AS customer_id",
    "concat('  ', c_mktsegment, ' ') AS first_name",
    "concat(c_name, ' ') AS last_name",
    "CASE WHEN c_custkey % 7 = 0 THEN 'no at sign' WHEN c_custkey % 11 = 0 THEN NULL "
    "ELSE concat(' user.', CAST(c_custkey AS STRING), '@mail.example.com ') END AS email",
    "CASE WHEN c_custkey % 5 = 0 THEN concat('(555) 123-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) "
    "WHEN c_custkey % 5 = 1 THEN concat(' 555.123.', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) "
    "WHEN c_custkey % 5 = 2 THEN concat('+44 555 123 ', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) "
    "WHEN c_custkey % 5 = 3 THEN concat('1-555-123-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) "
    "ELSE '12-34' END AS phone",
    "CAST('2020-01-31' AS DATE) AS signup_date",
    "concat(' N', CAST(c_nationkey AS STRING)) AS country",
    "concat('S', CAST(c_custkey % 50 AS STRING), '  ') AS state",
    "lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') AS postal_code",
    "c_custkey % 2 = 0 AS is_active",
    "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey * 37 % 1500 AS INT) - 200 END AS loyalty_points",
]
DIRTY_ORDERS = [
    "concat(' ', CAST(o_orderkey AS STRING)) AS order_id",
    "CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 'guest' "
    "ELSE concat(CAST(o_custkey AS STRING), ' ') END AS customer_id",
    "concat('  P', CAST(o_orderkey % 200 AS STRING)) AS product_id",
    "CAST(o_orderdate AS DATE) AS order_date",
    "CAST(o_orderdate AS DATE) AS ship_date",
    "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_orderkey % 40 AS INT) - 3 END AS quantity",
    "CASE WHEN o_orderkey % 29 = 0 THEN 'n/a' ELSE concat('$', CAST(o_orderkey % 9 + 1 AS STRING), ',', "
    "lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0'), '.', lpad(CAST(o_orderkey % 100 AS STRING), 2, '0')) END AS unit_price",
    "CASE WHEN o_orderkey % 31 = 0 THEN '-5' WHEN o_orderkey % 37 = 0 THEN '150' "
    "WHEN o_orderkey % 41 = 0 THEN 'ten' ELSE concat(CAST(o_orderkey % 60 AS STRING), '.5') END AS discount_pct",
    "CAST(o_orderkey % 1000 AS FLOAT) AS total_amount",
    "concat(' ', o_orderpriority) AS payment_method",
    "concat(o_orderstatus, ' ') AS order_status",
]
DIRTY_PRODUCTS = [
    "concat('P', CAST(p_partkey AS STRING), ' ') AS product_id",
    "concat(' ', p_name) AS product_name",
    "concat(p_type, ' ') AS category",
    "p_brand AS brand",
    "CASE WHEN p_partkey % 7 = 0 THEN 'free' WHEN p_partkey % 11 = 0 THEN '-$12.50' "
    "ELSE concat('$1,', lpad(CAST(p_partkey % 1000 AS STRING), 3, '0'), '.', lpad(CAST(p_size AS STRING), 2, '0')) END AS price",
    "CAST(p_size AS FLOAT) AS cost",
    "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size - 5 END AS stock_quantity",
    "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_size AS FLOAT) END AS weight_kg",
    "CAST('2021-06-30' AS DATE) AS created_date",
    "CASE WHEN p_partkey % 5 = 0 THEN 'YES' WHEN p_partkey % 5 = 1 THEN 'true' WHEN p_partkey % 5 = 2 THEN ' Yes' "
    "WHEN p_partkey % 5 = 3 THEN 'no' ELSE NULL END AS is_active",
]
# A second, different copy of every fifth row, to be removed by deduplication.
COPIES = {
    "customer": ("c_custkey % 5 = 0", {"last_name": "concat('Z', c_name)"}),
    "orders": ("o_orderkey % 5 = 0", {"order_status": "concat('Z', o_orderstatus)"}),
    "part": ("p_partkey % 5 = 0", {"brand": "concat('Z', p_brand)"}),
}
_EXPRESSIONS = {"customer": DIRTY_CUSTOMERS, "orders": DIRTY_ORDERS, "part": DIRTY_PRODUCTS}


def _copy_expressions(name: str) -> list[str]:
    changes = COPIES[name][1]
    kept = [e for e in _EXPRESSIONS[name] if e.rsplit(" AS ", 1)[1] not in changes]
    return kept + [f"{e} AS {column}" for column, e in changes.items()]


def dirty(spark: SparkSession, folder: str, name: str) -> DataFrame:
    source = table(spark, folder, name)
    copies = source.filter(COPIES[name][0]).selectExpr(*_copy_expressions(name))
    return source.selectExpr(*_EXPRESSIONS[name]).unionByName(copies)


def dirty_sql(name: str) -> str:
    first, second = ", ".join(_EXPRESSIONS[name]), ", ".join(_copy_expressions(name))
    return (
        f"(SELECT {first} FROM {name} UNION ALL BY NAME "
        f"SELECT {second} FROM {name} WHERE {COPIES[name][0]})"
    )
