"""Cleaning, publishing and reporting views on retail tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from suite.tables import as_double, dirty, dirty_sql, money, table
from tablewright.plans import retail
from tablewright.runtime import scratch_path
from tablewright.sinks.files import write_csv


def sales_summary(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_partkey", "l_orderkey", "l_quantity", money("l_extendedprice").alias("amount")
    )
    report = retail.sales_summary(
        lines, table(spark, folder, "part"), "l_partkey", "l_orderkey", "l_quantity", "amount",
        "p_type", "p_partkey",
    )
    return report.withColumns(as_double("units_sold", "total_sales"))


def clean_customers(spark, folder):
    return retail.clean_customers(dirty(spark, folder, "customer"))


def clean_orders(spark, folder):
    cleaned = retail.clean_orders(dirty(spark, folder, "orders"))
    return cleaned.withColumns(as_double("unit_price", "total_amount"))


def clean_products(spark, folder):
    cleaned = retail.clean_products(dirty(spark, folder, "part"))
    return cleaned.withColumns(as_double("price", "cost", "weight_kg"))


def _cleaned(spark, folder):
    return {
        "customers": retail.clean_customers(dirty(spark, folder, "customer")),
        "orders": retail.clean_orders(dirty(spark, folder, "orders")),
        "products": retail.clean_products(dirty(spark, folder, "part")),
    }


def customer_summary(spark, folder):
    return retail.customer_summary(_cleaned(spark, folder)["customers"])


def order_details(spark, folder):
    c = _cleaned(spark, folder)
    details = retail.order_details(c["orders"], c["customers"], c["products"])
    return details.withColumns(as_double("total_amount"))


def active_products(spark, folder):
    products = retail.active_products(_cleaned(spark, folder)["products"])
    return products.withColumns(as_double("price"))


def high_value_customers(spark, folder):
    return retail.high_value_customers(_cleaned(spark, folder)["customers"])


def _published(spark, folder):
    """Cleaned tables published to a namespace of their own."""
    namespace = f"retail_{uuid.uuid4().hex[:12]}"
    counts = retail.publish_all(
        spark, _cleaned(spark, folder), namespace, location=scratch_path(spark, namespace)
    )
    return namespace, counts


def publish_all(spark, folder):
    _, counts = _published(spark, folder)
    return counts.select(F.substring_index("table_name", ".", -1).alias("table_name"), "rows")


def create_views(spark, folder):
    """All five views read through the catalog, as one row of sizes and sums each."""
    namespace, _ = _published(spark, folder)
    totals = {
        "customer_summary": "loyalty_points",
        "order_details": "quantity",
        "sales_summary": "units_sold",
        "active_products": "stock_quantity",
        "high_value_customers": "loyalty_points",
    }
    parts = [
        spark.table(f"{namespace}.{view}").agg(
            F.lit(view).alias("view_name"),
            F.count(F.lit(1)).alias("rows"),
            F.sum(totals[view]).cast("long").alias("total"),
        )
        for view in retail.create_views(spark, namespace)
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _view(spark, folder, name):
    """All rows of one view over published tables."""
    namespace, _ = _published(spark, folder)
    retail.create_views(spark, namespace)
    return spark.table(f"{namespace}.{name}")


def view_sales_summary(spark, folder):
    return _view(spark, folder, "sales_summary").withColumns(as_double("units_sold", "total_sales"))


def view_customer_summary(spark, folder):
    return _view(spark, folder, "customer_summary")


def view_order_details(spark, folder):
    return _view(spark, folder, "order_details").withColumns(as_double("total_amount"))


def view_active_products(spark, folder):
    return _view(spark, folder, "active_products").withColumns(as_double("price"))


def view_high_value_customers(spark, folder):
    return _view(spark, folder, "high_value_customers")


def retail_load(spark, folder):
    """From CSV files with the three schemas to published tables and their counts."""
    path = scratch_path(spark, "load")
    for name, source in (("customers", "customer"), ("orders", "orders"), ("products", "part")):
        write_csv(dirty(spark, folder, source), f"{path}/{name}")
    namespace = f"retail_{uuid.uuid4().hex[:12]}"
    counts = retail.load_and_publish(spark, path, namespace, location=scratch_path(spark, namespace))
    return counts.select(F.substring_index("table_name", ".", -1).alias("table_name"), "rows")


QUERIES = {
    "sales_summary": sales_summary,
    "clean_customers": clean_customers,
    "clean_orders": clean_orders,
    "clean_products": clean_products,
    "customer_summary": customer_summary,
    "order_details": order_details,
    "active_products": active_products,
    "high_value_customers": high_value_customers,
    "publish_all": publish_all,
    "create_views": create_views,
    "view_sales_summary": view_sales_summary,
    "view_customer_summary": view_customer_summary,
    "view_order_details": view_order_details,
    "view_active_products": view_active_products,
    "view_high_value_customers": view_high_value_customers,
    "retail_load": retail_load,
}


def _first_rows(name: str, key: str, columns: list[str]) -> str:
    order = ", ".join(f"{column} NULLS FIRST" for column in columns)
    return (
        f"SELECT * FROM {dirty_sql(name)} AS d "
        f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"
    )


_CUSTOMERS = f"""
    WITH one AS ({_first_rows("customer", "customer_id", [
        "first_name", "last_name", "email", "phone", "signup_date", "country", "state",
        "postal_code", "is_active", "loyalty_points"])}),
    checked AS (
        SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
            CASE WHEN regexp_matches(trim(email), '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\\.[a-zA-Z0-9-.]+$')
                 THEN trim(email) END AS email,
            CASE WHEN regexp_matches(trim(phone),
                 '^(\\+?\\d{{1,3}}[\\s.-]?)?\\(?\\d{{3}}\\)?[\\s.-]?\\d{{3}}[\\s.-]?\\d{{4}}$')
                 THEN regexp_replace(trim(phone), '[^\\d+]', '', 'g') END AS digits,
            signup_date, trim(country) AS country, trim(state) AS state,
            trim(postal_code) AS postal_code, is_active, loyalty_points
        FROM one)
    SELECT customer_id, first_name, last_name, email,
        CASE WHEN digits LIKE '+%' THEN digits ELSE '+1' || digits END AS phone,
        signup_date, country, state, postal_code, is_active,
        CAST(greatest(loyalty_points, 0) AS INT) AS loyalty_points
    FROM checked
    WHERE email IS NOT NULL AND digits IS NOT NULL AND loyalty_points IS NOT NULL"""

_ORDERS = f"""
    WITH keyed AS (
        SELECT * REPLACE (trim(order_id) AS order_id, trim(customer_id) AS customer_id,
                          trim(product_id) AS product_id)
        FROM {dirty_sql("orders")} AS d),
    one AS (
        SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY order_id
            ORDER BY customer_id NULLS FIRST, product_id NULLS FIRST, order_date NULLS FIRST,
            ship_date NULLS FIRST, quantity NULLS FIRST, unit_price NULLS FIRST,
            discount_pct NULLS FIRST, total_amount NULLS FIRST, payment_method NULLS FIRST,
            order_status NULLS FIRST) = 1)
    SELECT order_id, customer_id, product_id, order_date, ship_date,
        CAST(greatest(coalesce(quantity, 0), 0) AS INT) AS quantity,
        TRY_CAST(replace(replace(unit_price, '$', ''), ',', '') AS DECIMAL(18, 2)) AS unit_price,
        CASE WHEN regexp_matches(discount_pct, '^\\d+(\\.\\d+)?$')
             THEN least(CAST(discount_pct AS DOUBLE), 100) END AS discount_pct,
        total_amount, trim(payment_method) AS payment_method, trim(order_status) AS order_status
    FROM one
    WHERE customer_id IS NOT NULL AND product_id IS NOT NULL
      AND TRY_CAST(replace(replace(unit_price, '$', ''), ',', '') AS DECIMAL(18, 2)) IS NOT NULL
      AND regexp_matches(discount_pct, '^\\d+(\\.\\d+)?$')"""

_PRODUCTS = f"""
    WITH keyed AS (
        SELECT * REPLACE (trim(product_id) AS product_id) FROM {dirty_sql("part")} AS d),
    one AS (
        SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY product_id
            ORDER BY product_name NULLS FIRST, category NULLS FIRST, brand NULLS FIRST,
            price NULLS FIRST, cost NULLS FIRST, stock_quantity NULLS FIRST,
            weight_kg NULLS FIRST, created_date NULLS FIRST, is_active NULLS FIRST) = 1)
    SELECT product_id, trim(product_name) AS product_name, trim(category) AS category,
        trim(brand) AS brand,
        greatest(coalesce(TRY_CAST(replace(replace(price, '$', ''), ',', '') AS DECIMAL(18, 2)), 0), 0) AS price,
        cost, CAST(greatest(coalesce(stock_quantity, 0), 0) AS INT) AS stock_quantity,
        coalesce(weight_kg, CAST(0.1 AS FLOAT)) AS weight_kg, created_date,
        coalesce(lower(is_active) IN ('true', 'yes', 'y'), false) AS is_active
    FROM one"""

_NAME = "concat(first_name, ' ', last_name) AS customer_name"
_DETAILS = f"""
    SELECT o.order_id, o.order_date, c.customer_id, concat(c.first_name, ' ', c.last_name) AS raw_name,
        CASE WHEN c.customer_id IS NOT NULL THEN concat(c.first_name, ' ', c.last_name) END AS customer_name,
        p.product_name, p.category, o.quantity, CAST(o.total_amount AS DOUBLE) AS total_amount,
        o.payment_method, o.order_status
    FROM ({_ORDERS}) AS o
    LEFT JOIN ({_CUSTOMERS}) AS c ON TRY_CAST(o.customer_id AS INT) = c.customer_id
    LEFT JOIN ({_PRODUCTS}) AS p ON o.product_id = p.product_id"""
_VIEW_SALES = f"""
    SELECT p.category, count(o.order_id) AS total_orders,
        CAST(sum(o.quantity) AS DOUBLE) AS units_sold,
        CAST(sum(CAST(o.total_amount AS DECIMAL(18, 2))) AS DOUBLE) AS total_sales,
        CAST(sum(CAST(o.total_amount AS DECIMAL(18, 2))) AS DOUBLE) / count(o.total_amount)
            AS average_order_value
    FROM ({_ORDERS}) AS o JOIN ({_PRODUCTS}) AS p ON o.product_id = p.product_id
    GROUP BY p.category"""

ORACLE = {
    "sales_summary": """
        SELECT p_type, count(l_orderkey) AS total_orders,
            CAST(sum(l_quantity) AS DOUBLE) AS units_sold,
            CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_sales,
            CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) / count(l_extendedprice)
                AS average_order_value
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""",
    "clean_customers": _CUSTOMERS,
    "clean_orders": f"""SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price,
        CAST(total_amount AS DOUBLE) AS total_amount) FROM ({_ORDERS}) AS o""",
    "clean_products": f"""SELECT * REPLACE (CAST(price AS DOUBLE) AS price,
        CAST(cost AS DOUBLE) AS cost, CAST(weight_kg AS DOUBLE) AS weight_kg)
        FROM ({_PRODUCTS}) AS p""",
    "customer_summary": f"""SELECT customer_id, {_NAME}, email, phone, country, state,
        loyalty_points, is_active FROM ({_CUSTOMERS}) AS c""",
    "order_details": f"SELECT * EXCLUDE (raw_name) FROM ({_DETAILS}) AS d",
    "active_products": f"""SELECT product_id, product_name, category, brand,
        CAST(price AS DOUBLE) AS price, stock_quantity FROM ({_PRODUCTS}) AS p WHERE is_active""",
    "high_value_customers": f"""SELECT customer_id, {_NAME}, email, country, loyalty_points
        FROM ({_CUSTOMERS}) AS c WHERE loyalty_points >= 500""",
    "publish_all": f"""
        SELECT 'customers' AS table_name, count(*) AS rows FROM ({_CUSTOMERS}) AS c
        UNION ALL SELECT 'orders', count(*) FROM ({_ORDERS}) AS o
        UNION ALL SELECT 'products', count(*) FROM ({_PRODUCTS}) AS p""",
    "create_views": f"""
        SELECT 'customer_summary' AS view_name, count(*) AS rows,
            CAST(sum(loyalty_points) AS BIGINT) AS total FROM ({_CUSTOMERS}) AS c
        UNION ALL SELECT 'order_details', count(*), CAST(sum(quantity) AS BIGINT) FROM ({_DETAILS}) AS d
        UNION ALL SELECT 'sales_summary', count(*), CAST(sum(units_sold) AS BIGINT) FROM ({_VIEW_SALES}) AS s
        UNION ALL SELECT 'active_products', count(*), CAST(sum(stock_quantity) AS BIGINT)
            FROM ({_PRODUCTS}) AS p WHERE is_active
        UNION ALL SELECT 'high_value_customers', count(*), CAST(sum(loyalty_points) AS BIGINT)
            FROM ({_CUSTOMERS}) AS h WHERE loyalty_points >= 500""",
    "view_sales_summary": _VIEW_SALES,
}
# A view says the same as the function of its name, and a load the same as publishing.
for _name in ("customer_summary", "order_details", "active_products", "high_value_customers"):
    ORACLE[f"view_{_name}"] = ORACLE[_name]
ORACLE["retail_load"] = ORACLE["publish_all"]
