"""Retail tables: schemas, cleaning, publishing and reporting views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import scalars as S
from tablewright.operators.rows import dedup
from tablewright.sinks.catalog import create_view, ensure_namespace, publish_table, verify_counts
from tablewright.sources.files import read_csv

# Columns and types of the three tables.
ORDER_SCHEMA = (
    "order_id string, customer_id string, product_id string, order_date date, ship_date date, "
    "quantity int, unit_price string, discount_pct string, total_amount float, "
    "payment_method string, order_status string"
)
PRODUCT_SCHEMA = (
    "product_id string, product_name string, category string, brand string, price string, "
    "cost float, stock_quantity int, weight_kg float, created_date date, is_active string"
)
CUSTOMER_SCHEMA = (
    "customer_id int, first_name string, last_name string, email string, phone string, "
    "signup_date date, country string, state string, postal_code string, "
    "is_active boolean, loyalty_points int"
)

# Weight given to products that list none.
DEFAULT_WEIGHT_KG = 0.1
# Loyalty points from which a customer counts as high value.
HIGH_VALUE_POINTS = 500


def _trimmed(*names: str) -> dict[str, Column]:
    return {name: F.trim(name) for name in names}


def clean_customers(df: DataFrame, dedupe_country_code: bool = False) -> DataFrame:
    """One complete, valid row per customer.

    An invalid email or phone counts as missing, and a row with anything missing
    is dropped; negative loyalty points become 0 after that.
    """
    cleaned = dedup(df, ["customer_id"]).withColumns(
        {
            **_trimmed("first_name", "last_name", "country", "state", "postal_code"),
            "email": S.email_or_null("email"),
            "phone": S.phone_or_null("phone", dedupe_country_code),
        }
    )
    return cleaned.na.drop().withColumn("loyalty_points", S.at_least_zero("loyalty_points"))


def clean_orders(
    df: DataFrame, money_type: str = "decimal(18,2)", null_as_zero: bool = True
) -> DataFrame:
    """One row per order with typed price and discount.

    Rows without customer, product, readable price or readable discount are
    dropped. A negative discount is unreadable; one above 100 becomes 100.
    """
    keyed = df.withColumns(_trimmed("order_id", "customer_id", "product_id"))
    cleaned = dedup(keyed, ["order_id"]).withColumns(
        {
            **_trimmed("payment_method", "order_status"),
            "unit_price": S.money("unit_price", money_type),
            "discount_pct": S.percent("discount_pct"),
            "quantity": S.at_least_zero("quantity", null_as_zero),
        }
    )
    return cleaned.na.drop(subset=["customer_id", "product_id", "unit_price", "discount_pct"])


def clean_products(
    df: DataFrame,
    money_type: str = "decimal(18,2)",
    null_as_zero: bool = True,
    trim_truth: bool = False,
) -> DataFrame:
    """One row per product with typed price, stock, weight and activity.

    By default an unreadable price becomes 0, so no product is dropped; with
    ``null_as_zero=False`` it stays missing and the product goes.
    """
    keyed = df.withColumns(_trimmed("product_id"))
    cleaned = dedup(keyed, ["product_id"]).withColumns(
        {
            **_trimmed("product_name", "category", "brand"),
            "price": S.at_least_zero(S.money("price", money_type), null_as_zero).cast(money_type),
            "weight_kg": F.coalesce(
                F.col("weight_kg").cast("float"), F.lit(DEFAULT_WEIGHT_KG).cast("float")
            ),
            "stock_quantity": S.at_least_zero("stock_quantity", null_as_zero),
            "is_active": S.truth("is_active", trim_truth),
        }
    )
    return cleaned.na.drop(subset=["price"])


def _customer_name() -> Column:
    return F.concat("first_name", F.lit(" "), "last_name").alias("customer_name")


def customer_summary(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", _customer_name(), "email", "phone", "country", "state",
        "loyalty_points", "is_active",
    )


def order_details(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Orders with customer and product, kept when either is unknown.

    Order rows carry the customer key as text; text that is no number matches nobody.
    """
    people = customers.select("customer_id", _customer_name())
    goods = products.select(F.col("product_id").alias("_product"), "product_name", "category")
    lines = orders.withColumn("_customer", F.col("customer_id").try_cast("int")).drop("customer_id")
    return (
        lines.join(people, F.col("_customer") == F.col("customer_id"), "left")
        .join(goods, F.col("product_id") == F.col("_product"), "left")
        .select(
            "order_id", "order_date", "customer_id", "customer_name", "product_name",
            "category", "quantity", "total_amount", "payment_method", "order_status",
        )
    )


def sales_summary(
    orders: DataFrame,
    products: DataFrame,
    key: str = "product_id",
    order_id: str = "order_id",
    quantity: str = "quantity",
    amount: str = "total_amount",
    category: str = "category",
    product_key: str | None = None,
) -> DataFrame:
    """Orders, units, sales and mean order value per category.

    Orders are summed per product before the join, so the join sees one row per
    product and a best-seller is no hot key.
    """
    per_product = orders.groupBy(F.col(key).alias("_product")).agg(
        F.count(order_id).alias("_orders"),
        F.sum(quantity).alias("_units"),
        F.sum(amount).alias("_sales"),
        F.count(amount).alias("_priced"),
    )
    goods = products.select(F.col(product_key or key).alias("_key"), category)
    joined = per_product.join(goods, F.col("_product") == F.col("_key"))
    sums = joined.groupBy(category).agg(
        F.sum("_orders").alias("total_orders"),
        F.sum("_units").alias("units_sold"),
        F.sum("_sales").alias("total_sales"),
        F.sum("_priced").alias("_priced"),
    )
    mean = F.when(F.col("_priced") != 0, F.col("total_sales").cast("double") / F.col("_priced"))
    return sums.withColumn("average_order_value", mean).drop("_priced")


def active_products(products: DataFrame) -> DataFrame:
    return products.filter("is_active").select(
        "product_id", "product_name", "category", "brand", "price", "stock_quantity"
    )


def high_value_customers(customers: DataFrame, points: int = HIGH_VALUE_POINTS) -> DataFrame:
    return customers.filter(F.col("loyalty_points") >= points).select(
        "customer_id", _customer_name(), "email", "country", "loyalty_points"
    )


def publish_all(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    namespace: str,
    provider: str = "parquet",
    location: str | None = None,
) -> DataFrame:
    """Publish frames as ``namespace.name`` tables; returns the read-back counts."""
    ensure_namespace(spark, namespace, location)
    for name, frame in frames.items():
        publish_table(frame, f"{namespace}.{name}", provider)
    return verify_counts(spark, {f"{namespace}.{name}": None for name in frames})


def load_and_publish(
    spark: SparkSession, folder: str, namespace: str, provider: str = "parquet", location: str | None = None
) -> DataFrame:
    """CSV files with headers below ``folder`` (customers, orders, products) to cleaned,
    published tables; returns the read-back counts.

    Columns bind by position. An unreadable cell is null, which cleaning then treats as
    missing.
    """
    def read(name: str, schema: str) -> DataFrame:
        return read_csv(spark, f"{folder.rstrip('/')}/{name}", schema)

    frames = {
        "customers": clean_customers(read("customers", CUSTOMER_SCHEMA)),
        "orders": clean_orders(read("orders", ORDER_SCHEMA)),
        "products": clean_products(read("products", PRODUCT_SCHEMA)),
    }
    return publish_all(spark, frames, namespace, provider, location)


def create_views(spark: SparkSession, namespace: str) -> list[str]:
    """The five reporting views over ``customers``, ``orders`` and ``products``.

    Persistent views, so they are SQL text; each says the same as the function of
    its name above. Returns the view names.
    """
    name = "concat(first_name, ' ', last_name) AS customer_name"
    # Names and columns of the views.
    views = {
        "customer_summary": f"""
            SELECT customer_id, {name}, email, phone, country, state, loyalty_points, is_active
            FROM {namespace}.customers""",
        "order_details": f"""
            WITH people AS (SELECT customer_id, {name} FROM {namespace}.customers)
            SELECT o.order_id, o.order_date, u.customer_id, u.customer_name, g.product_name,
                   g.category, o.quantity, o.total_amount, o.payment_method, o.order_status
            FROM {namespace}.orders AS o
            LEFT JOIN people AS u ON try_cast(o.customer_id AS int) = u.customer_id
            LEFT JOIN {namespace}.products AS g ON o.product_id = g.product_id""",
        "sales_summary": f"""
            WITH per_product AS (
                SELECT product_id, count(order_id) AS n, sum(quantity) AS units,
                       sum(total_amount) AS sales, count(total_amount) AS priced
                FROM {namespace}.orders GROUP BY product_id)
            SELECT category, sum(n) AS total_orders, sum(units) AS units_sold,
                   sum(sales) AS total_sales,
                   cast(sum(sales) AS double) / nullif(sum(priced), 0) AS average_order_value
            FROM per_product JOIN {namespace}.products USING (product_id)
            GROUP BY category""",
        "active_products": f"""
            SELECT product_id, product_name, category, brand, price, stock_quantity
            FROM {namespace}.products WHERE is_active""",
        "high_value_customers": f"""
            SELECT customer_id, {name}, email, country, loyalty_points
            FROM {namespace}.customers WHERE loyalty_points >= {HIGH_VALUE_POINTS}""",
    }
    for view, query in views.items():
        create_view(spark, f"{namespace}.{view}", query)
    return list(views)
