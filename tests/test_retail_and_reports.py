from __future__ import annotations

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from tablewright.plans import reports
from tablewright.plans import retail as R
from tests.conftest import plan_text

DAY = datetime.date(2024, 1, 1)


def customer(key, first="Ann", email="a@b.de", phone="555-123-4567", points=10):
    return (key, f" {first} ", "Lee", email, phone, DAY, "US ", "TX", "1", True, points)


def order(key, customer="1", product="p1", price="$10.50", discount="5", quantity=2, amount=20.0):
    return (key, customer, product, DAY, DAY, quantity, price, discount, amount, " card", "done ")


def product(key, price="$9.99", stock=3, weight=1.5, active="yes", category=" toys"):
    return (key, "Top", category, "B", price, 1.0, stock, weight, DAY, active)


@pytest.fixture
def customers(spark):
    return R.clean_customers(
        spark.createDataFrame(
            [
                customer(1), customer(1, "Zoe"), customer(2, email="bad"), customer(3, phone="12"),
                customer(4, points=-5), customer(5, points=None), customer(6, points=500),
            ],
            R.CUSTOMER_SCHEMA,
        )
    )


@pytest.fixture
def orders(spark):
    return R.clean_orders(
        spark.createDataFrame(
            [
                order("o1"), order(" o1 ", customer="9"), order("o2", customer="guest"),
                order("o3", price="n/a"), order("o4", discount="-1"), order("o5", discount="120"),
                order("o6", quantity=None), order("o7", quantity=-4, product=" p2 ", amount=None),
                order("o8", customer=None),
            ],
            R.ORDER_SCHEMA,
        )
    )


@pytest.fixture
def products(spark):
    data = [
        product("p1 "), product("p2", price="free", stock=None, weight=None, active=" yes"),
        product("p3", price="-3", stock=-1, active=None, category="tools"),
    ]
    return R.clean_products(spark.createDataFrame(data, R.PRODUCT_SCHEMA))


def test_customers(customers, rows):
    assert rows(customers, "customer_id", "first_name", "phone", "loyalty_points") == [
        (1, "Ann", "+15551234567", 10), (4, "Ann", "+15551234567", 0), (6, "Ann", "+15551234567", 500),
    ]


def test_orders(orders, rows):
    got = rows(orders.withColumn("unit_price", F.col("unit_price").cast("string")),
               "order_id", "customer_id", "quantity", "unit_price", "discount_pct")
    assert got == [
        ("o1", "1", 2, "10.50", 5.0), ("o2", "guest", 2, "10.50", 5.0),
        ("o5", "1", 2, "10.50", 100.0), ("o6", "1", 0, "10.50", 5.0), ("o7", "1", 0, "10.50", 5.0),
    ]
    assert dict(orders.dtypes)["discount_pct"] == "double"


def test_products(products, rows):
    got = rows(products.withColumns({"price": F.col("price").cast("string"), "weight_kg": F.round(F.col("weight_kg").cast("double"), 3)}),
               "product_id", "price", "stock_quantity", "weight_kg", "is_active")
    assert got == [("p1", "9.99", 3, 1.5, True), ("p2", "0.00", 0, 0.1, False), ("p3", "0.00", 0, 1.5, False)]


def test_products_can_keep_missing_prices_apart(spark, rows):
    raw = spark.createDataFrame([product("p1"), product("p2", price="free", stock=None)], R.PRODUCT_SCHEMA)
    assert rows(R.clean_products(raw, null_as_zero=False), "product_id") == [("p1",)]


def test_cleaning_needs_one_shuffle(spark):
    raw = spark.createDataFrame([order("o1")], R.ORDER_SCHEMA)
    assert plan_text(R.clean_orders(raw)).count("Exchange") == 1


def test_views_equal_functions(spark, tmp_path, customers, orders, products, rows):
    space = f"shop_{uuid.uuid4().hex[:8]}"
    frames = {"customers": customers, "orders": orders, "products": products}
    counts = R.publish_all(spark, frames, space, location=str(tmp_path / space))
    assert rows(counts, "rows") == [(3,), (3,), (5,)]
    assert len(R.create_views(spark, space)) == 5
    expected = {
        "customer_summary": R.customer_summary(customers),
        "order_details": R.order_details(orders, customers, products),
        "sales_summary": R.sales_summary(orders, products),
        "active_products": R.active_products(products),
        "high_value_customers": R.high_value_customers(customers),
    }
    for view, frame in expected.items():
        assert rows(spark.table(f"{space}.{view}"), *frame.columns) == rows(frame)


def test_order_details_keep_unknown_customers(customers, orders, products, rows):
    got = R.order_details(orders, customers, products)
    assert rows(got.filter("order_id = 'o2'"), "customer_id", "customer_name", "product_name") == [
        (None, None, "Top")
    ]
    assert got.count() == 5


def test_sales_summary(orders, products, rows):
    assert rows(R.sales_summary(orders, products)) == [("toys", 5, 6, 80.0, 20.0)]


def test_spend_and_extremes(spark, rows):
    df = spark.createDataFrame([("a", "TMAX", 3.0), ("a", "TMIN", 1.0), ("b", "TMIN", 2.5), ("a", "TMIN", 0.5)],
                               "station string, kind string, value double")
    low = reports.extreme_by_key(df, "station", "value", "min", F.col("kind") == "TMIN")
    assert rows(low) == [("a", 0.5), ("b", 2.5)]
    assert rows(reports.extreme_by_key(df, "station", "value", "max")) == [("a", 3.0), ("b", 2.5)]
    spend = reports.spend_by_customer(df, "station", "value")
    assert [tuple(r) for r in spend.collect()] == [("a", 4.5), ("b", 2.5)]


def test_revenue_lines(spark, rows):
    df = spark.createDataFrame([("p1", "Pen", 1.255, 2), ("p2", "Ink", 0.1, 3)],
                               "product_id string, name string, price double, quantity int")
    assert rows(reports.revenue_lines(df)) == [("p1,Pen,2.51",), ("p2,Ink,0.30",)]
    exact = df.withColumn("price", F.col("price").cast("decimal(9,3)"))
    assert rows(reports.revenue_lines(exact)) == [("p1,Pen,2.51",), ("p2,Ink,0.30",)]


def test_segment_report(spark, tmp_path, rows):
    customers = spark.createDataFrame(
        [(1, "X", "home"), (1, "X", "home"), (2, "Y", "work"), (3, "X", "work")],
        "custy_id int, city string, segment string",
    )
    orders = spark.createDataFrame(
        [(1, 1, DAY, 10.25), (1, 1, DAY, 10.25), (2, 1, DAY, None), (3, 2, DAY, 5.0), (4, 3, DAY, 1.0), (5, 9, DAY, 7.0)],
        "order_id int, custy_id int, date date, amount float",
    )
    path = str(tmp_path / "out")
    report = reports.segment_report(customers, orders, k=2, path=path)

    def text(df, column):
        return rows(df.withColumn(column, F.col(column).cast("decimal(9,2)").cast("string")))

    assert report.joined.count() == 3
    assert text(report.totals_by_city, "total_spendings") == [("X", "11.25"), ("Y", "5.00")]
    assert text(report.average_by_segment, "avg_spending") == [("home", "10.25"), ("work", "3.00")]
    assert text(report.top_customers, "total_spendings") == [(1, "10.25"), (2, "5.00")]
    assert spark.read.parquet(path).filter("city = 'X'").count() == 2
