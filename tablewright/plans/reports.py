"""Spend, extremes, revenue lines, segment report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tablewright.operators.aggregates import group_min_max
from tablewright.operators.ordering import sort_columns, top_k
from tablewright.runtime import cut_lineage
from tablewright.sinks.files import write_parquet


def spend_by_customer(
    orders: DataFrame, customer: str, amount: str, name: str = "total", digits: int | None = 2
) -> DataFrame:
    """Total per customer, highest first."""
    total = F.sum(amount) if digits is None else F.round(F.sum(amount), digits)
    spend = orders.groupBy(customer).agg(total.alias(name))
    return spend.orderBy(*sort_columns([f"-{name}", customer]))


def extreme_by_key(
    df: DataFrame, key: str, value: str, how: str, kind: Column | None = None, name: str = "extreme"
) -> DataFrame:
    """Smallest (``how="min"``) or largest (``"max"``) value per key, of one kind of rows."""
    pick = {"min": F.min, "max": F.max}[how]
    rows = df if kind is None else df.filter(kind)
    return rows.groupBy(key).agg(pick(value).alias(name))


def extremes_by_key(
    df: DataFrame, key: str, value: str, kind: Column | None = None, low: str = "low", high: str = "high"
) -> DataFrame:
    """Smallest and largest value per key in one pass, of one kind of rows."""
    return group_min_max(df if kind is None else df.filter(kind), key, value, low, high)


def revenue_lines(
    sales: DataFrame,
    product: str = "product_id",
    label: str = "name",
    price: str = "price",
    quantity: str = "quantity",
) -> DataFrame:
    """One text line ``id,name,revenue`` per sale, with two decimals."""
    revenue = F.col(price) * F.col(quantity)
    if isinstance(sales.select(revenue.alias("r")).schema["r"].dataType, DecimalType):
        shown = revenue.cast("decimal(38,2)").cast("string")
    else:
        shown = F.format_string("%.2f", revenue.cast("double"))
    return sales.select(F.concat_ws(",", F.col(product), F.col(label), shown).alias("value"))


@dataclass(frozen=True)
class SegmentReport:
    """Results of ``segment_report``."""

    joined: DataFrame
    totals_by_city: DataFrame
    average_by_segment: DataFrame
    top_customers: DataFrame


def segment_report(
    customers: DataFrame,
    orders: DataFrame,
    key: str = "custy_id",
    k: int = 3,
    path: str | None = None,
    amount_type: str = "decimal(18,2)",
) -> SegmentReport:
    """Spend by city and segment and the best customers; joined rows go to ``path``.

    Repeated rows and incomplete orders are removed first. The three summaries
    join customers with per-customer sums, so a customer with very many orders
    is one row by then; only ``joined`` has all rows. The sums are written down once
    for the three.
    """
    people = customers.distinct()
    lines = orders.na.drop().distinct()
    joined = people.join(lines, key)
    if path is not None:
        write_parquet(joined, path, partition_by="city")

    amount = F.col("amount").cast(amount_type)
    spend = lines.groupBy(key).agg(F.sum(amount).alias("_sum"), F.count(amount).alias("_n"))
    known = cut_lineage(people.join(spend, key))
    total = F.round(F.sum("_sum"), 2)
    by_city = known.groupBy("city").agg(total.alias("total_spendings"))
    mean = F.round(F.sum("_sum") / F.sum("_n"), 2)
    by_segment = known.groupBy("segment").agg(mean.alias("avg_spending"))
    by_customer = known.groupBy(key).agg(total.alias("total_spendings"))
    return SegmentReport(
        joined, by_city, by_segment, top_k(by_customer, ["-total_spendings", key], k)
    )
