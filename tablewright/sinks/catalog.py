"""Catalog tables, namespaces, views and read-back checks."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _has_own_catalog(spark: SparkSession, name: str) -> bool:
    """True when the name's first part is a catalog plug-in of the session."""
    parts = name.split(".")
    return len(parts) > 2 and spark.conf.get(f"spark.sql.catalog.{parts[0]}", None) is not None


def ensure_namespace(
    spark: SparkSession, namespace: str, location: str | None = None, replace: bool = False
) -> None:
    """Create a namespace if absent. ``replace=True`` drops the old one and its tables."""
    if replace:
        spark.sql(f"DROP NAMESPACE IF EXISTS {namespace} CASCADE")
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{where}")


def publish_table(df: DataFrame, name: str, provider: str = "parquet") -> None:
    """Create or replace a table.

    A catalog plug-in (for example Iceberg) replaces in one step. The built-in
    catalog cannot, so there the table is overwritten.
    """
    if _has_own_catalog(df.sparkSession, name):
        df.writeTo(name).using(provider).createOrReplace()
    else:
        df.write.format(provider).mode("overwrite").saveAsTable(name)


def register_table(spark: SparkSession, name: str, path: str, provider: str = "parquet") -> DataFrame:
    """Enter existing files in the catalog as an external table, replacing its entry.

    Only the entry of another external table is replaced. A managed table owns its files
    and would lose them, so it is refused.
    """
    if spark.catalog.tableExists(name):
        kind = spark.catalog.getTable(name).tableType
        if kind != "EXTERNAL":
            raise ValueError(f"{name} is a {kind} table; drop it first if its data may go")
        spark.sql(f"DROP TABLE {name}")
    return spark.catalog.createTable(name, path=path, source=provider)


def verify_counts(spark: SparkSession, expected: Mapping[str, int | None]) -> DataFrame:
    """Rows per table read back from the catalog, next to the expected number.

    ``matches`` is null where nothing was expected.
    """
    parts = [
        spark.table(table)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            F.lit(table).alias("table_name"),
            "rows",
            F.lit(number).cast("long").alias("expected"),
            (F.col("rows") == F.lit(number).cast("long")).alias("matches"),
        )
        for table, number in expected.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def create_view(spark: SparkSession, name: str, query: str, temporary: bool = False) -> None:
    """Create or replace a view over SQL text."""
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {name} AS {query}")


def sql_over(df: DataFrame, view: str, query: str) -> DataFrame:
    """Name a frame as a temporary view and run SQL text on it."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(query)
