"""Row-level operators: projection, filtering, clean-up, flattening."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.ordering import sort_columns, sort_names


def map_values(df: DataFrame, expression: Column, name: str = "value") -> DataFrame:
    """One output value per input row."""
    return df.select(expression.alias(name))


def flat_map(df: DataFrame, array: Column, name: str = "value") -> DataFrame:
    """One output row per array element; null and empty arrays give none."""
    return df.select(F.explode(array).alias(name))


def containing(df: DataFrame, column: str, part: str) -> DataFrame:
    """Rows whose text contains ``part``."""
    return df.filter(F.col(column).contains(part))


def non_empty(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is neither null nor empty."""
    return df.filter(F.col(column) != "")


def log_words(df: DataFrame, column: str, level: str, name: str = "word") -> DataFrame:
    """Upper-cased words of the log lines that start with ``level``."""
    lines = df.filter(F.col(column).startswith(level))
    words = F.split(F.trim(F.col(column)), r"\s+")
    return flat_map(lines, F.transform(words, F.upper), name)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Rows distinct over all columns."""
    return df.distinct()


def dedup(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the first by ``order_by`` (default: all other columns).

    Rows that agree in ``order_by`` are ordered by their other columns, so the
    choice never depends on how the data is spread. Each map task cuts a key to one
    row before the shuffle: a key with very many copies costs no more than any other.
    """
    order = list(order_by or [])
    rest = [name for name in df.columns if name not in [*keys, *sort_names(order)]]
    if not any(key.startswith("-") for key in order):
        names = [*(name for name in order if name not in keys), *rest]
        if not names:
            return df.select(*keys).distinct()
        first = df.groupBy(*keys).agg(F.min(F.struct(*names)).alias("_first"))
        picked = [name if name in keys else f"_first.{name}" for name in df.columns]
        return first.select(*picked)
    window = Window.partitionBy(*keys).orderBy(*sort_columns([*order, *rest]))
    return df.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any column, or in any of ``subset``."""
    return df.na.drop(subset=list(subset) if subset else None)


def fill_nulls(df: DataFrame, values: object) -> DataFrame:
    """Replace nulls by one constant (matching types) or per column (a dict)."""
    return df.na.fill(values)


def impute_mean(df: DataFrame, column: str) -> DataFrame:
    """Fill nulls with the rounded mean of the non-null values.

    The mean is a scalar subquery: one row, computed by the same job.
    """
    kind = df.schema[column].dataType
    mean = df.agg(F.round(F.avg(column)).cast(kind)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean))


def flatten_struct(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Nested fields as top-level columns: ``{"total": "customer.orders.total"}``."""
    return df.select(*(F.col(path).alias(name) for name, path in paths.items()))


def split_fields(df: DataFrame, column: str, sep: str, names: Sequence[str]) -> DataFrame:
    """Positional tokens of a line as columns; missing tokens are null.

    ``sep`` is a regular expression.
    """
    tokens = df.withColumn("_tokens", F.split(F.col(column), sep))
    fields = {name: F.get("_tokens", position) for position, name in enumerate(names)}
    return tokens.withColumns(fields).drop(column, "_tokens")


def parse_delimited(df: DataFrame, column: str, schema: str, sep: str = ",") -> DataFrame:
    """Parse a delimited text column into typed columns (``schema`` is DDL)."""
    record = F.from_csv(F.col(column), schema, {"sep": sep})
    return df.select(record.alias("_record")).select("_record.*")


def explode_list(
    df: DataFrame, column: str, sep: str = ",", name: str | None = None
) -> DataFrame:
    """One row per element of a delimited list; other columns repeat."""
    name = name or column
    listed = df.withColumn("_items", F.split(F.col(column), sep)).drop(column)
    return listed.withColumn(name, F.explode("_items")).drop("_items")
