"""Sort specifications, top-k, ties and global order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.runtime import cut_lineage


def sort_columns(order: Sequence[str], reverse: bool = False) -> list[Column]:
    """Turn ``["-amount", "id"]`` into sort expressions ("-" means descending)."""
    result = []
    for key in order:
        name, descending = key.removeprefix("-"), key.startswith("-")
        column = F.col(name)
        result.append(column.desc() if descending != reverse else column.asc())
    return result


def sort_names(order: Sequence[str]) -> list[str]:
    return [key.removeprefix("-") for key in order]


def sort_all(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Global sort. The other columns break ties.

    Range partitioning keeps equal keys together, so a sort on one hot value
    would send all its rows to one task; the extra keys let it be cut.
    """
    rest = [name for name in df.columns if name not in sort_names(order)]
    return df.orderBy(*sort_columns([*order, *rest]))


def top_k(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """First k rows in the given order (each task keeps k rows, then they merge)."""
    return df.orderBy(*sort_columns(order)).limit(k)


def bottom_k(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """Last k rows in the given order."""
    return df.orderBy(*sort_columns(order, reverse=True)).limit(k)


def argmax(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The single best row; ``order`` must be total to make it repeatable."""
    return top_k(df, order, 1)


def min_ties(df: DataFrame, column: str) -> DataFrame:
    """Every row whose value equals the column's minimum."""
    lowest = df.agg(F.min(column)).scalar()
    return df.filter(F.col(column) == lowest)


def with_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Number all rows from 1 in the given order; the other columns break ties.

    The rows are cut by range and each part is numbered on its own; a table with one row
    per part tells how many rows come before it. No task holds all rows.
    """
    rest = [column for column in df.columns if column not in sort_names(order)]
    total = sort_columns([*order, *rest])
    parts = cut_lineage(df.repartitionByRange(*total).withColumn("_part", F.spark_partition_id()))
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    earlier = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*total))
    numbered = parts.join(earlier, "_part").withColumn(name, F.col("_before") + own)
    return numbered.drop("_part", "_before")
