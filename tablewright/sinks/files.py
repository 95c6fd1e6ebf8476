"""File writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _layout(df: DataFrame, files: int | None) -> DataFrame:
    return df if files is None else df.coalesce(files)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: str | Sequence[str] | None = None,
    files: int | None = None,
) -> None:
    """Overwrite a Parquet folder, optionally one sub-folder per key value.

    Partitioned output is rebalanced by key first: each value ends in few files,
    and adaptive execution splits a value that holds too much for one task.
    """
    if partition_by is None:
        _layout(df, files).write.mode("overwrite").parquet(path)
        return
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    rows = df.hint("rebalance", *keys) if files is None else df.coalesce(files)
    rows.write.mode("overwrite").partitionBy(*keys).parquet(path)


def write_text_lines(
    df: DataFrame, columns: Sequence[Column | str], path: str, files: int | None = None
) -> None:
    """Overwrite a text folder with comma-joined columns, one line per row."""
    line = df.select(F.concat_ws(",", *columns).alias("value"))
    _layout(line, files).write.mode("overwrite").text(path)


def write_csv(
    df: DataFrame,
    path: str,
    header: bool = True,
    sep: str = ",",
    files: int | None = None,
    encoding: str = "UTF-8",
) -> None:
    """Overwrite a CSV folder."""
    writer = _layout(df, files).write.mode("overwrite").option("header", header)
    writer.option("sep", sep).option("encoding", encoding).csv(path)


def write_json(df: DataFrame, path: str, files: int | None = None) -> None:
    """Overwrite a folder of JSON lines."""
    _layout(df, files).write.mode("overwrite").json(path)
