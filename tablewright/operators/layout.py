"""Set operations, partition layout and caching."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.skew import share_counts, with_share


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag union by column name; duplicates stay."""
    return left.unionByName(right)


def intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in both inputs, without duplicates."""
    return left.intersect(right)


def with_partition_id(df: DataFrame, name: str = "pid") -> DataFrame:
    """Add the number of the partition each row sits in."""
    return df.withColumn(name, F.spark_partition_id())


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per partition; empty partitions have no row."""
    return with_partition_id(df).groupBy("pid").agg(F.count(F.lit(1)).alias("rows"))


def shrink(df: DataFrame, partitions: int) -> DataFrame:
    """Fewer partitions without a shuffle."""
    return df.coalesce(partitions)


def spread(df: DataFrame, partitions: int, *keys: str, split_hot: bool = False) -> DataFrame:
    """Shuffle to a partition count, by key when keys are given.

    With keys, equal keys meet in one partition. ``split_hot`` gives that up for keys with
    more rows than half an even partition: they are dealt out over several.
    """
    if not keys or not split_hot:
        return df.repartition(partitions, *keys)
    shared = with_share(df, keys, share_counts(df, keys, partitions), "_share")
    return shared.repartition(partitions, *keys, "_share").drop("_share")


def keep(df: DataFrame) -> DataFrame:
    """Cache a result that several consumers share, spilling to disk when large.

    The caller releases it with ``unpersist()``.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)
