"""Finding and splitting groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.runtime import cut_and_measure

# A group with more rows than this is split over several tasks.
HOT_ROWS = 5_000_000

# Rows of a group at the limit that a share of the data should contain.
SAMPLE_ROWS = 10_000

GROUP_ID = "_group"
GROUP_ROWS = "_group_rows"


def _same_key(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"l.{key}").eqNullSafe(F.col(f"h.{key}"))
    return condition


def _likely_groups(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame | None:
    """Groups that a small share of the rows suggests are above ``limit``, or None.

    A group at the limit expects ``SAMPLE_ROWS`` rows in the share and half of that
    is asked for, so a large group is missed with no realistic chance. If it ever
    were, it would be handled as an ordinary group: slower, with the same result.
    """
    share = df.select(*keys).sample(SAMPLE_ROWS / limit, seed=1)
    counted = share.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    likely, state = cut_and_measure(counted.filter(F.col("_rows") > SAMPLE_ROWS / 2).select(*keys))
    return likely if state["rows"] else None


def hot_groups(
    df: DataFrame, keys: Sequence[str], limit: int, stats: Sequence[Column] = ()
) -> DataFrame | None:
    """Groups with more than ``limit`` rows, or None when there are none.

    For a high limit a small share of the key columns rules most groups out first,
    so the usual answer (none) costs one scan of these columns and hardly any
    shuffle. The remaining groups are counted exactly, combined before the shuffle.
    The answer has at most rows/limit entries and is written down once: every later
    step then sees the same groups and the same group ids, and Spark broadcasts it
    by its file size.
    """
    if limit > SAMPLE_ROWS:
        likely = _likely_groups(df, keys, limit)
        if likely is None:
            return None
        df = df.alias("l").join(likely.alias("h"), _same_key(keys), "left_semi")
    large = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(GROUP_ROWS), *stats)
        .filter(F.col(GROUP_ROWS) > limit)
    )
    hot, state = cut_and_measure(large.withColumn(GROUP_ID, F.monotonically_increasing_id()))
    return hot if state["rows"] else None


def split_hot(
    df: DataFrame, hot: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary groups, rows of hot groups with the hot group's columns).

    Null keys form a group like any other, hence the null-safe comparison.
    """
    condition = _same_key(keys)
    ordinary = df.alias("l").join(hot.alias("h"), condition, "left_anti")
    extra = [F.col(f"h.{name}") for name in hot.columns if name not in keys]
    heavy = df.alias("l").join(hot.alias("h"), condition, "inner").select("l.*", *extra)
    return ordinary, heavy


def share_counts(df: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame | None:
    """Keys with more rows than half an even partition, and into how many shares
    (``_shares``) of half that size such a key is to be cut; None when there are none.

    There are at most two such keys per partition, so the answer is small.
    """
    limit = max(1, -(-df.count() // (2 * max(partitions, 1))))
    hot = hot_groups(df, keys, limit)
    return None if hot is None else hot.select(*keys, F.ceil(F.col(GROUP_ROWS) * 2 / limit).cast("long").alias("_shares"))


def with_share(df: DataFrame, keys: Sequence[str], shares: DataFrame | None, name: str) -> DataFrame:
    """The share of each row: 0, or for a key in ``shares`` one of several by the row's content.

    A task that is run again makes the same choice. Rows equal in all columns share a share.
    """
    if shares is None:
        return df.withColumn(name, F.lit(0).cast("long"))
    own = F.col("_shares")
    counted = df.alias("l").join(shares.alias("h"), _same_key(keys), "left").select("l.*", "h._shares")
    content = [field.name for field in df.schema.fields if not isinstance(field.dataType, (T.MapType, T.VariantType))]
    share = F.coalesce(F.pmod(F.xxhash64(*content), own), F.lit(0).cast("long"))
    return counted.withColumn(name, share).drop("_shares")
