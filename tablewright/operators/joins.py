"""Equi-joins, anti-joins, lookups.

No broadcast is forced here: Spark broadcasts a side when its size estimate, or
the size measured at run time, is below ``spark.sql.autoBroadcastJoinThreshold``
and otherwise shuffles, splitting uneven partitions (adaptive skew join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.skew import share_counts, with_share


def inner_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    partitions: int | None = None,
) -> DataFrame:
    """Inner equi-join, by default with the partitioning Spark picks.

    ``partitions`` fixes the number of partitions on both sides. A key with more rows on
    a side than half an even partition is then cut into shares there, and the rows of the
    other side go to each of them.
    """
    if partitions is None:
        return left.join(right, on, "inner")
    keys = [on] if isinstance(on, str) else list(on)
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    left, right = left.filter(known), right.filter(known)
    shares = [share_counts(side, keys, partitions) for side in (left, right)]
    cells = [f"_share{number}" for number, counted in enumerate(shares) if counted is not None]
    dealt = []
    for number, side in enumerate((left, right)):
        for other, counted in enumerate(shares):
            column = f"_share{other}"
            if counted is None:
                continue
            if other == number:
                side = with_share(side, keys, counted, column)
            else:
                every = F.sequence(F.lit(0).cast("long"), F.coalesce("_shares", F.lit(1).cast("long")) - 1)
                side = side.join(counted, keys, "left").withColumn(column, F.explode(every)).drop("_shares")
        dealt.append(side.repartition(partitions, *keys, *cells))
    return dealt[0].join(dealt[1], [*keys, *cells], "inner").drop(*cells)


def left_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, on, "left")


def no_match(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a partner.

    Only the distinct keys of ``right`` take part: a key repeated in a large
    table is combined before the shuffle.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    value: str,
    default: str,
    dim_key: str | None = None,
    name: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Add the dimension's ``value`` for ``key``, or ``default`` where it has none.

    Repeated dimension keys are reduced to their largest value, so that the lookup never
    multiplies rows. ``unique=True`` skips that where keys are known to be unique.
    """
    name = name or value
    pairs = dim.select(F.col(dim_key or key).alias("_key"), F.col(value).alias("_value"))
    if not unique:
        pairs = pairs.groupBy("_key").agg(F.max("_value").alias("_value"))
    joined = df.join(pairs, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(name, F.coalesce("_value", F.lit(default))).drop("_key", "_value")
