"""Grouped and global aggregates, pivots, duplicates, statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ordering import sort_columns
from tablewright.operators.skew import HOT_ROWS
from tablewright.operators.windows import running_total
from tablewright.runtime import cut_lineage

# Values of one key held in a single array.
ARRAY_ROWS = 1_000_000


def _names(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def group_count(df: DataFrame, keys: str | Sequence[str], name: str = "count") -> DataFrame:
    return df.groupBy(*_names(keys)).agg(F.count(F.lit(1)).alias(name))


def count_non_null(
    df: DataFrame, keys: str | Sequence[str], column: str, name: str = "count"
) -> DataFrame:
    """Non-null values per group; a group with only nulls counts 0."""
    return df.groupBy(*_names(keys)).agg(F.count(column).alias(name))


def group_sum(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    name: str = "total",
    digits: int | None = None,
) -> DataFrame:
    total = F.sum(value)
    return df.groupBy(*_names(keys)).agg(
        (total if digits is None else F.round(total, digits)).alias(name)
    )


def group_avg(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    name: str = "average",
    digits: int | None = None,
) -> DataFrame:
    mean = F.avg(value)
    return df.groupBy(*_names(keys)).agg(
        (mean if digits is None else F.round(mean, digits)).alias(name)
    )


def group_min_max(
    df: DataFrame, keys: str | Sequence[str], value: str, low: str = "low", high: str = "high"
) -> DataFrame:
    return df.groupBy(*_names(keys)).agg(F.min(value).alias(low), F.max(value).alias(high))


def value_histogram(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """How often each value occurs, most frequent first."""
    return group_count(df, column, name).orderBy(*sort_columns([f"-{name}", column]))


def global_reduce(df: DataFrame, value: str) -> DataFrame:
    """Sum, largest, smallest and row count of a column as one row."""
    return df.agg(
        F.sum(value).alias("total"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.count(F.lit(1)).alias("rows"),
    )


def fold_sum(df: DataFrame, value: str, zero: object = 0, name: str = "total") -> DataFrame:
    """Sum that starts from ``zero``, so no rows give ``zero`` and not null."""
    kind = df.agg(F.sum(value).alias(name)).schema[name].dataType
    start = F.lit(zero).cast(kind)
    return df.agg((F.coalesce(F.sum(value), F.lit(0).cast(kind)) + start).cast(kind).alias(name))


def collect_values(
    df: DataFrame,
    key: str,
    value: str,
    name: str = "values",
    hot_rows: int = ARRAY_ROWS,
) -> DataFrame:
    """Sorted values per key as arrays, in ``(key, chunk, values)`` rows.

    The values of a key in ascending order are cut into chunks of exactly ``hot_rows``, the
    last one shorter; so a key of up to that many values has one row (chunk 0), and the
    chunks of a larger one follow each other. Nulls are left out. Equal values are counted
    first and take as many places as they have copies, so neither a key with very many
    values nor a value with very many copies meets in one task.
    """
    limit = F.lit(max(hot_rows, 1)).cast("long")
    pairs = df.select(key, value).filter(F.col(value).isNotNull())
    counts = pairs.groupBy(key, value).agg(F.count(F.lit(1)).alias("_copies"))
    placed = running_total(counts, key, value, "_copies", "_end", frame="rows", hot_rows=max(hot_rows, 1))
    begin, end = F.col("_end") - F.col("_copies"), F.col("_end")
    chunks = F.sequence(F.floor(begin / limit), F.floor((end - 1) / limit))
    cut = placed.withColumn("chunk", F.explode(chunks))
    inside = F.least(end, (F.col("chunk") + 1) * limit) - F.greatest(begin, F.col("chunk") * limit)
    parts = cut.select(key, "chunk", F.struct(F.col(value).alias("v"), inside.cast("int").alias("n")).alias("_part"))
    ordered = F.sort_array(F.collect_list("_part"))
    repeated = F.flatten(F.transform(ordered, lambda part: F.array_repeat(part["v"], part["n"])))
    return parts.groupBy(key, "chunk").agg(repeated.alias(name))


def pivot_sum(
    df: DataFrame,
    row: str | Sequence[str],
    column: str,
    value: str,
    values: Sequence[object] | None = None,
) -> DataFrame:
    """Sums as a table of ``row`` by the values of ``column``; gaps are 0.

    Naming ``values`` saves the extra pass that finds them (Spark refuses to
    find more than ``spark.sql.pivotMaxValues``).
    """
    wide = df.groupBy(*_names(row)).pivot(column, list(values) if values else None)
    table = wide.agg(F.sum(value))
    return table.na.fill(0, subset=[c for c in table.columns if c not in _names(row)])


def split_duplicates(
    df: DataFrame, key: str | Sequence[str], name: str = "num_times"
) -> tuple[DataFrame, DataFrame]:
    """(keys that occur more than once, keys that occur once), with their counts."""
    keys = _names(key)
    counts = df.groupBy(*keys).agg(F.count(keys[0]).alias(name))
    return counts.filter(F.col(name) > 1), counts.filter(F.col(name) < 2)


def exact_quantiles(
    df: DataFrame, column: str, shares: Sequence[float], hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """The values below or at which the given shares of all values lie: (share, value).

    For share s of n values it is the one at place ceil(s * n) (the first for 0), always a
    value of the column; nulls are left out, no values give null. Equal values are counted
    first; above ``hot_rows`` different values the counts are added up in blocks, so no task
    holds the column however large or skewed it is.
    """
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("_n")).filter("value IS NOT NULL")
    one = F.lit(0).alias("_all")
    placed = cut_lineage(running_total(counts.select(one, "value", "_n"), "_all", "value", "_n", "_end", hot_rows=hot_rows))
    total = F.coalesce(placed.agg(F.max("_end")).scalar(), F.lit(0))
    wanted = F.explode(F.array(*(F.lit(float(share)) for share in shares)))
    # A share is an exact decimal here: 0.07 of 100 values are 7 of them, not 8.
    place = F.greatest(F.ceil(F.col("share").cast("decimal(12,10)") * total), F.lit(1)).cast("long")
    asked = df.sparkSession.range(1).select(wanted.alias("share")).withColumn("_place", place)
    at = (F.col("_place") > F.col("_end") - F.col("_n")) & (F.col("_place") <= F.col("_end"))
    # A handful of places is sent to the values.
    return asked.join(F.broadcast(asked).join(placed, at).select("share", "value"), "share", "left").select("share", "value")


def summary_stats(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum, one row.

    Quartiles are values of the column, not interpolated, found by a mergeable
    sketch (rank error below 1 in 10,000); ``exact_quantiles`` has no error.
    """
    quartiles = F.percentile_approx(column, [0.25, 0.5, 0.75], 10_000)
    return df.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        quartiles.alias("_q"),
        F.max(column).alias("max"),
    ).select(
        "count",
        "mean",
        "std",
        "min",
        F.get("_q", F.lit(0)).alias("q1"),
        F.get("_q", F.lit(1)).alias("median"),
        F.get("_q", F.lit(2)).alias("q3"),
        "max",
    )


def salted_sum(
    df: DataFrame,
    key: str,
    value: str,
    salts: int = 32,
    name: str = "total",
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Sum per key in two phases, first per (key, salt), so a hot key is shared out.

    Equal to a plain sum. The salt comes from the row's content, so a task that
    is run again makes the same choice.
    """
    content = list(salt_by or df.columns)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*content), F.lit(salts)))
    partial = salted.groupBy(key, "_salt").agg(F.sum(value).alias("_sum"))
    return partial.groupBy(key).agg(F.sum("_sum").alias(name))
