"""Ordered analytics per group: running values, lags, moving means, sessions.

Each operator is an ordinary window while every group fits in a task. The rows of
groups above ``hot_rows`` are range-partitioned by group and order, which cuts them into
blocks of near equal size whatever the order columns hold; rows tied in the order stay
together. A low ``hot_rows`` makes no more blocks than a shuffle has tasks, unless they would
exceed ``BLOCK_ROWS`` rows, as blocks of a few rows each cost a task and a file. A block is processed on its own and the little it needs from earlier blocks (a
running sum, the last few values) comes from a table with one row per block. The result
does not depend on ``hot_rows``: where single rows count (previous values, moving means),
ties are broken by the other columns in both forms. Finding large groups is one extra
scan of the group columns; ``hot_rows=None`` skips it where no group is large.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.ordering import sort_columns, sort_names
from tablewright.operators.skew import GROUP_ID, GROUP_ROWS, HOT_ROWS, hot_groups, split_hot
from tablewright.runtime import cut_lineage

BLOCK = "_block"
BLOCK_KEYS = [GROUP_ID, BLOCK]
# Range boundaries come from a sample, so cut finer than needed.
OVERSPLIT = 2
# Smaller blocks cost more than they save once every task of a shuffle has one.
BLOCK_ROWS = 250_000


def _names(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def _total_order(df: DataFrame, part: list[str], order: list[str]) -> list[str]:
    """The order, then every other column that can be compared."""
    def comparable(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return comparable(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(comparable(field.dataType) for field in kind.fields)
        return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))

    taken = {*part, *sort_names(order)}
    return order + [f.name for f in df.schema.fields if f.name not in taken and comparable(f.dataType)]


def epoch_seconds(df: DataFrame, name: str, column: Column | None = None) -> Column:
    """Whole seconds since 1970 of a time column, the same in every session time zone
    where the column has none."""
    column = F.col(name) if column is None else column
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        since = column - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.floor(since.cast("interval second").cast("decimal(20,6)"))
    return F.unix_timestamp(column.cast("timestamp"))


def _with_blocks(
    df: DataFrame, part: list[str], order: list[str], hot_rows: int
) -> tuple[DataFrame, DataFrame | None]:
    """Split into (rows of ordinary groups, rows of hot groups with block numbers)."""
    hot = hot_groups(df, part, hot_rows)
    if hot is None:
        return df, None
    ordinary, heavy = split_hot(df, hot, part)
    rows = hot.agg(F.sum(GROUP_ROWS)).first()[0]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = min(-(-rows // max(hot_rows, 1)), max(tasks, -(-rows // BLOCK_ROWS))) * OVERSPLIT
    ranged = heavy.repartitionByRange(int(blocks), GROUP_ID, *sort_columns(order))
    # Written down once: all later steps see the same blocks.
    return ordinary, cut_lineage(ranged.withColumn(BLOCK, F.spark_partition_id())).drop(GROUP_ROWS)


def _run(
    df: DataFrame,
    part: list[str],
    order: list[str],
    hot_rows: int | None,
    plain: Callable[[DataFrame], DataFrame],
    blocked: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    if hot_rows is None:
        return plain(df)
    ordinary, heavy = _with_blocks(df, part, order, hot_rows)
    result = plain(ordinary)
    if heavy is None:
        return result
    casts = [F.col(field.name).cast(field.dataType) for field in result.schema]
    return result.unionByName(blocked(heavy).select(*casts))


def _block_window(order: list[str]):
    return Window.partitionBy(*BLOCK_KEYS).orderBy(*order)


def _across_blocks():
    return Window.partitionBy(GROUP_ID).orderBy(BLOCK)


def _null_safe_sum(left: Column, right: Column) -> Column:
    """Sum of two sums, where a sum over nothing is null."""
    return F.when(left.isNull(), right).when(right.isNull(), left).otherwise(left + right)


def _earlier_sum(blocks: DataFrame, value: str, name: str) -> DataFrame:
    """Per block, the sum of ``value`` over all earlier blocks of its group."""
    frame = _across_blocks().rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(*BLOCK_KEYS, F.sum(value).over(frame).alias(name))


def _tails(heavy: DataFrame, order: list[str], value: str, size: int) -> DataFrame:
    """Per block, the last ``size`` values before it, oldest first, as ``_tail``.

    A block has at least one row, so the ``size`` blocks before it suffice.
    """
    newest = Window.partitionBy(*BLOCK_KEYS).orderBy(*sort_columns(order, reverse=True))
    ends = (
        heavy.withColumn("_back", F.row_number().over(newest))
        .filter(F.col("_back") <= size)
        .groupBy(*BLOCK_KEYS)
        .agg(
            F.sort_array(
                F.collect_list(F.struct((-F.col("_back")).alias("at"), F.col(value).alias("v")))
            ).alias("_end")
        )
    )
    before = _across_blocks().rowsBetween(-size, -1)
    joined = F.flatten(F.collect_list("_end").over(before))
    return ends.select(*BLOCK_KEYS, joined.alias("_all")).select(
        *BLOCK_KEYS,
        F.transform(
            F.slice("_all", F.greatest(F.size("_all") - size + 1, F.lit(1)), size),
            lambda entry: entry["v"],
        ).alias("_tail"),
    )


def running_total(
    df: DataFrame,
    part: str | Sequence[str],
    order: str | Sequence[str],
    value: str,
    name: str = "running_total",
    frame: str = "range",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Cumulative sum. With the default RANGE frame, tied rows share their total."""
    part, order = _names(part), _names(order)

    def framed(window):
        if frame == "rows":
            return window.rowsBetween(Window.unboundedPreceding, 0)
        return window.rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def plain(rows):
        window = framed(Window.partitionBy(*part).orderBy(*order))
        return rows.withColumn(name, F.sum(value).over(window))

    def blocked(rows):
        totals = rows.groupBy(*BLOCK_KEYS).agg(F.sum(value).alias("_sum"))
        earlier = _earlier_sum(totals, "_sum", "_earlier")
        local = rows.withColumn("_local", F.sum(value).over(framed(_block_window(order))))
        return local.join(earlier, BLOCK_KEYS).withColumn(
            name, _null_safe_sum(F.col("_local"), F.col("_earlier"))
        )

    return _run(df, part, order, hot_rows, plain, blocked)


def previous_value(
    df: DataFrame,
    part: str | Sequence[str],
    order: str | Sequence[str],
    value: str,
    name: str = "previous",
    offset: int = 1,
    default: object = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Value ``offset`` rows earlier; ``default`` where there is no such row.

    Rows tied in the order follow each other by their other columns.
    """
    part, order = _names(part), _names(order)
    order = _total_order(df, part, order)

    def plain(rows):
        window = Window.partitionBy(*part).orderBy(*order)
        return rows.withColumn(name, F.lag(value, offset, default).over(window))

    def blocked(rows):
        window = _block_window(order)
        local = rows.withColumn("_row", F.row_number().over(window)).withColumn(
            "_local", F.lag(value, offset).over(window)
        )
        back = F.lit(offset + 1) - F.col("_row")
        carried = F.when(
            F.size("_tail") >= back, F.get("_tail", F.size("_tail") - back)
        ).otherwise(F.lit(default))
        return local.join(_tails(rows, order, value, offset), BLOCK_KEYS).withColumn(
            name, F.when(F.col("_row") > offset, F.col("_local")).otherwise(carried)
        )

    return _run(df, part, order, hot_rows, plain, blocked)


def delta(
    df: DataFrame,
    part: str | Sequence[str],
    order: str | Sequence[str],
    value: str,
    name: str = "difference",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Difference from the previous row; the first row differs from 0."""
    lagged = previous_value(df, part, order, value, "_previous", 1, 0, hot_rows)
    return lagged.withColumn(name, F.col(value) - F.col("_previous")).drop("_previous")


def moving_avg(
    df: DataFrame,
    part: str | Sequence[str],
    order: str | Sequence[str],
    value: str,
    rows: int = 7,
    name: str = "moving_avg",
    digits: int = 2,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Mean of the current and the ``rows - 1`` preceding rows, rounded.

    Rows tied in the order follow each other by their other columns.
    """
    part, order = _names(part), _names(order)
    order = _total_order(df, part, order)
    size = rows - 1

    def plain(data):
        window = Window.partitionBy(*part).orderBy(*order).rowsBetween(-size, 0)
        return data.withColumn(name, F.round(F.avg(value).over(window), digits))

    def blocked(data):
        window = _block_window(order)
        frame = window.rowsBetween(-size, 0)
        local = data.withColumns(
            {
                "_row": F.row_number().over(window),
                "_sum": F.sum(value).over(frame),
                "_count": F.count(value).over(frame),
            }
        ).join(_tails(data, order, value, max(size, 1)), BLOCK_KEYS)
        kind = local.schema["_sum"].dataType
        missing = F.greatest(F.lit(rows) - F.col("_row"), F.lit(0))
        taken = F.filter(
            F.slice(
                "_tail",
                F.greatest(F.size("_tail") - missing + 1, F.lit(1)),
                missing,
            ),
            lambda entry: entry.isNotNull(),
        )
        carried = F.aggregate(
            taken, F.lit(0).cast(kind), lambda total, entry: (total + entry).cast(kind)
        )
        count = F.col("_count") + F.size(taken)
        total = F.coalesce(F.col("_sum"), F.lit(0).cast(kind)) + carried
        return local.withColumn(name, F.round(F.when(count > 0, total / count), digits))

    return _run(df, part, order, hot_rows, plain, blocked)


def sessionize(
    df: DataFrame,
    user: str | Sequence[str],
    ts: str,
    gap_s: int = 1800,
    name: str = "session_num",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Number each user's sessions; a gap above ``gap_s`` whole seconds starts one."""
    part, order = _names(user), [ts]

    def starts(previous: Column) -> Column:
        idle = epoch_seconds(df, ts) - epoch_seconds(df, ts, previous)
        return F.when(previous.isNull() | (idle > gap_s), 1).otherwise(0)

    def plain(rows):
        window = Window.partitionBy(*part).orderBy(ts)
        marked = rows.withColumn("_previous", F.lag(ts).over(window)).withColumn(
            "_start", starts(F.col("_previous"))
        )
        return marked.withColumn(name, F.sum("_start").over(window)).drop("_previous", "_start")

    def blocked(rows):
        window = _block_window(order)
        newest = rows.groupBy(*BLOCK_KEYS).agg(F.max(ts).alias("_newest"))
        entry = newest.select(
            *BLOCK_KEYS, F.lag("_newest").over(_across_blocks()).alias("_entry")
        )
        marked = (
            rows.withColumn("_row", F.row_number().over(window))
            .withColumn("_lag", F.lag(ts).over(window))
            .join(entry, BLOCK_KEYS)
            .withColumn(
                "_start",
                starts(F.when(F.col("_row") == 1, F.col("_entry")).otherwise(F.col("_lag"))),
            )
        )
        totals = marked.groupBy(*BLOCK_KEYS).agg(F.sum("_start").alias("_sum"))
        earlier = _earlier_sum(totals, "_sum", "_earlier")
        return (
            marked.withColumn("_local", F.sum("_start").over(window))
            .join(earlier, BLOCK_KEYS)
            .withColumn(name, _null_safe_sum(F.col("_local"), F.col("_earlier")))
        )

    return _run(df, part, order, hot_rows, plain, blocked)


def row_numbers(
    df: DataFrame,
    part: str | Sequence[str],
    order: Sequence[str],
    name: str = "row_number",
    hot_rows: int | None = HOT_ROWS,
    first: int | None = None,
) -> DataFrame:
    """Number the rows of each group from 1 (``"-amount"`` sorts descending).

    Ties are broken by the other columns. A group above ``hot_rows`` is cut by range: the
    rows of a block are numbered on their own and the blocks before it are counted. With
    ``first`` only that many rows of a group are kept, and blocks that begin beyond them
    are left out before anything is sorted.
    """
    part = _names(part)
    order = _total_order(df, part, list(order))

    def kept(numbered):
        return numbered if first is None else numbered.filter(F.col(name) <= first)

    def plain(rows):
        window = Window.partitionBy(*part).orderBy(*sort_columns(order))
        return kept(rows.withColumn(name, F.row_number().over(window).cast("long")))

    def blocked(rows):
        sizes = rows.groupBy(*BLOCK_KEYS).agg(F.count(F.lit(1)).alias("_rows"))
        earlier = _earlier_sum(sizes, "_rows", "_earlier").na.fill(0, ["_earlier"])
        if first is not None:
            earlier = earlier.filter(F.col("_earlier") < first)
        window = Window.partitionBy(*BLOCK_KEYS).orderBy(*sort_columns(order))
        # The join comes first, so that blocks without a wanted row are never sorted.
        numbered = rows.join(earlier, BLOCK_KEYS).withColumn("_row", F.row_number().over(window))
        return kept(numbered.withColumn(name, F.col("_row") + F.col("_earlier")))

    return _run(df, part, order, hot_rows, plain, blocked)


# Up to this n, Spark cuts each group to n rows in every task before the shuffle.
GROUP_LIMIT = 1000


def top_n_per_group(
    df: DataFrame,
    part: str | Sequence[str],
    order: Sequence[str],
    n: int,
    ties: str = "row",
    name: str = "rank",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Best n rows per group (``"-amount"`` sorts descending).

    ``ties="row"`` numbers rows, ties broken by the other columns; ``ties="rank"`` keeps
    every row that ties with a kept one. For n up to 1000 each task passes on n rows of a
    group. Beyond that the rows of groups above ``hot_rows`` are cut into blocks by range, and
    those blocks that hold the first n rows are numbered, one task each.
    """
    part = _names(part)
    if n > GROUP_LIMIT:
        numbered = row_numbers(df, part, order, name, hot_rows, first=n)
        numbered = numbered.withColumn(name, F.col(name).cast("int"))
    else:
        window = Window.partitionBy(*part).orderBy(*sort_columns(_total_order(df, part, list(order))))
        numbered = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    if ties == "row":
        return numbered
    # The rank of a value is the row number of its first row, and every rank
    # up to n shows within the first n rows. Joining back spreads tied rows; the
    # table of ranks is written down so that its size decides how to join.
    keys = [*part, *(key for key in sort_names(order) if key not in part)]
    ranks = cut_lineage(numbered.groupBy(*keys).agg(F.min(name).alias(name)))
    match = F.lit(True)
    for key in keys:
        match = match & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return df.alias("l").join(ranks.alias("r"), match).select("l.*", f"r.{name}")
