"""Mixing sources to target weights along a curriculum that changes over time.

Every source has a demand for words (its target) and a schedule, a weight that varies
over training time. The integral of the schedule, scaled to the target, is the source's
cumulative demand. Its documents, in a seeded order, serve that demand one after the
other, and the inverse of the cumulative demand gives the training time of each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (1, 2, 3)
# Knots (time, weight) of each source's schedule, repeating like the weights: first
# early, then even, then late in training.
SCHEDULES = (((0, 4), (1, 1)), ((0, 1), (1, 1)), ((0, 1), (0.5, 2), (1, 4)))


def demand_time(share: Column, schedule: Sequence[tuple[float, float]]) -> Column:
    """Time at which this share of a source's demand has been served.

    Between two knots the weight is linear, so the demand is quadratic and its inverse
    has a closed form.
    """
    pieces, served = [], 0.0
    for (begin, low), (stop, high) in zip(schedule, schedule[1:]):
        pieces.append((begin, stop, low, high, served))
        served += (stop - begin) * (low + high) / 2
    result: Column | None = None
    for begin, stop, low, high, before in reversed(pieces):
        slope = (high - low) / (stop - begin)
        left = F.greatest(share * served - before, F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(low * low) + 2 * slope * left, F.lit(0.0)))
        time = F.lit(float(begin)) + F.when(left > 0, 2 * left / (low + root)).otherwise(0.0)
        result = time if result is None else F.when(share * served < before + (stop - begin) * (low + high) / 2, time).otherwise(result)
    return F.least(result, F.lit(float(schedule[-1][0])))


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = 3) -> DataFrame:
    """Add ``turn`` (rank of the source, from 0), ``target`` and ``demand`` to sources.

    ``sources`` has one row per source: ``source`` and ``source_size``. Sources are
    ranked by code point, null last, and weigh ``weights`` in turn. Shares of the total
    stop at ``most`` times the source's size; what is over goes to the others by weight
    until none is above. That is one level for all: a source gets its weight times the
    level, or its limit where that is lower. With the sources sorted by limit over
    weight, the level is the first one that the next source's limit doesn't cut. All
    windows here run over one row per source. ``demand`` is the target in whole words.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("ratio", "turn").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    kinds = F.array(*[F.lit(weight) for weight in weights])
    ranked = sources.withColumn("turn", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("weight", F.get(kinds, F.col("turn") % len(weights)))
    ranked = ranked.withColumn("limit", most * F.col("source_size"))
    ranked = ranked.withColumn("ratio", F.col("limit") / F.col("weight"))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(by_limit), F.lit(0))
    sharing = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_limit), F.lit(0))
    ranked = ranked.withColumn("level", left.cast("double") / sharing)
    found = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "turn", "level"))
    level = F.min(found).over(everything)["level"]
    target = F.least(F.col("limit").cast("double"), level * F.col("weight"))
    return (
        ranked.withColumn("target", target)
        .withColumn("demand", F.floor(F.col("target") + 0.5).cast("long"))
        .select("source", "source_size", "turn", "target", "demand")
    )


def mix(
    docs: DataFrame,
    size: str = "size",
    key: str = "doc_id",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    most: int = 3,
    seed: int = 0,
    blocks: int = 4096,
) -> DataFrame:
    """What the mix takes of every document, and when.

    Adds ``source_size``, ``target``, ``taken`` (words, repeats counted) and ``positions``,
    one training time from 0 to 1 per copy; columns of these names, and those starting
    with two underscores, are replaced. ``size`` names a column with each document's
    words. A source's documents are taken whole, in order of a seeded digest of the key,
    again from the first once all are used, until its demand is met; the last one only as
    far as needed. A copy's position is the time at which half of it is served.

    Null keys share one digest; rows of one digest follow each other by size. A null
    source is a source. Documents without words take nothing and have no position.
    Repeated rows count each. An empty table gives no row.

    Running sums go in two steps, first over blocks of the digest, then inside each
    block, so that no source is in one task, however large.
    """
    added = ("source_size", "target", "taken", "positions")
    docs = docs.drop(*added)
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    first_bits = F.conv(F.substring("__digest", 1, 8), 16, 10).cast("long")
    rows = docs.withColumn("__digest", digest).withColumn(
        "__block", F.shiftright(first_bits * blocks, 32).cast("int")
    )
    sums = rows.groupBy(F.col(source).alias("source"), "__block").agg(F.sum(size).alias("block_size"))
    sources = source_targets(
        sums.groupBy("source").agg(F.sum("block_size").alias("source_size")), weights, most
    )
    earlier = Window.partitionBy("__of", "__block_of").orderBy("__digest", size).rowsBetween(
        Window.unboundedPreceding, -1
    )
    before_block = Window.partitionBy("source").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sums.withColumn("__offset", F.coalesce(F.sum("block_size").over(before_block), F.lit(0)))
        .join(sources.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named")))
        .select(
            F.col("source").alias("__of"), F.col("__block").alias("__block_of"),
            "__offset", "source_size", "target", F.col("demand").alias("__demand"), F.col("turn").alias("__turn"),
        )
    )
    placed = rows.join(
        offsets, rows[source].eqNullSafe(offsets["__of"]) & (F.col("__block") == F.col("__block_of"))
    ).withColumn("__start", F.col("__offset") + F.coalesce(F.sum(size).over(earlier), F.lit(0)))
    rounds = F.floor(F.col("__demand") / F.greatest(F.col("source_size"), F.lit(1))).cast("long")
    rest = F.col("__demand") - rounds * F.col("source_size")
    part = F.greatest(F.least(rest - F.col("__start"), F.col(size)), F.lit(0))
    copies = F.when(F.col(size) > 0, rounds + (part > 0).cast("long")).otherwise(F.lit(0))
    placed = placed.withColumn("__rounds", rounds).withColumn("__part", part).withColumn("__copies", copies)
    taken = (F.col("__rounds") * F.col(size) + F.col("__part")).cast("long")

    def position(copy: Column) -> Column:
        served = F.when(copy < F.col("__rounds"), F.col(size)).otherwise(F.col("__part"))
        share = (copy * F.col("source_size") + F.col("__start") + served / 2) / F.greatest(
            F.col("__demand"), F.lit(1)
        )
        turn = F.col("__turn") % len(schedules)
        time = F.lit(None).cast("double")
        for number, schedule in enumerate(schedules):
            time = F.when(turn == number, demand_time(share, schedule)).otherwise(time)
        return time

    counted = F.filter(F.sequence(F.lit(0), F.col("__copies")), lambda copy: copy < F.col("__copies"))
    return placed.select(
        *docs.columns, "source_size", "target", taken.alias("taken"),
        F.transform(counted, position).alias("positions"),
    )


def in_training_order(mixed: DataFrame, size: str = "size") -> DataFrame:
    """One row per taken copy, range-sorted by ``position``.

    A copy that the mix takes less than half of is left out.
    """
    copies = F.floor(F.col("taken") / F.col(size) + 0.5).cast("int")
    columns = [name for name in mixed.columns if name not in ("positions", "position")]
    return (
        mixed.filter(F.col("taken") > 0)
        .select(*columns, F.explode(F.slice("positions", F.lit(1), copies)).alias("position"))
        .orderBy("position")
    )
