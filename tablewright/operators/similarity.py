"""Item-to-item cosine similarity over co-ratings, and popular items."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.joins import lookup
from tablewright.operators.ordering import top_k
from tablewright.operators.skew import GROUP_ID, GROUP_ROWS, hot_groups, split_hot
from tablewright.operators.windows import top_n_per_group
from tablewright.runtime import cut_and_measure, cut_lineage

# Users with more items than this are worked on by several tasks.
ITEMS_PER_TASK = 5_000

# Pairs that a task forms and adds up; more of them make more tasks, up to a number that Spark can deal to.
PAIRS_PER_TASK = 1_000_000
MOST_TASKS = 10_000

# With no more pairs per rating than this, all pairs are formed without looking for a shorter way.
FEW_PAIRS = 8


def rating_moments(ratings: DataFrame, user: str, item: str, value: str) -> DataFrame:
    """One row per (user, item): row count, value count, sum, sum of squares.

    Pair sums over repeated ratings factor into these four numbers, so repeats
    are combined here, before any pairing, and the result stays exact.
    """
    rating = F.col(value)
    return (
        ratings.filter(F.col(user).isNotNull() & F.col(item).isNotNull())
        .groupBy(F.col(user).alias("user"), F.col(item).alias("item"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(rating).alias("n_rated"),
            F.sum(rating).alias("total"),
            F.sum(rating * rating).alias("squares"),
        )
    )


_MOMENTS = ["n", "n_rated", "total", "squares"]


def _side(moments: DataFrame, number: int, keys: list[str]) -> DataFrame:
    carried = [name for name in _MOMENTS if name in moments.columns]
    return moments.select(
        *keys, F.col("item").alias(f"item{number}"),
        *(F.col(name).alias(f"{name}{number}") for name in carried),
    )


def _pair_counts(moments: DataFrame, items_per_task: int) -> tuple[int, float, float]:
    """The most items of a user, and how many pairs all users and those not cut into blocks form."""
    items = F.col("_items")
    formed = items.cast("double") * (items - 1) / 2
    busy = moments.groupBy("user").agg(F.count(F.lit(1)).alias("_items"))
    counts = busy.agg(F.max(items), F.sum(formed), F.sum(F.when(items <= items_per_task, formed))).first()
    return counts[0] or 0, counts[1] or 0.0, counts[2] or 0.0


def _paired(moments: DataFrame, items_per_task: int, counts: tuple[int, float, float] | None = None) -> DataFrame:
    """Each user's items in pairs (item1 < item2); read several times, so it should be written down.

    The users are dealt to as many tasks as their pairs need, so what a task adds up stays
    small however many users there are.
    """
    most, _, formed = counts or _pair_counts(moments, items_per_task)
    tasks = min(MOST_TASKS, math.ceil(formed / PAIRS_PER_TASK))

    def joined(rows: DataFrame) -> DataFrame:
        dealt = rows.repartition(tasks, "user") if tasks > 1 else rows
        return _side(dealt, 1, ["user"]).join(_side(dealt, 2, ["user"]), "user")

    crowded = hot_groups(moments, ["user"], items_per_task) if most > items_per_task else None
    if crowded is None:
        return joined(moments).filter("item1 < item2").drop("user")

    ordinary, heavy = split_hot(moments, crowded, ["user"])
    plain = joined(ordinary)
    blocks = F.ceil(F.col(GROUP_ROWS) / F.lit(max(items_per_task, 1))).cast("long")
    cut = heavy.withColumn("_blocks", blocks).withColumn(
        "_own", F.pmod(F.xxhash64("item"), F.col("_blocks"))
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    cell = [GROUP_ID, "_block1", "_block2"]
    left = _side(cut.withColumn("_block1", F.col("_own")).withColumn("_block2", every), 1, cell)
    right = _side(cut.withColumn("_block2", F.col("_own")).withColumn("_block1", every), 2, cell)
    split = left.join(right, cell).drop(*cell)
    return plain.drop("user").unionByName(split).filter("item1 < item2")


def item_pairs(
    ratings: DataFrame, user: str, item: str, value: str, items_per_task: int = ITEMS_PER_TASK
) -> DataFrame:
    """Items rated by the same user, each unordered pair once (item1 < item2).

    The rows are meant to flow straight into ``cosine_similarity``, whose
    map-side step adds them up in the task that makes them, so they are neither
    stored nor shuffled. A user with many items is cut into blocks of items;
    each task then pairs one block with one other. The combined ratings are written
    down first, as both sides of the join and the search for such users read them.
    """
    moments = cut_lineage(rating_moments(ratings, user, item, value))
    return _paired(moments, items_per_task)


def candidate_pairs(moments: DataFrame, min_pairs: int, items_per_task: int = ITEMS_PER_TASK) -> DataFrame:
    """Item pairs (item1, item2) that may have more than ``min_pairs`` co-ratings.

    Such items share at least t users, where a user who rated both counts for the square
    of the most ratings that anyone gave one item. All users are put in one order, those of
    few items first, and of an item's users the last t - 1 are left aside: two items that
    share t users share one of the others. So users of very many items, who come last,
    form next to no pairs, and items of fewer than t users none. No pair is lost.
    """
    rated = moments.filter("n_rated > 0").select("user", "item", "n_rated")
    most = rated.agg(F.max("n_rated")).first()[0] or 1
    shared = min_pairs // most**2 + 1
    if shared > 1:
        enough = rated.groupBy("item").agg(F.count(F.lit(1)).alias("_users")).filter(F.col("_users") >= shared)
        rated = rated.join(enough.select("item"), "item", "left_semi")
        busy = rated.groupBy("user").agg(F.count(F.lit(1)).alias("_items"))
        ordered = cut_lineage(rated.select("user", "item").join(busy, "user"))
        last = top_n_per_group(ordered, "item", ["-_items", "-user"], shared - 1).select("item", "user")
        rated = ordered.join(last, ["item", "user"], "left_anti")
    return _paired(cut_lineage(rated.select("user", "item")), items_per_task).distinct()


def pruned_similarity(
    ratings: DataFrame, user: str, item: str, value: str, min_pairs: int, items_per_task: int = ITEMS_PER_TASK
) -> DataFrame:
    """``item_similarity`` of the pairs with more than ``min_pairs`` (0 or more) co-ratings.

    The same rows, in whichever way reads fewer: forming all pairs, or taking the candidates
    of ``candidate_pairs`` and working each out over the users of whichever of its items has
    fewer. Both numbers are counted before either is done; where all pairs are few, the
    candidates are not looked for.
    """
    moments, state = cut_and_measure(rating_moments(ratings, user, item, value))
    counts = _pair_counts(moments, items_per_task)
    formed = counts[1]
    if formed > FEW_PAIRS * state["rows"]:
        turned, checks = _candidates_to_check(moments, min_pairs, items_per_task)
        if checks < formed:
            return cosine_similarity(_checked(turned, moments), min_pairs)
    return cosine_similarity(_paired(moments, items_per_task, counts), min_pairs)


def _candidates_to_check(moments: DataFrame, min_pairs: int, items_per_task: int) -> tuple[DataFrame, int]:
    """Candidates as the item of fewer users and the other, and the users of the former in all."""
    pairs = candidate_pairs(moments, min_pairs, items_per_task)
    sizes = moments.groupBy("item").agg(F.count(F.lit(1)).alias("_users"))
    sized = pairs.join(sizes.toDF("item1", "_users1"), "item1").join(sizes.toDF("item2", "_users2"), "item2")
    swapped = F.col("_users1") > F.col("_users2")
    few, many = F.when(swapped, F.col("item2")).otherwise(F.col("item1")), F.when(swapped, F.col("item1")).otherwise(F.col("item2"))
    users = F.least("_users1", "_users2")
    turned, state = cut_and_measure(
        sized.select(swapped.alias("_swapped"), few.alias("_few"), many.alias("_many"), users.alias("_users")),
        checks=F.sum("_users"),
    )
    return turned.drop("_users"), state["checks"] or 0


def _checked(turned: DataFrame, moments: DataFrame) -> DataFrame:
    """The candidates' pairs of ratings, found from the item of fewer users."""
    a = moments.select("user", F.col("item").alias("_few"), *(F.col(name).alias(f"_a_{name}") for name in _MOMENTS))
    b = moments.select("user", F.col("item").alias("_many"), *(F.col(name).alias(f"_b_{name}") for name in _MOMENTS))
    met = turned.join(a, "_few").join(b, ["_many", "user"])

    def side(number: int, name: str, first: str, second: str):
        first, second = (first, second) if number == 1 else (second, first)
        return F.when(F.col("_swapped"), F.col(second)).otherwise(F.col(first)).alias(f"{name}{number}")

    columns = [side(number, "item", "_few", "_many") for number in (1, 2)]
    columns += [side(number, name, f"_a_{name}", f"_b_{name}") for name in _MOMENTS for number in (1, 2)]
    return met.select(*columns)


def nearest_items(
    ratings: DataFrame,
    user: str,
    item: str,
    value: str,
    k: int = 10,
    min_score: float = 0.97,
    min_pairs: int = 50,
) -> DataFrame:
    """Every item's k best neighbours: (item, neighbour, rank, score, num_pairs).

    Limits are strict, as in ``similar_items``; of equal scores the one with more
    co-ratings, then the smaller item, comes first.
    """
    found = cut_lineage(pruned_similarity(ratings, user, item, value, min_pairs).filter(F.col("score") > min_score))
    sides = ["score", "num_pairs"]
    both = found.select(F.col("item1").alias("item"), F.col("item2").alias("neighbour"), *sides).unionByName(
        found.select(F.col("item2").alias("item"), F.col("item1").alias("neighbour"), *sides)
    )
    best = top_n_per_group(both, "item", ["-score", "-num_pairs", "neighbour"], k)
    return best.select("item", "neighbour", F.col("rank").cast("long").alias("rank"), *sides)


def pairs_with(
    ratings: DataFrame, user: str, item: str, value: str, wanted: object
) -> DataFrame:
    """The pairs one item takes part in: its raters joined with all they rated."""
    raters = ratings.filter((F.col(item) == F.lit(wanted)) & F.col(user).isNotNull()).select(user).distinct()
    moments = rating_moments(ratings.join(raters, user, "left_semi"), user, item, value)
    chosen = F.col("item") == F.lit(wanted)
    mine = _side(moments.filter(chosen), 1, ["user"])
    others = _side(moments.filter(~chosen), 2, ["user"])
    pairs = mine.join(others, "user").drop("user")
    first = F.col("item1") < F.col("item2")

    def ordered(name):
        a, b = F.col(f"{name}1"), F.col(f"{name}2")
        return [F.when(first, a).otherwise(b).alias(f"{name}1"),
                F.when(first, b).otherwise(a).alias(f"{name}2")]

    return pairs.select(*(c for name in ["item", *_MOMENTS] for c in ordered(name)))


def cosine_similarity(pairs: DataFrame, min_pairs: int | None = None) -> DataFrame:
    """Score and co-rating count per item pair; a zero denominator scores 0."""
    sums = pairs.groupBy("item1", "item2").agg(
        F.sum(F.col("total1") * F.col("total2")).alias("numerator"),
        (
            F.sqrt(F.sum(F.col("squares1") * F.col("n2")))
            * F.sqrt(F.sum(F.col("n1") * F.col("squares2")))
        ).alias("denominator"),
        F.sum(F.col("n_rated1") * F.col("n_rated2")).alias("num_pairs"),
    )
    if min_pairs is not None:
        sums = sums.filter(F.col("num_pairs") > min_pairs)
    score = F.when(
        F.col("denominator") != 0, F.col("numerator") / F.col("denominator")
    ).otherwise(F.lit(0.0))
    return sums.select("item1", "item2", score.alias("score"), "num_pairs")


def item_similarity(
    ratings: DataFrame,
    user: str,
    item: str,
    value: str,
    min_pairs: int | None = None,
    only: object = None,
    items_per_task: int = ITEMS_PER_TASK,
) -> DataFrame:
    """Cosine similarity of all co-rated item pairs, or of those with item ``only``.

    With ``min_pairs``, pairs that cannot have more co-ratings are not formed where that is shorter.
    """
    if only is None and min_pairs is not None and min_pairs >= 0:
        return pruned_similarity(ratings, user, item, value, min_pairs, items_per_task)
    if only is None:
        pairs = item_pairs(ratings, user, item, value, items_per_task)
    else:
        pairs = pairs_with(ratings, user, item, value, only)
    return cosine_similarity(pairs, min_pairs)


def similar_items(
    similarities: DataFrame,
    item: object,
    min_score: float = 0.97,
    min_pairs: int = 50,
    k: int = 10,
) -> DataFrame:
    """The k best neighbours of an item, on either side of the pair (strict limits)."""
    wanted = F.lit(item)
    found = similarities.filter(
        ((F.col("item1") == wanted) | (F.col("item2") == wanted))
        & (F.col("score") > min_score)
        & (F.col("num_pairs") > min_pairs)
    )
    other = F.when(F.col("item1") == wanted, F.col("item2")).otherwise(F.col("item1"))
    named = found.select(other.alias("item"), "score", "num_pairs")
    return top_k(named, ["-score", "-num_pairs", "item"], k)


def popular_items(
    ratings: DataFrame,
    names: DataFrame,
    item: str,
    name_key: str,
    title: str,
    k: int = 10,
    default: str = "Unknown",
) -> DataFrame:
    """The k most rated items with their titles."""
    counts = ratings.groupBy(item).agg(F.count(F.lit(1)).alias("count"))
    best = top_k(counts, ["-count", item], k)
    return lookup(best, names, item, title, default, dim_key=name_key)
