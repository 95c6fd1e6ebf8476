"""Quality rules: base counts, and a hashed n-gram likelihood ratio against a trusted target.

Two multinomials over hashed words and word pairs are counted: one over the trusted
documents, one over the whole raw corpus. A document's ratio is the mean, over its words
and pairs, of how much likelier each is under the first. Documents below a cut go; it is
learned from labelled documents. Everything is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import WORD, words
from tablewright.runtime import cut_lineage

SYMBOLS = "[#*$%&|<>]+"


def _word_hashes(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``__words`` and ``__hashes``."""
    return docs.withColumn("__words", words(F.col(text))).withColumn(
        "__hashes", F.transform("__words", lambda word: F.xxhash64(word))
    )


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and ``__hashes``.

    Columns of these names are replaced. A null text counts as empty: all counts are 0.
    Three-word windows are compared by 64-bit hashes. A text without a repeated window,
    the usual case, costs one pass; in others the windows are sorted, and the words that
    a repeated window covers are counted once each.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    n = F.size("__hashes")
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get("__hashes", i), F.get("__hashes", i + 1), F.get("__hashes", i + 2)),
        ),
    )
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD))
    named = _word_hashes(docs, text).withColumn("__lines", lines).withColumn("__windows", windows)
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    ordered = F.when(
        repeats,
        F.sort_array(F.transform("__windows", lambda hash, at: F.struct(hash.alias("hash"), at.alias("at")))),
    )
    named = named.withColumn("__sorted", ordered)

    def same(i: Column, j: Column) -> Column:
        return F.get("__sorted", i)["hash"].eqNullSafe(F.get("__sorted", j)["hash"])

    again = F.filter(
        F.sequence(F.lit(0), F.size("__sorted") - 1), lambda i: same(i, i - 1) | same(i, i + 1)
    )
    covered = F.flatten(
        F.transform(
            F.transform(again, lambda i: F.get("__sorted", i)["at"]), lambda at: F.array(at, at + 1, at + 2)
        )
    )
    repeated = F.when(F.col("__sorted").isNull(), 0).otherwise(F.size(F.array_distinct(covered)))
    return named.select(
        *[c for c in docs.columns if c not in COUNTS],
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.regexp_replace(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
        "__hashes",
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _pair(i: Column) -> Column:
    return F.xxhash64(F.get("__hashes", i), F.get("__hashes", i + 1))


def _grams() -> Column:
    """Hashes of the words and word pairs of a row."""
    last = F.size("__hashes") - 1
    pairs = F.when(last >= 1, F.transform(F.sequence(F.lit(0), last - 1), _pair))
    return F.concat(F.col("__hashes"), F.coalesce(pairs, F.array().cast("array<long>")))


def gram_counts(docs: DataFrame, text: str, buckets: int) -> DataFrame:
    """Words and word pairs of all texts per hash bucket: ``bucket`` and ``n``."""
    return (
        _word_hashes(docs.select(text), text)
        .select(F.explode(_grams()).alias("hash"))
        .groupBy(F.pmod("hash", F.lit(buckets)).cast("int").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def likelihood_ratios(
    trusted: DataFrame, raw: DataFrame, text: str = "text", buckets: int = 8192, smoothing: float = 1.0
) -> DataFrame:
    """One row with the log-ratio of every bucket, as the array ``ratios``.

    Its length is ``buckets``, whatever the corpus. Without any trusted or raw words all
    ratios are 0.
    """
    counts = (
        gram_counts(trusted, text, buckets).select("bucket", F.col("n").alias("t"), F.lit(0).alias("r"))
        .unionByName(gram_counts(raw, text, buckets).select("bucket", F.lit(0).alias("t"), F.col("n").alias("r")))
        .unionByName(trusted.sparkSession.range(buckets).selectExpr("cast(id AS int) AS bucket", "0 AS t", "0 AS r"))
        .groupBy("bucket").agg(F.sum("t").alias("t"), F.sum("r").alias("r"))
    )
    gathered = counts.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "t", "r"))).alias("all"),
        F.sum("t").alias("n_t"),
        F.sum("r").alias("n_r"),
    )

    def ratio(entry: Column) -> Column:
        trust = (entry["t"] + smoothing) / (F.col("n_t") + smoothing * buckets)
        corpus = (entry["r"] + smoothing) / (F.col("n_r") + smoothing * buckets)
        known = (F.col("n_t") > 0) & (F.col("n_r") > 0)
        return F.when(known, F.log(trust) - F.log(corpus)).otherwise(0.0).cast("float")

    return gathered.select(F.transform("all", ratio).alias("ratios"))


def learned_cut(
    labelled: DataFrame, ratios: DataFrame, text: str = "text", label: str = "__label", buckets: int = 8192,
    smoothing: float = 1.0, default: float = -0.5,
) -> DataFrame:
    """One row with the ratio that parts the labels 0 and 1 with the fewest errors, as ``cut``.

    The rows with label 1 are the trusted documents behind ``ratios``. Each is taken at the
    ratio it would have if it were not one of them, as unlabelled documents are not.
    Only documents that pass the base rules count, as the others go anyway. The cut lies
    midway between two neighbouring ratios; of cuts with equally few errors that in the
    widest gap is taken. Keeping all of them is one of the choices. Where a label is
    missing, or all are best kept, nothing tells where to cut, and ``default`` is the cut,
    but no labelled document that is best kept falls below it. ``labelled`` has as many
    rows as are to be gathered in one.
    """
    trusted = gram_counts(labelled.filter(F.col(label) == 1), text, buckets)
    counts = cut_lineage(
        trusted.agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("counts"), F.sum("n").alias("n_t"))
        .select(
            F.transform(
                F.sequence(F.lit(0), F.lit(buckets - 1)), lambda b: F.coalesce(F.try_element_at("counts", b), F.lit(0))
            ).alias("counts"),
            (F.coalesce("n_t", F.lit(0)) + smoothing * buckets).alias("n_t"),
        )
    )
    judged = _word_hashes(judge(labelled.select(text, label), ratios, text, buckets), text)
    grams = F.transform(_grams(), lambda hash: F.pmod(hash, F.lit(buckets)).cast("int"))
    judged = (
        judged.withColumn("__grams", F.sort_array(grams)).withColumn("__n", F.size("__grams"))
        .withColumn("__counts", counts.select("counts").scalar()).withColumn("__n_t", counts.select("n_t").scalar())
    )

    def lost(run: Column) -> Column:
        """What the trusted share of a bucket loses without the row, over its grams there."""
        there = F.get("__counts", run["bucket"]) + smoothing
        return F.when(run["n"] > 0, run["n"] * F.log1p(-run["n"] / there)).otherwise(0.0)

    def add(run: Column, bucket: Column) -> Column:
        same = run["bucket"] == bucket
        return F.struct(
            bucket.alias("bucket"),
            F.when(same, run["n"] + 1).otherwise(1.0).alias("n"),
            F.when(same, run["lost"]).otherwise(run["lost"] + lost(run)).alias("lost"),
        )

    none = F.struct(F.lit(-1).alias("bucket"), F.lit(0.0).alias("n"), F.lit(0.0).alias("lost"))
    without = F.aggregate("__grams", none, add, lambda run: run["lost"] + lost(run))
    own = without / F.col("__n") - F.log1p(-F.col("__n") / F.col("__n_t"))
    judged = judged.withColumn("__own", F.when((F.col(label) == 1) & (F.col("__n") > 0), own).otherwise(0.0))
    # Conditions within the sums: a filter would be moved below the counts, with copies of them.
    row = F.struct((F.col("ratio") + F.col("__own")).alias("ratio"), F.col(label).cast("int").alias("good"))
    passed = F.when(~F.col("base_failed"), row)
    rows = cut_lineage(
        judged.agg(
            F.sort_array(F.collect_list(passed)).alias("rows"),
            F.count_if(passed["good"] == 0).alias("bad"),
            F.count_if(passed["good"] == 1).alias("good"),
        )
    )
    # A fold over the rows by ratio: errors of a cut below the row, the ratio before it, and
    # the best cut so far.
    start = F.struct(
        F.col("bad").cast("long").alias("errors"),
        F.lit(None).cast("double").alias("before"),
        F.struct(
            F.col("bad").cast("long").alias("errors"), F.lit(0.0).alias("narrow"), F.lit(None).cast("double").alias("cut")
        ).alias("best"),
    )

    def step(state: Column, row: Column) -> Column:
        here = F.struct(
            state["errors"].alias("errors"),
            (state["before"] - row["ratio"]).alias("narrow"),
            ((state["before"] + row["ratio"]) / 2).alias("cut"),
        )
        between = state["before"] < row["ratio"]
        return F.struct(
            (state["errors"] + 2 * row["good"] - 1).cast("long").alias("errors"),
            row["ratio"].alias("before"),
            F.when(between & (here < state["best"]), here).otherwise(state["best"]).alias("best"),
        )

    both = (F.col("bad") > 0) & (F.col("good") > 0)
    cut = F.when(both, F.aggregate("rows", start, step)["best"]["cut"])
    lowest = F.when(both, F.get("rows", F.lit(0))["ratio"])
    return rows.select(F.coalesce(cut, F.least(F.lit(default), lowest)).alias("cut"))


def judge(
    docs: DataFrame, ratios: DataFrame, text: str = "text", buckets: int = 8192, threshold: float = -0.5
) -> DataFrame:
    """Add the base counts, ``ratio``, ``base_failed`` and ``kept`` to every document.

    Columns of these names are replaced. ``base_failed``: fewer than 50 words, or more
    than half of them in repeated windows. ``ratio`` is the mean log-ratio over all words
    and word pairs; 0 for a wordless text. ``kept``: not failed, and ratio at or above
    the threshold; ``learned_cut`` finds one.
    """
    docs = docs.drop("ratio", "base_failed", "kept")
    counted = base_counts(docs, text).withColumn("__ratios", ratios.scalar())
    last = F.size("__hashes") - 1

    def of(hash: Column) -> Column:
        return F.get("__ratios", F.pmod(hash, F.lit(buckets)).cast("int")).cast("double")

    def add(sum_: Column, i: Column) -> Column:
        return sum_ + of(F.get("__hashes", i)) + F.when(i < last, of(_pair(i))).otherwise(0.0)

    total = F.aggregate(F.sequence(F.lit(0), last), F.lit(0.0), add)
    ratio = F.when(last >= 0, total / (2 * last + 1)).otherwise(0.0)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        counted.withColumn("ratio", ratio)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold))
        .drop("__hashes", "__ratios")
    )
