"""Benchmark decontamination by template canonicalisation.

Texts become tokens, and numbers, units and names become typed placeholders. Windows of
the resulting templates are looked up among those of the benchmark by hash. Matched
windows that lie on one diagonal are one occurrence of an item; it counts if its slots
are consistent, that is, if every value of the item is always replaced by the same one.
So a question is found again with other numbers and names in it. All in built-in
expressions.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.runtime import cut_and_measure

WINDOW = 5
LITERALS = 3  # a window needs so many tokens that are no placeholder
TOKEN = r"\p{N}+(?:[.,:/]\p{N}+)*|\p{L}[\p{L}\p{M}]*|[%$€£°]"
# Units of measure and currency.
UNITS = (
    "% $ € £ ° mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres "
    "kilometer kilometers kilometre kilometres centimeter centimeters mg g kg lb lbs oz gram grams kilogram kilograms "
    "pound pounds ounce ounces ton tons ml l liter liters litre litres gallon gallons s ms sec second seconds min minute "
    "minutes h hr hour hours day days week weeks month months year years dollar dollars cent cents euro euros usd eur gbp "
    "percent degrees celsius fahrenheit volt volts watt watts kw kwh joule joules hz khz mhz ghz kb mb gb tb byte bytes "
    "mph kmh acre acres hectare hectares"
).split()
NUMBER, UNIT, NAME = "#number", "#unit", "#name"


def _tokens(docs: DataFrame, text: str) -> DataFrame:
    """Columns of ``docs``, ``__raw`` tokens, their templates ``__plain``, and ``__fixed`` and ``__name``.

    In the templates numbers, and units next to them, are placeholders and case is ignored.
    ``__fixed`` is 1 for tokens that are no placeholder. ``__name`` marks capitalised words,
    which a second template replaces too.
    """
    raw = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(TOKEN), F.lit(0))
    units = F.array(*[F.lit(unit) for unit in UNITS])

    def digit(token: Column) -> Column:
        # ":" follows "9" and "±" follows "°", the last token that is neither number nor word.
        return F.when(token < ":", token >= "0").otherwise((token >= "±") & token.rlike(r"^\p{N}"))

    def plain(token: Column, at: Column) -> Column:
        # Outside the array a neighbour is null, and a null condition is none.
        beside = F.get("__digit", at - 1) | F.get("__digit", at + 1)
        lower = F.lower(token)
        return F.when(F.get("__digit", at), NUMBER).when(beside & F.array_contains(units, lower), UNIT).otherwise(lower)

    return (
        docs.withColumn("__raw", raw)
        .withColumn("__digit", F.transform("__raw", digit))
        .withColumn("__plain", F.transform("__raw", plain))
        .withColumn("__fixed", F.transform("__plain", lambda token: (~token.startswith("#")).cast("int")))
        .withColumn("__name", F.zip_with("__raw", "__plain", lambda token, literal: (literal != token) & ~literal.startswith("#")))
        .drop("__digit")
    )


def _windows(docs: DataFrame, text: str) -> DataFrame:
    """Columns of ``docs``, ``__raw``, ``at`` and ``hashes``: a row per place of a window.

    ``hashes`` has the hash of the plain window and, where that differs, of the one with
    names replaced; null stands for a window with fewer than ``LITERALS`` tokens outside
    placeholders, which matches anything and is none. Texts too short for a window leave one
    row without a place. Windows are formed from rows: Spark compiles that, but not the
    functions of arrays.
    """
    prepared = _tokens(docs, text).withColumn("__code", F.transform("__plain", lambda token: F.xxhash64(token)))
    last = F.size("__raw") - WINDOW
    places = F.when(last >= 0, F.sequence(F.lit(0), last))
    # The outer forms of explode keep Spark from filtering on their arrays first, which
    # would compute them a second time.
    rows = prepared.select(*docs.columns, "__raw", "__code", "__name", F.explode_outer(places).alias("at"))
    codes = [F.get("__code", F.col("at") + step) for step in range(WINDOW)]
    named = [F.get("__name", F.col("at") + step) for step in range(WINDOW)]
    number, unit, name = (F.xxhash64(F.lit(word)) for word in (NUMBER, UNIT, NAME))
    fixed = reduce(add, [((code != number) & (code != unit)).cast("int") for code in codes])
    names = reduce(add, [mark.cast("int") for mark in named])
    masked = [F.when(mark, name).otherwise(code) for mark, code in zip(named, codes)]
    hashes = F.array(
        F.when(fixed >= LITERALS, F.xxhash64(*codes)),
        F.when((names > 0) & (fixed - names >= LITERALS), F.xxhash64(*masked)),
    )
    return rows.select(*docs.columns, "__raw", "at", hashes.alias("hashes"))


def _values(raw: str, at: Column) -> Column:
    return F.slice(raw, at + 1, F.lit(WINDOW))


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> tuple[DataFrame, int]:
    """The benchmark's windows, written down once, and their number: item, of (windows of
    the item), at, hash, and the tokens as they stand."""
    named = benchmark.select(F.col(item).alias("item"), F.col(text).alias("body")).dropDuplicates()
    places = (
        _windows(named, "body")
        .filter(F.coalesce(F.get("hashes", F.lit(0)), F.get("hashes", F.lit(1))).isNotNull())
        .select("item", F.xxhash64("body").alias("item_text"), "at", "hashes", _values("__raw", F.col("at")).alias("item_values"))
    )
    of = F.count(F.lit(1)).over(Window.partitionBy("item", "item_text")).cast("int")
    rows = (
        places.withColumn("of", of)
        .select("item", "item_text", "of", F.col("at").alias("item_at"), F.explode_outer("hashes").alias("item_hash"), "item_values")
        .filter("item_hash IS NOT NULL")
    )
    written, measured = cut_and_measure(rows)
    return written, measured["rows"]


def _bitmap(windows: DataFrame, bits: int) -> DataFrame:
    """One row: the array ``words`` of ``bits`` / 64 numbers with a bit for every hash."""
    spark = windows.sparkSession
    place = F.pmod("item_hash", F.lit(bits))
    used = windows.select((place / 64).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int")).alias("bit"))
    every = spark.range(bits // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bit"))
    merged = used.unionByName(every).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    gathered = merged.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("all"))
    return gathered.select(F.transform("all", lambda entry: entry["bits"]).alias("words"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", similarity: float = 0.8,
) -> DataFrame:
    """Pairs of a document and a benchmark item it contains, re-parameterised or not.

    Columns: the key, ``doc_text`` (a hash of the text), the item, ``windows`` (of the
    item), ``covered`` (those found in consistent occurrences) and ``similarity``, their
    share, at least as given. One row per different (key, text) and item. Null texts
    contain nothing; null keys are keys; an item or text of fewer than five tokens, or
    with placeholders only, has no window and matches nothing.

    A bitmap over the hashes of the benchmark's windows, 256 bits each up to 8 MB in all,
    rules out nearly all windows where they arise; what passes is compared exactly by a
    join on the hash, so a crowded bitmap costs time only.
    """
    windows, count = benchmark_windows(benchmark, item, item_text)
    bits = min(1 << 26, max(1 << 12, 1 << (256 * count).bit_length()))
    prepared = _windows(docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")), "__text")
    place = F.pmod("hash", F.lit(bits))
    word = F.get(_bitmap(windows, bits).scalar(), (place / 64).cast("int"))
    passed = F.call_function("shiftright", word, (place % 64).cast("int")).bitwiseAND(F.lit(1)) == 1
    hits = (
        prepared.select("__key", "__text", "__raw", "at", F.explode_outer("hashes").alias("hash"))
        .filter(passed)
        .select("__key", F.xxhash64("__text").alias("__doc_text"), "at", "hash", _values("__raw", F.col("at")).alias("values"))
    )
    matched = hits.join(windows, hits["hash"] == windows["item_hash"])
    pairs = F.filter(
        F.zip_with("item_values", "values", lambda a, b: F.struct(F.lower(a).alias("a"), F.lower(b).alias("b"))),
        lambda pair: pair["a"] != pair["b"],
    )
    # Values that stay as they are may stand beside others that change: all slots count.
    slots = F.zip_with("item_values", "values", lambda a, b: F.struct(F.lower(a).alias("a"), F.lower(b).alias("b")))
    occurrence = matched.groupBy(
        "__key", "__doc_text", "item", "item_text", "of", (F.col("at") - F.col("item_at")).alias("diagonal")
    ).agg(
        F.collect_set("item_at").alias("places"),
        F.flatten(F.collect_set(slots)).alias("slots"),
        F.max(F.size(pairs)).alias("changed"),
    )
    distinct = F.array_distinct("slots")
    consistent = F.size(distinct) == F.size(F.array_distinct(F.transform(distinct, lambda pair: pair["a"])))
    return (
        occurrence.filter((F.col("changed") == 0) | consistent)
        .groupBy("__key", "__doc_text", "item", "item_text", "of")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("covered"))
        .filter(F.col("covered") >= similarity * F.col("of"))
        .select(
            F.col("__key").alias(key), F.col("__doc_text").alias("doc_text"), F.col("item").alias(item),
            F.col("of").alias("windows"), "covered", (F.col("covered") / F.col("of")).alias("similarity"),
        )
        .distinct()
    )


def without_contaminated(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that contain no benchmark item."""
    bad = found.select(F.col(key).alias("__key"), F.col("doc_text").alias("__doc_text")).distinct()
    same = docs[key].eqNullSafe(bad["__key"]) & (F.xxhash64(docs[text]) == bad["__doc_text"])
    return docs.join(bad, same, "left_anti")
