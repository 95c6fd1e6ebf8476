"""Phrases whose words stand together, counted in tiles of frequency-ranked ids.

Words get ids by falling frequency. A pair of neighbours is then a cell of a square, and
the square is cut into tiles: where a tile holds many pairs its cells are counted directly
(one dense ``bincount``), elsewhere pairs are sorted as coordinates and runs of equal ones
counted. Pairs that are frequent enough are ranked anew and take the place of words: two
of them that overlap in a word make a phrase of three, counted the same way, and so on.

Ids exist inside a task only. Between tasks an item is known by a 64-bit code, so ranks
need not cover everything: the ``ranked`` most frequent items of a level are sent to the
tasks, a table of bounded size, and any further ones are counted by their codes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.hashing import PLACES, bytes_of, mixed, pieces
from tablewright.runtime import cut_and_measure, cut_lineage

# What ends a piece, what stands between words, the language of a null.
ENDS = b".,;:!?\n\v\f\r"
SPACES = b" \t"
UNKNOWN = "und"

SIDE = 256  # ids along a tile's side
DENSE = SIDE * SIDE // 4  # pairs from which a tile is counted cell by cell
BUFFER = 3 << 19  # pairs counted at a time
SLICE = 2 << 20  # bytes of text cut into words at a time
STEP = 1 << 18  # bytes of a slice coded at a time
TILES = 1 << 20  # tiles of a square up to which each has a counter
ROWS = 1 << 16  # rows handed to Spark at a time
RANKED = 1 << 20  # items of a level that are sent to the tasks


def _byte_values() -> np.ndarray:
    """A random number for each byte at each place of a word; A-Z count as a-z."""
    values = np.random.default_rng(11_2024).integers(0, 2**64, (PLACES, 256), dtype=np.uint64)
    values[:, 65:91] = values[:, 97:123]
    values[:, list(SPACES + ENDS)] = 0
    return values


VALUES = _byte_values()
KIND = np.zeros(256, np.uint8)  # 0 in a word, 1 between words, 2 at the end of a piece
KIND[list(SPACES)], KIND[list(ENDS)] = 1, 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words(NamedTuple):
    """Words of a slice of texts: code, bytes from and to, whether the next one follows."""

    codes: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    joined: np.ndarray
    data: np.ndarray


def _sums(data: np.ndarray, place: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Each word's sum of the random numbers of its bytes; ``place`` counts within the word."""
    sums = np.empty(len(begins), np.uint64)
    cuts = np.unique(np.searchsorted(begins, np.arange(0, len(data) + STEP, STEP)))
    for one, other in zip(cuts[:-1], cuts[1:]):
        low, high = begins[one], begins[other] if other < len(begins) else len(data)
        values = VALUES[place[low:high] & (PLACES - 1), data[low:high]]
        sums[one:other] = np.add.reduceat(values, begins[one:other] - low)
    return sums


def cut_words(texts: pa.Array, langs: pa.Array) -> Words:
    """All words of the texts in order; a word's code depends on its text's language.

    Words of up to 64 bytes are coded by sums of random numbers, longer ones one by one.
    """
    data, offsets = bytes_of(texts)
    data = LOWER[data]
    kind = KIND[data]
    inside = kind == 0
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    starts[first] |= inside[first]
    begins = np.flatnonzero(starts)
    if not len(begins):
        nothing = np.zeros(0, np.int64)
        return Words(nothing.astype(np.uint64), nothing, nothing, nothing.astype(bool), data)
    at = np.arange(len(data), dtype=np.int32)
    place = np.where(starts, at, np.int32(0))
    np.maximum.accumulate(place, out=place)
    np.subtract(at, place, out=place)
    codes = _sums(data, place, begins)
    del at, place
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    later = first[first > 0] - 1
    closes[later] |= inside[later]
    stops = np.flatnonzero(closes) + 1
    for word in np.flatnonzero(stops - begins > PLACES).tolist():
        codes[word] = xxhash.xxh3_64_intdigest(data[begins[word] : stops[word]].tobytes(), seed=1)
    owner = np.searchsorted(offsets, begins, side="right") - 1
    names = langs.fill_null(UNKNOWN).dictionary_encode()
    seeds = np.array([xxhash.xxh3_64_intdigest(n.as_py().encode()) for n in names.dictionary], dtype=np.uint64)
    with np.errstate(over="ignore"):
        codes = mixed(codes + seeds[names.indices.to_numpy(zero_copy_only=False)[owner]])
    # A word follows the one before it if only spaces of the same text stand between.
    walls = np.concatenate(([0], np.cumsum(kind == 2, dtype=np.int32)))[begins]
    joined = np.zeros(len(begins), bool)
    joined[:-1] = (walls[1:] == walls[:-1]) & (owner[1:] == owner[:-1])
    return Words(codes, begins, stops, joined, data)


def pair_code(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Code of an item made of two overlapping ones (or of two words)."""
    with np.errstate(over="ignore"):
        return mixed(left * np.uint64(0x9E3779B97F4A7C15) + mixed(right + np.uint64(0x632BE59BD9B4E019)))


def tile_counts(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of ids, with how often each occurs."""
    if not len(left):
        return left, right, np.zeros(0, np.int64)
    across = int(max(left.max(), right.max())) // SIDE + 1
    # Numbers of 32 bits while they hold every tile, so that the work arrays stay small.
    kind = np.int32 if across <= 1 << 15 else np.int64
    left, right = left.astype(kind, copy=False), right.astype(kind, copy=False)
    tiles = left // SIDE * across
    tiles += right // SIDE
    if across * across <= TILES:
        filled = np.flatnonzero(np.bincount(tiles) >= DENSE).astype(kind)
    else:
        numbers, sizes = np.unique(tiles, return_counts=True)
        filled = numbers[sizes >= DENSE]
    cells, counts = [], []
    if len(filled):
        dense = np.searchsorted(filled, tiles).astype(np.uint16)
        hit = filled[np.minimum(dense, len(filled) - 1)] == tiles
        del tiles
        where = np.flatnonzero(hit).astype(np.uint32)
        dense = dense[where]
        turn = np.argsort(dense, kind="stable")
        where, bounds = where[turn], np.searchsorted(dense[turn], np.arange(len(filled) + 1))
        del dense, turn
        for number, tile in enumerate(filled.tolist()):
            mine = where[bounds[number] : bounds[number + 1]]
            found = np.bincount(left[mine] % SIDE * SIDE + right[mine] % SIDE, minlength=SIDE * SIDE)
            cell = np.flatnonzero(found)
            row, column = tile // across * SIDE + cell // SIDE, tile % across * SIDE + cell % SIDE
            cells.append(row << 32 | column)
            counts.append(found[cell])
        del where
        left, right = left[~hit], right[~hit]
    order = left.astype(np.int64)
    order <<= 32
    order |= right
    del left, right
    order.sort()
    if len(order):
        first = np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1])))
        cells.append(order[first])
        counts.append(np.diff(np.concatenate((first, [len(order)]))))
    del order
    cells = np.concatenate(cells)
    return cells >> 32, cells & 0xFFFFFFFF, np.concatenate(counts)


class Level(NamedTuple):
    """The most frequent items of a level by falling frequency.

    ``codes`` by rank; ``keys`` sorted, with the rank of each: codes of words, or for longer
    items the ranks of both parts in one number. ``complete`` if no frequent item is left out.
    """

    codes: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    complete: bool

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Ranks, -1 where unknown."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], -1)


def _neighbours(words: Words, levels: list[Level]) -> tuple[np.ndarray, ...]:
    """Overlapping neighbours among the items of the last level: ranks and codes of both."""
    at, codes = np.arange(len(words.codes)), words.codes
    ranks = levels[0].find(codes)
    for number, level in enumerate(levels):
        if level.complete:
            kept = np.flatnonzero(ranks >= 0)
            at, codes, ranks = at[kept], codes[kept], ranks[kept]
        next_to = np.flatnonzero((at[1:] == at[:-1] + 1) & words.joined[at[:-1]]) if len(at) else at
        left, right = (ranks[next_to], codes[next_to]), (ranks[next_to + 1], codes[next_to + 1])
        if number + 1 == len(levels):
            return *left, *right
        known = np.flatnonzero((left[0] >= 0) & (right[0] >= 0))
        at, codes = at[next_to], pair_code(left[1], right[1])
        ranks = np.full(len(at), -1)
        ranks[known] = levels[number + 1].find(left[0][known] << 32 | right[0][known])
    raise AssertionError


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, pa.Array]]:
    for batch in batches:
        begun = 0
        for texts in pieces(batch.column(0), SLICE):
            langs = batch.column(1).slice(begun, len(texts))
            begun += len(texts)
            yield cut_words(texts, langs), langs


def _slices_by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, Words]]:
    """Words of slices of one language's texts; a slice is copied when its turn comes."""
    names = batch.column(1).fill_null(UNKNOWN).dictionary_encode()
    sizes, owners = np.diff(bytes_of(batch.column(0))[1]), names.indices.to_numpy()
    for number, lang in enumerate(names.dictionary.to_pylist()):
        mine = np.flatnonzero(owners == number)
        before = np.cumsum(sizes[mine]) - sizes[mine]
        for rows in np.split(mine, np.flatnonzero(np.diff(before // SLICE)) + 1):
            taken = batch.take(pa.array(rows))
            yield lang, cut_words(taken.column(0), taken.column(1))


def word_counts(docs: DataFrame) -> DataFrame:
    """(code, lang, word, a) of all words of (text, lang), once per language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words in _slices_by_language(batch):
                codes, first, counts = np.unique(words.codes, return_index=True, return_counts=True)
                if not len(codes):
                    continue
                # Words and the gaps after them are the cells of one array of bytes.
                bounds = np.column_stack((words.begins, words.ends)).ravel()
                spelled = pa.LargeStringArray.from_buffers(
                    len(bounds) - 1, pa.py_buffer(np.append(bounds, bounds[-1])[: len(bounds)].tobytes()),
                    pa.py_buffer(words.data.tobytes()),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(codes.view(np.int64)),
                        pa.array([lang] * len(codes), pa.string()),
                        spelled.take(pa.array(2 * first)).cast(pa.string()),
                        pa.array(counts),
                    ],
                    names=["code", "lang", "word", "a"],
                )

    counted = docs.mapInArrow(run, "code long, lang string, word string, a long")
    return counted.groupBy("code", "lang", "word").agg(F.sum("a").alias("a"))


def neighbour_counts(docs: DataFrame, levels: list[Broadcast]) -> DataFrame:
    """(left, right, a): how often items of the last level follow each other, by codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [level.value for level in levels]
        codes = tables[-1].codes

        def given(left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            for begin in range(0, len(counts), ROWS):
                columns = [side[begin : begin + ROWS].view(np.int64) for side in (left, right)]
                columns.append(counts[begin : begin + ROWS])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["left", "right", "a"])

        def counted(ranks: list[list[np.ndarray]], rest: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            # The lists are emptied here: what has been joined is not held twice.
            sides = [np.concatenate(side) for side in ranks]
            ranks.clear()
            left, right, counts = tile_counts(*sides)
            del sides
            yield from given(codes[left], codes[right], counts)
            del left, right, counts
            others = np.concatenate(rest)
            rest.clear()
            if len(others):
                others, counts = np.unique(others, return_counts=True)
                yield from given(others["l"].copy(), others["r"].copy(), counts)

        ranks, rest, size = [[], []], [], 0
        for words, _ in _slices(batches):
            ranks1, codes1, ranks2, codes2 = _neighbours(words, tables)
            both = (ranks1 >= 0) & (ranks2 >= 0)
            ranks[0].append(ranks1[both].astype(np.int32))
            ranks[1].append(ranks2[both].astype(np.int32))
            rest.append(np.rec.fromarrays([codes1[~both], codes2[~both]], names="l,r"))
            size += len(ranks1)
            if size >= BUFFER:
                yield from counted(ranks, rest)
                ranks, rest, size = [[], []], [], 0
        if size:
            yield from counted(ranks, rest)

    # Most pairs are rare, so that adding up before the shuffle would fill memory for little.
    counted = docs.mapInArrow(run, "left long, right long, a long").repartition("left", "right")
    return counted.groupBy("left", "right").agg(F.sum("a").alias("a"))


def _ranked(items: DataFrame, rows: int, ranked: int, below: Level | None) -> Level:
    """The ``ranked`` most frequent items, as the tasks need them."""
    best = items if rows <= ranked else items.orderBy(F.desc("a"), "code").limit(ranked)
    columns = ["code", "a"] if below is None else ["code", "a", "left", "right"]
    table = best.select(*columns).toArrow()
    read = {name: table.column(name).to_numpy() for name in columns}
    order = np.lexsort((read["code"], -read["a"]))
    codes = read["code"][order].view(np.uint64)
    if below is None:
        keys = codes
    else:
        place = np.argsort(below.codes)
        sides = []
        for side in ("left", "right"):
            wanted = read[side][order].view(np.uint64)
            at = np.minimum(np.searchsorted(below.codes, wanted, sorter=place), len(place) - 1)
            sides.append(np.where(below.codes[place[at]] == wanted, place[at], -1) if len(place) else wanted * 0 - 1)
        left, right = (side.astype(np.int64) for side in sides)
        # An item with an unranked part is known by its code only.
        usable = (left >= 0) & (right >= 0)
        codes, keys = codes[usable], (left << 32 | right)[usable]
    ranks = np.argsort(keys)
    return Level(codes, keys[ranks], ranks, rows <= ranked and len(codes) == rows)


def _with_codes(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [batch.column(name).to_numpy().view(np.uint64) for name in ("left", "right")]
            yield batch.append_column("code", pa.array(pair_code(*sides).view(np.int64)))

    return pairs.mapInArrow(run, "left long, right long, a long, code long")


def _only_once(items: DataFrame) -> None:
    if items.groupBy("code").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count():
        raise ArithmeticError("two items have the same code; counts would not be exact")


def _wide(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 4, least: int = 30, ranked: int = RANKED
) -> tuple[DataFrame, DataFrame]:
    """Phrases of 2 to ``longest`` words that occur ``least`` times or more in a language.

    A text (null: none) is lower-cased in A-Z only, cut into pieces at sentence marks and
    line ends, and those into words at spaces and tabs. A null language is ``und``. Phrases
    lie within a piece; overlapping occurrences count. All texts are counted whole, repeated
    rows each; other columns are not read; an empty table gives empty results.

    Returns the phrases and the words per language (lang, n). Phrases have: lang, phrase
    (words joined by one space), a (occurrences), l and r (those of the parts at the cut with
    the lowest score), score (2000000 * a over l + r, floored; of equal cuts the one after
    the fewest words), and ``inside``: whether a longer phrase holds it with at least 80%
    of its occurrences. Arithmetic is on decimals.

    ``ranked`` bounds what a task is sent. Results do not depend on it: items beyond it are
    counted by codes of 64 bits, and two different items of one code raise an error.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    every = cut_lineage(word_counts(read))
    _only_once(every)
    totals = cut_lineage(every.groupBy("lang").agg(F.sum("a").alias("n")))
    none = F.array().cast("array<long>")
    items, state = cut_and_measure(
        every.filter(F.col("a") >= least).select(
            "code", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a",
            none.alias("firsts"), none.alias("lasts"), none.alias("holds"),
        )
    )
    levels, sent, found = [_ranked(items, state["rows"], ranked, None)], [], []
    for size in range(2, longest + 1):
        sent.append(spark.sparkContext.broadcast(levels[-1]))
        # Few pairs of a part are frequent: they go on in parts of useful size, not in as many small files.
        counted = neighbour_counts(read, sent).filter(F.col("a") >= least).hint("rebalance")
        pairs, state = cut_and_measure(_with_codes(counted))
        _only_once(pairs)
        levels.append(_ranked(pairs, state["rows"], ranked, levels[-1]))
        sides = [
            items.select(*(F.col(name).alias(f"{side}_{name}") for name in items.columns)) for side in ("left", "right")
        ]
        joined = pairs.join(sides[0], F.col("left") == F.col("left_code")).join(sides[1], F.col("right") == F.col("right_code"))
        held = none if size == 2 else F.array_distinct(
            F.concat("left_holds", "right_holds", F.array("left", "right"))
        )
        items = cut_lineage(
            joined.select(
                "code", F.col("left_lang").alias("lang"), F.concat_ws(" ", "left_phrase", "right_last").alias("phrase"),
                F.col("right_last").alias("last"), "a",
                F.concat("left_firsts", F.array("left_a")).alias("firsts"),
                F.concat("right_lasts", F.array("right_a")).alias("lasts"),
                held.alias("holds"),
            )
        )
        cuts = [
            F.struct(
                (_wide(F.col("a")) * 2_000_000).alias("top"),
                F.lit(k).alias("k"), F.get("firsts", F.lit(k - 1)).alias("l"), F.get("lasts", F.lit(size - k - 1)).alias("r"),
            )
            for k in range(1, size)
        ]
        scored = [
            F.struct(
                F.call_function("div", cut["top"], _wide(cut["l"]) + _wide(cut["r"])).alias("score"), cut["k"].alias("k"),
                cut["l"].alias("l"), cut["r"].alias("r"),
            )
            for cut in cuts
        ]
        lowest = F.array_min(F.array(*scored))
        found.append(items.withColumn("cut", lowest).select("code", "lang", "phrase", "a", "cut", "holds"))
    candidates = found[0]
    for more in found[1:]:
        candidates = candidates.unionByName(more)
    covering = candidates.select(F.explode("holds").alias("code"), F.col("a").alias("by")).groupBy("code").agg(F.max("by").alias("by"))
    judged = candidates.join(covering, "code", "left").select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score",
        F.coalesce(_wide(F.col("by")) * 100 >= _wide(F.col("a")) * 80, F.lit(False)).alias("inside"),
    )
    return judged, totals


def best_phrases(found: DataFrame, totals: DataFrame, most: int = 2000, task_rows: int = 20_000) -> DataFrame:
    """Each language's best phrases that no longer one covers, with ``rank`` from 1 and n.

    By score, then occurrences, both falling, then the phrase's bytes. A language's
    phrases are first dealt out by their hash, and each share keeps its best ``most``; the
    shares left become fewer round by round until one is left.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rest, state = cut_and_measure(found.filter(~F.col("inside")).drop("inside"))
    shares = -(-state["rows"] // task_rows)
    while shares > 1:
        share = F.pmod(F.xxhash64("phrase"), F.lit(shares)).alias("share")
        window = Window.partitionBy("lang", "share").orderBy(*order)
        rest = rest.select("*", share).withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= most)
        rest = rest.drop("share", "rank")
        shares = -(-shares * most // task_rows) if most < task_rows // 2 else 1
    numbered = rest.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return numbered.filter(F.col("rank") <= most).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
