"""Near-duplicates by Order MinHash and banded alignment.

Every occurrence of a five-word run is labelled with its number in the text, so that all
runs of a text are different. A sketch takes, for each of several random orders, the runs
with the smallest ranks, in the order in which they stand in the text: texts share it if
they share the runs and their order. Texts that share a sketch are candidates. They are
verified by aligning their labelled runs within a band around the diagonal.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.hashing import NOT_ALNUM, bytes_of, mixed, pieces, shingle_hashes, word_hashes
from tablewright.runtime import cut_and_measure, cut_lineage

WORDS = 5
SIMILARITY = 0.8
# Sketches and the runs in each. With eight runs, texts that only share a passage seldom
# share a sketch, and 48 of them miss a pair of similarity 0.8 once in 7000 times.
SKETCHES, MINIMA = 48, 8
# Texts with so few runs have further sketches, as eight of their runs leave out too few.
SHORT, SHORT_SKETCHES, SHORT_MINIMA = 32, 24, 4
PLACE_BITS = 24  # of a rank: the place in the text


def labelled_runs(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of words, each with its occurrence number, and where each text's
    begin, with the end. Case and punctuation don't count. A shorter text with words has
    one run; a text without words has none."""
    lowered = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    runs, offsets = shingle_hashes(*word_hashes(lowered, NOT_ALNUM), words)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((runs, owner))
    a, o = runs[order], owner[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (o[1:] != o[:-1])
    if new.all():
        return runs, offsets
    at = np.arange(len(a))
    number = np.empty(len(a), dtype=np.uint64)
    number[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return np.where(number > 0, mixed(runs + number * np.uint64(0x9E3779B97F4A7C15)), runs), offsets


def sketch(runs: np.ndarray, offsets: np.ndarray, sketches: int = SKETCHES, minima: int = MINIMA) -> np.ndarray:
    """One row per text that has runs, one ordered sketch per column.

    The rank of a run holds its place in the low bits, so a minimum brings its place along.
    A text with fewer runs than ``minima`` is sketched by those it has.
    """
    counts = np.diff(offsets)
    begins, counts = offsets[:-1][counts > 0], counts[counts > 0]
    result = np.zeros((len(begins), sketches), dtype=np.int64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    place = np.arange(len(runs)) - np.repeat(begins, counts)
    place = np.minimum(place, int(low)).astype(np.uint64)
    highest = np.uint64(2**64 - 1)
    for number in range(sketches if len(begins) else 0):
        salt = np.uint64((number + 1 + 1000 * minima) * 0xD1342543DE82EF95 & 2**64 - 1)
        ranks = (mixed(runs ^ salt) & ~low) | place
        places = np.empty((minima, len(begins)), dtype=np.int64)
        for step in range(minima):
            least = np.minimum.reduceat(ranks, begins)
            found = (least & low).astype(np.int64)
            places[step] = np.where(least == highest, -1, found)
            ranks[begins + found % np.maximum(counts, 1)] = highest
        places.sort(axis=0)
        key = np.full(len(begins), salt)
        for step in range(minima):
            chosen = runs[begins + np.maximum(places[step], 0)]
            key = np.where(places[step] < 0, key, mixed(key * np.uint64(31) + chosen))
        result[:, number] = key.view(np.int64)
    return result


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> float:
    """Similarity of two texts by their labelled runs: those that an alignment within the
    band pairs, over all different ones. Below ``similarity`` it may be wrong, but stays
    below; with 0 there is no band, and it is exact.

    Two texts as similar as that differ in a bounded number of runs, and so does the place
    of a run in them: that is the band. All runs of a text differ, so the best alignment
    is the longest increasing chain of places.
    """
    order = np.argsort(b, kind="stable")
    ranked = b[order]
    at = np.minimum(np.searchsorted(ranked, a), max(len(b) - 1, 0))
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    common = ranked[at] == a
    i, j = np.flatnonzero(common), order[at[common]]
    total = len(a) + len(b)
    band = total - 2 * similarity / (1 + similarity) * total
    near = np.abs(i - j) <= band
    j = j[near]
    pairs = len(j)
    if not pairs or pairs / (total - pairs) < similarity:
        return pairs / (total - pairs)
    if not (np.diff(j) > 0).all():
        ends: list[int] = []
        for place in j.tolist():
            slot = bisect_left(ends, place)
            if slot == len(ends):
                ends.append(place)
            else:
                ends[slot] = place
        pairs = len(ends)
    return pairs / (total - pairs)


def _node(text: str):
    """Identity of a text: equal texts have one; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _sketched(docs: DataFrame, text: str) -> DataFrame:
    """``node``, ``n`` (runs) and ``keys`` (sketches) of every different text with words.

    Copies are folded in the task that reads them, before anything is shuffled.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for piece in pieces(batch.column("text")):
                nodes = batch.column("node").slice(done, len(piece))
                done += len(piece)
                runs, offsets = labelled_runs(piece)
                counts = np.diff(offsets)
                keys = sketch(runs, offsets)
                short = counts[counts > 0] <= SHORT
                of_short = np.repeat(counts <= SHORT, counts)
                few = np.concatenate(([0], np.cumsum(np.where(counts <= SHORT, counts, 0))))
                more = iter(sketch(runs[of_short], few, SHORT_SKETCHES, SHORT_MINIMA))
                both = [np.concatenate((k, next(more))) if s else k for k, s in zip(keys, short)]
                flat = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(SKETCHES + SHORT_SKETCHES * short))), pa.int32()),
                    pa.array(np.concatenate(both) if both else keys.ravel()),
                )
                yield pa.RecordBatch.from_arrays(
                    [nodes.filter(pa.array(counts > 0)), pa.array(counts[counts > 0]), flat],
                    names=["node", "n", "keys"],
                )

    rows = docs.select(_node(text).alias("node"), F.col(text).alias("text"))
    return (
        rows.mapInArrow(work, "node binary, n long, keys array<long>")
        .groupBy("node").agg(F.max("n").alias("n"), F.max("keys").alias("keys"))
    )


def measured(pairs: DataFrame, texts: DataFrame, similarity: float = 0.0) -> DataFrame:
    """The pairs (a, b) whose texts align at least as well as ``similarity``, with how well."""
    named = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(named, "b")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, found = 0, []
            for piece in pieces(batch.column("text_a")):
                # A leader's pairs arrive together: its runs are made once.
                others = batch.column("text_b").slice(done, len(piece)).dictionary_encode()
                runs_a, at_a = labelled_runs(piece)
                runs_b, at_b = labelled_runs(others.dictionary)
                for row, other in enumerate(others.indices.to_pylist()):
                    a = runs_a[at_a[row] : at_a[row + 1]]
                    b = runs_b[at_b[other] : at_b[other + 1]]
                    found.append(aligned(a, b, similarity))
                done += len(piece)
            values = np.array(found, dtype=np.float64)
            keep = pa.array(values >= similarity)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep), pa.array(values).filter(keep)],
                names=["a", "b", "alike"],
            )

    return both.select("a", "b", "text_a", "text_b").mapInArrow(work, "a binary, b binary, alike double")


def verified(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose texts align at least as well as ``similarity``."""
    return measured(pairs, texts, similarity).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for all linked nodes.

    Rounds of two steps: every node's larger neighbours, then its smaller ones, are linked
    to the smallest. The links become stars; the rounds grow with the logarithm of the
    longest chain, and each is written down. One row of totals per round is looked at.
    """
    edges, total = cut_and_measure(_directed(links), sum=F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    while total["rows"]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _directed(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = _directed(moved.unionByName(small.select("u", F.col("m").alias("v"))))
        before = total
        edges, total = cut_and_measure(new, sum=F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
        if total == before:
            break
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return ends.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _directed(links: DataFrame) -> DataFrame:
    """Links from the larger to the smaller node, each once."""
    pair = links.toDF("u", "v").filter("u <> v")
    return pair.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def text_links(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Links that join all near-duplicate texts: ``node``, ``root``.

    Texts with one sketch in common form a bucket. Comparing all pairs of a large bucket
    is never done; most of its links follow from few comparisons. First every text meets
    leaders of its buckets: the most central member (the one whose buckets have the most
    members) and the one with the smallest hash. What is left is exact: those texts of
    the buckets with several components that can be similar share a rare run and are
    compared (``_rare_pairs``), whether they share a sketch or not.
    """
    nodes = cut_lineage(_sketched(docs, text))

    member = nodes.select("node", "n", F.posexplode("keys").alias("number", "key"))
    counted = member.groupBy("number", "key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = cut_lineage(member.join(counted, ["number", "key"]))
    degrees = shared.groupBy("node").agg(F.sum("members").alias("degree"))
    shared = cut_lineage(shared.drop("members").join(degrees, "node"))

    central = F.struct("degree", F.xxhash64("node").alias("rank"), "node", "n")
    chosen = F.struct(F.xxhash64("node").alias("rank"), "node", "n")
    fits = F.least("n", "other_n") >= similarity * F.greatest("n", "other_n")

    def candidates(rows: DataFrame) -> DataFrame:
        """Different pairs of node and other whose sizes fit."""
        fitting = rows.filter((F.col("node") != F.col("other")) & fits)
        return fitting.select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")).distinct()

    middle = F.max(central)
    led = shared.groupBy("number", "key").agg(F.array(_named(middle), _named(F.min(chosen))).alias("leaders"))
    with_leaders = (
        shared.select("number", "key", "node", "n").join(led, ["number", "key"])
        .select("node", "n", F.explode_outer("leaders").alias("leader"))
        .select("node", "n", F.col("leader.node").alias("other"), F.col("leader.n").alias("other_n"))
    )
    wanted = shared.select("node").distinct()
    texts = cut_lineage(
        docs.select(_node(text).alias("node"), F.col(text).alias("text"))
        .join(wanted, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    )
    links = cut_lineage(verified(candidates(with_leaders), texts, similarity))
    roots = components(links)

    placed = shared.select("number", "key", "node").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    split = placed.groupBy("number", "key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    open_ = placed.join(split, ["number", "key"], "left_semi").select("node", "root").distinct()
    rare = _rare_runs(cut_lineage(open_.join(texts, "node")), similarity)
    more = verified(candidates(_rare_pairs(cut_lineage(rare), similarity)), texts, similarity)
    return components(roots.unionByName(more.toDF("node", "root")))


def _rare_pairs(rare: DataFrame, similarity: float) -> DataFrame:
    """Pairs of texts of different components that may be similar, from their rare runs.

    Similar texts have the first run they share, in the order from rare to frequent, among
    the rare ones of both, and enough runs from there on in both. Runs within a single
    component are dropped first. Of the others, the texts outside the run's largest
    component are joined with all; the join key holds the size class too, so texts of very
    different lengths never meet.
    """
    largest = F.max(F.struct("members", "root"))["root"]
    several = rare.groupBy("run", "root").agg(F.count(F.lit(1)).alias("members")).groupBy("run").agg(
        F.count(F.lit(1)).alias("roots"), largest.alias("lead_root")
    ).filter("roots > 1").drop("roots")
    # Slightly wider classes than the largest ratio: sizes that fit are never two classes apart.
    size = F.floor(F.log("n") / (1.001 * math.log(max(1.01, 1 / similarity))))
    cells = cut_lineage(rare.join(several, "run").withColumn("size", size))
    outside = cells.filter("root <> lead_root").withColumn(
        "size", F.explode(F.array(*[F.col("size") + step for step in (-1, 0, 1)]))
    ).drop("lead_root")
    others = cells.select(
        "run", "size", F.col("node").alias("other"), F.col("n").alias("other_n"), F.col("root").alias("other_root"),
        F.col("left").alias("other_left"),
    )
    enough = F.least("left", "other_left") >= similarity / (1 + similarity) * (F.col("n") + F.col("other_n")) - 1e-6
    fits = F.least("n", "other_n") >= similarity * F.greatest("n", "other_n")
    pairs = outside.join(others, ["run", "size"]).filter(
        (F.col("root") != F.col("other_root")) & fits & enough
    )
    return pairs.select("node", "n", "other", "other_n")


def _rare_runs(texts: DataFrame, similarity: float, bits: int = 20) -> DataFrame:
    """``node``, ``root``, ``n``, ``run`` and ``left``: a row for each of a text's rarest
    runs, so many that a text as similar has one of its own rarest runs among them.
    ``left`` counts the text's runs from that one on, in the order from rare to frequent.

    Of n runs, similar texts share so many that n minus those, plus one, in any fixed order
    of all runs cannot all be missed (prefix filter). In the order from rare to frequent,
    texts that have only a widespread passage in common are told apart. Frequencies are
    counted in ``2**bits`` hash buckets, which bounds what reaches the driver; the order
    need not be exact for the filter to be.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            for piece in pieces(batch.column("text")):
                runs, _ = labelled_runs(piece)
                sums += np.bincount((runs >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums[used])], names=["bucket", "n"])

    counted = texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(1 << bits, dtype=np.int64)
    table[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    frequency = texts.sparkSession.sparkContext.broadcast(table)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for piece in pieces(batch.column("text")):
                runs, offsets = labelled_runs(piece)
                often = frequency.value[(runs >> np.uint64(64 - bits)).astype(np.int64)]
                rows, chosen, left = [], [], []
                for row, (begin, end) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
                    n = end - begin
                    most = n - int(np.ceil(similarity * n - 1e-9)) + 1
                    order = np.lexsort((runs[begin:end], often[begin:end]))[:most]
                    chosen.append(runs[begin:end][order].view(np.int64))
                    left.append(n - np.arange(len(order)))
                    rows.append(np.full(len(order), row))
                at = pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64))
                columns = [batch.column(name).slice(done, len(piece)).take(at) for name in ("node", "root")]
                columns += [pa.array(np.diff(offsets)[at]), *(
                    pa.array(np.concatenate(part) if part else np.empty(0, np.int64)) for part in (chosen, left)
                )]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "root", "n", "run", "left"])
                done += len(piece)

    return texts.select("node", "root", "text").mapInArrow(
        choose, "node binary, root binary, n long, run long, left long"
    )


def _named(leader):
    return F.struct(leader["node"].alias("node"), leader["n"].alias("n"))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: the key, ``node`` (its text's digest), ``class_id`` and
    ``representative`` (node of the class's first document).

    A class holds documents that a chain of near-duplicates connects; ``class_id`` is its
    smallest key. Equal texts are always in one class; null counts as empty. Texts without
    words are only equal to themselves. Texts shorter than five words are compared as one
    run. Null keys take part and never give a class its id unless it has no other.
    Repeated rows have a row each.
    """
    roots = text_links(docs, text, similarity)
    rows = docs.select(F.col(key).alias("__key"), _node(text).alias("node"))
    per_text = rows.groupBy("node").agg(F.min("__key").alias("least"))
    rooted = per_text.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = rooted.groupBy("root").agg(
        F.min(F.struct(F.col("least").isNull().alias("none"), "least", "node")).alias("first")
    )
    named = rooted.join(first, "root").select(
        "node", F.col("first.least").alias("class_id"), F.col("first.node").alias("representative")
    )
    return rows.join(named, "node").select(
        F.col("__key").alias(key), "node", "class_id", "representative"
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The first document of every class. Of rows with one key and text, the one whose
    other columns come first as JSON text, which leaves nulls out, stays."""
    found = classes(docs, key, text, similarity).filter(
        F.col(key).eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("representative"))
    )
    kept = found.select(F.col(key).alias("__key"), F.col("node").alias("__kept")).distinct()
    tagged = docs.withColumn("__node", _node(text))
    same = (tagged["__node"] == kept["__kept"]) & tagged[key].eqNullSafe(kept["__key"])
    others = F.struct(*[tagged[name] for name in docs.columns if name != text], tagged[text].isNull().alias("__null"))
    first = F.min_by(F.struct(*[tagged[name] for name in docs.columns]), F.to_json(others)).alias("__first")
    found = tagged.join(kept, same, "left_semi").groupBy(tagged[key], "__node").agg(first)
    return found.select("__first.*")
