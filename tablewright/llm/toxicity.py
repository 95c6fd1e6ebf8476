"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

A character trigram model is counted over the whole corpus. Spans that look disguised
(digits and signs for letters, letters set apart, letters drawn out) become lattices of
what they may stand for, and a Viterbi search takes the reading that channel and language
model together find likeliest. Restored texts are scored by the words in them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import training_rows
from tablewright.llm.hashing import (
    NOT_ALNUM, PLACES, _values, bytes_of, mixed, pieces, shingle_hashes, word_hashes,
)

# What signs and digits may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "(": "c", "*": "aeiou", "#": "h",
}
SIGNS = "".join(STANDS_FOR)
# Channel: log-probabilities of what a writer does.
SWAPPED, LITERAL, DRAWN_OUT, APART = np.log([0.8, 0.01, 0.6, 0.7])
DOUBLED, KEPT_RUN, TOGETHER = np.log([0.3, 0.1, 0.3])

_LETTER = r"[^\W\d_]"
_SIGN = "[" + re.escape(SIGNS) + "]"
_ONE = rf"(?:{_LETTER}|{_SIGN})"
# Letters set apart by the same sign, or a word with signs before or between letters, or
# one with a letter three times in a row.
_APART = rf"(?<![\w{re.escape(SIGNS)}]){_LETTER}(?P<gap>[ .\-_*~])(?:{_ONE}(?P=gap)){{1,}}{_LETTER}(?![\w])"
_MIXED = rf"(?<![\w{re.escape(SIGNS)}])(?:{_LETTER}|{_SIGN})*?(?:{_SIGN}{_LETTER})(?:{_LETTER}|{_SIGN})*"
_DRAWN = rf"(?<!\w){_LETTER}*?(?P<run>{_LETTER})(?P=run){{2}}{_LETTER}*"
NOISY = re.compile(f"{_APART}|{_MIXED}|{_DRAWN}")

SYMBOLS = 64  # of the language model: 0 is a gap, 1 to 26 are a to z, the rest is hashed
CONTEXT = SYMBOLS * SYMBOLS


@cache
def _symbols() -> np.ndarray:
    """The model's symbol for every code point."""
    table = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000).astype(np.int32)
    high = np.flatnonzero(table)
    table[high] = 27 + high * 31 % (SYMBOLS - 27)
    table[97:123] = np.arange(1, 27)
    table[65:91] = np.arange(1, 27)
    return table


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("\n".join(texts).lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


@dataclass
class CharModel:
    """Trigram counts over symbols, smoothed with shorter contexts: log-probabilities."""

    logs: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray, weight: float = 5.0) -> CharModel:
        three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + SYMBOLS)
        p2 = (two + weight * p1) / (two.sum(axis=1, keepdims=True) + weight)
        p3 = (three + weight * p2) / (three.sum(axis=2, keepdims=True) + weight)
        return cls(np.log(p3).astype(np.float32))


def count_characters(docs: DataFrame, text: str = "text") -> CharModel:
    """The model over all texts. Each task adds up its own trigrams; ``SYMBOLS**3`` sums
    at most reach the driver, whatever the corpus. Null texts count as empty."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            for piece in pieces(batch.column("text"), 1 << 20):
                ids = _symbols()[_codes(piece.fill_null("").to_pylist())]
                ids = np.concatenate(([0], ids, [0]))
                ids = ids[np.concatenate(([True], (ids[1:] > 0) | (ids[:-1] > 0)))]  # one gap between words
                sums += np.bincount(ids[:-2] * CONTEXT + ids[1:-1] * SYMBOLS + ids[2:], minlength=SYMBOLS**3)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(sums[used], pa.int64())], names=["trigram", "n"]
        )

    rows = (
        docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "trigram int, n long")
        .groupBy("trigram").agg(F.sum("n").alias("n")).toArrow()
    )
    counts = np.zeros(SYMBOLS**3, dtype=np.int64)
    counts[rows["trigram"].to_numpy()] = rows["n"].to_numpy()
    return CharModel.of(counts)


class Decoder:
    """Restores texts; remembers the spans it has seen."""

    def __init__(self, model: CharModel, remembered: int = 200_000):
        self.logs, self.remembered, self.known = model.logs, remembered, {}

    def lattice(self, span: str) -> list[list[tuple[str, float]]]:
        """What each place of a span may stand for, with the channel's log-probabilities."""
        places, at = [], 0
        apart = re.fullmatch(_APART, span) is not None
        while at < len(span):
            sign, end = span[at], at + 1
            while end < len(span) and span[end] == sign:
                end += 1
            run = end - at
            if apart and not sign.isalpha() and at % 2:
                places.append([("", APART), (" ", TOGETHER)])
                end = at + 1
            elif sign.isalpha() and run >= 3:
                places.append([(sign, DRAWN_OUT), (sign * 2, DOUBLED), (sign * run, KEPT_RUN)])
            elif sign in STANDS_FOR:
                options = STANDS_FOR[sign]
                places.append([(x, SWAPPED - np.log(len(options))) for x in options] + [(sign, LITERAL)])
                end = at + 1
            else:
                places.append([(sign, 0.0)])
                end = at + 1
            at = end
        return places

    def decode(self, span: str) -> str:
        """The likeliest reading of one span, between word gaps."""
        symbols = _symbols()
        best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for options in self.lattice(span):
            after: dict[tuple[int, int], tuple[float, tuple]] = {}
            for state, (score, path) in best.items():
                for reading, channel in options:
                    total, (a, b) = score + channel, state
                    for letter in reading:
                        c = int(symbols[ord(letter)])
                        if c or b:
                            total += float(self.logs[a, b, c])
                            a, b = b, c
                    if (a, b) not in after or total > after[a, b][0]:
                        after[a, b] = (total, (path, reading))
            best = after
        total, path = max(
            ((score + float(self.logs[a, b, 0]), path) for (a, b), (score, path) in best.items()), key=lambda x: x[0]
        )
        readings: list[str] = []
        while path:
            path, reading = path
            readings.append(reading)
        return "".join(reversed(readings))

    def _known(self, match: re.Match) -> str:
        span = match[0]
        found = self.known.get(span)
        if found is None:
            if len(self.known) > self.remembered:
                self.known.clear()
            found = self.known[span] = self.decode(span)
        return found

    def restore(self, text: str) -> str:
        """The text in lower case with every disguised span restored. Spans without a sign
        of disguise have one reading only, so they are passed over."""
        return NOISY.sub(self._known, text.lower())

    def restore_all(self, texts: pa.Array) -> pa.Array:
        lowered = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
        suspect = _suspect(lowered)
        if not suspect.any():
            return lowered
        rows = lowered.to_pylist()
        for row in np.flatnonzero(suspect):
            rows[row] = self.restore(rows[row])
        return pa.array(rows, pa.large_string())


def _suspect(texts: pa.Array) -> np.ndarray:
    """Texts that may have a span to restore: a sign before a letter after something that
    is no gap or at a word's start, one letter three times, or three letters set apart."""
    data, offsets = bytes_of(texts)
    letter = np.zeros(256, dtype=bool)
    letter[97:123] = letter[128:] = True
    sign = np.zeros(256, dtype=bool)
    sign[list(SIGNS.encode())] = True
    gap = np.zeros(256, dtype=bool)
    gap[list(b" .-_*~")] = True
    is_letter, is_sign, is_gap = letter[data], sign[data], gap[data]
    flags = np.zeros(len(data) + 1, dtype=np.int64)
    flags[1:-1] |= is_sign[:-1] & is_letter[1:]
    if len(data) > 4:
        flags[2:-1] |= is_letter[2:] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])
        middle = is_letter | is_sign | (data >= 128)
        flags[3:-1] |= is_gap[1:-2] & middle[2:-1] & is_gap[3:]
        wide = (data >= 128) & (data < 192)  # the last byte of a letter outside ASCII
        flags[4:-1] |= is_gap[1:-3] & wide[3:-1] & is_gap[4:]
    return np.diff(np.concatenate(([0], np.cumsum(flags[:-1])))[offsets]) > 0


PREFIXES = (4, 5, 6)
SKETCHES = 4


def _with(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.Array, pa.Array]]:
    """The batch's texts in pieces, each with the same rows of another column."""
    done = 0
    for piece in pieces(batch.column("text")):
        yield piece, batch.column(column).slice(done, len(piece))
        done += len(piece)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every word and of its first 4, 5 and 6 bytes: one row per kind, and where
    each text's words begin, with the end."""
    data, offsets = bytes_of(texts)
    table = _values(NOT_ALNUM)
    is_word = table[0].astype(bool)[data]
    starts = is_word.copy()
    if len(data):
        starts[1:] &= ~is_word[:-1]
        inner = offsets[:-1][offsets[:-1] < len(data)]
        starts[inner] |= is_word[inner]
    begins = np.flatnonzero(starts)
    if not len(begins):
        return np.zeros((len(PREFIXES) + 1, 0), np.uint64), np.zeros(len(offsets), np.int64)
    at = np.arange(len(data), dtype=np.int64)
    place = at - np.maximum.accumulate(np.where(starts, at, 0))
    values = table[place & (PLACES - 1), data]
    rows = [mixed(np.add.reduceat(values, begins))]
    for kind, length in enumerate(PREFIXES):
        short = np.add.reduceat(np.where(place < length, values, 0), begins)
        rows.append(mixed(short + np.uint64(kind + 1)))
    return np.stack(rows), np.searchsorted(begins, offsets)


@dataclass
class ToxicWords:
    """Sorted feature hashes with the probability that a text with the feature is toxic."""

    hashes: np.ndarray
    chance: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        """The highest probability of any feature of each text; 0 for none."""
        found, offsets = features(texts)
        scores = np.zeros(len(texts))
        filled = np.diff(offsets) > 0
        if len(self.hashes) and filled.any():
            best = np.zeros(found.shape[1])
            for row in found:
                at = np.minimum(np.searchsorted(self.hashes, row), len(self.hashes) - 1)
                best = np.maximum(best, np.where(self.hashes[at] == row, self.chance[at], 0.0))
            scores[filled] = np.maximum.reduceat(best, offsets[:-1][filled])
        return scores


def train(
    docs: DataFrame, labels: DataFrame, model: CharModel, text: str = "text", key: str = "doc_id",
    rows: int = 30_000, most: int = 50_000, prior: float = 1e-3, prefix_prior: float = 1e-6, always: float = 0.98,
    pure: float = 0.995,
) -> ToxicWords:
    """Learn which words, and beginnings of words, mark toxic texts.

    At most ``rows`` labelled documents that are not held out are used. Of documents that
    share one of four minima over hashed five-word runs, as near copies do, one counts, so
    that a copied text does not make its words marks. A feature seen in t toxic of n texts is either
    ordinary, as likely toxic as all incidences are, or (with probability ``prior``) a
    mark, of whose texts a share ``always`` is toxic; ``prefix_prior`` holds for beginnings
    of words, of which there are many more. The posterior of the second is its
    score. A beginning is a mark only if ``pure`` of its texts are toxic: where a longer one
    or the whole word tells more, that is used. The ``most`` best marks are kept. Without toxic labels every score is 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    known = training_rows(docs.select(key, text), labels, "toxic", key, rows)
    known = known.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col("__label").alias("label"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, keys in _with(batch, "key"):
                hashes, offsets = shingle_hashes(*word_hashes(piece), 5)
                minima = [np.zeros(len(piece), np.int64) for _ in range(SKETCHES)]
                filled = np.diff(offsets) > 0
                for number, column in enumerate(minima):
                    if filled.any():
                        salted = mixed(hashes ^ np.uint64(number * 0x9E3779B97F4A7C15 & 2**64 - 1))
                        column[filled] = np.minimum.reduceat(salted, offsets[:-1][filled]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [keys, *map(pa.array, minima)], names=["key", *(f"m{n}" for n in range(SKETCHES))]
                )

    kind = docs.schema[key].dataType.simpleString()
    minima = [f"m{number}" for number in range(SKETCHES)]
    first = known.mapInArrow(sketch, f"key {kind}, " + ", ".join(f"{m} long" for m in minima))
    for m in minima:
        first = first.withColumn(f"first_{m}", F.min("key").over(Window.partitionBy(m)))
    for m in minima:
        first = first.filter(F.col(f"first_{m}") == F.col("key"))
    known = known.join(first.select("key").distinct(), "key", "left_semi").select("text", "label")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
            done = 0
            for piece in pieces(batch.column("text")):
                found, offsets = features(decoder.restore_all(piece))
                owner = np.repeat(np.arange(len(piece)), np.diff(offsets))
                pairs = np.unique(
                    np.stack((np.tile(owner, len(found)).astype(np.uint64), found.ravel())), axis=1
                ) if found.size else np.zeros((2, 0), np.uint64)
                hashes, place, n = np.unique(pairs[1], return_inverse=True, return_counts=True)
                toxic = np.bincount(place, label[done + pairs[0].astype(np.int64)], len(hashes))
                whole = np.isin(hashes, found[0])
                done += len(piece)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes.view(np.int64)), pa.array(whole),
                        pa.array(toxic.astype(np.int64)), pa.array(n.astype(np.int64)),
                    ],
                    names=["hash", "whole", "t", "n"],
                )

    counts = known.mapInArrow(count, "hash long, whole boolean, t long, n long").groupBy("hash", "whole").agg(
        F.sum("t").alias("t"), F.sum("n").alias("n")
    )
    seen = known.agg(F.avg("label").alias("share")).first()["share"] or 0.0
    ordinary = min(max(seen, 0.02), 0.5)
    odds = (
        F.when(F.col("whole"), float(np.log(prior / (1 - prior))))
        .otherwise(float(np.log(prefix_prior / (1 - prefix_prior))))
        + F.col("t") * float(np.log(always / ordinary))
        + (F.col("n") - F.col("t")) * float(np.log((1 - always) / (1 - ordinary)))
    )
    marks = (
        counts.filter(F.col("whole") | (F.col("t") >= pure * F.col("n")))
        .withColumn("odds", odds).filter("odds > -4").orderBy(F.desc("odds"), "hash").limit(most).toArrow()
    )
    hashes = marks["hash"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return ToxicWords(hashes[order], 1 / (1 + np.exp(-np.minimum(marks["odds"].to_numpy()[order], 50))))


def score(docs: DataFrame, model: CharModel, words: ToxicWords, text: str = "text") -> Column:
    """Probability of toxicity of every whole text, restored; 0 for null and empty ones."""
    shared = docs.sparkSession.sparkContext.broadcast((model, words))
    decoders: list[Decoder] = []  # one per task, for all its batches

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        model, words = shared.value
        if not decoders:
            decoders.append(Decoder(model))
        decoder = decoders[0]
        parts = [words.score(decoder.restore_all(piece)) for piece in pieces(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return scored(F.col(text))
