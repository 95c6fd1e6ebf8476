"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are complete binary trees of one depth, kept as flat arrays, so that numpy
walks all trees for a batch of documents level by level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import training_rows
from tablewright.llm.hashing import WHITESPACE, bytes_of, pieces, word_hashes

SYMBOL_BYTES = b"#*$%&|<>"
STATISTICS = (
    "words", "mean_word_bytes", "distinct_words", "most_frequent_word", "repeated_next_words",
    "upper", "digits", "symbols", "marks", "commas_and_stops", "non_ascii", "spaces", "lines",
    "distinct_lines", "longest_word_bytes",
)


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Flags set per text."""
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])


def _class(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


UPPER = _class(bytes(range(65, 91)))
DIGIT = _class(b"0123456789")
SYMBOL = _class(SYMBOL_BYTES)
MARK = _class(b"!?")
STOP = _class(b".,;:")
SPACE = _class(WHITESPACE)
HIGH = _class(bytes(range(192, 256)))  # first bytes of characters outside ASCII
LATE = _class(bytes(range(128, 192)))  # their further bytes


def _distinct(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes per text, and occurrences of the most frequent one."""
    counts = np.diff(offsets)
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(hashes)))
    most = np.zeros(len(counts), dtype=np.int64)
    np.maximum.at(most, owner[at], runs)
    return np.bincount(owner[at], minlength=len(counts)), most


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text, from the whole text; null counts as empty."""
    parts = [_statistics(piece) for piece in pieces(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))


def _statistics(texts: pa.Array) -> np.ndarray:
    data, offsets = bytes_of(texts)
    chars = np.maximum(_sums(~LATE[data], offsets), 1)
    hashes, at = word_hashes(texts)
    words = np.diff(at)
    per_word = np.maximum(words, 1)
    distinct, most = _distinct(hashes, at)
    lines, line_at = word_hashes(texts, b"\n")
    n_lines = np.diff(line_at)
    distinct_lines, _ = _distinct(lines, line_at)
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[at[:-1][words > 0]] = False
    space = SPACE[data]
    length = np.diff(np.concatenate(([-1], np.flatnonzero(space), [len(data)]))) - 1
    longest = np.zeros(len(texts), dtype=np.int64)
    ends = np.concatenate((np.flatnonzero(space), [len(data)]))
    owner = np.clip(np.searchsorted(offsets, ends - 1, side="right") - 1, 0, max(len(texts) - 1, 0))
    np.maximum.at(longest, owner, np.minimum(length, ends - offsets[owner]))
    return np.column_stack(
        [
            words, (np.diff(offsets) - _sums(space, offsets)) / per_word, distinct / per_word, most / per_word,
            _sums(same, at) / per_word, *(_sums(kind[data], offsets) / chars for kind in (UPPER, DIGIT, SYMBOL, MARK, STOP, HIGH, SPACE)),
            n_lines, distinct_lines / np.maximum(n_lines, 1), longest,
        ]
    ).astype(np.float64)


@dataclass
class Trees:
    """Boosted trees of one depth; row t of each array is tree t in level order."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row."""
        tree = np.arange(len(self.feature))
        at = np.zeros((len(rows), len(tree)), dtype=np.int64)
        inner = self.feature.shape[1]
        while inner and at.size and at[0, 0] < inner:
            value = np.take_along_axis(rows, self.feature[tree, at], axis=1)
            at = 2 * at + 1 + (value > self.threshold[tree, at])
        total = self.leaf[tree, at - inner].sum(axis=1) if len(tree) else 0.0
        return 1 / (1 + np.exp(-(self.base + total * np.ones(len(rows)))))


def fit(
    rows: np.ndarray, labels: np.ndarray, trees: int = 40, depth: int = 4, bins: int = 64,
    rate: float = 0.3, smoothing: float = 1.0, least: float = 5.0,
) -> Trees:
    """Boosting on the logistic loss. Splits come from histograms over quantile bins.

    ``least`` is the smallest weight (sum of second derivatives, scaled by 4 to count
    rows) of a child. Without rows, or with one label only, the score is a constant.
    """
    rows = np.asarray(rows, dtype=np.float64).reshape(-1, len(STATISTICS) if not len(rows) else np.shape(rows)[1])
    labels = np.asarray(labels, dtype=np.float64)
    share = (labels.sum() + 1) / (len(labels) + 2)
    inner = 2**depth - 1
    model = Trees(
        np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)),
        float(np.log(share / (1 - share))),
    )
    if len(set(labels.tolist())) < 2:
        return model
    width = rows.shape[1]
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins)[1:-1])) for column in rows.T]
    binned = np.column_stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, rows.T)])
    margin = np.full(len(rows), model.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = labels - p, p * (1 - p)
        node = np.zeros(len(rows), dtype=np.int64)
        for level in range(depth):
            nodes, first = 2**level, 2**level - 1
            best = np.full(nodes, 1e-9)
            for f in range(width):
                if not len(edges[f]):
                    continue
                cell = (node - first) * bins + binned[:, f]
                g = np.bincount(cell, gradient, nodes * bins).reshape(nodes, bins)
                h = np.bincount(cell, weight, nodes * bins).reshape(nodes, bins)
                gl, hl = g.cumsum(axis=1), h.cumsum(axis=1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + smoothing) + (gt - gl) ** 2 / (ht - hl + smoothing) - gt**2 / (ht + smoothing)
                gain[(4 * hl < least) | (4 * (ht - hl) < least)] = 0
                gain = gain[:, : len(edges[f])]
                cut = gain.argmax(axis=1)
                top = gain[np.arange(nodes), cut]
                better = np.flatnonzero(top > best)
                best[better] = top[better]
                model.feature[t, first + better] = f
                model.threshold[t, first + better] = edges[f][cut[better]]
            value = rows[np.arange(len(rows)), model.feature[t, node]]
            node = 2 * node + 1 + (value > model.threshold[t, node])
        end = node - inner
        g, h = np.bincount(end, gradient, inner + 1), np.bincount(end, weight, inner + 1)
        model.leaf[t] = rate * g / (h + smoothing)
        margin += model.leaf[t][end]
    return model


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", rows: int = 20_000, **options) -> Trees:
    """Fit on the statistics of at most ``rows`` labelled documents that are not held out.

    The statistics are made by the tasks that read the texts; one row of numbers per
    training document reaches the driver. Of several texts under one id, one is used.
    """
    known = training_rows(docs.select(key, text), labels, "quality", key, rows)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = statistics(batch.column("text"))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(numbers.ravel()), len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), lists.cast(pa.list_(pa.float64()))],
                names=["key", "label", "numbers"],
            )

    kind = docs.schema[key].dataType.simpleString()
    measured = (
        known.select(F.col(key).alias("key"), F.col("__label").alias("label"), F.col(text).alias("text"))
        .mapInArrow(measure, f"key {kind}, label int, numbers array<double>")
        .groupBy("key")
        .agg(F.min(F.struct("numbers", "label")).alias("row"))
        .orderBy("key")
        .select("row.*")
        .toArrow()
    )
    numbers = np.array(measured["numbers"].to_pylist(), dtype=np.float64).reshape(-1, len(STATISTICS))
    return fit(numbers, np.array(measured["label"].to_pylist(), dtype=np.float64), **options)


def score(model: Trees, text: Column) -> Column:
    """Probability of good quality of every text, also of null and empty ones."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        parts = [model.score(_statistics(piece)) for piece in pieces(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return scored(text)
