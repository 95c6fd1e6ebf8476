"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import held_out
from tablewright.llm.hashing import pieces

BITS = 14
ORDERS = (1, 2, 3)
UNKNOWN = "und"
SPACE = ord(" ")


@cache
def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the n-grams of all texts, and where each text's begin, with the end.

    Case is ignored, what is no letter separates, and an n-gram may begin with one
    separator. A text without letters has none; null counts as empty.
    """
    lowered = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    lengths = pc.utf8_length(lowered).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = np.frombuffer("".join(lowered.to_pylist()).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    owner = np.repeat(np.arange(len(lengths)), lengths)
    letter = _letters()[codes]
    follows = np.zeros(len(codes), dtype=bool)
    follows[1:] = letter[:-1] & (owner[1:] == owner[:-1])
    keep = letter | follows  # letters, and the first separator after them
    codes, owner = np.where(letter, codes, SPACE)[keep].astype(np.uint64), owner[keep]
    found, whose = [], []
    hashes = np.zeros(len(codes), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for order in range(1, max(ORDERS) + 1):
            valid = np.zeros(len(codes), dtype=bool)
            valid[order - 1 :] = owner[order - 1 :] == owner[: len(owner) - order + 1] if len(owner) >= order else False
            moved = np.zeros_like(codes)
            moved[order - 1 :] = codes[: len(codes) - order + 1]
            hashes = (hashes + (moved + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
            hashes ^= hashes >> np.uint64(32)
            if order in ORDERS:
                found.append((hashes[valid] >> np.uint64(8)) & np.uint64((1 << BITS) - 1))
                whose.append(owner[valid])
    buckets = np.concatenate(found).astype(np.int64)
    counts = sum(np.bincount(w, minlength=len(lengths)) for w in whose)
    # Texts may interleave over the orders: bring each text's grams together.
    order = np.argsort(np.concatenate(whose), kind="stable")
    return buckets[order], np.concatenate(([0], np.cumsum(counts)))


@dataclass
class Languages:
    """Names, log-priors, and log-probabilities by bucket and language."""

    names: list[str]
    prior: np.ndarray
    logs: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        names, scores = [], []
        for piece in pieces(texts, 1 << 20):
            buckets, offsets = grams(piece)
            known = np.diff(offsets) > 0
            answer, score = np.full(len(piece), UNKNOWN, dtype=object), np.zeros(len(piece))
            if self.names and known.any():
                total = np.add.reduceat(self.logs[buckets], offsets[:-1][known], axis=0) + self.prior
                share = np.exp(total - total.max(axis=1, keepdims=True))
                share /= share.sum(axis=1, keepdims=True)
                best = share.argmax(axis=1)
                answer[known] = np.array(self.names, dtype=object)[best]
                score[known] = share[np.arange(len(best)), best]
            names.extend(answer.tolist())
            scores.append(score)
        return names, np.concatenate(scores) if scores else np.zeros(0)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", smoothing: float = 0.5) -> Languages:
    """Count the n-grams of all documents with a language that are not held out.

    Each task adds up its own counts; per language, one row of ``2**BITS`` counts reaches
    the driver, whatever the corpus. Null languages, null texts and texts without letters
    teach nothing. Without any training text every prediction is ``und``.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            names = batch.column("lang").to_pylist()
            for name in sorted(set(names)):
                chosen = batch.column("text").filter(pa.array([n == name for n in names]))
                for piece in pieces(chosen, 1 << 20):
                    buckets, offsets = grams(piece)
                    if len(buckets):
                        sums = np.bincount(buckets, minlength=1 << BITS)
                        counts[name] = counts[name] + sums if name in counts else sums
                        texts[name] = texts.get(name, 0) + int((np.diff(offsets) > 0).sum())
        for name, sums in counts.items():
            used = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * (len(used) + 1), pa.string()),
                    pa.array(np.append(used, -1), pa.int32()),
                    pa.array(np.append(sums[used], texts[name]), pa.int64()),
                ],
                names=["lang", "bucket", "n"],
            )

    learned = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(key)))
    rows = (
        learned.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
        .mapInArrow(count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells"))
        .orderBy("lang")
        .toArrow()
    )
    names = rows["lang"].to_pylist()
    table = np.zeros((len(names), (1 << BITS) + 1))
    for row, cells in enumerate(rows["cells"].combine_chunks() if names else []):
        values = cells.values
        table[row, values.field("bucket").to_numpy()] = values.field("n").to_numpy()
    counts, texts = table[:, :-1] + smoothing, table[:, -1]  # bucket -1 holds the texts
    logs = np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))
    prior = np.log(texts) - np.log(max(texts.sum(), 1)) if names else np.zeros(0)
    return Languages(names, prior, np.ascontiguousarray(logs.T))


def identify(docs: DataFrame, model: Languages, text: str = "text") -> Column:
    """Struct of ``lang_pred`` and ``score`` for a text; the model goes out as a broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def predicted(texts: pa.Array) -> pa.Array:
        names, scores = shared.value.predict(texts)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "score"])

    return predicted(F.col(text))
