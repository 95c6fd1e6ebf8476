"""Vectorised word and shingle hashes of Arrow text arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

PLACES = 64


@cache
def _values(separators: bytes) -> np.ndarray:
    """A random number for every byte at every place in a word; 0 for separators."""
    values = np.random.default_rng(20_240_601).integers(0, 2**64, (PLACES, 256), dtype=np.uint64)
    values[:, list(separators)] = 0
    return values


# Whitespace as in the word pattern; or everything in ASCII that is no letter or digit.
WHITESPACE = b"\t\n\v\f\r "
NOT_ALNUM = bytes(i for i in range(128) if not chr(i).isalnum())


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of the texts, and where each begins, with the end; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(texts: pa.Array, most: int = 4 << 20) -> Iterator[pa.Array]:
    """Slices of the texts of about so many bytes each, so that work arrays stay small."""
    _, offsets = bytes_of(texts)
    begin = 0
    while begin < len(texts):
        stop = int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1
        stop = min(len(texts), max(stop, begin + 1))
        yield texts.slice(begin, stop - begin)
        begin = stop


def word_hashes(texts: pa.Array, separators: bytes = WHITESPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin, with the end."""
    data, offsets = bytes_of(texts)
    table = _values(separators)
    is_word = table[0].astype(bool)[data]
    starts = is_word.copy()
    if len(data):
        starts[1:] &= ~is_word[:-1]
        inner = offsets[:-1][offsets[:-1] < len(data)]
        starts[inner] |= is_word[inner]
    begins = np.flatnonzero(starts)
    if not len(begins):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    at = np.arange(len(data), dtype=np.int64)
    place = at - np.maximum.accumulate(np.where(starts, at, 0))
    values = table[place & (PLACES - 1), data]
    hashes = np.add.reduceat(values, begins)
    return mixed(hashes), np.searchsorted(begins, offsets)


def shingle_hashes(hashes: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of k words per text; a shorter text with words has one, of them all."""
    counts = np.diff(offsets)
    n = len(hashes)
    if not n:
        return hashes, np.zeros(len(offsets), np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    end = offsets[1:][owner]
    at = np.arange(n)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for step in range(k):
            inside = at + step < end
            moved = np.where(inside, hashes[np.minimum(at + step, n - 1)], np.uint64(0))
            total = total * np.uint64(0x9E3779B97F4A7C15) + moved
    first = at == offsets[:-1][owner]
    keep = (at + k <= end) | first
    kept = np.concatenate(([0], np.cumsum(keep)))
    return mixed(total[keep]), kept[offsets]
