"""Token ids of a corpus as one wavelet matrix per shard.

A wavelet matrix keeps a sequence of ids as bit-planes. The first plane has the highest
bit of every id; the ids are then parted stably by that bit, zeros first, and the next
plane has the next bit in the new order. With counts of ones per block the planes answer
which id stands at a place, how often an id occurs before a place, and where its k-th
occurrence is, without the ids being unpacked.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import utf8_crc32
from tablewright.runtime import scratch_path

BLOCK = 512  # bits per entry of the rank directory
SLICE = 1 << 23  # bytes of the texts that are encoded together

# Characters whose class is the same in every version of Unicode, white space left out.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
PLAIN = f"!-~¡-©«-±´¶-¸»¿×÷{LETTERS}"
# Fixed value: how the byte-level tokenizer cuts a text of such characters before its merges.
PIECE = rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+"
# How the tokenizer spells bytes: printable ones as themselves, the rest from U+0100 on.
BYTES = {
    byte: chr(0x100 + number)
    for number, byte in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))
}
# The same for the characters of ``PLAIN`` and white space; others keep their spelling.
SPELLED = {
    number: "".join(BYTES.get(byte, chr(byte)) for byte in chr(number).encode()) for number in range(0x250)
}


class WaveletMatrix:
    """Access, counting and occurrence lookup over one sequence of ids."""

    def __init__(self, n: int, zeros: list[int], planes: bytes, ranks: bytes):
        self.n, self.zeros, self.bits = n, zeros, len(zeros)
        self.planes = np.frombuffer(planes, dtype=np.uint8).reshape(self.bits, -1)
        self.ranks = np.frombuffer(ranks, dtype="<u4").reshape(self.bits, -1)

    @staticmethod
    def build(ids: np.ndarray, bits: int) -> tuple[list[int], bytes, bytes]:
        """Zeros per plane, the planes, and the ones before each block of each plane."""
        zeros, planes, ranks = [], [], []
        parted = pa.array(ids)

        def _mask(plane: np.ndarray) -> pa.Array:
            return pa.Array.from_buffers(pa.bool_(), len(ids), [None, pa.py_buffer(plane)])

        for shift in range(bits - 1, -1, -1):
            ones = (parted.to_numpy() >> shift & 1).astype(bool)
            padded = np.zeros(-(-max(1, len(ids)) // BLOCK) * BLOCK, dtype=bool)
            padded[: len(ids)] = ones
            plane = np.packbits(padded, bitorder="little")
            counts = np.bitwise_count(plane.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1)
            ranks.append((np.cumsum(counts) - counts).astype("<u4").tobytes())
            planes.append(plane.tobytes())
            low, high = (parted.filter(_mask(bits_)) for bits_ in (~plane, plane))
            zeros.append(len(low))
            parted = pa.concat_arrays([low, high])
        return zeros, b"".join(planes), b"".join(ranks)

    def _ones(self, plane: int, end: int) -> int:
        """Ones before a place of a plane."""
        block = end // BLOCK
        if block == self.ranks.shape[1]:
            return self.n - self.zeros[plane]
        piece = np.unpackbits(self.planes[plane, block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")
        return int(self.ranks[plane, block]) + int(piece[: end - block * BLOCK].sum())

    def _bit(self, plane: int, at: int) -> int:
        return int(self.planes[plane, at >> 3]) >> (at & 7) & 1

    def _find(self, plane: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) such bit of a plane."""
        before = self.ranks[plane].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        piece = np.unpackbits(self.planes[plane, block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(piece == bit)[k - before[block]])

    def access(self, at: int) -> int:
        """The id at a place."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        found = 0
        for plane in range(self.bits):
            bit = self._bit(plane, at)
            ones = self._ones(plane, at)
            at = self.zeros[plane] + ones if bit else at - ones
            found = found << 1 | bit
        return found

    def _range(self, token: int, end: int) -> tuple[int, int]:
        low, high = 0, end
        for plane in range(self.bits):
            a, b = self._ones(plane, low), self._ones(plane, high)
            one = token >> (self.bits - 1 - plane) & 1
            low, high = (self.zeros[plane] + a, self.zeros[plane] + b) if one else (low - a, high - b)
        return low, high

    def count(self, token: int, end: int | None = None) -> int:
        """Occurrences of an id before a place (by default in the whole sequence)."""
        if token >> self.bits:
            return 0
        low, high = self._range(token, self.n if end is None else end)
        return high - low

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of an id."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        at = self._range(token, self.n)[0] + k
        for plane in range(self.bits - 1, -1, -1):
            one = token >> (self.bits - 1 - plane) & 1
            at = self._find(plane, one, at - self.zeros[plane] if one else at)
        return at

    def ids(self) -> np.ndarray:
        """The whole sequence: the last order first, then back through the planes."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        ids = np.zeros(self.n, dtype=kind)
        for plane in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(self.planes[plane], count=self.n, bitorder="little").astype(bool)
            before = np.empty_like(ids)
            before[~ones] = ids[: self.zeros[plane]]
            before[ones] = ids[self.zeros[plane] :] | kind(1 << (self.bits - 1 - plane))
            ids = before
        return ids


class Encoder:
    """Ids of texts as little-endian bytes of one width.

    A plain byte-level tokenizer cuts a text into pieces, never inside a word, and merges
    within a piece only. So texts are cut at their single spaces and line ends, and the ids of
    a word after a space, or after a line end, are looked up; the tokenizer encodes each once,
    and those not met of late go first when too many are known. Many texts are encoded together:
    Arrow cuts them, and each different word is looked up once. Texts with other white space are
    cut by the tokenizer's own rule. Texts with characters outside ``PLAIN``, or with the text of a
    special token, go to the tokenizer whole, and so do all texts of a file that is cut
    or merged in another way.
    """

    def __init__(self, path: str, kind: str = "<u2", remembered: int = 2_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.code, self.remembered = {2: "H", 4: "I"}[np.dtype(kind).itemsize], remembered
        self.by_words = self._cuts_at_words(path)
        # Padding and truncation are no part of a text's ids.
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.merges = self.tokenizer.model
        special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)")
        self.special_letters = any(map(str.isalpha, special))
        self.pieces = re.compile(PIECE)
        self.letters = re.compile(f"([{LETTERS}]+)([.,;:!?]?)")
        self.plain_word, self.plain = re.compile(f"[{PLAIN}]+"), re.compile(rf"[\s{PLAIN}]*", re.ASCII)
        self.newline = self._bytes(self._ids("\n"))
        self.forget()

    @staticmethod
    def _cuts_at_words(path: str) -> bool:
        """Whether the file's tokenizer works as ``PIECE`` and ``BYTES`` say."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cutter, model = spec.get("pre_tokenizer") or {}, spec["model"]
        other = (
            spec.get("normalizer"), cutter.get("add_prefix_space"), model.get("dropout"), model.get("ignore_merges"),
            model.get("continuing_subword_prefix"), model.get("end_of_word_suffix"),
        )
        rules = (token["lstrip"] or token["rstrip"] or token["single_word"] for token in spec.get("added_tokens") or [])
        known = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and model.get("type") == "BPE"
        return bool(known) and not any(other) and not any(rules)

    def forget(self) -> None:
        """Known pieces, words after a space or line end, and words that were met first: those of an earlier time.

        A word that must not be encoded on its own has no ids.
        """
        self.known: dict[str, bytes] = {}
        self.inner: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _bytes(self, ids: list[int]) -> bytes:
        ids = array(self.code, ids)  # raises where an id does not fit
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _merged(self, spelled: str) -> bytes:
        return self._bytes([token.id for token in self.merges.tokenize(spelled)])

    def _piece(self, piece: str) -> bytes:
        found = self.known.get(piece)
        if found is None:
            found = self.known[piece] = self._merged(piece.translate(SPELLED))
        return found

    def _met(self, word: str) -> bytes:
        """Ids of a word that is perhaps not known."""
        ids = self.inner.get(word)
        if ids is None:
            ids = self.first.get(word)
            self.inner[word] = ids = self._word(word) if ids is None else ids
        return ids

    def _word(self, word: str) -> bytes:
        """Ids of a word after a space, or after the line end it begins with; none if they depend on more."""
        usual = self.letters.fullmatch(word)
        if usual and not self.special_letters:
            letters, tail = usual.groups()
            if not tail:  # one piece
                return self._merged(SPELLED[32] + (word if word.isascii() else word.translate(SPELLED)))
            if not self.special.search(word):
                return self._met(letters) + self._piece(tail)
        begins_line = word.startswith("\n")
        if not self.plain_word.fullmatch(word, int(begins_line)) or self.special.search(word):
            return b""
        if begins_line:
            return self.newline + b"".join(map(self._piece, self.pieces.findall(word, 1)))
        return b"".join(map(self._piece, self.pieces.findall(" " + word)))

    def whole(self, text: str) -> bytes:
        """By the tokenizer's own rule, piece by piece where that is safe."""
        if not self.by_words or not self.plain.fullmatch(text) or self.special.search(text):
            return self._bytes(self._ids(text))
        return b"".join([self._piece(piece) for piece in self.pieces.findall(text)])

    def encode(self, text: str) -> bytes:
        return next(self.encode_all(pa.array([text])))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text; a null text counts as empty."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = 0
        while begin < len(texts):
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + SLICE, side="right")))
            yield from self._encode_slice(pc.fill_null(texts.slice(begin, end - begin), ""))
            begin = end

    def _encode_slice(self, texts: pa.Array) -> Iterator[bytes]:
        if not self.by_words:
            yield from map(self.whole, texts.to_pylist())
            return
        if 2 * (len(self.known) + len(self.inner)) > self.remembered:
            late = self.inner
            self.forget()
            self.first = late
        lines = pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), "")
        cut = pc.split_pattern(lines, " ")
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.inner.get, words))
        for place in [place for place, ids in enumerate(found) if ids is None]:
            found[place] = self._met(words[place])
        known = pa.array(found, pa.large_binary())
        stops = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        alone = pc.equal(pc.binary_length(known), 0).take(coded.indices).to_numpy(zero_copy_only=False)
        mixed = set((np.searchsorted(stops, np.flatnonzero(alone), side="right") - 1).tolist())
        ids = known.take(coded.indices)
        stops = np.frombuffer(ids.buffers()[1], np.int64)[stops].tolist()
        raw = memoryview(ids.buffers()[2] or b"")
        for row, (start, stop) in enumerate(zip(stops, stops[1:])):
            # Some texts have words that must not be encoded on their own.
            yield self.whole(texts[row].as_py()) if row in mixed else bytes(raw[start + len(self.newline) : stop])


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, kind: str) -> Encoder:
    """One per Python worker: what it remembers serves all its tasks."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = Encoder(path, kind)
    return _ENCODERS[path, kind]


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end: int = 2,
    key: str = "doc_id",
    text: str = "text",
    bits: int = 16,
    shard_tokens: int = 1 << 21,
) -> DataFrame:
    """Write the ids of all texts in ascending order of the key; return the files' rows.

    The rows are range-partitioned and sorted by key, then by a checksum of the text, so
    many rows of one key still spread over tasks. Null keys come first, a null or empty
    text has only the end id, repeated rows are encoded each. Every text is encoded whole.
    A shard ends with the document that reaches ``shard_tokens``; it is one row of the
    Parquet files below ``path``: ``part`` and ``cut`` (its place among the shards),
    ``keys``, ``lengths`` (ids per document, end id included), ``n``, ``zeros``,
    ``planes`` and ``ranks``. An empty table gives no shard. ``tokenizer`` is a file of
    the tokenizers library, present on every executor; ids must fit into ``bits``.
    """
    kind = docs.schema[key].dataType.simpleString()
    ordered = (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"), utf8_crc32(F.col(text)).alias("crc"))
        .repartitionByRange("key", "crc")
        .sortWithinPartitions("key", "crc")
        .drop("crc")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, cut = TaskContext.get().partitionId(), 0
        kind = "<u2" if bits <= 16 else "<u4"
        width = np.dtype(kind).itemsize
        encoder, last = _encoder(tokenizer, kind), np.array([end], dtype=kind).tobytes()
        keys: list[pa.Array] = []
        pieces: list[bytes] = []
        lengths: list[int] = []
        held = 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(pieces), dtype=kind)
            if int(ids.max(initial=0)) >> bits:
                raise ValueError(f"an id needs more than {bits} bits")
            zeros, planes, ranks = WaveletMatrix.build(ids, bits)
            chunk = pa.concat_arrays(keys)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([cut], pa.int32()),
                    pa.ListArray.from_arrays(pa.array([0, len(chunk)], pa.int32()), chunk),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([zeros], pa.list_(pa.int64())),
                    pa.array([planes], pa.binary()),
                    pa.array([ranks], pa.binary()),
                ],
                names=["part", "cut", "keys", "lengths", "n", "zeros", "planes", "ranks"],
            )

        for batch in batches:
            begun = 0
            for row, ids in enumerate(encoder.encode_all(batch.column("text"))):
                pieces += ids, last
                lengths.append(len(ids) // width + 1)
                held += lengths[-1]
                if held >= shard_tokens:
                    keys.append(batch.column("key").slice(begun, row + 1 - begun))
                    yield flush()
                    keys, pieces, lengths, held, begun, cut = [], [], [], 0, row + 1, cut + 1
            keys.append(batch.column("key").slice(begun))
        if lengths:
            yield flush()

    schema = (
        f"part int, cut int, keys array<{kind}>, lengths array<long>, n long, zeros array<long>, "
        "planes binary, ranks binary"
    )
    files = ordered.mapInArrow(encode, schema)
    files.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(files.schema).parquet(path)


def read_tokens(files: DataFrame) -> DataFrame:
    """One row per document from the files: key, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it; one row per shard is added up
    for it, in one task. ``ids_crc32`` is the checksum of the document's ids.
    """
    kind = files.schema["keys"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, cut, n, zeros, planes, ranks = (
                    batch.column(name)[row].as_py() for name in ("part", "cut", "n", "zeros", "planes", "ranks")
                )
                raw = memoryview(WaveletMatrix(n, zeros, planes, ranks).ids().astype("<u4").tobytes())
                keys = batch.column("keys")[row].values
                lengths = np.asarray(batch.column("lengths")[row].values, dtype=np.int64)
                stops = np.cumsum(lengths)
                sums = [zlib.crc32(raw[4 * (b - a) : 4 * b]) for a, b in zip(lengths.tolist(), stops.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(keys), part, np.int32)),
                        pa.array(np.full(len(keys), cut, np.int32)),
                        keys,
                        pa.array(stops - lengths),
                        pa.array(lengths),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["part", "cut", "key", "at", "n_tokens", "ids_crc32"],
                )

    decoded = files.mapInArrow(
        decode, f"part int, cut int, key {kind}, at long, n_tokens long, ids_crc32 long"
    )
    order = Window.orderBy("part", "cut").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("part", "cut", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    return decoded.join(before, ["part", "cut"]).select(
        "key", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode_corpus(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the token files to a new folder below the shared one and return their rows."""
    return write_tokens(docs, scratch_path(docs.sparkSession, "tokens"), tokenizer, **options)
