"""Byte-level BPE by a walk over the trie of distinct words.

The encoding of a word's prefix is known from its last token: what stands before that
token is again an encoded prefix. So every node of a trie of words needs one number, the
last token of the bytes that lead to it. It is the one token that ends there and *fits*
the last token of the node where it begins, that is, no merge ever crosses the seam
between the two. Words that share a prefix share its nodes, and a word is read back from
its last node token by token.

Words are visited in sorted order, which is the depth-first order of their trie; only the
nodes on the path to the current word are held.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.token_files import BYTES, PIECE, PLAIN

NEVER = 1 << 60


class Vocabulary:
    """Tokens, merges and seams of a byte-level BPE file of the tokenizers library.

    Raises ValueError for a file of another kind, and for merges that no training gives
    (a part that is merged later than the whole, or one token made in two ways), since the
    walk relies on them.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cutter, model = spec.get("pre_tokenizer") or {}, spec["model"]
        known = (
            cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
            and not spec.get("normalizer") and model.get("type") == "BPE" and not model.get("ignore_merges")
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
            and (spec.get("decoder") or {}).get("type") == "ByteLevel"
        )
        if not known:
            raise ValueError(f"{path} is no plain byte-level BPE")
        spelled = {chr(number): bytes([number]) for number in range(256)}
        spelled |= {mark: bytes([byte]) for byte, mark in BYTES.items()}
        for byte in BYTES:
            del spelled[chr(byte)]
        vocab = model["vocab"]
        self.added = {token["content"]: token["id"] for token in spec.get("added_tokens") or []}
        for token in spec.get("added_tokens") or []:
            if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
                raise ValueError(f"{path} has added tokens with rules of their own")
        self.bytes = {number: b"".join(map(spelled.__getitem__, text)) for text, number in vocab.items()
                      if text not in self.added}
        self.split: dict[int, tuple[int, int, int]] = {}
        self.rank: dict[tuple[int, int], int] = {}
        merges = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        for place, (left, right) in enumerate(merges):
            pair, whole = (vocab[left], vocab[right]), vocab[left + right]
            if whole in self.split or any(self._born(part) > place for part in pair):
                raise ValueError(f"{path} has merges in no trained order")
            self.rank[pair], self.split[whole] = place, (*pair, place)
        self._seams: dict[tuple[int, int], bool] = {}
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._left: dict[int, list[tuple[int, int]]] = {}
        # A token counts only if its own bytes encode to it alone.
        self.sound = {number for number, text in self.bytes.items() if len(text) == 1}
        for whole, (left, right, place) in self.split.items():
            if left in self.sound and right in self.sound and not self._crossed(left, right, place):
                self.sound.add(whole)
        self._build_endings()
        self.bytes |= {number: text.encode() for text, number in self.added.items()}
        # For decoding: all tokens' bytes in one array, and where each token's are.
        size = max(self.bytes) + 1
        self.sizes = np.zeros(size, np.int64)
        for number, text in self.bytes.items():
            self.sizes[number] = len(text)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.spelling = np.frombuffer(b"".join(self.bytes.get(n, b"") for n in range(size)), np.uint8)

    def _build_endings(self) -> None:
        """An automaton over the tokens' prefixes; ``ends[state]`` has the tokens that end
        at a state as (length, token), longest first."""
        self.step: dict[int, int] = {}
        nodes, own = 1, {}
        for number in self.sound:
            at = 0
            for byte in self.bytes[number]:
                arc = at << 8 | byte
                if arc not in self.step:
                    self.step[arc], nodes = nodes, nodes + 1
                at = self.step[arc]
            own[at] = number
        below: list[list[tuple[int, int]]] = [[] for _ in range(nodes)]
        for arc, node in self.step.items():
            below[arc >> 8].append((arc & 255, node))
        self.back, self.ends = [0] * nodes, [()] * nodes
        level = [0]
        while level:
            after = []
            for at in level:
                for byte, node in below[at]:
                    back = self._step(self.back[at], byte) if at else 0
                    self.back[node] = back
                    mine = ((len(self.bytes[own[node]]), own[node]),) if node in own else ()
                    self.ends[node] = mine + self.ends[back]
                    after.append(node)
            level = after

    def _step(self, state: int, byte: int) -> int:
        """The state after one more byte, remembered once it is known."""
        arc = state << 8 | byte
        found = self.step.get(arc)
        if found is None:
            found = self._step(self.back[state], byte) if state else 0
            self.step[arc] = found
        return found

    def _born(self, token: int) -> int:
        return self.split[token][2] if token in self.split else -1

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts at one end of a token, whole first, each with the merge that ends it."""
        spine, until = [], NEVER
        while True:
            spine.append((token, until))
            if token not in self.split:
                return spine
            until, token = self.split[token][2], self.split[token][side]

    def _crossed(self, left: int, right: int, before: int = NEVER) -> bool:
        """Whether a merge across the seam of two tokens comes earlier than ``before``.

        A merge happens while both its parts exist. Of equal merges the leftmost comes
        first: one inside the left token goes before one across, one inside the right
        token after it.
        """
        if left not in self._right:
            self._right[left] = self._spine(left, 1)
        if right not in self._left:
            self._left[right] = self._spine(right, 0)
        for a, until_a in self._right[left]:
            for b, until_b in self._left[right]:
                place = self.rank.get((a, b))
                if place is not None and place < before and place < until_a and place <= until_b:
                    return True
        return False

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens may follow each other."""
        seam = (left, right)
        found = self._seams.get(seam)
        if found is None:
            if len(self._seams) > 4_000_000:
                self._seams.clear()
            found = self._seams[seam] = not self._crossed(left, right)
        return found

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Ids of every word, shared prefixes worked out once.

        ``last[d]`` is the last token of the first d bytes of the current word: the states
        on the path from the trie's root. Going to the next word in order keeps those of
        the prefix both share.
        """
        step, ends, seams, fits = self.step, self.ends, self._seams, self.fits
        sizes = self.sizes.tolist()
        before, last, states = b"", [-1], [0]
        for text, word in sorted((word.encode(), word) for word in words):
            shared, most = 0, min(len(before), len(text))
            while shared < most and before[shared] == text[shared]:
                shared += 1
            del last[shared + 1 :], states[shared + 1 :]
            state = states[shared]
            for depth in range(shared + 1, len(text) + 1):
                byte = text[depth - 1]
                found = step.get(state << 8 | byte)
                state = self._step(state, byte) if found is None else found
                states.append(state)
                for size, token in ends[state]:
                    if size == depth:
                        break
                    known = seams.get((last[depth - size], token))
                    if known or known is None and fits(last[depth - size], token):
                        break
                else:
                    raise ValueError(f"no encoding of {text[:depth]!r}")
                last.append(token)
            ids, at = [], len(text)
            while at:
                ids.append(last[at])
                at -= sizes[last[at]]
            ids.reverse()
            yield word, ids
            before = text

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, one after the other."""
        ids = ids.astype(np.int64)
        sizes = self.sizes[ids]
        shift = self.begins[ids] - (np.cumsum(sizes) - sizes)
        return self.spelling[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]


class TrieEncoder:
    """Encodes and decodes texts; remembers the ids of up to ``remembered`` words."""

    def __init__(self, path: str, remembered: int = 500_000):
        from tokenizers import Tokenizer

        self.vocabulary, self.remembered = Vocabulary(path), remembered
        self.cutter = Tokenizer.from_file(path).pre_tokenizer
        added = sorted(self.vocabulary.added, key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        self.added_ids = {text: np.array([n], "<u4").tobytes() for text, n in self.vocabulary.added.items()}
        self.plain, self.piece = re.compile(rf"[\s{PLAIN}]*", re.ASCII), re.compile(PIECE)
        self.known: dict[str, bytes] = dict(self.added_ids)

    def _words(self, text: str) -> list[str]:
        """A text without added tokens, cut into words: by pattern where all characters
        have the same class in every version of Unicode, else by the library's own cutter."""
        if self.plain.fullmatch(text):
            return self.piece.findall(text)
        return [text[begin:end] for _, (begin, end) in self.cutter.pre_tokenize_str(text)]

    def words(self, text: str) -> list[str]:
        """All words of a text; added tokens stand as words of their own."""
        if not self.added.search(text):
            return self._words(text)
        found, at = [], 0
        for match in self.added.finditer(text):
            found += [*self._words(text[at : match.start()]), match.group()]
            at = match.end()
        return found + self._words(text[at:])

    def _learn(self, words: set[str]) -> None:
        found = list(self.vocabulary.walk(words.difference(self.added_ids)))
        lengths = np.fromiter((len(ids) for _, ids in found), dtype=np.int64, count=len(found))
        packed = np.fromiter((n for _, ids in found for n in ids), dtype="<u4", count=int(lengths.sum())).tobytes()
        ends = (4 * np.cumsum(lengths)).tolist()
        for (word, _), begin, end in zip(found, [0, *ends], ends):
            self.known[word] = packed[begin:end]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        words: list[str] = []
        ends = []
        for text in texts:
            words += self.words(text)
            ends.append(len(words))
        if len(self.known) > self.remembered:
            self.known = dict(self.added_ids)
        found = list(map(self.known.get, words))
        if None in found:
            self._learn({word for word, ids in zip(words, found) if ids is None})
            found = list(map(self.known.__getitem__, words))
        return [b"".join(found[begin:end]) for begin, end in zip([0, *ends], ends)]

    def decode(self, encoded: list[bytes]) -> list[str]:
        """The texts of ids; bytes that are no UTF-8 become U+FFFD, as in the library."""
        ids = np.frombuffer(b"".join(encoded), "<u4")
        spelled = self.vocabulary.spell(ids).tobytes()
        sizes = np.concatenate(([0], np.cumsum(self.vocabulary.sizes[ids])))
        ends = sizes[np.cumsum([0] + [len(raw) // 4 for raw in encoded])].tolist()
        return [spelled[begin:end].decode("utf-8", "replace") for begin, end in zip(ends, ends[1:])]


_ENCODERS: dict[str, TrieEncoder] = {}


def encoder(path: str) -> TrieEncoder:
    """One per Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TrieEncoder(path)
    return _ENCODERS[path]


def _portions(values: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Slices of texts or bytes of about so many bytes each, and where they begin."""
    ends = np.cumsum(pc.binary_length(values).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < len(values):
        stop = int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + most, side="right"))
        stop = min(len(values), max(stop, begin + 1))
        yield begin, values.slice(begin, stop - begin)
        begin = stop


def _with_columns(
    df: DataFrame, source: str, columns: str, made_of: Callable[[pa.Array], list[pa.Array]], keep: list[str]
) -> DataFrame:
    """The columns ``keep`` and new ones, made from one text or id column in Arrow batches."""
    names = [column.split()[0] for column in columns.split(", ")]
    keep = [c for c in keep if c not in names]
    sent = df.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{source}`").alias("__source"))
    schema = sent.drop("__source").schema
    for column in columns.split(", "):
        schema = schema.add(*column.split())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.columns[: len(keep)]
            for begin, part in _portions(batch.column(len(keep))):
                arrays = [array.slice(begin, len(part)) for array in rest]
                yield pa.RecordBatch.from_arrays(arrays + made_of(part), names=[*keep, *names])

    return sent.mapInArrow(run, schema)


def encode(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``: every text's token ids, little-endian 32-bit, as binary.

    ``tokenizer`` is a byte-level BPE file of the tokenizers library, present on every
    executor; ids equal the library's without special tokens added (the text of a special
    token becomes that token, as there). A null or empty text has no ids. Texts are encoded
    whole, however long, and every row on its own, so ties and repeated rows need no
    rule; other columns stay, one named ``ids`` is replaced; an empty table gives none.
    The words of about 4 MB of text at a time form the trie of a task.
    """

    def made_of(part: pa.Array) -> list[pa.Array]:
        return [pa.array(encoder(tokenizer).encode([t or "" for t in part.to_pylist()]), pa.binary())]

    return _with_columns(docs, text, "ids binary", made_of, docs.columns)


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the text of every row's ids; null ids give an empty text."""

    def made_of(part: pa.Array) -> list[pa.Array]:
        return [pa.array(encoder(tokenizer).decode([raw or b"" for raw in part.to_pylist()]), pa.string())]

    return _with_columns(encoded, ids, "decoded string", made_of, encoded.columns)


def digests(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``n_tokens``, and checksums of its ids and of its decoded text.

    The same work as ``encode`` and ``decode``, done in one pass so that neither ids nor
    decoded texts leave the task.
    """

    def made_of(part: pa.Array) -> list[pa.Array]:
        tool = encoder(tokenizer)
        ids = tool.encode([t or "" for t in part.to_pylist()])
        return [
            pa.array([len(raw) // 4 for raw in ids], pa.int64()),
            pa.array([hashlib.sha256(raw).hexdigest() for raw in ids], pa.string()),
            pa.array([hashlib.sha256(text.encode()).hexdigest() for text in tool.decode(ids)], pa.string()),
        ]

    made = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _with_columns(docs, text, made, made_of, [key])
