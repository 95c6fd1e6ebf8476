"""Phrases, the word trie and the conversation trie against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tablewright.llm import bpe_trie, conversation_trie, phrases
from tests.conftest import plan_text

FOLDER = "/root/testdata/sf0.01"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
EMPTY_DIGEST = hashlib.sha256().hexdigest()


# Phrases


def plain_phrases(rows, least, most):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    kept = {key: a for key, a in counts.items() if a >= least and len(key[1]) > 1}
    covered = defaultdict(int)
    for (lang, gram), a in kept.items():
        for size in range(2, len(gram)):
            for i in range(len(gram) - size + 1):
                covered[lang, gram[i : i + size]] = max(covered[lang, gram[i : i + size]], a)
    best = defaultdict(list)
    for (lang, gram), a in kept.items():
        score, _, l, r = min(
            (2_000_000 * a // (counts[lang, gram[:k]] + counts[lang, gram[k:]]), k, counts[lang, gram[:k]], counts[lang, gram[k:]])
            for k in range(1, len(gram))
        )
        if 100 * covered[lang, gram] < 80 * a:
            best[lang].append((-score, -a, " ".join(gram).encode(), l, r))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, totals[lang], -score)
        for lang, found in best.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:most], 1)
    )


def mined(docs, least=30, most=2000, task_rows=20_000, **options):
    found, totals = phrases.phrases(docs, least=least, **options)
    return sorted(tuple(row) for row in phrases.best_phrases(found, totals, most, task_rows).collect())


@pytest.fixture(scope="module")
def sayings(spark):
    rng = random.Random(5)
    words = ["a", "B", "the", "The", "é", "日本", "w" * 70, "w" * 64 + "v" * 8, "\x00", "x\x0by", "a b"]
    rows = [
        ("".join(rng.choice(words) + rng.choice([" ", " ", "\t ", ". ", "\n", ","]) for _ in range(rng.randrange(60))),
         rng.choice(["en", "de", None, "und"]))
        for _ in range(150)
    ]
    rows += [(None, "en"), ("", None), (" \t.", "fr"), ("the a " * 3000, "en"), ("x y", "fr"), ("x y", "fr"), ("", "en")]
    docs = spark.createDataFrame([(*row, "x", 1) for row in rows], "text string, lang string, code string, a int")
    return rows, docs.repartition(5)


@pytest.mark.parametrize("ranked", [1 << 20, 6, 0])
def test_phrases_equal_plain_python_whatever_is_ranked(sayings, ranked):
    rows, docs = sayings
    assert mined(docs, least=5, ranked=ranked) == plain_phrases(rows, 5, 2000)


def test_best_phrases_by_rounds(sayings):
    rows, docs = sayings
    assert mined(docs, least=3, most=4, task_rows=10) == plain_phrases(rows, 3, 4)


def test_no_phrases_in_an_empty_table(spark):
    assert mined(spark.createDataFrame([], "text string, lang string")) == []
    assert mined(spark.createDataFrame([("one two", "en")], "text string, lang string")) == []


def test_tiles_count_every_pair():
    rng = np.random.default_rng(1)
    left, right = rng.zipf(1.3, 400_000) % 3000, rng.zipf(1.3, 400_000) % 3000
    counted = Counter(zip(left.tolist(), right.tolist()))
    a, b, n = phrases.tile_counts(left, right)
    assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == counted
    far = phrases.tile_counts(left + (1 << 22), right)
    assert Counter(far[2].tolist()) == Counter(counted.values())


def test_words_end_with_their_text():
    texts, langs = pa.array(["", "ab", "", "cd e", None, "f"]), pa.array(["x"] * 6)
    words = phrases.cut_words(texts, langs)
    assert [words.data[b:e].tobytes() for b, e in zip(words.begins, words.ends)] == [b"ab", b"cd", b"e", b"f"]
    assert words.joined.tolist() == [False, True, False, False]


def most_bytes(work, *values):
    tracemalloc.start()
    work(*values)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_work_arrays_stay_small():
    """A slice took 30 times its bytes and a pair 51 bytes; 100,000 pairs of far ids took 150 MB."""
    rng = np.random.default_rng(3)
    words = [f"w{n}" for n in range(5000)]
    texts = pa.array([" ".join(words[n] for n in row) for row in rng.integers(0, len(words), (1200, 300))])
    assert most_bytes(phrases.cut_words, texts, pa.array(["x"] * len(texts))) < 26 * texts.nbytes
    left, right = (rng.zipf(1.2, phrases.BUFFER) % 60_000 for _ in range(2))
    assert most_bytes(phrases.tile_counts, left, right) < 32 * phrases.BUFFER
    far = rng.integers(0, phrases.RANKED, (2, 100_000))
    assert most_bytes(phrases.tile_counts, *far) < 20e6


def test_words_longer_than_a_step_are_coded_alike():
    long = "v" * (2 * phrases.STEP + 5)
    texts = pa.array([f" {long} a", "a", "b " * phrases.STEP + "a " + long])
    words = phrases.cut_words(texts, pa.array(["x"] * 3))
    assert words.codes[0] == words.codes[-1]
    assert words.codes[1] == words.codes[2] == words.codes[-2]
    assert len(set(words.codes.tolist())) == 3


def test_pairs_are_not_added_up_before_their_shuffle(spark):
    """Map tasks held 250 MB each for sums of pairs that left nine tenths of the rows."""
    docs = spark.createDataFrame([("one two", "en")], "text string, lang string")
    lines = plan_text(phrases.neighbour_counts(docs, [])).splitlines()
    shuffle = next(n for n, line in enumerate(lines) if "Exchange" in line)
    assert not any("Aggregate" in line for line in lines[shuffle:])


def test_languages_are_cut_apart_in_slices(monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 8)
    texts, langs = pa.array(["a b", None, "c", "a" * 20, "", "b", "a c d"]), pa.array(["x", "y", None, "x", "und", "y", "x"])
    found = Counter()
    for lang, words in phrases._slices_by_language(pa.record_batch([texts, langs], names=["text", "lang"])):
        found.update((lang, words.data[b:e].tobytes().decode()) for b, e in zip(words.begins, words.ends))
    assert found == Counter(
        (lang or "und", word) for text, lang in zip(texts.to_pylist(), langs.to_pylist()) for word in (text or "").split()
    )


# Encoding and decoding


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def random_texts(count):
    rng = random.Random(2)
    letters = ["abcdefghij", "aab", " \n\t ab'stre", "éàßabc  ", "日本語ab🎉 \x85\x1c ", "0123 abAB.,!?'", "퟿​  x "]
    texts = ["".join(rng.choice(rng.choice(letters)) for _ in range(rng.randrange(30))) for _ in range(count)]
    return [text + "<|endoftext|>" + text if n % 50 == 0 else text for n, text in enumerate(texts)]


def test_random_texts_encode_and_decode_as_the_library_does(library):
    tool = bpe_trie.encoder(TOKENIZER)
    texts = random_texts(5000) + ["a" * 20_000, "ab" * 9_000, " " * 9_999, "", "<|endoftext|>", "é" * 5000]
    encoded = tool.encode(texts)
    wanted = [found.ids for found in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoded] == wanted
    assert tool.decode(encoded) == [library.decode(ids, skip_special_tokens=False) for ids in wanted]


def test_ids_that_are_no_text_decode_as_the_library_does(library):
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 50257, n).astype("<u4") for n in rng.integers(0, 12, 500)]
    wanted = [library.decode(row.tolist(), skip_special_tokens=False) for row in ids]
    assert bpe_trie.encoder(TOKENIZER).decode([row.tobytes() for row in ids]) == wanted


def test_forgetting_words_changes_nothing():
    texts = random_texts(300)
    small = bpe_trie.TrieEncoder(TOKENIZER, remembered=10)
    assert [small.encode([text])[0] for text in texts] == bpe_trie.encoder(TOKENIZER).encode(texts)


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        bpe_trie.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_documents_encode_and_decode_in_tables(spark, library):
    rows = [(None, None, 1, "x"), (1, "", None, None), (2, "two words", 3, "y"), (2, "two words", 3, "y"), (None, "é 日", 4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string").repartition(3)
    encoded = bpe_trie.encode(docs, TOKENIZER)
    back = bpe_trie.decode(encoded, TOKENIZER)
    assert back.columns == ["doc_id", "text", "ids", "decoded"]
    assert all(row["decoded"] == (row["text"] or "") for row in back.collect())
    found = Counter(map(tuple, bpe_trie.digests(docs, TOKENIZER).collect()))

    def digest(key, text):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4")
        return key, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    assert found == Counter(digest(row[0], row[1]) for row in rows)
    assert bpe_trie.digests(docs.limit(0), TOKENIZER).count() == 0


# Conversations


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {conv: [(role, text) for _, _, role, text in sorted(found)] for conv, found in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for conv in sorted(turns):
        h = zlib.crc32(str(conv).encode()) % 6
        whole = turns.get(conv - conv % 100, [])[:h] + turns[conv][h:]
        for depth in range(len(whole) + 1):
            members[tuple(whole[:depth])].append(conv)
        ends[tuple(whole)].append(conv)
    children, leaves, saved = Counter(node[:-1] for node in members if node), Counter(), Counter()
    for node, found in members.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not children[node]
            saved[node[:depth]] += (len(found) - 1) * len(node[-1][1]) if node else 0
    return Counter(
        (found[0], len(node), members[node[:-1]][0] if node else None, len(found), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
        for node, found in members.items()
    )


def trie_of(df, **options):
    trie = conversation_trie.prefix_trie(*conversation_trie.rebuilt(conversation_trie.numbered_turns(df)), **options)
    return Counter(map(tuple, trie.nodes.drop(*conversation_trie.KEY).collect()))


def talk():
    rng = random.Random(3)
    rows = []
    for conv in [*range(30), *range(100, 130), -5, -100, 205, None]:
        for turn in range(rng.choice([1, 2, 3, 9, 40])):
            rows.append((conv, rng.choice([None, turn, turn]), rng.choice(["u", "a", None]), rng.choice(["x", "yy", None, "zzé"])))
    rows += [(9, n, "u", "x") for n in range(50)]
    rows += [(conv, n, "u", f"same {n}") for conv in range(300, 390) for n in range(4)]
    return rows


@pytest.mark.parametrize("options", [{}, {"run": 5, "shard": 20}])
def test_trie_equals_plain_python_however_it_is_cut(spark, options):
    rows = talk()
    df = spark.createDataFrame([(*row, 1, 2) for row in rows], "conv_id long, turn int, role string, text string, conv int, place int")
    assert trie_of(df.repartition(4), **options) == plain_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    schema = "conv_id long, turn int, role string, text string"
    assert not trie_of(spark.createDataFrame([], schema))
    turnless = next(c for c in range(401, 499) if zlib.crc32(str(c).encode()) % 6 >= 2)
    found = trie_of(spark.createDataFrame([(turnless, 0, "u", "x")], schema))
    digest = hashlib.sha256(str(turnless).encode()).hexdigest()
    assert found == Counter([(turnless, 0, None, 1, 0, 1, 0, digest)])


def test_trie_of_the_table(spark):
    df = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    rows = [tuple(row) for row in df.select("conv_id", "turn", "role", "text").collect()]
    assert trie_of(df) == plain_trie(rows)
