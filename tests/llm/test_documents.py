"""Operators on documents against plain Python, and their defined edge cases."""

from __future__ import annotations

import math
import re
import json
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tablewright.llm import (
    decontamination, language, mixing, near_dups, quality_model, quality_rules, sharding, token_files, toxicity,
)
from tablewright.llm.common import training_rows

FOLDER = "/root/testdata/sf0.01"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"word{n % 997} of, a;{n} thing." for n in range(6000))
SCHEMA = "doc_id long, text string, lang string, source string, shard string, slot string, size string, ratio string"
# Nulls in any column, empty and wordless and very long texts, repeated rows, one id twice.
EDGES = [
    (None, None, None, None, "x", None, None, None),
    (None, "some text here", "en", None, None, "s", "1", "r"),
    (1, "", "en", "a", None, None, None, None),
    (2, " \t\n", "en", "a", None, None, None, None),
    (3, LONG, "en", "a", None, None, None, None),
    (4, "same row", "de", "b", None, None, None, None),
    (4, "same row", "de", "b", None, None, None, None),
    (4, "other text, same id", None, "b", None, None, None, None),
    (5, "!!! ... ???", "fr", "b", None, None, None, None),
    (6, "naïve café   日本語 <|endoftext|> x", "fr", "é", None, None, None, None),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


def bag(rows):
    return Counter(tuple(row) for row in rows)


# Sharding


def test_shards_hold_every_row_once_in_gapless_slots(edges):
    kept = [c for c in edges.columns if c not in ("shard", "slot")]
    written = sharding.shard(edges, 4, bucket_rows=1).cache()
    assert bag(written.select(kept).collect()) == bag(edges.select(kept).collect())
    slots = defaultdict(list)
    for row in written.collect():
        slots[row["shard"]].append(row["slot"])
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    again = sharding.shard(edges.repartition(5), 4, bucket_rows=1)
    columns = ["doc_id", "text", "shard", "slot"]
    assert bag(written.select(columns).collect()) == bag(again.select(columns).collect())


def test_one_more_shard_takes_rows_into_itself_only(spark):
    moved = spark.range(5000).select(
        sharding.shard_of("id", 16).alias("a"), sharding.shard_of("id", 17).alias("b")
    ).collect()
    changed = [row for row in moved if row["a"] != row["b"]]
    assert all(row["b"] == 16 for row in changed) and 150 < len(changed) < 450


def test_shards_of_an_empty_table(empty):
    assert sharding.shard(empty, 4).count() == 0


# Token files


def test_wavelet_matrix_against_the_plain_sequence():
    ids = np.random.default_rng(1).integers(0, 50_000, 3000).astype(np.uint16)
    ids[::7] = 262
    matrix = token_files.WaveletMatrix(len(ids), *token_files.WaveletMatrix.build(ids, 16))
    assert (matrix.ids() == ids).all()
    assert [matrix.access(i) for i in range(0, 3000, 37)] == ids[::37].tolist()
    places = np.flatnonzero(ids == 262)
    assert matrix.count(262) == len(places) and matrix.count(1 << 20) == 0
    assert matrix.count(262, 1000) == (places < 1000).sum()
    assert [matrix.select(262, k) for k in range(len(places))] == places.tolist()
    for wrong in (lambda: matrix.access(3000), lambda: matrix.select(262, len(places))):
        with pytest.raises(IndexError):
            wrong()


ODD = [
    "", "a", " a", "a ", "a  b", "a\n\nb", "it's 'll we'd", "x y", "<|endoftext|> b", "tab\tq", "a\r\nb", "日本 語",
    "²³ ab", "é a", "!!!  ?", "\x1c a\x1cb", "a.\nB 'tis", "12 3a4 ² b", "\n", "a\n", "ﬁ ½ x", "é e", "a  \n b",
]


def test_encoder_equals_the_tokenizer(docs):
    encoder = token_files.Encoder(TOKENIZER)
    texts = ODD + [row["text"] for row in docs.limit(200).collect()]
    for text in texts + texts:
        expected = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == expected, text


def test_encoder_of_a_file_with_other_rules(tmp_path):
    """A tokenizer that is cut in another way gets whole texts; what is remembered stays bounded."""
    spec = json.loads(Path(TOKENIZER).read_text())
    spec["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}
    spec["truncation"] = {"direction": "Right", "max_length": 3, "strategy": "LongestFirst", "stride": 0}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec))
    encoder, plain = token_files.Encoder(str(path)), token_files.Encoder(TOKENIZER, remembered=20)
    assert not encoder.by_words and plain.by_words
    for text in ODD:
        for one in (encoder, plain):
            assert np.frombuffer(one.encode(text), "<u2").tolist() == one.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.encode("many more words than three of them") != plain.encode("many more words than three of them")
    assert len(encoder.encode("a b c d e f")) == 12
    assert len(plain.known) + len(plain.inner) + len(plain.first) < 60


def test_encoder_of_many_texts(monkeypatch):
    """Texts encoded together are cut at any byte; a word is merged once, whatever sign follows it."""
    texts = [None, *ODD, "élan vital, élan!", "Zürich\nélan élan. Zürich", *ODD]
    encoder = token_files.Encoder(TOKENIZER)
    expected = [encoder.tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]
    for size in (1, 20, 1 << 20):
        monkeypatch.setattr(token_files, "SLICE", size)
        for remembered in (6, 2_000_000):
            encoder = token_files.Encoder(TOKENIZER, remembered=remembered)
            for part in (pa.array(texts), pa.array(["", "x  y", *texts]).slice(2)):
                found = [np.frombuffer(ids, "<u2").tolist() for ids in encoder.encode_all(part)]
                assert found == expected
    assert list(encoder.encode_all(pa.array([], pa.string()))) == []
    merged, merge = [], encoder._merged
    monkeypatch.setattr(encoder, "_merged", lambda spelled: merged.append(spelled) or merge(spelled))
    list(encoder.encode_all(pa.array(["the quag, quag", "a quag. quag!", "the quag"])))
    assert sum("quag" in spelled for spelled in merged) == 1


def test_words_met_of_late_stay_known(monkeypatch):
    encoder = token_files.Encoder(TOKENIZER, remembered=20)
    merged, merge = [], encoder._merged
    monkeypatch.setattr(encoder, "_merged", lambda spelled: merged.append(spelled) or merge(spelled))
    for number in range(100):
        encoder.encode(f"x always {chr(97 + number % 26)}{number}")
    assert sum("always" in spelled for spelled in merged) == 1


def test_token_files_round_trip(edges):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    files = token_files.encode_corpus(edges, TOKENIZER, shard_tokens=3)
    rows = token_files.read_tokens(files).orderBy("start").collect()
    assert len(rows) == len(EDGES) and files.count() > 2
    keys = [row["key"] for row in rows]
    assert keys == sorted(keys, key=lambda key: (key is not None, key or 0))
    expected, start = defaultdict(Counter), 0
    for edge in EDGES:
        ids = [*tokenizer.encode(edge[1] or "", add_special_tokens=False).ids, 2]
        expected[edge[0]][len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    for row in rows:
        assert row["start"] == start
        start += row["n_tokens"]
        expected[row["key"]][row["n_tokens"], row["ids_crc32"]] -= 1
    assert not any(any(left.values()) for left in expected.values())


def test_token_files_of_an_empty_table(empty):
    assert token_files.read_tokens(token_files.encode_corpus(empty, TOKENIZER)).count() == 0


# Mixing


def plain_targets(sizes: dict, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda name: (name is None, (name or "").encode()))
    weight = {name: weights[turn % len(weights)] for turn, name in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[name] for name in full)
        sharing = sum(weight[name] for name in names if name not in full)
        targets = {n: most * sizes[n] if n in full else left * weight[n] / sharing for n in names}
        above = {n for n in names if n not in full and targets[n] > most * sizes[n] * (1 + 1e-12)}
        if not above:
            return targets
        full |= above


def test_mix_against_plain_python(spark):
    rows = [(n, f"s{n % 7}" if n % 11 else None, n * 37 % 50 if n % 7 else n % 3) for n in range(500)]
    rows += [(3, "s3", 5)] * 4 + [(None, "s1", 9)]
    table = spark.createDataFrame(rows, "doc_id long, source string, size long")
    found = mixing.mix(table, blocks=8).collect()
    sizes = defaultdict(int)
    for _, source, size in rows:
        sizes[source] += size
    targets = plain_targets(sizes)
    taken = defaultdict(int)
    for row in found:
        assert row["target"] == pytest.approx(targets[row["source"]])
        assert 0 <= row["taken"] <= 3 * row["size"]
        assert len(row["positions"]) == math.ceil(row["taken"] / row["size"]) if row["size"] else not row["positions"]
        assert all(0 <= time <= 1 for time in row["positions"]) and sorted(row["positions"]) == row["positions"]
        taken[row["source"]] += row["taken"]
    assert len(found) == len(rows)
    for source, target in targets.items():
        assert taken[source] == math.floor(target + 0.5)
    again = mixing.mix(table.repartition(5), blocks=64).collect()
    assert bag((r["doc_id"], r["size"], r["taken"]) for r in found) == bag((r["doc_id"], r["size"], r["taken"]) for r in again)


def test_mix_follows_the_schedules(spark):
    table = spark.createDataFrame([(n, "ab"[n % 2], 10) for n in range(2000)], "doc_id long, source string, size long")
    early, late = ((0, 3), (1, 1)), ((0, 1), (1, 3))
    mixed = mixing.mix(table, weights=(1, 1), schedules=(early, late))
    times = defaultdict(list)
    for row in mixing.in_training_order(mixed).collect():
        times[row["source"]].append(row["position"])
    for source, (a, b) in (("a", (3, 1)), ("b", (1, 3))):
        assert len(times[source]) == 1000
        half = (a + (a + b) / 2) / 2 / 2 / ((a + b) / 2)
        assert sum(t < 0.5 for t in times[source]) / 1000 == pytest.approx(half, abs=0.01)


def test_mix_of_edges(edges, empty):
    sized = edges.selectExpr("doc_id", "source", "text", "cast(length(coalesce(text, '')) as long) as size")
    assert mixing.in_training_order(mixing.mix(sized)).filter("text is null or text = ''").count() == 0
    assert mixing.mix(sized).count() == len(EDGES)
    nothing = empty.selectExpr("doc_id", "source", "0L as size")
    assert mixing.mix(nothing).count() == 0
    assert mixing.mix(edges.selectExpr("doc_id", "source", "0L as size")).agg({"taken": "sum"}).first()[0] == 0


# Quality rules

SPACE = " \t\n\v\f\r"


def plain_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def plain_counts(text):
    words = plain_words(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if line.strip(SPACE)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
    )


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def plain_grams(text, buckets):
    hashes = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in plain_words(text)]
    pairs = [
        xxhash.xxh64(b.to_bytes(8, "little"), seed=xxhash.xxh64(a.to_bytes(8, "little"), seed=42).intdigest()).intdigest()
        for a, b in zip(hashes, hashes[1:])
    ]
    return [signed(value) % buckets for value in hashes + pairs]


def test_quality_rules_against_plain_python(spark, edges, docs):
    repeated = "a b c a b c d\nx y\nx y\n \n" * 9
    rows = [(n, row["text"]) for n, row in enumerate(docs.orderBy("doc_id").limit(150).collect())]
    rows += [(1000, repeated), (1001, repeated + LONG), *((n, text) for n, text, *_ in EDGES)]
    raw = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    good = raw.filter("doc_id < 60")
    found = quality_rules.judge(raw, quality_rules.likelihood_ratios(good, raw, buckets=512), buckets=512).collect()
    target, corpus = Counter(), Counter()
    for key, text in rows:
        corpus.update(plain_grams(text, 512))
        if key is not None and key < 60:
            target.update(plain_grams(text, 512))
    n_t, n_r = sum(target.values()) + 512, sum(corpus.values()) + 512
    logs = [math.log((target[b] + 1) / n_t) - math.log((corpus[b] + 1) / n_r) for b in range(512)]
    assert len(found) == len(rows)
    for row in found:
        counts = plain_counts(row["text"])
        assert tuple(row[name] for name in quality_rules.COUNTS) == counts
        grams = plain_grams(row["text"], 512)
        ratio = sum(logs[b] for b in grams) / len(grams) if grams else 0.0
        assert row["ratio"] == pytest.approx(ratio, abs=1e-5)
        assert row["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert row["kept"] == (not row["base_failed"] and row["ratio"] >= -0.5)


def test_quality_rules_without_trusted_or_any_text(edges, empty):
    judged = quality_rules.judge(edges, quality_rules.likelihood_ratios(empty, edges)).collect()
    assert len(judged) == len(EDGES) and {row["ratio"] for row in judged} == {0.0}
    assert quality_rules.judge(empty, quality_rules.likelihood_ratios(empty, empty)).count() == 0


def test_learned_cut_rejects_held_out_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    known = training_rows(docs, labels, "quality")
    ratios = quality_rules.likelihood_ratios(known.filter("__label = 1"), docs)
    cut = quality_rules.learned_cut(known, ratios).first()["cut"]
    rows = quality_rules.judge(docs, ratios, threshold=cut).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 and not r["base_failed"]]
    bad = [row["kept"] for row in held if row["quality"] == 0]
    good = [row["kept"] for row in held if row["quality"] == 1]
    assert len(bad) > 50 and sum(bad) <= 0.05 * len(bad)
    assert len(good) > 500 and sum(good) >= 0.98 * len(good)


def test_learned_cut_against_plain_python(spark, docs):
    texts = [row["text"] for row in docs.filter("length(text) > 600").orderBy("doc_id").limit(30).collect()]
    rows = [(n, text, int(n % 3 > 0)) for n, text in enumerate(texts)]
    known = spark.createDataFrame(rows, "doc_id long, text string, __label int").repartition(3)
    ratios = quality_rules.likelihood_ratios(known.filter("__label = 1"), known, buckets=512)
    judged = quality_rules.judge(known, ratios, buckets=512).collect()
    target = Counter(g for _, text, good in rows if good for g in plain_grams(text, 512))
    total, found = sum(target.values()) + 512, []
    for row in judged:
        if not row["base_failed"]:
            own, ratio = Counter(plain_grams(row["text"], 512)), row["ratio"]
            if row["__label"]:
                ratio += sum(n * math.log((target[b] - n + 1) / (target[b] + 1)) for b, n in own.items()) / own.total()
                ratio += math.log(total / (total - own.total()))
            found.append((ratio, row["__label"]))
    found.sort()
    cuts = [(sum(label == 0 for _, label in found), 0.0, -0.5)]
    for n, ((a, _), (b, _)) in enumerate(zip(found, found[1:])):
        errors = sum(label for _, label in found[: n + 1]) + sum(not label for _, label in found[n + 1 :])
        cuts.append((errors, a - b, (a + b) / 2))
    best = min(cuts)[2]
    expected = min(best, found[0][0]) if best == -0.5 else best
    assert quality_rules.learned_cut(known, ratios, buckets=512).first()["cut"] == pytest.approx(expected, abs=1e-5)


def test_quality_rules_count_the_corpus_once(spark, tmp_path):
    """The last step reads the ratios from files; it doesn't count all words again for them."""
    from tablewright.llm import suite

    spark.createDataFrame([(n, f"some words of text {n} " * 20) for n in range(30)], "doc_id long, text string") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(n, n % 2) for n in range(30)], "doc_id long, quality int") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    rows = suite.op8_quality_rules(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "labels" not in plan
    assert rows.count() == 30


def test_learned_cut_without_a_label(edges, empty):
    ratios = quality_rules.likelihood_ratios(empty, edges)
    for label in (0, 1):
        known = edges.selectExpr("text", f"{label} as __label")
        assert quality_rules.learned_cut(known, ratios).first()["cut"] == -0.5


# Models


def test_training_rows_are_bounded_and_not_held_out(docs, labels):
    chosen = training_rows(docs, labels, "quality", rows=50).collect()
    assert len(chosen) == 50
    assert all(zlib.crc32(str(row["doc_id"]).encode()) % 3 != 1 for row in chosen)


def test_quality_trees_on_held_out_documents(spark, docs, labels):
    model = quality_model.train(docs, labels)
    scored = docs.join(labels, "doc_id").select("doc_id", "quality", quality_model.score(model, docs["text"]).alias("s"))
    held = [row for row in scored.collect() if zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1]
    right = sum((row["s"] >= 0.5) == row["quality"] for row in held)
    assert len(held) > 80 and right / len(held) > 0.95


def test_tree_traversal_equals_a_plain_walk():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(400, 15))
    model = quality_model.fit(rows, (rows[:, 2] > 0.3) ^ (rows[:, 5] > 0), trees=12, depth=3)
    scores = model.score(rows)
    for row, score in zip(rows[:40], scores):
        total = model.base
        for t in range(12):
            at = 0
            while at < 7:
                at = 2 * at + 1 + int(row[model.feature[t, at]] > model.threshold[t, at])
            total += model.leaf[t, at - 7]
        assert score == pytest.approx(1 / (1 + math.exp(-total)))
    assert ((scores > 0.5) == ((rows[:, 2] > 0.3) ^ (rows[:, 5] > 0))).mean() > 0.9


def test_models_without_labels_score_every_row(edges, empty, labels):
    none = labels.limit(0)
    model = quality_model.train(edges, none)
    assert {row[0] for row in edges.select(quality_model.score(model, edges["text"])).collect()} == {0.5}
    characters = toxicity.count_characters(empty)
    marks = toxicity.train(edges, none, characters)
    assert {row[0] for row in edges.select(toxicity.score(edges, characters, marks)).collect()} == {0.0}
    assert empty.select(toxicity.score(empty, characters, marks)).count() == 0


def test_statistics_of_odd_texts():
    numbers = quality_model.statistics(pa.array([None, "", " \n", "Ab Ab é1 #!", LONG, "x" * 100_000]))
    assert numbers.shape == (6, len(quality_model.STATISTICS)) and np.isfinite(numbers).all()
    assert (numbers[0] == numbers[1]).all()
    named = dict(zip(quality_model.STATISTICS, numbers[3]))
    assert named["words"] == 4 and named["distinct_words"] == 0.75 and named["repeated_next_words"] == 0.25
    assert named["upper"] == 2 / 11 and named["longest_word_bytes"] == 3
    assert numbers[5, -1] == 100_000


def test_language_on_held_out_documents(docs):
    model = language.train(docs)
    rows = docs.select("doc_id", "lang", language.identify(docs, model).alias("found")).collect()
    held = [row for row in rows if row["lang"] and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1]
    assert sum(row["found"]["lang_pred"] == row["lang"] for row in held) / len(held) > 0.97


def test_language_against_a_plain_score(edges):
    texts = ["the cat the", "der Hund", "le chat"]
    model = language.Languages(["x", "y"], np.zeros(2), np.random.default_rng(0).normal(size=(1 << language.BITS, 2)))
    for text, name, score in zip(texts, *model.predict(pa.array(texts))):
        buckets, _ = language.grams(pa.array([text]))
        total = sum(model.logs[b] for b in buckets)
        assert name == "xy"[int(np.argmax(total))]
        assert score == pytest.approx(1 / (1 + math.exp(-abs(total[0] - total[1]))))
    both, offsets = language.grams(pa.array(texts))
    apart = [language.grams(pa.array([text]))[0] for text in texts]
    assert all(sorted(both[a:b]) == sorted(own) for a, b, own in zip(offsets, offsets[1:], apart))


def test_language_of_edges(edges, empty):
    model = language.train(edges)
    found = {row[0]: row[1] for row in edges.select("text", language.identify(edges, model)).collect()}
    assert {found[text]["lang_pred"] for text in (None, "", " \t\n", "!!! ... ???")} == {"und"}
    assert found[LONG]["lang_pred"] == "en" and set(model.names) <= {"en", "de", "fr"}
    assert language.train(empty).names == []


def test_toxicity_restores_disguised_words(spark):
    words = "idiot stupid loser moron trash pathetic clown the and with river stone table people".split()
    texts = [(" ".join(words[n % 14 :] + words[: n % 14]),) for n in range(300)]
    model = toxicity.count_characters(spark.createDataFrame(texts, "text string"))
    decoder = toxicity.Decoder(model)
    for noisy, plain in {
        "an 1d10t": "an idiot", "id!ot": "idiot", "s t u p i d": "stupid", "s.t.u.p.i.d": "stupid", "l0ser": "loser",
        "mooooron": "moron", "tr@sh": "trash", "paaathetic cl0wn": "pathetic clown", "The river": "the river", "": "",
        "room 12, $5": "room 12, $5", "wow!!": "wow!!",
    }.items():
        assert decoder.restore(noisy) == plain
    assert decoder.restore_all(pa.array([None, "id!ot"])).to_pylist() == ["", "idiot"]


def test_viterbi_finds_the_best_reading(spark):
    model = toxicity.count_characters(spark.createDataFrame([("idiot clown stupid loser",)] * 9, "text string"))
    decoder, symbols = toxicity.Decoder(model), toxicity._symbols()

    def total(reading, channel):
        a = b = 0
        for letter in reading + " ":
            c = int(symbols[ord(letter)])
            if c or b:
                channel += float(model.logs[a, b, c])
                a, b = b, c
        return channel

    for span in ("1d10t", "cl0wwwn", "$tup1d"):
        best = {("", 0.0)}
        for options in decoder.lattice(span):
            best = {(text + reading, channel + c) for text, channel in best for reading, c in options}
        assert decoder.decode(span) == max(best, key=lambda found: total(*found))[0]


def test_toxicity_on_held_out_documents(docs, labels):
    characters = toxicity.count_characters(docs)
    marks = toxicity.train(docs, labels, characters)
    rows = docs.join(labels, "doc_id").select("toxic", toxicity.score(docs, characters, marks).alias("s")).collect()
    clean = [row for row in rows if not row["toxic"]]
    assert sum(row["s"] >= 0.7 for row in clean) <= 0.02 * len(clean)
    assert sum(row["s"] >= 0.7 for row in rows if row["toxic"]) > 0.5 * (len(rows) - len(clean))


# Near-duplicates


def plain_runs(text):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    runs = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    seen = Counter()
    labelled = []
    for run in runs:
        labelled.append((run, seen[run]))
        seen[run] += 1
    return labelled


def plain_similarity(a, b):
    """By the textbook table for the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1] / (len(a) + len(b) - row[-1])


def edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        at = int(rng.integers(len(words)))
        kind = int(rng.integers(3))
        words[at : at + (kind != 1)] = [] if kind == 0 else [f"new{int(rng.integers(10**6))}"]
    return " ".join(words)


@pytest.fixture(scope="module")
def copies(docs):
    """Texts, chains of edited copies, copies, and texts without words."""
    rng = np.random.default_rng(5)
    texts = [row["text"] for row in docs.filter("length(text) between 300 and 900").orderBy("doc_id").limit(25).collect()]
    rows = [(n, text) for n, text in enumerate(texts)]
    for n in range(8):
        text = texts[n]
        for step in range(6):
            text = edited(text, rng, 1 + n % 3)
            rows.append((100 + 10 * n + step, text))
    rows += [(300 + n, texts[3].upper()) for n in range(3)] + [(400, texts[5]), (400, texts[5])]
    rows += [(500, None), (501, ""), (502, "..."), (503, "..."), (504, "two words"), (505, "Two, words"), (None, texts[7])]
    return rows


def test_classes_against_all_pairs(spark, copies):
    texts = [text for _, text in copies]
    runs = [plain_runs(text) for text in texts]
    parent = list(range(len(copies)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(copies)):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "")
            short = not runs[i] or not runs[j] or min(len(runs[i]), len(runs[j])) < 0.8 * max(len(runs[i]), len(runs[j]))
            if same or not short and plain_similarity(runs[i], runs[j]) >= 0.8:
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i, (key, _) in enumerate(copies):
        members[root(i)].append(key)
    expected = Counter(
        (key, min((k for k in group if k is not None), default=None)) for group in members.values() for key in group
    )
    table = spark.createDataFrame(copies, "doc_id long, text string").repartition(4)
    found = near_dups.classes(table).select("doc_id", "class_id").collect()
    assert bag(found) == expected
    kept = near_dups.one_of_each(table.selectExpr("*", "1 as node", "2 as class_id"))
    assert kept.columns == ["doc_id", "text", "node", "class_id"]
    assert sorted(row["doc_id"] for row in kept.collect()) == sorted({c for _, c in expected})


def test_alignment_is_exact_above_the_limit():
    rng = np.random.default_rng(9)
    for _ in range(60):
        a = rng.choice(10_000, int(rng.integers(1, 60)), replace=False)
        b = a.copy()
        for _ in range(int(rng.integers(0, 6))):
            at = int(rng.integers(len(b)))
            b = np.delete(b, at) if rng.random() < 0.5 and len(b) > 1 else np.insert(b, at, 20_000 + rng.integers(1000))
        if rng.random() < 0.3:
            b = np.roll(b, int(rng.integers(len(b))))
        exact = plain_similarity(a.tolist(), b.tolist())
        found = near_dups.aligned(a.astype(np.uint64), b.astype(np.uint64))
        assert found == pytest.approx(exact) if exact >= 0.8 else found < 0.8


def test_sketch_keeps_order():
    runs = np.random.default_rng(2).integers(0, 2**64, 50, dtype=np.uint64)
    offsets = np.array([0, 50])
    same = near_dups.sketch(np.concatenate((runs, runs)), np.array([0, 50, 100]))
    assert (same[0] == same[1]).all()
    assert not (near_dups.sketch(runs, offsets) == near_dups.sketch(runs[::-1].copy(), offsets)).any()
    assert near_dups.sketch(runs[:1], np.array([0, 0, 1])).shape == (1, near_dups.SKETCHES)


def test_components_of_long_chains_and_stars(spark):
    links = [(f"{n:04}", f"{n + 1:04}") for n in range(100, 140)] + [("5000", f"{n}") for n in range(5001, 5030)]
    rows = near_dups.components(spark.createDataFrame(links, "u string, v string")).collect()
    assert bag(rows) == Counter(
        [(f"{n:04}", "0100") for n in range(100, 141)] + [(str(n), "5000") for n in range(5000, 5030)]
    )


def test_equal_keys_and_texts_leave_a_fixed_row(spark):
    rows = [(1, "same words in both of these rows", source) for source in ("b", "a", None, "c")]
    rows += [(2, "", "y"), (2, None, "x"), (None, "a text without a key", "z")]
    kept = [
        bag(near_dups.one_of_each(
            spark.createDataFrame(order, "doc_id long, text string, source string").repartition(parts)
        ).collect())
        for order, parts in ((rows, 1), (rows[::-1], 3))
    ]
    assert kept[0] == kept[1]
    assert kept[0] == Counter(
        [(1, "same words in both of these rows", None), (2, None, "x"), (None, "a text without a key", "z")]
    )


def test_classes_of_an_empty_table(empty):
    assert near_dups.classes(empty).count() == 0


# Decontamination

ITEMS = [
    (1, "Alice has 12 apples and gives 5 of them to Bob, so how many apples does Alice have left after that day?"),
    (2, "A train leaves the old station at 9:30 and drives 80 km before it stops near the river for 15 minutes."),
    (3, "too short here"),
    (4, None),
    (None, "An item without an id still counts as an item and must be found in texts that have it whole."),
]


def test_contaminated_texts(spark):
    given = {
        1: "Intro words. " + ITEMS[0][1] + " And more.",
        2: "Now Carla has 30 apples and gives 7 of them to Dan, so how many apples does Carla have left after that day?",
        3: "Now Carla has 30 apples and gives 7 of them to Dan, so how many apples does Erik have left after that day?",
        4: "A TRAIN LEAVES THE OLD STATION AT 9:30 AND DRIVES 80 KM BEFORE IT STOPS NEAR THE RIVER FOR 15 MINUTES.",
        5: "A train leaves the old station at 7:10 and drives 35 miles before it stops near the river for 4 minutes.",
        6: "Some other text about trains and apples that leaves the old station out of it.",
        7: None, 8: "", 9: "too short here", 10: " ".join(["filler"] * 9000) + " " + ITEMS[1][1],
        11: "An item without an id still counts as an item and must be found in texts that have it whole.",
    }
    rows = [*given.items(), (1, given[1]), (None, given[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontamination.contaminated(docs, bench)
    pairs = {(row["doc_id"], row["item_id"]) for row in found.collect()}
    assert pairs == {(1, 1), (None, 1), (2, 1), (4, 2), (5, 2), (10, 2), (11, None)}
    left = decontamination.without_contaminated(docs, found)
    assert sorted(row["doc_id"] for row in left.collect()) == [3, 6, 7, 8, 9]


def test_contaminated_documents_against_plain_search(spark, docs):
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    items = [(row["item_id"], row["text"]) for row in bench.collect()]
    expected = {(d["doc_id"], i) for d in docs.collect() for i, text in items if d["text"] and text in d["text"]}
    found = {(row["doc_id"], row["item_id"]) for row in decontamination.contaminated(docs, bench).collect()}
    assert expected and found == expected


def test_contamination_of_empty_tables(spark, empty, docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.contaminated(empty, bench).count() == 0
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0


def test_windows_are_rows(spark):
    """A row per place with the hash of each kind of window; no function of arrays reads a window's tokens."""
    texts = {1: "one Two three 4 Km five six", 2: "1 2 3 4 5 six", 3: "a b c d E", 4: "a b c d", 5: "", 6: None}
    docs = spark.createDataFrame([*texts.items()], "id int, text string")
    windows = decontamination._windows(docs, "text")
    expected = {
        (1, 0): ("one two three #number #unit", None), (1, 1): ("two three #number #unit five", None),
        (1, 2): ("three #number #unit five six", None), (2, 0): (None, None), (2, 1): (None, None),
        (3, 0): ("a b c d e", "a b c d #name"), (4, None): (None, None), (5, None): (None, None), (6, None): (None, None),
    }
    kinds = {text for pair in expected.values() for text in pair if text}
    words = spark.createDataFrame([(text, *text.split()) for text in kinds], "text string, a string, b string, c string, d string, e string")
    hashes = {row[0]: row[1] for row in words.select("text", F.xxhash64(*[F.xxhash64(word) for word in "abcde"])).collect()}
    got = {(row["id"], row["at"]): tuple(row["hashes"]) for row in windows.collect()}
    assert got == {place: tuple(hashes.get(text) for text in pair) for place, pair in expected.items()}
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = decontamination.contaminated(docs.withColumnRenamed("id", "doc_id"), bench)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(" in plan and "transform(filter(" not in plan


def test_templates_of_odd_tokens(spark):
    """Digits of any script are numbers, units count beside numbers only, names are capitalised words."""
    text = "Run 5 Km, a km, ° 3 ² £ 4 KG Ünï ½ ١ l Ab"
    row = decontamination._tokens(spark.createDataFrame([(1, text), (2, None)], "id int, text string"), "text").orderBy("id").collect()
    assert row[0]["__plain"] == (
        ["run", "#number", "#unit", "a", "km", "#unit", "#number", "#number", "#unit", "#number", "#unit", "ünï", "#number", "#number", "#unit", "ab"]
    )
    assert [token for token, named in zip(row[0]["__raw"], row[0]["__name"]) if named] == ["Run", "Ünï", "Ab"]
    assert [0 if token.startswith("#") else 1 for token in row[0]["__plain"]] == row[0]["__fixed"]
    assert row[1]["__plain"] == row[1]["__name"] == []
