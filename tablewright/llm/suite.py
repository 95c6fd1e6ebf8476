"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import (
    bpe_trie, conversation_trie, decontamination, language, mixing, near_dups, phrases, quality_model, quality_rules,
    sharding, token_files, toxicity, wrappers,
)
from tablewright.llm.common import held_out, table, training_rows, utf8_crc32, word_count
from tablewright.runtime import cut_lineage


def op1_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Class of near-duplicates of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near_dups.classes(docs).select("doc_id", "class_id")


def op2_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, folder, "pages")
    found = wrappers.infer_wrappers(pages)
    return wrappers.extract_pages(pages, found).select("page_id", "url", "text", "n_chars")


def op3_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_model.train(docs, table(spark, folder, "labels"))
    return docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        quality_model.score(model, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, folder, "documents")
    model = language.train(docs)
    found = docs.select("doc_id", language.identify(docs, model).alias("found"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "found.*")


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that contain a benchmark item, with the item."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.contaminated(docs, table(spark, folder, "benchmark"))
    return found.drop("doc_text")


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    characters = toxicity.count_characters(docs)
    marks = toxicity.train(docs, table(spark, folder, "labels"), characters)
    return docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        toxicity.score(docs, characters, marks).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, folder, "documents")
    sized = cut_lineage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    return (
        mixing.mix(sized)
        .withColumn("first_position", F.get("positions", F.lit(0)))
        .select("doc_id", "size", "source_size", "target", "taken", "first_position")
        .orderBy("first_position", "doc_id")
    )


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and verdict of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    # Both are used several times; the rows are bounded, the ratios are one row.
    labelled = cut_lineage(training_rows(docs, table(spark, folder, "labels"), "quality").select("text", "__label"))
    ratios = cut_lineage(quality_rules.likelihood_ratios(labelled.filter("__label = 1"), docs))
    cut = quality_rules.learned_cut(labelled, ratios).first()["cut"]
    return quality_rules.judge(docs, ratios, threshold=cut).drop("text")


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document, read back from the shards."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sharding.shard(docs, 16).select(
        "doc_id",
        sharding.text_bytes(F.col("text")).alias("size"),
        utf8_crc32(F.col("text")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        sharding.shard_of(F.col("doc_id"), 17).alias("grown_shard"),
    )


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, read back from the wavelet matrices."""
    docs = table(spark, folder, "documents")
    files = token_files.encode_corpus(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_tokens(files).withColumnRenamed("key", "doc_id")


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """Best phrases of every language."""
    found, totals = phrases.phrases(table(spark, folder, "documents"))
    return phrases.best_phrases(found, totals)


def op12_bpe_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Checksums of every document's ids, and of the text decoded from them."""
    return bpe_trie.digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    turns = conversation_trie.numbered_turns(table(spark, folder, "conversations"))
    return conversation_trie.prefix_trie(*conversation_trie.rebuilt(turns)).nodes.drop(*conversation_trie.KEY)


def _position_sql() -> str:
    """First position of a document, from ``served``, in the operations of the operator."""
    cases = []
    for number, schedule in enumerate(mixing.SCHEDULES):
        pieces, total = [], 0.0
        for (begin, low), (stop, high) in zip(schedule, schedule[1:]):
            pieces.append((begin, stop, low, high, total))
            total += (stop - begin) * (low + high) / 2
        result = ""
        for begin, stop, low, high, before in reversed(pieces):
            slope = (high - low) / (stop - begin)
            left = f"greatest(share * {total}::DOUBLE - {before}::DOUBLE, 0::DOUBLE)"
            root = f"sqrt(greatest({low * low}::DOUBLE + {2 * slope}::DOUBLE * {left}, 0::DOUBLE))"
            time = f"{begin}::DOUBLE + CASE WHEN {left} > 0 THEN 2 * {left} / ({low} + {root}) ELSE 0::DOUBLE END"
            limit = before + (stop - begin) * (low + high) / 2
            result = f"CASE WHEN share * {total}::DOUBLE < {limit}::DOUBLE THEN {time} ELSE {result} END" if result else time
        cases.append(f"WHEN turn % {len(mixing.SCHEDULES)} = {number} THEN least({result}, {schedule[-1][0]}::DOUBLE)")
    return f"CASE {' '.join(cases)} END"


MIXING_SQL = f"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn
  FROM docs GROUP BY source),
weighted AS (
  SELECT *, turn % 3 + 1 AS weight, 3 * source_size AS cap, CAST(3 * source_size AS DOUBLE) / (turn % 3 + 1) AS ratio
  FROM sources),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER earlier, 0) AS DOUBLE)
    / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
  FROM weighted
  WINDOW earlier AS (ORDER BY ratio, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, turn,
    least(CAST(cap AS DOUBLE), (SELECT min_by(level, (ratio, turn)) FROM levels WHERE level <= ratio) * weight) AS target
  FROM levels),
placed AS (
  SELECT doc_id, size, source_size, turn, target, CAST(floor(target + 0.5) AS BIGINT) AS demand,
    coalesce(sum(size) OVER (PARTITION BY docs.source ORDER BY digest, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source),
parts AS (
  SELECT *, demand // greatest(source_size, 1) AS rounds,
    greatest(least(demand - demand // greatest(source_size, 1) * source_size - start, size), 0) AS part
  FROM placed),
served AS (
  SELECT *, CAST(rounds * size + part AS BIGINT) AS taken,
    (start + CAST(CASE WHEN rounds > 0 THEN size ELSE part END AS DOUBLE) / 2) / greatest(demand, 1) AS share
  FROM parts)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN {_position_sql()} END AS first_position
FROM served"""

PHRASES_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words
  FROM (
    SELECT lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
grams AS (
  SELECT lang, k, unnest([list_slice(words, i, i + k - 1) FOR i IN range(1, len(words) - k + 2)]) AS gram
  FROM pieces, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(words) >= k),
counted AS (SELECT lang, k, gram, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a) AS n FROM counted WHERE k = 1 GROUP BY lang),
frequent AS (SELECT * FROM counted WHERE a >= 30),
cuts AS (
  SELECT p.lang, p.k, p.gram, p.a, c.cut, x.a AS l, y.a AS r, 2000000::HUGEINT * p.a // (x.a + y.a) AS score
  FROM frequent p JOIN (VALUES (1), (2), (3)) AS c(cut) ON c.cut < p.k
  JOIN frequent x ON x.lang = p.lang AND x.gram = p.gram[:c.cut]
  JOIN frequent y ON y.lang = p.lang AND y.gram = p.gram[c.cut + 1:]),
scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) = 1),
parts AS (
  SELECT lang, gram[i:i + s - 1] AS gram, a
  FROM frequent, (VALUES (2), (3)) AS sizes(s), (VALUES (1), (2), (3)) AS places(i)
  WHERE s < k AND i + s - 1 <= k),
covers AS (SELECT lang, gram, max(a) AS a FROM parts GROUP BY ALL),
left_over AS (
  SELECT s.*, array_to_string(s.gram, ' ') AS phrase
  FROM scored s LEFT JOIN covers c ON c.lang = s.lang AND c.gram = s.gram
  WHERE c.a IS NULL OR 100::HUGEINT * c.a < 80::HUGEINT * s.a)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_over)
JOIN totals USING (lang) WHERE rank <= 2000"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_wrappers": op2_wrappers,
    "op3_quality_trees": op3_quality_trees,
    "op4_language": op4_language,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_mixing": op7_mixing,
    "op8_quality_rules": op8_quality_rules,
    "op9_sharding": op9_sharding,
    "op10_token_files": op10_token_files,
    "op11_phrases": op11_phrases,
    "op12_bpe_trie": op12_bpe_trie,
    "op13_conversation_trie": op13_conversation_trie,
}
# The other operators use hashes, trees, alignments or file formats that SQL lacks; the
# tests compare them with plain Python.
ORACLE: dict[str, str] = {"op7_mixing": MIXING_SQL, "op11_phrases": PHRASES_SQL}
