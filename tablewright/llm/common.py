"""What several operators share: tables, words, held-out rows, bounded training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What separates words, and what makes one up.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; empty for a null or wordless text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\v\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8_crc32(text: Column) -> Column:
    """Unsigned checksum of the text's UTF-8 bytes; a null text counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def held_out(key: Column) -> Column:
    """Rows that no model may learn from: the checksum of the id leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", rows: int = 20_000
) -> DataFrame:
    """Documents with a label, as columns ``__label`` (0 or 1) and those of ``docs``.

    ``rows`` bounds the labels used: the ones whose ids have the smallest hashes, so the
    choice is the same in every run. That bound also makes the list safe to broadcast,
    which keeps the texts where they are. Held-out ids, null ids and null labels are left
    out; of conflicting labels of one id the smaller counts.
    """
    chosen = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
        .groupBy(F.col(key).alias("__labelled"))
        .agg(F.min(F.col(label).cast("int")).alias("__label"))
        .orderBy(F.xxhash64("__labelled"), "__labelled")
        .limit(rows)
    )
    return docs.join(F.broadcast(chosen), docs[key] == F.col("__labelled")).drop("__labelled")
