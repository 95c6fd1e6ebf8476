"""Tokenisers and hashtag expressions over whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Token patterns. A word has letters, numbers of every kind and underscores,
# but no combining marks: \w of Java differs, so the class and its limits are spelt out.
WORD_CHARACTER = r"[\p{L}\p{N}_]"
HASHTAG_PATTERN = rf"#{WORD_CHARACTER}+"
WORD_PATTERN = rf"{WORD_CHARACTER}+(?: '{WORD_CHARACTER}+)*"
ASCII_GAP = r"\W+"
WHITE_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"

TOKENIZERS = ("whitespace", "ascii", "regex")


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def words(value: Column | str, tokenizer: str) -> Column:
    """Words of a text as an array, in the case the tokenizer reads them.

    The array may hold empty words, and ``ascii`` words still in mixed case:
    ``word_count`` settles both per word, where generated code can do it.
    """
    value = _column(value)
    if tokenizer == "whitespace":
        return F.split(value, WHITE_SPACE)
    if tokenizer == "ascii":
        return F.split(value, ASCII_GAP)
    if tokenizer == "regex":
        return F.regexp_extract_all(F.lower(value), F.lit(WORD_PATTERN), F.lit(0))
    raise ValueError(f"tokenizer must be one of {TOKENIZERS}")


def hashtag_array(value: Column | str) -> Column:
    return F.regexp_extract_all(_column(value), F.lit(HASHTAG_PATTERN), F.lit(0))


def hashtag_count(value: Column | str) -> Column:
    """Hashtags in a text; null for null or empty text."""
    value = _column(value)
    return F.when(value != "", F.size(hashtag_array(value)))


def hashtags(df: DataFrame, column: str, name: str = "hashtag") -> DataFrame:
    """One row per hashtag, next to the row's columns; texts without any give none."""
    return df.withColumn(name, F.explode(hashtag_array(column)))
