"""Word counts and access-log profiles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.text import words
from tablewright.operators.ordering import sort_columns

# Token positions in a common-format access-log line.
LOG_FIELDS = {"ip": 0, "endpoint": 6, "status": 8}


def word_count(df: DataFrame, column: str, tokenizer: str = "ascii") -> DataFrame:
    """Words and how often they occur, most frequent first.

    Tokenizers: ``whitespace`` (case kept), ``ascii`` (split at non-word
    characters, lower case), ``regex`` (Unicode word pattern, lower case).
    """
    tokens = df.select(F.explode(words(column, tokenizer)).alias("word")).filter("word <> ''")
    word = F.lower("word") if tokenizer == "ascii" else F.col("word")
    counts = tokens.groupBy(word.alias("word")).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(*sort_columns(["-count", "word"]))


def log_profile(
    lines: DataFrame, column: str = "value", fields: Mapping[str, int] | None = None
) -> DataFrame:
    """Hits per client address, endpoint and status as ``(field, value, count)``.

    One scan and one shuffle for all fields. A missing token counts 0.
    """
    tokens = F.split(F.col(column), " ")
    entries = F.array(
        *(
            F.struct(F.lit(name).alias("field"), F.get(tokens, F.lit(position)).alias("value"))
            for name, position in (fields or LOG_FIELDS).items()
        )
    )
    return (
        lines.select(F.explode(entries).alias("e"))
        .groupBy(F.col("e.field").alias("field"), F.col("e.value").alias("value"))
        .agg(F.count("e.value").alias("count"))
    )
