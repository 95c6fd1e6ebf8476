"""Corpus pipeline: quality, near-duplicates, decontamination, mixing, shards.

Every stage takes (spark, docs, folder) and returns what it keeps; all but the last return
the columns of ``docs``. ``run`` writes each stage's rows to the shared folder and reads
them again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import decontamination, mixing, near_dups, quality_model, sharding
from tablewright.llm.common import table, word_count
from tablewright.runtime import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality_model.train(docs, table(spark, folder, "labels"))
    return docs.filter(quality_model.score(model, F.col("text")) >= 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The first document of every class of near-duplicates."""
    return near_dups.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    found = decontamination.contaminated(docs, table(spark, folder, "benchmark"))
    return decontamination.without_contaminated(docs, found)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """A row for every copy of a document that the mix takes, in training order.

    Documents that it takes nothing of, or less than half, go; those it repeats have a row
    for each time. Columns of the documents named like those of the mix stay as they are. A
    null source is a source; documents without words go; repeated rows count each.
    """
    whole = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.struct(*docs.columns).alias("row"))
    return mixing.in_training_order(mixing.mix(whole)).select("row.*")


def shard(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All rows in 16 shards, shuffled, with ``shard`` and ``slot``."""
    return sharding.shard(docs, 16)


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix),
    ("sharding", shard),
]

# Trees, sketches and seeded shuffles are beyond SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, folder, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, folder))
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
