"""Shards in random order by a two-pass external shuffle.

The first pass scatters the rows by seeded hashes into buckets small enough for the
memory of one task. The second shuffles each bucket (Fisher-Yates) and writes it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.runtime import cut_lineage, scratch_path

ROW = "__row"


def shard_of(key: Column, shards: int, seed: int = 0) -> Column:
    """Shard of a key: the one whose seeded hash with the key is the largest.

    Only the key and the number of shards decide. With one more shard a key either stays
    or moves to the new one. A null key is a key like any other. The cost is one hash
    per shard.
    """
    ranks = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda shard: F.struct(F.xxhash64(F.lit(seed), shard, key).alias("rank"), shard.alias("shard")),
    )
    return F.array_max(ranks)["shard"]


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text plus one; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = 16,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 0,
    bucket_bytes: int = 32 << 20,
    bucket_rows: int = 200_000,
) -> DataFrame:
    """Write all rows below ``path``, one folder per shard, and return what was written.

    The result has the columns of ``docs``, then ``shard`` and ``slot``, the row's place
    in its shard, gapless from 0; input columns of these two names are replaced. Every
    row is written once: repeated rows get slots of their own, rows with a null key or
    text count like others, and an empty table gives no row. The number of buckets
    follows from the total size, so a bucket holds about ``bucket_bytes`` or
    ``bucket_rows``, whichever is smaller; one very long text is a bucket of its size.
    The hash of a row's bucket covers all its columns that Spark can hash (no maps), so
    copies of a text under different keys are scattered, and rows that share key and text
    keep their order. Input order has no influence on the result but among rows that are
    equal in all these columns; those stay in one bucket.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    total, rows = docs.agg(F.coalesce(F.sum(text_bytes(F.col(text))), F.lit(0)), F.count(F.lit(1))).first()
    buckets = max(1, math.ceil(total / shards / bucket_bytes), math.ceil(rows / shards / bucket_rows))
    hashed = [field.name for field in docs.schema if "map<" not in field.dataType.simpleString()]
    row_hash = F.xxhash64(F.lit(seed + 1), *hashed)
    scattered = docs.select(
        shard_of(F.col(key), shards, seed).alias("shard"),
        F.pmod(row_hash, F.lit(buckets)).cast("int").alias("bucket"),
        F.xxhash64(F.lit(seed + 2), row_hash).alias("hash"),
        F.struct(*docs.columns).alias(ROW),
    )

    def shuffle(group: tuple, bucket: pa.Table) -> pa.Table:
        shard, number = (int(value.as_py()) for value in group)
        # A fixed order first, so that the shuffle does not depend on how rows arrived.
        order = np.argsort(bucket["hash"].to_numpy(), kind="stable")
        dealt = np.random.default_rng([seed, shard, number]).permutation(len(order))
        place = np.empty(len(order), dtype=np.int64)
        place[order[dealt]] = np.arange(len(order))
        table = bucket.drop_columns(["hash"]).append_column("place", pa.array(place))
        return table.take(pa.array(order[dealt]))

    schema = f"shard int, bucket int, {ROW} {docs.schema.simpleString()}, place long"
    shuffled = scattered.groupBy("shard", "bucket").applyInArrow(shuffle, schema)
    shuffled.write.partitionBy("shard").parquet(path)

    written = spark.read.schema(shuffled.schema).parquet(path)
    in_shard = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # Written down, so that Spark knows the size of these few rows and leaves the others in place.
    before = cut_lineage(
        written.groupBy("shard", "bucket")
        .count()
        .select("shard", "bucket", F.coalesce(F.sum("count").over(in_shard), F.lit(0)).alias("before"))
    )
    return written.join(before, ["shard", "bucket"]).select(
        f"{ROW}.*", "shard", (F.col("before") + F.col("place")).alias("slot")
    )


def shard(docs: DataFrame, shards: int = 16, **options) -> DataFrame:
    """``write_shards`` to a new folder below the shared one."""
    return write_shards(docs, scratch_path(docs.sparkSession, "shards"), shards, **options)
