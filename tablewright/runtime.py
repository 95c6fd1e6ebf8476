"""Session-level helpers: shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"


# Temporary folders of local sessions, by application id; removed when Python ends.
_LOCAL_FOLDERS: dict[str, tempfile.TemporaryDirectory] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary
    folder of its own. On a cluster a missing setting is an error, because a
    machine-local folder would lose data with its executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.TemporaryDirectory(
            prefix="tablewright-", ignore_cleanup_errors=True
        )
    return _LOCAL_FOLDERS[context.applicationId].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


# Rows that a task adds up in memory.
ROWS_PER_TASK = 500_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to as many tasks as its ``rows`` need, as they stand if one is enough.

    Spark merges the parts of a shuffle by their bytes, so that groups of short rows fill
    a task's memory; it leaves a number of parts that was asked for. Grouping by the keys
    needs no shuffle afterwards.
    """
    parts = -(-rows // ROWS_PER_TASK)
    return df.repartition(parts, *keys) if parts > 1 else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a result to the shared folder once and go on from the files.

    The files outlive any executor and carry no history. Spark also knows their
    size, so a join with the result is broadcast exactly when it is small enough.
    """
    return cut_and_measure(df)[0]


def cut_in_buckets(df: DataFrame, buckets: int, *keys: str) -> DataFrame:
    """Write a result to the shared folder in hash buckets of ``keys`` and go on from the files.

    A later join on exactly these keys reads the buckets in place and shuffles the other
    side only, provided that ``spark.sql.shuffle.partitions`` equals ``buckets``. One
    task writes one bucket, so a key must not own more rows than a task can hold. The
    catalog knows the layout while the table is opened; its entry is removed at once,
    the files stay in the shared folder.
    """
    spark, name = df.sparkSession, f"spark_catalog.default.step_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.format("parquet").bucketBy(buckets, *keys)
    writer.option("path", scratch_path(spark, "step")).saveAsTable(name)
    opened = spark.table(name)
    opened.schema  # resolved before the entry goes
    spark.sql(f"DROP TABLE {name}")
    return opened


def cut_and_measure(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict[str, object]]:
    """``cut_lineage`` plus aggregates of the written rows, taken by the same job."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "step")
    observation = Observation()
    rows = F.count(F.lit(1)).alias("rows")
    named = [column.alias(name) for name, column in measures.items()]
    df.observe(observation, rows, *named).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), observation.get
