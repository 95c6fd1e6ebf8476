"""File readers. Paths may be files, folders, globs, or any Hadoop file system URL."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    infer: bool = False,
    mode: str = "PERMISSIVE",
    encoding: str = "UTF-8",
) -> DataFrame:
    """CSV as a table. Columns bind to ``schema`` by position, not by header name.

    Unparsable cells become null. ``mode="DROPMALFORMED"`` drops malformed rows,
    whichever columns a query goes on to use. Without a schema all columns are
    strings, or inferred (one more pass) with ``infer=True``; inference widens a
    column to fit bad cells, so only rows with a wrong number of fields count as
    malformed then.
    """
    if mode.upper() == "DROPMALFORMED":
        if schema is None:
            guess = spark.read.option("header", header).option("sep", sep).option("encoding", encoding)
            schema = guess.option("inferSchema", infer).csv(path).schema
        return checked_csv(spark, path, schema, header, sep, encoding)[0]
    reader = spark.read.option("header", header).option("sep", sep).option("mode", mode)
    reader = reader.option("encoding", encoding)
    if schema is not None:
        # Positional binding: the header line is skipped, its names are not compared.
        reader = reader.schema(schema).option("enforceSchema", True)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


def _as_struct(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def checked_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str,
    header: bool = True,
    sep: str = ",",
    encoding: str = "UTF-8",
) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, raw text of malformed rows).

    Spark looks for bad cells only in the columns a query reads. The filters here
    read every column, so both results are the same for every query.
    """
    fields = _as_struct(schema).fields
    extended = StructType([*fields, StructField(CORRUPT, StringType())])
    rows = (
        spark.read.schema(extended)
        .option("header", header)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    # Always true, but only known after parsing all columns.
    parsed = F.pmod(F.xxhash64(*(field.name for field in fields)), F.lit(1)) == 0
    good = rows.filter(parsed & F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = rows.filter(parsed & F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("record"))
    return good, bad


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str,
    multiline: bool = True,
) -> DataFrame:
    """JSON with a nested schema: arrays over many lines, or one record per line.

    A multi-line file is one task's work; use many files, or one record per line,
    for large data.
    """
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_text(
    spark: SparkSession, path: str | Sequence[str], line_sep: str | None = None
) -> DataFrame:
    """Lines as a single ``value`` column."""
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    return reader.text(path)


def skip_header(lines: DataFrame, header: str) -> DataFrame:
    """Drop every line equal to the header line."""
    return lines.filter(F.col("value") != header)


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Add the file each row was read from."""
    return df.withColumn(name, F.input_file_name())


def from_rows(
    spark: SparkSession,
    rows: Iterable[object],
    schema: StructType | str,
    partitions: int | None = None,
) -> DataFrame:
    """Small in-memory collection as a table, over ``partitions`` if given."""
    df = spark.createDataFrame(rows, schema)
    return df if partitions is None else df.repartition(partitions)
