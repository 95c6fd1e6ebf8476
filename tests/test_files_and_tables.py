from __future__ import annotations

import uuid
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tablewright.sinks import catalog as C
from tablewright.sinks import files as W
from tablewright.sources import files as S

PEOPLE = "id int, name string, age int, day date"
GOOD = ["1,Ann,30,2024-01-02", "2,Bob,,2024-01-03"]
BAD = ["3,Cy,abc,2024-01-04", "4,Di,5,2024/13/01", "5,Ed,7,2024-01-05,extra", "6,Flo,8"]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "one.csv").write_text("\n".join(["person,n,a,d", *GOOD, BAD[0], BAD[1]]) + "\n")
    (tmp_path / "two.csv").write_text("\n".join(["person,n,a,d", *BAD[2:]]) + "\n")
    return str(tmp_path)


def test_columns_bind_by_position(spark, folder, rows):
    got = S.read_csv(spark, folder + "/one.csv", PEOPLE)
    assert got.columns == ["id", "name", "age", "day"]
    assert rows(got, "id", "age") == [(1, 30), (2, None), (3, None), (4, 5)]


def test_without_schema_all_text_or_inferred(spark, folder):
    assert dict(S.read_csv(spark, folder + "/one.csv").dtypes)["a"] == "string"
    inferred = S.read_csv(spark, folder + "/one.csv", infer=True)
    assert dict(inferred.dtypes)["person"] == "int"


def test_malformed_rows_are_dropped_for_every_query(spark, folder, rows):
    got = S.read_csv(spark, folder, PEOPLE, mode="DROPMALFORMED")
    assert rows(got, "id") == [(1,), (2,)]
    assert got.count() == 2
    assert got.select("name").count() == 2
    assert got.groupBy("day").count().count() == 2


def test_malformed_rows_can_be_kept_apart(spark, folder, rows):
    good, bad = S.checked_csv(spark, folder, PEOPLE)
    assert rows(bad) == sorted((line,) for line in BAD)
    assert good.count() + bad.count() == 6


def test_inferred_schema_only_drops_rows_of_wrong_width(spark, folder, rows):
    got = S.read_csv(spark, folder, infer=True, mode="DROPMALFORMED")
    assert rows(got, "person") == [(1,), (2,), (3,), (4,)]


def test_source_file(spark, folder):
    named = S.with_source_file(S.read_csv(spark, folder, PEOPLE))
    files = {row[0].rsplit("/", 1)[1] for row in named.select("source_file").distinct().collect()}
    assert files == {"one.csv", "two.csv"}


def test_multiline_json(spark, tmp_path, rows):
    (tmp_path / "c.json").write_text(
        '[\n {"customer": {"id": 1,\n "orders": {"total": 3, "amount": 250.5}}},\n'
        ' {"customer": {"id": 2}}\n]'
    )
    ddl = "customer struct<id: int, orders: struct<total: int, amount: double>>"
    got = S.read_json(spark, str(tmp_path / "c.json"), ddl)
    assert rows(got.select("customer.id", "customer.orders.amount")) == [(1, 250.5), (2, None)]


def test_text_lines_and_header(spark, tmp_path, rows):
    (tmp_path / "t.txt").write_text("h;a;h;b")
    lines = S.read_text(spark, str(tmp_path / "t.txt"), ";")
    assert rows(S.skip_header(lines, "h")) == [("a",), ("b",)]


def test_from_rows(spark):
    df = S.from_rows(spark, [(n,) for n in range(10)], "n int", 3)
    assert df.count() == 10
    assert df.select(F.spark_partition_id()).distinct().count() <= 3


def test_partitioned_parquet_is_pruned_and_compact(spark, tmp_path):
    df = spark.range(300, numPartitions=6).selectExpr("id", "cast(id % 3 as string) AS city")
    path = str(tmp_path / "out")
    W.write_parquet(df, path, partition_by="city")
    back = spark.read.parquet(path)
    assert back.count() == 300
    assert len(back.inputFiles()) == 3
    scan = back.filter("city = '1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(city" in scan


def test_overwrite_and_single_file(spark, tmp_path):
    path = str(tmp_path / "out")
    W.write_parquet(spark.range(10, numPartitions=4), path)
    W.write_parquet(spark.range(5, numPartitions=4), path, files=1)
    assert spark.read.parquet(path).count() == 5
    assert len(spark.read.parquet(path).inputFiles()) == 1


def test_text_output(spark, tmp_path, rows):
    df = spark.createDataFrame([("p1", 2)], "id string, n int")
    W.write_text_lines(df, ["id", F.format_string("%.2f", F.col("n") * 1.5)], str(tmp_path / "out"))
    assert rows(S.read_text(spark, str(tmp_path / "out"))) == [("p1,3.00",)]


@pytest.fixture
def namespace(spark, tmp_path):
    name = f"space_{uuid.uuid4().hex[:8]}"
    C.ensure_namespace(spark, name, str(tmp_path / name))
    return name


def test_publish_replaces(spark, namespace):
    C.publish_table(spark.range(3).toDF("a"), f"{namespace}.t")
    C.publish_table(spark.range(5).toDF("b"), f"{namespace}.t")
    assert spark.table(f"{namespace}.t").columns == ["b"]
    counts = C.verify_counts(spark, {f"{namespace}.t": 5}).first()
    assert (counts["rows"], counts["matches"]) == (5, True)


def test_namespace_is_kept_unless_replaced(spark, namespace, tmp_path):
    C.publish_table(spark.range(3), f"{namespace}.t")
    C.ensure_namespace(spark, namespace)
    assert spark.catalog.tableExists(f"{namespace}.t")
    C.ensure_namespace(spark, namespace, str(tmp_path / "again"), replace=True)
    assert not spark.catalog.tableExists(f"{namespace}.t")


def test_registered_files(spark, namespace, tmp_path):
    spark.range(4).selectExpr("id", "'x' AS name").write.parquet(str(tmp_path / "files"))
    table = C.register_table(spark, f"{namespace}.ext", str(tmp_path / "files"))
    assert table.count() == 4
    again = C.register_table(spark, f"{namespace}.ext", str(tmp_path / "files"))
    assert again.count() == 4


def test_registering_never_drops_a_managed_table(spark, namespace, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "files"))
    C.publish_table(spark.range(3), f"{namespace}.own")
    with pytest.raises(ValueError, match="MANAGED"):
        C.register_table(spark, f"{namespace}.own", str(tmp_path / "files"))
    assert spark.table(f"{namespace}.own").count() == 3


def test_views(spark, namespace):
    C.publish_table(spark.range(6), f"{namespace}.t")
    C.create_view(spark, f"{namespace}.v", f"SELECT id FROM {namespace}.t WHERE id > 3")
    C.create_view(spark, f"{namespace}.v", f"SELECT id FROM {namespace}.t WHERE id > 4")
    assert spark.table(f"{namespace}.v").count() == 1
    assert C.sql_over(spark.range(6), "numbers", "SELECT sum(id) AS s FROM numbers").first()["s"] == 15


def test_catalog_plug_ins_replace_in_one_step():
    """No such catalog is installed here, so the calls are recorded."""
    calls = []

    class Writer:
        def using(self, provider):
            calls.append(provider)
            return self

        def createOrReplace(self):
            calls.append("createOrReplace")

    class Frame:
        sparkSession = SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: {"spark.sql.catalog.lake": "x"}.get(key))
        )

        def writeTo(self, name):
            calls.append(name)
            return Writer()

    C.publish_table(Frame(), "lake.shop.orders", "iceberg")
    assert calls == ["lake.shop.orders", "iceberg", "createOrReplace"]
