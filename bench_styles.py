"""Times library operators against row-at-a-time programs for the same results.

There is no published timing to compare with, so the yardstick is the style of
program the operators replace: pair collections handled by Python functions, and
per-row Python functions on columns. Both sides read the same tables, and the
results are compared before the times are printed.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import functions as F

from suite.tables import cents, table
from tablewright.functions.text import hashtag_count
from tablewright.operators.aggregates import group_sum, value_histogram
from tablewright.operators.joins import lookup
from tablewright.plans.text import word_count
from tests.session import local_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    documents = table(spark, folder, "documents").select("text")
    orders = table(spark, folder, "orders").select("o_custkey", cents("o_totalprice").alias("price"))
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_quantity")
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    tagged = table(spark, folder, "events").select(
        F.concat(F.lit("did #"), "event_type", F.lit(" and #u"), "user_id").alias("text")
    )
    word = re.compile(r"\w+", re.ASCII)
    tag = re.compile(r"#\w+")

    @F.udf("int")
    def count_tags(text):
        return len(tag.findall(text)) if text else None

    def lookup_rows():
        names = spark.sparkContext.broadcast({r[0]: r[1] for r in part.collect()})
        named = F.udf(lambda key: names.value.get(key, "Unknown"))
        return lines.withColumn("name", named("l_partkey")).groupBy("name").count()

    pairs = {
        "word_count": (
            lambda: documents.rdd.flatMap(lambda r: word.findall(r.text))
            .map(lambda w: (w.lower(), 1)).reduceByKey(lambda a, b: a + b).collect(),
            lambda: word_count(documents, "text", "ascii").collect(),
        ),
        "spend_by_customer": (
            lambda: orders.rdd.map(lambda r: (r.o_custkey, r.price))
            .reduceByKey(lambda a, b: a + b).collect(),
            lambda: group_sum(orders, "o_custkey", "price").collect(),
        ),
        "value_histogram": (
            lambda: list(lines.rdd.map(lambda r: r.l_quantity).countByValue().items()),
            lambda: value_histogram(lines, "l_quantity").collect(),
        ),
        "lookup": (
            lambda: lookup_rows().collect(),
            lambda: lookup(lines, part, "l_partkey", "p_name", "Unknown", dim_key="p_partkey")
            .groupBy("p_name").count().collect(),
        ),
        "hashtag_count": (
            lambda: tagged.select(count_tags("text").alias("n")).groupBy("n").count().collect(),
            lambda: tagged.select(hashtag_count("text").alias("n")).groupBy("n").count().collect(),
        ),
    }
    report = {}
    for name, (by_row, by_column) in pairs.items():
        best = []
        results = []
        for program in (by_row, by_column):
            times = []
            for _ in range(3):
                began = time.perf_counter()
                rows = program()
                times.append(time.perf_counter() - began)
            best.append(round(sorted(times)[1], 3))
            results.append(sorted(tuple(row) for row in rows))
        assert results[0] == results[1], name
        report[name] = {"row_at_a_time": best[0], "library": best[1]}
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
