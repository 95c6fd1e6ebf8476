"""Run registered queries against their SQL in DuckDB.

``python -m tests.compare [table folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(item) for item in value)
    return value


def _bag(columns: list[str], rows: list) -> Counter:
    """Rows as a bag, with columns in the order of their names."""
    order = sorted(range(len(columns)), key=lambda position: columns[position])
    return Counter(tuple(_plain(row[p]) for p in order) for row in rows)


# Spark type names and their DuckDB counterparts.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def difference(query, sql: str, spark, connection, folder: str) -> str:
    """Empty text when both sides agree in names, types and rows."""
    frame = query(spark, folder)
    types = {name: TYPES.get(kind, kind) for name, kind in frame.dtypes}
    other_types = {row[0]: str(row[1]) for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    if types != other_types:
        return f"types {types} against {other_types}"
    left = _bag(frame.columns, frame.collect())
    cursor = connection.execute(sql)
    right = _bag([entry[0] for entry in cursor.description], cursor.fetchall())
    if left != right:
        only_left, only_right = left - right, right - left
        return (
            f"{sum(left.values())} rows against {sum(right.values())}; "
            f"only Spark {list(only_left)[:2]}; only SQL {list(only_right)[:2]}"
        )
    return "" if left else "no rows"


def main(arguments: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.session import local_session

    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    wanted = arguments[1:] or list(entry.queries())
    spark, connection = local_session(), connect(folder)
    failures = 0
    for name in wanted:
        began = time.monotonic()
        try:
            sql = entry.oracle_sql().get(name)
            if sql is None:
                problem = f"rows only: {entry.queries()[name](spark, folder).count()}"
            else:
                problem = difference(entry.queries()[name], sql, spark, connection, folder)
        except Exception as error:  # noqa: BLE001 - reported per query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += bool(problem) and not problem.startswith("rows only")
        print(f"{name:28s} {time.monotonic() - began:6.2f}s {problem or 'equal'}", flush=True)
    print(f"{failures} differ of {len(wanted)}")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
