"""Compare queries with their SQL, value by value.

    python tests/check_oracles.py [SF_DIR] [QUERY ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def plain(value: object) -> object:
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return Counter(tuple(plain(row[n]) for n in order) for row in rows)


def compare(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str):
    """(problem or '', rows, Spark seconds)."""
    started = time.time()
    df = contract.queries()[name](spark, sf_dir)
    got = [tuple(row) for row in df.collect()]
    seconds = time.time() - started
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return ("" if got else "no rows"), len(got), seconds
    relation = connection.execute(sql)
    names = [column[0] for column in relation.description]
    kinds = {column[0]: str(column[1]) for column in relation.description}
    expected = relation.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}", len(got), seconds
    same = {
        "string": "VARCHAR",
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "date": "DATE",
        "boolean": "BOOLEAN",
        "timestamp": "TIMESTAMP",
        "timestamp_ntz": "TIMESTAMP",
    }
    for column, kind in df.dtypes:
        if same.get(kind, kind) != kinds[column]:
            return f"{column} is {kind} against {kinds[column]}", len(got), seconds
    left, right = bag(df.columns, got), bag(names, expected)
    if left != right:
        only_spark, only_sql = left - right, right - left
        return (
            f"{sum(only_spark.values())} rows only in Spark, {sum(only_sql.values())} only in SQL; "
            f"{list(only_spark)[:2]} {list(only_sql)[:2]}",
            len(got),
            seconds,
        )
    return "", len(got), seconds


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(contract.queries())
    spark, connection = session(), connect(sf_dir)
    failures = 0
    for name in names:
        try:
            problem, rows, seconds = compare(spark, connection, sf_dir, name)
        except Exception as error:
            problem, rows, seconds = f"{type(error).__name__}: {str(error)[:600]}", 0, 0.0
        failures += bool(problem)
        kind = "sql" if name in contract.oracle_sql() else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {name:24} {kind:4} {rows:8} {seconds:6.2f}s {problem}", flush=True)
    print(f"{len(names) - failures} of {len(names)} agree")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
