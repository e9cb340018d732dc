"""Runs registered queries on Spark and their SQL on DuckDB and compares the rows.

    python tests/compare.py [prefix ...]        data folder: $COMPARE_DIR
"""

from __future__ import annotations

import os
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{folder}/{table}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"create view {table} as select * from read_parquet('{files}')")
    return connection


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(spark_df, connection, sql: str) -> str | None:
    """None when column names, row count and every value agree."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    expected = _sorted_rows(names, result.fetchall())
    actual = _sorted_rows(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if len(expected) != len(actual):
        return f"rows {len(actual)} != {len(expected)}"
    for ours, theirs in zip(actual, expected):
        if ours != theirs or [type(v) for v in ours] != [type(v) for v in theirs]:
            return f"{ours} != {theirs}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from meterlens.session import local_session

    folder = os.environ.get("COMPARE_DIR", "/root/testdata/sf0.01")
    prefixes = tuple(sys.argv[1:])
    spark, connection, oracles = local_session(8), duck(folder), entry.oracle_sql()
    for name, run in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in oracles:
                problem = difference(df, connection, oracles[name])
            else:
                problem = f"no SQL, {df.count()} rows"
            rows = connection.execute(f"select count(*) from ({oracles[name]})").fetchone()[0] if name in oracles else "-"
        except Exception as error:  # noqa: BLE001
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", "?"
        print(f"{name:36} {time.time() - start:6.2f}s {rows!s:>7} {problem or 'ok'}", flush=True)
