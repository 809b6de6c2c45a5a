"""Run registered queries in Spark and in DuckDB and compare names, types and values.

Usage: python tests/oracle.py [folder] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    return value


def sort_key(row):
    return tuple((v is None, str(v)) for v in row)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=sort_key)


def compare(spark, connection, query, sql: str, folder: str) -> str | None:
    """None when both engines agree, else what differs."""
    frame = query(spark, folder)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    for name, kind in frame.dtypes:
        if TYPES.get(kind, kind) != types[name]:
            return f"type of {name}: {kind} != {types[name]}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            at = next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)
            return f"column {sorted(names)[at]}: {str(a)[:700]}\n   !=   {str(b)[:700]}"
    return None


def main() -> None:
    from gleaner.plans import ORACLES, QUERIES
    from gleaner.session import get_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = get_session(
        master="local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = connect(folder)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, connection, QUERIES[name], ORACLES[name], folder)
                outcome = problem or "ok"
            else:
                outcome, problem = f"rows only: {QUERIES[name](spark, folder).count()}", None
        except Exception as error:  # noqa: BLE001
            problem = outcome = f"{type(error).__name__}: {str(error)[:1200]}"
        bad += problem is not None
        print(f"\n{name:32s} {time.time() - start:6.2f}s {outcome}", flush=True)
    print(f"{len(chosen)} queries, {bad} bad")
    sys.exit(bad > 0)


if __name__ == "__main__":
    main()
