"""Run every registered query beside its SQL: python tests/check_oracle.py [sf_dir] [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from pairclf.session import build_session  # noqa: E402


SQL_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def compare(spark, connection, sf_dir: str, name: str) -> str | None:
    """None when both sides hold the same rows, else what differs."""
    frame = entry.queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    ours = sorted(map(repr, (tuple(row[c] for c in columns) for row in frame.collect())))
    result = connection.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} and {sorted(names)}"
    types = {field.name: SQL_TYPES[field.dataType.simpleString()] for field in frame.schema}
    other = {d[0]: str(d[1]) for d in result.description}
    if types != other:
        return f"types {types} and {other}"
    order = [names.index(c) for c in columns]
    theirs = sorted(repr(tuple(row[i] for i in order)) for row in result.fetchall())
    if ours != theirs:
        different = [pair for pair in zip(ours, theirs) if pair[0] != pair[1]][:2]
        return f"{len(ours)} and {len(theirs)} rows, first differences {different}"
    return None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        difference = compare(spark, connection, sf_dir, name)
        failed += difference is not None
        print(f"{'ok  ' if difference is None else 'DIFF'} {name} {time.time() - start:.1f}s {difference or ''}", flush=True)
    print(f"{failed} of {len(sys.argv[2:] or entry.queries())} differ")


if __name__ == "__main__":
    main()
