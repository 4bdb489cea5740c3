"""Compare every registered query with its SQL: ``python tests/parity.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([row[i] for i in order]) for row in rows)


def differences(spark, con, sf_dir: str, name: str) -> list[str]:
    """What differs between the two results; empty when they agree."""
    df = contract.queries()[name](spark, sf_dir)
    sql = con.execute(contract.oracle_sql()[name])
    sql_columns = [c[0] for c in sql.description]
    if sorted(df.columns) != sorted(sql_columns):
        return [f"columns {sorted(df.columns)} / {sorted(sql_columns)}"]
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(sql_columns, sql.fetchall())
    found = [f"rows {len(ours)} / {len(theirs)}"] if len(ours) != len(theirs) else []
    found += [f"{a} / {b}" for a, b in zip(ours, theirs) if a != b][:3]
    return found


def main() -> int:
    from pyspark.sql import SparkSession

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = oracle(sf_dir), 0
    for name in args or contract.queries():
        began = time.time()
        if name not in contract.oracle_sql():
            print(f"{name}: no SQL")
            continue
        found = differences(spark, con, sf_dir, name)
        bad += bool(found)
        print(f"{name}: {'ok' if not found else found} ({time.time() - began:.1f} s)", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
