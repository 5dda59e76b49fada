"""Compare Spark queries with their DuckDB statements: names, types, row counts and values."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.12g}")
    return v


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
}


def differences(spark_df, con, sql: str) -> list[str]:
    """Differences between a Spark frame and the result of a statement."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    found = [
        f"type of {n}: {t} != {types[n]}"
        for n, t in spark_df.dtypes
        if _TYPES.get(types[n], types[n]) != t
    ]
    actual = rows_of(spark_df.columns, spark_df.collect())
    if len(actual) != len(expected):
        found.append(f"rows {len(actual)} != {len(expected)}")
    elif actual != expected:
        bad = [(a, e) for a, e in zip(actual, expected) if a != e]
        found.append(f"{len(bad)} rows differ, first: {bad[0]}")
    return found


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", os.environ.get("ZONE", "UTC"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    statements = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        started = time.time()
        found = differences(query(spark, sf_dir), con, statements[name])
        bad += bool(found)
        print(f"{name}: {'; '.join(found) or 'ok'} ({time.time() - started:.1f}s)", flush=True)
    print(f"{bad} of {len(statements)} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
