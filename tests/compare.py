"""Compare a Spark query with its SQL oracle as multisets of rows."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

# Spark type name -> DuckDB type name of a matching column.
TYPES = {
    "string": "VARCHAR",
    "double": "DOUBLE",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def differences(spark_df, connection, sql: str) -> list[str]:
    """Empty if names, types and rows agree exactly."""
    described = {row[0]: str(row[1]) for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    expected = {name: TYPES.get(kind, kind) for name, kind in spark_df.dtypes}
    problems = []
    if described != expected:
        problems.append(f"schema: {sorted(set(expected.items()) ^ set(described.items()))}")
    names = sorted(set(described) & set(expected))
    mine = Counter(tuple(row) for row in spark_df.select(*names).collect())
    listed = ", ".join(names)
    oracle = Counter(
        tuple(row) for row in connection.execute(f"SELECT {listed} FROM ({sql})").fetchall()
    )
    if mine != oracle:
        extra, missing = mine - oracle, oracle - mine
        problems.append(
            f"rows: {sum(mine.values())} vs {sum(oracle.values())}, {sum(extra.values())} extra,"
            f" {sum(missing.values())} missing {names}\n  {sorted(map(str, extra))[:2]}\n"
            f"  {sorted(map(str, missing))[:2]}"
        )
    return problems


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    from __spark_entry__ import oracle_sql, queries

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    duck, oracles, failed = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = run(session, sf_dir)
            if name in oracles:
                problems = differences(df, duck, oracles[name])
            else:
                rows = df.limit(3).collect()
                problems = [] if rows else ["no rows"]
                print("   ", rows)
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - started:.1f}s", flush=True)
        for problem in problems:
            print("   ", problem)
    print(f"{failed} failed")
