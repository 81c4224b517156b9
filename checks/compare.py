"""Run queries and their DuckDB statements on one data folder and compare the rows.

    python -m checks.compare [--sf-dir DIR] [--cpus N] [query ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES
from eventlake import build_session


def _plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, datetime | date):
        return value.isoformat()
    return value


def spark_rows(df: DataFrame) -> Counter:
    columns = sorted(df.columns)
    return Counter(tuple(_plain(v) for v in r) for r in df.select(*columns).collect())


def duckdb_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def duckdb_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(_plain(r[i]) for i in order) for r in result.fetchall())
    return sorted(names), rows


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """What differs, or None."""
    df = QUERIES[name](spark, sf_dir)
    got = spark_rows(df)
    if name not in ORACLES:
        return None if got else "no rows"
    columns, expected = duckdb_rows(con, ORACLES[name])
    if sorted(df.columns) != columns:
        return f"columns {sorted(df.columns)} != {columns}"
    if got != expected:
        extra, missing = got - expected, expected - got
        return (
            f"rows {got.total()} != {expected.total()}; "
            f"extra {list(extra)[:2]}, missing {list(missing)[:2]}"
        )
    return None


def main() -> int:
    p = argparse.ArgumentParser()
    p.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    p.add_argument("--cpus", default="8")
    p.add_argument("names", nargs="*")
    args = p.parse_args()
    spark = build_session(
        "checks", f"local[{args.cpus}]", **{"spark.sql.shuffle.partitions": args.cpus}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_connection(args.sf_dir)
    failures = 0
    for name in args.names or QUERIES:
        start = time.time()
        problem = compare(spark, con, args.sf_dir, name)
        failures += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    spark.stop()
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
