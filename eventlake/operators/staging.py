"""Intermediate results as stored tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from eventlake.config import Table
from eventlake.session import delete, fresh_dir

_open: list[list[str]] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """A run: what is staged in it is deleted when it ends."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            delete(spark, path)


def stage(spark: SparkSession, df: DataFrame, table: Table) -> DataFrame:
    """Store rows bound for a table in the shared folder and read them back.

    What follows then starts from files: nothing is computed twice, the planner knows the
    real size, and a lost executor costs no recomputation.
    """
    path = fresh_dir(spark, f"stage/{table.name}")
    if _open:
        _open[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
