"""Which partitions of a table may hold a key: the range of keys of every write to every partition.

A write adds the ranges before its rows, so a run that dies in between leaves a range too many, never
one too few. A lookup compares the ranges of a load's own partitions with them. Keys that grow with time,
as event ids do, give narrow ranges: an old key that comes back beside new ones costs its own partition and
not all history. Keys without order give ranges that overlap, and then all partitions are candidates.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from eventlake.config import Table

#: Ranges of one partition that are kept before they are joined into one.
MOST = 64


def side_table(table: Table) -> Table:
    return replace(
        table,
        name=f"{table.name}_key_ranges",
        path=f"{table.path}_key_ranges" if table.path else None,
        partition_by=(),
        key=None,
        ranged=False,
    )


def key_ranges(df: DataFrame, table: Table) -> DataFrame:
    """``<partition columns>, low, high`` of the keys in each partition."""
    return df.groupBy(*table.partition_by).agg(F.min(table.key).alias("low"), F.max(table.key).alias("high"))


def joined_ranges(ranges: DataFrame, table: Table) -> DataFrame:
    """One range for each partition."""
    return ranges.groupBy(*table.partition_by).agg(F.min("low").alias("low"), F.max("high").alias("high"))


def crowded(spark: SparkSession, table: Table, ranges: DataFrame) -> bool:
    """More than ``MOST`` ranges for each partition, on average."""
    # One row.
    n, partitions = ranges.agg(F.count(F.lit(1)), F.count_distinct(F.struct(*table.partition_by))).first()
    return n > MOST * partitions


def partitions_with(source: DataFrame, ranges: DataFrame, table: Table) -> list[Row]:
    """The partitions whose ranges meet a range of the source; at most all partitions of the table."""
    own = key_ranges(source, table).select(F.col("low").alias("first"), F.col("high").alias("last"))
    meets = (F.col("low") <= F.col("last")) & (F.col("first") <= F.col("high"))
    return ranges.join(own, meets, "left_semi").select(*table.partition_by).distinct().collect()
