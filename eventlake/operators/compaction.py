"""Fewer, larger files for partitions that collected many small ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from eventlake.config import Table
from eventlake.operators.incremental import in_partitions
from eventlake.operators.merge import replace_partitions
from eventlake.session import setting
from eventlake.sources import catalog

TARGET_FILE_BYTES = 256 * 1024 * 1024


def file_stats(spark: SparkSession, table: Table, only: list[Row] | None = None) -> DataFrame:
    """``<partition columns>, files, bytes`` for each partition; with ``only`` no other partition is listed.
    Name and size of its file come with every row, no column is read, and the names are reduced and
    counted in tasks. A file without rows does not count."""
    rows = catalog.read(spark, table)
    if only is not None:
        rows = rows.where(in_partitions(table.partition_by, only))
    files = rows.select(*table.partition_by, "_metadata.file_path", "_metadata.file_size").distinct()
    return files.groupBy(*table.partition_by).agg(
        F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes")
    )


def crowded_partitions(
    stats: DataFrame, table: Table, min_files: int, target_bytes: int
) -> DataFrame:
    """Partitions with at least ``min_files`` files more than their size calls for."""
    needed = F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1))
    return stats.where(F.col("files") - needed >= min_files).select(*table.partition_by)


def compact(
    spark: SparkSession,
    table: Table,
    only: list[Row] | None = None,
    min_files: int = 8,
    target_bytes: int = TARGET_FILE_BYTES,
) -> list[Row]:
    """Rewrite crowded partitions, or those of ``only`` that are. Returns the partitions.

    Rows stay the same. ``min_files`` keeps a partition that receives a file every hour
    from being rewritten every hour.
    """
    if table.provider == "delta":
        spark.sql(f"OPTIMIZE {table.name}")
        return []
    by = list(table.partition_by)
    if only == []:
        return []
    current = catalog.read(spark, table)
    stats = file_stats(spark, table, only)
    # At most one entry per table partition.
    crowded = crowded_partitions(stats, table, min_files, target_bytes).collect()
    if crowded:
        rows = current.where(in_partitions(by, crowded))
        with setting(
            spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes)
        ):
            replace_partitions(spark, rows, table)
    return crowded
