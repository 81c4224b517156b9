"""Message stream to the raw table: drain what is there, then stop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlake.config import PipelineConfig
from eventlake.plans.bronze import to_bronze
from eventlake.session import work_dir
from eventlake.sources import catalog
from eventlake.sources.messages import message_stream


def checkpoint_path(spark: SparkSession, cfg: PipelineConfig, query: str) -> str:
    return f"{(cfg.checkpoint_dir or work_dir(spark) + '/streams').rstrip('/')}/{query}"


def start_bronze(
    spark: SparkSession, cfg: PipelineConfig, extra: Sequence[Column] = ()
) -> StreamingQuery:
    """Append all unread messages to the raw table in batches of limited size.

    The checkpoint holds the position, so a restart neither loses nor repeats messages.
    ``extra`` columns are added to the table on first use.
    """
    table = cfg.raw_events
    bronze = to_bronze(message_stream(spark, cfg))
    if extra:
        known = bronze.columns
        bronze = bronze.select("*", *extra)
        # Nullable in the files, so that they can be read together with files without it.
        nullable = {
            c: F.when(F.col(c).isNotNull(), F.col(c)) for c in bronze.columns if c not in known
        }
        bronze = bronze.withColumns(nullable)
    if table.provider != "delta" and catalog.exists(spark, table):
        catalog.add_missing_columns(spark, table, bronze)
    writer = (
        bronze.writeStream.format(table.provider)
        .outputMode("append")
        .option("checkpointLocation", checkpoint_path(spark, cfg, table.name))
        .option("mergeSchema", "true")
        .partitionBy(*table.partition_by)
        .trigger(availableNow=True)
    )
    if table.path:
        writer = writer.option("path", table.path)
    return writer.toTable(table.name)
