"""The raw table as a stream into the clean table, instead of the lookback batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from eventlake.config import PipelineConfig
from eventlake.plans.silver import load_silver
from eventlake.sources.messages import file_read_options
from eventlake.streaming.bronze import checkpoint_path


def start_silver(
    spark: SparkSession,
    cfg: PipelineConfig,
    mode: str = "fail",
    fixed_partitions: bool = False,
    loaded: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Clean each new part of the raw table and insert the events not there yet.

    A batch that is run again after a failure finds its rows present and adds nothing. A
    batch with events that break a rule stops the stream once, after its good events and its
    rejects are stored; the next run goes on. With ``mode="warn"`` it logs instead.
    ``loaded`` is called with each cleaned batch.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        increment = load_silver(batch.sparkSession, cfg, batch, mode, fixed_partitions)
        if loaded is not None:
            loaded(increment)

    options = file_read_options(cfg) if cfg.raw_events.provider == "parquet" else {}
    raw = spark.readStream.options(**options).table(cfg.raw_events.name)
    return (
        raw.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint_path(spark, cfg, cfg.events.name))
        .trigger(availableNow=True)
        .start()
    )
