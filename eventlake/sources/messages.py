"""The keyed message log between archive and raw table: Kafka, or Parquet files.

Both have the same six columns, so everything downstream is the same for either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.config import PipelineConfig
from eventlake.session import setting


def kafka_read_options(cfg: PipelineConfig) -> dict[str, str]:
    options = {
        **cfg.kafka_options,
        "subscribe": cfg.topics.raw,
        "startingOffsets": cfg.starting_offsets,
        "failOnDataLoss": str(cfg.fail_on_data_loss).lower(),
    }
    if cfg.max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(cfg.max_offsets_per_trigger)
    if cfg.min_partitions:
        options["minPartitions"] = str(cfg.min_partitions)
    return options


def file_read_options(cfg: PipelineConfig) -> dict[str, str]:
    # Files count as unread however old they are; by default a stream skips files much
    # older than the newest one. With a retention, read files are deleted and forgotten after it.
    options = {"maxFileAge": cfg.retention or "36500d"}
    if cfg.max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(cfg.max_files_per_trigger)
    if cfg.max_bytes_per_trigger:
        options["maxBytesPerTrigger"] = cfg.max_bytes_per_trigger
    return options


def message_stream(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Stream of the raw topic, oldest first, in batches of limited size."""
    if cfg.message_source == "kafka":
        return spark.readStream.format("kafka").options(**kafka_read_options(cfg)).load()
    # Only the raw topic's folder is listed; the others have no reader here.
    return (
        spark.readStream.schema(schemas.LANDED)
        .options(basePath=cfg.landing, cleanSource="delete" if cfg.retention else "off", **file_read_options(cfg))
        .parquet(f"{cfg.landing}/topic={cfg.topics.raw}/batch=*")
    )


def with_positions(messages: DataFrame, partitions: int = 2) -> DataFrame:
    """Partition by key, an offset, and a send time: what a broker would add.

    The offset is the position of the message's line in the archive, so of two messages with one key
    the same comes first however many tasks have written them. Rows without a position are numbered.
    """
    offset = F.col("position") if "position" in messages.columns else F.monotonically_increasing_id()
    return messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int").alias("partition"),
        offset.alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


def _send(messages: DataFrame, cfg: PipelineConfig) -> None:
    """To the broker, which acknowledges each message; one that it refuses fails the job."""
    rows = messages.select(F.col("key").cast("binary"), F.col("value").cast("binary"), "topic")
    rows.write.format("kafka").options(**cfg.kafka_options).save()


def write_messages(messages: DataFrame, cfg: PipelineConfig, batch: str) -> dict[str, int]:
    """Append ``key, value, topic`` rows to the log; the topic is taken per row. Returns how many
    the writer was given, in all and of the raw topic, counted in the pass that writes them."""
    written = Observation("messages")
    messages = messages.observe(
        written,
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("topic") == cfg.topics.raw).alias("raw_messages"),
    )
    if cfg.message_source == "kafka":
        _send(messages, cfg)
        return written.get
    # One open file per topic spares the writer a sort of the messages.
    topics = str(1 + len(cfg.topics.by_event_type))
    with setting(messages.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", topics):
        (
            with_positions(messages)
            .withColumn("batch", F.lit(batch))
            .write.mode("append")
            .partitionBy("topic", "batch")
            .parquet(cfg.landing)
        )
    return written.get


def landed_messages(spark: SparkSession, cfg: PipelineConfig, batch: str) -> DataFrame:
    """What one call of ``write_messages`` left in the file log."""
    log = spark.read.schema(schemas.LANDED).option("basePath", cfg.landing)
    return log.parquet(f"{cfg.landing}/topic=*/batch={batch}")
