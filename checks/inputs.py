"""The ``events`` test table in the shapes the jobs work on.

``props.k`` is the repository, the user is the actor, and the time is cut to seconds as in
the event JSON. ``ingested_at`` is one hour after the event, so it is the same on each run.
In JSON the types ``view``, ``click`` and ``purchase`` become the three that are routed.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.config import PipelineConfig, Table
from eventlake.plans.bronze import to_bronze
from eventlake.session import fresh_dir
from eventlake.sources import catalog

RAW_TOPIC = "events.raw"
STAR_TYPE = "view"


def cut():
    """Divides the rows of an earlier and a later load by ingestion time."""
    return F.expr("TIMESTAMP '2024-01-15 00:00:00'")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """Give a scan with fewer tasks than the cluster has cores a task per core."""
    slots = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(slots) if scan.rdd.getNumPartitions() < slots else scan


def _seconds():
    return F.date_trunc("second", F.col("ts").cast("timestamp"))


def _repo():
    return F.get_json_object("props", "$.k")


def _org():
    login = F.concat(F.lit("org_"), F.col("user_id"))
    return F.when(F.col("event_type").isin("click", "purchase"), login)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean event table, as if it had been loaded already."""
    return as_silver(table(spark, sf_dir, "events"))


def as_silver(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.col("user_id").alias("actor_id"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("actor_login"),
        _repo().cast("bigint").alias("repo_id"),
        F.concat(F.lit("repo_"), _repo()).alias("repo_name"),
        _org().alias("org_login"),
        F.lit(True).alias("is_public"),
        _seconds().alias("event_timestamp"),
        (_seconds() + F.expr("INTERVAL 1 HOUR")).alias("ingested_at"),
        F.to_date("ts").alias("event_date"),
        F.hour("ts").alias("event_hour"),
    )


def event_json(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """``event_id, event_type, value, event_timestamp, raw_json``.

    ``dirty`` events with a value below 10 have no id, and below 20 no type.
    """
    events = spread(table(spark, sf_dir, "events"))
    event_type = F.expr(
        "CASE event_type WHEN 'view' THEN 'WatchEvent' WHEN 'click' THEN 'PushEvent' "
        "WHEN 'purchase' THEN 'PullRequestEvent' ELSE event_type END"
    )
    event_id = F.col("event_id").cast("string")
    has_id = F.col("value") >= 10 if dirty else F.lit(True)
    has_type = (F.col("value") < 10) | (F.col("value") >= 20) if dirty else F.lit(True)
    org = F.when(_org().isNotNull(), F.struct(_org().alias("login")))
    body = F.struct(
        F.when(has_id, event_id).alias("id"),
        F.when(has_type, event_type).alias("type"),
        F.struct(
            F.col("user_id").alias("id"), F.concat(F.lit("user_"), F.col("user_id")).alias("login")
        ).alias("actor"),
        F.struct(
            _repo().cast("bigint").alias("id"), F.concat(F.lit("repo_"), _repo()).alias("name")
        ).alias("repo"),
        org.alias("org"),
        F.lit(True).alias("public"),
        F.date_format(_seconds(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.struct(_repo().cast("bigint").alias("k")).alias("payload"),
    )
    # A generator, so that a later filter on the text does not build it a second time.
    return events.select(
        "event_id",
        event_type.alias("event_type"),
        "value",
        _seconds().alias("event_timestamp"),
        F.explode(F.array(F.to_json(body))).alias("raw_json"),
    )


def archive_lines(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Archive lines, column ``value``: every event, and a cut-off copy of each event with
    a value below 5."""
    cut_off = F.when(F.col("value") < 5, F.expr("left(raw_json, length(raw_json) - 1)"))
    lines = F.explode(F.array_compact(F.array("raw_json", cut_off)))
    return event_json(spark, sf_dir, dirty).select(lines.alias("value"))


def messages(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """The raw topic: two partitions, offsets in the order of the ids."""
    return event_json(spark, sf_dir, dirty).select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.col("raw_json").cast("binary").alias("value"),
        F.lit(RAW_TOPIC).alias("topic"),
        F.pmod("event_id", F.lit(2)).cast("int").alias("partition"),
        F.expr("event_id div 2").alias("offset"),
        (F.col("event_timestamp") + F.expr("INTERVAL 1 HOUR")).alias("timestamp"),
    )


def bronze(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    return to_bronze(messages(spark, sf_dir, dirty), F.col("timestamp"))


def archive_files(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the archive: a gzip file for each hour, named as the archive names it. Each has a blank
    line, also where the hour has no event."""
    folder = fresh_dir(spark, "check-hours")
    events = event_json(spark, sf_dir).select("event_timestamp", "raw_json")
    first, last = (F.date_trunc("hour", f("event_timestamp")) for f in (F.min, F.max))
    hours = F.explode(F.sequence(first, last, F.expr("INTERVAL 1 HOUR")))
    blank = events.agg(hours.alias("event_timestamp")).withColumn("raw_json", F.lit(""))
    hour = F.concat(F.to_date("event_timestamp"), F.lit("-"), F.hour("event_timestamp"))
    (
        events.unionByName(blank)
        .select(hour.alias("hour"), "raw_json")
        .repartition("hour")
        .write.partitionBy("hour")
        .text(folder, compression="gzip")
    )
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    # One file a folder, as an hour is in one task.
    for file in fs.globStatus(path(f"{folder}/hour=*/part-*")):
        name = file.getPath().getParent().getName().removeprefix("hour=")
        fs.rename(file.getPath(), path(f"{folder}/{name}.json.gz"))
    return folder


@contextmanager
def lake(spark: SparkSession, label: str):
    """A configuration whose tables lie in a new folder of the shared one.

    The schemas are dropped afterwards; the files stay and are read by path.
    """
    root = fresh_dir(spark, f"check-{label}")
    tag = f"{label}_{uuid.uuid4().hex[:8]}"
    cfg = PipelineConfig(
        bronze_db=f"bronze_{tag}",
        silver_db=f"silver_{tag}",
        gold_db=f"gold_{tag}",
        warehouse=f"{root}/tables",
        checkpoint_dir=f"{root}/progress",
        landing=f"{root}/landing",
    )
    catalog.create_schemas(spark, cfg)
    try:
        yield cfg
    finally:
        for db in (cfg.bronze_db, cfg.silver_db, cfg.gold_db):
            spark.sql(f"DROP SCHEMA IF EXISTS {db} CASCADE")


def stored(spark: SparkSession, t: Table) -> DataFrame:
    return spark.read.parquet(catalog.current_folder(spark, t))


def land(df: DataFrame, cfg: PipelineConfig, batch: str) -> None:
    """Put messages that already have their positions into the file log."""
    (
        df.withColumn("batch", F.lit(batch))
        .write.mode("append")
        .partitionBy("topic", "batch")
        .parquet(cfg.landing)
    )


SILVER_COLUMNS = schemas.SILVER.fieldNames()
