"""One entry per operator: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads whole tables. Entries that write do so in a new folder and return what a reader
of the written table sees.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from checks import inputs
from eventlake import ingest_archive, run_all, run_bronze, run_gold, run_hours, run_silver, schemas
from eventlake.config import Topics
from eventlake.operators import compaction, dedupe, incremental, merge, quality, ranking, routing
from eventlake.plans import bronze as bronze_plan
from eventlake.plans import gold, silver
from eventlake.plans.run import load_daily, load_fact
from eventlake.session import fresh_dir, use_utc
from eventlake.sources import archive, catalog
from eventlake.streaming import start_silver

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Times without a zone and dates as text, so that clients agree on the values."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz").alias(field.name)
        elif isinstance(field.dataType, DateType):
            column = column.cast("string").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return portable(f(spark, sf_dir))

    run.__doc__ = f.__doc__
    run.__name__ = f.__name__
    QUERIES[f.__name__] = run
    return f


def _kept(rows: DataFrame) -> DataFrame:
    """Rows of a view or table whose schema is dropped afterwards."""
    folder = fresh_dir(rows.sparkSession, "check-rows")
    rows.write.parquet(folder)
    return rows.sparkSession.read.parquet(folder)


# ------------------------------------------------------------------- archive, messages


@query
def archive_read(spark, sf_dir):
    """Archive files written and read back: events only, with key and type."""
    folder = fresh_dir(spark, "check-archive")
    lines = inputs.archive_lines(spark, sf_dir)
    lines.write.option("compression", "gzip").text(folder)
    parsed = archive.parse_lines(archive.read_archive(spark, folder))
    return routing.keyed_messages(parsed).select("key", "type", "value")


@query
def archive_hour_filter(spark, sf_dir):
    """The events of one hour."""
    events = archive.in_hour(inputs.table(spark, sf_dir, "events"), "ts", "2024-01-15", 12)
    return inputs.as_silver(events).select("event_id", "event_type", "event_timestamp")


@query
def archive_hour_files(spark, sf_dir):
    """The events in the archive files of a day and a half, picked by name."""
    paths = archive.archive_paths(
        inputs.archive_files(spark, sf_dir), datetime(2024, 1, 14, 12), datetime(2024, 1, 15, 23)
    )
    events = archive.parse_lines(archive.read_archive(spark, paths)).where("is_event")
    return events.select(F.col("id").alias("event_id"), "type", "created_at")


@query
def limit_n(spark, sf_dir):
    """The first 500 events: the row cap of a smoke run."""
    events = inputs.silver(spark, sf_dir).select("event_id", "event_type", "event_timestamp")
    return ranking.first_n(events, 500, ["event_timestamp", "event_id"])


@query
def keyed_messages(spark, sf_dir):
    """Key, value and type of each event; events without an id share one key."""
    lines = archive.parse_lines(inputs.archive_lines(spark, sf_dir, dirty=True))
    return routing.keyed_messages(lines)


@query
def route_topics(spark, sf_dir):
    """Messages per topic after the fan-out."""
    lines = archive.parse_lines(inputs.archive_lines(spark, sf_dir, dirty=True))
    routed = routing.route(routing.keyed_messages(lines), Topics())
    return routed.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


@query
def delivery_reconcile(spark, sf_dir):
    """Lines in, messages they call for, messages in the log, and how many of them are missing."""
    folder = fresh_dir(spark, "check-delivery")
    lines = inputs.archive_lines(spark, sf_dir, dirty=True)
    lines.write.option("compression", "gzip").text(folder)
    with inputs.lake(spark, "delivery") as cfg:
        counts = ingest_archive(spark, cfg, folder)
        is_raw = F.col("topic") == cfg.topics.raw
        log = spark.read.parquet(cfg.landing).agg(
            F.count_if(is_raw).alias("raw_messages"), F.count_if(~is_raw).alias("routed_messages")
        )
    given = ("source_lines", "malformed_lines", "expected_messages")
    return log.select(
        *[F.lit(counts[c]).cast("long").alias(c) for c in given],
        "raw_messages",
        "routed_messages",
        (F.lit(counts["expected_messages"]) - F.col("raw_messages") - F.col("routed_messages")).alias("missing"),
    )


# --------------------------------------------------------------------------------- raw


@query
def bronze_project(spark, sf_dir):
    """Messages to raw rows."""
    return inputs.bronze(spark, sf_dir)


@query
def bronze_summary(spark, sf_dir):
    return bronze_plan.bronze_summary(inputs.bronze(spark, sf_dir))


BRONZE_COLUMNS = (
    "event_id",
    "raw_json",
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
    "kafka_timestamp",
)


@query
def bronze_stream(spark, sf_dir):
    """The raw table after the message stream was drained."""
    with inputs.lake(spark, "bronze_stream") as cfg:
        inputs.land(inputs.messages(spark, sf_dir), cfg, "b-1")
        run_bronze(spark, cfg)
        return inputs.stored(spark, cfg.raw_events).select(*BRONZE_COLUMNS)


@query
def bronze_stream_batches(spark, sf_dir):
    """A drain in at most four batches of limited size: were there as many as the limit
    implies, and did all rows arrive?"""
    with inputs.lake(spark, "bronze_batches") as cfg:
        inputs.land(inputs.messages(spark, sf_dir), cfg, "b-1")
        files = len(spark.read.parquet(cfg.landing).inputFiles())
        limit = math.ceil(files / 4)
        run_bronze(spark, replace(cfg, max_files_per_trigger=limit))
        rows = inputs.stored(spark, cfg.raw_events)
        batches = rows.groupBy("ingested_at").agg(F.count(F.lit(1)).alias("n"))
        return batches.agg(
            (F.count(F.lit(1)) == math.ceil(files / limit)).alias("limit_held"),
            F.sum("n").alias("n_rows"),
        )


@query
def bronze_rerun_idempotent(spark, sf_dir):
    """Rows after a drain, and after a second one with nothing new."""
    with inputs.lake(spark, "bronze_rerun") as cfg:
        inputs.land(inputs.messages(spark, sf_dir), cfg, "b-1")
        first = run_bronze(spark, cfg).first()["rows"]
        run_bronze(spark, cfg)
        second = inputs.stored(spark, cfg.raw_events).agg(F.count(F.lit(1)).alias("second_run"))
        return second.select(F.lit(first).alias("first_run"), "second_run")


@query
def bronze_schema_evolution(spark, sf_dir):
    """A second load brings a new column; earlier rows read as NULL there."""
    with inputs.lake(spark, "bronze_evolution") as cfg:
        sent = inputs.messages(spark, sf_dir)
        inputs.land(sent.where(F.col("timestamp") <= inputs.cut()), cfg, "b-1")
        run_bronze(spark, cfg)
        inputs.land(sent.where(F.col("timestamp") > inputs.cut()), cfg, "b-2")
        run_bronze(spark, cfg, extra=[F.lit("second load").alias("origin")])
        rows = spark.read.option("mergeSchema", "true").parquet(cfg.raw_events.path)
        return rows.groupBy("origin").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------------------- clean


@query
def lookback_filter(spark, sf_dir):
    """Rows ingested since the day before the run date."""
    recent = silver.in_lookback(inputs.bronze(spark, sf_dir), "2024-01-20", 1)
    return recent.select("event_id", "ingested_at", "ingestion_date")


@query
def silver_parse(spark, sf_dir):
    """JSON to the flat columns, with date and hour."""
    return silver.with_event_date(silver.parse_events(inputs.bronze(spark, sf_dir)))


@query
def silver_clean(spark, sf_dir):
    """The same without events that lack an id or a type."""
    parsed = silver.parse_events(inputs.bronze(spark, sf_dir, dirty=True))
    return silver.with_event_date(silver.drop_malformed(parsed))


@query
def silver_dedupe(spark, sf_dir):
    """Each event once, the first arrival, from a log in which all ``WatchEvent`` messages
    were sent again a day later under another name."""
    raw = inputs.bronze(spark, sf_dir)
    again = raw.where(F.get_json_object("raw_json", "$.type") == "WatchEvent").withColumns(
        {
            "raw_json": F.replace("raw_json", F.lit("user_"), F.lit("renamed_")),
            "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY"),
        }
    )
    return silver.clean_events(raw.unionByName(again))


@query
def dedupe_by_key(spark, sf_dir):
    """One line item per order and line number, the smallest by all other columns."""
    items = inputs.table(spark, sf_dir, "lineitem")
    return dedupe.first_per_key(items, ["l_orderkey", "l_linenumber"])


@query
def silver_view(spark, sf_dir):
    """The staging view of the clean table, as a reader of the view sees it."""
    with inputs.lake(spark, "silver_view") as cfg:
        merge.create(inputs.silver(spark, sf_dir), cfg.events)
        return _kept(catalog.create_silver_view(spark, cfg))


def _runs_over_dates(spark, raw: DataFrame, label: str, **settings) -> DataFrame:
    """The view of the clean table after a load from a raw table of many ingestion dates."""
    with inputs.lake(spark, label) as cfg:
        merge.create(raw, cfg.raw_events)
        cfg = replace(cfg, **settings)
        run_silver(spark, cfg)
        return _kept(spark.table(cfg.silver_view))


@query
def silver_run_date(spark, sf_dir):
    """A clean load with a run date and a lookback of three days."""
    raw = inputs.bronze(spark, sf_dir)
    return _runs_over_dates(spark, raw, "run_date", run_date="2024-01-20", lookback_days=3)


@query
def silver_today(spark, sf_dir):
    """A clean load without a run date looks back from today: rows ingested today and on the three days
    before, of which it takes two days."""
    days = F.make_interval(days=F.pmod(F.col("event_id").cast("long"), F.lit(4)).cast("int"))
    raw = inputs.bronze(spark, sf_dir).withColumn("ingested_at", F.current_timestamp() - days)
    raw = raw.withColumn("ingestion_date", F.to_date("ingested_at"))
    return _runs_over_dates(spark, raw, "today").drop("ingested_at")


@query
def silver_create(spark, sf_dir):
    """The clean table created from raw rows, partitioned by date and type."""
    with inputs.lake(spark, "silver_create") as cfg:
        silver.load_silver(spark, cfg, inputs.bronze(spark, sf_dir))
        return inputs.stored(spark, cfg.events).select(*inputs.SILVER_COLUMNS)


@query
def silver_rejects_kept(spark, sf_dir):
    """Copies that break a rule arrive first: the good copy is stored, and an event without one is
    kept apart with its text."""
    raw = inputs.bronze(spark, sf_dir)
    broken = F.regexp_replace("raw_json", '"created_at":"[^"]*"', '"created_at":"unknown"')
    earlier = F.col("ingested_at") - F.expr("INTERVAL 1 DAY")
    bad = raw.withColumns({"raw_json": broken, "ingested_at": earlier})
    bad = bad.where("kafka_offset % 3 = 0")
    good = raw.where("kafka_offset % 6 != 0")
    with inputs.lake(spark, "rejects") as cfg:
        silver.load_silver(spark, cfg, good.unionByName(bad), mode="warn")
        events, rejects = inputs.stored(spark, cfg.events), inputs.stored(spark, cfg.rejects)
    stored = events.select("event_id", F.lit("stored").alias("place"), F.lit(None).cast("string").alias("raw_json"))
    return stored.unionByName(rejects.select("event_id", F.lit("rejected").alias("place"), "raw_json"))


@query
def silver_foreach_batch(spark, sf_dir):
    """The clean table filled from the raw stream in two drains; the second sends
    everything again."""
    with inputs.lake(spark, "silver_stream") as cfg:
        sent = inputs.messages(spark, sf_dir)
        inputs.land(sent.where(F.col("timestamp") <= inputs.cut()), cfg, "b-1")
        run_bronze(spark, cfg)
        start_silver(spark, cfg).awaitTermination()
        inputs.land(sent, cfg, "b-2")
        run_bronze(spark, cfg)
        start_silver(spark, cfg).awaitTermination()
        return inputs.stored(spark, cfg.events).drop("ingested_at")


@query
def compact_partitions(spark, sf_dir):
    """Rows per partition of a table written in pieces and then compacted, and whether it
    has fewer files than before."""
    with inputs.lake(spark, "compact") as cfg:
        facts = gold.fact_events(inputs.silver(spark, sf_dir))
        for hours in ("event_hour < 8", "event_hour between 8 and 15", "event_hour > 15"):
            merge.append(spark, facts.where(hours), cfg.fact_events)
        before = compaction.file_stats(spark, cfg.fact_events).agg(F.sum("files")).first()[0]
        compaction.compact(spark, cfg.fact_events, min_files=1)
        after = compaction.file_stats(spark, cfg.fact_events).agg(F.sum("files")).first()[0]
        rows = inputs.stored(spark, cfg.fact_events).groupBy("event_date")
        return rows.agg(
            F.count(F.lit(1)).alias("n_rows"), F.lit(after < before).alias("fewer_files")
        )


# -------------------------------------------------------------------------- star schema


@query
def events_by_type(spark, sf_dir):
    return gold.events_by_type(inputs.silver(spark, sf_dir))


@query
def dim_repos(spark, sf_dir):
    return gold.dim_repos(inputs.silver(spark, sf_dir))


@query
def dim_users(spark, sf_dir):
    return gold.dim_users(inputs.silver(spark, sf_dir))


@query
def dim_repos_latest_name(spark, sf_dir):
    """One row per repository when its name contains the day it was last seen."""
    events = inputs.silver(spark, sf_dir).withColumn(
        "repo_name", F.concat_ws("_", "repo_name", "event_date")
    )
    return gold.dim_repos(events, latest_name=True)


@query
def fact_events(spark, sf_dir):
    return gold.fact_events(inputs.silver(spark, sf_dir))


@query
def agg_daily_activity(spark, sf_dir):
    return gold.agg_daily_activity(inputs.silver(spark, sf_dir))


@query
def top_repos_topk(spark, sf_dir):
    """The 20 repositories with the most stars."""
    return gold.top_repos(gold.stars_per_repo(inputs.silver(spark, sf_dir), inputs.STAR_TYPE))


@query
def stars_from_daily(spark, sf_dir):
    """Stars per repository from the daily aggregate."""
    daily = gold.agg_daily_activity(inputs.silver(spark, sf_dir))
    return gold.stars_from_daily(daily, inputs.STAR_TYPE)


@query
def star_join(spark, sf_dir):
    """Events per login: the fact joined to the user dimension."""
    events = inputs.silver(spark, sf_dir)
    return gold.events_per_user(gold.fact_events(events), gold.dim_users(events, True))


@query
def gold_overwrite(spark, sf_dir):
    """A dimension built from the earlier rows and then overwritten from all."""
    with inputs.lake(spark, "gold_overwrite") as cfg:
        events = inputs.silver(spark, sf_dir)
        merge.overwrite(gold.dim_repos(_old(events)), cfg.dim_repos)
        merge.overwrite(gold.dim_repos(events), cfg.dim_repos)
        return inputs.stored(spark, cfg.dim_repos)


# -------------------------------------------------------------------------- incremental


def _old(events: DataFrame) -> DataFrame:
    return events.where(F.col("ingested_at") <= inputs.cut())


def _new(events: DataFrame) -> DataFrame:
    return events.where(F.col("ingested_at") > inputs.cut())


@query
def affected_dates(spark, sf_dir):
    return incremental.affected_dates(_new(inputs.silver(spark, sf_dir)))


@query
def incremental_highwater(spark, sf_dir):
    """Events later than everything in a fact of the earlier rows."""
    events = inputs.silver(spark, sf_dir)
    fact = gold.fact_events(_old(events))
    return incremental.newer_than(gold.fact_events(events), fact)


@query
def incremental_affected_dates(spark, sf_dir):
    """All events of the dates that have new ones."""
    events = inputs.silver(spark, sf_dir)
    new = incremental.newer_than(events, gold.fact_events(_old(events)))
    return incremental.on_dates(gold.fact_events(events), incremental.affected_dates(new))


def _daily_in_two_loads(spark, sf_dir, first: DataFrame, mode: str, label: str) -> DataFrame:
    with inputs.lake(spark, label) as cfg:
        load_daily(spark, cfg, first, mode)
        load_daily(spark, cfg, inputs.silver(spark, sf_dir), mode)
        return inputs.stored(spark, cfg.agg_daily_activity)


@query
def agg_daily_incremental(spark, sf_dir):
    """The daily aggregate of the earlier rows, brought up to date by high-water mark."""
    first = _old(inputs.silver(spark, sf_dir))
    return _daily_in_two_loads(spark, sf_dir, first, "strict", "agg_daily")


@query
def late_event_recompute(spark, sf_dir):
    """The daily aggregate when errors arrive late for days already aggregated."""
    first = inputs.silver(spark, sf_dir).where("event_type != 'error'")
    return _daily_in_two_loads(spark, sf_dir, first, "safe", "agg_late")


def _fact_in_two_loads(spark, sf_dir, first: DataFrame, mode: str, label: str) -> DataFrame:
    with inputs.lake(spark, label) as cfg:
        load_fact(spark, cfg, first, mode)
        load_fact(spark, cfg, inputs.silver(spark, sf_dir), mode)
        return inputs.stored(spark, cfg.fact_events)


@query
def fact_incremental_strict(spark, sf_dir):
    """The fact of the earlier rows, upserted with those after its high-water mark."""
    first = _old(inputs.silver(spark, sf_dir))
    return _fact_in_two_loads(spark, sf_dir, first, "strict", "fact_strict")


@query
def fact_incremental_safe(spark, sf_dir):
    """The fact when errors reach the clean table after later events did."""
    first = inputs.silver(spark, sf_dir).where("event_type != 'error'")
    return _fact_in_two_loads(spark, sf_dir, first, "safe", "fact_safe")


def _gold_in_two_loads(spark, sf_dir, label: str):
    """The star schema after a load of the earlier events and one of the others, which opens the files
    of their dates only."""
    events = inputs.silver(spark, sf_dir)
    with inputs.lake(spark, label) as cfg:
        for load in (_old(events), events.where(F.col("ingested_at") > inputs.cut())):
            merge.append(spark, load, cfg.events)
            merge.append(spark, incremental.affected_dates(load), cfg.changed_dates)
            run_gold(spark, cfg, dates="changed", rules="fail")
        return cfg


@query
def dims_incremental(spark, sf_dir):
    """The repositories after two loads, the second counted from its new combinations."""
    return inputs.stored(spark, _gold_in_two_loads(spark, sf_dir, "dims").dim_repos)


@query
def users_incremental(spark, sf_dir):
    """The same for the users."""
    return inputs.stored(spark, _gold_in_two_loads(spark, sf_dir, "users").dim_users)


@query
def gold_changed_dates(spark, sf_dir):
    """The daily aggregate after two loads that look at changed dates only."""
    return inputs.stored(spark, _gold_in_two_loads(spark, sf_dir, "changed").agg_daily_activity)


# -------------------------------------------------------------------------------- merges


def _overlapping_loads(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """A target up to the 20th and a source from the 10th on. The source has another type,
    and its purchases are dated a day later."""
    facts = gold.fact_events(inputs.silver(spark, sf_dir)).drop("is_public")
    target = facts.where("event_timestamp < TIMESTAMP '2024-01-20 00:00:00'")
    moved = F.col("event_type") == "purchase"
    source = facts.where("event_timestamp >= TIMESTAMP '2024-01-10 00:00:00'").withColumns(
        {
            "event_type": F.concat(F.lit("new_"), F.col("event_type")),
            "event_date": F.when(moved, F.date_add("event_date", 1)).otherwise(
                F.col("event_date")
            ),
        }
    )
    return target, source


@query
def merge_insert_only(spark, sf_dir):
    """Both loads, the first write of an event kept."""
    return merge.merge_insert_only(*_overlapping_loads(spark, sf_dir), "event_id")


@query
def merge_upsert(spark, sf_dir):
    """Both loads, the last write of an event kept."""
    return merge.merge_upsert(*_overlapping_loads(spark, sf_dir), "event_id")


@query
def merge_insert_only_table(spark, sf_dir):
    with inputs.lake(spark, "insert_only") as cfg:
        for load in (*_overlapping_loads(spark, sf_dir), *_overlapping_loads(spark, sf_dir)):
            merge.insert_only(spark, load, cfg.fact_events)
        return inputs.stored(spark, cfg.fact_events)


@query
def merge_upsert_table(spark, sf_dir):
    """The upsert on a stored table, where events change their partition."""
    with inputs.lake(spark, "upsert") as cfg:
        for load in _overlapping_loads(spark, sf_dir):
            merge.upsert(spark, load, cfg.fact_events)
        return inputs.stored(spark, cfg.fact_events)


def _daily_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date", "event_type").agg(F.count("event_id").alias("n"))


def _corrected_days(counts: DataFrame) -> DataFrame:
    days = F.col("event_date").between("2024-01-10", "2024-01-12")
    return counts.where(days).withColumn("n", F.col("n") * 10)


@query
def insert_overwrite_partitions(spark, sf_dir):
    """Daily counts with three days replaced."""
    counts = _daily_counts(inputs.silver(spark, sf_dir))
    return merge.overwrite_partitions(counts, _corrected_days(counts), "event_date")


@query
def insert_overwrite_table(spark, sf_dir):
    """The same on a stored table that is read and written at once."""
    with inputs.lake(spark, "replace") as cfg:
        t = cfg.agg_daily_activity
        merge.create(_daily_counts(inputs.silver(spark, sf_dir)), t)
        merge.replace_partitions(spark, _corrected_days(spark.table(t.name)), t)
        return inputs.stored(spark, t)


# ------------------------------------------------------------------------- data quality


@query
def dq_not_null(spark, sf_dir):
    """NULLs per column, in one scan."""
    events = silver.parse_events(inputs.bronze(spark, sf_dir, dirty=True))
    return quality.null_counts(
        events, ["event_id", "event_type", "actor_id", "repo_id", "org_login", "event_timestamp"]
    )


@query
def dq_unique(spark, sf_dir):
    """Repeated order and line numbers with their counts."""
    items = inputs.table(spark, sf_dir, "lineitem")
    return quality.duplicate_keys(items, ["l_orderkey", "l_linenumber"])


@query
def dq_check_constraint(spark, sf_dir):
    """Orders that violate a lower bound on their date."""
    orders = inputs.table(spark, sf_dir, "orders")
    rule = quality.Check("o_orderdate", "o_orderdate > TIMESTAMP_NTZ '2000-01-01 00:00:00'")
    return quality.check_count(orders, rule)


@query
def dq_schema(spark, sf_dir):
    """A stored raw table whose files lack a column, have one more, and one of another type."""
    raw = inputs.bronze(spark, sf_dir).drop("kafka_timestamp")
    raw = raw.withColumn("kafka_partition", F.col("kafka_partition").cast("long"))
    folder = fresh_dir(spark, "check-drift")
    raw.withColumn("origin", F.when(F.col("kafka_offset") < 100, "early")).write.parquet(folder)
    return quality.schema_drift(spark.read.parquet(folder), schemas.BRONZE)


@query
def dq_audit(spark, sf_dir):
    """All kinds of rules on line items at once."""
    return quality.audit(
        inputs.table(spark, sf_dir, "lineitem"),
        [
            quality.NotNull("l_orderkey"),
            quality.NotNull("l_shipdate"),
            quality.Check("small", "l_quantity < 40"),
            quality.Unique("l_orderkey"),
            quality.Unique("l_partkey"),
        ],
    )


# -------------------------------------------------------------------------- end to end


def archive_to_star_schema(spark: SparkSession, sf_dir: str, label: str):
    """Archive files through every stage; returns the configuration of the tables."""
    folder = fresh_dir(spark, "check-archive")
    inputs.archive_lines(spark, sf_dir).write.option("compression", "gzip").text(folder)
    with inputs.lake(spark, label) as cfg:
        ingest_archive(spark, cfg, folder)
        run_bronze(spark, cfg)
        run_silver(spark, cfg)
        run_gold(spark, cfg, rules="fail")
        return cfg


@query
def archive_to_gold(spark, sf_dir):
    """The daily aggregate after one run over all stages."""
    cfg = archive_to_star_schema(spark, sf_dir, "end_to_end")
    return inputs.stored(spark, cfg.agg_daily_activity).drop("ingested_at")


@query
def hourly_run(spark, sf_dir):
    """What one run over all stages shows for the hour it is given: the repositories with the most stars."""
    folder = inputs.archive_files(spark, sf_dir)
    with inputs.lake(spark, "one_hour") as cfg:
        return _kept(run_all(spark, cfg, folder, "2024-01-15", 12))


@query
def hourly_run_limited(spark, sf_dir):
    """The fact after a run that takes the first 50 events of an hour, and then one that takes all."""
    folder = inputs.archive_files(spark, sf_dir)
    with inputs.lake(spark, "limited_hour") as cfg:
        facts = []
        for limit in (50, None):
            run_all(spark, cfg, folder, "2024-01-15", 12, limit)
            rows = catalog.read(spark, cfg.fact_events).drop("ingested_at")
            facts.append(_kept(rows.withColumn("row_limit", F.lit(limit).cast("int"))))
        return facts[0].unionByName(facts[1])


@query
def hours_to_gold(spark, sf_dir):
    """The daily aggregate after ten days caught up in one run over their hours."""
    folder = inputs.archive_files(spark, sf_dir)
    with inputs.lake(spark, "ten_days") as cfg:
        run_hours(spark, cfg, folder, datetime(2024, 1, 10), datetime(2024, 1, 19, 23))
        return inputs.stored(spark, cfg.agg_daily_activity).drop("ingested_at")


def hours_on_history(spark: SparkSession, sf_dir: str, first: str, time) -> float:
    """The time of one hour, from archive file to star schema, on top of the stored events since ``first``."""
    folder = fresh_dir(spark, "check-hour")
    last = F.lit("2024-01-30 12:00:00").cast("timestamp")
    lines = inputs.archive_lines(spark, sf_dir)
    at = F.to_timestamp(F.get_json_object("value", "$.created_at"))
    parts = {"history": (at >= F.lit(first).cast("timestamp")) & (at < last)}
    parts["hour"] = (at >= last) & (at < last + F.expr("INTERVAL 1 HOUR"))
    for name, rows in parts.items():
        lines.where(rows).write.option("compression", "gzip").text(f"{folder}/{name}")

    def load(cfg, name):
        ingest_archive(spark, cfg, f"{folder}/{name}")
        run_bronze(spark, cfg)
        run_silver(spark, cfg, stream=True)
        run_gold(spark, cfg, dates="changed", rules="fail")

    with inputs.lake(spark, "hour") as cfg:
        load(cfg, "history")
        return time(lambda: load(cfg, "hour"))
