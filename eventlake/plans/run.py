"""One run of each stage, in the order archive, raw, clean, star schema.

An hourly scheduler calls ``run_all``; every function can be repeated after a failure.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import replace
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from eventlake.config import PipelineConfig, Table
from eventlake.operators import compaction, incremental, merge, quality
from eventlake.operators.ranking import first_n
from eventlake.operators.routing import expected_messages, keyed_messages, route
from eventlake.operators.merge import rebuild
from eventlake.operators.staging import stage, staging
from eventlake.plans import bronze as bronze_plan
from eventlake.plans import dimensions as dimension_plan
from eventlake.plans import gold, silver
from eventlake.session import use_utc
from eventlake.sources import archive, catalog, messages
from eventlake.streaming.bronze import start_bronze
from eventlake.streaming.silver import start_silver

logger = logging.getLogger(__name__)


#: What ``ingest_archive`` counts.
COUNTS = (
    "source_lines",
    "malformed_lines",
    "expected_messages",
    "messages",
    "raw_messages",
    "delivered",
)


class DeliveryError(RuntimeError):
    """Fewer messages arrived than were sent."""


# ------------------------------------------------------------------------------ archive


def ingest_archive(
    spark: SparkSession,
    cfg: PipelineConfig,
    paths: str | Iterable[str],
    limit: int | None = None,
) -> dict[str, int]:
    """Send the events of archive files to the message log and account for all of them.

    ``limit`` sends only the first events, by time and id. Sending an hour again adds its
    messages again; the clean table drops the copies.

    What the lines call for is counted apart from the messages, in the pass that writes them. The file log
    is counted as it landed; a broker has acknowledged what the writer was given, or the job fails.
    """
    use_utc(spark)
    lines = archive.parse_lines(archive.read_archive(spark, paths))
    if limit == 0:
        return dict.fromkeys(COUNTS, 0)
    seen, due = Observation("lines"), Observation("due")
    lines = lines.observe(
        seen,
        F.count(F.lit(1)).alias("source_lines"),
        F.count_if(~F.col("is_event")).alias("malformed_lines"),
    )
    if limit is not None:
        lines = first_n(lines.where("is_event"), limit, ["created_at", "id", "position"])
    out = route(keyed_messages(lines.observe(due, expected_messages(cfg.topics))), cfg.topics)
    batch = f"b-{uuid.uuid4().hex}"
    written = messages.write_messages(out, cfg, batch)
    counts = {**seen.get, **due.get, **written, "delivered": written["messages"]}
    if cfg.message_source == "files" and counts["messages"]:
        counts["delivered"] = messages.landed_messages(spark, cfg, batch).count()
    logger.info("archive: %s", counts)
    if counts["delivered"] != counts["expected_messages"]:
        raise DeliveryError(f"sent {counts['expected_messages']}, delivered {counts['delivered']}")
    return counts


# ---------------------------------------------------------------------------------- raw


def run_bronze(
    spark: SparkSession,
    cfg: PipelineConfig,
    audit_table: bool = False,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Drain the message log into the raw table, check it, and return row count and
    latest ingestion time.

    The rules cover the partitions this run can have written, or all with ``audit_table``. Columns of
    ``extra`` are added to the table on first use, and earlier rows are NULL there; a later run without them leaves
    them NULL.
    """
    use_utc(spark)
    catalog.create_schemas(spark, cfg)
    today = datetime.now(timezone.utc).date()
    start_bronze(spark, cfg, extra).awaitTermination()
    table = catalog.read(spark, cfg.raw_events)
    recent = table if audit_table else table.where(F.col("ingestion_date") >= F.lit(today))
    quality.enforce(recent, cfg.raw_events.name, bronze_plan.RULES)
    return bronze_plan.bronze_summary(table)


# -------------------------------------------------------------------------------- clean


def run_silver(
    spark: SparkSession,
    cfg: PipelineConfig,
    stream: bool = False,
    full_refresh: bool = False,
    mode: str = "fail",
    audit_table: bool = False,
    fixed_partitions: bool = False,
    compact_min_files: int | None = 8,
) -> DataFrame:
    """Load the raw rows of the lookback window, or all with ``full_refresh``, into the
    clean table. Returns the number of events per type. The window starts at the date the last
    load has reached if that is earlier, so an outage leaves no gap. Events that break a rule
    are stored in ``rejects`` and raise once, after the good ones are stored.

    With ``stream`` it loads the raw rows that no earlier ``stream`` run has seen instead,
    so that each raw row is parsed once and not again in every run of its window.
    ``audit_table`` checks the whole table afterwards.
    ``compact_min_files=None`` leaves the files as they are.
    """
    if stream and full_refresh:
        raise ValueError("a full refresh does not use the stream")
    use_utc(spark)
    catalog.create_schemas(spark, cfg)
    by = cfg.events.partition_by
    touched: set[Row] = set()

    def note(increment: DataFrame) -> None:
        if compact_min_files is not None:
            touched.update(incremental.partition_values(increment, by))

    with staging(spark):
        if stream:
            start_silver(spark, cfg, mode, fixed_partitions, note).awaitTermination()
        else:
            raw = catalog.read(spark, cfg.raw_events)
            if not full_refresh:
                reached = silver.cleaned_to(spark, cfg)
                raw = silver.in_lookback(raw, cfg.run_date, cfg.lookback_days, reached)
            note(silver.load_silver(spark, cfg, raw, mode, fixed_partitions))
    if touched:
        compaction.compact(spark, cfg.events, list(touched), compact_min_files)
    table = catalog.read(spark, cfg.events)
    if audit_table:
        quality.enforce(table, cfg.events.name, silver.TABLE_RULES, mode)
    catalog.create_silver_view(spark, cfg)
    return gold.events_by_type(table)


# ------------------------------------------------------------------------- star schema


def _within(df: DataFrame, dates: Sequence[date] | None) -> DataFrame:
    return df if dates is None else df.where(F.col("event_date").isin(list(dates)))


def _touched(df: DataFrame, table: Table, partitions: list[Row] | None) -> DataFrame:
    """The rows in the given partitions, all of them for None."""
    if partitions is None:
        return df
    return df.where(incremental.in_partitions(table.partition_by, partitions))


def load_fact(
    spark: SparkSession,
    cfg: PipelineConfig,
    events: DataFrame,
    mode: str = "safe",
    dates: Sequence[date] | None = None,
) -> list[Row] | None:
    """Bring the event fact up to date, and before it the combinations that the dimensions are counted
    from. Returns its touched partitions, None for all.

    ``strict`` upserts the events ingested after everything in the fact, and so misses
    events that arrive with an earlier ingestion time. ``safe`` finds the dates whose
    counts differ and adds their missing events; it needs no rewrite. ``dates`` limits the
    latter to these event dates.
    """
    table = cfg.fact_events
    if not catalog.exists(spark, table):
        dimension_plan.start_over(spark, cfg, events)
        merge.create(gold.fact_events(events), table, aligned=True)
        return None
    target = catalog.read(spark, table)
    if not catalog.exists(spark, cfg.repo_actors):
        dimension_plan.start_over(spark, cfg, events.join(target.select(table.key), table.key, "left_semi"))
    if mode == "strict":
        mark = incremental.stored_mark(target)
        new = stage(spark, incremental.rows_after(events, mark), table)
        dimension_plan.add_load(spark, cfg, new)
        merge.upsert(spark, gold.fact_events(new), table, is_stored=True)
        return incremental.partition_values(new, table.partition_by)
    behind = incremental.partition_values(
        incremental.dates_out_of_step(
            incremental.rows_per_date(_within(events, dates)),
            incremental.rows_per_date(_within(target, dates)),
        ),
        table.partition_by,
    )
    if behind:
        present = _touched(target, table, behind).select(table.key)
        missing = _touched(events, table, behind).join(present, table.key, "left_anti")
        missing = stage(spark, missing, table)
        dimension_plan.add_load(spark, cfg, missing)
        merge.append(spark, gold.fact_events(missing), table)
    return behind


def load_daily(
    spark: SparkSession,
    cfg: PipelineConfig,
    events: DataFrame,
    mode: str = "safe",
    dates: Sequence[date] | None = None,
) -> list[Row] | None:
    """Recompute the daily aggregate for the dates with new events and replace those
    dates. Distinct counts do not add up, so a date is always recomputed as a whole.
    Returns the replaced partitions, None for all. ``mode`` and ``dates`` are those of
    ``load_fact``."""
    table = cfg.agg_daily_activity
    if not catalog.exists(spark, table):
        merge.create(gold.agg_daily_activity(events), table)
        return None
    target = catalog.read(spark, table)
    if mode == "strict":
        mark = incremental.stored_mark(target)
        changed = incremental.affected_dates(incremental.rows_after(events, mark))
    else:
        present = incremental.rows_per_date(_within(events, dates))
        counted = _within(target, dates).groupBy("event_date")
        counted = counted.agg(F.sum("event_count").alias("n"))
        changed = incremental.dates_out_of_step(present, counted)
    behind = incremental.partition_values(changed, table.partition_by)
    if behind:
        days = gold.agg_daily_activity(_touched(events, table, behind))
        merge.replace_partitions(spark, days, table)
    return behind


def pending_dates(spark: SparkSession, cfg: PipelineConfig) -> list[date] | None:
    """The event dates that clean loads have touched since the star schema was brought up to date; None
    where that is not known. At most one for each date."""
    known = (cfg.changed_dates, cfg.fact_events, cfg.agg_daily_activity)
    if not all(catalog.exists(spark, t) for t in known):
        return None
    return [r[0] for r in catalog.read(spark, cfg.changed_dates).distinct().collect()]


def run_gold(
    spark: SparkSession,
    cfg: PipelineConfig,
    full_refresh: bool = False,
    mode: str = "safe",
    dates: Sequence[date] | str | None = None,
    latest_name: bool = False,
    rules: str | None = "warn",
    audit_table: bool = False,
    dimensions: bool = True,
    compact_min_files: int | None = 8,
    top: int = 20,
) -> DataFrame:
    """Build or update the star schema and return the repositories with the most stars.

    ``mode`` is ``safe`` or ``strict``, see ``load_fact``. In ``safe`` mode ``dates`` limits
    the search for new events to these event dates and leaves all others to another run;
    in ``strict`` mode the others would then be behind the mark. ``dates="changed"`` are those that
    clean loads have touched since the last run, so that no other file is opened.

    ``latest_name`` gives one dimension row per id where names change; without it a rename
    breaks the uniqueness rule of a dimension. ``rules`` is what a violation does: ``warn``,
    ``fail``, or None to skip the rules. They cover the touched partitions, or all with
    ``audit_table``. In ``safe`` mode the dimensions are updated from what is new and cover the events
    of the fact, else they are rebuilt from all events; ``dimensions=False`` leaves that to another run. ``compact_min_files`` is that of ``run_silver``, for the fact.
    """
    if mode not in ("safe", "strict"):
        raise ValueError(f"mode must be 'safe' or 'strict': {mode}")
    if dates is not None and (mode == "strict" or full_refresh):
        raise ValueError("dates go with the safe mode only")
    use_utc(spark)
    catalog.create_schemas(spark, cfg)
    events = catalog.create_silver_view(spark, cfg)
    with staging(spark):
        return _run_gold(
            spark, cfg, events, full_refresh, mode, dates, latest_name, rules, audit_table, dimensions, compact_min_files, top
        )


def _run_gold(
    spark, cfg, events, full_refresh, mode, dates, latest_name, rules, audit_table, dimensions, compact_min_files, top
) -> DataFrame:
    pending = pending_dates(spark, cfg) if mode == "safe" else None
    if dates == "changed":
        dates = pending
    if full_refresh:
        dimension_plan.start_over(spark, cfg, events)
        rebuild(spark, gold.fact_events(events), cfg.fact_events)
        rebuild(spark, gold.agg_daily_activity(events), cfg.agg_daily_activity)
        facts = days = None
    else:
        facts = load_fact(spark, cfg, events, mode, dates)
        days = load_daily(spark, cfg, events, mode, dates)
        if facts and compact_min_files is not None:
            compaction.compact(spark, cfg.fact_events, facts, compact_min_files)
    if dimensions and mode == "safe":
        dimension_plan.update(spark, cfg, latest_name)
    elif dimensions:
        rebuild(spark, gold.dim_repos(events, latest_name), cfg.dim_repos)
        rebuild(spark, gold.dim_users(events, latest_name), cfg.dim_users)
    # The daily aggregate is far smaller than the events and already holds the counts.
    daily = catalog.read(spark, cfg.agg_daily_activity)
    rebuild(spark, gold.stars_from_daily(daily), cfg.top_repos_by_stars)
    if pending and (dates is None or set(pending) <= set(dates)):
        merge.overwrite(spark.createDataFrame([], "event_date date"), cfg.changed_dates)
    if rules is not None:
        audits = [
            (cfg.fact_events, gold.FACT_RULES, None if audit_table else facts),
            (cfg.agg_daily_activity, gold.AGG_RULES, None if audit_table else days),
        ]
        if dimensions:
            audits.append((cfg.dim_repos, gold.DIM_REPOS_RULES, None))
            audits.append((cfg.dim_users, gold.DIM_USERS_RULES, None))
        quality.enforce_all(
            [
                (_touched(catalog.read(spark, t), t, partitions), t.name, checked)
                for t, checked, partitions in audits
            ],
            rules,
        )
    return gold.top_repos(catalog.read(spark, cfg.top_repos_by_stars), top)


# ----------------------------------------------------------------------------- all of it


def run_all(
    spark: SparkSession,
    cfg: PipelineConfig,
    archive_base: str,
    day: str | date | None = None,
    hour: int | None = None,
    limit: int | None = None,
    stream: bool = False,
) -> DataFrame:
    """One hourly run: the given hour, or the previous one, from archive to star schema.
    ``stream`` is that of ``run_silver``. Unless the configuration names a run date it is the
    given day, so a run that is caught up later looks back from its own date."""
    day, hour = archive.resolve_hour(day, hour)
    if cfg.run_date is None:
        cfg = replace(cfg, run_date=str(day))
    ingest_archive(spark, cfg, archive.archive_path(archive_base, day, hour), limit)
    run_bronze(spark, cfg)
    run_silver(spark, cfg, stream)
    return run_gold(spark, cfg, dates="changed")


def run_hours(
    spark: SparkSession,
    cfg: PipelineConfig,
    archive_base: str,
    first: datetime,
    last: datetime,
    stream: bool = False,
) -> DataFrame:
    """All hours from ``first`` to ``last``, both included, in one run: one pass over the archive files, one
    drain and one load of each table. The result is that of a run for every hour. An hour without a file
    raises before anything is sent. The clean load looks back from the first day."""
    if last < first:
        raise ValueError(f"the last hour is before the first: {last} < {first}")
    if cfg.run_date is None:
        cfg = replace(cfg, run_date=str(first.date()))
    ingest_archive(spark, cfg, archive.archive_paths(archive_base, first, last))
    run_bronze(spark, cfg)
    run_silver(spark, cfg, stream)
    return run_gold(spark, cfg, dates="changed")
