"""Whole stages on stored tables: streams, restarts, incremental loads."""

import gzip
from dataclasses import replace
from datetime import date

import pytest
from conftest import event
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from eventlake import run_all, run_bronze, run_gold, run_silver, schemas
from eventlake.operators import DataQualityError, enforce
from eventlake.plans import bronze, gold
from eventlake.plans.silver import load_silver
from eventlake.sources import catalog, messages
from eventlake.streaming import start_bronze, start_silver


def send(spark, cfg, *texts, batch="b1", topic=None):
    keyed = [(str(i), t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(keyed, "key string, value string")
    messages.write_messages(
        df.withColumn("topic", F.lit(topic or cfg.topics.raw)), cfg, batch
    )


def rows(spark, table):
    return sorted(map(str, spark.table(table.name).collect()))


@pytest.fixture
def lake(spark, cfg):
    yield cfg
    for db in (cfg.bronze_db, cfg.silver_db, cfg.gold_db):
        spark.sql(f"DROP SCHEMA IF EXISTS {db} CASCADE")


def test_bronze_lands_the_raw_topic(spark, lake):
    send(spark, lake, event("1"), "not json")
    send(spark, lake, event("1"), topic=lake.topics.stars)
    summary = run_bronze(spark, lake).first()
    assert summary["rows"] == 2
    table = spark.table(lake.raw_events.name)
    assert table.schema.simpleString() == schemas.BRONZE.simpleString()
    assert {r.raw_json for r in table.collect()} == {event("1"), "not json"}
    assert table.select("kafka_topic").distinct().collect()[0][0] == lake.topics.raw
    assert table.where("ingestion_date != to_date(ingested_at)").count() == 0


def test_bronze_rerun_adds_only_new_messages(spark, lake):
    send(spark, lake, event("1"), event("2"))
    for _ in range(2):
        assert run_bronze(spark, lake).first()["rows"] == 2
    send(spark, lake, event("3"), batch="b2")
    assert run_bronze(spark, lake).first()["rows"] == 3


def test_bronze_restart_with_a_new_catalog(spark, lake):
    send(spark, lake, event("1"))
    run_bronze(spark, lake)
    spark.sql(f"DROP TABLE {lake.raw_events.name}")
    send(spark, lake, event("2"), batch="b2")
    assert run_bronze(spark, lake).first()["rows"] == 2


def test_bronze_rate_limit(spark, lake):
    for n in range(3):
        send(spark, lake, event(str(n)), batch=f"b{n}")
    limited = replace(lake, max_files_per_trigger=1)
    catalog.create_schemas(spark, limited)
    query = start_bronze(spark, limited)
    query.awaitTermination()
    files = len(spark.read.parquet(f"{lake.landing}/topic={lake.topics.raw}").inputFiles())
    done = [p for p in query.recentProgress if p.numInputRows > 0]
    assert files >= 3 and len(done) <= files
    times = spark.table(lake.raw_events.name).select("ingested_at").distinct().count()
    assert times == 3


def test_bronze_gains_a_column(spark, lake):
    send(spark, lake, event("1"))
    run_bronze(spark, lake)
    send(spark, lake, event("2"), batch="b2")
    start_bronze(spark, lake, [F.lit("v2").alias("origin")]).awaitTermination()
    table = spark.table(lake.raw_events.name)
    assert {r.origin for r in table.collect()} == {None, "v2"}
    enforce(table, "raw", bronze.RULES)
    merged = spark.read.option("mergeSchema", "true").parquet(lake.raw_events.path)
    assert "origin" in merged.columns and merged.count() == 2
    send(spark, lake, event("3"), batch="b3")
    assert run_bronze(spark, lake).first()["rows"] == 3
    send(spark, lake, event("4"), batch="b4")
    added = [F.lit("v4").alias("origin"), F.lit(4).alias("shard")]
    assert run_bronze(spark, lake, extra=added).first()["rows"] == 4
    rows = spark.table(lake.raw_events.name).withColumn("id", F.get_json_object("raw_json", "$.id"))
    stored = {r.id: (r.origin, r.shard) for r in rows.collect()}
    assert stored == {"1": (None, None), "2": ("v2", None), "3": (None, None), "4": ("v4", 4)}


def test_bronze_rules(spark, lake):
    messages.write_messages(
        spark.sql("select cast(null as string) key, 'x' value, 'events.raw' topic"), lake, "b"
    )
    with pytest.raises(DataQualityError, match=r"not_null\(event_id\): 1"):
        run_bronze(spark, lake)
    with pytest.raises(DataQualityError, match="missing kafka_offset"):
        enforce(spark.table(lake.raw_events.name).drop("kafka_offset"), "raw", bronze.RULES)


def test_silver_first_write_wins_across_runs(spark, lake):
    send(spark, lake, event("1", repo=1), event("1", repo=1), event("2"))
    run_bronze(spark, lake)
    by_type = run_silver(spark, lake, audit_table=True)
    assert [tuple(r) for r in by_type.collect()] == [("WatchEvent", 2)]
    send(spark, lake, event("1", repo=99, at="2024-02-01T00:00:00Z"), event("3"), batch="b2")
    run_bronze(spark, lake)
    run_silver(spark, lake, audit_table=True)
    got = {(r.event_id, r.repo_id) for r in spark.table(lake.events.name).collect()}
    assert got == {("1", 1), ("2", 10), ("3", 10)}
    before = rows(spark, lake.events)
    run_silver(spark, lake, compact_min_files=1)
    assert rows(spark, lake.events) == before
    assert spark.table(lake.silver_view).columns == schemas.SILVER.fieldNames()
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {lake.events.name}").collect()}
    assert parts == {"event_date=2024-01-15/event_type=WatchEvent"}


def test_bad_events_are_kept_apart(spark, lake):
    send(spark, lake, event("1"))
    run_bronze(spark, lake)
    run_silver(spark, lake)
    send(spark, lake, event("2"), event("3", at="nope"), batch="b2")
    run_bronze(spark, lake)
    with pytest.raises(DataQualityError, match="event_timestamp"):
        run_silver(spark, lake)
    assert {r.event_id for r in catalog.read(spark, lake.events).collect()} == {"1", "2"}
    run_silver(spark, lake)
    assert {r.event_id for r in catalog.read(spark, lake.events).collect()} == {"1", "2"}
    rejected = catalog.read(spark, lake.rejects).collect()
    assert [(r.event_id, r.rules) for r in rejected] == [
        ("3", ["not_null(event_timestamp)", "check(event_timestamp)"])
    ]
    send(spark, lake, event("4", at="2019-01-01T00:00:00Z"), event("5"), batch="b3")
    run_bronze(spark, lake)
    run_silver(spark, lake, mode="warn")
    assert catalog.read(spark, lake.events).count() == 3
    assert catalog.read(spark, lake.rejects).count() == 2


def test_outage_longer_than_the_window(spark, lake):
    """Raw rows that no run has cleaned are read however far the run date has moved on."""
    send(spark, lake, event("1"))
    run_bronze(spark, lake)
    run_silver(spark, lake)
    send(spark, lake, event("2"), batch="b2")
    run_bronze(spark, lake)
    run_silver(spark, replace(lake, run_date="2999-01-01"))
    assert {r.event_id for r in catalog.read(spark, lake.events).collect()} == {"1", "2"}
    assert catalog.read(spark, lake.progress).count() == 1


def test_dropped_rows_are_counted(spark, lake, caplog):
    send(spark, lake, event("1"), "{bad", '{"type":"A"}', event("1"))
    run_bronze(spark, lake)
    with caplog.at_level("INFO", logger="eventlake"):
        run_silver(spark, lake)
    assert "'raw_rows': 4, 'malformed': 2" in caplog.text


def test_lookback_and_full_refresh(spark, lake):
    send(spark, lake, event("1"))
    run_bronze(spark, lake)
    future = replace(lake, run_date="2999-01-01")
    run_silver(spark, future)
    assert spark.table(lake.events.name).count() == 0
    run_silver(spark, future, full_refresh=True)
    assert spark.table(lake.events.name).count() == 1


def test_silver_stream_equals_silver_batch(spark, lake):
    send(spark, lake, event("1"), event("2"), event("1"))
    run_bronze(spark, lake)
    start_silver(spark, lake).awaitTermination()
    send(spark, lake, event("2", repo=99), event("3"), batch="b2")
    run_bronze(spark, lake)
    limited = start_silver(spark, replace(lake, max_files_per_trigger=1))
    limited.awaitTermination()
    assert len([p for p in limited.recentProgress if p.numInputRows > 0]) == 2
    streamed = rows(spark, lake.events)
    batch = replace(lake, silver_db=lake.silver_db + "x")
    run_silver(spark, batch)
    assert rows(spark, batch.events) == streamed
    spark.sql(f"DROP SCHEMA {batch.silver_db} CASCADE")


def test_run_silver_as_a_stream(spark, lake):
    send(spark, lake, event("1"), event("2"))
    run_bronze(spark, lake)
    run_silver(spark, lake, stream=True)
    send(spark, lake, event("2", repo=9), event("3"), batch="b2")
    run_bronze(spark, lake)
    by_type = run_silver(spark, lake, stream=True, compact_min_files=1, audit_table=True)
    assert [tuple(r) for r in by_type.collect()] == [("WatchEvent", 3)]
    files = spark.table(lake.events.name).inputFiles()
    assert len(files) == 1
    run_silver(spark, lake, stream=True)
    assert spark.table(lake.events.name).inputFiles() == files
    send(spark, lake, event("4", at="nope"), batch="b3")
    run_bronze(spark, lake)
    with pytest.raises(StreamingQueryException, match="DATA QUALITY FAILURE"):
        run_silver(spark, lake, stream=True)
    assert spark.table(lake.events.name).count() == 3
    send(spark, lake, event("5"), batch="b4")
    run_bronze(spark, lake)
    run_silver(spark, lake, stream=True)
    assert spark.table(lake.events.name).count() == 4
    assert [r.event_id for r in catalog.read(spark, lake.rejects).collect()] == ["4"]
    with pytest.raises(ValueError):
        run_silver(spark, lake, stream=True, full_refresh=True)


def test_replayed_silver_batch_adds_nothing(spark, lake):
    """The driver dies after a batch was written and before it was committed."""
    send(spark, lake, event("1"), event("2"))
    run_bronze(spark, lake)

    def die(increment):
        raise RuntimeError("driver lost")

    with pytest.raises(StreamingQueryException, match="driver lost"):
        start_silver(spark, lake, loaded=die).awaitTermination()
    assert catalog.read(spark, lake.events).count() == 2
    start_silver(spark, lake).awaitTermination()
    assert catalog.read(spark, lake.events).count() == 2


def test_replayed_bronze_batch_adds_nothing(spark, lake, tmp_path):
    """The same for the raw table: the batch runs again and its files count once."""
    send(spark, lake, event("1"), event("2"))
    run_bronze(spark, lake)
    commits = tmp_path / "progress" / lake.raw_events.name / "commits"
    for name in ("0", ".0.crc"):
        (commits / name).unlink(missing_ok=True)
    assert run_bronze(spark, lake).first()["rows"] == 2
    assert (commits / "0").exists()


def stored_silver(spark, cfg, specs):
    """Insert events given as (id, type, actor, repo, time, hour of ingestion)."""
    df = spark.createDataFrame(
        [(event(i, t, a, r, at), h, n) for n, (i, t, a, r, at, h) in enumerate(specs)],
        "raw_json string, hour int, kafka_offset bigint",
    ).selectExpr(
        "raw_json",
        "timestamp '2024-03-01 00:00:00' + make_interval(0,0,0,0,hour) as ingested_at",
        "0 as kafka_partition",
        "kafka_offset",
    )
    catalog.create_schemas(spark, cfg)
    load_silver(spark, cfg, df)


FIRST = [
    ("1", "WatchEvent", 1, 10, "2024-01-15T01:00:00Z", 1),
    ("2", "PushEvent", 2, 10, "2024-01-15T02:00:00Z", 1),
    ("3", "WatchEvent", 1, 11, "2024-01-16T03:00:00Z", 1),
]
LATE = [
    ("4", "WatchEvent", 3, 10, "2024-01-15T23:00:00Z", 2),
    ("5", "PushEvent", 3, 12, "2024-01-17T23:00:00Z", 2),
]
BEHIND = [("6", "PushEvent", 9, 10, "2024-01-16T00:00:00Z", 1)]

GOLD = ("fact_events", "agg_daily_activity", "dim_repos", "dim_users", "top_repos_by_stars")


def assert_equals_full_refresh(spark, cfg):
    events = spark.table(cfg.events.name)
    full = {
        "fact_events": gold.fact_events(events),
        "agg_daily_activity": gold.agg_daily_activity(events),
        "dim_repos": gold.dim_repos(events),
        "dim_users": gold.dim_users(events),
        "top_repos_by_stars": gold.stars_per_repo(events),
    }
    for name, df in full.items():
        table = spark.table(getattr(cfg, name).name).select(*df.columns)
        assert sorted(map(str, table.collect())) == sorted(map(str, df.collect())), name


@pytest.mark.parametrize("mode", ["safe", "strict"])
def test_incremental_equals_full(spark, lake, mode):
    stored_silver(spark, lake, FIRST)
    run_gold(spark, lake, mode=mode, rules="fail")
    assert_equals_full_refresh(spark, lake)
    untouched = set(
        spark.table(lake.agg_daily_activity.name).where("event_date = '2024-01-16'").inputFiles()
    )
    stored_silver(spark, lake, LATE)
    top = run_gold(spark, lake, mode=mode, rules="fail", audit_table=True)
    assert_equals_full_refresh(spark, lake)
    assert [tuple(r) for r in top.collect()] == [(10, "repo_10", 2), (11, "repo_11", 1)]
    assert untouched == set(
        spark.table(lake.agg_daily_activity.name).where("event_date = '2024-01-16'").inputFiles()
    )
    run_gold(spark, lake, mode=mode, rules="fail")
    assert_equals_full_refresh(spark, lake)
    run_gold(spark, lake, full_refresh=True, rules="fail")
    assert_equals_full_refresh(spark, lake)


def test_rows_behind_the_mark_need_safe_mode(spark, lake):
    stored_silver(spark, lake, FIRST + LATE)
    run_gold(spark, lake)
    stored_silver(spark, lake, BEHIND)
    run_gold(spark, lake, mode="strict")
    ids = lambda: {r.event_id for r in spark.table(lake.fact_events.name).collect()}
    assert ids() == {"1", "2", "3", "4", "5"}
    run_gold(spark, lake, mode="safe")
    assert ids() == {"1", "2", "3", "4", "5", "6"}
    assert_equals_full_refresh(spark, lake)


def test_fact_is_compacted(spark, lake):
    parts = [[(str(n), "PushEvent", n, 1, "2024-01-15T01:00:00Z", n)] for n in range(1, 5)]
    for part in parts:
        stored_silver(spark, lake, part)
        run_gold(spark, lake, dimensions=False, rules="fail", compact_min_files=2)
    assert len(catalog.read(spark, lake.fact_events).inputFiles()) == 2
    run_gold(spark, lake)
    assert_equals_full_refresh(spark, lake)


def test_update_of_chosen_dates(spark, lake):
    stored_silver(spark, lake, FIRST)
    run_gold(spark, lake)
    stored_silver(spark, lake, LATE)
    run_gold(spark, lake, dates=[date(2024, 1, 17)], dimensions=False)
    ids = {r.event_id for r in spark.table(lake.fact_events.name).collect()}
    assert ids == {"1", "2", "3", "5"}
    run_gold(spark, lake)
    assert_equals_full_refresh(spark, lake)
    with pytest.raises(ValueError):
        run_gold(spark, lake, mode="strict", dates=[date(2024, 1, 17)])


def test_split_input_equals_one_load(spark, lake):
    for part in (BEHIND, FIRST[:1], LATE, FIRST[1:]):
        stored_silver(spark, lake, part)
        run_gold(spark, lake)
    split = {name: rows(spark, getattr(lake, name)) for name in GOLD}
    whole = replace(lake, silver_db=lake.silver_db + "w", gold_db=lake.gold_db + "w")
    stored_silver(spark, whole, FIRST + LATE + BEHIND)
    run_gold(spark, whole)
    assert split == {name: rows(spark, getattr(whole, name)) for name in GOLD}
    for db in (whole.silver_db, whole.gold_db):
        spark.sql(f"DROP SCHEMA {db} CASCADE")


def test_unknown_mode(spark, lake):
    with pytest.raises(ValueError):
        run_gold(spark, lake, mode="fast")


def test_rules_fail_on_a_rename(spark, lake):
    send(spark, lake, event("1", name="old"), event("2", name="new"))
    run_bronze(spark, lake)
    run_silver(spark, lake)
    run_gold(spark, lake)
    with pytest.raises(DataQualityError, match=r"dim_repos: unique\(repo_id\): 1"):
        run_gold(spark, lake, rules="fail")
    run_gold(spark, lake, rules="fail", latest_name=True)


@pytest.mark.parametrize("stream", [False, True])
def test_hourly_run(spark, lake, tmp_path, stream):
    folder = tmp_path / "arc"
    folder.mkdir()
    for hour in (5, 6):
        with gzip.open(folder / f"2024-01-15-{hour}.json.gz", "wt") as f:
            for n in range(hour):
                f.write(event(f"{hour}-{n}", actor=n, at=f"2024-01-15T0{hour}:00:00Z") + "\n")
            f.write("{broken\n")
    for day, hour in (("2024-01-15", 5), (date(2024, 1, 15), 6), ("2024-01-15", 5)):
        top = run_all(spark, lake, str(folder), day, hour, stream=stream)
    assert [tuple(r) for r in top.collect()] == [(10, "repo_10", 11)]
    assert spark.table(lake.raw_events.name).count() == 16
    assert spark.table(lake.fact_events.name).count() == 11
    daily = spark.table(lake.agg_daily_activity.name).first()
    assert (daily.event_count, daily.unique_actors) == (11, 6)
