"""Loads that cost what is new: touched dates, key ranges, combinations, first good copies."""

import gzip
import random
from datetime import datetime
from pathlib import Path

import pytest
from conftest import bronze_rows, event
from test_runs import assert_equals_full_refresh, lake, send, stored_silver  # noqa: F401

from eventlake import run_all, run_bronze, run_gold, run_silver
from eventlake.operators import merge, quality
from eventlake.operators.key_ranges import partitions_with
from eventlake.operators.staging import staging
from eventlake.plans import dimensions, silver
from eventlake.plans.run import run_hours
from eventlake.session import work_dir
from eventlake.sources import archive, catalog, messages


def write_hour(folder, day, hour, texts):
    folder.mkdir(exist_ok=True)
    with gzip.open(folder / f"{day}-{hour}.json.gz", "wt") as f:
        f.write("\n".join(texts) + "\n")


def day_events(day, ids, **more):
    return [event(f"{n:08d}", actor=n % 7, repo=n % 5, at=f"2024-01-{day:02d}T05:00:00Z", **more) for n in ids]


def spoil(table, day):
    """Make the files of one date unreadable."""
    files = list(Path(table.path).glob(f"event_date={day}/**/*.parquet"))
    for f in files:
        f.write_bytes(b"no parquet file")
    return len(files)


def test_a_second_hour_opens_files_of_its_own_dates_only(spark, lake, tmp_path):
    for day, ids in ((14, range(100)), (15, range(100, 200))):
        write_hour(tmp_path / "arc", f"2024-01-{day}", 5, day_events(day, ids))
        run_all(spark, lake, str(tmp_path / "arc"), f"2024-01-{day}", 5, stream=True)
    assert_equals_full_refresh(spark, lake)
    for table in (lake.events, lake.fact_events):
        assert spoil(table, "2024-01-14") > 0
    write_hour(tmp_path / "arc", "2024-01-15", 6, day_events(15, range(200, 260)))
    run_all(spark, lake, str(tmp_path / "arc"), "2024-01-15", 6, stream=True)
    fact = catalog.read(spark, lake.fact_events).where("event_date = '2024-01-15'")
    assert fact.count() == 160
    contributors = {r.repo_id: r.contributors for r in catalog.read(spark, lake.dim_repos).collect()}
    assert contributors == {n: 7 for n in range(5)}
    assert catalog.read(spark, lake.changed_dates).count() == 0


def test_an_old_key_beside_new_ones_reads_two_partitions(spark, lake):
    for day in range(1, 21):
        stored_silver(spark, lake, [(f"{day:04d}-{n}", "WatchEvent", n, 1, f"2024-01-{day:02d}T01:00:00Z", day) for n in range(3)])
    new = bronze_rows(spark, [
        (event("0003-1", at="2024-01-03T01:00:00Z"), 25, 0, 1),
        (event("0021-1", at="2024-01-20T09:00:00Z"), 25, 0, 2),
    ])
    source = silver.clean_events(new)
    found = partitions_with(source, merge.known_ranges(spark, lake.events), lake.events)
    assert {str(r.event_date) for r in found} == {"2024-01-03"}
    spoil(lake.events, "2024-01-10")
    silver.load_silver(spark, lake, new)
    got = catalog.read(spark, lake.events).where("event_date != '2024-01-10'")
    assert got.count() == 19 * 3 + 1 and got.where("event_id = '0003-1'").count() == 1


def test_a_key_that_moves_to_another_date_is_found(spark, lake):
    stored_silver(spark, lake, [("a", "WatchEvent", 1, 1, "2024-01-03T01:00:00Z", 1), ("b", "PushEvent", 1, 1, "2024-01-04T01:00:00Z", 1)])
    stored_silver(spark, lake, [("a", "PushEvent", 2, 2, "2024-02-03T01:00:00Z", 2), ("c", "PushEvent", 2, 2, "2024-02-03T01:00:00Z", 2)])
    assert {(r.event_id, r.repo_id) for r in catalog.read(spark, lake.events).collect()} == {("a", 1), ("b", 1), ("c", 2)}


def test_key_ranges_are_joined_and_survive_a_new_catalog(spark, lake, monkeypatch):
    monkeypatch.setattr("eventlake.operators.key_ranges.MOST", 2)
    for n in range(8):
        stored_silver(spark, lake, [(f"{n}", "WatchEvent", 1, 1, "2024-01-03T01:00:00Z", n)])
    ranges = merge.known_ranges(spark, lake.events)
    assert ranges.count() <= 4
    assert ranges.selectExpr("min(low)", "max(high)").first()[:] == ("0", "7")
    spark.sql(f"DROP TABLE {lake.events.name}_key_ranges")
    spark.sql(f"DROP TABLE {lake.events.name}")
    stored_silver(spark, lake, [("3", "WatchEvent", 1, 9, "2024-01-03T01:00:00Z", 9), ("9", "WatchEvent", 1, 9, "2024-01-03T01:00:00Z", 9)])
    assert catalog.read(spark, lake.events).count() == 9


def test_the_first_good_copy_is_stored(spark, lake):
    send(spark, lake, event("1", at="nope"), batch="b1")
    send(spark, lake, event("1", repo=7), event("1", repo=8), event("2", at="bad"), event("2", at="worse"), batch="b2")
    run_bronze(spark, lake)
    with pytest.raises(quality.DataQualityError):
        run_silver(spark, lake)
    stored = catalog.read(spark, lake.events).collect()
    assert [(r.event_id, r.repo_id) for r in stored] == [("1", 7)]
    rejected = catalog.read(spark, lake.rejects).collect()
    assert [r.event_id for r in rejected] == ["2"]
    assert rejected[0].raw_json in (event("2", at="bad"), event("2", at="worse"))
    assert rejected[0].kafka_offset is not None
    run_silver(spark, lake)
    assert catalog.read(spark, lake.events).count() == 1


SPLIT = [
    ("1", "WatchEvent", 1, 10, "2024-01-15T01:00:00Z", 1),
    ("2", "PushEvent", 2, 10, "2024-01-15T02:00:00Z", 1),
    ("3", "WatchEvent", 1, 11, "2024-01-16T03:00:00Z", 1),
    ("4", "WatchEvent", 3, 10, "2024-01-15T23:00:00Z", 2),
    ("5", "PushEvent", 3, 12, "2024-01-17T23:00:00Z", 2),
    ("6", "PushEvent", 1, 10, "2024-01-16T00:00:00Z", 1),
]


@pytest.mark.parametrize("step", ["add_load", "fact", "update"])
def test_dimensions_after_a_run_that_dies(spark, lake, monkeypatch, step):
    stored_silver(spark, lake, SPLIT[:3])
    run_gold(spark, lake)
    stored_silver(spark, lake, SPLIT[3:])

    def die(*args, **options):
        raise RuntimeError("driver lost")

    write = merge.append
    with monkeypatch.context() as m:
        if step == "fact":
            m.setattr(merge, "append", lambda s, df, t: die() if t == lake.fact_events else write(s, df, t))
        else:
            m.setattr(dimensions, step, die)
        with pytest.raises(RuntimeError, match="driver lost"):
            run_gold(spark, lake, dates="changed")
    run_gold(spark, lake, dates="changed")
    assert_equals_full_refresh(spark, lake)


def test_dimensions_over_many_loads_and_both_grains(spark, lake, monkeypatch):
    monkeypatch.setattr(dimensions, "MOST_LOADS", 2)
    for n, spec in enumerate(SPLIT):
        stored_silver(spark, lake, [spec])
        run_gold(spark, lake, dates="changed", dimensions=n % 3 != 1)
    run_gold(spark, lake)
    assert_equals_full_refresh(spark, lake)
    assert catalog.read(spark, lake.repo_actors).select("load").distinct().count() <= 3
    run_gold(spark, lake, latest_name=True)
    run_gold(spark, lake)
    assert_equals_full_refresh(spark, lake)
    run_gold(spark, lake, full_refresh=True)
    assert_equals_full_refresh(spark, lake)


def test_staged_tables_are_deleted(spark, lake):
    stage = Path(work_dir(spark)) / "stage"
    before = {p for p in stage.glob("*/*")} | {p for p in stage.glob("*")}
    send(spark, lake, event("1"))
    run_bronze(spark, lake)
    run_silver(spark, lake)
    run_gold(spark, lake)
    assert {p for p in stage.glob("*/*")} | {p for p in stage.glob("*")} <= before
    with pytest.raises(KeyError), staging(spark):
        raise KeyError


def test_a_range_of_hours_equals_single_runs(spark, lake, tmp_path):
    from dataclasses import replace

    r = random.Random(2)
    hours = [(day, hour) for day in (14, 15, 16) for hour in (0, 23)]
    for day, hour in hours:
        ids = [r.randrange(60) for _ in range(20)]
        texts = [event(str(i), actor=i % 7, repo=i % 5 + hour % 2, at=f"2024-01-{day}T{hour:02d}:00:00Z") for i in ids]
        write_hour(tmp_path / "arc", f"2024-01-{day}", hour, texts)
    single = replace(lake, silver_db=lake.silver_db + "s", gold_db=lake.gold_db + "s", bronze_db=lake.bronze_db + "s", landing=lake.landing + "s", checkpoint_dir=lake.checkpoint_dir + "s")
    for day, hour in hours:
        run_all(spark, single, str(tmp_path / "arc"), f"2024-01-{day}", hour)
    for day in (14, 15, 16):
        for hour in range(1, 23):
            write_hour(tmp_path / "arc", f"2024-01-{day}", hour, [""])
    run_hours(spark, lake, str(tmp_path / "arc"), datetime(2024, 1, 14, 0), datetime(2024, 1, 16, 23))
    for name in ("fact_events", "dim_repos", "dim_users", "agg_daily_activity"):
        got, want = (sorted(map(str, spark.table(getattr(c, name).name).drop("ingested_at").collect())) for c in (lake, single))
        assert got == want, name
    with pytest.raises(ValueError):
        run_hours(spark, lake, str(tmp_path / "arc"), datetime(2024, 1, 2), datetime(2024, 1, 1))
    for db in (single.bronze_db, single.silver_db, single.gold_db):
        spark.sql(f"DROP SCHEMA {db} CASCADE")


@pytest.mark.parametrize("tasks", [1, 4, 7])
def test_the_survivor_does_not_depend_on_the_number_of_tasks(spark, tmp_path, monkeypatch, tasks):
    """Of the copies of an event the first line of the earliest hour stays."""
    r = random.Random(1)
    order = []
    for hour in (9, 10, 11):
        lines = [(i, f"{hour}-{n}") for n, i in enumerate(r.randrange(30) for _ in range(60))]
        order += lines
        write_hour(tmp_path / "arc", "2024-01-15", hour, [event(str(i), login=login) for i, login in lines])
    first = {}
    for i, login in order:
        first.setdefault(str(i), login)
    lines = archive.read_archive(spark, str(tmp_path / "arc")).repartition(tasks)
    events = archive.parse_lines(lines)
    sent = messages.with_positions(
        events.selectExpr("id as key", "value", "'t' as topic", "position").repartition(tasks)
    )
    raw = sent.selectExpr(
        "cast(value as string) raw_json", "timestamp '2024-01-15 00:00:00' ingested_at", "partition kafka_partition", "offset kafka_offset"
    )
    got = {r.event_id: r.actor_login for r in silver.clean_events(raw).collect()}
    assert got == first


def test_read_messages_are_deleted_with_a_retention(spark, lake):
    from dataclasses import replace

    kept = replace(lake, retention="24h")
    assert messages.file_read_options(kept)["maxFileAge"] == "24h"
    for n in range(4):
        send(spark, kept, event(str(n)), batch=f"b{n}")
        run_bronze(spark, kept)
    files = list(Path(lake.landing).glob(f"topic={lake.topics.raw}/**/*.parquet"))
    assert catalog.read(spark, lake.raw_events).count() == 4 and len(files) < 4


def test_drift_of_a_stored_schema_is_named(spark, tmp_path):
    from eventlake import schemas

    good = bronze_rows(spark, [event("1"), event("2")])
    assert quality.schema_drift(good, schemas.BRONZE).collect() == []
    drifted = good.drop("kafka_topic").selectExpr("*", "'x' as more").withColumnRenamed("kafka_offset", "offset")
    got = {(r.column, r.problem, r.rows) for r in quality.schema_drift(drifted, schemas.BRONZE).collect()}
    assert got == {("kafka_topic", "missing", 2), ("kafka_offset", "missing", 2), ("offset", "extra", 2), ("more", "extra", 2)}
