"""Plans and layouts that matter at scale: pruning, shuffles, hot keys."""

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import eventlake
from eventlake.config import Table
from eventlake.operators import (
    affected_dates,
    compact,
    create,
    file_stats,
    first_per_key,
    insert_only,
    merge_upsert,
    on_dates,
    stage,
    upsert,
)
from eventlake.operators.incremental import in_key_range, in_partitions, partition_values
from eventlake.operators.merge import _laid_out
from eventlake.plans import gold
from eventlake.session import setting


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def table(spark, cfg, tmp_path):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {cfg.gold_db}")
    yield Table(f"{cfg.gold_db}.t", ("d", "t"), "k", str(tmp_path / "t"))
    spark.sql(f"DROP SCHEMA {cfg.gold_db} CASCADE")


def numbered(spark, n, hot_share=3):
    """Keys that grow with the date; one in ``hot_share`` rows has the type ``hot``."""
    return spark.range(0, n, 1, 4).select(
        F.lpad(F.col("id").cast("string"), 9, "0").alias("k"),
        F.rand(1).alias("v"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") * 4 / n).cast("int")).alias("d"),
        F.when(F.col("id") % hot_share == 0, "hot")
        .otherwise(F.concat(F.lit("t"), F.col("id") % 5))
        .alias("t"),
    )


def test_hot_partition_is_written_by_several_tasks(spark, table):
    # Every map task holds rows of all partitions, as after the de-duplication.
    rows = numbered(spark, 60_000).withColumn(
        "d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("k").cast("int") % 2)
    )
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k"):
        create(rows, table)
    files = {(str(r.d), r.t): r.files for r in file_stats(spark, table).collect()}
    assert files[("2024-01-01", "hot")] > 1
    assert spark.table(table.name).count() == 60_000
    assert compact(spark, table, min_files=1)
    assert {r.files for r in file_stats(spark, table).collect()} == {1}


def test_files_are_sorted_by_key(spark, table):
    create(numbered(spark, 8_000), table)
    for path in spark.table(table.name).inputFiles()[:4]:
        keys = [r.k for r in spark.read.parquet(path).collect()]
        assert keys == sorted(keys)


def test_fact_is_built_from_the_clean_table_without_a_shuffle(spark, table):
    create(numbered(spark, 8_000), table)
    by_date = Table(f"{table.name}_by_date", ("d",), "k")
    rows = spark.table(table.name).select("k", "v", "d")
    assert "Exchange" not in plan(_laid_out(rows, by_date, aligned=True))
    assert "Exchange" in plan(_laid_out(rows, by_date))
    create(rows, by_date, aligned=True)
    assert spark.table(by_date.name).count() == 8_000


def test_lookup_reads_the_key_column_and_its_range_without_a_shuffle(spark, table, tmp_path):
    create(numbered(spark, 8_000), table)
    numbered(spark, 8_000).where("k > '000007900'").write.parquet(str(tmp_path / "s"))
    keys = spark.read.parquet(str(tmp_path / "s")).select("k")
    target = in_key_range(spark.table(table.name).select("k"), keys, "k")
    text = plan(target.join(keys, "k", "left_semi"))
    assert "GreaterThanOrEqual(k,000007901)" in text and "LessThanOrEqual(k,000007999)" in text
    assert "ReadSchema: struct<k:string>" in text
    assert "Exchange hashpartitioning" not in text


def test_empty_source_has_an_empty_range(spark, table):
    create(numbered(spark, 100), table)
    rows = spark.table(table.name)
    assert in_key_range(rows, rows.limit(0), "k").count() == 0
    before = rows.count()
    insert_only(spark, numbered(spark, 100).limit(0), table)
    assert spark.table(table.name).count() == before


def test_affected_dates_prune_partitions(spark, table):
    create(numbered(spark, 8_000), table)
    rows = spark.table(table.name)
    dates = affected_dates(rows.where("k > '000007990'"), "d")
    text = plan(on_dates(rows, dates, "d"))
    assert "dynamicpruning" in text and "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning(d" in text  # of the distinct dates only
    assert text.count("BuildRight") == 1


def test_chosen_partitions_are_resolved_before_the_scan(spark, table):
    create(numbered(spark, 8_000), table)
    rows = spark.table(table.name)
    chosen = partition_values(rows.where("k = '000000000'"), ["d", "t"])
    picked = rows.where(in_partitions(["d", "t"], chosen))
    assert {p.split("/d=")[1].split("/part")[0] for p in picked.inputFiles()} == {
        "2024-01-01/t=hot"
    }


def test_ten_thousand_partitions_make_a_flat_predicate(spark):
    rows = spark.range(20_000).selectExpr(
        "date_add(date'2000-01-01', cast(id div 4 as int)) AS d",
        "if(id % 4 = 3, null, concat('t:', id % 4)) AS t",
    )
    chosen = rows.limit(0).collect() + partition_values(rows.where("day(d) % 2 = 0 or t is null"), ["d", "t"])
    assert len(chosen) > 10_000
    picked = rows.where(in_partitions(["d", "t"], chosen))
    assert picked.count() == len(chosen)
    assert picked.where("not (day(d) % 2 = 0 or t is null)").isEmpty()
    assert rows.where(in_partitions(["d", "t"], [])).isEmpty()


def test_one_key_with_a_third_of_the_rows(spark):
    rows = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("o")
    )
    got = first_per_key(rows, ["k"], ["o"])
    assert got.count() == 60_001
    assert got.where("k = -1").first().o == 0


def test_star_schema_with_a_hot_repository_and_actor(spark):
    n = 30_000
    hot = F.col("id") % 3 == 0
    events = spark.range(0, n, 1, 8).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(hot, "WatchEvent").otherwise("PushEvent").alias("event_type"),
        F.when(hot, 0).otherwise(F.col("id") % 50).alias("actor_id"),
        F.lit("a").alias("actor_login"),
        F.when(F.col("id") % 3 == 1, -1).otherwise(F.col("id") % 200).alias("repo_id"),
        F.lit("r").alias("repo_name"),
        F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("event_timestamp"),
    )
    brute: dict = {}
    for i in range(n):
        actor = 0 if i % 3 == 0 else i % 50
        repo = -1 if i % 3 == 1 else i % 200
        brute.setdefault(repo, set()).add(actor)
    got = {r.repo_id: r.contributors for r in gold.dim_repos(events).collect()}
    assert got == {repo: len(actors) for repo, actors in brute.items()}
    users = gold.dim_users(events, latest_name=True)
    total = gold.events_per_user(events, users).first()
    assert total.event_count == n


def test_partition_values_that_need_escaping(spark, table):
    types = ["007", "a/b", "c d", "e=f", "%41", "g:h", "'q'", "ü"]
    rows = spark.createDataFrame(
        [(f"{i}-{j}", 0.0, t) for i, t in enumerate(types) for j in range(3)],
        "k string, v double, t string",
    ).withColumn("d", F.lit("2024-01-01").cast("date")).select("k", "v", "d", "t")
    for j in range(3):
        part = rows.where(F.col("k").endswith(f"-{j}"))
        create(part, table) if j == 0 else insert_only(spark, part, table)
    assert {r.t: r.files for r in file_stats(spark, table).collect()} == {t: 3 for t in types}
    only = partition_values(rows, ["d", "t"])
    assert {r.t for r in compact(spark, table, only, min_files=2)} == set(types)
    assert {r.t: r.files for r in file_stats(spark, table, only).collect()} == {
        t: 1 for t in types
    }
    assert sorted(map(str, spark.table(table.name).collect())) == sorted(map(str, rows.collect()))
    moved = rows.where("t = 'a/b' or t = 'c d'").withColumn("t", F.lit("x"))
    upsert(spark, moved, table)
    left = {r.t for r in spark.table(table.name).select("t").distinct().collect()}
    assert left == {*types, "x"} - {"a/b", "c d"}


def test_random_loads_against_a_dictionary(spark, table):
    """Insert-only merges and upserts in turn, keys changing partition at random."""
    rng = random.Random(7)
    model: dict = {}
    for step in range(6):
        keys = rng.sample(range(40), 15)
        load = {
            f"{k:02d}": (step + rng.random(), f"2024-01-0{rng.randint(1, 4)}", rng.choice("xy"))
            for k in keys
        }
        rows = [(k, v, d, t) for k, (v, d, t) in load.items()]
        df = spark.createDataFrame(rows, "k string, v double, d string, t string")
        df = df.withColumn("d", F.to_date("d"))
        if step % 2:
            upsert(spark, stage(spark, df, table), table)
            model.update(load)
        else:
            insert_only(spark, stage(spark, df, table), table)
            model = {**load, **model}
        got = {
            r.k: (r.v, str(r.d), r.t) for r in spark.table(table.name).collect()
        }
        assert got == model, step
        assert spark.table(table.name).count() == len(model)


def test_merge_frames_leave_join_strategy_to_the_planner(spark):
    big = spark.range(100).selectExpr("cast(id as string) k", "id v")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        assert "SortMergeJoin" in plan(merge_upsert(big, big, "k"))


def test_sources_use_no_shortcuts_that_break_at_scale():
    banned = re.compile(
        r"localCheckpoint|crossJoin|toPandas|\.rdd\.(?!getNumPartitions)|@F?\.?udf|pandas_udf"
        r"|collect_list|collect_set|coalesce\(1\)|repartition\(1\)"
    )
    root = Path(eventlake.__file__).parent
    bounded = {
        # lists of places in one text, which its length bounds
        "suffix_dedup.py": ['.groupBy("row").agg(F.collect_list(', '.groupBy("row")\n        .agg(F.collect_list('],
        # a posting list of one range of rows
        "filter_audit.py": ["F.sort_array(F.collect_list(F.when(F.col(name), entry)))"],
        # the first three turns of a conversation; a band of depths with few turns
        "prefix_trie.py": ['F.collect_list(F.struct("at", "digest", "words"))', "band.repartition(1)"],
    }
    for path in root.rglob("*.py"):
        text = path.read_text()
        for use in bounded.get(path.name, []) if path.parent == root / "llm" else []:
            text = text.replace(use, "")
        assert not banned.search(text), path
