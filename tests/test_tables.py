"""Table writes: merges, partition replacement, compaction."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventlake.config import Table
from eventlake.operators import (
    DataQualityError,
    append,
    compact,
    create,
    file_stats,
    first_per_key,
    insert_only,
    merge_insert_only,
    merge_upsert,
    overwrite,
    overwrite_partitions,
    replace_partitions,
    upsert,
)
from eventlake.operators.incremental import in_partitions, partition_values
from eventlake.operators.merge import OVERWRITE_MODE, empty_partition, rebuild
from eventlake.session import setting
from eventlake.sources import catalog

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


@pytest.fixture(params=["managed", "external"])
def table(request, spark, cfg, tmp_path):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {cfg.gold_db}")
    path = str(tmp_path / "t") if request.param == "external" else None
    yield Table(f"{cfg.gold_db}.t", ("d",), "k", path)
    spark.sql(f"DROP SCHEMA {cfg.gold_db} CASCADE")


def rows(spark, *data):
    return spark.createDataFrame(list(data), "k string, v int, d date")


def content(spark, table):
    return sorted((r.k, r.v, r.d) for r in spark.table(table.name).collect())


def partitions(spark, table):
    return sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {table.name}").collect())


def test_insert_only_creates_then_keeps_first_write(spark, table):
    insert_only(spark, rows(spark, ("a", 1, D1), ("b", 1, D1)), table)
    insert_only(spark, rows(spark, ("b", 9, D2), ("c", 1, D2)), table)
    expected = [("a", 1, D1), ("b", 1, D1), ("c", 1, D2)]
    assert content(spark, table) == expected
    insert_only(spark, rows(spark, ("b", 9, D2), ("c", 1, D2)), table)
    insert_only(spark, rows(spark), table)
    assert content(spark, table) == expected


def test_insert_only_within_source_partitions(spark, table):
    create(rows(spark, ("a", 1, D1), ("b", 1, D2)), table)
    insert_only(spark, rows(spark, ("b", 9, D2), ("c", 1, D2)), table, fixed_partitions=True)
    assert content(spark, table) == [("a", 1, D1), ("b", 1, D2), ("c", 1, D2)]


def test_upsert_moves_a_key_and_removes_the_emptied_partition(spark, table):
    upsert(spark, rows(spark, ("a", 1, D1), ("b", 1, D2), ("c", 1, D2)), table)
    upsert(spark, rows(spark, ("a", 2, D2), ("x", 1, D3)), table)
    assert content(spark, table) == [("a", 2, D2), ("b", 1, D2), ("c", 1, D2), ("x", 1, D3)]
    assert partitions(spark, table) == ["d=2024-01-02", "d=2024-01-03"]
    left = spark.read.parquet(catalog.location(spark, table))
    assert left.count() == 4


def test_upsert_removes_exactly_the_emptied_partitions(spark, table):
    create(rows(spark, ("a", 1, D1), ("b", 1, D1), ("c", 1, D2), ("d", 1, None), ("e", 1, D3)), table)
    # D1 keeps a row, D2 and the partition without a date lose all they have, D3 gets its row back.
    source = rows(spark, ("a", 2, D3), ("c", 2, D3), ("d", 2, D3), ("e", 2, D3), ("f", 2, D3))
    upsert(spark, source.withColumn("v", (F.rand() * 0 + 2).cast("int")), table)
    assert content(spark, table) == [("a", 2, D3), ("b", 1, D1), ("c", 2, D3), ("d", 2, D3), ("e", 2, D3), ("f", 2, D3)]
    assert partitions(spark, table)[:2] == ["d=2024-01-01", "d=2024-01-03"]
    for partition in ("d=2024-01-02", "d=__HIVE_DEFAULT_PARTITION__"):
        folder = Path(catalog.location(spark, table).removeprefix("file:")) / partition
        assert not list(folder.glob("*.parquet")) or spark.read.parquet(str(folder)).count() == 0


def test_upsert_without_matches_rewrites_nothing(spark, table):
    create(rows(spark, ("a", 1, D1)), table)
    before = set(spark.table(table.name).inputFiles())
    upsert(spark, rows(spark, ("b", 1, D1)), table)
    assert before < set(spark.table(table.name).inputFiles())
    upsert(spark, rows(spark), table)
    assert content(spark, table) == [("a", 1, D1), ("b", 1, D1)]


def test_upsert_twice_is_upsert_once(spark, table):
    create(rows(spark, ("a", 1, D1), ("b", 1, D1)), table)
    for _ in range(2):
        upsert(spark, rows(spark, ("b", 2, D3), ("c", 1, D1)), table)
        assert content(spark, table) == [("a", 1, D1), ("b", 2, D3), ("c", 1, D1)]


def test_upsert_rejects_repeated_source_keys(spark, table):
    create(rows(spark, ("a", 1, D1)), table)
    with pytest.raises(DataQualityError, match="several source rows per k"):
        upsert(spark, rows(spark, ("b", 1, D1), ("b", 2, D1)), table)
    assert content(spark, table) == [("a", 1, D1)]


def test_replace_partitions(spark, table):
    replace_partitions(spark, rows(spark, ("a", 1, D1), ("b", 1, D2)), table)
    replace_partitions(spark, rows(spark, ("c", 1, D2), ("d", 1, D3)), table)
    expected = [("a", 1, D1), ("c", 1, D2), ("d", 1, D3)]
    assert content(spark, table) == expected
    replace_partitions(spark, rows(spark), table)
    assert content(spark, table) == expected
    doubled = spark.table(table.name).where(F.col("d") == F.lit(D1)).withColumn("v", F.lit(2))
    replace_partitions(spark, doubled, table)
    assert content(spark, table)[0] == ("a", 2, D1)


def test_inserts_go_by_column_name(spark, table):
    create(rows(spark, ("a", 1, D1)), table)
    append(spark, rows(spark, ("b", 2, D2)).select("d", "v", "k"), table)
    assert content(spark, table) == [("a", 1, D1), ("b", 2, D2)]


def test_null_partition(spark, table):
    create(rows(spark, ("a", 1, None), ("b", 1, D1)), table)
    upsert(spark, rows(spark, ("a", 2, D1)), table)
    assert content(spark, table) == [("a", 2, D1), ("b", 1, D1)]
    upsert(spark, rows(spark, ("b", 3, None)), table)
    assert spark.table(table.name).where("d is null").collect()[0].v == 3


def test_empty_partition_removes_files(spark, table):
    create(rows(spark, ("a", 1, D1), ("b", 1, D2)), table)
    (victim,) = partition_values(spark.table(table.name).where("k = 'a'"), ["d"])
    empty_partition(spark, table, victim)
    assert spark.read.parquet(catalog.location(spark, table)).count() == 1
    assert content(spark, table) == [("b", 1, D2)]


def test_overwrite_replaces_schema(spark, table):
    flat = Table(table.name, path=table.path)
    overwrite(rows(spark, ("a", 1, D1)), flat)
    overwrite(rows(spark, ("b", 2, D1)).withColumn("extra", F.lit(1)), flat)
    assert [r.asDict() for r in spark.table(table.name).collect()] == [
        {"k": "b", "v": 2, "d": D1, "extra": 1}
    ]


def test_overwrite_removes_old_partitions_whatever_the_session_says(spark, table):
    create(rows(spark, ("a", 1, D1), ("b", 1, D2)), table)
    with setting(spark, OVERWRITE_MODE, "dynamic"):
        overwrite(rows(spark, ("c", 1, D2)), table)
        assert spark.conf.get(OVERWRITE_MODE) == "dynamic"
    assert content(spark, table) == [("c", 1, D2)]
    assert spark.read.parquet(catalog.location(spark, table)).count() == 1


def _failing(spark, *data):
    """Rows of which the last task's cannot be computed."""
    bad = rows(spark, ("bad", 1, D3)).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    return rows(spark, *data).unionByName(bad)


@pytest.mark.parametrize("partitioned", [True, False])
def test_a_failed_rebuild_leaves_the_old_table(spark, table, partitioned):
    table = table if partitioned else replace(table, partition_by=())
    old = [("a", 1, D1), ("b", 1, D2)]
    create(rows(spark, *old), table)
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            rebuild(spark, _failing(spark, ("c", 1, D2)), table)
        assert content(spark, table) == old
    if table.path is not None:
        spark.sql(f"DROP TABLE {table.name}")
        catalog.attach(spark, table)
        assert content(spark, table) == old
    append(spark, rows(spark, ("c", 1, D3)), table)
    rebuild(spark, catalog.read(spark, table).where("k != 'a'").select("k", "v", "d"), table)
    assert content(spark, table) == [("b", 1, D2), ("c", 1, D3)]
    append(spark, rows(spark, ("d", 1, D1)), table)
    rebuild(spark, rows(spark), table)
    assert content(spark, table) == []
    append(spark, rows(spark, ("e", 1, D1)), table)
    assert content(spark, table) == [("e", 1, D1)]


@pytest.mark.parametrize("known", [True, False])
def test_a_build_that_the_catalog_never_saw(spark, table, known, monkeypatch):
    """The run dies between the last file of a build and the change of the catalog."""
    if table.path is None:
        pytest.skip("managed tables are overwritten in place")
    create(rows(spark, ("a", 1, D1)), table)
    with monkeypatch.context() as died:
        died.setattr(catalog, "point", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            overwrite(rows(spark, ("b", 1, D2)), table)
    assert content(spark, table) == [("a", 1, D1)]
    if not known:
        spark.sql(f"DROP TABLE {table.name}")
    catalog.attach(spark, table)
    assert content(spark, table) == [("b", 1, D2)]
    append(spark, rows(spark, ("c", 1, D1)), table)
    assert content(spark, table) == [("b", 1, D2), ("c", 1, D1)]


def test_readers_of_the_old_build_finish(spark, table):
    if table.path is None:
        pytest.skip("managed tables are overwritten in place")
    create(rows(spark, ("a", 1, D1)), table)
    for n in range(4):
        reader = catalog.read(spark, table)
        overwrite(rows(spark, ("b", n, D1)), table)
        assert reader.count() == 1
    folders = {f.name for f in Path(table.path).parent.iterdir() if f.name.startswith("t")}
    assert folders == {"t__000003", "t__000004"}


def test_a_dropped_table_is_created_beside_its_builds(spark, table):
    if table.path is None:
        pytest.skip("managed tables are overwritten in place")
    create(rows(spark, ("a", 1, D1)), table)
    overwrite(rows(spark, ("b", 1, D1)), table)
    spark.sql(f"DROP TABLE {table.name}")
    create(rows(spark, ("c", 1, D1)), table)
    catalog.attach(spark, table)
    assert content(spark, table) == [("c", 1, D1)]


def test_overwrites_from_several_threads(spark, table):
    """One thread replaces single partitions while others overwrite tables as a whole."""
    create(rows(spark, ("a", 1, D1), ("b", 1, D2)), table)
    flats = [Table(f"{table.name}_{n}", ("d",), "k") for n in range(3)]

    def replace(n):
        replace_partitions(spark, rows(spark, ("b", n, D2)), table)

    def refill(flat):
        for d in (D1, D2, D3):
            overwrite(rows(spark, ("x", 1, d)), flat)

    with ThreadPoolExecutor(6) as pool:
        jobs = [pool.submit(replace, n) for n in range(4)]
        jobs += [pool.submit(refill, flat) for flat in flats]
        for job in jobs:
            job.result()
    assert [(k, d) for k, _, d in content(spark, table)] == [("a", D1), ("b", D2)]
    for flat in flats:
        assert content(spark, flat) == [("x", 1, D3)]


@pytest.mark.parametrize("change", ["compact", "upsert", "insert_only"])
def test_files_of_another_session_are_not_lost(spark, table, change):
    create(rows(spark, ("a", 1, D1)), table)
    assert spark.table(table.name).count() == 1
    other = spark.newSession()
    append(other, rows(other, ("b", 1, D1)), table)
    if change == "compact":
        compact(spark, table, min_files=1)
    elif change == "upsert":
        upsert(spark, rows(spark, ("a", 1, D1)), table)
    else:
        insert_only(spark, rows(spark, ("b", 9, D1)), table)
    assert content(spark, table) == [("a", 1, D1), ("b", 1, D1)]


def test_attach_after_the_catalog_forgot_the_table(spark, table):
    if table.path is None:
        pytest.skip("managed tables live with their catalog")
    create(rows(spark, ("a", 1, D1), ("b", 1, None)), table)
    spark.sql(f"DROP TABLE {table.name}")
    assert not catalog.exists(spark, table)
    catalog.attach(spark, table)
    append(spark, rows(spark, ("c", 1, D3)), table)
    assert {r.k for r in spark.table(table.name).collect()} == {"a", "b", "c"}
    catalog.attach(spark, table)
    overwrite(rows(spark, ("z", 1, D1)), table)
    assert content(spark, table) == [("z", 1, D1)]


def test_compaction_keeps_rows_and_reduces_files(spark, table):
    for n in range(5):
        append(spark, rows(spark, (f"a{n}", n, D1)), table)
    append(spark, rows(spark, ("b", 1, D2)), table)
    before = content(spark, table)
    files = {r.d: r.files for r in file_stats(spark, table).collect()}
    assert files == {D1: 5, D2: 1}
    untouched = set(spark.table(table.name).where("d = '2024-01-02'").inputFiles())
    assert [r.d for r in compact(spark, table, min_files=3)] == [D1]
    assert content(spark, table) == before
    assert {r.d: r.files for r in file_stats(spark, table).collect()} == {D1: 1, D2: 1}
    assert untouched == set(spark.table(table.name).where("d = '2024-01-02'").inputFiles())
    assert compact(spark, table, min_files=3) == []


def test_compaction_of_chosen_partitions(spark, table):
    for n in range(4):
        append(spark, rows(spark, (f"a{n}", n, D1), (f"b{n}", n, D2)), table)
    chosen = partition_values(spark.table(table.name).where("k = 'b0'"), ["d"])
    assert [r.d for r in compact(spark, table, chosen, min_files=2)] == [D2]
    assert {r.d: r.files for r in file_stats(spark, table).collect()} == {D1: 4, D2: 1}


def test_partition_predicate_with_two_columns(spark):
    df = spark.createDataFrame(
        [(D1, "x"), (D1, "y"), (D2, "x"), (None, "x"), (D1, None)], "d date, t string"
    )
    pick = partition_values(df.where("t = 'y' or d is null or t is null"), ["d", "t"])
    got = {tuple(r) for r in df.where(in_partitions(["d", "t"], pick)).collect()}
    assert got == {(D1, "y"), (None, "x"), (D1, None)}
    assert df.where(in_partitions(["d", "t"], [])).count() == 0


def test_merge_results_as_frames(spark):
    target = rows(spark, ("a", 1, D1), ("b", 1, D2))
    source = rows(spark, ("b", 2, D3), ("c", 2, D2))
    as_set = lambda df: {(r.k, r.v, r.d) for r in df.collect()}
    assert as_set(merge_insert_only(target, source, "k")) == {
        ("a", 1, D1), ("b", 1, D2), ("c", 2, D2)
    }
    assert as_set(merge_upsert(target, source, "k")) == {
        ("a", 1, D1), ("b", 2, D3), ("c", 2, D2)
    }
    assert as_set(overwrite_partitions(target, source, "d")) == {
        ("a", 1, D1), ("b", 2, D3), ("c", 2, D2)
    }


def test_first_per_key_total_order(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, None)], "k string, o int, v string"
    )
    got = first_per_key(df, ["k"], ["o"])
    assert got.columns == ["k", "o", "v"]
    assert {tuple(r) for r in got.collect()} == {("a", 1, "y"), ("b", 5, None)}


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 1000, 1, 4).selectExpr("'hot' as k", "id as o")
    query = first_per_key(df, ["k"], ["o"])
    assert query.collect()[0].o == 0
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
