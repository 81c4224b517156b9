"""Table writes: create, overwrite, append, insert-only merge, upsert, partition replace.

The ``merge_*`` and ``overwrite_partitions`` functions compute a merge result as a
DataFrame. The others write tables.

Parquet tables have no transaction log: each job commits as a whole or not at all, but a
reader may see a commit half way through. Delta tables use their own merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from eventlake.config import Table
from eventlake.operators.incremental import (
    in_key_range,
    in_partitions,
    partition_values,
)
from eventlake.operators.key_ranges import (
    crowded,
    joined_ranges,
    key_ranges,
    partitions_with,
    side_table,
)
from eventlake.operators.quality import DataQualityError, duplicate_keys
from eventlake.operators.staging import stage, staging
from eventlake.session import setting
from eventlake.sources import catalog

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"

# ---------------------------------------------------------------- merges as DataFrames


def merge_insert_only(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The target plus the source rows whose key it lacks; existing rows never change."""
    return target.unionByName(source.join(target.select(key), key, "left_anti"))


def merge_upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The source plus the target rows whose key it lacks; the source wins."""
    return target.join(source.select(key), key, "left_anti").unionByName(source)


def overwrite_partitions(target: DataFrame, source: DataFrame, partition_by: str) -> DataFrame:
    """The target with each partition that occurs in the source replaced by it."""
    replaced = source.select(F.col(partition_by).alias("_replaced")).distinct()
    kept = target.join(
        replaced, target[partition_by].eqNullSafe(replaced["_replaced"]), "left_anti"
    )
    return kept.unionByName(source)


# ------------------------------------------------------------------------ table writes


def _laid_out(df: DataFrame, table: Table, aligned: bool = False) -> DataFrame:
    """Rows of a partition together in files of sensible size. Adaptive execution splits
    a partition that is too big for one task and joins small ones, so a dominant event
    type is written by many tasks.

    The writer sorts by the partition columns in any case; the key is added to that sort
    so that lookups by key skip row groups. ``aligned`` rows are not shuffled: they come
    from a table with the same partitions, so each task holds few of them already.
    """
    if not table.partition_by:
        return df
    order = [*table.partition_by, *([table.key] if table.key else [])]
    rows = df if aligned else df.hint("rebalance", *table.partition_by)
    return rows.sortWithinPartitions(*order)


def _save(df: DataFrame, table: Table, mode: str, aligned: bool) -> None:
    writer = _laid_out(df, table, aligned).write.format(table.provider).mode(mode)
    if table.partition_by:
        writer = writer.partitionBy(*table.partition_by)
    if table.path:
        # Not where builds of a table were that has been dropped since.
        later = catalog.current_folder(df.sparkSession, table) != table.path
        writer = writer.option("path", catalog.next_folder(df.sparkSession, table) if later else table.path)
    if mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    writer.saveAsTable(table.name)


def _insert(spark: SparkSession, df: DataFrame, table: Table, overwrite: bool) -> None:
    # The insert is by position and partition columns come last in the table.
    rows = _laid_out(df.select(*spark.table(table.name).columns), table)
    rows.write.insertInto(table.name, overwrite=overwrite)


def known_ranges(spark: SparkSession, table: Table) -> DataFrame:
    """The key ranges of a table's partitions; of a table that has none yet they are read from it."""
    side = side_table(table)
    catalog.attach(spark, side)
    if not catalog.exists(spark, side):
        create(key_ranges(catalog.read(spark, table), table), side)
    return catalog.read(spark, side)


def _note_ranges(df: DataFrame, table: Table) -> None:
    """Add the key ranges of rows that are about to be written."""
    if not table.ranged:
        return
    spark, side = df.sparkSession, side_table(table)
    if catalog.exists(spark, table):
        known = known_ranges(spark, table)
        if crowded(spark, table, known):
            rebuild(spark, joined_ranges(known, table), side)
    append(spark, key_ranges(df, table), side)


def create(df: DataFrame, table: Table, aligned: bool = False) -> None:
    """Write a new table. ``aligned`` input comes from a table with the same partitions."""
    _note_ranges(df, table)
    _save(df, table, "errorifexists", aligned)


def overwrite(df: DataFrame, table: Table, aligned: bool = False) -> None:
    """Replace a table, its schema included.

    A table with a path is built in a new folder, and becomes the table when it is complete: a run that
    dies before leaves the old one as it was, and the input may read the table. The old build stays
    until the next one, for readers that have started; those before it are deleted. The input must
    not read a table without a path.
    """
    spark = df.sparkSession
    _note_ranges(df, table)
    if table.path is None or table.provider == "delta":
        with setting(spark, OVERWRITE_MODE, "static"):
            _save(df, table, "overwrite", aligned)
        return
    before, folder = catalog.current_folder(spark, table), catalog.next_folder(spark, table)
    writer = _laid_out(df, table, aligned).write.format(table.provider)
    if table.partition_by:
        writer = writer.partitionBy(*table.partition_by)
    writer.save(folder)
    catalog.point(spark, table, df.schema, folder)
    catalog.drop_builds(spark, table, {before, folder})


def rebuild(spark: SparkSession, df: DataFrame, table: Table) -> None:
    """Overwrite a table with rows that may come from it. A failure while they are computed leaves
    the old table; without a path they are stored first for that."""
    overwrite(df if table.path else stage(spark, df, table), table)


def append(spark: SparkSession, df: DataFrame, table: Table) -> None:
    if catalog.exists(spark, table):
        _note_ranges(df, table)
        _insert(spark, df, table, overwrite=False)
    else:
        create(df, table)


def replace_partitions(spark: SparkSession, df: DataFrame, table: Table) -> None:
    """Replace the partitions that occur in the input and leave the others alone. The
    input may read the table; an empty input changes nothing."""
    if not catalog.exists(spark, table):
        create(df, table)
        return
    _note_ranges(df, table)
    with setting(spark, OVERWRITE_MODE, "dynamic"):
        _insert(spark, df, table, overwrite=True)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def empty_partition(spark: SparkSession, table: Table, partition: Row) -> None:
    """Remove all rows of one partition, files included."""
    spec = ", ".join(f"`{c}` = {_literal(partition[c])}" for c in table.partition_by)
    fields = [f for f in spark.table(table.name).schema if f.name not in table.partition_by]
    nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in fields)
    with setting(spark, OVERWRITE_MODE, "static"):
        spark.sql(
            f"INSERT OVERWRITE TABLE {table.name} PARTITION ({spec}) SELECT {nulls} WHERE false"
        )
    if None not in partition:
        spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS PARTITION ({spec})")


def missing_rows(
    spark: SparkSession, source: DataFrame, table: Table, fixed_partitions: bool = False
) -> DataFrame:
    """The source rows whose key an existing table lacks.

    The source is read more than once, so pass a stored one (see ``staging.stage``). The table is
    first reduced to the keys that occur in the source: a scan of one column, limited to the source's
    key range and, of a ``ranged`` table, to the partitions that may hold such keys, without a shuffle
    when the source is small. Only the matching keys meet the source again.

    ``fixed_partitions`` limits the lookup to the partitions of the source. It is right
    only where a key can never come back with other partition values.
    """
    key = table.key
    target = catalog.read(spark, table)
    if fixed_partitions:
        candidates = partition_values(source, table.partition_by)
        target = target.where(in_partitions(table.partition_by, candidates))
    elif table.ranged:
        candidates = partitions_with(source, known_ranges(spark, table), table)
        target = target.where(in_partitions(table.partition_by, candidates))
    keys = source.select(key)
    present = in_key_range(target.select(key), keys, key).join(keys, key, "left_semi")
    return source.join(present, key, "left_anti")


def insert_only(
    spark: SparkSession, source: DataFrame, table: Table, fixed_partitions: bool = False
) -> None:
    """Insert the source rows whose key the table lacks; never change existing rows. The source must
    hold each key once; see ``missing_rows``."""
    if not catalog.exists(spark, table):
        create(source, table)
        return
    if table.provider == "delta":
        same = F.col(f"{table.name}.{table.key}") == F.col(f"_source.{table.key}")
        source.alias("_source").mergeInto(table.name, same).whenNotMatched().insertAll().merge()
        return
    append(spark, missing_rows(spark, source, table, fixed_partitions), table)


def reject_duplicate_keys(source: DataFrame, key: str) -> None:
    if not duplicate_keys(source.select(key), [key]).isEmpty():
        raise DataQualityError(f"DATA QUALITY FAILURE: several source rows per {key} in an upsert")


def upsert(spark: SparkSession, source: DataFrame, table: Table, is_stored: bool = False) -> None:
    """Replace the rows whose key is in the source and insert the others.

    Without matching keys this is an append. Otherwise one job rewrites the partitions of
    the matched rows and of the source, so a row whose partition changes leaves its old
    one; partitions left without rows are removed. The source is read more than once and is stored
    first, unless it ``is_stored`` already.
    """
    if not is_stored and table.provider != "delta" and catalog.exists(spark, table):
        with staging(spark):
            upsert(spark, stage(spark, source, table), table, is_stored=True)
        return
    key = table.key
    reject_duplicate_keys(source, key)
    if not catalog.exists(spark, table):
        create(source, table)
        return
    if table.provider == "delta":
        same = F.col(f"{table.name}.{key}") == F.col(f"_source.{key}")
        (
            source.alias("_source")
            .mergeInto(table.name, same)
            .whenMatched()
            .updateAll()
            .whenNotMatched()
            .insertAll()
            .merge()
        )
        return
    target = catalog.read(spark, table)
    keys = source.select(key)
    by = table.partition_by
    if not by:
        raise ValueError(f"upsert needs a partitioned table: {table.name}")
    candidates = in_key_range(target.select(key, *by), keys, key)
    found = candidates.join(keys, key, "left_semi").groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    # One row for each partition with a matched key.
    replaced = {tuple(r[c] for c in by): r for r in found.collect()}
    if not replaced:
        append(spark, source, table)
        return
    incoming = {tuple(r): r for r in partition_values(source, by)}
    touched = list({**replaced, **incoming}.values())
    left = [r for values, r in replaced.items() if values not in incoming]
    # A partition that loses as many rows as it has is empty afterwards; file footers tell how many.
    sizes = target.where(in_partitions(by, left)).groupBy(*by).agg(F.count(F.lit(1)).alias("n")) if left else None
    emptied = [r for r in sizes.collect() if r["n"] == replaced[tuple(r[c] for c in by)]["n"]] if left else []
    kept = target.where(in_partitions(by, touched)).join(keys, key, "left_anti")
    replace_partitions(spark, kept.unionByName(source), table)
    for partition in emptied:
        empty_partition(spark, table, partition)
