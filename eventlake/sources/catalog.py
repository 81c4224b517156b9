"""Schemas, tables and views of the catalog.

A table in a warehouse folder is first written to ``<path>``. Each later build of the whole table goes
to a new folder beside it, ``<path>__000001`` and so on, and the catalog is then pointed there. A
build is complete when its ``_SUCCESS`` file is, which Spark writes last, so the folders alone tell
which one is the table; a catalog that was lost, or that a dead run left behind, is brought up to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from eventlake import schemas
from eventlake.config import PipelineConfig, Table
from eventlake.session import delete


def create_schemas(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Create the schemas that are not there and register tables that have files.

    With a warehouse folder the schemas' own location is beside the tables, not around
    them: dropping a schema must not remove the files of external tables.
    """
    for db in (cfg.bronze_db, cfg.silver_db, cfg.gold_db):
        place = f" LOCATION '{cfg.schema_path('_schemas')}/{db}'" if cfg.warehouse else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {cfg.schema_name(db)}{place}")
    for table in cfg.tables:
        attach(spark, table)


def exists(spark: SparkSession, table: Table) -> bool:
    return spark.catalog.tableExists(table.name)


def read(spark: SparkSession, table: Table) -> DataFrame:
    """The table as it is now. A session caches a table's file list; refreshing it brings
    in what another session wrote, and a stream batch is one."""
    spark.catalog.refreshTable(table.name)
    return spark.table(table.name)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _path_has_data(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _file_system(spark, path)
    return fs.exists(hadoop_path) and len(fs.listStatus(hadoop_path)) > 0


def _builds(spark: SparkSession, table: Table) -> dict[int, str]:
    """The later builds of a table with a path, complete or not: number and folder. One listing of the
    schema's folder, which has an entry for each table and build."""
    first, fs = _file_system(spark, table.path)
    if not fs.exists(first.getParent()):
        return {}
    start = f"{first.getName()}__"
    names = [s.getPath().getName() for s in fs.listStatus(first.getParent())]
    numbers = [n.removeprefix(start) for n in names if n.startswith(start)]
    return {int(n): f"{table.path}__{n}" for n in numbers if n.isdigit()}


def _complete(spark: SparkSession, folder: str) -> bool:
    marker, fs = _file_system(spark, f"{folder}/_SUCCESS")
    return fs.exists(marker)


def current_folder(spark: SparkSession, table: Table) -> str:
    """The last complete build of a table with a path."""
    builds = _builds(spark, table)
    complete = (builds[n] for n in sorted(builds, reverse=True) if _complete(spark, builds[n]))
    return next(complete, table.path)


def next_folder(spark: SparkSession, table: Table) -> str:
    """A folder for a new build, which no build has used, complete or not."""
    return f"{table.path}__{max(_builds(spark, table), default=0) + 1:06d}"


def point(spark: SparkSession, table: Table, schema: StructType, folder: str) -> None:
    """Make a complete build the table. Files are not touched.

    With the same columns and no partitions this is one change of the catalog. Otherwise the entry is
    made anew, and for that moment the catalog has none; a run that dies there is repaired by
    ``attach``.
    """
    known = spark.table(table.name).schema if exists(spark, table) else None
    columns = [(f.name, f.dataType) for f in schema]
    if known is not None and not table.partition_by and [(f.name, f.dataType) for f in known] == columns:
        spark.sql(f"ALTER TABLE {table.name} SET LOCATION '{folder}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table.name}")
        listed = ", ".join(f"`{name}` {kind.simpleString()}" for name, kind in columns)
        by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in table.partition_by)})" if table.partition_by else ""
        spark.sql(f"CREATE TABLE {table.name} ({listed}) USING {table.provider} {by} LOCATION '{folder}'")
        if table.partition_by:
            spark.sql(f"MSCK REPAIR TABLE {table.name}")
    spark.catalog.refreshTable(table.name)


def drop_builds(spark: SparkSession, table: Table, keep: set[str]) -> None:
    """Delete all builds but the named ones."""
    for folder in {table.path, *_builds(spark, table).values()} - keep:
        delete(spark, folder)


def attach(spark: SparkSession, table: Table) -> None:
    """Register a table whose files are there but which the catalog does not know, as
    after a restart with a catalog that lives only as long as the session. A known table whose last
    build is complete but not in the catalog is pointed to it."""
    if table.path is None:
        return
    folder = current_folder(spark, table)
    if exists(spark, table):
        if folder != table.path and not _same_folder(location(spark, table), folder):
            point(spark, table, spark.read.parquet(folder).schema, folder)
        return
    if not _path_has_data(spark, folder):
        return
    spark.sql(f"CREATE TABLE {table.name} USING {table.provider} LOCATION '{folder}'")
    if table.partition_by and table.provider == "parquet":
        spark.sql(f"MSCK REPAIR TABLE {table.name}")


def _same_folder(a: str, b: str) -> bool:
    """Names of builds differ in the last part of the path."""
    return a.rstrip("/").rsplit("/", 1)[-1] == b.rstrip("/").rsplit("/", 1)[-1]


def location(spark: SparkSession, table: Table) -> str:
    """Folder of an existing table."""
    # A few rows for each column, which the catalog has; filtering them on the driver starts no job.
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table.name}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def add_missing_columns(spark: SparkSession, table: Table, df: DataFrame) -> list[str]:
    """Add the columns of ``df`` that an existing table lacks. Old rows read as NULL."""
    known = {c.lower() for c in spark.table(table.name).columns}
    new = [f for f in df.schema.fields if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table.name} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def create_silver_view(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """The staging view: the clean event table by named columns, no logic."""
    columns = ", ".join(schemas.SILVER.fieldNames())
    spark.catalog.refreshTable(cfg.events.name)
    spark.sql(
        f"CREATE OR REPLACE VIEW {cfg.silver_view} AS SELECT {columns} FROM {cfg.events.name}"
    )
    return spark.table(cfg.silver_view)
