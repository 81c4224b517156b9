"""Small helpers that several operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eventlake.session import fresh_dir


def stored(df: DataFrame, label: str, by: list[str] | None = None, codec: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage, survives executors.

    With ``by`` each value of those columns has a folder of its own.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    if _inner is not None:
        _inner.append(path)
    df.write.partitionBy(*by or []).parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


_inner: list[str] | None = None
_left: list[str] = []


@contextmanager
def stage_tables(spark: SparkSession) -> Iterator[None]:
    """A stage of a pipeline. The tables stored in it stay until the next stage starts, for its result
    is computed from them; by then that has been written."""
    global _inner
    while _left:
        delete(spark, _left.pop())
    outer, _inner = _inner, []
    try:
        yield
    finally:
        _left.extend(_inner)
        _inner = outer


def delete(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


Frames = Iterable[pd.DataFrame]


def beside(
    df: DataFrame,
    work: Callable[[Frames], Frames],
    reads: list[str],
    keep: list[str],
    made: str | StructType,
    rows: int = 1_000,
) -> DataFrame:
    """The columns ``keep`` of ``df`` and those that ``work`` makes of the columns ``reads``.

    ``work`` gets frames of at most ``rows`` rows and yields one with as many rows for each. The kept
    columns go past it as Arrow, so a number in them stays as it is also where others are missing.
    """
    made = made if isinstance(made, StructType) else StructType.fromDDL(made)
    types, names = to_arrow_schema(made), [*keep, *made.names]

    def run(batches):
        kept = []

        def frames():
            for batch in batches:
                for at in range(0, batch.num_rows, rows):
                    part = batch.slice(at, rows)
                    kept.append([part.column(c) for c in keep])
                    yield part.select(reads).to_pandas()

        for frame in work(frames()):
            columns = pa.RecordBatch.from_pandas(frame, schema=types, preserve_index=False).columns
            yield pa.RecordBatch.from_arrays([*kept.pop(0), *columns], names)

    schema = StructType([*[df.schema[c] for c in keep], *made.fields])
    return df.select(*dict.fromkeys([*keep, *reads])).mapInArrow(run, schema)


_shipped: set[str] = set()


#: Rows that Spark sends to a Python worker at once, unless the session says otherwise: texts are long.
BATCH = 2_000
BATCH_SETTING, SPARK_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for the Python operators."""
    context = spark.sparkContext
    if spark.conf.get(BATCH_SETTING) == SPARK_BATCH:
        spark.conf.set(BATCH_SETTING, BATCH)
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="eventlake-")).resolve() / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str = "text") -> Column:
    """The text of a row; a missing one counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text: what stands between blanks, tabs and line ends."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def numbered(
    df: DataFrame, group: str, key: Column, name: str, rows_per_chunk: int = 50_000
) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in an order fixed by ``key``.

    Rows are numbered within hashed chunks of about ``rows_per_chunk`` and moved by the sizes of
    the chunks before, so no task holds a whole group. ``df`` should be a stored table: it is
    read for the sizes and again for the numbers.
    """
    chunks = max(1, df.count() // rows_per_chunk)
    spread = df.withColumns(
        {"_order": F.xxhash64(key), "_chunk": F.pmod(F.xxhash64(key, F.lit(1)), F.lit(chunks))}
    )
    before = Window.partitionBy(group).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = (
        spread.groupBy(group, "_chunk")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    within = Window.partitionBy(group, "_chunk").orderBy("_order", key)
    return (
        spread.withColumn("_row", F.row_number().over(within))
        .join(sizes, [group, "_chunk"])
        .withColumn(name, F.col("_before") + F.col("_row") - 1)
        .drop("_order", "_chunk", "_row", "_before")
    )
