"""What is new since the last run, and which partitions it touches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

WATERMARK = "ingested_at"


def high_water_mark(target: DataFrame, column: str = WATERMARK) -> DataFrame:
    """One row: the latest value in the target, or the epoch for an empty target."""
    epoch = F.expr("TIMESTAMP '1970-01-01 00:00:00'").cast(target.schema[column].dataType)
    return target.agg(F.coalesce(F.max(column), epoch).alias(column))


def stored_mark(target: DataFrame, column: str = WATERMARK) -> Column:
    """The mark as a literal, for a target that is written afterwards."""
    mark = high_water_mark(target, column)
    # One row. Microseconds avoid the client's time zone.
    micros = mark.select(F.unix_micros(column)).first()[0]
    return F.timestamp_micros(F.lit(micros))


def rows_after(source: DataFrame, mark, column: str = WATERMARK) -> DataFrame:
    """Rows strictly later than a mark; the comparison reaches the file scan."""
    return source.where(F.col(column) > mark)


def newer_than(source: DataFrame, target: DataFrame, column: str = WATERMARK) -> DataFrame:
    """Rows of the source that are later than everything in the target."""
    return rows_after(source, high_water_mark(target, column).scalar(), column)


def affected_dates(new_rows: DataFrame, column: str = "event_date") -> DataFrame:
    return new_rows.select(column).distinct()


def on_dates(df: DataFrame, dates: DataFrame, column: str = "event_date") -> DataFrame:
    """All rows on the given distinct dates. The planner broadcasts them where they are few;
    then only those partitions of a table partitioned by the date are read. NULL dates match
    nothing."""
    return df.join(dates, column, "left_semi")


def rows_per_date(df: DataFrame, column: str = "event_date") -> DataFrame:
    """``date, n``. On a table partitioned by the date this reads file footers only."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def dates_out_of_step(
    source: DataFrame, target: DataFrame, column: str = "event_date"
) -> DataFrame:
    """Dates for which two ``date, n`` frames disagree.

    The source only ever gains rows, and the target only has rows of the source, so equal
    counts mean equal rows. Unlike the high-water mark this also finds rows that arrived
    with an ``ingested_at`` the target has already passed.
    """
    s, t = source.alias("s"), target.alias("t")
    return (
        s.join(t, F.col(f"s.{column}").eqNullSafe(F.col(f"t.{column}")), "left")
        .where(F.col("s.n") != F.coalesce(F.col("t.n"), F.lit(0)))
        .select(F.col(f"s.{column}").alias(column))
    )


def in_key_range(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The target rows whose key lies between the smallest and largest key of the source.

    Drops no match. Keys that grow over time, as event ids do, let the scan skip the files
    and row groups of all earlier loads by their statistics.
    """
    # One row.
    low, high = source.agg(F.min(key), F.max(key)).first()
    return target.where(F.col(key).between(F.lit(low), F.lit(high)))


def partition_values(df: DataFrame, columns: Sequence[str]) -> list[Row]:
    """The distinct partitions of some rows. At most one entry per table partition, a
    list the driver holds anyway to plan a scan."""
    return df.select(*columns).distinct().collect()


def in_partitions(columns: Sequence[str], partitions: Sequence[Row]) -> Column:
    """Predicate on partition columns that the planner resolves before listing files.
    NULL is a partition like any other.

    Lists of values, whose depth does not grow with the number of partitions: one for each
    column, and for several columns one of their combinations as text.
    """
    if not partitions:
        return F.lit(False)
    each = [in_values(c, {p[c] for p in partitions}) for c in columns]
    if len(columns) > 1:
        each.append(joined(columns).isin([joined_values([p[c] for c in columns]) for p in partitions]))
    return reduce(lambda a, b: a & b, each)


def in_values(column: str, values: set) -> Column:
    known = [v for v in values if v is not None]
    condition = F.col(column).isin(known) if known else F.lit(False)
    return condition | F.col(column).isNull() if None in values else condition


def joined(columns: Sequence[str]) -> Column:
    """The columns as one text, each with its length before it."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.concat(
        *[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    )


def joined_values(values: list) -> str:
    """As ``joined``, for values that the driver has."""
    texts = [str(v).lower() if isinstance(v, bool) else str(v) for v in values]
    return "".join("-" if v is None else f"{len(t)}:{t}" for v, t in zip(values, texts, strict=True))
