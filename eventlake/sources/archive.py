"""Hourly archive files: one JSON event per line, gzip, one file per UTC hour."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.functions.events import event_fields


def previous_hour(now: datetime | None = None) -> tuple[str, int]:
    """Date and hour of the most recently completed UTC hour."""
    hour_ago = (now or datetime.now(timezone.utc)).astimezone(timezone.utc) - timedelta(hours=1)
    return hour_ago.date().isoformat(), hour_ago.hour


def resolve_hour(
    day: str | date | None = None, hour: int | None = None, now: datetime | None = None
) -> tuple[str, int]:
    """The hour to read: the given one, or the previous one when neither part is given."""
    if (day is None) != (hour is None):
        raise ValueError("give both the date and the hour, or neither")
    if day is None:
        return previous_hour(now)
    if not 0 <= hour <= 23:
        raise ValueError(f"hour must be within 0..23: {hour}")
    return str(day), hour


def archive_path(base: str, day: str | date, hour: int) -> str:
    # The hour in the file name is not zero-padded.
    return f"{base.rstrip('/')}/{day}-{hour}.json.gz"


def in_hour(events: DataFrame, column: str, day: str | date, hour: int) -> DataFrame:
    """The events of one archive hour. A range on the plain column, so it reaches the scan."""
    start = datetime.combine(date.fromisoformat(str(day)), time(hour))
    kind = events.schema[column].dataType
    first, end = (F.lit(str(t)).cast(kind) for t in (start, start + timedelta(hours=1)))
    return events.where((F.col(column) >= first) & (F.col(column) < end))


def archive_paths(base: str, first: datetime, last: datetime) -> list[str]:
    """Paths of all hours from ``first`` to ``last``, both included, for a backfill."""
    hours = int((last - first) / timedelta(hours=1))
    times = (first + timedelta(hours=n) for n in range(hours + 1))
    return [archive_path(base, t.date(), t.hour) for t in times]


def line_position() -> Column:
    """Where a line is, as one number that grows with the hours and with the lines of a file.

    It is the hour in the file's name (of other names a checksum; 20 bits), the part of a file that can
    be split (in MB, 14 bits), and a counter in the task that reads it, before any exchange (29 bits). How
    files are dealt to tasks changes where a counter starts, but never the order of two lines.
    """
    name = F.col("_metadata.file_name")
    at = F.try_to_timestamp(F.regexp_extract(name, r"^(\d{4}-\d{2}-\d{2}-\d{1,2})\.", 1), F.lit("yyyy-MM-dd-H"))
    hour = F.coalesce(F.floor(F.unix_seconds(at) / 3600), F.crc32(name))
    part = F.floor(F.col("_metadata.file_block_start") / (1 << 20))
    counter = F.monotonically_increasing_id()
    return (
        F.shiftleft(F.pmod(hour, F.lit(1 << 20)), 43)
        + F.shiftleft(F.pmod(part, F.lit(1 << 14)), 29)
        + F.pmod(counter, F.lit(1 << 29))
    ).cast("long")


def read_archive(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Lines of the given files, column ``value``, and their ``position`` (see ``line_position``).

    A gzip file cannot be split, so one file is one task. A backfill has files enough for
    all cores; where one file has more than twice a core's even share, as in a run over
    a few hours, the lines are spread before the parsing starts.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths).withColumn("position", line_position())
    sizes = spark.read.format("binaryFile").load(paths).select("length")
    # One row, from the file listing.
    largest, total = sizes.agg(F.max("length"), F.sum("length")).first()
    slots = spark.sparkContext.defaultParallelism
    if largest and largest * slots > 2 * total:
        return lines.repartition(max(slots, lines.rdd.getNumPartitions()))
    return lines


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Adds ``id``, ``type``, ``created_at`` and ``is_event`` to each line.

    ``is_event`` is false for text that is not a JSON object, blank lines included. ``position`` stays
    where the lines have one.
    """
    others = [c for c in lines.columns if c == "position"]
    parsed = lines.select(
        F.col(column).alias("value"), *others, event_fields(F.col(column), schemas.ARCHIVE_LINE)
    )
    has_text = F.coalesce(F.col("value").rlike(r"\S"), F.lit(False))
    return parsed.select(
        "value",
        *others,
        "id",
        "type",
        "created_at",
        (has_text & F.col("_corrupt_record").isNull()).alias("is_event"),
    )
