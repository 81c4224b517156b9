"""Sharding by sampled splitters.

Keys are sampled with a chance in proportion to their record's size, quantiles of the sample
become range boundaries, and records are range-partitioned by key. Ranges that turn out overfull
are subdivided by quantiles of their own keys until each is small enough for one task; one that has
a single key is subdivided by its texts' hashes, and one of equal records by their salt. Shards are
consecutive stretches of the key order with near-equal bytes: a record goes to the shard its
first byte falls in, so a shard's bytes differ from the mean by less than one record at each end.

A missing text has size 8; a missing id sorts first; rows with equal ids are ordered by their
text's hash. An empty table gives an empty result. Whole records are placed: they are moved to their
range once, with every column, and stored in the order of their shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.work import stored, whole

LOWEST = -(1 << 63)
FAN = 64
PLACES = ("size", "text_crc32", "shard", "slot")


def records(docs: DataFrame) -> DataFrame:
    """The records (struct ``record``) with their key, size and checksum, and a salt that tells equal
    ones apart."""
    text = whole()
    return docs.select(
        F.struct(*docs.columns).alias("record"),
        F.coalesce("doc_id", F.lit(LOWEST)).alias("key"),
        F.xxhash64(text).alias("tie"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("salt"),
    )


def below(bounds: list[int], key: Column) -> Column:
    """How many of the sorted bounds are at or below the key, found in two levels."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    runs = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    firsts = F.array(*[F.lit(r[0]) for r in runs])
    run = F.size(F.filter(firsts, lambda b: b <= key))
    inside = F.array(*[F.array(*[F.lit(b) for b in r]) for r in runs])
    return F.when(run == 0, 0).otherwise(
        (run - 1) * step + F.size(F.filter(F.get(inside, run - 1), lambda b: b <= key))
    )


def sampled_splitters(rows: DataFrame, total: int, ranges: int, per_range: int) -> list[int]:
    """Boundaries of ``ranges`` ranges with near-equal bytes, from a size-weighted sample.

    A record is in the sample when a hash of its key and salt falls below its size over ``step``
    bytes, and stands for ``step`` bytes, or for its own size where that is larger. Equal records are
    drawn one by one, so the sample has about ``ranges * per_range`` rows whatever the table has.
    """
    step = max(1, total // (ranges * per_range))
    drawn = F.pmod(F.xxhash64("key", "tie", "salt"), F.lit(step)) < F.col("size")
    sample = rows.where(drawn).select("key", F.greatest("size", F.lit(step)).alias("weight"))
    bounds, seen, drawn_total = [], 0, 0
    picked = sorted(sample.collect())
    drawn_total = sum(r.weight for r in picked)
    for r in picked:
        if seen * ranges >= drawn_total * (len(bounds) + 1):
            bounds.append(r.key)
        seen += r.weight
    return sorted(set(bounds))


def range_partition(
    rows: DataFrame, total: int, ranges: int, per_range: int, max_rows: int
) -> DataFrame:
    """Adds ``range``, increasing with (key, tie, salt); overfull ranges are subdivided.

    A range is cut by the first of the three in which its rows differ. Rows equal to a cut are a range
    of their own, so every round takes at least one value out of the range, and each value that a
    64th of its rows have. The salt is unique, so no range with two rows stays undivided.
    """
    bounds = sampled_splitters(rows, total, ranges, per_range)
    rows = rows.withColumn("range", below(bounds, F.col("key")).cast("long"))
    while True:
        sizes = rows.groupBy("range").agg(
            F.count("*").alias("n"),
            F.sum("size").alias("bytes"),
            (F.min("key") < F.max("key")).alias("by_key"),
            (F.min("tie") < F.max("tie")).alias("by_tie"),
        )
        crowded = (F.col("n") > max_rows) | (
            (F.col("bytes") > 4 * total // ranges) & (F.col("n") > 4 * FAN)
        )
        overfull = sizes.where(crowded & (F.col("n") > 1)).select("range", "by_key", "by_tie")
        if overfull.isEmpty():
            return rows
        value = F.when(F.col("by_key"), F.col("key")).when(F.col("by_tie"), F.col("tie")).otherwise(F.col("salt"))
        cuts = (
            rows.join(overfull, "range")
            .groupBy("range", "by_key", "by_tie")
            .agg(
                F.array_distinct(
                    F.percentile_approx(value, [i / FAN for i in range(1, FAN)], 100 * FAN)
                ).alias("cuts")
            )
        )
        # ranges of one round: below the first cut, at it, between it and the second, ...
        at_or_below = F.size(F.filter("cuts", lambda c: c <= F.col("value")))
        inside = F.size(F.filter("cuts", lambda c: c < F.col("value"))) + at_or_below
        # numbered anew in each round, so that numbers grow with the ranges and not with the rounds
        parts = stored(
            rows.join(cuts, "range", "left")
            .withColumn("value", value)
            .withColumn("part", F.when(F.col("cuts").isNull(), 0).otherwise(inside))
            .drop("cuts", "by_key", "by_tie", "value"),
            "parts",
        )
        numbers = parts.select("range", "part").distinct().withColumn(
            "number", F.row_number().over(Window.orderBy("range", "part")).cast("long") - 1
        )
        rows = stored(
            parts.join(numbers, ["range", "part"]).drop("range", "part").withColumnRenamed("number", "range"),
            "ranges",
        )


def shard(
    docs: DataFrame,
    shards: int = 24,
    ranges_per_shard: int = 16,
    per_range: int = 32,
    max_rows: int = 200_000,
) -> DataFrame:
    """The records with their columns and ``PLACES``, stored in a folder for each shard.

    Each goes to one of ``shards`` key ranges with near-equal bytes. A column of ``docs`` that is
    named like one of ``PLACES`` is replaced.
    """
    columns = [c for c in docs.columns if c not in PLACES]
    rows = stored(records(docs.select(*columns)), "records", codec="zstd")
    total = rows.agg(F.sum("size")).first()[0] or 0
    placed = range_partition(rows, total, shards * ranges_per_shard, per_range, max_rows)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("range")
        .agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
        .select(
            "range",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        )
    )
    within = Window.partitionBy("range").orderBy("key", "tie", "salt")
    running = within.rowsBetween(Window.unboundedPreceding, -1)
    ordered = (
        placed.withColumn("row", F.row_number().over(within) - 1)
        .withColumn("first_byte", F.coalesce(F.sum("size").over(running), F.lit(0)))
        .join(starts, "range")
        .withColumn("row", F.col("row") + F.col("rows_before"))
        .withColumn("first_byte", F.col("first_byte") + F.col("bytes_before"))
        .withColumn(
            "shard", F.expr(f"cast(cast(first_byte as decimal(38)) * {shards} div {max(1, total)} as int)")
        )
    )
    # of the columns without the record; one row per shard, so its size is bounded by their number
    found = ordered.groupBy("shard").agg(F.min("row").alias("first")).collect()
    firsts = F.broadcast(
        docs.sparkSession.createDataFrame([(r.shard, r.first) for r in found], "shard int, first long")
    )
    whole_records = ordered.join(firsts, "shard").select(
        *[F.col("record")[c].alias(c) for c in columns],
        "size",
        "text_crc32",
        "shard",
        (F.col("row") - F.col("first")).alias("slot"),
    )
    return stored(whole_records.sortWithinPartitions("shard", "slot"), "shards", by=["shard"])


def digest(placed: DataFrame) -> DataFrame:
    """Checksum, size and place of every record of the shards."""
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
