"""How filters interact: what each removes in every order, by sorted posting lists.

The rows of a table are numbered, and each filter keeps the sorted list of the rows that fail it, per
part and range of ``RANGE`` row numbers, with one list each for good and for toxic rows. Unions of the
lists and what a list adds to a union are found by galloping merges within the ranges; only their
sizes are summed over ranges. A part that holds most rows is many ranges, and a list has ``RANGE``
entries at most.

A missing text counts as empty, a missing source as the part "". Rows with equal ids are rows of their
own; a row repeats a text if any row with that text has a smaller id, and a row without an id
repeats none. Of several labels of an id any that says good (or toxic) counts. An empty table has no
parts. Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.work import ship, stored, whole, words_of

FILTERS = "ABCDE"
#: Row numbers in a range; the entries of a posting list are positions in their range.
RANGE = 1024
#: Of every so many searches one starts afresh, the others gallop from it.
AFRESH = 64


def flagged(docs: DataFrame) -> DataFrame:
    """One narrow row per document: its number, part, id, text digest and what it fails."""
    text, words = whole(), words_of(whole())
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce("source", F.lit("")).alias("part"),
        "doc_id",
        F.unhex(F.sha2(text, 256)).alias("digest"),
        (F.size(words) < 200).alias("A"),
        (100 * F.size(F.array_distinct(words)) < 50 * F.size(words)).alias("B"),
        (100 * capitals > 2 * F.length(text)).alias("C"),
        text.rlike("[#$%&*|]").alias("D"),
    )


def postings(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, range, documents, A ... E, good, toxic): the posting lists of a range of rows."""
    rows = stored(flagged(docs), "audit-rows")
    first = (
        rows.where("doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"))
        .withColumn("first", F.lit(True))
    )
    marks = (
        labels.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    )
    marked = (
        rows.join(first, ["digest", "doc_id"], "left")
        .withColumn("E", F.col("doc_id").isNotNull() & F.col("first").isNull())
        .join(marks, "doc_id", "left")
    )
    entry = F.pmod("row", F.lit(RANGE)).cast("short")
    lists = [
        F.sort_array(F.collect_list(F.when(F.col(name), entry))).alias(name)
        for name in (*FILTERS, "good", "toxic")
    ]
    return marked.groupBy("part", F.floor(F.col("row") / RANGE).alias("range")).agg(
        F.count(F.lit(1)).alias("documents"), *lists
    )


def gallop(long: np.ndarray, short: np.ndarray) -> np.ndarray:
    """Where each entry of ``short`` stands in ``long`` or would; both are sorted.

    A search starts where the first one of its block of ``AFRESH`` ended and takes steps that double,
    then halves the last step.
    """
    low = np.repeat(np.searchsorted(long, short[::AFRESH]), AFRESH)[: len(short)]
    high = low.copy()
    left, step = np.flatnonzero(high < len(long)), 1
    left = left[long[high[left]] < short[left]]
    while len(left):
        low[left] = high[left] + 1
        high[left] = np.minimum(high[left] + step, len(long))
        step *= 2
        left = left[high[left] < len(long)]
        left = left[long[high[left]] < short[left]]
    left = np.flatnonzero(low < high)
    while len(left):
        middle = (low[left] + high[left]) // 2
        less = long[middle] < short[left]
        low[left] = np.where(less, middle + 1, low[left])
        high[left] = np.where(less, high[left], middle)
        left = left[low[left] < high[left]]
    return low


def found(long: np.ndarray, short: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which entries of ``short`` are in ``long``, where ``at`` says they stand."""
    inside = at < len(long)
    inside[inside] = long[at[inside]] == short[inside]
    return inside


def differences(lists: list[np.ndarray]):
    """(filter, before, its entries in no list of the set of filters ``before``) for each filter and
    each set without it. Sets are bit masks."""
    unions = [np.zeros(0, dtype=np.int64)]
    places = {}
    for before in range(1 << len(lists)):
        if before:
            last = before.bit_length() - 1
            rest = before ^ 1 << last
            at, new = places.pop((last, rest))
            unions.append(np.insert(unions[rest], at, new))
        for f, entries in enumerate(lists):
            if not before >> f & 1:
                at = gallop(unions[before], entries)
                new = ~found(unions[before], entries, at)
                if f >= before.bit_length():
                    places[f, before] = at[new], entries[new]
                yield f, before, entries[new]


def sizes(batches):
    """Sizes of the differences of posting lists, summed by part over the ranges of a batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.column("part").dictionary_encode()
        part, parts = names.indices.to_numpy(), len(names.dictionary)

        def concatenated(name, batch=batch):
            column = batch.column(name)
            of = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy())
            return of * RANGE + column.flatten().to_numpy()

        def by_part(entries, part=part, parts=parts):
            return np.bincount(part[entries // RANGE], minlength=parts)

        lists = [concatenated(f) for f in FILTERS]
        good, toxic = concatenated("good"), concatenated("toxic")
        documents = np.bincount(part, weights=batch.column("documents").to_numpy(), minlength=parts)
        unions = [np.zeros(parts, dtype=np.int64)] * (1 << len(lists))
        for f, before, new in differences(lists):
            removed = by_part(new)
            unions[before | 1 << f] = unions[before] + removed
            yield pa.RecordBatch.from_pydict(
                {
                    "part": names.dictionary,
                    "filter": pa.array([FILTERS[f]] * parts),
                    "before": pa.array(np.full(parts, before, dtype=np.int32)),
                    "documents": pa.array(documents.astype(np.int64)),
                    "removed": pa.array(removed),
                    "union": pa.array(unions[before | 1 << f]),
                    "good_lost": pa.array(by_part(new[found(good, new, gallop(good, new))])),
                    "toxic_lost": pa.array(by_part(new[found(toxic, new, gallop(toxic, new))])),
                }
            )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with counts of the part's rows: ``kept`` after
    the step, ``removed`` in it, ``redundant`` (failing, but removed before), ``unique_fails``
    (failing this filter only), ``good_lost`` and ``toxic_lost`` (removed here with that label), and
    ``shapley``, what the filter removes summed over all orders."""
    spark = docs.sparkSession
    ship(spark)
    lists = stored(postings(docs, labels), "audit-postings")
    counts = ("documents", "removed", "union", "good_lost", "toxic_lost")
    columns = ", ".join(f"{c} long" for c in counts)
    summed = (
        lists.mapInArrow(sizes, f"part string, filter string, before int, {columns}")
        .groupBy("part", "filter", "before")
        .agg(*[F.sum(c).alias(c) for c in counts])
    )
    # The orders that have the set ``before`` in front of a filter: of its members, of the others.
    set_size = F.bit_count("before")
    orders = F.factorial(set_size) * F.factorial(len(FILTERS) - 1 - set_size)
    of_filter = Window.partitionBy("part", "filter")
    alone = F.when(F.col("before") == 0, F.col("removed"))
    last = F.when(set_size == len(FILTERS) - 1, F.col("removed"))
    steps = [
        ("".join(order), n + 1, order[n], sum(1 << FILTERS.index(f) for f in order[:n]))
        for order in permutations(FILTERS)
        for n in range(len(order))
    ]
    # As many rows as the filters have orders and steps.
    steps = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, filter string, before int"))
    return (
        summed.withColumn("redundant", F.max(alone).over(of_filter) - F.col("removed"))
        .withColumn("unique_fails", F.max(last).over(of_filter))
        .withColumn("shapley", F.sum(orders * F.col("removed")).over(of_filter))
        .join(steps, ["filter", "before"])
        .select(
            "part",
            "filter_order",
            "step",
            (F.col("documents") - F.col("union")).alias("kept"),
            "removed",
            "redundant",
            "unique_fails",
            "good_lost",
            "toxic_lost",
            "shapley",
        )
    )
