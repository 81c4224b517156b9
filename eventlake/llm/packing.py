"""Packing into optimal length buckets.

Lengths are counted into one global histogram. A dynamic program over it chooses the bucket
boundaries that minimise padding, where a document is padded to its bucket's boundary. Inside a
bucket, batches are formed under a token budget: as many documents as fit when padded, at least
one. A document longer than the budget is a batch of its own; nothing is cut or dropped.

Whole documents are packed: the result is stored by bucket, in order of batches, with every
column of the input. Length is the number of words. A missing or empty text has length 0 and is packed like any
other, and stays missing. Rows with equal ids are kept apart. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.work import numbered, stored, whole

PLACES = ("n_tokens", "bucket", "padded", "batch", "slot")

WORD = r"[^\x20\x09-\x0D]+"


def histogram(lengths: DataFrame) -> list[tuple[int, int]]:
    """(length, rows) of every length that occurs.

    L different lengths have at least L * L / 2 words together, so the driver holds the square root of
    twice the number of words at most.
    """
    rows = lengths.groupBy("n_tokens").agg(F.count("*").alias("rows")).collect()
    return sorted((r.n_tokens, r.rows) for r in rows)


def boundaries(bins: list[tuple[int, int]], buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets with the least padding in total.

    ``best[j]`` is the least padded size of the first j bins with k buckets. A bucket over bins
    i..j costs rows(i..j) * length(j), which satisfies the quadrangle inequality, so the best
    split moves right with j and each round is solved by halving.
    """
    if not bins:
        return []
    length = np.array([b[0] for b in bins], dtype=np.float64)
    rows = np.concatenate([[0], np.cumsum([b[1] for b in bins])]).astype(np.float64)
    m = len(bins)
    best = np.concatenate([[0.0], rows[1:] * length])
    cut = [np.zeros(m + 1, dtype=np.int64)]
    for _ in range(min(buckets, m) - 1):
        new, at = best.copy(), np.arange(m + 1)
        spans = [(1, m, 0, m - 1)]
        while spans:
            low, high, left, right = spans.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(left, min(right, j - 1) + 1)
            cost = best[i] + (rows[j] - rows[i]) * length[j - 1]
            k = int(np.argmin(cost))
            new[j], at[j] = cost[k], i[k]
            spans += [(low, j - 1, left, int(i[k])), (j + 1, high, int(i[k]), right)]
        best = new
        cut.append(at)
    out, j = [], m
    for at in reversed(cut):
        if j:
            out.append(int(length[j - 1]))
            j = int(at[j])
    return sorted(set(out))


def pack(docs: DataFrame, buckets: int = 16, budget: int = 16_384) -> DataFrame:
    """The documents with their columns and ``PLACES``, stored by bucket and batch.

    ``docs`` should be a stored table: it is read for the lengths and again for the documents.
    A column of ``docs`` that is named like one of ``PLACES`` is replaced.
    """
    columns = [c for c in docs.columns if c not in PLACES]
    text = whole()
    lengths = docs.select(
        F.struct(*columns).alias("record"),
        F.struct("doc_id", F.xxhash64(text)).alias("key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"),
    )
    uppers = boundaries(histogram(lengths), buckets)
    upper = F.array(*[F.lit(u).cast("long") for u in uppers]).cast("array<bigint>")
    # a sum, as a function of an array would count the words again for each of its elements
    bucket = sum(((F.col("n_tokens") > u).cast("int") for u in uppers), F.lit(0))
    placed = lengths.withColumn("bucket", bucket).withColumn("padded", F.get(upper, F.col("bucket")))
    rows = numbered(placed, "bucket", F.col("key"), "row")
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), F.col("padded"))))
    batched = rows.withColumn("batch", F.floor(F.col("row") / per_batch)).withColumn(
        "slot", F.pmod(F.col("row"), per_batch)
    )
    packed = batched.select(*[F.col("record")[c].alias(c) for c in columns], *PLACES).sortWithinPartitions("bucket", "batch", "slot")
    return stored(packed, "packed", by=["bucket"])


def digest(packed: DataFrame) -> DataFrame:
    """Bucket, batch and place of every packed document, with its padded length."""
    return packed.select("doc_id", *PLACES)
