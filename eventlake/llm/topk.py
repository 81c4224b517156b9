"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into equal segments; each keeps its mean and deviation. For two vectors the
squared distance is at least the sum over segments of m * ((mean - mean')^2 + (dev - dev')^2), so
the inner product, which is half of the squared lengths less the distance, is at most the sum of
m * (mean * mean' + dev * dev'). The bound is first taken over one segment, then over finer ones;
only candidates that still reach a query's k-th best exact score are compared in full.

Components become floor(scale * x). Vectors that are missing, or hold a missing or non-finite
component, take no part; vectors are compared with those of their own length. A query is not its
own candidate; of rows with equal ids each is a candidate (and a query) of its own. Ties go to
the smaller id. Without queries or candidates the result is empty. Scores are exact while they
fit 64 bits.

Queries are blocked and meet every block of candidates; each meeting is one bounded task that
returns k rows a query, and Spark ranks these.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.work import ship, stored

LEVELS = (1, 4, 16)
EXACT = 2.0**53


def quantised(vectors: DataFrame, key: str, column: str, scale: int) -> DataFrame:
    """Usable vectors as whole numbers, with their length."""
    x = F.col(column)
    fine = F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return (
        vectors.where(x.isNotNull() & fine & F.col(key).isNotNull())
        .select(F.col(key).alias("id"), whole.alias("v"), F.size(x).alias("dim"))
    )


def segments(v: np.ndarray, parts: int) -> np.ndarray:
    """Means and deviations of each segment, scaled so that a dot product gives the bound."""
    cuts = np.linspace(0, v.shape[1], min(parts, v.shape[1]) + 1).astype(int)
    cols = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        seg = v[:, a:b]
        root = np.sqrt(b - a)
        cols += [seg.mean(axis=1) * root, seg.std(axis=1) * root]
    return np.stack(cols, axis=1)


def search_block(qid, q, cid, c, k: int):
    """Top k of each query among the candidates of a block: (position of the query, candidate id, score)."""
    qf, cf = q.astype(np.float64), c.astype(np.float64)
    longest = np.abs(qf).max(initial=0) * np.abs(cf).max(initial=0) * max(1, q.shape[1])
    exact = cf if longest < EXACT else c
    queries = qf if longest < EXACT else q
    levels = [(segments(qf, p), segments(cf, p)) for p in LEVELS] if q.shape[1] else []
    slack = 1e-9 * np.linalg.norm(qf, axis=1) * np.linalg.norm(cf, axis=1).max(initial=0) + 1e-6
    rows = []
    for i in range(len(q)):
        alive = np.flatnonzero(cid != qid[i])
        if not len(alive):
            continue
        score, least = None, -np.inf
        for a, b in levels:
            bound = b[alive] @ a[i] + slack[i]
            if score is None:
                # exact scores of the likeliest give the first threshold
                first = alive[np.argpartition(-bound, min(4 * k, len(bound)) - 1)[: 4 * k]]
                score = np.sort(exact[first] @ queries[i])
                least = score[-k] if len(score) >= k else -np.inf
            alive = alive[bound >= least]
        score = exact[alive] @ queries[i]
        best = np.lexsort((cid[alive], -score))[:k]
        rows.append((np.full(len(best), i), cid[alive[best]], score[best].astype(np.int64)))
    return [np.concatenate(x) for x in zip(*rows, strict=True)] if rows else None


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    key: str = "vec_id",
    column: str = "embedding",
    scale: int = 1024,
    block: int = 8192,
    query_block: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of every row for which ``is_query`` holds. Query rows with one id
    each give ``k`` rows."""
    ship(vectors.sparkSession)
    rows = stored(
        quantised(vectors.withColumn("_query", is_query), key, column, scale)
        .withColumn("place", F.xxhash64("id", "v")),
        "vectors",
    )
    queries = stored(
        quantised(vectors.where(is_query), key, column, scale)
        .withColumn("place", F.xxhash64("id", "v", F.lit(1)))
        .withColumn("query_row", F.monotonically_increasing_id()),
        "queries",
    )
    n, n_queries = rows.count(), queries.count()
    blocks, query_blocks = -(-n // block) or 1, -(-n_queries // query_block) or 1
    # a block of queries goes to every block of candidates and the other way round
    left = queries.withColumn("qb", F.pmod("place", F.lit(query_blocks))).withColumn(
        "cb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    right = rows.withColumn("cb", F.pmod("place", F.lit(blocks))).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    )
    by = [F.col("cb").cast("int"), F.col("qb").cast("int"), F.col("dim")]

    def meet(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        ids, found = q["id"].to_numpy(), None
        if len(q) and len(c):
            found = search_block(ids, np.stack(q["v"]), c["id"].to_numpy(), np.stack(c["v"]), k)
        at, vec_id, score = found or [np.zeros(0, np.int64)] * 3
        own = q["query_row"].to_numpy()
        return pd.DataFrame({"query_row": own[at], "query_id": ids[at], "vec_id": vec_id, "score": score})

    near = (
        left.groupBy(*by)
        .cogroup(right.groupBy(*by))
        .applyInPandas(meet, "query_row long, query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
