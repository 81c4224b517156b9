"""Sorted heads of a result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, measure: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest measure. Each task keeps its own ``k`` before the
    final merge, so nothing is sorted as a whole."""
    order = [F.desc_nulls_last(measure), *[F.asc_nulls_last(c) for c in tie_break]]
    return df.orderBy(*order).limit(k)


def first_n(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by a total order: the row cap of a smoke run."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in order_by]).limit(n)
