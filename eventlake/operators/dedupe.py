"""One row per key, with a survivor that does not depend on row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The smallest row of each key by ``order_by``, ties decided by all other columns.

    An aggregate, not a window: each task reduces its copies of a key to one row before
    the shuffle, so a key that holds a large part of the input costs one row per task.
    """
    keys, order_by = list(keys), list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    if not order_by + rest:
        return df.distinct()
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*order_by, *rest)).alias("_first"))
        .select(*[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns])
    )
