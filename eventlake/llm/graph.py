"""Connected components of links between rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.work import stored


#: Links that are joined in one task; more go through rounds.
FEW = 100_000


def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(node, component) of the nodes in all links (a, b) of a task."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    yield pd.DataFrame({"node": list(root), "component": [find(x) for x in list(root)]}, dtype="int64")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in links (a, b), which are longs in a stored table; the
    component is its smallest node.

    At most ``FEW`` links are joined in one task, for a round costs several shuffles however few there
    are. Of more, each round every node takes the smallest label next to it, and then the label of its
    label. Labels are written out after each round, so the lineage stays short.
    """
    if links.count() <= FEW:
        return stored(links.select("a", "b").repartition(1).mapInPandas(joined, "node long, component long"), "labels")
    both = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.col("a")).alias("component")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("component").alias("least"))
        )
        taken = labels.join(near, F.col("node") == F.col("a")).select(
            "node", "component", F.least("least", "component").alias("least")
        )
        jumped = (
            taken.alias("t")
            .join(labels.select(F.col("node").alias("n"), F.col("component").alias("c")), F.col("least") == F.col("n"))
            .select("node", F.least("least", "c").alias("component"), F.col("t.component").alias("was"))
        )
        new = stored(jumped, "labels")
        labels = new.select("node", "component")
        if new.where("component <> was").isEmpty():
            return labels
