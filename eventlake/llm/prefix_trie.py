"""The trie of all prefixes of conversations, by truncation peeling.

A conversation is its turns in order. Each prefix has a key, the exclusive or of 128-bit hashes of
its turns with their depth, so the key of the prefix without its last turn is one operation away. The
trie is peeled from its greatest depth: at each depth the conversations that end there are merged
with the nodes that came up from below, which gives the nodes of the depth with all counts of
their subtrees; then every node loses its last turn and goes up. A turn takes part once, at its own
depth, and a node's rows are reduced before they are shuffled, so a first turn that very many
conversations share costs a row per task. Neighbouring depths with at most ``THIN`` turns in all, as at the
ends of a few very long conversations, are peeled in one task; every other depth is a round of its own.

Turns are ordered by number, missing ones first, and turns with equal numbers by a digest of their
contents. A missing role or text counts as empty. Rows without a conversation id belong to no
conversation and take no part. An empty table has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.work import ship, stored, whole, words_of
from eventlake.session import fresh_dir

#: Conversations that share the head of one.
FAMILY = 20
#: Turns of a head are fewer than this.
HEADS = 4
#: Conversation ids that are joined into one piece of text.
PIECE = 4096
#: Depths with fewer turns than this in all are peeled in one task.
THIN = 20_000
KEY = ["depth", "k1", "k2"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, digest, words) of each turn, ``at`` counting from 1."""
    role, text = whole("role"), whole("text")
    content = F.concat_ws(":", F.length(role).cast("string"), role, text)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.sha2(content, 256)).alias("digest"),
        F.size(words_of(text)).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    return turns.select("conv_id", F.row_number().over(order).alias("at"), "digest", "words")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, length, depth, digest, words): every conversation with the first turns of the first
    one of its family in place of its own; one without turns is one row of depth 0."""
    own_head = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEADS)).cast("int")
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = (
        turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("at") < HEADS))
        .groupBy(F.col("conv_id").alias("family"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "digest", "words"))).alias("head"))
    )
    conversations = (
        turns.groupBy("conv_id")
        .agg(F.count(F.lit(1)).alias("turns"))
        .withColumn("family", family)
        .withColumn("own_head", own_head)
        .join(heads, "family", "left")
        .withColumn("head", F.filter("head", lambda t: t["at"] <= F.col("own_head")))
        .withColumn("taken", F.when(F.col("head").isNull(), 0).otherwise(F.size("head")))
        .withColumn("length", F.col("taken") + F.greatest(F.col("turns") - F.col("own_head"), F.lit(0)))
        .select("conv_id", "own_head", "taken", "length", "head")
    )
    first = conversations.select("conv_id", "length", F.inline("head")).select(
        "conv_id", "length", F.col("at").cast("long").alias("depth"), "digest", "words"
    )
    rest = (
        turns.join(conversations.drop("head"), "conv_id")
        .where("at > own_head")
        .select("conv_id", "length", (F.col("taken") + F.col("at") - F.col("own_head")).cast("long").alias("depth"), "digest", "words")
    )
    none = conversations.where("length = 0").select(
        "conv_id",
        "length",
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("binary").alias("digest"),
        F.lit(0).cast("long").alias("words"),
    )
    return first.unionByName(rest).unionByName(none)


def prefixes(turns: DataFrame) -> DataFrame:
    """Each turn with the key of the prefix that ends with it, and of the one without it."""
    so_far = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    hashed = turns
    for n in (1, 2):
        own = F.when(F.col("depth") > 0, F.xxhash64(F.lit(n), "depth", "digest")).otherwise(0)
        hashed = hashed.withColumn(f"m{n}", own)
    keyed = hashed.withColumns({f"k{n}": F.bit_xor(f"m{n}").over(so_far) for n in (1, 2)})
    return keyed.select(
        *KEY,
        *[F.col(f"k{n}").bitwiseXOR(F.col(f"m{n}")).alias(f"p{n}") for n in (1, 2)],
        "words",
        "conv_id",
        (F.col("depth") == F.col("length")).alias("ended"),
    )


NODE = [*KEY, "p1", "p2", "words", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
NODE_SCHEMA = ", ".join(f"{c} long" for c in NODE)
#: What a missing number is in a row that is merged: it never wins the largest or the smallest.
LEAST, MOST = -(2**63), 2**63 - 1


def bands(sizes: dict[int, int]) -> list[tuple[int, int]]:
    """Depths as (lowest, highest), deepest first. Neighbours with ``THIN`` turns at most in all are one
    band; the root is a band of its own, for any number of nodes comes up to it."""
    out, total = [], 0
    for depth in range(max(sizes), 0, -1):
        size = sizes.get(depth, 0)
        if out and total + size <= THIN:
            out[-1], total = (depth, out[-1][1]), total + size
        else:
            out.append((depth, depth))
            total = size
    return [*out, (0, 0)]


def merged(rows: DataFrame) -> DataFrame:
    """The nodes of one depth, from conversations that end there and nodes that came up."""
    nodes = rows.groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in ("p1", "p2", "words")],
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    return nodes.withColumns(
        {
            "n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long"),
            "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"),
        }
    )


def merged_band(batches):
    """The same for all depths of a band, which is small, in one task."""
    rows = pa.Table.from_batches(batches).to_pandas() if (batches := list(batches)) else None
    if rows is None or rows.empty:
        return
    how = {c: "max" for c in ("p1", "p2", "words")} | {"conv_id": "min"}
    how |= {c: "sum" for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
    by_depth = dict(iter(rows.groupby("depth")))
    risen = None
    for depth in range(max(by_depth), min(by_depth) - 1, -1):
        here = [x for x in (by_depth.get(depth), risen) if x is not None]
        nodes = pd.concat(here).groupby(KEY, as_index=False).agg(how)
        nodes["n_leaves"] = nodes["n_leaves"].where(nodes["n_children"] > 0, 1)
        nodes["saved_tokens"] += (nodes["n_convs"] - 1) * nodes["words"]
        yield pa.RecordBatch.from_pandas(nodes[NODE], preserve_index=False)
        risen = nodes.assign(depth=depth - 1, k1=nodes["p1"], k2=nodes["p2"], p1=LEAST, p2=LEAST, words=0, n_children=1)


def stripped(nodes: DataFrame, depth: int) -> DataFrame:
    """The nodes of a depth without their last turn, as rows of the depth above."""
    gone = {"depth": F.lit(depth - 1), "k1": F.col("p1"), "k2": F.col("p2"), "p1": F.lit(LEAST), "p2": F.lit(LEAST)}
    gone |= {"words": F.lit(0), "n_children": F.lit(1)}
    return nodes.where(F.col("depth") == depth).select(*[gone.get(c, F.col(c)).cast("long").alias(c) for c in NODE])


def peel(steps: DataFrame) -> DataFrame:
    """One row per node: its key, the key without its last turn, and the counts of its subtree."""
    spark = steps.sparkSession
    # Only a conversation that ends here is counted here; the others come up with their nodes.
    numbers = {"conv_id": F.when(F.col("ended"), F.col("conv_id")).otherwise(MOST), "n_convs": F.col("ended")}
    numbers |= {c: F.lit(0) for c in ("n_children", "n_leaves", "saved_tokens")}
    rows = steps.select(*[numbers.get(c, F.col(c)).cast("long").alias(c) for c in NODE])
    # One number for each depth.
    sizes = {r["depth"]: r["count"] for r in steps.groupBy("depth").count().collect()}
    if not sizes:
        return spark.createDataFrame([], NODE_SCHEMA)
    folder = fresh_dir(spark, "trie-nodes")
    risen = None
    for low, high in bands(sizes):
        band = rows.where(F.col("depth").between(low, high))
        if risen is not None:
            band = band.unionByName(risen)
        nodes = merged(band) if low == high else band.repartition(1).mapInArrow(merged_band, NODE_SCHEMA)
        nodes.write.parquet(f"{folder}/low={low}")
        risen = stripped(spark.read.schema(NODE_SCHEMA).parquet(f"{folder}/low={low}"), low)
    return spark.read.schema(f"{NODE_SCHEMA}, low long").parquet(folder).select(*NODE)


def joined_ids(batches):
    """Consecutive ids of a node as pieces of text: (key, number of the first, ids with commas)."""

    def piece(key, ids):
        return (*key, ids[0], ",".join(map(str, ids)))

    key, ids = None, []
    for batch in batches:
        out = []
        for *k, conv_id in zip(*[batch.column(c).to_pylist() for c in (*KEY, "conv_id")], strict=True):
            if ids and (k != key or len(ids) == PIECE):
                out.append(piece(key, ids))
                ids = []
            key = k
            ids.append(conv_id)
        yield rows_of(out, PIECES)
    if ids:
        yield rows_of([piece(key, ids)], PIECES)


def digested(batches):
    """The digest of a node's pieces, which come in order."""
    key, digest = None, None
    for batch in batches:
        out = []
        for *k, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "ids")], strict=True):
            if k == key:
                digest.update(b",")
            else:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            digest.update(ids.encode())
        yield rows_of(out, DIGESTS)
    if key is not None:
        yield rows_of([(*key, digest.hexdigest())], DIGESTS)


PIECES = [*[(c, pa.int64()) for c in (*KEY, "first")], ("ids", pa.string())]
DIGESTS = [*[(c, pa.int64()) for c in KEY], ("ends_sha256", pa.string())]


def rows_of(rows: list[tuple], fields: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def ends_digest(steps: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes at which conversations end.

    A digest is made in order, so the last step sees all of a node's ids, but as text of many ids a
    row and one row after the other; the ids are sorted and joined in ranges that split any node.
    """
    ids = [*KEY, "conv_id"]
    ended = steps.where("ended").select(*ids)
    pieces = (
        ended.repartitionByRange(*ids)
        .sortWithinPartitions(*ids)
        .mapInArrow(joined_ids, ", ".join(f"{c} long" for c in (*KEY, "first")) + ", ids string")
    )
    return (
        pieces.repartition(*KEY)
        .sortWithinPartitions(*KEY, "first")
        .mapInArrow(digested, ", ".join(f"{c} long" for c in KEY) + ", ends_sha256 string")
    )


def trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the empty one included."""
    ship(conversations.sparkSession)
    turns = stored(ordered_turns(conversations), "trie-turns")
    # In order of depth, so that a round reads the files and row groups of its own depth.
    steps = prefixes(rebuilt(turns)).repartitionByRange("depth", "conv_id").sortWithinPartitions("depth")
    steps = stored(steps, "trie-steps")
    nodes = peel(steps)
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("k1").alias("p1"),
        F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return (
        nodes.join(parents, ["depth", "p1", "p2"], "left")
        .join(ends_digest(steps), KEY, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
