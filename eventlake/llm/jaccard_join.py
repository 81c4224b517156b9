"""N-gram Jaccard join by token combinations.

A document's tokens are its distinct word shingles. Two sets that reach the threshold differ in
few tokens, at most ``d`` of both together for their sizes. The prefix is extended to the whole
set and tokens are dealt by their hash into d + 1 classes, so at least one class holds the same
tokens in both sets. Each class is indexed by the combination of its tokens, or by the token itself
where it holds one; unrelated documents that merely share a passage or common shingles rarely
agree on a whole combination. d depends on the sizes, so sets are indexed by size class, and
those near a class's upper end in the next class too.

The class that is equal may be empty in both sets, which gives no common entry. Then the tokens that
differ touch every class that is not empty, so only sets with at most as many such classes as tokens
that can differ are concerned: short ones, and few of the others. They are indexed by their prefix
as well, the n - ceil(t n) + 1 smallest tokens one by one, which pairs that reach the threshold share.

Equal sets are one entry, and index entries with the same members are one group. Sets of a group
are compared by sketches (sums of token hashes by class, of which a pair that reaches the
threshold can differ in d at most), in three rounds. First each set meets the others of its largest
group only, and the closest pairs that span them are verified token by token. Then the closest
pairs that span the components of every group are; then, where there are further close pairs, the sets
meet with their tokens: all close pairs of sets in different components are verified in the task
that finds them, which returns the links that join components. So a group of near copies costs a
row for each member and not each pair, and no link between different sets that would join two
components is lost. Groups too large for a task are dealt into chunks, and every two chunks that still
hold several components meet in a block; pairs are only returned from a chunk and its neighbours, and
of other blocks whether they hold close pairs.

A missing or blank text has an empty set and is its own component. Rows with equal ids are compared
by their sets like any others. A row without an id is in the component of rows with an equal set, and
otherwise in none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.graph import components
from eventlake.llm.work import beside, ship, stored, whole

WIDER = 1.63
#: Members of a group that are compared in one task.
MEMBERS = 1024
#: Tokens of sets that meet in one task.
TOKENS = 4_000_000
#: Documents whose sets are in memory together.
SLICE = 500
ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX
    return x ^ (x >> np.uint64(27))


def shingles(text: str, words: int) -> np.ndarray:
    """The distinct shingle hashes of a text."""
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = min(words, len(found))
    out = np.full(len(found) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = mixed(out * ODD + hashes[i : len(hashes) - n + 1 + i])
    return np.unique(out)


@lru_cache(maxsize=8)
def size_classes(percent: int, most: int = 1 << 40) -> list[int]:
    """Lower ends of the size classes; partners differ by one class at most."""
    ends = [1]
    while ends[-1] < most:
        ends.append(max(ends[-1] + 1, -(-100 * ends[-1] // percent), int(ends[-1] * WIDER)))
    return ends


def combinations(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Index entries of a set: one for each class of tokens that is not empty, and one for each token
    of the prefix where a partner may agree in empty classes only."""
    n, ends = len(tokens), size_classes(percent)
    at = int(np.searchsorted(ends, n, side="right")) - 1
    entries = []
    for c in (at, at + 1):
        if c > at and 100 * n < percent * ends[c]:
            continue  # too small for any partner of the next class
        largest = ends[c + 1] - 1
        classes = np.uint64((100 - percent) * 2 * largest // (100 + percent) + 1)
        own = (mixed(tokens) >> np.uint64(8)) % classes
        order = np.argsort(own, kind="stable")
        own = own[order]
        starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        total = np.add.reduceat(mixed(tokens[order] ^ ODD), starts)
        entries.append(mixed(total + own[starts] * ODD + np.uint64(c)))
        most = (100 - percent) * (n + min(100 * n // percent, largest)) // (100 + percent)
        if len(starts) <= most:
            prefix = tokens[: n - -(-percent * n // 100) + 1]
            entries.append(mixed(mixed(prefix ^ MIX) * ODD + np.uint64(c)))
    return np.concatenate(entries).view(np.int64)


def set_key(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Sums of token hashes, modulo 16, by class, two to a byte; a power of two of classes, one to
    two for each token.

    Adding the halves gives the sketch with half as many classes.
    """
    classes = max(16, 1 << (len(tokens) - 1).bit_length())
    h = mixed(tokens ^ MIX)
    own = (h % np.uint64(classes)).astype(np.int64)
    sums = np.bincount(own, weights=(h >> np.uint64(40) & np.uint64(15)).astype(float), minlength=classes)
    sums = sums.astype(np.int64).astype(np.uint8) & 15
    return sums[: classes // 2] | sums[classes // 2 :] << 4


def unpacked(raw: bytes, width: int) -> np.ndarray:
    """A sketch with ``width`` classes."""
    both = np.frombuffer(raw, dtype=np.uint8)
    return np.concatenate([both & 15, both >> 4]).reshape(-1, width).sum(axis=0, dtype=np.uint8) & 15


def index(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(entry, key, doc_id, n_shingles): index entries, where the last two are missing, and one
    row per document, whose entry stands for itself."""

    def run(batches):
        for batch in batches:
            sets = [shingles(t, words) for t in batch["text"]]
            keys = [set_key(s) for s in sets]
            fresh = {k: s for k, s in zip(keys, sets, strict=True) if len(s)}
            yield pd.DataFrame(
                {
                    "key": keys,
                    "n_shingles": [len(s) for s in sets],
                    "entries": [combinations(s, percent) if (s := fresh.pop(k, None)) is not None else [] for k in keys],
                }
            )

    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", whole().alias("text"))
    made = "key long, n_shingles long, entries array<long>"
    found = beside(texts, run, ["text"], ["doc_id"], made, rows=SLICE)
    own = F.struct(F.xxhash64("doc_id", "key").alias("entry"), "doc_id", "n_shingles")
    entries = F.transform(
        "entries",
        lambda e: F.struct(
            e.alias("entry"), F.lit(None).cast(kind).alias("doc_id"), F.lit(None).cast("long").alias("n_shingles")
        ),
    )
    return found.select("key", F.explode(F.concat(F.array(own), entries)).alias("x")).select("key", "x.*")


def sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(key, tokens, sketch) of the documents named in ``wanted`` (key, doc_id)."""

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.iloc[at : at + SLICE]
                found = [(k, shingles(t, words)) for k, t in zip(part["key"], part["text"], strict=True)]
                found = [(k, s) for k, s in found if set_key(s) == k]
                yield pd.DataFrame(
                    {
                        "key": [k for k, _ in found],
                        "tokens": pd.Series([s.view(np.int64) for _, s in found], dtype=object),
                        "sketch": pd.Series([sketch(s).tobytes() for _, s in found], dtype=object),
                    }
                )

    texts = docs.select("doc_id", whole().alias("text")).join(wanted.select("doc_id", "key"), "doc_id")
    return texts.select("key", "text").mapInPandas(run, "key long, tokens array<long>, sketch binary")


def close_rows(
    sketches: list[bytes], sizes: np.ndarray, percent: int, parts: np.ndarray, sides: np.ndarray | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(i, j, differing classes) for each member i with those in other ``parts`` that may reach the
    threshold with it and are not smaller.

    With ``sides`` each pair spans them; members of one side meet in the block of that side with itself.
    ``parts`` may be changed between the rows.
    """
    width = 2 * min(map(len, sketches))
    rows = np.zeros((len(sketches), width), dtype=np.uint8)
    for i, raw in enumerate(sketches):
        rows[i] = unpacked(raw, width)
    order = np.argsort(sizes, kind="stable")
    ends = np.searchsorted(sizes[order], 100 * sizes[order] // percent, side="right")
    for at, (i, end) in enumerate(zip(order.tolist(), ends.tolist(), strict=True)):
        j = order[at + 1 : end]
        j = j[parts[j] != parts[i]]
        if sides is not None:
            j = j[sides[j] != sides[i]]
        if len(j):
            differ = np.count_nonzero(rows[j] != rows[i], axis=1)
            near = differ <= (sizes[j] + sizes[i]) * (100 - percent) // (100 + percent)
            if near.any():
                yield i, j[near], differ[near]


def close_pairs(*block) -> np.ndarray:
    """(i, j, differing classes) of the pairs of ``close_rows``."""
    found = [np.stack([np.full(len(j), i), j, differ], axis=1) for i, j, differ in close_rows(*block)]
    return np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)


def joining_links(
    tokens: list[np.ndarray], sketches: list[bytes], percent: int, parts: np.ndarray
) -> list[tuple[int, int]]:
    """Pairs (i, j) that reach the threshold, enough to join all ``parts`` that such pairs join."""
    sizes = np.array([len(s) for s in tokens])
    starts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    names, own = np.unique(np.concatenate(tokens), return_inverse=True)
    mine, parts, links = np.zeros(len(names), dtype=np.int32), parts.copy(), []
    for i, j, _ in close_rows(sketches, sizes, percent, parts):
        mine[own[starts[i] : starts[i + 1]]] = 1
        theirs = np.concatenate([own[starts[x] : starts[x + 1]] for x in j.tolist()])
        shared = np.add.reduceat(mine[theirs], np.concatenate([[0], np.cumsum(sizes[j])[:-1]]))
        mine[own[starts[i] : starts[i + 1]]] = 0
        for x in j[100 * shared >= percent * (sizes[i] + sizes[j] - shared)].tolist():
            if parts[x] != parts[i]:
                parts[parts == parts[x]] = parts[i]
                links.append((i, x))
    return links


def spanning_pairs(i: np.ndarray, j: np.ndarray, parts: int) -> list[int]:
    """Of pairs of parts, best first, those that connect what the ones before do not."""
    root = list(range(parts))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    chosen = []
    for n, (x, y) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[x] = y
            chosen.append(n)
    return chosen


def by_block(work: Callable[[pd.DataFrame, Iterator[slice]], pd.DataFrame]):
    """Run ``work`` on frames of whole blocks, which come sorted, and the slices of those with two or
    more rows."""

    def done(rows: pd.DataFrame) -> pd.DataFrame:
        heads = np.append(np.flatnonzero(block_starts(rows)), len(rows)).tolist()
        return work(rows, (slice(a, b) for a, b in pairwise(heads) if b - a > 1))

    def run(batches):
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = int(np.flatnonzero(block_starts(batch))[-1]) if len(batch) else 0
            rest = batch.iloc[last:]
            yield done(batch.iloc[:last])
        if rest is not None:
            yield done(rest)

    return run


def block_starts(rows: pd.DataFrame) -> np.ndarray:
    out = np.zeros(len(rows), dtype=bool)
    out[:1] = True
    for c in ("entry", "low", "high"):
        x = rows[c].to_numpy()
        out[1:] |= x[1:] != x[:-1]
    return out


def compare(percent: int):
    """Of each block's pairs (a, b) with close sketches the closest that connect its components, as
    if all were links, and a row (entry, missing, low, high) where there are further ones. Blocks of
    chunks that are not neighbours only have that row, for close pairs of any kind."""

    def pairs_of(rows: pd.DataFrame, blocks: Iterator[slice]) -> pd.DataFrame:
        found, further, sketches = [np.zeros((0, 2), np.int64)], [], rows["sketch"].tolist()
        sizes, keys, parts, sides, low, high, near = (
            rows[c].to_numpy() for c in ("n", "key", "component", "side", "low", "high", "near")
        )
        for own in blocks:
            spans = sides[own] if low[own.start] != high[own.start] else None
            i, j, differ = close_pairs(sketches[own], sizes[own], percent, parts[own], spans).T
            chosen = []
            if near[own.start] and len(i):
                best = np.argsort(differ, kind="stable")
                names, part = np.unique(parts[own], return_inverse=True)
                chosen = best[spanning_pairs(part[i[best]], part[j[best]], len(names))]
                found.append(np.stack([keys[own][i[chosen]], keys[own][j[chosen]]], axis=1))
            if len(chosen) < len(i):
                further.append(own.start)
        ab = np.sort(np.concatenate(found), axis=1)
        pairs = pd.DataFrame({"a": ab[:, 0], "b": pd.array(ab[:, 1], dtype="Int64")}).drop_duplicates()
        left = rows.iloc[further][["entry", "low", "high"]].rename(columns={"entry": "a"})
        return pd.concat([pairs, left], ignore_index=True).astype({c: "Int64" for c in ("b", "low", "high")})[[*"ab", "low", "high"]]

    return by_block(pairs_of)


def involved(percent: int):
    """The members (entry, low, high, key, component) of each block with close sketches in another component."""

    def members_of(rows: pd.DataFrame, blocks: Iterator[slice]) -> pd.DataFrame:
        sketches, kept = rows["sketch"].tolist(), np.zeros(len(rows), dtype=bool)
        sizes, parts, sides, low, high = (rows[c].to_numpy() for c in ("n", "component", "side", "low", "high"))
        for own in blocks:
            spans = sides[own] if low[own.start] != high[own.start] else None
            for i, j, _ in close_rows(sketches[own], sizes[own], percent, parts[own], spans):
                kept[own.start + i] = True
                kept[own.start + j] = True
        return rows.loc[kept, ["entry", "low", "high", "key", "component"]]

    return by_block(members_of)


def verify(percent: int):
    """Links (a, b) that join the components of each block, found by its sketches and tokens."""

    def links_of(rows: pd.DataFrame, blocks: Iterator[slice]) -> pd.DataFrame:
        tokens, sketches = rows["tokens"].tolist(), rows["sketch"].tolist()
        keys, parts, found = rows["key"].to_numpy(), rows["component"].to_numpy(), []
        for own in blocks:
            links = joining_links(tokens[own], sketches[own], percent, parts[own])
            found += [sorted(keys[own][[i, j]].tolist()) for i, j in links]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64).drop_duplicates()

    return by_block(links_of)


def dealt(groups: DataFrame, chunks: Column, neighbours: bool = False) -> DataFrame:
    """Groups (entry, key, ...) dealt into chunks, of which every two, or with ``neighbours`` those
    next to each other, meet in the block (entry, low, high)."""
    around = [F.pmod(F.col("side") + step, F.col("chunks")) for step in (-1, 0, 1)]
    others = F.array_distinct(F.array(*around)) if neighbours else F.sequence(F.lit(0), F.col("chunks") - 1)
    return (
        groups.withColumn("chunks", F.ceil(chunks).cast("int"))
        .withColumn("side", F.pmod(F.xxhash64("key", "entry"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(others))
        .withColumn("low", F.least("side", "other"))
        .withColumn("high", F.greatest("side", "other"))
        .withColumn("near", (F.col("high") - F.col("low")).isin(0, 1) | (F.col("high") - F.col("low") == F.col("chunks") - 1))
    )


def together(blocks: DataFrame, *columns: str) -> DataFrame:
    return (
        blocks.select("entry", "low", "high", *columns)
        .repartition("entry", "low", "high")
        .sortWithinPartitions("entry", "low", "high")
    )


def candidates(groups: DataFrame, sets: DataFrame, percent: int, neighbours: bool = False) -> DataFrame:
    """Distinct pairs (a, b) to verify, and the blocks with further pairs as (entry, missing, low, high),
    from (entry, m, key, component).

    A group of m members is dealt into chunks of ``MEMBERS``; every two of them meet in one block, or
    with ``neighbours`` those next to each other.
    """
    sketches = sets.select("key", "sketch", F.size("tokens").cast("long").alias("n"))
    blocks = dealt(groups, F.col("m") / MEMBERS, neighbours).join(sketches, "key")
    return (
        together(blocks, "side", "near", "key", "component", "sketch", "n")
        .mapInPandas(compare(percent), "a long, b long, low int, high int")
        .distinct()
    )


def remaining(groups: DataFrame, further: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distinct links (a, b) that join the components of the blocks ``further`` (entry, low, high) of
    (entry, m, key, component). Only members with close sketches get their tokens; where those are
    more than ``TOKENS`` they are dealt into chunks once more."""
    blocks = dealt(groups, F.col("m") / MEMBERS).join(further, ["entry", "low", "high"], "left_semi")
    blocks = blocks.join(sets.select("key", "sketch", F.size("tokens").cast("long").alias("n")), "key")
    members = stored(
        together(blocks, "side", "key", "component", "sketch", "n")
        .mapInPandas(involved(percent), "entry long, low int, high int, key long, component long")
        .select(F.xxhash64("entry", "low", "high").alias("entry"), "key", "component"),
        "members",
    )
    sizes = sets.select("key", F.size("tokens").alias("n"))
    total = members.join(sizes, "key").groupBy("entry").agg(F.sum("n").alias("tokens"))
    parts = dealt(members.join(total, "entry"), F.col("tokens") / TOKENS).drop("tokens").join(sets, "key")
    return (
        together(parts, "key", "component", "tokens", "sketch")
        .mapInPandas(verify(percent), "a long, b long")
        .distinct()
    )


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold, compared token by token."""
    shared = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - shared
    return (
        pairs.join(sets.select(F.col("key").alias("b"), F.col("tokens").alias("y")), "b")
        .join(sets.select(F.col("key").alias("a"), F.col("tokens").alias("x")), "a")
        .where(100 * shared >= percent * union)
        .select("a", "b")
    )


def groups_of(entries: DataFrame) -> DataFrame:
    """(entry, m, key, largest) of one entry for each distinct set of members; ``largest`` is true
    in one group of each key."""
    members = (
        entries.groupBy("entry")
        .agg(
            F.count("*").alias("m"),
            F.sum(F.xxhash64("key").cast("decimal(20)")).alias("sum"),
            F.bit_xor(F.xxhash64("key", F.lit(1))).alias("xor"),
        )
    )
    kept = members.groupBy("m", "sum", "xor").agg(F.min("entry").alias("entry")).select("entry", "m")
    size = F.struct("m", "entry")
    largest = F.max(size).over(Window.partitionBy("key")) == size
    return entries.join(kept, "entry").withColumn("largest", largest)


def apart(groups: DataFrame, links: DataFrame) -> DataFrame:
    """The groups whose members are in several components of the links, with the component."""
    placed = groups.join(components(links), F.col("key") == F.col("node"), "left").select(
        "entry", "m", "key", F.coalesce("component", "key").alias("component")
    )
    split = (
        placed.groupBy("entry")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("entry")
    )
    return placed.join(split, "entry", "left_semi")


def classes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, key, n_shingles, component) of every row; a component is named by one of its sets."""
    ship(docs.sparkSession)
    entry = Window.partitionBy("entry")
    found = stored(
        index(docs, words, percent)
        .withColumn("shared", F.min("key").over(entry) != F.max("key").over(entry))
        .where("shared or n_shingles is not null"),
        "entries",
    )
    keys = found.where("n_shingles is not null").select("doc_id", "key", "n_shingles")
    shared = found.where("shared and n_shingles is null").select("entry", "key").distinct()
    groups = stored(groups_of(shared), "groups")
    named = keys.where("doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    wanted = named.join(groups.select("key").distinct(), "key", "left_semi")
    sets = stored(sets_of(docs, wanted, words), "sets")
    first = groups.where("largest").withColumn("component", F.col("key"))
    tried = candidates(first, sets, percent, neighbours=True).where("b is not null").select("a", "b")
    tried = stored(tried, "pairs")
    links = stored(linked(tried, sets, percent), "links")
    near = candidates(apart(groups, links), sets, percent)
    near = stored(near.join(tried, ["a", "b"], "left_anti"), "pairs")
    links = links.union(stored(linked(near, sets, percent), "links"))
    further = near.where("b is null").select(F.col("a").alias("entry"), "low", "high")
    left = apart(groups.join(further, "entry", "left_semi"), links)
    links = links.union(stored(remaining(left, further, sets, percent), "links"))
    by_set = components(links).select(F.col("node").alias("key"), "component")
    return keys.join(by_set, "key", "left").select(
        "doc_id", "key", "n_shingles", F.coalesce("component", "key").alias("component")
    )


def join(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id reachable by links, of every row."""
    placed = classes(docs, words, percent)
    least = (
        placed.where("n_shingles > 0")
        .groupBy("component")
        .agg(F.min("doc_id").alias("component_id"))
    )
    return placed.join(least, "component", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, with its own columns: a row with the smallest id, or with none where
    no row of the component has one. All texts without words stay.

    Rows whose id is unique are chosen by it. The others, those without an id among them, are placed by
    their sets, and of equal choices one stays.
    """
    placed = stored(classes(docs, words, percent), "classes")
    best = placed.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("best"))
    repeated = stored(
        placed.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").select("doc_id"),
        "repeated",
    )
    chosen = placed.join(best, "component", "left").where("n_shingles = 0 or doc_id = best").select("doc_id")
    if repeated.isEmpty():
        return docs.join(chosen, "doc_id", "left_semi").select(*docs.columns)
    clear = repeated.where("doc_id is not null")
    unique = docs.join(chosen.join(clear, "doc_id", "left_anti"), "doc_id", "left_semi").select(*docs.columns)
    rows = docs.select(F.struct(*docs.columns).alias("record"), "doc_id", whole().alias("text"))
    rows = rows.join(clear, "doc_id", "left_semi").unionByName(rows.where("doc_id is null"))

    def run(batches):
        for batch in batches:
            yield pd.DataFrame({"key": [set_key(shingles(t, words)) for t in batch["text"]]})

    rows = beside(rows, run, ["text"], ["record", "doc_id"], "key long", rows=SLICE)
    by_key = placed.select("key", "n_shingles", "component").distinct()
    rows = rows.join(by_key, "key").join(best, "component", "left")
    blank = rows.where("n_shingles = 0").select("record.*")
    one = (
        rows.where("n_shingles > 0 and doc_id <=> best")
        .groupBy("component")
        .agg(F.min_by("record", "key").alias("record"))
        .select("record.*")
    )
    return unique.unionByName(blank).unionByName(one)
