"""Removal of repeated passages with suffix arrays.

A byte is removed if a string of ``SPAN`` bytes that covers it also starts earlier: in a document
with a smaller id, or earlier in the same one. Every such string holds the same anchor wherever
it occurs: its smallest hash of ``GRAM`` bytes. So

1. each text's anchors, some 4 in 100 bytes, are dealt into buckets by their hash; an anchor that
   occurs once anywhere is dropped, and of those with the same surroundings all but the first are
   repeats as they stand;
2. the different surroundings of one anchor form a group, cut from the texts;
3. each group's suffix array (``suffix_sort``) brings equal strings of ``SPAN`` bytes together,
   and all but the first are repeats;
4. a text's repeats are united and cut out.

A group of more than ``GROUP`` surroundings is split by longer parts that equal strings must share,
and where these are shared by as many again, by the strings themselves, which are then grouped by
hash. So no group is too large for a task, whatever share of the documents holds a passage. Copies
are reduced before the shuffle, as far as they meet in a slice of a partition.

A missing text counts as empty. Missing ids sort before all others. Of rows with equal ids, the
order is that of their texts' hashes, and each is a document of its own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.suffix_sort import ranges, suffix_arrays
from eventlake.llm.work import BATCH, beside, ship, stored, whole

SPAN, GRAM = 100, 48
WINDOW = SPAN - GRAM + 1
LEFT = WINDOW - 1
AROUND = LEFT + SPAN
GROUP = 64
PARTS = 4
SLICE = 1 << 20
BUCKET = 8 << 20
BLOCK = 1 << 20
GAP = 256
LAST = np.uint64(2**64 - 1)
CODES = np.random.default_rng(7).integers(0, 2**64, 257, dtype=np.uint64)
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * B
    return x ^ (x >> np.uint64(32))


def hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all strings of 2**k codes."""
    h, n = CODES[codes], 1
    while n < size:
        h, n = mixed(h[:-n] * A + h[n:]), 2 * n
    return h


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x, n = pick(x[:-n], x[n:]), 2 * n
    return x if n == width else pick(x[: len(x) - (width - n)], x[width - n :])


def stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as codes, each with a gap before and after it, and where they start."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    starts = AROUND + np.concatenate([[0], np.cumsum(sizes + AROUND)[:-1]])
    codes = np.full(int(sizes.sum()) + AROUND * (len(texts) + 1), GAP, dtype=np.uint16)
    at, _ = ranges(starts, starts + sizes)
    codes[at] = np.frombuffer(b"".join(texts), dtype=np.uint8)
    return codes, starts


def anchors(texts: list[bytes]):
    """(hash, hash of the surroundings, text, place) of every anchor."""
    codes, starts = stream(texts)
    h16 = hashes(codes, 16)
    h32 = mixed(h16[:-16] * A + h16[16:])
    h = mixed(h32[:-16] * A + h16[32:])
    outside = np.concatenate([[0], np.cumsum(codes == GAP)])
    h[outside[GRAM:] - outside[:-GRAM] > 0] = LAST
    low = sliding(h, WINDOW, np.minimum)
    edge = np.zeros(WINDOW - 1, dtype=np.uint64)
    least = sliding(np.concatenate([edge, low, edge]), WINDOW, np.maximum)
    at = np.flatnonzero((least == h) & (h != LAST))
    around = np.zeros(len(at), dtype=np.uint64)
    for step in (*range(-LEFT, SPAN - 32, 32), SPAN - 32):
        around = mixed(around * A + h32[at + step])
    text = np.searchsorted(starts, at, side="right") - 1
    return h[at].view(np.int64), around.view(np.int64), text, at - starts[text]


def slices(batch: pd.DataFrame):
    """Runs of rows, in the order of ids, of about ``SLICE`` bytes."""
    batch = batch.sort_values("row", kind="stable")
    texts = [t.encode() for t in batch["text"]]
    run, size = [], 0
    for row, text in zip(batch["row"], texts, strict=True):
        run.append((row, text))
        size += len(text) + AROUND
        if size >= SLICE:
            yield run
            run, size = [], 0
    if run:
        yield run


def runs(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before in any column."""
    out = np.ones(len(columns[0]), dtype=bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


PACKED = ("key", "around", "row", "place")


def deal(buckets: int):
    """Anchors of a partition's texts as packed arrays, one row per slice and bucket.

    ``again`` marks those that repeat an earlier anchor of the slice, surroundings included.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                key, around, text, place = anchors([t for _, t in part])
                if not len(key):
                    continue
                row = np.array([r for r, _ in part], dtype=np.int64)[text]
                order = np.lexsort((place, row, around, key))
                key, around, row, place = (x[order] for x in (key, around, row, place))
                again = ~runs(key, around)
                bucket = (mixed(key.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((again, bucket))
                cuts = np.flatnonzero(runs(bucket[order], again[order]))
                out = {"bucket": bucket[order[cuts]], "again": again[order[cuts]]}
                for name, x in zip(PACKED, (key, around, row, place), strict=True):
                    x = x[order].astype(np.int32 if name == "place" else np.int64)
                    out[name] = [p.tobytes() for p in np.split(x, cuts[1:])]
                yield pd.DataFrame(out)

    return run


DEALT = "bucket long, again boolean, key binary, around binary, row binary, place binary"
FOUND = "repeat boolean, row long, place int, key long, size int"


def gather(dealt: pd.DataFrame) -> pd.DataFrame:
    """Of a bucket's anchors: repeats, and the first of each surroundings of a shared anchor."""

    def unpacked(rows: pd.DataFrame) -> list[np.ndarray]:
        return [
            np.frombuffer(b"".join(rows[c]), dtype=np.int32 if c == "place" else np.int64)
            for c in PACKED
        ]

    again = dealt["again"].to_numpy(dtype=bool)
    key, around, row, place = unpacked(dealt[~again])
    order = np.lexsort((place, row, around, key))
    key, around, row, place = (x[order] for x in (key, around, row, place))
    first = runs(key, around)
    group = np.cumsum(runs(key)) - 1
    sizes = np.bincount(group, weights=first).astype(np.int64)[group] if len(key) else group
    shared = first & (sizes > 1)
    _, _, row2, place2 = unpacked(dealt[again])
    return pd.DataFrame(
        {
            "repeat": np.concatenate([np.zeros(shared.sum(), bool), np.ones((~first).sum() + len(row2), bool)]),
            "row": np.concatenate([row[shared], row[~first], row2]),
            "place": np.concatenate([place[shared], place[~first], place2]),
            "key": np.concatenate([key[shared], np.zeros((~first).sum() + len(row2), np.int64)]),
            "size": np.concatenate([sizes[shared], np.zeros((~first).sum() + len(row2), np.int64)]),
        }
    )


def digest64(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def cut(batches):
    """Surroundings of a row's anchors; of large groups the overlapping parts.

    Strings of ``SPAN`` bytes that hold an anchor between ``low`` and ``high`` bytes after their
    start all hold the part from ``low`` before the anchor to ``SPAN - high`` after it.
    """
    step = -(-WINDOW // PARTS)
    for batch in batches:
        out = []
        columns = (batch[c] for c in ("row", "text", "place", "key", "size"))
        for row, text, places, keys, sizes in zip(*columns, strict=True):
            data = text.encode()
            for p, key, size in zip(places.tolist(), keys.tolist(), sizes.tolist(), strict=True):
                if size <= GROUP:
                    start, end = max(0, p - LEFT), min(len(data), p + SPAN)
                    if end - start >= SPAN:
                        out.append((key, row, start, data[start:end]))
                    continue
                for low in range(0, WINDOW, step):
                    high = min(LEFT, low + step - 1)
                    start, end = max(0, p - high), min(len(data), p - low + SPAN)
                    if p >= low and end - start >= SPAN and p - high + SPAN <= len(data):
                        part = data[p - low : p - high + SPAN]
                        out.append((digest64(part + bytes([low])), row, start, data[start:end]))
        yield pd.DataFrame(out, columns=["key", "row", "start", "data"])


CUT = "key long, row long, start int, data binary"


NOTHING = (np.zeros(0, np.int64),) * 3


def repeats_in(groups: list[list[tuple[int, int, bytes]]]) -> tuple[np.ndarray, ...]:
    """(row, start, end) of the strings of ``SPAN`` bytes that repeat within groups."""
    texts, rows, starts, bounds = [], [], [], [0]
    for group in groups:
        for row, start, data in group:
            rows.append(row)
            starts.append(start)
            texts.append(data)
        bounds.append(bounds[-1] + sum(len(d) + 1 for *_, d in group) + 1)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    members = np.array([len(g) for g in groups], dtype=np.int64)
    bounds = np.array(bounds)
    # codes: 0 ends a group, 1 ends a text, bytes are moved up by 2
    group_of = np.repeat(np.arange(len(groups)), members)
    heads = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) + group_of
    codes = np.ones(bounds[-1], dtype=np.uint16)
    codes[bounds[1:] - 1] = 0
    at, owner = ranges(heads, heads + sizes)
    codes[at] = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.uint16) + 2
    del at, owner, texts
    order = suffix_arrays(codes, bounds)
    at, owner = ranges(heads, heads + sizes)
    text_of = np.zeros(len(codes), dtype=np.int32)
    left = np.zeros(len(codes), dtype=np.int64)
    text_of[at], left[at] = owner, (heads + sizes)[owner] - at
    del at, owner
    order = order[left[order] >= SPAN].astype(np.int64)
    del left
    if len(order) < 2:
        return NOTHING
    # neighbours in the suffix array that share SPAN bytes (and so a group) are one class
    strings = np.lib.stride_tricks.sliding_window_view(codes, SPAN)
    same = np.zeros(len(order), dtype=bool)
    for i in range(1, len(order), 1 << 16):
        x, y = order[i - 1 : i - 1 + (1 << 16)], order[i : i + (1 << 16)]
        same[i : i + (1 << 16)] = (strings[x[: len(y)]] == strings[y]).all(axis=1)
    text_group = np.repeat(np.arange(len(groups)), members)
    same[1:] &= text_group[text_of[order[1:]]] == text_group[text_of[order[:-1]]]
    rows, starts = np.array(rows, dtype=np.int64), np.array(starts, dtype=np.int64)
    row = rows[text_of[order]]
    place = starts[text_of[order]] + order - heads[text_of[order]]
    rank = np.empty(len(order), dtype=np.int64)
    by = np.lexsort((place, row))
    rank[by] = np.cumsum(runs(row[by], place[by]))
    heads_of = np.flatnonzero(~same)
    least = np.minimum.reduceat(rank, heads_of)[np.cumsum(~same) - 1]
    late = rank > least
    row, place = row[late], place[late]
    by = np.lexsort((place, row))
    row, place = row[by], place[by]
    fresh = runs(row)
    fresh[1:] |= place[1:] > place[:-1] + 1
    at = np.flatnonzero(fresh)
    if not len(at):
        return NOTHING
    ends = place[np.append(at[1:], len(place)) - 1] + SPAN
    return row[at], place[at], ends


#: Strings of large groups that go out in one frame.
STRINGS = 100_000
SORTED = "single boolean, row long, start int, end int, high long, low long"


def strings_of(row: int, start: int, data: bytes):
    """Row, place and digest of every string of ``SPAN`` bytes."""
    n = len(data) - SPAN + 1
    digests = [xxhash.xxh3_128_digest(data[i : i + SPAN]) for i in range(n)]
    return row, start, n, b"".join(digests)


def sort_groups(batches):
    """Repeats of groups that come one after the other; strings of the groups still too large."""
    groups, group, key, size = [], [], None, 0
    strings, held = [], 0

    def digests():
        """The strings of the members of large groups that were gathered."""
        n = np.array([x[2] for x in strings])
        at, owner = ranges(np.array([x[1] for x in strings]), np.array([x[1] for x in strings]) + n)
        digest = np.frombuffer(b"".join([x[3] for x in strings]), dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame(
            {
                "single": np.ones(len(at), bool),
                "row": np.array([x[0] for x in strings])[owner],
                "start": at,
                "end": at + SPAN,
                "high": digest[:, 0],
                "low": digest[:, 1],
            }
        )

    def flush():
        row, start, end = repeats_in([g for g in groups if len(g) > 1])
        zero = np.zeros(len(row), np.int64)
        return pd.DataFrame(
            {"single": zero > 0, "row": row, "start": start, "end": end, "high": zero, "low": zero}
        )

    for batch in batches:
        large = batch["n"].to_numpy() > GROUP
        if large.any():
            columns = (batch[c][large] for c in ("row", "start", "data"))
            found = [strings_of(*x) for x in zip(*columns, strict=True)]
            strings += found
            held += sum(x[2] for x in found)
            if held >= STRINGS:
                yield digests()
                strings, held = [], 0
        columns = (batch[c][~large] for c in ("key", "row", "start", "data"))
        for k, row, start, data in zip(*columns, strict=True):
            if k != key:
                if group:
                    groups.append(group)
                if size >= BLOCK:
                    yield flush()
                    groups, size = [], 0
                group, key = [], k
            group.append((row, start, bytes(data)))
            size += len(data) + 2
    if strings:
        yield digests()
    groups.append(group)
    yield flush()


def repeats(texts: DataFrame) -> DataFrame:
    """(row, start, end) of all repeats in (row, text); a row may have many, overlapping."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, size // BUCKET)
    found = stored(
        texts.mapInPandas(deal(buckets), DEALT).groupBy("bucket").applyInPandas(gather, FOUND),
        "anchors",
    )
    whole_ = found.where("repeat").select(
        "row", (F.col("place") - LEFT).alias("start"), (F.col("place") + SPAN).alias("end")
    )
    at = (
        found.where("not repeat")
        .groupBy("row")
        .agg(F.collect_list(F.struct("place", "key", "size")).alias("found"))
    )
    members = Window.partitionBy("key")
    groups = (
        texts.join(at, "row")
        .select("row", "text", "found.place", "found.key", "found.size")
        .mapInPandas(cut, CUT)
        .withColumn("n", F.count("*").over(members))
        .where("n > 1")
    )
    sorted_ = stored(groups.mapInPandas(sort_groups, SORTED), "sorted")
    place = F.struct("row", "start")
    string = Window.partitionBy("high", "low")
    single = (
        sorted_.where("single")
        .withColumn("first", F.min(place).over(string))
        .where(F.col("first") < place)
    )
    three = ("row", "start", "end")
    return (
        whole_.union(sorted_.where("not single").select(*three)).union(single.select(*three))
    )


def kept_parts(data: bytes, starts, ends) -> tuple[np.ndarray, int]:
    """Which bytes to remove, and in how many runs."""
    starts, ends = np.maximum(0, starts), np.minimum(len(data), ends)
    whole_ = ends - starts >= SPAN
    change = np.bincount(starts[whole_], minlength=len(data) + 1)
    change -= np.bincount(ends[whole_], minlength=len(data) + 1)
    gone = np.cumsum(change)[:-1] > 0
    return gone, int(gone[:1].sum() + (gone[1:] > gone[:-1]).sum())


def numbered_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row``, a unique number in the order of ids."""
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n")).agg(
        F.max("n").alias("most"), F.max(F.col("doc_id").isNull()).alias("missing")
    )
    most, missing = ids.first()
    if (most or 0) <= 1 and not missing:
        return docs.withColumn("row", F.col("doc_id").cast("long"))
    # In sorted ranges, which split rows with equal ids too; the numbers grow from range to range.
    ordered = docs.withColumn("tie", F.xxhash64(whole())).repartitionByRange("doc_id", "tie")
    ordered = ordered.sortWithinPartitions("doc_id", "tie").drop("tie")
    return stored(ordered.withColumn("row", F.monotonically_increasing_id()), "numbered")


def with_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row``, and the ``starts`` and ``ends`` of each text's repeats."""
    ship(docs.sparkSession)
    rows = numbered_rows(docs)
    all_ = repeats(rows.select("row", whole().alias("text")))
    by_row = all_.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    by_row = by_row.select("row", F.col("found.start").alias("starts"), F.col("found.end").alias("ends"))
    return rows.join(by_row, "row", "left")


def measure(docs: DataFrame) -> DataFrame:
    """Bytes, removed bytes and runs of every document, and the digest of what stays."""

    def run(batches):
        for batch in batches:
            out = []
            columns = (batch[c] for c in ("text", "starts", "ends"))
            for text, starts, ends in zip(*columns, strict=True):
                kept = data = text.encode()
                spans = 0
                if starts is not None:
                    gone, spans = kept_parts(data, starts, ends)
                    kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
                out.append((len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = with_repeats(docs.select("doc_id", whole().alias("text")))
    made = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return beside(rows, run, ["text", "starts", "ends"], ["doc_id"], made, rows=BATCH)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with repeated passages cut out of the texts.

    A character goes if all of its bytes go. ``n_chars`` follows the text where the table has it.
    Texts without repeats are returned as they are, missing ones stay missing.
    """

    def run(batches):
        for batch in batches:
            texts = []
            for text, starts, ends in zip(batch["text"], batch["starts"], batch["ends"], strict=True):
                if not isinstance(text, str) or starts is None:
                    texts.append(text)
                    continue
                data = text.encode()
                gone, _ = kept_parts(data, starts, ends)
                raw = np.frombuffer(data, dtype=np.uint8)
                heads = np.flatnonzero(raw & 0xC0 != 0x80)
                stays = np.logical_or.reduceat(~gone, heads) if len(heads) else gone
                texts.append(raw[np.repeat(stays, np.diff(np.append(heads, len(raw))))].tobytes().decode())
            yield pd.DataFrame({"cut": texts})

    others = [c for c in docs.columns if c != "text"]
    rows = docs.select("doc_id", "text", F.struct(*others).alias("record"))
    clean = beside(with_repeats(rows), run, ["text", "starts", "ends"], ["record"], "cut string")
    clean = clean.select(*[F.col("record")[c].alias(c) for c in others], F.col("cut").alias("text"))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return clean.select(*docs.columns)
