"""Byte-level BPE over padded matrices.

A text is cut by the tokenizer's pattern. Each distinct piece of a batch is one row of a padded
matrix of token ids; pieces of similar length share a matrix. In each round every row merges its
leftmost pair of minimum rank. Pair ranks come from an open-addressing hash table of numpy
arrays. Merged columns are unlinked at once; rows that are done leave the matrix, and a matrix
more than half of whose columns are dead is compacted.

A missing text counts as empty and has no tokens. Rows are independent, so ties, repeated rows
and other columns do not matter. Very long pieces (a text without spaces) are rows of their own.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from eventlake.llm.work import beside, ship, whole

NONE = np.int32(2**31 - 1)
CELLS = 1 << 21
CACHED = 400_000


class Merges:
    """Vocabulary and pair ranks of a rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int32)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = self.slot(keys)
        while len(keys):
            # of the keys that want one free slot, one gets it; the rest move on by one
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], slots[~placed]
            slots = (slots + 1) & (len(self.keys) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; NONE where the pair is no token or an id is negative."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        out = np.full(keys.shape, NONE, dtype=np.int32)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        keys = keys.ravel()[at]
        slots = self.slot(keys)
        flat = out.ravel()
        while len(at):
            found = self.keys[slots]
            hit = found == keys
            flat[at[hit]] = self.values[slots[hit]]
            more = ~hit & (found >= 0)
            at, keys, slots = at[more], keys[more], (slots[more] + 1) & (len(self.keys) - 1)
        return flat.reshape(out.shape)

    def merge_rows(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Token ids of pieces of similar length."""
        n, width = len(pieces), max(map(len, pieces))
        lengths = np.array([len(p) for p in pieces])
        ids = np.full((n, width + 1), -1, dtype=np.int32)
        inside = np.arange(width + 1) < lengths[:, None]
        ids[inside] = self.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        out: list = [None] * n
        rows = np.arange(n)
        while len(rows):
            ids, rows = self.rounds(ids, rows, out)
        return out

    def rounds(self, ids: np.ndarray, rows: np.ndarray, out: list):
        """Merge until rows are done or the matrix is worth compacting."""
        n, width = ids.shape
        after = np.broadcast_to(np.arange(1, width + 1), (n, width)).copy()
        before = np.broadcast_to(np.arange(-1, width - 1), (n, width)).copy()
        ranks = np.full((n, width), NONE, dtype=np.int32)
        ranks[:, :-1] = self.rank(ids[:, :-1], ids[:, 1:])
        live, merges = np.arange(n), 0
        while len(live):
            at = ranks[live].argmin(axis=1) if len(live) < n else ranks.argmin(axis=1)
            least = ranks[live, at]
            going = least < NONE
            live, at, least = live[going], at[going], least[going]
            if not len(live):
                break
            gone = after[live, at]
            ids[live, at] = least
            ids[live, gone] = -1
            ranks[live, gone] = NONE
            follow = after[live, gone]
            after[live, at] = follow
            inner = follow < width
            before[live[inner], follow[inner]] = at[inner]
            right = np.where(inner, ids[live, np.minimum(follow, width - 1)], -1)
            ranks[live, at] = self.rank(least, right)
            prior = before[live, at]
            has = prior >= 0
            spot = live[has], prior[has]
            ranks[spot] = self.rank(ids[spot], least[has])
            merges += 1
            if width > 16 and merges * 2 >= width or len(live) * 4 < n and n > 64:
                break
        done = np.ones(len(rows), dtype=bool)
        done[live] = False
        for k in np.flatnonzero(done):
            line = ids[k]
            out[rows[k]] = line[line >= 0]
        ids, rows = ids[live], rows[live]
        if not len(rows):
            return ids, rows
        # compaction: live cells move left, in order
        kept = ids >= 0
        counts = kept.sum(axis=1)
        packed = np.full((len(rows), int(counts.max()) + 1), -1, dtype=np.int32)
        packed[np.arange(packed.shape[1]) < counts[:, None]] = ids[kept]
        return packed, rows

    def encode_pieces(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct pieces as little-endian unsigned 32-bit integers."""
        out, rest = {}, []
        for p in pieces:
            rank = self.ranks.get(p)
            if rank is None:
                rest.append(p)
            else:
                out[p] = rank.to_bytes(4, "little")
        rest.sort(key=len)
        start = 0
        while start < len(rest):
            # a bucket ends where lengths double or the matrix would be too large
            limit = 2 * len(rest[start])
            end = start + 1
            while end < len(rest) and len(rest[end]) <= limit and (end - start + 1) * len(rest[end]) <= CELLS:
                end += 1
            bucket = rest[start:end]
            for p, ids in zip(bucket, self.merge_rows(bucket), strict=True):
                out[p] = ids.astype("<u4").tobytes()
            start = end
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        token = self.bytes_of
        return b"".join([token[i] for i in ids.tolist()])


@functools.lru_cache(maxsize=2)
def merges_of(path: str) -> Merges:
    with open(path, "rb") as f:
        lines = [line.split() for line in f if line.strip()]
    return Merges({base64.b64decode(a): int(b) for a, b in lines})


def encoded(texts: list[str], merges: Merges, pattern, cache: dict[str, bytes]) -> list[bytes]:
    """Ids of texts as bytes. ``cache`` keeps pieces from batch to batch and is bounded."""
    cut = [pattern.findall(t) for t in texts]
    if len(cache) > CACHED:
        cache.clear()
    new = {p for pieces in cut for p in pieces if p not in cache}
    as_bytes = {p: p.encode() for p in new}
    ids = merges.encode_pieces(list(as_bytes.values()))
    cache.update((p, ids[b]) for p, b in as_bytes.items())
    return [b"".join([cache[p] for p in pieces]) for pieces in cut]


def slices(texts: list[str], chars: int = 1 << 21) -> Iterator[list[str]]:
    """Runs of texts of about ``chars`` characters, so that a batch's pieces stay bounded."""
    run, n = [], 0
    for t in texts:
        run.append(t)
        n += len(t)
        if n >= chars:
            yield run
            run, n = [], 0
    if run:
        yield run


def tokenize(
    docs: DataFrame, path: str, pattern: str, key: str = "doc_id", keep_ids: bool = True
) -> DataFrame:
    """Ids of every text (``ids`` only with ``keep_ids``), their number, digest and round trip.

    ``path`` is a rank file that every executor can open at that place.
    """

    ship(docs.sparkSession)

    def run(batches):
        merges, words, cache = merges_of(path), regex.compile(pattern), {}
        for batch in batches:
            texts = batch["text"].tolist()
            done = []
            for part in slices(texts):
                for raw in encoded(part, merges, words, cache):
                    ids = np.frombuffer(raw, dtype="<u4")
                    digest = hashlib.sha256(raw).hexdigest()
                    back = hashlib.sha256(merges.decode(ids)).hexdigest()
                    done.append((ids if keep_ids else None, len(ids), digest, back))
            out = pd.DataFrame(
                {
                    "n_tokens": [d[1] for d in done],
                    "ids_sha256": [d[2] for d in done],
                    "decoded_sha256": [d[3] for d in done],
                }
            )
            if keep_ids:
                out["ids"] = [d[0].astype("int64") for d in done]
            yield out

    made = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<long>" if keep_ids else "")
    return beside(docs.select(key, whole().alias("text")), run, ["text"], [key], made)
