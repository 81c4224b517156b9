"""Document fingerprints by SpotSigs.

A spot signature is a common word (an anchor) followed by the next two content words, with the
common words between them left out. A document's fingerprint is the set of its signatures'
hashes. A text without a spot has one signature, the hash of all its words; a text without words
has none. Documents are compared by Jaccard similarity of these sets. Pairs are sought within
partitions by set length, as sets whose lengths differ too much cannot be similar, and
only through a shared signature among each set's smallest hashes.

A missing text counts as empty. Rows with equal ids are kept apart by their text. Equal texts
have equal fingerprints. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.work import stored, whole

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in is that it for was on are as with he be at this have from or by "
    "der die das und ist ein eine für von zu mit auf den des dem nicht "
    "le la les un une des et est dans que qui pour sur par pas en "
    "el los las una y es de por con para del se su"
)


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.transform(F.array(value), f)[0]


def spots(text: Column, anchors: str = ANCHORS) -> Column:
    """The distinct signatures of a text, as sorted hashes."""
    common = "(?:" + "|".join(dict.fromkeys(anchors.split())) + ")"
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]++", " "), F.lit(" "))
    chain = f"(?<= )(?=({common} (?!{common} )[^ ]++ (?:{common} )*+[^ ]++) )"

    def hashes(plain: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(plain, F.lit(chain), F.lit(1)))
        each = F.transform(found, lambda s: F.xxhash64(F.regexp_replace(s, f" (?:{common} )++", " ")))
        return F.array_sort(F.array_distinct(each))

    def signatures(plain: Column) -> Column:
        words = F.trim(plain)
        return once(
            hashes(plain),
            lambda found: F.when(F.size(found) > 0, found)
            .when(words == "", F.array().cast("array<bigint>"))
            .otherwise(F.array(F.xxhash64(F.lit("whole"), words))),
        )

    return once(plain, signatures)


def fingerprint(signatures: Column) -> Column:
    """The set as text: sorted signatures, 12 hex digits each."""
    return F.array_join(
        F.array_distinct(F.transform(signatures, lambda h: F.right(F.lower(F.lpad(F.hex(h), 16, "0")), F.lit(12)))), ""
    )


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity; 0 without a comparison where the lengths alone rule out ``least``.
    Two empty sets are alike."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return (
        F.when(large == 0, F.lit(1.0))
        .when((small == 0) | (small < least * large), F.lit(0.0))
        .otherwise(shared / (F.size(a) + F.size(b) - shared))
    )


def next_rows(ids: DataFrame, width: int = 1000, levels: int = 3) -> DataFrame:
    """(bucket, next): each bucket with the following bucket that has rows.

    Found inside blocks of ``width`` buckets; only the last of each block looks among the blocks.
    The top level sees one row for ``width ** levels`` buckets.
    """
    if levels == 0:
        return ids.withColumn("next", F.lead("bucket").over(Window.orderBy("bucket")))
    block = F.floor(F.col("bucket") / width)
    inner = ids.withColumn("block", block).withColumn(
        "next", F.lead("bucket").over(Window.partitionBy("block").orderBy("bucket"))
    )
    firsts = ids.groupBy(block.alias("bucket")).agg(F.min("bucket").alias("first"))
    after = next_rows(firsts.select("bucket"), width, levels - 1)
    following = after.join(
        firsts.select(F.col("bucket").alias("next"), "first"), "next"
    ).select(F.col("bucket").alias("block"), "first")
    return inner.join(following, "block", "left").select(
        "bucket", F.coalesce("next", "first").alias("next")
    )


def with_next(docs: DataFrame, per_bucket: int = 64) -> DataFrame:
    """Every document with its signatures and the text and signatures of the one after it by id,
    the first after the last.

    Neighbours meet in buckets of ``per_bucket`` consecutive ids, so the texts are shuffled once;
    only the last row of a bucket needs the first of a later one. Missing ids sort first.
    """
    rows = docs.select(
        "doc_id",
        whole().alias("text"),
        F.coalesce(F.floor(F.col("doc_id") / per_bucket), F.lit(-(1 << 60))).alias("bucket"),
    )
    order = Window.partitionBy("bucket").orderBy("doc_id", F.xxhash64("text"))
    # signatures are made after the shuffle, which then carries texts alone
    inner = (
        rows.repartition("bucket")
        .withColumn("own", spots(F.col("text")))
        .withColumns({"after": F.lead("text").over(order), "following": F.lead("own").over(order)})
    )
    first = F.struct("doc_id", F.xxhash64("text").alias("tie"), "text")
    heads = stored(
        rows.groupBy("bucket").agg(F.min(first).getField("text").alias("head")), "heads"
    )
    lowest = heads.agg(F.min("bucket")).first()[0]
    following = (
        next_rows(heads.select("bucket"))
        .withColumn("next", F.coalesce("next", F.lit(lowest)))
        .join(heads.select(F.col("bucket").alias("next"), "head"), "next")
        .select("bucket", "head")
    )
    return inner.join(following, "bucket").select(
        "doc_id",
        "text",
        "own",
        F.coalesce("after", "head").alias("after"),
        F.coalesce("following", spots(F.col("head"))).alias("following"),
    )


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next document, compared.

    The edited text has its last half replaced by the first half as many code points of the next.
    """
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("after", F.lit(1), half))
    rows = with_next(docs).select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(edited, 256).alias("edited_sha256"),
        "own",
        spots(edited).alias("changed"),
        "following",
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )


def length_class(size: Column, least: float) -> Column:
    """Sets that can reach ``least`` differ by one class at most."""
    return F.floor(F.log(F.greatest(size, F.lit(1))) / F.lit(-math.log(least))).cast("int")


def near_pairs(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(a, b, likeness) of fingerprints that reach ``least``; equal sets are one class.

    a and b are the smallest ids of their class. Two sets that reach ``least`` share a hash among
    each one's first ``n - ceil(least * n) + 1``, so only these are indexed, by hash and length
    class, against the same class and the next.
    """
    sets = stored(
        docs.select("doc_id", spots(whole()).alias("set"))
        .where(F.size("set") > 0)
        .groupBy("set")
        .agg(F.min("doc_id").alias("id")),
        "spots",
    )
    n = F.size("set")
    prefix = F.slice("set", F.lit(1), (n - F.ceil(F.lit(least) * n - 1e-9) + 1).cast("int"))
    posts = sets.select(
        "id", n.alias("n"), length_class(n, least).alias("class"), F.explode(prefix).alias("hash")
    )
    left = posts.withColumn("class", F.explode(F.array("class", F.col("class") + 1)))
    pairs = (
        left.alias("x")
        .join(posts.alias("y"), ["hash", "class"])
        .where(F.col("x.id") != F.col("y.id"))
        .where(F.least("x.n", "y.n") >= least * F.greatest("x.n", "y.n") - 1e-9)
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
        .distinct()
    )
    return (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
        .select("a", "b", likeness(F.col("sa"), F.col("sb"), least).alias("likeness"))
        .where(F.col("likeness") >= least)
    )
