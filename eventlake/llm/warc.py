"""Web archives (WARC files): writing pages as records, and reading records back in parallel.

Writing: of records with equal payloads of at least ``LEAST`` bytes the one with the smallest page id
is a response, the others are revisits that refer to it and have no payload. Equal rows that share
the smallest id are all responses, and so are copies of which none has an id. A missing payload is empty.

Reading by boundary-chain verification: a file is split at every place where the magic of a record
stands, also inside payloads. Tasks parse what follows each one as a header and emit a pointer from
the candidate to its successor, the offset behind the length the header states. Pointer jumping from
offset 0 then finds the records: every round doubles the length of the jumps, so there are as many
rounds as the number of records of a file has binary digits. What no chain reaches is part of a payload.
A chain has to end at the end of its file; otherwise the file is damaged and reading raises.

Payloads without a magic inside are digested where they are found. Those with one lie in several
pieces; only their pieces are read again and digested in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm.work import ship, stored, whole
from eventlake.session import fresh_dir

# Fixed values of the format: the magic with its line end, the end of a header, the end of a record.
MAGIC = "WARC/1.1\r\n"
BLANK = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"
HTTP = "application/http"
#: Payloads with fewer bytes are always stored.
LEAST = 100


class ArchiveError(ValueError):
    """An archive file is not a chain of whole records."""


# ------------------------------------------------------------------------------ writing


def record_id(page_id: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), digest, F.lit(">"))


def records(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): ``refers_to`` is the page id of the response that
    holds a revisit's payload."""
    own = pages.select("page_id", "url", whole("html").alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    # Stored, so the planner knows its size; without many copies the payloads are not shuffled.
    copied = stored(
        own.where((F.octet_length("payload") >= LEAST))
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 and first is not null")
        .drop("copies"),
        "warc-copied",
    )
    return own.join(copied, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )


def as_text(rows: DataFrame) -> DataFrame:
    """Each record as WARC text, without the two line ends behind it."""
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, "").otherwise(F.concat(F.lit(HTTP_HEAD + BLANK), F.col("payload")))

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)

    def printed(text: str) -> Column:
        return F.replace(F.replace(F.col(text), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    # A field whose value is missing is left out.
    header = F.concat_ws(
        "\r\n",
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", record_id(F.col("page_id"), F.col("digest"))),
        field("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        field("WARC-Target-URI", printed("url")),
        field("X-Page-Id", F.col("page_id").cast("string")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        field("WARC-Refers-To", F.when(revisit, record_id(F.col("refers_to"), F.col("digest")))),
        field("Content-Type", F.lit(f"{HTTP}; msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
    )
    return rows.select(F.concat(F.lit(MAGIC), header, F.lit(BLANK), block).alias("value"))


def write(pages: DataFrame, folder: str, compression: str = "none") -> None:
    """Write the pages (page_id, url, html) as WARC files into a new folder."""
    as_text(records(pages)).write.option("lineSep", BLANK).option("compression", compression).text(folder)


# ------------------------------------------------------------------------------ reading


def pieces(spark: SparkSession, folder: str) -> DataFrame:
    """What stands between magics, in the order of the file within each block of a file."""
    text = spark.read.option("lineSep", MAGIC).text(folder)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )


def placed(batches) -> Iterator[list[tuple[str, int, int, int, bytes]]]:
    """(file, block, number in it, offset in it, bytes) of the pieces of each batch."""
    at = None
    for batch in batches:
        out = []
        for file, block, value in zip(*[batch.column(c).to_pylist() for c in ("file", "block", "value")], strict=True):
            if at is None or at[:2] != (file, block):
                at = (file, block, 0, 0)
            out.append((*at, value))
            at = (file, block, at[2] + 1, at[3] + len(value) + len(MAGIC))
        yield out


FIELDS = {
    "file": pa.string(),
    "block": pa.int64(),
    "n": pa.int64(),
    "offset": pa.int64(),
    "size": pa.int64(),
    "length": pa.int64(),
    "body": pa.int64(),
    "record_id": pa.string(),
    "record_type": pa.string(),
    "page_id": pa.int64(),
    "url": pa.string(),
    "refers_to": pa.string(),
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
}
#: The same for Spark.
SCHEMA = ", ".join(f"{c} {'string' if kind == pa.string() else 'long'}" for c, kind in FIELDS.items())


def number(text: bytes) -> int | None:
    """The 64-bit number that a field's value is, else None."""
    if len(text) > 20 or not text.removeprefix(b"-").isdigit():
        return None
    value = int(text)
    return value if -(2**63) <= value < 2**63 else None


def parsed(piece: bytes) -> dict | None:
    """The header at the start of a piece, with ``length``, the bytes from the magic's end to the end
    of the record, and ``body``, where its payload starts. None for what is no header."""
    blank = BLANK.encode()
    head, end, _ = piece.partition(blank)
    names = (line.partition(b":") for line in head.split(b"\r\n"))
    fields = {name.strip().lower(): value.strip() for name, colon, value in names if colon}
    content = number(fields.get(b"content-length", b""))
    if not end or content is None or not 0 <= content < 2**62:
        return None
    body = len(head) + len(blank)
    length = body + content + len(blank)
    if length == len(piece) and not piece.endswith(blank):
        return None
    if fields.get(b"content-type", b"").startswith(HTTP.encode()) and content:
        inner = piece.find(blank, body, body + content)
        body = inner + len(blank) if inner >= 0 else body

    def text(name: bytes) -> str | None:
        return fields[name].decode("utf-8", "replace") if name in fields else None

    return {
        "length": length,
        "body": body,
        "record_id": text(b"warc-record-id"),
        "record_type": text(b"warc-type"),
        "page_id": number(fields.get(b"x-page-id", b"")),
        "url": text(b"warc-target-uri"),
        "refers_to": text(b"warc-refers-to"),
    }


def candidates(batches):
    """One row per piece: its place, and what its header says. The payload is digested here if the
    piece ends where the record does."""
    for batch in placed(batches):
        rows = []
        for file, block, n, offset, value in batch:
            row = {"file": file, "block": block, "n": n, "offset": offset, "size": len(value)}
            # No magic stands before the first piece of a file.
            found = parsed(value) if block or n else None
            if found:
                row |= found
                if found["length"] == len(value):
                    payload = memoryview(value)[found["body"] : len(value) - len(BLANK)]
                    row["payload_bytes"] = len(payload)
                    row["payload_digest"] = hashlib.sha256(payload).hexdigest()
            rows.append(row)
        yield pa.RecordBatch.from_pylist(rows, pa.schema(list(FIELDS.items())))


def located(found: DataFrame) -> DataFrame:
    """Adds ``at``, the offset of a piece's magic in its file, ``next``, that of its successor, and
    ``ends``, the length of the file."""
    by_file = Window.partitionBy("file")
    blocks = (
        found.groupBy("file", "block")
        .agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
        .withColumn("before", F.sum("bytes").over(by_file.orderBy("block")) - F.col("bytes"))
        .withColumn("ends", F.sum("bytes").over(by_file) - len(MAGIC))
        .drop("bytes")
    )
    begin = F.col("before") + F.col("offset")
    return (
        found.join(blocks, ["file", "block"])
        .withColumn("at", begin - len(MAGIC))
        .withColumn("next", begin + F.col("length"))
        .drop("before", "offset")
    )


def reachable(pointers: DataFrame) -> DataFrame:
    """(file, at) of the candidates on the chains that start at offset 0 of each file, from (file, at,
    next)."""
    jumps = pointers.select("file", "at", "next")
    reached = [stored(jumps.where("at = 0").select("file", "at"), "warc-reached")]
    while True:
        # A jump of 2^k records from each of the first 2^k.
        ahead = jumps.join(_union(reached), ["file", "at"]).select("file", F.col("next").alias("at"))
        ahead = stored(ahead.join(pointers.select("file", "at"), ["file", "at"], "left_semi"), "warc-reached")
        if ahead.isEmpty():
            return _union(reached)
        reached.append(ahead)
        onward = jumps.select("file", F.col("at").alias("next"), F.col("next").alias("then"))
        jumps = stored(
            jumps.join(onward, ["file", "next"]).select("file", "at", F.col("then").alias("next")), "warc-jumps"
        )


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.union(df)
    return out


def texts(batches):
    """(file, block, n, value): the pieces with their place in the block."""
    for batch in placed(batches):
        rows = [{"file": file, "block": block, "n": n, "value": value} for file, block, n, _, value in batch]
        yield pa.RecordBatch.from_pylist(
            rows, pa.schema([("file", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("value", pa.binary())])
        )


def digested(batches):
    """(file, record, payload_bytes, payload_digest) of records whose pieces come in order."""
    kinds = [("file", pa.string()), ("record", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    key, left, digest = None, 0, None
    for batch in batches:
        rows = []
        columns = [batch.column(c).to_pylist() for c in ("file", "record", "body", "payload_bytes", "value")]
        for file, record, body, size, value in zip(*columns, strict=True):
            if key != (file, record):
                key, left, digest = (file, record), size, hashlib.sha256()
                value = value[body:]
            else:
                value = MAGIC.encode() + value
            digest.update(value[:left])
            left -= min(left, len(value))
            if not left:
                rows.append(dict(zip([k for k, _ in kinds], (*key, size, digest.hexdigest()), strict=True)))
        yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


def digest_spanning(spark: SparkSession, folder: str, found: DataFrame, records: DataFrame) -> DataFrame:
    """(file, record, payload_bytes, payload_digest) of the records with magics in their payload: the
    pieces up to the next record are read again."""
    starts = records.select("file", "at", F.col("at").alias("record"))
    so_far = Window.partitionBy("file").orderBy("at")
    owned = found.join(starts, ["file", "at"], "left").select(
        "file", "block", "n", "at", F.last("record", ignorenulls=True).over(so_far).alias("record")
    )
    spanning = records.where("payload_digest is null").select(
        "file",
        F.col("at").alias("record"),
        "body",
        (F.col("length") - F.col("body") - len(BLANK)).alias("payload_bytes"),
    )
    wanted = stored(owned.join(spanning, ["file", "record"]), "warc-wanted")
    kinds = "file string, block long, n long, value binary"
    return (
        pieces(spark, folder)
        .mapInArrow(texts, kinds)
        .join(wanted, ["file", "block", "n"])
        .repartition("file", "record")
        .sortWithinPartitions("file", "record", "at")
        .select("file", "record", "body", "payload_bytes", "value")
        .mapInArrow(digested, "file string, record long, payload_bytes long, payload_digest string")
    )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all WARC files of a folder: record_id, record_type, page_id, url, refers_to (a
    record id), payload_bytes and payload_digest (SHA-256, in hex) of the stored payload."""
    ship(spark)
    found = stored(pieces(spark, folder).mapInArrow(candidates, SCHEMA), "warc-pieces")
    found = stored(located(found), "warc-candidates")
    pointers = stored(found.where("next is not null").select("file", "at", "next"), "warc-pointers")
    records = stored(found.join(reachable(pointers), ["file", "at"]), "warc-records")
    reached = records.groupBy("file").agg(F.max("next").alias("reached"))
    broken = found.groupBy("file").agg(F.max("ends").alias("ends")).join(reached, "file", "left")
    # One row.
    damaged = broken.where("not ends <=> reached").agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("file")).first()
    if damaged["n"]:
        raise ArchiveError(f"{damaged['n']} files are no chain of records, {damaged['file']} among them")
    if not records.where("payload_digest is null").isEmpty():
        again = digest_spanning(spark, folder, found, records)
        inner = again.withColumnsRenamed({"record": "at", "payload_bytes": "bytes", "payload_digest": "digest"})
        records = records.join(inner, ["file", "at"], "left").withColumns(
            {"payload_bytes": F.coalesce("payload_bytes", "bytes"), "payload_digest": F.coalesce("payload_digest", "digest")}
        )
    return records.select(
        "record_id", "record_type", "page_id", "url", "refers_to", "payload_bytes", "payload_digest"
    )


def resolved(records: DataFrame) -> DataFrame:
    """The records with page ids in ``refers_to``, and with the payload's size and digest also for
    revisits, from the response they refer to; both are missing if that is not among the records."""
    records = stored(records, "warc-read")
    held = (
        records.where("record_type = 'response'")
        .groupBy("record_id")
        .agg(*[F.min(c).alias(c) for c in ("page_id", "payload_bytes", "payload_digest")])
        .withColumnsRenamed({"record_id": "refers_to", "page_id": "response"})
    )
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    columns = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    revisits = revisits.join(held, "refers_to", "left").withColumn("refers_to", F.col("response"))
    others = records.where("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    return others.select(columns).unionByName(revisits.select(columns))


def archive(pages: DataFrame) -> DataFrame:
    """Pages written to a new folder of archives and read back."""
    folder = fresh_dir(pages.sparkSession, "warc")
    write(pages, folder)
    return resolved(read(pages.sparkSession, folder))
