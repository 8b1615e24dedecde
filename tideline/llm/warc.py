"""WARC archives: writing captures, reading records, assembling transactions.

A capture is three records: the response (or a revisit, if another capture has
the same payload), the request and a metadata record, the last two concurrent
to the first.  Archives are written by Spark's text writer, whose line
separator is the end of a record, gzipped; they are read whole, one file a row,
and parsed by Content-Length, so payloads may hold anything.  Records meet
again by their concurrent-to identifiers in one shuffle and give one nested row
per capture.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import stable

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
FILE_BYTES = 32 << 20  # of an archive before compression, on average
MOST_BYTES = 512 << 20  # of any archive, unless one capture is larger; a reader takes less than 2 GB
FEW = 100_000  # groups of equal payloads that may be broadcast


def sha1_base32(payload: Column) -> Column:
    """Base32 SHA-1: 160 bits are four times 40, 40 bits are eight letters."""
    told = F.sha1(payload)
    letters = []
    for part in range(4):
        value = F.conv(told.substr(1 + 10 * part, 10), 16, 10).cast("long")
        for shift in range(35, -5, -5):
            at = F.shiftright(value, shift).bitwiseAND(F.lit(31)).cast("int")
            letters.append(F.substring(F.lit(BASE32), at + 1, F.lit(1)))
    return F.concat(*letters)


def _name(*parts: Column) -> Column:
    """A record identifier made from what identifies the capture."""
    told = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("\0")) for p in parts]))
    cuts = [F.substring(told, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _record(kind: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.concat(F.lit(f"\r\n{name}: "), value) for name, value in headers]
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), kind,
        *[F.coalesce(line, F.lit("")) for line in lines],
        F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END), block,
    )


def captures(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
    min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """(value, bytes): the records of each row's capture as one text without the last END.

    A row is told from others that equal it by its place in ``pages``, which must
    give the same rows in the same partitions each time it is read, as files do;
    write a computed table first.  Of rows with equal bodies the one with the
    largest id, url and place is the response; a NULL is smaller than any value.
    """
    body = F.coalesce(F.col(body_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"),
        # line breaks cannot stand in a header
        F.replace(F.replace(F.col(url_col), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
        .alias("url"),
        body.alias("body"), F.monotonically_increasing_id().alias("place"),
    ).withColumns(
        {"size": F.octet_length("body"), "digest": sha1_base32(F.col("body")),
         "check": F.xxhash64("body")}
    )
    groups = rows.filter(F.col("size") >= min_bytes).groupBy("digest", "size", "check").agg(
        F.count("*").alias("n"), F.max(F.struct("id", "url", "place")).alias("best")
    )
    groups = stable(groups.filter("n > 1").select("digest", "size", "check", "best"))
    groups = F.broadcast(groups) if groups.count() <= FEW else groups.hint("merge")
    rows = rows.join(groups, ["digest", "size", "check"], "left").withColumn(
        "again", F.col("best").isNotNull() & (F.col("place") != F.col("best.place"))
    )
    own = _name(F.lit("response"), F.col("id"), F.col("url"), F.col("digest"), F.col("place"))
    first = _name(
        F.lit("response"), F.col("best.id"), F.col("best.url"), F.col("digest"), F.col("best.place")
    )
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"), F.lit(END),
    )
    common = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("url"))]
    response = _record(
        F.when(F.col("again"), "revisit").otherwise("response"),
        [("WARC-Record-ID", own), *common,
         ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
         ("WARC-Refers-To", F.when(F.col("again"), first)),
         ("WARC-Profile", F.when(F.col("again"), F.lit(PROFILE))),
         ("Content-Type", F.lit("application/http;msgtype=response"))],
        F.concat(head, F.when(F.col("again"), "").otherwise(F.col("body"))),
    )
    target = F.coalesce(F.regexp_extract("url", r"://([^/?#]*)([^#]*)", 2), F.lit(""))
    host = F.coalesce(F.regexp_extract("url", r"://([^/?#]*)", 1), F.lit(""))
    request = _record(
        F.lit("request"),
        [("WARC-Record-ID", _name(F.lit("request"), F.col("own"))), *common,
         ("WARC-Concurrent-To", F.col("own")),
         ("Content-Type", F.lit("application/http;msgtype=request"))],
        F.concat(F.lit("GET "), F.when(target.startswith("/"), target).otherwise(
            F.concat(F.lit("/"), target)), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END)),
    )
    metadata = _record(
        F.lit("metadata"),
        [("WARC-Record-ID", _name(F.lit("metadata"), F.col("own"))), *common,
         ("WARC-Concurrent-To", F.col("own")),
         ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(
            F.coalesce(F.concat(F.lit("page-id: "), F.col("id").cast("string"), F.lit("\r\n")),
                       F.lit("")),
            F.lit("payload-bytes: "), F.col("size").cast("string"), F.lit("\r\n"),
        ),
    )
    value = F.concat_ws(END, response, request, metadata)
    return rows.withColumn("own", own).select(value.alias("value"), F.col("size").alias("bytes"))


def write_archives(pages: DataFrame, folder: str, **options) -> str:
    """Write the captures of ``pages`` as gzipped WARC files; options of ``captures``.

    Every row is a capture, also one that repeats id, url and body.  A NULL body
    is an empty payload; a NULL url leaves its header out.  Files are cut by a
    number of captures that keeps them at ``FILE_BYTES`` on average and, however
    large captures lie together, below ``MOST_BYTES``.
    """
    body = F.octet_length(options.get("body_col", "html"))
    size = pages.agg(F.avg(body).alias("mean"), F.max(body).alias("most")).first()
    rows = min(FILE_BYTES // ((size["mean"] or 0) + 1500), MOST_BYTES // ((size["most"] or 0) + 1500))
    rows = max(1, int(rows))
    (
        captures(pages, **options).select("value").write
        .option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", rows)
        .text(folder)
    )
    return folder


def parse_records(data: bytes, keep_payload: bool) -> Iterator[dict]:
    """Records of one gzipped or plain archive, read as a stream."""
    raw = io.BytesIO(data)
    stream = io.BufferedReader(_Inflated(raw), 1 << 20) if data[:2] == b"\x1f\x8b" else raw
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        size = int(head["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("the archive ends within a record")
        kind, payload, told = head.get("warc-type"), None, None
        if kind in ("response", "revisit"):
            payload = block.partition(b"\r\n\r\n")[2]
        elif kind == "metadata":
            told = block.decode("utf-8", "replace")
        digest = head.get("warc-payload-digest", "")
        actual = payload if kind == "response" else None
        yield {
            "type": kind, "record_id": head.get("warc-record-id"),
            "concurrent_to": head.get("warc-concurrent-to"), "refers_to": head.get("warc-refers-to"),
            "target_uri": head.get("warc-target-uri"), "date": head.get("warc-date"),
            "declared_digest": digest.partition(":")[2] or None,
            "payload_bytes": None if actual is None else len(actual),
            "payload_digest": None if actual is None
            else base64.b32encode(hashlib.sha1(actual).digest()).decode(),
            "fields": told,
            "block": block if keep_payload and kind == "request" else None,
            "payload": actual if keep_payload else None,
        }


class _Inflated(io.RawIOBase):
    """Bytes of one or more gzip members."""

    def __init__(self, raw):
        self.raw, self.engine, self.rest = raw, zlib.decompressobj(31), b""

    def readable(self):
        return True

    def readinto(self, room):
        while True:
            if self.engine.eof:
                self.rest = self.engine.unused_data or self.rest
                self.engine = zlib.decompressobj(31)
            data = self.rest or self.raw.read(1 << 16)
            self.rest = b""
            if not data:
                return 0
            out = self.engine.decompress(data, len(room))
            self.rest = self.engine.unconsumed_tail
            if out:
                room[: len(out)] = out
                return len(out)


RECORDS = (
    "archive string, type string, record_id string, concurrent_to string, refers_to string, "
    "target_uri string, date string, declared_digest string, payload_bytes bigint, "
    "payload_digest string, fields string, block binary, payload binary"
)
_TYPES = {"payload_bytes": pa.int64(), "block": pa.binary(), "payload": pa.binary()}


def read_archives(spark: SparkSession, folder: str, keep_payload: bool = True) -> DataFrame:
    """One row per record.  Without payloads only their length and digest leave the task."""
    names = [c.split()[0] for c in RECORDS.split(", ")]
    schema = pa.schema([(n, _TYPES.get(n, pa.string())) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows, size = [], 0
                for record in parse_records(content.as_py(), keep_payload):
                    rows.append({"archive": path.as_py(), **record})
                    size += 500 + len(record["payload"] or b"")
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").load(folder)
    return files.select("path", "content").mapInArrow(run, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, response, request, metadata.

    Request and metadata records join the response or revisit that they are
    concurrent to; a part that is missing is NULL.  Repeated records of one
    identifier count once.
    """
    def part(*kinds: str) -> Column:
        told = F.struct(
            "type", "record_id", "refers_to", "target_uri", "date", "declared_digest",
            "payload_bytes", "payload_digest", "fields", "block", "payload",
        )
        return F.min(F.when(F.col("type").isin(*kinds), told))

    return records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture")).agg(
        part("response", "revisit").alias("response"), part("request").alias("request"),
        part("metadata").alias("metadata"),
    ).select(F.col("capture").alias("record_id"), "response", "request", "metadata")


def page_records(transactions: DataFrame, id_type: str = "long") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each capture.

    A revisit takes length and digest from the response it refers to.
    """
    told = F.col("metadata.fields")
    named = F.nullif(F.regexp_extract(told, r"page-id: ([^\r]*)", 1), F.lit(""))
    rows = transactions.select(
        "record_id", named.cast(id_type).alias("page_id"),
        F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("to"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
    )
    first = rows.filter("record_type = 'response'").select(
        F.col("record_id").alias("to"), F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("first_bytes"), F.col("payload_digest").alias("first_digest"),
    )
    again = rows.filter("record_type = 'revisit'").join(first.hint("merge"), "to", "left").select(
        "page_id", F.col("first_bytes").alias("payload_bytes"),
        F.col("first_digest").alias("payload_digest"), "record_type", "refers_to",
    )
    return rows.filter("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.lit(None).cast(id_type).alias("refers_to"),
    ).unionByName(again)
