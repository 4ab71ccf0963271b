"""WARC archives written and read by Spark, with long payloads as rows of chunks.

A payload is a table of chunks: record and chunk number. Each chunk becomes a
WARC record of its own, the first a ``response``, the others its ``continuation``
segments, as the WARC standard provides. A chunk is a row of text that Spark's
text writer ends with the two line breaks that close a record, so archives go
to any store that Spark writes to, gzipped.

They are read by lines. A record's state in the reader is the bytes it still
waits for and a running SHA-1 that each chunk's row carries on, so neither side
ever joins a whole payload. The reader checks every digest against its header.

Of equal payloads one is stored; the others are ``revisit`` records that name it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 1 << 16
BREAK = "\r\n"

_READ_SCHEMA = (
    "record_id string, chunk int, record_type string, refers_to string, data binary, "
    "payload_bytes long, sha1_so_far string, last boolean"
)


def with_originals(pages: DataFrame, key: str, payload: str, least_bytes: int) -> DataFrame:
    """``key``, ``payload``, ``digest`` (SHA-1), ``bytes`` and ``refers_to``: the key of the row that stores an equal payload.

    Payloads of fewer than ``least_bytes`` refer to none. Groups are counted
    per task before the shuffle, so a payload that most rows share is no burden.
    """
    rows = pages.select(F.col(key).alias("key"), "url", F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    rows = rows.withColumns(
        {"digest": F.sha1("payload"), "strong": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("long")}
    )
    large = rows.filter(F.col("bytes") >= least_bytes).select("key", "strong")
    groups = large.groupBy("strong").agg(F.max("key").alias("original"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return rows.join(groups.select("strong", "original"), "strong", "left").withColumn(
        "refers_to", F.when(F.col("key") != F.col("original"), F.col("original"))
    )


def chunks(rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """Rows of stored payloads by chunk number from 1, of at most ``size`` characters; revisits have one empty chunk."""
    data = F.when(F.col("refers_to").isNotNull(), F.array(F.lit("")))
    data = data.when(F.length("payload") <= size, F.array("payload"))
    data = data.otherwise(F.regexp_extract_all("payload", F.lit(rf"(?s).{{1,{size}}}"), 0))
    return rows.withColumn("data", data).select(
        "key", "url", "digest", "bytes", "refers_to", F.size("data").alias("n"), F.posexplode("data").alias("chunk", "data")
    ).withColumn("chunk", F.col("chunk") + 1)


def _header(name: str, value: Column, where: Column | None = None) -> Column:
    line = F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))
    return line if where is None else F.when(where, line).otherwise("")


def record_text(date: str) -> Column:
    """A chunk as the text of its WARC record, but for the line breaks that end it."""
    first, several = F.col("chunk") == 1, F.col("n") > 1
    revisit = F.col("refers_to").isNotNull()
    urn = lambda name: F.concat(F.lit("<urn:record:"), name.cast("string"), F.lit(">"))
    key = F.coalesce(F.col("key").cast("string"), F.lit("null"))
    segment = F.when(first, urn(key)).otherwise(urn(F.concat(key, F.lit("/"), F.col("chunk"))))
    # A line break or other control character in a URL would end its header.
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    return F.concat(
        F.lit("WARC/1.1" + BREAK),
        _header("WARC-Type", F.when(revisit, "revisit").when(first, "response").otherwise("continuation")),
        _header("WARC-Record-ID", segment),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", url, first & (url != "")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _header("WARC-Payload-Length", F.col("bytes").cast("string")),
        _header("WARC-Refers-To", urn(F.col("refers_to")), revisit),
        _header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), revisit),
        _header("WARC-Segment-Number", F.col("chunk").cast("string"), several),
        _header("WARC-Segment-Origin-ID", urn(key), ~first),
        _header("WARC-Segment-Total-Length", F.col("bytes").cast("string"), several & (F.col("chunk") == F.col("n"))),
        _header("Content-Type", F.lit("text/html")),
        _header("Content-Length", F.octet_length("data").cast("string")),
        F.lit(BREAK),
        F.col("data"),
    )


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    payload: str = "html",
    least_bytes: int = 1000,
    size: int = CHUNK,
    date: str = "2000-01-01T00:00:00Z",
) -> None:
    """Write a table of pages (``key``, ``url``, ``payload``) as gzipped archives below ``path``.

    A null payload is empty, a null URL has no header. Of equal payloads of ``least_bytes`` bytes or
    more the row with the largest key is stored (rows that repeat this key, each); a null key is stored
    as ``null`` and never revisits another. An empty table writes an archive without records.
    """
    rows = chunks(with_originals(pages, key, payload, least_bytes), size)
    rows.select(record_text(date).alias("value")).write.option("lineSep", BREAK * 2).option("compression", "gzip").text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of all records below a folder of archives.

    Columns: ``record_id`` (of the first segment), ``chunk``, ``record_type``,
    ``refers_to``, ``data``, ``payload_bytes`` and ``sha1_so_far`` of the payload up to
    and including the chunk, ``last``. A revisit has no data; its length and
    digest are those its headers give. A damaged record, or one whose payload
    doesn't have the digest of its header, ends the job.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return lines.mapInArrow(_records, _READ_SCHEMA)


class _Reader:
    """Takes the lines of one archive in order and makes rows of its records."""

    def __init__(self):
        self.head: dict[str, str] | None = None
        self.left = 0
        self.kept: list[bytes] = []
        self.digest, self.done, self.of = hashlib.sha1(), 0, None
        self.waits_for_end = False

    def take(self, line: bytes) -> tuple | None:
        if self.left:
            line += b"\n"
            part, rest = line[: self.left], line[self.left :]
            self.kept.append(part)
            self.left -= len(part)
            if self.left:
                return None
            # What follows the last byte of the content is the line break that ends the record.
            line = rest.rstrip(b"\n")
            row = self._row()
            self._ends(line)
            return row
        if self.waits_for_end:
            self.waits_for_end = line.rstrip(b"\r") != b""
            if self.waits_for_end:
                raise ValueError("a record goes on beyond its length")
            return None
        if self.head is None:
            if line.rstrip(b"\r") == b"":
                return None
            if not line.startswith(b"WARC/1."):
                raise ValueError(f"not the start of a record: {line[:60]!r}")
            self.head = {}
            return None
        name, _, value = line.rstrip(b"\r").decode().partition(": ")
        if name:
            self.head[name] = value
            return None
        self.left = int(self.head["Content-Length"])
        if self.left == 0:
            row = self._row()
            # Content of no bytes: the next two lines are the record's end.
            return row
        return None

    def _ends(self, rest: bytes) -> None:
        if rest.rstrip(b"\r"):
            raise ValueError("a record goes on beyond its length")
        self.waits_for_end = True

    def _row(self) -> tuple:
        head, data = self.head, b"".join(self.kept)
        self.head, self.kept = None, []
        kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
        total = int(head["WARC-Payload-Length"])
        if kind == "revisit":
            return _name(head["WARC-Record-ID"]), 1, kind, _name(head["WARC-Refers-To"]), data, total, digest, True
        of = head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"])
        number = int(head.get("WARC-Segment-Number", "1"))
        if number == 1:
            self.digest, self.done, self.of = hashlib.sha1(), 0, of
        elif of != self.of:
            raise ValueError(f"segment {number} of {of} doesn't follow its origin")
        self.digest.update(data)
        self.done += len(data)
        last = "WARC-Segment-Number" not in head or "WARC-Segment-Total-Length" in head
        so_far = self.digest.hexdigest()
        if last and (so_far, self.done) != (digest, total):
            raise ValueError(f"{of} doesn't have the digest and length of its header")
        return _name(of), number, "response" if number == 1 else kind, None, data, self.done, so_far, last


def _name(urn: str) -> str:
    return urn.removeprefix("<urn:record:").removesuffix(">")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    file, reader, rows, held = None, None, [], 0
    for batch in batches:
        for name, value in zip(batch.column("file"), batch.column("value")):
            if name.as_py() != file:
                if reader and (reader.left or reader.head is not None):
                    raise ValueError(f"{file} ends within a record")
                file, reader = name.as_py(), _Reader()
            row = reader.take(value.as_py().encode())
            if row:
                rows.append(row)
                held += len(row[4])
                if held > 1 << 22 or len(rows) >= 5000:
                    yield _rows(rows)
                    rows, held = [], 0
    if reader and (reader.left or reader.head is not None):
        raise ValueError(f"{file} ends within a record")
    if rows:
        yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.bool_())
    names = [f.split()[0] for f in _READ_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def payloads(read: DataFrame) -> DataFrame:
    """One row per record: ``record_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``.

    Only last chunks are looked at: they carry the digest of the whole.
    """
    kind = F.when(F.col("record_type") == "continuation", "response").otherwise(F.col("record_type"))
    return read.filter("last").select(
        "record_id", "payload_bytes", F.col("sha1_so_far").alias("payload_digest"), kind.alias("record_type"), "refers_to"
    )
