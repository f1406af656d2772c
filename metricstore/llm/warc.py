"""Web archives: write WARC records, index them, and read selected records by byte range.

Writing is plain DataFrame work: a record's header and payload are one string,
and the text writer ends each with the blank lines that end a WARC record, so
every part file is a valid uncompressed WARC file and commits as Spark's output
does.  Of records with equal payloads (by SHA-1 and length, of ``least`` bytes
or more) the one with the smallest id is a ``response``; the others are
``revisit`` records without payload that refer to it.

The index comes first: one pass over the files writes file, offset, length,
URL, digest, id and type of each record.  Reading takes a selection of index
rows, sorts it by file and offset, joins ranges that lie within ``gap`` bytes of
each other into reads of at most ``most`` bytes (one record may be longer), and
checks each payload against its digest.

Files are opened by URI through Arrow's file systems, on the executors.

Defined results: a null payload is empty; a null or empty URL is written empty;
line breaks in URLs are written as blanks; rows that repeat an id with one
payload are all responses if it is the smallest; a null id is written as
``null`` and read back as null; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricstore.llm.store import stored

END = "\r\n\r\n"
TASK_BYTES = 32 << 20  # of an archive that a task indexes or reads
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 20 bits at a time are four digits."""
    code = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(code, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def records(pages: DataFrame, page_id: str, url: str, html: str, least: int, date: str) -> DataFrame:
    """(record): one string per row, without the blank lines at its end."""
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).cast("string").alias("id"), F.col(page_id).alias("order"),
        F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"[\r\n]", " ").alias("url"), body.alias("html"),
        F.octet_length(body).alias("size"), base32_sha1(body.cast("binary")).alias("digest"))
    firsts = (rows.where(F.col("size") >= least).groupBy("digest", "size")
              .agg(F.min("order").cast("string").alias("first")))
    rows = rows.join(firsts, ["digest", "size"], "left")
    again = F.coalesce(F.col("first") != F.col("id"), F.lit(False))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit(END))
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("html")))
    refers = F.when(again, F.concat(
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"),
        F.col("first"), F.lit(">\r\n"))).otherwise(F.lit(""))
    name = F.concat(F.lit("<urn:page:"), F.coalesce("id", F.lit("null")), F.lit(">"))
    return rows.select(F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), name, F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n"), refers,
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(END), block).alias("record"))


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   least: int = 0, date: str = "2024-01-01T00:00:00Z", per_file: int = 5_000) -> None:
    """Files of at most ``per_file`` records: a file is what one task indexes."""
    made = records(pages, page_id, url, html, least, date)
    made.write.option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)


def _open(uri: str):
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(uri)
    return where.open_input_file(path)


def _head(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}


INDEX = ("file string, offset long, length long, url string, digest string, page_id string, record_type string, "
         "refers_to string")


def index_archives(spark: SparkSession, path: str, chunk: int = 4 << 20) -> DataFrame:
    """A row per record of all files at ``path`` (see INDEX), from one pass of reads of ``chunk`` bytes."""
    files = stored(spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0"), "warc-files")
    tasks = _tasks(files, "length", spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with _open(uri) as f:
                    yield pa.RecordBatch.from_pylist(list(_entries(f, uri, size, chunk)), shape)

    shape = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()),
                       ("digest", pa.string()), ("page_id", pa.string()), ("record_type", pa.string()),
                       ("refers_to", pa.string())])
    return stored(files.repartitionByRange(tasks, F.xxhash64("path")).mapInArrow(run, INDEX), "warc-index")


def _tasks(rows: DataFrame, length: str, spark: SparkSession) -> int:
    """One for each ``TASK_BYTES`` of the archives, not of the rows that describe them; two at least, else one a row at most."""
    total, n = rows.agg(F.sum(length), F.count(F.lit(1))).first()
    total = total or 0
    return max(2, min(n, max(-(-total // TASK_BYTES), min(spark.sparkContext.defaultParallelism, total >> 20))))


def _name(value: str | None) -> str | None:
    inner = value[len("<urn:page:"):-1] if value else None
    return None if inner == "null" else inner


def _entries(f, uri: str, size: int, chunk: int) -> Iterator[dict]:
    at, buf, base = 0, b"", 0
    while at < size:
        while (end := buf.find(b"\r\n\r\n", at - base)) < 0:
            more = f.read_at(min(chunk, size - base - len(buf)), base + len(buf))
            if not more:
                raise ValueError(f"{uri}: no whole record at {at}")
            buf, base = buf[at - base:] + more, at
        head = _head(buf[at - base:end])
        length = end + 4 + base - at + int(head["content-length"])
        yield {"file": uri, "offset": at, "length": length, "url": head["warc-target-uri"],
               "digest": head["warc-payload-digest"].removeprefix("sha1:"), "page_id": _name(head["warc-record-id"]),
               "record_type": head["warc-type"], "refers_to": _name(head.get("warc-refers-to"))}
        at += length + len(END)
        if at > base + len(buf):
            buf, base = b"", at


READ = "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def read_records(index: DataFrame, gap: int = 64 << 10, most: int = 8 << 20, payloads: bool = True) -> DataFrame:
    """The records of the selected index rows (see READ).

    A revisit's payload is null; its length comes from its own HTTP header and its digest from the record.
    """
    shape = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
                       ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("payload", pa.binary())])

    def record(raw: bytes) -> dict:
        split = raw.index(b"\r\n\r\n")
        head = _head(raw[:split])
        block = raw[split + 4:]
        inner = block.index(b"\r\n\r\n")
        http, payload = _head(block[:inner]), block[inner + 4:]
        digest = head["warc-payload-digest"].removeprefix("sha1:")
        whole = head["warc-type"] == "response"
        if whole:
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if found != digest:
                raise ValueError(f"{head['warc-record-id']}: payload digest {found}, not {digest}")
            digest = found
        return {"page_id": _name(head["warc-record-id"]), "url": head["warc-target-uri"],
                "record_type": head["warc-type"], "refers_to": _name(head.get("warc-refers-to")),
                "payload_bytes": len(payload) if whole else int(http["content-length"]), "payload_digest": digest,
                "payload": payload if whole and payloads else None}

    def read(uri: str, ranges: list[tuple[int, int]]) -> pa.RecordBatch:
        start, stop = ranges[0][0], max(o + n for o, n in ranges)
        with _open(uri) as f:
            buf = f.read_at(stop - start, start)
        return pa.RecordBatch.from_pylist([record(buf[o - start:o - start + n]) for o, n in ranges], shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, ranges, stop = None, [], 0
        for batch in batches:
            for file, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3))):
                far = offset > stop + gap or offset + length - (ranges[0][0] if ranges else 0) > most
                if ranges and (file != uri or far):
                    yield read(uri, ranges)
                    ranges, stop = [], 0
                uri = file
                ranges.append((offset, length))
                stop = max(stop, offset + length)
        if ranges:
            yield read(uri, ranges)

    tasks = _tasks(index, "length", index.sparkSession)
    rows = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset")
    return rows.sortWithinPartitions("file", "offset").mapInArrow(run, READ)
