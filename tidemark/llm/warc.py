"""WARC archives: written one gzip member per record, read back sequentially.

Writing: the payload's SHA-1 and size are computed by Spark; of records with equal payloads of at least
``dedup_bytes`` bytes the one with the largest page id is a ``response`` with the payload, the others are ``revisit``
records that name it. Each task streams its records to one archive file at a time and rolls to the next after
``roll_bytes``; the table it returns lists the finished files, so files of lost or repeated attempts are never read.

Reading: one task per archive decompresses incrementally, frames each record by its Content-Length, and verifies block
and payload digests; a damaged archive raises. The full payload is never needed of more than one record at a time.

Defined results: a null payload is empty; rows equal in page id and payload are alike (all response or all revisit);
a null page id is smaller than any other and written as ``-``; a null url is written as empty; empty tables write no
archive; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = b"WARC/1.1"
FILES = "path string, n_records long, n_bytes long"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "offset long, path string"
)
CHUNK = 1 << 16


def plan_records(pages: DataFrame, dedup_bytes: int) -> DataFrame:
    """page_id, url, payload, digest, size and refers_to (null: response).

    The largest page id of each payload is combined before the shuffle; only payloads with two ids or more are joined
    back, and a hot one is split by the planner's skew handling because its side of the join has one row.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
        F.octet_length(payload).cast("long").alias("size"),
    )
    firsts = (
        rows.where(F.col("size") >= dedup_bytes)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("largest"), F.min("page_id").alias("smallest"), F.count("page_id").alias("n_ids"),
             F.count(F.lit(1)).alias("n"))
        .where((F.col("smallest") < F.col("largest")) | (F.col("n_ids") < F.col("n")))
        .select("digest", "size", "largest")
    )
    other = ~F.col("page_id").eqNullSafe(F.col("largest")) & F.col("largest").isNotNull()
    return rows.join(firsts, ["digest", "size"], "left").select(
        "page_id", "url", "payload", F.when(other, F.col("largest")).alias("refers_to")
    )


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()



def header_text(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c > " " and c != "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def from_header(value: str) -> str:
    return re.sub(r"(?:%[0-9A-F]{2})+", lambda m: bytes.fromhex(m[0].replace("%", "")).decode(), value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record: header lines, an empty line, the block, two empty lines."""
    digest = sha1_base32(payload)
    block = payload if refers_to is None else b""
    lines = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'-' if page_id is None else page_id}>"),
        ("WARC-Target-URI", header_text(url or "")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Payload-Length", str(len(payload))),
        ("WARC-Block-Digest", f"sha1:{digest if refers_to is None else sha1_base32(block)}"),
    ]
    if refers_to is not None:
        lines += [
            ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
    lines.append(("Content-Length", str(len(block))))
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in lines)
    return head + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    """Any shared file system: a local mount, HDFS or an object store."""
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))


def rows_in(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield from zip(*[column.to_pylist() for column in batch.slice(at, step).columns], strict=True)


def write_archives(records: DataFrame, folder: str, roll_bytes: int = 64 << 20, level: int = 6) -> DataFrame:
    """Write page_id, url, payload, refers_to rows below ``folder``; returns path, n_records, n_bytes of each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        out, name, files, counts = None, "", [], [0, 0]
        try:
            for row in rows_in(batches):
                if out is None:
                    name, counts = f"{root}/{uuid.uuid4().hex}.warc.gz", [0, 0]
                    out = store.open_output_stream(name, compression=None)
                data = member(record(*row), level)
                out.write(data)
                counts = [counts[0] + 1, counts[1] + len(data)]
                if counts[1] >= roll_bytes:
                    out.close()
                    out = None
                    files.append((name, *counts))
        finally:
            if out is not None:
                out.close()
                files.append((name, *counts))
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("path", "n_records", "n_bytes"), f, strict=True)) for f in files],
            pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())]),
        )

    return records.select("page_id", "url", "payload", "refers_to").mapInArrow(run, FILES)


class Members:
    """The bytes of the gzip member that begins at the stream's place, and after it the next one's."""

    def __init__(self, stream):
        self.stream, self.rest, self.offset = stream, b"", 0

    def more(self) -> bool:
        if not self.rest:
            self.rest = self.stream.read(CHUNK)
        return bool(self.rest)

    def pieces(self) -> Iterator[bytes]:
        unpacker = zlib.decompressobj(31)
        while not unpacker.eof:
            if not self.more():
                raise ValueError(f"gzip member cut off at {self.offset}")
            piece = unpacker.decompress(self.rest, 1 << 20)
            self.offset += len(self.rest)
            self.rest = unpacker.unused_data if unpacker.eof else unpacker.unconsumed_tail
            self.offset -= len(self.rest)
            yield piece


def read_record(pieces: Iterator[bytes], where: str) -> tuple[dict[str, str], int, str, bytes]:
    """Headers, block length, block SHA-1 (base32) and what follows the block; the block itself is not kept."""
    buffer = b""
    while (end := buffer.find(b"\r\n\r\n")) < 0:
        piece = next(pieces, None)
        if piece is None:
            raise ValueError(f"{where}: no end of headers")
        buffer += piece
    lines = buffer[:end].decode().split("\r\n")
    if lines[0].encode() != VERSION:
        raise ValueError(f"{where}: not a record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    left = length = int(headers["Content-Length"])
    digest, buffer = hashlib.sha1(), buffer[end + 4 :]
    while True:
        digest.update(buffer[:left])
        used = min(left, len(buffer))
        left -= used
        buffer = buffer[used:]
        if not left:
            break
        buffer = next(pieces, None)
        if buffer is None:
            raise ValueError(f"{where}: block shorter than its Content-Length")
    return headers, length, base64.b32encode(digest.digest()).decode(), buffer + b"".join(pieces)


def page_of(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(found[1]) if found else None


def read_archive(store: fs.FileSystem, path: str) -> Iterator[dict]:
    with store.open_input_stream(path, compression=None) as stream:
        members = Members(stream)
        while members.more():
            offset = members.offset
            where = f"{path} at {offset}"
            headers, length, digest, tail = read_record(members.pieces(), where)
            if tail != b"\r\n\r\n":
                raise ValueError(f"{where}: block longer than its Content-Length")
            if headers["WARC-Block-Digest"] != f"sha1:{digest}":
                raise ValueError(f"{where}: block digest differs")
            payload = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            kind = headers["WARC-Type"]
            if kind == "response" and (payload != digest or int(headers["WARC-Payload-Length"]) != length):
                raise ValueError(f"{where}: payload digest or length differs")
            yield {
                "page_id": page_of(headers["WARC-Record-ID"]),
                "url": from_header(headers["WARC-Target-URI"]),
                "record_type": kind,
                "refers_to": page_of(headers.get("WARC-Refers-To")),
                "payload_bytes": int(headers["WARC-Payload-Length"]),
                "payload_digest": payload,
                "offset": offset,
                "path": path,
            }


def read_archives(spark: SparkSession, files: DataFrame, folder: str, rows: int = 1000) -> DataFrame:
    """The records of the listed archives, headers and checks only; one archive is one task's work at a time."""
    schema = pa.schema(
        [
            (name, pa.string() if kind == "string" else pa.int64())
            for name, kind in (part.split() for part in RECORDS.split(", "))
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        found: list[dict] = []
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for row in read_archive(store, path):
                    found.append(row)
                    if len(found) == rows:
                        yield pa.RecordBatch.from_pylist(found, schema)
                        found = []
        if found:
            yield pa.RecordBatch.from_pylist(found, schema)

    return files.select("path").repartition(max(1, files.count())).mapInArrow(run, RECORDS)
