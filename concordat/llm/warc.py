"""Deterministic sharded WARC archives of pages.

Payloads are digested in the JVM and digests, not payloads, decide who repeats whom: equal payloads of REVISIT bytes
or more are one response, that of the largest page_id, and revisit records. What a page refers to travels to the page as
a small row with its page_id, so payloads are shuffled once, by the range sort. Each task writes its range of page_ids record by
record, every record a gzip member of its own, and starts a new file when the compressed size reaches a bound. Headers, record
ids and digests are made anew from the rows and nothing else (no clock, no random number), so a task that runs again
makes the same files. A file has a temporary name until it is whole; the manifest, a table, names the files that count.

A payload that a third of all pages share is one row per task and digest, combined before the shuffle.

Defined cases: null html is an empty payload; null urls get a name made of the page_id; control characters in urls are
percent-encoded; null page_ids sort first, and only refer, unless all with that payload are null; rows with equal
page_ids are records of their own, responses where theirs is the largest; an empty table gives no files; other columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm import storage
from concordat.session import pin, ship_package

REVISIT = 1000
FILE_BYTES = 16 << 20  # compressed size at which a file ends
TASK_BYTES = 32 << 20  # payload bytes that a task is meant to write
DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_MANIFEST = "part int, file string, records long, bytes long, sha1 string, first_page long, last_page long"
_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def roles(pages: DataFrame, least: int = REVISIT) -> DataFrame:
    """page_id, _digest and refers_to of the pages that repeat another's payload."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(body).alias("_digest"), F.octet_length(body).alias("_n"))
    narrow = pin(narrow.where(F.col("_n") >= least).drop("_n"))
    groups = narrow.groupBy("_digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("_c")).where("_c > 1")
    return narrow.join(groups, "_digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull()).select(
        "page_id", "_digest", "refers_to")


def _hex(digest: str) -> str:
    return base64.b32decode(digest).hex()


def _b32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page}|{digest}')}>"


def record(page, url, payload: bytes, refers_to=None, repeats: bool = False) -> bytes:
    """One uncompressed record; repeats makes it a revisit of the page refers_to."""
    digest = _b32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if repeats else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{'' if page is None else page}"
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if repeats else 'response'}", f"WARC-Record-ID: {record_id(page, digest)}",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{_b32(block)}", f"X-Payload-Length: {len(payload)}",
    ]
    if page is not None:
        head.append(f"X-Page-ID: {page}")
    if repeats:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _info(name: str) -> bytes:
    block = b"software: concordat\r\nformat: WARC File Format 1.1\r\n"
    head = (
        f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(_SPACE, name)}>\r\nWARC-Date: {DATE}\r\n"
        f"WARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n"
    )
    return head.encode() + block + b"\r\n\r\n"


def _packed(data: bytes) -> bytes:
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    return member.compress(data) + member.flush()


def _rows(batches: Iterator[pa.RecordBatch]):
    """(page_id, url, payload, refers_to or None, whether it repeats) in order; role rows precede their pages."""
    page_now, known = object(), {}
    for batch in batches:
        columns = [batch.column(c) for c in ("page_id", "_digest", "refers_to", "url", "html")]
        for i in range(batch.num_rows):
            page, digest, refers, url, html = (c[i].as_py() for c in columns)
            if page != page_now:
                page_now, known = page, {}
            if digest is not None:
                known[digest] = refers
                continue
            payload = html or b""
            refers = known.get(hashlib.sha1(payload).hexdigest()) if known else None
            yield page, url, payload, refers, refers is not None


def _write(folder: str, file_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, rows = TaskContext.get(), _rows(batches)
    part, attempt = task.partitionId(), str(task.taskAttemptId())
    row, number = next(rows, None), 0
    while row is not None:
        name = f"pages-{part:06d}-{number:05d}.warc.gz"
        size, count, digest, first = 0, 0, hashlib.sha1(), row[0]
        with storage.writing(f"{folder}/{name}", attempt) as out:
            data = _packed(_info(name))
            while True:
                out.write(data)
                digest.update(data)
                size += len(data)
                if row is None or size >= file_bytes:
                    break
                data, last = _packed(record(*row)), row[0]
                count += 1
                row = next(rows, None)
        values = [part, f"{folder}/{name}", count, size, digest.hexdigest(), first, last]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        yield pa.record_batch(
            [pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
            ["part", "file", "records", "bytes", "sha1", "first_page", "last_page"])
        number += 1


def write_archives(
    pages: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES, task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Writes the archives and returns their manifest."""
    spark = pages.sparkSession
    ship_package(spark)
    folder = folder or storage.new_folder(spark, "warc")
    size = pages.agg(F.coalesce(F.sum(F.octet_length("html").cast("long")), F.lit(0))).first()[0]
    none = F.lit(None)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), none.cast("string").alias("_digest"), none.cast("long").alias("refers_to"),
        F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("html"))
    said = roles(pages).select("page_id", "_digest", "refers_to", none.cast("string").alias("url"), none.cast("binary").alias("html"))
    ordered = rows.unionByName(said).repartitionByRange(max(1, -(-size // task_bytes)), "page_id").sortWithinPartitions(
        "page_id", F.col("_digest").isNull(), "url", "html")
    return pin(ordered.mapInArrow(partial(_write, folder, file_bytes), _MANIFEST))


def records(stream, chunk: int = 1 << 16) -> Iterator[bytes]:
    """Uncompressed records of an archive, one gzip member at a time."""
    data = stream.read(chunk)
    while data:
        member, parts = zlib.decompressobj(31), []
        while True:
            parts.append(member.decompress(data))
            if member.eof:
                data = member.unused_data or stream.read(chunk)
                break
            data = stream.read(chunk)
            if not data:
                raise ValueError("the archive ends inside a record")
        yield b"".join(parts)


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    for batch in batches:
        for uri in batch.column("file").to_pylist():
            found = []
            for data in records(storage.reading(uri)):
                fields, block = parsed(data)
                kind = fields["WARC-Type"]
                if kind == "warcinfo":
                    continue
                digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
                if fields["WARC-Block-Digest"] != f"sha1:{_b32(block)}":
                    raise ValueError(f"{uri}: a block differs from its digest")
                if kind == "response":
                    payload = block.partition(b"\r\n\r\n")[2]
                    if _b32(payload) != digest or len(payload) != size:
                        raise ValueError(f"{uri}: a payload differs from its digest")
                page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                found.append((page and int(page), size, _hex(digest), kind, refers and int(refers)))
            yield pa.record_batch([pa.array(v, k) for v, k in zip(zip(*found, strict=True), kinds, strict=True)], names)


def read_archives(manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record, from the files."""
    ship_package(manifest.sparkSession)
    files = manifest.select("file").repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4, "file")
    return files.mapInArrow(_read, _READ)
