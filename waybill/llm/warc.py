"""WARC archives: a writer with one gzip member per record, and a sequential, verifying reader.

``write`` makes one record a page, payload the html in UTF-8 (null: empty) behind a small HTTP
header. Of pages with equal payloads of at least ``min_bytes`` bytes the one with the smallest
page_id becomes a response, the others revisit records without payload that refer to it; smaller
payloads are always responses. Each task writes its own files, cut at ``file_bytes``, to the shared
folder under a name that holds the task attempt; the returned manifest lists only files of tasks
that succeeded, so attempts that were lost or repeated leave nothing that is read.

``read`` walks through each listed file with incremental decompression in constant-size chunks,
takes blocks by content length, and checks block and payload digests; a broken record raises.

Defined cases: a row without page_id is a response of its own that nothing refers to; rows with
the same page_id and payload are of one kind; a null url becomes ``urn:page:ID``; control
characters and spaces in a url are percent-encoded. Further columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.storage import folder, kept

VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 16
FILE_BYTES = 256 << 20
HEAD_BYTES = 1 << 20

RECORD = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, payload binary")
_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("payload", pa.binary())])


class BrokenRecord(ValueError):
    """A record that does not hold what it says."""


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _target(url: str | None, page_id: int | None) -> str:
    if not url:
        return f"urn:page:{page_id}"
    return "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode())
                   for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
           level: int = 1) -> bytes:
    """One gzip member."""
    digest = sha1_base32(payload)
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             f"Content-Length: {len(payload)}\r\n\r\n").encode()
    if refers_to is None:
        block += payload
    head = {"WARC-Type": "response" if refers_to is None else "revisit",
            "WARC-Record-ID": record_id(page_id, digest), "WARC-Date": DATE,
            "WARC-Target-URI": _target(url, page_id)}
    if page_id is not None:
        head["Page-ID"] = str(page_id)
    if url is None:
        head["Page-Without-URL"] = "yes"
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to, digest),
                 "Page-Refers-To": str(refers_to)}
    head |= {"WARC-Payload-Digest": f"sha1:{digest}", "WARC-Block-Digest":
             f"sha1:{sha1_base32(block)}", "Content-Type": "application/http; msgtype=response",
             "Content-Length": str(len(block))}
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode()
    return (pack.compress(VERSION + b"\r\n" + lines + b"\r\n")
            + pack.compress(block) + pack.compress(b"\r\n\r\n") + pack.flush())


def members(stream: pa.NativeFile) -> Iterator[Iterator[bytes]]:
    """The decompressed chunks of each gzip member; take all of one before the next."""
    rest = stream.read(CHUNK)
    while rest:
        pack = zlib.decompressobj(31)

        def chunks() -> Iterator[bytes]:
            nonlocal rest
            while not pack.eof:  # noqa: B023 - one member at a time
                out = pack.decompress(rest, CHUNK)  # noqa: B023
                rest = pack.unconsumed_tail or pack.unused_data  # noqa: B023
                if out:
                    yield out
                if not rest and not pack.eof:  # noqa: B023
                    rest = stream.read(CHUNK)
                    if not rest and not out:
                        raise BrokenRecord("the file ends inside a record")

        yield chunks()
        if not pack.eof:
            raise BrokenRecord("a record was not read to its end")
        rest = rest or stream.read(CHUNK)


def _headers(text: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in
            (line.partition(":") for line in text.decode().split("\r\n")[1:] if line)}


def parse(chunks: Iterator[bytes]) -> dict:
    """One record from its decompressed chunks, framed by content length and verified."""
    buffer = bytearray()
    end = -1
    for chunk in chunks:
        buffer += chunk
        end = buffer.find(b"\r\n\r\n")
        if end >= 0 or len(buffer) > HEAD_BYTES:
            break
    if end < 0 or not buffer.startswith(VERSION):
        raise BrokenRecord("no record header")
    head = _headers(bytes(buffer[:end]))
    del buffer[:end + 4]
    length = int(head["content-length"])
    for chunk in chunks:
        buffer += chunk
        if len(buffer) > length + 4:
            break
    if len(buffer) > length + 4:
        raise BrokenRecord("longer than its content length")
    if len(buffer) != length + 4 or not buffer.endswith(b"\r\n\r\n"):
        raise BrokenRecord("shorter than its content length")
    block = bytes(buffer[:length])
    if head["warc-block-digest"] != f"sha1:{sha1_base32(block)}":
        raise BrokenRecord("block digest")
    http, found, payload = block.partition(b"\r\n\r\n")
    if not found:
        raise BrokenRecord("no HTTP header")
    size, digest = int(_headers(http)["content-length"]), head["warc-payload-digest"][5:]
    kind = head["warc-type"]
    if kind == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise BrokenRecord("payload digest")
    return {"page_id": int(head["page-id"]) if "page-id" in head else None,
            "url": None if "page-without-url" in head else head["warc-target-uri"],
            "record_type": kind,
            "refers_to": int(head["page-refers-to"]) if "page-refers-to" in head else None,
            "payload_bytes": size, "payload_digest": digest,
            "payload": payload if kind == "response" else None}


def write(pages: DataFrame, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the archives; the manifest (path, records, bytes) of what was written."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                        F.unhex(F.sha2(html, 256)).alias("digest"))
    first = (rows.where((F.octet_length("html") >= min_bytes) & F.col("page_id").isNotNull())
             .groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .where("n > 1").drop("n"))
    linked = rows.join(first, "digest", "left").select(
        "page_id", "url", "html", F.when(F.col("page_id") != F.col("first"), F.col("first"))
        .alias("refers_to"))
    top = folder(pages.sparkSession, "warc")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        where, path = pafs.FileSystem.from_uri(top)
        where.create_dir(path, recursive=True)
        out, name, size, records, number = None, "", 0, 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(4)), strict=True):
                page_id, url, payload, refers_to = (x.as_py() for x in row)
                if out is None:
                    name = f"{task.partitionId():06d}-{number:04d}-{task.taskAttemptId()}.warc.gz"
                    out, size, records, number = (where.open_output_stream(f"{path}/{name}",
                                                                           compression=None),
                                                  0, 0, number + 1)
                data = record(page_id, url, payload, refers_to)
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= file_bytes:
                    out.close()
                    done.append((f"{top}/{name}", records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{top}/{name}", records, size))
        names, counts, sizes = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(counts, pa.int64()),
             pa.array(sizes, pa.int64())], ["path", "records", "bytes"])

    return kept(linked.mapInArrow(put, "path string, records long, bytes long"), "warc-manifest")


def read(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the listed files. Without ``payloads`` that column is null, though every
    payload is still read and verified."""

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                where, path = pafs.FileSystem.from_uri(uri)
                with where.open_input_stream(path, compression=None) as stream:
                    rows: list[dict] = []
                    held = 0
                    for member in members(stream):
                        row = parse(member)
                        held += 200 + (len(row["payload"] or b"") if payloads else 0)
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _RECORD)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, _RECORD)

    files = manifest.select("path")
    return files.repartition(max(1, files.count())).mapInArrow(get, RECORD)


def digest(records: DataFrame) -> DataFrame:
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
with p as (select *, sha1(coalesce(html, '')) as h from pages),
f as (select h, min(page_id) as first from p group by h),
b as (select page_id, h, first,
             list_transform(range(0, 32), lambda i:
               (('0x' || substr(h, (i * 5 // 20) * 5 + 1, 5))::bigint
                >> (15 - (i * 5) % 20)::bigint) & 31) as d
      from (select p.*, first from p join f on p.h = f.h))
select p.page_id, strlen(coalesce(p.html, '')) as payload_bytes,
       list_aggregate(list_transform(b.d, lambda x:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x + 1)::int, 1)), 'string_agg', '')
         as payload_digest,
       case when p.page_id = b.first then 'response' else 'revisit' end as record_type,
       case when p.page_id <> b.first then b.first end as refers_to
from p join b on p.page_id = b.page_id
"""
