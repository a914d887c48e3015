"""Deterministic sharded WARC writer and reader.

Pages are range-sorted by id (and digest), every range is written by one task, and a task starts a new file when the
compressed size of the open one reaches ``roll_bytes``. Records are gzip members of their own with headers and digests
made anew, so equal input gives equal bytes. A file is written under a temporary name and moved to its final one when
whole; a repeated attempt replaces it by the same bytes. The manifest, written last, names the files that count.

Of records with equal payloads of at least ``least_bytes`` bytes the one with the largest id is a response and the
others are revisits that refer to it; their payload is stored once.

Edge cases: null payloads are empty. A null id comes first, is never referred to, and can be a revisit. Rows that
repeat an id and a payload are records of their own; all rows with the largest id are responses. Null addresses have no
target header; control characters in addresses are percent-encoded. An empty table gives a manifest without files.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracecause.llm.common import cut_lineage, fresh_path

LEAST_BYTES, ROLL_BYTES = 1000, 64 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, records long, bytes long, sha256 string"
MANIFEST_SCHEMA = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()),
                             ("sha256", pa.string())])


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id, digest: str) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}:{digest}>"


def record(page_id, url, payload: bytes, refers_to) -> bytes:
    """One record, not compressed. A revisit keeps the HTTP header (with the payload's length) and no payload."""
    digest = hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines += [f"WARC-Payload-Digest: {sha1_label(payload)}", f"WARC-Block-Digest: {sha1_label(block)}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


class RollingWriter:
    """Files of one task; ``done`` has a manifest row for each."""

    def __init__(self, folder: str, part: int, roll_bytes: int):
        self.store, self.folder = fs.FileSystem.from_uri(folder)
        self.part, self.roll_bytes, self.done, self.out = part, roll_bytes, [], None

    def add(self, raw: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.part:05d}-{len(self.done):05d}.warc.gz"
            self.temporary = f"{self.folder}/_temporary/{self.name}-{uuid.uuid4().hex}"
            self.out, self.size, self.records, self.digest = self.store.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = packer.compress(raw) + packer.flush()
        self.out.write(packed)
        self.digest.update(packed)
        self.size += len(packed)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.store.move(self.temporary, f"{self.folder}/{self.name}")
            self.done.append((self.name, self.records, self.size, self.digest.hexdigest()))
            self.out = None


def revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of the rows that repeat a payload; narrow, and folded before any shuffle."""
    narrow = pages.select("page_id", F.sha1(payload_column()).alias("digest"), F.octet_length(payload_column()).alias("n"))
    narrow = narrow.where(F.col("n") >= least_bytes)
    chiefs = (narrow.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies"))
              .where("copies > 1").drop("copies"))
    again = narrow.join(chiefs, "digest").where("page_id IS NULL OR page_id < refers_to").where("refers_to IS NOT NULL")
    return again.select("page_id", "digest", "refers_to").distinct()


def payload_column():
    return F.coalesce(F.col("html"), F.lit(""))


def write(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``folder`` (a URI all executors reach) and return the manifest."""
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(f"{root}/_temporary", recursive=True)
    # What a revisit refers to travels with the pages through one shuffle and precedes them in its range.
    narrow = cut_lineage(revisits(pages, least_bytes))
    rows = pages.select("page_id", F.sha1(payload_column()).alias("digest"), "url", payload_column().alias("html"),
                        F.lit(None).cast(narrow.schema["refers_to"].dataType).alias("refers_to"))
    marks = narrow.select("page_id", "digest", F.lit(None).cast("string").alias("url"),
                          F.lit(None).cast("string").alias("html"), "refers_to")
    ranged = (rows.unionByName(marks).repartitionByRange(F.col("page_id").asc_nulls_first(), "digest")
              .sortWithinPartitions(F.col("page_id").asc_nulls_first(), "digest", F.col("html").isNotNull(), "url"))

    def run(batches):
        from pyspark import TaskContext

        writer = RollingWriter(folder, TaskContext.get().partitionId(), roll_bytes)
        mark, refers_to = None, None
        for b in batches:
            for at in range(0, b.num_rows, 256):
                for row in b.slice(at, 256).to_pylist():
                    if row["html"] is None:
                        mark, refers_to = (row["page_id"], row["digest"]), row["refers_to"]
                        continue
                    target = refers_to if mark == (row["page_id"], row["digest"]) else None
                    writer.add(record(row["page_id"], row["url"], row["html"].encode(), target))
        writer.close()
        yield pa.RecordBatch.from_pydict(dict(zip(MANIFEST_SCHEMA.names, map(list, zip(*writer.done, strict=True)) if writer.done
                                                  else ([], [], [], []), strict=True)), MANIFEST_SCHEMA)

    manifest = ranged.mapInArrow(run, MANIFEST)
    manifest.write.parquet(f"{folder.rstrip('/')}/_manifest")  # committed whole or not at all
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/_manifest")


def parse(stream, chunk: int = 1 << 20):
    """Records (headers, block) of a file of gzip members, streamed."""
    buffer, unpacker, packed = bytearray(), zlib.decompressobj(31), b""
    ended = False
    while True:
        head = buffer.find(b"\r\n\r\n")
        if head >= 0:
            lines = bytes(buffer[:head]).decode().split("\r\n")
            headers = dict(line.split(": ", 1) for line in lines[1:])
            size = int(headers["Content-Length"])
            whole = head + 4 + size + 4
            if len(buffer) >= whole:
                yield headers, bytes(buffer[head + 4:head + 4 + size])
                del buffer[:whole]
                continue
        if ended:
            if buffer:
                raise ValueError("the archive ends within a record")
            return
        if not packed:
            packed = stream.read(chunk)
            if not packed:
                ended = True
                continue
        buffer += unpacker.decompress(packed)
        packed = unpacker.unused_data
        if unpacker.eof:
            unpacker = zlib.decompressobj(31)


RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
RECORD_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                           ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                           ("payload", pa.binary())])


def page_of(urn: str | None):
    return None if urn is None or urn.startswith("<urn:page:null:") else int(urn.split(":")[2])


def read(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the files in the manifest, digests checked. Revisits have the digest and length of what they repeat
    and no payload; ``payloads=False`` leaves the column null for all."""
    def row(headers, block):
        http, _, payload = block.partition(b"\r\n\r\n")
        if sha1_label(block) != headers["WARC-Block-Digest"]:
            raise ValueError(f"block digest of {headers['WARC-Record-ID']} is wrong")
        kind = headers["WARC-Type"]
        if kind == "response" and sha1_label(payload) != headers["WARC-Payload-Digest"]:
            raise ValueError(f"payload digest of {headers['WARC-Record-ID']} is wrong")
        digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        return (page_of(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), kind, size, digest,
                page_of(headers.get("WARC-Refers-To")), payload if payloads and kind == "response" else None)

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    rows, held = [], 0
                    for headers, block in parse(stream):
                        rows.append(row(headers, block))
                        held += len(block) if payloads else 0
                        if len(rows) >= 4096 or held >= 8 << 20:
                            yield as_batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield as_batch(rows)

    def as_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), RECORD_SCHEMA.types, strict=True)],
                                          schema=RECORD_SCHEMA)

    # A file is a unit of work: as many tasks as files, up to the session's number of partitions.
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("file").repartition(tasks).mapInArrow(run, RECORDS)


def archive_folder(spark) -> str:
    path = fresh_path(spark, "warc")
    return path if ":" in path.split("/")[0] else f"file://{path}"
