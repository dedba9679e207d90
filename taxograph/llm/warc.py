"""WARC archives: a writer with revisit records and a sequential, verifying reader.

Each record is one gzip member. The reader streams an archive once, front to back: it inflates with
an incremental zlib object, frames blocks by Content-Length, hashes while it reads and compares with
the block digest and, for responses, the payload digest; a mismatch, a truncated member or bytes
between members raise ValueError. Memory is bounded by the chunk size unless payloads are asked for.

Archives are written by tasks to the shared folder under names of their own; only those in the
manifest of a finished task are read, so a lost or repeated task leaves no trace in the result.

Defined cases: a null html is an empty payload; a null url has no target header; a null id has no id
header and reads back as null; ids given twice are separate records, both are the response if theirs
is the smallest id of the payload; ties go to the smallest id, null last; other columns are not
carried; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxograph.llm.common import new_path, partitions, small_batches, staged

REVISIT_LEAST = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
CHUNK = 1 << 16
ARCHIVE_BYTES = 64 << 20
RESULT = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, target_uri string, archive string, record_offset bigint"


def printable(value: str) -> str:
    """A header value on one line: control characters percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member; with refers_to a revisit, whose block has no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {printable(url)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    raw = ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"
    deflate = zlib.compressobj(4, zlib.DEFLATED, 31)
    return deflate.compress(raw) + deflate.flush()


class MemberStream:
    """The bytes of one gzip member after another, inflated a chunk at a time."""

    def __init__(self, raw: BinaryIO):
        self.raw, self.inflate, self.pending, self.out = raw, zlib.decompressobj(31), b"", b""
        self.offset = self.taken = 0

    def more(self) -> bool:
        """Inflate one more chunk into out; False at the end of the member."""
        while not self.inflate.eof:
            if not self.pending:
                self.pending = self.raw.read(CHUNK)
                if not self.pending:
                    raise ValueError("archive ends inside a record")
            before = len(self.pending)
            got = self.inflate.decompress(self.pending, CHUNK)
            self.pending = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            self.taken += before - len(self.pending)
            if got:
                self.out += got
                return True
        return False

    def line(self) -> bytes:
        at = 0
        while (end := self.out.find(b"\r\n", at)) < 0:
            at = max(0, len(self.out) - 1)
            if not self.more():
                raise ValueError("record without an end of line")
        text, self.out = self.out[:end], self.out[end + 2 :]
        return text

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.out and not self.more():
                raise ValueError("record shorter than its Content-Length")
            part, self.out = self.out[:n], self.out[n:]
            n -= len(part)
            yield part

    def next_member(self) -> bool:
        """Go on to the next member; False at the end of the archive."""
        if self.out or self.more():
            raise ValueError("bytes after the end of a record")
        self.pending = self.pending or self.raw.read(CHUNK)
        self.inflate, self.offset = zlib.decompressobj(31), self.taken
        return bool(self.pending)


def read_records(raw: BinaryIO, payloads: bool = False) -> Iterator[dict]:
    """The records of one archive in order, each verified; with payloads, their bytes too."""
    stream = MemberStream(raw)
    stream.pending = raw.read(CHUNK)
    going = bool(stream.pending)
    while going:
        if not (version := stream.line()).startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {version[:40]!r}")
        head: dict[str, str] = {}
        while text := stream.line():
            name, _, value = text.decode("utf-8", "surrogatepass").partition(":")
            head[name.lower()] = value.strip()
        block, payload, kept = hashlib.sha256(), hashlib.sha256(), []
        http, in_payload, length = b"", False, 0
        for part in stream.take(int(head["content-length"])):
            block.update(part)
            if not in_payload:
                http += part
                if (end := http.find(b"\r\n\r\n")) < 0:
                    continue
                in_payload, part = True, http[end + 4 :]
            payload.update(part)
            length += len(part)
            if payloads:
                kept.append(part)
        if b"".join(stream.take(4)) != b"\r\n\r\n":
            raise ValueError("record not closed by two line ends")
        if head["warc-block-digest"] != f"sha256:{block.hexdigest()}":
            raise ValueError(f"block digest of {head.get('warc-record-id')} does not match")
        kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha256:")
        if kind == "response" and (digest != payload.hexdigest() or length != int(head["x-payload-length"])):
            raise ValueError(f"payload of {head.get('warc-record-id')} does not match its digest")
        number = lambda k: int(head[k]) if k in head else None
        found = {
            "page_id": number("x-page-id"), "payload_bytes": number("x-payload-length"), "payload_digest": digest, "record_type": kind,
            "refers_to": number("x-refers-to-page-id"), "target_uri": head.get("warc-target-uri"), "record_offset": stream.offset,
        }
        if payloads:
            found["payload"] = b"".join(kept)
        going = stream.next_member()
        yield found


def write_archives(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row to archives under path; the manifest (archive, records, bytes)."""
    small_batches(df.sparkSession)
    body = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), body.alias("body")).withColumn("digest", F.sha2("body", 256))
    sizes = df.select(F.col(id_col).cast("long").alias("page_id"), body.alias("body")).select("page_id", F.sha2("body", 256).alias("digest"), F.length("body").alias("n"))
    repeated = sizes.filter(F.col("n") >= REVISIT_LEAST).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first")
    linked = pages.join(repeated, "digest", "left").select("page_id", "url", "body", "digest", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))

    def write(batches):
        system, root = fs.FileSystem.from_uri(path)
        system.create_dir(root, recursive=True)
        out, name, records, size, done = None, "", 0, 0, []
        for b in batches:
            for page_id, url, raw, digest, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out, records, size = system.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                member = record(page_id, url, raw, digest, refers_to)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{path}/{name}", records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{path}/{name}", records, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done]) for k in range(3)], ["archive", "records", "bytes"])

    return staged(linked.mapInArrow(write, "archive string, records bigint, bytes bigint"), "warc-manifest")


def read_archives(manifest: DataFrame, payloads: bool = False, rows: int = 512) -> DataFrame:
    """The records of the archives that the manifest lists, one archive to a task at a time."""
    names = [c.split()[0] for c in RESULT.split(", ")] + ["payload"] * payloads

    def read(batches):
        schema = pa.schema([(n, pa.binary() if n == "payload" else pa.string() if n in ("payload_digest", "record_type", "target_uri", "archive") else pa.int64()) for n in names])
        for b in batches:
            for archive, records in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                system, where = fs.FileSystem.from_uri(archive)
                seen, held = 0, []
                with system.open_input_stream(where, compression=None) as raw:
                    for r in read_records(raw, payloads):
                        held.append(r | {"archive": archive})
                        seen += 1
                        if len(held) >= rows:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held = []
                if seen != records:
                    raise ValueError(f"{archive} has {seen} records, {records} were written")
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    few = manifest.repartition(max(partitions(manifest.sparkSession), 1), "archive")
    return few.mapInArrow(read, RESULT + ", payload binary" * payloads)


def round_trip(df: DataFrame, **columns) -> DataFrame:
    """Write df's pages to archives in the shared folder and read them back."""
    return read_archives(write_archives(df, new_path(df.sparkSession, "warc"), **columns))
