"""Writing pages to compressed WARC archives and reading them back in splits.

Writing: of records with equal payloads the one with the largest key is a response, the others are revisits that refer
to it. Every record is a gzip member of its own. A task writes its file under a name of its own and renames it when it
is complete, so a task that runs again replaces its file.

Reading: each task takes a byte range, scans it for the gzip magic, and accepts a candidate only if it decodes to a
WARC header and a complete record with the right checksum and length. It owns the records that begin in its range,
also where they end behind it, so ranges of any size give every record once. (A payload that itself holds a whole
WARC member, in a block that deflate stored without compression, could be taken for a record by a range that begins
inside it; text payloads cannot hold the magic.)
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costweave.session import cut_lineage, scratch_path

MAGIC = b"\x1f\x8b\x08"
URN = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "page_id long, record_type string, refers_to long, url string, payload_bytes long, payload_digest string, payload binary"


def _header(fields: list[tuple[str, str | None]]) -> bytes:
    lines = [f"{k}: {v}".replace("\r", "%0D").replace("\n", "%0A") for k, v in fields if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode()


def record(key: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, date: str) -> bytes:
    """One gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    named = lambda k: f"<{URN}{'' if k is None else k}>"
    head = _header([
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", named(key)), ("WARC-Date", date),
        ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}"),
        ("WARC-Profile", PROFILE if refers_to is not None else None),
        ("WARC-Refers-To", named(refers_to) if refers_to is not None else None),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", body: str = "html",
                   least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", file_bytes: int = 1 << 30) -> DataFrame:
    """Write a record per row below ``folder``, which all executors share; returns the table of (path, bytes).

    A null body is an empty payload, a null url is left out. Payloads shorter than ``least_bytes`` are all responses.
    Rows that share the largest key of equal payloads are all responses; a null key is the smallest, and where all keys
    are null all are responses. Equal payloads are those of equal SHA-1, length and 64-bit hash. No row, no file.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(body), F.lit("")).alias("body"))
    rows = rows.withColumn("sha1", F.sha1(F.col("body").cast("binary"))).withColumn("same", F.xxhash64(F.octet_length("body"), "body"))
    several = rows.where(F.octet_length("body") >= least_bytes).groupBy("sha1", "same").agg(
        F.count(F.lit(1)).alias("n"), F.max("key").alias("first")).where("n > 1 AND first IS NOT NULL").drop("n")
    # One payload may be a third of all rows; adaptive execution splits such a partition of this join.
    told = rows.join(several, ["sha1", "same"], "left").select(
        "key", "url", "body", "sha1", F.when(~F.col("first").eqNullSafe(F.col("key")), F.col("first")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        part, n, out, size, at = TaskContext.get().partitionId(), 0, None, 0, ""

        def closed() -> pa.RecordBatch:
            out.close()
            path = f"part-{part:06d}-{n:04d}.warc.gz"
            store.move(at, f"{root}/{path}")
            return pa.RecordBatch.from_pydict({"path": pa.array([path]), "bytes": pa.array([size], pa.int64())})

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("key", "url", "body", "sha1", "refers_to")), strict=True):
                k, u, b, s, r = (v.as_py() for v in row)
                if out is None:
                    store.create_dir(root, recursive=True)
                    at = f"{root}/.{uuid.uuid4().hex}"
                    out, size = store.open_output_stream(at, compression=None), 0
                size += out.write(data := record(k, u, b.encode(), s, r, date)) or len(data)
                if size >= file_bytes:
                    yield closed()
                    out, n = None, n + 1
        if out is not None:
            yield closed()

    return cut_lineage(told.mapInArrow(write, "path string, bytes long"))


class Bytes:
    """A file from ``start`` on, read as far as it is asked for."""

    def __init__(self, file, size: int, start: int, end: int, step: int = 1 << 20):
        self.file, self.size, self.start, self.step = file, size, start, step
        self.data = bytearray(file.read_at(min(end + 64, size) - start, start))

    def more(self) -> bool:
        at = self.start + len(self.data)
        self.data += self.file.read_at(min(self.step, self.size - at), at) if at < self.size else b""
        return self.start + len(self.data) > at


def member(source: Bytes, at: int, chunk: int = 16_384) -> tuple[dict[str, str], bytes, int] | None:
    """Fields, block and end of the record whose member begins at ``at`` of the source's data, None if none does."""
    unpack, out, fed = zlib.decompressobj(31), bytearray(), at
    checked = False
    try:
        while not unpack.eof:
            if fed >= len(source.data) and not source.more():
                return None
            part = bytes(source.data[fed:fed + chunk])
            fed += len(part)
            out += unpack.decompress(part)
            if not checked and len(out) >= 7:
                if not out.startswith(b"WARC/1."):
                    return None
                checked = True
    except zlib.error:
        return None
    cut = out.find(b"\r\n\r\n")
    if not checked or cut < 0:
        return None
    fields = {}
    for line in out[:cut].decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    length = fields.get("content-length", "")
    if not length.isdigit() or len(out) != cut + 4 + int(length) + 4 or "warc-type" not in fields:
        return None
    return fields, bytes(out[cut + 4:cut + 4 + int(length)]), fed - len(unpack.unused_data)


def records(file, size: int, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of the records that begin in [start, end)."""
    source, at = Bytes(file, size, start, end), 0
    while start + at < end and (at := source.data.find(MAGIC, at, end - start + len(MAGIC) - 1)) >= 0:
        found = member(source, at)
        if found is None:
            at += 1
        else:
            yield found[:2]
            at = found[2]


def _number(urn: str | None) -> int | None:
    digits = (urn or "").strip("<>").removeprefix(URN)
    return int(digits) if digits else None


def _row(fields: dict[str, str], block: bytes, keep: bool) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, told = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "revisit":
        lengths = [v for k, _, v in (line.partition(":") for line in http.decode("utf-8", "replace").split("\r\n")) if k.lower() == "content-length"]
        return _number(fields.get("warc-record-id")), kind, _number(fields.get("warc-refers-to")), fields.get("warc-target-uri"), int(lengths[0]), told, None
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if told and told != digest:
        raise ValueError(f"the payload of {fields.get('warc-record-id')} does not match its digest")
    return _number(fields.get("warc-record-id")), kind, None, fields.get("warc-target-uri"), len(payload), digest, payload if keep else None


def read_archives(files: DataFrame, folder: str, split_bytes: int = 8 << 20, payload: bool = True) -> DataFrame:
    """A row per record of the archives ``files`` (path, bytes) below ``folder``; revisits have no payload of their own.

    No file gives no row; ``payload`` False leaves the payloads out after they were checked against their digests.
    """
    splits = files.select("path", "bytes", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(split_bytes))).alias("start"))
    n = files.agg(F.coalesce(F.sum(F.ceil(F.col("bytes") / split_bytes)), F.lit(1))).first()[0]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        names = [c.split()[0] for c in RECORDS.split(", ")]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for path, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "start")), strict=True):
                rows, held = [], 0
                with store.open_input_file(f"{root}/{path}") as file:
                    for fields, block in records(file, size, start, min(size, start + split_bytes)):
                        rows.append(_row(fields, block, payload))
                        held += len(block) if payload else 64
                        if held > 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return splits.repartition(int(n)).mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """The records of the archives that the pages were written to, without payloads."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, key, url, body), folder, payload=False)
