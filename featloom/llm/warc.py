"""WARC archives: a deterministic sharded writer and a streaming reader.

Writing. Records are put in order of (page id, payload digest); every
``shard_records`` of that order are a shard. Where shards begin is read off the
exact order of the keys, never off a sample, so the same pages always give the
same files. Pages go to ranges of whole shards, ``MOST_RANGES`` at most, of which the
driver holds the first keys; where the shards of a range begin comes to its task as
rows sorted before the pages. A task writes a shard's records one by one, each a gzip member of its
own, and rolls to the next file when ``file_bytes`` compressed bytes are reached.
A file is written under a temporary name and renamed when whole; the manifest, a
table of the files with their sizes, counts and digests, is the commit: what it
does not list does not exist. A task that runs again writes the same bytes.

Payloads of at least ``revisit_bytes`` that occur more than once are stored with
the smallest page id; the others become ``revisit`` records, with headers only.
Which those are is found from digests (SHA-256), not from payloads, and reaches
the writers as rows sorted before the pages they concern, in the same shuffle.

Reading streams each file record by record, checks block and payload digests, and
raises on a file that is not what the manifest says.

Files go through Arrow's file systems, so the root may be in any store Arrow knows.

Defined results: a null html is an empty payload; a null url becomes ``urn:none``;
null page ids come first and are read back as null; of rows with equal page id and
payload the first is the response; an empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from featloom.llm.common import stored
from featloom.operators.ids import dense_ids
from featloom.sources.scratch import scratch_path

# Ranges of shards that pages are dealt to, and tasks that read: 90 bytes each at the
# driver and in the tasks.
MOST_RANGES = 100_000

MANIFEST = "shard long, part int, file string, records long, bytes long, sha256 string"
RECORDS = (
    "page_id long, url string, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, payload binary"
)
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class WarcSpec:
    shard_records: int = 4096
    file_bytes: int = 64 << 20
    revisit_bytes: int = 0
    date: str = "2024-01-01T00:00:00Z"
    level: int = 6


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None, digest: str, kind: str = "response", before: int = 0) -> str:
    """Of the record that ``before`` records of equal page id and payload precede."""
    name = f"{page_id}/{digest}" + (f"/{kind}/{before}" if before or kind != "response" else "")
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def record(
    page_id: int | None, url: str | None, payload: bytes, revisits: tuple | None, spec: WarcSpec, before: int = 0
) -> bytes:
    """One record, uncompressed. ``revisits`` is a tuple of the page id revisited;
    ``before`` counts the records of the same page id and payload in front of it."""
    kind = "response" if revisits is None else "revisit"
    digest = sha1_base32(payload)
    block = HTTP.format(len(payload)).encode()
    if revisits is None:
        block += payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_record_id(page_id, digest, kind, before)}",
        f"WARC-Date: {spec.date}",
        f"WARC-Target-URI: {'urn:none' if url is None else quote(url, safe=_URL_SAFE)}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisits is not None:
        head.append(f"WARC-Profile: {PROFILE}")
        head.append(f"WARC-Refers-To: {_record_id(revisits[0], digest)}")
        if revisits[0] is not None:
            head.append(f"X-Refers-To-Page-Id: {revisits[0]}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL_SAFE = "".join(map(chr, range(33, 127)))


class _Shard:
    """The files of one shard, written one after the other."""

    def __init__(self, root: str, shard: int, spec: WarcSpec):
        self.store, self.base = fs.FileSystem.from_uri(root)
        self.shard, self.spec, self.part, self.out = shard, spec, 0, None

    def _open(self) -> None:
        self.name = f"shard-{self.shard:08d}-{self.part:05d}.warc.gz"
        self.temporary = f"{self.base}/_temporary/{self.name}.{uuid.uuid4().hex}"
        self.store.create_dir(f"{self.base}/_temporary", recursive=True)
        self.out = self.store.open_output_stream(self.temporary, compression=None)
        self.sha, self.bytes, self.records = hashlib.sha256(), 0, 0

    def add(self, data: bytes) -> dict | None:
        """Adds a record; returns the manifest row of a file that is full."""
        if self.out is None:
            self._open()
        packer = zlib.compressobj(self.spec.level, zlib.DEFLATED, 31)
        member = packer.compress(data) + packer.flush()
        self.out.write(member)
        self.sha.update(member)
        self.bytes += len(member)
        self.records += 1
        return self.close() if self.bytes >= self.spec.file_bytes else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.out, final = None, f"{self.base}/{self.name}"
        try:
            self.store.move(self.temporary, final)
        except OSError:
            # An earlier run of this task got here; its file has the same bytes.
            if self.store.get_file_info(final).size != self.bytes:
                raise
            self.store.delete_file(self.temporary)
        row = {
            "shard": self.shard, "part": self.part, "file": self.name,
            "records": self.records, "bytes": self.bytes, "sha256": self.sha.hexdigest(),
        }
        self.part += 1
        return row


def _writer(root: str, spec: WarcSpec):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, files, first, number, key, before = None, [], None, None, None, 0
        for batch in batches:
            columns = [batch.column(c) for c in ("shard", "id", "digest", "first_id", "is_page", "url", "html")]
            for i in range(batch.num_rows):
                begins, page, digest, first_id, is_page, url, html = (c[i].as_py() for c in columns)
                if not is_page:
                    if begins is None:
                        first = (page, digest, first_id)
                    else:
                        number = begins
                    continue
                if shard is None or number != shard.shard:
                    if shard is not None:
                        files.append(shard.close())
                    shard = _Shard(root, number, spec)
                before = before + 1 if key == (page, digest) else 0
                key, revisits = (page, digest), None
                if first is not None and first[:2] == key and (before or first[2] != page):
                    revisits = (first[2],)
                files.append(shard.add(record(page, url, html or b"", revisits, spec, before)))
        if shard is not None:
            files.append(shard.close())
        rows = [f for f in files if f]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_MANIFEST_ARROW)

    return write


_MANIFEST_ARROW = pa.schema(
    [("shard", pa.int64()), ("part", pa.int32()), ("file", pa.string()),
     ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]
)


def write_archives(pages: DataFrame, root: str, spec: WarcSpec = WarcSpec()) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html) below ``root``;
    returns the manifest, stored."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    body = pages.select(
        F.col("page_id").cast("long").alias("id"), F.sha2(payload, 256).alias("digest"),
        "url", payload.alias("html"),
    )
    keys = stored(body.select("id", "digest", F.length("html").alias("bytes")), "warc-keys")
    numbered = dense_ids(keys.select("id", "digest"), scratch_path(spark, "warc-order"), ["id", "digest"], id_col="n")
    begins = numbered.where(F.col("n") % spec.shard_records == 0).select(
        "id", "digest", F.expr(f"n div {spec.shard_records}").alias("shard")
    )
    shards = -(-keys.count() // spec.shard_records)
    together = max(1, -(-shards // MOST_RANGES))
    ranges = [
        (r["id"] is not None, r["id"] or 0, r["digest"])
        for r in begins.where(F.col("shard") % together == 0).orderBy("shard").collect()
    ]

    @F.arrow_udf("int")
    def range_of(ids: pa.Array, digests: pa.Array) -> pa.Array:
        places = ((i is not None, i or 0, d) for i, d in zip(ids.to_pylist(), digests.to_pylist()))
        return pa.array([bisect_right(ranges, p) - 1 for p in places], pa.int32())

    groups = (
        keys.where(F.col("bytes") >= spec.revisit_bytes)
        .groupBy("digest")
        .agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
    )
    none = {"first_id": "long", "shard": "long", "url": "string", "html": "binary"}

    def rows_of(df: DataFrame, is_page: bool) -> DataFrame:
        absent = [F.lit(None).cast(kind).alias(c) for c, kind in none.items() if c not in df.columns]
        return df.select("*", *absent, F.lit(is_page).alias("is_page"))

    notes = keys.select("id", "digest").distinct().join(groups.drop("n"), "digest")
    everything = (
        rows_of(notes, False)
        .unionByName(rows_of(begins, False))
        .unionByName(rows_of(body, True))
        .withColumn("range", range_of("id", "digest"))
    )
    manifest = stored(
        everything.repartitionByRange(max(len(ranges), 1), "range")
        .sortWithinPartitions("range", "id", "digest", "is_page", "shard", "url")
        .mapInArrow(_writer(root, spec), MANIFEST),
        "warc-manifest",
    )
    _remove_temporary(root)
    return manifest


def _remove_temporary(root: str) -> None:
    """What tasks that were lost have left."""
    store, base = fs.FileSystem.from_uri(root)
    if store.get_file_info(f"{base}/_temporary").type == fs.FileType.Directory:
        store.delete_dir(f"{base}/_temporary")


def members(stream) -> Iterator[bytes]:
    """The gzip members of a file, unpacked, one at a time."""
    data = b""
    while True:
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            data = data or stream.read(1 << 20)
            if not data:
                if parts:
                    raise ValueError("archive ends within a record")
                return
            parts.append(unpacker.decompress(data))
            data = unpacker.unused_data if unpacker.eof else b""
        yield b"".join(parts)


def parse(data: bytes) -> dict:
    """A record's row; raises if a digest or length does not fit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    if "sha1:" + sha1_base32(block) != fields["WARC-Block-Digest"]:
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError("payload digest differs")
    page, refers = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
    return {
        "page_id": None if page is None else int(page),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": None if refers is None else int(refers),
        "payload": payload if response else None,
    }


_RECORDS_ARROW = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
     ("refers_to", pa.int64()), ("payload", pa.binary())]
)


class _Summed:
    """A stream whose bytes are counted and hashed as they are read."""

    def __init__(self, stream):
        self.stream, self.sha, self.bytes = stream, hashlib.sha256(), 0

    def read(self, size: int) -> bytes:
        data = self.stream.read(size)
        self.sha.update(data)
        self.bytes += len(data)
        return data


def _reader(root: str, batch_bytes: int = 4 << 20):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for want in batch.to_pylist():
                rows, size, count = [], 0, 0
                with store.open_input_stream(f"{base}/{want['file']}", compression=None) as stream:
                    source = _Summed(stream)
                    for data in members(source):
                        rows.append(parse(data))
                        size, count = size + len(data), count + 1
                        if size >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS_ARROW)
                            rows, size = [], 0
                if count != want["records"]:
                    raise ValueError(f"{want['file']} has {count} records, not {want['records']}")
                if (source.bytes, source.sha.hexdigest()) != (want["bytes"], want["sha256"]):
                    raise ValueError(f"{want['file']} differs from the manifest in its bytes")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS_ARROW)

    return read


def read_archives(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """A row per record of the files that ``manifest`` lists: a task per file, or per
    few of them from ``MOST_RANGES`` files on. The number is fixed, as the manifest is
    so small that adaptive execution would make it one task."""
    tasks = min(max(manifest.count(), 1), MOST_RANGES)
    return manifest.repartitionByRange(tasks, "file").mapInArrow(_reader(root), RECORDS)
