"""WARC archives written from and read into Spark tables, payloads in bounded chunks.

Write: every task of a DataFrame of pages writes one gzip-per-record archive into the shared
folder. Records with equal payloads of at least 100 bytes keep the payload once (`response`, the
least page id) and refer to it otherwise (`revisit`).
Read: a task streams an archive member by member and yields a chunked record table, rows of
(record id, chunk number, at most chunk_bytes of payload, running SHA-256), so no task ever holds
a whole payload.

Reading takes foreign archives too: a record of any type, with or without an HTTP block, a digest or a length of its own,
gives chunk rows; what it doesn't declare is null.

Edge cases: a null html is an empty payload; of rows that repeat a page id with one payload a single one is the
response, the one of the least url, the others revisit it; a null page id is written as such, comes last and is
referred to only if all copies have none (refers_to is then null); an empty table writes no archive and reads back empty;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom.llm.workspace import Workspace

CHUNK_BYTES = 1 << 20
MIN_SHARED_BYTES = 100
CRLF = b"\r\n"
RECORD_PREFIX = "urn:x-page:"

MANIFEST = T.StructType([T.StructField("path", T.StringType()), T.StructField("records", T.LongType()), T.StructField("bytes", T.LongType())])
CHUNKS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("chunk_no", T.LongType()),
        T.StructField("chunk", T.BinaryType()),
        T.StructField("running_digest", T.StringType()),
        T.StructField("running_bytes", T.LongType()),
        T.StructField("declared_digest", T.StringType()),
        T.StructField("declared_bytes", T.LongType()),
        T.StructField("is_last", T.BooleanType()),
    ]
)


def plan_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_digest, payload_bytes, record_type, refers_to) for every row of pages.

    Ids and digests are shuffled twice, payloads of MIN_SHARED_BYTES once, shorter ones stay where they are. Equal rows of the
    first id of a payload are counted before the shuffle, so however often one repeats, no task meets them all.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(payload, "UTF-8").alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    every = ["page_id", "url", "payload", "payload_digest", "payload_bytes", "record_type", "refers_to"]
    none = F.lit(None).cast("long")
    short = rows.where(F.col("payload_bytes") < MIN_SHARED_BYTES).withColumns({"record_type": F.lit("response"), "refers_to": none})
    long = rows.where(F.col("payload_bytes") >= MIN_SHARED_BYTES)
    # nulls last, in ids and urls
    place = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", F.col("url").isNull().alias("no_url"), "url")
    copies = long.groupBy("payload_digest", "page_id", "url").agg(F.count("*").alias("n"))
    first = copies.groupBy("payload_digest").agg(F.min(place).alias("first"), F.min_by("n", place).alias("times"), F.sum("n").alias("copies")).where("copies > 1")
    joined = long.join(first.select("payload_digest", "first", "times"), "payload_digest", "left")
    of_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    revisit = F.col("first").isNotNull() & ~of_first
    repeated = F.coalesce(of_first & (F.col("times") > 1), F.lit(False))
    once = joined.where(~repeated).withColumns({"record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col("first.page_id"))})
    again = joined.where(repeated).groupBy("page_id", "url", "payload_digest", "payload_bytes").agg(F.first("payload").alias("whole"), F.count("*").alias("n"))
    again = again.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    # a revisit has no payload to carry
    again = again.withColumns({"payload": F.when(F.col("k") == 1, F.col("whole")), "record_type": F.when(F.col("k") == 1, "response").otherwise("revisit"), "refers_to": F.when(F.col("k") > 1, F.col("page_id"))})
    return short.select(*every).unionByName(once.select(*every)).unionByName(again.select(*every))


def _member(page: dict, level: int) -> Iterator[bytes]:
    """One gzip member: WARC header, HTTP header and, for a response, the payload in chunks."""
    revisit = page["record_type"] == "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % page["payload_bytes"]
    payload = memoryview(b"" if revisit else page["payload"])
    uri = (page["url"] or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {page['record_type']}",
        f"WARC-Record-ID: <{RECORD_PREFIX}{'' if page['page_id'] is None else page['page_id']}>",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{page['payload_digest']}",
        "Content-Type: application/http;msgtype=response",
    ]
    if revisit and page["refers_to"] is None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    elif revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{RECORD_PREFIX}{page['refers_to']}>"]
    head.append(f"Content-Length: {len(http) + len(payload)}")
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    yield packer.compress("\r\n".join(head).encode() + CRLF + CRLF + http)
    for at in range(0, len(payload), CHUNK_BYTES):
        yield packer.compress(payload[at : at + CHUNK_BYTES])
    yield packer.compress(CRLF + CRLF) + packer.flush()


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    """The folder's store for Arrow, which knows s3 by its plain name. Stores that only Hadoop reaches can't hold archives."""
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def write_archives(planned: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """Write planned records below folder, an archive for each task; returns the manifest (path, records, bytes).

    A retried task writes a file of another name; only files in the manifest count.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        store, root = _place(folder)
        path, out, records, size = f"{root}/{uuid.uuid4().hex}.warc.gz", None, 0, 0
        for batch in batches:
            columns = {k: batch.column(k) for k in batch.schema.names}
            for i in range(batch.num_rows):
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(path, compression=None)
                for part in _member({k: v[i].as_py() for k, v in columns.items()}, level):
                    size += len(part)
                    out.write(part)
                records += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "records": records, "bytes": size}], schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return planned.mapInArrow(write, MANIFEST)


class _Stream:
    """Bytes of the gzip members of a file, decompressed a bounded piece at a time."""

    def __init__(self, source, piece: int):
        self.source, self.piece, self.zip, self.raw, self.out = source, piece, zlib.decompressobj(31), b"", bytearray()

    def fill(self) -> bool:
        while True:
            if self.zip.eof:
                self.raw = self.zip.unused_data or self.raw
                self.zip = zlib.decompressobj(31)
            if not self.raw:
                self.raw = self.source.read(self.piece)
                if not self.raw:
                    return False
            got = self.zip.decompress(self.raw, self.piece)
            self.raw = self.zip.unconsumed_tail if not self.zip.eof else b""
            if got:
                self.out += got
                return True

    def line(self) -> bytes | None:
        while (at := self.out.find(CRLF)) < 0:
            if not self.fill():
                return None
        got = bytes(self.out[:at])
        del self.out[: at + 2]
        return got

    def take(self, most: int) -> bytes:
        if not self.out and not self.fill():
            raise EOFError("archive ends within a record")
        got = bytes(self.out[:most])
        del self.out[:most]
        return got

    def header(self) -> tuple[dict[str, str], int] | None:
        """Fields of a header block up to its empty line and the block's length; blank lines before it are skipped."""
        fields, size = {}, 0
        while (line := self.line()) is not None:
            size += len(line) + 2
            if line:
                name, _, value = line.decode("utf-8", "replace").partition(":")
                fields[name.strip().lower()] = value.strip()
            elif fields:
                return fields, size
        return None


def read_chunks(manifest: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES, with_payload: bool = True) -> DataFrame:
    """The chunked record table of the archives in manifest. Every record has one chunk at least, the last one marked is_last.

    with_payload=False leaves the bytes out of the rows (digests and sizes stay).
    """
    names = [f.name for f in CHUNKS]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("chunk_no", pa.int64()), ("chunk", pa.binary()), ("running_digest", pa.string()), ("running_bytes", pa.int64()), ("declared_digest", pa.string()), ("declared_bytes", pa.int64()), ("is_last", pa.bool_())])
        store = _place(folder)[0]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as source:
                    stream = _Stream(source, min(chunk_bytes, 1 << 18))
                    while (got := stream.header()) is not None:
                        for row in _record(stream, got[0], chunk_bytes):
                            held += len(row[5])
                            if not with_payload:
                                row[5] = None
                            rows.append(row)
                            if held >= 4 * chunk_bytes or len(rows) >= 4096:
                                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], names)
                                rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], names)

    return manifest.select("path").mapInArrow(read, CHUNKS)


def _record(stream: _Stream, head: dict[str, str], chunk_bytes: int) -> Iterator[list]:
    """Chunk rows of one record, its WARC header being read."""
    bare = lambda x: x.strip("<>") if x else None
    whole = int(head.get("content-length", 0))
    # a block of another kind is payload from its first byte
    has_http = whole > 0 and head.get("content-type", "").lower().startswith("application/http")
    http, used = (stream.header() or ({}, 0)) if has_http else ({}, 0)
    left, digest, number, so_far = max(0, whole - used), hashlib.sha256(), 0, 0
    fixed = [bare(head.get("warc-record-id")), head.get("warc-type"), head.get("warc-target-uri"), bare(head.get("warc-refers-to"))]
    kind, _, value = head.get("warc-payload-digest", "").partition(":")
    length = http.get("content-length", "")
    declared = [value if kind.lower() == "sha256" else None, int(length) if length.isdigit() else None]
    while True:
        parts, size = [], 0
        while left and size < chunk_bytes:
            part = stream.take(min(left, chunk_bytes - size))
            parts.append(part)
            digest.update(part)
            size += len(part)
            left -= len(part)
        so_far += size
        yield [*fixed, number, b"".join(parts), digest.hexdigest(), so_far, *declared, left == 0]
        number += 1
        if not left:
            return


def round_trip(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Archives of pages written and read back: page_id, payload_bytes, payload_digest, record_type, refers_to, chunks, verified.

    A response's digest and size are those of the bytes read; a revisit carries the ones its
    headers declare. verified: read and declared digest agree (null for a revisit, which has no payload).
    """
    with Workspace(pages.sparkSession, "warc") as ws:
        folder = ws.folder("archives")
        manifest = ws.table(write_archives(plan_records(pages), folder), "manifest")
        files = manifest.repartition(F.col("path"))
        last = read_chunks(files, folder, chunk_bytes, with_payload=False).where("is_last")
        page = lambda c: F.expr(f"try_cast(nullif(substring({c}, {len(RECORD_PREFIX) + 1}), '') as bigint)")
        response = F.col("record_type") == "response"
        return ws.keep(
            last.select(
                page("record_id").alias("page_id"),
                F.when(response, F.col("running_bytes")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
                F.when(response, F.col("running_digest")).otherwise(F.col("declared_digest")).alias("payload_digest"),
                "record_type",
                page("refers_to").alias("refers_to"),
                (F.col("chunk_no") + 1).alias("chunks"),
                F.when(response, F.col("running_digest") == F.col("declared_digest")).alias("verified"),
            )
        )
