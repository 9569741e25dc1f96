"""WARC archives: records as single gzip members, read back in sequence.

Every task writes the records of its rows to one archive after another in the shared folder, each archive closed at a size limit. The
reader gets one archive per row, inflates it piece by piece, and cuts each record by its content length and hashes its payload as the pieces come, so neither side
holds more than one record, nor more of a damaged one than it declares.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from spindrift.llm.rows import name, slices, written
from spindrift.session import new_dir, qualified

MIN_SHARED_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
READ_BYTES = 1 << 18
#: What one step of inflating gives at most, so that a small file cannot unfold at once.
INFLATED_BYTES = 1 << 22
VERSION = "WARC/1.1"
#: All records bear one date, so that a repeated task writes the same bytes.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVES = "archive string, n_records long, n_bytes long"
RECORDS = (
    "archive string, offset long, record_id string, refers_to_id string, url string, record_type string, payload_bytes long, "
    "payload_digest string, digest_ok boolean, payload binary"
)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path or URI, by Arrow's file systems (local, S3, GCS, HDFS)."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pafs.LocalFileSystem(), path


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def urn(key: str | None) -> str:
    """A record id that any id survives: escaped, and told apart from none."""
    return "<urn:none>" if key is None else f"<urn:page:{quote(key, safe='')}>"


def key_of(named: str | None) -> str | None:
    return unquote(named.removeprefix("<urn:page:").removesuffix(">")) if named and named != "<urn:none>" else None


def record(kind: str, record_id: str | None, url: str | None, payload: bytes, refers_to: str | None, digest: str) -> bytes:
    """Bytes of one record. A revisit holds the HTTP head only; its payload's digest and size stand in the header."""
    code = base64.b32encode(bytes.fromhex(digest)).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if kind == "revisit" else head + payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", urn(record_id)), ("WARC-Date", DATE),
        *([("WARC-Target-URI", target)] if target else []),
        ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{code}"),
        *([("WARC-Profile", PROFILE), ("WARC-Refers-To", urn(refers_to))] if kind == "revisit" else []),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


class Archives:
    """Writes one task's records; an archive appears under its name only once it is whole."""

    def __init__(self, folder: str, limit: int):
        self.store, self.inner = file_system(folder)
        self.folder = folder
        self.store.create_dir(self.inner, recursive=True)
        # Each attempt has names of its own: the archives that count are those its task returned.
        self.label = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        self.limit, self.number, self.stream = limit, 0, None

    def add(self, data: bytes) -> Iterator[tuple[str, int, int]]:
        if self.stream is None:
            self.file = f"{self.label}-{self.number:05d}.warc.gz"
            self.stream, self.records, self.size = self.store.open_output_stream(f"{self.inner}/{self.file}.part", compression=None), 0, 0
        member = gzip_member(data)
        self.stream.write(member)
        self.records, self.size = self.records + 1, self.size + len(member)
        if self.size >= self.limit:
            yield from self.close()

    def close(self) -> Iterator[tuple[str, int, int]]:
        if self.stream is not None:
            self.stream.close()
            self.store.move(f"{self.inner}/{self.file}.part", f"{self.inner}/{self.file}")
            self.stream, self.number = None, self.number + 1
            yield f"{self.folder}/{self.file}", self.records, self.size


def _write(folder: str, limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Archives(folder, limit)

    def rows(made: list[tuple[str, int, int]]) -> pa.RecordBatch:
        columns = [pa.array([m[0] for m in made], pa.string()), *[pa.array([m[i] for m in made], pa.int64()) for i in (1, 2)]]
        return pa.RecordBatch.from_arrays(columns, names=["archive", "n_records", "n_bytes"])

    for batch in batches:
        for part in slices(batch):
            for row in part.to_pylist():
                payload = (row["payload"] or "").encode()
                made = list(out.add(record(row["kind"], row["key"], row["url"], payload, row["refers_to"], row["digest"])))
                if made:
                    yield rows(made)
    if made := list(out.close()):
        yield rows(made)


@dataclass
class Record:
    offset: int
    fields: dict[str, str]
    head: bytes
    payload: bytes
    sha1: str


class Frame:
    """One record, cut out of its inflated pieces as they come: header, HTTP head, then as much payload as the content length leaves."""

    def __init__(self, start: int):
        self.start, self.data, self.fields, self.body, self.end, self.hashed, self.sha1 = start, bytearray(), None, None, None, 0, hashlib.sha1()

    def feed(self, piece: bytes) -> None:
        self.data += piece
        if self.fields is None:
            at = self.data.find(b"\r\n\r\n")
            if at < 0:
                return
            first, *lines = bytes(self.data[:at]).decode("utf-8").split("\r\n")
            if not first.startswith("WARC/"):
                raise ValueError(f"no record header at byte {self.start}")
            self.fields = {k.lower(): v.strip(" ") for k, _, v in (line.partition(":") for line in lines)}
            self.block, self.end = at + 4, at + 4 + int(self.fields["content-length"])
        if len(self.data) > self.end + 4:
            raise ValueError(f"the record at byte {self.start} does not end after {self.end - self.block} bytes")
        if self.body is None:
            at = self.data.find(b"\r\n\r\n", self.block, self.end)
            if at < 0:
                return
            self.body = self.hashed = at + 4
        upto = min(len(self.data), self.end)
        with memoryview(self.data) as view:
            self.sha1.update(view[self.hashed:upto])
        self.hashed = upto

    def record(self) -> Record:
        if self.fields is None:
            raise ValueError(f"no record header at byte {self.start}")
        if len(self.data) != self.end + 4 or self.data[self.end:] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {self.start} does not end after {self.end - self.block} bytes")
        if self.body is None:
            raise ValueError(f"no HTTP head in the record at byte {self.start}")
        with memoryview(self.data) as view:
            return Record(self.start, self.fields, bytes(view[self.block:self.body]), bytes(view[self.body:self.end]), self.sha1.hexdigest())


class Members:
    """Reads an archive as records: a member at a time, a piece of the file at a time."""

    def __init__(self, stream, piece: int = READ_BYTES):
        self.stream, self.piece = stream, piece

    def __iter__(self) -> Iterator[Record]:
        waiting, position = b"", 0
        while True:
            if not waiting and not (waiting := self.stream.read(self.piece)):
                return
            frame, unpack = Frame(position), zlib.decompressobj(31)
            while not unpack.eof:
                if not waiting and not (waiting := self.stream.read(self.piece)):
                    raise ValueError(f"archive ends within the record at byte {frame.start}")
                frame.feed(unpack.decompress(waiting, INFLATED_BYTES))
                while unpack.unconsumed_tail:
                    frame.feed(unpack.decompress(unpack.unconsumed_tail, INFLATED_BYTES))
                position += len(waiting) - len(unpack.unused_data)
                waiting = unpack.unused_data
            yield frame.record()


def parsed(item: Record) -> dict:
    """Type, ids, payload and whether the payload agrees with the digest (null for a revisit, which holds none)."""
    fields = item.fields
    declared = fields["warc-payload-digest"].partition(":")[2]
    digest = base64.b32decode(declared).hex()
    whole = fields["warc-type"] == "response"
    size = next(int(x.partition(b":")[2]) for x in item.head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    if whole and size != len(item.payload):
        raise ValueError(f"the payload at byte {item.offset} has {len(item.payload)} bytes, not {size}")
    return {
        "offset": item.offset, "record_id": key_of(fields.get("warc-record-id")), "refers_to_id": key_of(fields.get("warc-refers-to")), "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"], "payload_bytes": size, "payload_digest": digest,
        "digest_ok": item.sha1 == digest if whole else None, "payload": item.payload if whole else None,
    }


def _read(with_payload: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {
        "archive": pa.string(), "offset": pa.int64(), "record_id": pa.string(), "refers_to_id": pa.string(), "url": pa.string(),
        "record_type": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "digest_ok": pa.bool_(), "payload": pa.binary(),
    }

    def rows(found: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in kinds.items()], names=list(kinds))

    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, inner = file_system(path)
            found, held = [], 0
            with store.open_input_stream(inner, compression=None) as stream:
                for item in Members(stream):
                    row = parsed(item) | {"archive": path}
                    if not with_payload:
                        row["payload"] = None
                    found.append(row)
                    held += len(row["payload"] or b"") + 300
                    if held > 4 << 20:
                        yield rows(found)
                        found, held = [], 0
            if found:
                yield rows(found)


def write_archives(
    df: DataFrame, folder: str, id_column: str = "page_id", url: str = "url", html: str = "html",
    min_shared: int = MIN_SHARED_BYTES, limit: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes a record per row below ``folder`` and returns (archive, n_records, n_bytes), one row per archive.

    The payload is the html in UTF-8, a null one is empty. Of records with equal payloads of at least ``min_shared`` bytes those with the
    largest id are responses and the others revisits that refer to it; rows that repeat that id are all responses, and where all
    ids are null all are. Equal payloads are found by SHA-256 and size with a partial aggregate (records bear SHA-1, which crafted pages may share); only
    digests with several rows come back, by a shuffle join whose hot digests Spark splits. ``folder`` without a scheme lies in the cluster's default store.
    """
    folder = qualified(df.sparkSession, folder)
    pages = df.select(
        name(id_column).alias("id"), name(url).cast("string").alias("url"), F.coalesce(name(html), F.lit("")).alias("payload")
    ).withColumn("n", F.octet_length("payload")).withColumn("same", F.when(F.col("n") >= min_shared, F.sha2(F.col("payload").cast("binary"), 256)))
    shared = pages.filter("same IS NOT NULL").groupBy("same", "n").agg(F.max("id").alias("head"), F.count("*").alias("rows"))
    # Written first: Spark splits a hot key of a join only where both sides come straight from a shuffle.
    heads, _ = written(shared.filter("rows > 1").select(F.col("same").alias("d"), F.col("n").alias("m"), "head"), "heads")
    joined = pages.join(heads, (F.col("same") == F.col("d")) & (F.col("n") == F.col("m")), "left")
    revisit = F.col("head").isNotNull() & ~F.col("id").eqNullSafe(F.col("head"))
    rows = joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("kind"), F.col("id").cast("string").alias("key"),
        "url", "payload", F.when(revisit, F.col("head").cast("string")).alias("refers_to"), F.sha1(F.col("payload").cast("binary")).alias("digest"),
    )
    return rows.mapInArrow(partial(_write, folder, limit), ARCHIVES)


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the archives named in the first column, each whole and checked against its frame and digest.

    A cut or wrongly framed archive fails the read; a payload that differs from its digest gives digest_ok false.
    """
    return archives.select(archives.columns[0]).mapInArrow(partial(_read, with_payload), RECORDS)


def round_trip(df: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes the rows to archives in the shared scratch folder, and returns page_id, payload_bytes, payload_digest, record_type and
    refers_to as read back from them (see ``write_archives`` for nulls, ties and repeated rows).

    An empty table gives no archive and no rows; other columns of ``df`` are not read.
    """
    spark = df.sparkSession
    listed, _ = written(write_archives(df, new_dir(spark, "warc"), id_column, url, html), "archives")
    kind = df.schema[id_column].dataType
    found = read_archives(listed.repartition(max(1, min(listed.count(), 4096))), with_payload=False)
    key = lambda c: F.col(c).cast(kind)
    checked = F.when(
        F.coalesce(F.col("digest_ok"), F.lit(True)), F.col("payload_digest")
    ).otherwise(F.raise_error(F.concat(F.lit("wrong payload digest in "), "archive")))
    return found.select(
        key("record_id").alias(id_column), "payload_bytes", checked.alias("payload_digest"), "record_type", key("refers_to_id").alias("refers_to")
    )


WARC_SQL = f"""
WITH p AS (
  SELECT page_id, COALESCE(html, '') AS body, strlen(COALESCE(html, '')) AS n FROM pages),
h AS (
  SELECT *, MAX(page_id) OVER (PARTITION BY body) AS head FROM p)
SELECT page_id, n AS payload_bytes, sha1(body) AS payload_digest,
  CASE WHEN n >= {MIN_SHARED_BYTES} AND page_id < head THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {MIN_SHARED_BYTES} AND page_id < head THEN head END AS refers_to
FROM h
"""
