"""WARC archives written from a page table and read back as a chunked record table.

Payloads pass through in chunks on both ways: the writer encodes, digests and compresses one chunk at a
time; the reader inflates a file as a stream and gives rows (record, chunk number, bytes of the chunk,
digest of the payload up to there), so no record is ever held whole.  Each record is a gzip member of
its own.  Files live in the shared folder; a task names its files by its attempt, and only the manifest
rows of the attempt that Spark commits count, so lost executors leave nothing half-written behind.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import new_path, table, written

CHUNK = 1 << 20
#: A file is closed once it holds so many bytes, so that reading splits over tasks.
FILE_BYTES = 64 << 20
#: Smaller payloads are always responses.
LEAST_REVISIT_BYTES = 100
#: Fixed values of the WARC format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST_SCHEMA = "path string, records long, bytes long"
CHUNK_SCHEMA = "page_id long, url string, record_type string, refers_to long, chunk_no int, last boolean, payload_bytes long, payload_digest string, data binary"


def decide(pages: DataFrame, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Add ``digest`` and ``first_id``: of equal payloads of at least ``least`` bytes, the smallest page_id (else null).

    Only digests that occur again are joined, and a hot digest is counted before it is shuffled; the
    join may be split by the engine where one payload fills a partition.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string").alias("url"), html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"))
    firsts = pages.select(F.col("page_id").cast("long").alias("page_id"), html.cast("binary").alias("html")).where(F.octet_length("html") >= least).groupBy(F.sha2("html", 256).alias("digest")).agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return rows.join(firsts, "digest", "left")


def text_chunks(text: str, chars: int = CHUNK) -> Iterator[bytes]:
    for at in range(0, len(text), chars):
        yield text[at : at + chars].encode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


class WarcWriter:
    """One gzip member for each record."""

    def __init__(self, stream, date: str):
        self.stream, self.date, self.bytes, self.records = stream, date, 0, 0

    def add(self, page_id: int | None, url: str | None, html: str, digest: str, refers_to: int | None) -> None:
        n = sum(len(c) for c in text_chunks(html))
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
        revisit = refers_to is not None
        # line ends in a URI would end its header line
        uri = (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
        head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {self.date}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
        if url is None:
            head.append("X-Null-URI: true")
        if revisit:
            head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
        head.append(f"Content-Length: {len(http) + (0 if revisit else n)}")
        gz = zlib.compressobj(1, zlib.DEFLATED, 31)
        self._put(gz.compress(VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + http))
        if not revisit:
            for chunk in text_chunks(html):
                self._put(gz.compress(chunk))
        self._put(gz.compress(b"\r\n\r\n"))
        self._put(gz.flush())
        self.records += 1

    def _put(self, data: bytes) -> None:
        if data:
            self.stream.write(data)
            self.bytes += len(data)


def write_archives(decided: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record for each row of ``decide``; returns the written manifest of the files that count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        context, k, writer, done = TaskContext.get(), 0, None, []
        for batch in batches:
            for at in range(batch.num_rows):
                page_id, url, html, digest, first_id = (c[at].as_py() for c in batch.columns)
                if writer is None:
                    name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{k:04d}-{uuid.uuid4().hex[:8]}.warc.gz"
                    writer, k, path = WarcWriter(fs.open_output_stream(f"{root}/{name}"), date), k + 1, f"{folder}/{name}"
                writer.add(page_id, url, html, digest, None if first_id is None or first_id == page_id else first_id)
                if writer.bytes >= file_bytes:
                    writer.stream.close()
                    done.append((path, writer.records, writer.bytes))
                    writer = None
        if writer is not None:
            writer.stream.close()
            done.append((path, writer.records, writer.bytes))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done) if done else [()] * 3, (pa.string(), pa.int64(), pa.int64()))], ["path", "records", "bytes"])

    return written(decided.select("page_id", "url", "html", "digest", "first_id").mapInArrow(run, MANIFEST_SCHEMA), "warc-manifest")


class Inflated:
    """The bytes of a stream of gzip members, a bounded block at a time."""

    def __init__(self, stream, block: int = CHUNK):
        self.stream, self.block, self.held, self.buffer = stream, block, zlib.decompressobj(31), b""
        self.raw = b""

    def _more(self) -> bool:
        if self.held.eof:
            self.raw, self.held = self.held.unused_data, zlib.decompressobj(31)
        data = self.held.unconsumed_tail or self.raw or self.stream.read(self.block)
        self.raw = b""
        if not data:
            return False
        self.buffer += self.held.decompress(data, self.block)
        return True

    def line(self) -> bytes | None:
        """The next line without its line end; None at the end of the stream."""
        while (at := self.buffer.find(b"\r\n")) < 0:
            if not self._more():
                return None
        out, self.buffer = self.buffer[:at], self.buffer[at + 2 :]
        return out

    def take(self, n: int) -> bytes:
        """At most ``n`` bytes, at least one."""
        while not self.buffer:
            if not self._more():
                raise EOFError("the archive ends within a record")
        out, self.buffer = self.buffer[:n], self.buffer[n:]
        return out


def headers(stream: Inflated) -> dict[str, str]:
    out = {}
    while line := stream.line():
        name, _, value = line.partition(b":")
        out[name.decode().lower()] = value.strip().decode()
    return out


def page_of(record: str | None) -> int | None:
    value = (record or "").strip("<>").rpartition(":")[2]
    return int(value) if value.lstrip("-").isdigit() else None


def read_records(stream: Inflated, keep_data: bool, chunk: int = CHUNK) -> Iterator[tuple]:
    """Chunk rows of every record: the digest and length of each row cover the payload up to its end."""
    while (line := stream.line()) is not None:
        if not line:
            continue
        if line != VERSION:
            raise ValueError(f"no WARC record begins here: {line[:40]!r}")
        head = headers(stream)
        kind = head["warc-type"]
        stream.line()
        http = headers(stream)
        url = None if "x-null-uri" in head else head["warc-target-uri"].replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
        start = (page_of(head["warc-record-id"]), url, kind, page_of(head.get("warc-refers-to")))
        said = head["warc-payload-digest"].partition(":")[2]
        size = int(http["content-length"])
        if kind == "revisit":
            yield *start, 0, True, size, said, None
            continue
        digest, done, k = hashlib.sha256(), 0, 0
        while True:
            part = bytearray()
            while len(part) < min(chunk, size - done):
                part += stream.take(min(chunk, size - done) - len(part))
            digest.update(part)
            done += len(part)
            if done == size and digest.hexdigest() != said:
                raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
            yield *start, k, done == size, done, digest.hexdigest(), bytes(part) if keep_data else None
            k += 1
            if done == size:
                break


def read_archives(manifest: DataFrame, keep_data: bool = True, chunk: int = CHUNK) -> DataFrame:
    """The chunked record table of the archives of a manifest, a task for each few files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in CHUNK_SCHEMA.split(", ")]
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary())
        out = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = pafs.FileSystem.from_uri(path)
                rows, held = [], 0
                with fs.open_input_stream(at) as f:
                    for row in read_records(Inflated(f), keep_data, chunk):
                        rows.append(row)
                        held += len(row[-1] or b"") + 200
                        if held > 4 * chunk:
                            yield out(rows)
                            rows, held = [], 0
                if rows:
                    yield out(rows)

    files = max(1, min(manifest.count(), 10_000))
    return manifest.select("path").repartition(files, F.xxhash64("path")).mapInArrow(run, CHUNK_SCHEMA)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record: what its last chunk carries."""
    return chunks.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` (``page_id``, ``url``, ``html``) and read the archives back; one row per page.

    A null html is an empty payload, a null url stays null, a null page_id is kept.  Of equal payloads the
    smallest page_id is the response (rows that repeat it are responses too); an empty table gives
    no rows; other columns are not read.
    """
    manifest = write_archives(decide(pages), new_path(pages.sparkSession, "warc"))
    return records(read_archives(manifest, keep_data=False)).drop("url")


def op3_warc(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


OP3_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
  CASE WHEN f.first_id IS NULL OR f.first_id = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.first_id IS NULL OR f.first_id = d.page_id THEN NULL ELSE f.first_id END AS refers_to
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest
"""
