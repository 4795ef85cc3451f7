"""WARC archives as chunked record tables.

A payload is a number of rows (record, chunk number, bytes), never one value. The writer appends
chunk after chunk to the record it has open; the reader streams an archive and yields chunk rows
that carry the SHA-1 of all bytes so far, so the last chunk of a record holds its digest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsieve.llm.common import shipped, whole, written
from docsieve.session import scratch_path

CHUNK_BYTES = 1 << 20
_HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_HEAD_END = b"\r\n\r\n"
_RECORD = "urn:page:"
CHUNKS = (
    "record string, url string, type string, refers_to string, declared_digest string, chunk int, "
    "last boolean, n_bytes long, digest string, payload binary"
)


def _uri(path: str) -> str:
    """Spark also writes ``file:/a`` and plain paths; pyarrow opens ``file:///a``."""
    if "://" in path:
        return path
    return "file://" + (path.removeprefix("file:") if path.startswith("file:") else urllib.parse.quote(path))


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record_table(pages: DataFrame, key: str, url: str, payload: str, min_bytes: int = 0, chunk: int = CHUNK_BYTES) -> DataFrame:
    """(record, url, refers_to, n_bytes, sha1, chunk, data): the records to write, in chunks.

    Of payloads that are equal and have at least ``min_bytes`` bytes, the row with the largest key
    keeps its payload; the others refer to it and have one empty chunk. Only payloads that occur
    more than once take part in that join.
    """
    rows = pages.select(
        pages[key].cast("string").alias("record"), pages[key].alias("k"), pages[url].cast("string").alias("url"),
        F.encode(whole(pages[payload]), "UTF-8").alias("data"),
    )
    rows = rows.select("*", F.octet_length("data").cast("long").alias("n_bytes"), F.sha1("data").alias("sha1"))
    repeated = (
        rows.where(F.col("n_bytes") >= min_bytes).groupBy(F.col("sha1").alias("same_sha1"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("keeper")).where("n > 1").drop("n")
    )
    joined = rows.join(repeated, F.col("sha1") == F.col("same_sha1"), "left")
    refers = F.when(~F.col("k").eqNullSafe(F.col("keeper")), F.col("keeper").cast("string"))
    kept = F.when(refers.isNull(), F.col("data")).otherwise(F.lit(b""))
    joined = joined.select("record", "url", refers.alias("refers_to"), "n_bytes", "sha1", kept.alias("data"))
    last = F.greatest(F.ceil(F.octet_length("data") / chunk) - 1, F.lit(0)).cast("int")
    return joined.select(
        "*", F.explode(F.sequence(F.lit(0), last)).alias("chunk")
    ).withColumn("data", F.substring("data", F.col("chunk") * chunk + 1, F.lit(chunk)))


def _target(url: str | None) -> str:
    return urllib.parse.quote(url or "", safe=":/?#[]@!$&'()*+,;=%~")


def _header(row: dict) -> bytes:
    digest = base32(bytes.fromhex(row["sha1"]))
    lines = ["WARC/1.1", f"WARC-Type: {'response' if row['refers_to'] is None else 'revisit'}"]
    lines.append(f"WARC-Record-ID: <{_RECORD}{'' if row['record'] is None else urllib.parse.quote(row['record'], safe='')}>")
    lines.append("WARC-Date: 1970-01-01T00:00:00Z")
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {_target(row['url'])}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if row["refers_to"] is None:
        size = len(_HTTP_HEAD) + row["n_bytes"]
    else:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <{_RECORD}{urllib.parse.quote(row['refers_to'], safe='')}>")
        size = len(_HTTP_HEAD)
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {size}"]
    return "\r\n".join(lines).encode() + _HEAD_END + _HTTP_HEAD


def write(records: DataFrame, folder: str) -> DataFrame:
    """Write one ``.warc.gz`` per task below ``folder``; returns the table of (path, records).

    Chunks of a record must follow each other, as ``record_table`` leaves them. A repeated task
    writes under a new name, and only names in the returned table, which is stored first, count.
    ``folder`` may be on any store that Arrow can write to.
    """

    shipped(records.sparkSession)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        system, inner = fs.FileSystem.from_uri(_uri(path))
        out = zipped = None
        n = 0
        for batch in batches:
            names = [c for c in batch.schema.names if c != "data"]
            data = batch.column("data")
            for i, row in enumerate(batch.select(names).to_pylist()):
                if row["chunk"] == 0:
                    if out is None:
                        system.create_dir(inner.rpartition("/")[0], recursive=True)
                        out = system.open_output_stream(inner, compression=None)
                    else:
                        out.write(zipped.compress(_HEAD_END) + zipped.flush())
                    zipped = zlib.compressobj(1, zlib.DEFLATED, 31)
                    out.write(zipped.compress(_header(row)))
                    n += 1
                out.write(zipped.compress(data[i].as_buffer()))
        if out is not None:
            out.write(zipped.compress(_HEAD_END) + zipped.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([n], pa.int64())})

    return written(records.mapInArrow(store, "path string, records long"), "archives")


class _Unzipped:
    """Bytes of a gzip file of many members, some at a time."""

    def __init__(self, stream, block: int):
        self.stream, self.block, self.left, self.buffer = stream, block, b"", b""
        self.member = zlib.decompressobj(31)

    def fill(self) -> bool:
        """More bytes into the buffer; False at the end."""
        while True:
            if self.member.eof:
                self.left, self.member = self.member.unused_data, zlib.decompressobj(31)
            if not self.left:
                self.left = self.stream.read(self.block)
                if not self.left:
                    return False
            more = self.member.decompress(self.left, self.block)
            self.left = self.member.unconsumed_tail
            if more:
                self.buffer += more
                return True

    def until(self, mark: bytes) -> bytes | None:
        at = self.buffer.find(mark)
        while at < 0:
            seen = max(0, len(self.buffer) - len(mark))
            if not self.fill():
                return None
            at = self.buffer.find(mark, seen)
        found, self.buffer = self.buffer[:at], self.buffer[at + len(mark):]
        return found

    def some(self, most: int) -> bytes:
        if not self.buffer and not self.fill():
            raise ValueError("the archive ends within a record")
        found, self.buffer = self.buffer[:most], self.buffer[most:]
        return found


def records_of(stream, chunk: int = CHUNK_BYTES) -> Iterator[tuple]:
    """The chunk rows of an open archive."""
    data = _Unzipped(stream, chunk)
    while (head := data.until(_HEAD_END)) is not None:
        fields = dict(re.findall(r"^([\w-]+):[ \t]*(.*?)[ \t\r]*$", head.decode(errors="replace"), re.M))
        size = int(fields["Content-Length"])
        if "application/http" in fields.get("Content-Type", ""):
            size -= len(data.until(_HEAD_END)) + len(_HEAD_END)
        sha, seen, n = hashlib.sha1(), 0, 0
        name = lambda f: urllib.parse.unquote(f[1:-1].removeprefix(_RECORD)) if f else None
        fixed = (
            name(fields["WARC-Record-ID"]) or None, fields.get("WARC-Target-URI"), fields["WARC-Type"],
            name(fields.get("WARC-Refers-To")), fields.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
        )
        while True:
            parts, want = [], min(chunk, size - seen)
            while want:
                part = data.some(want)
                parts.append(part)
                want -= len(part)
            payload = b"".join(parts)
            sha.update(payload)
            seen += len(payload)
            yield (*fixed, n, seen == size, seen, base32(sha.digest()), payload)
            n += 1
            if seen == size:
                break
        data.until(_HEAD_END)


def read(archives: DataFrame, chunk: int = CHUNK_BYTES, payload: bool = True) -> DataFrame:
    """Chunk rows of the archives named in ``path``; without ``payload`` the bytes stay null.

    At most ``chunk`` bytes of a record are held at once.
    """
    shipped(archives.sparkSession)
    kinds = [pa.string()] * 5 + [pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in CHUNKS.split(", ")]

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, inner = fs.FileSystem.from_uri(_uri(path))
                rows, held = [], 0
                with system.open_input_stream(inner, compression=None) as stream:
                    for row in records_of(stream, chunk):
                        held += len(row[-1]) if payload else 0
                        rows.append(row if payload else (*row[:-1], None))
                        if held >= chunk or len(rows) >= 4096:
                            yield emit(rows)
                            rows, held = [], 0
                if rows:
                    yield emit(rows)

    # One archive per task.
    spread = archives.select("path").repartition(max(1, archives.count()), "path")
    return spread.mapInArrow(load, CHUNKS)


def digests(chunks: DataFrame) -> DataFrame:
    """(record, payload_bytes, payload_digest, record_type, refers_to) of whole records.

    A revisit has the length and digest that its response was found to have; the digest that the
    revisit declares must be the same.
    """
    ends = chunks.where("last").select("record", "type", "refers_to", "declared_digest", "n_bytes", "digest")
    responses = ends.where("type = 'response'").select(
        "record", F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to",
    )
    known = responses.groupBy(F.col("record").alias("origin"), F.col("payload_digest").alias("found")).agg(
        F.max("payload_bytes").alias("payload_bytes")
    )
    same = (F.col("refers_to") == F.col("origin")) & (F.col("declared_digest") == F.col("found"))
    revisits = ends.where("type = 'revisit'").join(known, same).select(
        "record", "payload_bytes", F.col("found").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to"
    )
    return responses.unionByName(revisits)


def archive(spark: SparkSession, pages: DataFrame, key: str, url: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the scratch folder and return their table.

    A null payload is empty; a null url leaves the target out; of equal rows (key and payload) all
    are responses; null keys count as smallest. An empty table writes nothing. Other columns are
    not used.
    """
    return write(record_table(pages, key, url, payload, min_bytes), scratch_path(spark, "warc"))
