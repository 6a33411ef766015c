"""WARC archives with revisit resolution.

Headers (page, payload digest, length) alone are shuffled by digest to find each payload's original.  Archives hold its
payload once, as a response record; the other records are revisits that refer to it.  Pages become records where they are
read, compressed one by one, so that an index of offsets finds each, in files of a folder that all executors share.
Reading parses each archive by its Content-Length fields, once, and joins revisits to their responses again.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import durable, shared_dir, slices, spread_join, utf8

LEAST_REVISIT = 100
ARCHIVE_BYTES = 16 << 20
#: Revisits sent to every executor at most; more are joined by shuffle.
BROADCAST_REVISITS = 1_000_000
GROUP_ROWS = 50_000
_END = b"\r\n"
_IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """pages(page_id, html) -> id, digest (binary) and original, distinct: those that repeat another page's payload.

    Of equal payloads of at least `least` bytes the smallest page_id is the original; if rows repeat that id, each is one.
    Null ids are revisits, unless all ids of a payload are null.  A hot payload is summed by salts before its headers meet.
    """
    headed = pages.select(F.col("page_id").alias("id"), F.sha2(utf8("html"), 256).alias("hex"), F.octet_length(F.coalesce("html", F.lit(""))).alias("n")).where(F.col("n") >= least)
    headed = durable(headed.select("id", F.unhex("hex").alias("digest")).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(1 << 20))))
    salts = max(1, -(-headed.count() // GROUP_ROWS))
    headed = headed.withColumn("salt", F.pmod("salt", F.lit(salts)))
    partial = headed.groupBy("digest", "salt").agg(F.min("id").alias("first"), F.count("*").alias("c"))
    copied = partial.groupBy("digest").agg(F.min("first").alias("original"), F.sum("c").alias("copies")).where("copies > 1").drop("copies")
    own = headed.join(partial.select("digest", "salt").join(copied, "digest"), ["digest", "salt"])
    return own.where("NOT id <=> original").select("id", "digest", "original").distinct()


def resolve(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, html, digest (binary) and original, null where the record is a response, of every page.

    The pages stay where they are read unless there are more than BROADCAST_REVISITS revisits.
    """
    found = durable(revisits(pages, least).withColumnRenamed("digest", "d"))
    found = F.broadcast(found) if found.count() <= BROADCAST_REVISITS else found
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.unhex(F.sha2(utf8("html"), 256)))
    return own.join(found, (F.col("digest") == F.col("d")) & F.col("page_id").eqNullSafe(F.col("id")), "left").select("page_id", "url", "html", "digest", "original")


def _record_id(page_id: int | None, digest: bytes) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id}|'.encode() + digest).digest())}>"


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in headers), b"Content-Length: %d" % len(block)]
    return _END.join(lines) + _END * 2 + block + _END * 2


def page_record(page_id: int | None, url: str | None, html: bytes, digest: bytes, original: int | None, date: str) -> bytes:
    """The response record of a page, or its revisit record if it has an original.  Characters that would end a line are escaped in the url."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(html)
    again = original is not None
    target = "".join("%%%02X" % ord(c) if c <= " " or c == "\x7f" else c for c in url or "")
    headers = [("WARC-Type", "revisit" if again else "response"), ("WARC-Record-ID", _record_id(page_id, digest)), ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha256:{digest.hex()}")]
    headers += [("WARC-Profile", _IDENTICAL), ("WARC-Refers-To", _record_id(original, digest))] if again else []
    headers += [("X-Page-ID", page_id)] if page_id is not None else []
    return _record([*headers, ("Content-Type", "application/http;msgtype=response")], http if again else http + html)


def _member(record: bytes) -> bytes:
    pack = zlib.compressobj(6, wbits=31)
    return pack.compress(record) + pack.flush()


def write_archives(pages: DataFrame, path: str | None = None, least: int = LEAST_REVISIT, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Write deduplicated archives (*.warc.gz, WARC 1.1, a gzip member a record, a warcinfo first) of pages; returns their folder.

    path is a folder that all executors reach by Arrow's file systems.  Its table `index` has page_id, file, offset and length
    of each record; a file that it lacks is left over from a task that was lost.  A null html is an empty payload, and a null
    url an empty target.  An empty table gives a folder without records; columns other than page_id, url and html are ignored.
    """
    path = path or f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(path)
        system.create_dir(root)
        name, out, at, rows = "", None, 0, []
        for batch in slices(batches, "html"):
            for page in batch.to_pylist():
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                    info = _member(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    out.write(info)
                    at = len(info)
                member = _member(page_record(page["page_id"], page["url"], page["html"].encode(), page["digest"], page["original"], date))
                out.write(member)
                rows.append((page["page_id"], name, at, len(member)))
                at += len(member)
                if at >= archive_bytes:
                    out.close()
                    out = None
            if rows and out is None:
                yield _batch(rows, _INDEX)
                rows = []
        if out is not None:
            out.close()
        if rows:
            yield _batch(rows, _INDEX)

    resolve(pages, least).mapInArrow(write, "page_id long, file string, offset long, length long").write.parquet(f"{path}/index")
    return path


_INDEX = {"page_id": pa.int64(), "file": pa.string(), "offset": pa.int64(), "length": pa.int64()}


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], list(types))


def parse(data: bytes):
    """The records of an archive: (headers by lower-case name, block)."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict((k.lower(), v) for k, _, v in (line.partition(": ") for line in lines))
        start, n = end + 4, int(headers["content-length"])
        if data[start + n : start + n + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut short")
        yield headers, data[start : start + n]
        at = start + n + 4


def members(stream) -> Iterator[bytes]:
    """What each gzip member of a file holds, one after another."""
    unpack, parts = None, []
    while data := stream.read(1 << 20):
        while data:
            unpack = unpack or zlib.decompressobj(31)
            parts.append(unpack.decompress(data))
            data = unpack.unused_data
            if unpack.eof:
                yield b"".join(parts)
                unpack, parts = None, []
    if unpack is not None:
        raise ValueError("a gzip member is cut short")


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """page_id, record_type, record_id, refers_id, payload_bytes and payload_digest (null for revisits) of every page's record."""
    types = {"page_id": pa.int64(), "record_type": pa.string(), "record_id": pa.string(), "refers_id": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string()} | ({"payload": pa.binary()} if with_payload else {})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for member in members(stream):
                        for h, block in parse(member):
                            if h["warc-type"] == "warcinfo":
                                continue
                            own = h["warc-type"] == "response"
                            payload = block[block.index(b"\r\n\r\n") + 4 :]
                            rows.append((int(h["x-page-id"]) if h.get("x-page-id") else None, h["warc-type"], h["warc-record-id"], h.get("warc-refers-to"), len(payload) if own else None, hashlib.sha256(payload).hexdigest() if own else None, *[payload if own else None] * with_payload))
                if rows:
                    yield _batch(rows, types)

    files = durable(spark.read.parquet(f"{path}/index").select("file").distinct())
    dealt = files.repartition(max(1, min(files.count(), 10_000)), "file")
    return dealt.mapInArrow(read, "page_id long, record_type string, record_id string, refers_id string, payload_bytes long, payload_digest string" + ", payload binary" * with_payload)


def read_resolved(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to: revisits take their payload's from the response.

    Archives are parsed once, into a table of headers; many revisits of one response are dealt to several tasks.
    """
    found = durable(read_archives(spark, path))
    # responses whose row was repeated have the same id and payload
    originals = found.where("record_type = 'response'").groupBy(F.col("record_id").alias("original")).agg(F.first("page_id").alias("first"), F.first("payload_bytes").alias("size"), F.first("payload_digest").alias("digest")).withColumnRenamed("original", "refers_id")
    responses = found.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    again = spread_join(found.where("record_type = 'revisit'").select("page_id", "record_type", "refers_id"), originals, "refers_id", found.count())
    return responses.unionByName(again.select("page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", F.col("first").alias("refers_to")))
