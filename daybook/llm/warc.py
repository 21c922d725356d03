"""WARC archives, compressed record by record with an embedded Zstandard dictionary.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds a
dictionary built from a spread of its own records; each record follows as a
frame of its own.  A task writes archives of about ``ARCHIVE_BYTES`` under a
name of its attempt and reports them in a manifest; only archives in the
manifest are read, so what a lost or repeated task has left is not.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sources.store import materialize

MAGIC = 0x184D2A5D
#: Uncompressed bytes after which an archive is closed; bytes of the dictionary and of the records it is built from.
ARCHIVE_BYTES, DICTIONARY_BYTES, TRAINING_BYTES = 24 << 20, 32 << 10, 2 << 20
#: Payloads smaller than this are always written whole.
LEAST_SHARED = 100
LEVEL, CHUNK, DATE = 3, 1 << 16, "2024-01-01T00:00:00Z"
_RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def with_roles(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with payload_digest, payload_bytes, record_type and refers_to.

    The smallest page_id of equal payloads of LEAST_SHARED bytes or more is
    the response, others revisit it; smaller payloads are responses.  A null
    html is an empty payload.  Repeated rows of the smallest page_id are all
    responses; a null page_id is a response only where no row has an id.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    told = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    told = told.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256))
    shared = told.where(f"payload_bytes >= {LEAST_SHARED}").groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    marked = told.join(shared.where("n > 1").drop("n"), "payload_digest", "left")
    marked = marked.withColumn("refers_to", F.expr("CASE WHEN first IS NOT NULL AND NOT page_id <=> first THEN first END"))
    return marked.withColumn("record_type", F.expr("if(refers_to IS NULL, 'response', 'revisit')")).drop("first")


def record_bytes(row: dict) -> bytes:
    """One WARC record; a revisit has no payload but tells its size and digest."""
    payload = row["payload"] if row["record_type"] == "response" else b""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode() + payload
    name = lambda i: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{i}:{row['payload_digest']}')}>"
    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {name(row['page_id'])}", f"WARC-Date: {DATE}"]
    if row["url"] is not None:
        head.append("WARC-Target-URI: " + quote(row["url"], safe="!#$&'()*+,/:;=?@[]~%"))
    head += [f"WARC-Payload-Digest: sha256:{row['payload_digest']}", "Content-Type: application/http;msgtype=response"]
    if row["record_type"] == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(row['refers_to'])}"]
        head.append(f"Refers-To-Page-ID: {row['refers_to']}")
    if row["page_id"] is not None:
        head.append(f"Page-ID: {row['page_id']}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> bytes:
    """A dictionary from an even spread of the records; raw pieces of them where too few are there to train on."""
    step = max(1, sum(map(len, records)) // TRAINING_BYTES)
    sample = [r[:CHUNK] for r in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(r[:1024] for r in sample)[:DICTIONARY_BYTES]


def archive(records: list[bytes]) -> Iterator[bytes]:
    """The parts of one archive: the skippable frame, then a frame per record."""
    content = dictionary(records)
    yield struct.pack("<II", MAGIC, len(content)) + content
    writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(content), write_content_size=True)
    yield from map(writer.compress, records)


def _writing(folder: str):
    def write(records: list[bytes]) -> tuple[str, int]:
        path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        files, at = fs.FileSystem.from_uri(path)
        files.create_dir(at.rsplit("/", 1)[0], recursive=True)
        with files.open_output_stream(at) as out:
            for part in archive(records):
                out.write(part)
        return path, len(records)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, done = [], 0, []
        for batch in batches:
            for i in range(batch.num_rows):
                held.append(record_bytes(batch.slice(i, 1).to_pylist()[0]))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    done.append(write(held))
                    held, size = [], 0
        if held:
            done.append(write(held))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], ["path", "records"])

    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Archive ``pages`` below the shared ``folder`` (a URI or path every executor reaches); the manifest: path, records."""
    root = folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "", 1)
    given = with_roles(pages).select("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload")
    return materialize(given.mapInArrow(_writing(root), "path string, records long"), "warc/manifest")


def frames(path: str) -> Iterator[bytes]:
    """The records of an archive, streamed."""
    files, at = fs.FileSystem.from_uri(path)
    with files.open_input_stream(at) as source:
        magic, size = struct.unpack("<II", source.read(8))
        if magic != MAGIC:
            raise ValueError(f"{path} doesn't begin with a dictionary")
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(source.read(size)))
        current, parts = reader.decompressobj(), []
        begun = False
        while chunk := source.read(CHUNK):
            while chunk:
                begun = True
                parts.append(current.decompress(chunk))
                chunk = b""
                if current.eof:
                    yield b"".join(parts)
                    chunk, parts, current, begun = current.unused_data, [], reader.decompressobj(), False
        if begun:
            raise ValueError(f"{path} ends inside a record")


def parse(record: bytes) -> dict:
    """The fields of one record; a response's payload must agree with the stated size and digest."""
    head, block = record.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    field = dict(line.split(": ", 1) for line in lines[1:])
    block = block[: int(field["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    digest = field["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = field["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {field['WARC-Record-ID']} is damaged")
    number = lambda k: int(field[k]) if k in field else None
    return {
        "page_id": number("Page-ID"), "url": field.get("WARC-Target-URI"), "record_type": kind, "refers_to": number("Refers-To-Page-ID"),
        "payload_bytes": size, "payload_digest": digest, "payload": payload if kind == "response" else None,
    }


def _reading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
    )
    for batch in batches:
        for path in batch.column("path").to_pylist():
            held, size = [], 0
            for record in frames(path):
                held.append(parse(record))
                size += len(record)
                if size >= ARCHIVE_BYTES // 4:
                    yield pa.RecordBatch.from_pylist(held, kind)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, kind)


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Every record of the archives of a manifest; a revisit's payload is null, its size and digest are those of the response."""
    n = spark.sparkContext.defaultParallelism * 4
    return manifest.where("path IS NOT NULL").select("path").repartition(n, "path").mapInArrow(_reading, _RECORD)
