"""WARC archives, each record a Zstandard frame of its own, with a dictionary trained on archived records.

A file starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary; every record follows as one frame
compressed with it, so a reader that knows a record's place can open it alone. Spark's text writer writes the frames,
with its committer, to any file system it knows: the separator that it puts behind each row is an empty skippable
frame, which every Zstandard reader passes over.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityspark.llm.common import columns, slices

#: An empty skippable frame: magic 0x184D2A50, length 0.
SEPARATOR = "P*M\x18\0\0\0\0"
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528


def kinds(pages: DataFrame, payload: str, key: str, least: int) -> DataFrame:
    """The rows with digest, record_type and refers_to. Of equal payloads of ``least`` bytes or more the largest key is the response.

    Rows that share the largest key are responses all; a group without any key has responses only.
    """
    rows = pages.withColumn("digest", F.sha1(payload)).withColumn("size", F.length(payload))
    groups = rows.filter(F.col("size") >= least).groupBy("digest").agg(F.max(key).alias("first"), F.count("*").alias("n")).filter("n > 1")
    refers = F.when((F.col("size") >= least) & (F.col(key) < F.col("first")) | (F.col(key).isNull() & F.col("first").isNotNull()), F.col("first"))
    return rows.join(groups, "digest", "left").withColumn("refers_to", refers).drop("first", "n").withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))


def uri(key: object) -> str:
    return f"<urn:record:{'' if key is None else key}>"


def record(key: object, url: str | None, payload: bytes, size: int, digest: str, refers_to: object, date: str) -> bytes:
    """A response with the payload, or a revisit that holds the head of the response alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    named = base64.b32encode(bytes.fromhex(digest)).decode()
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {uri(key)}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{named}", "Content-Type: application/http;msgtype=response"]
    if url:
        head.insert(3, "WARC-Target-URI: " + "".join(c for c in url if c not in "\r\n"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {uri(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block = http + payload if refers_to is None else http
    return "\r\n".join(["WARC/1.1", *head, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def trained(rows: DataFrame, date: str, samples: int = 1000, sample_bytes: int = 65536, size: int = 65536) -> bytes:
    """A dictionary from at most ``samples`` records with payloads of at most ``sample_bytes`` each, those with the smallest
    hashes; empty where they are too few. Records are taken whole, with their heads."""
    import zstandard

    fit = rows.filter(F.length("payload").between(64, sample_bytes)).select("key", "url", "payload", F.xxhash64("payload").alias("order"))
    # First the hashes alone: each task sends its smallest ones to the driver. Copies count once.
    last = fit.select("order").distinct().orderBy("order").limit(samples).agg(F.max("order")).first()[0]
    if last is None:
        return b""
    chosen = fit.filter(F.col("order") <= last).groupBy("order").agg(F.min(F.struct("payload", "key", "url")).alias("x")).orderBy("order").limit(samples)
    payloads = ((r["key"], r["url"], bytes(r["payload"])) for r in chosen.select("x.*").toLocalIterator())
    archived = [record(key, url, p, len(p), hashlib.sha1(p).hexdigest(), None, date) for key, url, p in payloads]
    if len(archived) < 16 or sum(map(len, archived)) < 16 * 1024:
        return b""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, archived)) // 8), archived).as_bytes()
    except zstandard.ZstdError:  # nothing in common
        return b""


def write_archives(pages: DataFrame, path: str, payload: str = "payload", key: str = "page_id", url: str = "url", least: int = 1000, level: int = 6, date: str = "2024-01-01T00:00:00Z", **training: int) -> None:
    """Write a record for each row to files below ``path``.

    A null payload is an empty one and a null url is left out; null keys are written as such. An empty table gives
    files without records. A revisit needs no payload to be written, so a popular page costs its head only. A task writes
    one file; adaptive execution deals about 64 MB of pages to a task, which keeps files far below the 2 GB that a reader's
    row can hold.
    """
    rows = columns(pages, payload, key, url).select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload"))
    dictionary = trained(rows, date, **training)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        out = lambda values: pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], names=["value"])
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True, write_content_size=True)
        if dictionary:
            yield out([struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary])
        for batch in slices(batches, "payload", 1 << 22):
            yield out([press.compress(record(*row, date)) for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True)])

    decided = kinds(rows, "payload", "key", least)
    sent = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b""))
    archived = decided.select("key", "url", sent.alias("payload"), "size", "digest", "refers_to")
    archived.mapInArrow(frames, "value binary").select(F.col("value").cast("string").alias("value")).write.option("lineSep", SEPARATOR).option("compression", "none").text(path)


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, from its headers alone."""
    flags = data[at + 4]
    single, sizes = flags >> 5 & 1, flags >> 6
    at += 5 + (0 if single else 1) + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[sizes]
    while True:
        head = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            return at + (4 if flags & 4 else 0)


def records(archive: bytes) -> Iterator[bytes]:
    """The records of a file."""
    import zstandard

    data, at, press = memoryview(archive), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        magic, size = struct.unpack_from("<II", data, at)
        if magic == FRAME_MAGIC:
            end = frame_end(data, at)
            yield press.decompress(data[at:end])
        elif magic & 0xFFFFFFF0 == 0x184D2A50:
            end = at + 8 + size
            if magic == DICTIONARY_MAGIC:
                press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(data[at + 8 : end])))
        else:
            raise ValueError(f"no frame at {at}")
        at = end


def parsed(raw: bytes) -> dict:
    """Fields of a record: type, key, refers_to, url, digest (hex), payload (null in a revisit) and payload_bytes."""
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(x.split(b": ")[1] for x in http.split(b"\r\n") if x.startswith(b"Content-Length")))
    named = lambda x: x[len("<urn:record:") : -1] or None if x else None
    whole = fields["WARC-Type"] == "response"
    if whole and len(payload) != length:
        raise ValueError("a payload is cut off")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    return {"record_type": fields["WARC-Type"], "key": named(fields["WARC-Record-ID"]), "refers_to": named(fields.get("WARC-Refers-To")), "url": fields.get("WARC-Target-URI"), "payload_digest": digest, "payload_bytes": length, "payload": payload if whole else None}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(key, url, record_type, refers_to, payload_digest, payload_bytes, payload) of every record; keys are strings."""
    names = ["key", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)], names=names)
        for batch in batches:
            for archive in batch.column(0):
                rows, size = [], 0
                for raw in records(archive.as_buffer()):
                    rows.append(parsed(raw))
                    size += len(raw)
                    if size > 1 << 22:
                        yield table(rows)
                        rows, size = [], 0
                yield table(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(read, "key string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary")
