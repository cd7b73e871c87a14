"""Exact dedup by content-defined chunk recipes.

Texts are normalised (each run of ASCII white space becomes one space) and cut where a rolling hash of the last 32
bytes has its top bits clear, so that equal passages give equal chunks wherever they stand. A chunk is known by a
64-bit hash that is verified: chunks of one hash but different SHA-256 digests or lengths get different identifiers.
Two texts are equal when their ordered identifier lists are. A text leaves its task once, as this list; what is
shuffled is about 1/80 of the text, however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.llm.common import SPACE, columns, materialize, slices, text_or_empty, utf8

WINDOW = 32
FACTOR = np.uint32(0x9E3779B1)


def normalised(text: str = "text"):
    """The text (null: empty) with one space for every run of ASCII white space."""
    # A single space is left as it is: only other runs need a replacement.
    return F.regexp_replace(text_or_empty(text), f"[\\x09-\\x0D]{SPACE}*|\\x20{SPACE}+", " ")


def byte_table() -> np.ndarray:
    return np.random.RandomState(7).randint(0, 2**32, 256, dtype=np.uint64).astype(np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """At i the hash of the WINDOW bytes from i on, by doubling."""
    h, factor, n = byte_table()[data], FACTOR, 1
    while n < WINDOW:
        h = h[:-n] * factor + h[n:] if len(h) > n else h[:0]
        factor = np.uint32((int(factor) ** 2) & 0xFFFFFFFF)
        n *= 2
    return h


def cuts(data: np.ndarray, at: np.ndarray, least: int, mean: int, most: int) -> Iterator[list[int]]:
    """Of each text between two offsets, where its chunks end."""
    marks = np.flatnonzero(rolling(data) < np.uint32(2**32 // mean)) + WINDOW
    for start, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        near, ends = marks[np.searchsorted(marks, start) : np.searchsorted(marks, end)].tolist(), []
        last, k = start, 0
        while last < end:
            while k < len(near) and near[k] < last + least:
                k += 1
            stop = min(near[k] if k < len(near) else end, last + most, end)
            ends.append(stop)
            last = stop
        yield ends


def recipes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = 256, mean: int = 2048, most: int = 16384) -> DataFrame:
    """(row_id, doc_id, text_sha256, chunks: array<struct<h, digest>>) for each row; the digest covers the length."""
    if least < WINDOW:
        raise ValueError(f"a chunk needs at least {WINDOW} bytes")

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body", 1 << 22):
            data, at = utf8(batch.column("body"))
            raw, found = data.tobytes(), []
            for start, ends in zip(at[:-1].tolist(), cuts(data, at, least, mean, most), strict=True):
                row = []
                for end in ends:
                    piece = raw[start:end]
                    row.append({"h": xxhash.xxh3_64_intdigest(piece) - 2**63, "digest": hashlib.sha256(piece).digest()})
                    start = end
                found.append(row)
            kind = pa.list_(pa.struct([("h", pa.int64()), ("digest", pa.binary())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(found, kind)], names=["row_id", "doc_id", "text_sha256", "chunks"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = columns(docs, doc_id, text).select(F.monotonically_increasing_id().alias("row_id"), F.col(f"`{doc_id}`").alias("doc_id"), normalised(text).alias("body"))
    return rows.select("row_id", "doc_id", F.sha2("body", 256).alias("text_sha256"), "body").mapInArrow(chunk, f"row_id long, doc_id {kind}, text_sha256 string, chunks array<struct<h: long, digest: binary>>")


def verified(rows: DataFrame) -> DataFrame:
    """(row_id, recipe): the ordered identifiers. An identifier is the chunk's hash and its place among the digests of that hash."""
    parts = rows.select("row_id", F.posexplode("chunks").alias("pos", "chunk")).select("row_id", "pos", "chunk.h", "chunk.digest")
    # One row a distinct chunk; the digests of a hash are one, or a handful where a 64-bit hash collides.
    known = parts.groupBy("h", "digest").agg(F.lit(1).alias("one"))
    clashing = known.groupBy("h").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("digest")).alias("digests")).filter("n > 1")
    ranked = clashing.select("h", F.posexplode("digests").alias("rank", "digest"))
    exact = parts.join(ranked, ["h", "digest"], "left").select("row_id", F.struct("pos", F.struct("h", F.coalesce("rank", F.lit(0)).alias("rank")).alias("id")).alias("part"))
    lists = exact.groupBy("row_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return lists.select("row_id", F.col("parts.id").alias("recipe"))


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **sizes: int) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty. Null doc_ids sort behind all others; of repeated rows with one doc_id the first read
    stays, so that each group keeps exactly one row. An empty table gives an empty result; further columns are ignored.
    """
    rows = materialize(recipes(docs, text, doc_id, **sizes), "recipes")
    listed = rows.select("row_id", "doc_id", "text_sha256").join(verified(rows), "row_id", "left")
    listed = materialize(listed.withColumn("recipe", F.coalesce("recipe", F.array().cast("array<struct<h: bigint, rank: int>>"))), "verified")
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"), F.col("row_id").alias("row_id"))
    groups = listed.groupBy("recipe").agg(F.count("*").alias("group_size"), F.min(order).alias("keep"))
    return listed.join(groups, "recipe").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("row_id") == F.col("keep.row_id")).alias("kept"), "text_sha256"
    )
