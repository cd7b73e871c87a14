"""Vector best-fit packing of tokenised documents into training sequences.

A document becomes pieces (only one longer than a sequence is cut), and each piece is a vector: tokens, one document,
and its attention cost (the square of its length). A sequence has a capacity in each dimension. Pieces are taken from
the longest on; of the open sequences in which a piece fits in every dimension, it goes to the tightest: the one with the
smallest weighted dot-product of the demand and the residual that it leaves, or the smallest weighted norm of that residual.

Pieces are dealt evenly over shards, each packed by one task. A shard leaves a few sequences unfilled, whatever its
size, so with the default of 20,000 pieces a shard that is a small part of one per cent.
"""

from __future__ import annotations

import base64
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.llm.common import columns, materialize, slices, text_or_empty

#: Words whose ids a task keeps, and how long they may be: together they bound the memory that words take.
MOST_WORDS, LONGEST_WORD = 300_000, 64


@dataclass(frozen=True)
class Capacity:
    """Of a sequence. Attention cost is the sum of the squared lengths; as a rule 2048 tokens can't exceed 2048 squared."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048


@dataclass(frozen=True)
class Weights:
    tokens: float = 1.0
    documents: float = 0.05
    attention: float = 0.05


class WordIds(dict):
    """The ids of words that stand behind a space, as bytes (little-endian unsigned 32 bits); bounded."""

    def __init__(self, ids_of):
        super().__init__()
        self.ids_of = ids_of
        self.marks = {c: ids_of(c) for c in ".,;:?"}

    def __missing__(self, word: str) -> bytes:
        # The pattern parts letters from the mark behind them.
        if word[-1:] in self.marks and word[:-1].isalpha():
            ids = self[word[:-1]] + self.marks[word[-1]]
        else:
            ids = self.ids_of(" " + word)
        if len(self) < MOST_WORDS and len(word) <= LONGEST_WORD:
            self[word] = ids
        return ids


def tokenizer(ranks_path: str, pattern: str, end_of_text: int):
    """Text to ids as bytes; a worker process keeps it, with the words it has met, for its later tasks."""
    kept = vars(sys).setdefault("_entityspark_tokenizers", {})
    key = (ranks_path, pattern, end_of_text)
    if key not in kept:
        kept[key] = new_tokenizer(*key)
    return kept[key]


def new_tokenizer(ranks_path: str, pattern: str, end_of_text: int):
    """Text to ids as bytes.

    A byte-level BPE splits at every single space, which belongs to what follows it. So words are looked up, and only
    new ones are encoded. Where three white space characters meet, or two at the end, the text is encoded as a whole.
    """
    import re

    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    bpe = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": end_of_text})
    odd = re.compile(r"\s\s(?:\s|\Z)").search

    def ids_of(text: str) -> bytes:
        return bpe.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()

    words = WordIds(ids_of)

    def encode(text: str) -> bytes:
        if odd(text):
            return ids_of(text)
        first, *rest = text.split(" ")
        return ids_of(first) + b"".join(map(words.__getitem__, rest))

    return encode


def pieces(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", doc_id: str = "doc_id", most: int = 2048, end: int = 0, end_of_text: int = 50256) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, shard_key): each document's ids and ``end``, cut where longer than ``most``.

    The first piece of a cut document holds what the others, all of full length, leave over. shard_key is even over
    the rows, whatever the ids and texts are.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tail = tokenizer(ranks_path, pattern, end_of_text), int(end).to_bytes(4, "little")
        for batch in slices(batches, "body", 1 << 23):
            rows, out = [], []
            for k, body in enumerate(batch.column("body").to_pylist()):
                ids = encode(body) + tail
                n = len(ids) // 4
                start, stop = 0, n % most or most
                if n <= most:
                    stop = n
                view, piece = memoryview(ids), 0
                while start < n:
                    rows.append(k)
                    out.append((piece, start, stop - start, zlib.crc32(view[4 * start : 4 * stop])))
                    start, stop, piece = stop, stop + most, piece + 1
            found = np.array(out, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(found[0].astype(np.int32)), *map(pa.array, found[1:])], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = columns(docs, doc_id, text).select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(text).alias("body"))
    cut_rows = rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")
    return cut_rows.withColumn("shard_key", F.xxhash64(F.monotonically_increasing_id()))


def best_fit(lengths: np.ndarray, capacity: Capacity, weights: Weights, rule: str = "dot") -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length. Bins in the same state are alike, so states with their bins are compared, not bins."""
    limits = np.array([capacity.tokens, capacity.documents, capacity.attention], np.float64)
    scale = np.array([weights.tokens, weights.documents, weights.attention])
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    # Residuals of open bins by row; rows of closed bins are reused.
    left, ids, used = np.zeros((1024, 3)), np.zeros(1024, np.int64), 0
    made = 0
    for k in order:
        n = float(lengths[k])
        demand = np.array([n, 1.0, n * n])
        if (demand > limits).any():
            raise ValueError(f"a piece of {int(n)} tokens exceeds the capacity")
        fits = np.flatnonzero((left[:used] >= demand).all(1)) if used else ()
        if len(fits):
            rest = (left[fits] - demand) / limits
            if rule == "norm":
                score = (rest * rest * scale).sum(1)
            else:  # the demand's dot-product with the residual it leaves; the least left over is the tightest fit
                score = (rest * scale) @ (demand / limits)
            row = fits[int(np.argmin(score))]
        else:
            if used == len(left):
                left, ids = np.vstack([left, np.zeros_like(left)]), np.append(ids, np.zeros_like(ids))
            row, used = used, used + 1
            left[row], ids[row], made = limits, made, made + 1
        bins[k], offsets[k] = ids[row], capacity.tokens - left[row, 0]
        left[row] -= demand
        if left[row, 0] < 1 or left[row, 1] < 1 or left[row, 2] < 1:  # full: the last open bin takes its place
            used -= 1
            left[row], ids[row] = left[used], ids[used]
            left[used] = 0
    return bins, offsets


def pack(rows: DataFrame, capacity: Capacity = Capacity(), weights: Weights = Weights(), rule: str = "dot", shard: int = 20_000) -> DataFrame:
    """Add sequence_id and offset to pieces with the columns length and shard_key, which goes."""
    if rule not in ("dot", "norm"):
        raise ValueError(f"no such rule: {rule}")
    n_shards = max(1, -(-rows.count() // shard))
    kept = [f for f in rows.schema.fields if f.name != "shard_key"]

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["shard"].iloc[0])
        pdf = pdf.drop(columns="shard")
        bins, offsets = best_fit(pdf["length"].to_numpy(), capacity, weights, rule)
        return pdf.assign(sequence_id=bins + (number << 40), offset=offsets)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    dealt = rows.select(*[f"`{f.name}`" for f in kept], F.pmod("shard_key", F.lit(n_shards)).alias("shard"))
    return dealt.groupBy("shard").applyInPandas(place, f"{schema}, sequence_id long, offset long")


def packed(docs: DataFrame, ranks_path: str, pattern: str, capacity: Capacity = Capacity(), weights: Weights = Weights(), rule: str = "dot", text: str = "text", doc_id: str = "doc_id", shard: int = 20_000, **tokens: int) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts count as empty and are one end token long. Rows with one doc_id, or none, are documents of their own.
    An empty table gives an empty result; further columns are ignored.
    """
    cut = pieces(docs, ranks_path, pattern, text, doc_id, most=capacity.tokens, **tokens)
    return pack(materialize(cut, "pieces"), capacity, weights, rule, shard)
