"""Repeated passages by a run-length compressed index.

Every byte is removed that lies in a string of ``length`` bytes which starts anywhere else too. To bring equal strings
together without listing them all, each window of that length is filed under its minimizer, the seed of 32 bytes in it
with the least hash: equal windows have equal minimizers at equal places. The windows that share one minimizer are a
block. Three cases are left, each exact:

* blocks whose minimizer occurs once hold no repeated window;
* in blocks that occur twice or more as a whole, all windows are repeated;
* of the other blocks the distinct ones of a minimizer are compared. They are dealt in shards of bounded size. A shard
  builds the Burrows-Wheeler transform of its blocks, run by run, with the suffix array sampled at the ends of runs.
  Only there matches are measured; between samples a streamed match shrinks by one with every byte. A window is
  repeated where the longest match that starts with it is long enough.

A minimizer with very many different blocks (a passage in a large share of all documents) would outgrow a shard; its
windows are hashed instead and counted by hash, with 128 bits, over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.llm.common import columns, discard, materialize, slices, text_or_empty, utf8

SEED = 32
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def seed_hashes(data: np.ndarray) -> np.ndarray:
    """At i the hash of the SEED bytes from i on."""
    h = np.random.RandomState(11).randint(0, 2**63, 256, dtype=np.int64).astype(np.uint64)[data]
    factor, n = int(FACTOR), 1
    while n < SEED:
        h = h[:-n] * np.uint64(factor) + h[n:] if len(h) > n else h[:0]
        factor, n = factor * factor & 2**64 - 1, 2 * n
    return h


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    least, n = keys, 1
    while 2 * n <= width:
        least, n = np.minimum(least[:-n], least[n:]), 2 * n
    return np.minimum(least[: len(keys) - width + 1], least[width - n : len(keys) - n + 1]) if width > n else least


def blocks_of(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For texts between offsets: (text, first window, windows, hash of the minimizer) of each block."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    h = seed_hashes(data)
    # The upper half of a hash decides, then the place: both are the same wherever a window occurs.
    place = sliding_least((h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64), length - SEED + 1) & np.uint64(0xFFFFFFFF)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    whole = owner[: len(place)] == owner[length - 1 :]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | ~whole[:-1] | (owner[1 : len(place)] != owner[: len(place) - 1])
    first = np.flatnonzero(new & whole)
    text = owner[first]
    end = np.minimum(np.append(first[1:], len(data)), at[text + 1] - length + 1)
    return text, first, end - first, h[place[first].astype(np.int64)]


def blocks(rows: DataFrame, length: int) -> DataFrame:
    """(fp, bh, row_id, a, n): minimizer, hash of the whole block, and where its n windows start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for batch in slices(batches, "body", 1 << 19):
            data, at = utf8(batch.column("body"))
            text, first, n, fp = blocks_of(data, at, length)
            raw = data.tobytes()
            bh = np.fromiter((digest(raw[a:b]) for a, b in zip(first.tolist(), (first + n + length - 1).tolist(), strict=True)), np.uint64, len(first))
            ids = batch.column("row_id").to_numpy(zero_copy_only=False)
            found = (fp.view(np.int64), bh.view(np.int64), ids[text], (first - at[text]).astype(np.int32), n.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["fp", "bh", "row_id", "a", "n"])

    return rows.select("row_id", "body").mapInArrow(run, "fp long, bh long, row_id long, a int, n int")


def cut_out(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted blocks (fp, occurrences, row_id, a, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body", 1 << 22):
            out: list[list] = [[], [], [], [], [], []]
            for row_id, body, parts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = memoryview(body.as_buffer())
                for p in parts:
                    for k, v in enumerate((p["fp"], p["occurrences"], row_id, p["a"], p["n"], bytes(raw[p["a"] : p["a"] + p["n"] + length - 1]))):
                        out[k].append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=["fp", "occurrences", "row_id", "a", "n", "block"])

    lists = wanted.groupBy("row_id").agg(F.collect_list(F.struct("fp", "occurrences", "a", "n")).alias("parts"))
    return rows.join(lists, "row_id").select("row_id", "body", "parts").mapInArrow(run, "fp long, occurrences long, row_id long, a int, n int, block binary")


def suffix_ranks(data: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Ranks of all suffixes, where the byte at each of ``stop`` ends a block and is smaller than others, each unlike any other."""
    size = len(data)
    block = np.searchsorted(stop, np.arange(size))
    ahead = stop[block] - np.arange(size)
    symbols = data.astype(np.uint64) + np.uint64(1)
    symbols[stop] = 0
    key = np.zeros(size, np.uint64)
    for k in range(4):
        key = key << np.uint64(16)
        key[: size - k] |= np.where(ahead[: size - k] > k, symbols[k:], np.uint64(0))
    rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
    rank = np.unique(rank * (len(stop) + 1) + np.where(ahead < 4, block + 1, 0), return_inverse=True)[1].astype(np.int64)
    width = 4
    while rank.max(initial=0) < size - 1:
        after = np.zeros(size, np.int64)
        after[: size - width] = rank[width:] + 1
        rank = np.unique(rank * (size + 1) + after, return_inverse=True)[1].astype(np.int64)
        width *= 2
    return rank


def common_length(data: np.ndarray, left: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Length of the common beginning of suffixes at p and q, within their blocks; ``left`` is how far each block goes on."""
    most = np.minimum(left[p], left[q])
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.zeros(len(data), np.uint64)
    for k in range(8):
        eight |= padded[k : k + len(data)].astype(np.uint64) << np.uint64(8 * k)
    found, live = np.zeros(len(p), np.int64), np.flatnonzero(most > 0)
    while len(live):
        differ = eight[p[live] + found[live]] ^ eight[q[live] + found[live]]
        low = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, 8, np.searchsorted(np.uint64(1) << (np.arange(8, dtype=np.uint64) * np.uint64(8)), low, "right") - 1)
        found[live] += equal
        live = live[(differ == 0) & (found[live] < most[live])]
    return np.minimum(found, most)


class RunLengthIndex:
    """A Burrows-Wheeler transform in runs, with the suffix array sampled at both ends of each run."""

    def __init__(self, data: np.ndarray, stop: np.ndarray):
        self.data, self.stop = data, stop
        order = np.argsort(suffix_ranks(data, stop))
        before = order - 1
        symbol = data[before].astype(np.int64)
        at_stop = np.isin(before, stop) | (before < 0)
        symbol[at_stop] = 256 + np.arange(at_stop.sum())  # ends of blocks are unlike each other
        start = np.flatnonzero(np.concatenate(([True], symbol[1:] != symbol[:-1])))
        end = np.append(start[1:], len(order)) - 1
        self.symbols, self.lengths = symbol[start], end - start + 1
        #: Suffixes at the start of each run and before it, and at its end and behind it.
        self.heads, self.above = order[start], order[np.maximum(start - 1, 0)]
        self.tails, self.below = order[end], order[np.minimum(end + 1, len(order) - 1)]
        self.first, self.last = start == 0, end == len(order) - 1

    def matches(self) -> np.ndarray:
        """At each place the longest match with another place, streamed from the samples on."""
        size = len(self.data)
        left = self.stop[np.searchsorted(self.stop, np.arange(size))] - np.arange(size)
        best = np.zeros(size, np.int64)
        for own, other, none in ((self.heads, self.above, self.first), (self.tails, self.below, self.last)):
            measured = np.where(none, 0, common_length(self.data, left, own, other))
            sample = np.full(size, -1, np.int64)
            sample[own] = measured
            known = np.maximum.accumulate(np.where(sample >= 0, np.arange(size), 0))
            best = np.maximum(best, sample[known] - (np.arange(size) - known))
        return best


def repeated_windows(found: list[bytes], owned: np.ndarray, length: int) -> list[np.ndarray]:
    """Of each block the windows, of its first ``owned``, that occur elsewhere among the blocks."""
    sizes = np.fromiter(map(len, found), np.int64, len(found)) + 1
    stop = np.cumsum(sizes) - 1
    match = RunLengthIndex(np.frombuffer(b"\0".join([*found, b""]), np.uint8), stop).matches()
    return [np.flatnonzero(match[e - s + 1 : e - s + 1 + n] >= length) for e, s, n in zip(stop.tolist(), sizes.tolist(), owned.tolist(), strict=True)]


def intervals(hits: np.ndarray) -> list[tuple[int, int]]:
    """Runs of successive numbers: (first, how many)."""
    if not len(hits):
        return []
    edge = np.flatnonzero(np.diff(hits) != 1) + 1
    return [(int(r[0]), len(r)) for r in np.split(hits, edge)]


def compared(blocks_: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """(row_id, a, n): windows that distinct blocks of one minimizer share, for minimizers that fit a shard."""
    total = blocks_.agg(F.sum(F.length("block"))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes))

    def run(part: pa.Table) -> pa.Table:
        found = part.column("block").to_pylist()
        hits = repeated_windows(found, part.column("n").to_numpy(), length)
        out = [(r, a + s, n) for r, a, o, h in zip(part.column("row_id").to_pylist(), part.column("a").to_pylist(), part.column("occurrences").to_pylist(), hits, strict=True) if o == 1 for s, n in intervals(h)]
        return pa.table([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int32()))], names=["row_id", "a", "n"])

    dealt = blocks_.select("row_id", "a", "n", "occurrences", "block", F.pmod(F.xxhash64("fp"), F.lit(shards)).alias("shard"))
    return dealt.groupBy("shard").applyInArrow(run, "row_id long, a int, n int")


def counted(blocks_: DataFrame, length: int) -> DataFrame:
    """The same for minimizers of any size, by counting the hashes of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in slices(batches, "block", 1 << 18):
            out = [(int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), r, a + s)
                for r, a, n, x in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True) for s in range(n) for d in (xxhash.xxh3_128_digest(x[s : s + length]),)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int32()))], names=["high", "low", "row_id", "a"])

    windows = blocks_.select("row_id", "a", "n", "block").mapInArrow(run, "high long, low long, row_id long, a int")
    often = windows.groupBy("high", "low").agg(F.count("*").alias("c")).filter("c > 1").drop("c")
    return windows.join(often, ["high", "low"]).select("row_id", "a", F.lit(1).alias("n"))


def repeats(rows: DataFrame, length: int, shard_bytes: int, most_blocks: int) -> DataFrame:
    """(row_id, a, n): from a on, n windows that occur elsewhere. ``rows`` are materialized: row_id, body."""
    found = materialize(blocks(rows, length), "blocks")
    shared = found.groupBy("fp").agg(F.count("*").alias("c"), F.min("bh").alias("least"), F.max("bh").alias("most")).filter("c > 1").select("fp", (F.col("least") != F.col("most")).alias("mixed"))
    # What follows works on the blocks whose minimizers repeat.
    repeated = materialize(found.join(shared, "fp"), "repeated")
    discard(found)
    distinct = materialize(repeated.groupBy("fp", "bh", "mixed").agg(F.count("*").alias("occurrences"), F.min(F.struct("row_id", "a", "n")).alias("x")), "distinct")
    whole = repeated.join(distinct.filter("occurrences > 1").select("fp", "bh"), ["fp", "bh"]).select("row_id", "a", "n")
    mixed = distinct.filter("mixed")
    large = mixed.groupBy("fp").agg(F.count("*").alias("c")).filter(F.col("c") > most_blocks).select("fp", F.lit(True).alias("large"))
    wanted = mixed.join(large, "fp", "left").select(F.when(F.col("large"), F.lit(None)).otherwise(F.col("fp")).alias("fp"), "occurrences", "x.*")
    # A block of a large minimizer has no fp any more: it isn't grouped again.
    parts = materialize(cut_out(rows, wanted, length), "parts")
    return whole.unionByName(compared(parts.filter("fp is not null"), length, shard_bytes)).unionByName(counted(parts.filter("fp is null"), length))


def remove_repeats(docs: DataFrame, length: int = 200, text: str = "text", doc_id: str = "doc_id", shard_bytes: int = 2 << 20, most_blocks: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) of each row: what is left when repeated passages are removed.

    Strings are judged on the input: all copies go, the first as well. Null texts count as empty, texts shorter than
    ``length`` stay whole, rows with one doc_id are documents of their own. The rest may end within a UTF-8 character,
    so it is binary. An empty table gives an empty result; further columns are ignored.
    """
    if length < SEED + 1:
        raise ValueError(f"a passage has at least {SEED + 1} bytes")
    own = columns(docs, doc_id, text).select(F.monotonically_increasing_id().alias("row_id"), F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(text).alias("body"))
    rows = materialize(own, "texts")
    marks = materialize(repeats(rows, length, shard_bytes, most_blocks), "marks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body", 1 << 22):
            stats, kept = [], []
            for body, starts, counts in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                raw = memoryview(body.as_buffer())
                a = np.array(starts.as_py() or [], np.int64)
                b = a + np.array(counts.as_py() or [], np.int64) + length - 1
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order]) if len(a) else b
                # A span starts where no earlier one reaches; spans that touch are one run of bytes.
                new = np.flatnonzero(np.concatenate(([True], a[1:] > b[:-1]))) if len(a) else np.zeros(0, np.int64)
                ends = b[np.append(new[1:], len(a)) - 1] if len(a) else b
                at, left = 0, []
                for s, e in zip(a[new].tolist(), ends.tolist(), strict=True):
                    left.append(raw[at:s])
                    at = e
                left.append(raw[at:])
                kept.append(b"".join(left))
                stats.append((len(raw), len(raw) - len(kept[-1]), len(new)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([s[k] for s in stats], pa.int64()) for k in range(3)), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    lists = marks.groupBy("row_id").agg(F.collect_list(F.struct("a", "n")).alias("m")).select("row_id", F.col("m.a").alias("starts"), F.col("m.n").alias("counts"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.join(lists, "row_id", "left").select("doc_id", "body", "starts", "counts").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
