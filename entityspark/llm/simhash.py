"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two 64-bit fingerprints that differ in at most 3 bits differ in at most one bit in one of their 32-bit halves. So every
fingerprint emits all variants within half the radius (one bit, rounded down) of each half: 66 keys. It meets the other
fingerprint at that one's own half. Where two or more meet, they emit the variants of the other half the same way, and
what meets there is verified by the bits that were flipped: everything around a middle is linked to the one that owns
it, so a group of any size needs as many links as members, and no pairs are listed.

Links are between distinct fingerprints: copies cost nothing. Each is verified by the bits in which they differ.
Components are found by large and small stars.

Halves have 32 bits: up to some ten million distinct fingerprints few meet by chance, with n of them about n * n / 65
million rows do. They are refined in the other half, so links stay right, but work grows with the square from there on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.llm.common import columns, discard, materialize, slices, text_or_empty, utf8


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Bits set in over half the XXH64 hashes (seed 42) of the word shingles, repeats included. No words: zero."""
    import xxhash

    hashes = shingle_hashes(text, shingle, xxhash.xxh64_intdigest)
    if not hashes:
        return 0
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


def shingle_hashes(text: bytes, shingle: int, hash64) -> list[int]:
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return []
    line = b" ".join(words)
    if len(words) < shingle:
        return [hash64(line, 42)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    return [hash64(line[a:b], 42) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=False)]


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3) -> DataFrame:
    """(doc_id, fp long) of each row; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body", 1 << 22):
            data, at = utf8(batch.column("body"))
            raw = data.tobytes()
            found = np.array([fingerprint(raw[a:b], shingle) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = columns(docs, doc_id, text).select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(text).alias("body"))
    return rows.mapInArrow(run, f"doc_id {kind}, fp long")


def flips(width: int, bits: int) -> list[int]:
    """Masks with exactly so many bits, none (0) included for one bit; of two bits both lie in one half of the width."""
    if bits == 1:
        return [0, *(1 << k for k in range(width))]
    half = width // 2
    return [1 << i | 1 << j for low in (0, half) for i in range(low, low + half) for j in range(low, i)]


def literal(masks: list[int]):
    return F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>")


def links(fps: DataFrame) -> DataFrame:
    """(fp, to): links within 3 bits that connect what all such links connect. ``fps`` has distinct values of fp."""
    low = F.lit(0xFFFFFFFF)
    halves = F.explode(F.array(*[F.struct(F.lit(h).alias("h"), own.alias("own"), other.alias("other")) for h, own, other in (
        (0, F.col("fp").bitwiseAND(low), F.shiftrightunsigned("fp", 32)), (1, F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(low)))]))
    split = fps.select("fp", halves.alias("x")).select("fp", "x.*")
    # Of two halves that differ in one bit the one that has it set meets the other where it is cleared, so flips only clear.
    flipped = split.select("fp", "h", "own", "other", F.explode(literal(flips(32, 1))).alias("m")).filter(F.col("own").bitwiseAND(F.col("m")) == F.col("m"))
    variants = flipped.select("fp", "h", F.col("own").bitwiseXOR(F.col("m")).alias("key"), "other", (F.col("m") == 0).alias("at"))
    # One row for each half that some fingerprint has; a variant that none has can't be a middle. Explodes are larger
    # than Spark estimates, so these joins are told not to broadcast.
    owners = split.groupBy("h", F.col("own").alias("key")).agg(F.count("*").alias("own_n"))
    met = variants.join(owners.hint("merge"), ["h", "key"])
    sizes = met.groupBy("h", "key").agg(F.count("*").alias("n")).filter("n > 1")
    met = materialize(met.join(sizes.hint("merge"), ["h", "key"]).select("h", "key", "fp", "other", "at", "own_n"), "met")
    # Members of one key with the same other half differ in at most 2 bits. One stands for them, one with the key itself
    # if there is any: it has every link in this key that the others have.
    ranked = F.struct(~F.col("at"), F.col("fp"))
    same = met.groupBy("h", "key", "other").agg(F.min(ranked).alias("r"), F.max("at").alias("at"), F.first("own_n").alias("own_n"))
    stands = materialize(same.select("h", "key", "other", "at", "own_n", F.col("r.fp").alias("fp")), "stands")
    equal = met.join(stands.select("h", "key", "other", F.col("fp").alias("to")).hint("merge"), ["h", "key", "other"]).select("fp", "to")
    # Around a middle (key, mid): P has the key itself and at most 1 flipped bit, R one flipped bit in the key and at most 1
    # here, Q the key itself and 2 flipped bits. P-P differ in at most 2 bits, P-R and P-Q in at most 3. Q is needed for
    # 3 differing bits only: then the parities differ, so the odd one takes two flips, two of the three lie in one half.
    odd = F.col("at") & (F.col("own_n") > 1) & (F.bit_count("fp") % 2 == 1)
    near = stands.select("h", "key", "fp", "other", "at", F.explode(literal(flips(32, 1))).alias("m"))
    far = stands.filter(odd).select("h", "key", "fp", "other", F.lit(False).alias("at"), F.explode(literal(flips(32, 2))).alias("m"))
    around = near.unionByName(far).select("h", "key", "fp", "at", F.col("other").bitwiseXOR(F.col("m")).alias("mid"))
    middles = around.groupBy("h", "key", "mid").agg(F.min(F.when(F.col("at"), F.col("fp"))).alias("to"), F.count("*").alias("n")).filter("to is not null and n > 1").drop("n")
    close = around.join(middles.hint("merge"), ["h", "key", "mid"]).select("fp", "to")
    # Every link is verified on the fingerprints themselves.
    verified = F.bit_count(F.col("fp").bitwiseXOR(F.col("to"))).between(1, 3)
    return close.unionByName(equal).filter(verified).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node of each node's component, for nodes with links. Each round is written and read again."""
    pairs = materialize(edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).filter("v <> u").distinct(), "edges")
    while True:
        both = pairs.select("v", "u").unionByName(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).withColumn("m", F.least("v", "m"))
        # Large star: larger neighbours go to the least of all neighbours.
        large = both.filter("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        # Small star: smaller neighbours, and the node, go to the least of them.
        lower = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(lower, "v").select(F.explode(F.array(F.struct(F.col("v").alias("v"), F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e")).select("e.v", "e.u").filter("v <> u").distinct()
        after = materialize(small, "stars")
        done = after.exceptAll(pairs).isEmpty() and after.count() == pairs.count()
        discard(pairs)
        pairs = after
        if done:
            return pairs.select(F.col("v").alias("node"), F.col("u").alias("root"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row: 16 hex digits, and the smallest doc_id that links reach.

    Null and empty texts have the fingerprint zero, linked like any other. Null doc_ids are never the smallest unless a
    component has no other; rows with one doc_id are rows of their own. Further columns are ignored.
    """
    rows = materialize(fingerprints(docs, text, doc_id, shingle), "fingerprints")
    known = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(known.select("fp")), "fp", "to")
    # A fingerprint without links is its own component.
    placed = known.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    names = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    table = materialize(placed.join(names, "root").select("fp", "component_id"), "components")
    return rows.join(table, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3) -> DataFrame:
    """The rows, all their columns as they were, that stand for a component: of each the one with the smallest doc_id.

    Null doc_ids come last; of rows with one doc_id the first read stays. Null and empty texts are one group. An empty table
    gives an empty result; any further columns stay, whatever their names.
    """
    # The caller's columns lie in a struct of their own, so no name can clash.
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("own")), "rows")
    found = near_duplicates(rows.select("row", "text"), "text", "row", shingle).select(F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    order = F.struct(F.col("id").isNull(), "id", "row")
    stay = rows.select("row", "id").join(found, "row").groupBy("group").agg(F.min(order).alias("first")).select(F.col("first.row").alias("row"))
    return rows.join(stay, "row", "left_semi").select(*[F.col(f"own.`{n}`").alias(n) for n in docs.columns])
