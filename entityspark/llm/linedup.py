"""Line dedup by an exact set-similarity join, in DataFrame operations only.

A line is the set of its lower-cased words. It goes if an earlier line, in the order of (doc_id, row, line number), has
the same set, or one whose Jaccard similarity reaches the threshold. Whether that line goes too doesn't matter: lines
are judged on the input.

Lines that are spelled alike are grouped by hash, and the earliest of each group is coded once: its distinct words as
64-bit hashes. Those are ordered by rarity, and only sets that share one of their first words (the prefix) can be similar,
equal sets in another spelling included. They meet under the word and a band of sizes, as sets of very different sizes
can't be similar. Sizes, the places of the shared word and a parity sketch of the sets rule out almost all other pairs before
Jaccard is verified on the whole sets.

Lines with a shared rare word, such as the versions of a text with many near copies, are not paired with each other:
first each meets only the earliest line of each of its rarest words, which settles most; only lines that are still unsettled
meet the other earlier ones. Of the pairs found so, each unsettled line is first compared with the one whose sketch is
nearest, and with the others only if that one is not similar. Words are taken in several passes, so that the shuffle files
of a fraction exist at a time.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from entityspark.llm.common import NOT_SPACE, SPACE, discard, materialize

#: Words are counted by hash in so many classes. Any order makes the join exact; rarity makes it fast.
CLASSES = 1 << 17
#: Bits of a word's hash below its class's rarity in a prefix. Where they collide, a pair more is verified.
BITS = 50
#: Sets of more words have a parity sketch of 128 bits instead of 64.
LARGE = 64
#: A band of sizes spans so many steps by the inverse of the threshold: fewer bring more rows, more bring more pairs to rule out.
STEPS = 2
#: White space in a line other than the space.
CONTROLS = "\t\x0b\x0c\r"
#: Passes over the words of the prefixes, for the leaders and for the others.
LED, PASSES = 2, 4
#: Tables of row numbers with at most so many rows (16 MB) are broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 1 << 21
ORDER = ("last", "doc_id", "row_id", "line_no")


def let(value: Column, of) -> Column:
    """``of(value)``, with the value computed once however often it occurs there."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def codes(line: Column) -> Column:
    """The distinct lower-cased words of a line, as hashes. Java splits at one plain character without a regular expression."""
    lower = F.lower(line)
    words = F.when(reduce(Column.__or__, [line.contains(c) for c in CONTROLS]), F.split(lower, f"{SPACE}+")).otherwise(F.split(lower, " "))
    return F.array_distinct(F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w)))


def lines(rows: DataFrame) -> DataFrame:
    """(last, doc_id, row_id, line_no, line) of every line of rows (row_id, doc_id, text); a null text has none."""
    return rows.select(F.col("doc_id").isNull().alias("last"), "doc_id", "row_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def distinct_lines(every: DataFrame) -> DataFrame:
    """(set_no, ORDER, codes): the earliest line of each spelling, blank lines left out."""
    keyed = every.select(F.struct(*ORDER, "line").alias("x"), F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2"))
    first = keyed.groupBy("k1", "k2").agg(F.min("x").alias("x"))
    return first.filter(F.col("x.line").rlike(NOT_SPACE)).select(F.monotonically_increasing_id().alias("set_no"), *[f"x.{c}" for c in ORDER], codes(F.col("x.line")).alias("codes"))


def rarity(sets: DataFrame) -> Column:
    """An array: how often words of each class occur, in quarter powers of two. It stands in the plan, so it is kept short."""
    counts = sets.select(F.explode("codes").alias("w")).groupBy(F.col("w").bitwiseAND(F.lit(CLASSES - 1)).alias("c")).count()
    found = counts.select("c", F.floor(4 * F.log2("count")).cast("int").alias("often")).toArrow()  # CLASSES rows at most
    often = dict(zip(found["c"].to_pylist(), found["often"].to_pylist()))
    return F.split(F.lit(",".join(str(often.get(k, 0)) for k in range(CLASSES))), ",").cast("array<int>")


def prefix_length(size: Column, share: float) -> Column:
    """Sets that have at least this share of their words in common with another have one of so many first words in common with it."""
    return (size - F.ceil(F.lit(share) * size - 1e-9) + 1).cast("int")


def short(size: Column, threshold: float) -> Column:
    """Length of the prefix by which a set meets sets of its size or larger ones."""
    return prefix_length(size, 2 * threshold / (1 + threshold))


def prefixes(sets: DataFrame, often: Column, threshold: float) -> DataFrame:
    """(set_no, order, size, own, largest, parity, upper, prefix): the prefix of each set, the rarest words coming first, and its bands.

    ``parity``: 64 bits, each word flips one. ``upper``: for large sets, the part of it that comes from words with the highest
    bit, so that large sets have 128 bits.
    """

    def ranked(w: Column) -> Column:
        # Without nulls Spark sorts the numbers as they are, not as objects; whatever is read from a file might be null.
        rare = F.shiftleft(F.get(often, w.bitwiseAND(F.lit(CLASSES - 1)).cast("int")).cast("long"), BITS)
        return F.coalesce(w.bitwiseAND(F.lit((1 << BITS) - 1)).bitwiseOR(rare), F.lit(0).cast("long"))

    def flipped(one) -> Column:
        return F.aggregate("codes", F.lit(0).cast("long"), lambda a, t: a.bitwiseXOR(F.call_function("shiftleft", one(t), t.bitwiseAND(F.lit(63)).cast("int"))))

    order = F.coalesce("doc_id", F.lit(2**63 - 1)) if isinstance(sets.schema["doc_id"].dataType, T.IntegralType) else F.lit(0)
    size, one = F.size("codes"), F.lit(1).cast("long")
    upper = F.when(size > LARGE, flipped(lambda t: F.shiftrightunsigned(t, 63))).otherwise(F.lit(0).cast("long"))
    prefix = F.slice(F.sort_array(F.transform("codes", ranked)), F.lit(1), prefix_length(size, threshold))
    own, largest = bands(size, threshold)
    return sets.select("set_no", order.cast("long").alias("order"), size.alias("size"), own.alias("own"), largest.alias("largest"), flipped(lambda t: one).alias("parity"), upper.alias("upper"), prefix.alias("prefix"))


def tokens(sets: DataFrame) -> DataFrame:
    """(at, token) of each word of the prefixes, with the set's other columns."""
    return sets.select(*[c for c in sets.columns if c != "prefix"], F.posexplode("prefix").alias("at", "token"))


def overlap(threshold: float) -> Column:
    """How many words similar sets x and y share at least."""
    return F.ceil((F.col("x_size") + F.col("y_size")) * (threshold / (1 + threshold)) - 1e-9)


def spare(threshold: float) -> Column:
    """How many more words could differ in x and y than their sketches tell, were they similar."""
    parity, upper = (F.col(f"x_{c}").bitwiseXOR(F.col(f"y_{c}")) for c in ("parity", "upper"))
    differing = F.when(F.least("x_size", "y_size") > LARGE, F.bit_count(upper) + F.bit_count(parity.bitwiseXOR(upper))).otherwise(F.bit_count(parity))
    return F.col("x_size") + F.col("y_size") - 2 * overlap(threshold) - differing


def bands(size: Column, threshold: float) -> tuple[Column, Column]:
    """The band of a size and that of the largest size that a similar set may have, this one or the next."""
    step = -math.log(threshold) + 1e-6  # a little more than the largest step, so rounding loses none
    return tuple(F.floor((F.log(size) + more) / (STEPS * step)) for more in (0, step))


def fits(threshold: float) -> Column:
    """Whether rows x and y of one token may belong to similar sets."""
    # The first shared word bounds the overlap by what follows it; of a similar pair that word always passes.
    reach = F.least(F.col("x_size") - F.col("x_at"), F.col("y_size") - F.col("y_at"))
    near = F.least("x_size", "y_size") >= F.greatest("x_size", "y_size") * threshold - 1e-9
    return (F.col("x_set_no") != F.col("y_set_no")) & near & (reach >= overlap(threshold)) & (spare(threshold) >= 0)


def named(words: DataFrame, side: str, key: str = "token") -> DataFrame:
    return words.select(key, *[F.col(c).alias(f"{side}_{c}") for c in words.columns if c not in ("token", "own", "largest", key)])


def to_leaders(words: DataFrame, threshold: float) -> DataFrame:
    """Candidates (a, b): each set with the earliest set of each word of its short prefix."""
    of_token = W.partitionBy("token").orderBy("y_order", "y_set_no").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = named(words.filter(F.col("at") < short(F.col("size"), threshold)), "y")
    met = rows.select("*", *[F.nth_value(c, 1).over(of_token).alias(f"x{c[1:]}") for c in rows.columns if c != "token"])
    return met.filter(fits(threshold)).select(F.col("y_set_no").alias("a"), F.col("x_set_no").alias("b")).distinct()


def among_open(words: DataFrame, settled: DataFrame, threshold: float) -> DataFrame:
    """Candidates (a, b, later, spare) of which the later one is not settled: y is as large as x or larger, so x needs its short
    prefix only. ``later`` is null where the order of the documents doesn't tell which one that is."""
    open_ = words.join(small(settled).withColumn("done", F.lit(True)), "set_no", "left").withColumn("open", F.col("done").isNull()).drop("done")
    # Token and band in one number are sorted faster. Where it collides, a pair more is looked at.
    larger = named(open_.withColumn("key", F.xxhash64("token", "own")), "y", "key")
    spread = open_.filter(F.col("at") < short(F.col("size"), threshold)).withColumn("band", F.explode(F.array_distinct(F.array("own", "largest"))))
    smaller = named(spread.withColumn("key", F.xxhash64("token", "band")).drop("band"), "x", "key")
    met = larger.join(smaller.hint("merge"), "key")
    x, y = F.col("x_order"), F.col("y_order")
    met = met.filter((F.col("x_size") <= F.col("y_size")) & fits(threshold) & ((F.col("x_open") & (x >= y)) | (F.col("y_open") & (y >= x))))
    later = F.when(x > y, F.col("x_set_no")).when(y > x, F.col("y_set_no"))
    return met.select(F.col("y_set_no").alias("a"), F.col("x_set_no").alias("b"), later.alias("later"), spare(threshold).alias("spare")).distinct()


def small(numbers: DataFrame) -> DataFrame:
    """A table of set numbers, to be broadcast if its rows, which its files' footers tell, are few enough."""
    return F.broadcast(numbers) if numbers.count() <= BROADCAST_ROWS else numbers


def in_passes(words: DataFrame, of, name: str, passes: int) -> DataFrame:
    """The distinct rows of ``of`` each part of the words, taken one after the other, in a table."""
    parts = [materialize(of(tokens(words).filter(F.pmod("token", F.lit(passes)) == k)), name) for k in range(passes)]
    found = materialize(reduce(DataFrame.unionByName, parts).distinct(), name)
    for part in parts:
        discard(part)
    return found


def whole_sets(met: DataFrame, sets: DataFrame) -> DataFrame:
    """(set_no, place, codes) of all sets of the candidates, in a table."""
    ids = materialize(met.select(F.col("a").alias("set_no")).distinct().unionByName(met.select(F.col("b").alias("set_no")).distinct()).distinct(), "ids")
    found = materialize(sets.join(small(ids), "set_no", "left_semi").select("set_no", F.struct(*ORDER).alias("place"), "codes"), "whole")
    discard(ids)
    return found


def verified(met: DataFrame, whole: DataFrame, threshold: float) -> DataFrame:
    """(set_no): the later one of each pair whose Jaccard similarity reaches the threshold."""
    with_b = met.join(whole, F.col("b") == F.col("set_no")).select("a", F.col("place").alias("b_place"), F.col("codes").alias("b_codes"), "b")
    both = with_b.join(whole, F.col("a") == F.col("set_no")).drop("set_no")
    common = F.size(F.array_intersect("codes", "b_codes"))
    alike = common >= threshold * (F.size("codes") + F.size("b_codes") - common) - 1e-9
    later = F.when(F.col("place") > F.col("b_place"), F.col("a")).otherwise(F.col("b"))
    return materialize(both.filter(alike).select(later.alias("set_no")).distinct(), "settled")


def nearest(met: DataFrame) -> DataFrame:
    """(a, b): for each later set the candidate that its sketch is nearest to."""
    return met.filter("later IS NOT NULL").groupBy("later").agg(F.max(F.struct("spare", "a", "b")).alias("x")).select("x.a", "x.b")


def kept_lines(rows: DataFrame, threshold: float) -> DataFrame:
    """(row_id, line_no) of the lines with words that stay, of rows (row_id, doc_id, text)."""
    sets = materialize(distinct_lines(lines(rows)), "sets", **{"parquet.dictionary.page.size": str(1 << 23)})
    words = materialize(prefixes(sets, rarity(sets), threshold), "words", **{"parquet.enable.dictionary": "false"})

    led = in_passes(words, lambda part: to_leaders(part, threshold), "led", LED)
    settled = verified(led, whole := whole_sets(led, sets), threshold)
    rest = in_passes(words, lambda part: among_open(part, settled, threshold), "pairs", PASSES)
    for table in (words, led, whole):
        discard(table)
    whole = whole_sets(rest, sets)
    by_nearest = verified(nearest(rest), whole, threshold)
    left = rest.join(small(by_nearest), F.col("later") == F.col("set_no"), "left_anti").select("a", "b")
    gone = materialize(reduce(DataFrame.unionByName, (settled, by_nearest, verified(left, whole, threshold))).distinct(), "gone")
    for table in (rest, whole):
        discard(table)
    return sets.join(small(gone), "set_no", "left_anti").select("row_id", "line_no")


def dedup_lines(docs: DataFrame, threshold: float = 0.8, text: str = "text", doc_id: str = "doc_id", counts: bool = True) -> DataFrame:
    """The rows with all columns, text without the lines that go, and with ``counts`` the columns n_lines and n_removed.

    Lines without words stay. A null text stays null and has no lines; a text may become empty. Null doc_ids come last;
    rows with one doc_id, or none, are ordered as they are read. An empty table gives an empty result. Columns named
    n_lines or n_removed are replaced; any other name is the caller's. The numbered rows are written first: numbers drawn
    anew by each action would differ where the input is split otherwise, as after an executor is lost.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies between 0 and 1")
    names = [n for n in docs.columns if not counts or n not in ("n_lines", "n_removed")]
    whole = F.struct(*[F.col(f"`{n}`") for n in names if n not in (text, doc_id)], F.lit(0).alias("__none"))
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), whole.alias("row")), "rows")
    kept = kept_lines(rows.drop("row"), threshold).groupBy("row_id").agg(F.collect_list("line_no").alias("stay"))
    known = F.struct(F.split("text", "\n").alias("lines"), F.coalesce("stay", F.array().cast("array<int>")).alias("stay"))

    def parts(x: Column) -> Column:
        blank = F.array_compact(F.transform(x["lines"], lambda line, k: F.when(~line.rlike(NOT_SPACE), k)))
        return F.transform(F.sort_array(F.array_union(x["stay"], blank)), lambda k: F.get(x["lines"], k))

    found = rows.join(kept, "row_id", "left").select("doc_id", "row", "text", F.size(F.coalesce(F.split("text", "\n"), F.array())).alias("n_lines"), F.when(F.col("text").isNotNull(), let(known, parts)).alias("parts"))
    out = {doc_id: F.col("doc_id"), text: F.array_join("parts", "\n")}
    numbers = ["n_lines", (F.col("n_lines") - F.size(F.coalesce("parts", F.array()))).alias("n_removed")] if counts else []
    return found.select(*[out.get(n, F.col(f"row.`{n}`")).alias(n) for n in names], *numbers)
