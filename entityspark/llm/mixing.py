"""Mixing sources to target weights through a tree of domains, languages and sources.

Each node shares its budget of tokens among its children by weight. A child can't take more than its documents hold in
the allowed epochs; what it leaves goes to its siblings by their weights, and only what a whole subtree can't take goes
to the siblings of its ancestors. Each leaf then repeats its documents for the full epochs its budget holds, and of one
further epoch takes the prefix that the budget still holds, in an order that a seed and the epoch's number give.

Selection is exact on any leaf, however large: sums by hash bucket find the bucket in which the prefix ends, and only
that bucket's rows are sorted. Budgets live in a table with one row a leaf, never on the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from entityspark.llm.common import NOT_SPACE, columns, materialize, text_or_empty

#: Hex digits of an order that make a bucket: 4096 buckets a leaf.
DIGITS = 3


def words(text: str = "text") -> Column:
    """Tokens of a text: runs without ASCII white space; none in a null."""
    return F.regexp_count(text_or_empty(text), F.lit(f"{NOT_SPACE}+")).cast("long")


def weight(level: str, weights: dict[str, float]) -> Column:
    """The weight of a node by its name; 1 where none is given."""
    if any(w < 0 for w in weights.values()):
        raise ValueError("weights can't be negative")
    return reduce(lambda c, kv: c.when(F.col(level) == kv[0], float(kv[1])), weights.items(), F.when(F.lit(False), 1.0)).otherwise(1.0)


def shared(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Add ``budget``: the parent's ``whole`` dealt by ``w`` up to each child's ``capacity``, shortages to its siblings.

    By rising capacity per weight, a child is full while the level that the rest would reach lies above its own; the
    highest such level is the water line.
    """
    order = [F.when(F.col("w") > 0, F.col("capacity") / F.col("w")).asc_nulls_last(), F.col(name)]
    by = W.partitionBy(*parent) if parent else W.partitionBy(F.lit(0))
    behind = F.coalesce(F.sum("capacity").over(by.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ahead = F.sum("w").over(by.orderBy(*order).rowsBetween(0, W.unboundedFollowing))
    level = nodes.withColumn("level", F.when(ahead > 0, (F.col("whole") - behind) / ahead))
    line = F.max("level").over(by)
    return level.withColumn("budget", F.least(F.col("capacity").cast("double"), F.col("w") * F.coalesce(line, F.lit(0.0)))).drop("level", "whole")


def budgets(leaves: DataFrame, levels: list[str], weights: list[dict[str, float]], target: float, epochs: int) -> DataFrame:
    """(levels, tokens, budget) of each leaf. ``target`` is a number of tokens, or up to 1 a share of all tokens.
    A shortage goes to the siblings first and then to those of the ancestors; a weight of 0 shuts all that lies below it."""
    # What lies below a weight of 0 can take nothing, so no node above counts on it.
    shut = reduce(lambda a, b: a | b, [weight(n, w) == 0 for n, w in zip(levels, weights, strict=True)])
    capped = leaves.withColumn("capacity", F.when(shut, 0).otherwise(F.col("tokens") * epochs))
    root = capped.agg(F.sum("tokens").alias("all"), F.sum("capacity").alias("most"))
    whole = F.least(F.col("most").cast("double"), F.col("all") * F.lit(float(target)) if target <= 1 else F.lit(float(target)))
    above = root.select(whole.alias("whole"))
    for depth, name in enumerate(levels):
        nodes = capped.groupBy(*levels[: depth + 1]).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens")).withColumn("w", weight(name, weights[depth]))
        nodes = nodes.crossJoin(above) if not depth else nodes.join(above, levels[:depth])  # the root is one row
        above = shared(nodes, levels[:depth], name).select(*levels[: depth + 1], "tokens", F.col("budget").alias("whole"))
        if depth < len(levels) - 1:
            above = above.drop("tokens")
    return above.withColumn("budget", F.floor(F.col("whole") + 1e-6)).drop("whole")


def order(seed: int, epoch: Column, doc_id: str) -> Column:
    """The place of a document in an epoch, as 32 hex digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))


def plan(rows: DataFrame, levels: list[str], weights: list[dict[str, float]], target: float, epochs: int = 1, seed: int = 0, doc_id: str = "doc_id") -> DataFrame:
    """One row a leaf: levels, tokens, budget, full (epochs taken whole), cut (the last order taken of one more; null: none).

    ``rows`` has the levels, doc_id and n_tokens.
    """
    if epochs < 1 or target < 0 or len(weights) != len(levels):
        raise ValueError("epochs, target and a dict of weights for each level are needed")
    leaves = rows.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"))
    full = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0)
    table = materialize(budgets(leaves, levels, weights, target, epochs).withColumn("full", full).withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens")), "budgets")
    placed = rows.join(table.select(*levels, "full", "rest"), levels).filter("rest > 0 and n_tokens > 0").withColumn("order", order(seed, F.col("full"), doc_id)).withColumn("bucket", F.substring("order", 1, DIGITS))
    sums = placed.groupBy(*levels, "bucket").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
    reached = sums.withColumn("up_to", F.sum("n").over(W.partitionBy(*levels).orderBy("bucket")))
    last = reached.filter("up_to > rest and up_to - n <= rest").select(*levels, "bucket", (F.col("rest") - (F.col("up_to") - F.col("n"))).alias("within"))
    close = placed.join(last, [*levels, "bucket"]).withColumn("up_to", F.sum("n_tokens").over(W.partitionBy(*levels).orderBy("order").rangeBetween(W.unboundedPreceding, W.currentRow)))
    ends = close.groupBy(*levels).agg(F.max(F.when(F.col("up_to") <= F.col("within"), F.col("order"))).alias("in_bucket"), F.min("bucket").alias("bucket"))
    # Where the last bucket gives nothing, all orders below it are taken; '' is below every order.
    cut = F.coalesce("in_bucket", "bucket")
    return materialize(table.join(ends.select(*levels, cut.alias("cut")), levels, "left").drop("rest"), "mixture")


def chosen(rows: DataFrame, mixture: DataFrame, levels: list[str], full: Column, seed: int = 0, doc_id: str = "doc_id") -> DataFrame:
    """The rows that are taken, each once for every epoch that takes it, with the column ``epoch``. ``full``: has tokens."""
    joined = rows.join(mixture.select(*levels, "full", "cut"), levels)
    times = F.col("full") + F.when(full & (order(seed, F.col("full"), doc_id) <= F.col("cut")), 1).otherwise(0)
    return joined.withColumn("times", times).filter("times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), (F.col("times") - 1).cast("int")))).drop("full", "cut", "times")


def mix(docs: DataFrame, domain: Column, weights: list[dict[str, float]], target: float, epochs: int = 1, seed: int = 0, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, domain, lang, source, n_tokens, epoch for every time that a document is taken.

    Null sources and languages are nodes of their own, named ''. Documents without tokens, null texts among them, are
    taken with the full epochs of their leaf only. Rows with one doc_id have one place in the order and are taken
    together or not at all. The prefix ends with the last document that fits whole, so a leaf may stay short by less
    than a document. An empty table gives an empty result; further columns are ignored.
    """
    own = columns(docs, doc_id, text, "lang", "source").select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(domain, F.lit("")).alias("domain"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), words(text).alias("n_tokens")
    )
    rows, levels = materialize(own, "weighed"), ["domain", "lang", "source"]
    return chosen(rows, plan(rows, levels, weights, target, epochs, seed), levels, F.col("n_tokens") > 0, seed)


def mixed_rows(docs: DataFrame, domain: Column, weights: list[dict[str, float]], target: float, epochs: int = 1, seed: int = 0, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows themselves, all their columns as they were and whatever their names, once for every time that ``mix`` takes
    them. An empty table gives an empty result."""
    # The caller's columns lie in a struct of their own, so no name can clash.
    levels = ["m_domain", "m_lang", "m_source"]
    named = [F.coalesce(c, F.lit("")).alias(n) for n, c in zip(levels, (domain, F.col("lang"), F.col("source")), strict=True)]
    some = F.coalesce(F.col(f"`{text}`").rlike(NOT_SPACE), F.lit(False))
    own = docs.select(*named, F.col(f"`{doc_id}`").alias("doc_id"), some.alias("some"), F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("own"))
    light = materialize(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), *named, words(text).alias("n_tokens")), "weighed")
    mixture = plan(light, levels, weights, target, epochs, seed)
    return chosen(own, mixture, levels, F.col("some"), seed).select(*[F.col(f"own.`{n}`").alias(n) for n in docs.columns])
