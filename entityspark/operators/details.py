"""Details of map cards: which are asked for under a budget and a breaker, and what their status is worth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityspark.functions import text
from entityspark.operators import ordered, signals

#: The confidence of a card and its flags, by the status of its details.
QUALITY = {
    "ok": ("0.95", ""),
    "empty": ("0.85", "no_public_contacts"),
    "timeout": ("0.65", "detail_timeout contact_unverified"),
    "navigation_error": ("0.60", "detail_navigation_error contact_unverified"),
    "markup_error": ("0.55", "detail_markup_error manual_review"),
    "captcha": ("0.50", "detail_blocked contact_unverified"),
    "blocked": ("0.50", "detail_blocked contact_unverified"),
}
UNKNOWN = ("0.50", "contact_unverified manual_review")
CONTACTS = ["phone", "email", "website"]


def confidence(status: Column) -> Column:
    return F.coalesce(*[F.when(status == s, c) for s, (c, _) in QUALITY.items()], F.lit(UNKNOWN[0]))


def default_flags(status: Column) -> Column:
    array = lambda fs: F.array(*map(F.lit, fs.split())) if fs else F.array().cast("array<string>")
    return F.coalesce(*[F.when(status == s, array(fs)) for s, (_, fs) in QUALITY.items()], array(UNKNOWN[1]))


def detailed(cards: DataFrame, answers: DataFrame, order: list[str], most: int = 0) -> DataFrame:
    """The cards with status, confidence, flags and contacts of their details.

    ``cards``: org_id and the order. ``answers`` is what a request for an org_id gives: status (null: the request failed),
    phone, email, website, one row each. The first card of an organisation asks, further ones repeat the answer. After
    ``most`` requests (0: any number) the next new one finds the budget gone, and all later ones the circuit open, as they do
    once the breaker trips. Statuses that are unknown count as navigation errors. An empty table gives an empty result.
    """
    first = ordered.numbered(cards, order)
    asking = first.groupBy("org_id").agg(F.min("__id").alias("__id"))
    asked = ordered.running(ordered.numbered(asking, ["__id"], "__n"), {"seq": F.lit(1)}, "__n").select("org_id", "seq", F.col("__id").alias("__first"))
    own = F.when(F.col("status").isin(list(QUALITY)), F.col("status")).otherwise("navigation_error")
    known = answers.select(F.col("org_id"), own.alias("told"), F.col("status").isNotNull().alias("answered"), *CONTACTS)
    asked = asked.join(known, "org_id", "left").withColumns({"told": F.coalesce("told", F.lit("navigation_error")), "answered": F.coalesce("answered", F.lit(False))})
    within = asked.filter(F.col("seq") <= most) if most else asked
    # Of one run there are as many attempts as its budget allows.
    off = signals.breaker(within.select(F.lit(1).alias("run"), "seq", F.col("told").alias("status")).withColumnRenamed("seq", "place"), ["run"], ["place"]).agg(F.min("seq").alias("off"))
    state = asked.crossJoin(F.broadcast(off))  # one row
    after = F.coalesce(F.col("seq") > F.col("off"), F.lit(False))
    gone = F.lit(False) if not most else F.col("seq") > most
    status = F.when(after, "circuit_open").when(gone & (F.col("seq") == most + 1), "detail_budget_exhausted").when(gone, "circuit_open").otherwise(F.col("told"))
    done = state.withColumn("status", status).withColumn("got", ~after & ~gone)
    failed = F.when(F.col("got") & ~F.col("answered"), F.array(F.lit("detail_exception"))).otherwise(F.array().cast("array<string>"))
    done = done.select("org_id", "__first", "status", confidence(F.col("status")).alias("confidence"), F.array_join(F.concat(default_flags(F.col("status")), failed), "|").alias("flags"), *[F.when(F.col("got"), text.blank(F.col(c))).otherwise("").alias(c) for c in CONTACTS])
    # What was refused is no answer: when it is asked for again, the circuit is open.
    again = (F.col("status") == "detail_budget_exhausted") & (F.col("__id") != F.col("__first"))
    return first.join(done, "org_id").withColumn("status", F.when(again, "circuit_open").otherwise(F.col("status"))).drop("__id", "__first")
