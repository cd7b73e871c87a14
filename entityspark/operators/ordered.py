"""Limits along one global order: running sums in levels, so that no task sees more than a bucket of rows.

Rows are dealt by range, sorted and numbered once, in a written table. A bucket is 65,536 neighbouring numbers; sums of buckets
are added up within 65,536 buckets, and those sums, two for each partition, in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from entityspark.operators.lineage import cut

BITS = 16


def numbered(rows: DataFrame, order: list[str], name: str = "__id") -> DataFrame:
    """The rows with ascending numbers along ``order`` (nulls first), with gaps. Ties are settled once, in the written table."""
    keys = [F.col(f"`{c}`").asc_nulls_first() for c in order]
    return cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(name, F.monotonically_increasing_id()))


def running(rows: DataFrame, sums: dict[str, Column], name: str = "__id") -> DataFrame:
    """Numbered rows with the running sum, themselves included, of each whole-number column. Nulls add nothing."""
    names = list(sums)
    values = rows.withColumns({f"__{n}": F.coalesce(c.cast("long"), F.lit(0)) for n, c in sums.items()}).withColumn("__b", F.shiftright(name, BITS))
    add = lambda: [F.sum(f"__{n}").alias(f"__{n}") for n in names]
    buckets = cut(values.groupBy("__b").agg(*add()))
    tops = buckets.groupBy(F.shiftright("__b", BITS).alias("__t")).agg(*add())
    all_ = tops.agg(F.collect_list(F.struct("__t", *[f"__{n}" for n in names])).alias("a"))  # two a partition
    below = lambda t, n: F.aggregate(F.filter("a", lambda x: x["__t"] < t["__t"]), F.lit(0).cast("long"), lambda s, x: s + x[f"__{n}"])
    offsets = all_.select(F.inline(F.transform("a", lambda t: F.struct(t["__t"].alias("__t"), *[below(t, n).alias(f"__t_{n}") for n in names]))))
    way = W.partitionBy("__t").orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    starts = buckets.withColumn("__t", F.shiftright("__b", BITS)).join(offsets, "__t")
    starts = starts.select("__b", *[(F.col(f"__t_{n}") + F.coalesce(F.sum(f"__{n}").over(way), F.lit(0))).alias(f"__s_{n}") for n in names])
    way = W.partitionBy("__b").orderBy(name).rowsBetween(W.unboundedPreceding, 0)
    done = values.join(starts, "__b").withColumns({n: F.col(f"__s_{n}") + F.sum(f"__{n}").over(way) for n in names})
    return done.select(*[F.col(f"`{c}`") for c in rows.columns], *names)


def before_first(rows: DataFrame, stop: DataFrame, name: str) -> DataFrame:
    """The rows before the first of ``stop``, by the column ``name``; all where there is none."""
    first = stop.agg(F.min(name).alias("__stop"))  # one row
    return rows.crossJoin(F.broadcast(first)).filter(F.col("__stop").isNull() | (F.col(name) < F.col("__stop"))).drop("__stop")


def in_a_row(places: DataFrame, n: int) -> DataFrame:
    """(place) of those that end a run of ``n`` neighbouring places, each given once."""
    ends = places.select("place")
    for k in range(1, n):
        ends = ends.join(places.select((F.col("place") + k).alias("place")), "place", "left_semi")
    return ends


def budgeted(rows: DataFrame, order: list[str], most: int, refunded: Column, key: str | None = None) -> DataFrame:
    """The rows with ``allowed`` and ``charged``, under a budget of ``most`` that is spent along ``order``.

    A row is allowed while less than the budget is spent before it, and charged unless it is refunded (skipped or failed).
    With a ``key``, its first row alone is looked up: the others repeat that answer, free of charge, also when the budget is
    gone. Null keys are one key; an empty table gives an empty one.
    """
    placed = numbered(rows, order)
    if key:
        first = placed.groupBy(F.col(f"`{key}`").alias("__key")).agg(F.min("__id").alias("__first"))
        placed = placed.join(first, F.col(f"`{key}`").eqNullSafe(F.col("__key"))).drop("__key")
    else:
        placed = placed.withColumn("__first", F.col("__id"))
    placed = placed.withColumn("__cost", ((F.col("__id") == F.col("__first")) & ~F.coalesce(refunded, F.lit(False))).cast("long"))
    spent = running(placed, {"__spent": F.col("__cost")})
    own = spent.withColumn("allowed", F.col("__spent") - F.col("__cost") < most).withColumn("charged", F.col("allowed") & (F.col("__cost") == 1))
    if key:
        answers = own.filter("__id = __first").select("__first", F.col("allowed").alias("__answer"))
        own = own.drop("allowed").join(answers, "__first").withColumnRenamed("__answer", "allowed")
    return own.select(*[F.col(f"`{c}`") for c in rows.columns], "allowed", "charged")
