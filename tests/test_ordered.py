"""Limits along one order against plain loops."""

import random

from pyspark.sql import functions as F

from entityspark.operators import ordered
from entityspark.sources import readers


def test_running_sums_of_many_rows_are_exact(spark):
    n = 3_000_000
    rows = spark.range(n).select(((F.col("id") * 7919) % n).alias("k"), F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 5).alias("v")).repartition(6)
    done = ordered.running(ordered.numbered(rows, ["k"]), {"place": F.lit(1), "total": F.col("v")})
    assert done.filter("place <> k + 1").isEmpty()
    values = {r["k"]: r["v"] for r in done.filter("k < 5000").collect()}
    total, expected = 0, {}
    for k in range(5000):
        total += values[k] or 0
        expected[k] = total
    assert {r["k"]: r["total"] for r in done.filter("k < 5000").select("k", "total").collect()} == expected
    assert done.agg(F.max("total")).first()[0] == rows.agg(F.sum("v")).first()[0]


def test_budget_with_refunds_and_known_keys(spark):
    rnd = random.Random(2)
    rows = [(k, rnd.choice([None, *range(150)]), rnd.random() < 0.3) for k in range(900)]
    answers, spent, expected = {}, 0, {}
    for k, key, bad in rows:
        charged = False
        if key not in answers:
            answers[key] = spent < 60
            charged = answers[key] and not bad
            spent += charged
        expected[k] = (answers[key], charged)
    df = spark.createDataFrame(rows, "k long, key long, bad boolean").repartition(5)
    found = ordered.budgeted(df, ["k"], 60, F.col("bad"), "key")
    assert found.columns == ["k", "key", "bad", "allowed", "charged"]
    assert {r["k"]: (r["allowed"], r["charged"]) for r in found.collect()} == expected
    assert ordered.budgeted(df.limit(0), ["k"], 60, F.col("bad"), "key").collect() == []
    plain = ordered.budgeted(df, ["k"], 60, F.col("bad"))
    assert plain.filter("charged").count() == 60


def test_answers_end_at_the_third_flood_in_a_row(spark):
    for codes in ([None, 6, 6, None, 6, None, 6, 6, 6, None], [None, 9, 9, 9, None], [9] * 5, [None] * 4, [5, None]):
        kept, run = [], 0
        for k, c in enumerate(codes):
            run = run + 1 if c == readers.values.FLOOD_CODE else 0
            if c in readers.values.DEAD_TOKEN_CODES or run == 3:
                break
            if c is None:
                kept.append(k)
        df = spark.createDataFrame(list(enumerate(codes)), "seq long, error_code int")
        assert sorted(r["seq"] for r in readers.usable(df).collect()) == kept, codes
