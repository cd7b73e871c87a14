"""State per key over restarts and batches of any cut."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from entityspark.operators import signals
from entityspark.streaming import keyed, state

DAY0 = datetime(2026, 1, 1)


def feed(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_entries_expire_by_status_over_restarts(spark, tmp_path):
    schema = "host string, status string, checked_at timestamp"
    at = lambda d: DAY0 + timedelta(days=d)
    runs = [
        [("a.ru", "found", at(0)), ("b.ru", "dead", at(0)), ("c.ru", "none", at(0)), ("c.ru", "found", at(-1)), (None, "dead", at(0)), ("x.ru", None, at(0)), ("y.ru", "found", None)],
        [("d.ru", "found", at(8))],  # the dead go with the watermark, after seven days
        [("b.ru", "none", at(9)), ("a.ru", "dead", at(-3))],  # one comes back, an older entry changes nothing
        [("e.ru", "found", at(70))],
        [("f.ru", "found", at(71))],
    ]
    held = []
    for rows in runs:
        stream = keyed.remembered(feed(spark, rows, schema, f"{tmp_path}/in"), {"found": 60, "none": 14}, 7)
        query = keyed.run(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
        query.awaitTermination(120)
        assert query.exception() is None
        held.append({(r["host"], r["status"]) for r in keyed.stored(spark, f"{tmp_path}/checkpoint").collect()})
    assert held[0] == {("a.ru", "found"), ("b.ru", "dead"), ("c.ru", "none"), (None, "dead")}
    assert ("b.ru", "dead") not in held[1] and (None, "dead") not in held[1] and ("d.ru", "found") in held[1]
    assert ("b.ru", "none") in held[2] and ("a.ru", "found") in held[2]
    assert held[-1] == {("e.ru", "found"), ("f.ru", "found")}
    gone = {r["host"] for r in spark.read.parquet(f"{tmp_path}/out").filter("not alive").collect()}
    assert gone == {"a.ru", "b.ru", "c.ru", "d.ru", None}


def test_breaker_on_a_stream_equals_the_windows(spark, tmp_path):
    rnd = random.Random(4)
    statuses = ["ok", "empty", "timeout", "markup_error", "search_no_results", "blocked", "search_timeout"]
    weights = [[8, 3, 1, 0, 1, 0, 0], [1, 9, 0, 0, 0, 0, 0], [3, 1, 3, 1, 1, 0, 1], [1, 0, 2, 2, 0, 0, 1], [9, 1, 0, 0, 0, 0.3, 0]]
    events = [(run, k, rnd.choices(statuses, weights[run % 5])[0]) for k in range(120) for run in range(12)]
    schema = "run long, at long, status string"
    expected = {tuple(r) for r in signals.breaker(spark.createDataFrame(events, schema), ["run"], ["at"]).collect()}
    cuts = [0, *sorted(rnd.sample(range(1, len(events)), 3)), len(events)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        part = events[a:b]
        rnd.shuffle(part)
        query = keyed.run(keyed.tripped(feed(spark, part, schema, f"{tmp_path}/in"), ["at"]), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
        query.awaitTermination(120)
        assert query.exception() is None
    found = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select("run", "seq", "reason").collect()]
    assert len(found) == len(set(found)) and set(found) == expected and len({r for *_, r in found}) >= 3


def test_novelty_in_batch_and_on_a_stream(spark, tmp_path):
    known = state.named(spark.createDataFrame([("OSM", "1", "Салон «Лотос»", "г. Ялта"), ("VK", "", "Мотор", "Керчь")], "source string, source_id string, name string, city string"))
    schema = "k long, name string, city string, source string, source_id string"
    probes = [(1, "x", "y", "osm", "1"), (2, "салон лотос", "Ялта", "", ""), (3, "салон лотос", "Ялта", "OSM", "2"), (4, "мотор", "керчь", "VK", ""), (5, "Мотор", "Ялта", None, None), (6, None, None, None, None)]
    seen = {1: True, 2: True, 3: False, 4: True, 5: False, 6: False}
    assert {r["k"]: r["seen"] for r in state.novel(spark.createDataFrame(probes, schema), known).collect()} == seen
    query = state.novel(feed(spark, probes, schema, f"{tmp_path}/in"), known).select("k", F.col("seen")).writeStream.format("memory").queryName("novelty").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {r["k"]: r["seen"] for r in spark.table("novelty").collect()} == seen
