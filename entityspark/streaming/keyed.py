"""State per key that Spark's state store keeps between batches: entries that expire by their status, and a breaker that
latches. Both survive a restart from their checkpoint and may see their input cut into batches in any way."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from entityspark.operators.signals import DETAILS, FAILURES, WALLS

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package

DAY_MS = 86_400_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Entries(StatefulProcessor):
    """The latest entry of a host, until the watermark passes the days its status is good for."""

    def __init__(self, days: dict[str, int], otherwise: int):
        self.days, self.otherwise = days, otherwise

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", "status string, checked long, expires long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        latest = None
        for batch in rows:
            own = batch.sort_values(["checked_ms", "status"]).iloc[-1]
            if latest is None or (own["checked_ms"], own["status"]) > latest:
                latest = (int(own["checked_ms"]), str(own["status"]))
        held = self.entry.get() if self.entry.exists() else None
        if held and (held[1], held[0]) >= latest:
            return
        checked, status = latest
        expires = checked + self.days.get(status, self.otherwise) * DAY_MS
        if held:
            self.handle.deleteTimer(held[2])
        if expires <= timerValues.getCurrentWatermarkInMs():
            self.entry.clear()
            if held:
                yield self.row(key, held[0], held[1], False)
            return
        self.entry.update((status, checked, expires))
        self.handle.registerTimer(expires)
        yield self.row(key, status, checked, True)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.entry.exists():
            status, checked, expires = self.entry.get()
            if expires <= expiredTimerInfo.getExpiryTimeInMs():
                self.entry.clear()
                yield self.row(key, status, checked, False)

    def row(self, key: tuple, status: str, checked: int, alive: bool) -> pd.DataFrame:
        return pd.DataFrame({"host": [key[0]], "status": [status], "checked_at": [pd.Timestamp(checked, unit="ms")], "alive": [alive]})

    def close(self) -> None:
        pass


class Breaker(StatefulProcessor):
    """``signals.breaker`` one attempt at a time: the last statuses, failures in a row, walls, and whether it is off."""

    def __init__(self, order: list[str], last: int, failed: float, empty: float, walls: int, in_a_row: int):
        self.order, self.last, self.failed, self.empty, self.most_walls, self.in_a_row = order, last, failed, empty, walls, in_a_row
        self.failures, self.details, self.wall = set(FAILURES), set(DETAILS), set(WALLS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", "status string")
        self.counts = handle.getValueState("counts", "seq long, in_a_row int, walls int, latched boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seq, in_a_row, walls, latched = self.counts.get() if self.counts.exists() else (0, 0, 0, False)
        if latched:
            return
        recent = [r[0] for r in self.recent.get()] if self.recent.exists() else []
        for status in pd.concat(list(rows)).sort_values(self.order, kind="stable")["status"]:
            seq, recent = seq + 1, [*recent, status][-self.last :]
            in_a_row = 0 if status in ("ok", "empty", "search_no_results") else in_a_row + (status in self.failures)
            walls += status in self.wall
            if reason := self.reason(status, recent, in_a_row, walls):
                self.counts.update((seq, in_a_row, walls, True))
                self.recent.clear()
                yield pd.DataFrame({"run": [key[0]], "seq": [seq], "reason": [reason]})
                return
        self.counts.update((seq, in_a_row, walls, False))
        self.recent.put([(s,) for s in recent])

    def reason(self, status: str, recent: list[str], in_a_row: int, walls: int) -> str:
        least, details = min(10, self.last), [s for s in recent if s in self.details]
        if walls >= self.most_walls:
            return f"yandex_{status}"
        if in_a_row >= self.in_a_row:
            return "consecutive_detail_failures"
        if len(recent) >= least and sum(s in self.failures for s in recent) >= self.failed * len(recent):
            return "high_detail_failure_ratio"
        if len(details) >= least and details.count("empty") >= self.empty * len(details):
            return "high_empty_detail_ratio"
        return ""

    def close(self) -> None:
        pass


def remembered(entries: DataFrame, days: dict[str, int], otherwise: int, late: str = "0 seconds") -> DataFrame:
    """(host, status, checked_at, alive) of a stream of (host, status, checked_at timestamp): a row when an entry is stored,
    and one when the watermark of checked_at has passed its days. Of one batch the latest entry of a host counts; older ones
    than the stored entry change nothing, and what is not after the watermark is late and left out. Null hosts are a host; rows without a time or status are left out."""
    rows = entries.filter("checked_at IS NOT NULL AND status IS NOT NULL").select("host", "status", "checked_at").withWatermark("checked_at", late)
    rows = rows.withColumn("checked_ms", F.unix_millis("checked_at"))
    return rows.groupBy("host").transformWithStateInPandas(Entries(days, otherwise), "host string, status string, checked_at timestamp, alive boolean", "Update", "EventTime")


def tripped(attempts: DataFrame, order: list[str], last: int = 20, failed: float = 0.5, empty: float = 0.8, walls: int = 1, in_a_row: int = 6) -> DataFrame:
    """(run, seq, reason) once for each run that goes off, of a stream of (run, status, order columns). Batches follow each
    other in order; within one, rows are put in order. A run that is off stays off."""
    return attempts.select("run", "status", *order).groupBy("run").transformWithStateInPandas(Breaker(order, last, failed, empty, walls, in_a_row), "run long, seq long, reason string", "Update", "None")


def run(stream: DataFrame, changes: str, checkpoint: str):
    """Start a stream over what is there; each batch writes its rows, and writes them anew if it is run again."""
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)

    def step(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes}/batch={number}")

    try:
        return stream.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def stored(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(host, status, checked_at) of the entries that are in the state now, read from the store and not from past changes."""
    rows = spark.read.format("statestore").option("stateVarName", "entry").load(checkpoint)
    return rows.select(F.col("key.host").alias("host"), F.col("value.status").alias("status"), F.timestamp_millis("value.checked").alias("checked_at"))
