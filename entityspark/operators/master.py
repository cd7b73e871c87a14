"""From observations of many runs to one row an entity: the master, and the quarantine of clusters without an anchor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.operators import golden, resolve
from entityspark.operators.identity import complete, loaded

QUARANTINE_REASON = "vk_missing_primary_segment_signal"


def observations(files: DataFrame) -> DataFrame:
    """One row an observation from the rows of all result files; row_idx gives the order in which they are read."""
    return golden.refreshed(loaded(files))


def clustered(rows: DataFrame) -> DataFrame:
    """The rows with their cluster."""
    return rows.join(resolve.resolved(resolve.prepared(complete(rows))), "row_idx")


def build(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(master, quarantine) of result rows: load, refresh, resolve, one golden record a cluster with its provenance."""
    placed = clustered(observations(files))
    records = golden.golden(placed).join(golden.provenance_json(placed), "cluster")
    return records.filter("anchored").drop("anchored"), records.filter("not anchored").drop("anchored").withColumn("quarantine_reason", F.lit(QUARANTINE_REASON))
