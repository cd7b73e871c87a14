"""Observation state over runs: first and last sighting and how often, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entityspark.functions import text
from entityspark.operators import identity


def sightings(observations: DataFrame) -> DataFrame:
    """(observation_id, first_seen, last_seen, seen_count) of one run."""
    return observations.groupBy("observation_id").agg(F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("last_seen"), F.count("*").alias("seen_count"))


def upsert(state: DataFrame, observations: DataFrame) -> DataFrame:
    """The state after a run: the first sighting is kept, the last one moves on, counts add up."""
    return state.unionByName(sightings(observations)).groupBy("observation_id").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("seen_count").alias("seen_count"))


def fresh(state: DataFrame, now: str, days: dict[str, int], otherwise: int) -> DataFrame:
    """Rows younger than the days their status is good for. Columns: status, checked_at."""
    good = F.lit(otherwise)
    for status, n in days.items():
        good = F.when(F.col("status") == status, n).otherwise(good)
    return state.filter(F.to_timestamp("checked_at") > F.to_timestamp(F.lit(now)) - F.make_dt_interval(good))


def run_updates(observations: DataFrame, changes: str, checkpoint: str):
    """Keep the state of a stream in Spark's state store; each batch writes only the rows that it changed. A batch that is run
    again writes its own rows anew."""
    state = observations.groupBy("observation_id").agg(F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("last_seen"), F.count("*").alias("seen_count"))

    def step(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes}/batch={number}")

    return state.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state of ``run_updates`` after its last batch, read from the state store; past changes are not read."""
    rows = spark.read.format("statestore").load(checkpoint)
    return rows.select(F.col("key.observation_id").alias("observation_id"), F.col("value.min").alias("first_seen"), F.col("value.max").alias("last_seen"), F.col("value.count").alias("seen_count"))


def named(observations: DataFrame) -> DataFrame:
    """(observation_id, name_norm, city_norm) of observations, by which later ones are known again."""
    return identity.complete(observations).select(identity.observation_id().alias("observation_id"), text.normal_text(F.col("name")).alias("name_norm"), text.normal_city(F.col("city")).alias("city_norm"))


def novel(probes: DataFrame, known: DataFrame) -> DataFrame:
    """The probes (name, city, source, source_id; further columns stay) with ``seen``: whether ``known`` (see ``named``) has
    them. Those with a source or an id of it are looked up by observation id, others by name and city. Probes may be a
    stream, ``known`` is a snapshot; it is reduced to its distinct keys, so no probe is repeated. Nulls count as empty."""
    given = (F.col("source") != "") | (F.col("source_id") != "")
    blank = {c: text.blank(F.col(c)) for c in ("name", "city", "source", "source_id")}
    key = F.when(given, F.concat(F.lit("id|"), probe_id())).otherwise(F.concat_ws("|", F.lit("name"), text.normal_text(F.col("name")), text.normal_city(F.col("city"))))
    keys = known.select(F.explode(F.array(F.concat(F.lit("id|"), F.col("observation_id")), F.concat_ws("|", F.lit("name"), "name_norm", "city_norm"))).alias("__known")).distinct()
    keyed = probes.withColumns(blank).withColumn("__key", key)
    return keyed.join(keys, F.col("__key") == F.col("__known"), "left").withColumn("seen", F.col("__known").isNotNull()).drop("__key", "__known")


def probe_id() -> Column:
    """The observation id of a name, city, source and source id."""
    source = F.coalesce(F.nullif(F.lower(text.one_space(F.col("source"))), F.lit("")), F.lit("unknown"))
    own = F.trim(F.col("source_id"))
    material = F.when(own != "", F.concat_ws("|", F.lit("source-id"), source, own)).otherwise(F.concat_ws("|", F.lit("minimal"), source, text.normal_text(F.col("name")), text.normal_city(F.col("city")), F.lit("")))
    return F.concat(F.lit("obs_"), F.substring(F.sha2(material, 256), 1, 24))
