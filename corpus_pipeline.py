"""A training corpus from the documents: toxicity, line dedup, near-duplicates, mixture, sequences.

Each stage works on all that the one before kept. Stages are written as Parquet to the cluster's shared folder and read
again, so a lost executor costs the running stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityspark.llm import linedup, mixing, packing, simhash, toxicity
from entityspark.llm.common import materialize
from entityspark.llm.queries import SEED, WEIGHTS, domain, tokenizer_files

#: Documents that score this or more are rejected.
TOXIC = 0.7
#: Lines of this Jaccard similarity are one line.
SIMILAR = 0.8
#: The share of the tokens left that the mixture takes, in one epoch.
SHARE = 0.8


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean(docs, model, TOXIC)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that resemble an earlier one go; n_chars follows."""
    found = linedup.dedup_lines(docs, SIMILAR, counts=False)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*[F.col(f"`{n}`") for n in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash links stays."""
    return simhash.representatives(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents up to the budgets of their domain, language and source stay."""
    return mixing.mixed_rows(docs, domain(), WEIGHTS, SHARE, 1, SEED)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.packed(docs, **tokenizer_files())


STAGES = [("toxicity", clean), ("line dedup", lines), ("near-duplicates", near), ("mixture", mixture), ("packing", sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    found = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        found = materialize(stage(spark, found, sf_dir), f"stage-{name.replace(' ', '-')}")
    return found


#: The toxicity model, the fingerprints and the tokenizer can't be said in SQL.
ORACLE_SQL = None
