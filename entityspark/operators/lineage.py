"""Where iterative work cuts its lineage: tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCRATCH = "spark.entityspark.cuts"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a session in one process gets a temporary folder where it is unset, removed at its end. On a
    cluster that is an error."""
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(SCRATCH, None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: the executors need a folder that all of them share")
        folder = tempfile.mkdtemp(prefix="entityspark-")
        atexit.register(shutil.rmtree, folder, True)
        where = f"file://{folder}"
        spark.conf.set(SCRATCH, where)
    return where.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a written table, so that a lost executor costs a running task only. Unlike checkpoint() it computes ``df``
    once, and the plan does not keep the constraints of what came before, which double in every round of a loop."""
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
