"""What the operators share: scratch tables in the cluster's shared folder, row ids, slices of Arrow batches."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java's spelling of the white space that the text operators agree on: space and the controls from tab to carriage return.
SPACE = "[\\x20\\x09-\\x0D]"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``). Where it is unset, as in tests, a session in one
    process gets a temporary folder, removed at its end; on a cluster that is an error."""
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.entityspark.scratch", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: the executors need a folder that all of them share")
        folder = tempfile.mkdtemp(prefix="entityspark-")
        atexit.register(shutil.rmtree, folder, True)
        where = f"file://{folder}"
        spark.conf.set("spark.entityspark.scratch", where)
    return where.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder, with further options of the Parquet writer, and read it back.

    It cuts the lineage with a table that survives lost executors. The shuffle files behind the write are no longer
    needed then, so Spark is asked to remove them.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.options(**{"compression": "zstd"} | options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized table that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


class settings:
    """Session settings that hold for a block of code."""

    def __init__(self, spark: SparkSession, values: dict[str, str]):
        self.spark, self.values = spark, values

    def __enter__(self):
        self.before = {k: self.spark.conf.get(k, None) for k in self.values}
        for k, v in self.values.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *_):
        for k, v in self.before.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns, so that further ones can't clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array without nulls, and the n+1 offsets into them."""
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with at most ``most`` bytes in a text column, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = utf8(batch.column(column))
        row = 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
            yield batch.slice(row, end - row)
            row = end
