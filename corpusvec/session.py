"""Session helpers: shared scratch space and size-checked broadcasts."""

from __future__ import annotations

import uuid
from functools import cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

CHECKPOINT_CONF = "spark.checkpoint.dir"
WAREHOUSE_CONF = "spark.sql.warehouse.dir"

# Largest side that is ever broadcast on purpose, in rows and in bytes.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 200 << 20
# What a row takes beside its texts and lists, roughly.
_ROW_BYTES = 16


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a session on one machine may go without; its warehouse has to do.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    return spark.conf.get(WAREHOUSE_CONF, None).rstrip("/")


@cache
def _session_folder(root: str, application: str) -> str:
    """This session's part of the shared folder; it goes when the driver ends."""
    folder = f"{root}/corpusvec/{application}"
    context = SparkContext._active_spark_context
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; every run gets its own."""
    folder = _session_folder(shared_root(spark), spark.sparkContext.applicationId)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Compute a small table once: written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bytes_of(field: ST.StructField) -> Column:
    """About how many bytes a value takes: its own width, or that of its text."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (ST.StringType, ST.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(field.dataType, (ST.ArrayType, ST.StructType, ST.MapType)):
        return F.coalesce(F.octet_length(value.cast("string")), F.lit(0))
    return F.lit(8)


def broadcast_if_small(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Hint a broadcast only after measuring; past a bound Spark picks the join.

    Measuring stops at ``max_rows + 1`` rows, so it stays cheap on a large input.
    """
    size = F.lit(_ROW_BYTES)
    for field in df.schema:
        size = size + _bytes_of(field)
    found = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")).first()
    if found["n"] <= max_rows and (found["bytes"] or 0) <= max_bytes:
        return F.broadcast(df)
    return df
