"""Dense global row numbers without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from corpusvec.session import settle

# Fixed value: vectors in a shard.
SHARD_VECTORS = 200_000
# Vectors per part file; keeps a file of 1024-dimensional entries well below
# the 2 GB a binary column can hold.
FILE_VECTORS = 50_000


def whole_parts(number: Column, size: int) -> Column:
    """Integer division; exact for any BIGINT."""
    return F.call_function("div", number, F.lit(size))


def spread(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Repartition by key into the configured number of partitions.

    A number given outright is kept: what follows is heavy for its bytes, and
    merging partitions by size would leave it to a few tasks.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


KEYS = ("file_index", "row", "chunk")


def _can_hash(kind: ST.DataType) -> bool:
    if isinstance(kind, ST.ArrayType):
        return _can_hash(kind.elementType)
    if isinstance(kind, ST.StructType):
        return all(_can_hash(f.dataType) for f in kind)
    return not isinstance(kind, (ST.MapType, ST.VariantType))


def _places(keys: tuple[str, ...]) -> list[str]:
    """The columns that say where a source row stands, all but the last key; never NULL."""
    return [name for i in range(len(keys) - 1) for name in (f"_known{i}", f"_key{i}")] + ["_extra"]


def _placed(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``df`` with its places.

    A NULL key comes before all others.  Rows that lack a key are told apart, and spread, by
    a hash of what they hold.
    """
    contents = F.xxhash64(*(f.name for f in df.schema if _can_hash(f.dataType)))
    placed, lacking = df, F.lit(False)
    for i, key in enumerate(keys[:-1]):
        kind = df.schema[key].dataType
        least = F.lit("") if isinstance(kind, ST.StringType) else F.lit(0).cast(kind)
        placed = placed.withColumns(
            {f"_known{i}": F.col(key).isNotNull(), f"_key{i}": F.coalesce(F.col(key), least)}
        )
        lacking = lacking | F.col(key).isNull()
    return placed.withColumn("_extra", F.when(lacking, contents).otherwise(F.lit(0).cast("long")))


def row_sizes(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """How many rows of ``df`` each source row has, as its place and ``_n``; stored."""
    places = _places(keys)
    return settle(_placed(df, keys).groupBy(*places).agg(F.count(F.lit(1)).alias("_n")), "row-sizes")


def running_offsets(sizes: DataFrame) -> DataFrame:
    """Rows before each source row, from ``row_sizes``: its place and ``_offset``.

    Places are dealt into ranges of even numbers of them.  Sums run inside each range and
    over the ranges, of which there are as many as shuffle partitions.
    """
    places = [c for c in sizes.columns if c != "_n"]
    n = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settle(
        sizes.repartitionByRange(n, *places).withColumn("_range", F.spark_partition_id()), "row-ranges"
    )
    before = Window.unboundedPreceding
    outer = Window.orderBy("_range").rowsBetween(before, -1)
    inner = Window.partitionBy("_range").orderBy(*places).rowsBetween(before, -1)
    totals = (
        ranged.groupBy("_range")
        .agg(F.sum("_n").alias("_total"))
        .select("_range", F.coalesce(F.sum("_total").over(outer), F.lit(0)).alias("_before"))
    )
    return ranged.join(F.broadcast(totals), "_range").select(
        *places, (F.coalesce(F.sum("_n").over(inner), F.lit(0)) + F.col("_before")).alias("_offset")
    )


def assign_vec_ids(
    df: DataFrame,
    keys: tuple[str, ...] = KEYS,
    out: str = "vec_id",
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Number the rows from 0 in the order of the keys, (file, row, chunk), without gaps.

    Every source row gets the number of rows before it, from sums over a table
    with one small row each; its own rows are ranked among themselves.  The data
    itself is shuffled once, by source row, so neither a large file nor a file of long
    rows is the work of one task.  ``sizes`` is ``row_sizes`` of the same rows, if known.
    """
    places = _places(keys)
    if sizes is None:
        sizes = row_sizes(df, keys)
    rank = Window.partitionBy(*places).orderBy(keys[-1])
    # The hint keeps the data where it is and makes the offsets the table that
    # is looked up, one partition at a time.
    offsets = running_offsets(sizes).hint("shuffle_hash")
    return (
        spread(_placed(df, keys), *places)
        .withColumn("_rank", F.row_number().over(rank))
        .join(offsets, places)
        .withColumn(out, F.col("_offset") + F.col("_rank") - 1)
        .select(out, *df.columns)
    )


def shard_of(vec_id: Column, shard_size: int = SHARD_VECTORS) -> Column:
    return whole_parts(vec_id, shard_size).cast("int")


def cluster_by_runs(
    df: DataFrame, shard_size: int = SHARD_VECTORS, run_size: int = FILE_VECTORS
) -> DataFrame:
    """Bring runs of consecutive ids together, in order.

    All runs have the same length, so no partition is larger than the others.
    """
    shard = shard_of(F.col("vec_id"), shard_size)
    run = whole_parts(F.col("vec_id") % shard_size, run_size)
    return spread(df, shard, run).sortWithinPartitions("vec_id")


def sample_limit(df: DataFrame, n: int, order: str = "vec_id") -> DataFrame:
    """The first ``n`` rows in id order; each task keeps at most ``n``."""
    return df.orderBy(order).limit(n)
