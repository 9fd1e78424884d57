"""Publishing an index only once it is complete and verified."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from corpusvec.functions import vectors as V
from corpusvec.operators.alignment import IntegrityError, require_counts
from corpusvec.operators.embed import vector_figures
from corpusvec.operators.ordinals import FILE_VECTORS, SHARD_VECTORS, cluster_by_runs
from corpusvec.sinks.artifacts import now, summary_row, write_summary, write_vector_shards
from corpusvec.sources.index_store import (
    Index,
    Part,
    label_postings,
    load_index,
    newest_run,
    pointer_row,
    run_path,
)


def publish_verified(
    spark: SparkSession,
    entries: DataFrame,
    path: str,
    dataset: str,
    model: str,
    dimension: int,
    source_path: str = "",
    expected_chunks: DataFrame | None = None,
    shard_size: int = SHARD_VECTORS,
    clustered: bool = False,
    previous: dict | None = None,
    through_batch: int | None = None,
    labels: Sequence[str] = (),
    **extra: str | int | float | bool | None,
) -> Index:
    """Stage the entries, check them, then let readers see them.

    Staging has a directory of its own per run, so no run finds another's
    files.  The figures that the gate looks at are observed on the rows as they are
    written; afterwards only the ids are read, once, for the table of files, and its
    rows have to be as many.  A failing check raises and publishes nothing.
    ``labels`` are columns that searches are restricted by; they get postings.
    ``previous`` is the pointer of an index that the entries are added to; their ids
    go on where its ids end, and its runs stay as they are.
    """
    run = uuid.uuid4().hex
    at = run_path(path, run)
    if not clustered:
        entries = cluster_by_runs(entries, shard_size, FILE_VECTORS)
    seen = Observation()
    write_vector_shards(_observed(entries, seen), f"{at}/entries", shard_size=shard_size, clustered=True)
    part = _described(spark, path, run, shard_size)
    _require_verified(seen.get, part, dimension, expected_chunks)
    if labels:
        staged = spark.read.parquet(f"{at}/entries")
        postings = label_postings(staged, labels)
        (
            postings.withColumn("file", _below(at))
            .repartitionByRange("label", "value")
            .sortWithinPartitions("label", "value")
            .write.parquet(f"{at}/postings")
        )
    parts, before = [part], 0
    if previous is not None:
        parts = [*(Part(**p) for p in previous["parts"]), part]
        before = sum(p.entries for p in parts[:-1])
    summary = summary_row(
        entries, dataset, source_path, model, dimension, True, before + part.entries, shard_size=shard_size, **extra
    )
    write_summary(summary, f"{at}/summary")
    publish_parts(spark, path, run, parts, previous, through_batch)
    return load_index(spark, path)


def _observed(entries: DataFrame, seen: Observation) -> DataFrame:
    """The entries; what the gate has to know is summed up where they are written."""
    norm = entries.withColumn("_norm", V.l2_norm(F.col("vector")))
    return norm.observe(
        seen,
        F.count("vector").alias("n_vectors"),
        F.count("text").alias("n_chunks"),
        F.count("source").alias("n_metadata"),
        *vector_figures(F.size("vector"), F.col("_norm")),
    ).drop("_norm")


def _below(at: str) -> Column:
    """A file's path below the entries of a run."""
    return F.substring_index(F.col("file"), f"{at.rsplit('/', 1)[-1]}/entries/", -1)


def _described(spark: SparkSession, path: str, run: str, shard_size: int) -> Part:
    """Write the table of files of a staged run; the run as a part of an index."""
    at = run_path(path, run)
    staged = spark.read.parquet(f"{at}/entries")
    files = (
        staged.groupBy(F.col("_metadata.file_path").alias("file"), "shard_id")
        .agg(
            F.min("vec_id").alias("first_id"),
            F.max("vec_id").alias("last_id"),
            F.count(F.lit(1)).alias("entries"),
            F.sum(F.col("vec_id").cast("decimal(38,0)")).alias("sum"),
            F.max("_metadata.file_size").alias("bytes"),
        )
        .withColumn("file", _below(at))
    )
    # Ids without a gap: inside every file, from file to file of a shard, and from shard to shard.
    gapless = (
        (F.col("last_id") - F.col("first_id") + 1 == F.col("entries"))
        & (2 * F.col("sum") == (F.col("first_id") + F.col("last_id")).cast("decimal(38,0)") * F.col("entries"))
    )
    files.select("file", "shard_id", "first_id", "last_id", "entries", "bytes", gapless.alias("gapless")).write.parquet(
        f"{at}/files"
    )
    stored = spark.read.parquet(f"{at}/files")
    earlier = F.lag("last_id").over(Window.partitionBy("shard_id").orderBy("first_id", "last_id"))
    ends = stored.agg(
        F.min("first_id").alias("first"), F.max("last_id").alias("last"), F.coalesce(F.sum("entries"), F.lit(0)).alias("entries")
    ).first()
    first, last = ends["first"] or 0, ends["last"] if ends["last"] is not None else -1
    expected = F.coalesce(earlier + 1, F.greatest(F.lit(first), F.col("shard_id") * F.lit(shard_size).cast("long")))
    gaps = stored.withColumn("expected", expected).filter(
        ~F.col("gapless") | (F.col("first_id") != F.col("expected"))
    )
    dense = last - first + 1 == ends["entries"] and gaps.isEmpty()
    return Part(path.rstrip("/"), run, 0, None, first, ends["entries"], dense)


def _require_verified(seen: dict, part: Part, dimension: int, expected_chunks: DataFrame | None) -> None:
    expected = None if expected_chunks is None else expected_chunks.first()[0]
    require_counts(seen["n_vectors"], seen["n_chunks"], seen["n_metadata"], expected)
    if part.entries != seen["vectors"]:
        raise IntegrityError(f"{seen['vectors']} entries were written, {part.entries} are there")
    wrong = seen["null_vectors"] or seen["wrong_norms"]
    if seen["vectors"] and (wrong or (seen["min_dim"], seen["max_dim"]) != (dimension, dimension)):
        raise IntegrityError(f"vectors do not match the declared form: {seen}")


def publish_parts(
    spark: SparkSession,
    path: str,
    run: str,
    parts: Sequence[Part],
    previous: dict | None = None,
    through_batch: int | None = None,
) -> None:
    """Write the pointer that lets readers see the parts, as the next version of the index.

    A version is a file that is put in its place whole and never over another, so of
    two writers who saw the same newest version one fails.  That needs a file system
    whose renaming is atomic.
    """
    newest = newest_run(spark, path)
    if previous is not None and (newest is None or newest["run"] != previous["run"]):
        raise IntegrityError(f"{path} was published anew while entries were added to it")
    version = 0 if newest is None else newest["version"] + 1
    write_pointer(spark, path, pointer_row(version, run, parts, through_batch, now()))


def write_pointer(spark: SparkSession, path: str, row: dict) -> None:
    """Put the pointer of a version in its place; an error if there is one."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{path.rstrip('/')}/published")
    target = hadoop.Path(folder, f"v{row['version']:012d}.json")
    written = hadoop.Path(folder, f".{row['run']}")
    conf = context._jsc.hadoopConfiguration()
    out = folder.getFileSystem(conf).create(written, False)
    out.write(bytearray(json.dumps(row).encode()))
    out.close()
    files = hadoop.FileContext.getFileContext(folder.getFileSystem(conf).makeQualified(folder).toUri(), conf)
    try:
        files.rename(written, target, context._gateway.new_array(hadoop.Options.Rename, 0))
    except Py4JJavaError as e:
        files.delete(written, False)
        if "AlreadyExists" in e.java_exception.getClass().getName():
            raise IntegrityError(f"version {row['version']} of {path} was published by another writer") from e
        raise
