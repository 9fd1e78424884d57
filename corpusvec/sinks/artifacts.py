"""Single artifacts: chunk and metadata lines, vector shards, manifests."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import suppress
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusvec.operators.assemble import chunk_metadata
from corpusvec.operators.ordinals import (
    FILE_VECTORS,
    SHARD_VECTORS,
    cluster_by_runs,
    shard_of,
    spread,
    whole_parts,
)
from corpusvec.session import settle
from corpusvec.sources.files import arrow_folder, opened, text_names

INDEX_TYPE = "exact inner product"

# Files up to this size are digested whole; larger ones by ranges, read in pieces.
WHOLE_BYTES = 1 << 30
RANGE_BYTES, READ_BYTES = 256 << 20, 8 << 20


def _in_id_order(df: DataFrame, total: int | None) -> DataFrame:
    """A partition for every run of ``FILE_VECTORS`` ids, in order.

    Ids are dense, so a row's id says where it goes and nothing has to be sampled.
    """
    if total is None:
        total = (df.agg(F.max("vec_id")).first()[0] or 0) + 1
    run = whole_parts(F.col("vec_id"), FILE_VECTORS).cast("int")
    return df.repartitionById(max(1, -(-total // FILE_VECTORS)), run).sortWithinPartitions("vec_id")


def write_chunks(df: DataFrame, path: str, total: int | None = None) -> None:
    """JSON lines ``{"text": ...}``; part files and lines are in id order.

    ``total`` is the number of rows; without it, the ids are read once more.
    """
    _in_id_order(df.select("vec_id", "text"), total).select("text").write.json(path)


def write_metadata(df: DataFrame, path: str, total: int | None = None) -> None:
    """JSON lines of provenance, in the same order as the chunks."""
    _in_id_order(chunk_metadata(df), total).drop("vec_id").write.json(path)


def write_lines(df: DataFrame, path: str) -> int:
    """Both kinds of lines below ``path``, as ``chunks`` and ``metadata``; the number of rows.

    The rows are computed once, and stored for the second pass.
    """
    stored = settle(df.select("text", *chunk_metadata(df).columns), "lines")
    total = stored.count()
    write_chunks(stored, f"{path.rstrip('/')}/chunks", total)
    write_metadata(stored, f"{path.rstrip('/')}/metadata", total)
    return total


def write_texts(df: DataFrame, path: str, text: str = "text", suffix: str = ".txt") -> None:
    """A file in ``path`` for every row, with its text as the only line; a NULL text is empty.

    Files are named by partition and position, so a task that runs again writes the same
    ones, if its rows come in the same order again, as those of a scan do.  A file gets its
    name once it is complete.  Arrow writes them: it needs no process for each, and leaves
    the driver none to move.
    """
    context = df.sparkSession.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).mkdirs(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = opened(path)
        task, written = TaskContext.get(), 0
        for batch in batches:
            for value in batch.column(0).cast(pa.large_binary()):
                name = f"part-{task.partitionId():05d}-{written:09d}{suffix}"
                hidden = f"{root.rstrip('/')}/.{name}.{task.taskAttemptId()}"
                with target.open_output_stream(hidden) as out:
                    out.write((value.as_py() or b"") + b"\n")
                target.move(hidden, f"{root.rstrip('/')}/{name}")
                written += 1
        yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], ["written"])

    counted = df.select(F.col(text).cast("string")).mapInArrow(run, "written long")
    counted.agg(F.sum("written")).collect()


def remove_texts(spark: SparkSession, path: str) -> None:
    """Remove the ``.txt`` files in ``path``, as ``write_texts`` leaves them.

    Tasks do it: a driver that removes a directory holds the names of all its files.  What
    else is in the directory stays, and so does one that only Spark can open.
    """
    folder = arrow_folder(spark, path)
    if folder is None:
        return

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = opened(folder)
        removed = 0
        for batch in batches:
            for name in batch.column("name").to_pylist():
                # A task that ran before may have removed it.
                with suppress(FileNotFoundError):
                    target.delete_file(f"{root.rstrip('/')}/{name}")
                    removed += 1
        yield pa.RecordBatch.from_arrays([pa.array([removed], pa.int64())], ["removed"])

    names = text_names(spark, folder).filter("NOT partition").select("name")
    spread(names, "name").mapInArrow(run, "removed long").agg(F.sum("removed")).collect()


def write_vector_shards(
    df: DataFrame,
    path: str,
    shard_size: int = SHARD_VECTORS,
    file_vectors: int = FILE_VECTORS,
    clustered: bool = False,
) -> None:
    """Parquet below ``shard_id=<n>``, sorted by id; all shards full but the last.

    ``clustered`` says that runs of consecutive ids are together already.
    """
    if not clustered:
        df = cluster_by_runs(df, shard_size, file_vectors)
    (
        df.withColumn("shard_id", shard_of(F.col("vec_id"), shard_size))
        .sortWithinPartitions("shard_id", "vec_id")
        .write.partitionBy("shard_id")
        .option("maxRecordsPerFile", file_vectors)
        .parquet(path)
    )


def now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")


def summary_row(
    entries: DataFrame,
    dataset: str,
    source_path: str,
    model: str,
    dimension: int,
    verified: bool,
    total: int | None = None,
    **extra: str | int | float | bool | None,
) -> DataFrame:
    """The manifest as a one-row DataFrame; its count comes from the entries, if not given."""
    # The manifest's field names and date format.
    fixed = {
        "dataset_name": dataset,
        "raw_dataset_path": source_path,
        "embedding_model": model,
        "embedding_dimension": dimension,
        "index_type": INDEX_TYPE,
        "date_completed": now(),
        "integrity_status": "VERIFIED" if verified else "UNVERIFIED",
        **extra,
    }
    if total is None:
        counted = entries.agg(F.count(F.lit(1)).alias("total_vectors"))
    else:
        counted = entries.sparkSession.range(1).select(F.lit(total).cast("long").alias("total_vectors"))
    return counted.select("*", *(F.lit(value).alias(name) for name, value in fixed.items()))


def write_summary(summary: DataFrame, path: str) -> None:
    summary.coalesce(1).write.json(path)


def artifact_manifest(
    spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """``artifact, file, bytes, sha256, ranges`` of every data file below ``path``.

    The artifact is the first directory below ``path``.  A file of more than
    ``whole_bytes``, which no cell could hold, is digested by ranges of ``range_bytes``, each a
    task's work: its digest is the SHA-256 of their digests, one behind the other, and
    ``ranges`` says how many there are.  Of other files, which have one, it is the plain SHA-256.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    )
    below = F.split("path", _quoted(path), 2)[1]
    named = (F.substring_index(below, "/", 1).alias("artifact"), below.alias("file"), F.col("length").alias("bytes"))
    whole = files.filter(F.col("length") <= whole_bytes).select(
        *named, F.sha2("content", 256).alias("sha256"), F.lit(1).alias("ranges")
    )
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))
    ranges = files.filter(F.col("length") > whole_bytes).select("path", "length", F.explode(starts).alias("start"))
    digested = spread(ranges, "path", "start").mapInArrow(
        _range_digester(range_bytes), "path string, length long, start long, digest binary"
    )
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("start", "digest"))), lambda r: r["digest"])
    large = digested.groupBy("path", "length").agg(ordered.alias("digests"))
    joined = F.aggregate("digests", F.lit("").cast("binary"), lambda all_, d: F.concat(all_, d))
    return whole.union(
        large.select(*named, F.sha2(joined, 256).alias("sha256"), F.size("digests").alias("ranges"))
    )


def _range_digester(range_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """SHA-256 of the range of a file that starts at ``start``, read a little at a time.

    The file is opened by Arrow, whose file systems can read from the middle of a file.
    """

    def digest(path: str, start: int) -> bytes:
        source, name = opened(path)
        found, left = hashlib.sha256(), range_bytes
        with source.open_input_file(name) as file:
            file.seek(start)
            while left and (piece := file.read(min(left, READ_BYTES))):
                found.update(piece)
                left -= len(piece)
        return found.digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [digest(p, s) for p, s in zip(*(batch.column(c).to_pylist() for c in ("path", "start")))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(digests, pa.binary())], [*batch.schema.names, "digest"]
            )

    return run


def _quoted(path: str) -> str:
    """A regular expression for the path without its scheme, and a slash."""
    bare = path.split(":", 1)[1].lstrip("/") if "://" in path else path.lstrip("/")
    return r"\Q" + bare.rstrip("/") + r"\E/"

