"""Adding new files to an index as they arrive, each exactly once.

The stream's checkpoint remembers the files it has seen.  A batch writes to a
directory named after its number and overwrites it, so a replayed batch leaves
the same rows behind once.  Rows are keyed by batch, file, row and chunk; dense
vector ids are only given when the increments are published, which adds the new
batches behind those published before.  Records that cannot be used are kept, with
the reason.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST
from pyspark.sql.streaming import StreamingQuery

from corpusvec.operators import quality as Q
from corpusvec.operators.embed import Embedder, embed_chunks
from corpusvec.operators.ordinals import SHARD_VECTORS, assign_vec_ids, shard_of
from corpusvec.plans.build import assemble_records, documents_to_chunks
from corpusvec.sinks.artifacts import now
from corpusvec.sinks.publish import publish_verified
from corpusvec.sources.files import LINES, parse_lines, with_line_numbers
from corpusvec.sources.index_store import Index, load_index, newest_run

# The source would otherwise pass over files a week older than the newest one.
ANY_AGE = "36500d"

PROGRESS_SCHEMA = "batch_id BIGINT, vectors BIGINT, rows BIGINT, rejected BIGINT, timestamp STRING"


def incremental_index(
    spark: SparkSession,
    source_path: str,
    path: str,
    checkpoint: str,
    kind: str,
    embedder: Embedder,
    file_format: str = "jsonl",
    schema: ST.StructType | None = None,
    line_suffix: str = LINES,
    max_files_per_batch: int = 1000,
) -> StreamingQuery:
    """Start a query that indexes all files not seen yet, then stops.

    ``file_format`` is jsonl, or parquet with the files' ``schema``.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_batch).option(
        "maxFileAge", ANY_AGE
    )
    if file_format == "jsonl":
        stream = (
            reader.format("text")
            .option("pathGlobFilter", f"*.{line_suffix}")
            .load(source_path)
            .select(
                "value",
                F.col("_metadata.file_name").alias("source"),
                F.col("_metadata.file_block_start").alias("_split"),
            )
        )
        records = _line_records
    elif file_format == "parquet":
        stream = (
            reader.format("parquet")
            .schema(schema)
            .option("pathGlobFilter", "*.parquet")
            .load(source_path)
            .select(
                F.to_variant_object(F.struct(*schema.names)).alias("v"),
                F.col("_metadata.file_name").alias("source"),
                F.col("_metadata.row_index").alias("row"),
            )
        )
        records = _same
    else:
        raise ValueError(f"unknown file format: {file_format}")
    return (
        stream.writeStream.foreachBatch(_batch_writer(path, kind, embedder, records))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _same(batch: DataFrame) -> DataFrame:
    return batch


def _line_records(batch: DataFrame) -> DataFrame:
    placed = batch.withColumn("_position", F.monotonically_increasing_id())
    return with_line_numbers(placed).select(
        parse_lines(batch.sparkSession, F.col("value")).alias("v"), "value", "source", "row"
    )


def _batch_writer(
    path: str,
    kind: str,
    embedder: Embedder,
    records: Callable[[DataFrame], DataFrame],
) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Rows are counted on their way to the entries.
        seen = Observation()
        parsed = records(batch).observe(seen, F.count(F.lit(1)).alias("rows"))
        good, bad = Q.quarantine_malformed(parsed, kind)
        chunks = documents_to_chunks(assemble_records(good, kind))
        entries = embed_chunks(chunks, embedder)
        at = f"{path}/increments/batch_id={batch_id}"
        entries.write.mode("overwrite").parquet(at)
        apart = f"{path}/rejected/batch_id={batch_id}"
        bad.write.mode("overwrite").parquet(apart)
        row = (
            batch_id,
            spark.read.parquet(at).count(),
            seen.get["rows"],
            spark.read.parquet(apart).count(),
            now(),
        )
        (
            spark.createDataFrame([row], PROGRESS_SCHEMA)
            .coalesce(1)
            .write.mode("overwrite")
            .json(f"{path}/progress/batch={batch_id}")
        )

    return write


def increments(spark: SparkSession, path: str) -> DataFrame:
    """Everything the committed batches have added.

    A batch counts once its progress row is there; until then its directory may
    be half written.
    """
    committed = _progress(spark, path).select("batch_id")
    added = spark.read.parquet(f"{path}/increments")
    return added.join(committed, "batch_id", "left_semi")


def rejects(spark: SparkSession, path: str) -> DataFrame:
    """Source, row and reason of every record the committed batches set aside."""
    committed = _progress(spark, path).select("batch_id")
    apart = spark.read.parquet(f"{path}/rejected")
    return apart.join(committed, "batch_id", "left_semi")


def _progress(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(PROGRESS_SCHEMA).json(f"{path}/progress/*")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], PROGRESS_SCHEMA)


def progress_log(
    spark: SparkSession, path: str, shard_size: int = SHARD_VECTORS
) -> DataFrame:
    """One row per committed batch, with running totals.

    The running sum orders one row per batch.
    """
    log = _progress(spark, path)
    so_far = Window.orderBy("batch_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    total = F.sum("vectors").over(so_far)
    return log.select(
        "batch_id",
        total.alias("vectors_count"),
        shard_of(total, shard_size).alias("shard_index"),
        (total % shard_size).alias("shard_vectors"),
        F.sum("rows").over(so_far).alias("rows_processed"),
        "rejected",
        "timestamp",
    )


def number_increments(
    spark: SparkSession, path: str, after_batch: int = -1, first_file: int = 0
) -> DataFrame:
    """The batches after a given one under dense vector ids, in (batch, file name, row) order.

    Files are numbered from ``first_file`` by batch and name; the listing has one
    row per file.
    """
    added = increments(spark, path).filter(F.col("batch_id") > after_batch)
    order = Window.orderBy("batch_id", "source")
    files = (
        added.select("batch_id", "source")
        .distinct()
        .withColumn("file_index", F.row_number().over(order) + F.lit(first_file - 1))
    )
    return assign_vec_ids(added.join(files, ["batch_id", "source"])).drop("batch_id")


def publish_increments(
    spark: SparkSession,
    path: str,
    dataset: str,
    model: str,
    dimension: int,
    source_path: str = "",
    shard_size: int = SHARD_VECTORS,
) -> Index:
    """Add the batches not yet published to the index at the same path, verified.

    What was published stays where it is; new entries get the ids behind it.
    Without new batches the index stays as it is.
    """
    previous = newest_run(spark, path)
    published, first_id, first_file = -1, 0, 0
    if previous is not None:
        published = previous["through_batch"]
        if published is None:
            raise ValueError(f"the index at {path} was not published from increments")
        before = load_index(spark, path)
        first_id = before.summary.first()["total_vectors"]
        first_file = (before.entries.agg(F.max("file_index")).first()[0] or 0) + 1
    newest = _progress(spark, path).agg(F.max("batch_id")).first()[0]
    if previous is not None and newest <= published:
        return before
    numbered = number_increments(spark, path, published, first_file)
    new = increments(spark, path).filter(F.col("batch_id") > published)
    return publish_verified(
        spark,
        numbered.withColumn("vec_id", F.col("vec_id") + first_id),
        path,
        dataset=dataset,
        model=model,
        dimension=dimension,
        source_path=source_path,
        expected_chunks=new.agg(F.count(F.lit(1)).alias("n_expected")),
        shard_size=shard_size,
        previous=previous,
        through_batch=newest,
        resume_mode=True,
    )
