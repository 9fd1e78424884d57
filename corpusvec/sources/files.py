"""Reading corpora, with every row's file and position in it."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import batched
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusvec.operators.ordinals import spread
from corpusvec.session import broadcast_if_small, settle

# The file kinds of a corpus directory, by suffix.
LINES, TABLES = "jsonl", "parquet"
KINDS = (LINES, TABLES)

# Footers read at a time.
FOOTER_THREADS = 16
# Files up to this size are read whole for their footers.
SMALL_FILE = 4 << 20
# Fixed value: where Spark keeps the schema that it wrote a file with.
_ROW_METADATA = b"org.apache.spark.sql.parquet.row.metadata"
# Names and bytes of texts that a task holds at a time.
NAMES_HELD, TEXT_BYTES_HELD = 1 << 16, 8 << 20
# Fixed value: the characters that Spark gives as %XX in a file's name.
_ENCODED = re.compile(
    r'[\0- "#%<>?\[\\\]^`{|}\x7f-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]'
)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark names it, and the path in it."""
    if path.startswith("file:"):
        path = f"file:///{path.removeprefix('file:').lstrip('/')}"
    return fs.FileSystem.from_uri(path)


def discover_files(
    spark: SparkSession, path: str, kinds: tuple[str, ...] = KINDS
) -> DataFrame:
    """``source, kind, file_index`` of the corpus files directly in ``path``.

    The index is the position in name order, and empty files count.  Spark's
    own listing of the directory is used; no file is opened.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.{" + ",".join(kinds) + "}")
        .load(path)
        .inputFiles()
    )
    names = sorted(unquote(file.rsplit("/", 1)[1]) for file in listing)
    rows = [(name, name.rsplit(".", 1)[1], i) for i, name in enumerate(names)]
    return spark.createDataFrame(rows, "source string, kind string, file_index int")


def _with_file_index(rows: DataFrame, files: DataFrame) -> DataFrame:
    indexed = broadcast_if_small(files.select("source", "file_index"))
    return rows.join(indexed, "source")


# Line files ----------------------------------------------------------------


def with_line_numbers(lines: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Number the lines of every file from 0, without shuffling them.

    Expects ``source``, ``_split`` (where the file split starts) and
    ``_position``, the scan's ``monotonically_increasing_id``.  A line's number
    is its place in its split plus the lines of the splits before.  Only one row
    per split is shuffled; those are counted once, kept, and looked up.  ``files``
    adds the file index on the way.  Should the two passes over the scan disagree
    on the splits, the job fails rather than lose lines.
    """
    splits = lines.groupBy("source", "_split").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_position").alias("_first")
    )
    before = (
        Window.partitionBy("source")
        .orderBy("_split")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = splits.select(
        "source",
        "_split",
        "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    if files is not None:
        starts = starts.join(files.select("source", "file_index"), "source")
    number = F.col("_before") + F.col("_position") - F.col("_first")
    checked = F.when(
        number.isNull() | (number < 0),
        F.raise_error(F.lit("file splits changed between passes")).cast("long"),
    ).otherwise(number)
    kept = broadcast_if_small(settle(starts, "splits"))
    return (
        lines.join(kept, ["source", "_split"], "left")
        .withColumn("row", checked)
        .drop("_split", "_first", "_before", "_position")
    )


def _lines(spark: SparkSession, path: str, glob: str) -> DataFrame:
    # The id has to sit right above the scan to follow the file order.
    return spark.read.option("pathGlobFilter", glob).text(path).select(
        "value",
        F.col("_metadata.file_name").alias("source"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_position"),
    )


def parse_lines(spark: SparkSession, line: Column) -> Column:
    """JSON lines as VARIANT, read as leniently as common parsers do.

    Of a repeated key the last value counts, which is a setting of the session;
    lines with NaN or Infinity are read by the slower parser that knows them.
    NULL if a line is no JSON.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    text = F.trim(line)
    lenient = F.from_json(text, "variant", {"allowNonNumericNumbers": "true"})
    return F.coalesce(F.try_parse_json(text), F.when(text.rlike("NaN|Infinity"), lenient))


def scan_jsonl(
    spark: SparkSession,
    path: str,
    files: DataFrame | None = None,
    suffix: str = LINES,
) -> DataFrame:
    """``value, v, source, file_index, row`` of the line files in ``path``.

    ``v`` is the parsed line as VARIANT and NULL if the line is not JSON; such
    lines keep their numbers and can be quarantined.
    """
    if files is None:
        files = discover_files(spark, path, (suffix, TABLES))
    return with_line_numbers(_lines(spark, path, f"*.{suffix}"), files).select(
        "value",
        parse_lines(spark, F.col("value")).alias("v"),
        "source",
        "file_index",
        "row",
    )


# Parquet files -------------------------------------------------------------


def with_row_numbers(scan: DataFrame) -> DataFrame:
    """Add ``source`` and ``row`` to a Parquet scan, from the file's own index."""
    return scan.select(
        "*",
        F.col("_metadata.file_name").alias("source"),
        F.col("_metadata.row_index").alias("row"),
    )


def scan_parquet(
    spark: SparkSession, path: str, columns: list[str] | None = None
) -> DataFrame:
    """The Parquet rows in ``path``; unnamed columns are not read."""
    scan = spark.read.parquet(path)
    return scan if columns is None else scan.select(*columns)


def footer_hashes(spark: SparkSession, path: str, max_bytes: int = SMALL_FILE) -> DataFrame:
    """``source, footer`` of the Parquet files in ``path`` of at most ``max_bytes``.

    Files with one footer hash have one schema.  Tasks read the footers, of files that
    are small enough to be read whole; it is NULL where a footer could not be told.
    """

    def hashed(content: bytes) -> str | None:
        try:
            found = pq.ParquetFile(pa.BufferReader(content))
            said = (found.metadata.metadata or {}).get(_ROW_METADATA, b"")
            columns = [found.schema.column(i) for i in range(len(found.schema))]
            told = [
                (c.path, c.physical_type, str(c.logical_type), c.length, c.precision, c.scale,
                 c.max_definition_level, c.max_repetition_level)
                for c in columns
            ]
            return hashlib.sha256(repr(told).encode() + b"\0" + said).hexdigest()
        except (pa.ArrowException, OSError):
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            footers = [hashed(content.as_py()) for content in batch.column("content")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("source"), pa.array(footers, pa.string())], ["source", "footer"]
            )

    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{TABLES}").load(path)
    small = files.filter(F.col("length") <= max_bytes)
    named = small.select(F.col("_metadata.file_name").alias("source"), "content")
    return named.mapInArrow(run, "source string, footer string")


def _scans_by_schema(
    spark: SparkSession, path: str, names: list[str], max_bytes: int = SMALL_FILE
) -> list[DataFrame]:
    """The named Parquet files, one scan per distinct schema.

    Files of a directory may differ in columns and in their types, so none is
    read with another's schema.  Of small files, one of every footer is asked for its
    schema; the others, of which a directory has fewer for its bytes, are each.
    """
    alike: dict[str, list[str]] = {}
    wanted = set(names)
    for row in footer_hashes(spark, path, max_bytes).filter(F.col("footer").isNotNull()).collect():
        if row["source"] in wanted:
            alike.setdefault(row["footer"], []).append(row["source"])
            wanted.discard(row["source"])
    asked = [*(sorted(group) for group in alike.values()), *([name] for name in sorted(wanted))]

    def schema_of(group: list[str]) -> tuple[str, list[str]]:
        return spark.read.parquet(f"{path.rstrip('/')}/{group[0]}").schema.json(), group

    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        for schema, group in pool.map(schema_of, asked):
            groups.setdefault(schema, []).extend(f"{path.rstrip('/')}/{name}" for name in group)
    return [
        spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(*paths)
        for schema, paths in groups.items()
    ]


def scan_directory(spark: SparkSession, path: str, line_suffix: str = LINES) -> DataFrame:
    """``v, source, file_index, row`` of a directory of JSONL and Parquet files."""
    files = discover_files(spark, path, (line_suffix, TABLES))
    kinds = {r["kind"] for r in files.select("kind").distinct().collect()}
    parts = []
    if line_suffix in kinds:
        parts.append(scan_jsonl(spark, path, files, line_suffix).drop("value"))
    if TABLES in kinds:
        names = [r["source"] for r in files.filter(F.col("kind") == TABLES).collect()]
        for scan in _scans_by_schema(spark, path, names):
            record = F.to_variant_object(F.struct(*scan.columns)).alias("v")
            place = (F.col("_metadata.file_name").alias("source"), F.col("_metadata.row_index").alias("row"))
            rows = widen(scan.select(record, *place), "row")
            parts.append(_with_file_index(rows, files).select("v", "source", "file_index", "row"))
    if not parts:
        raise FileNotFoundError(f"no corpus files in {path}")
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def widen(scan: DataFrame, key: str) -> DataFrame:
    """Spread a scan with fewer partitions than cores over all of them.

    A small file, or one with a single row group, would otherwise leave the
    work on its text to one task.  A scan that is wide enough is not shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, key)


def count_rows_per_file(scan: DataFrame) -> DataFrame:
    """``source, rows`` of a file scan; no data column is read."""
    return scan.groupBy(F.col("_metadata.file_name").alias("source")).agg(
        F.count(F.lit(1)).alias("rows")
    )


# Splits, shards and plain text ---------------------------------------------


def split_by_file_range(df: DataFrame, start: int, end: int) -> DataFrame:
    """The rows of files ``start`` up to, not including, ``end``."""
    return df.filter((F.col("file_index") >= start) & (F.col("file_index") < end))


def split_of_file(file_index: Column, files_per_split: int) -> Column:
    return F.call_function("div", file_index, F.lit(files_per_split)).cast("int")


def concat_shards(
    spark: SparkSession, root: str, shards: list[str], pattern: str = "wiki_*"
) -> DataFrame:
    """``shard, value``: the lines of the named sub-directories.

    A sub-directory that is not there contributes nothing.
    """
    path = f"{root.rstrip('/')}/{{{','.join(shards)}}}/{pattern}"
    return spark.read.text(path).select(
        F.element_at(F.split("_metadata.file_path", "/"), -2).alias("shard"), "value"
    )


def shard_line_counts(lines: DataFrame) -> DataFrame:
    """Lines per shard and, where the shard is NULL, in all."""
    return lines.rollup("shard").agg(F.count(F.lit(1)).alias("lines"))


def scan_text_dir(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, text``: one document per ``.txt`` file, named after it; empty files have none.

    The directory is listed by a task, into a table of names, and the files are opened where
    their names were dealt to, so the driver holds nothing for each file.  A listing is read a
    little at a time from a local or mounted file system; for other stores Arrow holds the
    names of one directory in that task.  Paths that only Spark can open are read by Spark,
    whose driver lists all files, as are patterns and directories with partitions.
    """
    folder = arrow_folder(spark, path)
    if folder is not None:
        listed = text_names(spark, folder)
        if listed.filter("partition").isEmpty():
            read = spread(listed.select("name"), "name").mapInArrow(
                _text_reader(folder), "doc_id string, content binary"
            )
            return read.select("doc_id", F.col("content").cast("string").alias("text"))
    read = spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    return spread(
        read.select(F.col("_metadata.file_name").alias("doc_id"), F.col("value").alias("text")), "doc_id"
    )


def arrow_folder(spark: SparkSession, path: str) -> str | None:
    """The directory as Arrow can open it; None if it is none or only Spark can."""
    if set(path) & set("*?[{\\"):
        return None
    context = spark.sparkContext
    try:
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        store = folder.getFileSystem(context._jsc.hadoopConfiguration())
        if not store.getFileStatus(folder).isDirectory():
            return None
        uri = store.makeQualified(folder).toUri()
        where = uri.getPath() if uri.getScheme() == "file" else uri.toString()
        found, root = opened(where)
        return where if found.get_file_info(root).type == fs.FileType.Directory else None
    except (Py4JJavaError, pa.ArrowException, OSError):
        return None


def text_names(spark: SparkSession, folder: str) -> DataFrame:
    """``name, partition``: the ``.txt`` files of a directory that Arrow can open; stored.

    A directory that Spark would take for a partition is among them, and marked.
    """
    one = spark.range(0, 1, 1, 1)
    return settle(one.mapInArrow(_text_lister(folder), "name string, partition boolean"), "text-names")


def _children(store: fs.FileSystem, root: str) -> Iterator[tuple[str, bool, bool]]:
    """The name of everything directly in a directory, and whether it is a file or a directory."""
    if isinstance(store, fs.LocalFileSystem):
        with os.scandir(root) as entries:
            for entry in entries:
                yield entry.name, entry.is_file(), entry.is_dir()
    else:
        for info in store.get_file_info(fs.FileSelector(root)):
            yield info.base_name, info.type == fs.FileType.File, info.type == fs.FileType.Directory


def _text_lister(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The ``.txt`` files that Spark would read, and the directories it would take for partitions.

    One task does it, as a directory can only be read from its beginning; it holds few names.
    """

    def found() -> Iterator[tuple[str, bool]]:
        for name, is_file, is_folder in _children(*opened(folder)):
            hidden = name.startswith(".") or (name.startswith("_") and "=" not in name)
            if not hidden and (is_file and name.endswith(".txt") or is_folder and "=" in name):
                yield name, is_folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            for some in batched(found(), NAMES_HELD):
                names, folders = zip(*some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(folders, pa.bool_())], ["name", "partition"]
                )

    return run


def _text_reader(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The files of the names, by the name and with the bytes that Spark gives them."""

    def batch_of(rows: list[tuple[str, bytes]]) -> pa.RecordBatch:
        ids, contents = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.string()), pa.array(contents, pa.binary())], ["doc_id", "content"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(folder)
        rows, held = [], 0
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with store.open_input_file(f"{root.rstrip('/')}/{name}") as file:
                    content = file.read()
                if content:
                    rows.append((_ENCODED.sub(lambda c: quote(c[0], safe=""), name), content))
                    held += len(content)
                if held >= TEXT_BYTES_HELD or len(rows) >= NAMES_HELD:
                    yield batch_of(rows)
                    rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return run
