"""Reading published indexes.

An index lives below one root:

    runs/<run>/entries/shard_id=<n>/   vectors, texts and provenance, one table
    runs/<run>/files/                  one row per file of entries: its ids, rows and bytes
    runs/<run>/postings/               one bitmap per label and file, if labels were named
    runs/<run>/summary/                the manifest, one JSON row
    published/v<version>.json          a small pointer, one for each published version

Readers follow the newest pointer, so they only ever see runs that
were complete and verified.  A pointer names the parts of the index in the order of
their ids.  A part is a run, of this index or another, and what is added to its ids as
they are read: an index that grew has the runs of all its increments, and a merged one
has the runs of its splits where they are.  Nothing is rewritten for either.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusvec.session import broadcast_if_small, settle

_PART = (
    "STRUCT<path: STRING, run: STRING, id_offset: BIGINT, split_id: INT, "
    "first_id: BIGINT, entries: BIGINT, dense: BOOLEAN>"
)
POINTER_SCHEMA = (
    f"version BIGINT, run STRING, parts ARRAY<{_PART}>, through_batch BIGINT, published_at STRING"
)
_NOT_METADATA = ("vec_id", "shard_id", "vector", "text")

# Files that are named one by one; more hits than that are met by a join over all.
MAX_FILES = 10_000
# Ids to a step when files and ids are brought together.
ID_STEP = 32_768


class IndexNotFound(FileNotFoundError):
    """Nothing was published below the given root."""


@dataclass(frozen=True)
class Part:
    """A run, and where its entries stand in an index.

    ``id_offset`` is added to its ids; these are ``first_id`` and so on without a gap if it
    is ``dense``.
    """

    path: str
    run: str
    id_offset: int
    split_id: int | None
    first_id: int
    entries: int
    dense: bool

    @property
    def root(self) -> str:
        return run_path(self.path, self.run)


@dataclass(frozen=True)
class Index:
    """A published index: its parts, their entries as one table, and its manifest."""

    path: str
    run: str
    parts: tuple[Part, ...]
    entries: DataFrame
    summary: DataFrame

    @property
    def shard_size(self) -> int:
        return self.summary.first()["shard_size"]

    @property
    def vectors(self) -> DataFrame:
        return self.entries.select("vec_id", "vector")

    @property
    def chunks(self) -> DataFrame:
        return self.entries.select("vec_id", "text")

    @property
    def metadata(self) -> DataFrame:
        kept = [c for c in self.entries.columns if c not in _NOT_METADATA]
        return self.entries.select("vec_id", *kept)

    @property
    def dense(self) -> bool:
        """Whether the ids are 0 and so on without a gap."""
        following = 0
        for part in self.parts:
            if not part.dense or (part.entries and part.first_id + part.id_offset != following):
                return False
            following += part.entries
        return True

    @property
    def files(self) -> DataFrame:
        """``part, file, first_id, last_id, entries, bytes`` of every file, by the index's ids."""
        return _table(self, "files").withColumns(
            {c: F.col(c) + F.col("id_offset") for c in ("first_id", "last_id")}
        ).drop("id_offset")


def run_path(path: str, run: str) -> str:
    return f"{path.rstrip('/')}/runs/{run}"


def newest_run(spark: SparkSession, path: str) -> dict | None:
    """The newest pointer, or None if nothing was published."""
    try:
        pointers = spark.read.schema(POINTER_SCHEMA).json(f"{path.rstrip('/')}/published")
        row = pointers.orderBy(F.desc("version")).first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return None if row is None else row.asDict(recursive=True)


def load_index(spark: SparkSession, path: str) -> Index:
    newest = newest_run(spark, path)
    if newest is None:
        raise IndexNotFound(path)
    parts = tuple(Part(**p) for p in newest["parts"])
    scans = [_scan(spark, part, [f"{part.root}/entries"]) for part in parts]
    summary = spark.read.json(f"{run_path(path, newest['run'])}/summary")
    return Index(path, newest["run"], parts, _union(scans), summary)


def _union(tables: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _scan(spark: SparkSession, part: Part, paths: Sequence[str]) -> DataFrame:
    """Entries of a part under the index's ids; only the numbers differ from what is stored."""
    entries = spark.read.option("basePath", f"{part.root}/entries").parquet(*paths)
    if part.id_offset:
        entries = entries.withColumn("vec_id", F.col("vec_id") + part.id_offset)
    if part.split_id is not None:
        entries = entries.withColumn("split_id", F.lit(part.split_id))
    return entries


def _table(index: Index, name: str) -> DataFrame:
    """A side table of all parts, with ``part`` and ``id_offset``."""
    spark = index.entries.sparkSession
    return _union(
        spark.read.parquet(f"{part.root}/{name}").select(
            "*", F.lit(n).alias("part"), F.lit(part.id_offset).cast("long").alias("id_offset")
        )
        for n, part in enumerate(index.parts)
    )


# Reading a few of many files ---------------------------------------------------


def _entries_in(index: Index, files: DataFrame, max_files: int) -> DataFrame | None:
    """The entries in ``files`` (``part, file``); None if these are too many to name."""
    spark = index.entries.sparkSession
    named = files.select("part", "file").distinct().limit(max_files + 1).collect()
    if len(named) > max_files:
        return None
    by_part: dict[int, list[str]] = {}
    for row in named:
        by_part.setdefault(row["part"], []).append(f"{index.parts[row['part']].root}/entries/{row['file']}")
    if not by_part:
        return index.entries.limit(0)
    return _union(_scan(spark, index.parts[n], sorted(paths)) for n, paths in sorted(by_part.items()))


def entries_with_ids(index: Index, ids: DataFrame, max_files: int = MAX_FILES) -> DataFrame:
    """The entries of the files that may have one of the ``vec_id`` of ``ids``.

    Files and ids meet in steps of ``ID_STEP`` ids, so this is an equi-join over one row
    per file.  With more than ``max_files`` of them, these are all entries.
    """
    steps = F.sequence(F.floor(F.col("first_id") / ID_STEP), F.floor(F.col("last_id") / ID_STEP))
    stepped = index.files.select("part", "file", "first_id", "last_id", F.explode(steps).alias("step"))
    wanted = ids.select(F.col("vec_id"), F.floor(F.col("vec_id") / ID_STEP).alias("step"))
    met = stepped.join(wanted, "step").filter(F.col("vec_id").between(F.col("first_id"), F.col("last_id")))
    found = _entries_in(index, met, max_files)
    return index.entries if found is None else found


def lookup(index: Index, hits: DataFrame, max_files: int = MAX_FILES) -> DataFrame:
    """The hits with the text and provenance of the entries they name; no vector is read.

    Text is read from files with a hit only.  A hit without an entry stays, with NULLs.
    """
    hits = settle(hits, "hits")
    wanted = settle(hits.select("vec_id").distinct(), "hit-ids")
    entries = entries_with_ids(index, wanted, max_files).drop("vector", "shard_id")
    found = entries.join(broadcast_if_small(wanted), "vec_id", "left_semi")
    return hits.join(found, "vec_id", "left")


def label_postings(entries: DataFrame, labels: Sequence[str]) -> DataFrame:
    """``label, value, file, step, bits``: for every value of the label columns, the rows of
    each file that have it, as bitmaps of ``ID_STEP`` rows each.

    A label column has one value or a list of them.  Only label columns are read.
    """
    tagged = None
    for label in labels:
        listed = F.col(label)
        if not entries.schema[label].dataType.typeName() == "array":
            listed = F.array(listed)
        one = entries.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("at"),
            F.lit(label).alias("label"),
            F.explode(F.array_distinct(listed.cast("array<string>"))).alias("value"),
        )
        tagged = one if tagged is None else tagged.union(one)
    # Buckets and positions of bitmaps count from 1 and from 0.
    number = F.col("at") + 1
    return (
        tagged.filter(F.col("value").isNotNull())
        .select("label", "value", "file", F.bitmap_bucket_number(number).alias("step"), F.bitmap_bit_position(number).alias("bit"))
        .groupBy("label", "value", "file", "step")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )


def has_value(entries: DataFrame, label: str, value: str) -> Column:
    """Whether a row's label column is, or has among its values, the value."""
    column = F.col(label)
    if entries.schema[label].dataType.typeName() == "array":
        return F.coalesce(F.array_contains(column.cast("array<string>"), value), F.lit(False))
    return F.coalesce(column.cast("string") == value, F.lit(False))


def labelled(
    index: Index,
    all_of: Sequence[tuple[str, str]] = (),
    any_of: Sequence[tuple[str, str]] = (),
    max_files: int = MAX_FILES,
) -> DataFrame:
    """The entries that have all of the first labels and, if any are given, one of the second.

    Labels are pairs of column and value.  Their bitmaps are merged before any entry is
    read: only files with a row that meets the condition are.
    """
    entries = index.entries
    condition = F.lit(True)
    postings = _table(index, "postings")
    steps = None
    for labels, merge, least in ((all_of, F.bitmap_and_agg, len(set(all_of))), (any_of, F.bitmap_or_agg, 1)):
        if not labels:
            continue
        tests = [has_value(entries, *pair) for pair in labels]
        wanted = reduce(Column.__or__, [(F.col("label") == c) & (F.col("value") == v) for c, v in labels])
        condition = condition & reduce(Column.__and__ if labels is all_of else Column.__or__, tests)
        merged = (
            postings.filter(wanted)
            .groupBy("part", "file", "step")
            .agg(merge("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= least)
            .select("part", "file", "step", "bits")
        )
        steps = merged if steps is None else steps.union(merged).groupBy("part", "file", "step").agg(
            F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n")
        ).filter("n = 2").drop("n")
    if steps is None:
        return entries
    found = _entries_in(index, steps.filter(F.bitmap_count("bits") > 0), max_files)
    return (entries if found is None else found).filter(condition)


def pointer_row(
    version: int, run: str, parts: Sequence[Part], through_batch: int | None, published_at: str
) -> dict:
    return {
        "version": version,
        "run": run,
        "parts": [asdict(p) for p in parts],
        "through_batch": through_batch,
        "published_at": published_at,
    }
