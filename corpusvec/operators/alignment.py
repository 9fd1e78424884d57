"""Keeping vectors, chunks and metadata aligned by vector id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = ("vectors", "chunks", "metadata")


def align_triple(vectors: DataFrame, chunks: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row per vector id that all three parts share."""
    return vectors.join(chunks, "vec_id").join(metadata, "vec_id")


def alignment_audit(
    vectors: DataFrame, chunks: DataFrame, metadata: DataFrame
) -> DataFrame:
    """Ids that are missing, or there more than once, in one of the parts.

    One aggregation over the three id columns: only ids travel, and each task
    has already added up its own before they do.
    """
    parts = (vectors, chunks, metadata)
    ids = None
    for position, part in enumerate(parts):
        flags = [
            F.lit(1 if position == i else 0).alias(f"in_{name}")
            for i, name in enumerate(PARTS)
        ]
        marked = part.select("vec_id", *flags)
        ids = marked if ids is None else ids.unionByName(marked)
    columns = [f"in_{name}" for name in PARTS]
    counted = ids.groupBy("vec_id").agg(*(F.sum(c).alias(c) for c in columns))
    wrong = F.lit(False)
    for c in columns:
        wrong = wrong | (F.col(c) != 1)
    return counted.filter(wrong)


def _part_counts(
    vectors: DataFrame, chunks: DataFrame, metadata: DataFrame, extra: DataFrame | None, name: str
) -> DataFrame:
    """One row: size of each part, and the one number in ``extra`` as ``name``."""
    tagged = None
    for position, part in enumerate((vectors, chunks, metadata)):
        sized = part.select(F.lit(position).alias("part"), F.lit(None).cast("long").alias("n"))
        tagged = sized if tagged is None else tagged.unionAll(sized)
    if extra is not None:
        number = F.col(extra.columns[0]).cast("long")
        tagged = tagged.unionAll(extra.select(F.lit(len(PARTS)), number))
    counts = [
        F.count_if(F.col("part") == i).alias(f"n_{part}") for i, part in enumerate(PARTS)
    ]
    if extra is not None:
        counts.append(F.max("n").alias(name))
    return tagged.agg(*counts)


def integrity_gate(
    vectors: DataFrame,
    chunks: DataFrame,
    metadata: DataFrame,
    expected_chunks: DataFrame | None = None,
) -> DataFrame:
    """One row with the counts and PASSED or FAILED.

    ``expected_chunks`` is an optional one-row DataFrame whose first column is
    the number of chunks that should be there.
    """
    counts = _part_counts(vectors, chunks, metadata, expected_chunks, "n_expected")
    ok = (F.col("n_vectors") == F.col("n_chunks")) & (
        F.col("n_vectors") == F.col("n_metadata")
    )
    if expected_chunks is not None:
        ok = ok & (F.col("n_vectors") == F.col("n_expected"))
    return counts.withColumn(
        "status", F.when(F.coalesce(ok, F.lit(False)), "PASSED").otherwise("FAILED")
    )


class IntegrityError(RuntimeError):
    """The parts of an index do not fit together."""


def require_passed(gate: DataFrame) -> dict:
    """Run the gate; its row if it passed, an error if not."""
    row = gate.first().asDict()
    if row["status"] != "PASSED":
        raise IntegrityError(f"integrity gate failed: {row}")
    return row


def require_counts(
    n_vectors: int, n_chunks: int, n_metadata: int, n_expected: int | None = None
) -> None:
    """The same gate over counts that are known already; an error if they differ."""
    counts = {"n_vectors": n_vectors, "n_chunks": n_chunks, "n_metadata": n_metadata}
    if n_expected is not None:
        counts["n_expected"] = n_expected
    if len(set(counts.values())) != 1:
        raise IntegrityError(f"integrity gate failed: {counts}")


def manifest_match(
    summary: DataFrame, vectors: DataFrame, chunks: DataFrame, metadata: DataFrame
) -> DataFrame:
    """One row: do the counts agree with each other and with the manifest?"""
    declared = summary.select("total_vectors")
    counts = _part_counts(vectors, chunks, metadata, declared, "n_declared")
    return counts.select(
        "*",
        (F.col("n_vectors") == F.col("n_chunks")).alias("chunks_match"),
        (F.col("n_vectors") == F.col("n_declared")).alias("manifest_matches"),
        (F.col("n_vectors") == F.col("n_metadata")).alias("metadata_match"),
    )
