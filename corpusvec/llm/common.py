"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of anything but these six characters.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Text bytes that a Python worker takes up at a time.
SLICE_BYTES = 4 << 20


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores ahead as tell it from the columns."""
    taken, found = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text; NULL has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join by keys that may be NULL; the right side's keys are dropped."""
    others = unused([*left.columns, *right.columns], *keys)
    renamed = right.withColumnsRenamed(dict(zip(keys, others)))
    condition = None
    for k, other in zip(keys, others):
        equal = left[k].eqNullSafe(renamed[other])
        condition = equal if condition is None else condition & equal
    return left.join(renamed, condition, how).drop(*others)


# The bit map of a set: bits to a member, and bits in all (16 MB at most).
BITS_PER_MEMBER = 64
MIN_BITS, MAX_BITS = 1 << 16, 1 << 27


class BitMap:
    """A set of digests that tasks get as a whole; it may hold a few more than were put in.

    A digest sets the bit that its first bytes name.  With more members than there are bits
    for, more and more digests are held that were not put in: what it is asked for
    must only cost more then, never come out otherwise.
    """

    def __init__(self, members: DataFrame, column: str, max_bits: int = MAX_BITS):
        wanted = min(max(BITS_PER_MEMBER * members.count(), MIN_BITS), max_bits)
        self.bits = 1 << (wanted - 1).bit_length()
        number = F.conv(F.left(F.hex(column), F.lit(8)), 16, 10).cast("long") % self.bits
        words = (
            members.select(F.shiftright(number, 5).cast("int").alias("word"), (number % 32).cast("int").alias("bit"))
            .groupBy("word")
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("set"))
            .toArrow()
        )
        self.words = np.zeros(self.bits // 32, dtype=np.uint32)
        self.words[words["word"].to_numpy()] = words["set"].to_numpy().astype(np.uint32)

    def __contains__(self, digest: bytes) -> bool:
        at = int.from_bytes(digest[:4], "big") % self.bits
        return bool(self.words[at >> 5] >> np.uint32(at & 31) & np.uint32(1))

    def holds(self, digest: Column) -> Column:
        """Whether the digest of a row may be a member."""

        def run(digests: pa.Array) -> pa.Array:
            return pa.array([d is not None and d in self for d in digests.to_pylist()], pa.bool_())

        run.__annotations__ = {"digests": pa.Array, "return": pa.Array}
        return F.arrow_udf(run, "boolean")(digest)


def as_bytes(column: pa.Array) -> pa.Array:
    """A string column as plain binary, NULL as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary()).fill_null(b"")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``limit`` text bytes, or one row."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start = held = 0
    for at, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)
