"""Vectors as short codes: product quantisation in exact integers.

A component x becomes the integer ``floor(scale * x)``, and a vector is cut into equal
parts, each with a codebook of its own.  Rounds assign every part to its nearest entry
and move each entry to the floor of the mean of its parts.

Distances are exact.  ``|x - c|^2`` is ``|x|^2 - 2 x.c + |c|^2``, and the dot products of
many parts with all entries are one matrix product, which float64 BLAS does fastest.
To keep it exact, integers are split into limbs of ``limb_bits(width)`` bits with a sign,
such that a product of two limb matrices sums up to less than 2^53; the products are
put together in int64, with a shift for each pair of limbs.  A limb that is zero
everywhere is left out.  The first of the smallest distances wins, which is the tie
rule.  So neither the number nor the order of rows, tasks or threads changes a bit.

Tasks never hold more than a batch of vectors, and a round hands on at most one sum per
part and entry and task; sums over all rows are decimals, which cannot overflow.  Only the
codebooks, ``entries`` times the dimension, come to the driver and go out again.
The vectors are read ``rounds + 3`` times and never shuffled or rewritten.

Rows whose vector is NULL, or has a NULL or non-finite component, are dropped.  Shorter
vectors than the longest count as filled up with zeros, as does a dimension that the
parts do not divide; an empty vector is the origin.  Repeated rows are rows of their
own; the first entries are those of the smallest ``vec_id``, NULL last, then by vector.
With fewer rows than entries there are as many entries as rows.  Integers
must be small enough for a vector's squared distance to fit 62 bits (at 64 dimensions
a component of 524,288); beyond that the job fails before it starts.  Columns other
than ``vec_id``, ``label`` and the vector take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import null_safe_join
from corpusvec.session import broadcast_if_small, settle

# Fixed values.
SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2

# Vectors that are multiplied at a time.
BATCH_ROWS = 4096


class Codec(NamedTuple):
    """Codebooks as ``part, entry, position`` and the longest vector's length."""

    books: np.ndarray
    dim: int


# Exact products ------------------------------------------------------------------


def limb_bits(width: int) -> int:
    """Bits of a signed limb such that a sum of ``width`` products stays below 2^53."""
    # A limb is at most 2^(bits - 1) in size, a product of two 2^(2 bits - 2).
    return (54 - int(width).bit_length()) // 2


def limbs(values: np.ndarray, bits: int) -> list[tuple[int, np.ndarray]]:
    """``(shift, float64 limbs)`` whose shifted sum is ``values``; limbs of zeros are left out."""
    found, shift, half = [], 0, 1 << (bits - 1)
    while values.any():
        low = ((values + half) & ((1 << bits) - 1)) - half
        if low.any():
            found.append((shift, low.astype(np.float64)))
        values, shift = (values - low) >> bits, shift + bits
    return found


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right.T`` of int64 matrices, through float64 products of their limbs."""
    bits = limb_bits(left.shape[1])
    total = np.zeros((len(left), len(right)), dtype=np.int64)
    rights = limbs(right, bits)
    for shift, a in limbs(left, bits):
        for other, b in rights:
            total += (a @ b.T).astype(np.int64) << (shift + other)
    return total


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of each part, and its squared distance."""
    scores = (book * book).sum(axis=1) - 2 * exact_products(parts, book)
    code = scores.argmin(axis=1)
    return code, scores[np.arange(len(parts)), code] + (parts * parts).sum(axis=1)


def assign(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``row, part`` matrices of codes and squared distances."""
    parts = len(books)
    cut = vectors.reshape(len(vectors), parts, -1)
    found = [nearest(np.ascontiguousarray(cut[:, p]), books[p]) for p in range(parts)]
    return np.stack([c for c, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


# Vectors -------------------------------------------------------------------------


def valid(vector: Column) -> Column:
    """Whether a vector is there with all its components, and all are finite."""
    finite = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))
    )
    return F.coalesce(finite, F.lit(False))


def _integers(column: pa.Array, dim: int, scale: int) -> np.ndarray:
    """A list column as a matrix of ``floor(scale * x)``, short rows filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if (sizes == dim).all():
        return flat.astype(np.int64).reshape(-1, dim)
    wide = np.zeros((len(sizes), dim), dtype=np.int64)
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    wide[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - starts] = flat
    return wide


def _batches(
    batches: Iterator[pa.RecordBatch], column: str, dim: int, scale: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(at, BATCH_ROWS)
            yield part, _integers(part.column(column), dim, scale)


def _padded(dim: int, parts: int) -> int:
    return -(-max(dim, 1) // parts) * parts


# Training ------------------------------------------------------------------------


def _first_books(kept: DataFrame, column: str, dim: int, parts: int, entries: int, scale: int) -> np.ndarray:
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), column).select(column).limit(entries).collect()
    rows = np.zeros((len(first), dim), dtype=np.int64)
    for i, row in enumerate(first):
        rows[i, : len(row[0])] = np.floor(np.array(row[0], dtype=np.float64) * scale)
    return np.ascontiguousarray(rows.reshape(len(first), parts, -1).swapaxes(0, 1))


def _moved(kept: DataFrame, column: str, books: np.ndarray, scale: int) -> np.ndarray:
    """The codebooks after a round."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * entries, width), dtype=np.int64)
        counts = np.zeros(parts * entries, dtype=np.int64)
        for _, vectors in _batches(batches, column, parts * width, scale):
            codes, _ = assign(vectors, books)
            cut = vectors.reshape(len(vectors), parts, width)
            for p in range(parts):
                slots = slice(p * entries, (p + 1) * entries)
                counts[slots] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(sums[slots], codes[:, p], cut[:, p])
        used = np.flatnonzero(counts)
        offsets = pa.array(np.arange(len(used) + 1, dtype=np.int32) * width)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used.astype(np.int32)),
                pa.ListArray.from_arrays(offsets, pa.array(sums[used].ravel())),
                pa.array(counts[used]),
            ],
            ["slot", "sums", "n"],
        )

    partial = kept.select(column).mapInArrow(run, "slot int, sums array<long>, n long")
    totals = [F.sum(F.col("sums")[k].cast("decimal(20,0)")).alias(f"s{k}") for k in range(width)]
    moved = books.copy().reshape(parts * entries, width)
    for row in partial.groupBy("slot").agg(F.sum("n").alias("n"), *totals).collect():
        moved[row["slot"]] = [int(row[f"s{k}"]) // row["n"] for k in range(width)]
    return moved.reshape(books.shape)


def train(
    vectors: DataFrame,
    column: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codec | None:
    """Codebooks for ``vec_id`` and a vector column; None if no vector is valid."""
    kept = vectors.filter(valid(F.col(column))).select("vec_id", column)
    largest = F.array_max(F.transform(column, lambda x: F.abs(x).cast("double")))
    found = kept.agg(F.max(F.size(column)).alias("dim"), F.max(largest).alias("size")).first()
    if found["dim"] is None:
        return None
    dim = _padded(found["dim"], parts)
    reach = 2 * (int((found["size"] or 0.0) * scale) + 1)
    if dim * reach * reach >= 1 << 62:
        raise ValueError(f"components up to {found['size']} are too large for exact 64-bit distances")
    books = _first_books(kept, column, dim, parts, entries, scale)
    for _ in range(rounds):
        books = _moved(kept, column, books, scale)
    return Codec(books, dim)


# Encoding ------------------------------------------------------------------------


def encode(vectors: DataFrame, codec: Codec, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id, label, code, error`` of every valid vector: an index of two hex digits per
    part, and the squared distance in integers."""
    books, dim = codec

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, values in _batches(batches, column, dim, scale):
            codes, errors = assign(values, books)
            digits = codes.astype(np.uint8).tobytes().hex()
            size = 2 * len(books)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id"),
                    part.column("label"),
                    pa.array([digits[i : i + size] for i in range(0, len(digits), size)], pa.string()),
                    pa.array(errors.sum(axis=1)),
                ],
                ["vec_id", "label", "code", "error"],
            )

    kinds = {c: vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    return vectors.filter(valid(F.col(column))).select("vec_id", "label", column).mapInArrow(run, schema)


def decode(codes: DataFrame, codec: Codec, scale: int = SCALE) -> DataFrame:
    """The rows and columns of ``code`` and others, and ``decoded``: the entries' components."""
    books, _ = codec
    given = codes.drop("decoded")
    names = given.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digits = "".join(batch.column("code").to_pylist())
            index = np.frombuffer(bytes.fromhex(digits), np.uint8).reshape(-1, len(books))
            values = np.stack([books[p][index[:, p]] for p in range(len(books))], axis=1)
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * (len(books) * books.shape[2])
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel() / scale))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*names, "decoded"])

    schema = given.withColumn("decoded", F.lit(None).cast("array<double>")).schema
    return given.mapInArrow(run, schema)


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every valid vector."""
    codec = train(vectors, column)
    if codec is None:
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame(
            [], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string"
        )
    coded = settle(encode(vectors, codec, column), "codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    joined = null_safe_join(coded, broadcast_if_small(settle(by_label, "label-errors")), ["label"], "inner")
    return joined.select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(codec.books)).alias("codebooks_sha256")
    )


def sql(vectors: str = "embeddings", column: str = "embedding") -> str:
    """The same rows in DuckDB SQL."""

    def assigned(k: int) -> str:
        return f"""
    a{k} AS (
      SELECT r, part, best % {ENTRIES} AS e, best // {ENTRIES} AS d FROM (
        SELECT r, part, min(d * {ENTRIES} + e) AS best FROM (
          SELECT x.r, x.part, b.e, sum((x.x - b.x) * (x.x - b.x)) AS d
          FROM x JOIN b{k} b ON b.part = x.part AND b.pos = x.pos GROUP BY ALL)
        GROUP BY ALL))"""

    def moved(k: int) -> str:
        return f"""
    b{k + 1} AS (
      SELECT b.e, b.part, b.pos, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, b.x) AS x
      FROM b{k} b LEFT JOIN (
        SELECT a.e, a.part, x.pos, sum(x.x) AS s, count(*) AS n
        FROM a{k} a JOIN x ON x.r = a.r AND x.part = a.part GROUP BY ALL) m
      ON m.e = b.e AND m.part = b.part AND m.pos = b.pos)"""

    rounds = ",".join(f"{assigned(k)},{moved(k)}" for k in range(ROUNDS))
    return f"""
    WITH kept AS (
      SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, {column}) AS r, vec_id, label,
             list_transform({column}, lambda c: CAST(floor({SCALE} * c::DOUBLE) AS BIGINT)) AS v
      FROM {vectors}
      WHERE {column} IS NOT NULL
        AND len(list_filter({column}, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
    x AS (
      SELECT r, part, pos, v[part * (len(v) // {PARTS}) + pos + 1]::HUGEINT AS x
      FROM (SELECT r, v, part, unnest(range(len(v) // {PARTS})) AS pos
            FROM (SELECT r, v, unnest(range({PARTS})) AS part FROM kept))),
    b0 AS (SELECT r - 1 AS e, part, pos, x FROM x WHERE r <= {ENTRIES}),{rounds},{assigned(ROUNDS)},
    named AS (
      SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY part, e, pos)) AS codebooks_sha256
      FROM b{ROUNDS}),
    coded AS (
      SELECT r, string_agg(printf('%02x', e::BIGINT), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
      FROM a{ROUNDS} GROUP BY r)
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
    FROM kept JOIN coded USING (r), named"""
