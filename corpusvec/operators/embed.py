"""Turning text into fixed-length unit vectors.

An embedder adds a vector column.  ``HashingEmbedder`` needs no model and gives
the same vectors on any machine; ``BatchEmbedder`` plugs in any encoder that
maps a list of strings to a matrix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from corpusvec.functions import text as T
from corpusvec.functions import vectors as V
from corpusvec.operators.assemble import encode_prefix

DEFAULT_DIM = 64
# Fixed value: texts the encoder takes at a time.
ENCODE_BATCH = 1300
VECTOR_TYPE = ST.ArrayType(ST.FloatType())


class Embedder(Protocol):
    dim: int

    def embed(self, df: DataFrame, text_col: str, out_col: str) -> DataFrame: ...


def vectors_to_arrow(matrix: np.ndarray) -> pa.Array:
    """A float matrix as an Arrow list<float> array, without a Python loop."""
    rows, dim = matrix.shape
    offsets = pa.array(np.arange(0, (rows + 1) * dim, dim, dtype=np.int32))
    values = pa.array(np.ascontiguousarray(matrix, dtype=np.float32).ravel())
    return pa.ListArray.from_arrays(offsets, values)


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    return matrix / np.where(norms == 0, 1.0, norms)[:, None]


def _hash_vocabulary(words: pa.StringArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and sign of each word; the empty word has no sign and counts nothing."""
    if len(words) == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[words.offset : words.offset + len(words) + 1]
    raw = data.to_pybytes() if data is not None else b""
    bounds = ends.tolist()
    digests = np.frombuffer(
        b"".join([hashlib.md5(raw[a:b]).digest() for a, b in zip(bounds, bounds[1:])]),
        dtype=np.uint8,
    ).reshape(-1, 16)
    head = digests[:, :4].astype(np.int64)
    # Six hex digits are the first three bytes, the seventh half of the fourth.
    bucket = (head[:, 0] << 16 | head[:, 1] << 8 | head[:, 2]) % dim
    sign = np.where(np.diff(ends) == 0, 0.0, 1.0 - 2 * (head[:, 3] >> 4 & 1))
    return bucket, sign


class HashingEmbedder:
    """Signed feature hashing of lower-cased words, scaled to unit length.

    A word falls into the bucket given by the first six hex digits of its MD5,
    with the sign given by the parity of the seventh.  Words are hashed once per
    batch vocabulary, and the per-text sums are one vectorised histogram.
    """

    def __init__(self, dim: int = DEFAULT_DIM):
        self.dim = dim

    def embed(self, df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        return df.withColumn(out_col, self.column(F.col(text_col)))

    def column(self, text: Column) -> Column:
        """The stored form: single precision."""
        return self._kernel()(F.lower(T.squeeze(text)))

    def expression(self, text: Column) -> Column:
        """The same vector from built-in expressions, in double precision.

        Its work is words times dimensions; meant for a handful of query texts.
        """
        dim = self.dim

        def signed_bucket(word: Column) -> Column:
            digest = F.md5(word)
            return F.struct(
                (F.conv(F.substring(digest, 1, 6), 16, 10).cast("long") % dim).alias("b"),
                (
                    1 - 2 * (F.conv(F.substring(digest, 7, 1), 16, 10).cast("int") % 2)
                ).cast("double").alias("s"),
            )

        hashed = F.transform(T.words(F.lower(text)), signed_bucket)
        sums = T.bind(
            hashed,
            lambda h: F.transform(
                F.sequence(F.lit(0), F.lit(dim - 1)),
                lambda j: F.aggregate(
                    F.filter(h, lambda x: x["b"] == j),
                    F.lit(0.0),
                    lambda total, x: total + x["s"],
                ),
            ),
        )
        return T.bind(sums, V.l2_normalize)

    def _kernel(self):
        dim = self.dim

        @F.arrow_udf(VECTOR_TYPE)
        def hash_words(squeezed: pa.Array) -> pa.Array:
            if isinstance(squeezed, pa.ChunkedArray):
                squeezed = squeezed.combine_chunks()
            tokens = pc.split_pattern(pc.fill_null(squeezed, ""), " ")
            lengths = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
            coded = pc.dictionary_encode(tokens.flatten())
            bucket, sign = _hash_vocabulary(coded.dictionary.cast(pa.string()), dim)
            codes = coded.indices.to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            sums = np.bincount(
                owner * dim + bucket[codes],
                weights=sign[codes],
                minlength=len(lengths) * dim,
            ).reshape(len(lengths), dim)
            return vectors_to_arrow(_unit_rows(sums))

        return hash_words


class BatchEmbedder:
    """Any encoder, loaded once per task and fed in batches.

    ``load`` runs on the executor and returns the encoder, a function from a
    list of strings to a (strings x dim) matrix.
    """

    def __init__(
        self,
        load: Callable[[], Callable[[list[str]], np.ndarray]],
        dim: int,
        batch: int = ENCODE_BATCH,
        normalize: bool = True,
    ):
        self.load, self.dim, self.batch, self.normalize = load, dim, batch, normalize

    def embed(self, df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        return df.withColumn(out_col, self.column(F.col(text_col)))

    def column(self, text: Column) -> Column:
        load, dim, batch, normalize = self.load, self.dim, self.batch, self.normalize

        def encode_all(series: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encode = load()
            for texts in series:
                strings = texts.to_pylist()
                parts = [
                    np.asarray(encode(strings[i : i + batch]), dtype=np.float64)
                    for i in range(0, len(strings), batch)
                ]
                matrix = np.vstack(parts) if parts else np.zeros((0, dim))
                if matrix.shape[1] != dim:
                    raise ValueError(f"encoder gave {matrix.shape[1]} dimensions, not {dim}")
                yield vectors_to_arrow(_unit_rows(matrix) if normalize else matrix)

        encode_all.__annotations__ = {
            "series": Iterator[pa.Array],
            "return": Iterator[pa.Array],
        }
        return F.arrow_udf(encode_all, VECTOR_TYPE)(text)


def embed_chunks(
    df: DataFrame,
    embedder: Embedder,
    text: str = "text",
    out: str = "vector",
    kind: str = "passage",
) -> DataFrame:
    """Encode the prefixed text; the stored text stays unprefixed."""
    prefixed = encode_prefix(df, kind, text, "encoder_input")
    return embedder.embed(prefixed, "encoder_input", out).drop("encoder_input")


def validate_vectors(df: DataFrame, dim: int, vector: str = "vector", eps: float = 1e-3) -> DataFrame:
    """One row: dimension and norm ranges, counts of what is wrong, and the verdict.

    A vector is right if it has ``dim`` finite components and unit length, or if
    it is the origin, where embedders leave a text without words; those are
    counted apart.  A vector with a NULL component has no norm and counts as NULL.
    No vectors at all are not valid.
    """
    measured = df.select(
        F.size(vector).alias("dim"), V.l2_norm(F.col(vector)).alias("norm")
    )
    stats = measured.agg(*vector_figures(F.col("dim"), F.col("norm"), eps))
    ok = (
        (F.col("null_vectors") == 0)
        & (F.col("wrong_norms") == 0)
        & (F.col("min_dim") == dim)
        & (F.col("max_dim") == dim)
    )
    return stats.withColumn("valid", F.coalesce(ok, F.lit(False)))


def vector_figures(dim: Column, norm: Column, eps: float = 1e-3) -> list[Column]:
    """What ``validate_vectors`` sums up, from the dimension and the norm of each vector."""
    # NaN is larger than any number here, so it fails the comparison.
    unit = F.abs(norm - 1) <= eps
    return [
        F.count(F.lit(1)).alias("vectors"),
        F.count_if(norm.isNull()).alias("null_vectors"),
        F.count_if(norm == 0).alias("zero_vectors"),
        F.count_if(~unit & (norm != 0)).alias("wrong_norms"),
        F.min(dim).alias("min_dim"),
        F.max(dim).alias("max_dim"),
        F.min(norm).alias("min_norm"),
        F.max(norm).alias("max_norm"),
    ]
