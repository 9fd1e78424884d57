"""Exact duplicates by recipes of content-defined chunks.

A text is normalised (every run of blanks is one space) and cut where its content
says so, so the chunks of equal texts are equal.  A document becomes its recipe, the
ordered digests of its chunks.  Digests are counted first, 16 bytes each; only chunks
whose digest occurs more than once have anything to be compared with, and only their
bytes move, once per task.  Equal digests with unequal bytes are told apart there, so
that a chunk's identifier stands for its bytes and not for a digest that others might
share.  Documents are equal exactly if their lists of identifiers are.

Tasks know the repeated digests by a bit map of bounded size that is sent to them; the
few chunks that it lets through too many are compared with nothing.

A chunk whose digest is unambiguous is identified by the digest alone.  Where two
different chunks share one, the identifier also has the rank of its bytes among
them, and documents with such a chunk look theirs up.

A NULL text counts as empty, and an empty recipe equals another.  Of equal texts
the row with the smallest ``doc_id`` stays, once if it is repeated.  A NULL
``doc_id`` counts in no minimum; a group without any other has a NULL
``keep_id``.  A very long text is cut like any other; no chunk is longer than
``MAX_CHUNK``, and its recipe has 16 bytes for some two thousand.  Other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import BLANKS, BitMap, as_bytes, null_safe_join, slices
from corpusvec.session import settle

# A cut falls after a byte whose surrounding window hashes to zero under the
# mask, one in 2,048; chunks are never longer than MAX_CHUNK.
WINDOW = 16
MASK = np.uint32((1 << 11) - 1)
MAX_CHUNK = 16_384
DIGEST_BYTES = 16

# Fixed value: an odd multiplier for the window hash.
_MULTIPLIER = np.uint32(0x9E3779B1)
_IS_BLANK = np.isin(np.arange(256), np.frombuffer(BLANKS.encode(), np.uint8))


def normalise(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts end to end with each run of blanks as one space, and where each begins now.

    ``starts`` has the first byte of every text and the end of the last.
    """
    blank = _IS_BLANK[data]
    again = np.zeros(len(data), dtype=bool)
    again[1:] = blank[1:] & blank[:-1]
    heads = starts[:-1]
    again[heads[heads < len(data)]] = False
    kept = ~again
    before = np.r_[0, np.cumsum(kept)]
    return np.where(blank, np.uint8(0x20), data)[kept], before[starts]


def _window_hash(data: np.ndarray) -> np.ndarray:
    """At each byte, a hash of the ``WINDOW`` bytes that end there."""
    h = data.astype(np.uint32) + np.uint32(1)
    h *= _MULTIPLIER
    h ^= h >> np.uint32(15)
    factor, span = _MULTIPLIER, 1
    while span < WINDOW:
        wider = h * factor
        wider[span:] += h[:-span]
        h, factor, span = wider, factor * factor, span * 2
    return h ^ (h >> np.uint32(16))


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Chunk ends: where the window says so, at every text's end, and at the longest chunk."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    with np.errstate(over="ignore"):
        marked = np.flatnonzero((_window_hash(data) & MASK) == 0) + 1
    # A window that reaches back over the text's start saw another text.
    text = np.searchsorted(starts, marked, side="left") - 1
    marked = marked[marked - starts[text] >= WINDOW]
    ends = np.unique(np.r_[marked, starts[1:]])
    ends = ends[ends > 0]
    sizes = np.diff(np.r_[0, ends])
    extra = (sizes - 1) // MAX_CHUNK
    if not extra.any():
        return ends
    owner = np.repeat(np.arange(len(ends)), extra)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(extra) - extra, extra) + 1
    return np.unique(np.r_[ends, (ends - sizes)[owner] + nth * MAX_CHUNK])


def chunked(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes, list[bytes]]]:
    """Row, normalised text and chunks for every text of a batch with a ``text`` column."""
    first = 0
    for part in slices(batch, "text"):
        texts = as_bytes(part.column("text"))
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
        clean, starts = normalise(raw, offsets - offsets[0])
        ends = cuts(clean, starts)
        whole = clean.tobytes()
        at = 0
        bounds = starts.tolist()
        ends = ends.tolist()
        for row in range(len(texts)):
            start, end = bounds[row], bounds[row + 1]
            pieces = []
            while start < end:
                pieces.append(whole[start : ends[at]])
                start = ends[at]
                at += 1
            yield first + row, whole[bounds[row] : end], pieces
        first += len(texts)


def _digest(size: int):
    """A digest function; sizes of a few bytes make collisions for tests."""
    return lambda chunk: hashlib.blake2b(chunk, digest_size=size).digest()


def recipes(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """``doc_id, text_sha256, recipe`` per row; a recipe is its chunk digests end to end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = _digest(digest_bytes)
        for batch in batches:
            sums, lists = [], []
            for _, text, pieces in chunked(batch):
                sums.append(hashlib.sha256(text).hexdigest())
                lists.append(b"".join([digest(p) for p in pieces]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sums, pa.string()), pa.array(lists, pa.binary())],
                ["doc_id", "text_sha256", "recipe"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_sha256 string, recipe binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def repeated_digests(plain: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """``digest`` of the chunks that occur in more than one place of ``recipes``."""
    places = F.sequence(F.lit(1), F.length("recipe"), F.lit(digest_bytes))
    each = plain.filter(F.length("recipe") > 0).select(
        F.explode(F.transform(places, lambda at: F.substring("recipe", at, F.lit(digest_bytes)))).alias("digest")
    )
    return each.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest")


def shared_digests(docs: DataFrame, repeated: BitMap, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """``digest, chunk, variant`` of chunks whose digest stands for different bytes.

    Every task hands on each repeated chunk once.  Comparing bytes is grouping by them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = _digest(digest_bytes)
        for batch in batches:
            for part in slices(batch, "text"):
                named = {}
                for _, _, pieces in chunked(part):
                    for piece in pieces:
                        if piece not in named and (name := digest(piece)) in repeated:
                            named[piece] = name
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(named.values()), pa.binary()), pa.array(list(named), pa.binary())],
                    ["digest", "chunk"],
                )

    # Grouping by digest and bytes compares the bytes.
    chunks = docs.select("text").mapInArrow(run, "digest binary, chunk binary")
    mixed = settle(
        chunks.distinct()
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest"),
        "mixed-digests",
    )
    if mixed.isEmpty():
        return docs.sparkSession.createDataFrame([], "digest binary, chunk binary, variant long")
    ambiguous = chunks.join(mixed, "digest", "left_semi").distinct()
    ranked = ambiguous.groupBy("digest").agg(F.sort_array(F.collect_set("chunk")).alias("chunks"))
    return ranked.select("digest", F.posexplode("chunks").alias("variant", "chunk")).select(
        "digest", "chunk", F.col("variant").cast("long").alias("variant")
    )


def _chunk_places(docs: DataFrame, digest_bytes: int) -> DataFrame:
    """``doc_id, text_sha256, pos, digest, chunk`` of every chunk of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = _digest(digest_bytes)
        for batch in batches:
            for part in slices(batch, "text"):
                rows, sums, places, chunks = [], [], [], []
                for row, text, pieces in chunked(part):
                    rows += [row] * len(pieces)
                    sums += [hashlib.sha256(text).hexdigest()] * len(pieces)
                    places += range(len(pieces))
                    chunks += pieces
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(rows, pa.int64())),
                        pa.array(sums, pa.string()),
                        pa.array(places, pa.int64()),
                        pa.array([digest(c) for c in chunks], pa.binary()),
                        pa.array(chunks, pa.binary()),
                    ],
                    ["doc_id", "text_sha256", "pos", "digest", "chunk"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_sha256 string, pos long, digest binary, chunk binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def verified_recipes(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """``recipes`` with ``variants``: the ranks of chunks that their digest alone leaves open."""
    plain = settle(recipes(docs, digest_bytes), "plain-recipes")
    repeated = BitMap(settle(repeated_digests(plain, digest_bytes), "repeated-digests"), "digest")
    shared = settle(shared_digests(docs, repeated, digest_bytes), "chunk-variants")
    if shared.isEmpty():
        return plain.withColumn("variants", F.lit(None).cast("array<struct<pos: bigint, variant: bigint>>"))
    variants = (
        _chunk_places(docs, digest_bytes)
        .join(shared, ["digest", "chunk"])
        .groupBy("doc_id", "text_sha256")
        .agg(F.sort_array(F.collect_set(F.struct("pos", "variant"))).alias("variants"))
    )
    return null_safe_join(plain, variants, ["doc_id", "text_sha256"], "left")


def exact_duplicates(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``doc_id, text``."""
    identity = ["recipe", "variants"]
    rows = settle(
        verified_recipes(docs, digest_bytes)
        .groupBy("doc_id", "text_sha256", *identity)
        .agg(F.count(F.lit(1)).alias("n")),
        "recipes",
    )
    groups = settle(
        rows.groupBy(*identity).agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size")),
        "recipe-groups",
    )
    joined = null_safe_join(rows, groups, identity, "inner")
    # Repeated rows of one document: the first of them stands for it.
    return joined.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("nth")).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        "text_sha256",
    )

# The same rows in DuckDB SQL.
SQL = """
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS text
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id NULLS LAST, r) = 1 AS kept,
       sha256(text) AS text_sha256
FROM t WINDOW w AS (PARTITION BY text)"""
