"""Fill-in-the-middle examples by rotating blocks of a text in place.

A text is cut at two places into prefix, middle and suffix, chosen by a digest of its
``doc_id``.  Its bytes lie in one ``bytearray``: the sentinels are inserted where the
blocks begin, and two neighbouring blocks change places by three reversals (each
block, then both together), so nothing but a fixed buffer is held beside the text.
``psm`` exchanges middle and suffix, ``spm`` brings the suffix to the front.

Undoing it needs only the output and its form: the sentinels are found by scanning,
the same rotation the other way round restores the order, and the sentinels go.
That is exact because a text that has a sentinel itself stays ``plain``, and no
sentinel can arise where a block meets one, as each begins with its only ``<``.

Every row is handled alone: there is no shuffle.  NULL counts as an empty text, and an
empty text is ``plain``.  A NULL ``doc_id`` is digested as an empty string.  Repeated
rows give the same output each.  A very long text takes twice its bytes; cuts are
looked up in blocks of it.  Other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import as_bytes, slices

# Fixed values.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = 1
# Percent of texts that are rearranged, and of those that have the suffix first.
RATE, SPM_RATE = 90, 20

# Bytes that are looked through, or change places, at a time.
BLOCK = 1 << 20


def draws(doc_id: object, seed: int = SEED) -> tuple[int, ...]:
    """Four unsigned 32-bit numbers that depend on the document's id alone."""
    named = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(named.encode()).digest()
    return tuple(int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4))


# Places in a text ----------------------------------------------------------------


def _heads(data: np.ndarray) -> np.ndarray:
    """Whether a byte begins a code point."""
    return data & 0xC0 != 0x80


def _characters_by_block(data: np.ndarray) -> np.ndarray:
    """Code points that begin before each block, and in all."""
    counts = [np.count_nonzero(_heads(data[at : at + BLOCK])) for at in range(0, len(data), BLOCK)]
    return np.cumsum([0, *counts])


def _byte_offset(data: np.ndarray, before: np.ndarray, characters: int) -> int:
    """Where the code point of that number begins; the end, if there is none."""
    if characters == before[-1]:
        return len(data)
    block = int(np.searchsorted(before, characters, side="right")) - 1
    start = block * BLOCK
    heads = np.flatnonzero(_heads(data[start : start + BLOCK]))
    return start + int(heads[characters - before[block]])


# Rotation ------------------------------------------------------------------------


def _reverse(data: np.ndarray, start: int, end: int) -> None:
    while end - start > 1:
        size = min(BLOCK, (end - start) // 2)
        left = data[start : start + size].copy()
        data[start : start + size] = data[end - size : end][::-1]
        data[end - size : end] = left[::-1]
        start, end = start + size, end - size


def rotate(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Let the blocks ``start`` to ``middle`` and ``middle`` to ``end`` change places."""
    data = np.frombuffer(buffer, np.uint8)
    _reverse(data, start, middle)
    _reverse(data, middle, end)
    _reverse(data, start, end)


def rearrange_text(
    text: bytes, doc_id: object, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED
) -> tuple[bytearray, str, int, int | None, int | None]:
    """The output, its form, and the code points of text, prefix and middle."""
    data = np.frombuffer(text, np.uint8)
    before = _characters_by_block(data)
    n = int(before[-1])
    first, second, form_draw, order_draw = draws(doc_id, seed)
    buffer = bytearray(text)
    if not n or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or form_draw % 100 >= rate:
        return buffer, PLAIN, n, None, None
    low, high = sorted((first % (n + 1), second % (n + 1)))
    cut, end = _byte_offset(data, before, low), _byte_offset(data, before, high)
    buffer[end:end] = SUFFIX
    buffer[cut:cut] = MIDDLE
    buffer[0:0] = PREFIX
    middle_at, suffix_at = cut + len(PREFIX), end + len(PREFIX) + len(MIDDLE)
    form = SPM if order_draw % 100 < spm_rate else PSM
    rotate(buffer, 0 if form == SPM else middle_at, suffix_at, len(buffer))
    return buffer, form, n, low, high - low


def restore_text(output: bytes, form: str) -> bytearray:
    """The text that an output of this form was made of."""
    buffer = bytearray(output)
    if form == PLAIN:
        return buffer
    size = len(buffer)
    if form == PSM:
        suffix_at, middle_at = buffer.find(SUFFIX), buffer.find(MIDDLE)
        rotate(buffer, suffix_at, middle_at, size)
        middle_at, suffix_at = suffix_at, size - (middle_at - suffix_at)
    else:
        prefix_at, middle_at = buffer.find(PREFIX), buffer.find(MIDDLE)
        rotate(buffer, 0, prefix_at, size)
        middle_at, suffix_at = middle_at - prefix_at, size - prefix_at
    del buffer[suffix_at : suffix_at + len(SUFFIX)]
    del buffer[middle_at : middle_at + len(MIDDLE)]
    del buffer[: len(PREFIX)]
    return buffer


# Tables --------------------------------------------------------------------------


def _texts(found: list[bytearray]) -> pa.Array:
    """Buffers with whole characters as a string column."""
    offsets = np.cumsum([0, *map(len, found)]).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_string(), len(found), [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(found))]
    ).cast(pa.string())


def rearrange(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of ``doc_id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [
                    rearrange_text(text.as_py(), doc_id, rate, spm_rate, seed)
                    for text, doc_id in zip(as_bytes(part.column("text")), part.column("doc_id").to_pylist())
                ]
                outputs, forms, sizes, prefixes, middles = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(forms, pa.string()),
                        pa.array(prefixes, pa.int64()),
                        pa.array(middles, pa.int64()),
                        _texts(outputs),
                    ],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def restore(rearranged: DataFrame) -> DataFrame:
    """The rows and columns of ``output, form`` and others, and ``restored``: the text rebuilt
    from the output and form alone.  A ``restored`` that is there already is replaced."""
    given = rearranged.drop("restored")
    names = given.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "output"):
                texts = [
                    restore_text(output.as_py(), form)
                    for output, form in zip(as_bytes(part.column("output")), part.column("form").to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, _texts(texts)], [*names, "restored"])

    schema = given.withColumn("restored", F.lit("").cast("string")).schema
    return given.mapInArrow(run, schema)


def digests(rearranged: DataFrame) -> DataFrame:
    """Digests of the outputs, and of the texts rebuilt from them."""
    sha256 = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return restore(rearranged).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha256("output"), sha256("restored")
    )


def sql(docs: str = "documents") -> str:
    """The same digests in DuckDB SQL."""
    p, s, m = (mark.decode() for mark in (PREFIX, SUFFIX, MIDDLE))
    draw = "('0x' || substr(sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')), {at}, 8))::UBIGINT"
    h = [draw.format(seed=SEED, at=8 * i + 1) for i in range(4)]
    return f"""
    WITH t AS (
      SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
             {h[0]} AS h1, {h[1]} AS h2, {h[2]} AS h3, {h[3]} AS h4
      FROM {docs}),
    formed AS (
      SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS low,
             greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS high,
             CASE WHEN n = 0 OR contains(text, '{p}') OR contains(text, '{s}') OR contains(text, '{m}')
                    OR h3 % 100 >= {RATE} THEN '{PLAIN}'
                  WHEN h4 % 100 < {SPM_RATE} THEN '{SPM}' ELSE '{PSM}' END AS form
      FROM t),
    cut AS (
      SELECT *, substr(text, 1, low) AS prefix, substr(text, low + 1, high - low) AS middle,
             substr(text, high + 1) AS suffix
      FROM formed)
    SELECT doc_id, n, form,
           CASE WHEN form <> '{PLAIN}' THEN low END AS prefix_chars,
           CASE WHEN form <> '{PLAIN}' THEN high - low END AS middle_chars,
           sha256(CASE form WHEN '{PLAIN}' THEN text
                            WHEN '{PSM}' THEN '{p}' || prefix || '{s}' || suffix || '{m}' || middle
                            ELSE '{s}' || suffix || '{p}' || prefix || '{m}' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM cut"""
