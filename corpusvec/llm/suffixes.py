"""Removal of long repeated strings by blockwise suffix sorting over a cover sample.

A byte goes if it lies in a ``length``-byte string that starts anywhere else too.  A second,
shorter length may be looked at in the same pass: how many bytes such strings cover.

The cover.  A classic difference cover samples positions modulo a period, so that
any two suffixes have a common small shift after which both are sampled, and long
ties are settled by the rank of the samples.  At a byte of text per position that
would rank one position in eleven here, an order of magnitude more than fits; so the
sample is chosen by content instead, with the same property for equal strings:
the sample of a window is the place of the smallest 16-byte hash among its first
``SPAN`` starts (the leftmost, if several).  Equal windows have their sample at
equal shifts, by construction, and about one position in ninety is one.

Ranks.  A sample's suffix is named once, by the hash of the bytes that every window with
that sample shares, the tie.  Samples of one name are a suffix bucket; a name
that occurs once ends there, and its windows are unique.  A second hash names
all the bytes that the sample's windows touch: where both repeat, all of
these windows repeat.  This settles the long ties, including all inner parts of
copied text, without moving text.

Buckets.  What is left are samples whose surroundings differ at some distance: the
ends of repeated passages.  Only they carry bytes: at most ``SPAN`` before and the rest of
the windows after the tie; a second hash of the tie is part of the bucket, so ties too
are told apart by 128 bits.  A task sorts the suffixes of one bucket at a time,
takes the common prefixes of neighbours, and so the classes of equal strings at every
length; the same to the left; a window repeats if another sample of its bucket
agrees with it on both sides.

Large buckets.  Samples whose windows agree at some shift between two bounds agree on the
bytes that all those windows have.  So a bucket beyond ``bucket_rows`` is split: the shifts
in halves, and for each half by those very bytes, again and again.  At a single shift
what is left together is equal, and counting will do.  Every comparison is one of
bytes, however large a bucket is, and none is ever gathered in one task.

Copies.  Whole texts that are equal stand for each other: they meet by half of their SHA-256, a
text of ``length`` bytes or more with copies goes altogether, and one of them takes
part in the rest.  So a group of copies costs one text.

NULL is an empty text.  Results depend on the texts alone; repeated rows count as
places of their own, as do rows with the same or a NULL ``doc_id``.  A very long text is
sampled ``BLOCK_BYTES`` at a time; its samples and spans are one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import BitMap, as_bytes, null_safe_join, slices, unused
from corpusvec.session import broadcast_if_small, settle

LENGTH = 400
# The shorter length that is looked at as well.
SHORT = 240
GRAM = 16
# Starts among which a window's sample is chosen.
SPAN = 185
# Rows up to which a bucket is sorted in one task, and rows of small buckets to a task.
BUCKET_ROWS = 16_384
TASK_ROWS = 16_384
# Bytes of one text that are sampled at a time.
BLOCK_BYTES = 2 << 20

# Bytes of a text's SHA-256 by which copies meet.
KEY_BYTES = 16

# A sample's place and its first and last window are one number.
_SAMPLE = "struct<name: long, whole: long, place: long>"


# The cover sample ---------------------------------------------------------------


def _gram_hash(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes that start at each position but the last few."""
    h = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    factor, span = np.uint32(0xC2B2AE35), 1
    while span < GRAM:
        h = h[:-span] * factor + h[span:]
        factor, span = factor * factor | np.uint32(1), span * 2
    h *= np.uint32(0x9E3779B1)
    return h ^ (h >> np.uint32(16))


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values."""
    span = 1
    while 2 * span <= width:
        values, span = np.minimum(values[:-span], values[span:]), 2 * span
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def samples(text: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``at, first, last``: the samples of a text, and the windows each is the sample of."""
    windows = len(text) - length + 1
    if windows <= 0:
        return (np.zeros(0, dtype=np.int64),) * 3
    chosen = []
    for begin in range(0, windows, BLOCK_BYTES):
        end = min(begin + BLOCK_BYTES, windows)
        with np.errstate(over="ignore"):
            h = _gram_hash(text[begin : end - 1 + SPAN - 1 + GRAM])
        keyed = h.astype(np.uint64) << np.uint64(32) | np.arange(len(h), dtype=np.uint64)
        low = _window_minima(keyed, SPAN) & np.uint64(0xFFFFFFFF)
        chosen.append(low.astype(np.int64) + begin)
    sample = np.concatenate(chosen)
    heads = np.flatnonzero(np.r_[True, sample[1:] != sample[:-1]])
    tails = np.r_[heads[1:], len(sample)] - 1
    return sample[heads], heads, tails


def tie_bytes(lengths: tuple[int, ...]) -> int:
    """Bytes after a sample that all its windows reach."""
    return min(lengths) - SPAN + 1


def _placed(at: int, first: int, last: int) -> int:
    return at << 16 | (at - first) << 8 | (at - last)


def _windows(place: int) -> tuple[int, int, int]:
    """``at, first, last`` of a placed sample."""
    at = place >> 16
    return at, at - (place >> 8 & 0xFF), at - (place & 0xFF)


def _named(text: bytes, lengths: tuple[int, ...], mask: int) -> list[tuple[int, int, int]]:
    at, first, last = samples(np.frombuffer(text, np.uint8), min(lengths))
    tie, reach, digest = tie_bytes(lengths), max(lengths), xxhash.xxh64_intdigest
    found = []
    for a, f, z in zip(at.tolist(), first.tolist(), last.tolist()):
        # The shifts of the first and last window are part of what is named.
        whole = digest(text[f : z + reach], (a - f) << 16 | (a - z))
        found.append((digest(text[a : a + tie]) & mask, whole, _placed(a, f, z)))
    return found


def sampled(docs: DataFrame, lengths: tuple[int, ...] = (LENGTH,), name_bits: int = 64) -> DataFrame:
    """``doc_id, key, sha256, n_bytes, samples`` per row; ``key`` is half of the SHA-256.

    Names of fewer bits than 64 collide, which costs work and changes nothing.
    """
    mask = (1 << name_bits) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("name", "whole", "place")]))
        for batch in batches:
            for part in slices(batch, "text"):
                sums, sizes, counts, rows = [], [], [0], []
                for value in as_bytes(part.column("text")):
                    text = value.as_py()
                    sums.append(hashlib.sha256(text))
                    sizes.append(len(text))
                    rows += _named(text, lengths, mask)
                    counts.append(len(rows))
                columns = list(zip(*rows)) or [()] * 3
                values = pa.StructArray.from_arrays(
                    [pa.array(np.array(c, dtype=np.uint64).view(np.int64)) for c in columns],
                    fields=list(kind.value_type),
                )
                lists = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), values)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([x.digest()[:KEY_BYTES] for x in sums], pa.binary()),
                        pa.array([x.hexdigest() for x in sums], pa.string()),
                        pa.array(sizes, pa.int64()),
                        lists,
                    ],
                    ["doc_id", "key", "sha256", "n_bytes", "samples"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, key binary, sha256 string, n_bytes long, samples array<{_SAMPLE}>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


# Buckets ------------------------------------------------------------------------


def _classes(buckets: list[bytes], strings: list[bytes], width: int) -> np.ndarray:
    """Row n: for each string, a number equal among those of its bucket that agree on ``n`` bytes.

    The suffixes are sorted bucket by bucket, and the common prefixes of neighbours
    give the classes of every length; a string shorter than n is alone in its class.
    """
    m, strings = len(strings), [s[:width] for s in strings]
    order = np.array(sorted(range(m), key=lambda i: (buckets[i], strings[i])), dtype=np.int64)
    padded = np.zeros((m, width), dtype=np.uint8)
    for i, at in enumerate(order.tolist()):
        padded[i, : len(strings[at])] = np.frombuffer(strings[at], np.uint8)
    sizes = np.array([len(s) for s in strings], dtype=np.int64)[order]
    differ = padded[1:] != padded[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common = np.minimum(common, np.minimum(sizes[1:], sizes[:-1]))
    ranked = [buckets[i] for i in order.tolist()]
    common[[a != b for a, b in zip(ranked, ranked[1:])]] = -1
    result = np.empty((width + 1, m), dtype=np.int32)
    for n in range(width + 1):
        result[n, order] = np.cumsum(np.r_[True, common < n])
    return result


def repeated_shifts(
    buckets: list[bytes],
    befores: list[bytes],
    afters: list[bytes],
    largest: np.ndarray,
    rests: tuple[int, ...],
    shifts: range = range(SPAN),
) -> Iterator[tuple[int, np.ndarray, int]]:
    """Which of the ``rests``, samples, and a shift at which the window that many bytes
    before them repeats.

    ``befores`` are reversed, so both sides begin next to what a bucket shares.  A rest is
    what a window of one length has after the tie when it begins at the sample.  A sample has
    windows up to its ``largest`` shift, as far as its bytes go.
    """
    left = _classes(buckets, befores, SPAN - 1)
    right = _classes(buckets, afters, max(rests))
    reach = np.array([len(a) for a in afters], dtype=np.int64)
    for which, rest in enumerate(rests):
        for shift in shifts:
            inside = np.flatnonzero((shift <= largest) & (reach >= rest - shift))
            both = left[shift, inside].astype(np.int64) * (len(buckets) + 1) + right[rest - shift, inside]
            _, inverse, counts = np.unique(both, return_inverse=True, return_counts=True)
            again = inside[counts[inverse] > 1]
            if len(again):
                yield which, again, shift


def _intervals(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive values per row, as ``row, low, high``."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    if not len(rows):
        return rows, values, values
    new = np.r_[True, (rows[1:] != rows[:-1]) | (values[1:] != values[:-1] + 1)]
    heads = np.flatnonzero(new)
    tails = np.r_[heads[1:], len(rows)] - 1
    return rows[heads], values[heads], values[tails]


_BUCKET = "id long, name binary, at int, largest int, before binary, after binary"


def _bucket_contexts(texts: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """The bytes around each unsettled sample of ``id, text, edges``.

    The bytes before a sample end where its first window begins, those after it where
    its last window ends.
    """
    tie, reach = tie_bytes(lengths), max(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for owner, value, edges in zip(
                    part.column("id").to_pylist(),
                    as_bytes(part.column("text")),
                    part.column("edges").to_pylist(),
                ):
                    text = value.as_py()
                    for e in edges:
                        a, f, z = _windows(e["place"])
                        # The name and a second hash of the tie, with another seed.
                        name = (e["name"] & (1 << 64) - 1).to_bytes(8, "big")
                        name += xxhash.xxh64_digest(text[a : a + tie], 1)
                        rows.append((owner, name, a, a - f, text[f:a][::-1], text[a + tie : z + reach]))
                if rows:
                    columns = list(zip(*rows))
                    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)],
                        ["id", "name", "at", "largest", "before", "after"],
                    )

    return texts.select("id", "text", "edges").mapInArrow(run, _BUCKET)


_MARK = "id long, which int, low int, high int"
_MARK_COLUMNS = ["id", "which", "low", "high"]


def _sort_buckets(contexts: DataFrame, rests: tuple[int, ...], task_rows: int = TASK_ROWS) -> DataFrame:
    """``id, which, low, high``: runs of window starts that repeat, for each of the ``rests``.

    A group has whole buckets, about ``task_rows`` rows of them.
    """

    def runs(part: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Row, which, low and high of buckets that look at the same lengths and shifts."""
        which, low, high = (part[c][0].as_py() for c in ("which", "low", "high"))
        at, largest = (part[c].to_numpy().astype(np.int64) for c in ("at", "largest"))
        chosen = range(len(rests)) if which < 0 else [which]
        found = list(
            repeated_shifts(
                *(part[c].to_pylist() for c in ("bucket", "before", "after")),
                largest,
                tuple(rests[w] for w in chosen),
                range(low, high + 1),
            )
        )
        for n, w in enumerate(chosen):
            mine = [(rows, at[rows] - shift) for k, rows, shift in found if k == n]
            if mine:
                rows, starts, ends = _intervals(*(np.concatenate(x) for x in zip(*mine)))
                yield rows, np.full(len(rows), w), starts, ends

    def run(group: pa.Table) -> pa.Table:
        out = [pa.table({c: pa.array([], pa.int64() if c == "id" else pa.int32()) for c in _MARK_COLUMNS})]
        kinds = group.group_by(["which", "low", "high"]).aggregate([])
        for kind in kinds.to_pylist():
            part = group
            if len(kinds) > 1:
                part = group.filter(
                    (pc.field("which") == kind["which"])
                    & (pc.field("low") == kind["low"])
                    & (pc.field("high") == kind["high"])
                )
            ids = part["id"].combine_chunks()
            for rows, *marks in runs(part):
                columns = [ids.take(pa.array(rows)), *(pa.array(m.astype(np.int32)) for m in marks)]
                out.append(pa.table(columns, names=_MARK_COLUMNS))
        return pa.concat_tables(out)

    groups = max(1, contexts.count() // task_rows)
    return (
        contexts.withColumn("part", F.pmod(F.xxhash64("bucket"), F.lit(groups)))
        .groupBy("part")
        .applyInArrow(run, _MARK)
    )


def _of_large(contexts: DataFrame, rows: int) -> tuple[DataFrame, DataFrame] | None:
    """``contexts`` parted into those of small and of large buckets; None if all are small."""
    large = settle(
        contexts.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows).select("bucket"),
        "suffix-large",
    )
    if large.isEmpty():
        return None
    large = broadcast_if_small(large)
    return contexts.join(large, "bucket", "left_anti"), contexts.join(large, "bucket", "left_semi")


def _halved(contexts: DataFrame, rests: tuple[int, ...]) -> DataFrame:
    """The same samples in smaller buckets: one for each length and half of the shifts.

    All windows of one length whose shifts lie between two bounds have some bytes on either
    side of the tie; samples that differ in these have no such window in common.
    """
    lengths = F.when(F.col("which") < 0, F.sequence(F.lit(0), F.lit(len(rests) - 1))).otherwise(F.array("which"))
    middle = F.shiftright(F.col("low") + F.col("high"), 1)
    halves = F.array(
        F.struct(F.col("low").alias("low"), middle.alias("high")),
        F.struct((middle + 1).alias("low"), F.col("high").alias("high")),
    )
    parted = (
        contexts.withColumn("which", F.explode(lengths))
        .withColumn("half", F.explode(halves))
        .withColumns({"low": F.col("half.low"), "high": F.col("half.high")})
        .withColumn("shared", F.get(F.array(*map(F.lit, rests)), F.col("which")) - F.col("high"))
        # Without any such window, a sample has no part in it.
        .filter((F.col("largest") >= F.col("low")) & (F.length("after") >= F.col("shared")))
    )
    scope = F.unhex(F.format_string("%02x%04x%04x", "which", "low", "high"))
    sides = (F.substring("before", F.lit(1), F.col("low")), F.substring("after", F.lit(1), F.col("shared")))
    return parted.withColumn("bucket", F.concat("name", scope, *sides)).drop("half", "shared")


def _mark_buckets(contexts: DataFrame, rests: tuple[int, ...], bucket_rows: int) -> DataFrame:
    """The marks of all buckets; large ones are split until they are small, or all equal."""
    pending = contexts.withColumns(
        {"bucket": F.col("name"), "which": F.lit(-1), "low": F.lit(0), "high": F.lit(SPAN - 1)}
    )
    small, marks = [], []
    while (parted := _of_large(pending, bucket_rows)) is not None:
        small.append(parted[0])
        # At a single shift nothing tells windows of a bucket apart, and there are several.
        start = (F.col("at") - F.col("low")).cast("int")
        equal = parted[1].filter("low = high")
        marks.append(equal.select("id", "which", start.alias("low"), start.alias("high")))
        pending = settle(_halved(parted[1].filter("low < high"), rests), "suffix-halves")
    for part in small:
        pending = pending.unionByName(part)
    marked = _sort_buckets(pending, rests)
    for part in marks:
        marked = marked.union(part)
    return marked


# Removal ------------------------------------------------------------------------


def _spans(
    size: int, places: list[int] | None, marks: list[dict] | None, which: int, length: int
) -> list[tuple[int, int]]:
    """Maximal byte runs covered by windows that start in the given runs.

    ``places`` are samples all of whose windows repeat; those that the text is too short
    for are none.
    """
    runs = [(m["low"], m["high"]) for m in marks or () if m["which"] == which]
    for place in places or ():
        _, first, last = _windows(place)
        if (last := min(last, size - length)) >= first:
            runs.append((first, last))
    spans: list[tuple[int, int]] = []
    for low, high in sorted(runs):
        end = high + length
        if spans and low <= spans[-1][1]:
            if end > spans[-1][1]:
                spans[-1] = spans[-1][0], end
        else:
            spans.append((low, end))
    return spans


def _whole_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without the parts of characters at their ends."""
    fitted = []
    for start, end in spans:
        while start < end and text[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            fitted.append((start, end))
    return fitted


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return b"".join([*kept, text[at:]])


_CUT = {
    "n_removed": "long",
    "n_spans": "long",
    "kept_sha256": "string",
    "n_repeated": "long",
    "kept_text": "string",
}


def _cut(texts: DataFrame, lengths: tuple[int, ...], columns: tuple[str, ...]) -> DataFrame:
    """``doc_id, key`` and columns of what is left of ``text`` by ``sure`` and ``found``.

    The first length decides what goes; ``n_repeated`` counts the bytes by the last.
    ``kept_text`` has whole characters only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = {name: [] for name in _CUT}
                for value, sure, marks in zip(
                    as_bytes(part.column("text")),
                    part.column("sure").to_pylist(),
                    part.column("found").to_pylist(),
                ):
                    text = value.as_py()
                    every = [_spans(len(text), sure, marks, w, n) for w, n in enumerate(lengths)]
                    spans, covered = every[0], every[-1]
                    kept = _without(text, spans)
                    found["n_removed"].append(len(text) - len(kept))
                    found["n_spans"].append(len(spans))
                    found["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                    found["n_repeated"].append(sum(end - start for start, end in covered))
                    if "kept_text" in columns:
                        readable = _without(text, _whole_characters(text, spans))
                        found["kept_text"].append(readable.decode(errors="replace"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("key"),
                        *(pa.array(found[c], pa.int64() if _CUT[c] == "long" else pa.string()) for c in columns),
                    ],
                    ["doc_id", "key", *columns],
                )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {id_type}", "key binary", *(f"{c} {_CUT[c]}" for c in columns)])
    return texts.select("doc_id", "key", "text", "sure", "found").mapInArrow(run, schema)


def _key(text: Column) -> Column:
    digest = F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)
    return F.unhex(F.left(digest, F.lit(2 * KEY_BYTES)))


def find_repeats(
    docs: DataFrame,
    lengths: tuple[int, ...],
    columns: tuple[str, ...],
    bucket_rows: int = BUCKET_ROWS,
    name_bits: int = 64,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``rows`` (one per document), ``copies`` (texts that several rows have) and ``cut`` (other
    texts with a repeated string: ``doc_id, key`` and the given columns)."""
    if min(lengths) < SPAN + GRAM:
        raise ValueError(f"length must be at least {SPAN + GRAM}")
    rests = tuple(n - tie_bytes(lengths) for n in lengths)
    # Numbers stand for texts from here on; they are part of what is written.
    rows = settle(
        sampled(docs, lengths, name_bits).withColumn("id", F.monotonically_increasing_id()), "suffix-samples"
    )
    copies = settle(
        rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("one")).filter("n > 1"),
        "suffix-copies",
    )
    # Of copies, one takes part.
    distinct = rows.join(broadcast_if_small(copies), "key", "left").filter(
        F.col("one").isNull() | (F.col("one") == F.col("id"))
    )
    each = distinct.select("id", F.inline("samples"))
    # Stored, so that a name with very many samples can be split in the join.
    names = settle(
        each.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name"),
        "suffix-names",
    )
    shared = settle(each.join(names, "name", "left_semi"), "suffix-shared")
    classes = settle(
        shared.groupBy("name", "whole").agg(
            F.count(F.lit(1)).alias("same"), F.min(F.struct("id", "place")).alias("one")
        ),
        "suffix-classes",
    )
    # One sample of every class takes part in a bucket of several classes.
    open_names = settle(
        classes.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name"),
        "suffix-open",
    )
    edges = (
        classes.join(open_names, "name", "left_semi")
        .select("name", "one.*")
        .groupBy("id")
        .agg(F.collect_list(F.struct("name", "place")).alias("edges"))
    )
    sure = (
        shared.join(classes.filter("same > 1").select("name", "whole"), ["name", "whole"], "left_semi")
        .groupBy("id")
        .agg(F.collect_list("place").alias("sure"))
    )
    marked = sure.join(edges, "id", "full")
    candidates = settle(distinct.select("id", "doc_id", "key", "n").join(marked, "id"), "suffix-candidates")
    # Most texts are none of them, and are left where they are.
    wanted = BitMap(candidates.select("key"), "key")
    keyed = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        _key(F.col("text")).alias("key"),
    ).filter(wanted.holds(F.col("key")))
    texts = settle(null_safe_join(keyed, candidates, ["doc_id", "key"], "inner"), "suffix-texts")
    # A repeated row would otherwise meet itself.
    contexts = settle(
        _bucket_contexts(texts.filter(F.col("edges").isNotNull()), lengths).dropDuplicates(["id", "at"]),
        "suffix-buckets",
    )
    found = (
        _mark_buckets(contexts, rests, bucket_rows)
        .groupBy("id")
        .agg(F.collect_list(F.struct("which", "low", "high")).alias("found"))
    )
    alone = texts.filter("n IS NULL").select("id", "doc_id", "key", "text", "sure")
    cut = alone.join(found, "id", "left").filter(F.col("sure").isNotNull() | F.col("found").isNotNull())
    return rows.drop("samples", "id"), copies.select("key"), _cut(cut, lengths, columns)


def _joined(rows: DataFrame, copies: DataFrame, cut: DataFrame) -> DataFrame:
    """``copied`` (other rows have the same text) and the columns of ``cut`` beside every row.

    Copies are met by text; all other texts by document as well, so that no group
    of copies meets in one task.
    """
    several = broadcast_if_small(copies.withColumn("several", F.lit(True)))
    flagged = rows.join(several, "key", "left").withColumn("copied", F.coalesce("several", F.lit(False)))
    return null_safe_join(flagged, cut, ["doc_id", "key"], "left")


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    short: int = SHORT,
    bucket_rows: int = BUCKET_ROWS,
    name_bits: int = 64,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_repeated`` for every row of
    ``doc_id, text``.

    ``n_repeated`` counts the bytes covered by strings of ``short`` bytes that also start
    anywhere else; nothing is removed for it.
    """
    columns = ("n_removed", "n_spans", "kept_sha256", "n_repeated")
    rows, copies, cut = find_repeats(docs, (length, short), columns, bucket_rows, name_bits)
    empty = hashlib.sha256(b"").hexdigest()
    whole = F.col("copied") & (F.col("n_bytes") >= length)

    def count(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0)).cast("long")

    return _joined(rows, copies, cut).select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(count("n_removed")).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(count("n_spans")).alias("n_spans"),
        F.when(whole, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        F.when(F.col("copied") & (F.col("n_bytes") >= short), F.col("n_bytes"))
        .otherwise(count("n_repeated"))
        .alias("n_repeated"),
    )


def cut_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """All rows and columns of ``docs``, ``text`` without its repeated strings.

    A character of which only some bytes are repeated stays.
    """
    rows, copies, cut = find_repeats(docs, (length,), ("kept_text",))
    key, kept, whole = unused(docs.columns, "key", "kept_text", "whole")
    # Rows with the same id and text are copies of each other.
    gone = rows.filter(F.col("n_bytes") >= length).select("key").distinct().join(copies, "key", "left_semi")
    keyed = docs.withColumn(key, _key(F.col("text")))
    flagged = keyed.join(
        broadcast_if_small(settle(gone, "suffix-gone")).select(F.col("key").alias(key), F.lit(True).alias(whole)),
        key,
        "left",
    )
    named = cut.withColumnsRenamed({"key": key, "kept_text": kept})
    joined = null_safe_join(flagged, named, ["doc_id", key], "left")
    text = F.when(F.col(whole), F.lit("")).otherwise(F.coalesce(F.col(kept), F.col("text")))
    return joined.select(*(text.alias("text") if c == "text" else F.col(c) for c in docs.columns))
