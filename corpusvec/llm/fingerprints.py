"""Document fingerprints: one-permutation MinHash in built-in columns.

A shingle is ``shingle`` words, A-Z lower-cased; fewer words are one shingle.  Each
shingle is hashed once: the top bits of the hash name one of the bins, the rest is
its value, and a bin keeps its smallest.  An end mark for each bin is sorted among the
hashes, so the first of each run of equal top bits is the bin's minimum, or the mark if
the bin is empty: one sort, no hash function per bin.

Empty bins are filled by optimal densification: each has a random order of all bins of
its own, the same for every text, and borrows from the first that is not empty.  The
order is a few probes from a fixed table, then all bins by a hash of the pair.

The fingerprint has the low ``BITS`` bits of a hash of bin and value, packed, 8 bins to
a long.  Unequal values agree in them by chance, once in ``2 ** BITS`` bins; the
``likeness`` of two fingerprints is the share of agreeing bins without what chance gives
(negative estimates are 0).  Its standard error is sqrt(J (1 - J) / BINS).

Nothing but built-in columns: no shuffle moves a word or a shingle.  Equal texts have
equal fingerprints.  NULL is an empty text.  A text without words has an empty
fingerprint, which is like (1) any other such and unlike (0) all else.  Repeated rows
are fingerprinted each.  A very long text is an array of its words inside its row, some
ten times its bytes.  ``fingerprinted`` keeps all columns.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusvec.functions.text import bind
from corpusvec.llm.common import ascii_lower, unused, words
from corpusvec.session import settle

SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
BITS = 8
PER_LONG = 64 // BITS
# Bins that are tried one by one before all are looked at.
PROBES = 8

_VALUE_BITS = 64 - BIN_BITS
# An empty bin's mark: the largest value a bin can have.
_MARK = (1 << _VALUE_BITS) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def probe(number: int, attempt: int) -> int:
    """The bin that an empty one tries, by its number."""
    return xxhash.xxh64_intdigest(f"{number} {attempt}", 42) % BINS


def _array(values: list[int], kind: str) -> Column:
    """A constant array, written as one string and folded when the query is planned."""
    return F.split(F.lit(" ".join(map(str, values))), " ").cast(f"array<{kind}>")


# Bins ----------------------------------------------------------------------------


def _bin(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, _VALUE_BITS)


def _shingle_hashes(text: Column, shingle: int) -> Column:
    """A hash per shingle, repeats included; none for a text without words."""
    hashes = F.transform(words(ascii_lower(text)), lambda w: F.xxhash64(w))

    def joined(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - shingle)
        return (
            F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
            .when(F.size(h) < shingle, F.array(F.xxhash64(h)))
            .otherwise(F.transform(starts, lambda i: F.xxhash64(*(h[i + k] for k in range(shingle)))))
        )

    return bind(hashes, joined)


def _minima(hashes: Column) -> Column:
    """A hash per bin: its smallest, or the bin's mark."""
    marks = _array([_signed(b << _VALUE_BITS | _MARK) for b in range(BINS)], "bigint")
    ranked = F.sort_array(F.concat(hashes, marks))
    return bind(
        ranked, lambda r: F.filter(r, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(r, i - 1))))
    )


def _is_mark(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(_MARK)) == _MARK


def _filled(minima: Column) -> Column:
    """The minima with every empty bin's borrowed."""
    table = _array([probe(b, t) for b in range(BINS) for t in range(PROBES)], "int")

    def fill(m: Column, given: Column) -> Column:
        tried = []
        for t in range(PROBES):
            tried.append(lambda i, t=t: F.get(m, F.get(table, i * PROBES + t)))

        def donor(i: Column) -> Column:
            found = F.lit(None).cast("bigint")
            for look in reversed(tried):
                found = F.when(~_is_mark(look(i)), look(i)).otherwise(found)
            ranked = F.transform(given, lambda x: F.struct(F.xxhash64(i, _bin(x)).alias("rank"), x.alias("x")))
            return F.coalesce(found, F.array_min(ranked)["x"])

        return F.transform(m, lambda x, i: F.when(_is_mark(x), donor(i)).otherwise(x))

    return bind(
        minima, lambda m: bind(F.filter(m, lambda x: ~_is_mark(x)), lambda given: fill(m, given))
    )


def _packed(filled: Column) -> Column:
    """Low bits of each bin's hashed value, ``PER_LONG`` bins to a long."""
    low = F.transform(filled, lambda x, i: F.xxhash64(x, i).bitwiseAND(F.lit((1 << BITS) - 1)))
    return bind(
        low,
        lambda bits: F.transform(
            F.sequence(F.lit(0), F.lit(BINS // PER_LONG - 1)),
            lambda j: F.aggregate(
                F.slice(bits, j * PER_LONG + 1, F.lit(PER_LONG)),
                F.lit(0).cast("bigint"),
                lambda packed, b: F.shiftleft(packed, BITS).bitwiseOR(b),
            ),
        ),
    )


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text as an array of longs; empty for a text without words."""
    return bind(
        _shingle_hashes(text, shingle),
        lambda h: F.when(F.size(h) == 0, h).otherwise(_packed(_filled(_minima(h)))),
    )


def as_text(packed: Column) -> Column:
    """A fingerprint in lower-case hexadecimal."""
    return F.lower(F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """The estimated share of common shingles of two fingerprints, 0 to 1."""

    def unequal(x: Column, y: Column) -> Column:
        # The lowest bit of each byte of d collects all bits of that byte.
        def bytes_set(d: Column) -> Column:
            for step in (4, 2, 1):
                d = d.bitwiseOR(F.shiftrightunsigned(d, step))
            return F.bit_count(d.bitwiseAND(F.lit(0x0101010101010101)))

        return bytes_set(x.bitwiseXOR(y))

    differing = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda n, d: n + d)
    chance = 2.0**-BITS
    share = (1 - differing / F.lit(float(BINS)) - chance) / (1 - chance)
    both = (F.size(a) > 0) & (F.size(b) > 0)
    return F.when(both, F.greatest(F.lit(0.0), share)).otherwise((F.size(a) == F.size(b)).cast("double"))


def fingerprinted(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """All rows and columns of ``docs``, and ``fingerprint``; one that is there is replaced."""
    return docs.withColumn("fingerprint", fingerprint(F.col("text"), shingle))


# Neighbours ----------------------------------------------------------------------


def _range_tops(keys: DataFrame, ranges: int) -> DataFrame:
    """One row: ``tops``, the largest key of each of about ``ranges`` even ranges, descending."""
    within = keys.repartitionByRange(ranges, F.desc("key")).groupBy(F.spark_partition_id().alias("part"))
    return within.agg(F.max("key").alias("top")).agg(
        F.sort_array(F.collect_list("top"), asc=False).alias("tops")
    )


def _range_of(key: Column, tops: Column) -> Column:
    """The number of the last top that is not below the key, by bisection."""

    def halve(state: Column, _: Column) -> Column:
        middle = F.shiftright(state["low"] + state["high"] + 1, 1)
        above = F.get(tops, middle) >= key
        return F.struct(
            F.when(above, middle).otherwise(state["low"]).alias("low"),
            F.when(above, state["high"]).otherwise(middle - 1).alias("high"),
        )

    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(tops) + 1)).cast("int") + 1)
    start = F.struct(F.lit(0).alias("low"), (F.size(tops) - 1).alias("high"))
    return F.aggregate(steps, start, halve, lambda state: state["low"])


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The rows and columns of ``docs``, and ``next``: the given columns of the row that comes
    after it by descending ``doc_id``; after the last comes the first.

    Rows are dealt into ranges of even row counts, and the first row of each range also
    goes behind the end of the one before: the texts are shuffled once, and no task
    sees more than a range.  Rows with the same ``doc_id`` come by a hash of the text, then
    by text, so that they can be spread as well; NULL comes last.
    """
    spark = docs.sparkSession
    key, tops, number, place, guest = unused(docs.columns, "key", "tops", "range", "place", "guest")
    follows = unused([*docs.columns, key, tops, number, place, guest], *(f"next_{c}" for c in columns))
    order_key = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    keys = settle(docs.select(order_key.alias("key")), "neighbour-keys")
    # Several ranges to a task, since they are dealt by hash.
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = settle(_range_tops(keys, ranges), "neighbour-ranges")
    keyed = docs.select("*", order_key.alias(key), found.scalar().alias(tops))
    placed = keyed.withColumn(number, _range_of(F.col(key), F.col(tops)))
    first = F.get(tops, F.col(number)) == F.col(key)
    here = F.struct(F.lit(False).alias("guest"), F.col(number).alias("range"))
    before = F.pmod(F.col(number) - 1, F.size(tops))
    ahead = F.struct(F.lit(True).alias("guest"), before.alias("range"))
    dealt = placed.withColumn(
        place, F.explode(F.when(first, F.array(here, ahead)).otherwise(F.array(here)))
    ).select(*docs.columns, key, F.col(place)["guest"].alias(guest), F.col(place)["range"].alias(number))
    order = Window.partitionBy(number).orderBy(F.asc(guest), F.desc(key), F.desc("text"))
    following = dealt.select("*", *(F.lead(c).over(order).alias(n) for c, n in zip(columns, follows)))
    return following.filter(~F.col(guest)).select(
        *(c for c in docs.columns if c != "next"),
        F.struct(*(F.col(n).alias(c) for c, n in zip(columns, follows))).alias("next"),
    )


def compare_edited(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Fingerprints of every row of ``doc_id, text`` and of its edited text, and how alike they are.

    The edited text has the first code points of the next row's text in place of the last
    half of its own.  Returns ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    paired = with_next(fingerprinted(texts, shingle), ["text", "fingerprint"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.left("text", F.col("n_chars").cast("int") - half), F.left(F.col("next.text"), half)
    )
    both = (
        paired.withColumn("n_chars", F.length("text").cast("long"))
        .select("doc_id", "n_chars", "fingerprint", F.col("next.fingerprint").alias("next"), edited.alias("edited"))
        .withColumn("edited_fingerprint", fingerprint(F.col("edited"), shingle))
    )
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("fingerprint")).alias("fingerprint"),
        as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
    )
