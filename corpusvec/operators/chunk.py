"""Word-aligned chunking of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusvec.functions import text as T

# Sizes of chunks, of their overlap, and of what is too short.
CHUNK_CHARS = 1500
# Lengths that are summed up one after another.
SUM_BLOCK = 256
OVERLAP_CHARS = 200
MIN_CHUNK_CHARS = 20


def _packing_pattern(limit: int) -> str:
    """Greedy packing of single-spaced words, as one regular expression.

    A chunk starts at a word, runs for at most the limit and stops before a
    space or the end; a word beyond the limit stands alone.  The first chunk
    has one character less to spend than the others.
    """
    return (
        rf"\A[^ ].{{0,{limit - 2}}}(?![^ ])"
        rf"|(?!\A)[^ ].{{0,{limit - 1}}}(?![^ ])"
        r"|[^ ]+"
    )


def word_chunks(document: Column, max_len: int = CHUNK_CHARS) -> Column:
    """Array of chunks; a document within the limit is kept verbatim."""
    packed = F.regexp_extract_all(
        T.squeeze(document), F.lit(_packing_pattern(max_len)), F.lit(0)
    )
    whole = F.when(F.length(document) <= max_len, F.array(document))
    return F.when(document.isNotNull(), F.coalesce(whole, packed))


def _sums_before(lengths: Column) -> Column:
    """For each length, the sum of those before it; in blocks, so nearly linear."""
    block = F.lit(SUM_BLOCK)
    starts = F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), block)

    def added(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda total, n: total + n)

    def before(blocks: Column) -> Column:
        return F.aggregate(
            blocks,
            F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all")),
            lambda t, values: F.struct(
                (t["sum"] + added(values)).alias("sum"), F.array_append(t["all"], t["sum"]).alias("all")
            ),
            lambda t: t["all"],
        )

    def inside(values: Column, base: Column) -> Column:
        return F.transform(values, lambda _, i: base + added(F.slice(values, 1, i)))

    return T.bind(
        F.transform(starts, lambda at: F.slice(lengths, at, block)),
        lambda blocks: F.flatten(F.zip_with(blocks, before(blocks), inside)),
    )


_CHUNK_SPANS = "array<struct<start:int,end:int,text:string>>"


def _spanned(texts: Column, starts: Column) -> Column:
    return F.zip_with(
        texts,
        starts,
        lambda text, start: F.struct(
            start.alias("start"), (start + F.length(text)).alias("end"), text.alias("text")
        ),
    ).cast(_CHUNK_SPANS)


def word_spans(document: Column, max_len: int = CHUNK_CHARS) -> Column:
    """``word_chunks`` with where each begins and ends in ``chunked_text``."""
    return T.bind(
        word_chunks(document, max_len),
        # One space lies between a chunk and the next.
        lambda texts: _spanned(texts, _sums_before(F.transform(texts, lambda t: F.length(t) + 1))),
    )


def chunked_text(document: Column, max_len: int = CHUNK_CHARS) -> Column:
    """What ``word_chunks`` are cut from: a document within the limit as it is, others squeezed."""
    return F.when(F.length(document) <= max_len, document).otherwise(T.squeeze(document))


def overlapping_spans(
    document: Column, max_len: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> Column:
    """Single-spaced chunks, each opening with the end of the one before, with where they
    begin and end in the squeezed document.

    One pass over the words keeps where the current chunk starts, in words and in
    characters, and how long it is.  Only at a cut does it look back, and never past the words that
    could fit into the overlap, so the work stays linear in the document.
    """

    def cut(tokens: Column) -> Column:
        return T.bind(
            _cut_with_overlap(tokens, max_len, overlap),
            lambda spans: _spanned(
                F.transform(spans, lambda s: F.array_join(F.slice(tokens, s["start"] + 1, s["stop"] - s["start"]), " ")),
                F.transform(spans, lambda s: s["at"]),
            ),
        )

    return T.bind(
        T.squeeze(document),
        lambda squeezed: F.when(
            F.length(squeezed) <= max_len, _spanned(F.array(squeezed), F.array(F.lit(0)))
        ).otherwise(T.bind(F.split(squeezed, " "), cut)),
    )


def overlapping_chunks(
    document: Column, max_len: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> Column:
    """Array of single-spaced chunks, each opening with the end of the one before."""
    return T.bind(
        T.squeeze(document),
        lambda squeezed: F.when(
            F.length(squeezed) <= max_len, F.array(squeezed)
        ).otherwise(
            T.bind(
                F.split(squeezed, " "),
                lambda tokens: F.transform(
                    _cut_with_overlap(tokens, max_len, overlap),
                    lambda s: F.array_join(F.slice(tokens, s["start"] + 1, s["stop"] - s["start"]), " "),
                ),
            )
        ),
    )


_SPANS = "array<struct<start:int,stop:int,at:int>>"


def _span(start: Column, stop: Column, at: Column) -> Column:
    return F.struct(start.alias("start"), stop.alias("stop"), at.alias("at"))


def _longest_tail(
    tokens: Column, start: Column, stop: Column, overlap: int
) -> Column:
    """Count and joined length of the words before ``stop`` that fit, past ``start``."""
    first = F.greatest(start + 1, stop - (overlap // 2 + 1))
    nearest_first = F.reverse(F.slice(tokens, first + 1, stop - first))

    def state(n: Column, size: Column, full: bool) -> Column:
        return F.struct(n.alias("n"), size.alias("size"), F.lit(full).alias("full"))

    return F.aggregate(
        nearest_first,
        state(F.lit(0), F.lit(0), False),
        lambda acc, w: F.when(
            acc["full"] | (acc["size"] + F.length(w) > overlap),
            state(acc["n"], acc["size"], True),
        ).otherwise(state(acc["n"] + 1, acc["size"] + F.length(w) + 1, False)),
    )


def _cut_with_overlap(tokens: Column, max_len: int, overlap: int) -> Column:
    def state(i: Column, start: Column, at: Column, size: Column, cuts: Column) -> Column:
        return F.struct(
            i.alias("i"), start.alias("start"), at.alias("at"), size.alias("size"), cuts.alias("cuts")
        )

    def step(acc: Column, word: Column) -> Column:
        i, start, at, size = acc["i"], acc["start"], acc["at"], acc["size"]
        opened = i > start
        cut = T.bind(
            _longest_tail(tokens, start, i, overlap),
            lambda tail: state(
                i + 1,
                i - tail["n"],
                # The word lies a space behind the chunk, and the tail, with a space after
                # each of its words, before it.
                at + size + 1 - tail["size"],
                tail["size"] + F.length(word),
                F.array_append(acc["cuts"], _span(start, i, at)),
            ),
        )
        grown = state(
            i + 1,
            start,
            at,
            size + F.length(word) + F.when(opened, 1).otherwise(0),
            acc["cuts"],
        )
        overfull = opened & (size + 1 + F.length(word) > max_len)
        return F.when(overfull, cut).otherwise(grown)

    return F.aggregate(
        tokens,
        state(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.array().cast(_SPANS)),
        step,
        lambda acc: F.array_append(acc["cuts"], _span(acc["start"], acc["i"], acc["at"])),
    )


def _explode_chunks(df: DataFrame, document: str, chunks: Column) -> DataFrame:
    kept = [c for c in df.columns if c not in (document, "chunk", "text")]
    return df.select(*kept, F.posexplode(chunks).alias("chunk", "text"))


def chunk_words(
    df: DataFrame, document: str = "document", max_len: int = CHUNK_CHARS
) -> DataFrame:
    """One row per chunk: the other columns plus ``chunk`` and ``text``."""
    return _explode_chunks(df, document, word_chunks(F.col(document), max_len))


def chunk_words_overlap(
    df: DataFrame,
    document: str = "document",
    max_len: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    chunks = overlapping_chunks(F.col(document), max_len, overlap)
    return _explode_chunks(df, document, chunks)


def drop_short_chunks(df: DataFrame, min_chars: int = MIN_CHUNK_CHARS) -> DataFrame:
    """Drop near-empty chunks; the others keep their numbers."""
    return df.filter(F.length(T.strip(F.col("text"))) >= min_chars)


def chunk_stats(
    df: DataFrame,
    doc_id: str = "doc_id",
    document: str = "document",
    max_len: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
    spans: str | None = None,
) -> DataFrame:
    """Overlapping chunks with their id, position and size.

    The per-document count is the size of the chunk array, attached to every
    chunk before the explode, so it needs no shuffle.  ``spans`` is a column that has
    the chunks already.
    """
    found = overlapping_spans(F.col(document), max_len, overlap) if spans is None else F.col(spans)
    sized = T.bind(
        found,
        lambda chunks: F.transform(
            chunks,
            lambda c, i: F.struct(
                i.alias("chunk_index"),
                F.size(chunks).alias("chunk_count"),
                c["text"].alias("text"),
            ),
        ),
    )
    return df.select(F.col(doc_id).alias("doc_id"), F.inline(sized)).select(
        F.concat(
            F.col("doc_id").cast("string"),
            F.lit("__chunk_"),
            T.padded(F.col("chunk_index"), 3),
        ).alias("chunk_id"),
        "doc_id",
        "chunk_index",
        "chunk_count",
        F.length("text").alias("char_count"),
        # These chunks are single-spaced already.
        F.when(F.col("text") == "", 0)
        .otherwise(F.size(F.split("text", " ")))
        .alias("word_count"),
        "text",
    )
