"""Counts, estimates and quality rates of a corpus and its index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusvec.functions import text as T
from corpusvec.functions import variants as V
from corpusvec.operators.chunk import CHUNK_CHARS, MIN_CHUNK_CHARS, word_chunks
from corpusvec.operators.ordinals import SHARD_VECTORS, shard_of, whole_parts

# Chunks guessed per row, and the bounds that quality has to meet.
CHUNKS_PER_ROW = 1.5
MAX_MID_WORD_BREAKS = 0.02
MIN_SELF_CONTAINED = 0.95


# Estimates before indexing -------------------------------------------------


def estimate_chunks_by_length(df: DataFrame, size: int = CHUNK_CHARS) -> DataFrame:
    """Per source: documents that assemble, and chunks guessed from their length."""
    length = F.length("document")
    return (
        df.filter(F.col("document").isNotNull())
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("documents"),
            F.sum(F.greatest(F.lit(1), whole_parts(length, size))).alias("estimated_chunks"),
        )
    )


def estimate_chunks_by_rows(df: DataFrame, factor: float = CHUNKS_PER_ROW) -> DataFrame:
    """Per source: all rows, and chunks guessed from their number, rounded down."""
    return (
        df.groupBy("source")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("estimated_chunks", F.floor(F.col("rows") * F.lit(factor)))
    )


def estimate_total(estimates: DataFrame, unit: str) -> DataFrame:
    return estimates.agg(
        F.sum(unit).alias(unit), F.sum("estimated_chunks").alias("estimated_chunks")
    )


def estimate_vs_actual(estimates: DataFrame, chunks: DataFrame) -> DataFrame:
    """Per source: the estimate beside the real number of chunks."""
    actual = chunks.groupBy("source").agg(F.count(F.lit(1)).alias("actual_chunks"))
    return estimates.join(actual, "source", "left").select(
        "source",
        "estimated_chunks",
        F.coalesce("actual_chunks", F.lit(0)).alias("actual_chunks"),
        (F.col("estimated_chunks") - F.coalesce("actual_chunks", F.lit(0))).alias("difference"),
    )


# Counts --------------------------------------------------------------------


def chunks_per_document(
    chunks: DataFrame, document_keys: list[str], corpus: str = "source"
) -> DataFrame:
    """Per corpus: documents, chunks, and chunks per document.

    Chunks are added up per document before documents are added up per corpus,
    so a large corpus is no single task's work.
    """
    keys = list(dict.fromkeys([corpus, *document_keys]))
    per_document = chunks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_document.groupBy(corpus).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("n").alias("chunks"),
        F.avg("n").alias("chunks_per_document"),
    )


def corpus_totals(entries: DataFrame, corpus: str = "dataset") -> DataFrame:
    """Vectors per corpus and, where the corpus is NULL, in all."""
    return entries.rollup(corpus).agg(F.count(F.lit(1)).alias("vectors"))


def ingest_counts(records: DataFrame) -> DataFrame:
    """Per source: what became of its rows.

    Expects ``source``, ``document`` and, for raw lines, ``malformed``.  Chunks
    are counted as array sizes, so no row is exploded.
    """
    malformed = F.col("malformed") if "malformed" in records.columns else F.lit(False)
    no_sizes = F.array().cast("array<int>")
    counted = records.select(
        "source",
        malformed.alias("malformed"),
        F.col("document").isNull().alias("empty"),
        F.coalesce(
            F.transform(
                word_chunks(F.col("document")), lambda c: F.length(T.strip(c))
            ),
            no_sizes,
        ).alias("sizes"),
    ).select(
        "source",
        "malformed",
        "empty",
        F.size("sizes").alias("n_all"),
        F.size(F.filter("sizes", lambda n: n < MIN_CHUNK_CHARS)).alias("n_short"),
    )
    return counted.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("malformed").alias("malformed"),
        F.count_if(F.col("empty") & ~F.col("malformed")).alias("skipped_empty"),
        F.sum(F.col("n_all") - F.col("n_short")).alias("chunks"),
        F.sum("n_short").alias("dropped_short"),
    )


def shard_accounting(entries: DataFrame, shard_size: int = SHARD_VECTORS) -> DataFrame:
    """Vectors per shard; every shard but the last should be full."""
    return (
        entries.groupBy(shard_of(F.col("vec_id"), shard_size).alias("shard_id"))
        .agg(F.count(F.lit(1)).alias("vectors"))
        .withColumn("full", F.col("vectors") == shard_size)
    )


# Chunk quality -------------------------------------------------------------


def _clean_edges(text: Column, span: Column) -> Column:
    """Whether whitespace, or an end of the text, lies at either end of a span."""

    def blank(at: Column) -> Column:
        # Of the character at that position; outside the text there is none.
        return T.strip(F.substr(text, at, F.lit(1))) == ""

    left = (span["start"] <= 0) | blank(span["start"]) | blank(span["start"] + 1)
    right = (span["end"] >= F.length(text)) | blank(span["end"] + 1) | blank(span["end"])
    return (span["start"] < span["end"]) & left & right


def judged_spans(text: Column, spans: Column) -> Column:
    """``clean, long_enough, valid`` of every span of a text; NULL text has no clean edge.

    Spans that cover a text from word to word are what a chunker should give; one comparison
    of them all with the text tells.  Only where it fails is each looked at by itself.
    """
    # What a span adds behind the end of the one before, and all of them, a space between each.
    added = F.transform(
        spans,
        lambda s, i: F.substr(
            s["text"],
            F.greatest(F.coalesce(F.get(spans, i - 1)["end"], F.lit(-1)) + 2 - s["start"], F.lit(1)),
        ),
    )
    whole = F.coalesce(F.array_join(added, " ") == text, F.lit(False)) & F.forall(
        spans, lambda s: s["end"] - s["start"] == F.length(s["text"])
    )

    def judge(s: Column, all_clean: Column) -> Column:
        clean = F.when(all_clean, F.lit(True)).otherwise(F.coalesce(_clean_edges(text, s), F.lit(False)))
        return F.struct(
            clean.alias("clean"),
            (F.length(T.squeeze(s["text"])) >= MIN_CHUNK_CHARS).alias("long_enough"),
            F.is_valid_utf8(s["text"]).alias("valid"),
        )

    return T.bind(whole, lambda all_clean: F.transform(spans, lambda s: judge(s, all_clean)))


def chunk_quality(documents: DataFrame, text: str = "document", spans: str = "spans") -> DataFrame:
    """Rates of cut words and of self-contained chunks, and whether they pass.

    ``spans`` has where the chunks of ``text`` begin and end, so each is judged in the row of
    its own document.  Our definition: an edge of a chunk is clean if whitespace or an end of
    the text lies there.  A mid-word break is a chunk with an edge that is not clean; a
    self-contained chunk has two clean edges, is long enough, and is valid UTF-8.
    """
    judged = documents.select(F.inline(judged_spans(F.col(text), F.col(spans))))
    rates = judged.agg(
        F.count(F.lit(1)).alias("chunks"),
        F.avg((~F.col("clean")).cast("int")).alias("mid_word_breaks"),
        F.avg(
            (F.col("clean") & F.col("long_enough") & F.col("valid")).cast("int")
        ).alias("self_contained"),
    )
    return rates.withColumn(
        "passed",
        (F.col("mid_word_breaks") < MAX_MID_WORD_BREAKS)
        & (F.col("self_contained") > MIN_SELF_CONTAINED),
    )


# Malformed records ---------------------------------------------------------


def _not_text(record: Column, name: str) -> Column:
    """Present, with any other type than text, null included."""
    value = V.field(record, name)
    return ~V.is_missing(value) & ~V.is_string(value)


def _rejections(kind: str | None, record: Column) -> list[tuple[str, Column]]:
    if kind is None:
        return []
    if kind == "article":
        return [(f"ill-typed {n}", _not_text(record, n)) for n in ("title", "text")]
    if kind == "qa":
        title = V.first_truthy(record, "title", "Title")
        return [("ill-typed title", title.isNotNull() & ~V.is_string(title))]
    if kind == "paper":
        both = ~V.is_missing(V.field(record, "text")) & ~V.is_missing(V.field(record, "meta"))
        return [
            ("ill-typed meta", both & ~V.is_object(V.field(record, "meta"))),
            ("ill-typed text", both & _not_text(record, "text")),
            ("ill-typed title", _not_text(record, "title")),
            ("ill-typed abstract", ~both & _not_text(record, "abstract")),
        ]
    raise ValueError(f"unknown kind of record: {kind}")


def quarantine_malformed(
    df: DataFrame, kind: str | None = None, record: str = "v"
) -> tuple[DataFrame, DataFrame]:
    """Split parsed lines into good ones and rejects with a reason.

    ``kind`` (article, qa, paper) adds the field types that record form needs.
    A bad row costs that row only.
    """
    v = F.col(record)
    reason = F.when(v.isNull(), F.lit("malformed JSON")).when(
        ~V.is_object(v), F.lit("not an object")
    )
    for name, test in _rejections(kind, v):
        reason = reason.when(test, F.lit(name))
    judged = df.withColumn("reason", reason)
    good = judged.filter(F.col("reason").isNull()).drop("reason")
    bad = judged.filter(F.col("reason").isNotNull()).drop(record)
    return good, bad
