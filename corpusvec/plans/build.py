"""From source files to a published index, as one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusvec.functions import text as T
from corpusvec.operators import assemble as A
from corpusvec.operators import quality as Q
from corpusvec.operators.chunk import (
    CHUNK_CHARS,
    OVERLAP_CHARS,
    chunk_stats,
    chunk_words,
    drop_short_chunks,
    overlapping_spans,
)
from corpusvec.operators.embed import Embedder, embed_chunks
from corpusvec.operators.ordinals import SHARD_VECTORS, assign_vec_ids, cluster_by_runs, row_sizes
from corpusvec.session import settle
from corpusvec.sinks.publish import publish_verified
from corpusvec.sources.files import scan_directory, scan_text_dir
from corpusvec.sources.index_store import Index

PROVENANCE = ("source", "file_index", "row")


def assemble_records(records: DataFrame, kind: str) -> DataFrame:
    """``source, file_index, row, title[, arxiv_id], labels, document`` of parsed records.

    ``kind`` is article, qa or paper.  The labels a search can be restricted by
    are ``categories`` and ``is_featured``, ``tags``, or ``categories``.  A record
    without a document keeps its row, with a NULL document.
    """
    v = F.col("v")
    carried = [c for c in PROVENANCE if c in records.columns]
    if kind == "article":
        fields, assemble, kept = A.article_fields(v), A.assemble_articles, ["title", "categories", "is_featured"]
    elif kind == "qa":
        fields, assemble, kept = A.qa_fields(v), A.assemble_qa, ["title", "tags"]
    elif kind == "paper":
        fields, assemble, kept = A.paper_fields(v), A.assemble_papers, ["title", "arxiv_id", F.col("category_list").alias("categories")]
    else:
        raise ValueError(f"unknown kind of record: {kind}")
    typed = records.select(*carried, *(c.alias(n) for n, c in fields.items()))
    return assemble(typed).select(*carried, *kept, A.DOCUMENT)


def documents_to_chunks(documents: DataFrame) -> DataFrame:
    """Provenance, ``chunk`` and ``text`` of every chunk worth keeping."""
    return drop_short_chunks(chunk_words(A.drop_empty_documents(documents)))


def documents_to_entries(
    documents: DataFrame, embedder: Embedder, shard_size: int | None = None
) -> DataFrame:
    """Numbered, embedded chunks; with a shard size, in the layout of its files."""
    return chunks_to_entries(documents_to_chunks(documents), embedder, shard_size)


def chunks_to_entries(
    chunks: DataFrame,
    embedder: Embedder,
    shard_size: int | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """``documents_to_entries`` of documents that are cut into chunks already.

    Rows are numbered and laid out before they are embedded, so shuffles carry
    text but never vectors.  ``sizes`` is ``row_sizes`` of the chunks, if known.
    """
    numbered = assign_vec_ids(chunks, sizes=sizes)
    titled = numbered.withColumn(
        "title", F.left(F.coalesce("title", F.lit("")), F.lit(A.TITLE_CHARS))
    )
    if shard_size is not None:
        titled = cluster_by_runs(titled, shard_size)
    return embed_chunks(titled, embedder)


def expected_chunks(documents: DataFrame) -> DataFrame:
    """One row: how many chunks the documents have, from array sizes alone."""
    return Q.ingest_counts(documents).agg(
        F.coalesce(F.sum("chunks"), F.lit(0)).alias("n_expected")
    )


def build_index(
    spark: SparkSession,
    documents: DataFrame,
    path: str,
    embedder: Embedder,
    dataset: str,
    model: str,
    source_path: str = "",
    shard_size: int = SHARD_VECTORS,
    labels: Sequence[str] = (),
) -> Index:
    """Chunk, number, embed, stage, verify and publish.

    The documents are read and cut once.  The stored chunks are read twice: for the number
    of chunks of each document, which numbers them and says how many there have to be, without
    their texts, and for the chunks.
    """
    chunks = settle(documents_to_chunks(documents), "chunks")
    sizes = row_sizes(chunks)
    return publish_verified(
        spark,
        chunks_to_entries(chunks, embedder, shard_size, sizes),
        path,
        dataset=dataset,
        model=model,
        dimension=embedder.dim,
        source_path=source_path,
        expected_chunks=sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_expected")),
        shard_size=shard_size,
        clustered=True,
        labels=labels,
        resume_mode=False,
    )


def index_directory(
    spark: SparkSession,
    source_path: str,
    path: str,
    kind: str,
    embedder: Embedder,
    dataset: str,
    model: str,
) -> tuple[Index, DataFrame]:
    """Index a directory of JSONL and Parquet files; also the rejected rows."""
    good, bad = Q.quarantine_malformed(scan_directory(spark, source_path), kind)
    documents = assemble_records(good, kind)
    index = build_index(spark, documents, path, embedder, dataset, model, source_path)
    return index, bad


def index_texts(
    spark: SparkSession,
    source_path: str,
    path: str,
    embedder: Embedder,
    dataset: str,
    model: str,
    max_len: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
    shard_size: int = SHARD_VECTORS,
) -> Index:
    """Index a directory of ``.txt`` files, a document each, in overlapping chunks.

    Entries have ``chunk_id, doc_id, chunk_index, chunk_count, char_count, word_count`` and the
    text; they are numbered by document and chunk.  The manifest has the number of documents and
    the quality of the chunks, which are judged by where they lie in their documents.
    """
    texts = scan_text_dir(spark, source_path).select("doc_id", T.squeeze(F.col("text")).alias("document"))
    # Files are opened and cut into chunks once, where they were dealt to.
    spanned = settle(
        texts.filter(F.col("document") != "").withColumn(
            "spans", overlapping_spans(F.col("document"), max_len, overlap)
        ),
        "spans",
    )
    chunks = chunk_stats(spanned, spans="spans").withColumn("source", F.col("doc_id"))
    keys = ("doc_id", "chunk_index")
    sizes = row_sizes(chunks, keys)
    numbered = cluster_by_runs(assign_vec_ids(chunks, keys, sizes=sizes), shard_size)
    rates = Q.chunk_quality(spanned).first()
    found = sizes.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()
    return publish_verified(
        spark,
        embed_chunks(numbered, embedder),
        path,
        dataset=dataset,
        model=model,
        dimension=embedder.dim,
        source_path=source_path,
        expected_chunks=spark.range(1).select(F.lit(found["n"]).alias("n_expected")),
        shard_size=shard_size,
        clustered=True,
        documents=found["documents"],
        self_contained=rates["self_contained"],
        mid_word_breaks=rates["mid_word_breaks"],
    )


def text_index_summary(index: Index, purpose: str = "") -> DataFrame:
    """The manifest of an index of texts, in one row with a ``quality`` block."""
    # The field names of this manifest.
    return index.summary.select(
        F.col("integrity_status").alias("status"),
        F.col("total_vectors").alias("vector_count"),
        F.col("total_vectors").alias("chunk_count"),
        F.col("embedding_dimension").alias("dimensions"),
        "embedding_model",
        "index_type",
        F.struct("self_contained", "mid_word_breaks").alias("quality"),
        "documents",
        F.lit(purpose).alias("purpose"),
        F.left("date_completed", F.lit(10)).alias("created_date"),
    )


def dry_run(documents: DataFrame, by: str = "length") -> DataFrame:
    """Estimated chunks per source, before anything is embedded."""
    if by == "length":
        return Q.estimate_chunks_by_length(documents)
    return Q.estimate_chunks_by_rows(documents)
