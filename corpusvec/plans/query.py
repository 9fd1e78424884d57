"""Answering text queries from an index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusvec.functions import text as T
from corpusvec.operators.embed import Embedder, embed_chunks
from corpusvec.operators.search import topk_batch, topk_with_sources
from corpusvec.sources.index_store import Index, lookup


def embed_queries(
    queries: DataFrame, embedder: Embedder, query_id: str = "query_id", text: str = "text"
) -> DataFrame:
    """``query_id, vector`` of query texts, encoded as queries."""
    named = queries.select(F.col(query_id).alias("query_id"), F.col(text).alias("text"))
    return embed_chunks(named, embedder, kind="query").select("query_id", "vector")


def search_text(
    entries: DataFrame, queries: DataFrame, embedder: Embedder, k: int = 3
) -> DataFrame:
    """Ranked hits of text queries, with preview and provenance."""
    return topk_with_sources(entries, embed_queries(queries, embedder), k)


def search_index(index: Index, queries: DataFrame, embedder: Embedder, k: int = 3) -> DataFrame:
    """As ``search_text``, on a published index: only files with a hit give up text."""
    hits = topk_batch(index.vectors, embed_queries(queries, embedder), k)
    return lookup(index, hits).withColumn("preview", T.preview(F.col("text"))).drop("text")
