"""Exact inner-product search over a table of vectors.

Scoring runs as blocked matrix products inside Arrow batches.  Vectors never
move: queries go to the tasks that scan the index, in blocks that lie on the disk of
each executor and are read one after another, so that a query set of any size is one
scan.  Each task keeps its own best k per query,
so what leaves a task is bounded by k times the queries, never by the vectors it
read.  Ranking is by descending score and then ascending vector id.  NULL, ragged
and non-finite vectors have no rank and are an error.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusvec.functions import text as T
from corpusvec.functions import vectors as V
from corpusvec.operators.ordinals import shard_of
from corpusvec.session import broadcast_if_small, settle

DEFAULT_K = 10

# Scores are ranked at nine decimals.  That is finer than single precision and
# coarse enough that equal vectors tie however a sum happened to be ordered, so
# ranks do not depend on batches or partitions.
SCORE_DECIMALS = 9

# Queries that travel with the tasks at a time, as a matrix.
BLOCK_BYTES = 64 << 20
# Cells of the score matrix held at a time.
_SCORE_CELLS = 4_000_000
# Hits of all indexes that one task holds before it hands them on.
_OPEN_BYTES = 64 << 20
_HIT_BYTES = 24

# Lower bounds of the score bands.
SCORE_BANDS = (
    (0.90, "near-identical"),
    (0.80, "strongly related"),
    (0.70, "topically related"),
)
WEAK_BAND = "weak"


# Kernel --------------------------------------------------------------------


def _matrix(vectors: pa.Array) -> np.ndarray:
    """An Arrow list array as a dense double matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if vectors.null_count:
        raise ValueError("a vector is NULL; validate the vectors before searching")
    if len(vectors) == 0:
        return np.zeros((0, 0))
    sizes = pc.list_value_length(vectors)
    if pc.min(sizes).as_py() != pc.max(sizes).as_py():
        raise ValueError("vectors differ in dimension")
    flat = vectors.flatten()
    if flat.null_count:
        raise ValueError("a vector has a NULL component")
    matrix = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    if not np.isfinite(matrix).all():
        raise ValueError("a vector has a component that is not finite")
    return matrix


def _rounded(scores: np.ndarray) -> np.ndarray:
    # Adding zero turns -0.0 into 0.0.
    return np.round(scores, SCORE_DECIMALS) + 0.0


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best entries per query, in rank order."""
    order = np.lexsort((ids, -score, query))
    sorted_query = query[order]
    starts = np.flatnonzero(np.r_[True, sorted_query[1:] != sorted_query[:-1]])
    counts = np.diff(np.r_[starts, len(order)])
    rank = np.arange(len(order)) - np.repeat(starts, counts)
    return order[rank < k]


class _TopK:
    """Running best k per query over any number of batches.

    Once a query has k hits, its worst one is the bar: a later score below it
    is dropped by one comparison.
    """

    def __init__(self, k: int, queries: int):
        self.k, self.queries = k, queries
        self.bar = np.full(queries, -np.inf)
        self.query = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int64)
        self.score = np.zeros(0)

    def add(self, ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray) -> None:
        if len(ids) and vectors.shape[1] != queries.shape[1]:
            raise ValueError("queries and vectors differ in dimension")
        step = max(1, _SCORE_CELLS // max(1, self.queries))
        for at in range(0, len(ids), step):
            self._merge(ids[at : at + step], queries @ vectors[at : at + step].T)

    def _merge(self, ids: np.ndarray, scores: np.ndarray) -> None:
        bar, n = self.bar, len(ids)
        if n > self.k and np.isneginf(bar).any():
            bar = np.maximum(bar, np.partition(scores, n - self.k, axis=1)[:, n - self.k])
        # What rounds to the bar or above it stays in until ids decide.
        query, column = np.nonzero(scores >= (bar - 10.0**-SCORE_DECIMALS * 1.01)[:, None])
        if not len(query):
            return
        all_query = np.concatenate([self.query, query])
        all_ids = np.concatenate([self.ids, ids[column]])
        all_scores = np.concatenate([self.score, _rounded(scores[query, column])])
        kept = _best(all_query, all_ids, all_scores, self.k)
        self.query, self.ids, self.score = all_query[kept], all_ids[kept], all_scores[kept]
        hits = np.bincount(self.query, minlength=self.queries)
        last = np.cumsum(hits) - 1
        full = hits == self.k
        self.bar[full] = self.score[last[full]]


def _hits_batch(query_ids: pa.Array, best: _TopK, index_id=None) -> pa.RecordBatch:
    columns = {
        "query_id": query_ids.take(pa.array(best.query)),
        "vec_id": pa.array(best.ids),
        "score": pa.array(best.score),
    }
    if index_id is not None:
        columns["index_id"] = pa.array([index_id] * len(best.ids), pa.string())
    return pa.RecordBatch.from_pydict(columns)


def _hit_schema(query_type: str, with_index: bool) -> str:
    schema = f"query_id {query_type}, vec_id bigint, score double"
    return schema + (", index_id string" if with_index else "")


# Query sets ----------------------------------------------------------------


def _query_type(queries: DataFrame) -> str:
    return queries.schema["query_id"].dataType.simpleString()


def _dimension(queries: DataFrame) -> int:
    first = queries.select(F.size("vector").alias("dim")).head()
    return 1 if first is None else max(1, first["dim"])


def _query_blocks(queries: DataFrame, block_bytes: int) -> Iterator[pa.Table]:
    """The query set in blocks of about ``block_bytes``, one at a time on the driver.

    Queries are stored first, so their vectors are computed once.
    """
    selected = queries.select("query_id", V.to_double(F.col("vector")).alias("vector"))
    kept = settle(selected, "queries")
    blocks = max(1, -(-kept.count() * 8 * _dimension(kept) // block_bytes))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    for i in range(blocks):
        yield kept.filter(block == i).toArrow()


def _sent(spark: SparkSession, block: pa.Table) -> Broadcast:
    """Ids and matrix of a block, on their way to the executors' disks."""
    return spark.sparkContext.broadcast((_one_array(block["query_id"]), _matrix(block["vector"])))


def _received(block: Broadcast, keep: bool) -> tuple[pa.Array, np.ndarray]:
    """What was sent, read from the executor's disk; it is not held unless it is all there is."""
    value = block.value
    if not keep:
        block.__dict__.pop("_value", None)
    return value


def _one_array(column: pa.ChunkedArray) -> pa.Array:
    merged = column.combine_chunks()
    return pa.concat_arrays(merged.chunks) if isinstance(merged, pa.ChunkedArray) else merged


def _check_k(k: int) -> None:
    if k < 1:
        raise ValueError(f"k must be at least 1, not {k}")


# Local search --------------------------------------------------------------


def _local_hits(index: DataFrame, blocks: Sequence[Broadcast], query_type: str, k: int) -> DataFrame:
    """Best k per query (and index, if there is an index_id) of every task.

    A batch of vectors meets the blocks of queries one after another.
    """
    _check_k(k)
    with_index = "index_id" in index.columns

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # By block and index: the ids of the block's queries, and their best hits.
        open_states: dict[tuple[int, str | None], tuple[pa.Array, _TopK]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (_, index_id), (query_ids, best) in open_states.items():
                if len(best.ids):
                    yield _hits_batch(query_ids, best, index_id)
            open_states.clear()

        def add(number: int, block: Broadcast, parts: list[tuple[str | None, np.ndarray, np.ndarray]]) -> None:
            query_ids, matrix = _received(block, keep=len(blocks) == 1)
            for index_id, ids, vectors in parts if len(query_ids) else ():
                state = open_states.setdefault((number, index_id), (query_ids, _TopK(k, len(query_ids))))
                state[1].add(ids, vectors, matrix)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            vectors = _matrix(batch.column("vector"))
            parts = [(None, ids, vectors)]
            if with_index:
                coded = batch.column("index_id").dictionary_encode()
                codes = coded.indices.to_numpy(zero_copy_only=False)
                parts = [
                    (index_id, ids[codes == code], vectors[codes == code])
                    for code, index_id in enumerate(coded.dictionary.to_pylist())
                ]
            for number, block in enumerate(blocks):
                add(number, block, parts)
                if sum(len(best.ids) for _, best in open_states.values()) * _HIT_BYTES > _OPEN_BYTES:
                    yield from flush()
        yield from flush()

    columns = ["vec_id", "vector"] + (["index_id"] if with_index else [])
    return index.select(*columns).mapInArrow(search, _hit_schema(query_type, with_index))


def _hits(index: DataFrame, queries: DataFrame, k: int, block_bytes: int) -> DataFrame:
    """Best k per query (and index) of every task, for query sets of any size.

    All blocks of queries are met in one scan of the index.  One block at a time takes up
    the driver's memory, and a task's.
    """
    _check_k(k)
    blocks = [_sent(index.sparkSession, block) for block in _query_blocks(queries, block_bytes)]
    return _local_hits(index, blocks, _query_type(queries), k)


def _rank(hits: DataFrame, k: int) -> DataFrame:
    """Number the hits of each query and keep k.

    Spark limits each group before the shuffle as well (WindowGroupLimit), so a
    popular query or index costs a task at most k rows.
    """
    group = [c for c in ("index_id", "query_id") if c in hits.columns]
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


# Public operators ----------------------------------------------------------


def topk_batch(
    index: DataFrame, queries: DataFrame, k: int = DEFAULT_K, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``query_id, vec_id, score, rank``: the k best vectors of every query.

    ``index`` has ``vec_id, vector`` and ``queries`` has ``query_id, vector``;
    vectors are taken as they are.
    """
    return _rank(_hits(index.select("vec_id", "vector"), queries, k, block_bytes), k)


# The same search under the name of its use with several blocks of queries.
topk_block = topk_batch


def topk_per_index(
    index: DataFrame, queries: DataFrame, k: int = DEFAULT_K, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Ranks inside each ``index_id``; scores of two indexes are never compared."""
    return _rank(_hits(index, queries, k, block_bytes), k)


def topk_single(index: DataFrame, vector: Sequence[float], k: int = DEFAULT_K) -> DataFrame:
    """``vec_id, score, rank`` of the k best vectors for one query vector."""
    query = pa.table(
        {
            "query_id": pa.array([0], pa.int64()),
            "vector": pa.array([list(vector)], pa.list_(pa.float64())),
        }
    )
    hits = _local_hits(index.select("vec_id", "vector"), [_sent(index.sparkSession, query)], "bigint", k)
    best = hits.orderBy(F.desc("score"), "vec_id").limit(k)
    order = Window.orderBy(F.desc("score"), "vec_id")
    return best.select("vec_id", "score", F.row_number().over(order).alias("rank"))


def topk_filtered(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    condition: Column,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Only vectors meeting the condition compete; it reaches the scan as a filter."""
    return topk_batch(index.filter(condition), queries, k, block_bytes)


def score_pairs(pairs: DataFrame, queries: DataFrame, index: DataFrame) -> DataFrame:
    """``pairs`` of ``query_id, vec_id`` with the ``score`` of each.

    A pair whose query or vector is not there has a NULL score.
    """
    vectors = index.select("vec_id", "vector")
    asked = queries.select("query_id", F.col("vector").alias("_query"))
    score = F.round(V.inner_product(F.col("vector"), F.col("_query")), SCORE_DECIMALS) + 0.0
    return (
        pairs.join(vectors, "vec_id", "left")
        .join(asked, "query_id", "left")
        .select(*pairs.columns, score.alias("score"))
    )


def result_lookup(
    hits: DataFrame,
    index: DataFrame,
    max_hits: int | None = None,
    shard_size: int | None = None,
) -> DataFrame:
    """The hits with the text and provenance of the vectors they name.

    A hit that the index has no entry for stays, with NULLs.  ``max_hits`` is the
    caller's bound on the number of hits (k x queries); with one, the hits are
    broadcast to find the entries, if their size allows.  ``shard_size`` is the one the
    shards of a table were written with; given it, only shards with a hit are read.  On
    a published index, ``index_store.lookup`` reads no more than the files with a hit.
    """
    hits = settle(hits, "hits")
    wanted = hits.select("vec_id").distinct()
    if max_hits is not None:
        wanted = broadcast_if_small(settle(wanted, "hit-ids"))
    keys = ["vec_id"]
    if shard_size is not None:
        # Ids are never negative; it takes a comparison for Spark to consider
        # pruning the index's partitions by the hits.
        wanted = wanted.filter(F.col("vec_id") >= 0).withColumn(
            "shard_id", shard_of(F.col("vec_id"), shard_size)
        )
        keys.append("shard_id")
    else:
        index = index.drop("shard_id")
    found = index.drop("vector").join(wanted, keys)
    return hits.join(found.drop("shard_id"), "vec_id", "left")


def topk_with_sources(
    index: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_K,
    preview: int = T.PREVIEW_CHARS,
    block_bytes: int = BLOCK_BYTES,
    shard_size: int | None = None,
) -> DataFrame:
    """Hits with a one-line preview of their text and where they came from."""
    hits = settle(topk_batch(index, queries, k, block_bytes), "hits")
    found = result_lookup(hits, index, hits.count(), shard_size)
    return found.withColumn("preview", T.preview(F.col("text"), preview)).drop("text")


def score_bands(hits: DataFrame) -> DataFrame:
    """How many hits fall into each band of scores."""
    band = F.lit(WEAK_BAND)
    for lower, name in reversed(SCORE_BANDS):
        band = F.when(F.col("score") >= lower, F.lit(name)).otherwise(band)
    return hits.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("hits"))
