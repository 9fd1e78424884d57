"""Packing documents into token-budget batches inside length buckets.

A batch is padded to the length of its bucket, so the bucket boundaries decide
how much padding there is.  They are chosen by dynamic programming over the
histogram of all lengths: the exact minimum for the given number of buckets.

A token is a word here; ``pack`` takes any length column.  A text longer than
``max_tokens`` is packed as consecutive pieces of that many tokens, so the
histogram never has more than ``max_tokens`` entries, however many rows there
are; that bound is why it may go to the driver.

Inside a bucket the pieces are ordered by the MD5 of their id, which shuffles
them reproducibly, and a batch takes as many as fit the budget at the bucket's
length.  Numbering needs no global sort: rows are ranked inside blocks of equal
leading MD5 digits, and blocks are offset by a table of at most buckets x 4,096
counts.  A bucket with a third of all rows is thousands of blocks.

NULL, empty and blank texts have no tokens: their row has length 0 and no
bucket, batch or slot.  A NULL ``doc_id`` is numbered as the text ``null``;
repeated rows are packed each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusvec.llm.common import WORD
from corpusvec.session import settle

MAX_TOKENS = 2048
BUCKETS = 8
BATCH_TOKENS = 16_384
BLOCK_DIGITS = 3


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def boundaries(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Bucket lengths with the least padding; the last one is the longest length.

    Of equally good choices, the one whose last but one boundary is smallest is
    taken, and so on downwards.  Costs stay below rows x longest, far inside 64 bits.
    """
    lengths = np.array(sorted(n for n, count in histogram.items() if n > 0 and count > 0), dtype=np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[n] for n in lengths.tolist()], dtype=np.int64)
    rows = np.r_[0, np.cumsum(counts)]
    # Padded size of one bucket holding lengths i..j: lengths[j] x their rows.
    # The sum of the lengths themselves is the same for every choice.
    best = lengths * rows[1:]
    choices = []
    for _ in range(min(buckets, len(lengths)) - 1):
        ahead, previous = best.copy(), np.full(len(lengths), -1)
        for j in range(1, len(lengths)):
            cost = best[:j] + lengths[j] * (rows[j + 1] - rows[1 : j + 1])
            i = int(np.argmin(cost))
            if cost[i] < best[j]:
                ahead[j], previous[j] = cost[i], i
        choices.append(previous)
        best = ahead
    chosen, j = set(), len(lengths) - 1
    for previous in reversed(choices):
        chosen.add(int(lengths[j]))
        j = max(j if previous[j] < 0 else 0, int(previous[j]))
    chosen.add(int(lengths[j]))
    return sorted(chosen)


def pack(
    lengths: DataFrame,
    max_tokens: int = MAX_TOKENS,
    buckets: int = BUCKETS,
    batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """Place every row of ``doc_id, n_tokens``, one output row per piece.

    ``piece`` counts a document's pieces, ``n_tokens`` is the piece's length,
    ``bucket_tokens`` the padded length, ``batch`` the batch inside the bucket
    and ``slot`` the place inside the batch.
    """
    if batch_tokens < max_tokens:
        raise ValueError("a batch must hold a sequence of max_tokens")
    rows = settle(lengths.select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens")), "lengths")
    last = F.greatest(F.lit(0), F.floor((F.col("n_tokens") - 1) / max_tokens))
    pieces = rows.select(
        "doc_id",
        F.col("n_tokens").alias("doc_tokens"),
        F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("piece"),
    ).select(
        "doc_id",
        "piece",
        F.least(F.lit(max_tokens), F.col("doc_tokens") - F.col("piece") * max_tokens).alias("n_tokens"),
    )
    # At most max_tokens + 1 rows.
    histogram = {
        r["n_tokens"]: r["n"]
        for r in pieces.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    bounds = boundaries(histogram, buckets)
    bucket = F.lit(None).cast("long")
    for bound in reversed(bounds):
        bucket = F.when(F.col("n_tokens").between(1, bound), F.lit(bound).cast("long")).otherwise(bucket)
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary"))
    placed = pieces.select("*", bucket.alias("bucket_tokens"), key.alias("key")).withColumn(
        "block", F.left("key", F.lit(BLOCK_DIGITS))
    )
    full = placed.filter(F.col("bucket_tokens").isNotNull())
    group = ["bucket_tokens", "block"]
    before = Window.partitionBy("bucket_tokens").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # At most buckets x 16 ** BLOCK_DIGITS rows.
    offsets = (
        full.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*group, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    in_block = Window.partitionBy(*group).orderBy("key", "doc_id", "piece")
    position = F.col("offset") + F.row_number().over(in_block) - 1
    capacity = F.floor(F.lit(batch_tokens) / F.col("bucket_tokens"))
    numbered = full.join(F.broadcast(offsets), group).withColumn("position", position)
    out = numbered.select(
        "doc_id",
        "piece",
        "n_tokens",
        "bucket_tokens",
        F.floor(F.col("position") / capacity).alias("batch"),
        (F.col("position") % capacity).alias("slot"),
    )
    none = F.lit(None).cast("long")
    unplaced = placed.filter(F.col("bucket_tokens").isNull()).select(
        "doc_id", "piece", "n_tokens", "bucket_tokens", none.alias("batch"), none.alias("slot")
    )
    return out.union(unplaced)


def pack_documents(docs: DataFrame, **options: int) -> DataFrame:
    """Pack the texts of ``doc_id, text`` by their number of words."""
    return pack(docs.select("doc_id", token_count(F.col("text")).alias("n_tokens")), **options)


def _dynamic_program_sql(buckets: int) -> str:
    """Common table expressions that end in ``bounds(bound)``, in steps of one bucket each."""
    step = """
    dp{k} AS (
      SELECT h.len, least(min(p.cost), min(c.cost + h.len * (h.upto - c.upto))) AS cost,
             CASE WHEN min(c.cost + h.len * (h.upto - c.upto)) < min(p.cost)
                  THEN arg_min(c.len, (c.cost + h.len * (h.upto - c.upto)) * 65536 + c.len) END AS prev,
             any_value(h.upto) AS upto
      FROM dp{j} h JOIN dp{j} p ON p.len = h.len LEFT JOIN dp{j} c ON c.len < h.len
      GROUP BY h.len),"""
    steps = "".join(step.format(k=k, j=k - 1) for k in range(2, buckets + 1))
    walk = f"b{buckets} AS (SELECT max(len) AS len FROM dp1),\n" + "".join(
        f"b{k - 1} AS (SELECT coalesce(d.prev, d.len) AS len FROM dp{k} d JOIN b{k} b ON d.len = b.len),\n"
        for k in range(buckets, 1, -1)
    )
    every = " UNION ".join(f"SELECT len FROM b{k} WHERE len IS NOT NULL" for k in range(1, buckets + 1))
    return f"""
    dp1 AS (
      SELECT n_tokens AS len, n_tokens * sum(n) OVER w AS cost, CAST(NULL AS BIGINT) AS prev,
             sum(n) OVER w AS upto
      FROM hist WINDOW w AS (ORDER BY n_tokens)),{steps}
    {walk}
    bounds AS ({every})"""


def sql(max_tokens: int = MAX_TOKENS, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS,
        docs: str = "documents") -> str:
    """The same rows in DuckDB SQL."""
    return f"""
    WITH counted AS (
      SELECT doc_id, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS total
      FROM {docs}),
    pieces AS (
      SELECT doc_id, piece, least({max_tokens}, total - piece * {max_tokens}) AS n_tokens
      FROM (SELECT doc_id, total,
                   unnest(range(greatest(1, CAST(ceil(total / {max_tokens}) AS BIGINT)))) AS piece
            FROM counted)),
    hist AS (SELECT n_tokens, count(*) AS n FROM pieces WHERE n_tokens > 0 GROUP BY n_tokens),
    {_dynamic_program_sql(buckets)},
    placed AS (
      SELECT p.*, (SELECT min(len) FROM bounds WHERE len >= p.n_tokens) AS bucket_tokens FROM pieces p),
    numbered AS (
      SELECT *, row_number() OVER (
                  PARTITION BY bucket_tokens
                  ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), doc_id, piece) - 1 AS position,
             CAST(floor({batch_tokens} / bucket_tokens) AS BIGINT) AS capacity
      FROM placed WHERE n_tokens > 0)
    SELECT doc_id, piece, n_tokens, bucket_tokens, position // capacity AS batch,
           position % capacity AS slot
    FROM numbered
    UNION ALL
    SELECT doc_id, piece, n_tokens, NULL, NULL, NULL FROM placed WHERE n_tokens <= 0"""
