"""Near-duplicate documents by SimHash and a self-join of a binary trie.

A fingerprint has one bit per majority among the hashes of a text's word
shingles.  Two documents are linked when their fingerprints differ in few bits,
and a group is everything that links reach.

The join walks a binary trie over the distinct fingerprints against itself.  It
starts from the pair (root, root), goes down both sides a few bits at a time,
adds up the differing bits and drops a pair of nodes once they exceed the
budget.  Of two fingerprints within ``max_bits``, either the upper halves differ
in at most half of the budget, or the lower halves do in less than that; so one
trie reads the upper half first and one the lower half, each with the smaller
budget for its first 32 levels.  That prunes far higher up than one trie could
and loses no pair.

Spark walks the upper levels: a row is one fingerprint at one node that it may
still match, kept on the side of the smaller node of a pair.  A node with more
rows than ``node_rows`` is walked further down, whatever its depth, so a dense
region of near copies spreads over many tasks.  Inside a node a task walks the
rest with arrays and hands back a spanning forest of the links it found: all
that the groups need, and never more than one row for each fingerprint at a
node.

Equal fingerprints are one trie entry, so copies cost nothing here.  NULL and
blank texts have fingerprint zero and are linked like any other.  Repeated rows
and ``doc_id``s get a row each; a NULL ``doc_id`` counts in no minimum, so a
group without any has a NULL ``component_id``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import as_bytes
from corpusvec.llm.components import connected_components
from corpusvec.session import settle

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42

# Expected fingerprints in a trie node where Spark first groups them, rows at a
# node beyond which it goes further down, and bits it goes down at a time.
NODE_TARGET = 2048
NODE_ROWS = 200_000
STEP_BITS = 4

# Shingles hashed at a time, node pairs walked at a time, and pairs of leaves
# below which two subtrees are compared directly.
HASH_BLOCK = 1 << 16
FRONTIER = 1 << 18
LEAF_PAIRS = 16

_BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int64)


# Fingerprints ---------------------------------------------------------------


def simhash(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text, unsigned."""
    tokens = text.lower().split()  # bytes: A-Z only, and the six blanks only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    size = min(shingle_words, len(tokens))
    ends = list(accumulate([len(w) + 1 for w in tokens]))
    starts = [0, *ends[: len(tokens) - size]]
    digest, seed = xxhash.xxh64_digest, HASH_SEED
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), HASH_BLOCK):
        spans = zip(starts[at : at + HASH_BLOCK], ends[at + size - 1 : at + size - 1 + HASH_BLOCK])
        hashes = np.frombuffer(b"".join([digest(joined[a : b - 1], seed) for a, b in spans]), np.uint8)
        cells = hashes.reshape(-1, 8) + np.arange(0, 2048, 256)
        histogram = np.bincount(cells.ravel(), minlength=2048).reshape(8, 256)
        counts += (histogram @ _BITS).ravel()
    set_bits = np.packbits(2 * counts > len(starts))
    return int.from_bytes(set_bits.tobytes(), "big")


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a signed long."""

    @F.arrow_udf("long")
    def compute(texts: pa.Array) -> pa.Array:
        prints = [simhash(t.as_py(), shingle_words) for t in as_bytes(texts)]
        return pa.array(np.array(prints, dtype=np.uint64).view(np.int64))

    return compute(text)


# The upper levels of the trie, in Spark --------------------------------------


def _budgets(max_bits: int) -> list[int]:
    """Bits that may differ in the first half read, for each reading order."""
    upper = max_bits // 2
    lower = max_bits - upper - 1
    return [upper, lower] if lower >= 0 else [upper]


def _descend(nodes: DataFrame, depth: int, bits: int, max_bits: int) -> DataFrame:
    """Every row at the children it may match.

    A row belongs to the smaller node of a pair, so only children up to its own
    are kept.  Within the first half the half's own budget holds.
    """
    to = depth + bits
    own = F.shiftrightunsigned("key", 64 - to) if to else F.lit(0)
    children = nodes.select(
        "order",
        "key",
        F.explode(
            F.transform(
                F.array(*(F.lit(i) for i in range(1 << bits))),
                lambda i: F.shiftleft(F.col("node"), bits) + i,
            )
        ).alias("node"),
    )
    budgets = _budgets(max_bits)
    budget = F.lit(max_bits)
    if to <= 32:
        budget = F.lit(budgets[0])
        if len(budgets) > 1:
            budget = F.when(F.col("order") == 1, budgets[1]).otherwise(budget)
    differing = F.bit_count(own.bitwiseXOR(F.col("node")))
    return children.filter((F.col("node") <= own) & (differing <= budget))


def _roots(prints: DataFrame, max_bits: int) -> DataFrame:
    orders = [prints.select(F.lit(0).alias("order"), F.col("fp").alias("key"))]
    if len(_budgets(max_bits)) > 1:
        swapped = F.shiftleft("fp", 32).bitwiseOR(F.shiftrightunsigned("fp", 32))
        orders.append(prints.select(F.lit(1).alias("order"), swapped.alias("key")))
    rows = orders[0] if len(orders) == 1 else orders[0].union(orders[1])
    return rows.withColumn("node", F.lit(0).cast("long"))


def links(
    prints: DataFrame,
    max_bits: int = MAX_BITS,
    node_target: int = NODE_TARGET,
    node_rows: int = NODE_ROWS,
) -> DataFrame:
    """``a, b``: links between distinct fingerprints (``fp``), enough to span every group."""
    total = prints.count()
    depth = min(32, max(0, math.ceil(math.log2(max(1, total) / node_target))))
    nodes = _roots(prints, max_bits)
    for at in range(0, depth, STEP_BITS):
        nodes = _descend(nodes, at, min(STEP_BITS, depth - at), max_bits)
    found = []
    while True:
        sizes = nodes.groupBy("order", "node").agg(F.count(F.lit(1)).alias("rows"))
        hot = settle(sizes.filter(F.col("rows") > node_rows).select("order", "node"), "hot-nodes")
        if depth >= 60 or hot.isEmpty():
            found.append(_walk_nodes(nodes, depth, max_bits))
            break
        cold = nodes.join(hot, ["order", "node"], "left_anti")
        found.append(_walk_nodes(cold, depth, max_bits))
        crowded = settle(nodes.join(hot, ["order", "node"], "left_semi"), "crowded-nodes")
        nodes = _descend(crowded, depth, STEP_BITS, max_bits)
        depth += STEP_BITS
    result = found[0]
    for more in found[1:]:
        result = result.union(more)
    return result


def _walk_nodes(nodes: DataFrame, depth: int, max_bits: int) -> DataFrame:
    budgets = _budgets(max_bits)

    def walk(table: pa.Table) -> pa.Table:
        order, node = table["order"][0].as_py(), table["node"][0].as_py()
        keys = np.sort(table["key"].to_numpy().view(np.uint64))
        a, b = forest(keys, node, depth, budgets[order], max_bits)
        if order == 1:
            a, b = ((x << np.uint64(32)) | (x >> np.uint64(32)) for x in (a, b))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return nodes.groupBy("order", "node").applyInArrow(walk, "a long, b long")


# The lower levels, inside a task ---------------------------------------------


def forest(
    keys: np.ndarray, node: int, depth: int, half_budget: int, max_bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the groups among sorted ``keys`` with an end below ``node``.

    Keys of other nodes are compared with those of this node, not with each other.
    """
    label = np.arange(len(keys))
    for i, j in _close_pairs(keys, node, depth, half_budget, max_bits):
        _merge(label, i, j)
    moved = np.flatnonzero(label != np.arange(len(keys)))
    return keys[moved], keys[label[moved]]


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Take links into ``label``, where every key points at the smallest of its group."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            next_label = label[label]
            if (next_label == label).all():
                break
            label[:] = next_label


def _prefix(keys: np.ndarray, depth: int) -> np.ndarray:
    return keys >> np.uint64(64 - depth) if depth else np.zeros_like(keys)


def _close_pairs(
    keys: np.ndarray, node: int, depth: int, half_budget: int, max_bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    prefix = _prefix(keys, depth)
    heads = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
    tails = np.r_[heads[1:], len(keys)]
    home = np.flatnonzero(prefix[heads] == np.uint64(node))
    if not len(home):
        return
    # Rows of a frontier: a range of keys below either node of the pair.
    n = len(heads)
    start = np.stack([np.full(n, heads[home[0]]), np.full(n, tails[home[0]]), heads, tails])
    stack = [(depth, start)]
    while stack:
        depth, pairs = stack.pop()
        if pairs.shape[1] > FRONTIER:
            half = pairs.shape[1] // 2
            stack += [(depth, pairs[:, :half]), (depth, pairs[:, half:])]
            continue
        small = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2]) <= LEAF_PAIRS
        if depth == 64:
            small[:] = True
        if small.any():
            yield _compare(keys, pairs[:, small], half_budget, max_bits)
        pairs = pairs[:, ~small]
        if pairs.shape[1]:
            below = _children(keys, pairs, depth, half_budget, max_bits)
            if below.shape[1]:
                stack.append((depth + 1, below))


def _children(
    keys: np.ndarray, pairs: np.ndarray, depth: int, half_budget: int, max_bits: int
) -> np.ndarray:
    """Child pairs within the budget; a node paired with itself gives each pair once."""
    bit = np.uint64(1) << np.uint64(63 - depth)
    low = bit - np.uint64(1)

    def middle(first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return np.clip(np.searchsorted(keys, (keys[first] & ~(low | bit)) | bit), first, end)

    a0, a1, b0, b1 = pairs
    am, bm = middle(a0, a1), middle(b0, b1)
    other = a0 != b0
    below = np.concatenate(
        [
            np.stack([a0, am, b0, bm]),
            np.stack([am, a1, bm, b1]),
            np.stack([a0, am, bm, b1]),
            np.stack([am, a1, b0, bm])[:, other],
        ],
        axis=1,
    )
    below = below[:, (below[0] < below[1]) & (below[2] < below[3])]
    differing = np.bitwise_count(
        _prefix(keys[below[0]], depth + 1) ^ _prefix(keys[below[2]], depth + 1)
    )
    return below[:, differing <= (half_budget if depth < 32 else max_bits)]


def _compare(
    keys: np.ndarray, pairs: np.ndarray, half_budget: int, max_bits: int
) -> tuple[np.ndarray, np.ndarray]:
    a0, a1, b0, b1 = pairs
    width = b1 - b0
    cells = (a1 - a0) * width
    owner = np.repeat(np.arange(len(cells)), cells)
    cell = np.arange(len(owner)) - np.repeat(np.cumsum(cells) - cells, cells)
    i, j = a0[owner] + cell // width[owner], b0[owner] + cell % width[owner]
    x = keys[i] ^ keys[j]
    close = (
        (i != j)
        & (np.bitwise_count(x) <= max_bits)
        & (np.bitwise_count(x >> np.uint64(32)) <= half_budget)
    )
    return i[close], j[close]


# Groups -----------------------------------------------------------------------


def component_ids(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp, root, component_id`` for rows of ``doc_id, fp``; ``root`` names the group."""
    distinct = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    roots = connected_components(links(distinct.select("fp"), max_bits), "simhash-groups")
    member = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    member = settle(member, "simhash-members")
    groups = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return settle(member.join(groups, "root").select("fp", "root", "component_id"), "simhash-ids")


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``doc_id, text``."""
    prints = settle(
        docs.select("doc_id", fingerprint(F.col("text"), shingle_words).alias("fp")), "simhash"
    )
    return prints.join(component_ids(prints, max_bits), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of a group, its smallest ``doc_id`` stays.

    Rows that repeat that ``doc_id`` in one group count as one document; the one
    with the smallest text hash stays.
    """
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    prints = settle(
        docs.select(
            "doc_id",
            text_hash.alias("text_hash"),
            fingerprint(F.col("text"), shingle_words).alias("fp"),
        ),
        "simhash",
    )
    firsts = prints.join(component_ids(prints, max_bits), "fp").filter(
        F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
    keep = settle(
        firsts.groupBy("root", F.col("component_id").alias("keep_id"))
        .agg(F.min("text_hash").alias("keep_hash"))
        .drop("root"),
        "simhash-kept",
    )
    kept = docs.withColumn("__hash", text_hash).join(
        keep,
        F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("__hash") == F.col("keep_hash")),
        "left_semi",
    )
    return kept.dropDuplicates(["doc_id", "__hash"]).drop("__hash")
