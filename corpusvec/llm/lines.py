"""Removal of boilerplate lines by the number of sites they are spread over.

Every line has a HyperLogLog sketch of the sites (``source``) it occurs on.
Sketches are merged by aggregation, so a line on a third of all pages costs a
task one sketch.  Clear cases are decided by the estimate; lines near the
threshold get an exact count of distinct sites.

A line on ``min_sites`` or more sites is boilerplate: it stays where it occurs
first (smallest ``doc_id``, then position) and goes everywhere else.  Lines are
compared without the blanks at their ends, and every line with a word takes part.

Texts move once, to meet the list of positions that go.  A NULL text stays NULL
and has no lines; a NULL source is one more site; a NULL ``doc_id`` comes before
all others.  Rows that repeat both id and text are one document and are treated
alike.  A very long text is an array of its lines inside its row; of a text whose lines
all go, an empty text stays.  Other columns come through unchanged, but for ``n_lines``
and ``n_removed``, which are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import BLANKS, null_safe_join, unused
from corpusvec.session import settle

MIN_SITES = 10
SKETCH_BITS = 12
# Standard errors on either side of the threshold that are counted exactly.
SIGMAS = 4

_KEY = ["h1", "h2"]
_DOC = ["__doc", "__hash"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def line_table(docs: DataFrame) -> DataFrame:
    """``__doc, __hash, site, pos, h1, h2`` of every line with a word."""
    exploded = docs.select(
        F.col("doc_id").alias("__doc"),
        F.xxhash64("text").alias("__hash"),
        F.coalesce("source", F.lit("")).alias("site"),
        F.posexplode(_lines(F.col("text"))).alias("pos", "line"),
    )
    line = F.btrim(F.col("line"), F.lit(BLANKS))
    # Two differently salted hashes: 128 bits name a line.
    return exploded.filter(line != "").select(
        *_DOC,
        "site",
        "pos",
        F.xxhash64(line).alias("h1"),
        F.xxhash64(F.lit("second"), line).alias("h2"),
    )


def boilerplate(
    lines: DataFrame, min_sites: int = MIN_SITES, sketch_bits: int = SKETCH_BITS
) -> DataFrame:
    """``h1, h2`` of the lines on at least ``min_sites`` sites, and where each is first."""
    spread = settle(
        lines.groupBy(*_KEY)
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(sketch_bits))).alias("sites"),
            F.min(F.struct(F.col("__doc").alias("doc"), "pos")).alias("first"),
        )
        .filter(F.col("sites") >= min_sites - _margin(min_sites, sketch_bits)),
        "line-spread",
    )
    near = F.col("sites") <= min_sites + _margin(min_sites, sketch_bits)
    exact = (
        lines.join(spread.filter(near), _KEY, "left_semi")
        .select(*_KEY, "site")
        .distinct()
        .groupBy(*_KEY)
        .agg(F.count(F.lit(1)).alias("exact"))
        .filter(F.col("exact") >= min_sites)
    )
    return (
        spread.filter(~near)
        .select(*_KEY, "first")
        .union(spread.filter(near).join(exact, _KEY).select(*_KEY, "first"))
    )


def _margin(min_sites: int, sketch_bits: int) -> float:
    return max(1.0, SIGMAS * 1.04 / math.sqrt(1 << sketch_bits) * min_sites)


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """All rows and columns of ``docs``; ``text`` without the lines that go, and
    ``n_lines, n_removed``."""
    lines = line_table(docs)
    common = settle(boilerplate(lines, min_sites), "boilerplate")
    gone = (
        lines.join(common, _KEY)
        .filter(~(F.col("__doc").eqNullSafe(F.col("first.doc")) & (F.col("pos") == F.col("first.pos"))))
        .groupBy(*_DOC)
        .agg(F.collect_set("pos").alias("__gone"))
    )
    doc, named, places, split = unused(docs.columns, "doc", "hash", "gone", "split")
    keyed = docs.select("*", F.col("doc_id").alias(doc), F.xxhash64("text").alias(named))
    renamed = gone.withColumnsRenamed({**dict(zip(_DOC, (doc, named))), "__gone": places})
    joined = null_safe_join(keyed, renamed, [doc, named], "left")
    every = F.sequence(F.lit(0), F.size(_lines(F.col("text"))) - 1)
    kept = F.array_join(
        F.transform(F.array_except(every, F.col(places)), lambda i: F.get(F.col(split), i)), "\n"
    )
    return (
        joined.withColumn(split, _lines(F.col("text")))
        .select(
            *(c for c in docs.columns if c not in ("text", "n_lines", "n_removed")),
            F.when(F.col(places).isNull(), F.col("text")).otherwise(kept).alias("text"),
            F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.size(places), F.lit(0)).cast("long").alias("n_removed"),
        )
    )


def sql(min_sites: int = MIN_SITES, docs: str = "documents") -> str:
    """The same rows in DuckDB SQL: ``doc_id, source, text, n_lines, n_removed``."""
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    return f"""
    WITH texts AS (
      SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS ls
      FROM {docs}),
    l AS (
      SELECT r, doc_id, source, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos FROM texts),
    k AS (SELECT *, trim(line, {blanks}) AS key FROM l),
    spread AS (
      SELECT key, min(doc_id) AS first_doc, bool_or(doc_id IS NULL) AS nameless
      FROM k WHERE key <> ''
      GROUP BY key HAVING count(DISTINCT coalesce(source, '')) >= {min_sites}),
    firsts AS (
      SELECT key, CASE WHEN nameless THEN NULL ELSE first_doc END AS first_doc,
             (SELECT min(pos) FROM k WHERE k.key = s.key AND
              k.doc_id IS NOT DISTINCT FROM CASE WHEN nameless THEN NULL ELSE first_doc END) AS first_pos
      FROM spread s),
    marked AS (
      SELECT k.*, f.key IS NOT NULL
               AND NOT (k.doc_id IS NOT DISTINCT FROM f.first_doc AND k.pos = f.first_pos) AS gone
      FROM k LEFT JOIN firsts f ON f.key = k.key),
    joined AS (
      SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
      FROM marked GROUP BY r)
    SELECT t.doc_id, t.source, j.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
    FROM texts t LEFT JOIN joined j USING (r)"""
