"""Merging split indexes, and putting several corpora side by side."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusvec.operators.alignment import IntegrityError
from corpusvec.operators.ordinals import assign_vec_ids
from corpusvec.sinks.artifacts import summary_row, write_summary
from corpusvec.sinks.publish import publish_parts, publish_verified
from corpusvec.sources.index_store import Index, IndexNotFound, Part, load_index, run_path

log = logging.getLogger(__name__)


def merge_entries(splits: Mapping[int, DataFrame]) -> DataFrame:
    """Concatenate the entries in split order under new, dense ids.

    Where every split's own ids are dense, which one small aggregate tells, the
    new id is the old one plus the sizes of the splits before: no shuffle.
    """
    union = None
    for split_id in sorted(splits):
        part = splits[split_id].drop("shard_id", "split_id")
        part = part.withColumn("split_id", F.lit(split_id))
        union = part if union is None else union.unionByName(part, allowMissingColumns=True)
    if union is None:
        raise IndexNotFound("no split to merge")

    # One row per split, and the caller listed the splits.
    sizes = {
        r["split_id"]: r
        for r in union.groupBy("split_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("vec_id").alias("first"),
            F.max("vec_id").alias("last"),
            F.count("vec_id").alias("numbered"),
            F.sum(F.col("vec_id").cast("decimal(38,0)")).alias("sum"),
        )
        .collect()
    }
    dense = all(
        r["numbered"] == r["n"]
        and (r["first"], r["last"]) == (0, r["n"] - 1)
        and 2 * int(r["sum"]) == r["n"] * (r["n"] - 1)
        for r in sizes.values()
    )
    if not dense:
        numbered = union.withColumn("_old", F.col("vec_id")).withColumn("_none", F.lit(0))
        merged = assign_vec_ids(numbered.drop("vec_id"), ("split_id", "_old", "_none"))
        return merged.drop("_old", "_none")
    offset, before = F.lit(None).cast("long"), 0
    for split_id in sorted(splits):
        offset = F.when(F.col("split_id") == split_id, F.lit(before)).otherwise(offset)
        before += sizes[split_id]["n"] if split_id in sizes else 0
    return union.withColumn("vec_id", F.col("vec_id") + offset)


def load_splits(spark: SparkSession, paths: Sequence[str]) -> dict[int, Index]:
    """The indexes found at the paths, by position; a missing one is skipped."""
    found = {}
    for position, path in enumerate(paths):
        try:
            found[position] = load_index(spark, path)
        except IndexNotFound:
            log.warning("no index at %s; split %d is skipped", path, position)
    if not found:
        raise IndexNotFound("none of the splits was found")
    return found


def merged_parts(splits: Mapping[int, Index]) -> list[Part] | None:
    """The runs of the splits in split order, under ids that go on from split to split.

    None if the ids of a split have gaps, so that adding to them would not do.
    """
    parts, before = [], 0
    for split_id in sorted(splits):
        split = splits[split_id]
        if not split.dense:
            return None
        for part in split.parts:
            parts.append(replace(part, id_offset=part.id_offset + before, split_id=split_id))
        before += sum(part.entries for part in split.parts)
    return parts


def merge_splits(
    spark: SparkSession,
    paths: Sequence[str],
    path: str,
    dataset: str,
    source_path: str = "",
) -> Index:
    """Merge the split indexes at ``paths`` into one published index at ``path``.

    The merged index names the splits' runs and what to add to their ids, and has a
    manifest; the splits' files stay where they are and are read from there, and none of
    their entries is read or written.  Only splits whose ids have gaps are rewritten.
    """
    splits = load_splits(spark, paths)
    summaries = [s.summary.first().asDict() for s in splits.values()]
    forms = {(s["embedding_model"], s["embedding_dimension"]) for s in summaries}
    if len(forms) != 1:
        raise ValueError(f"splits were built with different embedders: {forms}")
    ((model, dimension),) = forms
    total = sum(s["total_vectors"] for s in summaries)
    known = {"split_merge": True, "num_splits": len(splits)}
    parts = merged_parts(splits)
    if parts is None:
        return publish_verified(
            spark,
            merge_entries({i: s.entries for i, s in splits.items()}),
            path,
            dataset=dataset,
            model=model,
            dimension=dimension,
            source_path=source_path,
            expected_chunks=spark.range(1).select(F.lit(total).alias("n_expected")),
            **known,
        )
    found = sum(part.entries for part in parts)
    if found != total:
        raise IntegrityError(f"the splits' manifests name {total} vectors, their runs have {found}")
    run = uuid.uuid4().hex
    summary = summary_row(
        spark.range(0), dataset, source_path, model, dimension, True, total, **known
    )
    write_summary(summary, f"{run_path(path, run)}/summary")
    publish_parts(spark, path, run, parts)
    return load_index(spark, path)


def union_corpora(corpora: Mapping[str, DataFrame]) -> DataFrame:
    """Several corpora in one table, told apart by ``index_id``.

    Vector ids keep counting per corpus; rank with ``topk_per_index``.
    """
    union = None
    for index_id, entries in corpora.items():
        part = entries.withColumn("index_id", F.lit(index_id))
        union = part if union is None else union.unionByName(part, allowMissingColumns=True)
    if union is None:
        raise ValueError("no corpus given")
    return union
