"""The corpus pipeline: five operators, each on what the one before kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame.  ``run`` writes each
result to the shared folder and reads it back, so a lost executor costs at most the
stage at hand.  All stages but the last return the columns of ``documents``; ``n_chars`` is
that of the text as it is then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusvec.llm import language, lines, packing, simhash, suffixes
from corpusvec.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Bytes of a string that counts as a repeated passage: shorter than any fifty words of prose.
PASSAGE_BYTES = 240

# Language identification and its margins cannot be told in SQL.
ORACLE_SQL = None


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``, with ``n_chars`` of the text as it is now."""
    measured = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return measured.select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found by a clear margin; ``und`` and narrow ones go."""
    return language.keep_identified(docs).select(*COLUMNS)


def remove_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that many sites share, except where they are first."""
    return _documents(lines.remove_boilerplate(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates: the one with the smallest ``doc_id``."""
    return simhash.drop_near_duplicates(docs).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of ``PASSAGE_BYTES`` that occur elsewhere too.

    A document that had a text and has none left goes.
    """
    cut = suffixes.cut_repeats(docs, PASSAGE_BYTES)
    emptied = (F.col("n_chars") > 0) & (F.col("text") == "")
    return _documents(cut.filter(~F.coalesce(emptied, F.lit(False))))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document, or piece of one, in the training batches."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", remove_boilerplate),
    ("SimHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents below ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
