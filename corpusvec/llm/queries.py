"""One query per operator, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusvec.llm import (
    chat, codes, fingerprints, language, lattice, lines, middle, packing, pieces, quality, recipes,
    simhash, suffixes,
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"))


def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op3_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return lines.remove_boilerplate(docs)


def op4_lattice(spark: SparkSession, sf: str) -> DataFrame:
    return lattice.score_documents(table(spark, sf, "documents"))


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(table(spark, sf, "documents"))


def op6_recipes(spark: SparkSession, sf: str) -> DataFrame:
    return recipes.exact_duplicates(table(spark, sf, "documents"))


def op7_pieces(spark: SparkSession, sf: str) -> DataFrame:
    decoded = pieces.decode(pieces.encode(table(spark, sf, "documents")))
    return decoded.withColumn("text", decoded["text"].cast("string"))


def op8_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(table(spark, sf, "documents"))


def op9_chat(spark: SparkSession, sf: str) -> DataFrame:
    turns = chat.with_probe(table(spark, sf, "conversations"))
    return chat.digests(chat.format_conversations(turns))


def op10_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf, "documents"))


def op11_codes(spark: SparkSession, sf: str) -> DataFrame:
    return codes.compress(table(spark, sf, "embeddings"))


def op12_middle(spark: SparkSession, sf: str) -> DataFrame:
    return middle.digests(middle.rearrange(table(spark, sf, "documents")))


def op13_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_simhash": op2_simhash,
    "op3_lines": op3_lines,
    "op4_lattice": op4_lattice,
    "op5_quality": op5_quality,
    "op6_recipes": op6_recipes,
    "op7_pieces": op7_pieces,
    "op8_language": op8_language,
    "op9_chat": op9_chat,
    "op10_suffixes": op10_suffixes,
    "op11_codes": op11_codes,
    "op12_middle": op12_middle,
    "op13_fingerprints": op13_fingerprints,
}

ORACLES: dict[str, str] = {
    "op1_packing": packing.sql(),
    "op3_lines": lines.sql(),
    "op5_quality": quality.sql(),
    "op6_recipes": recipes.SQL,
    "op9_chat": chat.SQL,
    "op11_codes": codes.sql(),
    "op12_middle": middle.sql(),
}
