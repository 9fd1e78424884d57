"""Language identification: held-out accuracy, and what is not a language."""

import zlib

import pytest
import regex
import zstandard
from pyspark.sql import functions as F

from corpusvec.llm import language

SCHEMA = "doc_id long, text string, lang string, score string"


def test_held_out_accuracy(spark):
    from corpusvec.llm.queries import op8_language

    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op8_language(spark, sf).collect()
    assert len(got) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    assert right / len(held) > 0.98
    assert sum(r["rejected"] for r in got) / len(got) < 0.02


def sample():
    english = "the quick brown fox jumps over the lazy dog and runs into the deep dark forest "
    german = "der schnelle braune fuchs springt über den faulen hund und läuft in den tiefen wald "
    rows = [(i, (english if i % 2 else german) * 3, "en" if i % 2 else "de", "x") for i in range(40)]
    return rows + [
        (100, None, "en", "x"), (101, "", "en", "x"), (102, "12 34 !?", "de", "x"), (None, german, "de", "x"),
        (103, "THE LAZY DOG RUNS INTO THE FOREST", None, "x"), (103, "the lazy dog runs into the forest", None, "x"),
    ]


def plain_size(text, dictionary):
    """What a text adds, by zstandard's streaming interface."""
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)

    def packed(part):
        tool = zstandard.ZstdCompressor(
            level=language.LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
        ).compressobj(size=len(part))
        return len(tool.compress(part) + tool.flush())

    if len(text) < 256:
        probe = b" ".join(dictionary.split()[::7][-80:]) + b" "
        return max(0, packed(probe + text) - packed(probe))
    return sum(packed(text[i : i + 2048]) for i in range(0, len(text), 2048))


def test_query_against_plain_sizes(spark):
    from corpusvec.llm.queries import op8_language

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    dictionaries = language.learn(docs)
    got = {r["doc_id"]: r for r in op8_language(spark, sf).collect()}
    for r in docs.select("doc_id", "text").collect():
        low = regex.sub(r"[^\p{L}\p{M}]+", " ", (r["text"] or "").lower()).encode()
        lang, score = "und", 0.0
        if regex.search(r"\p{L}", r["text"] or ""):
            sizes = {k: plain_size(low, d) for k, d in dictionaries.items()}
            lang = min(sorted(sizes), key=sizes.get)
            first, second = sorted(sizes.values())[:2]
            score = (second - first) / max(1, second)
        assert got[r["doc_id"]]["lang_pred"] == lang, r["doc_id"]
        assert got[r["doc_id"]]["score"] == pytest.approx(score)


def test_sample_has_the_smallest_hashes(spark):
    rows = [(i, f"text number {'abcdefghij'[i % 10] * (i // 10 + 1)}", "en", "x") for i in range(300)]
    docs = spark.createDataFrame(rows + rows[:50], SCHEMA)
    learned = language.learn(docs, docs_per_language=5)["en"].decode()
    hashed = docs.filter(~language.held_out(F.col("doc_id"))).select("text", F.xxhash64("text").alias("h")).distinct()
    assert learned == " ".join(r["text"] for r in hashed.orderBy("h").limit(5).collect())


def test_ties_go_to_the_first_name(spark):
    rows = [(i, "the very same words in either of two languages ", lang, "x") for i in range(8) for lang in ("zz", "aa")]
    got = language.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r["lang_pred"], r["score"], r["rejected"]) for r in got} == {("aa", 0.0, True)}


def test_very_long_text_and_clashing_names(spark):
    text = "the quick brown fox jumps over the lazy dog and runs into the forest " * 30_000
    table = spark.createDataFrame(sample() + [(500, text, None, "x")], SCHEMA).withColumn("found", F.lit("x"))
    kept = language.keep_identified(table)
    assert kept.columns == table.columns and kept.filter("doc_id = 500").first()["text"] == text


def test_odd_rows(spark):
    df = spark.createDataFrame(sample(), SCHEMA)
    got = language.identify(df).collect()
    assert len(got) == len(sample())
    found = {r["doc_id"]: r for r in got}
    assert {found[i]["lang_pred"] for i in (100, 101, 102)} == {"und"} and found[100]["score"] == 0
    assert found[None]["lang_pred"] == "de" and not found[None]["held_out"]
    assert [r["lang_pred"] for r in got if r["doc_id"] == 103] == ["en", "en"]
    assert all(found[i]["lang_pred"] == ("en" if i % 2 else "de") for i in range(40))
    kept = language.keep_identified(df)
    assert kept.columns == df.columns and kept.count() == len(sample()) - 3


def test_sample_is_bounded(spark):
    learned = language.learn(spark.createDataFrame(sample(), SCHEMA), docs_per_language=1)
    assert set(learned) == {"de", "en"}
    assert all(len(d) <= language.DICT_PIECE for d in learned.values())


def test_nothing_or_one_language_to_learn(spark):
    unlabelled = spark.createDataFrame([(1, "some text", None, "x")], SCHEMA)
    assert [tuple(r)[2:4] for r in language.identify(unlabelled).collect()] == [("und", 0.0)]
    one = spark.createDataFrame([(1, "some text", "en", "x")], SCHEMA)
    assert [tuple(r)[2:4] for r in language.identify(one).collect()] == [("en", 1.0)]
    empty = spark.createDataFrame([], SCHEMA)
    assert language.identify(empty).count() == 0 == language.keep_identified(empty).count()
