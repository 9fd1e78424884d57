"""Language identification by compression.

A text is compressed once per language, with a dictionary of raw text in that
language; the language whose dictionary makes it smallest is the answer.  The
margin is the share by which the best size undercuts the second; a narrow one
rejects the answer.

Texts are lower-cased and reduced to their letters, and go through whole, in
blocks: long texts would otherwise learn from themselves and dilute what the
dictionaries say.  A text of under ``SHORT_BYTES`` is too small to compress at all, so
it goes behind a probe, words dealt from the dictionary; what it adds to the probe's
size counts.

The dictionaries are the only thing learned.  They come from a bounded sample:
per language, the ``DICT_DOCS`` distinct training texts with the smallest hashes
give at most ``DICT_PIECE`` characters each and ``DICT_BYTES`` bytes together.
Training rows are those whose crc32 of ``doc_id`` (as text) modulo ``FOLDS`` is not
``HELD_OUT`` and whose ``lang`` is not NULL; a NULL ``doc_id`` is in no fold and
counts as training data.

A text that is NULL or has no letter gets ``und`` and score 0, as does everything
if nothing could be learned.  With one language learned the score is 1.  Equal
sizes go to the first name in order, with score 0.  Repeated rows are classified
each; a very long text is compressed block by block; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusvec.llm.common import unused
from corpusvec.session import broadcast_if_small, settle

FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
MIN_MARGIN = 0.01

DICT_DOCS, DICT_PIECE, DICT_BYTES = 256, 1024, 1 << 16
# Times the sample's size that is looked at to find the smallest hashes.
SAMPLE_ROOM = 4
LEVEL = 6
BLOCK_BYTES = 2048
SHORT_BYTES, PROBE_WORDS, PROBE_STEP = 256, 80, 7

_NOT_LETTERS = r"[^\p{L}\p{M}]+"
_RESULT = "struct<lang: string, score: double>"


def held_out(doc_id: Column) -> Column:
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def letters(text: Column) -> Column:
    """Lower-case words of letters with one space between; NULL if there is no letter."""
    return F.when(
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)),
        F.regexp_replace(F.lower(text), _NOT_LETTERS, " "),
    )


def learn(docs: DataFrame, docs_per_language: int = DICT_DOCS) -> dict[str, bytes]:
    """A dictionary per language from training rows of ``doc_id, text, lang``.

    What reaches the driver is bounded by ``DICT_DOCS`` x ``DICT_PIECE`` per language.
    """
    usable = docs.filter(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    ).select("lang", "text", F.xxhash64("text").alias("hash"))
    # Hashes are even, so a language's number of texts tells below which hash the sample
    # lies, with room to spare: whatever it has, a few of its rows meet in one task.
    distinct = settle(usable.select("lang", "hash").distinct(), "language-texts")
    room = F.least(F.lit(1.0), F.lit(float(SAMPLE_ROOM * docs_per_language)) / F.count(F.lit(1)))
    bounds = distinct.groupBy("lang").agg((F.lit(-(2.0**63)) + F.lit(2.0**64) * room).alias("bound"))
    near = distinct.join(broadcast_if_small(settle(bounds, "language-bounds")), "lang")
    order = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    chosen = settle(
        near.filter(F.col("hash").cast("double") <= F.col("bound"))
        .withColumn("n", order)
        .filter(F.col("n") <= docs_per_language)
        .select("lang", "hash"),
        "language-sample",
    )
    pieces = (
        usable.join(broadcast_if_small(chosen), ["lang", "hash"], "left_semi")
        .select("lang", "hash", F.left(letters(F.col("text")), F.lit(DICT_PIECE)).alias("piece"))
        .dropDuplicates(["lang", "hash"])
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("hash", "piece"))).alias("pieces"))
    )
    return {
        r["lang"]: " ".join(p["piece"] for p in r["pieces"]).encode()[:DICT_BYTES]
        for r in pieces.collect()
    }


class Compressor:
    """Sizes of texts under one language's dictionary."""

    def __init__(self, dictionary: bytes):
        raw = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=LEVEL)
        self.compress = zstandard.ZstdCompressor(
            level=LEVEL,
            dict_data=raw,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        ).compress
        self.probe = b" ".join(dictionary.split()[::PROBE_STEP][-PROBE_WORDS:]) + b" "
        self.probe_size = len(self.compress(self.probe))

    def size(self, text: bytes) -> int:
        if len(text) < SHORT_BYTES:
            return max(0, len(self.compress(self.probe + text)) - self.probe_size)
        compress = self.compress
        return sum(
            [len(compress(text[at : at + BLOCK_BYTES])) for at in range(0, len(text), BLOCK_BYTES)]
        )


def compressors(dictionaries: dict[str, bytes]) -> dict[str, Compressor]:
    return {lang: Compressor(dictionaries[lang]) for lang in sorted(dictionaries)}


def classify(text: bytes | None, by_lang: dict[str, Compressor]) -> tuple[str, float]:
    """Language and margin of one text of letters."""
    if not text or not by_lang:
        return UNKNOWN, 0.0
    sizes = sorted((compressor.size(text), lang) for lang, compressor in by_lang.items())
    if len(sizes) == 1:
        return sizes[0][1], 1.0
    return sizes[0][1], (sizes[1][0] - sizes[0][0]) / max(1, sizes[1][0])


def language(text: Column, dictionaries: dict[str, bytes]) -> Column:
    """``lang`` and ``score`` of a text."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        by_lang = compressors(dictionaries)
        for batch in batches:
            texts = batch.cast(pa.large_binary())
            found = [classify(t.as_py(), by_lang) for t in texts]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                ["lang", "score"],
            )

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, _RESULT)(letters(text))


def rejected(lang: Column, score: Column, min_margin: float = MIN_MARGIN) -> Column:
    return (lang == UNKNOWN) | (score < min_margin)


def identify(docs: DataFrame, min_margin: float = MIN_MARGIN) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every row."""
    found = docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        language(F.col("text"), learn(docs)).alias("found"),
    )
    return found.select(
        "doc_id",
        "held_out",
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
        rejected(F.col("found.lang"), F.col("found.score"), min_margin).alias("rejected"),
    )


def keep_identified(docs: DataFrame, min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of ``docs`` whose language is found by a clear margin, unchanged."""
    (answer,) = unused(docs.columns, "found")
    found = docs.withColumn(answer, language(F.col("text"), learn(docs)))
    return found.filter(
        ~rejected(F.col(answer)["lang"], F.col(answer)["score"], min_margin)
    ).drop(answer)
