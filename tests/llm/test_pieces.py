"""The parallel encoding against plain Viterbi, and the round trip."""

import random

import numpy as np
import pytest

from corpusvec.llm import pieces
from corpusvec.llm.vocabulary import MARK, load, vocabulary_path

SCHEMA = "doc_id long, text string, chunk string"


@pytest.fixture(scope="module")
def vocabulary():
    return load(vocabulary_path())


def brute_score(vocabulary, text):
    """Best sum over all segmentations, position by position."""
    text = pieces.marked(text)
    best = [0.0] + [-np.inf] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - vocabulary.longest), j):
            found = vocabulary.pieces.get(text[i:j])
            if found:
                best[j] = max(best[j], best[i] + found[1])
        if text[j - 1] not in vocabulary.pieces:
            plain = {MARK: " ", pieces.HIDDEN_MARK: MARK}.get(text[j - 1], text[j - 1])
            best[j] = max(best[j], best[j - 1] + len(plain.encode()) * vocabulary.byte_score)
    return best[-1]


def score_of(vocabulary, ids):
    scores = {i: s for i, s in vocabulary.pieces.values()}
    return sum(scores.get(i, vocabulary.byte_score) for i in ids)


def made_texts():
    rng = random.Random(4)
    words = ["the", "internationalisation", "é", "日本", "x" * 90, "", "", "a\nb", "\t", f"{MARK}lit", "🙂"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(12)]
    return texts + ["", None, " ", "   ", "nospacesatall" * 40, "日本" * 60, " lead and trail  ", "a"]


@pytest.mark.parametrize("chunk_chars, block", [(1 << 16, 256), (7, 3), (40, 2), (64, 256)])
def test_best_score_and_round_trip(spark, vocabulary, chunk_chars, block):
    texts = made_texts()
    rows = [(i, t, "c") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    encoded = pieces.encode(df, chunk_chars=chunk_chars, block=block)
    ids = {}
    for r in sorted(encoded.collect(), key=lambda r: (r["doc_id"], r["chunk"])):
        ids.setdefault(r["doc_id"], []).extend(r["ids"])
        assert r["n_pieces"] == len(r["ids"])
    for i, text in enumerate(texts):
        assert score_of(vocabulary, ids[i]) == brute_score(vocabulary, text or "")
    if chunk_chars in (7, 1 << 16):
        decoded = {r["doc_id"]: r["text"] for r in pieces.decoded_documents(encoded).collect()}
        assert decoded == {i: t or "" for i, t in enumerate(texts)}


def test_matrices_combine_associatively(vocabulary):
    encoder = pieces.Encoder(vocabulary)
    text = pieces.marked("nothing in thisisaverylongword that and more of it")
    parts = [(text[i : i + 5 + encoder.states], len(text[i : i + 5])) for i in range(0, len(text), 5)]
    m = [encoder.transfer(*p) for p in parts]
    left, right = m[0], m[-1]
    for x in m[1:]:
        left = pieces.combine(left, x)
    for x in reversed(m[:-1]):
        right = pieces.combine(x, right)
    assert (left == right).all()
    assert left[0, 0] == brute_score(vocabulary, "nothing in thisisaverylongword that and more of it")


def test_repeated_rows_and_ids(spark):
    long = "word after word " * 20
    rows = [(1, long, "a"), (1, long, "b"), (None, long, "c"), (None, "other " * 30, "d"), (1, "other", "e")]
    encoded = pieces.encode(spark.createDataFrame(rows, SCHEMA), chunk_chars=50)
    got = pieces.decode(encoded).withColumn("text", pieces.F.col("text").cast("string")).collect()
    assert sum(len(r["text"]) for r in got) == sum(len(r[1]) for r in rows)


def test_empty_table(spark):
    encoded = pieces.encode(spark.createDataFrame([], SCHEMA))
    assert encoded.count() == 0 == pieces.decoded_documents(encoded).count()


def test_query_gives_the_texts_back(spark, sf, vocabulary):
    from corpusvec.llm.queries import op7_pieces

    texts = {}
    for r in sorted(op7_pieces(spark, sf).collect(), key=lambda r: (r["doc_id"], r["chunk"])):
        texts[r["doc_id"]] = texts.get(r["doc_id"], "") + r["text"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert texts == {r["doc_id"]: r["text"] for r in docs}


COMMON = ["the", "language", "government", "international", "have", "people", "system"]


def own_ids(texts):
    from sentencepiece import SentencePieceProcessor

    return [list(ids) for ids in SentencePieceProcessor(model_file=vocabulary_path()).encode(texts)]


def ids_of(spark, texts, **options):
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], SCHEMA)
    found = [[] for _ in texts]
    for r in sorted(pieces.encode(df, **options).collect(), key=lambda r: (r["doc_id"], r["chunk"])):
        found[r["doc_id"]] += r["ids"]
    return found


@pytest.mark.parametrize("chunk_chars", [1 << 16, 7])
def test_frequent_words_are_the_pieces_of_the_model(spark, chunk_chars):
    texts = [*COMMON, " ".join(COMMON), "the  people", " the people", "", "日本 🙂", "the"]
    got = ids_of(spark, texts, chunk_chars=chunk_chars)
    assert got == own_ids(texts)
    assert all(len(ids) == 1 for ids in got[: len(COMMON)])


def test_most_words_are_the_pieces_of_the_model(spark, sf):
    words = sorted({w for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for w in r["text"].split()})
    got, want = ids_of(spark, words), own_ids(words)
    assert sum(a == b for a, b in zip(got, want)) > 0.6 * len(words)
    # Neither split up nor run together: the number of pieces is the model's within 3 %.
    assert sum(map(len, got)) == pytest.approx(sum(map(len, want)), rel=0.03)


@pytest.mark.parametrize("chunk_chars", [1 << 16, 7])
def test_no_character_stands_for_a_literal_mark(spark, vocabulary, chunk_chars):
    texts = ["\uffff", f"a\uffff b {MARK}\uffff{MARK} c", f"{MARK}", "\ufffe\uffff" * 9, "\U0010ffff"]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], SCHEMA)
    encoded = pieces.encode(df, chunk_chars=chunk_chars)
    assert {r["doc_id"]: r["text"] for r in pieces.decoded_documents(encoded).collect()} == dict(enumerate(texts))
