"""Lattice probabilities against all segmentations, and the query against plain sums."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from corpusvec.llm import lattice
from corpusvec.llm.vocabulary import MARK, load, vocabulary_path

SCHEMA = "doc_id long, text string, word string"


@pytest.fixture(scope="module")
def vocabulary():
    return load(vocabulary_path())


def every_segmentation(model, word):
    """Product of weights and ids of each way to spell a word."""
    text = MARK + word.replace(MARK, lattice.HIDDEN_MARK)

    def ways(j):
        if j == 0:
            yield 0.0, ()
            return
        for i in range(j):
            found = model.ahead.get(text[i:j])
            if found:
                for p, ids in ways(i):
                    yield p + found[0], (*ids, found[1])
        spelt = [model.bytes[b] for b in (b" " if j == 1 else word[j - 2].encode())]
        for p, ids in ways(j - 1):
            yield p + sum(x for x, _ in spelt), (*ids, *(i for _, i in spelt))

    return list(ways(len(text)))


@pytest.mark.parametrize("word", ["a", "the", "hello", "é", f"x{MARK}y", "\n", "日本"])
def test_word_against_all_segmentations(vocabulary, word):
    model = lattice.Lattice(vocabulary, lattice.starting_weights(vocabulary))
    ways = every_segmentation(model, word)
    total = math.log(sum(math.exp(p) for p, _ in ways))
    assert model.log_probability(word) == pytest.approx(total, rel=1e-12)
    expected = np.zeros(vocabulary.size)
    model.expect(word, 3, expected)
    want = np.zeros(vocabulary.size)
    for p, ids in ways:
        for i in ids:
            want[i] += 3 * math.exp(p - total)
    assert np.allclose(expected, want)


def test_no_character_stands_for_a_literal_mark(vocabulary):
    # Bytes of unlike weights, so that the two characters cannot have one score.
    logs = lattice.starting_weights(vocabulary)
    logs[list(vocabulary.byte_ids)] -= np.arange(256) / 100
    model = lattice.Lattice(vocabulary, logs)
    for word in ("\uffff", f"x\uffff{MARK}y"):
        ways = every_segmentation(model, word)
        assert model.log_probability(word) == pytest.approx(math.log(sum(math.exp(p) for p, _ in ways)), rel=1e-12)
    assert model.log_probability("\uffff") != model.log_probability(MARK)


def test_long_word_keeps_its_probability(vocabulary):
    model = lattice.Lattice(vocabulary, lattice.starting_weights(vocabulary))
    assert -math.inf < model.log_probability("abcde" * 20_000) < -100_000


def brute(rows, vocabulary):
    def tokens(text):
        return [w.decode() for w in (text or "").encode().lower().split()]

    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    counts = Counter(w for r, h in zip(rows, held) if not h for w in tokens(r[1]))
    ends = held.count(False)
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    sums = np.zeros(vocabulary.size)
    model = lattice.Lattice(vocabulary, lattice.starting_weights(vocabulary))
    for w, c in counts.items():
        model.expect(w, c, sums)
    usable = np.isfinite(lattice.starting_weights(vocabulary))
    smooth = sums + lattice.SMOOTHING * usable
    total = smooth.sum() + ends + lattice.SMOOTHING
    model = lattice.Lattice(vocabulary, lattice._logs(smooth / total))
    end = math.log10((ends + lattice.SMOOTHING) / total)
    out = []
    for r, h in zip(rows, held):
        words = tokens(r[1])
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        base += math.log10((ends + 1) / (n + v + 1))
        score = sum(model.log_probability(w) for w in words) / math.log(10) + end
        known = sum(counts[w] > 0 for w in words) + (ends > 0)
        out.append((r[0], h, len(words) + 1, known, n, base, score))
    return out


def agree(got, want):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted((tuple(r[n] for n in names) for r in got), key=repr)
    want = sorted(want, key=repr)
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("head", [100_000, 2])
def test_documents_against_plain_sums(spark, vocabulary, head):
    rows = [
        (1, "The cat SAT on the mat", "x"), (2, None, "x"), (3, "", None), (4, " \t\n", "y"),
        (5, "the the the dog é É unseen", "y"), (6, "hyper" * 3000, "z"), (None, "no id", "z"),
        (7, "twice", "z"), (7, "twice", "z"), (None, "no id", "z"),
        *((i, f"word{i} the", "z") for i in range(8, 30)),
    ]
    got = lattice.score_documents(spark.createDataFrame(rows, SCHEMA), head_words=head).collect()
    agree(got, brute(rows, vocabulary))


def test_empty_table(spark):
    assert lattice.score_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_against_plain_sums(spark, sf, vocabulary):
    from corpusvec.llm.queries import op4_lattice

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = op4_lattice(spark, sf).collect()
    agree(got, brute([tuple(r) for r in docs], vocabulary))
    # What was learned helps on texts that it was not learned from.
    untrained = lattice.score_documents(spark.read.parquet(f"{sf}/documents.parquet"), rounds=0)
    before = sum(r["score"] for r in untrained.collect() if r["held_out"])
    assert sum(r["score"] for r in got if r["held_out"]) > 0.9 * before > before
