"""Repeated strings against a count of every window."""

import hashlib
import random

import numpy as np
import pytest

from corpusvec.llm import suffixes

SCHEMA = "doc_id long, text string, extra int"
EMPTY = hashlib.sha256(b"").hexdigest()


def brute(texts, length=suffixes.LENGTH):
    """``n_bytes, n_removed, n_spans, kept_sha256`` of each text."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for b in data:
        for p in range(len(b) - length + 1):
            window = hashlib.blake2b(b[p : p + length], digest_size=12).digest()
            seen[window] = seen.get(window, 0) + 1
    result = []
    for b in data:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - length + 1):
            if seen[hashlib.blake2b(b[p : p + length], digest_size=12).digest()] > 1:
                gone[p : p + length] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(b) else 0
        result.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return result


def expected(texts, length=suffixes.LENGTH, short=suffixes.SHORT):
    """The same, and the bytes that strings of the shorter length cover."""
    return [(*b, s[1]) for b, s in zip(brute(texts, length), brute(texts, short))]


def made_texts(seed, alphabet="abcdefgh éü\n"):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choices(alphabet, k=n))
    shared = [make(rng.randint(300, 900)) for _ in range(4)]
    texts = [None, "", "x" * 239, "x" * 240, "x" * 399, "y" * 400, "z" * 401, "z" * 2000, "ab" * 700]
    for _ in range(14):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts.append(make(rng.randint(0, 500)))
            passage = rng.choice(shared)
            cut = rng.randint(0, 200)
            parts.append(passage[cut : len(passage) - rng.randint(0, 200)])
        texts.append("".join(parts))
    return texts + [texts[-1], texts[-2] + "tail", "y" * 400]


def rows_of(texts):
    ids = [None, 1, 1, 2, 2, 3, 4, *range(5, 5 + len(texts))][: len(texts)]
    return [(i, t, 0) for i, t in zip(ids, texts)]


def found(df):
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated"]
    return sorted(map(repr, (tuple(r[c] for c in cols) for r in df.collect())))


# Small buckets are split down to a single shift; names of a few bits collide.
@pytest.mark.parametrize("seed, bucket_rows, name_bits", [(1, 50_000, 64), (2, 1, 64), (3, 4, 3), (4, 50_000, 1)])
def test_against_every_window(spark, seed, bucket_rows, name_bits):
    texts = made_texts(seed)
    rows = rows_of(texts)
    got = suffixes.remove_repeats(
        spark.createDataFrame(rows, SCHEMA), bucket_rows=bucket_rows, name_bits=name_bits
    )
    assert found(got) == sorted(repr((r[0], *b)) for r, b in zip(rows, expected(texts)))


def test_one_length(spark):
    texts = made_texts(6)
    got = suffixes.remove_repeats(spark.createDataFrame(rows_of(texts), SCHEMA), length=210, short=210)
    assert found(got) == sorted(repr((r[0], *b)) for r, b in zip(rows_of(texts), expected(texts, 210, 210)))
    with pytest.raises(ValueError):
        suffixes.remove_repeats(spark.createDataFrame([], SCHEMA), length=200)


def test_many_surroundings_of_one_passage(spark):
    rng = random.Random(12)
    make = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage, sides = make(330), [make(rng.randint(0, 90)) for _ in range(12)]
    texts = [rng.choice(sides)[-rng.randint(1, 90) :] + passage + rng.choice(sides) + make(3) for _ in range(60)]
    rows = [(i, t, 0) for i, t in enumerate(texts)]
    got = suffixes.remove_repeats(spark.createDataFrame(rows, SCHEMA), bucket_rows=5)
    assert found(got) == sorted(repr((r[0], *b)) for r, b in zip(rows, expected(texts)))


def test_very_long_text(spark):
    rng = random.Random(8)
    long = "".join(rng.choices("abcdefghij ", k=3_000_000))
    texts = [long, long[1_000_000:1_000_500], long[2_999_700:], "x" + long[:380]]
    rows = [(i, t, 0) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in suffixes.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [(got[i]["n_removed"], got[i]["n_repeated"]) for i in range(4)] == [(500, 1180), (500, 500), (0, 300), (0, 380)]


def test_samples_are_chosen_by_content(monkeypatch):
    rng = np.random.default_rng(5)
    text = rng.integers(97, 101, 5000).astype(np.uint8)
    at, first, last = suffixes.samples(text)
    assert first[0] == 0 and last[-1] == 4600 and (first[1:] == last[:-1] + 1).all()
    assert ((at >= last) & (at - first < suffixes.SPAN)).all()
    moved, m_first, m_last = suffixes.samples(text[333:])
    shifts = {(a - p) for a, f, z in zip(moved, m_first, m_last) for p in (f, z)}
    whole = {p + 0: a for a, f, z in zip(at, first, last) for p in range(f, z + 1)}
    assert all(whole[p + 333] == a + 333 for a, f, z in zip(moved, m_first, m_last) for p in (f, z))
    assert min(shifts) >= 0
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 700)
    assert all((x == y).all() for x, y in zip(suffixes.samples(text), (at, first, last)))


def test_query_against_every_window(spark, sf):
    from corpusvec.llm.queries import op10_suffixes

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(repr((d["doc_id"], *b)) for d, b in zip(docs, expected([d["text"] for d in docs])))
    assert found(op10_suffixes(spark, sf)) == want


def test_text_keeps_whole_characters(spark):
    shared = "ab" * 10 + "é" + "".join(random.Random(3).choices("klmnop", k=400))
    # Both texts have the second byte of a two-byte character before the shared part.
    rows = [(1, "one Ã" + shared[20:] + " end", 1), (2, "two é" + shared[20:] + "! no", 2), (3, None, 3)]
    rows += [(4, "copy " * 100, 4), (5, "copy " * 100, 5)]
    got = {r["doc_id"]: r for r in suffixes.cut_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1]["text"] == "one Ã end" and got[2]["text"] == "two é! no"
    assert got[3]["text"] is None and got[4]["text"] == got[5]["text"] == ""
    assert [got[i]["extra"] for i in range(1, 6)] == [1, 2, 3, 4, 5]


def test_clashing_names(spark):
    names = ["doc_id", "text", "key", "__key", "kept_text", "__new_text", "whole", "id", "n", "sure"]
    rows = [(i, t, *names[2:]) for i, t in enumerate(["copy " * 100, "copy " * 100, "alone", None])]
    got = suffixes.cut_repeats(spark.createDataFrame(rows, names))
    assert got.columns == names
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(
        repr((i, t, *names[2:])) for i, t in enumerate(["", "", "alone", None])
    )


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffixes.remove_repeats(empty).count() == 0 == suffixes.cut_repeats(empty).count()
