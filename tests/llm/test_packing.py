"""Bucket boundaries against every choice, and batches against their rules."""

from itertools import combinations

import pytest

from corpusvec.llm import packing

SCHEMA = "doc_id long, text string, n_tokens string"


def padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= length) - length) for length, n in histogram.items())


@pytest.mark.parametrize("buckets", [1, 2, 3, 5, 20])
def test_boundaries_have_the_least_padding(buckets):
    histogram = {1: 50, 2: 3, 5: 40, 6: 1, 9: 7, 30: 2, 31: 90, 64: 5}
    got = packing.boundaries(histogram, buckets)
    lengths = sorted(histogram)
    choices = [
        (*c, lengths[-1]) for k in range(min(buckets, len(lengths))) for c in combinations(lengths[:-1], k)
    ]
    assert len(got) <= buckets and got[-1] == lengths[-1]
    assert padding(histogram, got) == min(padding(histogram, c) for c in choices)


def test_boundaries_of_nothing():
    assert packing.boundaries({}) == packing.boundaries({0: 7}) == []
    assert packing.boundaries({4: 1}, 8) == [4]


def test_rows_pieces_and_batches(spark):
    rows = [(i, "w " * (i % 23), "x") for i in range(200)]
    rows += [(None, "a b", "x"), (None, "a b", "x"), (7, "a", "x"), (300, None, "x"), (301, " \n", "x")]
    rows += [(302, "long " * 105, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = packing.pack_documents(df, max_tokens=40, buckets=4, batch_tokens=100).collect()
    assert len(got) == len(rows) + 2
    long = sorted((r["piece"], r["n_tokens"]) for r in got if r["doc_id"] == 302)
    assert long == [(0, 40), (1, 40), (2, 25)]
    assert sum(r["n_tokens"] for r in got) == sum(len((r[1] or "").split()) for r in rows)
    batches = {}
    for r in got:
        if r["n_tokens"] == 0:
            assert r["bucket_tokens"] is r["batch"] is r["slot"] is None
        else:
            assert r["n_tokens"] <= r["bucket_tokens"]
            batches.setdefault((r["bucket_tokens"], r["batch"]), []).append(r["slot"])
    for (tokens, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) * tokens <= 100
    for tokens in {b for b, _ in batches}:
        own = sorted(batch for b, batch in batches if b == tokens)
        assert own == list(range(len(own)))
        assert all(len(batches[tokens, b]) == 100 // tokens for b in own[:-1])


def test_empty_table_and_small_batches(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.pack_documents(empty).count() == 0
    with pytest.raises(ValueError):
        packing.pack(empty, max_tokens=10, batch_tokens=5)
