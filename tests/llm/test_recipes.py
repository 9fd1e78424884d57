"""Exact duplicates against grouping by normalised text, with colliding digests too."""

import hashlib
import random
import re

import pyarrow as pa
import pytest

from corpusvec.llm import recipes

SCHEMA = "doc_id long, text string, recipe string"


def brute(rows):
    clean = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
    out, seen = [], set()
    for row, text in zip(rows, clean):
        ids = [r[0] for r, t in zip(rows, clean) if t == text and r[0] is not None]
        keep = min(ids, default=None)
        kept = row[0] == keep and text not in seen
        if kept:
            seen.add(text)
        out.append((row[0], keep, clean.count(text), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def made_rows():
    rng = random.Random(2)
    long = "".join(rng.choices("abcdefghij klmnop\n", k=60_000))
    texts = [long, long.replace("\n", " \t"), long[:-1] + "#", "x" + long[1:], "z" * 40_000, "z" * 40_001,
             "z" * 40_000, None, "", " ", "\n\t ", " a", "a", "a b", "a\n\nb", "é ü", "é  ü"]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    return rows + [(3, texts[3], "x"), (3, texts[3], "x"), (None, "a", "x"), (None, "only null", "x"), (None, "only null", "y")]


@pytest.mark.parametrize("digest_bytes", [16, 1])
def test_against_grouping_by_text(spark, digest_bytes):
    rows = made_rows()
    got = recipes.exact_duplicates(spark.createDataFrame(rows, SCHEMA), digest_bytes).collect()
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == brute(rows)


def test_chunks_make_up_the_text_and_follow_its_content():
    rng = random.Random(5)
    text = "".join(rng.choices("abcdef  \n", k=50_000))
    moved = "another beginning. " + text
    batch = pa.record_batch({"text": pa.array([text, None, moved, "q" * 100_000])})
    found = [(t, p) for _, t, p in recipes.chunked(batch)]
    for whole, pieces in found:
        assert b"".join(pieces) == whole and all(0 < len(p) <= recipes.MAX_CHUNK for p in pieces)
    assert len(set(found[0][1]) & set(found[2][1])) >= len(found[0][1]) - 2 > 10
    assert [p for _, p in found][1] == []
    alone = [p for _, _, p in recipes.chunked(pa.record_batch({"text": pa.array([moved])}))]
    assert alone[0] == found[2][1]


def test_empty_table(spark):
    assert recipes.exact_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
