"""Fingerprints against a plain MinHash, likenesses against Jaccard, edits against slicing."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusvec.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, fingerprint string, next int, key string"
LOWER = {i: i + 32 for i in range(65, 91)}
MASK = (1 << 64) - 1


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def chained(values, seed=42):
    for v in values:
        seed = xxhash.xxh64_intdigest((v & MASK).to_bytes(8, "little"), seed)
    return seed


def small_chained(number, value):
    """Two integers as they are hashed together: 4 bytes and 8 bytes."""
    return xxhash.xxh64_intdigest((value & MASK).to_bytes(8, "little"), xxhash.xxh64_intdigest(number.to_bytes(4, "little"), 42))


def brute(text):
    hashes = {chained(xxhash.xxh64_intdigest(w.encode(), 42) for w in s) for s in shingles(text)}
    if not hashes:
        return ""
    # Bins are numbered by the signed hash.
    number = lambda h: ((h >> 56) + 128) % 256
    smallest = {}
    for h in hashes:
        smallest[number(h)] = min(h, smallest.get(number(h), MASK))
    out = []
    for b in range(256):
        value = smallest.get(b)
        if value is None:
            for attempt in range(fp.PROBES):
                value = value or smallest.get(fp.probe(b, attempt))
        if value is None:
            signed = lambda h: h - (1 << 64) if h >> 63 else h
            value = min(smallest.values(), key=lambda h: signed(small_chained(b, h >> 56)))
        mixed = xxhash.xxh64_intdigest(b.to_bytes(4, "little"), chained([value]))
        out.append(f"{mixed & 255:02x}")
    return "".join(out)


TEXTS = [
    None, "", " \n", "one", "ONE", "a b c d", "a b c d e", "a b c d e f g", "é ü ß é ü ß é",
    "same five words over again " * 30, "x" * 50_000,
    *(" ".join(random.Random(n).choices("abcdefghijklmnop", k=n)) for n in (6, 12, 40, 120, 400, 3000)),
]


def test_against_plain_minhash(spark):
    rows = [(i, t, "old", 0, "k") for i, t in enumerate(TEXTS)] + [(None, TEXTS[-1], None, None, None)]
    df = fp.fingerprinted(spark.createDataFrame(rows, SCHEMA)).select("*", fp.as_text(F.col("fingerprint")).alias("hex"))
    got = df.collect()
    assert df.columns == ["doc_id", "text", "fingerprint", "next", "key", "hex"]
    assert [r["hex"] for r in got] == [brute(r["text"]) for r in got]


def likenesses(pairs):
    both = pairs.select(fp.fingerprint(F.col("a")).alias("x"), fp.fingerprint(F.col("b")).alias("y"))
    return [r["likeness"] for r in both.select(fp.likeness(F.col("x"), F.col("y")).alias("likeness")).collect()]


def test_likeness_estimates_jaccard(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(3000)]
    pairs = []
    for n in (12, 60, 300, 1200):
        for share in (0.0, 0.3, 0.6, 0.9, 1.0):
            for _ in range(12):
                a = rng.choices(words, k=n)
                at = int(n * share)
                pairs.append((" ".join(a), " ".join(a[:at] + rng.choices(words, k=n - at))))
    df = spark.createDataFrame(pairs, "a string, b string")
    found = likenesses(df)
    errors = np.array([x - jaccard(*p) for x, p in zip(found, pairs)])
    assert abs(errors.mean()) < 0.01 and np.sqrt((errors**2).mean()) < 0.04
    assert all(x == 1.0 for x, p in zip(found, pairs) if p[0] == p[1])


def test_texts_without_words(spark):
    df = spark.createDataFrame([("", " \n"), ("", "word"), ("word", "WORD")], "a string, b string")
    assert likenesses(df) == [1.0, 0.0, 1.0]


def edited(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = []
    for k, r in enumerate(ordered):
        text, following = r[1] or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        out.append((r[0], len(text), text[: len(text) - half] + following[:half], text, following))
    return out


@pytest.mark.parametrize("n, partitions", [(1, "1"), (2, "4"), (90, "3"), (90, "40")])
def test_edits_against_slicing(spark, n, partitions):
    rng = random.Random(n)
    rows = [(3 * i - 20, "".join(rng.choices("ab é日\n", k=rng.choice((0, 1, 7, 50)))), "x", 1, "y") for i in range(n)]
    rows = rows[:-1] + [(None, "an id is missing", "x", 1, "y")]
    rng.shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r["doc_id"]: r for r in fp.compare_edited(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = edited(rows)
    assert len(got) == len(want) == n
    for doc_id, chars, text, own, following in want:
        r = got[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (chars, hashlib.sha256(text.encode()).hexdigest())
        assert r["fingerprint"] == brute(own) and r["edited_fingerprint"] == brute(text)
        same = brute(own) == brute(following)
        assert (r["near_next"] == 1.0) == same


def test_repeated_ids_are_told_apart_by_text(spark):
    rows = [(1, "b", "", 0, ""), (1, "a", "", 0, ""), (1, "a", "", 0, ""), (2, "c d", "", 0, ""), (None, None, "", 0, ""), (None, "n", "", 0, "")]
    following = fp.with_next(spark.createDataFrame(rows, SCHEMA), ["text", "next"])
    assert following.columns == ["doc_id", "text", "fingerprint", "key", "next"]
    got = [(r["doc_id"], r["text"], r["next"]["text"]) for r in following.collect()]
    assert sorted(map(repr, (g[:2] for g in got))) == sorted(map(repr, (r[:2] for r in rows)))
    assert sorted(map(repr, (g[2] for g in got))) == sorted(map(repr, (r[1] for r in rows)))
    assert fp.with_next(spark.createDataFrame([], SCHEMA), ["text"]).count() == 0
    assert fp.compare_edited(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_against_brute_force(spark, sf):
    from corpusvec.llm.queries import op13_fingerprints

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r["doc_id"]: r for r in op13_fingerprints(spark, sf).collect()}
    errors = []
    for doc_id, chars, text, own, following in edited(rows):
        r = got[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (chars, hashlib.sha256(text.encode()).hexdigest())
        assert r["fingerprint"] == brute(own)
        errors += [r["near_edited"] - jaccard(own, text), r["near_next"] - jaccard(own, following)]
    assert len(got) == len(rows) and abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.04


def test_main_path_has_no_python(spark, sf):
    found = fp.compare_edited(spark.read.parquet(f"{sf}/documents.parquet"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
