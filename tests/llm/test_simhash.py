"""SimHash groups against all pairs."""

import re

import numpy as np
import pytest
import xxhash

from corpusvec.llm import simhash
from corpusvec.llm.components import connected_components

SCHEMA = "doc_id long, text string, component_id string"


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(keys, max_bits):
    """The smallest index that links reach, by all pairs."""
    label = list(range(len(keys)))
    changed = True
    while changed:
        changed = False
        for i in range(len(keys)):
            for j in range(i):
                if (keys[i] ^ keys[j]).bit_count() <= max_bits and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def clustered_keys(seed, clusters, members, flips):
    rng = np.random.default_rng(seed)
    keys = set()
    for centre in rng.integers(0, 1 << 63, clusters).tolist():
        for _ in range(members):
            key = centre
            for bit in rng.integers(0, 64, rng.integers(0, flips + 1)).tolist():
                key ^= 1 << bit
            keys.add(key)
    return sorted(keys)


def test_fingerprint_is_exact():
    for text in ["", None, " \t\n", "One", "a b c", "a b c d", "A b  c\nd e É é Ü", "x " * 500]:
        assert simhash.simhash((text or "").encode()) == brute_fingerprint(text)


def test_very_long_text(spark):
    text = " ".join(f"word{i % 977}" for i in range(150_000))
    rows = [(i, t, "x") for i, t in enumerate([text, text.upper(), "word1 word2"])]
    got = {r["doc_id"]: r for r in simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert int(got[0]["fingerprint"], 16) == brute_fingerprint(text)
    assert [got[i]["component_id"] for i in range(3)] == [0, 0, 2]


@pytest.mark.parametrize(
    "max_bits, target, node_rows",
    [(0, 2048, 200_000), (3, 4, 200_000), (4, 2048, 200_000), (4, 4, 10), (7, 4, 200_000)],
)
def test_links_span_the_groups(spark, max_bits, target, node_rows):
    keys = clustered_keys(max_bits, 12, 8, 6)
    signed = [(k - (1 << 64) if k >> 63 else k,) for k in keys]
    edges = simhash.links(
        spark.createDataFrame(signed, "fp long"), max_bits, node_target=target, node_rows=node_rows
    )
    found = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    want = groups_of(keys, max_bits)
    groups = {}
    for key, (fp,), label in zip(keys, signed, want):
        groups.setdefault(label, set()).add(found.get(fp, fp))
    roots = [r for g in groups.values() for r in g]
    assert all(len(g) == 1 for g in groups.values()) and len(set(roots)) == len(roots)


def test_dense_node_is_walked_in_pieces(monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 8)
    keys = np.array(clustered_keys(3, 3, 60, 5), dtype=np.uint64)
    a, b = simhash.forest(keys, 0, 0, 2, 4)
    assert len(a) < len(keys)
    assert all((int(x) ^ int(y)).bit_count() <= 64 for x, y in zip(a, b))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    roots = {r["node"]: r["root"] for r in got.collect()}
    assert got.count() == len(roots) == 31 + 60
    assert {roots[i] for i in range(31)} == {0} and {roots[i] for i in range(100, 160)} == {100}


def sample_rows():
    long = " ".join(f"w{i}" for i in range(400))
    near = long + " tail"
    return [
        (1, long, "x"), (2, near, "x"), (3, long, None), (3, long, "y"),
        (4, None, "x"), (5, "", "x"), (6, " \n", "x"), (7, "other words here now", "x"),
        (None, "nobody knows this text", "x"), (None, long, "x"),
    ]


def test_documents_against_all_pairs(spark):
    rows = sample_rows()
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    prints = [brute_fingerprint(r[1]) for r in rows]
    label = groups_of(prints, simhash.MAX_BITS)
    want = []
    for i, row in enumerate(rows):
        ids = [r[0] for r, g in zip(rows, label) if g == label[i] and r[0] is not None]
        want.append((row[0], f"{prints[i]:016x}", min(ids, default=None)))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_one_of_each_group_stays(spark):
    kept = simhash.drop_near_duplicates(spark.createDataFrame(sample_rows(), SCHEMA))
    assert kept.columns == ["doc_id", "text", "component_id"]
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 4, 7]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_query_against_all_pairs(spark, sf):
    from corpusvec.llm.queries import op2_simhash

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs}
    ids = sorted(prints)
    label = groups_of([prints[i] for i in ids], simhash.MAX_BITS)
    got = {r["doc_id"]: r for r in op2_simhash(spark, sf).collect()}
    assert {i: got[i]["fingerprint"] for i in ids} == {i: f"{prints[i]:016x}" for i in ids}
    assert {i: got[i]["component_id"] for i in ids} == {i: ids[g] for i, g in zip(ids, label)}
