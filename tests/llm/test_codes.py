"""Vector codes against plain integer loops, and products against Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from corpusvec.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int, code int, decoded string"


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return [], ""
    dim = -(-max(1, max(len(r[1]) for r in kept)) // parts) * parts
    width = dim // parts
    ints = [[math.floor(256 * x) for x in r[1]] + [0] * (dim - len(r[1])) for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(ints[i], p) for i in order[:entries]] for p in range(parts)]

    def nearest(v, p):
        distances = [sum((a - b) ** 2 for a, b in zip(cut(v, p), c)) for c in books[p]]
        return distances.index(min(distances)), min(distances)

    for _ in range(rounds):
        assigned = [[nearest(v, p)[0] for p in range(parts)] for v in ints]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut(v, p) for v, a in zip(ints, assigned) if a[p] == e]
                if mine:
                    books[p][e] = [sum(col) // len(mine) for col in zip(*mine)]
    found = [[nearest(v, p) for p in range(parts)] for v in ints]
    errors = [sum(d for _, d in f) for f in found]
    by_label = {}
    for r, e in zip(kept, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [
        (r[0], "".join(f"{e:02x}" for e, _ in f), error, by_label[r[2]])
        for r, f, error in zip(kept, found, errors)
    ]
    return out, digest


def made_rows(n, dim, seed, spread=1.0):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, spread) for _ in range(dim)], rng.choice([1, 2, None]), 0, "x") for i in range(n)]
    rng.shuffle(rows)
    return rows


def found(df):
    return sorted(repr(tuple(r)[:4]) for r in df.collect())


@pytest.mark.parametrize("n, dim, spread", [(150, 32, 0.3), (100, 64, 900.0), (20, 16, 0.0)])
def test_against_loops(spark, n, dim, spread):
    rows = made_rows(n, dim, n, spread)
    want, digest = brute(rows)
    got = codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert found(got) == sorted(map(repr, want))
    assert {r["codebooks_sha256"] for r in got.collect()} == {digest}


def test_odd_rows(spark):
    rows = made_rows(80, 30, 3)
    rows += [rows[0], rows[0], (None, rows[1][1], 5, 0, "x"), (None, [], None, 0, "x"), (5, [0.25] * 3, 1, 0, "x")]
    bad = [(900, None, 1, 0, "x"), (901, [1.0, None], 1, 0, "x"), (902, [math.nan] * 30, 1, 0, "x"), (903, [math.inf], 1, 0, "x")]
    want, _ = brute(rows)
    assert found(codes.compress(spark.createDataFrame(rows + bad, SCHEMA))) == sorted(map(repr, want))
    assert codes.compress(spark.createDataFrame(bad, SCHEMA)).count() == 0
    assert codes.compress(spark.createDataFrame([], SCHEMA)).count() == 0
    assert codes.compress(spark.createDataFrame([(1, [], 1, 0, "x")], SCHEMA)).first()["code"] == "00" * 16


def test_ties_go_to_the_first_entry():
    parts = np.array([[0, 0], [4, 0], [2, 0]])
    book = np.array([[2, 2], [0, 0], [4, 0], [0, 0]])
    code, distance = codes.nearest(parts, book)
    assert code.tolist() == [1, 2, 0] and distance.tolist() == [0, 0, 4]


@pytest.mark.parametrize("width", [1, 4, 300])
def test_products_are_exact(width):
    rng = np.random.default_rng(width)
    for size in (1, 300, 1 << 20, 1 << 27):
        a = rng.integers(-size, size + 1, (7, width))
        b = rng.integers(-size, size + 1, (5, width))
        exact = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert codes.exact_products(a, b).tolist() == exact
        # Plain float64 would not do for the largest.
        bits = codes.limb_bits(width)
        for shift, limb in codes.limbs(a, bits):
            assert np.abs(limb).max() <= 1 << (bits - 1) and shift % bits == 0
        assert (sum(limb.astype(np.int64) << shift for shift, limb in codes.limbs(a, bits)) == a).all()
        assert width << (2 * bits - 2) < 1 << 53


def test_too_large_components_are_refused(spark):
    rows = [(1, [1e9] * 16, 1, 0, "x")]
    with pytest.raises(ValueError, match="too large"):
        codes.compress(spark.createDataFrame(rows, SCHEMA))


def test_decoding_is_as_far_off_as_the_error_says(spark):
    rows = made_rows(90, 32, 8, 0.4)
    table = spark.createDataFrame(rows, SCHEMA)
    codec = codes.train(table)
    coded = codes.encode(table, codec).collect()
    given = {r[0]: np.floor(256 * np.array(r[1])) for r in rows}
    for r in codes.decode(spark.createDataFrame(coded), codec).collect():
        assert ((given[r["vec_id"]] - 256 * np.array(r["decoded"])) ** 2).sum() == r["error"]
