"""Fill-in-the-middle outputs against plain string slicing, and exact round trips."""

import hashlib
import random

import pytest

from corpusvec.llm import middle

SCHEMA = "doc_id long, text string, output string, form int, n string"


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b, c = text[:low], text[low:high], text[high:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", low, high - low, f"<S>{c}<P>{a}<M>{b}"
    return doc_id, n, "psm", low, high - low, f"<P>{a}<S>{c}<M>{b}"


def made_rows():
    rng = random.Random(4)
    texts = [None, "", " ", "a", "é", "ab", "<P>", "x<M>y", "<<P", "S>", "a<", "<", ">", "P>M>S>", "<P<S<M", "日本語", "\U0001f600é"]
    texts += ["".join(rng.choices("ab<>PSM éü日\U0001f600\n", k=rng.randint(0, 60))) for _ in range(300)]
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(texts)]
    return rows + [(None, "no id", "x", 1, "y"), (None, None, "x", 1, "y"), (7, texts[7], "z", 2, "z"), (-5, "below zero", "", 0, "")]


def test_against_slicing(spark):
    rows = made_rows()
    out = middle.rearrange(spark.createDataFrame(rows, SCHEMA))
    got = sorted(map(repr, map(tuple, out.collect())))
    assert got == sorted(repr(brute(r[0], r[1])) for r in rows)
    assert {"plain", "psm", "spm"} == {r["form"] for r in out.collect()}
    back = middle.restore(out).collect()
    assert sorted((repr(r["doc_id"]), r["restored"]) for r in back) == sorted((repr(r[0]), r[1] or "") for r in rows)
    # The output and its form are all that restoring needs.
    alone = middle.restore(out.select("output", "form")).collect()
    assert sorted(r["restored"] for r in alone) == sorted(r[1] or "" for r in rows)


@pytest.mark.parametrize("block", [1, 2, 7, 1 << 20])
def test_blocks_of_any_size(monkeypatch, block):
    monkeypatch.setattr(middle, "BLOCK", block)
    rng = random.Random(block)
    for doc_id in range(120):
        text = "".join(rng.choices("abcé日\U0001f600", k=rng.randint(0, 40)))
        buffer, form, n, prefix, length = middle.rearrange_text(text.encode(), doc_id)
        assert (doc_id, n, form, prefix, length, buffer.decode()) == brute(doc_id, text)
        assert middle.restore_text(bytes(buffer), form).decode() == text


def test_rotation_is_its_own_way_back():
    for a, b, c, d in ((0, 0, 5, 9), (2, 4, 9, 9), (0, 3, 9, 9), (1, 1, 1, 1), (0, 9, 9, 9)):
        buffer = bytearray(b"abcdefghi")
        middle.rotate(buffer, a, b, c)
        assert bytes(buffer) == b"abcdefghi"[:a] + b"abcdefghi"[b:c] + b"abcdefghi"[a:b] + b"abcdefghi"[c:]
        middle.rotate(buffer, a, a + c - b, c)
        assert bytes(buffer) == b"abcdefghi"


def test_very_long_text_and_other_ids(spark):
    text = "wörd 日本 " * 200_000
    rows = [(str(i), text) for i in range(3)] + [("a b", "short")]
    out = middle.rearrange(spark.createDataFrame(rows, "doc_id string, text string"))
    got = {r["doc_id"]: tuple(r) for r in out.collect()}
    assert got == {r[0]: brute(*r) for r in rows}
    assert {r["restored"] for r in middle.restore(out).collect()} == {text, "short"}


def test_rates(spark):
    rows = [(i, "some text") for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["form"] for r in middle.rearrange(table, rate=0).collect()} == {"plain"}
    assert {r["form"] for r in middle.rearrange(table, rate=100, spm_rate=100).collect()} == {"spm"}
    assert middle.rearrange(table, seed=2).select("output").exceptAll(middle.rearrange(table).select("output")).count()


def test_empty_table(spark):
    empty = middle.rearrange(spark.createDataFrame([], SCHEMA))
    assert middle.digests(empty).count() == 0
