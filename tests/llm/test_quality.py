"""Counts against plain Python, and the label model against planted accuracies."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusvec.llm import quality

SCHEMA = "doc_id long, text string, n_words string"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text),
        len(lines) - len(set(lines)), len(covered), sum(c in quality.DIGITS for c in text),
        len(lines), len(set(words)),
    )


TEXTS = [
    None, "", " \n\t", "a", "a b", "a b c", "a a a", "a a a a", "a b c a b c", "x y x y x y x",
    "é ü ß same word\né ü", "line\nline\n\nline \n", "# * $ % & | < > 12 34", "1\n1\n1",
    " ".join(random.Random(1).choices("abcd", k=60)), "a b c d\ra b c\x0bd a\x0cb c",
]


def test_counts_are_exact(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], SCHEMA)
    got = {r["doc_id"]: tuple(r)[1:] for r in quality.measure(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_em_finds_the_habits_of_rules(spark):
    rng = random.Random(7)
    # How often a rule casts a good or a bad vote, for good and for bad texts.
    habits = {
        rule: {1: (g, 0.2), -1: (0.02, b)}
        for rule, g, b in zip(quality.RULES, (0.9, 0.8, 0.95, 0.7, 0.9, 0.85, 0.6), (0.3, 0.7, 0.6, 0.5, 0.4, 0.7, 0.6))
    }
    rows = []
    for _ in range(6000):
        kind = 0 if rng.random() < 0.8 else 1
        row = []
        for votes in habits.values():
            x = rng.random()
            row.append(1 if x < votes[1][kind] else -1 if x < votes[1][kind] + votes[-1][kind] else 0)
        rows.append(tuple(row))
    prior, found = quality.fit(spark.createDataFrame(rows, list(habits)), rounds=40)
    assert prior == pytest.approx(0.8, abs=0.03)
    for rule, votes in habits.items():
        for cast, shares in votes.items():
            assert found[rule][cast] == pytest.approx(shares, abs=0.06)
        assert sum(x[0] for x in found[rule].values()) == pytest.approx(1)


def test_votes_and_quartiles(spark):
    rows = [(i, "word " * 99 + "word" + " #" * s, "x") for i, s in enumerate([0, 0, 0, 1, 2, 4, 10, 60])]
    measured = quality.measure(spark.createDataFrame(rows + [(50, None, "x"), (51, "\n", "x")], SCHEMA))
    assert quality.quartiles(measured)["few_symbols"] == (0, 38)
    votes = {r["doc_id"]: r["few_symbols"] for r in quality.vote(measured).collect()}
    # Good up to 38 + 0.5 * 38 + 25, bad beyond 38 + 1.5 * 38 + 50 parts per thousand.
    assert votes == {0: 1, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 0, 7: -1, 50: 0, 51: 0}


def test_posterior_decides_on_real_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge(docs).join(labels.select("doc_id", F.col("quality").alias("label")), "doc_id", "left")
    rows = judged.collect()
    passed = [r for r in rows if not r["base_failed"]]
    assert any(r["quality"] < 0.5 for r in passed) and any(r["quality"] > 0.5 for r in passed)
    labelled = [r for r in passed if r["label"] is not None]
    wrong = sum(r["kept"] != (r["label"] == 1) for r in labelled)
    assert 5 * wrong < sum(r["label"] == 0 for r in labelled)
    _, shares = quality.fit(quality.vote(quality.measure(docs)))
    assert all(0 < x < 1 for votes in shares.values() for pair in votes.values() for x in pair)


def test_verdicts(spark):
    rng = random.Random(3)
    plain = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    rows = [(i, plain(200), "x") for i in range(30)]
    rows += [(100, "buy # $ now " * 60, "x"), (101, plain(49), "x"), (102, None, "x"), (102, None, "x")]
    got = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i]["kept"] for i in range(30))
    assert not got[100]["kept"] and got[101]["base_failed"] and got[102]["base_failed"]
    assert got[102]["n_words"] == 0


def test_very_long_text(spark):
    text = "\n".join(f"line {i} of {i % 700} # and so on" for i in range(20_000))
    got = quality.measure(spark.createDataFrame([(1, text, "x")], SCHEMA)).first()
    words, lines = text.split(), text.split("\n")
    assert (got["n_words"], got["n_distinct_words"], got["n_lines"]) == (len(words), len(set(words)), len(lines))
    assert got["n_symbols"] == 20_000 and got["word_chars"] == sum(map(len, words)) and got["n_dup_lines"] == 0
    # "and so on", "so on line" and "# and so", "of n #" and others come again; only n differs.
    windows = {}
    for w in zip(words, words[1:], words[2:]):
        windows[w] = windows.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    assert got["n_repeat_words"] == len(covered)


def test_empty_table(spark):
    assert quality.judge(spark.createDataFrame([], SCHEMA)).count() == 0


def test_main_path_has_no_python(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = quality.measure(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
