import random
import time

from pyspark.sql import functions as F

from corpusvec.operators import chunk as C


def pack(text, limit=1500):
    """Brute force: the reading order rule, word by word."""
    if len(text) <= limit:
        return [text]
    lengths, groups = 0, []
    for word in text.split():
        if groups and groups[-1] and lengths + len(word) + 1 > limit:
            groups.append([word])
            lengths = len(word)
        else:
            if not groups:
                groups.append([])
            groups[-1].append(word)
            lengths += len(word) + 1
    return [" ".join(g) for g in groups]


def pack_overlapping(text, limit=1500, overlap=200):
    words = text.split()
    spans, start = [], 0
    for i in range(len(words)):
        if i > start and len(" ".join(words[start : i + 1])) > limit:
            spans.append((start, i))
            start = next(
                (k for k in range(start + 1, i) if len(" ".join(words[k:i])) <= overlap), i
            )
    spans.append((start, len(words)))
    return [" ".join(words[a:b]) for a, b in spans]


def sample_texts():
    rng = random.Random(5)
    texts = ["", " \n ", " " * 1600, "x" * 2000, "a " * 800, "x" * 1500, "x" * 1501]
    texts += [("w" * n + " ") + "b " * 900 for n in (1497, 1498, 1499, 1500, 1501)]
    # A text of 1500 characters once squeezed, and one below it, both longer before.
    texts += ["ab  " * 374 + "ab" * n for n in (1, 2, 3)]
    separators = [" ", "\n", "　", "\xa0", "  ", "\x1c", "\r\n"]
    for i in range(150):
        longest = rng.choice([1, 5, 12, 60])
        words = ["\U0001f600éz"[i % 3] * rng.randint(1, longest) for _ in range(rng.randint(1, 900))]
        if i % 10 == 0:
            words.insert(rng.randint(0, len(words)), "q" * 1700)
        texts.append(rng.choice(separators).join(words))
    return texts


def run(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, document string")
    return {r.i: r.c for r in df.select("i", column(F.col("document")).alias("c")).collect()}


def test_word_chunks_match_brute_force(spark):
    texts = sample_texts()
    got = run(spark, texts, C.word_chunks)
    for i, text in enumerate(texts):
        assert got[i] == pack(text), i


def test_first_chunk_is_one_shorter(spark):
    words = ["ab"] * 2000
    (chunks,) = run(spark, [" ".join(words)], C.word_chunks).values()
    assert len(chunks[0]) <= 1499 and all(len(c) <= 1500 for c in chunks)
    assert " ".join(chunks).split() == words


def test_null_document_has_no_chunks(spark):
    df = spark.createDataFrame([(None,)], "document string")
    assert C.chunk_words(df).count() == 0


def test_overlapping_chunks_match_brute_force(spark):
    texts = [t for t in sample_texts() if len(" ".join(t.split())) < 20_000]
    got = run(spark, texts, C.overlapping_chunks)
    for i, text in enumerate(texts):
        assert got[i] == pack_overlapping(text), i


def test_spans_are_where_the_chunks_are(spark, monkeypatch):
    monkeypatch.setattr(C, "SUM_BLOCK", 3)
    texts = [t for t in sample_texts() if len(" ".join(t.split())) < 20_000][:60]
    for spans, chunked, source in (
        (C.word_spans, C.word_chunks, lambda t: t if len(t) <= 1500 else " ".join(t.split())),
        (C.overlapping_spans, C.overlapping_chunks, lambda t: " ".join(t.split())),
    ):
        found, chunks = run(spark, texts, spans), run(spark, texts, chunked)
        for i, text in enumerate(texts):
            assert [s.text for s in found[i]] == chunks[i]
            assert all(source(text)[s.start : s.end] == s.text for s in found[i])


def test_short_chunks_leave_gaps(spark):
    # The middle chunk is a single word of ten characters.
    text = "a" * 1495 + " " + "b" * 10 + " " + "c" * 1495
    df = spark.createDataFrame([(1, text)], "doc_id int, document string")
    kept = C.drop_short_chunks(C.chunk_words(df)).orderBy("chunk").collect()
    assert [r.chunk for r in kept] == [0, 2]


def test_chunk_stats(spark):
    text = " ".join(f"word{i}" for i in range(600))
    df = spark.createDataFrame([("d", text), ("e", "one two")], "doc_id string, document string")
    rows = C.chunk_stats(df).orderBy("chunk_id").collect()
    expected = pack_overlapping(text)
    assert [r.chunk_id for r in rows] == [f"d__chunk_{i:03d}" for i in range(len(expected))] + ["e__chunk_000"]
    assert [r.char_count for r in rows[:-1]] == [len(c) for c in expected]
    assert [r.word_count for r in rows[:-1]] == [len(c.split()) for c in expected]
    assert {r.chunk_count for r in rows[:-1]} == {len(expected)}


def test_places_of_overlapping_chunks_cost_little(spark):
    """Telling where the chunks begin takes no second walk over the words."""
    df = spark.range(40, numPartitions=1).select(F.repeat(F.concat(F.lit("ab "), "id"), 20_000).alias("document"))

    def seconds(column):
        start = time.monotonic()
        df.select(column(F.col("document")).alias("c")).agg(F.sum(F.size("c"))).collect()
        return time.monotonic() - start

    plain = min(seconds(C.overlapping_chunks) for _ in range(3))
    assert min(seconds(C.overlapping_spans) for _ in range(2)) < 3 * plain
