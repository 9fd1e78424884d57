import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusvec.functions import vectors as V
from corpusvec.operators import embed as E


def hashed(text, dim):
    sums = np.zeros(dim)
    for word in text.lower().split():
        digest = hashlib.md5(word.encode()).hexdigest()
        sums[int(digest[:6], 16) % dim] += 1 - 2 * (int(digest[6], 16) % 2)
    norm = np.sqrt((sums**2).sum())
    return (sums / norm if norm else sums).astype(np.float32)


TEXTS = ["Hello world hello", "", "  ", "Été\nété　ÉTÉ", "a b c d e f g " * 50, "one"]


def test_hashing_embedder_and_its_expression(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)) + [(99, None)], "i int, text string").repartition(3)
    for dim in (8, 64):
        embedder = E.HashingEmbedder(dim)
        out = embedder.embed(df, "text", "vector").withColumn(
            "same", V.to_float32(embedder.expression(F.coalesce("text", F.lit(""))))
        )
        for r in out.collect():
            expected = hashed(r.text or "", dim)
            assert np.array_equal(np.array(r.vector, dtype=np.float32), expected), r.text
            assert np.array_equal(np.array(r.same, dtype=np.float32), expected), r.text


def test_batch_embedder_loads_once_per_task_and_checks_the_dimension(spark):
    def load():
        calls = {"n": 0}

        def encode(texts):
            calls["n"] += 1
            assert len(texts) <= 4
            return [[len(t), calls["n"]] for t in texts]

        return encode

    df = spark.createDataFrame([(i, "x" * i) for i in range(10)], "i int, text string").coalesce(1)
    out = E.BatchEmbedder(load, 2, batch=4, normalize=False).embed(df, "text", "v").collect()
    assert [r.v for r in out] == [[i, 1 + i // 4] for i in range(10)]
    with pytest.raises(Exception, match="dimensions"):
        E.BatchEmbedder(load, 3, batch=4).embed(df, "text", "v").collect()


def test_embed_chunks_prefixes_only_for_the_encoder(spark):
    df = spark.createDataFrame([("some text",)], "text string")
    (row,) = E.embed_chunks(df, E.HashingEmbedder(16)).collect()
    assert row.text == "some text"
    assert np.array_equal(np.float32(row.vector), hashed("passage: some text", 16))
    (row,) = E.embed_chunks(df, E.HashingEmbedder(16), kind="query").collect()
    assert np.array_equal(np.float32(row.vector), hashed("query: some text", 16))


def test_vector_arithmetic(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 0.0], [0.0, 0.0])], "a array<float>, b array<float>, z array<float>")
    a, b, z = F.col("a"), F.col("b"), F.col("z")
    row = df.select(
        V.inner_product(a, b).alias("ip"), V.cosine(a, b).alias("cos"), V.cosine(a, z).alias("zero"),
        V.l2_normalize(a).alias("unit"), V.l2_normalize(z).alias("still_zero"), V.l2_norm(a).alias("n"),
    ).first()
    assert (row.ip, row.cos, row.zero, row.n) == (3.0, 0.6, 0.0, 5.0)
    assert row.unit == [0.6, 0.8] and row.still_zero == [0.0, 0.0]


@pytest.mark.parametrize(
    "vectors, valid",
    [
        ([[1.0, 0.0], [0.6, 0.8]], True),
        ([[1.0, 0.0], [0.5, 0.5]], False),
        ([[1.0, 0.0], [1.0]], False),
        ([[1.0, 0.0], None], False),
        ([[1.0, None]], False),
        ([[1.0, 0.0], [float("nan"), 0.0]], False),
        ([[1.0, 0.0], [0.3, 0.0]], False),
        ([[1.0, 0.0], [0.0, 0.0]], True),
        ([], False),
    ],
)
def test_validation(spark, vectors, valid):
    df = spark.createDataFrame([(v,) for v in vectors], "vector array<float>")
    assert E.validate_vectors(df, 2).first().valid is valid
