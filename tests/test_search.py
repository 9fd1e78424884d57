import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusvec.operators import search as S

DIM = 6


def frame(spark, key, vectors, ids=None, extra=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, f"{key} long, vector array<float>")


def brute(vectors, queries, k, ids=None):
    ids = np.arange(len(vectors)) if ids is None else np.asarray(ids)
    out = set()
    for q, query in enumerate(queries):
        scores = [
            round(float(sum(float(np.float32(a)) * float(np.float32(b)) for a, b in zip(v, query))), 9)
            for v in vectors
        ]
        order = sorted(range(len(vectors)), key=lambda i: (-scores[i], ids[i]))[:k]
        out |= {(q, int(ids[i]), rank + 1) for rank, i in enumerate(order)}
    return out


def ranked(df):
    return {(r.query_id, r.vec_id, r["rank"]) for r in df.collect()}


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, DIM)).astype(np.float32)
    # A third of the vectors are copies of one, so ties fill whole results.
    vectors[::3] = vectors[0]
    vectors[1] = 0
    queries = rng.normal(size=(17, DIM)).astype(np.float32)
    queries[0] = vectors[0]
    return vectors, queries


@pytest.mark.parametrize("k", [1, 5, 120, 1000])
def test_batch_and_block_match_brute_force(spark, data, k):
    vectors, queries = data
    index, qs = frame(spark, "vec_id", vectors), frame(spark, "query_id", queries)
    expected = brute(vectors, queries, k)
    assert ranked(S.topk_batch(index.repartition(7), qs, k)) == expected
    assert ranked(S.topk_block(index, qs, k, block_bytes=8 * DIM * 40)) == expected


def test_results_do_not_depend_on_partitions_or_batches(spark, data):
    vectors, queries = data
    index, qs = frame(spark, "vec_id", vectors), frame(spark, "query_id", queries)
    expected = brute(vectors, queries, 9)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for partitions, batch in ((1, 10_000), (3, 7), (20, 1)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            assert ranked(S.topk_batch(index.repartition(partitions), qs, 9)) == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_a_query_set_past_the_bound_is_blocked(spark, data):
    vectors, queries = data
    index, qs = frame(spark, "vec_id", vectors), frame(spark, "query_id", queries)
    few = 8 * DIM * 3
    assert len(list(S._query_blocks(qs, few))) > 3
    assert ranked(S.topk_batch(index, qs, 4, block_bytes=few)) == brute(vectors, queries, 4)
    both = index.withColumn("index_id", (F.col("vec_id") % 2).cast("string"))
    whole = S.topk_per_index(both, qs, 4).collect()
    blocked = S.topk_per_index(both, qs, 4, block_bytes=few).collect()
    assert set(map(tuple, whole)) == set(map(tuple, blocked))


def test_blocks_of_queries_share_one_scan(spark, data, tmp_path):
    vectors, queries = data
    path = str(tmp_path / "index")
    frame(spark, "vec_id", vectors).write.parquet(path)
    index, qs = spark.read.parquet(path), frame(spark, "query_id", queries)
    found = S.topk_batch(index, qs, 4, block_bytes=8 * DIM * 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan
    assert ranked(found) == brute(vectors, queries, 4)


def test_vectors_are_not_shuffled(spark, data):
    vectors, queries = data
    index, qs = frame(spark, "vec_id", vectors), frame(spark, "query_id", queries)
    plan = S.topk_batch(index, qs, 4)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Cogroup" not in plan
    assert not any("Exchange" in line and "vector" in line for line in plan.splitlines())


def test_small_score_cells(spark, data, monkeypatch):
    vectors, queries = data
    monkeypatch.setattr(S, "_SCORE_CELLS", 40)
    best = S._TopK(5, len(queries))
    best.add(np.arange(len(vectors)), vectors.astype(float), queries.astype(float))
    got = {(int(q), int(i)) for q, i in zip(best.query, best.ids)}
    assert got == {(q, i) for q, i, _ in brute(vectors, queries, 5)}


def test_single_and_ties(spark, data):
    vectors, _ = data
    got = S.topk_single(frame(spark, "vec_id", vectors).repartition(5), vectors[0].tolist(), 7).collect()
    assert {(0, r.vec_id, r["rank"]) for r in got} == brute(vectors, vectors[:1], 7)
    top = [r.vec_id for r in sorted(got, key=lambda r: r["rank"])]
    assert top == sorted(top)


def test_per_index_and_filtered(spark, data):
    vectors, queries = data
    index = frame(spark, "vec_id", vectors).withColumn(
        "index_id", F.when(F.col("vec_id") < 200, "big").otherwise("small")
    )
    qs = frame(spark, "query_id", queries)
    rows = S.topk_per_index(index.repartition(4), qs, 3).collect()
    for name, part in (("big", range(200)), ("small", range(200, 300))):
        got = {(r.query_id, r.vec_id, r["rank"]) for r in rows if r.index_id == name}
        assert got == brute(vectors[list(part)], queries, 3, list(part))
    even = [i for i in range(300) if i % 2 == 0]
    got = ranked(S.topk_filtered(index, qs, 3, F.col("vec_id") % 2 == 0))
    assert got == brute(vectors[even], queries, 3, even)


def test_many_indexes_in_one_task(spark, data):
    vectors, queries = data
    index = frame(spark, "vec_id", vectors).withColumn("index_id", (F.col("vec_id") % 150).cast("string"))
    rows = S.topk_per_index(index.coalesce(1), frame(spark, "query_id", queries), 5).collect()
    assert len(rows) == 300 * len(queries)


def test_given_pairs(spark, data):
    vectors, queries = data
    index, qs = frame(spark, "vec_id", vectors), frame(spark, "query_id", queries)
    pairs = spark.createDataFrame([(0, 3), (0, 3), (5, 7), (99, 1), (1, 999)], "query_id long, vec_id long")
    got = sorted(map(tuple, S.score_pairs(pairs, qs, index).collect()))
    scores = {(q, v): score for q, v, score in got}
    assert len(got) == 5 and scores[99, 1] is None and scores[1, 999] is None
    assert scores[5, 7] == pytest.approx(float(queries[5].astype(float) @ vectors[7].astype(float)), abs=1e-8)


def test_empty_sides(spark, data):
    vectors, queries = data
    index, qs = frame(spark, "vec_id", vectors), frame(spark, "query_id", queries)
    assert S.topk_batch(index, qs.limit(0), 3).count() == 0
    assert S.topk_batch(index.limit(0), qs, 3).count() == 0
    assert S.topk_block(index.limit(0), qs, 3).count() == 0


def test_string_query_ids(spark, data):
    vectors, queries = data
    qs = frame(spark, "query_id", queries).withColumn("query_id", F.concat(F.lit("q"), "query_id"))
    rows = S.topk_batch(frame(spark, "vec_id", vectors), qs, 2).collect()
    assert {(int(r.query_id[1:]), r.vec_id, r["rank"]) for r in rows} == brute(vectors, queries, 2)


@pytest.mark.parametrize("k", [1, 5])
@pytest.mark.parametrize(
    "bad, message",
    [(None, "NULL"), ([1.0, None], "NULL"), ([float("nan"), 1.0], "finite"),
     ([1.0, float("inf")], "finite"), ([1.0], "dimension"), ([1.0] * 3, "dimension")],
)
def test_what_has_no_rank_is_an_error(spark, bad, message, k):
    rows = [(i, [1.0, 0.5]) for i in range(3)] + [(9, bad)]
    good = spark.createDataFrame(rows[:3], "vec_id long, vector array<float>")
    mixed = spark.createDataFrame(rows, "vec_id long, vector array<float>").coalesce(1)
    with pytest.raises(Exception, match=message):
        S.topk_single(mixed, [1.0, 1.0], k).collect()
    with pytest.raises(Exception, match=message):
        S.topk_batch(good, mixed.withColumnRenamed("vec_id", "query_id"), k).collect()


def test_queries_of_another_dimension_are_an_error(spark):
    index = spark.createDataFrame([(0, [1.0, 0.0])], "vec_id long, vector array<float>")
    with pytest.raises(Exception, match="dimension"):
        S.topk_single(index, [1.0], 1).collect()


def test_lookup_keeps_hits_without_an_entry(spark):
    index = spark.createDataFrame([(1, "a")], "vec_id long, text string")
    hits = spark.createDataFrame([(0, 1), (0, 2)], "query_id long, vec_id long")
    for bound in (None, 5):
        got = S.result_lookup(hits, index, max_hits=bound).collect()
        assert {r.vec_id: r.text for r in got} == {1: "a", 2: None}


def test_lookup_prunes_shards(spark, tmp_path):
    from corpusvec.sinks.artifacts import write_vector_shards

    index = spark.range(1000).select(
        F.col("id").alias("vec_id"),
        F.array(F.lit(1.0).cast("float")).alias("vector"),
        F.concat(F.lit("text\n"), "id").alias("text"),
    )
    path = str(tmp_path / "shards")
    write_vector_shards(index, path)
    hits = spark.createDataFrame([(1, 5, 0.5)], "query_id long, vec_id long, score double")
    found = S.result_lookup(hits, spark.read.parquet(path), max_hits=1, shard_size=200_000)
    assert [r.text for r in found.collect()] == ["text\n5"]
    assert "dynamicpruning" in found._jdf.queryExecution().toString()


def test_bands(spark):
    hits = spark.createDataFrame([(x,) for x in (1.0, 0.9, 0.89999, 0.8, 0.7, 0.69, -1.0)], "score double")
    assert {r.band: r.hits for r in S.score_bands(hits).collect()} == {
        "near-identical": 2, "strongly related": 2, "topically related": 1, "weak": 2,
    }
