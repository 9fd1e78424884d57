import random

import pytest
from pyspark.sql import functions as F

from corpusvec.operators import ordinals as O


@pytest.fixture()
def ranges(spark, request):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("ranges", [1, 3, 40], indirect=True)
def test_ids_follow_file_row_chunk_order(spark, ranges):
    rng = random.Random(ranges)
    # One file holds most rows; rows and chunk numbers have gaps.
    keys = {(0, r, c) for r in range(0, 300, 2) for c in range(rng.randint(0, 4))}
    keys |= {(f, rng.randint(0, 10**12), rng.randint(0, 5)) for f in range(1, 9) for _ in range(6)}
    rows = list(keys)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "file_index int, row long, chunk int").repartition(6)
    got = O.assign_vec_ids(df).collect()
    assert {(r.vec_id, r.file_index, r.row, r.chunk) for r in got} == {
        (i, *key) for i, key in enumerate(sorted(rows))
    }


def test_rows_without_a_number_come_first_and_are_spread(spark):
    rows = [(f, None, 0, f"text {i}") for i in range(2000) for f in (0, None)] + [(0, 7, c, "known") for c in (0, 1)]
    df = spark.createDataFrame(rows, "file_index int, row long, chunk int, text string").repartition(6)
    numbered = O.assign_vec_ids(df)
    got = sorted(numbered.collect(), key=lambda r: r.vec_id)
    assert [r.vec_id for r in got] == list(range(len(rows)))
    assert [(r.file_index, r.row) for r in got] == [(None, None)] * 2000 + [(0, None)] * 2000 + [(0, 7)] * 2
    assert sorted(map(repr, (tuple(r)[1:] for r in got))) == sorted(map(repr, rows))
    # The same ids whenever they are computed.
    again = {(r.file_index, r.text): r.vec_id for r in numbered.collect() if r.row is None}
    assert again == {(r.file_index, r.text): r.vec_id for r in got if r.row is None}
    sizes = O.row_sizes(df).collect()
    assert max(r._n for r in sizes) == 2


def test_long_rows_and_large_files_are_even(spark):
    # One file of a few very long rows, one of very many short ones.
    rows = [(0, r, c) for r in range(40) for c in range(100)] + [(1, r, 0) for r in range(4000)]
    df = spark.createDataFrame(rows, "file_index int, row long, chunk int")
    placed = O._placed(df, O.KEYS)
    dealt = O.spread(placed, *O._places(O.KEYS)).groupBy(F.spark_partition_id()).count().collect()
    counts = sorted(r["count"] for r in dealt)
    assert counts[-1] < 2 * counts[len(counts) // 2]
    assert O.assign_vec_ids(df).agg(F.sum("vec_id")).first()[0] == sum(range(len(rows)))


def test_other_keys(spark):
    rows = [(name, c) for name in ("b.txt", "a.txt", "c") for c in (2, 0)]
    got = O.assign_vec_ids(spark.createDataFrame(rows, "doc_id string, n int"), ("doc_id", "n")).collect()
    assert {(r.vec_id, r.doc_id, r.n) for r in got} == {(i, *k) for i, k in enumerate(sorted(rows))}


def test_no_rows(spark):
    df = spark.createDataFrame([], "file_index int, row long, chunk int")
    assert O.assign_vec_ids(df).count() == 0


def test_runs_stay_together(spark):
    df = spark.range(1000).withColumnRenamed("id", "vec_id").repartition(5)
    placed = O.cluster_by_runs(df, shard_size=250, run_size=100).withColumn("p", F.spark_partition_id())
    homes = {}
    for r in placed.collect():
        homes.setdefault((r.vec_id // 250, r.vec_id % 250 // 100), set()).add(r.p)
    assert all(len(p) == 1 for p in homes.values())


def test_sample(spark):
    df = spark.range(100).withColumnRenamed("id", "vec_id").repartition(5)
    assert [r.vec_id for r in O.sample_limit(df, 7).collect()] == list(range(7))
