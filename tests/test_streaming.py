import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as ST

from corpusvec.operators.embed import HashingEmbedder
from corpusvec.streaming import incremental as I

EMBEDDER = HashingEmbedder(8)


def add_lines(folder, name, n):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"title": f"{name}-{i}", "text": f"words of {name} number {i} " * 90}) for i in range(n)]
    (folder / f"{name}.jsonl").write_text("\n".join([*lines, "{broken"]) + "\n")


def run(spark, source, path, **kw):
    I.incremental_index(
        spark, str(source), str(path), f"{path}/checkpoint", "article", EMBEDDER, **kw
    ).awaitTermination()


def keys(df):
    return sorted((r.source, r.row, r.chunk) for r in df.collect())


def test_only_new_files_are_added(spark, tmp_path):
    source, path = tmp_path / "in", tmp_path / "out"
    add_lines(source, "a", 3)
    run(spark, source, path)
    first = keys(I.increments(spark, str(path)))
    assert {k[0] for k in first} == {"a.jsonl"} and {k[1] for k in first} == {0, 1, 2}
    # Nothing new: nothing is added.
    run(spark, source, path)
    assert keys(I.increments(spark, str(path))) == first
    add_lines(source, "b", 2)
    add_lines(source, "c", 1)
    run(spark, source, path, max_files_per_batch=1)
    everything = keys(I.increments(spark, str(path)))
    assert set(first) < set(everything) and len(everything) == len(set(everything))
    log = I.progress_log(spark, str(path), shard_size=4).orderBy("batch_id").collect()
    assert [r.rows_processed for r in log] == [4, 7, 9]
    assert [r.rejected for r in log] == [1, 1, 1]
    assert log[-1].vectors_count == len(everything)
    assert (log[-1].shard_index, log[-1].shard_vectors) == divmod(len(everything), 4)

    bad = {(r.source, r.row): (r.reason, r.value) for r in I.rejects(spark, str(path)).collect()}
    assert bad == {(f"{n}.jsonl", i): ("malformed JSON", "{broken") for n, i in (("a", 3), ("b", 2), ("c", 1))}

    index = I.publish_increments(spark, str(path), "d", "m", 8)
    rows = index.entries.orderBy("vec_id").collect()
    assert [r.vec_id for r in rows] == list(range(len(everything)))
    assert index.summary.first().resume_mode


def test_a_replayed_batch_leaves_its_rows_once(spark, tmp_path):
    path = str(tmp_path / "out")
    lines = [json.dumps({"title": f"t{i}", "text": "enough words for a chunk here"}) for i in range(6)]
    batch = spark.createDataFrame([(x,) for x in lines], "value string").select(
        "value", F.lit("f.jsonl").alias("source"), F.lit(0).alias("_split")
    )
    write = I._batch_writer(path, "article", EMBEDDER, I._line_records)
    write(batch, 0)
    once = keys(I.increments(spark, path))
    write(batch, 0)
    assert keys(I.increments(spark, path)) == once and len(once) == 6
    assert I.progress_log(spark, path).count() == 1


def test_an_uncommitted_batch_is_not_read(spark, tmp_path):
    path = str(tmp_path / "out")
    assert I.progress_log(spark, path).count() == 0
    batch = spark.createDataFrame([('{"title": "t", "text": "enough words for a chunk"}',)], "value string").select(
        "value", F.lit("f.jsonl").alias("source"), F.lit(0).alias("_split")
    )
    I._batch_writer(path, "article", EMBEDDER, I._line_records)(batch, 0)
    half = spark.read.parquet(f"{path}/increments/batch_id=0")
    half.write.parquet(f"{path}/increments/batch_id=1")
    assert I.increments(spark, path).count() == 1


def test_parquet_stream(spark, tmp_path):
    source, path = tmp_path / "in", tmp_path / "out"
    schema = ST.StructType([ST.StructField("title", ST.StringType()), ST.StructField("text", ST.StringType())])
    rows = [(f"t{i}", f"words of number {i} " * 120) for i in range(5)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(source))
    run(spark, source, path, file_format="parquet", schema=schema)
    assert {r.row for r in I.increments(spark, str(path)).collect()} == set(range(5))


def test_a_second_publish_only_adds(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "out")
    add_lines(source, "b", 3)
    run(spark, source, path)
    first = I.publish_increments(spark, path, "d", "m", 8, shard_size=4)
    before = {r.vec_id: tuple(r) for r in first.entries.drop("shard_id").collect()}
    assert I.publish_increments(spark, path, "d", "m", 8).run == first.run
    add_lines(source, "a", 2)
    run(spark, source, path)
    second = I.publish_increments(spark, path, "d", "m", 8, shard_size=4)
    rows = {r.vec_id: tuple(r) for r in second.entries.drop("shard_id").collect()}
    assert sorted(rows) == list(range(len(rows))) and len(rows) > len(before)
    assert {i: rows[i] for i in before} == before
    added = spark.read.parquet(f"{path}/runs/{second.run}/entries")
    assert added.count() == len(rows) - len(before) and added.select("source").distinct().collect() == [("a.jsonl",)]
    assert added.agg(F.min("file_index")).first()[0] == 1
    assert second.summary.first().total_vectors == len(rows)


def test_old_files_are_read(spark, tmp_path):
    source, path = tmp_path / "in", tmp_path / "out"
    add_lines(source, "new", 1)
    run(spark, source, path)
    add_lines(source, "old", 1)
    month_ago = (source / "new.jsonl").stat().st_mtime - 30 * 86_400
    os.utime(source / "old.jsonl", (month_ago, month_ago))
    run(spark, source, path)
    assert {k[0] for k in keys(I.increments(spark, str(path)))} == {"new.jsonl", "old.jsonl"}
