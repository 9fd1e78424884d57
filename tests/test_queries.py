"""Every registered query against its SQL, on the smallest tables."""

import json
import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import spark_queries
from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.spark_queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    got = entry.queries()[name](spark, sf).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert difference(got, want) is None


def test_line_files_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab "), 300).alias("text"), F.lit("en").alias("lang"))
    docs.repartition(9).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(spark_queries, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        got = spark_queries.scan_jsonl(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)
    assert len(list((tmp_path / "lines").glob("part-*.json"))) == 9
    assert sorted((r.position, r.doc_id) for r in got) == [(i, i) for i in range(900)]


DISCOVER = """
import sys
from pyspark.sql import SparkSession
import __spark_entry__ as entry
at = sys.argv[1]
conf = {
    "spark.ui.enabled": "false", "spark.checkpoint.dir": f"{at}/shared", "spark.sql.warehouse.dir": f"{at}/warehouse",
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{at}/events",
    "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false",
}
spark = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
assert {r["files"] for r in entry.queries()["discover_files"](spark, at).collect()} == {2, 3}
spark.stop()
"""


def test_a_task_reads_few_bytes_for_its_line_file(spark, tmp_path):
    draw = random.Random(3)
    words = ["".join(draw.choices("aeinorst", k=draw.randint(2, 9))) for _ in range(5000)]
    texts = [" ".join(draw.choices(words, k=400)) for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(10).write.parquet(f"{tmp_path}/benchmark.parquet")
    (tmp_path / "events").mkdir()
    repo = Path(__file__).parent.parent
    subprocess.run([sys.executable, "-c", DISCOVER, str(tmp_path)], check=True, cwd=repo, timeout=300)
    (log,) = (tmp_path / "events").iterdir()
    read, written = Counter(), Counter()
    for event in map(json.loads, log.open()):
        if event["Event"] == "SparkListenerTaskEnd":
            task, seen = event["Task Info"]["Task ID"], event["Task Metrics"]
            dealt = seen["Shuffle Read Metrics"]
            read[task] = seen["Input Metrics"]["Bytes Read"] + dealt["Remote Bytes Read"] + dealt["Local Bytes Read"]
            written[task] = seen["Output Metrics"]["Bytes Written"]
    size = sum(len(text) for text in texts)
    writers = [task for task in read if size * 0.3 < written[task] < size * 0.4]
    assert len(writers) == 3
    assert all(0 < read[task] < 0.5 * written[task] for task in writers), [read[task] / written[task] for task in writers]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 400])
def test_rows_are_dealt_evenly_whatever_their_keys(spark, tmp_path, n):
    rows = [(None if i % 5 == 0 else 7, None if i % 3 == 1 else f"é\n{i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    docs.write.parquet(f"{tmp_path}/table")
    spark_queries.write_json_files(spark.read.parquet(f"{tmp_path}/table"), f"{tmp_path}/out", 3)
    lines = [p.read_text().splitlines() for p in (tmp_path / "out").glob("part-*.json")]
    assert sorted(len(x) for x in lines if x) == sorted(k for k in (n // 3, (n + 1) // 3, (n + 2) // 3) if k)
    got = [json.loads(line) for file in lines for line in file]
    assert Counter((r.get("doc_id"), r.get("text")) for r in got) == Counter(rows)


def test_a_split_is_built_from_its_own_documents(spark, sf, monkeypatch):
    seen, build_index = [], spark_queries.build.build_index

    def built(spark, part, *args, **kw):
        seen.append({r[0] for r in part.select(F.input_file_name()).distinct().collect()})
        return build_index(spark, part, *args, **kw)

    reads, cut = [], spark_queries.build.documents_to_chunks
    monkeypatch.setattr(spark_queries.build, "documents_to_chunks", lambda df: reads.append(df) or cut(df))
    monkeypatch.setattr(spark_queries.build, "build_index", built)
    paths = spark_queries.split_indexes(spark, sf)
    assert [p.rsplit("/", 1)[1] for p in paths] == ["split0", "split1", "absent", "split2", "split3", "split4"]
    assert len(seen) == len(reads) == 5 and all(seen)
    assert sum(len(files) for files in seen) == len(set().union(*seen))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["query_id", "rank", "score"]
    assert df.count() == 120
