import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from corpusvec import session


def fake(master, root):
    settings = {session.CHECKPOINT_CONF: root, session.WAREHOUSE_CONF: "hdfs://warehouse/"}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: settings[key]),
        sparkContext=SimpleNamespace(master=master),
    )


def test_the_shared_folder_comes_from_the_session():
    assert session.shared_root(fake("spark://x", "hdfs://shared/")) == "hdfs://shared"


def test_only_a_local_session_may_go_without():
    assert session.shared_root(fake("local[2]", None)) == "hdfs://warehouse"
    with pytest.raises(RuntimeError):
        session.shared_root(fake("yarn", None))
    with pytest.raises(RuntimeError):
        session.shared_root(fake("local-cluster[2,1,1024]", None))


def test_scratch_paths_are_fresh(spark):
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")


def test_small_tables_are_settled_and_hinted(spark):
    settled = session.settle(spark.range(10).filter("id > 3"), "few")
    assert sorted(r.id for r in settled.collect()) == list(range(4, 10))
    hinted = session.broadcast_if_small(settled, 6)._jdf.queryExecution().logical().toString()
    plain = session.broadcast_if_small(settled, 5)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted.lower() and "broadcast" not in plain.lower()


def test_wide_tables_are_not_hinted(spark):
    wide = spark.range(100).selectExpr("id", "repeat('x', 1000) AS text", "array(id, id) AS list")
    assert "broadcast" in str(session.broadcast_if_small(wide, max_bytes=200_000)._jdf.queryExecution().logical()).lower()
    assert "broadcast" not in str(session.broadcast_if_small(wide, max_bytes=90_000)._jdf.queryExecution().logical()).lower()


def test_settling_nothing(spark):
    assert session.settle(spark.range(0), "none").count() == 0


def test_scratch_tables_go_with_the_session(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
from corpusvec import session
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config(
    "spark.checkpoint.dir", "{tmp_path}").getOrCreate()
session.settle(spark.range(3), "few")
assert any(p.name.startswith("few-") for p in __import__("pathlib").Path("{tmp_path}").rglob("*"))
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).parent.parent, timeout=300)
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]
