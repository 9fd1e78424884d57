import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from corpusvec.sources import files


@pytest.fixture()
def corpus(tmp_path):
    """Three line files with bad and blank lines, two tables, and bystanders."""
    lines = {}
    for name, n in (("b.jsonl", 400), ("a.jsonl", 3), ("d.jsonl", 0)):
        content = []
        for i in range(n):
            record = json.dumps({"name": f"{name}-{i}", "pad": "é" * (i % 50)}, ensure_ascii=False)
            content.append({7: "{broken", 8: ""}.get(i, record))
        lines[name] = content
        (tmp_path / name).write_text("".join(line + "\n" for line in content), encoding="utf-8")
    (tmp_path / "notes.txt").write_text("not a corpus file")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "deep.jsonl").write_text('{"name": "deep"}\n')
    return tmp_path, lines


@pytest.fixture()
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    spark.conf.set(key, old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_discovery(spark, corpus):
    path, _ = corpus
    found = files.discover_files(spark, str(path)).orderBy("file_index").collect()
    assert [(r.source, r.file_index) for r in found] == [("a.jsonl", 0), ("b.jsonl", 1), ("d.jsonl", 2)]


def test_line_numbers_across_splits(spark, corpus, small_splits):
    path, lines = corpus
    df = files.scan_jsonl(spark, str(path))
    got = {(r.source, r.file_index, r.row): r.value for r in df.collect()}
    expected = {
        (name, i, row): line
        for i, name in enumerate(sorted(lines))
        for row, line in enumerate(lines[name])
    }
    assert got == expected
    bad = df.filter(F.col("v").isNull()).select("source", "row").collect()
    assert {tuple(r) for r in bad} == {("b.jsonl", 7), ("b.jsonl", 8)}


def test_split_count_was_real(spark, corpus, small_splits):
    path, _ = corpus
    assert spark.read.option("pathGlobFilter", "*.jsonl").text(str(path)).rdd.getNumPartitions() > 5


def test_changed_splits_fail_loudly(spark):
    lines = spark.createDataFrame([("x", "f", 0, 5)], "value string, source string, _split long, _position long")
    moved = lines.withColumn("_split", F.lit(None).cast("long"))
    with pytest.raises(Exception, match="splits changed"):
        files.with_line_numbers(moved).collect()


def test_mixed_directory(spark, corpus):
    path, lines = corpus
    rows = [(f"row {i}", [f"t{i}"], None) for i in range(5)]
    spark.createDataFrame(rows, "name string, tags array<string>, gone string").coalesce(1).write.parquet(
        str(path / "tmp")
    )
    (part,) = (path / "tmp").glob("part-*.parquet")
    (path / "c.parquet").write_bytes(part.read_bytes())
    got = files.scan_directory(spark, str(path)).collect()
    assert len(got) == 403 + 5
    table = {r.row: r for r in got if r.source == "c.parquet"}
    assert {r.file_index for r in table.values()} == {2}
    assert json.loads(table[3].v.toJson())["tags"] == ["t3"]


def test_empty_directory(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.scan_directory(spark, str(tmp_path))


def test_row_counts_and_ranges(spark, corpus, tmp_path):
    path, _ = corpus
    counts = files.count_rows_per_file(spark.read.option("pathGlobFilter", "*.jsonl").text(str(path)))
    assert {r.source: r.rows for r in counts.collect()} == {"a.jsonl": 3, "b.jsonl": 400}
    numbered = files.scan_jsonl(spark, str(path))
    assert files.split_by_file_range(numbered, 0, 1).count() == 3


def test_parquet_row_numbers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).coalesce(1).write.option("parquet.block.size", 1024).parquet(path)
    rows = files.with_row_numbers(spark.read.parquet(path)).collect()
    assert all(r.id == r.row for r in rows) and len(rows) == 1000


def test_shards_and_texts(spark, tmp_path):
    for shard, n in (("AA", 2), ("AC", 3)):
        (tmp_path / shard).mkdir()
        for part in range(n):
            (tmp_path / shard / f"wiki_{part:02d}").write_text("x\ny\n")
        (tmp_path / shard / "other").write_text("z\n")
    lines = files.concat_shards(spark, str(tmp_path), ["AA", "AB", "AC"])
    assert {r.shard: r.lines for r in files.shard_line_counts(lines).collect()} == {
        "AA": 4, "AC": 6, None: 10,
    }
    (tmp_path / "one.txt").write_text("first\n\nsecond")
    (tmp_path / "two.md").write_text("no")
    assert [tuple(r) for r in files.scan_text_dir(spark, str(tmp_path)).collect()] == [
        ("one.txt", "first\n\nsecond")
    ]


def test_texts_are_read_without_a_listing_in_the_driver(spark, tmp_path, monkeypatch):
    folder = tmp_path / "a dü%41"
    (folder / "sub").mkdir(parents=True)
    (folder / "sub" / "deep.txt").write_text("deep")
    (folder / "folder.txt").mkdir()
    odd = ["50% a.txt", "ü\u3000\u200b.txt", "a+b#c&d=e.txt", "[z]{y}~.txt", "_kept=1.txt"]
    for name in [*odd, "_hidden.txt", ".hidden.txt", "upper.TXT", *(f"n{i}.txt" for i in range(40))]:
        (folder / name).write_bytes(b"\xef\xbb\xbf" + name.encode() + b"\xff\r\n")
    (folder / "empty.txt").write_text("")
    (folder / "link.txt").symlink_to(folder / "n1.txt")

    def by_spark(path):
        read = spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True)
        return read.select(F.col("_metadata.file_name").alias("doc_id"), F.hex("value").alias("text"))

    def rows(df):
        return sorted(map(tuple, df.select("doc_id", F.hex("text")).collect()))

    monkeypatch.setattr(files, "NAMES_HELD", 7)
    monkeypatch.setattr(files, "TEXT_BYTES_HELD", 100)
    path = str(folder)
    want = sorted(map(tuple, by_spark(path).collect()))
    assert len(want) == 46
    for form in (path, f"file:{path}", f"file://{path}", f"{path}/"):
        read = files.scan_text_dir(spark, form)
        assert rows(read) == want
        # Neither the listing nor the tasks have a place for every file.
        assert not [f for f in read.inputFiles() if f.endswith(".txt")]
        assert read.rdd.getNumPartitions() == 4
    # What Spark alone understands is read as before: patterns, files and partitions.
    assert rows(files.scan_text_dir(spark, f"{tmp_path}/a*")) == want
    assert rows(files.scan_text_dir(spark, f"{path}/n7.txt")) == [r for r in want if r[0] == "n7.txt"]
    (tmp_path / "parts" / "k=1").mkdir(parents=True)
    (tmp_path / "parts" / "k=1" / "p.txt").write_text("p")
    assert [r[0] for r in rows(files.scan_text_dir(spark, str(tmp_path / "parts")))] == ["p.txt"]
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.scan_text_dir(spark, str(tmp_path / "none"))


def test_a_directory_of_mixed_schemas(spark, tmp_path):
    answers = {"plain": ["one"], "nested": [{"body": "one"}]}
    spark.createDataFrame([("t1", "q1", ["x"])], "title string, question string, answers array<string>").coalesce(
        1
    ).write.parquet(str(tmp_path / "w1"))
    spark.createDataFrame(
        [("t2", "b2", [("y",)])], "Title string, body string, answers array<struct<body: string>>"
    ).coalesce(1).write.parquet(str(tmp_path / "w2"))
    root = tmp_path / "in"
    root.mkdir()
    for name in ("w1", "w2"):
        (part,) = (tmp_path / name).glob("part-*")
        (root / f"{name}.parquet").write_bytes(part.read_bytes())
    lines = ['{"title": "a", "title": "b", "text": "t"}', '{"title": "c", "text": "u", "score": NaN}', "{broken NaN"]
    (root / "z.jsonl").write_text("\n".join([*lines, json.dumps(answers)]) + "\n")
    rows = {(r.source, r.row): r.j for r in files.scan_directory(spark, str(root)).withColumn("j", F.to_json("v")).collect()}
    assert json.loads(rows["w1.parquet", 0]) == {"title": "t1", "question": "q1", "answers": ["x"]}
    assert json.loads(rows["w2.parquet", 0]) == {"Title": "t2", "body": "b2", "answers": [{"body": "y"}]}
    assert json.loads(rows["z.jsonl", 0])["title"] == "b" and json.loads(rows["z.jsonl", 1])["text"] == "u"
    assert rows["z.jsonl", 2] is None and json.loads(rows["z.jsonl", 3]) == answers


@pytest.mark.parametrize("max_bytes", [files.SMALL_FILE, 0])
def test_one_schema_is_asked_for_per_footer(spark, tmp_path, max_bytes):
    written = {
        "a": spark.range(90).selectExpr("id", "cast(id AS string) AS name"),
        "b": spark.range(30).selectExpr("cast(id AS int) AS id", "array(id) AS names"),
    }
    root = tmp_path / "in"
    root.mkdir()
    for kind, df in written.items():
        df.repartition(30).write.option("maxRecordsPerFile", 1).parquet(str(tmp_path / kind))
        for i, part in enumerate(sorted((tmp_path / kind).glob("part-*.parquet"))):
            (root / f"{kind}{i}.parquet").write_bytes(part.read_bytes())
    names = [p.name for p in root.iterdir()]
    assert len(names) == 120
    if max_bytes:
        footers = files.footer_hashes(spark, str(root), max_bytes).collect()
        assert sorted(r.source for r in footers) == sorted(names) and len({r.footer for r in footers}) == 2
    scans = files._scans_by_schema(spark, str(root), names, max_bytes)
    assert sorted(scan.columns for scan in scans) == [["id", "name"], ["id", "names"]]
    assert sorted(scan.count() for scan in scans) == [30, 90]
    rows = files.scan_directory(spark, str(root))
    assert rows.count() == 120 and rows.filter("source LIKE 'b%'").selectExpr(
        "variant_get(v, '$.names[0]', 'bigint') AS x"
    ).agg(F.sum("x")).first()[0] == sum(range(30))
