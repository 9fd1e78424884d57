import json

import pytest
from pyspark.sql import functions as F

from corpusvec.functions import text as T
from corpusvec.operators import alignment, quality
from corpusvec.operators.chunk import chunked_text, overlapping_spans, word_spans
from corpusvec.operators.embed import HashingEmbedder
from corpusvec.plans import build, merge, query
from corpusvec.sinks import artifacts
from corpusvec.sinks.publish import publish_parts, publish_verified, write_pointer
from corpusvec.sources.index_store import (
    IndexNotFound,
    entries_with_ids,
    labelled,
    load_index,
    lookup,
    newest_run,
)

EMBEDDER = HashingEmbedder(16)


def documents(spark, files=4, rows=9, words=700):
    data = [
        (f"f{f}", f, r, f"title {f}/{r}", " ".join(f"w{f}x{r}y{i}" for i in range(1 + (r * words) % 1500)))
        for f in range(files)
        for r in range(rows)
    ]
    return spark.createDataFrame(
        data, "source string, file_index int, row long, title string, document string"
    ).repartition(5)


def make(spark, docs, path, **kw):
    return build.build_index(spark, docs, str(path), EMBEDDER, "test", "hashing", **kw)


def content(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_build_load_and_query(spark, tmp_path):
    docs = documents(spark)
    built = make(spark, docs, tmp_path / "i", shard_size=50)
    index = load_index(spark, str(tmp_path / "i"))
    assert index.run == built.run
    rows = index.entries.orderBy("vec_id").collect()
    assert [r.vec_id for r in rows] == list(range(len(rows)))
    assert [(r.file_index, r.row, r.chunk) for r in rows] == sorted((r.file_index, r.row, r.chunk) for r in rows)
    summary = index.summary.first()
    assert summary.total_vectors == len(rows) and summary.integrity_status == "VERIFIED"
    assert not summary.resume_mode and index.shard_size == 50
    shards = {r.shard_id: r["count"] for r in index.entries.groupBy("shard_id").count().collect()}
    assert [shards[i] for i in range(len(rows) // 50)] == [50] * (len(rows) // 50)
    aligned = alignment.align_triple(index.vectors, index.chunks, index.metadata)
    assert aligned.count() == len(rows)
    match = alignment.manifest_match(index.summary, index.vectors, index.chunks, index.metadata).first()
    assert match.chunks_match and match.manifest_matches and match.metadata_match

    # The hashing embedder finds a text by its own words.
    wanted = rows[3]
    qs = spark.createDataFrame([(7, wanted.text)], "query_id long, text string")
    hits = query.search_index(index, qs, EMBEDDER, k=2).collect()
    first = next(h for h in hits if h["rank"] == 1)
    assert (first.query_id, first.vec_id, first.source) == (7, wanted.vec_id, wanted.source)
    assert first.preview == wanted.text[:100]


def test_a_failing_gate_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "i")
    entries = build.documents_to_entries(documents(spark), EMBEDDER)
    one_too_many = entries.agg((F.count(F.lit(1)) + 1).alias("n"))
    with pytest.raises(alignment.IntegrityError):
        publish_verified(spark, entries, path, "d", "m", 16, expected_chunks=one_too_many)
    with pytest.raises(alignment.IntegrityError):
        publish_verified(spark, entries.withColumn("vector", F.expr("CASE WHEN vec_id > 3 THEN vector END")), path, "d", "m", 16)
    with pytest.raises(alignment.IntegrityError):
        publish_verified(spark, entries, path, "d", "m", 17)
    with pytest.raises(IndexNotFound):
        load_index(spark, path)


def test_readers_follow_the_newest_run(spark, tmp_path):
    first = make(spark, documents(spark, files=1), tmp_path)
    second = make(spark, documents(spark, files=2), tmp_path)
    assert first.run != second.run
    assert load_index(spark, str(tmp_path)).run == second.run
    assert first.entries.count() < second.entries.count()


def test_merging_splits_equals_building_at_once(spark, tmp_path):
    docs = documents(spark, files=6)
    whole = make(spark, docs, tmp_path / "whole")
    bounds = [(0, 1), (1, 4), (4, 6)]
    for i, (a, b) in enumerate(bounds):
        make(spark, docs.filter((F.col("file_index") >= a) & (F.col("file_index") < b)), tmp_path / f"s{i}")
    paths = [str(tmp_path / p) for p in ("s0", "s1", "missing", "s2")]
    merged = merge.merge_splits(spark, paths, str(tmp_path / "merged"), "test")
    columns = ("vec_id", "source", "file_index", "row", "chunk", "title", "text", "vector")
    assert content(merged.entries, *columns) == content(whole.entries, *columns)
    summary = merged.summary.first()
    assert summary.split_merge and summary.num_splits == 3
    assert {r.split_id for r in merged.entries.select("split_id").distinct().collect()} == {0, 1, 3}
    with pytest.raises(IndexNotFound):
        merge.merge_splits(spark, [str(tmp_path / "missing")], str(tmp_path / "m2"), "test")


def test_merging_ids_with_gaps(spark):
    parts = {
        2: spark.createDataFrame([(5, "c"), (9, "d")], "vec_id long, text string"),
        0: spark.createDataFrame([(0, "a"), (2, "b")], "vec_id long, text string"),
    }
    assert content(merge.merge_entries(parts), "vec_id", "text", "split_id") == [
        (0, "a", 0), (1, "b", 0), (2, "c", 2), (3, "d", 2),
    ]


def test_union_keeps_corpora_apart(spark):
    a = spark.createDataFrame([(0, "x")], "vec_id long, text string")
    b = spark.createDataFrame([(0, "y", "id")], "vec_id long, text string, arxiv_id string")
    rows = merge.union_corpora({"a": a, "b": b}).orderBy("index_id").collect()
    assert [(r.index_id, r.vec_id, r.arxiv_id) for r in rows] == [("a", 0, None), ("b", 0, "id")]
    totals = quality.corpus_totals(merge.union_corpora({"a": a, "b": b}), "index_id")
    assert {r.index_id: r.vectors for r in totals.collect()} == {"a": 1, "b": 1, None: 2}


def test_index_directory(spark, tmp_path):
    source = tmp_path / "src"
    source.mkdir()
    good = [{"title": f"t{i}", "text": f"some words about topic {i} " * (i + 1)} for i in range(40)]
    lines = [json.dumps(g) for g in good]
    lines[5] = "{broken"
    lines[6] = json.dumps({"title": None, "text": "x"})
    (source / "a.jsonl").write_text("\n".join(lines[:20]) + "\n")
    (source / "b.jsonl").write_text("\n".join(lines[20:]) + "\n")
    index, bad = build.index_directory(
        spark, str(source), str(tmp_path / "i"), "article", EMBEDDER, "d", "m"
    )
    assert content(bad, "source", "row", "reason") == [
        ("a.jsonl", 5, "malformed JSON"), ("a.jsonl", 6, "ill-typed title"),
    ]
    ids = {(r.source, r.row) for r in index.entries.collect()}
    assert len(ids) == 38 and ("b.jsonl", 19) in ids


def test_artifacts(spark, tmp_path):
    entries = build.documents_to_entries(documents(spark), EMBEDDER)
    artifacts.write_chunks(entries, str(tmp_path / "out" / "chunks"))
    artifacts.write_metadata(entries, str(tmp_path / "out" / "metadata"))
    expected = [r.text for r in entries.orderBy("vec_id").collect()]
    lines = [
        json.loads(line)["text"]
        for part in sorted((tmp_path / "out" / "chunks").glob("part-*"))
        for line in part.read_text().splitlines()
    ]
    assert lines == expected
    manifest = artifacts.artifact_manifest(spark, str(tmp_path / "out"))
    rows = [r for r in manifest.collect() if r.file.endswith(".json")]
    assert {r.artifact for r in rows} == {"chunks", "metadata"}
    import hashlib

    for r in rows:
        data = (tmp_path / "out" / r.file).read_bytes()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (r.bytes, r.sha256)


def test_large_files_are_digested_by_ranges(spark, tmp_path):
    import hashlib

    (tmp_path / "vectors").mkdir()
    sizes = {"small": 100, "even": 192, "odd": 200, "one": 101}
    for name, size in sizes.items():
        (tmp_path / "vectors" / name).write_bytes(bytes(i % 251 for i in range(size)))
    rows = artifacts.artifact_manifest(spark, str(tmp_path), whole_bytes=100, range_bytes=64).collect()
    got = {r.file: (r.artifact, r.bytes, r.sha256, r.ranges) for r in rows}
    for name, size in sizes.items():
        data = (tmp_path / "vectors" / name).read_bytes()
        parts = [hashlib.sha256(data[i : i + 64]).digest() for i in range(0, size, 64)]
        want = hashlib.sha256(data if name == "small" else b"".join(parts)).hexdigest()
        assert got[f"vectors/{name}"] == ("vectors", size, want, 1 if name == "small" else len(parts))


def test_alignment_audit_and_gate(spark):
    def ids(*values):
        return spark.createDataFrame([(v,) for v in values], "vec_id long")

    audit = alignment.alignment_audit(ids(0, 1, 2, 2), ids(0, 1, 3, 2), ids(0, 1, 2))
    assert content(audit, "vec_id", "in_vectors", "in_chunks", "in_metadata") == [(2, 2, 1, 1), (3, 0, 1, 0)]
    gate = alignment.integrity_gate(ids(0, 1), ids(0, 1), ids(0)).first()
    assert gate.status == "FAILED" and (gate.n_vectors, gate.n_metadata) == (2, 1)
    assert alignment.integrity_gate(ids(0), ids(5), ids(9)).first().status == "PASSED"


def test_chunk_quality_sees_cut_words(spark):
    text = " ".join(f"word{i}" for i in range(900))
    docs = spark.createDataFrame([("d", text), ("e", "kept  as it\nis, and long enough")], "doc_id string, document string")
    document = F.col("document")
    for spanned in (
        docs.select(chunked_text(document).alias("document"), word_spans(document).alias("spans")),
        docs.select(T.squeeze(document).alias("document"), overlapping_spans(document).alias("spans")),
    ):
        whole = quality.chunk_quality(spanned).first()
        assert whole.chunks > 4 and (whole.mid_word_breaks, whole.self_contained, whole.passed) == (0.0, 1.0, True)

    def rates(text, spans):
        rows = [(text, [(a, b, text[a:b]) for a, b in spans])]
        return quality.chunk_quality(
            spark.createDataFrame(rows, "document string, spans array<struct<start: int, end: int, text: string>>")
        ).first()

    cut = rates(text, [(i, i + 100) for i in (0, 101, 202)])
    assert cut.mid_word_breaks > 0.5 and not cut.passed
    # The words occur elsewhere with whitespace around them; here they are cut out of another.
    inner = "a longer wordinside of it, and a word inside too"
    assert rates(inner, [(9, 13)]).mid_word_breaks == 1.0 and rates(inner, [(33, 37)]).mid_word_breaks == 0.0
    gap = rates(inner, [(0, 19), (23, 48)])
    assert (gap.mid_word_breaks, gap.self_contained) == (0.0, 0.5)


def test_ingest_counts(spark):
    rows = [
        ("a", False, "x" * 30), ("a", False, "short"), ("a", False, None), ("a", True, None), ("a", False, "  "),
        ("b", False, "word " * 700),
    ]
    df = spark.createDataFrame(rows, "source string, malformed boolean, document string")
    got = {r.source: r for r in quality.ingest_counts(df).collect()}
    a, b = got["a"], got["b"]
    assert (a.rows, a.malformed, a.skipped_empty, a.chunks, a.dropped_short) == (5, 1, 1, 1, 2)
    assert (b.rows, b.chunks, b.dropped_short) == (1, 3, 0)


def test_estimates(spark):
    df = spark.createDataFrame(
        [("a", "x" * 10), ("a", "x" * 3100), ("a", None), ("b", "x" * 1500)], "source string, document string"
    )
    by_length = {r.source: (r.documents, r.estimated_chunks) for r in build.dry_run(df).collect()}
    assert by_length == {"a": (2, 3), "b": (1, 1)}
    by_rows = {r.source: (r.rows, r.estimated_chunks) for r in build.dry_run(df, "rows").collect()}
    assert by_rows == {"a": (3, 4), "b": (1, 1)}
    assert quality.estimate_total(build.dry_run(df), "documents").first().asDict() == {
        "documents": 3, "estimated_chunks": 4,
    }


@pytest.mark.parametrize(
    "bad", [[float("nan"), 0.0], [1.0, None], [0.3, 0.0], [1.0], None]
)
def test_vectors_of_the_wrong_form_are_not_published(spark, tmp_path, bad):
    rows = [(0, [1.0, 0.0], "a", "s"), (1, [0.0, 0.0], "b", "s"), (2, bad, "c", "s")]
    entries = spark.createDataFrame(rows, "vec_id long, vector array<float>, text string, source string")
    path = str(tmp_path / "index")
    with pytest.raises(alignment.IntegrityError):
        publish_verified(spark, entries, path, dataset="d", model="m", dimension=2)
    with pytest.raises(IndexNotFound):
        load_index(spark, path)
    assert publish_verified(
        spark, entries.filter("vec_id < 2"), path, dataset="d", model="m", dimension=2
    ).entries.count() == 2


def test_labels_reach_the_index(spark):
    records = {
        "article": '{"title": "a", "text": "t", "categories": ["x", "y"], "is_featured": true}',
        "qa": '{"title": "q", "question": "t", "Tags": ["python"]}',
        "paper": '{"id": "1", "title": "p", "abstract": "t", "category": "cs.LG"}',
    }
    for kind, labels in (("article", (["x", "y"], True)), ("qa", (["python"],)), ("paper", (["cs.LG"],))):
        rows = spark.createDataFrame([(records[kind], "s", 0, 0)], "j string, source string, file_index int, row long")
        got = build.assemble_records(rows.withColumn("v", F.parse_json("j")), kind).first().asDict()
        names = {"article": ("categories", "is_featured"), "qa": ("tags",), "paper": ("categories",)}[kind]
        assert tuple(got[n] for n in names) == labels and got["document"]


def test_merging_adds_a_pointer_and_a_manifest_only(spark, tmp_path):
    docs = documents(spark, files=4)
    for i in range(2):
        make(spark, docs.filter(F.col("file_index") % 2 == i), tmp_path / f"s{i}", shard_size=7)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*") if p.is_file()}
    merged = merge.merge_splits(spark, [str(tmp_path / f"s{i}") for i in range(2)], str(tmp_path / "m"), "test")
    added = [p for p in tmp_path.rglob("*") if p.is_file() and p not in before]
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    assert all(p.is_relative_to(tmp_path / "m") for p in added) and not [p for p in added if p.suffix == ".parquet"]
    assert {p.parent.name for p in added} == {"published", "summary"}
    sizes = [load_index(spark, str(tmp_path / f"s{i}")).entries.count() for i in range(2)]
    assert [(p.id_offset, p.split_id, p.entries) for p in merged.parts] == [(0, 0, sizes[0]), (sizes[0], 1, sizes[1])]
    # A merged index can be a split itself, and be searched like any other.
    twice = merge.merge_splits(spark, [str(tmp_path / "m"), str(tmp_path / "s0")], str(tmp_path / "mm"), "test")
    rows = twice.entries.orderBy("vec_id").collect()
    assert [r.vec_id for r in rows] == list(range(sum(sizes) + sizes[0])) and twice.dense
    assert [r.text for r in rows[sum(sizes) :]] == [r.text for r in rows[: sizes[0]]]
    wanted = rows[sizes[0] + 3]
    hits = spark.createDataFrame([(0, wanted.vec_id), (0, 10**9)], "query_id long, vec_id long")
    found = {r.vec_id: (r.text, r.split_id) for r in lookup(twice, hits).collect()}
    assert found == {wanted.vec_id: (wanted.text, 0), 10**9: (None, None)}


def test_splits_with_gaps_are_rewritten(spark, tmp_path):
    rows = [(i, [1.0, 0.0], f"t{i}", "s") for i in (0, 1, 5, 6)]
    schema = "vec_id long, vector array<float>, text string, source string"
    for name, kept in (("gaps", rows), ("dense", rows[:2])):
        index = publish_verified(spark, spark.createDataFrame(kept, schema), str(tmp_path / name), "d", "m", 2, shard_size=3)
        assert index.dense == (name == "dense")
    merged = merge.merge_splits(spark, [str(tmp_path / n) for n in ("gaps", "dense")], str(tmp_path / "m"), "d")
    assert content(merged.entries, "vec_id", "text", "split_id") == [
        (0, "t0", 0), (1, "t1", 0), (2, "t5", 0), (3, "t6", 0), (4, "t0", 1), (5, "t1", 1),
    ]


def test_text_is_read_from_files_with_hits_only(spark, tmp_path):
    rows = [(i, [1.0], f"t{i}", "s", [f"tag{i % 7}", "all"], i % 3 == 0) for i in range(400)]
    entries = spark.createDataFrame(
        rows, "vec_id long, vector array<float>, text string, source string, tags array<string>, is_featured boolean"
    )
    index = publish_verified(
        spark, entries, str(tmp_path / "i"), "d", "m", 1, shard_size=2, labels=["tags", "is_featured"]
    )
    files = index.files.collect()
    assert len(files) == 200 and sum(f.entries for f in files) == 400
    ids = [*range(0, 300, 10)]
    hits = spark.createDataFrame([(i, i) for i in ids], "query_id long, vec_id long")
    chosen = entries_with_ids(index, hits)
    assert len(chosen.inputFiles()) == 30 and chosen.count() == 60
    assert {r.vec_id: r.text for r in lookup(index, hits).collect()} == {i: f"t{i}" for i in ids}
    assert len(entries_with_ids(index, hits, max_files=29).inputFiles()) == 200
    assert {r.vec_id: r.text for r in lookup(index, hits, max_files=3).collect()} == {i: f"t{i}" for i in ids}
    # Labels: only files that have a row with all of them are read.
    both = labelled(index, all_of=[("tags", "tag3"), ("is_featured", "true")])
    want = [i for i in range(400) if i % 7 == 3 and i % 3 == 0]
    assert sorted(r.vec_id for r in both.collect()) == want
    assert len(both.inputFiles()) == len({i // 2 for i in want}) < 25
    plain = entries.filter(F.array_contains("tags", "tag3") & F.col("is_featured"))
    assert sorted(r.vec_id for r in plain.collect()) == want
    some = labelled(index, all_of=[("tags", "all"), ("tags", "all")], any_of=[("tags", "tag1"), ("tags", "tag2")])
    assert sorted(r.vec_id for r in some.collect()) == [i for i in range(400) if i % 7 in (1, 2)]
    assert labelled(index, all_of=[("tags", "none")]).count() == 0
    assert labelled(index).count() == 400


def test_two_writers_of_one_version(spark, tmp_path):
    path = str(tmp_path / "i")
    index = make(spark, documents(spark, files=1), path)
    newest = newest_run(spark, path)
    publish_parts(spark, path, "late", index.parts, previous=newest)
    with pytest.raises(alignment.IntegrityError, match="another writer"):
        write_pointer(spark, path, {**newest, "version": 1, "run": "raced"})
    with pytest.raises(alignment.IntegrityError, match="anew"):
        publish_parts(spark, path, "stale", index.parts, previous=newest)
    assert newest_run(spark, path)["run"] == "late"
    assert sorted(p.name for p in (tmp_path / "i" / "published").glob("*.json")) == ["v000000000000.json", "v000000000001.json"]


def test_index_of_texts(spark, tmp_path):
    source = tmp_path / "texts"
    source.mkdir()
    texts = {f"doc_{i:02d}.txt": " ".join(f"w{i}n{j}" for j in range(60 + 30 * i)) for i in range(14)}
    for name, text in {**texts, "empty.txt": " \n", "notes.md": "no"}.items():
        (source / name).write_text(text)
    index = build.index_texts(spark, str(source), str(tmp_path / "i"), EMBEDDER, "texts", "hashing")
    rows = index.entries.orderBy("vec_id").collect()
    assert [r.vec_id for r in rows] == list(range(len(rows))) and len(rows) > len(texts)
    assert [(r.doc_id, r.chunk_index) for r in rows] == sorted((r.doc_id, r.chunk_index) for r in rows)
    assert all(r.chunk_id == f"{r.doc_id}__chunk_{r.chunk_index:03d}" for r in rows)
    assert {r.doc_id for r in rows} == set(texts)
    assert all(r.char_count == len(r.text) and r.word_count == len(r.text.split()) for r in rows)
    summary = build.text_index_summary(index, "a demonstration").first()
    assert summary.asDict(recursive=True)["quality"] == {"self_contained": 1.0, "mid_word_breaks": 0.0}
    assert (summary.status, summary.vector_count, summary.chunk_count, summary.documents, summary.dimensions) == (
        "VERIFIED", len(rows), len(rows), 14, 16,
    )
    assert list(summary.asDict()) == [
        "status", "vector_count", "chunk_count", "dimensions", "embedding_model", "index_type", "quality",
        "documents", "purpose", "created_date",
    ]


def test_texts_are_opened_once(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("a b",), (None,), ("",), ("é\U0001f600",), ("a b",)], "value string").repartition(2)
    source = tmp_path / "texts"
    artifacts.write_texts(df, str(source), "value")
    assert sorted(f.read_text() for f in source.iterdir()) == sorted(["a b\n", "\n", "\n", "é\U0001f600\n", "a b\n"])
    assert all(f.name.startswith("part-") and f.suffix == ".txt" for f in source.iterdir())
    # What numbers the chunks and what judges them read stored chunks, not the texts.
    passes, row_sizes, chunk_quality = [], build.row_sizes, quality.chunk_quality
    monkeypatch.setattr(build, "row_sizes", lambda df, *a: passes.append(df) or row_sizes(df, *a))
    monkeypatch.setattr(quality, "chunk_quality", lambda df: passes.append(df) or chunk_quality(df))
    index = build.index_texts(spark, str(source), str(tmp_path / "i"), EMBEDDER, "texts", "hashing")
    assert sorted(r.text for r in index.entries.collect()) == ["a b", "a b", "é\U0001f600"]
    assert len(passes) == 2
    assert not [f for df in passes for f in df.inputFiles() if f.endswith(".txt")]


def test_texts_are_removed_by_tasks(spark, tmp_path):
    source = tmp_path / "texts"
    artifacts.write_texts(spark.range(30).select(F.col("id").cast("string").alias("value")), str(source), "value")
    others = [source / "notes.md", source / ".hidden.txt", source / "k=1" / "x.txt"]
    (source / "k=1").mkdir()
    for other in others:
        other.write_text("stays")
    assert len(list(source.iterdir())) == 33
    artifacts.remove_texts(spark, str(source))
    assert sorted(source.rglob("*.*")) == sorted(others)
    artifacts.remove_texts(spark, str(source))
    artifacts.remove_texts(spark, str(tmp_path / "none"))
    assert all(other.exists() for other in others)


def test_lines_are_written_in_id_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(artifacts, "FILE_VECTORS", 7)
    entries = build.documents_to_entries(documents(spark), EMBEDDER)
    total = artifacts.write_lines(entries, str(tmp_path / "out"))
    rows = entries.orderBy("vec_id").collect()
    assert total == len(rows)
    for kind, value in (("chunks", lambda r: {"text": r.text}), ("metadata", lambda r: {"row": r.row, "chunk": r.chunk})):
        parts = sorted((tmp_path / "out" / kind).glob("part-*"))
        assert len(parts) == -(-total // 7)
        lines = [json.loads(line) for part in parts for line in part.read_text().splitlines()]
        assert all(got.items() >= value(r).items() for got, r in zip(lines, rows, strict=True))
