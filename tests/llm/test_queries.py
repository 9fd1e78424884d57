"""Queries against their SQL, and the pipeline against the brute-force versions of its stages."""

import pandas as pd
import pytest

import corpus_pipeline
from checks.compare import connect, difference
from corpusvec.llm import language, lines, packing
from corpusvec.llm.queries import ORACLES, QUERIES

from .test_simhash import brute_fingerprint, groups_of
from .test_suffixes import brute as brute_repeats


def test_every_operator_has_a_query():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    assert difference(got, connect(sf).execute(ORACLES[name]).df()) is None


def test_pipeline_against_plain_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    by_lang = language.compressors(language.learn(docs))
    kept = []
    for r in docs.select("doc_id", "source", "text", language.letters(docs["text"]).alias("l")).collect():
        lang, score = language.classify((r["l"] or "").encode(), by_lang)
        if lang != language.UNKNOWN and score >= language.MIN_MARGIN:
            kept.append((r["doc_id"], r["source"], r["text"]))
    con = connect(sf)
    con.register("kept", pd.DataFrame(kept, columns=["doc_id", "source", "text"]))
    cleaned = con.execute(lines.sql(docs="kept")).df()
    texts = dict(zip(cleaned["doc_id"].tolist(), cleaned["text"].tolist()))
    ids = sorted(texts)
    label = groups_of([brute_fingerprint(texts[i]) for i in ids], 4)
    ids = [i for n, i in enumerate(ids) if label[n] == n]
    data = [texts[i] for i in ids]
    removed = {i: r[1] for i, r in zip(ids, brute_repeats(data, corpus_pipeline.PASSAGE_BYTES))}

    path = spark.conf.get("spark.checkpoint.dir")
    stage_docs, lengths = docs, []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, stage_docs, sf).write.mode("overwrite").parquet(f"{path}/test-stage-{n}")
        stage_docs = spark.read.parquet(f"{path}/test-stage-{n}")
        if n < 4:
            assert tuple(stage_docs.columns) == corpus_pipeline.COLUMNS
            lengths.append({r["doc_id"]: r for r in stage_docs.collect()})
    assert sorted(lengths[0]) == sorted(r[0] for r in kept)
    assert {i: r["text"] for i, r in lengths[1].items()} == texts
    assert sorted(lengths[2]) == ids
    emptied = {i for i in ids if texts[i] and removed[i] == len(texts[i].encode())}
    assert sorted(lengths[3]) == [i for i in ids if i not in emptied]
    for i, r in lengths[3].items():
        before = len(texts[i].encode())
        # Characters of which a part is repeated stay whole.
        assert before - removed[i] <= len(r["text"].encode()) <= before - removed[i] + 8
        assert r["n_chars"] == len(r["text"])
    con.register("packed", pd.DataFrame([(i, r["text"]) for i, r in lengths[3].items()], columns=["doc_id", "text"]))
    assert difference(stage_docs.toPandas(), con.execute(packing.sql(docs="packed")).df()) is None
    assert corpus_pipeline.run(spark, sf).count() == stage_docs.count()
