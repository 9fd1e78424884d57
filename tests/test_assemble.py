import json

import pytest
from pyspark.sql import functions as F

from corpusvec.functions import variants as V
from corpusvec.operators import assemble as A
from corpusvec.operators import quality as Q
from corpusvec.plans.build import assemble_records


def documents(spark, kind, records):
    lines = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    df = spark.createDataFrame(lines, "row long, line string").select(
        F.lit("f").alias("source"), F.lit(0).alias("file_index"), "row",
        F.try_parse_json("line").alias("v"),
    )
    return {r.row: r for r in assemble_records(df, kind).collect()}


def test_articles(spark):
    got = documents(spark, "article", [
        {"title": " T ", "text": " body\n", "categories": ["a", "", None, 0, 3, True, "b"]},
        {"title": "  ", "text": "body", "categories": []},
        {"title": "T", "text": " 　\n"},
        {"text": "body", "categories": "not a list"},
        {"title": "T"},
    ])
    assert got[0].document == "[TITLE] T\n\n[CATEGORIES] a, 3, True, b\n\n[CONTENT]\nbody"
    assert got[1].document == "[CONTENT]\nbody"
    assert got[2].document is None and got[4].document is None
    assert got[3].document == "[CONTENT]\nbody"


def test_questions(spark):
    got = documents(spark, "qa", [
        {"tags": ["py", ""], "title": " t ", "question": "q" * 5001, "accepted_answer": "a" * 3000,
         "answers": [" ", {"body": "x" * 2001}, {"Body": "y"}, "never seen"]},
        {"Tags": ["z"], "Title": "T", "body": "b", "AcceptedAnswer": "A", "Answers": [5, "s", ["l"], "no"]},
        {"tags": "py", "title": 5, "question": ["q"], "answers": "a"},
        {"tags": [], "Tags": ["second"], "title": "", "Title": "second", "question": None, "Question": "Q"},
        {},
    ])
    assert got[0].document == (
        "[TAGS] py\n\n[QUESTION_TITLE] t\n\n[QUESTION]\n" + "q" * 5000 + "...\n\n[ACCEPTED_ANSWER]\n"
        + "a" * 3000 + "\n\n[OTHER_ANSWERS]\n- " + "x" * 2000 + "...\n- y"
    )
    assert got[1].document == (
        "[TAGS] z\n\n[QUESTION_TITLE] T\n\n[QUESTION]\nb\n\n[ACCEPTED_ANSWER]\nA\n\n[OTHER_ANSWERS]\n- s"
    )
    assert got[2].document is None and got[4].document is None
    assert got[3].document == "[TAGS] second\n\n[QUESTION_TITLE] second\n\n[QUESTION]\nQ"


def test_papers(spark):
    got = documents(spark, "paper", [
        {"text": r" \emph{deep} nets ", "meta": {"arxiv_id": "1", "yymm": "2001"}, "title": "ignored"},
        {"text": "w " * 4000, "meta": {}},
        {"text": r"\alpha", "meta": {}},
        {"text": " ", "meta": {}, "abstract": "not used"},
        {"id": "9", "categories": ["cs.LG", ""], "title": r"\textbf{T}", "abstract": "a\nb",
         "authors": ["A", "", "B", "C", "D", "E", "F"]},
        {"arxiv_id": "8", "category": "cs.CL", "abstract": "x" * 6000, "author": "Solo"},
        {"text": "has no meta", "abstract": "std"},
        {"title": "no abstract"},
    ])
    assert got[0].document == "[ARXIV_ID] 1\n\n[DATE] 2001\n\n[CONTENT]\ndeep nets"
    # The id of this form is under meta, so the chunk metadata has none.
    assert got[0].arxiv_id is None
    assert got[1].document == "[CONTENT]\n" + ("w " * 4000).strip()[:5000] + "..."
    assert got[2].document == "[CONTENT]\n"
    assert got[3].document is None and got[7].document is None
    assert got[4].document == (
        "[ARXIV_ID] 9\n\n[CATEGORIES] cs.LG\n\n[TITLE] T\n\n[AUTHORS] A, B, C, D\n\n[ABSTRACT]\na b"
    )
    assert got[4].arxiv_id == "9"
    assert got[5].document == (
        "[ARXIV_ID] 8\n\n[CATEGORIES] cs.CL\n\n[AUTHORS] Solo\n\n[ABSTRACT]\n" + "x" * 6000
    )
    assert got[6].document == "[ABSTRACT]\nstd"


@pytest.mark.parametrize(
    "kind, line, reason",
    [
        ("article", '{"title": "t", "text": "x"', "malformed JSON"),
        ("article", "", "malformed JSON"),
        ("article", "[1]", "not an object"),
        ("article", "3", "not an object"),
        ("article", '{"title": null, "text": "x"}', "ill-typed title"),
        ("article", '{"title": "t", "text": 5}', "ill-typed text"),
        ("article", '{"text": "x"}', None),
        ("qa", '{"title": 5, "question": "q"}', "ill-typed title"),
        ("qa", '{"title": null, "question": "q"}', None),
        ("paper", '{"text": "x", "meta": null}', "ill-typed meta"),
        ("paper", '{"text": "x", "meta": {}}', None),
        ("paper", '{"abstract": 5}', "ill-typed abstract"),
        ("paper", '{"text": null, "abstract": "a"}', None),
    ],
)
def test_quarantine(spark, kind, line, reason):
    df = spark.createDataFrame([(line,)], "value string").withColumn("v", F.try_parse_json("value"))
    good, bad = Q.quarantine_malformed(df, kind)
    assert [r.reason for r in bad.collect()] == ([] if reason is None else [reason])
    assert good.count() == (1 if reason is None else 0)


def test_typed_papers_accept_lists_and_strings(spark):
    df = spark.createDataFrame(
        [("1", ["a", "b"], "t", list("ABCDEFG"), "abs")],
        "arxiv_id string, categories array<string>, title string, authors array<string>, abstract string",
    )
    (row,) = A.assemble_papers_standard(df).collect()
    assert "[CATEGORIES] a, b" in row.document and "[AUTHORS] A, B, C, D, E\n" in row.document


def test_fields_of_a_record_named_like_one_of_them(spark):
    df = spark.createDataFrame([('{"text": "x", "meta": {"arxiv_id": "1"}}',)], "line string").select(
        F.try_parse_json("line").alias("redpajama")
    )
    fields = A.paper_fields(F.col("redpajama"))
    row = df.select(*(c.alias(n) for n, c in fields.items())).first()
    assert (row.redpajama, row.text, row.meta_id) == (True, "x", "1")


def test_chunk_metadata(spark):
    df = spark.createDataFrame(
        [("f", 0, 1, 2, "t" * 150, None)],
        "source string, file_index int, row long, chunk int, title string, arxiv_id string",
    )
    (row,) = A.chunk_metadata(df).collect()
    assert row.title == "t" * 100 and row.arxiv_id == ""


def test_filter_by_label(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b"], "x", True), (2, ["c"], "y", False)],
        "i int, tags array<string>, kind string, flag boolean",
    )
    def ids(column, values):
        return [r.i for r in A.filter_by_label(df, column, values).collect()]
    assert ids("tags", ["b", "q"]) == [1]
    assert ids("kind", ["y"]) == [2]
    assert ids("flag", True) == [1]


def test_dates_and_bytes_are_truthy(spark):
    row = spark.sql(
        """SELECT to_variant_object(named_struct('d', DATE'2020-01-01', 't', TIMESTAMP'2020-01-01 00:00:00',
           'b', X'00', 'e', X'', 'n', 0, 's', '')) AS v"""
    )
    got = row.select(*(V.is_truthy(V.field(F.col("v"), n)).alias(n) for n in "dtbens")).first()
    assert tuple(got) == (True, True, True, False, False, False)
