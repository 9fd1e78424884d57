"""Boilerplate lines: thresholds, what stays, and odd rows."""

import pytest

from corpusvec.llm import lines

SCHEMA = "doc_id long, source string, text string, site string"
COMMON = "this line is boilerplate"
RARE = "this line is on few sites"


def rows(sites):
    out = [(i, f"s{i}", f"own text number {i} of its site\n  {COMMON}\n \nhi\n", "x") for i in range(sites)]
    out += [(100 + i, f"s{i}", f"{RARE}\n\nhi", "x") for i in range(4)]
    return out


def removed(df, **options):
    got = lines.remove_boilerplate(df, **options).collect()
    return {r["doc_id"]: r for r in got}


@pytest.mark.parametrize("sites, goes", [(9, False), (10, True), (11, True), (40, True)])
def test_threshold_is_exact(spark, sites, goes):
    got = removed(spark.createDataFrame(rows(sites), SCHEMA))
    assert COMMON in got[0]["text"] and got[0]["n_removed"] == 0
    # Short lines count as any other; lines without a word are none.
    for i in range(1, sites):
        assert (COMMON not in got[i]["text"]) == goes and got[i]["n_removed"] == 2 * int(goes)
    want = "own text number 5 of its site\n \n" if goes else rows(6)[5][2]
    assert got[5]["text"] == want and got[5]["n_lines"] == 5 and got[5]["site"] == "x"
    assert all(got[100 + i]["text"] == (f"{RARE}\n" if goes else f"{RARE}\n\nhi") for i in range(4))


def test_wide_sketch_error_is_made_up_for(spark):
    # Four sketch cells: the estimate is rough, so nearly all is counted exactly.
    table = lines.line_table(spark.createDataFrame(rows(30), SCHEMA))
    for threshold, found in ((30, 2), (31, 0)):
        assert lines.boilerplate(table, threshold, sketch_bits=4).count() == found


def test_odd_rows(spark):
    table = [(i, None if i == 3 else f"s{i}", COMMON, "x") for i in range(12)]
    table += [(1, "s1", COMMON, "x"), (None, "s1", COMMON + "\nmore", "x"), (50, "s", None, "x"), (51, "s", "", "x")]
    got = lines.remove_boilerplate(spark.createDataFrame(table, SCHEMA)).collect()
    assert len(got) == len(table)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[None][0]["text"] == COMMON + "\nmore"  # NULL comes first
    assert [r["text"] for r in by_id[1]] == ["", ""] and by_id[0][0]["n_removed"] == 1
    assert by_id[50][0]["text"] is None and by_id[50][0]["n_lines"] == 0
    assert by_id[51][0]["text"] == "" and by_id[51][0]["n_lines"] == 1


def test_repeats_inside_the_first_document(spark):
    table = [(i, f"s{i}", f"{COMMON}\n{COMMON}", "x") for i in range(12)]
    got = removed(spark.createDataFrame(table, SCHEMA))
    assert got[0]["text"] == COMMON and got[1]["text"] == ""


def test_clashing_names(spark):
    names = ["doc_id", "source", "text", "__doc", "__hash", "__gone", "__split", "doc", "hash", "gone", "split", "n_lines", "h1", "pos", "site"]
    table = [(i, f"s{i}", COMMON, *names[3:]) for i in range(12)]
    got = lines.remove_boilerplate(spark.createDataFrame(table, names))
    assert sorted(got.columns) == sorted([*names, "n_removed"])
    for r in got.collect():
        assert r["text"] == (COMMON if r["doc_id"] == 0 else "") and r["n_lines"] == 1
        assert [r[n] for n in names[3:] if n != "n_lines"] == [n for n in names[3:] if n != "n_lines"]


def test_very_long_text(spark):
    long = "\n".join(f"line {i} of many" for i in range(60_000))
    table = [(i, f"s{i}", COMMON if i else f"{long}\n{COMMON}", "x") for i in range(12)]
    table += [(99, "s99", f"{long}\n{COMMON}", "x")]
    got = removed(spark.createDataFrame(table, SCHEMA))
    assert got[99]["text"] == long and got[99]["n_lines"] == 60_001 and got[0]["n_removed"] == 0


def test_empty_table(spark):
    assert lines.remove_boilerplate(spark.createDataFrame([], SCHEMA)).count() == 0
