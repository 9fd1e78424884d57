import sys

from pyspark.sql import functions as F

from corpusvec.functions import text as T


def one(spark, value, *columns):
    row = spark.createDataFrame([(value,)], "s string").select(*columns).first()
    return row[0] if len(columns) == 1 else tuple(row)


def test_whitespace_is_pythons():
    assert set(T.WHITESPACE) == {chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()}


def test_squeeze_and_strip_treat_every_whitespace_character(spark):
    rows = [(c, f"{c}a{c}{c}b c{c}") for c in T.WHITESPACE]
    df = spark.createDataFrame(rows, "c string, s string")
    for r in df.select("s", T.squeeze(F.col("s")).alias("q"), T.strip(F.col("s")).alias("t")).collect():
        assert r.q == "a b c"
        assert r.t == r.s.strip()


def test_squeeze_leaves_other_characters_alone(spark):
    others = [chr(i) for i in range(0x3100) if not chr(i).isspace() and not 0xD800 <= i < 0xE000]
    text = "x".join(others[1:])  # NUL is not worth a test
    assert one(spark, text, T.squeeze(F.col("s"))) == text


def test_words(spark):
    df = spark.createDataFrame([("",), (" \n",), ("a  b　c",)], "s string")
    assert [r[0] for r in df.select(T.words(F.col("s"))).collect()] == [[], [], ["a", "b", "c"]]


def test_cap_counts_code_points(spark):
    assert one(spark, "\U0001f600" * 4, T.cap(F.col("s"), 3)) == "\U0001f600" * 3 + "..."
    assert one(spark, "abc", T.cap(F.col("s"), 3)) == "abc"


def test_clean_latex(spark):
    cases = {
        r"see \cite{x} and \ref{y}": "see [x and [y",
        r"\emph{a} \textbf{b} \textit{c}": "a b c",
        r"cost \$5 and $$x$$ or $y$": "cost 5 and x or $y$",
        r"\alpha\beta{z}": "{z",
        " a\n\n b ": "a b",
        "": "",
        None: "",
    }
    for raw, cleaned in cases.items():
        assert one(spark, raw, T.clean_latex(F.col("s"))) == cleaned


def test_fallbacks(spark):
    df = spark.createDataFrame([("", "b"), (None, "b"), ("a", "b"), ("", "")], "x string, y string")
    got = [r[0] for r in df.select(T.first_non_empty(F.col("x"), F.col("y"))).collect()]
    assert got == ["b", "b", "a", None]


def test_join_present_preview_padded(spark):
    assert one(spark, "", T.join_present(F.array(F.lit("a"), F.lit(""), F.lit(None), F.lit("b")))) == "a, b"
    assert one(spark, "", T.join_present(F.array(F.lit("")))) is None
    assert one(spark, "a\nb" * 60, T.preview(F.col("s"))) == ("a\nb" * 60)[:100].replace("\n", " ")
    assert one(spark, "", T.padded(F.lit(7), 3)) == "007"
