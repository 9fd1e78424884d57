"""Chat formatting: whatever a turn says comes back."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusvec.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"

PARTS = st.sampled_from(
    ["<|im_start|>", "<|im_end|>", "<|", "|>", "<", "|", "\\", "<\\|", "<n>", "n>", "\n", "a", "é", " ", "<|im_", "im_end|>"]
)
STRINGS = st.lists(PARTS, max_size=8).map("".join)


def source_digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(df)).collect()}
    by_id = {}
    for conv, turn, role, text in sorted(
        rows, key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())
    ):
        by_id.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(by_id)
    for conv, turns in by_id.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == source_digest(turns)
        assert got[conv]["loss_chars"] == len(loss)
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    return df


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), STRINGS, STRINGS), min_size=30, max_size=60))
def test_any_turn_comes_back(spark, turns):
    check(spark, [(conv, i, role, text) for i, (conv, role, text) in enumerate(turns)])


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (1, 1, "assistant", "b"),
        (2, None, None, "x"), (2, 0, "assistant", "<|im_end|>"), (None, 0, "user", "no id"),
        (3, 0, "as\nsistant", "two\nlines\n"), (3, 1, "assistant", "\n\n"), (4, 0, "user", "long " * 50_000),
        (-1, 0, "user", chat.PROBE_TEXT), (-1, 1, "assistant", chat.PROBE_TEXT),
    ]
    df = check(spark, rows)
    formatted = {r["conv_id"]: r["formatted"] for r in chat.format_conversations(df).collect()}
    assert formatted[-1].count(chat.START) == formatted[-1].count(chat.END) == 2
    assert formatted[1].startswith("<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n")


def test_only_conflicting_text_is_escaped(spark):
    rows = [(1, 0, "user", "plain <|other|> text"), (2, 0, "user", "an <|im_end|> and <|other|>")]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    formatted = {r["conv_id"]: r["formatted"] for r in chat.format_conversations(df).collect()}
    assert "plain <|other|> text" in formatted[1]
    assert "an <\\|im_end|> and <\\|other|>" in formatted[2]


def test_malformed_output_is_told(spark):
    bad = ["x<|im_start|>user\na<|im_end|>\n", "<|im_start|>user\na", "<|im_start|>user<|im_end|>\n"]
    df = spark.createDataFrame([(t,) for t in bad], "formatted string")
    assert [r[0] for r in df.select(chat.parse_turns(df["formatted"])).collect()] == [None] * 3


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.digests(chat.format_conversations(empty)).count() == 0
    assert chat.digests(chat.format_conversations(chat.with_probe(empty))).count() == 1


def test_main_path_has_no_python(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    plan = chat.digests(chat.format_conversations(turns))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
