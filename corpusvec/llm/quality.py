"""Quality by weak supervision: rules vote, EM weighs them, a posterior decides.

Each rule looks at a few counts of a text and votes good (1), bad (-1) or
abstains (0).  The votes are noisy labels of one hidden class.  EM estimates, for good
and for bad texts, how often each rule votes either way, and the share of good texts,
without any labelled data; a text's posterior probability of being good follows from its
votes.  Agreement between rules is what makes one trusted, so no single rule
can throw a text out, as an all-must-pass filter lets it.

Length is judged by fixed bounds.  The other rules look at a ratio in parts per thousand
and know what is usual from the corpus itself: a vote is good near the quartiles of the
ratio and bad beyond them by ``BAD_REACH`` times their distance, plus a slack.  Ratios
are whole numbers up to ``MOST``, so exact quartiles need a bounded table.

EM starts from the share of good votes among all votes of a text, and sees the number of
texts per pattern of votes: at most 3 ** rules rows.  Its rounds are small aggregations
over that table; a vote count is smoothed by one, and nothing else bounds it.  Counts
are per row, inside the row: no shuffle moves a text or a word.  Built-in columns only.

Windows of three words are compared by 64-bit hash.  NULL text has no words and
fails the base check; so does any text under ``MIN_WORDS`` words; of a text without words
only the length votes.  A very long text is an array of its words inside its row, some ten
times its bytes.  Repeated rows are counted and judged each, and other columns take no part.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusvec.functions.text import bind
from corpusvec.llm.common import BLANKS, words
from corpusvec.session import settle

# Fixed values.
SYMBOLS = "#*$%&|<>"
DIGITS = "0123456789"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

EM_ROUNDS = 15

# Votes of the length rule.
LONG_ENOUGH = ("n_words >= 80", f"n_words < {MIN_WORDS}")
# Ratio rules: (numerator, denominator, side that is bad, slack in parts per thousand).
RATIOS: Mapping[str, tuple[str, str, str, int]] = {
    "word_length": ("word_chars", "n_words", "both", 100),
    "few_symbols": ("n_symbols", "n_words", "high", 50),
    "fresh_lines": ("n_dup_lines", "n_lines", "high", 330),
    "fresh_windows": ("n_repeat_words", "n_words", "high", 250),
    "few_digits": ("n_digits", "word_chars", "high", 20),
    "varied_words": ("n_distinct_words", "n_words", "low", 0),
}
RULES = ("long_enough", *RATIOS)
VOTES = (1, 0, -1)
# Largest ratio that is told apart, in parts per thousand.
MOST = 20_000
# Quartile distances beyond the quartiles up to which a vote is good, and from which it is bad.
GOOD_REACH, BAD_REACH = 0.5, 1.5


# Counts -----------------------------------------------------------------------


def _characters(text: Column, removed: str) -> Column:
    return F.length(text) - F.length(F.translate(text, removed, ""))


def _repeated_words(tokens: Column) -> Column:
    """Words in windows of three that occur more than once among ``tokens``."""
    starts = F.sequence(F.lit(0), F.size(tokens) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(tokens[i], tokens[i + 1], tokens[i + 2]))

    def covered(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        repeated = bind(
            by_hash,
            lambda s: F.filter(
                s,
                lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))
                | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
            ),
        )
        places = F.sort_array(F.transform(repeated, lambda x: x["at"]))
        # A window adds what the one before does not cover already.
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda t, at: F.struct(
                (t["n"] + F.least(F.lit(3), at - t["last"])).alias("n"), at.alias("last")
            ),
            lambda t: t["n"],
        )

    distinct_or_covered = bind(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
    )
    return F.when(F.size(tokens) < 3, F.lit(0)).otherwise(distinct_or_covered)


def counts(text: Column) -> dict[str, Column]:
    """The counts that rules and the base check look at, all exact."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(
        F.split(text, "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0
    )
    line_counts = bind(
        lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))
    )
    word_counts = bind(
        words(text),
        lambda w: F.struct(
            F.size(w).alias("n"),
            F.size(F.array_distinct(w)).alias("distinct"),
            _repeated_words(w).alias("repeat"),
        ),
    )
    return {
        "word_chars": F.length(F.translate(text, BLANKS, "")),
        "n_symbols": _characters(text, SYMBOLS),
        "n_digits": _characters(text, DIGITS),
        "line_counts": line_counts,
        "word_counts": word_counts,
    }


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every row of ``doc_id, text``."""
    flat = docs.select("doc_id", *(c.alias(n) for n, c in counts(F.col("text")).items()))
    long = {
        "n_words": F.col("word_counts.n"),
        "word_chars": F.col("word_chars"),
        "n_symbols": F.col("n_symbols"),
        "n_dup_lines": F.col("line_counts.dup"),
        "n_repeat_words": F.col("word_counts.repeat"),
        "n_digits": F.col("n_digits"),
        "n_lines": F.col("line_counts.n"),
        "n_distinct_words": F.col("word_counts.distinct"),
    }
    return flat.select("doc_id", *(c.cast("long").alias(n) for n, c in long.items()))


# Votes -------------------------------------------------------------------------


def ratio_sql(rule: str, divide: str = "div") -> str:
    """The rule's ratio in parts per thousand; NULL for a text without words."""
    above, below, _, _ = RATIOS[rule]
    return f"CASE WHEN n_words > 0 THEN least({MOST}, (1000 * {above}) {divide} {below}) END"


def vote_sql(rule: str, low: str = "", high: str = "", divide: str = "div") -> str:
    """A rule's vote; ``low`` and ``high`` are the quartiles of its ratio."""
    if rule not in RATIOS:
        good, bad = LONG_ENOUGH
        return f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END"
    _, _, side, slack = RATIOS[rule]
    ratio = f"({ratio_sql(rule, divide)})"

    def outside(reach: float, part: float) -> str:
        above = f"{ratio} > {high} + {reach} * ({high} - {low}) + {part * slack}"
        below = f"{ratio} < {low} - {reach} * ({high} - {low}) - {part * slack}"
        return {"both": f"({above} OR {below})", "high": f"({above})", "low": f"({below})"}[side]

    return (
        f"CASE WHEN {outside(BAD_REACH, 1.0)} THEN -1 WHEN NOT {outside(GOOD_REACH, 0.5)} THEN 1 ELSE 0 END"
    )


def quartiles(measured: DataFrame) -> dict[str, tuple[int, int] | None]:
    """The quartiles of each rule's ratio over all texts with words; None if there are none."""
    at = "percentile_disc({q}) WITHIN GROUP (ORDER BY {x}) AS {name}"
    found = measured.agg(
        *(
            F.expr(at.format(q=q, x=ratio_sql(rule), name=f"{rule}_{name}"))
            for rule in RATIOS
            for q, name in ((0.25, "low"), (0.75, "high"))
        )
    ).first()
    return {
        rule: None
        if found[f"{rule}_low"] is None
        else (int(found[f"{rule}_low"]), int(found[f"{rule}_high"]))
        for rule in RATIOS
    }


def vote(measured: DataFrame) -> DataFrame:
    """The rows and columns of ``measured``, and one column of votes per rule."""
    bounds = {rule: found or (0, 0) for rule, found in quartiles(measured).items()}
    votes = (vote_sql(rule, *map(str, bounds.get(rule, ()))) for rule in RULES)
    return measured.select("*", *(F.expr(v).alias(rule) for rule, v in zip(RULES, votes)))


# The label model ---------------------------------------------------------------

# For each rule and vote, how often it is cast for good and for bad texts.
Model = tuple[float, Mapping[str, Mapping[int, tuple[float, float]]]]


def posterior(model: Model) -> Column:
    """The probability of a good text, given its votes."""
    prior, rules = model
    evidence = F.lit(math.log(prior / (1 - prior)))
    for rule, votes in rules.items():
        weight = F.lit(0.0)
        for cast, (good, bad) in votes.items():
            weight = F.when(F.col(rule) == cast, F.lit(math.log(good / bad))).otherwise(weight)
        evidence = evidence + weight
    return 1 / (1 + F.exp(-evidence))


def _majority() -> Column:
    """The share of good votes among the votes of a text, drawn a little towards a half."""
    cast = [F.abs(F.col(rule)) for rule in RULES]
    good = [(F.col(rule) == 1).cast("int") for rule in RULES]
    return (sum(good[1:], good[0]) + F.lit(0.5)) / (sum(cast[1:], cast[0]) + F.lit(1.0))


def fit(votes: DataFrame, rounds: int = EM_ROUNDS) -> Model:
    """The share of good texts and each rule's habits, from one column of votes per rule.

    Only these few numbers come to the driver, once a round.
    """
    patterns = settle(votes.groupBy(*RULES).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "votes")
    probability, model = _majority(), (0.5, {})
    for _ in range(rounds):
        parted = patterns.select(
            "*", (F.col("n") * probability).alias("good"), (F.col("n") * (1 - probability)).alias("bad")
        )
        sums = parted.agg(
            F.sum("good").alias("good"),
            F.sum("bad").alias("bad"),
            *(
                F.sum(F.when(F.col(rule) == cast, F.col(kind)).otherwise(0.0)).alias(f"{kind}_{rule}_{cast}")
                for rule in RULES
                for cast in VOTES
                for kind in ("good", "bad")
            ),
        ).first()
        if sums["good"] is None:
            break
        shares = {
            rule: {
                cast: tuple(
                    (sums[f"{kind}_{rule}_{cast}"] + 1) / (sums[kind] + len(VOTES)) for kind in ("good", "bad")
                )
                for cast in VOTES
            }
            for rule in RULES
        }
        model = (sums["good"] + 1) / (sums["good"] + sums["bad"] + 2), shares
        probability = posterior(model)
    return model


BASE_FAILED = (
    f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
)


def judge(docs: DataFrame, rounds: int = EM_ROUNDS) -> DataFrame:
    """Counts, ``base_failed``, ``quality`` (the posterior) and ``kept`` for every row."""
    measured = settle(measure(docs), "quality-counts")
    voted = vote(measured)
    model = fit(voted, rounds)
    scored = voted.select(
        *measured.columns,
        F.expr(BASE_FAILED).alias("base_failed"),
        F.round(posterior(model), 6).alias("quality"),
    )
    return scored.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("quality") >= 0.5)).alias("kept"),
        "quality",
    )


# The same rows in DuckDB SQL ----------------------------------------------------


def sql(rounds: int = EM_ROUNDS, docs: str = "documents") -> str:
    kinds = ("good", "bad")
    name = lambda kind, rule, cast: f"{kind}_{rule}_{VOTES.index(cast)}"

    def probability(t: str) -> str:
        weights = "".join(
            f" + CASE {t}.{rule} "
            + " ".join(f"WHEN {v} THEN ln(s.{name('good', rule, v)} / s.{name('bad', rule, v)})" for v in VOTES)
            + " END"
            for rule in RULES
        )
        return f"1 / (1 + exp(-(ln(s.prior / (1 - s.prior)){weights})))"

    cast = " + ".join(f"abs({rule})" for rule in RULES)
    good = " + ".join(f"({rule} = 1)::INT" for rule in RULES)
    shares = ", ".join(
        [
            "(sum(n * p) + 1) / (sum(n) + 2) AS prior",
            *(
                f"(sum(CASE WHEN {rule} = {v} THEN n * {p} ELSE 0 END) + 1) / (sum(n * {p}) + {len(VOTES)})"
                f" AS {name(kind, rule, v)}"
                for rule in RULES
                for v in VOTES
                for kind, p in zip(kinds, ("p", "(1 - p)"))
            ),
        ]
    )
    steps = [f"em1 AS (SELECT {shares} FROM (SELECT *, ({good} + 0.5) / ({cast} + 1.0) AS p FROM patterns))"]
    for k in range(2, rounds + 1):
        steps.append(
            f"em{k} AS MATERIALIZED (SELECT {shares}"
            f" FROM (SELECT v.*, {probability('v')} AS p FROM patterns v, em{k - 1} s))"
        )
    fences = ", ".join(
        f"quantile_disc({ratio_sql(rule, '//')}, {q}) AS {rule}_{side}"
        for rule in RATIOS
        for q, side in ((0.25, "low"), (0.75, "high"))
    )
    votes = ", ".join(
        f"{vote_sql(rule, f'coalesce({rule}_low, 0)', f'coalesce({rule}_high, 0)', '//')} AS {rule}"
        for rule in RULES
    )
    symbols = f"[{SYMBOLS}]"
    return f"""
    WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM {docs}),
    w AS (
      SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
      FROM (SELECT r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM texts)),
    windows AS (
      SELECT r, i, count(*) OVER (PARTITION BY r, word, w2, w3) AS n
      FROM (SELECT r, i, word, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3
            FROM w WINDOW o AS (PARTITION BY r ORDER BY i))
      WHERE w3 IS NOT NULL),
    repeats AS (
      SELECT r, count(DISTINCT i + k) AS n_repeat_words
      FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY r),
    word_counts AS (
      SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars,
             count(DISTINCT word) AS n_distinct_words FROM w GROUP BY r),
    line_counts AS (
      SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts)
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
    counts AS (
      SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words,
             CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '{symbols}', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) AS n_digits,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_distinct_words, 0) AS n_distinct_words
      FROM texts LEFT JOIN word_counts USING (r) LEFT JOIN line_counts USING (r)
           LEFT JOIN repeats USING (r)),
    fences AS (SELECT {fences} FROM counts),
    voted AS MATERIALIZED (SELECT counts.*, {votes} FROM counts, fences),
    patterns AS MATERIALIZED (SELECT {", ".join(RULES)}, count(*) AS n FROM voted GROUP BY ALL),
    {", ".join(steps)},
    scored AS (
      SELECT v.*, {BASE_FAILED} AS base_failed,
             round({probability("v")}, 6) AS quality
      FROM voted v, em{rounds} s)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND quality >= 0.5 AS kept, quality
    FROM scored"""
