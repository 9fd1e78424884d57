"""Document probability under a subword lattice language model.

The model is a unigram model over the pieces of a public vocabulary and an end
token.  A word's probability is the sum over all its segmentations, by forward
recursion in log space; a text's is the product over its words and the end.
Bytes are pieces too, so every text has a probability.

The vocabulary's own scores are ranks.  They give the weights to start from, and
expected counts over the training words (forward and backward through the same
lattice, each distinct word once with its count) make them probabilities of this
corpus.  Pieces are never added, removed or merged.

The base is a word unigram model with one added to every count.

What is gathered is the table of distinct words.  A text is read three times: to
count words, to meet the scores of frequent words (at most ``HEAD_WORDS``, with
the task) and, for its other words, in a join by word.  Frequent words are two
thirds of a text or more, and no word of the join is frequent, so it has no hot key.

NULL texts are empty: one token, the end.  Folds are taken from ``doc_id`` as text;
a NULL ``doc_id`` is in none and counts as training data.  Repeated rows count and
are scored each.  A very long text is the work of one task, at some times its bytes; its
words are counted as they are found.  Other columns take no part.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import as_bytes, null_safe_join, slices
from corpusvec.llm.vocabulary import MARK, RANK_OFFSET, Vocabulary, load, vocabulary_path
from corpusvec.session import settle

FOLDS, HELD_OUT = 7, 2
HEAD_WORDS, HEAD_WORD_BYTES = 100_000, 64
EM_ROUNDS = 1
# Added to every piece's expected count.
SMOOTHING = 0.1
# Words counted before a task hands its counts on, and words to a task of the lattice.
OPEN_WORDS = 200_000
TASK_WORDS = 50_000

# Takes the place of a literal mark inside a word, which is no blank.  Half of a
# surrogate pair is in no UTF-8 text, and no piece has it.
HIDDEN_MARK = "\ud800"

_LN10 = math.log(10)


def held_out(doc_id: Column) -> Column:
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


# The lattice -----------------------------------------------------------------------


class Lattice:
    """All segmentations of a word, weighted by the log probability of their pieces."""

    def __init__(self, vocabulary: Vocabulary, log_probs: np.ndarray):
        logs = log_probs.tolist()
        # Every prefix of a piece is a key, so that a search ends where no piece goes on.
        self.ahead: dict[str, tuple[float, int] | bool] = {}
        for piece, (i, _) in vocabulary.pieces.items():
            for end in range(1, len(piece)):
                self.ahead.setdefault(piece[:end], False)
        self.ahead |= {p: (logs[i], i) for p, (i, _) in vocabulary.pieces.items()}
        self.bytes = [(logs[i], i) for i in vocabulary.byte_ids]
        self.spelt: dict[str, tuple[float, list[int]]] = {}

    def _spell(self, character: str, first: bool) -> tuple[float, list[int]]:
        """A character in byte pieces; the first one is the blank before a word."""
        key = " " if first else character
        found = self.spelt.get(key)
        if found is None:
            raw = [self.bytes[b] for b in (MARK if key == HIDDEN_MARK else key).encode()]
            found = self.spelt[key] = (sum(p for p, _ in raw), [i for _, i in raw])
        return found

    def _walk(self, word: str, ends: list[list] | None = None) -> list[float]:
        """Log of the summed weights of all ways to each position.

        ``ends`` gets the pieces that end at each position.
        """
        text = MARK + word.replace(MARK, HIDDEN_MARK)
        n, get, exp, log = len(text), self.ahead.get, math.exp, math.log
        terms: list[list[float]] = [[] for _ in range(n + 1)]
        alpha = [0.0]
        if ends is not None:
            ends += [[] for _ in range(n + 1)]
        for i in range(n + 1):
            if i:
                here = terms[i]
                top = max(here)
                alpha.append(top + log(sum([exp(t - top) for t in here])) if len(here) > 1 else top)
                if i == n:
                    break
            a = alpha[i]
            cost, ids = self._spell(text[i], i == 0)
            terms[i + 1].append(a + cost)
            if ends is not None:
                ends[i + 1].append((i, cost, ids))
            j = i + 1
            while j <= n:
                found = get(text[i:j])
                if found is None:
                    break
                if found:
                    terms[j].append(a + found[0])
                    if ends is not None:
                        ends[j].append((i, found[0], (found[1],)))
                j += 1
        return alpha

    def log_probability(self, word: str) -> float:
        """Natural logarithm of the sum over all segmentations."""
        return self._walk(word)[-1]

    def expect(self, word: str, count: float, into: np.ndarray | list[float]) -> None:
        """Add the expected number of each piece in ``count`` occurrences of a word."""
        ends: list[list] = []
        alpha = self._walk(word, ends)
        # Share of the paths that pass each position, from the end back.
        share = [0.0] * len(alpha)
        share[-1] = count
        exp = math.exp
        for j in range(len(alpha) - 1, 0, -1):
            reach, here = share[j], alpha[j]
            for i, p, ids in ends[j]:
                part = reach * exp(alpha[i] + p - here)
                share[i] += part
                for piece in ids:
                    into[piece] += part


def starting_weights(vocabulary: Vocabulary) -> np.ndarray:
    """Log probabilities from the file's scores alone, which are ranks: the weight that a
    piece starts with is 1 / (rank + RANK_OFFSET)."""
    weights = np.zeros(vocabulary.size)
    for i, score in vocabulary.file_scores.items():
        weights[i] = 1.0 / (RANK_OFFSET - score)
    weights[list(vocabulary.byte_ids)] = 1.0 / (RANK_OFFSET + vocabulary.size)
    return _logs(weights / weights.sum())


def _logs(p: np.ndarray) -> np.ndarray:
    return np.log(np.where(p > 0, p, 1.0)) + np.where(p > 0, 0.0, -np.inf)


# Counting ------------------------------------------------------------------------


def count_words(docs: DataFrame) -> DataFrame:
    """``word, c``: every word of ``doc_id, text`` and how often training texts have it.

    Words of held-out texts alone have count zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained, seen = Counter(), set()

        def flush() -> pa.RecordBatch:
            words = [*trained, *seen.difference(trained)]
            counts = [*trained.values(), *[0] * (len(words) - len(trained))]
            trained.clear()
            seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["word", "c"]
            )

        for batch in batches:
            for part in slices(batch, "text"):
                out = part.column("held_out").to_pylist()
                for text, held in zip(as_bytes(part.column("text")), out):
                    words = text.as_py().lower().split()
                    (seen if held else trained).update(words)
                if len(trained) + len(seen) > OPEN_WORDS:
                    yield flush()
        if trained or seen:
            yield flush()

    texts = docs.select("text", held_out(F.col("doc_id")).alias("held_out"))
    return texts.mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _piece_counts(words: DataFrame, vocabulary: Vocabulary, log_probs: np.ndarray) -> np.ndarray:
    """Expected counts of all pieces over the training words.

    One row per piece comes to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, sums = Lattice(vocabulary, log_probs), [0.0] * vocabulary.size
        for batch in batches:
            for word, c in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist()):
                lattice.expect(word, c, sums)
        used = np.flatnonzero(sums).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(np.array(sums)[used])], ["piece", "expected"]
        )

    expected = words.filter("c > 0").select("word", "c").mapInArrow(run, "piece int, expected double")
    result = np.zeros(vocabulary.size)
    for r in expected.groupBy("piece").agg(F.sum("expected").alias("n")).collect():
        result[r["piece"]] = r["n"]
    return result


def fit(
    words: DataFrame, texts: int, vocabulary: Vocabulary, rounds: int = EM_ROUNDS
) -> tuple[np.ndarray, float]:
    """Log probabilities of the pieces, and of the end, learned from ``texts`` training texts."""
    log_probs = starting_weights(vocabulary)
    usable = np.isfinite(log_probs)
    end = math.log(0.5)
    for _ in range(rounds):
        counts = _piece_counts(words, vocabulary, log_probs) + SMOOTHING * usable
        total = counts.sum() + texts + SMOOTHING
        log_probs = _logs(counts / total)
        end = math.log((texts + SMOOTHING) / total)
    return log_probs, end


# Scoring --------------------------------------------------------------------------


def score_words(words: DataFrame, vocabulary: Vocabulary, log_probs: np.ndarray) -> DataFrame:
    """``word, c, logp``: each distinct word's log10 probability, computed once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(vocabulary, log_probs)
        for batch in batches:
            scores = [lattice.log_probability(w) / _LN10 for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("c"), pa.array(scores, pa.float64())],
                ["word", "c", "logp"],
            )

    return words.select("word", "c").mapInArrow(run, "word string, c long, logp double")


_PARTS = (
    "hash long, held_out boolean, n_tokens long, n_known long, base double, score double, "
    "rare array<struct<word: string, n: long>>"
)


def _score_frequent(docs: DataFrame, head: pa.Table, denominator: float) -> DataFrame:
    """Sums over each text's frequent words, and its other words with their counts."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    words = as_bytes(head["word"]).to_pylist()
    counts, logps = head["c"].to_pylist(), head["logp"].to_pylist()
    table = {
        w: (math.log10((c + 1) / denominator), p, c > 0) for w, c, p in zip(words, counts, logps)
    }
    shipped = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shipped.value.get
        for batch in batches:
            for part in slices(batch, "text"):
                sums, rare, counts, offsets = [], [], [], [0]
                for text in as_bytes(part.column("text")):
                    tokens = text.as_py().lower().split()
                    base = score = 0.0
                    known = 0
                    for word, n in Counter(tokens).items():
                        found = get(word)
                        if found is None:
                            rare.append(word)
                            counts.append(n)
                        else:
                            base += n * found[0]
                            score += n * found[1]
                            known += n * found[2]
                    sums.append((len(tokens), known, base, score))
                    offsets.append(len(rare))
                columns = list(zip(*sums))
                entries = pa.StructArray.from_arrays(
                    [pa.array(rare, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())],
                    ["word", "n"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("doc_id", "hash", "held_out")),
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int64()),
                        pa.array(columns[2], pa.float64()),
                        pa.array(columns[3], pa.float64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries),
                    ],
                    ["doc_id", "hash", "held_out", "n_tokens", "n_known", "base", "score", "rare"],
                )

    keyed = docs.select(
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"),
        held_out(F.col("doc_id")).alias("held_out"),
        "text",
    )
    return keyed.mapInArrow(run, f"doc_id {id_type}, {_PARTS}")


def _frequent(words: DataFrame, head_words: int) -> DataFrame:
    """The most frequent short words, at most ``head_words``.

    A step is an eighth of a doubling of the count; the words of as many upper
    steps are taken as fit.  That needs a few hundred counts and no sort.
    """
    stepped = words.filter(F.octet_length("word") <= HEAD_WORD_BYTES).withColumn(
        "step", F.floor(8 * F.log2(F.col("c") + 1))
    )
    room, lowest = head_words, None
    steps = stepped.groupBy("step").agg(F.count(F.lit(1)).alias("n")).collect()
    for r in sorted(steps, key=lambda r: -r["step"]):
        room -= r["n"]
        if room < 0:
            break
        lowest = r["step"]
    return stepped.filter(F.lit(False) if lowest is None else F.col("step") >= lowest).drop("step")


def score_documents(
    docs: DataFrame,
    path: str | None = None,
    rounds: int = EM_ROUNDS,
    head_words: int = HEAD_WORDS,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    vocabulary = load(path or vocabulary_path())
    docs = docs.select("doc_id", "text")
    counted = settle(count_words(docs), "word-counts")
    totals = counted.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.count_if(F.col("c") > 0).alias("v"),
        F.count(F.lit(1)).alias("words"),
    ).first()
    # Every training text ends once.
    texts = docs.filter(~held_out(F.col("doc_id"))).count()
    train_tokens = totals["n"] + texts
    denominator = train_tokens + (totals["v"] + (texts > 0) + 1)
    spread = counted.repartition(1 + totals["words"] // TASK_WORDS)
    log_probs, end = fit(spread, texts, vocabulary, rounds)
    words = settle(score_words(spread, vocabulary, log_probs), "word-scores")

    head = _frequent(words, head_words).toArrow()
    parts = settle(_score_frequent(docs, head, float(denominator)), "scored-frequent")
    rare = (
        parts.select("doc_id", "hash", F.inline("rare"))
        .join(words, "word")
        .groupBy("doc_id", "hash")
        .agg(
            F.sum(F.col("n") * F.log10((F.col("c") + 1) / F.lit(float(denominator)))).alias("rare_base"),
            F.sum(F.col("n") * F.col("logp")).alias("rare_score"),
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        )
    )
    # Rows that repeat id and text all added to one sum.
    same = parts.groupBy("doc_id", "hash").agg(F.count(F.lit(1)).alias("same"))
    both = null_safe_join(
        null_safe_join(parts.drop("rare"), same, ["doc_id", "hash"], "inner"), rare, ["doc_id", "hash"], "left"
    )
    none = F.lit(0.0)
    end_base = math.log10((texts + 1) / denominator)
    return both.select(
        "doc_id",
        "held_out",
        (F.col("n_tokens") + 1).alias("n_tokens"),
        (
            F.col("n_known") + F.coalesce(F.col("rare_known") / F.col("same"), none) + int(texts > 0)
        ).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce(F.col("rare_base") / F.col("same"), none) + end_base).alias("base_score"),
        (F.col("score") + F.coalesce(F.col("rare_score") / F.col("same"), none) + end / _LN10).alias("score"),
    )
