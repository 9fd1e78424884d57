"""SentencePiece encoding by a max-plus parallel scan, and decoding.

The encoding of a text is the segmentation into vocabulary pieces with the highest
sum of scores (Viterbi).  The scores are log weights made from the vocabulary's ranks;
the vocabulary's own encoder merges by rank instead, and now and then finds other pieces.
As there, a text that is not empty has one blank put ahead, which decoding takes off.
A character that is no piece is spelt in byte pieces, so there always is an encoding,
and decoding gives back the very text.

A document is cut into chunks of ``chunk_chars``, so one giant document is the work
of many tasks.  A piece may reach over a chunk's end by less than the longest
piece, so a boundary has a state: how far the piece across it reaches.  A chunk's
transfer matrix has the best score from each state at its start to each state at
its end.  Combining two matrices takes the maximum over the state between them of
the sums; that is associative, so blocks of chunks are combined in parallel, then
the blocks, which gives the best score into every block.  From the end back, blocks
pick the states on the best path, and then the chunks inside every block do; after
that every chunk is traced back by itself.

No piece of the vocabulary has a blank behind another character, so no piece
reaches over the front of a run of blanks.  Between two such cuts the best pieces are
independent of all else; a task works them out once per distinct stretch.  A chunk
without any cut is computed in full.  Scores are multiples of one small step, so sums
are exact; between equal sums a stretch takes the longer last piece, a boundary the
shorter reach.

A chunk is at most 2 ** 31 / ``chunk_chars`` of a document's, since a string has no more
characters, and a block has ``BLOCK`` of them: no group of the scan can be larger than
the two bounds say.

NULL and empty texts have one chunk without pieces, and decode to the empty text.
Rows are told apart by ``doc_id`` and text; rows that repeat both are encoded alike,
each on its own.  Other columns take no part.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.vocabulary import MARK, Vocabulary, load, vocabulary_path
from corpusvec.session import settle

CHUNK_CHARS = 1 << 16
BLOCK = 256
# Distinct stretches a task remembers, and how long they may be.
CACHE, CACHE_CHARS = 300_000, 64
# Chunks of a text that are handed on at a time.
_CHUNKS_AT_ONCE = 64

_NONE = -np.inf
# Takes the place of a literal mark in a text, which is no blank; no piece has it.
# Half of a surrogate pair is in no UTF-8 text, so no text is changed by it.
HIDDEN_MARK = "\ud800"


def marked(text: str) -> str:
    """A whole text as pieces see it: one blank is put ahead, and blanks are marks."""
    return _as_marks(f" {text}" if text else "")


def _as_marks(text: str) -> str:
    return text.replace(MARK, HIDDEN_MARK).replace(" ", MARK)


# What lies between cuts: a run of marks and what follows it up to the next run.
_STRETCH = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class _Memory(dict):
    """Results per stretch, worked out when first asked for."""

    def __init__(self, work: Callable[[str], object]):
        self.work = work

    def __missing__(self, text: str) -> object:
        found = self.work(text)
        if len(text) <= CACHE_CHARS:
            if len(self) >= CACHE:
                self.clear()
            self[text] = found
        return found


class Encoder:
    """Best segmentations of strings over one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.single = {p for p in vocabulary.pieces if len(p) == 1}
        # A tree of pieces: next character to (what may follow, id or -1, score).
        self.root: dict = {}
        for piece in sorted(vocabulary.pieces):
            below = self.root
            for character in piece[:-1]:
                below = below.setdefault(character, ({}, -1, 0.0))[0]
            below[piece[-1]] = (below.get(piece[-1], ({},))[0], *vocabulary.pieces[piece])
        self.vocabulary = vocabulary
        self.states = vocabulary.longest
        # Ids of a stretch as 32-bit integers, and its score.
        self.ids = _Memory(lambda text: array("i", self.path(text, 0, len(text))[1]).tobytes())
        self.scores = _Memory(lambda text: self.path(text, 0, len(text))[0])
        self.spelt: dict[str, tuple[float, list[int]]] = {}

    def spell(self, character: str) -> tuple[float, list[int]]:
        """Score and ids of a character in byte pieces."""
        found = self.spelt.get(character)
        if found is None:
            plain = {MARK: " ", HIDDEN_MARK: MARK}.get(character, character)
            ids = [self.vocabulary.byte_ids[b] for b in plain.encode()]
            found = self.spelt[character] = (len(ids) * self.vocabulary.byte_score, ids)
        return found

    def path(self, text: str, start: int, end: int) -> tuple[float, list[int]]:
        """Best score and ids from one position to another."""
        text = text[start:end]
        n, root = len(text), self.root
        score, back = [0.0] + [_NONE] * n, [0] * (n + 1)
        used: list[int | list[int]] = [0] * (n + 1)
        for i in range(n):
            here = score[i]
            below, j = root, i
            for character in text[i : i + self.states]:
                node = below.get(character)
                if node is None:
                    break
                j += 1
                below, piece, worth = node
                if piece >= 0:
                    total = here + worth
                    if total > score[j]:
                        score[j], back[j], used[j] = total, i, piece
            if text[i] not in self.single:
                cost, ids = self.spell(text[i])
                if here + cost > score[i + 1]:
                    score[i + 1], back[i + 1], used[i + 1] = here + cost, i, ids
        found: list[int] = []
        j = n
        while j:
            piece = used[j]
            if type(piece) is int:
                found.append(piece)
            else:
                found += reversed(piece)
            j = back[j]
        found.reverse()
        return score[n], found

    def cuts(self, text: str, end: int) -> list[int]:
        """Positions before ``end`` in front of a run of marks."""
        found, at = [], text.find(MARK, 1)
        while 0 <= at < end:
            if text[at - 1] != MARK:
                found.append(at)
            at = text.find(MARK, at + 1)
        return found

    def spread(self, text: str, start: int, end: int) -> np.ndarray:
        """Best scores from ``start`` to each of the next ``states`` positions at or after ``end``.

        A piece may begin before ``end`` only, and its end is where the next chunk begins.
        """
        n = end - start
        scores = np.full(n + self.states, _NONE)
        scores[0] = 0.0
        for i in range(n):
            here = scores[i]
            if here == _NONE:
                continue
            below, j = self.root, i
            for character in text[start + i : start + i + self.states]:
                node = below.get(character)
                if node is None:
                    break
                j += 1
                below, piece, worth = node
                if piece >= 0 and here + worth > scores[j]:
                    scores[j] = here + worth
            if text[start + i] not in self.single:
                scores[i + 1] = max(scores[i + 1], here + self.spell(text[start + i])[0])
        return scores[n : n + self.states]

    def transfer(self, text: str, size: int) -> np.ndarray:
        """The matrix of a chunk of ``size`` characters; ``text`` has what follows as well."""
        n = self.states
        matrix = np.full((n, n), _NONE)
        cuts = self.cuts(text, size)
        if cuts:
            into = np.full(n, _NONE)
            for i in range(min(n, cuts[0] + 1)):
                into[i] = self.path(text, i, cuts[0])[0]
            middle = sum([self.scores[text[a:b]] for a, b in zip(cuts, cuts[1:])])
            return (into + middle)[:, None] + self.spread(text, cuts[-1], size)[None, :]
        for i in range(min(n, size + 1)):
            matrix[i] = self.spread(text, i, size)
        for i in range(size + 1, n):
            matrix[i, i - size] = 0.0
        return matrix

    def trace(self, text: str, size: int, start: int, reach: int) -> bytes:
        """The ids of a chunk between two states, as 32-bit integers.

        Both ends are on the path, so the stretches between them stand alone.
        """
        return b"".join(map(self.ids.__getitem__, _STRETCH.findall(text[start : size + reach])))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product: the best sum over the state in between."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def states_of(matrices: list[np.ndarray], start: np.ndarray, end: int) -> list[int]:
    """The state in front of each matrix on the best path from ``start`` to state ``end``.

    ``start`` has the best score into each state; the path is picked from the end back.
    """
    into = [start]
    for m in matrices[:-1]:
        into.append((into[-1][:, None] + m).max(axis=0))
    picked, state = [], end
    for before, m in zip(reversed(into), reversed(matrices)):
        state = int(np.argmax(before + m[:, state]))
        picked.append(state)
    return picked[::-1]


# Chunks ----------------------------------------------------------------------------


def _texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, text``: every text with the blank ahead of it."""
    text = F.coalesce("text", F.lit(""))
    ahead = F.when(text == "", text).otherwise(F.concat(F.lit(" "), text))
    return docs.select("doc_id", F.sha2(text.cast("binary"), 256).alias("text_key"), ahead.alias("text"))


def whole_texts(docs: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """The texts that are one chunk; see ``cut_texts``."""
    texts = _texts(docs)
    return texts.filter(F.length("text") <= chunk_chars).select(
        "doc_id",
        "text_key",
        F.lit(0).alias("chunk"),
        F.lit(0).alias("last"),
        F.length("text").alias("size"),
        F.col("text").alias("body"),
    )


def cut_texts(docs: DataFrame, states: int, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``doc_id, text_key, chunk, last, size, body``: the chunks of the texts that have several.

    ``body`` is a chunk with the characters that a piece may reach into.  The blank ahead
    of the text is a character of the first chunk.  A text is walked once, and its chunks
    are dealt out, so that one giant text is the work of many tasks.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "text_key", "chunk", "last", "size", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                text = one.column("text")[0].as_py()
                starts = range(0, len(text), chunk_chars)
                for first in range(0, len(starts), _CHUNKS_AT_ONCE):
                    some = starts[first : first + _CHUNKS_AT_ONCE]
                    same = pa.array(np.zeros(len(some), np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            one.column("doc_id").take(same),
                            one.column("text_key").take(same),
                            pa.array(range(first, first + len(some)), pa.int32()),
                            pa.array([len(starts) - 1] * len(some), pa.int32()),
                            pa.array([min(chunk_chars, len(text) - at) for at in some], pa.int32()),
                            pa.array([text[at : at + chunk_chars + states] for at in some], pa.string()),
                        ],
                        columns,
                    )

    schema = f"doc_id {id_type}, text_key string, chunk int, last int, size int, body string"
    long = _texts(docs).filter(F.length("text") > chunk_chars)
    return long.select("doc_id", "text_key", "text").mapInArrow(run, schema).repartition("text_key", "chunk")


_KEY = ["doc_id", "text_key"]


def _matrices(long: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, text_key, chunk, last, matrix`` of the chunks of documents of several."""
    id_type = long.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            found = [
                encoder.transfer(_as_marks(body), size).tobytes()
                for body, size in zip(batch.column("body").to_pylist(), batch.column("size").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (*_KEY, "chunk", "last")), pa.array(found, pa.binary())],
                [*_KEY, "chunk", "last", "matrix"],
            )

    schema = f"doc_id {id_type}, text_key string, chunk int, last int, matrix binary"
    return long.mapInArrow(run, schema)


def _read(matrix: bytes, states: int) -> np.ndarray:
    return np.frombuffer(matrix).reshape(states, states)


def _only(state: int, states: int) -> np.ndarray:
    """Scores that leave one state open."""
    scores = np.full(states, _NONE)
    scores[state] = 0.0
    return scores


def scan(matrices: DataFrame, states: int, block: int = BLOCK) -> DataFrame:
    """``doc_id, text_key, chunk, start, reach``: the states of each chunk on the best path.

    Two levels: blocks of chunks are combined to one matrix each; a document's
    blocks get their scores from the front and their states from the back; then
    every block does the same for its chunks.
    """
    id_type = matrices.schema["doc_id"].dataType.simpleString()
    blocked = settle(
        matrices.dropDuplicates([*_KEY, "chunk"]).withColumn("block", F.floor(F.col("chunk") / block).cast("int")),
        "transfer",
    )

    def fold(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        all_matrices = [_read(m, states) for m in table["matrix"].to_pylist()]
        product = all_matrices[0]
        for m in all_matrices[1:]:
            product = combine(product, m)
        one = table.slice(0, 1).select([*_KEY, "block"])
        return one.append_column("matrix", pa.array([product.tobytes()], pa.binary()))

    products = blocked.groupBy(*_KEY, "block").applyInArrow(
        fold, f"doc_id {id_type}, text_key string, block int, matrix binary"
    )

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        products = [_read(m, states) for m in table["matrix"].to_pylist()]
        starts = states_of(products, _only(0, states), 0)
        out = table.select([*_KEY, "block"]).append_column("start", pa.array(starts, pa.int32()))
        return out.append_column("end", pa.array([*starts[1:], 0], pa.int32()))

    placed = settle(
        products.groupBy(*_KEY).applyInArrow(
            place, f"doc_id {id_type}, text_key string, block int, start int, end int"
        ),
        "placed-blocks",
    )

    def pick(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("chunk")
        start, end = right["start"][0].as_py(), right["end"][0].as_py()
        matrices = [_read(m, states) for m in left["matrix"].to_pylist()]
        # Of equally good paths, the one through the states already picked.
        picked = states_of(matrices, _only(start, states), end)
        out = left.select([*_KEY, "chunk"]).append_column("start", pa.array(picked, pa.int32()))
        return out.append_column("reach", pa.array([*picked[1:], end], pa.int32()))

    return (
        blocked.groupBy(*_KEY, "block")
        .cogroup(placed.groupBy(*_KEY, "block"))
        .applyInArrow(pick, f"doc_id {id_type}, text_key string, chunk int, start int, reach int")
    )


# Encoding and decoding ----------------------------------------------------------------


_ENCODED = "chunk int, n_pieces int, ids array<int>"


def _encoded(parts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    id_type = parts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        columns = ("body", "size", "start", "reach")
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                found = [
                    encoder.trace(_as_marks(body), size, start, reach)
                    for body, size, start, reach in zip(*(part.column(c).to_pylist() for c in columns))
                ]
                counts = np.array([len(f) // 4 for f in found], np.int32)
                offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
                values = pa.Array.from_buffers(pa.int32(), int(counts.sum()), [None, pa.py_buffer(b"".join(found))])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("chunk"),
                        pa.array(counts),
                        pa.ListArray.from_arrays(offsets, values),
                    ],
                    ["doc_id", "chunk", "n_pieces", "ids"],
                )

    return parts.select("doc_id", "chunk", *("body", "size", "start", "reach")).mapInArrow(
        run, f"doc_id {id_type}, {_ENCODED}"
    )


def encode(
    docs: DataFrame, path: str | None = None, chunk_chars: int = CHUNK_CHARS, block: int = BLOCK
) -> DataFrame:
    """``doc_id, chunk, n_pieces, ids`` of every row of ``doc_id, text``; a document's ids are
    those of its chunks, in order."""
    vocabulary = load(path or vocabulary_path())
    whole = whole_texts(docs, chunk_chars).withColumns({"start": F.lit(0), "reach": F.lit(0)})
    long = settle(cut_texts(docs, vocabulary.longest, chunk_chars), "text-chunks")
    picked = settle(
        scan(_matrices(long, vocabulary), vocabulary.longest, block), "piece-states"
    ).withColumnsRenamed({"doc_id": "__doc", "text_key": "__key", "chunk": "__chunk"})
    placed = long.join(
        picked,
        F.col("doc_id").eqNullSafe(F.col("__doc"))
        & (F.col("text_key") == F.col("__key"))
        & (F.col("chunk") == F.col("__chunk")),
    ).drop("__doc", "__key", "__chunk")
    return _encoded(whole, vocabulary).union(_encoded(placed, vocabulary))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``text``, the bytes that its ids stand for, as a binary column;
    the first chunk's without the blank put ahead.

    A chunk may end inside a character that is spelt in bytes only if the next one
    goes on with it, so texts are put together from bytes.
    """
    vocabulary = load(path or vocabulary_path())
    spelling = [b""] * vocabulary.size
    for piece, (i, _) in vocabulary.pieces.items():
        spelling[i] = piece.replace(MARK, " ").encode()
    for b, i in enumerate(vocabulary.byte_ids):
        spelling[i] = bytes([b])

    @F.arrow_udf("binary")
    def spell(ids: pa.Array, chunk: pa.Array) -> pa.Array:
        values = ids.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(pc.list_value_length(ids).fill_null(0).to_numpy(zero_copy_only=False)).tolist()
        texts = [
            b"".join(map(spelling.__getitem__, values[a:b].tolist()))[c == 0 :]
            for a, b, c in zip([0, *ends], ends, chunk.to_pylist())
        ]
        return pa.array(texts, pa.binary())

    return encoded.withColumn("text", spell("ids", "chunk"))


def decoded_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` of encoded documents with distinct ids."""
    spelt = decode(encoded, path).groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("chunk", "text"))).alias("chunks")
    )
    joined = F.aggregate("chunks", F.lit("").cast("binary"), lambda all, c: F.concat(all, c["text"]))
    return spelt.select("doc_id", joined.cast("string").alias("text"))
