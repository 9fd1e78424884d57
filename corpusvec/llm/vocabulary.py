"""The pieces and scores of a public subword vocabulary.

The file stays where it is; its path is a parameter, read on the driver from
``CORPUSVEC_PIECES`` or the default, and the pieces travel with the tasks.  They
are as many as the vocabulary has, whatever the corpus.
"""

from __future__ import annotations

import math
import os
from dataclasses import dataclass
from functools import cache

PATH_VARIABLE = "CORPUSVEC_PIECES"
DEFAULT_PATH = "/opt/tokenizers/piece_bpe_32k.model"

# Fixed value: stands for a blank inside pieces.
MARK = "▁"

# The file's scores are minus the rank of a merge and do not add up.  Additive ones are
# the logarithm of a weight, 1 / (rank + RANK_OFFSET), less PIECE_COST for every piece.
RANK_OFFSET = 10.0
PIECE_COST = 4.0
# Scores below PLACED belong to pieces that the file keeps out of the ranking, all of them
# runs of marks.  The model merges them last, so each mark costs more than any piece.
PLACED = -1e8
MARK_COST = 30.0
# Bytes spell what no piece does; each costs this much more than the worst placed piece.
BYTE_PENALTY = 10.0
# Scores are multiples of this: finer than what two ranks differ by, and sums over a text,
# which has at most 2 ** 31 bytes, are exact.
STEP = 2.0**-17


@dataclass(frozen=True)
class Vocabulary:
    """``pieces`` maps a string to its id and additive score; ``file_scores`` an id to the
    file's score; ``byte_ids`` a byte to its piece."""

    pieces: dict[str, tuple[int, float]]
    file_scores: dict[int, float]
    byte_ids: tuple[int, ...]
    byte_score: float
    size: int
    longest: int

    def texts(self) -> dict[int, str]:
        return {i: piece for piece, (i, _) in self.pieces.items()}


def vocabulary_path() -> str:
    return os.environ.get(PATH_VARIABLE, DEFAULT_PATH)


def additive(piece: str, score: float, size: int) -> float:
    """The additive score of a piece of a file of ``size`` pieces."""
    if score > PLACED:
        found = -math.log(RANK_OFFSET - score) - PIECE_COST
    else:
        found = -math.log(RANK_OFFSET + size) - PIECE_COST - MARK_COST * len(piece)
    return round(found / STEP) * STEP


@cache
def load(path: str) -> Vocabulary:
    """Pieces, scores and byte pieces of a SentencePiece model file.

    No piece may have a mark behind another character, so that a text can be
    cut in front of every run of marks; a vocabulary without that is refused, as
    is one without byte pieces, which could not spell every text.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces, file_scores, bytes_found = {}, {}, {}
    for i in range(len(model)):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            bytes_found[int(piece[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} has a blank inside")
            file_scores[i] = model.get_score(i)
            pieces[piece] = (i, additive(piece, file_scores[i], len(model)))
    if len(bytes_found) != 256:
        raise ValueError("the vocabulary has no piece for every byte")
    byte_score = min(s for i, s in pieces.values() if file_scores[i] > PLACED) - BYTE_PENALTY
    byte_ids = tuple(bytes_found[b] for b in range(256))
    return Vocabulary(pieces, file_scores, byte_ids, byte_score, len(model), max(map(len, pieces)))
