"""The fixed public vocabulary of text pieces, read from a SentencePiece model file."""

import math
import os
from functools import lru_cache

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # stands for a space at the front of a word


class Vocabulary:
    """Pieces with their ids and log probabilities.

    The file orders its pieces by merge rank and gives no probabilities, so they follow
    Zipf's law by rank: p(rank) = 1 / (rank * sum of 1/k). Byte pieces stand for what no
    piece spells, and only there.
    """

    def __init__(self, path):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.unknown = model.unk_id()
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        total = sum(1 / k for k in range(1, len(plain) + 1))
        order = sorted(plain, key=lambda i: (-model.get_score(i), i))
        self.scores = {self.pieces[i]: -math.log(k * total) for k, i in enumerate(order, 1)}
        self.ids = {self.pieces[i]: i for i in plain}
        self.longest = max(map(len, self.ids))
        # Every ending of a piece: a text that isn't one can't be extended to the left to a piece.
        self.endings = {p[k:] for p in self.ids for k in range(len(p))}


@lru_cache(maxsize=2)
def vocabulary(path=VOCABULARY):
    """The vocabulary of a file, loaded once per Python worker."""
    if not os.path.exists(path):
        raise FileNotFoundError(f"no vocabulary at {path}: it must be on every machine")
    return Vocabulary(path)
