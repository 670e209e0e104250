r"""Pieces of a published vocabulary, units of text, and the best segmentation of a unit.

A blank stands where the vocabulary writes the mark U+2581, and a text is taken with one blank before it.
It falls into units: blanks and the word they precede, blanks alone, a line feed. No piece reaches over
the edge of a unit, so the best segmentation of a text is that of its units one after the other. Units
are cut after `MAX_UNIT` characters, which bounds the work on a text without blanks.

The best segmentation has the greatest sum of piece scores; of two equal ones, that whose last piece is
longer, at every place. A character that no piece covers becomes one token for each of its bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
MAX_UNIT, MAX_BLANKS = 256, 64
_WORST, _SCORE = float("-inf"), ""
#: the same pattern is used by Spark and by Python
UNIT = rf" {{0,{MAX_BLANKS}}}[^ \n]{{1,{MAX_UNIT}}}| {{1,{MAX_BLANKS}}}|\n"
units = re.compile(UNIT).findall


@dataclass
class Pieces:
    """A vocabulary: what a task needs to segment units. A few megabytes."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    size: int
    longest: int = field(init=False)
    unknown: float = field(init=False)
    _root: dict | None = field(init=False, default=None, repr=False)

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = min(self.scores.values(), default=0.0) - 10.0

    def byte_tokens(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()]

    def segment(self, unit: str) -> tuple[int, ...]:
        """The ids of the unit's best segmentation.

        Places are settled from left to right. Of equal scores at a place the one that came first stays,
        which began earliest: it has the longer last piece.
        """
        n, unknown, root = len(unit), self.unknown, self._tree()
        best, back = [0.0] + [_WORST] * n, [0] * (n + 1)
        for start in range(n):
            score, node, end = best[start], root, start
            for char in unit[start:start + self.longest]:
                node = node.get(char)
                if node is None:
                    break
                end += 1
                piece = node.get(_SCORE)
                if piece is not None and score + piece > best[end]:
                    best[end], back[end] = score + piece, start
            if score + unknown > best[start + 1]:
                best[start + 1], back[start + 1] = score + unknown, start
        out: list[int] = []
        while n:
            piece = unit[back[n]:n]
            known = self.ids.get(piece)
            out.extend(reversed(self.byte_tokens(piece)) if known is None else (known,))
            n = back[n]
        return tuple(reversed(out))

    def _tree(self) -> dict:
        """The pieces by their characters; a node has its piece's score under a key that is no character."""
        if self._root is None:
            self._root = {}
            for piece, score in self.scores.items():
                node = self._root
                for char in piece:
                    node = node.setdefault(char, {})
                node[_SCORE] = score
        return self._root

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_root": None}  # grown again where it is needed


class Segments:
    """Best segmentations of many units, as `Pieces.segment` has them; ids are packed, four bytes each.

    What is best up to a place depends on the characters before it alone. So units are taken in sorted order, and
    places of the prefix that a unit shares with the one before it are settled already.
    """

    def __init__(self, known: Pieces) -> None:
        self._known = known
        self.places = 0
        # the pieces by their characters from last to first: (score, packed id, longer ones) of each character
        self._root: dict[str, list] = {}
        for piece, score in known.scores.items():
            node = self._root
            for char in reversed(piece):
                step = node.setdefault(char, [_WORST, b"", {}])
                node = step[2]
            step[:2] = score, packed((known.ids[piece],))

    def of(self, units: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """(unit, packed ids) of distinct units. Of equal scores at a place the longer last piece counts."""
        known, root, unknown = self._known, self._root, self._known.unknown
        best, ids, before = [0.0], [b""], ""
        for unit in sorted(units):
            n, shared, limit = len(unit), 0, min(len(before), len(unit))
            while shared < limit and before[shared] == unit[shared]:
                shared += 1
            del best[shared + 1:], ids[shared + 1:]
            for end in range(shared, n):
                top, node, last = best[end] + unknown, root, None
                for start in range(end, -1, -1):
                    step = node.get(unit[start])
                    if step is None:
                        break
                    score, piece, node = step
                    score += best[start]
                    if score >= top:
                        top, at, last = score, start, piece
                best.append(top)
                ids.append(ids[end] + packed(known.byte_tokens(unit[end])) if last is None else ids[at] + last)
            self.places += n - shared
            before = unit
            yield unit, ids[n]


def packed(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, dtype=np.int32).tobytes()


def load(path: str = MODEL) -> Pieces:
    """Reads a vocabulary file with its library; control and unknown pieces take no part."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, scores, byte_ids = {}, {}, [0] * 256
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            text = piece.replace(MARK, " ")
            ids[text], scores[text] = i, float(model.get_score(i))
    return Pieces(ids, scores, byte_ids, model.vocab_size())


def units_of(text: str) -> list[str]:
    """The units of a text; a mark that stands in the text itself is no blank and no piece covers it."""
    return units(f" {text}") if text else []
