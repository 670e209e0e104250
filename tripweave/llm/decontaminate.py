"""Benchmark decontamination: finds test items in documents, allowing a budget of character edits.

An item of m characters may differ by `m // CHARS_PER_EDIT` insertions, deletions or substitutions from
a passage of the document. It is split into one piece more than that budget, so a passage within the
budget holds at least one piece unchanged: an automaton over all pieces finds these in one pass over the
text, and the stretches around them are searched with the bit-parallel distance of Myers (1999).
Stretches of one item that overlap are searched as one, so the work stays linear in the text however
often a piece occurs. Case is folded and runs of white space count as one blank.

The benchmark is the query set: it is read in blocks of a bounded size, and each block is sent to all
tasks and held against all documents. Documents are never shuffled.

Items under `MIN_CHARS` characters have no budget: they match where they stand unchanged, from the start of a word to
the end of one.

Defined results: null and blank texts and items match nothing; items with the same text each match; a document repeated in the table is reported as often as it is there.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm import common as C

CHARS_PER_EDIT = 16
MIN_CHARS = 25
#: characters of benchmark text in a block; its automaton takes some 100 bytes for each of them
BLOCK_CHARS = 500_000
#: blocks whose automata a task keeps
HELD = 4


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece): budget + 1 pieces of nearly equal length."""
    cuts = [len(item) * k // (budget + 1) for k in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """An item, searched in texts by Myers' recurrence; one Python integer holds a column."""

    def __init__(self, item: str) -> None:
        self.length = len(item)
        # a short item has to stand there as it is, between blanks
        self.short = self.length < MIN_CHARS
        self.budget = 0 if self.short else self.length // CHARS_PER_EDIT
        self._masks: dict[str, int] = {}
        for k, c in enumerate(item):
            self._masks[c] = self._masks.get(c, 0) | 1 << k

    def distance(self, text: str) -> int:
        """The smallest edit distance between the item and any substring of the text."""
        full, top = (1 << self.length) - 1, 1 << (self.length - 1)
        up, down, score, best = full, 0, self.length, self.length
        get = self._masks.get
        for c in text:
            same = get(c, 0)
            vertical = same | down
            across = (((same & up) + up) ^ up) | same
            plus = down | (full & ~(across | up))
            minus = up & across
            if plus & top:
                score += 1
            elif minus & top:
                score -= 1
                if score < best:
                    best = score
            plus, minus = plus << 1, minus << 1
            up = (minus | ~(vertical | plus)) & full
            down = plus & vertical & full
        return best


    def stands(self, text: str, start: int) -> bool:
        """Whether a short item found at `start` begins and ends with words of the text."""
        end = start + self.length
        return (start == 0 or text[start - 1] == " ") and (end == len(text) or text[end] == " ")


class Block:
    """Some of the benchmark's items, ready to be found in texts."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        import ahocorasick

        self._items = items
        self._patterns = [Pattern(item) for _, item in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, item) in enumerate(items):
            for offset, piece in pieces(item, self._patterns[k].budget):
                places.setdefault(piece, []).append((k, offset))
        self._finder = ahocorasick.Automaton()
        for piece, found in places.items():
            self._finder.add_word(piece, (len(piece), found))
        if places:
            self._finder.make_automaton()

    def found(self, text: str | None, first_only: bool = False) -> list[tuple[int, int, int]]:
        """(item id, distance, budget) of the items in the text."""
        text = normal(text)
        if not self._items or not text:
            return []
        starts: dict[int, set[int]] = {}
        for end, (size, found) in self._finder.iter(text):
            for k, offset in found:
                starts.setdefault(k, set()).add(end + 1 - size - offset)
        out = []
        for k in sorted(starts):
            pattern, best = self._patterns[k], None
            if pattern.short:
                best = 0 if any(pattern.stands(text, a) for a in starts[k]) else None
            for a, b in () if pattern.short else _stretches(sorted(starts[k]), pattern):
                d = pattern.distance(text[max(0, a):b])
                if d <= pattern.budget and (best is None or d < best):
                    best = d
            if best is not None:
                out.append((self._items[k][0], best, pattern.budget))
                if first_only:
                    break
        return out


def _stretches(starts: list[int], pattern: Pattern) -> Iterator[tuple[int, int]]:
    """The places where the item may stand, widened by the budget; overlapping ones are one."""
    a, b = starts[0] - pattern.budget, starts[0] + pattern.length + pattern.budget
    for s in starts[1:]:
        if s - pattern.budget <= b:
            b = s + pattern.length + pattern.budget
        else:
            yield a, b
            a, b = s - pattern.budget, s + pattern.length + pattern.budget
    yield a, b


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items, some half a million characters at a time."""
    items = benchmark.where(benchmark["text"].isNotNull()).select(
        benchmark["item_id"].alias("item_id"), benchmark["text"].alias("text")).distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + chars // block_chars
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        block = [(r["item_id"], normal(r["text"])) for r in rows]
        yield sorted(((i, t) for i, t in block if t), key=repr)


def matches(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, edits, budget): every item that a document holds, with its smallest distance.

    The documents are read once. A task keeps the automata of `HELD` blocks and builds those of further blocks
    anew for each batch of texts, so its memory does not grow with the benchmark.
    """
    sent = docs.sparkSession.sparkContext.broadcast(list(blocks(benchmark, block_chars)))

    def rows(batch: dict[str, list], held: list = []) -> Iterator[tuple]:  # noqa: B006
        if not held:  # once for each task
            held.extend(Block(items) for items in sent.value[:HELD])
        for k, items in enumerate(sent.value):
            block = held[k] if k < HELD else Block(items)
            for key, text in zip(batch["id"], batch["text"], strict=True):
                for item, edits, budget in block.found(text):
                    yield key, item, edits, budget

    found = C.map_rows(docs.select(C.id_of(docs), docs["text"].alias("text")), rows,
                       "id bigint, item_id bigint, edits int, budget int")
    return found.select(C.true_id("id"), "item_id", "edits", "budget")


def clean(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that hold no item, columns unchanged. Texts pass through Python, rows are not moved."""
    for items in blocks(benchmark, block_chars):
        docs = docs.where(~_holds_item(docs.sparkSession.sparkContext.broadcast(items))(docs["text"]))
    return docs


def _holds_item(sent):
    @F.pandas_udf("boolean")
    def holds_item(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        block = Block(sent.value)
        for texts in batches:
            yield pd.Series([bool(block.found(t, first_only=True)) for t in texts], dtype=bool)

    return holds_item
