r"""Periodic runs: stretches of words that repeat with one period, and the texts without the repetitions.

Words are `[^\x20\x09-\x0D]+`. The contract plants repetitions: with h the crc32 of the decimal id and
g = h // 10, where 10 divides h each word i >= a becomes word a + (i - a) % p, a = g % n,
p = 1 + (n - a) // (3 + g % 8). A run is a stretch of words with smallest period q, of max(12, 2q)
words or more, that can't be made longer on either side. A word is dropped if it stands in a run after the run's first
q words.

Online dyadic square catching: words are appended, and every completed block of 2**k of them gets a catcher,
which waits for the block's words to come again 2**(k+1) - 1 to 2**(k+2) - 2 words further on, and expires
then. The first half of a square of such a period holds a whole block of that size, so no square is missed. An
append compares the suffixes that it completes with the catchers that are alive, all catchers of a size
at once; what it catches for a period in neighbouring blocks is one stretch, is extended on both sides by halving steps, and stays
open while it reaches the last word. Stretches of two periods or more are runs; of several periods of one
stretch the smallest counts.

Words are numbered by a dictionary, so equal numbers are equal words. Blocks are compared by 64-bit
numbers made from their halves' numbers. The documents of a batch are one stream, with a word of its own between two of them. Work and memory
grow as n log n with the words of a batch, whatever they repeat.

Defined results: null and blank texts have no words, no runs and the digests of nothing; rows that repeat
get a row each; a null id counts as the largest long and comes out null.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm import common as C

LEAST = 12
#: a stream of documents is closed after so many words
STREAM = 65_536
#: the largest step by which stretches are extended, as a power of two
KEPT = 10
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Catchers:
    """The runs of a growing sequence of numbers."""

    def __init__(self) -> None:
        self.n = 0
        self._words = np.empty(0, np.int64)
        self._blocks: list[np.ndarray] = []  # per k, a number for the 2**k words from each place on
        self._known: list[int] = []  # and for how many places
        self._found: dict[tuple[int, int], int] = {}
        self._open = np.empty((3, 0), np.int64)  # start, end, period of stretches that reach the last word

    def append(self, words: np.ndarray, longest: int | None = None) -> None:
        """Words are added; no run is longer than `longest`, if that is known."""
        before, self.n = self.n, self.n + len(words)
        self._words = _grown(self._words, before, words)
        limit, known = min(self.n, longest or self.n), []
        while 2 * ((2 << len(known)) - 1) <= limit:
            known.append(self._complete(len(known)))
        caught = [self._caught(k, place) for k, place in enumerate(known)]
        open_ = self._open
        if open_.shape[1]:
            caught.append(np.stack([open_[0], self._extended(open_[1], open_[2], +1), open_[2]]))
        stretches = np.concatenate(caught, axis=1) if caught else open_
        self._open = np.unique(stretches[:, stretches[1] == self.n], axis=1)
        self._merge(stretches[:, stretches[1] < self.n])

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, end, period) of all runs so far, by start, then period."""
        closed = dict(self._found)
        self._merge(self._open)
        found, self._found = self._found, closed
        return sorted(((a, b, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))

    def _merge(self, stretches: np.ndarray) -> None:
        """Stretches long enough are runs; of several periods the smallest is the run's."""
        length = stretches[1] - stretches[0]
        for a, b, q in stretches[:, length >= np.maximum(LEAST, 2 * stretches[2])].T.tolist():
            if q < self._found.get((a, b), q + 1):
                self._found[a, b] = q

    def _complete(self, k: int) -> int:
        """Numbers the blocks of 2**k words that are whole now; gives the first place that had none."""
        if k == len(self._blocks):
            self._blocks.append(np.empty(0, np.uint64))
            self._known.append(0)
        known, self._known[k] = self._known[k], self.n - (1 << k) + 1
        if k == 0:
            fresh = C.mixed((self._words[known:self.n].astype(np.uint64) + np.uint64(1)) * _ODD)
        else:
            half, below = 1 << (k - 1), self._blocks[k - 1]
            fresh = C.mixed(below[known:self.n - 2 * half + 1] * _ODD + below[known + half:self.n - half + 1])
        self._blocks[k] = _grown(self._blocks[k], known, fresh)
        return known

    def _caught(self, k: int, known: int) -> np.ndarray:
        """The stretches (start, end, period) caught by blocks of 2**k words when blocks from `known` on came in."""
        size, blocks = 1 << k, self._blocks[k]
        end = self.n - size + 1  # places of whole blocks
        first = max(0, -(-(known - 4 * size + 2) // size))
        last = (end - 2 * size) // size  # the last block with a place to look at
        if last < first:
            return np.empty((3, 0), np.int64)
        need = last * size + 4 * size - 1
        if need > len(blocks):
            blocks = self._blocks[k] = np.concatenate([blocks, np.zeros(need - len(blocks), np.uint64)])
        ahead = np.lib.stride_tricks.as_strided(blocks[first * size + 2 * size - 1:], (2 * size, last - first + 1),
                                                (8, 8 * size), writeable=False)
        further, block = np.nonzero(ahead == blocks[first * size:last * size + 1:size])
        start, period = (block + first) * size, further + 2 * size - 1
        fresh = (start + period >= known) & (start + period < end)
        start, period = start[fresh], period[fresh]
        if not len(start):
            return np.empty((3, 0), np.int64)
        # hits come by period, then place: neighbours with one period are one stretch
        opens = np.concatenate([[True], (period[1:] != period[:-1]) | (start[1:] != start[:-1] + size)])
        closes = np.concatenate([opens[1:], [True]])
        q = period[opens]
        left = self._extended(start[opens], q, -1)
        right = self._extended(start[closes] + size + q, q, +1)
        return np.unique(np.stack([left, right, q]), axis=1)

    def _extended(self, at: np.ndarray, period: np.ndarray, way: int) -> np.ndarray:
        """How far stretches go on: to the right from the end `at`, or to the left from the start `at`."""
        at = at.copy()
        k = top = min(KEPT, len(self._blocks) - 1)
        while k >= 0:
            size, blocks = 1 << k, self._blocks[k]
            if way > 0:
                on = np.flatnonzero(at + size <= self.n)
                on = on[blocks[at[on]] == blocks[at[on] - period[on]]]
            else:
                on = np.flatnonzero(at >= size)
                on = on[blocks[at[on] - size] == blocks[at[on] - size + period[on]]]
            at[on] += way * size
            if k < top or not len(on):
                k -= 1
        return at


def _grown(have: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """`more` behind the first `used` entries; room doubles, so that single words may be appended."""
    need = used + len(more)
    if need > len(have):
        room = np.zeros(max(need, 2 * used), more.dtype)
        room[:used] = have[:used]
        have = room
    have[used:need] = more
    return have


def planted(key: int, n: int) -> tuple[int, int] | None:
    """(a, p): from word a on a document of n words repeats its next p words."""
    g, rest = divmod(zlib.crc32(b"%d" % key), 10)
    if rest or not n:
        return None
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _words(key: int, text: str | None) -> list[bytes]:
    words = (text or "").encode().split()
    if change := planted(key, len(words)):
        a, p = change
        unit, rest = words[a:a + p], len(words) - a
        words[a:] = (unit * -(-rest // p))[:rest]
    return words


def _row(key: int, words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """The digest columns of a document, from its runs (start, end, period)."""
    best = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    longest = (None, None, None, None)
    if best:
        length = best[1] - best[0]
        longest = best[0], length, best[2], 1000 * length // best[2]
        words = _kept(words, runs)
    listed = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs)
    return (key, len(runs), *longest, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(words)).hexdigest(), [list(r) for r in runs], len(words))


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that stand in no run behind its first period."""
    kept = bytearray(b"\x01") * len(words)
    for a, b, q in runs:
        kept[a + q:b] = bytes(b - a - q)
    return [w for w, keep in zip(words, kept, strict=True) if keep]


def _streams(batch: dict[str, list]) -> Iterator[tuple]:
    """The rows of a batch, from streams of whole documents."""
    held: list[tuple[int, list[bytes]]] = []
    size = 0
    for key, text in zip(batch["id"], batch["text"], strict=True):
        words = _words(key, text)
        held.append((key, words))
        size += len(words) + 1
        if size >= STREAM:
            yield from _stream(held)
            held, size = [], 0
    yield from _stream(held)


def _stream(held: list[tuple[int, list[bytes]]]) -> Iterator[tuple]:
    numbers: dict[bytes, int] = {}
    ids: list[int] = []
    for k, (_, words) in enumerate(held):
        ids += [numbers.setdefault(w, len(numbers)) for w in words]
        ids.append(-1 - k)  # a word that stands nowhere else
    catchers = Catchers()
    catchers.append(np.array(ids, np.int64), max((len(w) for _, w in held), default=0))
    runs, at, start = catchers.runs(), 0, 0
    for key, words in held:
        own = []
        while at < len(runs) and runs[at][0] < start + len(words):
            a, b, q = runs[at]
            own.append((a - start, b - start, q))
            at += 1
        yield _row(key, words, own)
        start += len(words) + 1


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: its runs (start, end, period), the longest of them, and digests of all and of the kept words."""
    found = C.map_rows(C.keyed(docs).select("id", "text"), _streams,
                       "id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
                       "runs_sha256 string, collapsed_sha256 string, runs array<array<bigint>>, n_kept bigint")
    return found.select(C.true_id(), *found.columns[1:])


def collapsed(docs: DataFrame) -> DataFrame:
    """`docs` with one period left of every run: the kept words of a text joined by one space. Nothing is planted,
    and texts without runs stay as they are."""
    def text_of(text: str | None) -> str | None:
        words = (text or "").encode().split()
        runs = _runs(words)
        return b" ".join(_kept(words, runs)).decode() if runs else text

    @F.pandas_udf("string")
    def texts(part: pd.Series) -> pd.Series:
        return pd.Series([text_of(t) for t in part], dtype=object)

    return docs.withColumn("text", texts(docs["text"]))


def _runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    numbers: dict[bytes, int] = {}
    catchers = Catchers()
    catchers.append(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64))
    return catchers.runs()
