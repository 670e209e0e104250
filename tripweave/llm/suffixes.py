r"""Suffix-array dedup on a sparse suffix array: passages of 50 words or more that documents share.

Of all suffixes of a text (from each word to the end) only those are kept that start at a minimiser: the
8-word run with the smallest hash among 43 neighbouring ones. Every passage of 50 words holds such a
place, and equal passages hold the same. Suffixes whose first run stands in one document only have no
partner and go. The others carry the hashes of the 50 words that follow and of the 42 words before.

They are sorted by run, by what follows, then by what precedes. The nearest partner on either side need
not be the one that shares 50 words, so few suffixes of one run are all compared with one another: the
common words to the right and to the left of the place together are the match. Where a run has many, or
lies at the border of two tasks, every 50-word window around the place gets a 128-bit digest of its word
codes, as far as the neighbours in the order share enough words to the right, and windows of two documents
or more are matches. Every window so found names the other document it was found in: the smallest id among
those that have it, and for the document of that id itself the largest. The windows of a document that follow
one another and name the same document are one passage, which extends it over all its minimisers. Equal windows
have the same minimiser, at which all their documents meet, so the answer does not depend on the partitioning.

The order is a range partitioning with (id, place) as its last key, so any number of equal suffixes is
spread over tasks. Documents with equal word sequences are one, the first, which is compared with the others;
each later one is reported whole, with the first.

Defined results: null and blank texts and texts under 50 words have no passage; repeats within one
document, and rows that share an id, are not reported; null ids come last and come out null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm import common as C

LENGTH = 50
RUN = 8
_FIELDS = ["run", "after", "before", "id", "th", "place"]
_SUFFIX = "run bigint, after binary, before binary, id bigint, th int, place int"
_FOUND = "id bigint, th int, start int, stop int, other bigint, window binary"
#: runs with up to so many suffixes are compared pair by pair in their task; others by the digests of their
#: windows, with the same result
PAIRED = 32


class Scanner:
    def __init__(self, length: int, run: int) -> None:
        self.length, self.run = length, run
        self._words, self._runs = C.Words(), C.Runs()

    def places(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes of the words, of the runs, the minimisers' places)."""
        hashes = self._words.hashes(data)
        runs = self._runs.of(hashes, self.run)
        return hashes, runs, np.unique(C.minimum_places(runs, self.length - self.run + 1))


def sketches(docs: DataFrame, length: int = LENGTH, run: int = RUN) -> DataFrame:
    """(id, th, n_words, digest, runs): the minimiser runs of every row long enough, without repeats."""
    def rows(batch: dict[str, list]) -> Iterator[tuple]:
        scanner = Scanner(length, run)
        for key, th, text in zip(batch["id"], batch["th"], batch["text"], strict=True):
            hashes, runs, at = scanner.places((text or "").encode())
            if len(hashes) >= length:
                digest = hashlib.blake2b(hashes, digest_size=16).digest()
                yield key, th, len(hashes), digest, C.signed(np.unique(runs[at]))

    return C.map_rows(C.keyed(docs), rows, "id bigint, th int, n_words int, digest binary, runs array<bigint>")


def suffixes(docs: DataFrame, shared: DataFrame, length: int = LENGTH, run: int = RUN) -> DataFrame:
    """One row per kept suffix. `shared`: (id, th, runs), the runs of each document that others have too."""
    def rows(batch: dict[str, list]) -> Iterator[tuple]:
        scanner = Scanner(length, run)
        for key, th, text, wanted in zip(batch["id"], batch["th"], batch["text"], batch["runs"], strict=True):
            hashes, runs, at = scanner.places(text.encode())
            short = (hashes >> np.uint64(32)).astype(">u4")
            wanted = np.array(wanted, dtype=np.int64).view(np.uint64)
            for p in at[np.isin(runs[at], wanted)].tolist():
                before = short[max(0, p - length + run):p][::-1]
                yield int(runs[p].view(np.int64)), short[p:p + length].tobytes(), before.tobytes(), key, th, p

    return C.map_rows(C.keyed(docs).join(shared, ["id", "th"]), rows, _SUFFIX)


def _common(a: bytes, b: bytes) -> int:
    """Equal 4-byte words at the beginning."""
    n = min(len(a), len(b)) // 4
    if a[:4 * n] == b[:4 * n]:
        return n
    return int(np.argmin(np.frombuffer(a, np.uint32, n) == np.frombuffer(b, np.uint32, n)))


def _paired(rows: list[tuple], length: int) -> Iterator[tuple]:
    """Every suffix of one run against every other: spans of windows shared, each with the other document it names."""
    rows = sorted(rows, key=lambda row: row[3], reverse=True)
    named: list[list] = [[None] * (length + 1) for _ in rows]  # by the words of the window that stand before the place
    for i, low in enumerate(rows):
        for j, high in enumerate(rows[:i]):
            if low[3] == high[3]:
                continue
            right, left = _common(low[1], high[1]), _common(low[2], high[2])
            for before in range(max(0, length - right), left + 1):
                named[j][before] = low[3]  # ids fall: the smallest stays
                if named[i][before] is None:
                    named[i][before] = high[3]  # the largest, unless a smaller one than its own follows
    for row, others in zip(rows, named, strict=True):
        before = 0
        for other, same in groupby(others):
            n = len(list(same))
            if other is not None:
                yield row[3], row[4], row[5] - before - n + 1, row[5] - before + length, other, None
            before += n


def _windows(row: tuple, right: int, length: int) -> Iterator[tuple]:
    """A digest for each window of `length` words around the place that has at most `right` words from it on."""
    words = np.frombuffer(row[2], ">u4")[::-1].tobytes() + row[1]
    left = len(row[2]) // 4
    head = row[0].to_bytes(8, "big", signed=True)
    for before in range(max(0, length - right), left + 1):
        part = words[4 * (left - before):4 * (left - before + length)]
        if len(part) == 4 * length:
            digest = hashlib.blake2b(head + before.to_bytes(4, "big") + part, digest_size=16).digest()
            yield row[3], row[4], row[5] - before, row[5] - before + length, None, digest


def _groups(rows: Iterator[tuple], length: int, paired: int) -> Iterator[tuple]:
    """Spans and windows of a task's suffixes. The task's first and last run may go on in other tasks."""
    held: list[tuple] = []  # the rows of a run, as long as they are few
    many: _Many | None = None
    first = True
    for row in rows:
        if held and row[0] != held[-1][0]:
            if many is not None:
                yield from many.end(None)
            elif first:
                yield from _all_windows(held, length)
            else:
                yield from _paired(held, length)
            held, many, first = [], None, False
        if many is not None:
            yield from many.add(row)
            held[:] = [row]
            continue
        held.append(row)
        if len(held) > paired:
            many = _Many(length, None if first else 0)
            for earlier in held:
                yield from many.add(earlier)
            held = [row]
    if many is not None:
        yield from many.end(length)
    elif held:
        yield from _all_windows(held, length)


def _all_windows(rows: list[tuple], length: int) -> Iterator[tuple]:
    for row in rows:
        yield from _windows(row, length, length)


class _Many:
    """Windows of the suffixes of one run, sorted by what follows. The nearest rows of other documents before
    and after a row bound how many words to the right any other document shares with it."""

    def __init__(self, length: int, edge: int | None) -> None:
        #: words shared with whatever stands before the first row; None: not known, it is in another task
        self.length, self.edge = length, length if edge is None else edge
        self.document: list[tuple[tuple, int]] = []  # rows of one document that follow one another
        self.earlier: bytes | None = None

    def add(self, row: tuple) -> Iterator[tuple]:
        if self.document and self.document[-1][0][3] != row[3]:
            last = self.document[-1][0]
            for mine, right in self.document:
                yield from _windows(mine, max(right, _common(mine[1], row[1])), self.length)
            self.earlier, self.document = last[1], []
        right = self.edge if self.earlier is None else _common(self.earlier, row[1])
        self.document.append((row, right))

    def end(self, beyond: int | None) -> Iterator[tuple]:
        for mine, right in self.document:
            yield from _windows(mine, max(right, beyond or 0), self.length)
        self.document = []


def compared(found: DataFrame, length: int = LENGTH, paired: int = PAIRED) -> DataFrame:
    """(id, th, start, stop, other, window): passages found within a task (window is null), and the windows
    whose partners may be anywhere among many suffixes or in another task."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in _FIELDS), strict=True)

        made = []
        for out in _groups(rows(), length, paired):
            made.append(out)
            if len(made) >= 10_000:
                yield _found(made)
                made = []
        if made:
            yield _found(made)

    by = ["run", "after", "before", "id", "place"]
    conf = found.sparkSession.conf
    # named, so that tasks are not merged by bytes: the cost is in the comparison
    tasks = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
                or conf.get("spark.sql.shuffle.partitions"))
    return found.repartitionByRange(tasks, *by).sortWithinPartitions(*by).mapInArrow(compare, _FOUND)


def matches(found: DataFrame, length: int = LENGTH, paired: int = PAIRED) -> DataFrame:
    """(id, th, start, stop, other): spans whose windows of `length` words another document has."""
    made = C.written(compared(found, length, paired), "suffix-matches")
    windows = made.where("window IS NOT NULL")
    several = windows.groupBy("window").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    # a table of its own: the partitions of the join can then be split where a window is in many documents
    several = C.written(several, "suffix-windows")
    other = F.when(F.col("id") > F.col("low"), F.col("low")).otherwise(F.col("high"))
    shared = windows.drop("other").join(several, "window").select("id", "th", "start", "stop", other.alias("other"))
    return made.where("window IS NULL").drop("window").unionByName(shared)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
        names=["id", "th", "start", "stop", "other", "window"])


def shared_passages(docs: DataFrame, length: int = LENGTH, run: int = RUN, paired: int = PAIRED) -> DataFrame:
    """(id, th, start, stop, other): the passages of each document that another one has.

    Words `start` to `stop - 1`: as many as lie in windows one word apart that name the same other document. A
    passage overlaps the next one, in less than a window, where the document that they name changes.
    """
    known = C.written(sketches(docs, length, run), "suffix-sketches")
    same = known.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("final"))
    ranked = known.join(same, "digest")
    whole = ranked.where("first < final").select(
        "id", "th", F.lit(0).alias("start"), F.col("n_words").alias("stop"),
        F.when(F.col("id") > F.col("first"), F.col("first")).otherwise(F.col("final")).alias("other"))
    runs = ranked.where("id = first").select("id", "th", F.explode("runs").alias("run"))
    several = runs.groupBy("run").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("run")
    several = C.written(several, "suffix-runs")
    shared = runs.join(several, "run").groupBy("id", "th").agg(F.collect_set("run").alias("runs"))
    found = C.written(suffixes(docs, shared, length, run).distinct(), "suffixes")
    return _merged(matches(found, length, paired).unionByName(whole), length)


def _merged(spans: DataFrame, length: int) -> DataFrame:
    """Spans of one document as passages: its windows decide on one other document, runs of equal decisions stay."""
    fields = ["start", "stop", "other"]
    lists = spans.groupBy("id", "th").agg(F.collect_list(F.struct(*fields)).alias("spans")).select(
        "id", "th", *(F.col(f"spans.{c}").alias(c) for c in fields))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.small_batches(batches):
            ends = np.cumsum(pc.list_value_length(batch.column("start")).to_numpy())
            flat = [np.split(batch.column(c).flatten().to_numpy(), ends[:-1]) for c in fields]
            made = [(key, th, *passage, None) for key, th, *found in zip(
                        batch.column("id").to_pylist(), batch.column("th").to_pylist(), *flat, strict=True)
                    for passage in _passages(key, *found, length)]
            if made:
                yield _found(made)

    return lists.mapInArrow(merge, _FOUND).drop("window")


def _passages(key: int, start: np.ndarray, stop: np.ndarray, other: np.ndarray,
              length: int) -> Iterator[tuple[int, int, int]]:
    """(start, stop, other) of the stretches of windows for which the same id is best: the smallest below
    the document's own, or else the largest."""
    ids, which = np.unique(other, return_inverse=True)
    below = int(np.searchsorted(ids, key))
    ids = np.concatenate([ids[below:], ids[:below][::-1]])  # better ones later
    rank = np.concatenate([np.arange(below)[::-1] + len(ids) - below, np.arange(len(ids) - below)])[which] + 1
    count = stop - start - length + 1
    windows = np.arange(count.sum()) + np.repeat(start - (np.cumsum(count) - count), count)
    best = np.zeros(int(windows.max()) + 2, dtype=np.int64)
    np.maximum.at(best, windows, np.repeat(rank, count))
    edges = np.flatnonzero(np.diff(best, prepend=0)).tolist()
    for begin, end in zip(edges, edges[1:], strict=False):
        if best[begin]:
            yield begin, end - 1 + length, int(ids[best[begin] - 1])


def report(docs: DataFrame) -> DataFrame:
    """One row per shared passage of each document."""
    return shared_passages(docs).select(
        C.true_id("id"), F.col("start").cast("long").alias("first_word"),
        (F.col("stop") - F.col("start")).cast("long").alias("n_words"), C.true_id("other").alias("other_doc_id"))
