"""What the corpus operators share: row identity, words, batches of texts, written tables.

A row of a corpus is known by its id and a hash of its text, so rows that repeat both get one result
each, and rows that share an id but not the text stay apart. A null id counts as the largest long; it
is null again in results.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.operators.skew import fits_broadcast
from tripweave.session import scratch_path

NO_ID = (1 << 63) - 1
#: the white space of the word rule `[^\x20\x09-\x0D]+`; bytes.split() knows the same six characters
SPACE = r"[\x20\x09-\x0D]+"
BATCH_BYTES = 8_000_000
#: removes shuffle files at the end of the query that wrote them
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """(id, th, text) of every row, and the columns named in `more`."""
    return docs.select(id_of(docs), F.hash(docs["text"]).alias("th"), docs["text"].alias("text"),
                       *(docs[c] for c in more))


def id_of(docs: DataFrame) -> Column:
    return F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("id")


def true_id(name: str = "id") -> Column:
    """The id as it came in."""
    return F.when(F.col(name) != NO_ID, F.col(name)).alias("doc_id")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names that no column of `df` has, for helper columns beside a caller's own columns."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def only_in(docs: DataFrame, wanted: DataFrame, keys: list[str], max_rows: int = 200_000) -> DataFrame:
    """`docs` joined to a narrow table of rows wanted. Within a checked number of rows the table goes to the
    documents, so that no text moves; beyond it, both are shuffled."""
    return docs.join(F.broadcast(wanted) if fits_broadcast(wanted, max_rows) else wanted, keys)


def rejoin(docs: DataFrame, found: DataFrame, how: str) -> tuple[DataFrame, list[str]]:
    """`docs` joined to `found` (id, th, more columns) by row identity, and the new names of those columns.

    The caller's columns keep their names and order, whatever they are called.
    """
    more = [c for c in found.columns if c not in ("id", "th")]
    key, th, *named = free_names(docs, "id_", "th_", *(f"{c}_" for c in more))
    left = docs.select("*", id_of(docs).alias(key), F.hash(docs["text"]).alias(th))
    right = found.select(F.col("id").alias(key), F.col("th").alias(th),
                         *(F.col(c).alias(n) for c, n in zip(more, named, strict=True)))
    return left.join(right, [key, th], how).drop(key, th), named


def written(df: DataFrame, what: str) -> DataFrame:
    """`df` as a table in the shared folder: lineage ends here, and every executor can read it.

    What was shuffled for it is read no more and removed from the disks at once, not when the driver collects garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{what}-{uuid.uuid4().hex[:12]}")
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(batches: Iterator[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that none holds much more than `limit` bytes, a single long text aside."""
    for batch in batches:
        rows = max(1, min(batch.num_rows, int(batch.num_rows * limit / max(1, batch.nbytes))))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_rows(df: DataFrame, rows: Callable[[dict[str, list]], Iterator[tuple]], schema: str) -> DataFrame:
    """`mapInArrow` whose function takes columns as lists and yields tuples, a few megabytes at a time."""
    names = [part.split()[0] for part in _fields(schema)]
    arrow = _arrow_types(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            made: list[tuple] = []
            for row in rows({n: batch.column(n).to_pylist() for n in batch.schema.names}):
                made.append(row)
                if len(made) >= 20_000:
                    yield _batch(made, names, arrow)
                    made = []
            if made:
                yield _batch(made, names, arrow)

    return df.mapInArrow(run, schema)


def _fields(schema: str) -> list[str]:
    """The top-level fields of a DDL string."""
    out, depth, start = [], 0, 0
    for at, c in enumerate(schema):
        depth += (c in "<(") - (c in ">)")
        if c == "," and depth == 0:
            out.append(schema[start:at].strip())
            start = at + 1
    return [*out, schema[start:].strip()]


def _arrow_types(spark: SparkSession, schema: str) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return [f.type for f in to_arrow_schema(StructType.fromDDL(schema))]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(col, type=t) for col, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


# ---- hashes of words and of runs of words, as numpy arrays of unsigned 64-bit numbers ----

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xFF51AFD7ED558CCD)


class Words:
    """Hashes of the words of a text, all at once from its bytes.

    A word of bytes b0 .. bn has the hash sum(value[bi] * B**(n - i)) modulo 2**64 with fixed random
    values of the bytes, mixed with its length.
    """

    _CHUNK = 1 << 20

    def __init__(self) -> None:
        self._powers = _Powers()
        self._values = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)
        self._space = np.zeros(256, dtype=bool)
        self._space[[9, 10, 11, 12, 13, 32]] = True

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, starts, ends): of every word, and the bytes it takes in `data`."""
        parts, at = [], 0
        while at < len(data):
            end = at + self._CHUNK
            if end < len(data):  # cut before a word that would be split
                found = re.compile(rb"[\x20\x09-\x0D]").search(data, end)
                end = found.start() if found else len(data)
            parts.append(self._part(data[at:end], at))
            at = end
        if not parts:
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        return parts[0] if len(parts) == 1 else tuple(np.concatenate(c) for c in zip(*parts, strict=True))

    def _part(self, data: bytes, offset: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        code = np.frombuffer(data, dtype=np.uint8)
        solid = np.zeros(len(code) + 2, dtype=bool)
        np.logical_not(self._space[code], out=solid[1:-1])
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        starts, ends = edges[::2], edges[1::2]
        powers, inverse = self._powers.upto(len(code) + 1)
        sums = np.zeros(len(code) + 1, dtype=np.uint64)
        np.cumsum(self._values[code] * inverse[: len(code)], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * powers[starts]
        return mixed(hashes + (ends - starts).astype(np.uint64) * _MIX), starts + offset, ends + offset

    def hashes(self, data: bytes) -> np.ndarray:
        return self.of(data)[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a number over the whole number."""
    x = x ^ (x >> np.uint64(33))
    x *= _MIX
    return x ^ (x >> np.uint64(29))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as were needed so far."""

    def __init__(self) -> None:
        self._up = self._down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self._up):
            size = max(n, 2 * len(self._up), 1024)
            self._up, self._down = _geometric(_BASE, size), _geometric(pow(_BASE, -1, 1 << 64), size)
        return self._up, self._down


class Runs:
    """Hashes of all runs of k consecutive words, in one pass over the words' hashes.

    Run i has the hash sum(h[i + j] * B**(k - j)) modulo 2**64, mixed.
    """

    def __init__(self) -> None:
        self._powers = _Powers()

    def of(self, hashes: np.ndarray, k: int) -> np.ndarray:
        n = len(hashes) - k + 1
        if n < 1:
            return np.empty(0, dtype=np.uint64)
        powers, inverse = self._powers.upto(len(hashes) + 1)
        sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * inverse[: len(hashes)], out=sums[1:])
        return mixed((sums[k:] - sums[:-k]) * powers[:n])


def _geometric(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def minimum_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` values, where its smallest one is (the last of equal ones)."""
    if len(values) < width:
        return np.empty(0, dtype=np.int64)
    best, at, span = values, np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left, right = best[: len(best) - step], best[step:]
        take = right <= left
        at = np.where(take, at[step:], at[: len(at) - step])
        best = np.where(take, right, left)
        span += step
    return at


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
