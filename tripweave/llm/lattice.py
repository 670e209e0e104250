r"""SentencePiece encoding and decoding on a relational lattice.

Encoding words: every substring of a word up to the longest piece is a row; an equi-join with the piece
table keeps those that are pieces, which are the edges of the word's lattice; a group by word collects
the edges in order of their end, and a higher-order `aggregate` folds them to the best path (Viterbi).

Texts: the units of all documents are counted, the most frequent ones (a fixed number) are encoded on
the lattice, and every task gets their ids. Units outside this table, which are new on nearly every
page of a corpus, are segmented where they stand by the same rule, those of many texts together, so that
a prefix they share is settled once; sending each of them through the lattice and back to its documents
moves several times the text. Documents are not shuffled.

Decoding joins the bytes of the pieces, drops the leading blank and gives back the very text.

Defined results: a null text has null ids and decodes to null; an empty text has no ids; rows that repeat
are encoded alike; ids outside the vocabulary, and its control pieces, decode to nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import common as C
from tripweave.llm import pieces as P

#: units that the lattice encodes for all tasks: their table stays under 10 MB
TABLE_UNITS = 65_536
#: units that a task counts, or remembers, at a time
TASK_UNITS = 300_000
#: characters of texts whose new units a task segments together
BLOCK_CHARS = 2_000_000


def piece_table(spark: SparkSession, known: P.Pieces) -> DataFrame:
    """(piece, id, score): as many rows as the vocabulary has pieces."""
    rows = [(p, i, known.scores[p]) for p, i in known.ids.items()]
    return spark.createDataFrame(rows, "piece string, id int, score double")


def encode_words(words: DataFrame, known: P.Pieces) -> DataFrame:
    """(unit, ids) for distinct units; a character without a piece has the id -1 - its code point."""
    table = F.broadcast(piece_table(words.sparkSession, known))  # bounded by the vocabulary
    length = F.length("unit")
    starts = words.select("unit", F.explode(F.sequence(F.lit(0), length - 1)).alias("start"))
    longest = F.least(F.lit(known.longest), length - F.col("start"))
    spans = starts.select("unit", "start", F.explode(F.sequence(F.lit(1), longest)).alias("n"))
    found = spans.withColumn("piece", F.expr("substring(unit, start + 1, n)")).join(table, "piece")
    one = F.expr("substring(unit, start + 1, 1)")
    lone = starts.select("unit", (F.col("start") + 1).alias("end"), "start", (-1 - F.ascii(one)).alias("id"),
                         F.lit(known.unknown).alias("score"))
    edges = found.select("unit", (F.col("start") + F.col("n")).alias("end"), "start", "id", "score").unionByName(lone)
    # of one span, the piece comes before the lone character, which then does not replace it
    order = F.struct("end", "start", (-F.col("score")).alias("cost"), "id")
    lattice = edges.groupBy("unit").agg(F.sort_array(F.collect_list(order)).alias("edges"))
    return lattice.select("unit", _best_path("edges").alias("ids"))


def _best_path(edges: str) -> Column:
    """Folds edges in order of (end, start). The state has, for each place reached, its best score and ids."""
    def state(score: Column, ids: Column) -> Column:
        return F.struct(score.alias("score"), ids.alias("ids"))

    def step(places: Column, edge: Column) -> Column:
        before = F.get(places, edge["start"])
        reached = state(before["score"] - edge["cost"], F.concat(before["ids"], F.array(edge["id"])))
        longer = F.concat(places, F.array(reached))
        better = F.concat(F.slice(places, F.lit(1), edge["end"]), F.array(reached))
        return F.when(F.size(places) == edge["end"], longer).when(
            reached["score"] > F.get(places, edge["end"])["score"], better).otherwise(places)

    begin = F.array(state(F.lit(0.0), F.array().cast("array<int>")))
    return F.element_at(F.aggregate(edges, begin, step), -1)["ids"]


def unit_counts(docs: DataFrame) -> DataFrame:
    """(unit, n): how often each unit stands in all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter[str] = Counter()

        def part() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counted, type=pa.string()),
                                               pa.array(counted.values(), type=pa.int64())], names=["unit", "n"])

        for batch in C.small_batches(batches):
            for text in batch.column("text").to_pylist():
                counted.update(P.units_of(text or ""))
                if len(counted) > TASK_UNITS:
                    yield part()
                    counted.clear()
        yield part()

    parts = docs.select(docs["text"].alias("text")).mapInArrow(run, "unit string, n bigint")
    return parts.groupBy("unit").agg(F.sum("n").alias("n"))


def frequent_units(docs: DataFrame, known: P.Pieces, limit: int = TABLE_UNITS) -> dict[str, tuple[int, ...]]:
    """The ids of the most frequent units, `limit` at most, by the lattice.

    A histogram of the counts, of a few hundred steps whatever the corpus, tells from which count on
    units are taken, so no task has to rank them.
    """
    counts = C.written(unit_counts(docs).where("n > 1").withColumn(
        "step", F.floor(F.log2("n") * 8).cast("int")), "unit-counts")
    least, room = 1 << 30, limit
    for step, n in sorted(counts.groupBy("step").agg(F.count("*")).collect(), reverse=True):
        room -= n
        if room < 0:
            break
        least = step
    table = encode_words(counts.where(F.col("step") >= least).select("unit"), known).toArrow()
    return {u: tuple(t for i in ids for t in (known.byte_tokens(chr(-1 - i)) if i < 0 else (i,)))
            for u, ids in zip(table["unit"].to_pylist(), table["ids"].to_pylist(), strict=True)}


class _Memory(dict):
    """Packed ids by unit: the table, and the units segmented since it was last emptied."""

    def __init__(self, known: P.Pieces, table: dict[str, bytes]) -> None:
        super().__init__(table)
        self._segments, self._table = P.Segments(known), table

    def learn(self, texts: list[list[str]]) -> None:
        """Segments the units of these texts that are not known yet, all together."""
        if len(self) > len(self._table) + TASK_UNITS:
            self.clear()
            self.update(self._table)
        self.update(self._segments.of(set(filterfalse(self.__contains__, chain.from_iterable(texts)))))


def _blocks(texts: Iterable[str | None]) -> Iterator[list[list[str]]]:
    """The units of each text, about two megabytes of texts at a time, a single long text aside."""
    block, room = [], BLOCK_CHARS
    for text in texts:
        block.append(P.units_of(text or ""))
        room -= len(text or "")
        if room < 0:
            yield block
            block, room = [], BLOCK_CHARS
    yield block


def encode(docs: DataFrame, path: str = P.MODEL, limit: int = TABLE_UNITS) -> tuple[DataFrame, str]:
    """`docs` with a column of token ids added, and its name. Only texts pass through Python."""
    known = P.load(path)
    table = {unit: P.packed(ids) for unit, ids in frequent_units(docs, known, limit).items()}
    sent = docs.sparkSession.sparkContext.broadcast((known, table))
    (name,) = C.free_names(docs, "token_ids")

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids_of_unit = _Memory(*sent.value)
        for texts in batches:
            values, ends = bytearray(), [0]
            for block in _blocks(texts.to_pylist()):
                ids_of_unit.learn(block)
                for units in block:
                    values += b"".join(map(ids_of_unit.__getitem__, units))
                    ends.append(len(values) // 4)
            yield pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()),
                                           pa.array(np.frombuffer(values, dtype=np.int32)),
                                           mask=texts.is_null())

    return docs.withColumn(name, ids_of(docs["text"])), name


def decoded(ids: Column, known: P.Pieces) -> Column:
    """The text of an array of token ids."""
    table = [""] * known.size
    for piece, i in known.ids.items():
        table[i] = piece.encode().hex()
    for b, i in enumerate(known.byte_ids):
        table[i] = f"{b:02x}"
    # one literal, folded once to an array
    lookup = F.split(F.lit(",".join(table)), ",")
    joined = F.unhex(F.array_join(F.transform(ids, lambda i: F.get(lookup, i)), "")).cast("string")
    return F.substr(joined, F.lit(2))


def encoded(docs: DataFrame, path: str = P.MODEL) -> DataFrame:
    """`docs` with their token ids; the run stops at a text that its ids don't decode to."""
    df, ids = encode(docs, path)
    same = decoded(F.col(ids), P.load(path)).eqNullSafe(F.coalesce(df["text"], F.lit("")))
    checked = F.when(F.col(ids).isNull() | same, F.col(ids)).otherwise(
        F.raise_error(F.lit("token ids do not give back the text")).cast("array<int>"))
    return df.withColumn(ids, checked)


def report(docs: DataFrame, path: str = P.MODEL) -> DataFrame:
    """One row per document: its ids, and whether they decode to the very text."""
    df, ids = encode(docs, path)
    back = decoded(F.col(ids), P.load(path))
    return df.select("doc_id", F.coalesce(F.size(ids), F.lit(0)).cast("long").alias("n_tokens"),
                     F.col(ids).alias("token_ids"), (back == F.col("text")).alias("round_trip"))
