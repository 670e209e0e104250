r"""Substring dedup on a de Bruijn graph of words: removes word windows that an earlier document has.

Every window of 50 words is an edge from the node of its first 49 words to the node of its last 49. Only
edges that stand in two documents matter. They are found without shuffling every window: a window's
anchor is its 8-word run with the smallest hash, so equal windows have equal anchors, and windows whose
anchor stands in one document only are unique. Documents with equal word sequences are one source; the
later copies go as a whole and take no part in the graph.

The repeated edges keep the coordinates (document, word) of their first source. Where a node has one edge
in and one out, the two edges are one path: degrees are counted and joined back, and edges that follow
one another in their source up to the next branching node compact into a path. The places of a path in
later documents compact likewise into spans, which name their source coordinates.

Windows are the same if a 49-word hash and an independent hash of the 50 words' bytes agree (128 bits).

Defined results: null and blank texts have no words; a text under 50 words loses nothing; rows with one
id never remove words from each other; rows that repeat are treated alike; null ids come last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm import common as C

WINDOW = 50
#: words of an anchor; windows of 50 words then have an anchor every 22 words or so
ANCHOR = 8


class Scanner:
    """Anchors and edges of word sequences."""

    def __init__(self, window: int, anchor: int) -> None:
        self.window, self.anchor = window, anchor
        self._words, self._runs = C.Words(), C.Runs()

    def anchors(self, data: bytes) -> tuple[tuple, np.ndarray, np.ndarray]:
        """((hashes, starts, ends) of the words, hashes of the anchor runs, place of each window's anchor)."""
        words = self._words.of(data)
        runs = self._runs.of(words[0], self.anchor)
        return words, runs, C.minimum_places(runs, self.window - self.anchor + 1)

    def edges(self, words: list[bytes], nominated: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """(place, node from, node to, hash of the bytes) of each window whose anchor is nominated."""
        import xxhash

        joined = b" ".join(words)
        (hashes, starts, ends), runs, at = self.anchors(joined)
        places = np.flatnonzero(np.isin(runs[at], np.array(nominated, dtype=np.int64).view(np.uint64)))
        nodes = self._runs.of(hashes, self.window - 1)
        view, digest = memoryview(joined), xxhash.xxh3_64_intdigest
        checks = [digest(view[a:b]) for a, b in zip(starts[places].tolist(), ends[places + self.window - 1].tolist(),
                                                    strict=True)]
        return places, nodes[places], nodes[places + 1], checks


def sketches(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(id, th, digest, anchors) of every row of a window or more: the distinct hashes of its anchors."""
    def rows(batch: dict[str, list]) -> Iterator[tuple]:
        scanner = Scanner(window, anchor)
        for key, th, text in zip(batch["id"], batch["th"], batch["text"], strict=True):
            (hashes, _, _), runs, at = scanner.anchors((text or "").encode())
            if len(hashes) >= window:
                yield key, th, hashlib.blake2b(hashes, digest_size=16).digest(), C.signed(np.unique(runs[at]))

    return C.map_rows(C.keyed(docs), rows, "id bigint, th int, digest binary, anchors array<bigint>")


def edges(docs: DataFrame, nominated: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(id, spot, u, v, bytes): the windows at the nominated anchors, as edges from node u to node v.

    `spot` holds th and place in one number, which sorts like both: most windows are shuffled twice.
    """
    def run(batches):
        import pyarrow as pa

        scanner = Scanner(window, anchor)
        for batch in C.small_batches(batches, C.BATCH_BYTES // 4):
            made = []
            for key, th, text, anchors in zip(*(batch.column(c).to_pylist() for c in ("id", "th", "text", "anchors")),
                                              strict=True):
                at, u, v, checks = scanner.edges(text.encode().split(), anchors)
                n = len(at)
                made.append((np.full(n, key, dtype=np.int64), (np.int64(th) << 32) | at.astype(np.int64),
                             C.signed(u), C.signed(v), C.signed(np.array(checks, dtype=np.uint64))))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*made, strict=True)],
                                                 names=["id", "spot", "u", "v", "bytes"])

    joined = C.keyed(docs).join(nominated, ["id", "th"])
    return joined.mapInArrow(run, "id bigint, spot bigint, u bigint, v bigint, bytes bigint")


def _th_of(spot: str) -> Column:
    return F.shiftright(spot, 32).cast("int")


def _place_of(spot: str) -> Column:
    return F.col(spot).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")


def paths(found: DataFrame) -> DataFrame:
    """(u, bytes, s_id, s_th, s_place, path): the edges of two documents or more, their first source, their path."""
    repeated = found.groupBy("u", "bytes").agg(F.min(F.struct("id", "spot")).alias("s"),
                                               F.max("id").alias("last"), F.max("v").alias("v"))
    repeated = C.written(repeated.where("s.id < last").select(
        "u", "v", "bytes", F.col("s.id").alias("s_id"), _th_of("s.spot").alias("s_th"),
        _place_of("s.spot").alias("s_place")), "debruijn-edges")
    ends = repeated.select(F.col("u").alias("node"), F.lit(0).alias("into"), F.lit(1).alias("out")).unionAll(
        repeated.select("v", F.lit(1), F.lit(0)))
    simple = ends.groupBy("node").agg(F.sum("into").alias("into"), F.sum("out").alias("out")).where(
        "into = 1 AND out = 1").select(F.col("node").alias("u"), F.lit(True).alias("simple"))
    along = Window.partitionBy("s_id", "s_th").orderBy("s_place")
    begins = F.col("simple").isNull() | (F.coalesce(F.lag("s_place").over(along), F.lit(-2)) != F.col("s_place") - 1)
    start = F.max(F.when(F.col("begins"), F.col("s_place"))).over(along)
    return repeated.join(simple, "u", "left").withColumn("begins", begins).withColumn(
        "path", F.xxhash64("s_id", "s_th", start)).select("u", "bytes", "s_id", "s_th", "s_place", "path")


def spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[DataFrame, DataFrame]:
    """What repeats an earlier document, in two tables.

    (id, th, place, n, source_id, source_place): n consecutive windows from word `place` on, which a
    smaller id has from `source_place` on; and (id, th) of the documents that repeat a smaller id whole.
    """
    known = C.written(sketches(docs, window, anchor), "debruijn-sketches")
    first = known.groupBy("digest").agg(F.min("id").alias("first"))
    ranked = known.join(first, "digest")
    copies = ranked.where("id > first").select("id", "th").distinct()
    anchors = ranked.where("id = first").select("id", "th", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b")
    # a table of its own: the partitions of the join can then be split where an anchor is in many documents
    shared = C.written(shared.select("anchor"), "debruijn-anchors")
    nominated = anchors.join(shared, "anchor").groupBy("id", "th").agg(F.collect_set("anchor").alias("anchors"))
    found = C.written(edges(docs, nominated, window, anchor), "debruijn-windows")

    later = found.join(paths(found), ["u", "bytes"]).where("id > s_id").select(
        "id", _th_of("spot").alias("th"), _place_of("spot").alias("place"), "path", "s_id", "s_place")
    later = later.repartition("id", "th").dropDuplicates(["id", "th", "place"])
    along = Window.partitionBy("id", "th").orderBy("place")
    goes_on = (F.lag("place").over(along) == F.col("place") - 1) & (F.lag("path").over(along) == F.col("path")) & (
        F.lag("s_place").over(along) == F.col("s_place") - 1)
    runs = later.withColumn("breaks", ~F.coalesce(goes_on, F.lit(False))).withColumn(
        "run", F.sum(F.col("breaks").cast("int")).over(along))
    compact = runs.groupBy("id", "th", "run").agg(
        F.min("place").alias("place"), F.count("*").cast("int").alias("n"), F.min("s_id").alias("source_id"),
        F.min("s_place").alias("source_place")).drop("run")
    return C.written(compact, "debruijn-spans"), copies


def without_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(id, n_words, n_removed, kept): the words of each row that no earlier document has in a window."""
    found, copies = spans(docs, window, anchor)
    gone = found.select("id", "th", F.struct("place", "n").alias("s")).unionByName(
        copies.select("id", "th", F.struct(F.lit(0).alias("place"), F.lit(None).cast("int").alias("n")).alias("s")))
    gone = gone.groupBy("id", "th").agg(F.collect_list("s").alias("spans"))

    def rows(batch: dict[str, list]) -> Iterator[tuple]:
        for key, text, gaps in zip(batch["id"], batch["text"], batch["spans"], strict=True):
            words = (text or "").encode().split()
            keep = np.ones(len(words), dtype=bool)
            for gap in gaps or ():
                keep[gap["place"]:len(words) if gap["n"] is None else gap["place"] + gap["n"] + window - 1] = False
            kept = words if keep.all() else [words[i] for i in np.flatnonzero(keep)]
            yield key, len(words), len(words) - len(kept), b" ".join(kept).decode()

    return C.map_rows(C.keyed(docs).join(gone, ["id", "th"], "left"), rows,
                      "id bigint, n_words bigint, n_removed bigint, kept string")


def report(docs: DataFrame) -> DataFrame:
    """One row per document, with a digest of the words that stay."""
    return without_repeats(docs).select(C.true_id("id"), "n_words", "n_removed",
                                        F.sha2("kept", 256).alias("kept_sha256"))


#: the same in DuckDB
SQL = f"""
WITH worded AS (
  SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS h FROM worded, range(1, len(w) - {WINDOW - 2}) t(i)
), first AS (SELECT h, min(doc_id) AS first FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM win JOIN first USING (h), range(0, {WINDOW}) t(k) WHERE first < doc_id
), word AS (SELECT doc_id, i, w[i] AS word FROM worded, range(1, len(w) + 1) t(i)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (doc_id)
"""
