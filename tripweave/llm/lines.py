r"""Line dedup: removes runs of lines that stand elsewhere in the corpus.

Chunks of lines are cut by content: a rolling hash over the hashes of two lines decides whether a chunk may end
after the second. A chunk begins at every line and runs to the first such end that leaves it two lines, or to
the end of the text, so its boundaries depend on its own lines alone: whatever stands around a run of lines,
or is inserted before it, the run is cut alike, and a text that was copied whole is covered whole. Chunks may
overlap. Of chunks with the same bytes and at least one word, the first one by (id, place) stays, and the lines
of all others are removed; each removed line has an equal one at a smaller (id, place), so none is lost
altogether. Hashes only nominate: a nominated chunk's bytes are grouped as they are.

Runs of two lines are found when their pair is an end (three in four), longer ones nearly always.

The text is shuffled twice, to meet the nominated places and the places to remove; equal chunks combine
before their shuffle, and joins of many places to one chunk are left to adaptive skew handling.

Defined results: a null text stays null and has no lines; an empty text has one line and no chunk worth
removing; rows with the same id and text count as one document and are treated alike; a document all
of whose lines go keeps its row with an empty text; a text of one line has no chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm import common as C

#: one pair of lines in so many ends no chunk
DIVISOR = 4
MIN_LINES = 2


def line_hash(line: bytes) -> int:
    """60 bits that SQL can compute too."""
    return int(hashlib.md5(line).hexdigest()[:15], 16)


def chunks(lines: list[bytes], divisor: int = DIVISOR, min_lines: int = MIN_LINES) -> list[tuple[int, int]]:
    """(first line, line after the last) of each chunk. The rolling hash of the lines i - 1 and i is h(i) + 5 h(i-1)."""
    hashes = [0, *map(line_hash, lines)]
    ends = [(h + 5 * before) % divisor != 0 for before, h in zip(hashes, hashes[1:], strict=False)]
    out, n, stop = [], len(lines), len(lines)
    for start in range(n - min_lines, -1, -1):
        if ends[start + min_lines - 1]:
            stop = start + min_lines
        out.append((start, stop))
    return out[::-1]


def _wordy(lines: list[bytes], span: tuple[int, int]) -> bool:
    return any(line.split() for line in lines[span[0]:span[1]])


def chunk_places(docs: DataFrame, divisor: int = DIVISOR, min_lines: int = MIN_LINES) -> DataFrame:
    """(id, th, place, h): every chunk that could be removed, with a hash of its bytes."""
    def rows(batch: dict[str, list]) -> Iterator[tuple]:
        import xxhash

        for key, th, text in zip(batch["id"], batch["th"], batch["text"], strict=True):
            if text is None:
                continue
            lines = text.encode().split(b"\n")
            for span in chunks(lines, divisor, min_lines):
                if _wordy(lines, span):
                    h = xxhash.xxh3_64_intdigest(b"\n".join(lines[span[0]:span[1]]))
                    yield key, th, span[0], h - (1 << 63)

    return C.map_rows(C.keyed(docs), rows, "id bigint, th int, place int, h bigint")


def removals(docs: DataFrame, divisor: int = DIVISOR, min_lines: int = MIN_LINES) -> DataFrame:
    """(id, th, spans): the [first line, line after the last) of each stretch of lines to remove, in order and apart."""
    places = C.written(chunk_places(docs, divisor, min_lines), "chunk-places")
    # rows of one document twice are one place
    repeated = places.groupBy("h").agg(F.min(F.struct("id", "th", "place")).alias("a"),
                                       F.max(F.struct("id", "th", "place")).alias("b")).where("a <> b").select("h")
    # tables of their own: the partitions of the joins can then be split where a chunk is in many documents
    repeated = C.written(repeated, "chunk-repeated")
    nominated = places.join(repeated, "h").groupBy("id", "th").agg(F.collect_set("place").alias("places"))

    def texts(batch: dict[str, list]) -> Iterator[tuple]:
        for key, th, text, starts in zip(batch["id"], batch["th"], batch["text"], batch["places"], strict=True):
            lines, wanted = text.encode().split(b"\n"), set(starts)
            for a, b in chunks(lines, divisor, min_lines):
                if a in wanted:
                    yield key, th, a, b, b"\n".join(lines[a:b])

    suspects = C.written(C.map_rows(C.keyed(docs).join(nominated, ["id", "th"]), texts,
                                    "id bigint, th int, a int, b int, bytes binary"), "chunk-suspects")
    first = suspects.groupBy("bytes").agg(F.min(F.struct("id", "th", "a")).alias("first"),
                                          F.max(F.struct("id", "th", "a")).alias("last")).where("first <> last")
    first = C.written(first.select("bytes", "first"), "chunk-first")
    later = suspects.join(first, "bytes").where(F.struct("id", "th", "a") != F.col("first"))
    found = later.groupBy("id", "th").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("spans"))

    def together(batch: dict[str, list]) -> Iterator[tuple]:
        for key, th, *spans in zip(batch["id"], batch["th"], batch["a"], batch["b"], strict=True):
            apart: list[dict[str, int]] = []
            for a, b in zip(*spans, strict=True):
                if apart and a <= apart[-1]["b"]:
                    apart[-1]["b"] = max(b, apart[-1]["b"])
                else:
                    apart.append({"a": a, "b": b})
            yield key, th, apart

    return C.map_rows(found.select("id", "th", F.col("spans.a").alias("a"), F.col("spans.b").alias("b")), together,
                      "id bigint, th int, spans array<struct<a: int, b: int>>")


def without_repeats(docs: DataFrame, divisor: int = DIVISOR, min_lines: int = MIN_LINES) -> tuple[DataFrame, str, str]:
    """`docs` with their columns unchanged, and two added ones whose names are returned: the spans removed
    from each text (null: none) and the text that is left."""
    df, (spans,) = C.rejoin(docs, removals(docs, divisor, min_lines), "left")
    (kept,) = C.free_names(df, "kept_text_")
    # what stands between the spans, which are in order and apart; the text is split once
    begin = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["b"]))
    end = lambda lines: F.concat(F.transform(spans, lambda s: s["a"]), F.array(F.size(lines)))
    between = lambda lines: F.zip_with(begin, end(lines), lambda a, b: F.slice(lines, a + 1, b - a))
    left = F.transform(F.array(F.split(df["text"], "\n")), lambda lines: F.array_join(F.flatten(between(lines)), "\n"))[0]
    return df.withColumn(kept, F.when(F.col(spans).isNull(), df["text"]).otherwise(left)), spans, kept


def dedup(docs: DataFrame, drop_emptied: bool = False, **parameters: int) -> DataFrame:
    """`docs` with the repeated chunks taken out of `text`, and `n_chars` brought up to date if there is one.

    With `drop_emptied`, rows go whose words have all been taken out; rows that came without words stay.
    """
    df, spans, kept = without_repeats(docs, **parameters)
    if drop_emptied:
        df = df.where(F.col(spans).isNull() | F.col(kept).rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col(kept), "n_chars": F.length(kept).cast("long")}
    return df.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: lines, lines removed, and the text that is left."""
    df, spans, kept = without_repeats(docs)
    removed = F.coalesce(F.aggregate(spans, F.lit(0), lambda s, x: s + x["b"] - x["a"]), F.lit(0))
    return df.select("doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
                     removed.cast("long").alias("n_removed"), F.col(kept).alias("kept_text"))


#: the same in DuckDB
SQL = f"""
WITH doc AS (
  SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL
), line AS (
  SELECT doc_id, i, ls[i] AS line, i = len(ls) AS last, ('0x' || substr(md5(ls[i]), 1, 15))::BIGINT::HUGEINT AS h
  FROM doc, range(1, len(ls) + 1) t(i)
), rolled AS (
  SELECT *, last OR (h + 5 * lag(h, 1, 0::HUGEINT) OVER (PARTITION BY doc_id ORDER BY i)) % {DIVISOR} <> 0 AS ends FROM line
), chunk AS (
  SELECT doc_id, i, min(i) FILTER (ends) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN {MIN_LINES - 1} FOLLOWING AND UNBOUNDED FOLLOWING) AS e
  FROM rolled
), later AS (
  SELECT doc_id, i, e FROM (
    SELECT *, row_number() OVER (PARTITION BY bytes ORDER BY doc_id, i) AS nth
    FROM (SELECT doc_id, i, e, array_to_string(ls[i:e], chr(10)) AS bytes FROM chunk JOIN doc USING (doc_id) WHERE e IS NOT NULL)
    WHERE regexp_matches(bytes, '[^\\x20\\x09-\\x0D]')
  ) WHERE nth > 1
), marked AS (
  SELECT doc_id, i, line, coalesce(max(e) OVER (PARTITION BY doc_id ORDER BY i) >= i, false) AS gone
  FROM line LEFT JOIN later USING (doc_id, i)
), left_over AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept_text
  FROM marked GROUP BY 1
)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, kept_text
FROM documents LEFT JOIN left_over USING (doc_id)
"""
