r"""Quality classifier: vectors of words and character n-grams, averaged per document, learned from labelled documents.

Words are `[^\x20\x09-\x0D]+`. Features of a text are its words, the pairs of neighbouring words (equal
neighbours make the same pair, whatever they are), and the character 3- to 5-grams of its words with the blanks
on both sides. Features are hashed to `BUCKETS` vectors. A document is the mean of its features' vectors; a
softmax over a linear map of it gives the classes' probabilities. Vectors and map are learned by numpy
stochastic gradient descent, one document a step.

Learning takes labelled documents whose crc32(doc_id as text) mod 4 is not 2, in the order of a hash of text
and label, at most `SAMPLE` documents and about `SAMPLE_FEATURES` features of them in total; equal texts with
equal labels count once. That bounds what the driver gets. Nothing but the text enters a score.

As the map is linear, a vector counts in a document only through what the map makes of it: a number for
label 1 against label 0. Tasks get these `BUCKETS` numbers, and score every whole text piece by piece, so that a long
text needs no more memory than a short one.

Defined results: null and empty texts have no features and get the score of the learned bias; repeated rows get
a row each; a null id counts as the largest long and comes out null, and has no label. A document with both
labels is learned with both. Without labels of both kinds every score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm import common as C

BUCKETS = 1 << 18
DIMENSIONS, EPOCHS, RATE, SEED = 16, 5, 8.0, 7
GRAMS = (3, 4, 5)
#: the most labelled documents to learn from, and about the most features of them in total
SAMPLE, SAMPLE_FEATURES = 2000, 6_000_000
HELD_OUT, THRESHOLD = 2, 0.7
#: a text is read in pieces of about so many characters
PIECE = 1 << 18
_PAIR, _GRAM, _AGAIN = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x9E3779B97F4A7C15), 1
_BLANK = 32


def pieces(text: str) -> Iterator[str]:
    """The text with single blanks between words, cut at blanks; a piece begins with the last word of the one before."""
    words = text.encode().split()
    start = size = 0
    for k, word in enumerate(words):
        size += len(word) + 1
        if size >= PIECE or k == len(words) - 1:
            yield (b" %s " % b" ".join(words[start:k + 1])).decode()
            start, size = k, 0


def features(piece: str, first: bool, reader: C.Words) -> np.ndarray:
    """The buckets of all features of a piece; those of a word shared with the piece before are left out."""
    hashes, _, ends = reader.of(piece.encode())
    code = np.frombuffer(piece.encode("utf-32-le"), np.uint32)
    blank = code == _BLANK
    if not first:
        at = int(np.flatnonzero(blank)[1])  # behind the shared word
        code, blank = code[at:], blank[at:]
    out = [hashes if first else hashes[1:]]
    if len(hashes) > 1:
        before, after = hashes[:-1], hashes[1:]
        out.append(np.where(before == after, np.uint64(_AGAIN), C.mixed(before * _PAIR + after)))
    run, crossed = code.astype(np.uint64), np.zeros(len(code), bool)
    for n in range(2, max(GRAMS) + 1):
        # run[i]: the n characters from i on; crossed[i]: a blank stands between the first and the last of them
        run = run[:-1] * _GRAM + code[n - 1:]
        crossed = crossed[:-1] | blank[n - 2:-1] if n > 2 else crossed[:-1]
        if n in GRAMS:
            out.append(C.mixed(run[~crossed] * _PAIR))
    return (np.concatenate(out) % np.uint64(BUCKETS)).astype(np.int64)


def _counted(batch: dict[str, list], reader: C.Words = C.Words()) -> Iterator[tuple]:  # noqa: B008
    """(label, place, n, buckets, counts) of labelled documents."""
    for label, place, text in zip(batch["label"], batch["place"], batch["text"], strict=True):
        total = np.zeros(BUCKETS, np.int64)
        for k, piece in enumerate(pieces(text or "")):
            total += np.bincount(features(piece, k == 0, reader), minlength=BUCKETS)
        buckets = np.flatnonzero(total)
        yield label, place, len(buckets), buckets.astype(np.int32), total[buckets].astype(np.float32)


def learned(samples: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, float]:
    """What each bucket's vector gives to label 1 against label 0, and the bias, from (label, buckets, counts)."""
    both = np.bincount([s[0] for s in samples], minlength=2) if samples else np.ones(2)
    if not both.all():
        return np.zeros(BUCKETS, np.float32), float(both[1] > 0) * 2000 - 1000
    bias = np.log(both / both.sum())
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    used = np.zeros(BUCKETS, bool)
    weights = [(counts / max(1.0, counts.sum())).astype(np.float32) for _, _, counts in samples]
    out = np.zeros((2, DIMENSIONS), np.float32)
    steps, step = EPOCHS * len(samples), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(samples)):
            label, buckets, _ = samples[k]
            rate = RATE * (1 - step / steps)
            step += 1
            own = vectors[buckets]
            mean = weights[k] @ own
            error = _softmax(out @ mean + bias)
            error[label] -= 1
            back = (rate * error @ out).astype(np.float32)
            out -= (0.05 * rate * np.outer(error, mean)).astype(np.float32)
            bias -= 0.01 * rate * error
            vectors[buckets] = own - weights[k][:, None] * back
            used[buckets] = True
    vectors[~used] = 0  # what no labelled document has says nothing
    return vectors @ (out[1] - out[0]), float(bias[1] - bias[0])


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max())
    return x / x.sum()


def score(text: str | None, gives: np.ndarray, bias: float, reader: C.Words) -> float:
    """The probability of label 1: the softmax of two classes, of which only the difference counts."""
    total = n = 0
    for k, piece in enumerate(pieces(text or "")):
        found = gives[features(piece, k == 0, reader)]
        total, n = total + found.sum(dtype=np.float64), n + len(found)
    x = min(max(bias + total / max(1, n), -700.0), 700.0)
    return 1 / (1 + float(np.exp(-x)))


def held_out(key: str = "id") -> Column:
    """Whether the labels of a document are kept for measuring."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == HELD_OUT


def chosen(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, th, hash, label, place): at most `SAMPLE` distinct labelled texts, by a hash of text and label."""
    known = labels.select(labels["doc_id"].cast("long").alias("id"), labels["quality"].cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out()).distinct()
    texts = C.keyed(docs).select("id", "th", F.xxhash64("text").alias("hash")).join(known, "id")
    once = texts.groupBy("th", "hash", "label").agg(F.min("id").alias("id"))
    ordered = once.withColumn("place", F.xxhash64("hash", "th", "label")).orderBy("place", "id")
    return C.written(ordered.limit(SAMPLE), "classifier-sample")


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """What the buckets give, and the bias, learned from a bounded sample of the labelled documents."""
    wanted = chosen(docs, labels)
    texts = C.keyed(docs).withColumn("hash", F.xxhash64("text")).join(F.broadcast(wanted), ["id", "th", "hash"])
    counted = C.written(C.map_rows(texts.select("label", "place", "text"), _counted,
                                   "label int, place bigint, n int, buckets array<int>, counts array<float>"),
                        "classifier-features")
    total, last = 0, None
    for place, n in counted.select("place", "n").distinct().orderBy("place").collect():  # SAMPLE rows at most
        last, total = place, total + n
        if total >= SAMPLE_FEATURES:
            break
    if last is None:
        return learned([])
    table = counted.where(F.col("place") <= last).dropDuplicates(["place", "label"]).orderBy("place", "label").toArrow()
    buckets, counts = (table.column(c).combine_chunks() for c in ("buckets", "counts"))
    return learned([(label, b.values.to_numpy(), c.values.to_numpy()) for label, b, c in zip(
        table.column("label").to_pylist(), buckets, counts, strict=True)])


def scored(docs: DataFrame, gives: np.ndarray, bias: float) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `docs`."""
    table = docs.sparkSession.sparkContext.broadcast(gives)

    def rows(batch: dict[str, list], reader: C.Words = C.Words()) -> Iterator[tuple]:  # noqa: B008
        for key, text in zip(batch["id"], batch["text"], strict=True):
            yield key, score(text, table.value, bias, reader)

    found = C.map_rows(C.keyed(docs).select("id", "text"), rows, "id bigint, score double")
    return found.select(C.true_id(), held_out().alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The quality of every document, learned from the labels."""
    return scored(docs, *fit(docs, labels))
