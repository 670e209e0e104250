"""Spelling variants, quality classifier and periodic runs against brute force and held-out labels."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripweave.llm import classifier, common, debruijn, periods, spellings

FIELDS = "doc_id bigint, text string"
ODD = ("doc_id bigint, text string, id string, word string, n string, run string, th int, hash string, label double, "
       "place string, score string, start string, runs int, quality string")


def odd(spark, texts):
    return spark.createDataFrame([(i, t, *["1"] * 4, 1, "1", 1.0, *["1"] * 3, 1, "1") for i, t in texts], ODD)


# --- spelling variants -----------------------------------------------------------------------

def words_of(rows):
    """Word counts by the contract's words."""
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{(1 << 63) - 1 if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(rows):
    words = words_of(rows)
    near = {w: [v for v in words if one_edit(v, w)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def misspelt(seed, alphabet, sizes, n=400):
    rng = random.Random(seed)
    base = ["".join(rng.choices(alphabet, k=rng.choice(sizes))) for _ in range(12)]
    out = []
    for key in range(n):
        text = []
        for _ in range(15):
            w = rng.choice(base[:1 + rng.randrange(12)])
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w) + 1)
                w = w[:at] + rng.choice(["", rng.choice(alphabet)]) + w[at + rng.randrange(2):]
            text.append(rng.choice([str, str.upper, str.title])(w))
        out.append((key, rng.choice([" ", "\n", ", "]).join(text)))
    return out


@pytest.mark.parametrize("seed,alphabet,sizes", [
    (1, "ab", [5, 6, 7]), (2, "aéÿx", [5, 6, 9]), (3, "abc", [62, 63, 64, 65, 66, 90]), (4, "a", [4, 5, 63, 64, 66])])
def test_variants_of_words(spark, seed, alphabet, sizes):
    rows = misspelt(seed, alphabet, sizes)
    want = variants(rows)
    got = [tuple(r) for r in spellings.groups(spark.createDataFrame(rows, FIELDS)).select(
        "word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert any(f for _, f, *_ in want) or alphabet == "a"


def test_forms_lead_on_to_a_root(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 13, "aabbb": 30, "abbbb": 70, "bbbbb": 200}
    rows = [(k, w) for k, (w, n) in enumerate(counts.items()) for _ in range(n)]
    got = {r["word"]: r for r in spellings.groups(spark.createDataFrame(rows, FIELDS)).collect()}
    assert {w: n for w, n in counts.items()} == {w: r["n"] for w, r in got.items()} and got["aaaaa"]["form"] == "aaaab"
    assert {r["root"] for r in got.values()} == {"bbbbb"}


def test_words_of_odd_rows(spark):
    texts = [(None, "these words"), (None, "these words"), (1, "these wordS " * 3), (1, "these wordS " * 3), (2, None),
             (3, ""), (4, " \n"), (5, "x" * 60_000), (6, "x" * 60_000), (7, "x" * 60_000), (8, "x" * 59_999 + "y"),
             (9, "x" * 59_999 + "y"), (10, "x" * 59_999 + "y"), (11, "x" * 59_999 + "y"), (None, None)]
    got = {tuple(r) for r in spellings.groups(odd(spark, texts)).collect()}
    assert {(w[:6], len(w), n, near) for w, f, r, n, near, m in got} == {
        (w[:6], len(w), n, near) for w, f, r, n, near, m in variants(texts)} and got == variants(texts)
    assert spellings.groups(odd(spark, texts).limit(0)).collect() == []


# --- quality classifier ----------------------------------------------------------------------

def test_held_out_documents_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = classifier.report(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels).join(
        labels, "doc_id").toPandas()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"]]).all()
    kept = got[got["held_out"]]
    assert len(kept) > 800 and got["score"].between(0, 1).all()
    right = kept["predicted"] == kept["quality"]
    print(f"held out: {len(kept)} documents, accuracy {right.mean():.4f}")
    assert right[kept["quality"] == 1].mean() > 0.99 and right[kept["quality"] == 0].mean() > 0.95


def test_labels_held_out_are_not_read(spark):
    docs = spark.createDataFrame([(i, f"text {'good' if i % 2 else 'bad'} number {i}") for i in range(200)], FIELDS)
    right = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    wrong = right.withColumn("quality", F.when(classifier.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = ({r["doc_id"]: r["score"] for r in classifier.report(docs, x).collect()} for x in (right, wrong))
    assert one == two and all((one[i] > 0.5) == (i % 2 == 1) for i in one)


def test_a_long_text_scores_like_its_pieces(monkeypatch):
    rng = random.Random(3)
    text = " ".join("".join(rng.choices("abcdé", k=rng.randint(1, 7))) for _ in range(5000))
    gives = np.random.default_rng(1).normal(size=classifier.BUCKETS).astype(np.float32)
    whole = classifier.score(text, gives, 0.25, classifier.C.Words())
    for piece in (1, 7, 1000):
        monkeypatch.setattr(classifier, "PIECE", piece)
        assert classifier.score(text, gives, 0.25, classifier.C.Words()) == pytest.approx(whole, abs=1e-12)
    # all features of a small text, counted by hand
    reader = classifier.C.Words()
    (piece,) = classifier.pieces("ab\tab c")
    buckets = classifier.features(piece, True, reader)
    assert len(buckets) == 3 + 2 + 2 * (2 + 1) + 1 and (buckets == 1).sum() == 1


def test_scores_of_odd_rows(spark):
    texts = [(1, "good text here"), (1, "good text here"), (2, None), (3, ""), (4, " \n"), (None, "good text here"),
             (5, "x" * 1_000_000), (6, "bad " * 300_000), (7, "bad thing"), (8, "good thing"), (9, "fine"), (None, None)]
    docs = odd(spark, texts)
    labels = spark.createDataFrame([(1, 1), (1, 1), (7, 0), (8, 1), (8, 0), (2, 1), (3, None), (None, 1), (99, 0), (6, 5)],
                                   "doc_id bigint, quality int").withColumn("text", F.lit("x"))
    got = classifier.report(docs, labels).collect()
    assert sorted((r["doc_id"] for r in got), key=repr) == sorted((i for i, _ in texts), key=repr)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    by_text = {t: {r["score"] for r in got if r["doc_id"] in [i for i, x in texts if x == t]} for t in ("good text here",)}
    assert len({r["score"] for r in got if r["doc_id"] == 1}) == 1 and by_text
    for few, score in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0)):
        assert {round(r["score"], 6) for r in classifier.report(docs, few).collect()} == {score}
    assert classifier.report(docs.limit(0), labels).collect() == []


# --- periodic runs ---------------------------------------------------------------------------

def runs_of(w):
    """All runs (start, end, period) by trying every period."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1 if j == i else j
    return sorted(((a, b, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def sequences(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        w = [rng.randrange(rng.choice([1, 2, 2, 3, 5])) for _ in range(rng.randint(0, 130))]
        if rng.random() < 0.6 and len(w) > 4:
            a = rng.randrange(len(w))
            p = rng.randint(1, (len(w) - a) // 2 + 1)
            w[a:] = [w[a + (i - a) % p] for i in range(a, len(w))]
        if rng.random() < 0.2:
            x, y = [0], [0, 1]
            while len(y) < len(w):
                x, y = y, y + x
            w = y[:len(w)]
        yield w


def test_runs_word_by_word_and_at_once():
    rng = random.Random(9)
    for w in sequences(8, 300):
        want = runs_of(w)
        whole, parts, at = periods.Catchers(), periods.Catchers(), 0
        whole.append(np.array(w, np.int64))
        assert whole.runs() == want
        while at < len(w):
            more = w[at:at + rng.choice([1, 1, 2, 9, 40])]
            parts.append(np.array(more, np.int64))
            at += len(more)
            assert parts.runs() == runs_of(w[:at])


def digests(key, text):
    """A row of the contract, by brute force."""
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str((1 << 63) - 1 if key is None else key).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = runs_of(words)
    gone = {i for a, b, q in runs for i in range(a + q, b)}
    best = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    first = (best[0], best[1] - best[0], best[2], (best[1] - best[0]) * 1000 // best[2]) if best else (None,) * 4
    return (key, len(runs), *first, hashlib.sha256("".join(f"{a},{b - a},{q}\n" for a, b, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_runs_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 20000")
    want = sorted(digests(r["doc_id"], r["text"]) for r in docs.collect())
    got = sorted(tuple(r) for r in periods.scan(docs).select(*COLUMNS).collect())
    assert got == want and sum(r[1] > 0 for r in want) > 15


def test_runs_of_odd_rows(spark):
    texts = [(None, "a b " * 20), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, "x " * 3000), (4, "x " * 3000), (5, "é\x1cé " * 12),
             (6, "a b c d e f " * 2), (7, "a b c d e f " * 2 + "a"), (8, "a " * 11), (9, "x" * 1_000_000), (30, "one"),
             *((k, "p q r s t u v w x y z " * 2) for k in range(100, 140))]
    key = lambda r: repr(r[0])
    got = [tuple(r) for r in periods.scan(odd(spark, texts)).select(*COLUMNS).collect()]
    assert sorted(got, key=key) == sorted((digests(*t) for t in texts), key=key)
    assert periods.scan(odd(spark, texts).limit(0)).collect() == []
    long = "a b c " * 400_000  # a megabyte with one phrase
    row = periods.scan(odd(spark, [(1, long)])).first()
    assert (row["start"], row["length"], row["period"], row["n_kept"]) == (0, 1_200_000, 3, 3)


def test_collapsed_texts(spark):
    texts = [(1, "so it goes on " + "and on " * 9 + "until it ends"), (2, "no  run\nhere"), (3, None), (3, None)]
    got = periods.collapsed(odd(spark, texts))
    assert got.columns == odd(spark, texts).columns
    assert [(r["doc_id"], r["text"]) for r in got.orderBy("doc_id").collect()] == [
        (1, "so it goes on and until it ends"), (2, "no  run\nhere"), (3, None), (3, None)]


def test_spots_hold_text_hash_and_place_in_their_order(spark):
    pairs = [(th, place) for th in (-2**31, -5, 0, 7, 2**31 - 1) for place in (0, 1, 2**31 - 1)]
    made = spark.createDataFrame([((th << 32) | place,) for th, place in pairs], "spot bigint").orderBy("spot")
    assert [tuple(r) for r in made.select(debruijn._th_of("spot"), debruijn._place_of("spot")).collect()] == pairs
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60))), (2, " ".join(f"w{i}" for i in range(5, 60)))],
                                 "doc_id bigint, text string")
    found = debruijn.without_repeats(docs).select("id", "n_removed").collect()
    assert sorted(tuple(r) for r in found) == [(1, 0), (2, 55)]


def test_written_tables_leave_no_shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return sum(p.stat().st_size for d in manager.localDirs() for p in Path(d.getPath()).rglob("shuffle_*_*.data"))

    before, setting = shuffled(), spark.conf.get(common.SHUFFLE_CLEANUP)
    rows = spark.range(300_000).select(F.xxhash64("id").alias("k"))
    table = common.written(rows.repartition(4, "k"), "shuffled")
    assert shuffled() - before < 500_000  # 2.4 MB are shuffled
    assert table.count() == 300_000 and spark.conf.get(common.SHUFFLE_CLEANUP) == setting
