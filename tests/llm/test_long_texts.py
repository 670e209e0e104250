"""Long texts, whole values and short benchmark items: nothing is cut, and work stays in proportion to the text."""

from __future__ import annotations

import hashlib
import random
import time

from tripweave.llm import decontaminate, licenses, secrets

FIELDS = "doc_id bigint, text string"


def test_places_of_a_phrase_in_a_megabyte():
    start = time.time()
    n, places = licenses.base_places("mit license and " * 80_000)
    assert n == 240_000 and [w for w, _ in places] == list(range(0, 240_000, 3))
    assert licenses.base_places("x mit license mit license cc by") == (7, [(1, "mit"), (3, "mit"), (5, "cc-by")])
    assert time.time() - start < 30


def test_values_are_taken_whole():
    rng = random.Random(2)
    run = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=2100))
    assert secrets.places(f"see {run} there") == [(4, run)]
    assert secrets.places(f'password = "{run}!#"') == [(12, run + "!#")]
    assert secrets.places("token=secret=password=abc12345 end") == [
        (0, "token=secret=password=abc12345"), (22, "abc12345")]  # the run of characters, and the innermost value
    assert secrets.places("token=abc12345 secret: 'x y' pwd:='12345678'") == [(6, "abc12345"), (35, "12345678")]
    start = time.time()
    for text in ("token=" * 200_000, "x" * 1_000_000, "token=abcdefgh1 " * 60_000, "token " * 200_000, "a." * 500_000):
        found = secrets.places(text)
        assert sum(len(v) for _, v in found) <= 2 * len(text)
    assert time.time() - start < 60


def test_planted_secrets_in_documents(spark, sf_dir):
    """Values assigned to credential names in given documents are found; digests of revisions are not."""
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    planted, decoys = {}, {}
    for k, (i, text) in enumerate(rows):
        if k % 4 == 0:
            value = "".join(rng.choices(letters, k=rng.choice([20, 32, 40]))) + "7a1B9"
            planted[i] = hashlib.sha256(value.encode()).hexdigest()
            rows[k] = (i, f"{text}\n{rng.choice(['password', 'api_key', 'token', 'client_secret'])} = \"{value}\"\n")
        elif k % 4 == 2:
            value = hashlib.sha1(str(k).encode()).hexdigest()
            decoys[i] = hashlib.sha256(value.encode()).hexdigest()
            rows[k] = (i, f"{text}\ncommit {value} of the revision\n")
    found = secrets.scan(spark.createDataFrame(rows, FIELDS)).collect()
    secret = {(r["doc_id"], r["digest"]) for r in found}
    caught = sum((i, d) in secret for i, d in planted.items()) / len(planted)
    spared = sum((i, d) not in secret for i, d in decoys.items()) / len(decoys)
    print(f"planted secrets found {caught:.3f}, decoys spared {spared:.3f}")
    assert caught > 0.97 and spared > 0.97


def test_short_items_match_where_they_stand_unchanged(spark):
    items = [(1, "seven wizards"), (2, "ox"), (3, "Two  Plus\ntwo?"), (4, " \n"), (5, None),
             (6, "the quick brown fox jumps over the lazy dog and on")]
    rows = [(1, "so seven\nWIZARDS box"), (2, "seven wizardss"), (3, "xseven wizards"), (4, "seven wizards"), (5, "box"),
            (6, "an ox"), (7, "is two plus two? yes"), (8, "the quick brwn fox jumps over the lazy dog and on"), (9, None), (10, "")]
    docs, bench = spark.createDataFrame(rows, FIELDS), spark.createDataFrame(items, "item_id bigint, text string")
    want = {(1, 1, 0), (4, 1, 0), (6, 2, 0), (7, 3, 0), (8, 6, 1)}
    for chars in (500_000, 8):  # one block; more blocks than a task keeps
        got = {(r["doc_id"], r["item_id"], r["edits"]) for r in decontaminate.matches(docs, bench, chars).collect()}
        assert got == want
    assert {r["doc_id"] for r in decontaminate.clean(docs, bench).collect()} == {2, 3, 5, 9, 10}
