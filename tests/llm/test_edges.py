"""Nulls, empty and long texts, repeated rows, ties, empty tables and clashing columns, for every operator and stage."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from tripweave.llm import (
    debruijn,
    decontaminate,
    jaccard,
    lattice,
    licenses,
    lines,
    quality,
    secrets,
    suffixes,
    token_counts,
)

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, id string, id_ int, th int, "
          "n_words string, kept int, words_ string, token_ids string, label double, features string, component_id int")
random.seed(5)
WORDS = ["".join(random.choices("abcdefghij", k=random.randint(2, 9))) for _ in range(400)]


def prose(n: int, seed: int) -> str:
    chosen = random.Random(seed).choices(WORDS, k=n)
    return "\n".join(" ".join(chosen[k:k + 12]) for k in range(0, n, 12))


PASSAGE, LONG = prose(120, 1), prose(9000, 2)
ITEM = "the quick brown fox jumps over the lazy dog while seven wizards box with a jovial queen"
TEXTS = [
    (1, PASSAGE), (2, PASSAGE), (2, PASSAGE), (3, PASSAGE + " " + prose(6, 3)), (4, None), (4, None), (5, ""), (6, " \n\t \n"),
    (7, LONG), (8, "three short words"), (9, "three short words"), (None, PASSAGE), (None, None), (None, "three short words"),
    (10, prose(60, 9)), (10, prose(60, 10)), (11, f"{prose(30, 4)}\n{ITEM}\n{prose(30, 5)}"),
    (12, 'token = "cf1d64a9a4cd9723e1f4eafc27395915e6868ffa" licensed under the MIT License'),
    (13, "é ▁ \U0001F600 　   tab\tend"), (14, "x" * 3000),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i == 3 else "en", None, None if t is None else len(t), *[None] * 10) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, ITEM)], "item_id bigint, text string")


REPORTS = {
    "lines": lines.report, "debruijn": debruijn.report, "lattice": lattice.report, "counts": token_counts.counts,
    "suffixes": suffixes.report, "licenses": licenses.scan, "secrets": secrets.scan, "quality": quality.report,
    "jaccard": jaccard.report,
}
ONE_EACH = ["lines", "debruijn", "lattice", "counts", "licenses", "quality", "jaccard"]


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_odd_rows(name, docs):
    out = REPORTS[name](docs).collect()
    ids = sorted((r["doc_id"] for r in out), key=repr)
    if name in ONE_EACH:
        assert ids == sorted((i for i, _ in TEXTS), key=repr)
    by_id = {}
    for r in out:
        by_id.setdefault(r["doc_id"], []).append(r.asDict())
    if name in ONE_EACH:  # a repeated row has the same result twice
        assert by_id[2][0] == by_id[2][1] and by_id[4][0] == by_id[4][1]
    if name == "jaccard":
        assert {r["component_id"] for i in (1, 2, 3) for r in by_id[i]} == {1}
        assert by_id[4][0]["n_shingles"] == 0 and by_id[8][0]["n_shingles"] == 1
        assert by_id[9][0]["component_id"] == 8 and by_id[5][0]["component_id"] == 5
        assert sorted(r["component_id"] or 0 for r in by_id[None]) == [0, 1, 8]
    if name == "debruijn":
        assert by_id[1][0]["n_removed"] == 0 and by_id[2][0]["n_removed"] == 120 == by_id[3][0]["n_removed"]
        assert sorted(r["n_removed"] for r in by_id[None]) == [0, 0, 120]
        assert [r["n_removed"] for r in by_id[10]] == [0, 0] and by_id[7][0]["n_words"] == 9000
    if name == "suffixes":
        assert set(by_id) == {1, 2, 3, None}
    if name == "lines":
        assert by_id[4][0]["kept_text"] is None and by_id[5][0]["kept_text"] == ""
        assert by_id[1][0]["n_removed"] == 0 < by_id[2][0]["n_removed"]
    if name == "lattice":
        assert all(r["round_trip"] for i, r in ((r["doc_id"], r) for r in out) if r["token_ids"] is not None)
        assert by_id[4][0]["token_ids"] is None and by_id[5][0]["token_ids"] == []
    if name == "counts":
        assert by_id[4][0]["n_tokens"] == 0 == by_id[5][0]["n_tokens"]
    if name == "secrets":
        assert set(by_id) == {12}
    if name == "licenses":
        assert by_id[12][0]["base_labels"] == "mit" and by_id[12][0]["first_word"] == by_id[12][0]["last_word"] == 5
        assert by_id[4][0]["n_words"] == 0 and by_id[4][0]["first_word"] is None and by_id[4][0]["labels"] == ""
    if name == "quality":
        assert all(r["base_failed"] and not r["kept"] for i in (4, 5, 6, 8) for r in by_id[i])


def test_items_are_found_in_odd_rows(docs, bench):
    out = decontaminate.matches(docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["edits"]) for r in out) == [(11, 1, 0), (11, 4, 0)]
    assert decontaminate.matches(docs, bench.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_empty_tables(name, spark):
    assert REPORTS[name](spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_keep_odd_columns(name, stage, docs, bench, spark, tmp_path):
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    out = stage(spark, docs, str(tmp_path))
    last = name == corpus_pipeline.STAGES[-1][0]
    assert out.columns[:len(docs.columns)] == docs.columns and (last or out.columns == docs.columns)
    assert [f.dataType for f in out.schema][:len(docs.columns)] == [f.dataType for f in docs.schema]
    ids = [r["doc_id"] for r in out.collect()]
    if last:
        assert len(ids) == len(TEXTS)
    if name == "line dedup":  # copies that lose all their words go, texts that came without words stay
        assert set(ids) >= {1, 4, 5, 6, 7, 8, 10, 11, 12, 13, 14} and ids.count(4) == 2
        assert len(ids) < len(TEXTS) or all(r["text"] is None or r["doc_id"] in (5, 6) or r["text"].split() for r in out.collect())
    if name == "n-gram Jaccard join":  # copies, a near copy and the repeated row go; texts without words stay
        assert sorted(ids, key=repr) == sorted([1, 4, 5, 6, 7, 8, 10, 10, 11, 12, 13, 14, None], key=repr)
    if name == "benchmark decontamination":
        assert sorted(ids, key=repr) == sorted([i for i, _ in TEXTS if i != 11], key=repr)
    empty = stage(spark, docs.limit(0), str(tmp_path))
    assert empty.count() == 0 and empty.columns == out.columns
