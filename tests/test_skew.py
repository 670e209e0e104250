from __future__ import annotations

import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripweave.operators import relational as R
from tripweave.operators.skew import fits_broadcast, hot_keys, lookup_join, previous_value, salted_join


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on one key, some without a key, the rest spread."""
    rng = random.Random(7)
    data = [(i, "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(200)}", rng.randrange(1000))
            for i in range(3000)]
    return spark.createDataFrame(data, "id int, key string, t int").cache()


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"N{i}") for i in range(150)], "key string, name string")


def test_hot_keys(facts):
    assert rows(hot_keys(facts, "key", shares=5)) == [("hot",)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_is_exact_beyond_the_broadcast_bound(facts, dim, how):
    expected = rows(facts.join(dim, "key", how).select("id", "name"))
    assert rows(lookup_join(facts, dim, "key", how).select("id", "name")) == expected
    split = lookup_join(facts, dim, "key", how, max_rows=10, shares=20)
    assert rows(split.select("id", "name")) == expected


def test_large_branch_reads_the_facts_once(spark, dim, tmp_path):
    spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 150) END AS key").write.parquet(
        str(tmp_path / "facts"))
    stored = spark.read.parquet(str(tmp_path / "facts"))
    plan = lookup_join(stored, dim, "key", max_rows=10, shares=5)._jdf.queryExecution().executedPlan().toString()
    # the facts are the only table in files here; a plan's text shortens long paths
    assert plan.count("FileScan parquet") == 1 and "SinglePartition" not in plan


def test_bound_is_checked(dim):
    assert fits_broadcast(dim, 151) and not fits_broadcast(dim, 150)


def test_salted_join(facts, dim):
    assert rows(salted_join(facts, dim, "key", spread="id", salts=4).select("id", "name")) == rows(
        facts.join(dim, "key").select("id", "name"))


@pytest.mark.parametrize("width", [1, 7, 100, 10_000])
def test_previous_value_equals_one_window(facts, width):
    order = [F.col("t"), F.col("id")]
    expected = facts.withColumn("previous", F.lag("id").over(Window.partitionBy("key").orderBy(*order)))
    chunked = previous_value(facts, "key", order, "id", chunk=F.floor(F.col("t") / width))
    assert rows(chunked.select("id", "previous")) == rows(expected.select("id", "previous"))


def test_look_back_shuffles_the_rows_once(facts):
    """Beside the rows, only one value a piece is shuffled: by piece, by key, and back to the rows."""
    found = previous_value(facts.withColumn("wide", F.lit("w")), "key", [F.col("t"), F.col("id")], "id",
                           chunk=F.floor(F.col("t") / 100))
    plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
    exchanges = [k for k, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    below = [" ".join(plan[k + 1:k + 3]) for k in exchanges]
    assert len(exchanges) >= 3 and len([line for line in below if "max_by" not in line and "_last" not in line]) == 1, below


def test_rank_is_limited_before_the_shuffle(facts):
    counts = R.count_by(facts, "key", "t")
    for ranked in (R.busiest_in_group(counts, "key"), R.favourite_in_group(counts, "key", tie="t")):
        assert "WindowGroupLimit" in plan_of(ranked)


def test_rank_keeps_ties_and_row_number_does_not(spark):
    counts = spark.createDataFrame([("d", "b", 5), ("d", "a", 5), ("d", "c", 1)], "g string, k string, n int")
    assert rows(R.busiest_in_group(counts, "g").select("k")) == [("a",), ("b",)]
    assert rows(R.favourite_in_group(counts, "g", tie="k").select("k")) == [("a",)]


def test_broadcast_and_shuffled_lookups_agree(facts, dim):
    counts = R.count_by(facts.where("key IS NOT NULL"), "key").withColumnRenamed("key", "station_id")
    stations = dim.withColumnRenamed("key", "station_id")
    shuffled = R.named_by_shuffle(counts, stations)
    assert rows(R.named_by_broadcast(counts, stations)) == rows(shuffled)
    assert "SortMergeJoin" in plan_of(shuffled)
