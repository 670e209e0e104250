"""Copies are found by fingerprints, and told apart by their rows."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tripweave.operators import cleaning
from tripweave.sources import tables as T

NAN = float("nan")


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    data = [(rng.randrange(40), rng.choice([None, "a", "b"]), rng.choice([None, "a", "b"]), rng.choice([0.0, 1.5, None]))
            for _ in range(500)]
    # hashing skips nulls, so these pairs share a fingerprint without being copies
    data += [(100, None, "x", 1.0), (100, "x", None, 1.0), (101, "y", None, None), (101, None, "y", None)]
    data += [(200, "hot", "hot", 2.0)] * 400
    return spark.createDataFrame(data, "k int, a string, b string, x double").repartition(6)


def expected(df):
    return Counter(tuple(r) for r in df.collect())


PRINTS = {"all columns": lambda: None, "one column": lambda: F.xxhash64("k"),
          "every row the same": lambda: F.lit(7).cast("long"), "null": lambda: F.lit(None).cast("long")}


@pytest.mark.parametrize("name", sorted(PRINTS))
@pytest.mark.parametrize("most", [0, cleaning.REPEATED])
def test_colliding_fingerprints_lose_no_row(table, name, most):
    want, of = expected(table), PRINTS[name]()
    kept = cleaning.drop_copies(table, of, most)
    assert kept.columns == table.columns and rows(kept) == sorted(want, key=repr)
    sizes = {tuple(r)[:-1]: r[-1] for r in cleaning.copy_sizes(table, of, most).collect()}
    assert sizes == want
    assert cleaning.copy_count(table, of, most).first()[0] == sum(want.values()) - len(want)


def test_fingerprints_do_collide_here(spark, table):
    pair = table.where("k = 100")
    assert pair.select(cleaning.fingerprint(table)).distinct().count() == 1 and cleaning.drop_copies(pair).count() == 2


def test_equal_numbers_have_equal_fingerprints(spark):
    table = spark.createDataFrame([(0.0,), (-0.0,), (NAN,), (NAN,), (None,), (None,)], "x double")
    assert cleaning.drop_copies(table).count() == 3 == table.dropDuplicates().count()


def test_empty_table(table):
    none = table.limit(0)
    assert cleaning.drop_copies(none).count() == 0 and cleaning.copy_count(none).first()[0] == 0


def shuffled(spark) -> int:
    """Bytes that all stages so far have written for shuffles."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    jvm = spark.sparkContext._jvm
    stages = sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0),
                                        jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_whole_rows_are_not_shuffled(spark):
    raw = T.raw_trips(spark, "/root/testdata/sf0.01")
    start = shuffled(spark)
    whole = raw.groupBy(*raw.columns).agg(F.count("*").alias("n")).agg(F.sum(F.col("n") - 1)).first()[0]
    middle = shuffled(spark)
    assert cleaning.copy_count(raw, cleaning.trip_print()).first()[0] == whole
    assert 0 < shuffled(spark) - middle < (middle - start) / 4
