from __future__ import annotations

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from tripweave.functions import scalars
from tripweave.operators import cleaning, relational as R
from tripweave.sources import tables as T


def test_clean_accounts_for_every_row(spark, sf_dir):
    balance = cleaning.clean_balance(T.raw_trips(spark, sf_dir)).first()
    assert balance["balanced"] and balance["copies"] > 0 and balance["bad_duration"] > 0
    assert T.clean_trips(spark, sf_dir).count() == balance["clean_rows"]


def test_scan_reads_needed_columns_only(spark, sf_dir):
    plan = plan_of(R.count_by(T.raw_trips(spark, sf_dir), "origin"))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert "l_extendedprice" not in schema and "l_shipdate" not in schema


def test_filters_reach_the_scan(spark, sf_dir):
    plan = plan_of(T.clean_trips(spark, sf_dir).where("duration_min > 60").select("trip_id"))
    assert "PushedFilters: [IsNotNull(duration_min), GreaterThan(duration_min,60.0)]" in plan


def test_dataframe_and_sql_forms_agree(spark, sf_dir):
    trips = R.with_district(T.clean_trips(spark, sf_dir), T.stations(spark, sf_dir))
    trips.createOrReplaceTempView("trips_for_sql")
    in_sql = spark.sql("SELECT district, count(*) AS n FROM trips_for_sql GROUP BY district")
    assert rows(in_sql) == rows(R.count_by(trips, "district"))


def test_transformations_start_no_job(spark, sf_dir):
    trips = T.raw_trips(spark, sf_dir)
    spark.sparkContext.setJobGroup("lazy", "")
    try:
        R.rider_summary(trips.where("duration_min > 30"))
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("lazy") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_duration_classes(spark):
    table = spark.createDataFrame([(9.9,), (10.0,), (29.9,), (30.0,), (None,)], "d double")
    classes = [r[0] for r in table.select(scalars.duration_class(F.col("d"))).collect()]
    assert classes == ["court", "moyen", "moyen", "long", "long"]


@pytest.mark.parametrize("minutes, rider, electric, price", [
    (30.0, "abonne", 0, 0.0), (30.5, "abonne", 0, 1.0), (60.0, "abonne", 1, 1.5), (61.0, "abonne", 0, 2.0),
    (10.0, "occasionnel", 0, 1.5), (10.0, "occasionnel", 1, 2.0)])
def test_fare(spark, minutes, rider, electric, price):
    row = spark.createDataFrame([(minutes, rider, electric)], "m double, r string, e int")
    assert row.select(scalars.fare(F.col("m"), F.col("r"), F.col("e"))).first()[0] == price


def test_great_circle(spark):
    one_degree = spark.range(1).select(scalars.great_circle_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    assert one_degree.first()[0] == pytest.approx(111.1949, abs=1e-3)


def test_calendar(spark):
    days = spark.sql("SELECT TIMESTAMP_NTZ '2026-03-01 23:59:00' AS ts UNION ALL SELECT TIMESTAMP_NTZ '2026-03-02 00:00:00'")
    found = rows(days.select(*scalars.calendar("ts").values()))
    assert found == [(0, 2, False), (23, 1, True)]


def test_murmur_split_value(spark):
    row = spark.createDataFrame([("T0000001",)], "id string")
    assert row.select(F.pmod(F.hash("id"), F.lit(5))).first()[0] == 1


def test_hash_split_does_not_depend_on_partitioning(spark, sf_dir):
    trips = T.clean_trips(spark, sf_dir).select("trip_id")
    first = R.hash_split(trips, "trip_id")[1]
    second = R.hash_split(trips.repartition(7), "trip_id")[1]
    assert rows(first) == rows(second)


def test_one_per_key_is_deterministic(spark):
    table = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y")], "k string, o int, v string")
    assert rows(R.one_per_key(table.repartition(3), ["k"], ["o"])) == [("a", 1, "y")]


def test_latest_version(spark):
    table = spark.createDataFrame([("w", 3, 1.0, 0), ("w", 5, 2.0, 1), ("x", 1, 9.0, 0)],
                                  "k string, n int, m double, batch int")
    assert rows(R.latest_version(table, ["k"], "batch")) == [("w", 5, 2.0), ("x", 1, 9.0)]


def test_partition_profile(spark):
    assert R.partition_profile(spark.range(80).repartition(8)).count() == 8
    assert R.partition_profile(spark.range(80).repartition(8).coalesce(1)).count() == 1


def test_trips_are_not_shuffled_to_meet_the_stations(spark, sf_dir):
    trips = T.clean_trips(spark, sf_dir)
    for joined in (R.with_district(trips, T.stations(spark, sf_dir)),
                   R.arrivals_with_station(trips, T.stations(spark, sf_dir)),
                   R.with_weather(trips, T.weather(spark, sf_dir))):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning(origin" not in plan
