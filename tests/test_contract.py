"""Files that follow the trip contract, from reading to the cleaned table and its questions."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tripweave.operators import cleaning, graph, relational as R
from tripweave.sources import files, sinks

TRIPS = """trajet_id,velo_id,station_depart,station_arrivee,debut,fin,duree_min,distance_km,type_usager,electrique,tarif_eur
T1,V1,S001,S002,2026-01-03 08:00:00,2026-01-03 08:10:00,10.0,2.5,abonne,0,0.0
T1,V1,S001,S002,2026-01-03 08:00:00,2026-01-03 08:10:00,10.0,2.5,abonne,0,0.0
T2,V2,S001,S002,2026-01-05 08:30:00,2026-01-05 08:50:00,20.0,2.5,occasionnel,1,2.5
T3,V3,S002,S001,2026-01-05 17:00:00,2026-01-05 17:40:00,40.0,2.5,abonne,0,1.0
T4,V3,S002,S002,2026-01-06 17:00:00,2026-01-06 17:05:00,5.0,0.3,abonne,0,0.0
T5,V4,S003,S001,2026-01-06 09:00:00,2026-01-06 09:05:00,-5.0,1.0,abonne,0,0.0
T6,V5,S003,,2026-01-06 09:00:00,2026-01-06 09:05:00,5.0,1.0,abonne,0,0.0
T7,V6,S003,S001,2026-01-06 09:00:00,2026-01-06 09:05:00,5.0,1.0,,0,0.0
"""
STATIONS = """station_id,nom,quartier,latitude,longitude,capacite
S001,Gare Centrale,Gare,43.60,1.44,30
S002,Opéra,Centre,43.61,1.45,20
S003,Docks,Gare,43.62,1.46,25
"""
WEATHER = """date,temperature_c,pluie_mm
2026-01-03,4.5,0.0
2026-01-05,5.5,2.5
"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("contract")
    for name, text in (("trips", TRIPS), ("stations", STATIONS), ("weather", WEATHER)):
        (path / f"{name}.csv").write_text(text)
    return path


@pytest.fixture(scope="module")
def raw(spark, folder):
    return files.read_trips_csv(spark, str(folder / "trips.csv"))


@pytest.fixture(scope="module")
def stations(spark, folder):
    return files.read_stations_csv(spark, str(folder / "stations.csv"))


def test_defects_are_counted_then_removed(raw):
    assert tuple(cleaning.defect_profile(raw).first()) == (8, 1, 1, 1)
    assert cleaning.copy_count(raw).first()[0] == 1
    assert cleaning.clean_light(raw).count() == 6
    clean = cleaning.clean_trips(raw)
    assert rows(clean.select("trip_id", "hour", "weekday", "weekend")) == [
        ("T1", 8, 7, True), ("T2", 8, 2, False), ("T3", 17, 2, False), ("T4", 17, 3, False)]


def test_summary_keeps_the_unknown_type(raw):
    assert rows(R.rider_summary(raw)) == [("abonne", 6, 10.8), ("occasionnel", 1, 20.0), (None, 1, 5.0)]


def test_questions(spark, folder, raw, stations):
    clean = cleaning.clean_trips(raw)
    weather = files.read_weather_csv(spark, str(folder / "weather.csv"))
    assert rows(R.ranked_counts(R.with_district(clean, stations), "district")) == [("Centre", 2), ("Gare", 2)]
    assert rows(R.hour_by_rider(clean)) == [(17, 2, None), (8, 1, 1)]
    assert rows(R.rain_rate(spark, clean, weather)) == [("pluie faible", 1, 2.0), ("pluie forte", 1, 1.0), ("sec", 1, 1.0)]
    assert rows(R.top_pairs(clean, 1)) == [("S001", "S002", 2)]
    assert rows(R.with_weather(clean, weather).select("trip_id", "rain_mm")) == [
        ("T1", 0.0), ("T2", 2.5), ("T3", 2.5), ("T4", None)]
    arrivals = R.arrivals_with_station(raw, stations)
    assert arrivals.count() == 7  # the trip without a destination vanishes


def test_revenue_by_month_in_sql(spark, raw, stations):
    later = raw.withColumn("started_at", F.col("started_at") + F.expr("INTERVAL 31 DAYS"))
    two_months = R.with_district(cleaning.clean_trips(raw).unionByName(cleaning.clean_trips(later)), stations)
    assert rows(R.monthly_revenue(spark, two_months)) == [
        ("Centre", "2026-01", 1.0, None), ("Centre", "2026-02", 1.0, 0.0),
        ("Gare", "2026-01", 2.5, None), ("Gare", "2026-02", 2.5, 0.0)]


def test_cleaned_table_round_trip(spark, raw, tmp_path):
    clean = cleaning.clean_trips(raw)
    sinks.write_clean(clean, str(tmp_path / "clean"), max_files=2)
    again = files.load_or_rebuild(spark, str(tmp_path / "clean"), lambda: pytest.fail("must read"))
    assert set(again.columns) > {"trajet_id", "station_depart", "heure", "jour_semaine", "week_end"}
    assert rows(files.read_clean_parquet(spark, str(tmp_path / "clean"))) == rows(clean)
    counted = files.sql_on_parquet(spark, str(tmp_path / "clean"), "type_usager, count(*) AS n", "GROUP BY type_usager")
    assert rows(counted) == [("abonne", 3), ("occasionnel", 1)]


def test_network(raw, stations):
    edges = graph.build_edges(cleaning.clean_trips(raw))
    assert rows(edges) == [("S001", "S002", 2, 2.5), ("S002", "S001", 1, 2.5)]
    degrees = graph.degrees(graph.build_nodes(stations).select("id", "name", "district"), edges)
    assert rows(degrees)[2] == ("S003", "Docks", "Gare", 0, 0)
