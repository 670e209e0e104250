"""Queries on the kiosk log, in DataFrame form and on the pair-collection surface."""

from __future__ import annotations

from operator import add

from pyspark.sql import functions as F

from tripweave.functions import logs as L
from tripweave.operators import logs as O, rdd as P
from tripweave.operators.relational import count_by, named_by_broadcast
from tripweave.plans.registry import on_tables, query
from tripweave.sources import contracts as C
from tripweave.sources import files, tables as T

STATION = r"^S\d{3,}$"  # docks beyond number 999 keep all their digits


def lines(spark, sf_dir):
    return files.read_lines(spark, T.staged(spark, sf_dir, "log"))


def parsed(spark, sf_dir):
    return L.parse_lines(lines(spark, sf_dir), STATION)


def events(spark, sf_dir):
    return L.valid_events(parsed(spark, sf_dir))


def pair_events(spark, sf_dir):
    return P.parse_events(P.text_lines(spark, T.staged(spark, sf_dir, "log")), STATION)


def station_names(spark, sf_dir):
    return T.stations(spark, sf_dir).select("station_id", "name").rdd.map(tuple)


BY_KIND = on_tables("SELECT kind, count(*) AS n FROM log GROUP BY 1")
TOP_ERRORS = on_tables("SELECT station AS station_id, name, count(*) AS errors FROM log"
                       " JOIN stations ON station = station_id WHERE kind = 'ERREUR' GROUP BY 1, 2"
                       " ORDER BY errors DESC, 1 LIMIT 10")
CODES = on_tables("SELECT code, message, count(*) AS n FROM log JOIN error_codes ON slot = m % 4"
                  " WHERE kind = 'ERREUR' GROUP BY 1, 2")
BATTERY = on_tables("SELECT count(*) AS pickups, round(avg(battery), 6) AS mean_battery FROM log"
                    " WHERE battery IS NOT NULL")
BATTERY_BY_STATION = on_tables("SELECT station, round(avg(battery), 6) AS mean_battery FROM log"
                               " WHERE battery IS NOT NULL GROUP BY 1")


@query("log_events", "K3 I14 I15 I16 N3", on_tables(
    "SELECT strftime(moment, '%Y-%m-%dT%H:%M:%S') AS ts, station, kind, vehicle_id AS vehicle, battery::INT AS battery"
    " FROM log WHERE kind <> 'ERREUR' UNION ALL SELECT strftime(moment, '%Y-%m-%dT%H:%M:%S'), station, kind, NULL, NULL"
    " FROM log WHERE kind = 'ERREUR'"))
def log_events(spark, sf_dir):
    return events(spark, sf_dir).select("ts", "station", "kind", L.field("velo").alias("vehicle"),
                                        L.int_field("batterie").alias("battery"))


@query("log_reject_counts", "E22 K3", on_tables(
    "SELECT count(*) AS lines, count(*) FILTER (NOT is_cut) AS valid, count(*) FILTER (is_cut) AS rejected"
    " FROM log_all"))
def log_reject_counts(spark, sf_dir):
    return O.reject_report(parsed(spark, sf_dir))


@query("log_rejected_lines", "K3", on_tables(
    "SELECT substr(strftime(moment, '%Y-%m-%dT%H:%M:%S') || ' ' || station || ' ' || kind || ' velo=' || vehicle_id"
    " || CASE kind WHEN 'RETRAIT' THEN ' badge=' || CASE rider_type WHEN 'abonne' THEN 'A-' ELSE 'O-' END"
    " || (10000 + m * 7) ELSE ' duree=' || duration_min END, 1, CAST(cut AS INT)) AS value FROM log_all WHERE is_cut"))
def log_rejected_lines(spark, sf_dir):
    return L.rejected_lines(parsed(spark, sf_dir)).select("value")


@query("log_loose_rejects", "K4", on_tables(
    "SELECT count(*) AS lines, count(*) FILTER (is_cut AND cut < 22 + length(station)) AS rejected FROM log_all"))
def log_loose_rejects(spark, sf_dir):
    return L.loose_parts(lines(spark, sf_dir)).agg(F.count("*").alias("lines"),
                                                   F.count_if(~F.col("kept")).alias("rejected"))


@query("log_substring_filter", "C13", on_tables(
    "SELECT station, count(*) AS n FROM log WHERE kind = 'ERREUR' GROUP BY 1"))
def log_substring_filter(spark, sf_dir):
    failures = lines(spark, sf_dir).where(F.col("value").contains(C.ERROR))
    return count_by(failures.select(F.split("value", " ", 4)[1].alias("station")), "station")


@query("log_by_kind", "E14", BY_KIND)
def log_by_kind(spark, sf_dir):
    return count_by(events(spark, sf_dir), "kind")


@query("log_top_errors", "D9 G4", TOP_ERRORS)
def log_top_errors(spark, sf_dir):
    named = named_by_broadcast(O.errors_by_station(events(spark, sf_dir)), T.stations(spark, sf_dir))
    return named.select("station_id", "name", "errors").orderBy(F.desc("errors"), "station_id").limit(10)


@query("log_error_codes", "E15", CODES)
def log_error_codes(spark, sf_dir):
    return O.error_codes(events(spark, sf_dir))


@query("log_mean_battery", "E16 I19", BATTERY)
def log_mean_battery(spark, sf_dir):
    return O.pickup_battery(events(spark, sf_dir)).withColumn("mean_battery", F.round("mean_battery", 6))


@query("log_battery_by_station", "E17", BATTERY_BY_STATION)
def log_battery_by_station(spark, sf_dir):
    return O.pickup_battery(events(spark, sf_dir), "station").select(
        "station", F.round("mean_battery", 6).alias("mean_battery"))


@query("log_errors_by_hour", "E20", on_tables(
    "SELECT CAST(hour(moment) AS INT) AS hour, count(*) AS errors FROM log WHERE kind = 'ERREUR' GROUP BY 1"))
def log_errors_by_hour(spark, sf_dir):
    return O.errors_by_hour(events(spark, sf_dir))


@query("log_vehicles_picked_up", "E9", on_tables(
    "SELECT count(DISTINCT vehicle_id) AS vehicles FROM log WHERE kind = 'RETRAIT'"))
def log_vehicles_picked_up(spark, sf_dir):
    return O.vehicles_picked_up(events(spark, sf_dir))


@query("log_deposit_after_pickup", "E21", on_tables(
    "SELECT vehicle_id, count(*) AS deposits, count(*) FILTER (first_pickup IS NULL OR first_pickup >= moment)"
    " AS orphans FROM (SELECT vehicle_id, kind, moment, min(moment) FILTER (kind = 'RETRAIT')"
    " OVER (PARTITION BY vehicle_id) AS first_pickup FROM log WHERE kind <> 'ERREUR') WHERE kind = 'DEPOT' GROUP BY 1"))
def log_deposit_after_pickup(spark, sf_dir):
    return O.deposits_without_pickup(events(spark, sf_dir))


@query("log_sequence_check", "E21", on_tables(
    "SELECT vehicle_id, count(*) FILTER (kind = 'DEPOT') AS deposits,"
    " count(*) FILTER (kind = 'DEPOT' AND previous IS DISTINCT FROM 'RETRAIT') AS out_of_turn"
    " FROM (SELECT *, lag(kind) OVER (PARTITION BY vehicle_id ORDER BY moment, kind) AS previous FROM log"
    " WHERE kind <> 'ERREUR') GROUP BY 1"))
def log_sequence_check(spark, sf_dir):
    return O.deposits_out_of_turn(events(spark, sf_dir))


# --- pair-collection twins -------------------------------------------------------------------

@query("rdd_by_kind", "A7 E14", BY_KIND)
def rdd_by_kind(spark, sf_dir):
    return P.to_table(P.count_by_key(pair_events(spark, sf_dir).map(lambda e: e[2])), spark, "kind string, n bigint")


@query("rdd_reject_count", "E22", on_tables("SELECT count(*) FILTER (is_cut) AS rejected FROM log_all"))
def rdd_reject_count(spark, sf_dir):
    rejected = spark.sparkContext.accumulator(0)
    kept = P.parse_events(P.text_lines(spark, T.staged(spark, sf_dir, "log")), STATION, rejected).cache()
    kept.count()
    kept.unpersist()
    return files.local_table(spark, [(rejected.value,)], "rejected bigint")


@query("rdd_top_errors", "G4 D9 I17", TOP_ERRORS)
def rdd_top_errors(spark, sf_dir):
    errors = P.count_by_key(pair_events(spark, sf_dir).filter(lambda e: e[2] == C.ERROR).map(lambda e: e[1]))
    # names come from the lines of a delimited file with a header
    cells = P.table_lines(P.text_lines(spark, T.staged(spark, sf_dir, "stations_csv")), "station_id,")
    named = P.broadcast_names(errors, cells.map(lambda c: (c[0], c[1])))
    top = named.takeOrdered(10, key=lambda row: (-row[2], row[0]))
    return files.local_table(spark, top, "station_id string, name string, errors bigint")


@query("rdd_join_errors", "D10", TOP_ERRORS)
def rdd_join_errors(spark, sf_dir):
    errors = P.count_by_key(pair_events(spark, sf_dir).filter(lambda e: e[2] == C.ERROR).map(lambda e: e[1]))
    named = P.joined_names(errors, station_names(spark, sf_dir))
    top = named.takeOrdered(10, key=lambda row: (-row[2], row[0]))
    return files.local_table(spark, top, "station_id string, name string, errors bigint")


@query("rdd_error_codes", "E15 G6", CODES)
def rdd_error_codes(spark, sf_dir):
    keys = pair_events(spark, sf_dir).filter(lambda e: e[2] == C.ERROR).map(
        lambda e: (e[3]["code"], e[3]["message"]))
    rows = P.count_by_key(keys).sortByKey().map(lambda item: (*item[0], item[1]))
    return P.to_table(rows, spark, "code string, message string, n bigint")


@query("rdd_mean_battery", "E16", on_tables(
    "SELECT round(avg(battery), 6) AS mean_battery FROM log WHERE battery IS NOT NULL"))
def rdd_mean_battery(spark, sf_dir):
    levels = pair_events(spark, sf_dir).filter(lambda e: e[2] == C.PICKUP and "batterie" in e[3]).map(
        lambda e: int(e[3]["batterie"]))
    return files.local_table(spark, [(P.mean(levels),)], "mean_battery double").select(
        F.round("mean_battery", 6).alias("mean_battery"))


@query("rdd_battery_by_station", "E17", BATTERY_BY_STATION)
def rdd_battery_by_station(spark, sf_dir):
    levels = pair_events(spark, sf_dir).filter(lambda e: e[2] == C.PICKUP and "batterie" in e[3]).map(
        lambda e: (e[1], int(e[3]["batterie"])))
    return P.to_table(P.mean_by_key(levels), spark, "station string, mean_battery double").select(
        "station", F.round("mean_battery", 6).alias("mean_battery"))


@query("rdd_sum_of_squares", "E18 C14 A14", on_tables(
    "SELECT CAST(sum(battery * battery) AS BIGINT) AS squares,"
    " CAST(sum(battery * battery) FILTER (battery % 2 = 0) AS BIGINT) AS even_squares FROM log"))
def rdd_sum_of_squares(spark, sf_dir):
    levels = pair_events(spark, sf_dir).filter(lambda e: "batterie" in e[3]).map(lambda e: int(e[3]["batterie"]))
    squares = levels.map(lambda x: x * x)
    even = squares.filter(lambda x: x % 2 == 0)
    # the sums of either collection, put together again from a local one
    sums = P.local_collection(spark, [("all", squares.fold(0, add)), ("even", even.fold(0, add))], slices=2)
    sums = tuple(n for _, n in sums.sortByKey().collect())
    return files.local_table(spark, [sums], "squares bigint, even_squares bigint")


@query("rdd_word_count", "E19", r"""
    SELECT word, count(*) AS n FROM (
      SELECT unnest(regexp_split_to_array(text, '[\s\x0B\x1C-\x1F\x{85}\pZ]+')) AS word FROM documents)
    WHERE word <> '' GROUP BY 1""")
def rdd_word_count(spark, sf_dir):
    texts = T.table(spark, sf_dir, "documents").select("text").rdd
    return P.to_table(P.count_by_key(texts.flatMap(lambda row: (row.text or "").split())), spark, "word string, n bigint")


@query("rdd_partition_sizes", "K7 K6", on_tables("SELECT 6 AS partitions, count(*) AS row_count FROM log_all"))
def rdd_partition_sizes(spark, sf_dir):
    slices = P.text_lines(spark, T.staged(spark, sf_dir, "log")).repartition(6)
    sizes = P.to_table(P.partition_sizes(slices), spark, "partition int, elements bigint")
    return sizes.agg(F.count("*").cast("int").alias("partitions"), F.sum("elements").alias("row_count"))
