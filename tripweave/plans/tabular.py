"""Queries on files, projections, joins, aggregates, rankings and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripweave.functions import scalars
from tripweave.operators import cleaning, relational as R
from tripweave.operators.skew import previous_value
from tripweave.plans.registry import haversine_sql, key_hash_ctes, on_tables, query
from tripweave.session import cut_lineage, scratch_path, source_tag, split_size
from tripweave.sources import contracts as C
from tripweave.sources import files, sinks, tables as T

RIDER_SQL = on_tables("SELECT rider_type, count(*) AS trips, round(avg(duration_min), 4) AS mean_duration"
                      " FROM raw GROUP BY 1")


def by_rider(trips, rider="rider_type", duration="duration_min"):
    return trips.groupBy(F.col(rider).alias("rider_type")).agg(
        F.count("*").alias("trips"), F.round(F.avg(duration), 4).alias("mean_duration"))


def target(spark, sf_dir, name):
    return scratch_path(spark, source_tag(sf_dir), "out", name)


# --- flagship --------------------------------------------------------------------------------

@query("flagship_trips_by_district", "K1 D1 E1 G1", on_tables(
    "SELECT district, count(*) AS trips, round(avg(duration_min), 4) AS mean_duration,"
    " CAST(sum(CAST(fare_eur AS DECIMAL(18,2))) AS DOUBLE) AS revenue"
    " FROM clean LEFT JOIN stations ON origin = station_id GROUP BY 1"))
def flagship_trips_by_district(spark, sf_dir):
    clean = cleaning.clean_trips(T.raw_trips(spark, sf_dir))
    # totals per dock first: what meets the station table is one row per dock
    per_dock = clean.groupBy("origin").agg(
        F.count("*").alias("n"), F.sum("duration_min").alias("minutes"),
        F.sum(F.col("fare_eur").cast("decimal(18,2)")).alias("fares"))
    return (R.with_district(per_dock, T.stations(spark, sf_dir)).groupBy("district")
            .agg(F.sum("n").alias("trips"), F.round(F.sum("minutes") / F.sum("n"), 4).alias("mean_duration"),
                 F.sum("fares").cast("double").alias("revenue"))
            .orderBy(F.desc("trips"), "district"))


# --- A, B: files -----------------------------------------------------------------------------

@query("csv_inferred", "A1 E2", RIDER_SQL)
def csv_inferred(spark, sf_dir):
    trips = files.read_csv(spark, T.staged(spark, sf_dir, "trips_csv"), header=True, infer=True)
    return by_rider(trips, "type_usager", "duree_min")


@query("csv_raw_columns", "A2", on_tables("SELECT rider_type AS _c8, count(*) AS n FROM raw GROUP BY 1"))
def csv_raw_columns(spark, sf_dir):
    lines = files.read_csv(spark, T.staged(spark, sf_dir, "trips_csv"))
    return R.count_by(lines.where(F.col("_c0") != "trajet_id"), "_c8")


@query("csv_header_strings", "A3", on_tables(
    "SELECT electric::VARCHAR AS electrique, count(*) AS n FROM raw GROUP BY 1"))
def csv_header_strings(spark, sf_dir):
    return R.count_by(files.read_csv(spark, T.staged(spark, sf_dir, "trips_csv"), header=True), "electrique")


@query("csv_declared", "A4", on_tables(
    "SELECT origin, min(started_at) AS first_start, max(ended_at) AS last_end, count(*) AS trips FROM raw GROUP BY 1"))
def csv_declared(spark, sf_dir):
    trips = files.read_trips_csv(spark, T.staged(spark, sf_dir, "trips_csv"))
    return trips.groupBy("origin").agg(
        F.min("started_at").cast("timestamp_ntz").alias("first_start"),
        F.max("ended_at").cast("timestamp_ntz").alias("last_end"), F.count("*").alias("trips"))


@query("csv_ddl_schema", "A5", on_tables(
    "SELECT CAST(hour(started_at) AS INT) AS hour, round(avg(distance_km), 4) AS mean_km FROM raw GROUP BY 1"))
def csv_ddl_schema(spark, sf_dir):
    trips = files.read_trips_ddl(spark, T.staged(spark, sf_dir, "trips_csv"))
    return trips.groupBy(F.hour("started_at").alias("hour")).agg(F.round(F.avg("distance_km"), 4).alias("mean_km"))


@query("csv_malformed_modes", "A6", on_tables(
    "SELECT 'PERMISSIVE' AS mode, count(*) AS row_count, count(*) FILTER (destination IS NULL) AS null_durations"
    " FROM raw UNION ALL SELECT 'DROPMALFORMED', count(*), 0 FROM raw WHERE destination IS NOT NULL"))
def csv_malformed_modes(spark, sf_dir):
    path = T.staged(spark, sf_dir, "broken_csv")

    def profile(mode):
        # the malformed column must be parsed for the mode to act, so it is part of the aggregate
        trips = files.read_trips_ddl(spark, path, mode=mode)
        return trips.agg(F.lit(mode).alias("mode"), F.count("*").alias("row_count"),
                         F.count_if(F.col("duration_min").isNull()).alias("null_durations"))

    return profile("PERMISSIVE").unionByName(profile("DROPMALFORMED"))


@query("csv_failfast", "A6", on_tables(
    "SELECT 'broken' AS input, count(*) FILTER (destination IS NULL) > 0 AS refused FROM raw"
    " UNION ALL SELECT 'intact', false"))
def csv_failfast(spark, sf_dir):
    inputs = {"broken": "broken_csv", "intact": "trips_csv"}
    refused = [(name, files.first_parse_error(files.read_trips_ddl(spark, T.staged(spark, sf_dir, kind), mode="FAILFAST"))
                is not None) for name, kind in inputs.items()]
    return files.local_table(spark, refused, "input string, refused boolean")


@query("text_preview", "A8 B8", on_tables(
    "SELECT DISTINCT strftime(moment, '%Y-%m-%dT%H:%M:%S') || ' ' || station || ' ' || kind || ' velo=' || vehicle_id"
    " AS head FROM log WHERE kind = 'RETRAIT' ORDER BY head LIMIT 3"))
def text_preview(spark, sf_dir):
    lines = files.read_lines(spark, T.staged(spark, sf_dir, "log"))
    head = F.substring_index(F.col("value"), " badge=", 1).alias("head")
    return lines.where(F.col("value").contains(" badge=")).select(head).distinct().orderBy("head").limit(3)


@query("parquet_read", "A9 B1", on_tables("SELECT destination, count(*) AS n FROM clean GROUP BY 1"))
def parquet_read(spark, sf_dir):
    path = target(spark, sf_dir, "clean_contract")
    if not files.is_complete(spark, path):
        sinks.write_clean(T.clean_trips(spark, sf_dir), path)
    return R.count_by(files.read_clean_parquet(spark, path), "destination")


@query("parquet_file_ceiling", "B1 B9", on_tables("SELECT true AS within_ceiling, count(*) AS row_count FROM clean"))
def parquet_file_ceiling(spark, sf_dir):
    path = target(spark, sf_dir, "ceiling")
    # in the order of their ids the trips take less space; splits are small, as whole rows are sorted
    with split_size(spark, 4 * T.SPLIT_BYTES):
        sinks.write_bounded(T.clean_trips(spark, sf_dir).sortWithinPartitions("trip_id"), path, max_files=4)
    per_file = spark.read.parquet(path).groupBy("_metadata.file_path").agg(F.count("*").alias("n"))
    return per_file.agg((F.count("*") <= 4).alias("within_ceiling"), F.sum("n").alias("row_count"))


@query("sql_on_files", "A10", on_tables("SELECT rider_type, count(*) AS trips FROM clean GROUP BY 1"))
def sql_on_files(spark, sf_dir):
    return files.sql_on_parquet(spark, T.staged(spark, sf_dir, "clean"), "rider_type, count(*) AS trips",
                                "GROUP BY rider_type")


@query("read_or_rebuild", "A11", on_tables("SELECT electric, count(*) AS trips FROM clean GROUP BY 1"))
def read_or_rebuild(spark, sf_dir):
    missing = target(spark, sf_dir, "never_written")
    trips = files.load_or_rebuild(spark, missing, lambda: cleaning.clean_trips(
        files.read_trips_csv(spark, T.staged(spark, sf_dir, "trips_csv"))))
    return R.count_by(trips, "electric", alias="trips")


@query("json_batch", "A12", on_tables(
    "SELECT rider_type AS type_usager, count(*) AS trips, max(strftime(ended_at, '%Y-%m-%d %H:%M:%S')) AS last_end"
    " FROM raw GROUP BY 1"))
def json_batch(spark, sf_dir):
    trips = files.read_json(spark, T.staged(spark, sf_dir, "trips_json"))
    return trips.groupBy("type_usager").agg(F.count("*").alias("trips"), F.max("fin").alias("last_end"))


@query("local_table_join", "A13 D3", on_tables(
    "SELECT label, count(*) AS trips FROM clean JOIN (VALUES ('abonne', 'subscriber'), ('occasionnel', 'casual'))"
    " AS t(rider_type, label) USING (rider_type) GROUP BY 1"))
def local_table_join(spark, sf_dir):
    labels = files.local_table(spark, [(C.SUBSCRIBER, "subscriber"), (C.CASUAL, "casual")],
                               "rider_type string, label string")
    counts = R.count_by(T.clean_trips(spark, sf_dir), "rider_type", alias="trips")
    return counts.join(labels, "rider_type").select("label", "trips")


@query("range_calendar", "A15 D7", on_tables(
    "SELECT d::DATE AS date, coalesce(trips, 0) AS trips"
    " FROM (SELECT unnest(generate_series(min(started_at)::DATE, max(started_at)::DATE, INTERVAL 1 DAY)) AS d"
    "       FROM clean)"
    " LEFT JOIN (SELECT started_at::DATE AS d, count(*) AS trips FROM clean GROUP BY 1) USING (d)"))
def range_calendar(spark, sf_dir):
    per_day = R.count_by(T.clean_trips(spark, sf_dir).select(F.to_date("started_at").alias("date")), "date",
                         alias="trips")
    first, last = per_day.agg(F.min("date"), F.max("date")).first()
    days = spark.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))
    return R.from_full_key_set(days, per_day, "date", "trips", 0)


@query("read_else_rebuild", "A11", on_tables(
    "SELECT 'rebuilt' AS branch, electric, count(*) AS trips FROM clean GROUP BY 2"
    " UNION ALL SELECT 'read', electric, count(*) FROM clean WHERE duration_min > 30 GROUP BY 2"))
def read_else_rebuild(spark, sf_dir):
    """Both branches, told apart by their rows: the finished output holds the long trips only."""
    clean, long = T.clean_trips(spark, sf_dir), target(spark, sf_dir, "long_trips")
    sinks.write_clean(clean.where("duration_min > 30"), long)
    branches = {"rebuilt": files.load_or_rebuild(spark, target(spark, sf_dir, "never_written"), lambda: clean),
                "read": files.load_or_rebuild(spark, long, lambda: clean)}
    counts = [R.count_by(trips, "electric" if "electric" in trips.columns else C.rename_map(
        C.TRIP_FIELDS, to_external=True)["electric"], alias="trips").toDF("electric", "trips").select(
        F.lit(name).alias("branch"), F.col("electric").cast("int").alias("electric"), "trips")
        for name, trips in branches.items()]
    return counts[0].unionByName(counts[1])


@query("partitioned_by_month", "B2", on_tables(
    "SELECT month, count(*) AS trips, round(avg(distance_km), 4) AS mean_km"
    " FROM (SELECT *, strftime(started_at, '%Y-%m') AS month FROM clean) WHERE month = '1997-03' GROUP BY 1"))
def partitioned_by_month(spark, sf_dir):
    stored = spark.read.option("basePath", T.staged(spark, sf_dir, "months")).parquet(
        T.staged(spark, sf_dir, "months"))
    return stored.where(F.col("month") == "1997-03").groupBy("month").agg(
        F.count("*").alias("trips"), F.round(F.avg("distance_km"), 4).alias("mean_km"))


@query("single_text_report", "B3 I18", on_tables(
    "SELECT station_id || ';' || name || ';' || n AS value FROM (SELECT origin AS station_id, name, count(*) AS n"
    " FROM clean JOIN stations ON origin = station_id GROUP BY 1, 2 ORDER BY n DESC, 1 LIMIT 10)"))
def single_text_report(spark, sf_dir):
    counts = R.count_by(T.clean_trips(spark, sf_dir).withColumnRenamed("origin", "station_id"), "station_id")
    top = R.named_by_broadcast(counts, T.stations(spark, sf_dir)).orderBy(F.desc("n"), "station_id").limit(10)
    path = target(spark, sf_dir, "top_docks")
    sinks.write_single_text(top.select("station_id", "name", "n"), path)
    return files.read_lines(spark, path)


@query("storage_report", "B9")
def storage_report(spark, sf_dir):
    return sinks.storage_report(spark, csv=T.staged(spark, sf_dir, "trips_csv"),
                                parquet=T.staged(spark, sf_dir, "clean"))


@query("storage_rows", "B9", on_tables(
    "SELECT 'csv' AS label, count(*) AS row_count, true AS larger_than_parquet FROM raw UNION ALL"
    " SELECT 'parquet', count(*), false FROM clean"))
def storage_rows(spark, sf_dir):
    """The report's folders by what is in them, which SQL can count, and by size against each other."""
    paths = {"csv": T.staged(spark, sf_dir, "trips_csv"), "parquet": T.staged(spark, sf_dir, "clean")}
    size = {r["label"]: r["megabytes"] for r in sinks.storage_report(spark, **paths).collect()}
    tables = {"csv": spark.read.csv(paths["csv"], header=True), "parquet": spark.read.parquet(paths["parquet"])}
    parts = [df.agg(F.lit(label).alias("label"), F.count("*").alias("row_count"),
                    F.lit(size[label] > size["parquet"]).alias("larger_than_parquet")) for label, df in tables.items()]
    return parts[0].unionByName(parts[1])


# --- C: projections and predicates -----------------------------------------------------------

@query("project_columns", "C1", on_tables("SELECT name, district, capacity FROM stations"))
def project_columns(spark, sf_dir):
    return T.stations(spark, sf_dir).select("name", "district", "capacity")


@query("filter_long", "C2", on_tables("SELECT trip_id, duration_min FROM raw WHERE duration_min > 30"))
def filter_long(spark, sf_dir):
    return T.raw_trips(spark, sf_dir).where(F.col("duration_min") > 30).select("trip_id", "duration_min")


@query("filter_and_not", "C3 C2", on_tables(
    "SELECT trip_id, distance_km FROM raw WHERE distance_km >= 3 AND electric = 1 AND NOT (duration_min <= 40)"))
def filter_and_not(spark, sf_dir):
    keep = (F.col("distance_km") >= 3) & (F.col("electric") == 1) & ~(F.col("duration_min") <= 40)
    return T.raw_trips(spark, sf_dir).where(keep).select("trip_id", "distance_km")


@query("filter_sql_text", "C4 C7", on_tables(
    "SELECT origin, destination, count(*) AS trips FROM raw WHERE duration_min > 0 AND origin <> destination"
    " GROUP BY 1, 2"))
def filter_sql_text(spark, sf_dir):
    kept = T.raw_trips(spark, sf_dir).where("duration_min > 0").where("origin <> destination")
    return R.count_by(kept, "origin", "destination", alias="trips")


@query("null_predicates", "C5", on_tables(
    "SELECT count(*) FILTER (destination IS NULL) AS no_destination, count(*) FILTER (rider_type IS NOT NULL) AS typed,"
    " count(*) FILTER (destination IS NOT NULL AND rider_type IS NOT NULL) AS kept FROM raw"))
def null_predicates(spark, sf_dir):
    known = F.col("destination").isNotNull() & F.col("rider_type").isNotNull()
    return T.raw_trips(spark, sf_dir).agg(
        F.count_if(F.col("destination").isNull()).alias("no_destination"),
        F.count_if(F.col("rider_type").isNotNull()).alias("typed"), F.count_if(known).alias("kept"))


@query("drop_null_rows", "C5", on_tables(
    "SELECT origin, count(*) AS n FROM raw WHERE destination IS NOT NULL AND rider_type IS NOT NULL GROUP BY 1"))
def drop_null_rows(spark, sf_dir):
    return R.count_by(T.raw_trips(spark, sf_dir).dropna(subset=["destination", "rider_type"]), "origin")


@query("weekend_membership", "C6 I2", on_tables(
    "SELECT CAST(dayofweek(started_at) + 1 AS INT) AS weekday, dayofweek(started_at) IN (0, 6) AS weekend,"
    " count(*) AS n FROM raw GROUP BY 1, 2"))
def weekend_membership(spark, sf_dir):
    days = scalars.calendar("started_at")
    return R.count_by(T.raw_trips(spark, sf_dir).select(days["weekday"].alias("weekday"),
                                                        days["weekend"].alias("weekend")), "weekday", "weekend")


@query("drop_round_trips", "C7", on_tables(
    "SELECT count(*) FILTER (origin <> destination) AS links, count(*) FILTER (origin = destination) AS loops,"
    " count(*) FILTER (destination IS NULL) AS unknown FROM raw"))
def drop_round_trips(spark, sf_dir):
    return T.raw_trips(spark, sf_dir).agg(
        F.count_if(F.col("origin") != F.col("destination")).alias("links"),
        F.count_if(F.col("origin") == F.col("destination")).alias("loops"),
        F.count_if(F.col("destination").isNull()).alias("unknown"))


@query("computed_columns", "C8 I1 I9", on_tables(
    "SELECT trip_id, CAST(hour(started_at) AS INT) AS hour, round(duration_min / 60, 6) AS duration_h FROM clean"))
def computed_columns(spark, sf_dir):
    trips = T.clean_trips(spark, sf_dir).select("trip_id", "started_at", "duration_min")
    return trips.withColumn("hour", F.hour("started_at")).withColumn(
        "duration_h", F.round(F.col("duration_min") / 60, 6)).select("trip_id", "hour", "duration_h")


@query("rename_and_drop", "C9", on_tables("SELECT station_id AS id, name, district FROM stations"))
def rename_and_drop(spark, sf_dir):
    return T.stations(spark, sf_dir).withColumnRenamed("station_id", "id").drop("latitude", "longitude", "capacity")


@query("struct_fields", "C12 I5", "SELECT date_trunc('day', ts) AS window_start,"
       " date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, count(*) AS n FROM events GROUP BY 1, 2")
def struct_fields(spark, sf_dir):
    counts = T.table(spark, sf_dir, "events").groupBy(F.window("ts", "1 day").alias("window")).agg(
        F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n")


@query("random_sample_and_split", "C15")
def random_sample_and_split(spark, sf_dir):
    trips = T.clean_trips(spark, sf_dir).select("trip_id", "rider_type")
    sides = [R.count_by(side, "rider_type").withColumn("side", F.lit(name))
             for name, side in zip(("train", "test"), R.random_split(R.row_sample(trips)))]
    return sides[0].unionByName(sides[1])


@query("sample_and_split_sides", "C15", on_tables(
    "SELECT 0::BIGINT AS in_both, 0::BIGINT AS outside, true AS sampled, count(*) AS trips FROM clean"))
def sample_and_split_sides(spark, sf_dir):
    """Whatever the draw: no row is on both sides, none comes from elsewhere, and the shares are about as asked."""
    trips = T.clean_trips(spark, sf_dir).select("trip_id", "rider_type")
    sample = R.row_sample(trips)
    train, test = R.random_split(sample)
    marks = trips.select("trip_id", F.lit("all").alias("side")).unionByName(
        train.select("trip_id", F.lit("train").alias("side"))).unionByName(test.select("trip_id", F.lit("test").alias("side")))
    seen = marks.groupBy("trip_id").agg(*(F.count_if(F.col("side") == s).alias(s) for s in ("all", "train", "test")))
    return seen.agg(
        F.count_if((F.col("train") + F.col("test")) > F.col("all")).alias("in_both"),
        F.count_if(F.col("all") == 0).alias("outside"),
        ((F.sum(F.col("train") + F.col("test")) / F.sum("all")).between(0.15, 0.25)
         & (F.sum("train") > F.sum("test"))).alias("sampled"), F.sum("all").alias("trips"))


SIDES = key_hash_ctes("clean", "trip_id", "hashed") + (
    ", sides AS (SELECT *, (key_hash % 5 + 5) % 5 = 0 AS in_test FROM hashed)")


@query("hash_split_sides", "C16 I13", on_tables(
    "SELECT in_test, rider_type, count(*) AS n, CAST(sum(key_hash) AS BIGINT) AS hashes FROM sides GROUP BY 1, 2", SIDES))
def hash_split_sides(spark, sf_dir):
    train, test = R.hash_split(T.clean_trips(spark, sf_dir).select("trip_id", "rider_type"), "trip_id")
    sides = train.withColumn("in_test", F.lit(False)).unionByName(test.withColumn("in_test", F.lit(True)))
    return sides.groupBy("in_test", "rider_type").agg(F.count("*").alias("n"),
                                                      F.sum(F.hash("trip_id").cast("bigint")).alias("hashes"))


@query("baseline_accuracy", "E13 C16", on_tables(
    "SELECT round(avg(CASE WHEN rider_type = 'abonne' THEN 1.0::DOUBLE ELSE 0 END), 8) AS accuracy FROM sides"
    " WHERE in_test", SIDES))
def baseline_accuracy(spark, sf_dir):
    test = R.hash_split(T.clean_trips(spark, sf_dir).select("trip_id", "rider_type"), "trip_id")[1]
    return R.class_share(test, F.col("rider_type") == C.SUBSCRIBER, "accuracy").select(
        F.round("accuracy", 8).alias("accuracy"))


@query("hash_split_balance", "C16 I13", on_tables(
    "SELECT count(*) AS total, 0 AS in_both, true AS about_one_fifth FROM clean"))
def hash_split_balance(spark, sf_dir):
    train, test = R.hash_split(T.clean_trips(spark, sf_dir).select("trip_id"), "trip_id")
    sides = train.withColumn("test", F.lit(0)).unionByName(test.withColumn("test", F.lit(1)))
    per_id = sides.groupBy("trip_id").agg(F.count("*").alias("n"), F.sum("test").alias("test"))
    return per_id.agg(F.sum("n").alias("total"),
                      F.count_if((F.col("test") > 0) & (F.col("test") < F.col("n"))).cast("int").alias("in_both"),
                      (F.sum("test") / F.sum("n")).between(0.15, 0.25).alias("about_one_fifth"))


# --- D: joins --------------------------------------------------------------------------------

@query("left_join_dimension", "D1", on_tables(
    "SELECT trip_id, district FROM clean LEFT JOIN stations ON origin = station_id"))
def left_join_dimension(spark, sf_dir):
    return R.with_district(T.clean_trips(spark, sf_dir), T.stations(spark, sf_dir)).select("trip_id", "district")


@query("left_join_date", "D2 I3", on_tables(
    "SELECT trip_id, date, temperature_c, rain_mm FROM (SELECT trip_id, started_at::DATE AS date FROM clean)"
    " LEFT JOIN weather USING (date)"))
def left_join_date(spark, sf_dir):
    return R.with_weather(T.clean_trips(spark, sf_dir), T.weather(spark, sf_dir)).select(
        "trip_id", "date", "temperature_c", "rain_mm")


@query("inner_join_shared_name", "D3", on_tables(
    "SELECT district, rider_type, count(*) AS n FROM clean JOIN stations ON origin = station_id GROUP BY 1, 2"))
def inner_join_shared_name(spark, sf_dir):
    counts = R.count_by(T.clean_trips(spark, sf_dir), "origin", "rider_type")
    joined = R.with_district(counts, T.stations(spark, sf_dir), how="inner")
    return joined.groupBy("district", "rider_type").agg(F.sum("n").alias("n"))


@query("inner_join_other_names", "D4", on_tables(
    "SELECT trip_id, name AS arrival FROM raw JOIN stations ON destination = station_id"))
def inner_join_other_names(spark, sf_dir):
    return R.arrivals_with_station(T.raw_trips(spark, sf_dir), T.stations(spark, sf_dir)).select(
        "trip_id", F.col("name").alias("arrival"))


@query("lookup_by_broadcast", "D9", on_tables(
    "SELECT origin AS station_id, name, count(*) AS n FROM clean JOIN stations ON origin = station_id GROUP BY 1, 2"))
def lookup_by_broadcast(spark, sf_dir):
    counts = R.count_by(T.clean_trips(spark, sf_dir).withColumnRenamed("origin", "station_id"), "station_id")
    return R.named_by_broadcast(counts, T.stations(spark, sf_dir)).select("station_id", "name", "n")


@query("lookup_by_shuffle", "D10", on_tables(
    "SELECT origin AS station_id, name, count(*) AS n FROM clean JOIN stations ON origin = station_id GROUP BY 1, 2"))
def lookup_by_shuffle(spark, sf_dir):
    counts = R.count_by(T.clean_trips(spark, sf_dir).withColumnRenamed("origin", "station_id"), "station_id")
    return R.named_by_shuffle(counts, T.stations(spark, sf_dir)).select("station_id", "name", "n")


# --- E: aggregates ---------------------------------------------------------------------------

@query("group_count_ordered", "E1 C1", on_tables("SELECT district, count(*) AS n FROM stations GROUP BY 1"))
def group_count_ordered(spark, sf_dir):
    return R.ranked_counts(T.stations(spark, sf_dir), "district")


@query("group_null_is_a_group", "E2 I6", on_tables(
    "SELECT rider_type, count(*) AS trips, round(avg(duration_min), 1) AS mean_duration FROM raw GROUP BY 1"))
def group_null_is_a_group(spark, sf_dir):
    return R.rider_summary(T.raw_trips(spark, sf_dir))


@query("top_pairs", "E3 G2", on_tables(
    "SELECT origin, destination, count(*) AS trips FROM clean WHERE origin <> destination GROUP BY 1, 2"
    " ORDER BY trips DESC, 1, 2 LIMIT 5"))
def top_pairs(spark, sf_dir):
    return R.top_pairs(T.clean_trips(spark, sf_dir))


@query("pivot_hour_rider", "E4", on_tables(
    "SELECT hour, nullif(count(*) FILTER (rider_type = 'abonne'), 0) AS abonne,"
    " nullif(count(*) FILTER (rider_type = 'occasionnel'), 0) AS occasionnel FROM clean GROUP BY 1"))
def pivot_hour_rider(spark, sf_dir):
    return R.hour_by_rider(T.clean_trips(spark, sf_dir)).orderBy("hour")


@query("defect_profile", "E5 I10", on_tables(
    "SELECT count(*) AS raw_rows, count(*) FILTER (duration_min <= 0) AS bad_duration,"
    " count(*) FILTER (destination IS NULL) AS no_destination,"
    " count(*) FILTER (rider_type IS NULL) AS no_rider_type FROM raw"))
def defect_profile(spark, sf_dir):
    return cleaning.defect_profile(T.raw_trips(spark, sf_dir))


@query("copy_count", "E6 H3", on_tables(
    "SELECT (SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS copies"))
def copy_count(spark, sf_dir):
    return cleaning.copy_count(T.raw_trips(spark, sf_dir), cleaning.trip_print())


@query("rate_per_rain_class", "E7 I8", on_tables(
    "SELECT CASE WHEN rain_mm = 0 THEN 'sec' WHEN rain_mm < 5 THEN 'pluie faible' ELSE 'pluie forte' END AS weather,"
    " count(DISTINCT date) AS days, round(count(*) / count(DISTINCT date)) AS trips_per_day"
    " FROM (SELECT started_at::DATE AS date FROM clean) LEFT JOIN weather USING (date) GROUP BY 1"))
def rate_per_rain_class(spark, sf_dir):
    return R.rain_rate(spark, T.clean_trips(spark, sf_dir), T.weather(spark, sf_dir))


@query("group_count_sql", "E8 G3", on_tables(
    "SELECT district, count(*) AS trips FROM clean LEFT JOIN stations ON origin = station_id GROUP BY 1"))
def group_count_sql(spark, sf_dir):
    R.with_district(T.clean_trips(spark, sf_dir), T.stations(spark, sf_dir)).createOrReplaceTempView("district_trips")
    return spark.sql("SELECT district, count(*) AS trips FROM district_trips GROUP BY district ORDER BY trips DESC")


@query("top_k_sql", "G3", on_tables(
    "SELECT origin, count(*) AS n FROM clean GROUP BY 1 ORDER BY n DESC, origin LIMIT 5"))
def top_k_sql(spark, sf_dir):
    return spark.sql("SELECT origin, count(*) AS n FROM {trips} GROUP BY origin ORDER BY n DESC, origin LIMIT 5",
                     trips=T.clean_trips(spark, sf_dir))


@query("distinct_counts", "E9", on_tables(
    "SELECT count(*) AS row_count, count(DISTINCT trip_id) AS trips, count(DISTINCT vehicle_id) AS vehicles FROM raw"))
def distinct_counts(spark, sf_dir):
    return T.raw_trips(spark, sf_dir).agg(F.count("*").alias("row_count"),
                                          F.count_distinct("trip_id").alias("trips"),
                                          F.count_distinct("vehicle_id").alias("vehicles"))


@query("aggregate_of_aggregate", "E10", on_tables(
    "SELECT sum(n)::BIGINT AS trips, max(n) AS busiest, count(*) FILTER (n = top) AS reach_it"
    " FROM (SELECT n, max(n) OVER () AS top FROM (SELECT origin, count(*) AS n FROM clean GROUP BY 1))"))
def aggregate_of_aggregate(spark, sf_dir):
    per_size = R.count_by(R.count_by(T.clean_trips(spark, sf_dir), "origin"), "n", alias="docks")
    return per_size.agg(F.sum(F.col("n") * F.col("docks")).alias("trips"), F.max("n").alias("busiest"),
                        F.max_by("docks", "n").alias("reach_it"))


@query("latest_version_per_key", "E11 H4", on_tables(
    "SELECT vehicle_id, arg_max(destination, (started_at, trip_id)) AS destination,"
    " arg_max(duration_min, (started_at, trip_id)) AS duration_min FROM clean GROUP BY 1"))
def latest_version_per_key(spark, sf_dir):
    trips = T.clean_trips(spark, sf_dir).select(
        "vehicle_id", F.struct("started_at", "trip_id").alias("version"), "destination", "duration_min")
    return R.latest_version(trips, ["vehicle_id"], "version")


@query("pandas_api_mean", "E12", on_tables(
    "SELECT rider_type, round(avg(duration_min), 4) AS duration_min FROM clean GROUP BY 1"))
def pandas_api_mean(spark, sf_dir):
    means = R.mean_by_pandas_api(T.clean_trips(spark, sf_dir), "rider_type", "duration_min")
    return means.withColumn("duration_min", F.round("duration_min", 4))


@query("class_share", "E13", on_tables(
    "SELECT round(avg(CASE WHEN rider_type = 'abonne' THEN 1.0::DOUBLE ELSE 0 END), 6) AS share FROM clean"))
def class_share(spark, sf_dir):
    return R.class_share(T.clean_trips(spark, sf_dir), F.col("rider_type") == C.SUBSCRIBER).select(
        F.round("share", 6).alias("share"))


@query("sum_of_squares", "E18 C14", on_tables(
    "SELECT CAST(sum(CAST(duration_min AS BIGINT) * CAST(duration_min AS BIGINT)) AS BIGINT) AS squares,"
    " CAST(sum(CASE WHEN CAST(duration_min AS BIGINT) % 2 = 0 THEN CAST(duration_min AS BIGINT)"
    " * CAST(duration_min AS BIGINT) END) AS BIGINT) AS even_squares FROM clean"))
def sum_of_squares(spark, sf_dir):
    x = F.col("duration_min").cast("bigint")
    return T.clean_trips(spark, sf_dir).agg(F.sum(x * x).alias("squares"),
                                            F.sum(F.when(x % 2 == 0, x * x)).alias("even_squares"))


@query("word_count", "E19 I14", r"""
    SELECT word, count(*) AS n FROM (
      SELECT unnest(regexp_split_to_array(text, '[\s\x0B\x1C-\x1F\x{85}\pZ]+')) AS word FROM documents)
    WHERE word <> '' GROUP BY 1""")
def word_count(spark, sf_dir):
    return R.count_by(scalars.words(T.table(spark, sf_dir, "documents"), "text"), "word")


@query("clean_balance", "E23", on_tables(
    "SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM raw) - count(*) AS copies,"
    " count(*) FILTER (duration_min <= 0) AS bad_duration,"
    " count(*) FILTER (duration_min > 0 AND (destination IS NULL OR rider_type IS NULL)) AS missing_facts,"
    " (SELECT count(*) FROM clean) AS clean_rows, true AS balanced FROM (SELECT DISTINCT * FROM raw)"))
def clean_balance(spark, sf_dir):
    return cleaning.clean_balance(T.raw_trips(spark, sf_dir))


# --- F, G, H: windows, ordering, sets --------------------------------------------------------

_PER_DOCK = ("per_dock AS (SELECT district, origin, count(*) AS n FROM clean JOIN stations ON origin = station_id"
             " GROUP BY 1, 2)")


@query("rank_busiest_dock", "F1", on_tables(
    "SELECT district, origin, n FROM (SELECT *, rank() OVER (PARTITION BY district ORDER BY n DESC) AS position"
    " FROM per_dock) WHERE position = 1", _PER_DOCK))
def rank_busiest_dock(spark, sf_dir):
    counts = R.count_by(T.clean_trips(spark, sf_dir), "origin")
    docks = R.with_district(counts, T.stations(spark, sf_dir), how="inner")
    return R.busiest_in_group(docks, "district").select("district", "origin", "n")


@query("favourite_arrival", "F2 D4", on_tables(
    "SELECT district, destination, n FROM (SELECT *, row_number() OVER (PARTITION BY district ORDER BY n DESC,"
    " destination) AS position FROM per_arrival) WHERE position = 1",
    "per_arrival AS (SELECT district, destination, count(*) AS n FROM raw JOIN stations ON destination = station_id"
    " GROUP BY 1, 2)"))
def favourite_arrival(spark, sf_dir):
    counts = R.count_by(T.raw_trips(spark, sf_dir), "destination")
    docks = R.with_district(counts, T.stations(spark, sf_dir), how="inner", at="destination")
    return R.favourite_in_group(docks, "district", tie="destination").select("district", "destination", "n")


@query("monthly_revenue_change", "F3 I4", on_tables(
    "SELECT district, month, CAST(revenue AS DOUBLE) AS revenue,"
    " CAST(revenue - lag(revenue) OVER (PARTITION BY district ORDER BY month) AS DOUBLE) AS change"
    " FROM (SELECT district, strftime(started_at, '%Y-%m') AS month, sum(CAST(fare_eur AS DECIMAL(18,2))) AS revenue"
    "       FROM clean LEFT JOIN stations ON origin = station_id GROUP BY 1, 2)"))
def monthly_revenue_change(spark, sf_dir):
    return R.monthly_revenue(spark, R.with_district(T.clean_trips(spark, sf_dir), T.stations(spark, sf_dir)))


@query("sort_two_keys", "G1 G2", on_tables(
    "SELECT station_id, name, capacity FROM stations ORDER BY capacity DESC, name LIMIT 3"))
def sort_two_keys(spark, sf_dir):
    return T.stations(spark, sf_dir).orderBy(F.desc("capacity"), "name").select(
        "station_id", "name", "capacity").limit(3)


@query("arg_max_hour", "G5 E20", on_tables(
    "SELECT hour, count(*) AS n FROM clean GROUP BY 1 ORDER BY n DESC, hour LIMIT 1"))
def arg_max_hour(spark, sf_dir):
    per_hour = R.count_by(T.clean_trips(spark, sf_dir), "hour")
    return per_hour.agg(F.max_by(F.struct("hour", "n"), F.struct("n", -F.col("hour"))).alias("top")).select("top.*")


@query("union_by_name_distinct", "H1 H2", on_tables(
    "SELECT origin AS id FROM raw UNION SELECT destination FROM raw WHERE destination IS NOT NULL"))
def union_by_name_distinct(spark, sf_dir):
    trips = T.raw_trips(spark, sf_dir)
    starts = trips.select(F.col("origin").alias("id")).distinct()
    ends = trips.where(F.col("destination").isNotNull()).select(F.col("destination").alias("id")).distinct()
    return starts.unionByName(ends).distinct()


@query("one_row_per_key", "H4", on_tables(
    "SELECT origin, min(started_at) AS started_at, arg_min(trip_id, (started_at, trip_id)) AS trip_id"
    " FROM clean GROUP BY 1"))
def one_row_per_key(spark, sf_dir):
    trips = T.clean_trips(spark, sf_dir).select("origin", "started_at", "trip_id")
    return R.one_per_key(trips, ["origin"], ["started_at"])


@query("without_seen", "D6", on_tables(
    "SELECT station_id FROM stations WHERE station_id NOT IN (SELECT destination FROM clean"
    " WHERE origin = 'S001')"))
def without_seen(spark, sf_dir):
    seen = T.clean_trips(spark, sf_dir).where(F.col("origin") == "S001").select(
        F.col("destination").alias("station_id")).distinct()
    return R.not_in(T.stations(spark, sf_dir).select("station_id"), seen, "station_id")


# --- I, N: scalar functions ------------------------------------------------------------------

@query("calendar_columns", "I1 I2 I3 I4", "SELECT event_id, CAST(hour(ts) AS INT) AS hour,"
       " CAST(dayofweek(ts) + 1 AS INT) AS weekday, dayofweek(ts) IN (0, 6) AS weekend, ts::DATE AS date,"
       " strftime(ts, '%H:%M') AS label FROM events")
def calendar_columns(spark, sf_dir):
    return T.table(spark, sf_dir, "events").select(
        "event_id", *[c.alias(n) for n, c in scalars.calendar("ts").items()], F.to_date("ts").alias("date"),
        F.date_format("ts", "HH:mm").alias("label"))


@query("classify_duration", "I7", on_tables(
    "SELECT CASE WHEN duration_min < 10 THEN 'court' WHEN duration_min < 30 THEN 'moyen' ELSE 'long' END AS class,"
    " count(*) AS n FROM raw GROUP BY 1"))
def classify_duration(spark, sf_dir):
    return R.count_by(T.raw_trips(spark, sf_dir).select(
        scalars.duration_class(F.col("duration_min")).alias("class")), "class")


@query("default_and_literal", "I11 D7 C10", on_tables(
    "SELECT station_id, coalesce(n, 0) AS n, 'docked' AS state FROM stations LEFT JOIN"
    " (SELECT destination AS station_id, count(*) AS n FROM clean WHERE duration_min > 60 GROUP BY 1)"
    " USING (station_id)"))
def default_and_literal(spark, sf_dir):
    late = T.clean_trips(spark, sf_dir).where("duration_min > 60").withColumnRenamed("destination", "station_id")
    keys = T.stations(spark, sf_dir).select("station_id")
    counted = R.from_full_key_set(keys, R.count_by(late, "station_id"), "station_id", "n", 0)
    return counted.withColumn("state", F.lit("docked"))


@query("haversine_km", "N1", on_tables(
    "SELECT a.station_id, round(" + haversine_sql("a.latitude", "a.longitude", "b.latitude", "b.longitude")
    + ", 6) AS km FROM stations a JOIN stations b ON b.station_id = printf('S%03d',"
    " CAST(substr(a.station_id, 2) AS INT) + 1)"))
def haversine_km(spark, sf_dir):
    here = T.stations(spark, sf_dir).select("station_id", "latitude", "longitude")
    # each dock against the next one in number
    number = F.substring("station_id", 2, 10).cast("int")
    after = here.select(T.dock_id(number - 1).alias("station_id"), F.col("latitude").alias("lat_b"),
                        F.col("longitude").alias("lon_b"))
    km = scalars.great_circle_km(F.col("latitude"), F.col("longitude"), F.col("lat_b"), F.col("lon_b"))
    return here.join(after, "station_id").select("station_id", F.round(km, 6).alias("km"))


@query("fare_by_rule", "N2", on_tables(
    "SELECT rider_type, electric, CAST(sum(CAST(fare_eur AS DECIMAL(18,2))) AS DOUBLE) AS revenue,"
    " min(fare_eur) AS least, max(fare_eur) AS most FROM clean GROUP BY 1, 2"))
def fare_by_rule(spark, sf_dir):
    trips = T.clean_trips(spark, sf_dir)
    price = scalars.fare(F.col("duration_min"), F.col("rider_type"), F.col("electric"))
    return trips.withColumn("price", price).groupBy("rider_type", "electric").agg(
        F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("revenue"),
        F.min("price").alias("least"), F.max("price").alias("most"))


# --- K: cleaning and layout ------------------------------------------------------------------

@query("clean_trips", "K1", on_tables("SELECT * FROM clean"))
def clean_trips(spark, sf_dir):
    return cleaning.clean_trips(T.raw_trips(spark, sf_dir))


@query("clean_light", "K2", on_tables(
    "SELECT origin, count(*) AS trips, count(DISTINCT trip_id) AS ids FROM (SELECT DISTINCT * FROM raw"
    " WHERE duration_min > 0) GROUP BY 1"))
def clean_light(spark, sf_dir):
    return cleaning.clean_light(T.raw_trips(spark, sf_dir)).groupBy("origin").agg(
        F.count("*").alias("trips"), F.count_distinct("trip_id").alias("ids"))


@query("repartition_profile", "K6 K7", on_tables("SELECT 8 AS partitions, count(*) AS row_count FROM clean"))
def repartition_profile(spark, sf_dir):
    profile = R.partition_profile(T.clean_trips(spark, sf_dir).repartition(8, "trip_id"))
    return profile.agg(F.count("*").cast("int").alias("partitions"), F.sum("rows").alias("row_count"))


@query("cached_reuse", "K5", on_tables(
    "SELECT 'hour' AS part, hour AS slot, count(*) AS n FROM clean GROUP BY 2"
    " UNION ALL SELECT 'weekday', weekday, count(*) FROM clean GROUP BY 2"))
def cached_reuse(spark, sf_dir):
    # one narrow projection serves both branches from the cache
    slots = T.clean_trips(spark, sf_dir).select("hour", "weekday").cache()
    parts = [R.count_by(slots.select(F.lit(name).alias("part"), F.col(name).alias("slot")), "part", "slot")
             for name in ("hour", "weekday")]
    result = cut_lineage(parts[0].unionByName(parts[1]))
    slots.unpersist()
    return result


@query("previous_trip_of_vehicle", "E21 F3", on_tables(
    "SELECT trip_id, lag(destination) OVER (PARTITION BY vehicle_id ORDER BY started_at, trip_id) AS previous"
    " FROM clean"))
def previous_trip_of_vehicle(spark, sf_dir):
    trips = T.clean_trips(spark, sf_dir).select("vehicle_id", "started_at", "trip_id", "destination")
    return previous_value(trips, "vehicle_id", [F.col("started_at"), F.col("trip_id")], "destination",
                          chunk=F.date_trunc("hour", "started_at")).select("trip_id", "previous")
