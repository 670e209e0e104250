"""Trips, stations, weather and the kiosk log seen through a star schema's tables.

A shipment line plays a trip: the supplier is the origin dock, the part's home supplier the
destination, the quantity the duration. All rules are integer arithmetic on the row's own
columns, so the trip table needs one scan and no join, and a SQL engine can state the same rules.
The source tables are clean; the defects the cleaning operators exist for (negative durations,
missing destinations and rider types, exact copies, truncated log lines) are derived from the
row's keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions import logs, scalars
from tripweave.operators import cleaning
from tripweave.session import scratch_path, source_tag, split_size
from tripweave.sources import contracts as C
from tripweave.sources import files, sinks

SPLIT_BYTES = 8 << 20  # about half a million shipment lines, which are two to four hundred bytes each once they are trips
PARTS_PER_DOCK = 20  # the star schema has twenty parts per supplier at every scale


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def numbered(prefix: str, number: Column, digits: int) -> Column:
    """`prefix` and the number with leading zeros; longer numbers keep all their digits."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) < digits, F.lpad(text, digits, "0")).otherwise(text))


def dock_id(number: Column) -> Column:
    return numbered("S", number, 3)


def dock_latitude(number: Column) -> Column:
    return 43.5 + (number * 37) % 1000 / 1e4


def dock_longitude(number: Column) -> Column:
    return 1.3 + (number * 59) % 1000 / 8e3


def defect_key() -> Column:
    return (F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_suppkey") * 7 + F.col("l_linenumber")) % 2000


def _trip_columns(lineitem: DataFrame) -> DataFrame:
    here, there = F.col("l_suppkey"), F.expr(f"l_partkey div {PARTS_PER_DOCK}")
    minute = (F.col("l_partkey") * 7 + F.col("l_orderkey") * 13 + F.col("l_suppkey") * 3) % 1440
    flight = scalars.great_circle_km(dock_latitude(here), dock_longitude(here),
                                     dock_latitude(there), dock_longitude(there))
    casual = F.col("l_returnflag") == "R"
    return lineitem.select(
        defect_key().alias("m"), "l_orderkey", "l_linenumber",
        F.concat_ws("-", F.concat(F.lit("T"), F.col("l_orderkey").cast("string")), "l_linenumber", "l_partkey",
                    "l_suppkey").alias("trip_id"),
        numbered("V", F.expr("l_orderkey div 10"), 4).alias("vehicle_id"),
        dock_id(here).alias("origin"),
        dock_id(there).alias("destination"),
        (F.col("l_shipdate") + F.make_dt_interval(mins=minute.cast("int"))).alias("started_at"),
        (F.col("l_quantity") + F.when(casual, 12.0).otherwise(0.0)).alias("duration_min"),
        F.round(F.greatest(F.lit(0.3), flight * 1.25), 2).alias("distance_km"),
        F.when(casual, C.CASUAL).otherwise(C.SUBSCRIBER).alias("rider_type"),
        (F.col("l_linenumber") % 3 == 0).cast("int").alias("electric"),
    ).withColumns({
        "ended_at": F.col("started_at") + F.make_dt_interval(mins=F.col("duration_min").cast("int")),
        "fare_eur": scalars.fare(F.col("duration_min"), F.col("rider_type"), F.col("electric")),
    })


TRIP_COLUMNS = [inner for _, inner, _ in C.TRIP_FIELDS]


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with their defects, as collection would deliver them."""
    trips = _trip_columns(table(spark, sf_dir, "lineitem"))
    m = F.col("m")
    copies = F.when(m.isin(17, 1017), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return trips.withColumns({
        "duration_min": F.when(m.isin(7, 1007), -F.col("duration_min")).otherwise(F.col("duration_min")),
        "destination": F.when(~m.isin(11, 1011), F.col("destination")),
        "rider_type": F.when(m != 13, F.col("rider_type")),
        "copy": F.explode(copies),
    }).select(TRIP_COLUMNS)


def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned trips, cleaned once per application and then read from the shared folder."""
    path = staged(spark, sf_dir, "clean")
    return spark.read.parquet(path)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier; its region is the district."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    number = F.col("s_suppkey")
    return (table(spark, sf_dir, "supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(dock_id(number).alias("station_id"), F.col("s_name").alias("name"),
                    F.col("r_name").alias("district"),
                    dock_latitude(number).alias("latitude"), dock_longitude(number).alias("longitude"),
                    (15 + 5 * (number % 6)).cast("int").alias("capacity")))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order day: urgent orders play the rain, the dearest order the temperature."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return (table(spark, sf_dir, "orders")
            .groupBy(F.to_date("o_orderdate").alias("date"))
            .agg(F.round(F.max("o_totalprice") / 2e4, 1).alias("temperature_c"),
                 F.count_if(urgent).cast("double").alias("rain_mm")))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kiosk log of the undamaged trips: `at` and the line, some lines cut short."""
    trips = _trip_columns(table(spark, sf_dir, "lineitem"))
    m = F.col("m")
    kept = trips.where(~m.isin(7, 1007, 11, 1011))
    error = F.when((m % 100).isin(3, 36, 69), F.element_at(
        F.array(*[F.struct(F.lit(code).alias("code"), F.lit(text).alias("message")) for code, text in C.LOG_ERRORS]),
        (m % len(C.LOG_ERRORS) + 1).cast("int")))
    cut = (8 + (m * 13 + F.col("l_orderkey")) % 38).cast("int")
    badge = F.concat(F.when(F.col("rider_type") == C.SUBSCRIBER, "A-").otherwise("O-"),
                     (10000 + m * 7).cast("string"))
    return logs.trip_lines(
        kept, badge=badge, battery=F.when(F.col("electric") == 1, 15 + m % 85), error=error,
        cut_pickup=F.when(m.isin(21, 521, 1021, 1521), cut), cut_deposit=F.when(m.isin(23, 523, 1023, 1523), cut))


def staged(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Path of a derived copy in the shared folder, written at the first call of an application."""
    path = scratch_path(spark, source_tag(sf_dir), kind)
    if not files.is_complete(spark, path):
        with split_size(spark, SPLIT_BYTES):
            _stage(spark, sf_dir, kind, path)
    return path


def _stage(spark: SparkSession, sf_dir: str, kind: str, path: str) -> None:
    external = C.rename_map(C.TRIP_FIELDS, to_external=True)
    if kind == "clean":
        cleaning.clean_trips(raw_trips(spark, sf_dir)).write.mode("overwrite").parquet(path)
    elif kind == "trips_csv":
        sinks.write_csv(raw_trips(spark, sf_dir).withColumnsRenamed(external), path)
    elif kind == "trips_json":
        sinks.write_json(raw_trips(spark, sf_dir).withColumnsRenamed(external), path)
    elif kind == "stations_csv":
        sinks.write_csv(stations(spark, sf_dir).select(*(inner for _, inner, _ in C.STATION_FIELDS)).withColumnsRenamed(
            C.rename_map(C.STATION_FIELDS, to_external=True)), path)
    elif kind == "broken_csv":
        trips = raw_trips(spark, sf_dir)
        bad = F.when(F.col("destination").isNull(), "N/A").otherwise(F.col("duration_min").cast("string"))
        sinks.write_csv(trips.withColumn("duration_min", bad).withColumnsRenamed(external), path)
    elif kind == "clean_json":
        # a cleaned copy is read if there is one, but none is written for this
        trips = files.load_or_rebuild(spark, scratch_path(spark, source_tag(sf_dir), "clean"),
                                      lambda: cleaning.clean_trips(raw_trips(spark, sf_dir)))
        sinks.write_json(trips.select(TRIP_COLUMNS).withColumnsRenamed(external), path)
    elif kind == "log":
        sinks.write_log(log_lines(spark, sf_dir), path, by="at")
    elif kind == "months":
        sinks.write_by_month(clean_trips(spark, sf_dir), path)
    else:
        raise KeyError(kind)
