"""Questions on the kiosk log, on parsed events (`ts, station, kind, fields`)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.functions import logs
from tripweave.operators.skew import HOT_SHARES, lookup_join
from tripweave.session import cut_lineage
from tripweave.sources import contracts as C


def reject_report(parsed: DataFrame) -> DataFrame:
    """Lines, valid lines and rejects: counted from the data, so a rerun cannot count twice."""
    return parsed.agg(F.count("*").alias("lines"), F.count_if(F.col("reason").isNull()).alias("valid"),
                      F.count("reason").alias("rejected"))


def errors_by_station(events: DataFrame) -> DataFrame:
    return events.where(F.col("kind") == C.ERROR).groupBy(F.col("station").alias("station_id")).agg(
        F.count("*").alias("errors"))


def error_codes(events: DataFrame) -> DataFrame:
    pairs = events.where(F.col("kind") == C.ERROR).select(
        logs.field("code").alias("code"), logs.field("message").alias("message"))
    return pairs.groupBy("code", "message").agg(F.count("*").alias("n")).orderBy("code", "message")


def pickup_battery(events: DataFrame, *keys: str) -> DataFrame:
    """Mean battery of the pickups that report one, overall or by key."""
    level = events.where(F.col("kind") == C.PICKUP).withColumn("battery", logs.int_field("batterie"))
    return level.where(F.col("battery").isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("pickups"), F.avg("battery").alias("mean_battery"))


def errors_by_hour(events: DataFrame) -> DataFrame:
    return events.where(F.col("kind") == C.ERROR).groupBy(logs.event_hour().alias("hour")).agg(
        F.count("*").alias("errors"))


def vehicles_picked_up(events: DataFrame) -> DataFrame:
    return events.where(F.col("kind") == C.PICKUP).agg(F.count_distinct(logs.field("velo")).alias("vehicles"))


def _moves(events: DataFrame) -> DataFrame:
    """Pickups and deposits by vehicle: `pickup` is true or false."""
    return events.where(F.col("kind").isin(C.PICKUP, C.DEPOSIT)).select(
        logs.field("velo").alias("vehicle_id"), "ts", (F.col("kind") == C.PICKUP).alias("pickup"))


def deposits_without_pickup(events: DataFrame) -> DataFrame:
    """Per vehicle: deposits, and those with no pickup of the vehicle before them.

    These are the deposits up to the vehicle's first pickup. First pickups are found by a grouping that combines
    before it is shuffled; deposits are then held against them, those of vehicles with very many spread over tasks.
    """
    moves = _moves(events).withColumn("_key", F.struct("vehicle_id"))  # vehicles that are null meet like any other
    vehicles = cut_lineage(moves.groupBy("_key").agg(
        F.min(F.when(F.col("pickup"), F.col("ts"))).alias("first_pickup"), F.count_if(~F.col("pickup")).alias("deposits"))
        .where("deposits > 0"))
    total = vehicles.agg(F.sum("deposits")).first()[0] or 0
    early = (lookup_join(moves.where(~F.col("pickup")).select("_key", "ts"),
                         vehicles.where("first_pickup IS NOT NULL").select("_key", "first_pickup"), "_key",
                         hot=vehicles.where(F.col("deposits") > total / HOT_SHARES).select("_key"))
             .where("ts <= first_pickup").groupBy("_key").agg(F.count("*").alias("early")))
    orphans = F.when(F.col("first_pickup").isNull(), F.col("deposits")).otherwise(F.coalesce("early", F.lit(0)))
    return vehicles.join(early, "_key", "left").select("_key.vehicle_id", "deposits", orphans.alias("orphans"))


def deposits_out_of_turn(events: DataFrame) -> DataFrame:
    """The strict form: deposits whose vehicle's preceding event is not a pickup.

    At equal times a deposit counts before a pickup, and of several deposits at one time only
    the first can follow a pickup. Events are collapsed to one row per vehicle, second and kind and then
    looked at by vehicle and day, so no group has more than 172,800 rows however many events a vehicle has;
    days hand on their last event only.
    """
    rows = _moves(events).groupBy("vehicle_id", "ts", "pickup").agg(F.count("*").alias("n")).withColumn(
        "day", F.substring("ts", 1, 10))
    in_day, order = Window.partitionBy("vehicle_id", "day"), F.struct("ts", "pickup")
    looked = rows.withColumn("previous", F.lag("pickup").over(in_day.orderBy("ts", "pickup")))
    days = looked.groupBy("vehicle_id", "day").agg(
        F.sum(F.when(F.col("pickup"), 0).otherwise(F.col("n"))).alias("deposits"),
        F.count_if(~F.col("pickup") & F.col("previous")).alias("in_turn"),
        F.min_by("pickup", order).alias("first"), F.max_by("pickup", order).alias("last"))
    before = F.lag("last").over(Window.partitionBy("vehicle_id").orderBy("day"))
    handed = days.withColumn("in_turn", F.col("in_turn") + F.coalesce((~F.col("first") & before).cast("int"), F.lit(0)))
    return handed.groupBy("vehicle_id").agg(
        F.sum("deposits").alias("deposits"), F.sum(F.col("deposits") - F.col("in_turn")).alias("out_of_turn"))
