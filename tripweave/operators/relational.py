"""Joins, aggregates, rankings and layouts on trips, stations and weather."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripweave.functions import scalars
from tripweave.operators.skew import lookup_join
from tripweave.session import cut_lineage
from tripweave.sources import contracts as C


# --- joins -----------------------------------------------------------------------------------

def with_district(trips: DataFrame, stations: DataFrame, how: str = "left", at: str = "origin") -> DataFrame:
    """Add the district of the origin (or destination) dock; only two station columns travel.

    The size of the station table is checked and not estimated: an estimate that is too large
    would shuffle all trips by dock before it is found out.
    """
    dim = stations.select(F.col("station_id").alias(at), "district")
    return lookup_join(trips, dim, at, how)


def with_weather(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Add the weather of the start day; days without a record give NULL.

    The weather is written once, as it may itself be an aggregate: checking its size and joining
    it would otherwise compute it twice.
    """
    return lookup_join(trips.withColumn("date", F.to_date("started_at")), cut_lineage(weather), "date", "left")


def arrivals_with_station(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Inner join on differently named keys: trips without a destination vanish."""
    dim = stations.select("station_id", F.col("station_id").alias("destination"), "name", "district")
    return lookup_join(trips, dim, "destination")


def named_by_broadcast(counts: DataFrame, stations: DataFrame, key: str = "station_id") -> DataFrame:
    """Look names up on every executor when the station table is within the checked bound."""
    return lookup_join(counts, stations.select(F.col("station_id").alias(key), "name"), key)


def named_by_shuffle(counts: DataFrame, stations: DataFrame, key: str = "station_id") -> DataFrame:
    """The same result by a shuffled sort-merge join, for station tables of any size."""
    return counts.join(stations.select(F.col("station_id").alias(key), "name").hint("merge"), key)


def not_in(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    return df.join(seen.select(key), key, "left_anti")


def from_full_key_set(keys: DataFrame, values: DataFrame, key: str, column: str, default) -> DataFrame:
    """Every key, with a default where no value is known."""
    return keys.join(values, key, "left").withColumn(column, F.coalesce(column, F.lit(default)))


# --- aggregates ------------------------------------------------------------------------------

def count_by(df: DataFrame, *keys: str, alias: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(alias))


def ranked_counts(df: DataFrame, *keys: str, alias: str = "n", k: int | None = None) -> DataFrame:
    """Counts, largest first, ties by key; with `k`, only the top of the list."""
    ordered = count_by(df, *keys, alias=alias).orderBy(F.desc(alias), *keys)
    return ordered.limit(k) if k else ordered


def rider_summary(trips: DataFrame) -> DataFrame:
    """Trips and mean duration by rider type; an unknown type is a group of its own."""
    return trips.groupBy("rider_type").agg(
        F.count("*").alias("trips"), F.round(F.avg("duration_min"), 1).alias("mean_duration"))


def hour_by_rider(trips: DataFrame, riders=(C.SUBSCRIBER, C.CASUAL)) -> DataFrame:
    """Hour x rider type; the value list is given, so no extra job looks for it."""
    return trips.groupBy("hour").pivot("rider_type", list(riders)).count()


def top_pairs(trips: DataFrame, k: int = 5) -> DataFrame:
    """The most frequent origin-destination pairs, round trips left out."""
    return ranked_counts(trips.where(F.col("origin") != F.col("destination")), "origin", "destination",
                         alias="trips", k=k)


def class_share(df: DataFrame, condition: Column, alias: str = "share") -> DataFrame:
    """Share of the rows that meet a condition: the accuracy of always answering that class."""
    return df.agg(F.avg(condition.cast("double")).alias(alias))


def latest_version(versions: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The newest row per key of a table that stacks successive versions of its rows."""
    payload = [c for c in versions.columns if c not in keys and c != version]
    newest = versions.groupBy(*keys).agg(F.max_by(F.struct(*payload), version).alias("v"))
    return newest.select(*keys, "v.*")


def one_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, and a defined one: the smallest in `order` (all other columns break ties)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    columns = [*order, *rest]
    return df.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("v")).select(*keys, "v.*").select(*df.columns)


def mean_by_pandas_api(df: DataFrame, key: str, value: str) -> DataFrame:
    """The pandas spelling of a group mean; Spark runs it."""
    import pyspark.pandas as ps

    # the default index numbers all rows in order, at the price of a pass; a mean does not need it
    with ps.option_context("compute.default_index_type", "distributed"):
        means = df.select(key, value).pandas_api().groupby(key)[value].mean().sort_index()
        return means.to_frame().reset_index().to_spark()


def rain_rate(spark: SparkSession, trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips per day by rain class, in SQL; an unknown rainfall falls to the last class."""
    dry, light, heavy = C.RAIN_CLASSES
    return spark.sql(
        f"""WITH by_day AS (
               SELECT to_date(started_at) AS date, count(*) AS trips FROM {{trips}} GROUP BY 1)
            SELECT CASE WHEN rain_mm = 0 THEN '{dry}' WHEN rain_mm < {C.LIGHT_RAIN_BELOW_MM} THEN '{light}'
                        ELSE '{heavy}' END AS weather,
                   count(date) AS days,
                   round(sum(trips) / count(date)) AS trips_per_day
            FROM by_day LEFT JOIN {{weather}} USING (date) GROUP BY 1""",
        trips=trips, weather=weather)


# --- rankings --------------------------------------------------------------------------------

def busiest_in_group(counts: DataFrame, group: str, n: str = "n") -> DataFrame:
    """Rows with the largest count of their group; ties keep several rows.

    Spark limits each partition to rank 1 before the shuffle, so a large group stays cheap.
    """
    window = Window.partitionBy(group).orderBy(F.desc(n))
    return counts.withColumn("position", F.rank().over(window)).where("position = 1")


def favourite_in_group(counts: DataFrame, group: str, tie: str, n: str = "n") -> DataFrame:
    """Exactly one row per group: the largest count, ties by key."""
    window = Window.partitionBy(group).orderBy(F.desc(n), tie)
    return counts.withColumn("position", F.row_number().over(window)).where("position = 1")


def monthly_revenue(spark: SparkSession, trips: DataFrame) -> DataFrame:
    """Revenue by district and month with the change from the month before, in SQL.

    The window runs over the monthly totals, one row per district and month.
    """
    return spark.sql(
        """WITH monthly AS (
             SELECT district, date_format(started_at, 'yyyy-MM') AS month,
                    sum(CAST(fare_eur AS DECIMAL(18,2))) AS revenue
             FROM {trips} GROUP BY 1, 2)
           SELECT district, month, CAST(revenue AS DOUBLE) AS revenue,
                  CAST(revenue - lag(revenue) OVER (PARTITION BY district ORDER BY month) AS DOUBLE) AS change
           FROM monthly""", trips=trips)


# --- samples and layout ----------------------------------------------------------------------

def hash_split(df: DataFrame, key: str, parts: int = 5) -> tuple[DataFrame, DataFrame]:
    """(train, test): one part in `parts` by key hash, whatever the partitioning."""
    test = scalars.in_test_side(F.col(key), parts)
    return df.where(~test), df.where(test)


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """A seeded random split; unlike `hash_split` it changes with the partitioning."""
    return df.randomSplit(list(weights), seed=seed)


def row_sample(df: DataFrame, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per physical partition (empty partitions do not show)."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))
