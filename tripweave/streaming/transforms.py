"""Transformations that work on a stream and, unchanged, on a table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, StructField, StructType

from tripweave.functions import scalars
from tripweave.operators.skew import fits_broadcast, salted_join


def electric_only(trips: DataFrame) -> DataFrame:
    """Stateless filter and projection."""
    return trips.where(F.col("electric") == 1).select("trip_id", "origin", "ended_at", "duration_min")


def enrich(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """District of the origin (join with a static table) and the calendar columns of the start.

    A station table within the checked bound is broadcast. Adaptive execution does not split hot
    keys in streams, so a larger one is joined with salts.
    """
    dim = stations.select(F.col("station_id").alias("origin"), "district")
    if fits_broadcast(dim):
        joined = trips.join(F.broadcast(dim), "origin")
    else:
        joined = salted_join(trips, dim, "origin", spread="trip_id")
    return joined.withColumns(scalars.calendar("started_at"))


def running_counts(trips: DataFrame, *keys: str) -> DataFrame:
    """Counts since the start of the stream: the state has one row per key."""
    return trips.groupBy(*keys).agg(F.count("*").alias("n"))


def windowed(events: DataFrame, ts: str, width: str, *keys: str, aggregates: list[Column] | None = None,
             slide: str | None = None, watermark: str | None = None) -> DataFrame:
    """Aggregates by event-time window, tumbling or (with `slide`) sliding, and optional keys.

    With a watermark the state of a window is dropped once the largest event time seen, less the
    delay, passes the window's end; later rows for that window are dropped too.
    """
    if watermark:
        events = events.withWatermark(ts, watermark)
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    return events.groupBy(window, *keys).agg(*(aggregates or [F.count("*").alias("n")]))


def district_windows(trips: DataFrame, width: str = "5 minutes", watermark: str = "10 minutes",
                     digits: int = 1) -> DataFrame:
    """Trips and mean duration by window of the end time and district."""
    return windowed(trips, "ended_at", width, "district", watermark=watermark, aggregates=[
        F.count("*").alias("trips"), F.round(F.avg("duration_min"), digits).alias("mean_duration")])


def predicted_share(scored: DataFrame, width: str = "5 minutes", watermark: str = "10 minutes",
                    digits: int = 3) -> DataFrame:
    """Predicted against actual share of casual riders by window, on scored trips."""
    return windowed(scored.withColumn("actual", scalars.is_casual(F.col("rider_type"))), "ended_at", width,
                    watermark=watermark, aggregates=[
        F.count("*").alias("trips"), F.round(F.avg("prediction"), digits).alias("predicted_share"),
        F.round(F.avg("actual"), digits).alias("actual_share")])


def window_labels(df: DataFrame, pattern: str = "HH:mm") -> DataFrame:
    """The window struct as two text columns."""
    others = [c for c in df.columns if c != "window"]
    return df.select(F.date_format("window.start", pattern).alias("window_start"),
                     F.date_format("window.end", pattern).alias("window_end"), *others)


def window_bounds(df: DataFrame) -> DataFrame:
    """The window struct as two timestamps without zone."""
    others = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                     F.col("window.end").cast("timestamp_ntz").alias("window_end"), *others)




def mark_late(events: DataFrame, ts: str, until: Column, watermark: str, lanes: int) -> DataFrame:
    """Every row of the stream, with `late`: whether the watermark had reached its `until` when it came.

    With the end of a row's window as `until`, the late rows are those that an aggregation by window leaves out. An
    aggregation merges rows before it drops them, and reports windows; here single rows are seen, so they can be
    counted and written aside. `lanes` is the number of groups the rows are dealt to; no state is kept.
    """
    dealt = events.withWatermark(ts, watermark).withColumns({
        "_until": until, "_lane": F.pmod(F.xxhash64(*events.columns), F.lit(lanes)).cast("int")})
    schema = StructType([StructField("late", BooleanType()), *events.schema.fields])

    def mark(_, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        reached = pd.Timestamp(max(0, state.getCurrentWatermarkMs()), unit="ms")
        for rows in parts:
            yield rows.assign(late=rows["_until"] <= reached)[schema.names]

    marked = dealt.groupBy("_lane").applyInPandasWithState(
        mark, schema, "seen boolean", "append", GroupStateTimeout.NoTimeout)
    return marked.select(*events.columns, "late")  # rows of their own, which sinks may sort
