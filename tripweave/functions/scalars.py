"""Scalar rules on trips, all built from native column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.sources import contracts as C

# what a whitespace split treats as a separator: ASCII and Unicode spaces, control separators
WHITESPACE = r"(?U)[\s\x1C-\x1F]+"


def calendar(ts: str | Column) -> dict[str, Column]:
    """hour 0-23, weekday 1 = Sunday ... 7 = Saturday, weekend flag."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    weekday = F.dayofweek(ts)
    return {"hour": F.hour(ts), "weekday": weekday, "weekend": weekday.isin(1, 7)}


def duration_class(minutes: Column) -> Column:
    """First class whose bound is above the duration; a NULL duration falls to the last one."""
    (first_bound, first_label), *others = C.DURATION_CLASSES
    rule = F.when(minutes < first_bound, first_label)
    for bound, label in others:
        rule = rule.when(minutes < bound, label)
    return rule.otherwise(C.LONG_CLASS)


def great_circle_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Haversine distance in kilometres."""
    def half_chord(a: Column, b: Column) -> Column:
        s = F.sin((F.radians(b) - F.radians(a)) / 2)
        return s * s

    chord = half_chord(lat_a, lat_b) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_chord(lon_a, lon_b)
    return 2 * C.EARTH_RADIUS_KM * F.asin(F.sqrt(chord))


def fare(minutes: Column, rider: Column, electric: Column) -> Column:
    """Subscribers pay per started step beyond the free time, casual riders per minute."""
    over = F.greatest(minutes - C.FREE_MINUTES, F.lit(0.0))
    subscriber = F.ceil(over / C.FREE_MINUTES) * C.SUBSCRIBER_STEP_EUR
    casual = C.CASUAL_BASE_EUR + C.CASUAL_MINUTE_EUR * minutes
    base = F.when(rider == C.SUBSCRIBER, subscriber).otherwise(casual)
    return F.round(base + electric * C.ELECTRIC_EXTRA_EUR, 2)


def is_casual(rider: Column) -> Column:
    """1.0 for a casual rider, 0.0 for any other type, NULL when the type is missing."""
    return (rider == C.CASUAL).cast("double")


def in_test_side(key: Column, parts: int = 5) -> Column:
    """Whether a row belongs to the test side: the same rows whatever the partitioning."""
    return F.pmod(F.hash(key), F.lit(parts)) == 0


def words(df: DataFrame, text: str) -> DataFrame:
    """One row per whitespace-separated word of a text column."""
    return df.select(F.explode(F.split(text, WHITESPACE)).alias("word")).where("word <> ''")


def minutes_before(ts: Column, minutes: Column) -> Column:
    """`ts` moved back by a number of minutes, to the second."""
    return ts - F.make_dt_interval(mins=F.lit(0), secs=F.round(minutes * 60).cast("decimal(18,6)"))
