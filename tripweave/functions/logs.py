"""Native parsing of kiosk log lines: `<timestamp> <station> <KIND> key=value ...`.

Everything is a column expression, so a log is parsed inside the scan stage on the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.scalars import WHITESPACE
from tripweave.sources import contracts as C

PAIR = "(?U)" + C.LOG_PAIR  # (?U): word and space classes are Unicode ones

# Why a line is no event, in the order in which the rules are tried; both parsers name the first that fails.
FEW_PARTS, TIMESTAMP, STATION, KIND, FIELDS, QUOTES = REASONS = (
    "fewer than four parts", "timestamp", "station", "kind", "missing field", "unbalanced quotes")


def _computed_once(value: Column, use) -> Column:
    """`use(value)` where the value is evaluated once: the lambda refers to it, not to its expression."""
    return F.transform(F.array(value), use)[0]


def key_values(pairs: Column) -> Column:
    """A list of `key=value` texts as a map, quotes stripped; the last value of a repeated key wins."""
    values = F.transform(pairs, lambda pair: F.btrim(
        F.substring(pair, F.locate("=", pair) + 1, F.length(pair)), F.lit('"')))

    def as_map(keys: Column) -> Column:
        names, backwards = F.array_distinct(keys), F.reverse(keys)
        last_values = F.transform(names, lambda key: F.get(
            values, F.size(keys) - F.array_position(backwards, key)))
        return F.when(F.size(names) == F.size(keys), F.map_from_arrays(keys, values)).otherwise(
            F.map_from_arrays(names, last_values))

    return _computed_once(F.transform(pairs, lambda pair: F.substring_index(pair, "=", 1)), as_map)


def lacks_required(kind: Column, pairs: Column) -> Column:
    """Whether a key that the kind requires is missing from the pairs."""
    def missing(key: str) -> Column:
        return ~F.exists(pairs, lambda pair: pair.startswith(f"{key}="))

    return reduce(lambda a, b: a | b, [(kind == name) & missing(key)
                                       for name, keys in C.LOG_KINDS.items() for key in keys])


def parse_lines(lines: DataFrame, station_pattern: str = C.LOG_STATION) -> DataFrame:
    """One row per line: `value`, its parts, the field map and why it is rejected (NULL if valid).

    The pairs pass through a generator, so that filters on them read the result of the search and
    do not run the regular expression again; the field map is built above it, only for the rows
    and queries that use it.
    """
    part = F.split("value", " ", 4)
    cut_up = lines.select("value", *[F.get(part, F.lit(i)).alias(name)
                                     for i, name in enumerate(("ts", "station", "kind", "rest"))])
    found = F.struct(F.regexp_extract_all("rest", F.lit(PAIR), F.lit(0)).alias("pairs"))
    parts = cut_up.select("*", F.inline(F.array(found)))
    quotes = F.length("rest") - F.length(F.replace("rest", F.lit('"'), F.lit("")))
    fails = {
        FEW_PARTS: F.col("rest").isNull(),
        TIMESTAMP: F.length("ts") != C.LOG_TIMESTAMP_LENGTH,
        STATION: ~F.col("station").rlike(station_pattern),
        KIND: ~F.col("kind").isin(*C.LOG_KINDS),
        FIELDS: lacks_required(F.col("kind"), F.col("pairs")),
        QUOTES: F.col("rest").contains('"') & (quotes % 2 != 0),
    }
    reason = F.coalesce(*(F.when(fails[name], name) for name in REASONS))
    return parts.select("value", "ts", "station", "kind", key_values(F.col("pairs")).alias("fields"),
                        reason.alias("reason"))


def valid_events(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).select("ts", "station", "kind", "fields")


def rejected_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select("value", "reason")


def field(name: str) -> Column:
    """A field of an event as text, NULL when the line does not carry it."""
    return F.try_element_at("fields", F.lit(name))


def int_field(name: str) -> Column:
    """A field as an integer; NULL when it is missing or not a number."""
    return field(name).try_cast("int")


def event_hour() -> Column:
    return F.hour(F.try_to_timestamp(F.translate("ts", "T", " "), F.lit(C.TIMESTAMP_FORMAT)))


def loose_parts(lines: DataFrame, minimum: int = 3) -> DataFrame:
    """The loose rule: a line is kept when a whitespace split gives at least `minimum` pieces."""
    pieces = F.filter(F.split("value", WHITESPACE), lambda piece: piece != "")
    return lines.select("value", pieces.alias("parts")).withColumn("kept", F.size("parts") >= minimum)


def trip_lines(trips: DataFrame, badge: Column, battery: Column, error: Column, cut_pickup: Column,
               cut_deposit: Column) -> DataFrame:
    """Render trips as log lines: a pickup and a deposit each, and an error line where `error` is set.

    `error` is a struct<code,message> or NULL; `battery` is NULL for vehicles without one; a
    non-NULL cut shortens the line to that many characters, as a network cut would.
    """
    def stamp(ts: str) -> Column:
        return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")

    def event(at: str, line: Column, cut: Column) -> Column:
        text = F.when(cut.isNull(), line).otherwise(F.substring(line, F.lit(1), F.coalesce(cut, F.lit(0))))
        return F.struct(F.col(at).alias("at"), text.alias("value"))

    pickup = F.concat(stamp("started_at"), F.lit(" "), F.col("origin"), F.lit(f" {C.PICKUP} velo="),
                      F.col("vehicle_id"), F.lit(" badge="), badge,
                      F.coalesce(F.concat(F.lit(" batterie="), battery.cast("string")), F.lit("")))
    deposit = F.concat(stamp("ended_at"), F.lit(" "), F.col("destination"), F.lit(f" {C.DEPOSIT} velo="),
                       F.col("vehicle_id"), F.lit(" duree="), F.col("duration_min").cast("string"))
    failure = F.concat(stamp("started_at"), F.lit(" "), F.col("origin"), F.lit(f" {C.ERROR} code="),
                       error["code"], F.lit(' message="'), error["message"], F.lit('"'))
    uncut = F.lit(None).cast("int")
    events = F.array(event("started_at", pickup, cut_pickup), event("ended_at", deposit, cut_deposit),
                     F.when(error.isNotNull(), event("started_at", failure, uncut)))
    return trips.select(F.explode(events).alias("e")).where("e IS NOT NULL").select("e.at", "e.value")
