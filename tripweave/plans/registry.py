"""The query registry and the SQL statement of the derived tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tripweave.sources import contracts as C

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    covers: str
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a query under `name`; `covers` lists the inventory ids it exercises."""
    def add(fn: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"duplicate query {name}")
        ENTRIES[name] = Entry(name, covers, fn, sql)
        return fn
    return add


def _latitude(number: str) -> str:
    return f"(43.5::DOUBLE + (({number}) * 37) % 1000 / 1e4)"


def _longitude(number: str) -> str:
    return f"(1.3::DOUBLE + (({number}) * 59) % 1000 / 8e3)"


def haversine_sql(lat_a: str, lon_a: str, lat_b: str, lon_b: str) -> str:
    return (f"2 * 6371.0::DOUBLE * asin(sqrt(pow(sin((radians({lat_b}) - radians({lat_a})) / 2), 2)"
            f" + cos(radians({lat_a})) * cos(radians({lat_b}))"
            f" * pow(sin((radians({lon_b}) - radians({lon_a})) / 2), 2)))")


_HERE, _THERE = "l_suppkey", "(l_partkey // 20)"
_COLUMNS = ("trip_id, vehicle_id, origin, destination, started_at, ended_at, duration_min, distance_km,"
            " rider_type, electric, fare_eur")

TABLES_SQL = f"""
base AS (
  SELECT (l_orderkey * 31 + l_partkey * 17 + l_suppkey * 7 + l_linenumber) % 2000 AS m,
         l_orderkey, l_linenumber,
         'T' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS trip_id,
         printf('V%04d', l_orderkey // 10) AS vehicle_id,
         printf('S%03d', l_suppkey) AS origin,
         printf('S%03d', l_partkey // 20) AS destination,
         l_shipdate + to_minutes((l_partkey * 7 + l_orderkey * 13 + l_suppkey * 3) % 1440) AS started_at,
         l_quantity + CASE WHEN l_returnflag = 'R' THEN 12 ELSE 0 END AS duration_min,
         round(greatest(0.3::DOUBLE, 1.25::DOUBLE * {haversine_sql(_latitude(_HERE), _longitude(_HERE),
                                                                  _latitude(_THERE), _longitude(_THERE))}), 2)
           AS distance_km,
         CASE WHEN l_returnflag = 'R' THEN '{C.CASUAL}' ELSE '{C.SUBSCRIBER}' END AS rider_type,
         CAST(l_linenumber % 3 = 0 AS INT) AS electric
  FROM lineitem),
priced AS (
  SELECT *, started_at + to_minutes(CAST(duration_min AS BIGINT)) AS ended_at,
         round(CASE WHEN rider_type = '{C.SUBSCRIBER}' THEN ceil(greatest(duration_min - 30, 0) / 30)
                    ELSE 1 + 0.05::DOUBLE * duration_min END + 0.5::DOUBLE * electric, 2) AS fare_eur
  FROM base),
planted AS (
  SELECT m, trip_id, vehicle_id, origin,
         CASE WHEN m NOT IN (11, 1011) THEN destination END AS destination,
         started_at, ended_at,
         CASE WHEN m IN (7, 1007) THEN -duration_min ELSE duration_min END AS duration_min,
         distance_km,
         CASE WHEN m <> 13 THEN rider_type END AS rider_type,
         electric, fare_eur
  FROM priced),
raw AS (
  SELECT {_COLUMNS} FROM planted
  UNION ALL
  SELECT {_COLUMNS} FROM planted WHERE m IN (17, 1017)),
clean AS (
  SELECT DISTINCT {_COLUMNS}, CAST(hour(started_at) AS INT) AS hour,
         CAST(dayofweek(started_at) + 1 AS INT) AS weekday, dayofweek(started_at) IN (0, 6) AS weekend
  FROM raw
  WHERE duration_min > 0 AND destination IS NOT NULL AND rider_type IS NOT NULL),
stations AS (
  SELECT printf('S%03d', s_suppkey) AS station_id, s_name AS name, r_name AS district,
         {_latitude('s_suppkey')} AS latitude, {_longitude('s_suppkey')} AS longitude,
         CAST(15 + 5 * (s_suppkey % 6) AS INT) AS capacity
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
weather AS (
  SELECT CAST(o_orderdate AS DATE) AS date, round(max(o_totalprice) / 2e4, 1) AS temperature_c,
         CAST(count(*) FILTER (o_orderpriority = '1-URGENT') AS DOUBLE) AS rain_mm
  FROM orders GROUP BY 1),
events_log AS (
  SELECT m, 8 + (m * 13 + l_orderkey) % 38 AS cut,
         vehicle_id, origin, destination, started_at, ended_at, duration_min, rider_type, electric,
         CASE WHEN electric = 1 THEN 15 + m % 85 END AS battery
  FROM priced WHERE m NOT IN (7, 1007, 11, 1011)),
log_all AS (
  SELECT started_at AS moment, origin AS station, '{C.PICKUP}' AS kind, vehicle_id, rider_type, battery, duration_min, m, cut,
         m IN (21, 521, 1021, 1521) AS is_cut FROM events_log
  UNION ALL
  SELECT ended_at, destination, '{C.DEPOSIT}', vehicle_id, rider_type, NULL, duration_min, m, cut,
         m IN (23, 523, 1023, 1523) FROM events_log
  UNION ALL
  SELECT started_at, origin, '{C.ERROR}', vehicle_id, rider_type, NULL, duration_min, m, cut, false
  FROM events_log WHERE m % 100 IN (3, 36, 69)),
log AS (SELECT * FROM log_all WHERE NOT is_cut),
error_codes AS (
  SELECT * FROM (VALUES {', '.join(f"({i}, '{code}', '{text}')" for i, (code, text) in enumerate(C.LOG_ERRORS))})
    AS t(slot, code, message))
"""


def key_hash_ctes(source: str, key: str, name: str) -> str:
    """Subqueries that end in `name`: the rows of `source` with `key_hash`, Spark's hash of an ASCII text.

    The published Murmur3 function for 32 bits with seed 42, on unsigned 64-bit integers: words of
    four bytes, then the remaining bytes one by one, then the length and the final mixing.
    """
    def low(x: str) -> str:
        return f"(({x}) % 4294967296::UBIGINT)"

    def times(x: str, factor: int) -> str:
        return low(f"({x}) * {factor}::UBIGINT")

    def turned(x: str, bits: int) -> str:
        return low(f"({x}) * {2 ** bits}::UBIGINT + ({x}) // {2 ** (32 - bits)}::UBIGINT")

    def byte(position: str) -> str:
        return f"unicode(substr({key}, CAST({position} AS INT), 1))::UBIGINT"

    def folded(bits: int) -> str:
        return f"xor(h, h // {2 ** bits}::UBIGINT)"

    word = " + ".join(f"{byte(f'4 * i + {j + 1}')} * {256 ** j}::UBIGINT" for j in range(4))
    words = f"list_transform(range(length({key}) // 4), lambda i: {word})"
    rest = f"list_transform(range(length({key}) - length({key}) % 4, length({key})), lambda i: {byte('i + 1')})"
    scrambled = f"list_transform(list_concat({words}, {rest}), lambda k: {times('k', 0xcc9e2d51)})"
    mixed = f"list_transform({scrambled}, lambda k: {times(turned('k', 15), 0x1b873593)})"
    step = low(f"{turned('xor(h, k)', 13)} * 5::UBIGINT + {0xe6546b64}::UBIGINT")
    return (f"{name}_0 AS (SELECT *, xor(list_reduce({mixed}, lambda h, k: {step}, 42::UBIGINT),"
            f" length({key})::UBIGINT) AS h FROM {source}),"
            f" {name}_1 AS (SELECT * REPLACE ({times(folded(16), 0x85ebca6b)} AS h) FROM {name}_0),"
            f" {name}_2 AS (SELECT * REPLACE ({times(folded(13), 0xc2b2ae35)} AS h) FROM {name}_1),"
            f" {name}_3 AS (SELECT * REPLACE ({folded(16)}::BIGINT AS h) FROM {name}_2),"
            f" {name} AS (SELECT * EXCLUDE (h), CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS key_hash"
            f" FROM {name}_3)")


def on_tables(select: str, ctes: str = "") -> str:
    """A SQL twin over the derived tables; `ctes` adds named subqueries before the final select."""
    recursive = "RECURSIVE " if "RECURSIVE" in ctes else ""
    extra = ", " + ctes.replace("RECURSIVE", "") if ctes else ""
    return f"WITH {recursive}{TABLES_SQL.strip()}{extra} {select}"
