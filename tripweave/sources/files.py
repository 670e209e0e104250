"""File readers: CSV, JSON lines, text and Parquet, plus read-if-complete."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.sources import contracts as C


def read_csv(spark: SparkSession, path: str, schema=None, header: bool = False,
             infer: bool = False, mode: str | None = None, **options) -> DataFrame:
    """CSV with an inferred schema (one extra pass), a declared one, or raw string columns."""
    reader = spark.read.options(header=header, inferSchema=infer and schema is None, **options)
    if schema is not None:
        reader = reader.schema(schema)
    if mode:
        reader = reader.option("mode", mode)
    return reader.csv(path)


def read_trips_csv(spark: SparkSession, path: str) -> DataFrame:
    """Trips with declared text timestamps, parsed afterwards; unreadable ones become NULL."""
    text = read_csv(spark, path, schema=C.ddl(C.TRIP_FIELDS, text_timestamps=True), header=True)
    named = text.withColumnsRenamed(C.rename_map(C.TRIP_FIELDS))
    return named.withColumns({
        name: F.try_to_timestamp(name, F.lit(C.TIMESTAMP_FORMAT)) for name in ("started_at", "ended_at")
    })


def read_trips_ddl(spark: SparkSession, path: str, mode: str | None = None) -> DataFrame:
    """Trips with a DDL schema that types the timestamps at read time."""
    typed = read_csv(spark, path, schema=C.ddl(C.TRIP_FIELDS), header=True, mode=mode,
                     timestampFormat=C.TIMESTAMP_FORMAT)
    return typed.withColumnsRenamed(C.rename_map(C.TRIP_FIELDS))


def read_stations_csv(spark: SparkSession, path: str) -> DataFrame:
    typed = read_csv(spark, path, schema=C.ddl(C.STATION_FIELDS), header=True)
    return typed.withColumnsRenamed(C.rename_map(C.STATION_FIELDS))


def read_weather_csv(spark: SparkSession, path: str) -> DataFrame:
    typed = read_csv(spark, path, schema=C.ddl(C.WEATHER_FIELDS), header=True)
    return typed.withColumnsRenamed(C.rename_map(C.WEATHER_FIELDS))


def read_clean_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned table as the contract names it, under this library's names."""
    stored = spark.read.parquet(path)
    return stored.withColumnsRenamed(C.rename_map(C.TRIP_FIELDS + C.CALENDAR_FIELDS))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines, one row each, in column `value`."""
    return spark.read.text(path)


def first_parse_error(df: DataFrame) -> str | None:
    """Why a table that is read in FAILFAST mode can't be read; null if all its rows can."""
    try:
        df.write.format("noop").mode("overwrite").save()  # every column of every row is parsed
    except (PySparkException, Py4JJavaError) as e:
        if "MALFORMED" in str(e):
            return str(e).splitlines()[0]
        raise
    return None


def read_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """JSON lines; without a schema the types are inferred and timestamps stay text."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def sql_on_parquet(spark: SparkSession, path: str, select: str, tail: str = "") -> DataFrame:
    """SQL straight on a Parquet folder: `SELECT <select> FROM parquet.<path> <tail>`."""
    return spark.sql(f"SELECT {select} FROM parquet.`{path}` {tail}")


def local_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small table from local rows and a DDL schema."""
    return spark.createDataFrame(rows, ddl)


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop file system and path object of a path, for the few questions Spark has no reader for."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.getFileStatus(target).isDirectory()


def is_complete(spark: SparkSession, path: str) -> bool:
    """True once a Spark write to `path` has finished: the marker is written last."""
    return path_exists(spark, f"{path}/_SUCCESS")


def finished_folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers of the folders `<prefix>=<number>` under a path whose writes have finished."""
    fs, pattern = hadoop_path(spark, f"{path}/{prefix}=*/_SUCCESS")
    return sorted(int(found.getPath().getParent().getName().split("=")[1]) for found in fs.globStatus(pattern) or [])


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    fs.delete(target, True)


def load_or_rebuild(spark: SparkSession, path: str, rebuild: Callable[[], DataFrame]) -> DataFrame:
    """Read a finished Parquet output, else rebuild the table from its source."""
    return spark.read.parquet(path) if is_complete(spark, path) else rebuild()
