"""Streaming sources and the landing of new files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions import scalars
from tripweave.sources import contracts as C
from tripweave.sources import files, sinks


def json_stream(spark: SparkSession, path: str, schema: str, max_files: int | None = 10) -> DataFrame:
    """JSON files of a folder as a stream; a streaming file source needs a declared schema."""
    reader = spark.readStream.schema(schema).option("timestampFormat", C.TIMESTAMP_FORMAT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def trip_stream(spark: SparkSession, path: str, max_files: int | None = 10) -> DataFrame:
    """Trips arriving as JSON lines, under this library's names."""
    return json_stream(spark, path, C.ddl(C.TRIP_FIELDS), max_files).withColumnsRenamed(
        C.rename_map(C.TRIP_FIELDS))


def table_stream(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table (a folder of files or one file) as a stream, with the schema its files carry.

    Timestamps without zone become timestamps, as event time needs them.
    """
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files.is_folder(spark, path):
        stream = reader.parquet(path)
    else:  # a streaming source watches folders
        folder, _, name = path.rpartition("/")
        stream = reader.option("pathGlobFilter", name).parquet(folder)
    zoned = {f.name: F.col(f.name).cast("timestamp") for f in schema if f.dataType.typeName() == "timestamp_ntz"}
    return stream.withColumns(zoned) if zoned else stream


def rate_stream(spark: SparkSession, rows_per_second: int = 2) -> DataFrame:
    """Synthetic rows `timestamp, value`; it never ends, so wait for a batch and stop the query."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def land_json(batch: DataFrame, landing: str, name: str) -> None:
    """Publish a batch into a landing folder so that readers see whole files only.

    Spark writes under a hidden name, which file sources ignore; finished files are then renamed.
    """
    spark = batch.sparkSession
    hidden = f"{landing}/.landing-{name}"
    sinks.write_json(batch, hidden)
    fs, folder = files.hadoop_path(spark, hidden)
    for i, status in enumerate(fs.globStatus(files.hadoop_path(spark, f"{hidden}/part-*")[1])):
        target = files.hadoop_path(spark, f"{landing}/{name}-{i:05d}.json.gz")[1]
        if not fs.rename(status.getPath(), target):
            raise OSError(f"could not publish {target.toString()}")
    fs.delete(folder, True)


def rebase(trips: DataFrame, ended_at) -> DataFrame:
    """Trips replayed with new end times: the start is the end less the duration."""
    return trips.withColumn("ended_at", ended_at).withColumn(
        "started_at", scalars.minutes_before(F.col("ended_at"), F.col("duration_min")))


def replayable(trips: DataFrame) -> DataFrame:
    """Rows a replay may send: positive duration, destination and rider type known."""
    return trips.where(F.col("duration_min") > 0).dropna(subset=["destination", "rider_type"])


def delay_some(trips: DataFrame, key: str, share: float = 0.03, least: int = 120, most: int = 900) -> DataFrame:
    """Move a share of the rows back by `least` to `most` seconds, chosen by key hash.

    Adds `late_by` in seconds (0 for punctual rows); start and end keep their distance.
    """
    def draw(purpose: str, outcomes: int):
        return F.pmod(F.hash(F.concat(F.col(key), F.lit(purpose))), F.lit(outcomes))

    drawn = draw("/late", 10_000) < int(share * 10_000)
    seconds = draw("/delay", most - least + 1) + least
    late = trips.withColumn("late_by", F.when(drawn, seconds).otherwise(F.lit(0)).cast("int"))
    shift = F.make_dt_interval(secs=F.col("late_by").cast("decimal(18,6)"))
    return late.withColumns({name: F.col(name) - shift for name in ("started_at", "ended_at")})
