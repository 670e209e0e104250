"""Streaming sinks. Each returns the started query; triggers default to one pass over what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F

from tripweave.operators.relational import latest_version
from tripweave.session import STATE_WIDTH, shuffle_width
from tripweave.sources import files

ONCE = {"availableNow": True}


def _start(writer, spark: SparkSession, trigger: dict | None, width: int | None) -> StreamingQuery:
    with shuffle_width(spark, width or STATE_WIDTH):
        return writer.trigger(**(ONCE if trigger is None else trigger)).start()


def to_memory(df: DataFrame, name: str, mode: str = "append", trigger: dict | None = None,
              width: int | None = None) -> StreamingQuery:
    """Results as a table of the session. They are held by the driver: for small results only."""
    return _start(df.writeStream.outputMode(mode).format("memory").queryName(name), df.sparkSession, trigger, width)


def to_console(df: DataFrame, name: str, mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    return _start(df.writeStream.outputMode(mode).format("console").queryName(name), df.sparkSession, trigger, None)


def to_parquet(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
               width: int | None = None) -> StreamingQuery:
    """Append rows to a Parquet folder exactly once: a restart goes on from the checkpoint."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint)
    return _start(writer, df.sparkSession, trigger, width)


def to_csv_batches(df: DataFrame, path: str, checkpoint: str, mode: str = "update", trigger: dict | None = None,
                   width: int | None = None) -> StreamingQuery:
    """One CSV folder per batch. A batch may run twice (at least once), so it overwrites its own folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").csv(f"{path}/batch_id={batch_id}", header=True)

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return _start(writer, df.sparkSession, trigger, width)


def to_versions(df: DataFrame, path: str, checkpoint: str, mode: str = "update", trigger: dict | None = None,
                width: int | None = None, keys: tuple[str, ...] = (), compact_every: int = 20) -> StreamingQuery:
    """Results of a stateful query, one Parquet folder per batch: successive versions of its rows.

    This is what the memory sink holds in update mode, but on shared storage and with the batch
    number that tells which version is newer. The marker that Spark writes last is a batch's record; folders
    without it are not read. With `keys`, every `compact_every` batches the newest version of each key
    becomes one folder, and folders that an earlier one already stood for are removed, so that neither
    reading nor listing grows with the number of batches.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if keys and (batch_id + 1) % compact_every == 0:
            _compact(batch.sparkSession, path, list(keys), batch_id)

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return _start(writer, df.sparkSession, trigger, width)


def _compact(spark: SparkSession, path: str, keys: list[str], upto: int) -> None:
    """Writes the newest versions up to a batch. A batch that runs again writes the same."""
    versions = _versions(spark, path, upto)
    numbered = versions.withColumn("newest", F.col("batch_id"))
    latest_version(numbered, keys, "newest").write.mode("overwrite").parquet(f"{path}/upto={upto}")
    earlier = [n for n in files.finished_folders(spark, path, "upto") if n < upto]
    # readers that listed the folders before this one was there still need the last one and what followed it
    for prefix, last in (("upto", max(earlier, default=-1) - 1), ("batch_id", max(earlier, default=-1))):
        for n in files.finished_folders(spark, path, prefix):
            if n <= last:
                files.remove_folder(spark, f"{path}/{prefix}={n}")


def _versions(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """The last compacted folder and the finished batches after it; for a compaction, what is before it."""
    compacted = [n for n in files.finished_folders(spark, path, "upto") if upto is None or n < upto]
    last = max(compacted, default=-1)
    batches = [n for n in files.finished_folders(spark, path, "batch_id") if n > last and (upto is None or n <= upto)]
    if not batches and last < 0:
        raise ValueError(f"no finished batch in {path}")
    parts = []
    if batches:
        read = spark.read.option("basePath", path).parquet(*(f"{path}/batch_id={n}" for n in batches))
        parts.append(read.withColumn("batch_id", F.col("batch_id").cast("bigint")))
    if last >= 0:
        parts.append(spark.read.parquet(f"{path}/upto={last}"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def to_punctual_and_late(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                         width: int | None = None) -> StreamingQuery:
    """Rows with a `late` column, appended to the folders `late=false` and `late=true` of one table, exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append").partitionBy("late").option("path", path).option(
        "checkpointLocation", checkpoint)
    return _start(writer, df.sparkSession, trigger, width)


def read_versions(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """The last version of each key; without keys, the whole result of the last batch (complete mode)."""
    if not keys:
        batches = files.finished_folders(spark, path, "batch_id")
        if not batches:
            raise ValueError(f"no finished batch in {path}")
        return spark.read.parquet(f"{path}/batch_id={batches[-1]}")
    return latest_version(_versions(spark, path), list(keys), "batch_id")
