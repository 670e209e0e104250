"""Session defaults and the shared folder used for checkpoints and staged tables."""

from __future__ import annotations

import atexit
import hashlib
import shutil
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tripweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for; `conf` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        # checkpoints of finished loops are removed with the tables that used them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.checkpoint.compress": "true",
        # streaming state on disk beside the executors, not on their heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by `spark.checkpoint.dir`.

    Where it is unset, a folder in the session's warehouse is taken, and removed when the program ends;
    a cluster whose warehouse is on a local disk gets an error, because other machines don't see it.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc.getCheckpointDir() is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        on_disk = warehouse.startswith(("/", "file:"))
        if on_disk and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(f"{warehouse}/tripweave-scratch")
        if on_disk:
            own = sc.getCheckpointDir().removeprefix("file:")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder that belongs to this application."""
    app = spark.sparkContext.applicationId
    return "/".join([shared_dir(spark), f"tripweave-{app}", *parts])


def source_tag(sf_dir: str) -> str:
    """Short stable name for an input folder, used in scratch paths."""
    return hashlib.md5(sf_dir.rstrip("/").encode()).hexdigest()[:10]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder and continue from the written copy."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffle_width(spark: SparkSession, partitions: int | None):
    """Set the shuffle width for the queries started inside the block.

    A stateful stream fixes its number of state partitions at the first start and adaptive
    execution does not resize it, so the width is chosen here and not by the session default.
    """
    before = spark.conf.get("spark.sql.shuffle.partitions")
    if partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@contextmanager
def split_size(spark: SparkSession, size: int):
    """Read files in pieces of at most `size` bytes in what is run inside the block; smaller settings stay.

    For steps whose rows are much larger than in the file they come from: a task's memory follows its rows.
    """
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(size, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: state partitions of a stream where the caller names no number: fixed for the life of its checkpoint,
#: so a stream that is to grow should be started with the width of the cluster it will run on
STATE_WIDTH = 8
