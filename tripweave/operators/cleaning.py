"""Counting and removing defects.

Exact copies are found without moving whole rows. A 64-bit fingerprint of every row is counted, which
shuffles eight bytes a row; only rows whose fingerprint was seen twice are compared, and shuffled, in full.
A fingerprint only nominates, so two rows that share one by chance both stay, and it may be taken from a few
columns that tell most rows apart: the first pass then reads these columns only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions import scalars
from tripweave.operators.skew import fits_broadcast
from tripweave.session import cut_lineage

#: repeated fingerprints are sent to the rows up to this number, which takes 16 bytes each; beyond it
#: so many rows are copies that all are grouped in full
REPEATED = 2_000_000
_PRINT, _COPIES = "_fingerprint", "_copies"


def trip_print() -> Column:
    """The fingerprint of a trip: copies agree in both columns, and few other trips do."""
    return F.xxhash64("trip_id", "started_at")


def fingerprint(df: DataFrame) -> Column:
    """Equal rows have equal fingerprints, as in grouping: nulls, NaN and both zeros included."""
    return F.xxhash64(*df.columns)


def _print_of(df: DataFrame, of: Column | None) -> Column:
    """A null nominates like any other value."""
    return (fingerprint(df) if of is None else F.coalesce(of, F.lit(0))).alias(_PRINT)


def repeated_prints(df: DataFrame, of: Column | None = None) -> DataFrame:
    """Fingerprints that more than one row has. The counts combine before they are shuffled."""
    prints = df.select(_print_of(df, of))
    return cut_lineage(prints.groupBy(_PRINT).agg(F.count("*").alias("n")).where("n > 1").select(_PRINT))


def _suspects(df: DataFrame, of: Column | None, most: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows that may have copies, and the others, which have none (nothing, if all rows may have copies)."""
    if df.isStreaming:
        return df, None
    repeated = repeated_prints(df, of)
    if not fits_broadcast(repeated, most):
        return df, None
    marked = df.select("*", _print_of(df, of))
    few = F.broadcast(repeated)
    return (marked.join(few, _PRINT, "left_semi").drop(_PRINT), marked.join(few, _PRINT, "left_anti").drop(_PRINT))


def copy_sizes(df: DataFrame, of: Column | None = None, most: int = REPEATED) -> DataFrame:
    """One of each set of equal rows, and how many rows the set has (`_copies`)."""
    suspects, single = _suspects(df, of, most)
    sizes = suspects.groupBy(*df.columns).agg(F.count("*").alias(_COPIES))
    return sizes if single is None else sizes.unionByName(single.withColumn(_COPIES, F.lit(1).cast("long")))


def drop_copies(df: DataFrame, of: Column | None = None, most: int = REPEATED) -> DataFrame:
    """Keep one of each exact copy. Copies of a hot row are merged before the shuffle."""
    suspects, single = _suspects(df, of, most)
    kept = suspects.dropDuplicates()
    return kept if single is None else kept.unionByName(single)


def clean_light(raw: DataFrame) -> DataFrame:
    """Positive durations, exact copies removed."""
    return drop_copies(raw.where(F.col("duration_min") > 0), trip_print())


def clean_trips(raw: DataFrame) -> DataFrame:
    """Positive durations, both key facts known, exact copies removed, calendar columns added.

    The row filters come first so that only surviving rows are looked at for the copy removal;
    as copies are equal in every column the result is the same in either order.
    """
    usable = raw.where(F.col("duration_min") > 0).dropna(subset=["destination", "rider_type"])
    return drop_copies(usable, trip_print()).withColumns(scalars.calendar("started_at"))


def defect_profile(raw: DataFrame) -> DataFrame:
    """Each defect counted in one pass."""
    return raw.agg(
        F.count("*").alias("raw_rows"),
        F.count_if(F.col("duration_min") <= 0).alias("bad_duration"),
        F.count_if(F.col("destination").isNull()).alias("no_destination"),
        F.count_if(F.col("rider_type").isNull()).alias("no_rider_type"),
    )


def copy_count(df: DataFrame, of: Column | None = None, most: int = REPEATED) -> DataFrame:
    """Rows beyond the first of each set of exact copies; rows without a copy are not grouped at all."""
    suspects, _ = _suspects(df, of, most)
    sizes = suspects.groupBy(*df.columns).agg(F.count("*").alias(_COPIES))
    return sizes.agg(F.coalesce(F.sum(F.col(_COPIES) - 1), F.lit(0)).alias("copies"))


def clean_balance(raw: DataFrame) -> DataFrame:
    """raw rows = clean rows + the rows each rule removes, counted on the distinct rows and their copies."""
    sizes = copy_sizes(raw, trip_print())
    too_short = ~(F.col("duration_min") > 0)
    missing = F.col("destination").isNull() | F.col("rider_type").isNull()
    return sizes.agg(
        F.sum(_COPIES).alias("raw_rows"),
        F.sum(F.col(_COPIES) - 1).alias("copies"),
        F.count_if(too_short).alias("bad_duration"),
        F.count_if(~too_short & missing).alias("missing_facts"),
        F.count_if(~too_short & ~missing).alias("clean_rows"),
    ).withColumn("balanced", F.col("raw_rows") == F.col("copies") + F.col("bad_duration")
                 + F.col("missing_facts") + F.col("clean_rows"))
