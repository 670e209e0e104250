"""Joins and per-key sequences that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.session import cut_lineage

BROADCAST_ROWS = 200_000  # a lookup side is broadcast only when it is known to have no more rows
BROADCAST_BYTES = 64 << 20  # and is not estimated to be larger than this
HOT_SHARES = 1_000        # a key is hot above 1/HOT_SHARES of the rows, so there are fewer hot keys than this
PIECES = 64               # a hot key is spread over so many pieces, each of which is no longer hot


def fits_broadcast(dim: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Checked bound on rows and bytes: rows are counted by partition, bytes are the width of the rows counted."""
    parts = dim.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))
    rows = parts.agg(F.sum("n")).first()[0] or 0
    return rows <= max_rows and rows * _width(dim) <= BROADCAST_BYTES


def _width(df: DataFrame) -> int:
    """Bytes of a row as the optimiser assumes them: the default sizes of its columns' types."""
    sizes = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "date": 4, "float": 4, "string": 20, "binary": 100}
    return 8 + sum(sizes.get(f.dataType.typeName(), 8) for f in df.schema)


def hot_keys(df: DataFrame, key: str, shares: int = HOT_SHARES) -> DataFrame:
    """Keys that hold more than 1/shares of the rows: fewer than `shares` rows by construction."""
    sizes = cut_lineage(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    return sizes.where(F.col("n") > total / shares).select(key)


def lookup_join(facts: DataFrame, dim: DataFrame, key: str, how: str = "inner",
                max_rows: int = BROADCAST_ROWS, shares: int = HOT_SHARES,
                hot: DataFrame | None = None, small: bool | None = None) -> DataFrame:
    """Join facts to a dimension with one row per key (`how`: inner or left).

    A dimension within the checked bound is broadcast: no shuffle, so no skew. A larger one is shuffled
    together with the facts, in one join: facts with a hot key (one of fewer than `shares`, which are
    broadcast) or with none are dealt over `PIECES` numbers, and the dimension rows of hot keys are
    repeated for each of them.
    """
    if small is None:
        small = fits_broadcast(dim, max_rows)
    if small:
        return facts.join(F.broadcast(dim), key, how)
    hot = (hot_keys(facts, key, shares) if hot is None else hot).select(key, F.lit(True).alias("_hot"))
    # rows are numbered within their partition, so neighbours go to different pieces
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(PIECES)).cast("int")
    dealt = facts.join(F.broadcast(hot), key, "left").withColumn(
        "_piece", F.when(F.col("_hot") | F.col(key).isNull(), spread).otherwise(0)).drop("_hot")
    pieces = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(PIECES - 1))).otherwise(F.array(F.lit(0)))
    repeated = dim.join(F.broadcast(hot), key, "left").withColumn("_piece", F.explode(pieces)).drop("_hot")
    return dealt.join(repeated, [key, "_piece"], how).drop("_piece")


def salted_join(facts: DataFrame, dim: DataFrame, key: str, spread: str, salts: int = 16,
                how: str = "inner") -> DataFrame:
    """Join with every key split over `salts` shuffle partitions, for streams too.

    Facts take a salt from the hash of `spread`, a column that varies within a key; each dimension
    row is repeated once per salt, so every fact still meets its one row.
    """
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    repeated = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def previous_value(df: DataFrame, key: str, order: list[Column], value: str, chunk: Column,
                   alias: str = "previous") -> DataFrame:
    """`lag(value)` per key in the given order, without holding a whole key in one task.

    `chunk` cuts each key's sequence into consecutive pieces and must not decrease along `order`.
    A window looks back inside the pieces. Only the first row of a piece is left without its answer,
    which is the last value of the piece before: a grouping gives each piece's last value, combined before it is
    shuffled, and the answers, one a piece, are joined to the rows where these already are.
    """
    # as fields of a struct, keys and pieces that are null meet like any other
    piece = [F.struct(F.col(key).alias("k")).alias("_key"), F.struct(chunk.alias("c")).alias("_chunk")]
    rows = df.select("*", *piece)
    inside = Window.partitionBy("_key", "_chunk").orderBy(*order)
    looked = rows.withColumns({"_lag": F.lag(value).over(inside), "_first": F.row_number().over(inside) == 1})
    last = rows.groupBy("_key", "_chunk").agg(F.max_by(value, F.struct(*order)).alias("_last"))
    before = last.select("_key", "_chunk", F.lag("_last").over(
        Window.partitionBy("_key").orderBy("_chunk")).alias("_before"))
    return (looked.join(before, ["_key", "_chunk"], "left")
            .withColumn(alias, F.when(F.col("_first"), F.col("_before")).otherwise(F.col("_lag")))
            .drop("_key", "_chunk", "_lag", "_first", "_before"))
