"""Joins that stay even when one key holds a large share of the rows, or when one side is wide and hardly touched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

HOT_SHARE = 0.001
#: Bits of one part of a membership bitmap (what the engine's bitmap functions use), and of the largest bitmap that is broadcast (64 MB).
PART_BITS = 32_768
MOST_BITS = 1 << 29


def hot_keys(df: DataFrame, key: str, hot_share: float = HOT_SHARE) -> list:
    """Keys that hold more than ``hot_share`` of all rows: never more than ``1 / hot_share`` of them, whatever the input."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"))
    least = float(df.count()) * hot_share + 1
    return [r[0] for r in counts.where(F.col("__n") > F.lit(least)).select(key).collect()]


def skew_safe_join(many: DataFrame, few: DataFrame, key: str, how: str = "inner", hot_share: float = HOT_SHARE) -> DataFrame:
    """``many`` joined to ``few`` on ``key``, where each key has few rows in ``few`` but may hold a third of ``many``.

    Rows of hot keys (at most ``1 / hot_share`` keys, so their side of ``few`` has a proven bound) meet a broadcast and don't
    move; all others are shuffled, at most ``hot_share`` of the rows to one task. ``many`` is read three times and ``few`` twice, so
    pass tables or materialised frames. Null keys join nothing.
    """
    found = hot_keys(many, key, hot_share)
    if not found:
        return many.join(few, key, how)
    hot = many.sparkSession.createDataFrame([(k,) for k in found], StructType([StructField(key, many.schema[key].dataType)]))
    cold_part = many.join(F.broadcast(hot), key, "left_anti").join(few, key, how)
    hot_few = few.join(F.broadcast(hot), key, "left_semi")
    hot_part = many.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(hot_few), key, how)
    return cold_part.unionByName(hot_part)


def _slot(key: Column, bits: int) -> tuple[Column, Column]:
    """(part, bit within it) of a key in a bitmap of ``bits`` bits."""
    at = F.pmod(F.xxhash64(key), F.lit(bits))
    return F.floor(at / PART_BITS).cast("int"), F.pmod(at, F.lit(PART_BITS))


def anti_join_in_place(df: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` isn't among the keys of ``removed``; null keys stay.

    For wide rows of which few go: a bitmap of the removed keys' hashes, never above ``MOST_BITS``, is broadcast, and rows whose bit
    isn't set stay where they are. Only the others, the removed ones and those few that share a bit, meet the exact anti join.
    ``removed`` is read three times, so pass a table or a materialised frame.
    """
    gone = removed.select(F.col(key).alias("__gone")).where(F.col("__gone").isNotNull())
    n = gone.count()
    if not n:
        return df
    bits = PART_BITS
    while bits < min(MOST_BITS, 32 * n):
        bits *= 2
    part, bit = _slot(F.col("__gone"), bits)
    bitmap = gone.select(part.alias("__part"), bit.alias("__bit")).groupBy("__part").agg(F.bitmap_construct_agg("__bit").alias("__bits"))
    part, bit = _slot(F.col(key), bits)
    at = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = df.withColumn("__part", part).join(F.broadcast(bitmap), "__part", "left").withColumn("__maybe", F.coalesce(F.getbit(at, F.pmod(bit, F.lit(8)).cast("int")) == 1, F.lit(False)) & F.col(key).isNotNull())
    stays = marked.where(~F.col("__maybe")).select(*df.columns)
    asked = marked.where("__maybe").select(*df.columns)
    return stays.unionByName(asked.join(gone.distinct(), F.col(key) == F.col("__gone"), "left_anti"))


def bounded_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """``df``, broadcast where it has at most ``rows`` rows by count; otherwise Spark chooses the join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
