"""Equi-joins whose plan depends on the size and the skew of their sides.

A side is sent to all executors only if its size is within a bound, as the optimizer has it and
as rows in memory: files are compressed, and a few columns of a wide file take a larger share of it
than the optimizer thinks, so files of some size are asked for their number of rows. Above that
the join is shuffled on its keys, and the few keys that hold a large share of the left rows are
taken out first: they match at most one right row each, so those rows are broadcast and the hot
left rows are never shuffled. Which keys count as hot decides only the plan, not the result.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from feedloom import settings


def planned_bytes(df: DataFrame) -> int | None:
    """The optimizer's size of ``df``: file sizes for scans, products for joins. Runs no job."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def held_bytes(df: DataFrame) -> int:
    """About the bytes that the rows of ``df`` take in memory, at most: all rows of the files it is
    read from, in its columns. Their number stands in the files; no row is read."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if read <= settings.UNCOUNTED_BYTES:
        return read
    paths = tuple(sorted(df.inputFiles()))
    counted = tuple(p for p in paths if p.endswith(".parquet"))
    if len(counted) < len(paths):
        return read * UNCOUNTED_GROWTH
    return _rows_in(df.sparkSession, counted) * (
        ROW_BYTES + sum(_width(f.dataType) for f in df.schema.fields))


#: A row's own bytes, and its place in a hash table.
ROW_BYTES = 32
#: What rows of files that do not know their number take, for a byte of the file.
UNCOUNTED_GROWTH = 8


@functools.lru_cache(256)
def _rows_in(spark: SparkSession, paths: tuple[str, ...]) -> int:
    """Rows of parquet files. Kept for a file that is asked for again: only a plan depends on it."""
    return spark.read.schema("none int").option("recursiveFileLookup", "true").parquet(
        *paths).count() if paths else 0


def _width(kind: T.DataType) -> int:
    """Usual bytes of a value in a row; a list counts as one element."""
    if isinstance(kind, T.StructType):
        return 16 + sum(_width(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return 24 + _width(kind.elementType)
    if isinstance(kind, T.MapType):
        return 48 + _width(kind.keyType) + _width(kind.valueType)
    return 32 if isinstance(kind, (T.StringType, T.BinaryType)) else 8


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    limit = settings.BROADCAST_BYTES if limit is None else limit
    size = planned_bytes(df)
    return size is not None and size <= limit and held_bytes(df) <= limit


def shuffled(df: DataFrame) -> DataFrame:
    """A side that does not fit, marked for a shuffle where Spark, which sees the size of the files,
    might broadcast it all the same."""
    size = planned_bytes(df)
    return df.hint("merge") if size is not None and size <= settings.BROADCAST_BYTES else df


def small_side(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if its size allows that, else for a shuffle."""
    return F.broadcast(df) if fits_broadcast(df, limit) else shuffled(df)


def hot_keys(df: DataFrame, key: Column, share: float | None = None) -> list[int]:
    """Hashes of keys that hold at least ``share`` of the rows: never more than ``1 / share``.

    A mergeable frequency sketch over one column; the driver gets that short list only.
    """
    share = settings.HOT_KEY_SHARE if share is None else share
    most = int(1 / share)
    found = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.call_function("approx_top_k", key, F.lit(most), F.lit(most * 20)).alias("top"),
    ).select("rows", F.explode("top").alias("top")).where(
        F.col("top.count") >= F.col("rows") * share).select("top.item")
    return [row[0] for row in found.collect()]


def same_kinds(left: DataFrame, right: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with keys of one type each, the wider of the two, so that equal keys have equal
    hashes whichever way the join goes."""
    for key in on:
        kinds = left.schema[key].dataType, right.schema[key].dataType
        if kinds[0] != kinds[1]:
            wider = left.select(key).limit(0).union(right.select(key).limit(0)).schema[0].dataType
            left, right = (side.withColumn(key, F.col(key).cast(wider)) for side in (left, right))
    return left, right


def lookup_join(left: DataFrame, right: DataFrame, on, how: str = "left",
                limit: int | None = None, unique: bool = True) -> DataFrame:
    """Join ``right``, which holds one row per key unless ``unique`` is false.

    Looking for hot keys reads the key columns of the left side once; it is left out where that
    side is small as a whole. ``limit=0`` asks for it in any case.
    """
    on = [on] if isinstance(on, str) else list(on)
    left, right = same_kinds(left, right, on)
    if fits_broadcast(right, limit):
        return left.join(F.broadcast(right), on, how)
    size = planned_bytes(left)
    few_left = limit != 0 and size is not None and size <= settings.SKEW_CHECK_BYTES
    hashed = F.xxhash64(*on)
    hot = hot_keys(left, hashed) if unique and not few_left else []
    if not hot:
        return left.join(shuffled(right), on, how)
    is_hot = hashed.isin(hot)
    few = right.where(is_hot)
    # A key that repeats on the right, against the promise, must not swell what is broadcast.
    most = 2 * len(hot)
    if few.limit(most + 1).count() > most:
        return left.join(shuffled(right), on, how)
    return (
        left.where(is_hot).join(F.broadcast(few), on, how)
        .unionByName(left.where(~is_hot).join(shuffled(right.where(~is_hot)), on, how)))
