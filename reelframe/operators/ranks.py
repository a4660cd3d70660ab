"""Running counts over a sorted value that never put a whole hot key into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: The bucket of rows whose bucket is null: before all others.
_NULL_BUCKET = -(1 << 62)


def keyed(df: DataFrame, keys: list[str], bucket: Column) -> tuple[DataFrame, list[str]]:
    """(rows with _in_bucket, which is never null; the columns that stand for ``keys``): the keys where none can be null, else _in_key, the keys as one struct.

    Structs of null fields equal each other, so that null keys join as they meet in a window's partition, and an equi-join on these columns and the bucket
    finds rows where a window over them has put and sorted them.
    """
    rows = df.withColumn("_in_bucket", F.coalesce(bucket.cast("long"), F.lit(_NULL_BUCKET)))
    if not any(df.schema[k].nullable for k in keys):
        return rows, keys
    return rows.withColumn("_in_key", F.struct(*keys)), ["_in_key"]


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """An inner equi-join in which null keys meet null keys; the columns of ``on`` come once."""
    r = right.select(F.struct(*on).alias("_on"), *[c for c in right.columns if c not in on])
    return left.withColumn("_on", F.struct(*on)).join(r, "_on").drop("_on")


def bucketed(df: DataFrame, keys: list[str], order: list[str | Column], value: str, out: str, bucket: Column, how: str = "sum", falling: bool = False) -> DataFrame:
    """Add ``out`` = the sum, the greatest or the last that is not null (``how``: sum, max, last) of ``value`` over the rows of the same ``keys`` up to and including this one by ``order``.

    ``bucket`` is a function of the order that does not decrease along it (does not increase, if ``falling``). Rows are looked at inside (keys, bucket), and what the
    buckets before give comes from a second, far smaller window over one row a bucket, so a key that holds a third of all rows is
    spread over its buckets. ``order`` must be unique within ``keys`` but for rows of equal value. Empty input gives empty output; null keys are one entity,
    and rows whose bucket is null are a bucket of their own, so that every row stays.
    """
    take = {"sum": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}[how]
    b, k = keyed(df, keys, bucket)
    inner = Window.partitionBy(*k, "_in_bucket").orderBy(*order)
    upto = inner.rowsBetween(Window.unboundedPreceding, 0)
    local = b.withColumn("_local", take(value).over(upto))
    if how == "last":  # an aggregate has no order: the last row of a bucket tells
        ends = local.withColumn("_from_end", F.lead(F.lit(1)).over(inner)).where("_from_end IS NULL").select(*k, "_in_bucket", F.col("_local").alias("_total"))
    else:
        ends = b.groupBy(*k, "_in_bucket").agg(take(value).alias("_total"))
    before = Window.partitionBy(*k).orderBy(F.desc("_in_bucket") if falling else F.asc("_in_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_base", take("_total").over(before)).drop("_total")
    both = {"sum": lambda: F.col("_local") + F.coalesce(F.col("_base"), F.lit(0)), "max": lambda: F.greatest("_local", "_base"), "last": lambda: F.coalesce("_local", "_base")}[how]()
    return local.join(ends, [*k, "_in_bucket"]).withColumn(out, both).drop("_local", "_base", "_in_bucket", "_in_key")


def bucketed_cumsum(df: DataFrame, keys: list[str], order: str, value: str, out: str, bucket: Column) -> DataFrame:
    """``bucketed`` for a running sum over one column."""
    return bucketed(df, keys, [order], value, out, bucket)


def neighbour(df: DataFrame, keys: list[str], order: list[str], cols: list[str], out: str, ahead: bool = False, bucket: Column | None = None) -> DataFrame:
    """Add ``out`` = struct of ``cols`` of the row before (``ahead``: after) within ``keys`` by ``order``; null at the end.

    With ``bucket``, a non-decreasing function of the order, rows are compared inside (keys, bucket), and the first (last) of a
    bucket with the end of the bucket before (after), found in a window over one row a bucket: a key of any size is spread. Null keys are one entity, null buckets one bucket before all others.
    """
    here = F.struct(*cols)
    step = F.lead if ahead else F.lag
    if bucket is None:
        return df.withColumn(out, step(here).over(Window.partitionBy(*keys).orderBy(*order)))
    rows, k = keyed(df, keys, bucket)
    pick = F.min_by if ahead else F.max_by
    ends = rows.groupBy(*k, "_in_bucket").agg(pick(here, F.struct(*order)).alias("_end"))
    ends = ends.withColumn("_next", step("_end").over(Window.partitionBy(*k).orderBy("_in_bucket"))).drop("_end")
    rows = rows.withColumn(out, step(here).over(Window.partitionBy(*k, "_in_bucket").orderBy(*order)))
    return rows.join(ends, [*k, "_in_bucket"]).withColumn(out, F.coalesce(out, "_next")).drop("_in_bucket", "_next", "_in_key")
