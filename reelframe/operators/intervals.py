"""Overlapping and gapped time intervals: continuous periods per entity and the gaps between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.operators.ranks import bucketed_cumsum

#: A bucket of the time axis in milliseconds. Starts and ends are pre-aggregated to one row a millisecond,
#: so a bucket holds at most this many rows, however many intervals fall into it.
BUCKET_MS = 600_000
#: A bucket of ranks, for the numbering of boundaries.
BUCKET_RANKS = 1 << 18

_FIRST, _LAST = -(1 << 63), (1 << 63) - 1


def periods_and_gaps(df: DataFrame, keys: list[str], start: str, end: str, max_gap_ms: int | None = None, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Merge intervals into periods and list the gaps between neighbouring periods.

    Starts and ends are sorted independently within each entity (``keys``). Where the start ranked k+1 lies
    after the end ranked k, no interval covers the space between: that pair is a boundary. Neighbouring
    boundaries give the periods, each boundary itself is a gap.

    ``start`` and ``end`` are integer columns in milliseconds. Output: keys, kind ('period' or 'gap'),
    start_ms, end_ms. Intervals that touch or overlap are joined.

    Defined results: rows with a null time or end <= start do not count; null is a key like any other;
    repeated rows and nested intervals change nothing; a gap of ``max_gap_ms`` or more is not listed
    (None lists all); empty input gives no rows. Other columns of ``df`` are ignored, whatever their name.

    Plan: one row per entity and distinct start (end) is all that is shuffled; ranks are running counts over
    time buckets, and the ranked sequences meet on (entity, rank), so no entity is gathered in one task.
    """
    base = df.select(
        F.struct(*[F.col(f"`{c}`") for c in keys]).alias("_key"), F.col(f"`{start}`").cast("long").alias("_s"), F.col(f"`{end}`").cast("long").alias("_e")
    ).where(F.col("_e") > F.col("_s"))

    # Starts and ends go the same way in one pass, each kind with its own ranks.
    times = base.select("_key", F.explode(F.array(F.struct(F.lit("s").alias("k"), F.col("_s").alias("t")), F.struct(F.lit("e").alias("k"), F.col("_e").alias("t")))).alias("x"))
    distinct = times.groupBy("_key", F.col("x.k").alias("_kind"), F.col("x.t").alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    ranked = bucketed_cumsum(distinct, ["_key", "_kind"], "_t", "_n", "_rank", F.floor(F.col("_t") / F.lit(bucket_ms)))
    # The rank of the last of equal ends meets the rank before the first of equal starts; before the first
    # start and after the last end stands an open boundary.
    is_end, null = F.col("_kind") == "e", F.lit(None).cast("long")
    marks = ranked.select(
        "_key", F.when(is_end, F.col("_rank")).otherwise(F.col("_rank") - F.col("_n")).alias("_k"), F.when(is_end, F.col("_t")).alias("_end"), F.when(~is_end, F.col("_t")).alias("_start")
    )
    total = base.groupBy("_key").agg(F.count(F.lit(1)).alias("_total"))
    mark = lambda k, e, s: F.struct(k.alias("_k"), e.alias("_end"), s.alias("_start"))
    outer = total.select("_key", F.explode(F.array(mark(F.lit(0).cast("long"), F.lit(_FIRST), null), mark(F.col("_total"), null, F.lit(_LAST)))).alias("m")).select("_key", "m.*")
    bounds = marks.unionByName(outer).groupBy("_key", "_k").agg(F.max("_end").alias("_end"), F.max("_start").alias("_start"))
    bounds = bounds.where(F.col("_start") > F.col("_end")).withColumn("_one", F.lit(1))
    bounds = bucketed_cumsum(bounds, ["_key"], "_k", "_one", "_j", F.floor(F.col("_k") / F.lit(BUCKET_RANKS)))

    def part(j, kind, s, e):  # noqa: ANN001, ANN202
        return F.struct(j.alias("j"), F.lit(kind).alias("kind"), s.alias("s"), e.alias("e"))

    j, s, e = F.col("_j"), F.col("_start"), F.col("_end")
    parts = bounds.select("_key", F.explode(F.array(part(j, "period", s, null), part(j - 1, "period", null, e), part(j, "gap", e, s))).alias("p"))
    out = parts.groupBy("_key", F.col("p.j").alias("_j"), F.col("p.kind").alias("kind")).agg(F.max("p.s").alias("start_ms"), F.max("p.e").alias("end_ms"))
    out = out.where((F.col("start_ms") > _FIRST) & (F.col("start_ms") < _LAST) & (F.col("end_ms") > _FIRST) & (F.col("end_ms") < _LAST))
    if max_gap_ms is not None:
        out = out.where((F.col("kind") == "period") | (F.col("end_ms") - F.col("start_ms") < max_gap_ms))
    return out.select("_key.*", "kind", "start_ms", "end_ms")
