"""Queries of the core operators over the driver's tables, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.operators.intervals import periods_and_gaps
from reelframe.plans import fuzzy_sql, io_queries, pass_queries, record_queries, source_queries, text_queries, timeline_queries, timeline_sql
from reelframe.session import read

#: A gap this long is a break in the recording.
BREAK_MS = 600_000


def _to_ms(c: str):  # noqa: ANN202
    return F.round(F.col(c) * 1000.0).cast("long")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    both = [
        read(spark, d, t).select(F.lit(t).alias("track"), "episode", _to_ms("start_time").alias("s"), _to_ms("end_time").alias("e")) for t in ("word", "cue")
    ]
    return periods_and_gaps(both[0].unionByName(both[1]), ["track", "episode"], "s", "e", BREAK_MS)


P3_SQL = """
WITH rows AS (
  SELECT 'word' AS track, episode, CAST(round(start_time * 1000) AS BIGINT) AS s, CAST(round(end_time * 1000) AS BIGINT) AS e FROM word
  UNION ALL
  SELECT 'cue', episode, CAST(round(start_time * 1000) AS BIGINT), CAST(round(end_time * 1000) AS BIGINT) FROM cue
), ok AS (SELECT * FROM rows WHERE s IS NOT NULL AND e IS NOT NULL AND e > s),
seen AS (SELECT *, max(e) OVER (PARTITION BY track, episode ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM ok),
marked AS (SELECT *, CASE WHEN before IS NULL OR s > before THEN 1 ELSE 0 END AS new FROM seen),
grouped AS (SELECT *, sum(new) OVER (PARTITION BY track, episode ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM marked),
periods AS (SELECT track, episode, g, min(s) AS start_ms, max(e) AS end_ms FROM grouped GROUP BY ALL),
gaps AS (SELECT track, episode, end_ms AS start_ms, lead(start_ms) OVER (PARTITION BY track, episode ORDER BY start_ms) AS end_ms FROM periods)
SELECT track, episode, 'period' AS kind, start_ms, end_ms FROM periods
UNION ALL
SELECT track, episode, 'gap', start_ms, end_ms FROM gaps WHERE end_ms IS NOT NULL AND end_ms - start_ms < 600000
"""

QUERIES = {"p3_found": p3_found} | text_queries.QUERIES | timeline_queries.QUERIES | io_queries.QUERIES | record_queries.QUERIES | pass_queries.QUERIES | source_queries.QUERIES
SQL = {"p3_found": P3_SQL} | text_queries.SQL | timeline_sql.SQL | io_queries.SQL | record_queries.SQL | pass_queries.SQL | source_queries.SQL | fuzzy_sql.SQL
