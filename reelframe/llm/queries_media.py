"""Queries over music_tag (p1) and over transcripts (p2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.llm.speaker_turns import speaker_turns
from reelframe.llm.tags import compared_tags, current_rows
from reelframe.llm.varied_subset import varied_subset
from reelframe.session import read


def p1_picks(spark: SparkSession, d: str) -> DataFrame:
    """For each pick request its tracks in order: request_id, pick, track_id, copies (tracks of the same tags)."""
    rows = current_rows(read(spark, d, "music_tag"), "track_id", "loaded_at", ["emotion", "style", "energy"])
    tracks = rows.select("track_id", compared_tags("emotion").alias("emotion"), compared_tags("style").alias("style"), compared_tags(F.array("energy")).alias("energy"))
    requests = read(spark, d, "pick_request")
    most = requests.agg(F.max("n_pick")).first()[0] or 0
    picks = varied_subset(tracks, most, "track_id", ["emotion", "style", "energy"])
    wanted = requests.where("n_pick >= 1").withColumn("pick", F.explode(F.sequence(F.lit(1), F.col("n_pick"))))
    return wanted.join(picks, "pick").select("request_id", "pick", "track_id", "copies", F.round("residual", 6).alias("residual"))


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return speaker_turns(read(spark, d, "chunk_text"), read(spark, d, "speaker_alias"), read(spark, d, "script_line"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _turns(spark, d).select("orig_index", F.floor(F.col("start_ms") / 1000).cast("int").alias("start_s"), "speaker")


def p2_turns(spark: SparkSession, d: str) -> DataFrame:
    """The turns with their words."""
    return _turns(spark, d).select("orig_index", "start_ms", "speaker", "text", "lines")


QUERIES = {"p1_picks": p1_picks, "p2_found": p2_found, "p2_turns": p2_turns}
SQL: dict[str, str] = {}
