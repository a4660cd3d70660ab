"""Writers: subtitle text, result JSON, manifests, filter graphs, logs; files are written by Spark, one per entity key where asked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelframe.functions.text import base_name, srt_time


def srt_text(cues: DataFrame, keys: list[str], order: list[str], start: str = "start_time", end: str = "end_time") -> DataFrame:
    """K1: keys, srt: numbered from 1, times truncated to milliseconds."""
    rows = F.array_sort(F.collect_list(F.struct(*dict.fromkeys([*order, start, end, "text"]))))
    block = lambda x, i: F.concat((i + 1).cast("string"), F.lit("\n"), srt_time(x[start]), F.lit(" --> "), srt_time(x[end]), F.lit("\n"), F.coalesce(x["text"], F.lit("")), F.lit("\n\n"))
    return cues.groupBy(*keys).agg(F.array_join(F.transform(rows, block), "").alias("srt"))


def result_json(cues: DataFrame, keys: list[str], order: list[str], note: str = "") -> DataFrame:
    """K2: keys, json: count, note and the cues with their durations."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.struct("text", "start_time", "end_time", F.bround(F.col("end_time") - F.col("start_time"), 3).alias("duration")).alias("c"))))
    cues_ = F.transform(rows, lambda x: x["c"])
    return cues.groupBy(*keys).agg(F.to_json(F.struct(F.count(F.lit(1)).alias("total"), F.lit(note).alias("note"), cues_.alias("subtitles"))).alias("json"))


def manifest_json(clips: DataFrame, keys: list[str], order: str) -> DataFrame:
    """K3, K5: keys, json: the clips of an entity as an array in order."""
    cols = [c for c in clips.columns if c not in keys and c != order]
    rows = F.array_sort(F.collect_list(F.struct(order, F.struct(*cols).alias("c"))))
    return clips.groupBy(*keys).agg(F.to_json(F.transform(rows, lambda x: x["c"])).alias("json"))


def write_texts(rows: DataFrame, key: str, text: str, path: str) -> None:
    """One directory per key, the text in it with a line end after its last line; the writer runs in parallel over keys."""
    rows.select(F.col(key), F.regexp_replace(text, r"\n\z", "").alias("value")).repartition(key).write.mode("overwrite").partitionBy(key).text(path)


def read_through(spark, path: str, compute):  # noqa: ANN001, ANN201
    """A table kept at a path: read if it is there, else computed and written."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def edit_decisions(trims: DataFrame) -> DataFrame:
    """K6: action 'copy' where nothing is trimmed, else 'encode' with seek and length (null: to the end)."""
    none = F.col("start_trim").isNull() & F.col("end_trim").isNull()
    seek = F.coalesce("start_trim", F.lit(0.0))
    return trims.withColumn("action", F.when(none, "copy").otherwise("encode")).withColumn("seek_s", F.when(~none, seek)).withColumn("length_s", F.when(~none, F.col("end_trim") - seek))


def concat_filter(clips: DataFrame, keys: list[str], order: str, width: int = 1920, height: int = 1080, fps: int = 30, fade: float = 0.5) -> DataFrame:
    """K7: keys, filter: the filter graph that scales, trims, fades and joins the clips of an entity; the encoder itself is behind an adapter."""
    i, trim = F.col(order).cast("string"), F.col("trim_frames") / F.lit(float(fps))
    out = F.when(F.col("has_fade_after"), F.format_string(f",fade=t=out:st=%.3f:d={fade}", F.col("effective_s") - fade)).otherwise("")
    v = F.concat(F.lit("["), i, F.lit(":v]"), F.format_string(f"trim=start=%.6f,setpts=PTS-STARTPTS,scale={width}:{height},fps={fps}", trim), out, F.lit("[v"), i, F.lit("];"))
    a = F.concat(F.lit("["), i, F.lit(":a]"), F.format_string("atrim=start=%.6f,asetpts=PTS-STARTPTS", trim), F.lit("[a"), i, F.lit("];"))
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.concat(v, a).alias("f"), F.concat(F.lit("[v"), i, F.lit("][a"), i, F.lit("]")).alias("p"))))
    joined = lambda k: F.array_join(F.transform(rows, lambda x: x[k]), "")
    return clips.groupBy(*keys).agg(F.concat(joined("f"), joined("p"), F.lit("concat=n="), F.count(F.lit(1)).cast("string"), F.lit(":v=1:a=1[v][a]")).alias("filter"))


def moved_path(path: Column | str, root: str) -> Column:
    """K9: a path below a new root by its last part."""
    return F.concat(F.lit(root.rstrip("/") + "/"), base_name(path))


def archive_names(new: DataFrame, existing: DataFrame, name: str, stamp: str) -> DataFrame:
    """Target: a name that is taken gets a time stamp before its extension."""
    taken = existing.select(name).distinct().withColumn("_t", F.lit(True))
    alt = F.regexp_replace(F.col(name), r"^(.*?)(\.[^.]*)?$", f"$1_{stamp}$2")
    return new.join(taken, name, "left").withColumn("target", F.when(F.col("_t"), alt).otherwise(F.col(name))).drop("_t")


def results_log(summary: DataFrame) -> DataFrame:
    """The lines of a result log."""
    return summary.select(F.format_string("Instr %s %s: %.4f (Std: %.4f)", "instrument", "metric", "mean", "std").alias("value"))
