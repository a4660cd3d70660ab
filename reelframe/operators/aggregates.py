"""Two-level metrics, ensembles and the aggregates over tracks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean_colour(samples: DataFrame, keys: list[str]) -> DataFrame:
    """A1: mean r, g, b of the samples of a boundary, truncated to whole numbers; no sample, null."""
    return samples.groupBy(*keys).agg(F.struct(*[F.avg(c).cast("int").alias(c) for c in "rgb"]).alias("rgb"))


def cue_stats(cues: DataFrame, keys: list[str]) -> DataFrame:
    """A3: number of cues, characters, mean length and last end."""
    n = F.length("text")
    return cues.groupBy(*keys).agg(F.count(F.lit(1)).alias("cues"), F.sum(n).alias("chars"), F.avg(n).alias("avg_chars"), F.max("end_time").alias("last_end"))


def outcomes(df: DataFrame, keys: list[str], ok: Column) -> DataFrame:
    """A4: successes and failures; null is a failure."""
    good = F.coalesce(ok, F.lit(False))
    return df.groupBy(*keys).agg(F.count_if(good).alias("succeeded"), F.count_if(~good).alias("failed"))


def metric_summary(values: DataFrame, instruments: DataFrame) -> DataFrame:
    """Metric, instrument, mean, std (population) of each listed instrument; NaN where it has no value.

    A plain grouped aggregate: partial sums before the shuffle take the place of gathering lists from workers, and nothing is padded.
    """
    got = values.groupBy("metric", "instrument").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    # The instruments are a short list; it goes to each metric as one array.
    listed = instruments.agg(F.collect_set("instrument").alias("_i")).withColumn("_k", F.lit(1))
    want = values.select("metric").distinct().withColumn("_k", F.lit(1)).join(listed, "_k").select("metric", F.explode("_i").alias("instrument"))
    nan = F.lit(float("nan"))
    return want.join(got, ["metric", "instrument"], "left").select("metric", "instrument", F.coalesce("mean", nan).alias("mean"), F.coalesce("std", nan).alias("std"))


def macro_average(summary: DataFrame) -> DataFrame:
    """A5: metric, macro: the sum of the instruments' means over their number; NaN if one has none."""
    return summary.groupBy("metric").agg((F.sum("mean") / F.count(F.lit(1))).alias("macro"))


def latest_metric(values: DataFrame, order: str) -> DataFrame:
    """One value per metric, instrument and path: the last written."""
    return values.groupBy("metric", "instrument", "path").agg(F.max_by("value", F.struct(F.col(order), F.col("value"))).alias("value"))


def ordered_concat(chunks: DataFrame, parent: list[str], order: list[str], text: str) -> DataFrame:
    """The texts of a parent's chunks in order, joined without a separator; null texts count as empty."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.coalesce(text, F.lit("")).alias("_t"))))
    return chunks.groupBy(*parent).agg(F.array_join(F.transform(rows, lambda x: x["_t"]), "").alias(text))


def merged_items(chunks: DataFrame, parent: list[str], order: list[str], offset: str = "offset_sec") -> DataFrame:
    """The items of a parent's chunks in order, shifted by their chunk's offset and rounded to 3 places; none gives null."""
    shifted = F.transform(
        "items", lambda i: F.struct(i["text"].alias("text"), F.bround(i["start_time"] + F.col(offset), 3).alias("start_time"), F.bround(i["end_time"] + F.col(offset), 3).alias("end_time"))
    )
    rows = F.array_sort(F.collect_list(F.when(F.col("items").isNotNull(), F.struct(*order, shifted.alias("i")))))
    flat = F.flatten(F.transform(rows, lambda x: x["i"]))
    return chunks.groupBy(*parent).agg(F.when(F.size(flat) > 0, flat).alias("items"))


def track_lengths(stems: DataFrame, keys: list[str], frames: str) -> DataFrame:
    """The length of a track is that of its shortest stem; uneven tells whether they differ."""
    return stems.groupBy(*keys).agg(F.min(frames).alias("length"), (F.min(frames) != F.max(frames)).alias("uneven"))


def ensemble(samples: DataFrame, keys: list[str], pos: str, value: str, weight: str, source: str, how: str) -> DataFrame:
    """One value per position from the sources: 'avg', 'median', 'min' or 'max' (by absolute value, sign kept, first source on ties)."""
    v, s = F.col(value), F.col(source)
    agg = {
        "avg": F.sum(v * F.col(weight)) / F.sum(weight),
        "median": F.median(v),
        "min": F.min_by(v, F.struct(F.abs(v), s)),
        "max": F.max_by(v, F.struct(F.abs(v), -s)),
    }
    if how not in agg:
        raise ValueError(f"unknown ensemble {how}; known: {sorted(agg)}")
    return samples.groupBy(*keys, pos).agg(agg[how].alias(value))


def quantile_masked_mean(df: DataFrame, keys: list[str], value: str, q: float) -> DataFrame:
    """Mean over all rows of the values below the q-quantile (linear), the others as 0."""
    cut = df.groupBy(*keys).agg(F.percentile(value, F.lit(q)).alias("_q"))
    rows = df.join(cut, keys)
    return rows.groupBy(*keys).agg(F.avg(F.when(F.col(value) < F.col("_q"), F.col(value)).otherwise(0.0)).alias("masked_mean"))


def overlap_add(chunks: DataFrame, keys: list[str], start: str, values: str, window: Column) -> DataFrame:
    """Keys, pos, value: windowed chunks added up over the sum of their windows; a position of no weight is 0."""
    rows = chunks.select(*keys, start, F.posexplode(F.zip_with(values, window, lambda v, w: F.struct(v.alias("v"), w.alias("w")))).alias("_i", "_x")).where("_x.v IS NOT NULL AND _x.w IS NOT NULL")
    rows = rows.groupBy(*keys, (F.col(start) + F.col("_i")).alias("pos")).agg(F.sum(F.col("_x.v") * F.col("_x.w")).alias("_s"), F.sum("_x.w").alias("_w"))
    return rows.select(*keys, "pos", F.coalesce(F.try_divide("_s", "_w"), F.lit(0.0)).alias("value"))


def upsert(table: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """Rows of ``new`` take the place of those of the same key and stand first: their ``order`` is below all others."""
    head = table.agg(F.coalesce(F.min(order), F.lit(0)).alias("_h")).withColumn("_k", F.lit(1))
    placed = new.withColumn("_k", F.lit(1)).join(F.broadcast(head), "_k").withColumn(order, F.col("_h") - 1).drop("_h", "_k")
    return table.join(new.select(*key).distinct(), key, "left_anti").unionByName(placed)


def preflight(folders: DataFrame, parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Key, has_<part> for each part, ready if all are there."""
    out = folders.select(key).distinct()
    for name, df in parts.items():
        out = out.join(df.select(key).distinct().withColumn(f"has_{name}", F.lit(True)), key, "left").withColumn(f"has_{name}", F.coalesce(f"has_{name}", F.lit(False)))
    ready = F.lit(True)
    for name in parts:
        ready = ready & F.col(f"has_{name}")
    return out.withColumn("ready", ready)


def neighbour_indices(junctions: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Keys, clip: the distinct clips on either side of the junctions."""
    return junctions.select(*keys, F.explode(F.array(F.col(index), F.col(index) + 1)).alias("clip")).distinct()


def retention(words: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    """Verdict on a segmentation by the share of characters it keeps: 'reject' below 0.80, 'warn' below 0.90, else 'ok'."""
    from reelframe.functions.text import han

    a = words.groupBy(*keys).agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("said"))
    b = segments.groupBy(*keys).agg(F.sum(F.length(han("text"))).alias("kept"))
    r = F.coalesce("kept", F.lit(0)) / F.greatest("said", F.lit(1))
    return a.join(b, keys, "left").select(*keys, r.alias("ratio"), F.when(r < 0.80, "reject").when(r < 0.90, "warn").otherwise("ok").alias("verdict"))


def sampled_chunks(spark, tracks: DataFrame, draws: int, chunk: int, seed: int, buckets: int = 1024) -> DataFrame:  # noqa: ANN001
    """``draws`` draws with replacement, uniform over the tracks and then over the offset: draw, path, offset. Seeded.

    Tracks are numbered within hash buckets of their path; a draw finds its bucket in the running counts of the buckets (one row
    each) and meets its track on (bucket, number), so that nothing is sorted in one task. A path given twice is two tracks. No tracks, no rows.
    """
    from pyspark.sql import Window

    t = tracks.select("path", "n_frames", F.pmod(F.xxhash64("path"), F.lit(buckets)).cast("int").alias("_b"))
    numbered = t.withColumn("_i", F.row_number().over(Window.partitionBy("_b").orderBy("path", "n_frames")) - 1)
    sizes = t.groupBy("_b").agg(F.count(F.lit(1)).alias("n")).orderBy("_b").collect()  # at most one row a bucket
    ends, n = [], 0
    for r in sizes:
        ends.append((n, n + r["n"], r["_b"]))
        n += r["n"]
    if not n:
        return spark.createDataFrame([], "draw long, path string, offset long")
    of = spark.createDataFrame(ends, "lo long, hi long, _b int")
    d = spark.range(draws).select(F.col("id").alias("draw"), F.floor(F.rand(seed) * n).cast("long").alias("_k"), F.rand(seed + 1).alias("_u"))
    # The greatest lower end not above a draw's number names its bucket: the bounds are one sorted array of at most `buckets` entries.
    table = of.agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "_b"))).alias("_t")).withColumn("_one", F.lit(1))
    d = d.withColumn("_one", F.lit(1)).join(F.broadcast(table), "_one")
    d = d.withColumn("_x", F.element_at(F.filter("_t", lambda x: (x["lo"] <= F.col("_k")) & (F.col("_k") < x["hi"])), 1)).select("draw", "_u", F.col("_x._b").alias("_b"), (F.col("_k") - F.col("_x.lo")).cast("int").alias("_i"))
    room = F.greatest(F.col("n_frames") - chunk, F.lit(0)) + 1
    return d.join(numbered, ["_b", "_i"]).select("draw", "path", F.floor(F.col("_u") * room).cast("long").alias("offset"))


def mixup(chunks: DataFrame, p: float, seed: int) -> DataFrame:
    """With probability p a chunk is averaged with the next draw of the same instrument: draw, instrument, values."""
    from pyspark.sql import Window

    w = Window.partitionBy("instrument").orderBy("draw")
    other = F.lead("values").over(w)
    take = (F.rand(seed) < p) & other.isNotNull()
    return chunks.withColumn("_o", other).withColumn("values", F.when(take, F.zip_with("values", "_o", lambda a, b: (a + b) / 2)).otherwise(F.col("values"))).drop("_o")


def epoch_loss(steps: DataFrame, keys: list[str], loss: str) -> DataFrame:
    """Keys, loss: the sum over steps by their number, whatever the workers that they ran on; null losses count as no step."""
    return steps.groupBy(*keys).agg(F.avg(loss).alias("loss"), F.count(loss).alias("steps"))


def found_and_skipped(listed: DataFrame, lengths: DataFrame, keys: list[str], path: str, length: str) -> DataFrame:
    """Keys, listed, found, skipped: of the tracks listed, those whose length is known; a path without one (or null) is skipped."""
    rows = listed.select(*keys, path).join(lengths.groupBy(path).agg(F.max(length).alias("_n")), path, "left")
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("listed"), F.count("_n").alias("found"), F.count_if(F.col("_n").isNull()).alias("skipped"))


def target_instruments(config: DataFrame, keys: list[str], instruments: str, target: str) -> DataFrame:
    """P20: keys, instrument, index: the target instrument where one is set (null or empty: none is), else all of the list, with their place in the list (null if it is not in it)."""
    chosen = F.when(F.coalesce(target, F.lit("")) != "", F.array(F.col(target))).otherwise(F.col(instruments))
    rows = config.select(*keys, F.col(instruments).alias("_all"), F.explode(chosen).alias("instrument"))
    return rows.select(*keys, "instrument", F.nullif(F.array_position("_all", F.col("instrument")), F.lit(0)).cast("int").alias("index"))


def aligned_draws(levels: DataFrame, keys: list[str], attempt: str, level: str, least: float, attempts: int = 10) -> DataFrame:
    """P9 (aligned): the draw that is kept of an entity: the first of ``attempts`` (from 0) in which no stem is quieter than ``least``, else the last one made.

    ``levels``: a row a stem and draw with its mean absolute value; null is quiet. Output: keys, attempt, quiet (stems of that draw).
    """
    draws = levels.where(F.col(attempt) < attempts).groupBy(*keys, attempt).agg(F.count_if(~F.coalesce(F.col(level) >= least, F.lit(False))).alias("quiet"))
    best = F.min_by(F.struct(attempt, "quiet"), F.when(F.col("quiet") == 0, F.struct(F.lit(0).alias("k"), F.col(attempt).cast("long").alias("a"))).otherwise(F.struct(F.lit(1).alias("k"), (-F.col(attempt).cast("long")).alias("a"))))
    return draws.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")
