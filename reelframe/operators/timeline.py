"""Window recipes over ordered, time-stamped rows: sessions, runs, offsets, overlaps.

Every operator takes the keys of an entity and the columns that give its rows a total order. Windows partition by the
entity; operators that look at neighbours and running counts take a ``bucket`` as well, a non-decreasing function of the order, by which an
entity that holds a large share of the rows is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from reelframe.functions.text import han
from reelframe.operators.ranks import bucketed_cumsum, neighbour

FRAME_S = 1 / 30
GAP_AFTER = 0.05


def over(keys: list[str], order: list[str | Column]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def running(keys: list[str], order: list[str | Column]) -> WindowSpec:
    return over(keys, order).rowsBetween(Window.unboundedPreceding, 0)


def before(keys: list[str], order: list[str | Column]) -> WindowSpec:
    return over(keys, order).rowsBetween(Window.unboundedPreceding, -1)


def pause_annotation(words: DataFrame, keys: list[str], order: list[str], least: float = 0.3, bucket: Column | None = None) -> DataFrame:
    """All words of an entity in order, each pause of ``least`` seconds or more marked as [x.xs] (half up on whole milliseconds)."""
    rows = neighbour(words, keys, order, ["start_time"], "_n", True, bucket)
    gap = F.col("_n.start_time") - F.col("end_time")
    tenths = F.floor((F.round(gap * 1000) + 50) / 100).cast("long")
    mark = F.format_string("[%d.%ds]", F.floor(tenths / 10).cast("long"), tenths % 10)
    part = F.concat(F.coalesce("text", F.lit("")), F.when(gap >= least, mark).otherwise(""))
    rows = rows.select(*keys, *order, part.alias("_p"))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "_p"))), lambda x: x["_p"]), "").alias("sequence"))


def gap_sessions(df: DataFrame, keys: list[str], order: list[str], start: str, end: str, gap: float, bucket: Column | None = None) -> DataFrame:
    """Number the sessions of an entity; a row opens a new one if it starts ``gap`` or more after the row before ended.

    The column session counts from 1. A null time opens none. With ``bucket`` the order must be unique within an entity.
    """
    rows = neighbour(df, keys, order, [end], "_n", False, bucket)
    rows = rows.withColumn("_opens", F.when(F.col("_n").isNull() | (F.col(start) - F.col(f"_n.{end}") >= gap), 1).otherwise(0)).drop("_n")
    if bucket is None:
        return rows.withColumn("session", F.sum("_opens").over(running(keys, order))).drop("_opens")
    return bucketed_cumsum(rows.withColumn("_order", F.struct(*order)), keys, "_order", "_opens", "session", bucket).drop("_opens", "_order")


def uncovered_groups(words: DataFrame, keys: list[str], order: list[str], gap: float = 0.5, least_han: int = 2, bucket: Column | None = None) -> DataFrame:
    """Groups of words less than ``gap`` apart with at least ``least_han`` Han characters: keys, text, start_time, end_time. ``bucket``: see ``gap_sessions``."""
    s = gap_sessions(words, keys, order, "start_time", "end_time", gap, bucket)
    rows = s.groupBy(*keys, "session").agg(F.array_sort(F.collect_list(F.struct(*dict.fromkeys([*order, "text", "start_time", "end_time"])))).alias("w"))
    text = han(F.array_join(F.transform("w", lambda x: F.coalesce(x["text"], F.lit(""))), ""))
    out = rows.select(*keys, text.alias("text"), F.element_at("w", 1)["start_time"].alias("start_time"), F.element_at("w", -1)["end_time"].alias("end_time"))
    return out.where(F.length("text") >= least_han)


def truncate_overlaps(cues: DataFrame, keys: list[str], order: list[str], least: float, bucket: Column | None = None) -> DataFrame:
    """A cue that ends after the next one starts ends 0.05 s before it, but not before ``least`` seconds of its own."""
    rows, nxt = neighbour(cues, keys, order, ["start_time"], "_n", True, bucket), F.col("_n.start_time")
    end = F.when(F.col("end_time") > nxt, F.greatest(F.col("start_time") + least, nxt - GAP_AFTER)).otherwise(F.col("end_time"))
    return rows.withColumn("end_time", end).drop("_n")


def resolve_overlaps(cues: DataFrame, keys: list[str], order: list[str], bucket: Column | None = None) -> DataFrame:
    """As W5 with 0.1 s; a cue that starts with or after the next one ends 0.05 s before it, and goes if nothing is left of it.

    The next cue counts as it was, changed or gone.
    """
    rows, nxt = neighbour(cues, keys, order, ["start_time"], "_n", True, bucket), F.col("_n.start_time")
    late = F.col("start_time") >= nxt
    end = F.when(late, nxt - GAP_AFTER).when(F.col("end_time") > nxt, F.greatest(F.col("start_time") + 0.1, nxt - GAP_AFTER)).otherwise(F.col("end_time"))
    rows = rows.withColumn("_end", end).withColumn("_late", F.coalesce(late, F.lit(False)))
    return rows.where(~(F.col("_late") & (F.col("_end") <= F.col("start_time")))).drop("end_time", "_late", "_n").withColumnRenamed("_end", "end_time")


def clip_timeline(clips: DataFrame, keys: list[str], order: list[str], fade: str | Column) -> DataFrame:
    """Start, effective duration and trimmed frames of each clip: 10 frames after a fade, else 1, none off the first.

    The running time is kept unrounded, what is shown is rounded to 6 places.
    """
    w = over(keys, order)
    faded = F.coalesce(F.col(fade) if isinstance(fade, str) else fade, F.lit(False))
    rows = clips.withColumn("_fade", faded)
    first = F.row_number().over(w) == 1
    rows = rows.withColumn("trim_frames", F.when(first, 0).when(F.lag("_fade").over(w), 10).otherwise(1))
    rows = rows.withColumn("_eff", F.col("duration_s") - F.col("trim_frames") * FRAME_S)
    start = F.coalesce(F.sum("_eff").over(before(keys, order)), F.lit(0.0))
    return rows.withColumn("start_s", F.bround(start, 6)).withColumn("effective_s", F.bround("_eff", 6)).withColumnRenamed("_fade", "has_fade_after").drop("_eff")


def junction_times(clips: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The time of the junction after each clip but the last."""
    rows = clips.withColumn("time_s", F.sum("duration_s").over(running(keys, order))).withColumn("_next", F.lead(F.lit(1)).over(over(keys, order)))
    return rows.where("_next = 1").drop("_next")


def file_offsets(clips: DataFrame, keys: list[str], order: list[str], has_cues: str, fade_s: float = 0.6) -> DataFrame:
    """The offset of each file's cues: durations before it less the fade, as counted by files that have cues only.

    A file without cues moves no offset; durations are taken by position, the last one without the fade.
    """
    w = over(keys, order)
    rows = clips.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).withColumn("_i", F.row_number().over(w))
    step = F.when(F.col(has_cues), F.col("duration_s") - F.when(F.col("_i") < F.col("_n"), fade_s).otherwise(0.0)).otherwise(0.0)
    return rows.withColumn("_step", step).withColumn("offset_s", F.coalesce(F.sum("_step").over(before(keys, order)), F.lit(0.0))).drop("_n", "_i", "_step")


def drop_consecutive(df: DataFrame, keys: list[str], order: list[str], value: Column, bucket: Column | None = None) -> DataFrame:
    """W10 (equality): a row whose value equals that of the row before goes; null or empty never equals."""
    rows = neighbour(df.withColumn("_v", F.nullif(value, F.lit(""))), keys, order, ["_v"], "_n", False, bucket)
    return rows.where(F.col("_v").isNull() | F.col("_n._v").isNull() | (F.col("_v") != F.col("_n._v"))).drop("_v", "_n")


def leading_run(df: DataFrame, keys: list[str], order: str, dark: Column) -> DataFrame:
    """Keys, n: rows before the first that is not dark (all rows if there is none)."""
    first = df.withColumn("_d", F.coalesce(dark, F.lit(False)))
    cut = F.min(F.when(~F.col("_d"), F.struct(order))).over(Window.partitionBy(*keys))
    return first.withColumn("_c", cut).groupBy(*keys).agg(F.count_if(F.col("_c").isNull() | (F.struct(order) < F.col("_c"))).alias("n"))


def trailing_run(df: DataFrame, keys: list[str], order: str, dark: Column, least: int) -> DataFrame:
    """Keys, last_bright, n: the dark rows after the last bright one, if at least ``least``; an all-dark entity gives none."""
    rows = df.withColumn("_d", F.coalesce(dark, F.lit(False)))
    cut = F.max(F.when(~F.col("_d"), F.col(order))).over(Window.partitionBy(*keys))
    out = rows.withColumn("_c", cut).groupBy(*keys).agg(F.max("_c").alias("last_bright"), F.count_if(F.col(order) > F.col("_c")).alias("n"))
    return out.where(F.col("last_bright").isNotNull() & (F.col("n") >= least))


def stable_run(df: DataFrame, keys: list[str], order: str, bright: Column, least: int) -> DataFrame:
    """Keys, first: where the first run of ``least`` bright rows in a row begins."""
    w = over(keys, [order])
    rows = df.withColumn("_b", F.coalesce(bright, F.lit(False))).withColumn("_n", F.row_number().over(w))
    runs = rows.where("_b").withColumn("_g", F.col("_n") - F.row_number().over(w))
    return runs.groupBy(*keys, "_g").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("k")).where(F.col("k") >= least).groupBy(*keys).agg(F.min("first").alias("first"))


def trim_decision(frames: DataFrame, keys: list[str], fps: float, threshold: float = 50.0, strict: float = 20.0, bright: float = 80.0, voice: str | None = None) -> DataFrame:
    """Keys, start_trim, end_trim (seconds, null for none) from frame_idx, brightness, has_text.

    The dark head is looked for in the first 5 s. Text in it, or a voice (a boolean column, the same for all frames of an entity), keeps it.
    A fade-in behind it ends where 0.2 s are bright, within 1 s; one longer than 0.5 s counts as none. A dark tail of
    at least 0.1 s within the last 5 s goes.
    """
    least, stable, half, second, five = max(1, int(0.1 * fps)), int(fps * 0.2), int(fps * 0.5), int(fps * 1), int(fps * 5)
    key = Window.partitionBy(*keys)
    dark = F.col("brightness") < threshold
    stop = (F.col("frame_idx") >= five) | ~dark | F.col("has_text")
    rows = frames.withColumn("_total", F.max("frame_idx").over(key) + 1).withColumn("_stop", F.coalesce(F.min(F.when(stop, F.col("frame_idx"))).over(key), F.col("_total")))
    idx = F.col("frame_idx")
    in_fade = (idx >= F.col("_stop")) & (idx < F.col("_stop") + second)
    rows = rows.withColumn("_fade", in_fade).withColumn("_hi", in_fade & (F.col("brightness") >= bright))
    w = Window.partitionBy(*keys, "_fade").orderBy("frame_idx")
    rows = rows.withColumn("_lo_before", F.max(F.when(~F.col("_hi"), idx)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = idx - F.coalesce(F.col("_lo_before"), F.col("_stop") - 1)
    rows = rows.withColumn("_done", F.when(F.col("_hi") & (run >= stable), idx - stable + 1))
    tail_dark = dark & ~F.col("has_text")
    rows = rows.withColumn("_last_bright", F.max(F.when(~tail_dark & (idx >= F.col("_total") - five), idx)).over(key))
    g = rows.groupBy(*keys).agg(
        F.max("_total").alias("total"),
        F.max("_stop").alias("black"),
        F.max(F.when((idx == F.col("_stop")) & dark & F.col("has_text") & (idx < five), 1).otherwise(0)).alias("text"),
        F.min("_done").alias("done"),
        F.max(F.when(F.col("_fade") & ~F.col("_hi"), idx + 1)).alias("dim"),
        F.max("_last_bright").alias("last_bright"),
        (F.bool_or(voice) if voice else F.lit(False)).alias("voice"),
    )
    fade_end = F.coalesce("done", F.greatest("dim", "black"), "black")
    fade_end = F.when((F.col("black") > 0) & (fade_end <= F.col("black") + half), fade_end).otherwise(F.col("black"))
    start = F.when((F.col("text") == 1) | (F.col("voice") & (F.col("black") >= least)), None).when(fade_end > F.col("black"), fade_end / F.lit(fps)).when(F.col("black") >= least, F.col("black") / F.lit(fps))
    end = F.when(F.col("total") - 1 - F.col("last_bright") >= least, (F.col("last_bright") + 1) / F.lit(fps))
    return g.select(*keys, start.alias("start_trim"), end.alias("end_trim"))


def split_points(selections: DataFrame, keys: list[str], order: list[str], duration: str, percent: str = "start_percent") -> DataFrame:
    """start_s of each selection: percent of the duration, or equal parts if any percent of the entity is negative (null counts so)."""
    key = Window.partitionBy(*keys)
    pct = F.coalesce(F.col(percent), F.lit(-1.0))
    n, i = F.count(F.lit(1)).over(key), F.row_number().over(over(keys, order)) - 1
    by_pct = F.min(pct).over(key) >= 0
    return selections.withColumn("start_s", F.when(by_pct, F.col(duration) * pct / 100.0).otherwise(F.col(duration) / n * i))


def music_segments(points: DataFrame, keys: list[str], order: list[str], duration: str, physical: str, crossfade: float = 2.0) -> DataFrame:
    """actual_start, length, fade_in_us, fade_out_us of each piece of music between split points.

    A piece reaches half a crossfade over its split points, within the video; all but the last are no longer than
    their file. Pieces without length go.
    """
    w = over(keys, order)
    first, last = F.row_number().over(w) == 1, F.lead(F.lit(1)).over(w).isNull()
    half = crossfade / 2
    start = F.greatest(F.lit(0.0), F.col("start_s") - F.when(first, 0.0).otherwise(half))
    end = F.when(last, F.col(duration)).otherwise(F.least(F.col(duration), F.lead("start_s").over(w) + half))
    rows = points.withColumn("_last", last).withColumn("_first", first).withColumn("actual_start", start).withColumn("length", end - start).where(F.col("length") > 0)
    capped = F.when(~F.col("_last") & (F.col(physical) > 0), F.least(F.col("length"), F.col(physical))).otherwise(F.col("length"))
    rows = rows.withColumn("length", capped).withColumn("fade_in_us", F.when(F.col("_first"), 0).otherwise(int(crossfade * 1_000_000)))
    return rows.withColumn("fade_out_us", F.when(F.col("_last"), 2_000_000).otherwise(int(crossfade * 1_000_000))).drop("_first", "_last")


def micro_timeline(clips: DataFrame, keys: list[str], order: list[str], black_s: float) -> DataFrame:
    """start_us, duration_us, source_us in whole microseconds; a black piece follows each clip with a fade."""
    us = lambda c: F.floor(c * 1_000_000).cast("long")
    rows = clips.withColumn("duration_us", us(F.col("effective_s"))).withColumn("source_us", us(F.col("trim_frames") / F.lit(30)))
    rows = rows.withColumn("_step", F.col("duration_us") + F.when(F.col("has_fade_after"), int(black_s * 1_000_000)).otherwise(0))
    return rows.withColumn("start_us", F.coalesce(F.sum("_step").over(before(keys, order)), F.lit(0).cast("long"))).drop("_step")


def speaker_boundaries(lines: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Where the speaker changes: the last four characters before it and the first four after, Han only."""
    w = over(keys, order)
    rows = lines.withColumn("_p", F.lag(F.struct("speaker", "line")).over(w))
    changed = rows.where(F.col("_p").isNotNull() & ~F.col("_p.speaker").eqNullSafe(F.col("speaker")))
    only = lambda c: F.regexp_replace(c, "[^\\u4e00-\\u9fff]", "")
    return changed.select(
        *keys, *order, F.col("_p.speaker").alias("prev_speaker"), "speaker", only(F.right(F.col("_p.line"), F.lit(4))).alias("tail"), only(F.left(F.col("line"), F.lit(4))).alias("head")
    )


def scene_changes(timeline: DataFrame, keys: list[str], order: list[str], duration: str) -> DataFrame:
    """Clips with a fade before another clip: the time and its rounded share of the whole in percent."""
    nxt = F.lead("start_s").over(over(keys, order))
    rows = timeline.withColumn("change_s", nxt).where("has_fade_after AND change_s IS NOT NULL")
    return rows.withColumn("percent", F.bround(F.col("change_s") / F.col(duration) * 100, 0).cast("int"))


def extend_last(cues: DataFrame, keys: list[str], order: list[str], video_s: str | Column, least: float = 0.5) -> DataFrame:
    """The last cue of an entity, if shorter than ``least``, lasts to the end of the video, at least ``least`` seconds; where the video's length is null it stays."""
    last = F.lead(F.lit(1)).over(over(keys, order)).isNull()
    v = F.col(video_s) if isinstance(video_s, str) else video_s
    return cues.withColumn("end_time", F.when(last & v.isNotNull() & (F.col("end_time") - F.col("start_time") < least), F.greatest(F.col("start_time") + least, v)).otherwise(F.col("end_time")))


def scene_lines(lines: DataFrame, keys: list[str], line_no: str, text: str) -> DataFrame:
    """Keys, scene_ord, scene_id, location, line_count from numbered lines of a screenplay."""
    t = F.trim(F.regexp_replace(text, r"^[\s　]+|[\s　]+$", ""))
    rows = lines.withColumn("_t", t).withColumn("_mark", F.col("_t").rlike(r"^\d+-\d+$"))
    rows = rows.withColumn("_scene", F.sum(F.col("_mark").cast("int")).over(running(keys, [line_no]))).where("_scene > 0")
    place = F.when(F.col("_t").startswith("地点"), F.regexp_extract("_t", r"^地点\s*(\S+)", 1))
    return rows.groupBy(*keys, F.col("_scene").alias("scene_ord")).agg(
        F.min_by("_t", line_no).alias("scene_id"), F.coalesce(F.min_by(F.nullif(place, F.lit("")), F.when(place != "", F.col(line_no))), F.lit("")).alias("location"), F.count(F.lit(1)).alias("line_count")
    )


def expected_scene_times(scenes: DataFrame, keys: list[str], duration: str) -> DataFrame:
    """A2: expected_s of the change after each scene but the last, by its share of the lines."""
    share = F.sum("line_count").over(running(keys, ["scene_ord"])) / F.sum("line_count").over(Window.partitionBy(*keys))
    rows = scenes.withColumn("expected_s", share * F.col(duration)).withColumn("_next", F.lead(F.lit(1)).over(over(keys, ["scene_ord"])))
    return rows.where("_next = 1").drop("_next")


def running_best(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Improved: whether a value is above all before it."""
    best = F.max(value).over(before(keys, order))
    return df.withColumn("improved", F.coalesce(F.col(value) > best, F.col(value).isNotNull()))


def chunks_of(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """Chunk: rows in order, ``n`` a chunk; n <= 0 puts all into one."""
    i = F.row_number().over(over(keys, order)) - 1
    return df.withColumn("chunk", F.floor(i / F.lit(n)).cast("int") if n > 0 else F.lit(0))


def block_bounds(total: Column, world: int) -> Column:
    """The equal contiguous blocks as array of struct(rank, start, end); an error if ``total`` cannot be divided."""
    size = F.when(total % world == 0, F.floor(total / world)).otherwise(F.raise_error(F.lit("the number must be divisible")))
    return F.transform(F.sequence(F.lit(0), F.lit(world - 1)), lambda r: F.struct(r.alias("rank"), (r * size).cast("long").alias("start"), ((r + 1) * size).cast("long").alias("end")))
