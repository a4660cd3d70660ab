"""Window, join and aggregate operators over the driver's tables, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.functions import signal as S
from reelframe.operators import aggregates as A
from reelframe.operators import joins as J
from reelframe.operators import sequence as Q
from reelframe.operators import timeline as W
from reelframe.session import cut, read

EP = ["episode"]


def _words(spark: SparkSession, d: str, by: str | None = None) -> DataFrame:
    """Words once each, with times, by a total order; exchanged by ``by`` once, where what follows groups by it too."""
    w = read(spark, d, "word").where("start_time IS NOT NULL AND end_time IS NOT NULL AND text IS NOT NULL").select("episode", "word_ord", "text", "start_time", "end_time")
    return (w.repartition(by) if by else w).distinct()


def _cues(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "cue").where("start_time IS NOT NULL AND end_time IS NOT NULL AND text IS NOT NULL").select("episode", "cue_ord", "text", "start_time", "end_time").distinct()


def _clips(spark: SparkSession, d: str) -> DataFrame:
    """One row a clip; a failed probe counts as no duration."""
    return read(spark, d, "clip").groupBy("episode", "clip_ord").agg(F.max("file").alias("file"), F.coalesce(F.max("duration_s"), F.lit(0.0)).alias("duration_s"))


#: Rows of an episode that one task of a window looks at, about.
ROWS_A_BUCKET = 4096


def _bucket(ordinal: str):  # noqa: ANN202
    return F.floor(F.col(ordinal) / ROWS_A_BUCKET)


WORD_ORDER, CUE_ORDER = ["word_ord", "start_time", "end_time", "text"], ["cue_ord", "start_time", "end_time", "text"]


def pause_annotation(spark: SparkSession, d: str) -> DataFrame:
    return W.pause_annotation(_words(spark, d), EP, WORD_ORDER, bucket=_bucket("word_ord"))


def gap_sessions(spark: SparkSession, d: str) -> DataFrame:
    s = W.gap_sessions(_words(spark, d), EP, WORD_ORDER, "start_time", "end_time", 0.5, _bucket("word_ord"))
    return s.groupBy("episode", "session").agg(F.count(F.lit(1)).alias("n"), F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"))


def user_sessions(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select("user_id", "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("t"))
    s = W.gap_sessions(e, ["user_id"], ["t", "event_id"], "t", "t", 3600.0)
    return s.groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first"), F.max("t").alias("last"))


def size_gap_sessions(spark: SparkSession, d: str) -> DataFrame:
    return Q.words_to_cues(_words(spark, d), EP, WORD_ORDER, bucket=_bucket("word_ord")).select("episode", "text", F.round("start_time", 6).alias("start_time"), F.round("end_time", 6).alias("end_time"))


def overlap_truncate(spark: SparkSession, d: str) -> DataFrame:
    return W.truncate_overlaps(_cues(spark, d), EP, CUE_ORDER, 0.3, _bucket("cue_ord")).withColumn("end_time", F.round("end_time", 6))


def overlap_resolve(spark: SparkSession, d: str) -> DataFrame:
    return W.resolve_overlaps(_cues(spark, d), EP, CUE_ORDER, _bucket("cue_ord")).withColumn("end_time", F.round("end_time", 6))


def clip_timeline(spark: SparkSession, d: str) -> DataFrame:
    t = W.clip_timeline(_clips(spark, d), EP, ["clip_ord"], F.col("clip_ord") % 3 == 1)
    return t.select("episode", "clip_ord", "trim_frames", "has_fade_after", F.round("start_s", 4).alias("start_s"), F.round("effective_s", 4).alias("effective_s"))


def micro_timeline(spark: SparkSession, d: str) -> DataFrame:
    t = W.clip_timeline(_clips(spark, d).withColumn("duration_s", F.round("duration_s", 3)), EP, ["clip_ord"], F.col("clip_ord") % 3 == 1)
    t = t.withColumn("effective_s", F.round(F.floor(F.col("effective_s") * 1000) / 1000, 3) + 0.0001)
    return W.micro_timeline(t, EP, ["clip_ord"], 0.5).select("episode", "clip_ord", "start_us", "duration_us", "source_us")


def junction_times(spark: SparkSession, d: str) -> DataFrame:
    return W.junction_times(_clips(spark, d), EP, ["clip_ord"]).select("episode", "clip_ord", F.round("time_s", 4).alias("time_s"))


def file_offsets(spark: SparkSession, d: str) -> DataFrame:
    rows = _clips(spark, d).withColumn("has", F.col("clip_ord") % 4 != 2)
    return W.file_offsets(rows, EP, ["clip_ord"], "has").select("episode", "clip_ord", F.round("offset_s", 4).alias("offset_s"))


def _frames(spark: SparkSession, d: str) -> DataFrame:
    """Events as frames of 30 a second: the rows of a user in order, their value as brightness; some carry text."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = read(spark, d, "events").where("value IS NOT NULL")
    return e.select("user_id", (F.row_number().over(w) - 1).alias("frame_idx"), F.col("value").alias("brightness"), (F.col("event_type") == "error").alias("has_text"))


def leading_run(spark: SparkSession, d: str) -> DataFrame:
    return W.leading_run(_frames(spark, d), ["user_id"], "frame_idx", F.col("brightness") < 100)


def trailing_run(spark: SparkSession, d: str) -> DataFrame:
    return W.trailing_run(_frames(spark, d), ["user_id"], "frame_idx", F.col("brightness") < 100, 1)


def stable_run_start(spark: SparkSession, d: str) -> DataFrame:
    return W.stable_run(_frames(spark, d), ["user_id"], "frame_idx", F.col("brightness") >= 20, 3)


def trim_decisions(spark: SparkSession, d: str) -> DataFrame:
    t = W.trim_decision(_frames(spark, d), ["user_id"], 10.0)
    return t.select("user_id", F.round("start_trim", 6).alias("start_trim"), F.round("end_trim", 6).alias("end_trim"))


def consecutive_dedup(spark: SparkSession, d: str) -> DataFrame:
    return W.drop_consecutive(read(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type")).select("user_id", "event_id", "event_type")


def split_points(spark: SparkSession, d: str) -> DataFrame:
    rows = _clips(spark, d).withColumn("pct", F.when(F.col("clip_ord") % 7 == 6, -1.0).otherwise(F.col("clip_ord") * 5.0)).withColumn("total", F.lit(100.0))
    return W.split_points(rows, EP, ["clip_ord"], "total", "pct").select("episode", "clip_ord", F.round("start_s", 6).alias("start_s"))


def music_segments(spark: SparkSession, d: str) -> DataFrame:
    rows = _clips(spark, d).withColumn("start_s", F.col("clip_ord") * 6.0).withColumn("total", F.lit(90.0))
    s = W.music_segments(rows, EP, ["clip_ord"], "total", "duration_s")
    return s.select("episode", "clip_ord", F.round("actual_start", 6).alias("actual_start"), F.round("length", 6).alias("length"), "fade_in_us", "fade_out_us")


def _script(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "script_line").groupBy("episode", "line_ord").agg(F.max(F.struct("speaker", "line", "raw")).alias("v")).select("episode", "line_ord", "v.*")


def speaker_boundaries(spark: SparkSession, d: str) -> DataFrame:
    return W.speaker_boundaries(_script(spark, d), EP, ["line_ord"])


def scene_changes(spark: SparkSession, d: str) -> DataFrame:
    t = W.clip_timeline(_clips(spark, d), EP, ["clip_ord"], F.col("clip_ord") % 3 == 1).withColumn("total", F.lit(100.0))
    return W.scene_changes(t, EP, ["clip_ord"], "total").select("episode", "clip_ord", F.round("change_s", 4).alias("change_s"))


def last_row_extend(spark: SparkSession, d: str) -> DataFrame:
    c = _cues(spark, d).withColumn("end_time", F.least("end_time", F.col("start_time") + 0.4))
    return W.extend_last(c, EP, CUE_ORDER, F.lit(120.0)).withColumn("end_time", F.round("end_time", 6))


def _numbered_lines(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "documents").where("source = 'screenplay' AND text IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\r\n|\r|\n")).alias("line_no", "text"))
    return s


def scene_lines(spark: SparkSession, d: str) -> DataFrame:
    return W.scene_lines(_numbered_lines(spark, d), ["doc_id"], "line_no", "text")


def expected_scene_times(spark: SparkSession, d: str) -> DataFrame:
    s = scene_lines(spark, d).withColumn("total", F.lit(90.0))
    return W.expected_scene_times(s, ["doc_id"], "total").select("doc_id", "scene_ord", F.round("expected_s", 6).alias("expected_s"))


def running_best(spark: SparkSession, d: str) -> DataFrame:
    return W.running_best(read(spark, d, "events"), ["user_id"], ["ts", "event_id"], "value").select("event_id", "improved")


def list_chunks(spark: SparkSession, d: str) -> DataFrame:
    return W.chunks_of(read(spark, d, "events"), ["user_id"], ["event_id"], 3).select("event_id", "chunk")


def order_regression(spark: SparkSession, d: str) -> DataFrame:
    """W12 in its window form: short lines whose number lies more than 5 ahead of both neighbours."""
    from pyspark.sql import Window

    rows = read(spark, d, "events").select("user_id", "event_id", "ts", F.when(F.col("value") > 1, F.floor("value").cast("long")).alias("li"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    p = F.last("li", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    n = F.first("li", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return rows.withColumn("p", p).withColumn("n", n).where((F.col("li") > F.col("n") + 5) & (F.col("p").isNull() | (F.col("li") > F.col("p") + 5))).select("event_id", "li")


# --- joins -----------------------------------------------------------------------------------------------------------------


def interval_anti(spark: SparkSession, d: str) -> DataFrame:
    at = (F.col("start_time") + F.col("end_time")) / 2
    return J.not_covered(_words(spark, d), _cues(spark, d), EP, at, F.col("start_time"), F.col("end_time") + 0.5)


def salvaged_groups(spark: SparkSession, d: str) -> DataFrame:
    """Words that no cue covers, grouped, with a cue no further than 8 s away."""
    groups = cut(W.uncovered_groups(interval_anti(spark, d), EP, WORD_ORDER, bucket=_bucket("word_ord")))  # both of its ends are looked up
    return J.near_groups(groups, _cues(spark, d), EP).withColumn("nearest_gap", F.round("nearest_gap", 6))


def words_in_cues(spark: SparkSession, d: str) -> DataFrame:
    got = J.words_in_cues(_words(spark, d), _cues(spark, d), EP)
    return got.groupBy("episode", F.col("interval.cue_ord").alias("cue_ord")).agg(F.count(F.lit(1)).alias("n"))


def max_gap_split(spark: SparkSession, d: str) -> DataFrame:
    cues = _cues(spark, d).groupBy("episode", "cue_ord").agg(F.max(F.struct("start_time", "end_time", "text")).alias("c")).select("episode", "cue_ord", "c.*")
    words = _words(spark, d).groupBy("episode", "word_ord").agg(F.max(F.struct("start_time", "end_time", "text")).alias("w")).select("episode", "word_ord", "w.*")
    return J.split_long_cues(cues, words, EP, "cue_ord", 2.5, 0.2)


def hard_subtitles(spark: SparkSession, d: str) -> DataFrame:
    """On-screen captions (cues in brackets) hide the cues that start within them."""
    c = _cues(spark, d).groupBy("episode", "cue_ord").agg(F.max(F.struct("start_time", "end_time", "text")).alias("c")).select("episode", "cue_ord", "c.*")
    hard = c.where("text LIKE '（%'").select("episode", F.col("cue_ord").alias("interval_ord"), F.col("start_time").alias("s"), F.col("end_time").alias("e"))
    return J.hard_subtitles(c.where("text NOT LIKE '（%'"), hard, _script(spark, d), EP, ["episode", "cue_ord"]).select("episode", "cue_ord")


def nearest_event(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select("user_id", "event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    a = e.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("signup"), F.col("t").alias("signup_us"))
    b = e.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase"), F.col("t").alias("purchase_us"))
    return J.nearest(a, b, ["user_id"], "signup", "signup_us", "purchase", "purchase_us", 86_400e6)


def fuzzy_best_line(spark: SparkSession, d: str) -> DataFrame:
    cues = _cues(spark, d).groupBy("episode", "cue_ord").agg(F.max("text").alias("text"))
    m = J.best_lines(cues, _script(spark, d), EP, "cue_ord", "line_ord")
    return m.select("episode", "cue_ord", "match_li", F.round("match_score", 6).alias("match_score"))


def claimed_lines(spark: SparkSession, d: str) -> DataFrame:
    return J.claimed_elsewhere(fuzzy_best_line(spark, d), EP).select("episode", "cue_ord", "claimed")


def junction_assignment(spark: SparkSession, d: str) -> DataFrame:
    clips = _clips(spark, d)
    total = clips.groupBy("episode").agg(F.sum("duration_s").alias("total"))
    scenes = _script(spark, d).withColumn("scene_ord", F.floor(F.col("line_ord") / 8)).groupBy("episode", "scene_ord").agg(F.count(F.lit(1)).alias("line_count"))
    scenes = W.expected_scene_times(scenes.join(total, "episode"), EP, "total").select("episode", "scene_ord", "expected_s", "total")
    j = W.junction_times(clips, EP, ["clip_ord"]).select("episode", F.col("clip_ord").alias("junction"), "time_s", (F.col("clip_ord") * 37 % 200).cast("double").alias("dist"))
    return J.assign_junctions(scenes, j, EP, "total")


def incremental_scan(spark: SparkSession, d: str) -> DataFrame:
    c, o = read(spark, d, "customer"), read(spark, d, "orders")
    known = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("length"))
    old, new = J.known_and_new(c.select("c_custkey"), known, ["c_custkey"], "length")
    return old.select("c_custkey", "length", F.lit(True).alias("known")).unionByName(new.select("c_custkey", F.lit(None).cast("double").alias("length"), F.lit(False).alias("known")))


def priority_lookup(spark: SparkSession, d: str) -> DataFrame:
    s, c = read(spark, d, "supplier"), read(spark, d, "customer")
    a = s.select(F.col("s_nationkey").alias("k"), F.col("s_name").alias("v")).where("k % 3 <> 0")
    b = c.select(F.col("c_nationkey").alias("k"), F.col("c_name").alias("v"))
    return J.coalesced_lookup(read(spark, d, "nation").select(F.col("n_nationkey").alias("k")), [a, b], ["k"], "v")


def first_by_extension(spark: SparkSession, d: str) -> DataFrame:
    ext = F.regexp_extract("file", r"\.(\w+)$", 1)
    rank = F.coalesce(F.array_position(F.array(F.lit("flac"), F.lit("mp3"), F.lit("wav"), F.lit("m4a")), ext), F.lit(9))
    rows = read(spark, d, "music_tag").select("folder", "file", rank.alias("rank")).where("rank BETWEEN 1 AND 4 AND folder IS NOT NULL")
    return J.first_by_priority(rows, ["folder"], ["rank"], "file")


def char_overlap_match(spark: SparkSession, d: str) -> DataFrame:
    return J.title_matches(read(spark, d, "customer").select(F.lower("c_mktsegment").alias("title")), read(spark, d, "part").select(F.lower("p_type").alias("name")), "title", "name")


def project_directories(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").select(F.substring("p_type", 1, 4).alias("project"))
    return J.project_directories(p, read(spark, d, "part").select(F.concat("p_type", F.lit("_x")).alias("name")), "project", "name")


def positional_zip(spark: SparkSession, d: str) -> DataFrame:
    a = _clips(spark, d).select("episode", F.col("clip_ord").alias("a"))
    b = _script(spark, d).select("episode", F.col("line_ord").alias("b"))
    return J.positional_zip(a, b, EP, ["a"], ["b"])


def position_gate(spark: SparkSession, d: str) -> DataFrame:
    cues = _cues(spark, d).groupBy("episode", "cue_ord").agg(F.max("text").alias("text"))
    top = cues.groupBy("episode").agg(F.count(F.lit(1)).alias("n"))
    cues = cues.join(top, "episode").select("episode", F.col("cue_ord").alias("cue_id"), F.least(F.lit(1.0), F.col("cue_ord") / F.col("n")).alias("cue_pct"), "text")
    lines = _script(spark, d)
    lines = lines.join(lines.groupBy("episode").agg(F.count(F.lit(1)).alias("n")), "episode").select("episode", F.least(F.lit(1.0), F.col("line_ord") / F.col("n")).alias("line_pct"), "line")
    pairs = cues.select("episode").distinct().select("episode", F.explode(F.array(*[F.struct(F.lit(a).alias("wrong"), F.lit(b).alias("right")) for a, b in (("掉了", "那把断琴"), ("早就", "我不后悔"), ("药方", "账本"))])).alias("p")).select("episode", "p.*")
    return J.position_gate(cues, lines, pairs, EP).select("episode", "cue_id", "wrong", "right")


def colour_distance(spark: SparkSession, d: str) -> DataFrame:
    """The colour distance of neighbouring parts, 0 where a colour is missing."""
    from pyspark.sql import Window

    c = read(spark, d, "part").select("p_partkey", "p_brand", F.when(F.col("p_size") != 7, F.struct((F.col("p_partkey") * 37 % 256).alias("r"), (F.col("p_size") * 5 % 256).alias("g"), (F.floor("p_retailprice") % 256).alias("b"))).alias("c"))
    n = F.lead("c").over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    return c.withColumn("n", n).select("p_partkey", F.round(S.rgb_distance(F.col("c"), F.col("n")), 6).alias("dist"))


# --- aggregates ------------------------------------------------------------------------------------------------------------


def mean_colours(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "part").select("p_brand", (F.col("p_partkey") * 37 % 256).alias("r"), (F.col("p_size") * 5 % 256).alias("g"), (F.floor("p_retailprice") % 256).alias("b"))
    return A.mean_colour(c, ["p_brand"]).select("p_brand", "rgb.*")


def cue_statistics(spark: SparkSession, d: str) -> DataFrame:
    return A.cue_stats(_cues(spark, d), EP).withColumn("avg_chars", F.round("avg_chars", 6))


def outcome_counts(spark: SparkSession, d: str) -> DataFrame:
    return A.outcomes(read(spark, d, "clip"), EP, F.col("duration_s") > 0)


def _metric_rows(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem")
    return li.select(F.col("l_returnflag").alias("metric"), F.col("l_linestatus").alias("instrument"), F.col("l_orderkey").cast("string").alias("path"), F.col("l_extendedprice").alias("value"))


def metric_summary(spark: SparkSession, d: str) -> DataFrame:
    s = A.metric_summary(_metric_rows(spark, d), spark.createDataFrame([("O",), ("F",)], "instrument string"))
    return s.select("metric", "instrument", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


def metric_macro_average(spark: SparkSession, d: str) -> DataFrame:
    s = A.metric_summary(_metric_rows(spark, d), spark.createDataFrame([("O",), ("F",)], "instrument string"))
    return A.macro_average(s).select("metric", F.round("macro", 4).alias("macro"))


def latest_metric(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem").select(F.lit("m").alias("metric"), F.col("l_returnflag").alias("instrument"), F.col("l_orderkey").alias("path"), F.col("l_extendedprice").alias("value"), "l_linenumber")
    return A.latest_metric(li, "l_linenumber")


def transcript_texts(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "chunk_text").groupBy("orig_index", "chunk_index").agg(F.max("text").alias("text"))
    return A.ordered_concat(c, ["orig_index"], ["chunk_index"], "text")


def transcript_items(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "chunk_text").groupBy("orig_index", "chunk_index").agg(F.max("items").alias("items"), F.max("offset_sec").alias("offset_sec"))
    got = A.merged_items(c, ["orig_index"], ["chunk_index"])
    got = got.select("orig_index", F.posexplode("items").alias("i", "x"))
    return got.select("orig_index", "i", "x.text", "x.start_time", "x.end_time")


def min_stem_length(spark: SparkSession, d: str) -> DataFrame:
    return A.track_lengths(read(spark, d, "lineitem"), ["l_orderkey"], "l_quantity")


def _samples(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "embeddings").select("label", "vec_id", F.posexplode("embedding").alias("pos", "v"))
    return e.select("label", "vec_id", "pos", F.col("v").cast("double").alias("v"), (F.col("vec_id") % 3 + 1).cast("double").alias("w"))


def _ensemble(how: str):  # noqa: ANN202
    def run(spark: SparkSession, d: str) -> DataFrame:
        return A.ensemble(_samples(spark, d), ["label"], "pos", "v", "w", "vec_id", how).withColumn("v", F.round("v", 6))

    run.__name__ = f"ensemble_{how}"
    return run


def trimmed_mean(spark: SparkSession, d: str) -> DataFrame:
    return A.quantile_masked_mean(read(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", 0.9).withColumn("masked_mean", F.round("masked_mean", 4))


def overlap_add(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "embeddings").select("label", (F.col("vec_id") % 8 * 16).alias("start"), S.doubles("embedding").alias("x"))
    return A.overlap_add(c, ["label"], "start", "x", S.fade_window(64, 6)).withColumn("value", F.round("value", 6))


def upsert_by_key(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderkey").alias("ord"))
    new = o.where("o_orderkey % 10 = 0").select("o_orderkey", (-F.col("o_totalprice")).alias("o_totalprice"), "ord")
    return A.upsert(o.where("o_orderkey % 20 <> 0"), new, ["o_orderkey"], "ord").select("o_orderkey", "o_totalprice")


def preflight(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderpriority")
    p = lambda x: o.where(F.col("o_orderpriority").startswith(x))
    return A.preflight(read(spark, d, "customer").select(F.col("c_custkey").alias("k")), {"music": p("1"), "cover": p("2"), "script": p("3")}, "k")


def distinct_neighbours(spark: SparkSession, d: str) -> DataFrame:
    faded = W.clip_timeline(_clips(spark, d), EP, ["clip_ord"], F.col("clip_ord") % 3 == 1).where("has_fade_after")
    return A.neighbour_indices(faded, EP, "clip_ord")


def retention_verdict(spark: SparkSession, d: str) -> DataFrame:
    return A.retention(_words(spark, d), _cues(spark, d), EP).withColumn("ratio", F.round("ratio", 6))


def union_sorted(spark: SparkSession, d: str) -> DataFrame:
    """Two streams of cues put together, by start."""
    from pyspark.sql import Window

    c = _cues(spark, d)
    both = c.where("cue_ord % 2 = 0").unionByName(c.where("cue_ord % 2 = 1"))
    return both.select("episode", "cue_ord", "text", F.row_number().over(Window.partitionBy("episode").orderBy("start_time", *CUE_ORDER)).alias("rank"))


def topk_per_group(spark: SparkSession, d: str) -> DataFrame:
    """the three largest lines of each supplier; ties by the whole row."""
    from pyspark.sql import Window

    w = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey")
    return read(spark, d, "lineitem").withColumn("rn", F.row_number().over(w)).where("rn <= 3").select("l_suppkey", "l_orderkey", "l_extendedprice", "rn")


def argmax_first(spark: SparkSession, d: str) -> DataFrame:
    """the first order of the greatest priority of each customer."""
    o = read(spark, d, "orders").groupBy("o_custkey")
    return o.agg(F.max_by("o_orderkey", F.struct("o_orderpriority", -F.col("o_orderkey"))).alias("best"), F.min_by("o_orderkey", F.struct("o_orderpriority", "o_orderkey")).alias("least"))


def contiguous_blocks(spark: SparkSession, d: str) -> DataFrame:
    n = read(spark, d, "nation").agg(F.count(F.lit(1)).alias("n"))
    b = n.select(F.explode(W.block_bounds(F.col("n"), 5)).alias("b"))
    return b.select("b.*")


QUERIES = {f.__name__: f for f in (
    pause_annotation, gap_sessions, user_sessions, size_gap_sessions, overlap_truncate, overlap_resolve, clip_timeline, micro_timeline, junction_times, file_offsets, leading_run, trailing_run,
    stable_run_start, trim_decisions, consecutive_dedup, split_points, music_segments, speaker_boundaries, scene_changes, last_row_extend, scene_lines, expected_scene_times, running_best,
    list_chunks, order_regression, interval_anti, salvaged_groups, words_in_cues, max_gap_split, hard_subtitles, nearest_event, fuzzy_best_line, claimed_lines, junction_assignment,
    incremental_scan, priority_lookup, first_by_extension, char_overlap_match, project_directories, positional_zip, position_gate, colour_distance, mean_colours, cue_statistics, outcome_counts,
    metric_summary, metric_macro_average, latest_metric, transcript_texts, transcript_items, min_stem_length, _ensemble("avg"), _ensemble("median"), _ensemble("min"), _ensemble("max"),
    trimmed_mean, overlap_add, upsert_by_key, preflight, distinct_neighbours, retention_verdict, union_sorted, topk_per_group, argmax_first, contiguous_blocks,
)}
