"""Queries of functions.records with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.functions import records as R
from reelframe.functions import signal as S
from reelframe.plans.timeline_queries import _cues, _script
from reelframe.session import read


def frame_text(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part")
    return p.select("p_partkey", R.frame_has_text(F.col("p_size") * 4.0, F.col("p_size") / 400.0, F.col("p_partkey") % 5 / 200.0).alias("has_text"))


def replacement_checks(spark: SparkSession, d: str) -> DataFrame:
    script = _script(spark, d).groupBy("episode").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_ord", "line"))), lambda x: x["line"]), "").alias("script"))
    pairs = F.array(*[F.struct(F.lit(a).alias("wrong"), F.lit(b).alias("right")) for a, b in (("掉啦", "掉了"), ("那把断情", "那把断琴"), ("早", "我"), ("一整箱银票子弹壳儿", "一整箱银票"), ("账", "帐"), ("顶楼天台", "顶楼的天台"))])
    rows = script.select("episode", "script", F.explode(pairs).alias("p"))
    return rows.select("episode", "p.wrong", "p.right", R.valid_replacement("p.wrong", "p.right", "script").alias("valid"))


def argument_objects(spark: SparkSession, d: str) -> DataFrame:
    x = F.when(F.col("event_id") % 3 == 0, "  ").otherwise(F.col("props"))
    return read(spark, d, "events").select("event_id", R.json_argument(x).alias("arg"))


def merged_settings(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part")
    m = R.merged_maps(F.create_map(F.lit("a"), F.col("p_brand"), F.lit("b"), F.col("p_type")), F.when(F.col("p_size") > 25, F.create_map(F.lit("b"), F.col("p_name"), F.lit("c"), F.lit("x"))))
    return p.select("p_partkey", m["a"].alias("a"), m["b"].alias("b"), F.try_element_at(m, F.lit("c")).alias("c"))


def token_slices(spark: SparkSession, d: str) -> DataFrame:
    s = R.token_slice("start_time", "end_time", 16_000, F.lit(160_000).cast("long"))
    return _cues(spark, d).select("episode", "cue_ord", "text", "start_time", "end_time", s["lo"].alias("lo"), s["hi"].alias("hi"))


def value_ranges(spark: SparkSession, d: str) -> DataFrame:
    v = read(spark, d, "lineitem").groupBy("l_suppkey").agg(F.array_sort(F.collect_list("l_partkey")).alias("v"))
    return v.select("l_suppkey", F.explode(R.range_buckets("v", 500)).alias("b")).select("l_suppkey", F.col("b.bucket").cast("long").alias("bucket"), F.col("b.lo").alias("lo"), F.col("b.hi").alias("hi"))


def label_masks(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "part").select("p_partkey", F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: (i * F.col("p_size") % 7).cast("int")).alias("ids"), (F.col("p_size") % 4).alias("n"))
    return rows.select("p_partkey", F.array_join(R.masked_labels("ids", "n", 3).cast("array<string>"), ",").alias("labels"))


def decoded_stamps(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "chunk_text").where("items IS NOT NULL").groupBy("orig_index", "chunk_index").agg(F.any_value("items").alias("items"))
    ms = F.flatten(F.transform("items", lambda i: F.array(F.round(i["start_time"] * 1000).cast("long"), F.round(i["end_time"] * 1000).cast("long"))))
    w = R.decoded_times(F.transform("items", lambda i: i["text"]), ms)
    return c.select("orig_index", "chunk_index", F.explode(w).alias("w")).select("orig_index", "chunk_index", "w.*")


def instrumental_tracks(spark: SparkSession, d: str) -> DataFrame:
    return R.instrumental(read(spark, d, "music_tag")).select("track_id", "loaded_at")


def broadcast_language(spark: SparkSession, d: str) -> DataFrame:
    n = read(spark, d, "nation").select(F.col("n_nationkey").alias("k"))
    v = spark.createDataFrame([(0, "Chinese")], "k int, language string")
    return R.broadcast_setting(n, v, "k", "language").select("k", "language")


def stem_scores(spark: SparkSession, d: str) -> DataFrame:
    """SDR by instrument of vectors as stems."""
    e = read(spark, d, "embeddings").select((F.col("vec_id") / 3).cast("long").alias("track"), F.element_at(F.array(F.lit("vocals"), F.lit("drums"), F.lit("bass")), (F.col("vec_id") % 3 + 1).cast("int")).alias("instrument"), S.doubles("embedding").alias("wav"))
    est = e.withColumn("wav", F.transform("wav", lambda v: v * 0.9 + 0.01))
    est = est.unionByName(est.where("instrument = 'drums'").withColumn("instrument", F.lit("other")))
    mix = e.where("instrument = 'drums'").select("track", "wav")
    p = R.scored_stems(est, e, mix, True)
    return p.select("track", "instrument", F.round(S.sdr(F.col("reference"), F.col("estimate")), 4).alias("sdr"))


def repeated_captions(spark: SparkSession, d: str) -> DataFrame:
    c = _cues(spark, d).select("episode", "cue_ord", "text", F.lit("山上的灵泉是他们早就挡住的").alias("hard"))
    return c.select("episode", "cue_ord", "text", R.repeats_hard_subtitle("text", "hard").alias("again"))


def slow_cues(spark: SparkSession, d: str) -> DataFrame:
    return _cues(spark, d).select("episode", "cue_ord", "text", "start_time", "end_time", R.suspicious_pace("text", "start_time", "end_time").alias("slow"))


def side_values(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    return R.nearest_sides(e, ["user_id"], ["ts", "event_id"], "value", F.col("value") > 50).select("event_id", "before", "after")


QUERIES = {f.__name__: f for f in (
    frame_text, replacement_checks, argument_objects, merged_settings, token_slices, value_ranges, label_masks, decoded_stamps, instrumental_tracks, broadcast_language, stem_scores,
    repeated_captions, slow_cues, side_values,
)}

_H = r"'[^\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}]'"
_C = "c AS (SELECT DISTINCT episode, cue_ord, text, start_time, end_time FROM cue WHERE start_time IS NOT NULL AND end_time IS NOT NULL AND text IS NOT NULL)"
# replacement_checks: the distances of the fixed pairs stand in the SQL, since DuckDB counts the bytes of a character one by one.
SQL = {
    "frame_text": "SELECT p_partkey, p_size * 4 > 80 AND (p_size / 400.0 > 0.05 OR p_partkey % 5 / 200.0 > 0.01) AS has_text FROM part",
    "replacement_checks": """WITH sc AS (SELECT episode, line_ord, max({'speaker': speaker, 'line': line, 'raw': raw}) AS v FROM script_line GROUP BY ALL), t AS (SELECT episode, string_agg(v.line, '' ORDER BY line_ord) AS s FROM sc GROUP BY 1),
        p(w, r) AS (VALUES ('掉啦', '掉了'), ('那把断情', '那把断琴'), ('早', '我'), ('一整箱银票子弹壳儿', '一整箱银票'), ('账', '帐'), ('顶楼天台', '顶楼的天台'))
        SELECT episode, w AS wrong, r AS right, (length(w) >= 2 OR (NOT contains(s, w) AND length(r) = 1 AND contains(s, r))) AND length(w) <= 9 AND length(r) <= length(w) + 1 AND contains(s, r)
        AND (length(w) < 2 OR length(r) < 2 OR (CASE WHEN w = '掉啦' THEN 1 WHEN w = '那把断情' THEN 1 WHEN w = '顶楼天台' THEN 1 ELSE 4 END) <= CASE WHEN greatest(length(w), length(r)) <= 6 THEN 1 ELSE greatest(length(w), length(r)) * 0.75 END) AS valid FROM t, p""",
    "argument_objects": "SELECT event_id, CASE WHEN event_id % 3 = 0 OR trim(coalesce(props, '')) = '' THEN '{}' ELSE trim(props) END AS arg FROM events",
    "merged_settings": "SELECT p_partkey, p_brand AS a, CASE WHEN p_size > 25 THEN p_name ELSE p_type END AS b, CASE WHEN p_size > 25 THEN 'x' END AS c FROM part",
    "token_slices": f"WITH {_C}, l AS (SELECT *, greatest(0, least(CAST(floor(start_time * 16000) AS BIGINT), 160000)) AS lo FROM c) SELECT episode, cue_ord, text, start_time, end_time, lo, greatest(lo, least(CAST(floor(end_time * 16000) AS BIGINT), 160000)) AS hi FROM l",
    "value_ranges": "WITH v AS (SELECT l_suppkey, l_partkey // 500 AS bucket, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) - 1 AS i FROM lineitem) SELECT l_suppkey, bucket, min(i) AS lo, max(i) + 1 AS hi FROM v GROUP BY ALL",
    "label_masks": "SELECT p_partkey, array_to_string(list_transform(range(10), lambda i: CASE WHEN i < p_size % 4 OR i * p_size % 7 = 3 THEN -100 ELSE i * p_size % 7 END), ',') AS labels FROM part",
    "decoded_stamps": """WITH c AS (SELECT orig_index, chunk_index, any_value(items) AS items FROM chunk_text WHERE items IS NOT NULL GROUP BY ALL), e AS (SELECT orig_index, chunk_index, unnest(items) AS i FROM c)
        SELECT orig_index, chunk_index, i.text AS text, round(round(i.start_time * 1000) / 1000, 3) AS start_time, round(round(i.end_time * 1000) / 1000, 3) AS end_time FROM e""",
    "instrumental_tracks": "SELECT track_id, loaded_at FROM music_tag WHERE vocal = '纯音乐'",
    "broadcast_language": "SELECT n_nationkey AS k, 'Chinese' AS language FROM nation",
    "stem_scores": """WITH e AS (SELECT vec_id // 3 AS track, ['vocals', 'drums', 'bass'][CAST(vec_id % 3 + 1 AS INTEGER)] AS instrument, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
        est AS (SELECT track, instrument, i, v * 0.9 + 0.01 AS x FROM e UNION ALL SELECT track, 'other', i, v * 0.9 + 0.01 FROM e WHERE instrument = 'drums'),
        t AS (SELECT track, instrument, i, v AS r FROM e UNION ALL SELECT m.track, 'other', m.i, m.v - v.v FROM e m JOIN e v ON m.track = v.track AND m.i = v.i WHERE m.instrument = 'drums' AND v.instrument = 'vocals')
        SELECT track, instrument, round(10 * log10((sum(r * r) + 1e-8) / (sum((r - x) * (r - x)) + 1e-8)), 4) AS sdr FROM est JOIN t USING (track, instrument, i) GROUP BY ALL""",
    "slow_cues": f"WITH {_C} SELECT episode, cue_ord, text, start_time, end_time, length(regexp_replace(text, {_H}, '', 'g')) >= 3 AND (end_time - start_time) / length(regexp_replace(text, {_H}, '', 'g')) > 0.8 AS slow FROM c",
    "side_values": """SELECT event_id, last_value(CASE WHEN value > 50 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
        first_value(CASE WHEN value > 50 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM events""",
}
