"""Readers, writers, sequence passes, spectra and the pipeline over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelframe.functions import signal as S
from reelframe.functions import text as T
from reelframe.operators import sequence as Q
from reelframe.operators import spectra as X
from reelframe.operators import timeline as W
from reelframe.plans import pipeline
from reelframe.plans.timeline_queries import CUE_ORDER, EP, _clips, _cues, _frames, _script, _words
from reelframe.session import read
from reelframe.sources import readers as R
from reelframe.sources import writers as K


def script_parse(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").where("source = 'screenplay' AND text IS NOT NULL").select("doc_id", "text")
    return R.script_lines(docs, ["doc_id"])


def srt_parse(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").where("source = 'subtitle' AND text IS NOT NULL")
    rows = docs.select("doc_id", F.posexplode(R.srt_lenient(F.col("text"))).alias("cue_ord", "c"))
    return rows.select("doc_id", "cue_ord", F.round("c.start", 6).alias("start"), F.round("c.end", 6).alias("end"), "c.text")


def srt_write(spark: SparkSession, d: str) -> DataFrame:
    return K.srt_text(_cues(spark, d).where("start_time >= 0 AND end_time >= 0"), EP, CUE_ORDER)


def result_json(spark: SparkSession, d: str) -> DataFrame:
    rows = _cues(spark, d).groupBy("episode", "cue_ord").agg(F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), F.min("text").alias("text"))
    j = K.result_json(rows, EP, ["cue_ord"], "n")
    back = F.from_json("json", "total long, note string, subtitles array<struct<text:string,start_time:double,end_time:double,duration:double>>")
    j = j.select("episode", back.alias("j")).select("episode", "j.total", "j.note", F.posexplode("j.subtitles").alias("i", "c"))
    return j.select("episode", "total", "note", "i", "c.text", "c.start_time", "c.end_time", "c.duration")


def manifest_json(spark: SparkSession, d: str) -> DataFrame:
    m = K.manifest_json(_clips(spark, d).select("episode", "clip_ord", "file", F.col("duration_s")), EP, "clip_ord")
    back = m.select("episode", F.posexplode(F.from_json("json", R.MANIFEST)).alias("clip_ord", "c"))
    return back.select("episode", "clip_ord", "c.file", "c.duration_s")


def edit_decisions(spark: SparkSession, d: str) -> DataFrame:
    e = K.edit_decisions(W.trim_decision(_frames(spark, d), ["user_id"], 10.0))
    return e.select("user_id", "action", F.round("seek_s", 6).alias("seek_s"), F.round("length_s", 6).alias("length_s"))


def concat_filters(spark: SparkSession, d: str) -> DataFrame:
    t = W.clip_timeline(_clips(spark, d), EP, ["clip_ord"], F.col("clip_ord") % 3 == 1)
    return K.concat_filter(t, EP, "clip_ord")


def lcs_ratios(spark: SparkSession, d: str) -> DataFrame:
    """H5, H6: neighbouring lines of the script."""
    s = _script(spark, d).withColumn("prev", F.lag("line").over(Window.partitionBy("episode").orderBy("line_ord"))).where("prev IS NOT NULL AND line IS NOT NULL")
    return s.select("episode", "line_ord", F.round(T.lcs_ratio("prev", "line"), 6).alias("lcs"), F.round(T.ordered_share("prev", "line"), 6).alias("ordered"))


def leading_repeats(spark: SparkSession, d: str) -> DataFrame:
    x = F.concat(F.left("line", F.lit(2)), "line")
    return _script(spark, d).select("episode", "line_ord", T.collapse_leading_repeat(x).alias("text"))


def char_runs(spark: SparkSession, d: str) -> DataFrame:
    return _script(spark, d).select("episode", "line_ord", T.collapse_char_runs(F.concat(F.repeat(F.left("line", F.lit(1)), F.lit(30)), F.lit("|"), "line")).alias("text"))


def cue_correction(spark: SparkSession, d: str) -> DataFrame:
    """The cues of each episode against its script."""
    cues = _cues(spark, d).groupBy("episode", "cue_ord").agg(F.max(F.struct("start_time", "end_time", "text")).alias("c")).select("episode", "cue_ord", "c.*")
    return Q.correct_cues(cues, _script(spark, d), EP, "cue_ord", "line_ord")


def _segments(spark: SparkSession, d: str) -> DataFrame:
    """The recorded segments of an episode: the items of its recordings, or the lines of the text (H14) where a recording has none."""
    c = read(spark, d, "chunk_text").groupBy("episode", "orig_index", "chunk_index").agg(F.max(F.struct("loaded_at", "text", F.transform("items", lambda x: x["text"]).alias("items"))).alias("c"))
    rows = c.select("episode", "orig_index", "chunk_index", F.posexplode(F.coalesce("c.items", T.segments("c.text"))).alias("i", "text"))
    order = Window.partitionBy("episode").orderBy("orig_index", "chunk_index", "i")
    return rows.select("episode", (F.row_number().over(order) - 1).alias("seg_ord"), "text")


#: Recorded replacements (wrong, right), which stand in for a model's answer.
PAIRS = (("掉了", "那把断琴"), ("早就", "我不后悔"), ("药方", "账本"), ("掉啦", "掉了"), ("那把断情", "那把断琴"), ("早", "我"), ("一整箱银票子弹壳儿", "一整箱银票"), ("账", "帐"), ("顶楼天台", "顶楼的天台"))


def final_cues(spark: SparkSession, d: str) -> DataFrame:
    """The pipeline from words to final cues, with recorded segments and replacements, captions (cues in brackets) and the clips' length as the video's."""
    words = _words(spark, d).groupBy("episode", "word_ord").agg(F.max(F.struct("start_time", "end_time", "text")).alias("w")).select("episode", "word_ord", "w.*")
    cues = _cues(spark, d).groupBy("episode", "cue_ord").agg(F.max(F.struct("start_time", "end_time", "text")).alias("c")).select("episode", "cue_ord", "c.*")
    hard = cues.where("text LIKE '（%'").select("episode", F.col("cue_ord").alias("interval_ord"), F.col("start_time").alias("s"), F.col("end_time").alias("e"))
    video = _clips(spark, d).groupBy("episode").agg(F.sum("duration_s").alias("video_s"))
    script = _script(spark, d)
    pairs = F.array(*[F.struct(F.lit(i).alias("pair_ord"), F.lit(a).alias("wrong"), F.lit(b).alias("right")) for i, (a, b) in enumerate(PAIRS)])
    pairs = script.select("episode").distinct().select("episode", F.explode(pairs).alias("p")).select("episode", "p.*")
    return pipeline.final_cues(words, script, EP, video, hard, segments=_segments(spark, d), pairs=pairs)


def l1_freq_metric(spark: SparkSession, d: str) -> DataFrame:
    v = read(spark, d, "embeddings").select("vec_id", S.doubles("embedding").alias("reference"))
    p = v.join(v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("reference").alias("estimate")), "vec_id")
    return X.spectral_metric(p, ["vec_id"], lambda a, b: X.l1_freq(a, b, 32, 16), "l1_freq")


QUERIES = {f.__name__: f for f in (
    script_parse, srt_parse, srt_write, result_json, manifest_json, edit_decisions, concat_filters, lcs_ratios, leading_repeats, char_runs, cue_correction, final_cues, l1_freq_metric,
)}

_C = "c AS (SELECT DISTINCT episode, cue_ord, text, start_time, end_time FROM cue WHERE start_time IS NOT NULL AND end_time IS NOT NULL AND text IS NOT NULL)"
_CL = "cl AS (SELECT episode, clip_ord, max(file) AS file, coalesce(max(duration_s), 0.0) AS duration_s FROM clip GROUP BY ALL)"
_S = "sc AS (SELECT episode, line_ord, max({'speaker': speaker, 'line': line, 'raw': raw}) AS v FROM script_line GROUP BY ALL), s AS (SELECT episode, line_ord, v.line AS line FROM sc)"
_AT = "printf('%02d:%02d:%02d,%03d', CAST(floor({0} / 3600) AS BIGINT), CAST(floor(({0} % 3600) / 60) AS BIGINT), CAST(floor({0} % 60) AS BIGINT), CAST(floor(({0} % 1) * 1000) AS BIGINT))"
_SEC = "(CAST(split_part({0}, ':', 1) AS DOUBLE) * 3600 + CAST(split_part({0}, ':', 2) AS DOUBLE) * 60 + CAST(replace(split_part({0}, ':', 3), ',', '.') AS DOUBLE))"
_TIMES = r"'^\s*(\d+:\d+:\d+[,.]\d+)\s*-->\s*(\d+:\d+:\d+[,.]\d+)'"
SQL = {
    # By cutting instead of matching: what stands before the first bracket or colon, an action in brackets, a colon, the rest.
    "script_parse": r"""WITH l AS (SELECT doc_id, unnest(string_split_regex(text, '\r\n|\r|\n')) AS t, generate_subscripts(string_split_regex(text, '\r\n|\r|\n'), 1) AS n FROM documents WHERE source = 'screenplay' AND text IS NOT NULL),
        h AS (SELECT *, split_part(split_part(split_part(split_part(t, '（', 1), '(', 1), '：', 1), ':', 1) AS who FROM l),
        r AS (SELECT *, substr(t, length(who) + 1) AS rest FROM h), b AS (SELECT *, CASE WHEN rest[1] = '（' AND contains(rest, '）') THEN substr(rest, instr(rest, '）') + 1) ELSE rest END AS tail FROM r),
        k AS (SELECT doc_id, n, CASE WHEN left(t, 4) = '【旁白】' AND length(t) > 4 THEN '旁白' WHEN tail[1] IN ('：', ':') AND length(who) BETWEEN 1 AND 11 AND NOT (who[1] IN (' ', chr(9), chr(12), '【', '△', '※', '-', '#') OR who[1] BETWEEN '0' AND '9') THEN trim(who) END AS speaker,
          CASE WHEN left(t, 4) = '【旁白】' THEN trim(substr(t, 5)) ELSE trim(substr(tail, 2)) END AS raw FROM b),
        z AS (SELECT *, list_aggregate(list_filter(string_split(raw, ''), lambda c: (unicode(c) BETWEEN 19968 AND 40959) OR (unicode(c) BETWEEN 13312 AND 19903)), 'string_agg', '') AS line FROM k WHERE speaker IS NOT NULL)
        SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS INTEGER) AS line_ord, speaker, line, raw FROM z WHERE line <> '' AND length(speaker) <= 6""",
    "srt_parse": rf"""WITH b AS (SELECT doc_id, string_split_regex(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '^\s+|\s+$', '', 'g'), '\n\s*\n') AS bs FROM documents WHERE source = 'subtitle' AND text IS NOT NULL),
        l AS (SELECT doc_id, unnest(bs) AS b, generate_subscripts(bs, 1) AS i FROM b), p AS (SELECT doc_id, i, string_split(b, chr(10)) AS ls FROM l),
        g AS (SELECT doc_id, i, regexp_extract(ls[2], {_TIMES}, 1) AS s, regexp_extract(ls[2], {_TIMES}, 2) AS e, trim(array_to_string(list_transform(ls[3:], lambda x: trim(x, ' ')), ' '), ' ') AS text FROM p WHERE len(ls) >= 3 AND regexp_matches(ls[2], {_TIMES}))
        SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS cue_ord, round({_SEC.format('s')}, 6) AS start, round({_SEC.format('e')}, 6) AS end, text FROM g WHERE text <> ''""",
    "srt_write": f"""WITH {_C}, n AS (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY cue_ord, start_time, end_time, text) AS i FROM c WHERE start_time >= 0 AND end_time >= 0)
        SELECT episode, string_agg(i || chr(10) || {_AT.format('start_time')} || ' --> ' || {_AT.format('end_time')} || chr(10) || text || chr(10) || chr(10), '' ORDER BY i) AS srt FROM n GROUP BY 1""",
    "result_json": f"""WITH {_C}, r AS (SELECT episode, cue_ord, min(start_time) AS s, max(end_time) AS e, min(text) AS text FROM c GROUP BY ALL)
        SELECT episode, count(*) OVER (PARTITION BY episode) AS total, 'n' AS note, CAST(row_number() OVER (PARTITION BY episode ORDER BY cue_ord) - 1 AS INTEGER) AS i, text, s AS start_time, e AS end_time, round_even(e - s, 3) AS duration FROM r""",
    "manifest_json": f"WITH {_CL} SELECT episode, CAST(row_number() OVER (PARTITION BY episode ORDER BY clip_ord) - 1 AS INTEGER) AS clip_ord, file, duration_s FROM cl",
    "concat_filters": f"""WITH {_CL}, t AS (SELECT *, CASE WHEN row_number() OVER o = 1 THEN 0 WHEN lag(clip_ord % 3 = 1) OVER o THEN 10 ELSE 1 END AS trim FROM cl WINDOW o AS (PARTITION BY episode ORDER BY clip_ord)),
        p AS (SELECT episode, clip_ord AS i, printf('[%d:v]trim=start=%.6f,setpts=PTS-STARTPTS,scale=1920:1080,fps=30', clip_ord, trim / 30.0::DOUBLE)
          || CASE WHEN clip_ord % 3 = 1 THEN printf(',fade=t=out:st=%.3f:d=0.5', round_even(duration_s - trim * (1 / 30.0::DOUBLE), 6) - 0.5) ELSE '' END
          || printf('[v%d];[%d:a]atrim=start=%.6f,asetpts=PTS-STARTPTS[a%d];', clip_ord, clip_ord, trim / 30.0::DOUBLE, clip_ord) AS f FROM t)
        SELECT episode, string_agg(f, '' ORDER BY i) || string_agg(printf('[v%d][a%d]', i, i), '' ORDER BY i) || 'concat=n=' || count(*) || ':v=1:a=1[v][a]' AS filter FROM p GROUP BY 1""",
    "leading_repeats": f"WITH {_S} SELECT episode, line_ord, CASE WHEN line IS NULL THEN NULL WHEN length(left(line, 2) || line) < 5 THEN left(line, 2) || line WHEN line[1] = line[2] THEN left(line, 2)[2:] || line ELSE line END AS text FROM s",
    "char_runs": f"WITH {_S} SELECT episode, line_ord, CASE WHEN line = '' THEN '|' ELSE left(line, 1) || '|' || line END AS text FROM s",
}
