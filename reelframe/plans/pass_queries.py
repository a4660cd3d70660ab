"""Sequence passes, spectra and small operators over the driver's tables, each with the SQL that checks it where there is one."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelframe.functions import records as C
from reelframe.functions import signal as S
from reelframe.functions import text as T
from reelframe.operators import aggregates as A
from reelframe.operators import sequence as Q
from reelframe.operators import spectra as X
from reelframe.plans import pipeline
from reelframe.plans.io_queries import _segments
from reelframe.plans.timeline_queries import EP, _cues, _script, _words
from reelframe.session import read


def _one_cues(spark: SparkSession, d: str) -> DataFrame:
    return _cues(spark, d).groupBy("episode", "cue_ord").agg(F.max(F.struct("start_time", "end_time", "text")).alias("c")).select("episode", "cue_ord", "c.*")


def _one_words(spark: SparkSession, d: str) -> DataFrame:
    words = read(spark, d, "word").where("start_time IS NOT NULL AND end_time IS NOT NULL AND text IS NOT NULL")
    return words.groupBy("episode", "word_ord").agg(F.max(F.struct("start_time", "end_time", "text")).alias("w")).select("episode", "word_ord", "w.*")


# --- passes over segments and cues -----------------------------------------------------------------------------------------


def merged_segment_split(spark: SparkSession, d: str) -> DataFrame:
    """Neighbouring lines of the script put together, two by two, and cut again."""
    s = _script(spark, d).withColumn("i", F.row_number().over(Window.partitionBy("episode").orderBy("line_ord")) - 1)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", F.coalesce("line", F.lit("")).alias("l")))), lambda x: x["l"]), "")
    seg = s.groupBy("episode", F.floor(F.col("i") / 2).alias("seg_ord")).agg(text.alias("text"))
    return Q.split_script(seg, _script(spark, d), EP, "seg_ord", "line_ord")


def single_char_fix(spark: SparkSession, d: str) -> DataFrame:
    """Recorded segments of one character from what the script has before the next one."""
    return Q.segment_pass(_segments(spark, d), _script(spark, d), EP, "seg_ord", "line_ord", Q.fix_single_chars)


def overlap_trim(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the script of which every second one begins with the last two characters of the line before."""
    p = F.lag("line").over(Window.partitionBy("episode").orderBy("line_ord"))
    seg = _script(spark, d).withColumn("p", p).select("episode", "line_ord", F.when(F.col("line_ord") % 2 == 0, F.concat(F.right(F.coalesce("p", F.lit("")), F.lit(2)), F.col("line"))).otherwise(F.col("line")).alias("text"))
    return Q.segment_pass(seg, seg.where("false").withColumn("line", F.col("text")), EP, "line_ord", "line_ord", lambda segs, _: Q.trim_overlap(segs))


def segment_alignment(spark: SparkSession, d: str) -> DataFrame:
    """The recorded segments with the times of the words."""
    return Q.align_cues(_segments(spark, d), _one_words(spark, d), _script(spark, d), EP, "seg_ord", "word_ord", "line_ord")


def salvage_loop(spark: SparkSession, d: str) -> DataFrame:
    """The cues with the words that none of them covers, in up to four rounds."""
    return pipeline.salvage(_cues(spark, d).select("episode", "text", "start_time", "end_time"), _words(spark, d), EP)


def short_cue_merge(spark: SparkSession, d: str) -> DataFrame:
    """Here cues of up to four characters that last less than 1.2 s."""
    return Q.cue_pass(_one_cues(spark, d), EP, ["cue_ord"], lambda cs: Q.merge_short(cs, 4, 1.2)).select("episode", "ord", "text", F.round("start_time", 6).alias("start_time"), F.round("end_time", 6).alias("end_time"))


def repaired_stamps(spark: SparkSession, d: str) -> DataFrame:
    """Times that rise by 100 but for one, which is far too late; next to the end, it is the last time that does not fit."""
    ts = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.when(i == F.col("p_partkey") % 10, F.lit(5000)).otherwise(i * 100).cast("long"))
    return read(spark, d, "part").select("p_partkey", F.posexplode(Q.repaired_times(ts)).alias("pos", "ms"))


def pattern_runs(spark: SparkSession, d: str) -> DataFrame:
    """The first two characters of a line said 25 times before it."""
    s = _script(spark, d).where("length(line) >= 2")
    return s.select("episode", "line_ord", Q.collapsed_patterns(F.concat(F.lit("<"), F.repeat(F.left("line", F.lit(2)), F.lit(25)), F.lit(">"), "line")).alias("text"))


def quiet_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Vectors as waves of ten samples a second, cut near every two seconds."""
    v = read(spark, d, "embeddings").select("vec_id", S.doubles("embedding").alias("wav"))
    return Q.quiet_chunks(v, ["vec_id"], "wav", 10, 2.0, 0.5, 400.0)


# --- spectra ---------------------------------------------------------------------------------------------------------------


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    v = read(spark, d, "embeddings").select("vec_id", S.doubles("embedding").alias("reference"))
    return v.join(v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("reference").alias("estimate")), "vec_id")


def _points(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(key, F.posexplode("wav").alias("pos", "v")).select(key, "pos", (F.round("v", 5) + 0.0).alias("v"))


def spectral_ensemble(spark: SparkSession, d: str) -> DataFrame:
    """The weighted mean of three waves in the spectral domain, which is that in time."""
    v = read(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 3).alias("track"), "vec_id", S.doubles("embedding").alias("wav"), (F.col("vec_id") % 3 + 1).cast("double").alias("w"))
    return _points(X.ensemble_spectra(v, ["track"], "wav", "w", "vec_id", "avg", 32, 8), "track")


def spectral_rmse(spark: SparkSession, d: str) -> DataFrame:
    """Of neighbouring vectors."""
    return X.spectral_metric(_pairs(spark, d), ["vec_id"], lambda a, b: X.spec_rmse(a, b, 32, 16), "rmse").withColumn("rmse", F.round("rmse", 6))


def bleed_fullness(spark: SparkSession, d: str) -> DataFrame:
    """An estimate twice as loud as the reference."""
    v = read(spark, d, "embeddings").select("vec_id", S.doubles("embedding").alias("reference"))
    got = X.spectral_metric(v.withColumn("estimate", F.transform("reference", lambda x: x * 2)), ["vec_id"], lambda a, b: X.bleed_full(a, b, 44_100, 32, 16, 8), ["bleedless", "fullness"])
    return got.select("vec_id", F.round("bleedless", 6).alias("bleedless"), F.round("fullness", 6).alias("fullness"))


def demixed(spark: SparkSession, d: str) -> DataFrame:
    """A model that halves, in overlapping chunks."""
    v = read(spark, d, "embeddings").select("vec_id", S.doubles("embedding").alias("wav"))
    return _points(X.mapped_waves(v, ["vec_id"], "wav", lambda x: X.demix(x, lambda c: 0.5 * c, 16, 4)), "vec_id")


def tta_mean(spark: SparkSession, d: str) -> DataFrame:
    """Two channels through a model that trebles and adds to the first one; of the three passes two add, in turn, and one takes away."""
    v = read(spark, d, "embeddings").select("vec_id", S.doubles("embedding").alias("wav"))
    model = lambda a: 3 * a + np.array([[0.3], [0.0]])
    return _points(X.mapped_waves(v, ["vec_id"], "wav", lambda x: X.tta(x.reshape(2, -1), model)), "vec_id")


# --- small operators -------------------------------------------------------------------------------------------------------


def epoch_loss(spark: SparkSession, d: str) -> DataFrame:
    """Events of a user as steps of an epoch."""
    return A.epoch_loss(read(spark, d, "events"), ["user_id"], "value").withColumn("loss", F.round("loss", 6))


def found_and_skipped(spark: SparkSession, d: str) -> DataFrame:
    """Files of the clips of an episode, of which the probe failed for some."""
    c = read(spark, d, "clip")
    return A.found_and_skipped(c.select("episode", "file").distinct(), c.where("duration_s > 0"), EP, "file", "duration_s")


def target_instruments(spark: SparkSession, d: str) -> DataFrame:
    """P20: a part's brand, type and name as instruments, the type as target of the small ones."""
    p = read(spark, d, "part").select("p_partkey", F.array("p_brand", "p_type", "p_name").alias("all"), F.when(F.col("p_size") < 10, F.col("p_type")).when(F.col("p_size") < 12, F.lit("other")).when(F.col("p_size") < 14, F.lit("")).alias("target"))
    return A.target_instruments(p, ["p_partkey"], "all", "target")


def target_stems(spark: SparkSession, d: str) -> DataFrame:
    """Of three stems the target one where there is one."""
    p = read(spark, d, "part").select("p_partkey", C.target_stem(F.array("p_brand", "p_type", "p_name"), F.when(F.col("p_size") < 20, F.col("p_size") % 3 + 1)).alias("s"))
    return p.select("p_partkey", F.posexplode("s").alias("pos", "stem"))


def timed_cues(spark: SparkSession, d: str) -> DataFrame:
    """P15."""
    return C.timed_cues(read(spark, d, "cue")).select("episode", "cue_ord", "text", "start_time", "end_time")


def music_urls(spark: SparkSession, d: str) -> DataFrame:
    """Script JSON made of orders: an object, a list, a list without an mp3, and a broken text."""
    url = lambda ext: F.concat(F.lit('{"aliyun_url": "https://x/'), F.col("o_orderkey").cast("string"), F.lit(f'.{ext}"}}'))
    k = F.col("o_orderkey") % 4
    j = F.when(k == 0, url("MP3")).when(k == 1, F.concat(F.lit('[{"other": 1}, '), url("wav"), F.lit(", "), url("mp3"), F.lit("]"))).when(k == 2, F.concat(F.lit("["), url("wav"), F.lit("]"))).otherwise(F.lit("{broken"))
    return read(spark, d, "orders").select("o_orderkey", C.music_url(j).alias("url"))


def grey_means(spark: SparkSession, d: str) -> DataFrame:
    """A part's numbers as pixels."""
    px = lambda m: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: ((F.col("p_partkey") * m + i * 31) % 256).cast("double"))
    return read(spark, d, "part").select("p_partkey", F.round(S.mean_brightness(px(7), px(11), px(13)), 6).alias("brightness"))


def turned_channels(spark: SparkSession, d: str) -> DataFrame:
    """Two channels turned and played backwards."""
    v = read(spark, d, "embeddings").select("vec_id", F.array(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32)).alias("ch"))
    v = v.select("vec_id", F.posexplode(S.time_reversed(S.channels_flipped(F.col("ch")))).alias("channel", "x")).select("vec_id", "channel", F.posexplode("x").alias("pos", "v"))
    return v.select("vec_id", "channel", "pos", F.col("v").cast("double").alias("v"))


def weighted_losses(spark: SparkSession, d: str) -> DataFrame:
    """Twice the squared and half the absolute error of neighbouring vectors."""
    return _pairs(spark, d).select("vec_id", F.round(S.weighted_loss({"mse": 2.0, "l1": 0.5}, F.col("reference"), F.col("estimate")), 6).alias("loss"))


def aligned_draws(spark: SparkSession, d: str) -> DataFrame:
    """The lines of an order as stems, by supplier's draw, none of which may be below a quantity."""
    li = read(spark, d, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 4).alias("attempt"), F.col("l_quantity").alias("level"))
    return A.aligned_draws(li, ["l_orderkey"], "attempt", "level", 20.0, 3)


def loud_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Pieces of a vector, resampled, to one channel, kept where loud."""
    v = read(spark, d, "embeddings").select("vec_id", S.doubles("embedding").alias("x"))
    v = v.withColumn("part", S.fixed_chunk(F.col("x"), 40, 32)).withColumn("mono", S.to_mono(F.slice("part", 1, 16), F.slice("part", 17, 16)))
    v = v.where(S.is_loud(F.col("mono"), 0.04)).withColumn("fine", S.linear_resample(F.col("mono"), 8, 16))
    return v.select("vec_id", S.stem_format(F.transform("part", lambda y: y * 4)).alias("format"), F.posexplode("fine").alias("pos", "v")).withColumn("v", F.round("v", 6) + 0.0)


def directory_sort(spark: SparkSession, d: str) -> DataFrame:
    """folders of a track list in the order of their code points."""
    m = read(spark, d, "music_tag").where("folder IS NOT NULL").select("folder", "file").distinct()
    return m.select("folder", "file", F.row_number().over(Window.partitionBy("folder").orderBy("file")).alias("ord"))


def original_positions(spark: SparkSession, d: str) -> DataFrame:
    """H8: where the second and the last Han character of a raw line stand."""
    s = _script(spark, d).where("raw IS NOT NULL")
    return s.select("episode", "line_ord", T.original_position("raw", 1).alias("second"), T.original_position("raw", F.length(T.han("raw")) - 1).alias("last"), T.original_position("raw", F.length("raw")).alias("beyond"))


def kept_replacements(spark: SparkSession, d: str) -> DataFrame:
    """A replacement that leaves the first half of a cue's characters, or all but one."""
    c = _cues(spark, d).where("length(text) > 0")
    left = F.when(F.col("cue_ord") % 2 == 0, F.left("text", F.floor(F.length("text") / 2).cast("int"))).otherwise(F.left("text", F.length("text") - 1))
    return c.select("episode", "cue_ord", "text", "start_time", "end_time", T.keep_unless_halved("text", left).alias("kept"))


def answer_segments(spark: SparkSession, d: str) -> DataFrame:
    """Numbered lines of the script with pauses and speakers, as a model's answer."""
    s = _script(spark, d).where("line IS NOT NULL").withColumn("k", F.floor(F.col("line_ord") / 5))
    row = F.struct("line_ord", F.concat((F.col("line_ord") % 5 + 1).cast("string"), F.lit(". 甲："), F.left("line", F.lit(3)), F.lit("[1.2s]"), F.substring(F.col("line"), F.lit(4), F.length("line"))).alias("t"))
    a = s.groupBy("episode", "k").agg(F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["t"]), "\n"), F.lit("\n\n")).alias("answer"))
    return a.select("episode", "k", F.posexplode(T.segments("answer")).alias("i", "text"))


def expanded_markers(spark: SparkSession, d: str) -> DataFrame:
    """Three markers and two lengths."""
    x = F.concat(F.col("p_brand"), F.lit("<a>x<a>y<a>"))
    return read(spark, d, "part").select("p_partkey", T.expand_placeholders(x, "<a>", F.array(F.col("p_size") % 4, F.lit(2))).alias("text"))


def picked_junctions(spark: SparkSession, d: str) -> DataFrame:
    """Numbers, blanks and words of a list, for as many clips as a part's size."""
    x = F.concat((F.col("p_partkey") % 60).cast("string"), F.lit(", 2,x,,0,3 ,7"))
    return read(spark, d, "part").select("p_partkey", F.array_join(T.manual_junctions(x, F.col("p_size")).cast("array<string>"), ",").alias("at"))


def forced_prompts(spark: SparkSession, d: str) -> DataFrame:
    """A prompt file's text without its front matter, with the chunk's language forced."""
    c = read(spark, d, "chunk_text").select("orig_index", "chunk_index", "loaded_at", F.trim("language").alias("language"))
    return c.select("orig_index", "chunk_index", "loaded_at", T.prompt(T.without_front_matter(F.lit("---\na: b\n---\n\nSay: ")), "language").alias("prompt"))


QUERIES = {f.__name__: f for f in (
    merged_segment_split, single_char_fix, overlap_trim, segment_alignment, salvage_loop, short_cue_merge, repaired_stamps, pattern_runs, quiet_chunks, spectral_ensemble, spectral_rmse, bleed_fullness,
    demixed, tta_mean, epoch_loss, found_and_skipped, target_instruments, target_stems, timed_cues, music_urls, grey_means, turned_channels, weighted_losses, aligned_draws, loud_chunks, directory_sort,
    original_positions, kept_replacements, answer_segments, expanded_markers, picked_junctions, forced_prompts,
)}

_C = "c AS (SELECT DISTINCT episode, cue_ord, text, start_time, end_time FROM cue WHERE start_time IS NOT NULL AND end_time IS NOT NULL AND text IS NOT NULL)"
_U = f"{_C}, one AS (SELECT episode, cue_ord, max({{'start_time': start_time, 'end_time': end_time, 'text': text}}) AS c FROM c GROUP BY ALL), u AS (SELECT episode, cue_ord, c.start_time AS s, c.end_time AS e, c.text AS text FROM one)"
_S = "sc AS (SELECT episode, line_ord, max({'speaker': speaker, 'line': line, 'raw': raw}) AS v FROM script_line GROUP BY ALL), s AS (SELECT episode, line_ord, v.speaker AS speaker, v.line AS line, v.raw AS raw FROM sc)"
_HAN = r"'[^\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}]'"
_V = "v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)"
# A vector of 64 samples, reflected by 16 on either side: five frames of 32 samples, 16 apart, of 17 frequencies each.
_DFT = f"""{_V}, p AS (SELECT a.vec_id, a.pos, a.v AS a, b.v AS b FROM v a JOIN v b ON b.vec_id = a.vec_id + 1 AND a.pos = b.pos),
        g AS (SELECT f, k, j, cos(2 * pi() * k * j / 32) AS c, -sin(2 * pi() * k * j / 32) AS s, abs(f * 16 + j - 16) AS q FROM range(5) x(f), range(17) y(k), range(32) z(j)),
        h AS (SELECT f, k, c, s, CASE WHEN q > 63 THEN 126 - q ELSE q END AS pos FROM g),
        z AS (SELECT vec_id, f, k, sum(a * c) AS ar, sum(a * s) AS ai, sum(b * c) AS br, sum(b * s) AS bi FROM h JOIN p USING (pos) GROUP BY ALL)"""
_BLANK = r"'^[\s\x{3000}]+|[\s\x{3000}]+$'"
SQL = {
    "overlap_trim": f"""WITH RECURSIVE {_S}, p AS (SELECT *, coalesce(lag(line) OVER (PARTITION BY episode ORDER BY line_ord), '') AS p, row_number() OVER (PARTITION BY episode ORDER BY line_ord) AS i FROM s),
        g AS (SELECT episode, i, coalesce(CASE WHEN line_ord % 2 = 0 THEN right(p, 2) || line ELSE line END, '') AS text FROM p),
        r(episode, i, text) AS (SELECT episode, i, text FROM g WHERE i = 1 UNION ALL
          SELECT episode, i, CASE WHEN k > 0 THEN substr(h, k + 1) ELSE text END FROM (SELECT g.*, regexp_replace(g.text, {_HAN}, '', 'g') AS h, regexp_replace(r.text, {_HAN}, '', 'g') AS a,
            coalesce(list_max(list_filter(range(1, length(h)), lambda n: n <= length(a) AND suffix(a, left(h, n)))), 0) AS k FROM r JOIN g ON g.episode = r.episode AND g.i = r.i + 1))
        SELECT episode, i - 1 AS ord, text FROM r""",
    "short_cue_merge": f"""WITH {_U}, t AS (SELECT *, regexp_replace(text, {_BLANK}, '', 'g') AS t, row_number() OVER w AS i, count(*) OVER (PARTITION BY episode) AS n FROM u WINDOW w AS (PARTITION BY episode ORDER BY cue_ord)),
        k AS (SELECT *, length(t) <= 4 AND e - s < 1.2 AS short FROM t), g AS (SELECT *, i - row_number() OVER (PARTITION BY episode, short ORDER BY i) AS g FROM k),
        m AS (SELECT *, short AND i < n AND (row_number() OVER (PARTITION BY episode, short, g ORDER BY i)) % 2 = 1 AS joins FROM g),
        x AS (SELECT *, lead(t) OVER w AS nt, lead(e) OVER w AS ne, coalesce(lag(joins) OVER w, false) AS taken FROM m WINDOW w AS (PARTITION BY episode ORDER BY i))
        SELECT episode, row_number() OVER (PARTITION BY episode ORDER BY i) - 1 AS ord, CASE WHEN joins THEN t || nt ELSE text END AS text, round(s, 6) AS start_time, round(CASE WHEN joins THEN ne ELSE e END, 6) AS end_time FROM x WHERE NOT taken""",
    "repaired_stamps": """SELECT p_partkey, CAST(i AS INTEGER) AS pos, CASE WHEN p_partkey % 10 = 8 AND i >= 8 THEN 5000 WHEN i <> p_partkey % 10 THEN i * 100 WHEN i = 9 THEN 5000 WHEN i = 0 THEN 100 ELSE (i - 1) * 100 END AS ms FROM part, range(10) r(i)""",
    "pattern_runs": f"WITH {_S} SELECT episode, line_ord, '<' || CASE WHEN line[1] = line[2] THEN line[1] ELSE left(line, 2) END || '>' || line AS text FROM s WHERE length(line) >= 2",
    "quiet_chunks": f"""WITH RECURSIVE w AS (SELECT vec_id, list_transform(embedding, lambda x: abs(x::DOUBLE)) AS x FROM embeddings),
        r(vec_id, x, chunk, lo, hi) AS (SELECT vec_id, x, -1, 0, 0 FROM w UNION ALL
          SELECT vec_id, x, chunk + 1, hi, CASE WHEN len(x) - hi <= 20 THEN len(x) ELSE q + list_position(x[q + 1 : q + 4], list_min(x[q + 1 : q + 4])) - 1 END
          FROM (SELECT *, b + list_position(sums, list_min(sums)) - 1 AS q FROM (SELECT *, greatest(hi, hi + 15) AS b, list_transform(range(greatest(hi, hi + 15), least(len(x), hi + 25) - 3), lambda i: list_sum(x[i + 1 : i + 4])) AS sums FROM r WHERE hi < len(x))))
        SELECT vec_id, CAST(chunk AS INTEGER) AS chunk, CAST(lo AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi FROM r WHERE chunk >= 0""",
    "spectral_ensemble": f"WITH {_V} SELECT vec_id // 3 AS track, CAST(pos AS INTEGER) AS pos, round(sum(v * (vec_id % 3 + 1)) / sum(vec_id % 3 + 1), 5) + 0.0 AS v FROM v GROUP BY ALL",
    "spectral_rmse": f"WITH {_DFT} SELECT vec_id, round(sqrt(avg((ar - br) ^ 2 + (ai - bi) ^ 2) / 2 / 32), 6) AS rmse FROM z GROUP BY 1",
    "l1_freq_metric": f"WITH {_DFT} SELECT vec_id, 100 / (1 + 10 * avg(abs(sqrt(ar ^ 2 + ai ^ 2) - sqrt(br ^ 2 + bi ^ 2)))) AS l1_freq FROM z GROUP BY 1",
    "bleed_fullness": "SELECT vec_id, round(100 / (20 * log10(2) + 1), 6) AS bleedless, 100.0::DOUBLE AS fullness FROM embeddings",
    "demixed": f"WITH {_V} SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(v / 2, 5) + 0.0 AS v FROM v",
    "tta_mean": f"WITH {_V} SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(3 * v + CASE WHEN pos >= 32 THEN 0.1 ELSE 0 END, 5) + 0.0 AS v FROM v",
    "epoch_loss": "SELECT user_id, round(sum(value) / count(value), 6) AS loss, count(value) AS steps FROM events GROUP BY 1",
    "found_and_skipped": """WITH f AS (SELECT DISTINCT episode, file FROM clip), k AS (SELECT DISTINCT file FROM clip WHERE duration_s > 0)
        SELECT episode, count(*) AS listed, count(k.file) AS found, count(*) - count(k.file) AS skipped FROM f LEFT JOIN k USING (file) GROUP BY 1""",
    "target_instruments": """SELECT p_partkey, p_type AS instrument, list_position([p_brand, p_type, p_name], p_type)::INTEGER AS index FROM part WHERE p_size < 10 UNION ALL SELECT p_partkey, 'other', NULL FROM part WHERE p_size BETWEEN 10 AND 11
        UNION ALL SELECT p_partkey, x, list_position([p_brand, p_type, p_name], x)::INTEGER FROM (SELECT p_partkey, p_brand, p_type, p_name, unnest([p_brand, p_type, p_name]) AS x FROM part WHERE p_size >= 12)""",
    "target_stems": """SELECT p_partkey, 0 AS pos, CASE p_size % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_type ELSE p_name END AS stem FROM part WHERE p_size < 20 UNION ALL SELECT p_partkey, 0, p_brand FROM part WHERE p_size >= 20
        UNION ALL SELECT p_partkey, 1, p_type FROM part WHERE p_size >= 20 UNION ALL SELECT p_partkey, 2, p_name FROM part WHERE p_size >= 20""",
    "timed_cues": "SELECT episode, cue_ord, text, start_time, end_time FROM cue WHERE end_time - start_time > 0",
    "music_urls": "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'https://x/' || o_orderkey || '.MP3' WHEN 1 THEN 'https://x/' || o_orderkey || '.mp3' END AS url FROM orders",
    "grey_means": """SELECT p_partkey, round(avg(floor((p_partkey * 7 + i * 31) % 256 * 0.299::DOUBLE + (p_partkey * 11 + i * 31) % 256 * 0.587::DOUBLE + (p_partkey * 13 + i * 31) % 256 * 0.114::DOUBLE + 0.5::DOUBLE)), 6) AS brightness FROM part, range(8) r(i) GROUP BY 1""",
    "turned_channels": f"WITH {_V} SELECT vec_id, CAST(CASE WHEN pos < 32 THEN 1 ELSE 0 END AS INTEGER) AS channel, CAST(31 - pos % 32 AS INTEGER) AS pos, v FROM v",
    "weighted_losses": f"WITH {_V} SELECT a.vec_id, round(2 * avg((a.v - b.v) ^ 2) + 0.5::DOUBLE * avg(abs(a.v - b.v)), 6) AS loss FROM v a JOIN v b ON b.vec_id = a.vec_id + 1 AND a.pos = b.pos GROUP BY 1",
    "aligned_draws": """WITH d AS (SELECT l_orderkey, l_suppkey % 4 AS attempt, count(*) FILTER (WHERE l_quantity < 20) AS quiet FROM lineitem WHERE l_suppkey % 4 < 3 GROUP BY ALL)
        SELECT l_orderkey, attempt, quiet FROM d QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY quiet > 0, CASE WHEN quiet = 0 THEN attempt ELSE -attempt END) = 1""",
    "loud_chunks": f"""WITH {_V}, p AS (SELECT vec_id, r.pos, coalesce(v, 0) AS v FROM (SELECT vec_id, i AS pos FROM (SELECT DISTINCT vec_id FROM v), range(32) t(i)) r LEFT JOIN (SELECT vec_id, pos - 40 AS pos, v FROM v) USING (vec_id, pos)),
        f AS (SELECT vec_id, CASE WHEN max(abs(v * 4)) <= 1 THEN 'flac:PCM_16' ELSE 'wav:FLOAT' END AS format FROM p GROUP BY 1),
        m AS (SELECT vec_id, pos % 16 AS pos, sum(v) / 2 AS v FROM p GROUP BY ALL), k AS (SELECT vec_id FROM m GROUP BY 1 HAVING avg(abs(v)) >= 0.04)
        SELECT vec_id, format, CAST(i AS INTEGER) AS pos, round((a.v + b.v) / 2, 6) + 0.0 AS v FROM k JOIN f USING (vec_id) JOIN range(32) t(i) ON true JOIN m a USING (vec_id) JOIN m b USING (vec_id) WHERE a.pos = i // 2 AND b.pos = least(15, (i + 1) // 2)""",
    "directory_sort": "WITH m AS (SELECT DISTINCT folder, file FROM music_tag WHERE folder IS NOT NULL) SELECT folder, file, CAST(row_number() OVER (PARTITION BY folder ORDER BY file NULLS FIRST) AS INTEGER) AS ord FROM m",
    "original_positions": f"""WITH {_S}, p AS (SELECT episode, line_ord, raw, list_filter(range(0, length(raw)), lambda i: regexp_replace(substr(raw, i + 1, 1), {_HAN}, '') <> '') AS places FROM s WHERE raw IS NOT NULL)
        SELECT episode, line_ord, CAST(coalesce(places[2], length(raw)) AS INTEGER) AS second, CAST(CASE WHEN len(places) = 0 THEN length(raw) ELSE places[-1] END AS INTEGER) AS last, CAST(length(raw) AS INTEGER) AS beyond FROM p""",
    "kept_replacements": f"""WITH {_C}, p AS (SELECT *, CASE WHEN cue_ord % 2 = 0 THEN left(text, length(text) // 2) ELSE left(text, length(text) - 1) END AS l FROM c WHERE length(text) > 0),
        h AS (SELECT *, length(regexp_replace(text, {_HAN}, '', 'g')) AS a, length(regexp_replace(l, {_HAN}, '', 'g')) AS b FROM p)
        SELECT episode, cue_ord, text, start_time, end_time, CASE WHEN a >= 4 AND b <= a // 2 THEN text ELSE l END AS kept FROM h""",
    "answer_segments": f"""WITH {_S} SELECT episode, line_ord // 5 AS k, CAST(row_number() OVER (PARTITION BY episode, line_ord // 5 ORDER BY line_ord) - 1 AS INTEGER) AS i, line AS text FROM s WHERE line IS NOT NULL""",
    "expanded_markers": "SELECT p_partkey, p_brand || repeat('<a>', p_size % 4) || 'x<a><a>y<a>' AS text FROM part",
    "picked_junctions": """WITH x AS (SELECT p_partkey, p_size, i, n FROM part, LATERAL (SELECT unnest([p_partkey % 60, 2, 0, 3, 7]) AS n, unnest([1, 2, 3, 4, 5]) AS i))
        SELECT p.p_partkey, coalesce(string_agg((n - 1)::VARCHAR, ',' ORDER BY i), '') AS at FROM part p LEFT JOIN (SELECT * FROM x WHERE n >= 1 AND n < p_size) y ON y.p_partkey = p.p_partkey GROUP BY 1""",
    "forced_prompts": r"SELECT orig_index, chunk_index, loaded_at, 'Say: ' || CASE WHEN trim(coalesce(language, '')) = '' THEN '' ELSE 'language ' || upper(left(trim(language), 1)) || lower(substr(trim(language), 2)) || '<asr_text>' END AS prompt FROM chunk_text",
}
