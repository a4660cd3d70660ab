"""Text, colour and signal operators over the driver's tables, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.functions import signal as S
from reelframe.functions import text as T
from reelframe.session import read

_HAN = r"'[^\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}]'"


def _han(c: str) -> str:
    return f"regexp_replace({c}, {_HAN}, '', 'g')"


def han_strip(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "script_line").select("episode", "line_ord", T.han("raw").alias("han"))


def word_end_clamp(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "word").select("episode", "word_ord", "text", "loaded_at", F.round(T.clamp_word_end("text", "start_time", "end_time"), 6).alias("end_time"))


def interjection_filter(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "word").where(~T.is_interjection("text")).select("episode", "word_ord", "text", "loaded_at")


def trailing_particle(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "cue").select("episode", "cue_ord", T.strip_trailing_particle(F.concat("text", F.lit("啊"))).alias("text"))


def beep_prefix(spark: SparkSession, d: str) -> DataFrame:
    x = F.concat(F.lit("叮"), F.when(F.col("cue_ord") % 2 == 0, "检测").otherwise(""), F.col("text"))
    return read(spark, d, "cue").select("episode", "cue_ord", T.strip_beep(x).alias("text"))


def srt_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "cue").where("start_time >= 0").withColumn("srt", T.srt_time("start_time"))
    return rows.select("episode", "cue_ord", "srt", F.round(T.srt_seconds("srt"), 6).alias("seconds"))


def flexible_time(spark: SparkSession, d: str) -> DataFrame:
    x = F.concat_ws(":", F.col("clip_ord").cast("string"), F.lit("07.5"))
    return read(spark, d, "clip").select("episode", "clip_ord", "file", T.flexible_seconds(x).alias("a"), T.flexible_seconds("file").alias("b"))


def padded_ranges(spark: SparkSession, d: str) -> DataFrame:
    r = T.padded_range(F.concat(F.col("clip_ord").cast("string"), F.lit(" – 12.5")))
    return read(spark, d, "clip").select("episode", "clip_ord", "file", F.round(r["s"], 6).alias("s"), F.round(r["e"], 6).alias("e"))


def dictionary_replace(spark: SparkSession, d: str) -> DataFrame:
    out = T.replace_in_order("text", [("掉了", "丢了"), ("他的面具", "她的面具"), ("账本", "旧账本")])
    return read(spark, d, "cue").select("episode", "cue_ord", "loaded_at", out.alias("text"))


def language_canonical(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "chunk_text")
    return rows.select("orig_index", "chunk_index", T.canonical_language("language").alias("language"), F.coalesce(T.is_known_language("language"), F.lit(False)).alias("known"))


def language_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "chunk_text").groupBy("orig_index", "chunk_index").agg(F.max("language").alias("language"))
    xs = F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "language"))), lambda x: x["language"])
    return rows.groupBy("orig_index").agg(T.merged_languages(xs).alias("languages"))


def model_output(spark: SparkSession, d: str) -> DataFrame:
    o = T.model_output("raw")
    return read(spark, d, "chunk_text").select("orig_index", "chunk_index", "loaded_at", o["language"].alias("language"), o["text"].alias("text"))


def kept_chars(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", T.kept_chars("text").alias("kept"))


def mixed_tokens(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "music_tag").select("track_id", "loaded_at", F.array_join(T.tokens("description"), "|").alias("tokens"))


def json_extract(spark: SparkSession, d: str) -> DataFrame:
    answer = F.concat(F.lit("```json\nhere: "), F.col("props"), F.lit("\n```"))
    obj = T.json_object_text(answer)
    return read(spark, d, "events").select("event_id", F.get_json_object(obj, "$.k").cast("long").alias("k"))


def replacement_lines(spark: SparkSession, d: str) -> DataFrame:
    p = T.replacement_pair(F.concat("alias", F.lit(" → "), "speaker"))
    return read(spark, d, "speaker_alias").select("series", "alias", p["wrong"].alias("wrong"), p["right"].alias("right"))


def natural_sort_rank(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("episode").orderBy(T.natural_key("file"))
    return read(spark, d, "clip").where("file IS NOT NULL").select("episode", "file", "clip_ord", F.dense_rank().over(w).alias("rank"))


def catalogue_lines(spark: SparkSession, d: str) -> DataFrame:
    parts = [F.col("folder"), F.col("file"), F.array_join("emotion", "/"), F.col("energy"), F.array_join("style", "/")]
    return read(spark, d, "music_tag").select("track_id", "loaded_at", T.catalogue_line(parts).alias("line"))


def audio_kinds(spark: SparkSession, d: str) -> DataFrame:
    x = F.when(F.col("clip_ord") % 3 == 0, F.concat(F.lit("https://host/"), "file")).when(F.col("clip_ord") % 3 == 1, F.repeat(F.lit("QUJD"), 80)).otherwise(F.concat(F.lit("/media/"), "file"))
    return read(spark, d, "clip").select("episode", "clip_ord", "file", T.audio_kind(x).alias("kind"))


def episode_numbers(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "clip").select("episode", T.episode_number("episode").alias("a"), T.episode_number(F.concat(F.lit("第"), F.col("clip_ord").cast("string"), F.lit("集_x"))).alias("b")).distinct()


def title_display(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").select("p_partkey", T.title_case(F.regexp_replace("p_name", " ", "_")).alias("title"))


def loudness_volume(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").select("p_partkey", S.volume_for(-F.col("p_size").cast("double")).alias("volume"))


def _rgb() -> list:
    return [(F.col("p_partkey") * 37 % 256).alias("r"), (F.col("p_size") * 5 % 256).cast("long").alias("g"), (F.floor("p_retailprice") % 256).cast("long").alias("b")]


def colour_label(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "part").select("p_partkey", *_rgb())
    c, h = S.colour_labels(F.col("r"), F.col("g"), F.col("b")), S.hsv(F.col("r"), F.col("g"), F.col("b"))
    return rows.select("p_partkey", F.round(h["h"], 4).alias("h"), F.round(h["s"], 6).alias("s"), F.round(h["v"], 6).alias("v"), c["warmth"].alias("warmth"), c["brightness"].alias("brightness"))


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "embeddings").select("vec_id", "label", S.doubles("embedding").alias("x"))


def _vector_pairs(spark: SparkSession, d: str) -> DataFrame:
    v = _vectors(spark, d).select("vec_id", "x")
    return v.join(v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("y")), "vec_id")


def signal_metrics(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    return _vector_pairs(spark, d).select("vec_id", *[F.round(S.metric(m, x, y), 5).alias(m) for m in ("sdr", "si_sdr", "mse", "l1")])


def signal_levels(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("x")
    return _vectors(spark, d).select(
        "vec_id", F.round(S.rms_db(x), 5).alias("rms_db"), F.round(S.peak_db(x), 5).alias("peak_db"), F.round(S.std(x), 6).alias("std0"), F.round(S.std(x, 1), 6).alias("std1"),
        F.round(F.array_max(S.peak_normalised(S.gained(x, 3.0))), 6).alias("peak3"), F.round(S.total(S.standardised(x)), 4).alias("zero"), S.is_loud(x, 0.1).alias("loud"), S.stem_format(x).alias("format"),
    )


def feature_lengths(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select("event_id", S.feature_length("event_id").alias("n"))


QUERIES = {f.__name__: f for f in (
    han_strip, word_end_clamp, interjection_filter, trailing_particle, beep_prefix, srt_roundtrip, flexible_time, padded_ranges, dictionary_replace, language_canonical, language_merge,
    model_output, kept_chars, mixed_tokens, json_extract, replacement_lines, natural_sort_rank, catalogue_lines, audio_kinds, episode_numbers, title_display, loudness_volume, colour_label,
    signal_metrics, signal_levels, feature_lengths,
)}

_INTER = "'啊|哦|嗯|呢|吧|哈|唉|诶|嘿|喂|哎|呀|哟|咦|嘛|喔|噢|唔|嗨|咳|嘻'"
_CJK_ONE = r"[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}]"
_PAIRS = "SELECT a.vec_id, list_transform(a.embedding, lambda v: v::DOUBLE) AS x, list_transform(b.embedding, lambda v: v::DOUBLE) AS y FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"
_LANGS = ", ".join(f"'{x}'" for x in T.LANGUAGES)
SQL = {
    "han_strip": f"SELECT episode, line_ord, {_han('raw')} AS han FROM script_line",
    "word_end_clamp": f"SELECT episode, word_ord, text, loaded_at, round(least(end_time, start_time + greatest(coalesce(length({_han('text')}), 1), 1) * 1.2 + 1.0), 6) AS end_time FROM word".replace(
        "round(least(end_time, ", "round(CASE WHEN start_time IS NULL THEN end_time WHEN end_time IS NULL THEN start_time + greatest(coalesce(length(" + _han("text") + "), 1), 1) * 1.2 + 1.0 ELSE least(end_time, "
    ).replace("* 1.2 + 1.0), 6)", "* 1.2 + 1.0) END, 6)"),
    "interjection_filter": f"SELECT episode, word_ord, text, loaded_at FROM word WHERE NOT (regexp_full_match(trim(text, ' '), '(' || {_INTER} || ')*') OR trim(text, ' ') IN ('嘿嘿', '哈哈', '呵呵', '嘻嘻'))",
    "trailing_particle": "SELECT episode, cue_ord, CASE WHEN length(text) >= 2 THEN text ELSE text || '啊' END AS text FROM cue",
    "beep_prefix": "SELECT episode, cue_ord, CASE WHEN cue_ord % 2 = 0 THEN '检测' || text WHEN regexp_matches(text, '^(检测|击杀|发现|警告|获得|提升|吸收|触发|解锁|激活|任务|恭喜)') THEN text ELSE '叮' || text END AS text FROM cue",
    "srt_roundtrip": """WITH t AS (SELECT episode, cue_ord, printf('%02d:%02d:%02d,%03d', CAST(floor(start_time / 3600) AS BIGINT), CAST(floor((start_time % 3600) / 60) AS BIGINT),
        CAST(floor(start_time % 60) AS BIGINT), CAST(floor((start_time % 1) * 1000) AS BIGINT)) AS srt FROM cue WHERE start_time >= 0)
        SELECT episode, cue_ord, srt, round(CAST(split_part(srt, ':', 1) AS DOUBLE) * 3600 + CAST(split_part(srt, ':', 2) AS DOUBLE) * 60 + CAST(replace(split_part(srt, ':', 3), ',', '.') AS DOUBLE), 6) AS seconds FROM t""",
    "flexible_time": "SELECT episode, clip_ord, file, clip_ord * 60 + 7.5::DOUBLE AS a, -1.0::DOUBLE AS b FROM clip",
    "padded_ranges": "SELECT episode, clip_ord, file, CASE WHEN clip_ord < 12.5 THEN greatest(clip_ord - 0.5, 0)::DOUBLE END AS s, CASE WHEN clip_ord < 12.5 THEN 13.0::DOUBLE END AS e FROM clip",
    "dictionary_replace": r"""SELECT episode, cue_ord, loaded_at, replace(replace(replace(replace(replace(text, '他的面具', '她的面具'), '掉了', '丢了'), '旧账本', chr(1)), '账本', '旧账本'), chr(1), '旧账本') AS text FROM cue""",
    "language_canonical": f"""WITH t AS (SELECT orig_index, chunk_index, CASE WHEN trim(language) <> '' THEN upper(trim(language)[1]) || lower(substr(trim(language), 2)) END AS language FROM chunk_text)
        SELECT *, coalesce(language IN ({_LANGS}), false) AS known FROM t""",
    "language_merge": """WITH t AS (SELECT orig_index, chunk_index, trim(max(language)) AS language FROM chunk_text GROUP BY ALL),
        k AS (SELECT *, lag(language) OVER (PARTITION BY orig_index ORDER BY chunk_index) AS p FROM t WHERE language IS NOT NULL AND language <> '')
        SELECT o.orig_index, coalesce(string_agg(k.language, ',' ORDER BY k.chunk_index) FILTER (WHERE k.p IS DISTINCT FROM k.language), '') AS languages
        FROM (SELECT DISTINCT orig_index FROM chunk_text) o LEFT JOIN k USING (orig_index) GROUP BY o.orig_index""",
    "model_output": r"""WITH t AS (SELECT *, trim(raw, ' ') AS r FROM chunk_text), s AS (SELECT *, instr(r, '<asr_text>') AS i FROM t),
        u AS (SELECT *, CASE WHEN i > 0 THEN r[1 : i - 1] END AS head, CASE WHEN i > 0 THEN trim(substr(r, i + 10), ' ') END AS body FROM s)
        SELECT orig_index, chunk_index, loaded_at,
          CASE WHEN head IS NULL OR contains(lower(head), 'language none') OR trim(substr(head, 10)) = '' THEN '' ELSE upper(trim(substr(head, 10))[1]) || lower(substr(trim(substr(head, 10)), 2)) END AS language,
          CASE WHEN r IS NULL THEN '' WHEN i = 0 THEN r ELSE body END AS text FROM u""",
    "kept_chars": r"SELECT doc_id, regexp_replace(text, '[^\p{L}\p{N}'']', '', 'g') AS kept FROM documents",
    "mixed_tokens": rf"""SELECT track_id, loaded_at, CASE WHEN description IS NOT NULL THEN array_to_string(flatten(list_transform(list_filter(list_transform(regexp_split_to_array(trim(description, ' '), '\s+'),
        lambda w: regexp_replace(w, '[^\p{{L}}\p{{N}}'']', '', 'g')), lambda w: w <> ''), lambda w: regexp_extract_all(w, '{_CJK_ONE}|[^{_CJK_ONE[1:]}+'))), '|') END AS tokens FROM music_tag""",
    "json_extract": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "replacement_lines": "SELECT series, alias, CASE WHEN trim(alias) <> '' AND trim(speaker) <> '' AND trim(alias) <> trim(speaker) THEN trim(alias) END AS wrong, CASE WHEN trim(alias) <> '' AND trim(speaker) <> '' AND trim(alias) <> trim(speaker) THEN trim(speaker) END AS right FROM speaker_alias",  # noqa: E501
    "natural_sort_rank": r"""SELECT episode, file, clip_ord, CAST(dense_rank() OVER (PARTITION BY episode ORDER BY list_transform(regexp_extract_all(lower(file), '(\d+|\D+)'),
        lambda r: CASE WHEN regexp_matches(r, '^\d') THEN lpad(CASE WHEN ltrim(r, '0') = '' THEN '0' ELSE ltrim(r, '0') END, 20, '0') ELSE r END)) AS INTEGER) AS rank FROM clip WHERE file IS NOT NULL""",
    "catalogue_lines": """SELECT track_id, loaded_at, coalesce(folder, '') || ' | ' || coalesce(file, '') || ' | ' || coalesce(array_to_string(list_filter(emotion, lambda x: x IS NOT NULL), '/'), '') || ' | ' || coalesce(energy, '')
        || ' | ' || coalesce(array_to_string(list_filter(style, lambda x: x IS NOT NULL), '/'), '') AS line FROM music_tag""",
    "audio_kinds": "SELECT episode, clip_ord, file, CASE WHEN clip_ord % 3 = 0 THEN CASE WHEN file IS NOT NULL THEN 'url' END WHEN clip_ord % 3 = 1 THEN 'base64' WHEN file IS NOT NULL THEN 'path' END AS kind FROM clip",
    "episode_numbers": r"SELECT DISTINCT episode, CAST(regexp_extract(episode, '(\d+)\s*$', 1) AS INTEGER) AS a, clip_ord AS b FROM clip",
    "title_display": "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(substr(w, 2))), ' ') AS title FROM part",
    "loudness_volume": "SELECT p_partkey, round_even(greatest(0.05, least(0.40, pow(10.0, (-34.0 + p_size) / 20.0))), 3) AS volume FROM part",
    "colour_label": """WITH t AS (SELECT p_partkey, (p_partkey * 37 % 256) / 255.0::DOUBLE AS x, (p_size * 5 % 256) / 255.0::DOUBLE AS y, (CAST(floor(p_retailprice) AS BIGINT) % 256) / 255.0::DOUBLE AS z FROM part),
        m AS (SELECT *, greatest(x, y, z) AS v, greatest(x, y, z) - least(x, y, z) AS d FROM t),
        k AS (SELECT *, CASE WHEN d = 0 THEN 0 WHEN x = v THEN (y - z) / d WHEN y = v THEN 2 + (z - x) / d ELSE 4 + (x - y) / d END / 6.0 AS q FROM m),
        c AS (SELECT p_partkey, (q - floor(q)) * 360 AS h, CASE WHEN d = 0 THEN 0 ELSE d / v END AS s, v FROM k)
        SELECT p_partkey, round(h, 4) AS h, round(s, 6) AS s, round(v, 6) AS v, CASE WHEN s < 0.12 THEN '中性色调' WHEN h < 60 OR h > 300 THEN '暖色调' WHEN h BETWEEN 150 AND 270 THEN '冷色调' WHEN h < 150 THEN '偏绿冷调' ELSE '中性色调' END AS warmth,
        CASE WHEN v > 0.65 THEN '画面偏亮' WHEN v < 0.30 THEN '画面较暗' ELSE '亮度正常' END AS brightness FROM c""",
    "signal_metrics": f"""WITH p AS ({_PAIRS}), e AS (SELECT vec_id, unnest(x) AS a, unnest(y) AS b FROM p),
        s AS (SELECT vec_id, sum(a * a) AS aa, sum(a * b) AS ab, sum((a - b) * (a - b)) AS dd, avg(abs(a - b)) AS l1, count(*) AS n FROM e GROUP BY vec_id),
        k AS (SELECT *, (ab + 1e-8 * n) / (aa + 1e-8 * n) AS sc FROM s), f AS (SELECT e.vec_id, sum((a * sc) * (a * sc)) AS num, sum((a * sc - b) * (a * sc - b)) AS den FROM e JOIN k USING (vec_id) GROUP BY 1)
        SELECT vec_id, round(10 * log10((aa + 1e-8) / (dd + 1e-8)), 5) AS sdr, round(10 * log10(num / (den + 1e-8) + 1e-8), 5) AS si_sdr, round(dd / n, 5) AS mse, round(l1, 5) AS l1 FROM k JOIN f USING (vec_id)""",
    "signal_levels": """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v FROM embeddings), a AS (SELECT vec_id, sqrt(avg(v * v)) AS r, max(abs(v)) AS m, stddev_pop(v) AS s0, stddev_samp(v) AS s1, avg(abs(v)) AS l, max(v) AS mx FROM e GROUP BY 1)
        SELECT vec_id, round(20 * log10(r + 1e-9), 5) AS rms_db, round(20 * log10(m), 5) AS peak_db, round(s0, 6) AS std0, round(s1, 6) AS std1, round(CASE WHEN m * 3 > 1 THEN mx / m ELSE mx * 3 END, 6) AS peak3,
        0.0::DOUBLE AS zero, l >= 0.1 AS loud, CASE WHEN m <= 1 THEN 'flac:PCM_16' ELSE 'wav:FLOAT' END AS format FROM a""",
    "feature_lengths": """WITH t AS (SELECT event_id, event_id % 100 AS r, event_id // 100 AS q FROM events), f AS (SELECT *, CAST(floor((r - 1) / 2.0) AS BIGINT) + 1 AS a FROM t), g AS (SELECT *, CAST(floor((a - 1) / 2.0) AS BIGINT) + 1 AS b FROM f)
        SELECT event_id, CAST(floor((b - 1) / 2.0) AS BIGINT) + 1 + q * 13 AS n FROM g""",
}
