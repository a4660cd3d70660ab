"""Sources, sinks and streams: files and records made of the driver's tables, read back by the readers, each with the SQL that checks it."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelframe.operators import aggregates as A
from reelframe.plans.timeline_queries import EP, _clips, _cues, _frames, _metric_rows, _script, _words
from reelframe.session import read, scratch_path
from reelframe.sources import readers as R
from reelframe.sources import writers as K
from reelframe.sources.frames import encoded, read_frames
from reelframe.streaming import count_window as W


def _who(c: str):  # noqa: ANN202
    return F.coalesce(F.nullif(F.regexp_replace(c, r"[\s　]+", ""), F.lit("")), F.lit("甲"))


def frame_dialogues(spark: SparkSession, d: str) -> DataFrame:
    """Descriptions of two lines of the script: with their roles, as bare quotes, or without dialogue."""
    w = Window.partitionBy("episode").orderBy("line_ord")
    s = _script(spark, d).where("line IS NOT NULL").withColumn("a", _who("speaker"))
    s = s.withColumn("b", F.lead("a").over(w)).withColumn("next", F.lead("line").over(w)).where("next IS NOT NULL")
    roles = F.concat(F.lit("- 台词："), "a", F.lit("（急）：“"), "line", F.lit("”，"), "b", F.lit("：“"), "next", F.lit("”"))
    k = F.col("line_ord") % 3
    text = F.when(k == 0, roles).when(k == 1, F.concat(F.lit("台词：“"), "line", F.lit("。"), "next", F.lit("”"))).otherwise(F.lit("台词：无（动作）"))
    return R.frame_dialogues(s.select("episode", "line_ord", F.concat(F.lit("画面：天台\r\n"), text).alias("text")), ["episode", "line_ord"])


def srt_strict(spark: SparkSession, d: str) -> DataFrame:
    """Cues written as a subtitle text and read again."""
    c = _cues(spark, d).where("start_time BETWEEN 0 AND 3599 AND end_time BETWEEN 0 AND 3599 AND text <> '' AND text = trim(text)")
    srt = K.srt_text(c, EP, ["cue_ord", "start_time", "end_time", "text"])
    return srt.select("episode", F.posexplode(R.srt_strict(F.col("srt"))).alias("i", "c")).select("episode", "i", F.round("c.start", 3).alias("start"), F.round("c.end", 3).alias("end"), "c.text")


def media_listing(spark: SparkSession, d: str) -> DataFrame:
    """Files of some extensions in folders, in natural order; they are written here, empty but for a letter."""
    path = scratch_path(spark, "media")
    names = [f"clip{i}.{e}" for i in range(12) for e in ("mp4", "MKV", "wav", "txt")]
    n = read(spark, d, "region").select("r_regionkey")
    files = n.select("r_regionkey", F.explode(F.array(*map(F.lit, names))).alias("name"))
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for r in files.toLocalIterator():  # sixty small files: a list of names, not a table
        out = fs.create(jvm.org.apache.hadoop.fs.Path(f"{path}/r{r.r_regionkey}/{r.name}"), True)
        out.writeBytes("x" * (r.r_regionkey + 1))
        out.close()
    got = R.media_files(spark, f"{path}/*", ("mp4", "MKV", "wav"))
    return got.select(F.regexp_extract("folder", r"([^/]+)$", 1).alias("folder"), "name", "length", "ord")


def numbered_texts(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the script as files 1.txt, 2.txt, ... of an episode's folder, beside one that has no number."""
    s = _script(spark, d).where("line IS NOT NULL")
    files = s.select(F.concat(F.lit("/x/"), "episode", F.lit("/"), F.when(F.col("line_ord") % 7 == 6, F.lit("note")).otherwise(F.col("line_ord").cast("string")), F.lit(".txt")).alias("path"), F.col("line").alias("text"))
    return R.numbered_texts(files)


def script_json_texts(spark: SparkSession, d: str) -> DataFrame:
    """The lines of an episode as a JSON list, an object, or a list in which every second entry lacks the field."""
    row = F.struct("line_ord", F.struct(F.concat("line", F.lit("  "), "line").alias("剧情正文")).alias("j"))
    e = _script(spark, d).where("line IS NOT NULL").groupBy("episode").agg(F.array_sort(F.collect_list(row)).alias("x"), F.min("line_ord").alias("k"))
    lines = F.transform("x", lambda r: F.to_json(r["j"]))
    k = F.length("episode") + F.size("x")
    text = F.when(k % 3 == 0, lines[0]).when(k % 3 == 1, F.concat(F.lit("["), F.array_join(lines, ","), F.lit("]"))).otherwise(F.concat(F.lit('[{"other": 1},'), lines[0], F.lit("]")))
    return R.script_json_texts(e.select(F.col("episode").alias("path"), text.alias("text")))


def music_tag_files(spark: SparkSession, d: str) -> DataFrame:
    """The tags of a folder as one JSON map, with a copy of some below completed/ that overrides them, and a broken file."""
    m = read(spark, d, "music_tag").where("folder IS NOT NULL AND file IS NOT NULL").withColumn("folder", F.replace("folder", F.lit("/"), F.lit("_"))).groupBy("folder", "file").agg(F.max("energy").alias("energy"), F.max("vocal").alias("vocal"))
    entry = F.struct("file", F.struct("energy", "vocal", F.array(F.lit("古筝"), F.col("file")).alias("style")).alias("v"))
    maps = m.groupBy("folder").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("text"), F.min("file").alias("first"))
    plain = maps.select(F.concat(F.lit("/r/"), "folder", F.lit("/music_tags.json")).alias("path"), "text")
    done = maps.select(F.concat(F.lit("/r/completed/"), "folder", F.lit("/music_tags.json")).alias("path"), F.to_json(F.create_map("first", F.struct(F.lit("最高").alias("energy")))).alias("text"))
    broken = maps.select(F.concat(F.lit("/s/"), "folder", F.lit("/music_tags.json")).alias("path"), F.lit("{").alias("text"))
    got = R.music_tags(plain.unionByName(done).unionByName(broken))
    return got.select("folder", "file", "energy", "vocal", F.array_join("style", "|").alias("style"))


def music_choice(spark: SparkSession, d: str) -> DataFrame:
    """Choices of music as JSON: every second one without a percent."""
    m = _clips(spark, d).groupBy("episode").agg(F.array_sort(F.collect_list(F.struct("clip_ord", F.struct("file", F.when(F.col("clip_ord") % 2 == 0, F.col("clip_ord") * 5.0).alias("start_percent")).alias("s")))).alias("x"))
    text = F.to_json(F.struct(F.lit("g").alias("genre"), F.transform("x", lambda r: r["s"]).alias("selections")))
    return R.music_selections(m.select(F.col("episode").alias("path"), text.alias("text"))).select("path", "genre", "sel_ord", "file", "start_percent")


def track_listing(spark: SparkSession, d: str) -> DataFrame:
    """Layouts 1 and 2 over the same paths."""
    f = read(spark, d, "part").select(F.concat(F.lit("/data/"), F.regexp_replace("p_brand", r"\W", "_"), F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".x.wav")).alias("path"))
    return R.track_files(f, 1).withColumn("layout", F.lit(1)).unionByName(R.track_files(f, 2).withColumn("layout", F.lit(2)))


def training_lines(spark: SparkSession, d: str) -> DataFrame:
    """Examples as lines of JSON, some without a prompt and with a field that is not kept."""
    path = scratch_path(spark, "examples")
    c = _cues(spark, d).select(F.concat_ws("-", "episode", "cue_ord", "start_time", "end_time").alias("audio"), "text", F.when(F.col("cue_ord") % 2 == 0, F.lit("说")).alias("prompt"), F.lit(1).alias("other"))
    c.write.json(path)
    return R.json_lines(spark, path)


def latest_checkpoint(spark: SparkSession, d: str) -> DataFrame:
    """S27."""
    o = read(spark, d, "orders").select(F.concat(F.when(F.col("o_orderkey") % 2 == 0, "checkpoint-").otherwise("check-"), F.col("o_orderkey").cast("string")).alias("name"))
    return R.latest_checkpoint(o)


def word_list(spark: SparkSession, d: str) -> DataFrame:
    """A dictionary file of words with their weights, and blank lines."""
    path = scratch_path(spark, "words")
    _script(spark, d).where("line <> ''").select(F.concat(F.when(F.col("line_ord") % 3 == 0, F.lit("  ")).otherwise(F.lit("")), "line", F.lit(" 12 n"), F.when(F.col("line_ord") % 2 == 0, F.lit("\n \n")).otherwise(F.lit(""))).alias("value")).write.text(path)
    return R.dictionary(spark, path).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def edge_frames(spark: SparkSession, d: str) -> DataFrame:
    """Frames of the first and the last two seconds at two frames a second."""
    return R.head_and_tail_frames(_frames(spark, d), ["user_id"], 2.0, 2.0).select("user_id", "frame_idx")


def _recorded(spark: SparkSession, d: str) -> str:
    """A folder with the frames of each user as a recorded video of two frames a second, and one broken file."""
    path = scratch_path(spark, "frames")

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        fs, base = pafs.FileSystem.from_uri(path)
        fs.create_dir(base)
        pdf = pdf.sort_values("frame_idx")
        user = int(pdf["user_id"].iloc[0])
        with fs.open_output_stream(f"{base}/u{user}.frames") as f:
            f.write(encoded(2.0, np.stack([pdf["brightness"], pdf["brightness"] / 400, pdf["has_text"].astype(float)], axis=1)) if user % 7 else b"no")
        return pd.DataFrame({"n": [len(pdf)]})

    _frames(spark, d).groupBy("user_id").applyInPandas(write, "n long").write.format("noop").mode("overwrite").save()
    return path


def frame_source(spark: SparkSession, d: str) -> DataFrame:
    """The first and last two seconds of recorded videos, of which no other frame is read."""
    f = read_frames(spark, _recorded(spark, d), suffix=".frames", seconds="2")
    return f.select(F.regexp_extract("path", r"u(\d+)\.frames$", 1).cast("long").alias("user_id"), "fps", "total", "frame_idx", "brightness", "bright_ratio", "edge_ratio")


def video_lengths(spark: SparkSession, d: str) -> DataFrame:
    """Their lengths in seconds, 0 where the probe fails."""
    f = read_frames(spark, _recorded(spark, d), suffix=".frames", frames="false")
    return f.select(F.regexp_extract("path", r"u(\d+)\.frames$", 1).cast("long").alias("user_id"), F.coalesce(F.try_divide("total", "fps"), F.lit(0.0)).alias("duration_s"))


def sparse_frames(spark: SparkSession, d: str) -> DataFrame:
    """Every 0.3 s of the first three, at ten frames a second."""
    return R.sparse_frames(_frames(spark, d), 10.0).select("user_id", "frame_idx")


def classified_trim(spark: SparkSession, d: str) -> DataFrame:
    """Frames classed by what happened, with a value as confidence."""
    f = read(spark, d, "events").select("user_id", F.col("event_id").cast("double").alias("t"), F.when(F.col("event_type") == "view", "normal").otherwise(F.col("event_type")).alias("label"), (F.col("value") / 100).alias("confidence"))
    return R.classified_trim(f, ["user_id"])


def sampled_tracks(spark: SparkSession, d: str) -> DataFrame:
    """The draws, whose number and bounds hold whatever was drawn."""
    t = read(spark, d, "part").select(F.col("p_partkey").cast("string").alias("path"), (F.col("p_size") * 10).cast("long").alias("n_frames"))
    s = A.sampled_chunks(spark, t, 5000, 100, 11).join(t, "path")
    ok = (F.col("offset") >= 0) & (F.col("offset") <= F.greatest(F.col("n_frames") - 100, F.lit(0)))
    return s.agg(F.count(F.lit(1)).alias("draws"), F.countDistinct("draw").alias("distinct_draws"), F.bool_and(ok).alias("within"))


def kept_table(spark: SparkSession, d: str) -> DataFrame:
    """Intervals computed once: what would be computed the second time is not."""
    path = scratch_path(spark, "kept")
    first = lambda: _clips(spark, d).select("episode", "clip_ord", "duration_s")
    K.read_through(spark, path, first)
    return K.read_through(spark, path, lambda: first().where("false"))


def log_lines(spark: SparkSession, d: str) -> DataFrame:
    """K13."""
    return K.results_log(A.metric_summary(_metric_rows(spark, d), spark.createDataFrame([("O",), ("F",)], "instrument string")))


def archived_names(spark: SparkSession, d: str) -> DataFrame:
    """Files moved below a new root, the taken names with a stamp."""
    c = _clips(spark, d).select("episode", "clip_ord", F.concat(F.lit("v"), F.col("clip_ord").cast("string"), F.when(F.col("clip_ord") % 2 == 0, ".tar.mp4").otherwise("")).alias("name"))
    got = K.archive_names(c, c.where("clip_ord < 5").select("name"), "name", "0102")
    return got.select("episode", "clip_ord", K.moved_path(F.concat(F.lit("/old/x/"), "target"), "/new/").alias("path"))


def payload_samples(spark: SparkSession, d: str) -> DataFrame:
    """Posted bytes of four-byte samples; another length is refused."""
    e = read(spark, d, "embeddings").select("vec_id", F.when(F.col("vec_id") % 3 == 0, F.unhex(F.lit("0000803F0000"))).when(F.col("vec_id") % 3 == 1, F.unhex(F.lit("0000803F000000C0"))).otherwise(F.unhex(F.lit(""))).alias("data"))
    got = W.payloads(e, ["vec_id"], "data")
    return got.select("vec_id", F.col("samples").isNotNull().alias("ok"), F.array_join(F.col("samples").cast("array<string>"), ",").alias("samples"))


#: Samples of a chunk and fixed values of the stream below.
STREAM_CHUNK = 40


def _letters(samples: list[float], prefix: str) -> str:
    return prefix + "".join("abcdefgh"[int(v) % 8] for v in samples[len(prefix) :])


def transcribed_stream(spark: SparkSession, d: str) -> DataFrame:
    """The words of an episode as a stream of samples in several files, in chunks of forty samples; the last row of an episode ends it."""
    src, out, at = (scratch_path(spark, x) for x in ("stream-in", "stream-out", "stream-state"))
    w = _words(spark, d, "episode").withColumn("seq", F.row_number().over(Window.partitionBy("episode").orderBy("word_ord", "start_time", "end_time", "text")) - 1)
    last = F.lead("seq").over(Window.partitionBy("episode").orderBy("seq")).isNull()
    rows = w.select(F.col("episode").alias("session_id"), F.col("seq").cast("long").alias("seq"), F.array(F.length("text").cast("double"), (F.col("word_ord") % 100).cast("double")).alias("samples"), last.alias("is_end"))
    rows.repartitionByRange(4, "seq").write.parquet(src)
    own = spark.newSession()  # settings of the stream stay its own
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    # A row of the result holds the text of a session so far: a Parquet writer looks at its memory after each, since rows before tell nothing of the size of the next.
    for part in ("page", "block"):
        own.conf.set(f"parquet.{part}.size.row.check.min", "1")
        own.conf.set(f"parquet.{part}.size.row.check.max", "1")
    stream = own.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(src)
    got = W.transcribe_stream(stream, STREAM_CHUNK / W.SAMPLE_RATE, _letters, 2, 5, short=True)
    q = got.writeStream.outputMode("update").foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}")).option("checkpointLocation", at).trigger(availableNow=True).start()
    q.awaitTermination()
    return W.whole_texts(own.read.schema(f"{W.CHANGES}, batch long").parquet(out), ["batch", "step", "finished"])


QUERIES = {f.__name__: f for f in (
    frame_dialogues, srt_strict, media_listing, numbered_texts, script_json_texts, music_tag_files, music_choice, track_listing, training_lines, latest_checkpoint, word_list, edge_frames, frame_source, video_lengths, sparse_frames,
    classified_trim, sampled_tracks, kept_table, log_lines, archived_names, payload_samples, transcribed_stream,
)}

_C = "c AS (SELECT DISTINCT episode, cue_ord, text, start_time, end_time FROM cue WHERE start_time IS NOT NULL AND end_time IS NOT NULL AND text IS NOT NULL)"
_CL = "cl AS (SELECT episode, clip_ord, max(file) AS file, coalesce(max(duration_s), 0.0) AS duration_s FROM clip GROUP BY ALL)"
_S = "sc AS (SELECT episode, line_ord, max({'speaker': speaker, 'line': line, 'raw': raw}) AS v FROM script_line GROUP BY ALL), s AS (SELECT episode, line_ord, v.speaker AS speaker, v.line AS line FROM sc)"
_FR = "f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_idx, count(*) OVER (PARTITION BY user_id) AS n FROM events WHERE value IS NOT NULL)"
_NAMES = "list_transform(range(12), lambda i: 'clip' || i || '.{}')"
SQL = {
    "frame_dialogues": rf"""WITH {_S}, w AS (SELECT *, CASE WHEN regexp_replace(coalesce(speaker, ''), '[\s\x{{3000}}]+', '', 'g') = '' THEN '甲' ELSE regexp_replace(speaker, '[\s\x{{3000}}]+', '', 'g') END AS a FROM s WHERE line IS NOT NULL),
        n AS (SELECT *, lead(a) OVER o AS b, lead(line) OVER o AS nx FROM w WINDOW o AS (PARTITION BY episode ORDER BY line_ord)), k AS (SELECT * FROM n WHERE nx IS NOT NULL),
        r AS (SELECT episode, line_ord, 1 AS i, a AS speaker, line FROM k WHERE line_ord % 3 = 0 AND line <> '' UNION ALL SELECT episode, line_ord, 2, b, nx FROM k WHERE line_ord % 3 = 0 AND nx <> ''
          UNION ALL SELECT episode, line_ord, 1, '旁白', line || '。' FROM k WHERE line_ord % 3 = 1 UNION ALL SELECT episode, line_ord, 2, '旁白', nx FROM k WHERE line_ord % 3 = 1 AND nx <> '')
        SELECT episode, line_ord, CAST(row_number() OVER (PARTITION BY episode, line_ord ORDER BY i) - 1 AS INTEGER) AS ord, speaker, line FROM r""",
    "srt_strict": f"""WITH {_C}, k AS (SELECT * FROM c WHERE start_time BETWEEN 0 AND 3599 AND end_time BETWEEN 0 AND 3599 AND text <> '' AND text = trim(text))
        SELECT episode, CAST(row_number() OVER (PARTITION BY episode ORDER BY cue_ord, start_time, end_time, text) - 1 AS INTEGER) AS i, round(floor(start_time) + floor((start_time % 1) * 1000) / 1000, 3) AS start, round(floor(end_time) + floor((end_time % 1) * 1000) / 1000, 3) AS end, text FROM k""",
    "media_listing": f"""WITH n AS (SELECT r_regionkey, unnest(list_concat({_NAMES.format('mp4')}, {_NAMES.format('MKV')}, {_NAMES.format('wav')})) AS name FROM region)
        SELECT 'r' || r_regionkey AS folder, name, CAST(r_regionkey + 1 AS BIGINT) AS length, CAST(row_number() OVER (PARTITION BY r_regionkey ORDER BY regexp_extract(name, '\\d+')::INT, lower(name), name) - 1 AS INTEGER) AS ord FROM n""",
    "numbered_texts": f"WITH {_S} SELECT '/x/' || episode AS folder, string_agg(line, chr(10) ORDER BY line_ord) AS text FROM s WHERE line IS NOT NULL AND line_ord % 7 <> 6 GROUP BY 1",
    "script_json_texts": f"""WITH {_S}, n AS (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY line_ord) - 1 AS i, (length(episode) + count(*) OVER (PARTITION BY episode)) % 3 AS k FROM s WHERE line IS NOT NULL)
        SELECT episode AS path, CAST(CASE WHEN k = 2 THEN 1 ELSE i END AS INTEGER) AS ord, line || chr(10) || line AS text FROM n WHERE k = 1 OR i = 0""",
    "music_tag_files": """WITH m AS (SELECT replace(folder, '/', '_') AS folder, file, max(energy) AS e, max(vocal) AS v FROM music_tag WHERE folder IS NOT NULL AND file IS NOT NULL GROUP BY 1, 2), f AS (SELECT *, min(file) OVER (PARTITION BY folder) AS first FROM m)
        SELECT folder, file, CASE WHEN file = first THEN '最高' ELSE e END AS energy, CASE WHEN file <> first THEN v END AS vocal, CASE WHEN file <> first THEN '古筝|' || file END AS style FROM f""",
    "music_choice": f"WITH {_CL} SELECT episode AS path, 'g' AS genre, CAST(row_number() OVER (PARTITION BY episode ORDER BY clip_ord) - 1 AS INTEGER) AS sel_ord, file, (CASE WHEN clip_ord % 2 = 0 THEN clip_ord * 5.0 ELSE -1.0 END)::DOUBLE AS start_percent FROM cl",
    "track_listing": r"""WITH f AS (SELECT '/data/' || regexp_replace(p_brand, '\W', '_', 'g') || '/' || p_partkey || '.x.wav' AS path, p_partkey || '.x' AS stem, regexp_replace(p_brand, '\W', '_', 'g') AS parent FROM part)
        SELECT path, stem AS instrument, parent AS song, 1 AS layout FROM f UNION ALL SELECT path, parent, stem, 2 FROM f""",
    "training_lines": f"WITH {_C} SELECT CASE WHEN cue_ord % 2 = 0 THEN '说' ELSE '' END AS prompt, concat_ws('-', episode, cue_ord, start_time, end_time) AS audio, text AS target FROM c",
    "latest_checkpoint": "SELECT 'checkpoint-' || max(o_orderkey) AS name, max(o_orderkey) AS step FROM orders WHERE o_orderkey % 2 = 0 HAVING count(*) > 0",
    "word_list": f"WITH {_S} SELECT line AS word, count(*) AS n FROM s WHERE line <> '' GROUP BY 1",
    "edge_frames": f"WITH {_FR} SELECT user_id, CAST(frame_idx AS INTEGER) AS frame_idx FROM f WHERE frame_idx < 4 OR frame_idx >= n - 4",
    "frame_source": """WITH f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n, value AS v, event_type FROM events WHERE value IS NOT NULL)
        SELECT user_id, 2.0::DOUBLE AS fps, n AS total, i AS frame_idx, v AS brightness, v / 400 AS bright_ratio, CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END::DOUBLE AS edge_ratio FROM f WHERE user_id % 7 <> 0 AND (i < 4 OR i >= n - 4)
        UNION ALL SELECT user_id, 0.0, 0, NULL, NULL, NULL, NULL FROM f WHERE user_id % 7 = 0 GROUP BY user_id""",
    "video_lengths": "SELECT user_id, CASE WHEN user_id % 7 = 0 THEN 0.0 ELSE count(*) / 2.0 END::DOUBLE AS duration_s FROM events WHERE value IS NOT NULL GROUP BY 1",
    "sparse_frames": f"WITH {_FR} SELECT user_id, CAST(frame_idx AS INTEGER) AS frame_idx FROM f WHERE frame_idx IN (0, 3, 6, 9, 12, 15, 18, 21, 24, 27)",
    "classified_trim": """SELECT user_id, coalesce(min(event_id) FILTER (WHERE event_type = 'view' AND value / 100 > 0.85), max(event_id) FILTER (WHERE event_type <> 'view') + 0.3)::DOUBLE AS start_trim FROM events GROUP BY 1""",
    "sampled_tracks": "SELECT 5000 AS draws, 5000 AS distinct_draws, true AS within",
    "kept_table": f"WITH {_CL} SELECT episode, clip_ord, duration_s FROM cl",
    "log_lines": """SELECT printf('Instr %s %s: %.4f (Std: %.4f)', i, f, avg(l_extendedprice), stddev_pop(l_extendedprice)) AS value FROM (SELECT DISTINCT l_returnflag AS f FROM lineitem), (VALUES ('O'), ('F')) x(i), lineitem
        WHERE l_returnflag = f AND l_linestatus = i GROUP BY i, f""",
    "archived_names": f"""WITH {_CL} SELECT episode, clip_ord, '/new/v' || clip_ord || CASE WHEN clip_ord >= 5 THEN CASE WHEN clip_ord % 2 = 0 THEN '.tar.mp4' ELSE '' END WHEN clip_ord % 2 = 0 THEN '.tar_0102.mp4' ELSE '_0102' END AS path FROM cl""",
    "payload_samples": "SELECT vec_id, vec_id % 3 <> 0 AS ok, CASE vec_id % 3 WHEN 1 THEN '1.0,-2.0' WHEN 2 THEN '' END AS samples FROM embeddings",
    "transcribed_stream": f"""WITH w AS (SELECT DISTINCT episode, word_ord, text, start_time, end_time FROM word WHERE start_time IS NOT NULL AND end_time IS NOT NULL AND text IS NOT NULL),
        x AS (SELECT episode, 'abcdefgh'[length(text) % 8 + 1] || 'abcdefgh'[word_ord % 100 % 8 + 1] AS t, row_number() OVER (PARTITION BY episode ORDER BY word_ord, start_time, end_time, text) AS i FROM w),
        t AS (SELECT episode, string_agg(t, '' ORDER BY i) AS t, count(*) * 2 AS n FROM x GROUP BY 1),
        s AS (SELECT episode, t, n, unnest(range(1, n // {STREAM_CHUNK} + 1)) AS step FROM t),
        r AS (SELECT episode, step, step * {STREAM_CHUNK} AS m, t, n, false AS finished FROM s UNION ALL SELECT episode, ceil(n / {STREAM_CHUNK})::BIGINT, n, t, n, true FROM t)
        SELECT episode AS session_id, step, m AS n_samples, left(t, m) AS text, finished, 0::BIGINT AS missing FROM r""",
}
