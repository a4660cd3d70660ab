"""Readers, writers, spectra, streams, adapters and the pipeline."""

import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelframe.operators import spectra as X
from reelframe.plans import adapters, pipeline
from reelframe.sources import readers as R
from reelframe.sources import writers as K
from reelframe.streaming import count_window as W

SRT = "1\n00:00:01,500 --> 00:00:02,000\n走了\n好的\n\n2\n0:00:03.25 --> 0:00:04.5\n来人\n\n3\n00:00:05,000 --> 00:00:06,000\n \n"


def test_srt(spark, tmp_path):
    (tmp_path / "a.srt").write_text(SRT, encoding="utf-8")
    got = [tuple(r)[1:] for r in R.read_srt(spark, str(tmp_path)).orderBy("cue_ord").collect()]
    assert got == [(0, 1.5, 2.0, "走了 好的"), (1, 3.25, 4.5, "来人")]
    strict = [(r.start, r.end, r.text) for r in R.read_srt(spark, str(tmp_path), True).orderBy("cue_ord").collect()]
    assert strict[0] == (1.5, 2.0, "走了\n好的")
    cues = spark.createDataFrame([("e", 1, "乙", 3.0, 4.0), ("e", 0, "甲", 1.2345, 2.0)], "ep string, cue_ord int, text string, start_time double, end_time double")
    srt = K.srt_text(cues, ["ep"], ["cue_ord"]).first().srt
    assert srt == "1\n00:00:01,234 --> 00:00:02,000\n甲\n\n2\n00:00:03,000 --> 00:00:04,000\n乙\n\n"
    j = json.loads(K.result_json(cues, ["ep"], ["cue_ord"]).first().json)
    assert j["total"] == 2 and j["subtitles"][1]["duration"] == 1.0
    K.write_texts(K.srt_text(cues, ["ep"], ["cue_ord"]), "ep", "srt", str(tmp_path / "out"))
    assert next((tmp_path / "out" / "ep=e").glob("*.txt")).read_text(encoding="utf-8") == srt


def test_scripts(spark):
    t = spark.createDataFrame([("a", "第1集\n1-1\n地点：天台 夜\n王猛（怒）：小子，站住！\n【旁白】夜深了\n△动作：无\n一个很长很长的名字啊：走\n李霄: ok\n\n李霄：好。")], "ep string, text string")
    assert [(r.line_ord, r.speaker, r.line) for r in R.script_lines(t, ["ep"]).orderBy("line_ord").collect()] == [(0, "地点", "天台夜"), (1, "王猛", "小子站住"), (2, "旁白", "夜深了"), (3, "李霄", "好")]


@pytest.mark.parametrize(
    "content,want",
    [
        ("台词：甲：走吧，乙：好的", [("甲", "走吧"), ("乙", "好的")]),
        ("- 台词：甲（急）：“站住！”；乙: 「走。」", [("甲", "站住！"), ("乙", "走。")]),
        ("台词：甲：“走吧，我们一起”", [("甲", "走吧，我们一起")]),  # no role behind the comma
        ("台词：甲：“站住！”李霄：“走。”", [("甲", "站住！”李霄：“走。")]),  # nothing that parts them
        ("台词：无", []),
        ("台词：无（动作替代台词）", []),
        ("  台词：“好？走！”", [("旁白", "好？"), ("旁白", "走！")]),
        ("台词：他说“一句。两句”然后「三句」", [("旁白", "一句。"), ("旁白", "两句"), ("旁白", "三句")]),
        ("台词：好？走！", []),  # neither a role nor a quote
        ("台词：甲：“”", []),
        ("画面：甲：走", []),
        (None, []),
    ],
)
def test_frame_dialogues(spark, content, want):
    d = spark.createDataFrame([("a", content if content is None else f"画面\r\n{content}\n镜头")], "ep string, text string")
    assert [(r.speaker, r.line) for r in R.frame_dialogues(d, ["ep"]).orderBy("ord").collect()] == want


def test_json_sources(spark):
    f = spark.createDataFrame(
        [("/r/completed/x/music_tags.json", '{"a.mp3": {"emotion": ["热血"], "energy": "高"}}'), ("/r/x/music_tags.json", '{"a.mp3": {"emotion": ["旧"]}, "b.mp3": {"style": ["古筝"]}}'), ("/r/y/music_tags.json", "broken")],
        "path string, text string",
    )
    got = {(r.folder, r.file): r.emotion for r in R.music_tags(f).collect()}
    assert got == {("x", "a.mp3"): ["热血"], ("x", "b.mp3"): None}
    m = spark.createDataFrame([("p", '[{"file": "1.mp4", "duration_s": 2.5, "trim_first_frame": true}, {"file": "2.mp4", "trim_frames": 10}]'), ("q", "no")], "path string, text string")
    assert [(r.clip_ord, r.trim_frames) for r in R.clip_manifests(m).orderBy("clip_ord").collect()] == [(0, 1), (1, 10)]
    s = spark.createDataFrame([("p", '{"剧情正文": "一  二"}'), ("q", '[{"剧情正文": "三"}, {}]')], "path string, text string")
    assert sorted(r.text for r in R.script_json_texts(s).collect()) == ["一\n二", "三"]
    n = spark.createDataFrame([("/d/10.txt", "乙"), ("/d/2.txt", "甲"), ("/d/x.txt", "丙")], "path string, text string")
    assert R.numbered_texts(n).first().text == "甲\n乙"
    c = spark.createDataFrame([("checkpoint-9",), ("checkpoint-10",), ("x",)], ["name"])
    assert tuple(R.latest_checkpoint(c).first()) == ("checkpoint-10", 10)
    sel = spark.createDataFrame([("p", '{"genre": "g", "selections": [{"file": "a"}, {"file": "b", "start_percent": 40}]}')], "path string, text string")
    assert [r.start_percent for r in R.music_selections(sel).orderBy("sel_ord").collect()] == [-1.0, 40.0]


def test_files(spark, tmp_path):
    for name in ("clip10.mp4", "clip2.mp4", "x.txt"):
        (tmp_path / name).write_bytes(b"0")
    assert [r.name for r in R.media_files(spark, str(tmp_path), ("mp4", "avi")).orderBy("ord").collect()] == ["clip2.mp4", "clip10.mp4"]
    (tmp_path / "t.csv").write_text("instrum,path\nvocals,/a.wav\n")
    assert tuple(R.track_csv(spark, str(tmp_path / "t.csv")).first())[:2] == ("/a.wav", "vocals")
    calls = []
    p = str(tmp_path / "kept")
    for _ in range(2):
        got = K.read_through(spark, p, lambda: calls.append(1) or spark.range(3))
        assert got.count() == 3
    assert len(calls) == 1
    new, old = spark.createDataFrame([("a.mp4",), ("b.mp4",)], ["n"]), spark.createDataFrame([("a.mp4",)], ["n"])
    assert {r.n: r.target for r in K.archive_names(new, old, "n", "t1").collect()} == {"a.mp4": "a_t1.mp4", "b.mp4": "b.mp4"}


def test_spectra():
    rng = np.random.default_rng(1)
    x = rng.normal(size=20_000)
    w = X.hann(2048)
    assert np.allclose(X.istft(X.stft(x, 2048, 512, w), 512, len(x), w), x, atol=1e-8)
    assert X.l1_freq(x, x) == 100.0 and X.l1_freq(x, 0.5 * x) < 100
    b, f = X.bleed_full(x, x)
    assert (b, f) == (100.0, 100.0)
    b, f = X.bleed_full(x, 2 * x)
    assert b == pytest.approx(100 / (20 * np.log10(2) + 1), rel=1e-6) and f == 100.0
    assert np.allclose(X.fft_ensemble([x, x], [1, 3], "avg"), x, atol=1e-6)
    assert np.allclose(X.fft_ensemble([x, 2 * x], [1, 1], "max"), 2 * x, atol=1e-6)
    assert np.allclose(X.demix(x, lambda c: 0.5 * c, 4000, 4), 0.5 * x, atol=1e-9)
    s = rng.normal(size=(2, 50))
    assert np.allclose(X.tta(s, lambda a: 3 * a), 3 * s)


def test_spectral_metric(spark):
    df = spark.createDataFrame([(1, [1.0] * 3000, [1.0] * 2500), (2, [], []), (3, None, [1.0])], "id int, reference array<double>, estimate array<double>")
    got = {r.id: r.m for r in X.spectral_metric(df, ["id"], X.l1_freq, "m").collect()}
    assert got[1] == 100.0 and got[2] is None and 3 not in got


def decode(samples, prefix):
    return prefix + "".join("abcdefgh"[int(v) % 8] for v in samples[len(prefix) :])


def feed(batches, size=4):
    state, out = (0, [], [], "", 0, []), []
    for b in batches:
        state, got = W.advance(state, b, size, decode, 1, 2)
        out += got
    return out


def test_count_window_does_not_depend_on_batches():
    rows = [(i, [float(3 * i + k) for k in range(i % 4)], False) for i in range(12)] + [(12, [1.0], True)]
    want = feed([rows])
    assert feed([[r] for r in rows]) == want and feed([rows[6:], rows[:6], rows[:3]]) == want
    assert want[-1][3] and want[-1][1] == sum(i % 4 for i in range(12)) + 1
    assert W.fixed_prefix("abc�", 5, 1, 1) == "abc" and W.fixed_prefix("abc", 0, 1, 1) == "" and W.fixed_prefix("ab", 9, 1, 5, True) == "a"
    assert W.chunk_samples(0.00001) == 1 and W.valid_payload(b"123") is None and W.valid_payload(np.float32([1.5]).tobytes()) == [1.5]


def test_count_window_keeps_what_waits_for_a_missing_row():
    """seq 1 never comes: when the session times out, or its end row has come, the samples behind the gap are taken and the gap is counted."""
    state, out = W.advance((0, [], [], "", 0, []), [(0, [1.0], False), (2, [2.0, 3.0], False)], 4, decode, 1, 2)
    assert out == [] and len(state[5]) == 1
    _, out = W.advance(state, [], 4, decode, 1, 2, ended=True)
    assert [(r[1], r[3], r[4]) for r in out] == [(3, True, 1)]
    _, out = W.advance((0, [], [], "", 0, []), [(0, [1.0], True), (3, [2.0] * 4, False)], 4, decode, 1, 2)
    assert [(r[1], r[3], r[4]) for r in out] == [(4, False, 2), (5, True, 2)]
    _, out = W.advance((0, [], [], "", 0, []), [(0, [1.0] * 4, True)], 4, decode, 1, 2)
    assert [(r[1], r[3], r[4]) for r in out] == [(4, False, 0), (4, True, 0)]


def test_stream(spark, tmp_path):
    rows = [(s, i, [float(i)] * 3, i == 4) for s in ("x", "y") for i in range(5)]
    schema = "session_id string, seq long, samples array<double>, is_end boolean"
    for k in range(3):
        spark.createDataFrame([r for i, r in enumerate(rows) if i % 3 == k], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    local = lambda samples, prefix: prefix + "".join("abcdefgh"[int(v) % 8] for v in samples[len(prefix) :])
    out = W.transcribe_stream(stream, 4 / W.SAMPLE_RATE, local, 1, 2)
    q = out.writeStream.outputMode("update").format("memory").queryName("turns").option("checkpointLocation", str(tmp_path / "cp")).start()
    # Timeouts by processing time keep the query busy without input: wait for the last rows instead.
    for _ in range(120):
        if spark.sql("SELECT * FROM turns WHERE finished").count() == 2 or q.exception():
            break
        time.sleep(0.5)
    q.stop()
    got = {}
    for r in spark.sql("SELECT * FROM turns").collect():
        got.setdefault(r.session_id, []).append((r.step, r.n_samples, r.text, r.finished, r.missing))
    want = feed([[(i, x, e) for s, i, x, e in rows if s == "x"]])
    assert {k: sorted(v) for k, v in got.items()} == {"x": want, "y": want}


def test_adapters(spark):
    tries = []

    def flaky():
        tries.append(1)
        if len(tries) < 3:
            raise adapters.ServerError(503)
        return "ok"

    assert adapters.with_retries(flaky, sleep=lambda s: None) == "ok" and len(tries) == 3
    with pytest.raises(adapters.ServerError):
        adapters.with_retries(lambda: (_ for _ in ()).throw(adapters.ServerError(404)), sleep=lambda s: None)
    waits = []
    with pytest.raises(adapters.ServerError):
        adapters.with_retries(lambda: (_ for _ in ()).throw(adapters.ServerError(429)), sleep=waits.append)
    assert waits == [10.0, 20.0]
    fake = adapters.Recorded({'["duration", "a"]': 3.5}, 0.0)
    assert fake.duration("a") == 3.5 and fake.duration("b") == 0.0 and len(fake.asked) == 2
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, None)], "id int, q string")
    got = {r.id: r.a for r in adapters.map_requests(df, ["id"], "q", "a", lambda: (lambda s: s.upper())).collect()}
    assert got == {1: "X", 2: "X", 3: None}


def test_stream_hands_rows_on_while_they_are_made():
    made = []

    def decode(history, prefix):
        made.append(len(history))
        return prefix + "甲" * (len(history) - len(prefix))

    it = W.steps((0, [], [], "", 0, []), [(i, [0.0, 1.0], i == 49) for i in range(50)], 4, decode, 1, 2)
    assert next(it)[:2] == (1, 4) and made == [4]
    assert [r[0] for r in it] == [*range(2, 26), 25] and made == [4 * i for i in range(1, 26)]


def test_videos_share_partitions(tmp_path):
    from reelframe.sources import frames

    for i in range(1000):
        (tmp_path / f"v{i:04}.frames").write_bytes(frames.encoded(2.0, np.full((3, 3), float(i))))
    read = lambda **o: (r := frames._Reader({"path": f"file://{tmp_path}", **o}), r.partitions())
    r, parts = read(seconds="1")
    assert len(parts) == 32
    rows = [x for p in parts for x in r.read(p)]
    assert sorted({x[0][-12:] for x in rows}) == [f"v{i:04}.frames" for i in range(1000)] and len(rows) == 3000
    assert len(read()[1]) == 32  # whole videos: by bytes too
    import unittest.mock as m

    with m.patch.object(frames, "BYTES", 800):
        assert len(read()[1]) == 100 and len(read(seconds="1")[1]) == 32


def test_stream_of_changes_grows_with_its_input(spark, tmp_path):
    """What the stream hands on is as long as what comes in, not as its square, and gives the whole text of each step again."""

    def plain(samples, prefix):
        return prefix + "".join("abcdefgh"[int(v) % 8] for v in samples[len(prefix) :])

    def takes_back(samples, prefix):  # keeps its prefix but at every ninth sample; what follows changes with the length
        k = len(prefix) if len(samples) % 9 else 0
        return prefix[:k] + "".join("甲b𠮷�"[(int(v) + (len(samples) if i > len(samples) - 6 else k % 2)) % 4] for i, v in enumerate(samples[k:], k))

    rows = [(s, i, [float(i * k % 7), float(i % 3)], i == n - 1) for s, n, k in (("x", 1500, 3), ("y", 3, 1), (None, 40, 2)) for i in range(n)]
    schema = "session_id string, seq long, samples array<double>, is_end boolean"
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    for decoder in (plain, takes_back):
        src, out = (str(tmp_path / f"{decoder.__name__}-{x}") for x in ("in", "out"))
        for k in range(2):
            spark.createDataFrame([r for i, r in enumerate(rows) if i % 2 == k], schema).coalesce(1).write.mode("append").parquet(src)
        got = W.transcribe_stream(own.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src), 4 / W.SAMPLE_RATE, decoder, 1, 2, short=True)
        q = got.writeStream.outputMode("update").foreachBatch(lambda b, i, out=out: b.write.parquet(f"{out}/batch={i}")).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start()
        q.awaitTermination()
        changes = spark.read.schema(f"{W.CHANGES}, batch long").parquet(out)
        if decoder is plain:
            assert changes.agg(F.sum(F.length("text"))).first()[0] < 4 * sum(len(r[2]) for r in rows)
        want = [(s, *r) for s in ("x", "y", None) for r in W.advance((0, [], [], "", 0, []), [r[1:] for r in rows if r[0] == s], 4, decoder, 1, 2)[1]]
        whole = W.whole_texts(changes, ["batch", "step", "finished"])
        assert sorted(map(tuple, whole.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("most", [1 << 22, 100, 1])
def test_pieces_of_changes(monkeypatch, most):
    monkeypatch.setattr(W, "PIECE_CHARS", most)
    rng = np.random.default_rng(5)
    text, kept, rest, want = b"", [], [], []
    for _ in range(300):
        k = int(rng.integers(0, len(text) + 1)) if rng.random() < 0.1 else max(0, len(text) - int(rng.integers(0, 4)))
        kept.append(k)
        rest.append(bytes(rng.integers(97, 123, int(rng.integers(0, 9))).tolist()))
        want.append(text := text[:k] + rest[-1])
    got, at, n = [], 0, 0
    for a, b, last, first, own in W.pieces(kept, rest):
        assert a == at and last == want[b - 1] and (b - a == 1 or sum(map(len, own)) <= most)
        got += [last[:k] + x for k, x in zip(first, own, strict=True)]
        at, n = b, n + 1
    assert got == want and (most > 1 or n > W.PIECES)
    assert [x[:2] for x in W.pieces([0, 0], [b"", b""])] == [(0, 2)]


def test_pipeline(spark):
    w = [("e", i, c, round(i * 0.3, 2), round(i * 0.3 + 0.25, 2)) for i, c in enumerate("你说他们没问题")]
    w += [("e", 20, "啊", 9.0, 9.3), ("e", 21, "小", 20.0, 20.2), ("e", 22, "子", 20.2, 20.4)]
    words = spark.createDataFrame(w, "episode string, word_ord long, text string, start_time double, end_time double")
    lines = spark.createDataFrame([("e", 0, "你惹他们没问题"), ("e", 1, "小子")], "episode string, line_ord int, line string")
    got = pipeline.final_cues(words, lines, ["episode"], F.lit(30.0)).orderBy("start_time").collect()
    assert [(r.text, r.end_time) for r in got] == [("你惹他们没问题", 2.05), ("小子", 30.0)]
    cues = spark.createDataFrame([("e", "走了", 0.0, 1.0)], "episode string, text string, start_time double, end_time double")
    saved = pipeline.salvage(cues, words.where("word_ord < 20").withColumn("start_time", F.col("start_time") + 3).withColumn("end_time", F.col("end_time") + 3), ["episode"])
    assert sorted(r.text for r in saved.collect()) == sorted(["走了", "你说他们没问题"])
    assert [r.suspicious for r in pipeline.suspicious(cues.withColumn("text", F.lit("走了吧")).withColumn("end_time", F.lit(9.0))).collect()] == [True]


def test_segments_are_aligned_once(spark, monkeypatch):
    words = spark.createDataFrame([("e", 0, "走了", 0.0, 1.0)], "episode string, word_ord long, text string, start_time double, end_time double")
    segs = spark.createDataFrame([("e", 0, "走了")], "episode string, seg_ord long, text string")
    lines = spark.createDataFrame([("e", 0, "走了")], "episode string, line_ord int, line string")
    plans, split = [], pipeline.J.split_long_cues
    monkeypatch.setattr(pipeline.J, "split_long_cues", lambda cues, *a: (plans.append(cues._jdf.queryExecution().toString()), split(cues, *a))[1])
    assert [r.text for r in pipeline.segment_cues(words, segs, lines, ["episode"]).collect()] == ["走了"]
    assert "FlatMapCoGroups" not in plans[0]  # W26 looks at them twice


def test_pipeline_segments_and_replacements(spark):
    """The main branch: segments take their times from the words, lost words come back, replacements follow the script, captions and the video's end count."""
    at = lambda e, t, s, i0: [(e, i0 + i, c, round(s + i * 0.3, 2), round(s + i * 0.3 + 0.25, 2)) for i, c in enumerate(t)]
    w = at("e", "他丢掉啦那只旧箱子走得很远很远", 0.0, 0) + at("e", "后来我们", 10.0, 20) + at("e", "外面下雨了", 20.0, 30) + at("e", "完了", 30.0, 40)
    w += at("f", "他丢掉啦那只旧箱子", 0.0, 0)  # no segments: W2; the correction passes find the line
    words = spark.createDataFrame(w, "episode string, word_ord long, text string, start_time double, end_time double")
    lines = spark.createDataFrame([(e, i, x) for e in "ef" for i, x in enumerate(["他丢掉了那只旧箱子", "走得很远很远", "外面下雨了", "完了"])], "episode string, line_ord int, line string")
    segs = spark.createDataFrame([("e", i, x) for i, x in enumerate(["他丢掉啦那只旧箱子走得很远很远", "外面下雨了", "完了"])], "episode string, seg_ord int, text string")
    # 4 of 26 characters are in no segment (P18 keeps 85 %)
    cues = pipeline.segment_cues(words, segs, lines, ["episode"]).orderBy("cue_ord").collect()
    assert [(r.text, r.start_time) for r in cues] == [("他丢掉啦那只旧箱子", 0.0), ("走得很远很远", 2.7), ("后来我们", 10.0), ("外面下雨了", 20.0), ("完了", 30.0)]
    pairs = spark.createDataFrame([("e", 0, "掉啦", "掉了"), ("e", 1, "旧箱子", "新箱子")], "episode string, pair_ord int, wrong string, right string")
    hard = spark.createDataFrame([("e", 0, 10.0, 11.5)], "episode string, interval_ord int, s double, e double")
    video = spark.createDataFrame([("e", 40.0), ("f", 0.0)], "episode string, video_s double")
    raw = pipeline.Settings(skip=frozenset({"replace"}))
    got = pipeline.final_cues(words, lines, ["episode"], video, hard, segments=segs, pairs=pairs).orderBy("episode", "start_time").collect()
    assert [(r.episode, r.text, r.start_time) for r in got] == [("e", "他丢掉了那只旧箱子", 0.0), ("e", "走得很远很远", 2.7), ("e", "外面下雨了", 20.0), ("e", "完了", 30.0), ("f", "他丢掉了那只旧箱子", 0.0)]
    few = segs.where("seg_ord = 1")  # 5 of 26 characters: W2 instead
    assert pipeline.final_cues(words, lines, ["episode"], segments=few, settings=raw).count() == pipeline.final_cues(words, lines, ["episode"], settings=raw).count()


def test_replacements_are_gated_and_in_order(spark):
    """P10, J18, H12, P11 against the rule of each."""
    n = 20
    said = ["比赚钱和赚钱", "我们走把"] + ["风"] * (n - 3) + ["我们走把"]
    cues = spark.createDataFrame([("e", i, t, float(i), i + 0.5) for i, t in enumerate(said)], "episode string, cue_ord long, text string, start_time double, end_time double")
    lines = spark.createDataFrame([("e", i, x) for i, x in enumerate(["比赚钱", "我们走吧"] + ["雨"] * (n - 2))], "episode string, line_ord int, line string")
    schema = "episode string, pair_ord int, wrong string, right string"
    run = lambda *ps: [r.text for r in pipeline.replaced(cues, lines, spark.createDataFrame([("e", i, *p) for i, p in enumerate(ps)], schema), ["episode"]).orderBy("cue_ord").collect()]
    got = run(("赚钱", "比赚钱"), ("走把", "走吧"))
    assert got[:2] == ["比赚钱和比赚钱", "我们走吧"] and got[-1] == "我们走把"  # the last is too far from the line
    assert run(("走把", "没有"))[1] == "我们走把"  # not in the script
    # the second pair applies to what the first has made; longest first
    assert run(("走吧", "走雨"), ("们走把", "们走吧"))[1] == "我们走吧"  # 走雨 is not in the script
    assert run(("走把", "走吧"), ("走把", "们走"))[1] == "我们走吧"  # 们走: two edits, invalid; the first stays
