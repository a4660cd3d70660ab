"""What the queries do not show: errors, sampling, empty tables, ties."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reelframe.functions import records as R
from reelframe.operators import aggregates as A
from reelframe.operators import joins as J
from reelframe.operators import timeline as W
from reelframe.sources import readers

WORDS = "episode string, word_ord long, text string, start_time double, end_time double"


def test_errors(spark):
    one = spark.range(1)
    with pytest.raises(PySparkException):
        one.select(R.json_argument(F.lit("[1]"))).collect()
    with pytest.raises(PySparkException):
        one.select(W.block_bounds(F.lit(10), 3)).collect()
    assert one.select(R.json_argument(F.lit(None).cast("string")).alias("x")).first().x == "{}"
    got = one.select(W.block_bounds(F.lit(12), 4).alias("x")).first().x
    assert [(r["start"], r["end"]) for r in got] == [(0, 3), (3, 6), (6, 9), (9, 12)]
    items = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    with pytest.raises(PySparkException):
        R.broadcast_setting(items, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), "k", "v").collect()
    own = R.broadcast_setting(items, spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string"), "k", "v").collect()
    assert {r.k: r.v for r in own} == {1: "a", 2: "b", 3: "c"}
    with pytest.raises(ValueError):
        A.ensemble(items, [], "k", "k", "k", "k", "none")
    with pytest.raises(ValueError):
        readers.track_files(items, 9)


def test_sampling(spark):
    tracks = spark.createDataFrame([("a", 100), ("b", 5)], "path string, n_frames long")
    got = A.sampled_chunks(spark, tracks, 200, 10, 7).collect()
    assert len(got) == 200 and {r.path for r in got} == {"a", "b"}
    assert all(0 <= r.offset <= 90 for r in got if r.path == "a") and all(r.offset == 0 for r in got if r.path == "b")
    assert sorted(map(tuple, got)) == sorted(map(tuple, A.sampled_chunks(spark, tracks, 200, 10, 7).collect()))
    assert A.sampled_chunks(spark, tracks.where("false"), 5, 10, 7).count() == 0
    from collections import Counter

    many = spark.createDataFrame([(f"t{i}", 10) for i in range(40)], "path string, n_frames long")
    n = Counter(r.path for r in A.sampled_chunks(spark, many, 8000, 10, 3, buckets=8).collect())
    assert len(n) == 40 and min(n.values()) > 120 and max(n.values()) < 290  # 200 each, but for chance
    chunks = spark.createDataFrame([(i, "v", [float(i)] * 2) for i in range(4)], "draw long, instrument string, values array<double>")
    assert {r.draw: r["values"][0] for r in A.mixup(chunks, 1.1, 3).collect()} == {0: 0.5, 1: 1.5, 2: 2.5, 3: 3.0}
    assert {r.draw: r["values"][0] for r in A.mixup(chunks, 0.0, 3).collect()} == {0: 0.0, 1: 1.0, 2: 2.0, 3: 3.0}


def test_gap_boundaries(spark):
    rows = [("e", 0, "甲", 0.0, 1.0), ("e", 1, "乙", 1.4, 2.0), ("e", 2, "丙", 2.5, 3.0)]
    df = spark.createDataFrame(rows, WORDS)
    got = W.gap_sessions(df, ["episode"], ["word_ord"], "start_time", "end_time", 0.5).orderBy("word_ord").collect()
    assert [r.session for r in got] == [1, 1, 2]
    assert W.pause_annotation(df, ["episode"], ["word_ord"]).first().sequence == "甲[0.4s]乙[0.5s]丙"
    assert W.gap_sessions(df.where("false"), ["episode"], ["word_ord"], "start_time", "end_time", 0.5).count() == 0


def test_runs_over_all_dark(spark):
    f = spark.createDataFrame([("a", i, 10.0, False) for i in range(5)], "clip string, frame_idx long, brightness double, has_text boolean")
    assert W.leading_run(f, ["clip"], "frame_idx", F.col("brightness") < 50).first().n == 5
    assert W.trailing_run(f, ["clip"], "frame_idx", F.col("brightness") < 50, 1).count() == 0
    t = W.trim_decision(f, ["clip"], 30.0).first()
    assert t.end_trim is None and t.start_trim == pytest.approx(5 / 30)


def test_trim_decision(spark):
    schema = "clip string, frame_idx long, brightness double, has_text boolean"
    head = [("h", i, 10.0 if i < 6 else 200.0, False) for i in range(300)]
    fade = [("f", i, 10.0 if i < 6 else 60.0 if i < 12 else 200.0, False) for i in range(300)]
    text = [("t", i, 10.0 if i < 6 else 200.0, i == 3) for i in range(300)]
    tail = [("x", i, 200.0 if i < 290 else 5.0, False) for i in range(300)]
    got = {r.clip: (r.start_trim, r.end_trim) for r in W.trim_decision(spark.createDataFrame(head + fade + text + tail, schema), ["clip"], 30.0).collect()}
    assert got == {"h": (6 / 30, None), "f": (12 / 30, None), "t": (None, None), "x": (None, 290 / 30)}


def test_nearest_ties_and_absence(spark):
    a = spark.createDataFrame([("u", 1, 10), ("u", 2, 0), ("v", 3, 5)], "k string, l int, t int")
    b = spark.createDataFrame([("u", 7, 8), ("u", 8, 12), ("u", 9, 12), ("u", 6, None)], "k string, r int, s int")
    got = {r.l: (r.r, r.distance) for r in J.nearest(a, b, ["k"], "l", "t", "r", "s").collect()}
    assert got == {1: (7, 2), 2: (7, 8), 3: (None, None)}


def test_best_lines_first_of_equals(spark):
    cues = spark.createDataFrame([("e", 0, "走了吧"), ("e", 1, "好"), ("e", 2, None), ("g", 0, "走了")], "episode string, cue_ord int, text string")
    lines = spark.createDataFrame([("e", 0, "他走了"), ("e", 1, "走了他"), ("e", 2, None)], "episode string, line_ord int, line string")
    got = {(r.episode, r.cue_ord): (r.match_li, round(r.match_score, 4)) for r in J.best_lines(cues, lines, ["episode"], "cue_ord", "line_ord").collect()}
    assert got == {("e", 0): (0, 0.6667), ("e", 1): (-1, 0.0), ("e", 2): (-1, 0.0), ("g", 0): (-1, 0.0)}


def test_intervals_hold_both_ends(spark):
    p = spark.createDataFrame([("e", 1, 10.0), ("e", 2, 20.0), ("e", 3, 20.1), ("e", 4, None), (None, 5, 15.0)], "episode string, i int, t double")
    iv = spark.createDataFrame([("e", 10.0, 20.0), ("e", 30.0, 5.0), (None, 10.0, 20.0)], "episode string, s double, e double")
    inside = J.point_in_intervals(p, iv, ["episode"], F.col("t"), F.col("s"), F.col("e"))
    assert sorted(r.i for r in inside.collect()) == [1, 2]
    assert sorted(r.i for r in J.not_covered(p, iv, ["episode"], F.col("t"), F.col("s"), F.col("e")).collect()) == [3, 4]


def test_macro_average_keeps_nan(spark):
    v = spark.createDataFrame([("sdr", "vocals", 1.0), ("sdr", "vocals", 3.0)], "metric string, instrument string, value double")
    i = spark.createDataFrame([("vocals",), ("drums",)], "instrument string")
    got = {r.instrument: r.mean for r in A.metric_summary(v, i).collect()}
    assert got["vocals"] == 2.0 and got["drums"] != got["drums"]
    m = A.macro_average(A.metric_summary(v, i)).first().macro
    assert m != m


def test_buckets_change_nothing(spark):
    """Neighbours and sessions across buckets of any size equal those of one window."""
    import random

    rng = random.Random(6)
    rows, t = [], 0.0
    for i in range(300):
        t += rng.choice([0.1, 0.2, 0.6])
        rows.append((rng.choice(["e", "e", "f"]), i, "字", round(t, 2), round(t + rng.choice([0.05, 0.3]), 2)))
    df = spark.createDataFrame(rows, WORDS)
    for size in (1, 7, 1000):
        b = F.floor(F.col("word_ord") / size)
        for f, args in ((W.gap_sessions, ("start_time", "end_time", 0.3)), (W.truncate_overlaps, (0.1,)), (W.resolve_overlaps, ())):
            whole = f(df, ["episode"], ["word_ord"], *args).select("episode", "word_ord", "end_time", *(["session"] if args[-1:] == (0.3,) else []))
            parts = f(df, ["episode"], ["word_ord"], *args, bucket=b).select(whole.columns)
            assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
        odd = df.unionByName(spark.createDataFrame([(None, 5, "甲", 1.0, 1.2), (None, 6, "甲", 1.1, 1.3), ("e", None, "乙", 2.0, 2.1), (None, None, None, None, None)], WORDS))
        for f, args in ((W.gap_sessions, ("start_time", "end_time", 0.3)), (W.truncate_overlaps, (0.1,)), (W.drop_consecutive, (F.col("text"),))):
            whole = f(odd, ["episode"], ["word_ord"], *args)
            parts = f(odd, ["episode"], ["word_ord"], *args, bucket=b).select(whole.columns)
            assert sorted(map(repr, whole.collect())) == sorted(map(repr, parts.collect()))
        one = W.pause_annotation(df, ["episode"], ["word_ord"]).collect()
        assert sorted(map(tuple, one)) == sorted(map(tuple, W.pause_annotation(df, ["episode"], ["word_ord"], bucket=b).collect()))
