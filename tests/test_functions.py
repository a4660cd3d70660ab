"""Column functions on worked examples and against Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelframe.functions import signal as S
from reelframe.functions import text as T


def one(spark, col, **cols):
    return spark.createDataFrame([tuple(cols.values())], list(cols)).select(col.alias("r")).first()["r"] if cols else spark.range(1).select(col.alias("r")).first()["r"]


CASES = [
    (T.strip_beep, "兵检测到纳灵妖魔", "检测到纳灵妖魔"),
    (T.strip_beep, "兵来将挡", "兵来将挡"),
    (T.strip_trailing_particle, "走了啊", "走了"),
    (T.strip_trailing_particle, "走啊", "走啊"),
    (T.collapse_leading_repeat, "放心放心他暂时退走了", "放心他暂时退走了"),
    (T.collapse_leading_repeat, "放心放心", "放心放心"),
    (T.collapse_char_runs, "啊" * 21 + "b" * 20, "啊" + "b" * 20),
    (T.canonical_language, " cHINese ", "Chinese"),
    (T.canonical_language, " ", None),
    (T.han, "a走b了，", "走了"),
    (T.kept_chars, "don't（好）é1_", "don't好é1"),
    (T.flexible_seconds, "01:02:03.5", 3723.5),
    (T.flexible_seconds, "2:03", 123.0),
    (T.flexible_seconds, "52.3", 52.3),
    (T.flexible_seconds, "x", -1.0),
    (T.srt_seconds, "00:01:02,500", 62.5),
    (T.srt_seconds, "?", 0.0),
    (T.is_interjection, "啊啊啊", True),
    (T.is_interjection, "", True),
    (T.is_interjection, "啊好", False),
    (T.audio_kind, "https://a.b/c", "url"),
    (T.audio_kind, "data:audio/wav;base64,QUJD", "base64"),
    (T.audio_kind, "/a/b.wav", "path"),
    (T.episode_number, "第12集", 12),
    (T.episode_number, "show 07", 7),
    (T.episode_number, "x", None),
    (T.checkpoint_step, "checkpoint-300", 300),
    (T.without_front_matter, "---\na: 1\n---\nbody", "body"),
    (T.base_name, "/a/b/c.mp4", "c.mp4"),
    (T.title_case, "no_vocal  MIX", "No Vocal Mix"),
]


@pytest.mark.parametrize("f,x,want", CASES, ids=[f"{f.__name__}-{i}" for i, (f, *_) in enumerate(CASES)])
def test_strings(spark, f, x, want):
    assert one(spark, f(F.lit(x))) == want


def test_more_strings(spark):
    o = one(spark, T.model_output(F.lit("language cHINese<asr_text> 走 ")))
    assert (o.language, o.text) == ("Chinese", "走")
    o = one(spark, T.model_output(F.lit("language None<asr_text>")))
    assert (o.language, o.text) == ("", "")
    assert tuple(one(spark, T.model_output(F.lit("plain")))) == ("", "plain")
    assert tuple(one(spark, T.model_output(F.lit(None).cast("string")))) == ("", "")
    assert one(spark, T.merged_languages(F.array(F.lit("Chinese"), F.lit(" "), F.lit("English"), F.lit("English"), F.lit(None)))) == "Chinese,English"
    assert one(spark, T.tokens(F.lit("走 don't 中a文 ，"))) == ["走", "don't", "中", "a", "文"]
    assert one(spark, T.replace_in_order(F.lit("比赚钱，赚钱"), [("赚钱", "比赚钱")])) == "比赚钱，比赚钱"
    assert one(spark, T.expand_placeholders(F.lit("a<|x|>b<|x|>"), "<|x|>", F.array(F.lit(2), F.lit(1)))) == "a<|x|><|x|>b<|x|>"
    assert one(spark, T.manual_junctions(F.lit("3,7,x,99, 1"), 9)) == [2, 6, 0]
    assert one(spark, T.json_object_text(F.lit('```json\n{"a": [1, ...]}\n```'))) == '{"a": [1]}'
    assert one(spark, T.segments(F.lit("1. 王猛：小子[0.4s]站住\n2、走\n\n"))) == ["小子站住", "走"]
    assert tuple(one(spark, T.replacement_pair(F.lit("赚的 -> 赚得")))) == ("赚的", "赚得")
    assert tuple(one(spark, T.padded_range(F.lit("00:00:09.2–11")))) == (8.7, 11.5)
    assert one(spark, T.original_position(F.lit("a走，了"), 1)) == 3
    assert one(spark, T.prompt(F.lit("p"), F.lit("english"))) == "planguage English<asr_text>"
    assert one(spark, T.srt_time(F.lit(3661.9996))) == "01:01:01,999"
    assert one(spark, T.keep_unless_halved(F.lit("一二三四"), F.lit("一二"))) == "一二三四"
    names = ["clip10.mp4", "Clip2.mp4", "clip1.mp4", "10.mp4", "9.mp4"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], ["n"]).orderBy(T.natural_key("n")).collect()]
    assert got == ["9.mp4", "10.mp4", "clip1.mp4", "Clip2.mp4", "clip10.mp4"]


def test_lcs_columns(spark):
    from reelframe.operators.sequence import lcs, ordered_ratio

    rng = random.Random(2)
    rows = [tuple("".join(rng.choices("甲乙丙", k=rng.randint(0, 8))) for _ in "ab") for _ in range(80)]
    for r in spark.createDataFrame(rows, ["a", "b"]).select("a", "b", T.lcs_ratio("a", "b").alias("r"), T.ordered_share("a", "b").alias("o")).collect():
        assert r.r == (lcs(r.a, r.b) / max(len(r.a), len(r.b)) if r.a and r.b else 0.0)
        assert r.o == pytest.approx(ordered_ratio(r.a, r.b))


def test_signal(spark):
    arr = lambda xs: F.array(*[F.lit(float(x)) for x in xs])
    assert one(spark, S.fade_window(10, 3)) == [0, 0.5, 1, 1, 1, 1, 1, 1, 0.5, 0]
    assert one(spark, S.fixed_chunk(arr([1, 2, 3]), 1, 4)) == [2, 3, 0, 0]
    assert one(spark, S.peak_normalised(arr([2, -4]))) == [0.5, -1.0]
    assert one(spark, S.linear_resample(arr([0, 1, 2, 3]), 2, 4)) == [0, 0.5, 1, 1.5, 2, 2.5, 3, 3]
    r, e = np.array([1.0, -2, 0.5]), np.array([0.9, -1.5, 0.7])
    assert one(spark, S.sdr(arr(r), arr(e))) == pytest.approx(10 * np.log10(((r**2).sum() + 1e-8) / (((r - e) ** 2).sum() + 1e-8)))
    k = (e * r + 1e-8).sum() / (r**2 + 1e-8).sum()
    assert one(spark, S.si_sdr(arr(r), arr(e))) == pytest.approx(10 * np.log10(((k * r) ** 2).sum() / (((k * r - e) ** 2).sum() + 1e-8) + 1e-8))
    assert one(spark, S.volume_for(F.lit(None).cast("double"))) == 0.2 and one(spark, S.volume_for(F.lit(-20.0))) == 0.2
    assert [one(spark, S.feature_length(F.lit(n))) for n in (1, 100, 101, 250)] == [1, 13, 14, 33]
    c = one(spark, S.colour_labels(F.lit(200), F.lit(40), F.lit(30)))
    assert tuple(c) == ("暖色调", "画面偏亮")
    with pytest.raises(ValueError):
        S.metric("none", F.lit(1), F.lit(1))
