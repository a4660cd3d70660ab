"""Worked examples of the passes, and independent oracles on random input."""

import random

import numpy as np
import pytest

from reelframe.operators import sequence as Q

C = Q.Cue


def texts(cues):
    return [c.text for c in cues]


def at(*ts, step=1.0):
    return [C(t, i * step, i * step + 0.9 * step) for i, t in enumerate(ts)]


def plain_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_lcs_and_ordered_ratio():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rng.choices("甲乙丙丁", k=rng.randint(0, 12))) for _ in "ab")
        assert Q.lcs(a, b) == plain_lcs(a, b)
        j = n = 0
        for c in b:
            while j < len(a) and a[j] != c:
                j += 1
            if j < len(a):
                n, j = n + 1, j + 1
        assert Q.ordered_ratio(a, b) == n / max(len(b), 1)


def test_split_merged():
    assert Q.split_merged(["这就是武道纳灵级无敌"], ["这就是武道痛快", "纳灵级无敌"]) == ["这就是武道", "纳灵级无敌"]
    assert Q.split_merged(["", "好", "这就是武道"], ["这就是武道痛快", "纳灵级无敌"]) == ["", "好", "这就是武道"]


def test_single_char_from_context():
    lines = ["这就是武道痛快", "纳灵级无敌"]
    assert Q.fix_single_chars(["这就是", "武道", "他", "大灵级无敌"], lines) == ["这就是", "武道", "痛快", "大灵级无敌"]


def test_trim_overlap():
    assert Q.trim_overlap(["第三关回答我何为冰", "何为冰冰者至寒至坚宁折不弯"])[1] == "冰者至寒至坚宁折不弯"
    assert Q.trim_overlap(["走", "走"]) == ["走", "走"]


def test_lost_cue_takes_what_is_unsaid():
    lines = ["再说一句捏碎你们", "哟陆安躲了一礼拜敢来了"]
    cues = Q.score(at("再说一句", "你碎了哟", "陆安", "躲了一礼拜敢来了"), lines)
    assert texts(Q.fix_lost(cues, lines))[1] == "捏碎你们"


@pytest.mark.parametrize(
    "fix,text,lines,want",
    [
        (Q.expand_substrings, "小姐跟你没", ["本小姐跟你没完"], "本小姐跟你没完"),
        (Q.expand_substrings, "公安来了", ["公安来了公安来了"], "公安来了"),
        (Q.fix_by_end, "呦我也没和天才走在一起", ["废物也配和天才走在一起"], "废物也配和天才走在一起"),
        (Q.strip_short_heads, "德救命", ["外面好像有人喊救命"], "救命"),
        (Q.fix_near_exact, "好三块碎片", ["三块碎片"], "三块碎片"),
        (Q.fix_near_exact, "拼了拼了混沌五元灭", ["拼了混沌五元灭"], "拼了混沌五元灭"),
        (Q.fix_near_exact, "这是规矩契", ["夫妻当然要同住这是规矩"], "这是规矩"),
        (Q.fix_near_exact, "小哥我们来", ["霄哥我们来了"], "霄哥我们来了"),
        (Q.fix_near_exact, "你说他们没问题", ["你惹他们没问题"], "你惹他们没问题"),
        (Q.fix_near_exact, "比赚钱一个月看谁赚的多我", ["比赚钱一个月看谁赚得多"], "比赚钱一个月看谁赚得多"),
        (Q.fix_near_exact, "看谁赚的多我", ["比赚钱一个月看谁赚得多"], "看谁赚得多"),
        (Q.clean_heads, "卖废品赚了五块", ["我卖废品赚了五块"], "我卖废品赚了五块"),
        (Q.clean_heads, "成了结束了吧", ["结束了吧"], "结束了吧"),
    ],
)
def test_per_cue_rules(fix, text, lines, want):
    assert texts(fix(Q.score(at(text), lines), lines)) == [want]


def test_near_exact_keeps_order_of_rules():
    assert texts(Q.correct(at("你说他们没问题"), ["你惹他们没问题"])) == ["你惹他们没问题"]


def test_fragments_merge_forward_and_backward():
    assert texts(Q.merge_fragments(Q.score(at("我公", "司还有事"), ["我公司还有事"]), ["我公司还有事"])) == ["我公司还有事"]
    line = "他硬闯还凶我无法无天了"
    assert texts(Q.merge_fragments(Q.score(at("他硬闯还凶我无法", "无天"), [line]), [line])) == [line]
    far = [C("我公", 0, 1), C("司还有事", 9, 10)]
    assert len(Q.merge_fragments(Q.score(far, ["我公司还有事"]), ["我公司还有事"])) == 2


def test_prefix_fragment_goes():
    cs = at("霄儿撑住", "霄儿撑住师父带你走")
    assert texts(Q.drop_fragments(cs, ["师父带你走"])) == ["霄儿撑住师父带你走"]
    assert len(Q.drop_fragments(cs, ["霄儿撑住"])) == 2


def test_short_repeat_and_jumps():
    lines = ["一二三四", "找死", "放手", "无关的话"]
    cs = [C("放肆放手就", 0, 1, 2, 0.4), C("找死", 2, 3, 1, 1.0)]
    assert texts(Q.fix_short_repeats(cs, lines)) == ["找死", "找死"]
    cs = [C("开头", 0, 1, 1, 1), C("不可能", 1, 2, 20, 1), C("继续", 2, 3, 2, 1), C("没有", 3, 4, -1, 0), C("往后", 4, 5, 3, 1)]
    assert texts(Q.drop_jumps(cs, [])) == ["开头", "继续", "没有", "往后"]


def test_orphans_chars_noise_repeats():
    got = Q.attach_orphans([C("老师", 13.52, 13.9), C("我要跳级我要直接考三年级", 18.0, 22.0)], ["老师我要跳级"])
    assert [(c.text, c.start) for c in got] == [("老师我要跳级", 13.52), ("我要直接考三年级", 18.0)]
    assert texts(Q.join_single_chars([C("什", 54.0, 54.4), C("么", 55.2, 55.5)], ["什么"])) == ["什么"]
    assert texts(Q.join_single_chars([C("什", 54.0, 54.4), C("么", 57.2, 57.5)], ["什么"])) == ["什", "么"]
    assert texts(Q.drop_noise([C("好我", 0, 0.48), C("签", 0.5, 0.82)], ["好我签"])) == ["好我签"]
    assert texts(Q.drop_noise([C("好的", 0, 1), C("陆", 2, 3), C("走吧", 3, 4)], ["好的"])) == ["好的", "走吧"]
    assert texts(Q.drop_repeats(at("废物", "废物", "守护苍生何惜此身", "可惜此身"))) == ["废物", "守护苍生何惜此身"]
    assert texts(Q.merge_short([C("这", 0, 0.2), C("是陷害", 0.3, 1)])) == ["这是陷害"]


def test_split_long():
    lines = ["来吧", "让你们见识一下"]
    got = Q.split_long(Q.score([C("来吧让你们见识一下", 0.0, 9.0)], lines), lines)
    assert texts(got) == ["来吧", "让你们见识一下"] and got[0].end == pytest.approx(2.0)


def test_merge_words():
    words = [("一" * 5, 0, 1), ("二" * 5, 1.4, 2), ("三" * 5, 2.0, 3), ("四", 3.1, 3.2), ("五", 4.0, 4.1)]
    assert texts(Q.merge_words(words)) == ["一" * 5 + "二" * 5 + "三" * 5, "四", "五"]
    assert Q.merge_words([("好", 1.0, 1.1)]) == [C("好", 1.0, 1.3)] and Q.merge_words([]) == []


def test_alignment_follows_the_words():
    words = [(c, i * 0.3, i * 0.3 + 0.25) for i, c in enumerate("小子站住此路是我开")]
    got = Q.align_segments(["小子站住", "", "此路是我开！"], words)
    assert [(c.text, round(c.start, 2), round(c.end, 2)) for c in got] == [("小子站住", 0.0, 1.15), ("此路是我开！", 1.2, 2.65)]
    got = Q.align_segments(["全然无关"], words)
    assert got[0].start == 0.0 and got[0].end == 0.8
    assert Q.align_segments(["x"], []) == []


def longest(ts):
    best = [1] * len(ts)
    for i in range(len(ts)):
        best[i] = max([best[j] + 1 for j in range(i) if ts[j] <= ts[i]], default=1)
    return max(best, default=0)


def test_repair_times():
    assert Q.repair_times([]) == [] and Q.repair_times([1, 2, 3]) == [1, 2, 3]
    assert Q.repair_times([1, 99, 3, 4, 5]) == [1, 1, 3, 4, 5]
    assert Q.repair_times([0, 90, 80, 70, 4, 5, 6, 7, 8]) == [0, 1, 2, 3, 4, 5, 6, 7, 8]
    rng = random.Random(3)
    for _ in range(200):
        ts = [rng.randint(0, 30) for _ in range(rng.randint(1, 15))]
        out = Q.repair_times(ts)
        assert out == sorted(out) and sum(a == b for a, b in zip(ts, out)) >= longest(ts)


def test_quiet_cuts_make_up_the_whole():
    rng = np.random.default_rng(4)
    x = rng.uniform(0.5, 1, 5000)
    x[950:1080] = 0.0
    cuts = Q.quiet_cuts(x, 100, 10.0, 2.0)
    assert cuts[0][0] == 0 and cuts[-1][1] == 5000 and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    assert 950 <= cuts[0][1] <= 1080
    assert Q.quiet_cuts(x[:100], 100, 10.0) == [(0, 100)]


def test_collapse_patterns():
    assert Q.collapse_patterns("ab" * 30 + "c") == "abc"
    assert Q.collapse_patterns("ab" * 19) == "ab" * 19
    assert Q.collapse_patterns("x" + "哈哈好" * 25 + "尾") == "x哈哈好尾"
    assert Q.collapse_patterns("") == ""


def test_tables(spark):
    w = spark.createDataFrame([("e", i, c, i * 1.0, i + 0.9) for i, c in enumerate("小子站住")] + [("f", 0, None, 0.0, 1.0), ("f", 1, "走", None, 1.0)], "episode string, word_ord long, text string, start_time double, end_time double")
    assert [r.text for r in Q.words_to_cues(w, ["episode"], ["word_ord"]).collect()] == ["小子站住"]
    cues = spark.createDataFrame([("e", 0, "你说他们没问题", 0.0, 2.0), ("g", 0, "好", 0.0, 1.0)], "episode string, cue_ord long, text string, start_time double, end_time double")
    lines = spark.createDataFrame([("e", 0, "你惹他们没问题"), ("h", 0, None)], "episode string, line_ord int, line string")
    assert sorted(r.text for r in Q.correct_cues(cues, lines, ["episode"], "cue_ord", "line_ord").collect()) == sorted(["你惹他们没问题", "好"])
