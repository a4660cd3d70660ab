"""Joins that spread hot entities, and passes over scripts, against brute force on random rows; the session registry."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelframe.functions import records as C
from reelframe.functions import signal as S
from reelframe.operators import aggregates as A
from reelframe.operators import joins as J
from reelframe.operators import likeness as K
from reelframe.operators import sequence as Q
from reelframe.streaming import count_window as W

LETTERS = "甲乙丙丁戊己庚辛"


def text(rng, most, least=0):
    return "".join(rng.choices(LETTERS, k=rng.randint(least, most)))


def test_script_compares_with_all_lines_at_once():
    rng = random.Random(1)
    for _ in range(300):
        lines = [text(rng, 9) for _ in range(rng.randint(0, 12))] + [text(rng, 90, 65) for _ in range(rng.random() < 0.2)]
        s = Q.Script(lines)
        for h in [text(rng, 9) for _ in range(4)] + lines[:2]:
            want = [Q.lcs(h, x) for x in lines]
            assert s.lcs(h).tolist() == want
            assert s.like(h, 3) == [i for i, n in enumerate(want) if n >= 3]
            rs = [Q.ratio(h, x) for x in lines]
            top = max(rs, default=0.0)
            assert Q.best_line(h, lines) == ((rs.index(top), top) if len(h) > 1 and top > 0 else (-1, 0.0))


@pytest.mark.parametrize("rule,common,least", [(Q._by_end, lambda n: 4, 4), (Q._near_exact, lambda n: min(n - 2, (n + 1) // 2), 4), (Q._cleanup, lambda n: min(n - 3, (n + 1) // 2), 4), (Q._short_tail, lambda n: 2, 2)])
def test_lines_left_out_of_a_rule_could_not_hold(rule, common, least):
    rng = random.Random(2)
    held = 0
    for _ in range(20_000):
        x = text(rng, 9, 1)
        h = list(x)
        for _ in range(rng.randint(0, 2)):
            k = rng.random()
            if k < 0.4 and h:
                h[rng.randrange(len(h))] = rng.choice(LETTERS)
            elif k < 0.7:
                h.insert(rng.randint(0, len(h)), rng.choice(LETTERS))
            elif h:
                h.pop(rng.randrange(len(h)))
        h = "".join(h + h[: rng.choice([0, 0, 2])])
        if len(h) >= least and (least > 2 or len(h) <= 3) and rule(h, x):
            held += 1
            assert Q.lcs(h, x) >= max(1, common(len(h))), (h, x)
    assert held > 5


def test_correction_compares_with_few_lines_of_a_long_script(monkeypatch):
    rng = random.Random(4)
    words = ["".join(chr(0x4E00 + rng.randrange(100)) for _ in range(rng.randint(2, 3))) for _ in range(60)]
    lines = ["".join(rng.choices(words, k=rng.randint(1, 6))) for _ in range(1500)]
    s = Q.Script(lines)
    texts = ["".join(rng.choices(words, k=rng.randint(1, 6))) for _ in range(60)]
    n, compare = [0], Q.Script.compare
    monkeypatch.setattr(Q.Script, "compare", lambda self, h, ids: (n.__setitem__(0, n[0] + len(ids)), compare(self, h, ids))[1])
    for h in texts:
        rs = [Q.ratio(h, x) for x in lines]
        assert Q.best_line(h, s) == (rs.index(max(rs)), max(rs))
        assert s.around(h, 4) == list(dict.fromkeys(x for x in lines if h in x and 0 < len(x) - len(h) <= 4))
        assert s.holds(h, 0.5 * len(h)) == (max(Q.lcs(h, x) for x in lines) >= 0.5 * len(h))
        for rule, among in ((Q._near_exact, Q._near), (Q._cleanup, Q._whole)):
            if len(h) >= 4:
                assert next((x for x in among(s, h) if rule(h, x)), None) == next((x for x in lines if x and rule(h, x)), None)
        for first in (0, 700):
            assert s.starting(h[:4], first) == next((i for i, x in enumerate(lines) if i >= first and x.startswith(h[:4]) and len(x) > len(h[:4])), -1)
    assert n[0] < 0.2 * len(texts) * len(lines)  # all of them before


def _long_script(seed):
    rng = random.Random(seed)
    words = ["".join(chr(0x4E00 + rng.randrange(100)) for _ in range(rng.randint(2, 3))) for _ in range(60)]
    return rng, ["".join(rng.choices(words, k=rng.randint(1, 5))) for _ in range(1000)]


def _compared(monkeypatch):
    n, compare = [0], Q.Script.compare
    monkeypatch.setattr(Q.Script, "compare", lambda self, h, ids: (n.__setitem__(0, n[0] + len(ids)), compare(self, h, ids))[1])
    return n


def test_merged_segments_are_compared_with_few_lines(monkeypatch):
    rng, lines = _long_script(5)
    segs = ["".join(lines[i : i + 2]) for i in range(0, 60, 2)] + [lines[i][1:] + lines[rng.randrange(1000)] for i in range(30)]

    def cut(h):  # W38 as it is defined, with every line
        for i, b in enumerate(lines):
            a = lines[i - 1] if i else ""
            if len(h) < 5 or len(a) < 2 or not 1 < len(b) < len(h) - 1 or Q.lcs(h, b) < 0.75 * len(b):
                continue
            scored = []
            for k in range(max(2, len(h) - len(b) - 2), min(len(h) - 2, len(h) - len(b) + 2) + 1):
                r2, r1 = Q.ratio(h[k:], b), max(Q.ordered_ratio(a, h[:k]), Q.ordered_ratio(h[:k], a))
                if r2 >= 0.75 and r1 >= 0.3:
                    scored.append((r1 + r2, -k))
            if scored:
                k = -max(scored)[1]
                return [h[:k], h[k:]]
        return [h]

    want = [p for h in segs for p in cut(h)]
    n = _compared(monkeypatch)
    assert Q.split_merged(segs, lines) == want and len(want) > len(segs) + 20
    assert n[0] < 0.05 * len(segs) * len(lines)  # all of them before


def test_single_characters_are_looked_up_in_few_lines(monkeypatch):
    rng, lines = _long_script(6)
    lines = [x for x in dict.fromkeys(lines) if len(x) > 5]
    segs, want = [], []
    for i in range(1, 60):
        segs += [lines[i - 1][:-2], "某", lines[i][:-1] + "某"]
        want += [lines[i - 1][:-2], lines[i - 1][-2:], lines[i][:-1] + "某"]
    n = _compared(monkeypatch)
    assert Q.fix_single_chars(segs, lines) == want
    assert n[0] < 0.1 * 59 * len(lines)  # all of them before


def test_repeated_claims():
    cues = [Q.Cue("甲乙", 0, 1, 3, 0.9), Q.Cue("丙", 1, 2, 3, 0.2), Q.Cue("丁", 2, 3, 4, 0.6)]
    c = Q.Claims(list(cues))
    assert not c.by_another(0, 3) and c.by_another(1, 3) and c.by_another(0, 4)
    c.put(1, Q.Cue("丙", 1, 2, 3, 1.0))
    assert c.by_another(0, 3)


def test_points_in_intervals_of_any_length(spark):
    rng = random.Random(3)
    pts = [(rng.choice(["e", "f", None]), i, round(rng.uniform(-50, 3000), 1) if rng.random() < 0.95 else None) for i in range(300)]
    ivs = [(rng.choice(["e", "f", None]), i, s, s + rng.choice([0.0, 3.0, 9.9, 10.0, 45.0, 700.0])) for i in range(60) for s in [round(rng.uniform(-50, 3000), 1)]]
    ivs += [("e", 90, 100.0, 1e13), ("e", 91, 5.0, 2.0), ("f", 92, -float("inf"), float("inf")), ("f", 93, None, 5.0)]
    p = spark.createDataFrame(pts, "k string, i int, t double")
    iv = spark.createDataFrame(ivs, "k string, j int, s double, e double")
    got = sorted((r.i, r.interval.j) for r in J.point_in_intervals(p, iv, ["k"], F.col("t"), F.col("s"), F.col("e")).collect())
    ok = lambda s, e: s is not None and e is not None and s <= e
    assert got == sorted((i, j) for k, i, t in pts for m, j, s, e in ivs if k is not None and k == m and t is not None and ok(s, e) and s <= t <= e)
    for width in (7.0, 600.0):
        left = sorted(r.i for r in J.not_covered(p, iv, ["k"], F.col("t"), F.col("s"), F.col("e"), width).collect())
        assert left == sorted(i for k, i, t in pts if t is None or not any(k == m and ok(s, e) and s <= t <= e for m, j, s, e in ivs))
    assert J.point_in_intervals(p, iv.where("false"), ["k"], F.col("t"), F.col("s"), F.col("e")).count() == 0
    assert J.not_covered(p, iv.where("false"), ["k"], F.col("t"), F.col("s"), F.col("e")).count() == len(pts)


def test_nearest_in_buckets(spark):
    rng = random.Random(4)
    left = [(rng.choice("ab"), i, rng.randint(0, 400)) for i in range(150)]
    right = [(rng.choice("aab"), 1000 + i, rng.choice([rng.randint(0, 60), rng.randint(300, 400), None])) for i in range(40)]
    a, b = spark.createDataFrame(left, "k string, l int, t int"), spark.createDataFrame(right, "k string, r int, s int")
    want = {}
    for k, i, t in left:
        c = [(abs(t - s), s, r) for m, r, s in right if m == k and s is not None]
        d = min(c, default=(None, None, None))
        want[i] = (d[2], d[0])
    for width in (None, 1, 37, 1000):
        assert {r.l: (r.r, r.distance) for r in J.nearest(a, b, ["k"], "l", "t", "r", "s", width).collect()} == want


def test_position_gate_equals_all_comparisons(spark):
    rng = random.Random(5)
    cues = [("e" if i % 3 else "f", i, round(rng.random(), 2), text(rng, 7)) for i in range(60)]
    lines = [("e" if i % 3 else "f", round(i / 40, 2), text(rng, 7)) for i in range(40)]
    pairs = [(k, text(rng, 4, 1), text(rng, 4)) for k in "ef" for _ in range(12)]
    got = J.position_gate(
        spark.createDataFrame(cues, "k string, cue_id int, cue_pct double, text string"), spark.createDataFrame(lines, "k string, line_pct double, line string"),
        spark.createDataFrame(pairs + pairs[:3] + [("e", "", "甲"), (None, "甲", "乙")], "k string, wrong string, right string"), ["k"],
    )
    want = set()
    for k, i, p, t in cues:
        for m, w, r in pairs:
            if m == k and w in t:
                near = lambda x: min((abs(p - q) for n, q, line in lines if n == k and x in line), default=None)
                a, b = near(r) if r else None, near(w) if len(w) >= 3 else None
                if (a is None or a <= 0.35) and (b is None or b > 0.35):
                    want.add((k, i, p, w, r))
    assert {(r.k, r.cue_id, r.cue_pct, r.wrong, r.right) for r in got.collect()} == want


def test_titles_meet_names_through_their_rarest_characters(spark):
    rng = random.Random(6)
    titles, names = {text(rng, 6) for _ in range(40)}, {text(rng, 8) for _ in range(40)}
    got = J.title_matches(spark.createDataFrame([(t,) for t in titles] + [(None,)], "t string"), spark.createDataFrame([(n,) for n in names], "n string"), "t", "n")
    want = {}
    for t in titles:
        c = [(-sum(x in n for x in t), n) for n in names if n and 2 * sum(x in n for x in t) >= len(t)]
        if t and c:
            want[t] = (min(c)[1], -min(c)[0])
    assert {r.t: (r.n, r.shared) for r in got.collect()} == want


def test_best_lines_in_blocks(spark):
    rng = random.Random(7)
    cues = [(rng.choice("ab"), i, text(rng, 6)) for i in range(120)]
    lines = [("a", i, text(rng, 6)) for i in range(20)]
    c, s = spark.createDataFrame(cues, "k string, cue_ord int, text string"), spark.createDataFrame(lines, "k string, line_ord int, line string")
    want = {i: Q.best_line(t, [x for m, _, x in lines if m == k]) for k, i, t in cues}
    for block in (7, 1000):
        assert {r.cue_ord: (r.match_li, r.match_score) for r in J.best_lines(c, s, ["k"], "cue_ord", "line_ord", block).collect()} == want


def test_islands_in_buckets(spark):
    rng = random.Random(8)
    rows, t = [], 0.0
    for i in range(400):
        t += rng.choice([0.1, 0.3, 0.6])
        rows.append((rng.choice(["e", "e", None]), i, rng.choice(LETTERS), round(t, 2), round(t + 0.1, 2)))
    df = spark.createDataFrame(rows, "episode string, word_ord long, text string, start_time double, end_time double")
    whole = sorted(map(repr, Q.words_to_cues(df, ["episode"], ["word_ord"]).collect()))
    for size in (3, 50):
        assert sorted(map(repr, Q.words_to_cues(df, ["episode"], ["word_ord"], bucket=F.floor(F.col("word_ord") / size)).collect())) == whole


def test_session_registry():
    ended = []

    def finish(s):
        ended.append(s)
        if s == "bad":
            raise RuntimeError(s)
        return f"end of {s}"

    r = W.Sessions(finish, ttl_ms=100)
    a, b, c = r.start("a", 0), r.start("bad", 0), r.start("c", 0)
    assert len({a, b, c}) == 3 and r.get(a, 90) == "a" and ended == []
    assert r.get(a, 150) == "a" and sorted(ended) == ["bad", "c"] and r.get(c, 150) is None  # not touched for longer than 100; what finish raises is swallowed
    assert r.end(a, 160) == "end of a" and r.end(a, 160) is None
    with pytest.raises(RuntimeError):
        r.end(r.start("bad", 200), 200)


def test_small_operators_with_nulls(spark):
    one = spark.range(1)
    px = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    assert one.select(S.mean_brightness(px(255, 0), px(255, 0), px(255, 0)).alias("x")).first().x == 127.5
    assert one.select(S.mean_brightness(px(), px(), px()).alias("x")).first().x is None
    urls = spark.createDataFrame([('[{"aliyun_url": null}, {"aliyun_url": "a.MP3"}]',), ("",), (None,), ('{"aliyun_url": "a.wav"}',)], "j string")
    assert [r.u for r in urls.select(C.music_url("j").alias("u")).collect()] == ["a.MP3", None, None, None]
    assert one.select(C.target_stem(F.array(F.lit(1), F.lit(2)), None).alias("x")).first().x == [1, 2]
    rates = spark.createDataFrame([(None, None, 16000), (8000, None, None), (None, 44100, None), (None, None, None)], "a int, b int, r int")
    assert [x.v for x in rates.select(C.audio_record("a", "b", "r").alias("v")).collect()] == [16000, 8000, 44100, None]
    loss = spark.createDataFrame([("e", 1.0), ("e", None), ("e", 3.0), ("f", None)], "k string, loss double")
    assert {r.k: (r.loss, r.steps) for r in A.epoch_loss(loss, ["k"], "loss").collect()} == {"e": (2.0, 2), "f": (None, 0)}
    draws = spark.createDataFrame([("t", 0, 0.5), ("t", 0, None), ("t", 1, 0.5), ("t", 1, 0.4), ("u", 0, 0.0), ("u", 3, 0.0), ("v", 0, 0.1)], "k string, n int, level double")
    assert {r.k: (r.n, r.quiet) for r in A.aligned_draws(draws, ["k"], "n", "level", 0.2, 3).collect()} == {"t": (1, 0), "u": (0, 1), "v": (0, 1)}
    tracks = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", None)], "k string, path string")
    got = A.found_and_skipped(tracks, spark.createDataFrame([("1", 5.0), ("1", 6.0), ("2", None)], "path string, n double"), ["k"], "path", "n").collect()
    assert {r.k: (r.listed, r.found, r.skipped) for r in got} == {"a": (2, 1, 1), "b": (1, 0, 1)}
    cues = spark.createDataFrame([("e", 1.0, 1.0), ("e", None, 2.0), ("e", 1.0, 2.0)], "k string, start_time double, end_time double")
    assert C.timed_cues(cues).count() == 1


def test_passes_on_tables_with_nulls(spark):
    segs = spark.createDataFrame([("e", 1, None), ("e", 0, "这就是武道纳灵级无敌"), ("f", 0, "好")], "k string, o int, text string")
    lines = spark.createDataFrame([("e", 0, "这就是武道痛快"), ("e", 1, "纳灵级无敌"), ("e", 2, None), ("g", 0, "走")], "k string, line_ord int, line string")
    got = [(r.k, r.ord, r.text) for r in Q.segment_pass(segs, lines, ["k"], "o", "line_ord", Q.split_merged).orderBy("k", "ord").collect()]
    assert got == [("e", 0, "这就是武道"), ("e", 1, "纳灵级无敌"), ("e", 2, ""), ("f", 0, "好")]
    cues = spark.createDataFrame([("e", 0, "这", 0.0, 0.2), ("e", 1, None, 0.3, 1.0), ("e", 2, "走", None, 1.0)], "k string, o int, text string, start_time double, end_time double")
    assert [(r.text, r.end_time) for r in Q.cue_pass(cues, ["k"], ["o"], Q.merge_short).collect()] == [("这", 1.0)]
    arrays = spark.createDataFrame([([1, 99, 3, 4, 5],), (None,), ([],)], "t array<long>")
    assert [r.x for r in arrays.select(Q.repaired_times("t").alias("x")).collect()] == [[1, 1, 3, 4, 5], None, []]
    waves = spark.createDataFrame([(1, [0.5] * 30), (2, None), (3, [])], "i int, wav array<double>")
    got = Q.quiet_chunks(waves, ["i"], "wav", 10, 2.0, 0.5, 400.0).collect()
    assert Counter(r.i for r in got) == {1: 2, 3: 1} and max(r.hi for r in got) == 30
    assert np.isclose(sum(r.hi - r.lo for r in got if r.i == 1), 30)


def _odd_scripts(n):
    """Scripts with lines of no character to more than two words of 64 bits, and segments that run over two lines, changed here and there."""
    rng, some, groups = random.Random(8), "甲乙丙丁戊己庚辛壬癸子丑寅卯", []
    for _ in range(n):
        lines = ["".join(rng.choice(some[: rng.choice([2, 4, 14])]) for _ in range(rng.choice([0, 1, 2, 3, 5, 9, 20, 64, 70, 140]))) for _ in range(rng.randrange(14))]
        segs = []
        for _ in range(12):
            i = rng.randrange(len(lines)) if lines else 0
            x = list(lines[i - 1] + lines[i] if lines and rng.random() < 0.8 else rng.choices(some, k=rng.randrange(12)))
            for _ in range(rng.randrange(4) if x else 0):
                x[rng.randrange(len(x))] = rng.choice(some)
            if x and rng.random() < 0.3:
                x.insert(rng.randrange(len(x)), rng.choice(", a"))
            segs.append("".join(x))
        groups.append((segs, lines))
    return groups


def _cut(seg, lines):
    """W38 as it is defined, with every line."""
    h = Q.han(seg)
    for i, b in enumerate(lines):
        a = lines[i - 1] if i else ""
        if len(h) < 5 or len(a) < 2 or not 1 < len(b) < len(h) - 1 or Q.lcs(h[-len(b) - 2 :], b) < 0.75 * len(b):
            continue
        scored = []
        for k in range(max(2, len(h) - len(b) - 2), min(len(h) - 2, len(h) - len(b) + 2) + 1):
            r2, r1 = Q.ratio(h[k:], b), max(Q.ordered_ratio(a, h[:k]), Q.ordered_ratio(h[:k], a))
            if r2 >= 0.75 and r1 >= 0.3:
                scored.append((r1 + r2, -k))
        if scored:
            at = Q._original(seg, -max(scored)[1])
            parts = [seg[:at].strip(), seg[at:].strip()]
            if all(parts):
                return parts
    return [seg]


@pytest.mark.parametrize("small", [False, True])
def test_segments_of_many_scripts_are_split_at_once(monkeypatch, small):
    groups = _odd_scripts(60)
    if small:  # scripts searched length by length, and blocks of a few pairs
        for name, n in (("_LARGE", 3), ("_CACHED", 10), ("_PAIRS", 50), ("_MASKS", 500), ("_PLACES", 60)):
            monkeypatch.setattr(K, name, n)
    want = [[_cut(s, lines) for s in segs] for segs, lines in groups]
    assert Q.split_all(groups) == want and sum(len(x) > 1 for g in want for x in g) > 100


def test_few_pairs_of_segments_and_lines_are_compared(monkeypatch):
    _, lines = _long_script(5)
    segs = ["".join(lines[i : i + 2]) for i in range(0, 60, 2)]
    n, shared = [0], K.Ends.shared
    monkeypatch.setattr(K.Ends, "shared", lambda self, s, t: (n.__setitem__(0, n[0] + len(s)), shared(self, s, t))[1])
    assert Q.split_all([(segs, lines)]) == [[_cut(s, lines) for s in segs]]
    assert 0 < n[0] < 0.02 * len(segs) * len(lines)


def test_segments_of_an_episode_are_split_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(Q, "PIECE", 16)
    lines = [x for _, ls in _odd_scripts(20) for x in ls]
    segs = [x for ss, _ in _odd_scripts(20) for x in ss]
    said = spark.createDataFrame([("e", i, x) for i, x in enumerate(segs)] + [(None, 0, segs[0]), (None, 1, None), ("f", 3, segs[1])], "k string, o int, text string")
    script = spark.createDataFrame([(k, i, x) for k in ("e", None, "g") for i, x in enumerate(lines)], "k string, line_ord int, line string")
    got = Q.split_script(said, script, ["k"], "o", "line_ord").orderBy("k", "ord").collect()
    assert [r.text for r in got if r.k == "e"] == [p for s in segs for p in _cut(s, lines)]
    assert [r.text for r in got if r.k is None] == [*_cut(segs[0], lines), ""]
    assert [r.text for r in got if r.k == "f"] == [segs[1]]
    assert all([r.ord for r in got if r.k == k] == list(range(sum(r.k == k for r in got))) for k in ("e", "f", None))
    one = Q.split_segments(said.where("k = 'e'"), script, ["k"], "o", "line_ord")
    assert one.select(F.spark_partition_id()).distinct().count() > 1  # one task for an episode before


def test_segments_are_aligned_in_pieces_as_in_one_go(spark, monkeypatch):
    monkeypatch.setattr(Q, "PIECE", 8)
    rng, lines = _long_script(7)
    lines, segs = [x for x in dict.fromkeys(lines) if len(x) > 5][:90], []
    for i in range(1, 90):
        segs += [lines[i - 1][:-2], "某", lines[i][:-1] + "某"] if rng.random() < 0.4 else ["".join(lines[i - 1 : i + 1])] if rng.random() < 0.5 else [lines[i], ""]
    times = [(c, round(0.2 * i, 1)) for i, c in enumerate(c for x in lines for c in x)]
    said = spark.createDataFrame([(k, i, x) for k in ("e", "f") for i, x in enumerate(segs)] + [("g", 0, None)], "k string, o int, text string")
    script = spark.createDataFrame([("e", i, x) for i, x in enumerate(lines)] + [("h", 0, "走")], "k string, line_ord int, line string")
    heard = spark.createDataFrame([(k, i, c, t, t + 0.2) for k in ("e", "h") for i, (c, t) in enumerate(times)] + [("e", 5, None, 1.0, 1.2)], "k string, w long, text string, start_time double, end_time double")
    df = Q.align_cues(said, heard, script, ["k"], "o", "w", "line_ord")
    fixed = Q.fix_single_chars(Q.split_merged(segs, lines), lines)
    assert sum(x not in segs for x in fixed) > 40 and fixed.count("某") < segs.count("某")
    want = Q.align_segments([Q.drop_said_twice(x) for x in Q.trim_overlap(fixed)], [(c, t, t + 0.2) for c, t in times])
    got = df.orderBy("k", "ord").collect()
    assert [(r.ord, r.text, r.start_time, r.end_time) for r in got if r.k == "e"] == [(i, c.text, c.start, c.end) for i, c in enumerate(want)]
    assert {r.k for r in got} == {"e"}
    parts = Q.split_segments(said, script, ["k"], "o", "line_ord", fix_singles=True).orderBy("k", "_piece", "_part").collect()
    assert [r.text for r in parts if r.k == "e"] == fixed and len({r._piece for r in parts}) > 10
    assert "CoGroups" not in df._jdf.queryExecution().toString()  # one task took all passes over an episode before


def test_short_scripts_are_searched_as_they_are(monkeypatch):
    rng = random.Random(9)
    cases = [([text(rng, 9) for _ in range(rng.randint(1, 64))], [text(rng, 12, 2) for _ in range(5)]) for _ in range(60)]
    want = [[Q.Script(lines).best(h) for h in hs] for lines, hs in cases]
    monkeypatch.setattr(Q, "Script", type("None_", (), {"__init__": lambda self, lines: pytest.fail("a script is built")}))
    assert [[Q.best_line(h, lines) for h in hs] for lines, hs in cases] == want
