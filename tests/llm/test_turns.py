"""p2: parsing, the model against a plain rule, sections, held-out accuracy, edges."""

import random
from itertools import combinations, product

import numpy as np
import pytest

from reelframe.llm import speaker_turns as S

CHUNK = "orig_index int, chunk_index int, episode string, offset_sec double, raw string, language string, text string, items array<struct<text:string,start_time:double,end_time:double>>, loaded_at timestamp, speaker string, series string, cast string"
ALIAS = [("s000001", a, p) for a, p in (("spk1", "竺遥昭"), ("spk2", "云湛"), ("店家", "云湛"), ("spk3", "夜栩"), ("掌柜", "夜栩"), (None, "旁白"), ("x", None), ("y", " "))]


@pytest.mark.parametrize(
    "label,who",
    [("竺遥昭", 0), ("竺　遥昭", 0), ("SPK_01", 0), ("ＳＰＫ1", 0), ("Spk-2", 1), ("店家", 1), ("竺枫昭", 0), ("夜琅", 2), ("记住", None), ("掌声", None), ("", None), ("spk9", None)],
)
def test_labels(label, who):
    cast = S.Cast([(a, p) for _, a, p in ALIAS if p and p.strip()])
    order = {"竺遥昭": 0, "云湛": 1, "夜栩": 2}
    got = cast.resolve(label)
    assert (got is None and who is None) or order[cast.speakers[got[0][0]]] == who


@pytest.mark.parametrize(
    "raw,label,text,time",
    [
        ("[00:01:02.5] 云湛（起身）：嗯，走！", "云湛", "走！", 62.5),
        ("(01:05) <店家> 连夜走了。", "云湛", "连夜走了。", 65.0),
        ("<7.25s> >> 竺 遥昭：实话告诉你：走。", "竺遥昭", "实话告诉你：走。", 7.25),
        ("@0:00:09 实话告诉你：走。", None, "实话告诉你：走。", 9.0),
        ("1分3秒 -夜栩V.O.：呃，那个……", "夜栩", "", 63.0),
        ("【旁白】um, uh（叹气）", "旁白", "", 0.0),
        ("[door slams] 夜栩：((听不清)) 来人♪♪", "夜栩", "来人", 0.0),
        ("那个包袱是谁的", None, "那个包袱是谁的", 0.0),
    ],
)
def test_lines(raw, label, text, time):
    cast = S.Cast([(a, p) for _, a, p in ALIAS if p and p.strip()])
    (k,) = S.parse_chunk(raw, None, 0.0, cast)
    assert ([cast.speakers[i] for i in k.label] or [None])[0] == label and k.text == text and k.time == time


def test_srt_stamp_goes_to_the_next_line():
    cast = S.Cast([("a", "云湛")])
    got = S.parse_chunk("00:00:01,458 --> 00:00:02,358\r\n云湛：走\r\n\r\n好", None, 1.0, cast)
    assert [(k.time, k.text) for k in got] == [(1.458, "走"), (1.458, "好")]


def test_items_place_lines_even_out_of_order():
    cast = S.Cast([("a", "云湛")])
    items = [{"text": "来人", "start_time": 1.0}, {"text": "走了", "start_time": 2.5}, None]
    got = S.parse_chunk("走了。\n嗯\n云湛：来人！", items, 10.0, cast)
    assert {k.text: k.time for k in got if k.text} == {"走了。": 12.5, "来人！": 11.0}


def brute(model, lines, n):
    start, inside = S._features(lines, n)
    a, b = start @ model.w, inside @ model.w
    out = []
    t = len(lines)
    for k in range(t):
        for cuts in combinations(range(1, t), k):
            ends = [*cuts, t]
            begins = [0, *cuts]
            for who in product(range(n), repeat=k + 1):
                if any(x == y for x, y in zip(who, who[1:])):
                    continue
                s = sum(a[i, w] + b[i + 1 : e, w].sum() + model.w[11] * np.log1p(e - i) for i, e, w in zip(begins, ends, who))
                out.append((s, list(zip(begins, ends, who))))
    return out


def random_lines(rng, t, n):
    return [S.Line("走" * 3, *(((rng.randrange(n),), rng.random() < 0.8) if rng.random() < 0.5 else ((), False)), time=float(3 * i + rng.random()), words="走啊走") for i in range(t)]


def counts(start, inside, turns):
    g = np.zeros(len(S.FEATURES))
    for lo, hi, w in turns:
        g += start[lo, w] + inside[lo + 1 : hi, w].sum(axis=0)
        g[11] += np.log1p(hi - lo)
    return g


def test_decode_and_gradient_equal_enumeration():
    rng = random.Random(5)
    for n in (2, 3):
        model = S.TurnModel(np.array([rng.uniform(-2, 2) for _ in S.FEATURES]))
        pieces = [random_lines(rng, t, n) for t in (5, 3, 4)]
        # as one section each, and as padded pieces of one batch
        for lines, got in zip(pieces, model.decode_many([(x, n) for x in pieces])):
            best = max(brute(model, lines, n), key=lambda x: x[0])
            assert got == model.decode(lines, n)
            if all(w < n for *_, w in got):
                assert got == best[1]
        gold = [[rng.choice([-1, 0, 1]) for _ in x] for x in pieces]
        start, inside = np.zeros((2, 3, 5, n, len(S.FEATURES)))
        blocked = np.zeros((2, 3, 5, n), bool)
        want = np.zeros((2, len(S.FEATURES)))
        for i, (lines, y) in enumerate(zip(pieces, gold)):
            start[i, : len(lines)], inside[i, : len(lines)] = S._features(lines, n)
            for held in (0, 1):
                every = brute(model, lines, n)
                if held:
                    blocked[1, i, : len(y)] = [[s >= 0 and s != w for w in range(n)] for s in y]
                    every = [x for x in every if all(y[k] in (-1, w) for lo, hi, w in x[1] for k in range(lo, hi))]
                z = np.logaddexp.reduce([s for s, _ in every])
                want[held] += sum(np.exp(s - z) * counts(start[i], inside[i], turns) for s, turns in every)
        for held in (0, 1):
            assert np.allclose(model.expected(start, inside, np.array([5, 3, 4]), blocked[held]), want[held], atol=1e-6)


def dialogue(rng, n, missing):
    """A dialogue of two who take turns: a long pause before a turn, a short one within; labels are missing at some turns."""
    lines, gold, t, who = [], [], 0.0, 0
    for _ in range(n):
        size = rng.randint(1, 3)
        for k in range(size):
            t += 0.6 + (rng.uniform(3.0, 5.0) if k == 0 else rng.uniform(0.0, 0.3))
            label = (who,) if k == 0 and rng.random() >= missing else ()
            lines.append(S.Line("走" * 3, label, True, t, True, True, "走啊走"))
            gold.append(who)
        who = 1 - who
    return lines, gold


def test_model_finds_turns_that_labels_do_not_show():
    """Where labels are missing, what pauses tell is learned from the screenplay's speakers, and beats the weights that look at labels only."""
    rng = random.Random(1)
    train = [dialogue(rng, 12, 0.3) for _ in range(20)]
    # the screenplay knows some of the lines only
    model = S.TurnModel().fit([(x, 2, [g if rng.random() < 0.6 else -1 for g in y]) for x, y in train])
    held = [dialogue(rng, 12, 0.3) for _ in range(30)]

    def share(m):
        n = good = 0
        for x, y in held:
            for lo, hi, s in m.decode(x, 2):
                n += hi - lo
                good += sum(y[k] == s for k in range(lo, hi))
        return good / n

    label_only, fitted = share(S.TurnModel(np.array(S.DEFAULT_WEIGHTS))), share(model)
    assert label_only < 0.9 and fitted > 0.97, (label_only, fitted)
    again = S.TurnModel.from_json(model.to_json())
    assert np.allclose(again.w, model.w)


def make(spark, recordings):
    rows = []
    for o, chunks in recordings.items():
        rows += [(o, c, "s000001e001", off, None, None, text, items, None, "a", "b", "c") for c, off, text, items in chunks]
    return spark.createDataFrame(rows, CHUNK)


def tables(spark):
    al = spark.createDataFrame(ALIAS, "series string, alias string, speaker string")
    sc = spark.createDataFrame([("s000001e001", 0, "竺遥昭　", "走了", "走了"), ("s000001e001", 1, None, "x", "x")], "episode string, line_ord int, speaker string, line string, raw string")
    return al, sc


def random_recording(rng, lines):
    names = ["竺遥昭", "云湛", "夜栩", "spk2", "店家", "竺枫昭", "旁白"]
    out, t = [], 0
    for k in range(lines):
        t += rng.randint(1, 9)
        label = f"{rng.choice(names)}：" if k == 0 or rng.random() < 0.5 else ""
        body = rng.choice(["走了。", "嗯……", "我替你守着", "（叹气）", "实话告诉你：来人！"])
        out.append((t, label, body))
    return out


def rule(rec):
    true = {"spk2": "云湛", "店家": "云湛", "竺枫昭": "竺遥昭"}
    turns, now, last = [], None, None
    for t, label, body in rec:
        if label:
            now = true.get(label[:-1], label[:-1])
        if body in ("嗯……", "（叹气）"):
            continue
        if not turns or now != last:
            turns.append([t, now, []])
        turns[-1][2].append(body)
        last = now
    return [(t, w, "\n".join(x), len(x)) for t, w, x in turns]


@pytest.mark.parametrize("section,most", [(3600, 512), (40, 512), (3600, 3), (100, 1)])
def test_turns_equal_the_rule_in_sections_of_any_length(spark, section, most):
    rng = random.Random(7)
    recs = {o: random_recording(rng, rng.randint(1, 30)) for o in range(12)}
    chunks = {}
    for o, rec in recs.items():
        text = lambda ls: "\n".join(f"({t // 60:02d}:{t % 60:02d}) {a}{b}" for t, a, b in ls)
        h = len(rec) // 2
        # the second chunk repeats the last line of the first; chunks come twice
        parts = [(0, 0.0, text(rec[:h]), None), (1, float(rec[h][0]), text(rec[max(0, h - 1) :]), None)]
        chunks[o] = parts + parts[:1]
    al, sc = tables(spark)
    got = {}
    for r in S.speaker_turns(make(spark, chunks), al, sc, S.TurnModel(np.array(S.DEFAULT_WEIGHTS)), section, most).collect():
        got.setdefault(r.orig_index, []).append((r.start_ms // 1000, r.speaker, r.text, r.lines))
    assert {o: sorted(x) for o, x in got.items()} == {o: x for o, rec in recs.items() if (x := rule(rec))}


def test_lines_said_again_stay(spark):
    """Equal lines of one chunk without times all count, also where the next chunk has them too; a chunk delivered twice counts once."""
    al, sc = tables(spark)
    text = "云湛：走\n走\n走\n来\n走"
    one = S.speaker_turns(make(spark, {1: [(0, 0.0, text, None), (0, 0.0, text, None)]}), al, sc).collect()
    assert [(r.text, r.lines) for r in one] == [("走\n走\n走\n来\n走", 5)]
    stamped = "(00:01) 云湛：走\n(00:01) 走\n(00:02) 来"
    two = S.speaker_turns(make(spark, {1: [(0, 0.0, stamped, None), (1, 1.0, "(00:01) 走\n(00:01) 走\n(00:02) 来\n(00:02) 来", None)]}), al, sc).collect()
    assert sorted(x for r in two for x in r.text.split("\n")) == ["来", "来", "走", "走", "走"]  # two of the chunks' lines at 00:01 are the same, one has a label


def test_turn_edges(spark):
    al, sc = tables(spark)
    df = make(spark, {1: [(0, 0.0, None, None), (1, None, "", None)], 2: [(None, None, "走了\n云湛：来人", None)], None: [(0, 0.0, "云湛：走", None)]})
    got = sorted((r.orig_index, r.start_ms, r.speaker, r.text) for r in S.speaker_turns(df, al, sc).collect() if r.speaker)
    assert got == [(2, 0, "云湛", "来人")]
    assert [r.text for r in S.speaker_turns(df, al, sc).collect() if r.speaker is None] == ["走了"]
    none = S.speaker_turns(df, al.where("false"), sc.where("false")).collect()
    assert [(r.orig_index, r.speaker) for r in none] == [(2, None)]
    assert not S.speaker_turns(df.where("false"), al, sc).collect()


def test_held_out_accuracy(spark):
    """Fitted on recordings of one table, the model finds the speakers of the lines of recordings that it has not seen."""
    from reelframe.session import read

    d = "/root/testdata/sf0.01"
    ch, al, sc = (read(spark, d, t) for t in ("chunk_text", "speaker_alias", "script_line"))
    lines = S.cut(S.transcript_lines(ch, al))
    model = S.fit_turn_model(lines.where("orig_index % 2 = 0"), sc)
    good = n = 0
    for x, speakers, gold in S.training_pieces(lines.where("orig_index % 2 = 1"), sc, 100_000):
        for lo, hi, s in model.decode(x, speakers):
            n += sum(y >= 0 for y in gold[lo:hi])
            good += sum(y == s for y in gold[lo:hi])
    assert n > 200 and good / n > 0.98
