"""p7, p8, p9: exact against brute force and round trips; nulls, empties, long texts, repeats, empty tables, clashing columns."""

import random
import unicodedata

import numpy as np
import pytest

from reelframe.llm.leakage import Leaks, SuffixAutomaton, decontaminate, leaked_items
from reelframe.llm.letters import letters
from reelframe.llm.packing import best_fit, pack, token_counts
from reelframe.llm.splitting import split_documents, split_text
from reelframe.llm.tokenizer import tokenizer

DOC = "doc_id long, text string, id long, item_id int, limit_id int, block string, n_tokens long"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, 1, 2, 3, "b", 4) for i, t in texts], DOC)


def plain(s):
    return "".join(c for c in unicodedata.normalize("NFKC", s).lower() if unicodedata.category(c)[0] == "L")


def test_letters_equal_the_library():
    rng = random.Random(1)
    pool = [chr(c) for c in [*range(0x20, 0x3400), *range(0xAC00, 0xAD00), *range(0xF900, 0xFB50), *range(0xFE00, 0xFFEF), 0x1D400, 0x2F800, 0x20000]]
    for _ in range(3000):
        t = "".join(rng.choices(pool, k=rng.randint(0, 15)))
        a, p = letters(t)
        assert "".join(map(chr, a)) == plain(t), t
        assert len(a) == len(p) and all(0 <= x < max(len(t), 1) for x in p)
    a, p = letters("Ａb，中1文")
    assert "".join(map(chr, a)) == "ab中文" and p.tolist() == [0, 1, 3, 5]


def test_automaton_longest_matches():
    rng = random.Random(2)
    for _ in range(60):
        texts = {i: np.array([rng.randint(1, 3) for _ in range(rng.randint(1, 25))], np.uint32) for i in range(4)}
        doc = [rng.randint(1, 3) for _ in range(40)]
        m, from_four = SuffixAutomaton(texts), SuffixAutomaton(texts, 4)
        has = lambda s: {i for i, t in texts.items() if any(t[k : k + len(s)].tolist() == s for k in range(len(t)))}
        got = {e: (n, v) for e, n, v in m.matches(doc, 1)}
        for e in range(1, len(doc) + 1):
            n = max((k for k in range(1, e + 1) if has(doc[e - k : e])), default=0)
            assert got.get(e, (0,))[0] == n
            if n:
                for run, items in m.holders(got[e][1], n, 1):
                    assert set(items) == has(doc[e - run : e])
                if n >= 4:
                    assert list(from_four.holders(got[e][1], n, 4)) == list(m.holders(got[e][1], n, 4))


def test_leaks_equal_brute_force():
    rng = random.Random(3)
    items = {i: np.array([rng.randint(97, 100) for _ in range(rng.randint(5, 60))], np.uint32) for i in range(12)}
    leaks = Leaks(items, 9)
    for _ in range(200):
        d = np.array([rng.randint(97, 100) for _ in range(rng.randint(0, 80))], np.uint32)
        if len(d) > 20 and rng.random() < 0.7:
            t = items[rng.randrange(12)]
            k = rng.randint(5, 14)
            d[3 : 3 + k] = np.resize(t[:k], k)
        grams = {d[k : k + 9].tobytes() for k in range(len(d) - 8)}
        want = {i for i, t in items.items() if any(t[k : k + 9].tobytes() in grams for k in range(len(t) - 8))}
        runs, spans = leaks.find(d)
        assert set(runs) == want and bool(spans) == bool(want)


def test_leaked_items_and_removal(spark):
    item = "夜市的算命摊主对着空椅子收养了鲸骨做的火柴盒于是全村的狗都安静下来盐商的女儿冒着沙尘拆下了航海日志"
    texts = [(1, "前文。" + item[:40] + "！后文"), (2, item[:31]), (3, None), (4, ""), (5, "，".join(item)), (5, "，".join(item)), (6, "无关的话" * 20000), (None, item)]
    items = spark.createDataFrame([(7, item, "s"), (7, item, "s"), (8, item[5:45], "s"), (9, None, "s"), (None, item, "s"), (10, "", "s")], "item_id int, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in leaked_items(docs(spark, texts), items).collect()}
    assert got == {(1, 7), (1, 8), (5, 7), (5, 8), (None, 7), (None, 8)}
    runs = {(r.doc_id, r.item_id): r.longest_run for r in leaked_items(docs(spark, texts), items).collect()}
    assert runs[1, 7] == 40 and runs[1, 8] == 35
    left = {r.doc_id: r for r in decontaminate(docs(spark, [(1, "前文。" * 30 + item[:40] + "！后文"), (2, item), (3, "x")]), items).collect()}
    assert left[1].action == "trim" and left[1].text == "前文。" * 30 + "！后文" and left[1].covered == 40
    assert left[2].action == "drop" and left[2].text is None and set(left) == {1, 2}
    # A pass over the documents for each of several shards gives the same.
    assert sorted(map(repr, leaked_items(docs(spark, texts), items, shard_letters=45).collect())) == sorted(map(repr, leaked_items(docs(spark, texts), items).collect()))
    whole, parts = (decontaminate(docs(spark, texts), items, shard_letters=n).collect() for n in (1_000_000, 45))
    assert len(whole) == 4 and sorted(map(repr, whole)) == sorted(map(repr, parts))
    assert not leaked_items(docs(spark, []), items).collect()
    assert not leaked_items(docs(spark, texts), items.where("false")).collect()


def test_best_fit_meets_every_constraint():
    rng = random.Random(4)
    for cap, most, cost in ((100, 4, 10_000), (100, 50, 4_000), (64, 8, 4096)):
        sizes = sorted((rng.randint(1, min(cap, int(cost**0.5))) for _ in range(400)), reverse=True)
        bins = {}
        for n, b in zip(sizes, best_fit(sizes, cap, most, cost)):
            bins.setdefault(b, []).append(n)
        assert all(sum(x) <= cap and len(x) <= most and sum(n * n for n in x) <= cost for x in bins.values())
        bound = max(-(-sum(sizes) // cap), -(-len(sizes) // most), -(-sum(n * n for n in sizes) // cost))
        assert len(bins) <= 1.2 * bound + 1
    assert best_fit([], 5, 1, 25) == [] and best_fit([5, 5, 3, 2], 5, 9, 25) == [0, 1, 2, 2]
    assert best_fit([9, 6, 3, 3], 10, 9, 50) == [0, 1, 1, 2]  # 81 is above the cost of a bin by itself; 36 + 9 + 9 of three together


def test_best_fit_takes_the_least_norm_of_all_open_bins():
    from reelframe.llm.packing import WEIGHTS

    rng = random.Random(6)
    for cap, most, cost in ((100, 6, 10_000), (50, 50, 900)):
        sizes = sorted((rng.randint(1, 28) for _ in range(500)), reverse=True)
        bins, want = [], []
        for n in sizes:
            fits = [(sum(w * (v / c) ** 2 for w, v, c in zip(WEIGHTS, (t - n, k - 1, a - n * n), (cap, most, cost))), b) for b, (t, k, a) in enumerate(bins) if t >= n and k >= 1 and a >= n * n]
            b = min(fits, key=lambda x: (round(x[0], 12), x[1]))[1] if fits else len(bins)
            if not fits:
                bins.append((cap, most, cost))
            t, k, a = bins[b]
            bins[b] = (t - n, k - 1, a - n * n)
            want.append(b)
        assert best_fit(sizes, cap, most, cost) == want


def test_rows_of_one_id_are_spread_over_the_blocks(spark):
    """A third of all rows of one id, a third of a null id: no block takes much more than its share."""
    rng = random.Random(3)
    rows = [(i if i % 3 == 0 else 5 if i % 3 == 1 else None, rng.randint(1, 90)) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, n_tokens long")
    got = pack(df, [(1, 1000)], block_items=300).collect()
    share = {}
    for r in got:
        if not r.container_id >> 61:  # not those that were opened again
            share[r.container_id >> 31] = share.get(r.container_id >> 31, 0) + 1
    assert len(share) >= 15 and max(share.values()) < 450 and sum(r.n_tokens for r in got) == sum(n for _, n in rows)
    low = pack(df, [(1, 1000)], attention=0.02).collect()
    cost = {}
    for r in low:
        cost[r.container_id] = cost.get(r.container_id, 0) + r.n_tokens**2
    assert max(cost.values()) <= 20_000 and len(cost) > len({r.container_id for r in got}) and sum(r.n_tokens for r in low) == sum(n for _, n in rows)


def test_pack_whole_and_full(spark):
    rng = random.Random(5)
    sizes = [(i, rng.choice([1, 3, 20, 99, 100, 101, 350, 1000])) for i in range(600)] + [(7000, 0), (7001, None), (7002, 100), (7002, 100)]
    df = spark.createDataFrame([(i, n, 1, 2) for i, n in sizes], "id long, n_tokens long, block int, bin int")
    got = pack(df, [(1, 100), (2, 1000), (3, None), (4, 0)], block_items=100).collect()
    for limit, cap in ((1, 100), (2, 1000)):
        rows = [r for r in got if r.limit_id == limit]
        fill, docs_ = {}, {}
        for r in rows:
            fill[r.container_id] = fill.get(r.container_id, 0) + r.n_tokens
            docs_[r.container_id] = docs_.get(r.container_id, 0) + 1
        assert max(fill.values()) <= cap and max(docs_.values()) <= max(1, cap // 8)
        total = sum(n or 0 for _, n in sizes)
        assert sum(fill.values()) == total and total / cap / len(fill) > 0.93
        by = {}
        for r in rows:
            by.setdefault(r.id, []).append((r.token_start, r.n_tokens))
        for i, n in sizes:
            if n and n <= cap:
                assert all(x == (0, n) for x in by[i])
            elif n:
                assert sorted(by[i]) == [(s, min(cap, n - s)) for s in range(0, n, cap)]
    assert {r.limit_id for r in got} == {1, 2}
    assert not pack(df.where("false"), [(1, 100)]).collect() and not pack(df, []).collect()


def test_token_counts(spark):
    texts = [(1, "你好，world"), (2, None), (3, ""), (4, "x" * 300_000), (4, "again")]
    got = sorted((r.id, r.n_tokens) for r in token_counts(docs(spark, texts)).collect())
    assert got == sorted((i, tokenizer().count(t or "")) for i, t in texts)


TEXTS = [
    "1-1\n地点：天台 夜 外\n" + "墨荻：老管事明明埋下了一整箱银票，她在祠堂门口挡住了宴会的请帖？\n" * 9 + "\n1-2\n地点：桥头\n" + "旁白：我早就骗走了宴会的请帖。\n" * 30,
    "".join(f"{i}\r\n00:00:{i:02d},000 --> 00:00:{i + 1:02d},000\r\n他们居然卖掉了她的名字\r\n\r\n" for i in range(50)),
    "the rough mix softens three frames of black near the frozen well " * 60,
    "无" * 3000,
    "a" * 5000,
    '[{"id":0,"line":"老管事早就守着北门的守卫"},' * 80,
    "😀👩‍👩‍👧 𠀀" * 300,
    "短",
]


def test_split_round_trip(spark):
    tok = tokenizer()
    limits = [(1, 64, 8), (2, 200, 0), (3, 128, 500), (4, None, 3)]
    df = docs(spark, [*enumerate(TEXTS), (100, None), (101, ""), (102, TEXTS[0]), (102, TEXTS[0])])
    got = {}
    for r in split_documents(df, limits).collect():
        got.setdefault((r.limit_id, r.doc_id), []).append(r)
    for i, t in enumerate(TEXTS):
        for limit, most, overlap in limits[:2]:
            rows = sorted(got.get((limit, i), []), key=lambda r: r.piece)
            assert bool(rows) == (tok.count(t) > most)
            pos = 0
            for r in rows:
                assert r.core_start == pos and r.start <= pos < r.end and r.text == t[r.start : r.end]
                assert tok.count(r.text) <= most
                if overlap and r.piece:
                    assert tok.count(t[r.start : r.core_start]) >= overlap - 4
                pos = r.end
            assert not rows or (pos == len(t) and rows[-1].boundary == "end")
    assert all(r.boundary in ("scene", "cue", "line", "end") for r in got[2, 0])
    assert {r.boundary for r in got[1, 1]} <= {"cue", "line", "end"}
    assert len(got[1, 102]) == 2 * len(got[1, 0])
    assert not {i for _, i in got} & {100, 101, 7} and {k for k, _ in got} == {1, 2, 3}
    assert not split_documents(df.where("false"), limits).collect() and not split_documents(df, []).collect()


@pytest.mark.parametrize("text, kinds", [
    ("".join(f"{k}-1\n地点 山门\n" + "守门的人答应了两匹快马，你今晚赢回了那间密室\n" * 6 for k in range(1, 9)), {"scene", "line", "end"}),
    ("".join(f"{k}\n00:00:{k:02},000 --> 00:00:{k:02},900\n守门的人答应了两匹快马，别再提了\n\n" for k in range(1, 50)), {"cue", "end"}),
])
def test_line_ends_are_alike(text, kinds):
    """A screenplay and an SRT with \\r or \\r\\n are cut at the same places as with \\n."""
    tok = tokenizer()
    got = {}
    for end in ("\n", "\r", "\r\n"):
        t = text.replace("\n", end)
        ps = [p for p in split_text(t, tok, [(1, 200, 0)])]
        assert {p[-1] for p in ps} <= kinds and len(ps) > 2
        got[end] = [(t[p[3] : p[4]].replace(end, "\n"), p[-1]) for p in ps]
        assert "".join(x for x, _ in got[end]) == text
    assert got["\r"] == got["\n"]


def test_leaks_in_characters_that_expand(spark):
    """A document of fewer bytes than the run has letters can hold it, since NFKC expands characters."""
    text = "\ufdfa" * 3  # 9 bytes, 45 letters
    items = spark.createDataFrame([(1, unicodedata.normalize("NFKC", text))], "item_id int, text string")
    docs = spark.createDataFrame([(1, text), (2, "\ufdfa" * 2), (3, "abc")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in leaked_items(docs, items).collect()] == [(1, 1)]
    assert [(r.doc_id, r.action) for r in decontaminate(docs, items).collect()] == [(1, "drop")]
