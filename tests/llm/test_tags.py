"""p1, p4, p5, p6: brute force, nulls, empties, ties, repeats, empty tables, clashing columns."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reelframe.llm.ngram_counts import marked, ngram_counts
from reelframe.llm.pair_table import PairTable
from reelframe.llm.set_join import similar_pairs
from reelframe.llm.tags import compared, current_rows
from reelframe.llm.varied_subset import varied_subset

SETS = "id long, tokens array<string>, class string, t string, c long, sig long, h string"


def rows_of(sets):
    return [(i, t, "x", "y", 1, 2, "z") for i, t in sets]


def random_sets(n, seed, vocab=30, size=9):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = rng.randint(0, size)
        toks = [f"t{min(int(rng.expovariate(0.15)), vocab)}" for _ in range(k)]
        out.append((i * 3, toks + ([None, ""] if rng.random() < 0.1 else [])))
    for i in range(n // 4):  # near copies and copies
        a = list(out[rng.randrange(n)][1])
        if a and rng.random() < 0.7:
            a[rng.randrange(len(a))] = f"t{rng.randint(0, vocab)}"
        out.append((100_000 + i, a))
    return out


def truth(sets, num, den, other=None):
    clean = lambda s: {i: frozenset(x for x in t or [] if x) for i, t in s if i is not None}
    a = clean(sets)
    pairs = itertools.combinations(sorted(a), 2) if other is None else itertools.product(a, clean(other))
    b = a if other is None else clean(other)
    return {(x, y) for x, y in pairs if a[x] and b[y] and len(a[x] & b[y]) * den >= len(a[x] | b[y]) * num}


def expanded(pairs, members, two=False):
    ms = {}
    for r in members.collect():
        ms.setdefault(r["class"], []).append((r["id"], r["side"] if two else 0))
    out = set()
    for p in pairs.collect():
        for (x, sx), (y, sy) in itertools.product(ms[p.class_a], ms[p.class_b]):
            if not two:
                if x != y:
                    out.add((min(x, y), max(x, y)))
            elif sx == 0 and sy == 1:
                out.add((x, y))
    return out


@pytest.mark.parametrize("threshold,num,den,seed", [(0.6, 3, 5, 1), (0.8, 4, 5, 2), (0.5, 1, 2, 3), (0.3, 3, 10, 4)])
def test_similar_pairs_equals_brute_force(spark, threshold, num, den, seed):
    sets = random_sets(160, seed, size=14 if seed == 2 else 9) + [(None, ["a", "b"]), (7, None), (8, [])]
    df = spark.createDataFrame(rows_of(sets + sets[:20]), SETS)
    assert expanded(*similar_pairs(df, threshold)) == truth(sets, num, den)


def test_similar_pairs_of_two_tables(spark):
    a = random_sets(80, 5)
    b = [(i + 1_000_000, t) for i, t in random_sets(80, 6)] + [(i + 2_000_000, t) for i, t in random_sets(80, 5)[:15]]
    got = similar_pairs(spark.createDataFrame(rows_of(a), SETS), 0.6, right=spark.createDataFrame(rows_of(b), SETS))
    assert expanded(*got, two=True) == truth(a, 3, 5, b)


def test_similar_pairs_long_sets_and_empty(spark):
    base = [f"w{i}" for i in range(400)]
    sets = [(1, base), (2, base[:330]), (3, base[:200]), (4, base[100:] + ["x"])]
    assert expanded(*similar_pairs(spark.createDataFrame(rows_of(sets), SETS), 0.6)) == truth(sets, 3, 5)
    p, m = similar_pairs(spark.createDataFrame([], SETS), 0.6)
    assert not p.collect() and not m.collect()


def test_pair_table_follows_changes(spark):
    rng = random.Random(3)
    table = PairTable(spark, buckets=4)
    now = {}
    for _ in range(3):
        changed = {i: [rng.choice(["a", "b", "c", "d", None, "e"]) for _ in range(rng.randint(0, 5))] for i in range(30) if rng.random() < 0.7}
        rows = [(i, now.get(i), t if i % 7 else None, 1) for i, t in changed.items()]
        table.apply(spark.createDataFrame(rows, "a long, old array<string>, new array<string>, d int"), "old", "new")
        now |= {i: r[2] for i, r in zip(changed, rows)}
        bags = [sorted({x for x in t or [] if x}) for t in now.values()]
        bags = [b for b in bags if b]
        ones, twos = Counter(x for b in bags for x in b), Counter(p for b in bags for p in itertools.combinations(b, 2))
        got = {(r.a, r.b): (r.n, r.n_a, r.n_b, r.n_ab, round(r.lift, 9)) for r in table.scores().collect()}
        assert got == {(a, b): (len(bags), ones[a], ones[b], n, round(n * len(bags) / ones[a] / ones[b], 9)) for (a, b), n in twos.items()}
    table.apply(spark.createDataFrame([], "old array<string>, new array<string>"), "old", "new")
    assert table.scores().count() == len(twos)
    assert table.scores(table.changed_items()).count() == 0


def test_pair_table_is_kept_on_disk(spark, tmp_path, monkeypatch):
    """Closed and opened again between batches; a batch that fails half-way leaves nothing and can be tried again; a batch given again counts once."""
    schema = "old array<string>, new array<string>"
    path = f"file://{tmp_path}/pairs"
    first, second = [(None, ["a", "b"]), (None, ["a", "b", "c"]), (None, [])], [(["a", "b"], ["b", "c", "c"]), (None, ["a"])]
    counts = lambda t: (t.n, {r.a: r.n_a for r in t.items().collect()}, {(r.a, r.b): r.n_ab for r in t.pairs().collect()})
    PairTable(spark, path, buckets=3).apply(spark.createDataFrame(first, schema), "old", "new", "one")
    one = (2, {"a": 2, "b": 2, "c": 1}, {("a", "b"): 2, ("a", "c"): 1, ("b", "c"): 1})
    assert counts(PairTable(spark, path)) == one
    t = PairTable(spark, path)
    assert (t.version, t._state["buckets"]) == (1, 3)
    with monkeypatch.context() as m:
        m.setattr(PairTable, "_publish", lambda self, state: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            t.apply(spark.createDataFrame(second, schema), "old", "new", "two")
    assert counts(t) == one == counts(PairTable(spark, path))
    for _ in range(2):
        t.apply(spark.createDataFrame(second, schema), "old", "new", "two")
    two = (3, {"a": 2, "b": 2, "c": 2}, {("a", "b"): 1, ("a", "c"): 1, ("b", "c"): 2})
    assert counts(t) == two == counts(PairTable(spark, path)) and t.version == 2
    late = PairTable(spark, path)
    late._state = {**late._state, "version": 1}  # a writer who has missed the second batch
    with pytest.raises(RuntimeError):
        late.apply(spark.createDataFrame(first, schema), "old", "new")
    assert counts(PairTable(spark, path)) == two


def test_long_basket_is_paired_item_by_item(spark):
    t = PairTable(spark, buckets=2)
    t.apply(spark.createDataFrame([(None, [f"i{k:04d}" for k in range(700)])], "old array<string>, new array<string>"), "old", "new")
    assert t.pairs().count() == 700 * 699 // 2 and t.items().count() == 700


@pytest.mark.parametrize("salts", [1, 3])
def test_ngram_counts_equal_brute_force(spark, salts):
    rng = random.Random(4)
    seqs = [[rng.choice(["a", "b", "c", None]) for _ in range(rng.randint(0, 7))] for _ in range(60)] + [None, [], ["a"] * 40]
    df = spark.createDataFrame([(s, s[:1] if s else s, "q", 3) for s in seqs], "x array<string>, y array<string>, field string, n int")
    got = {(r.field, tuple(r.ngram)): (r.occurrences, r.records) for r in ngram_counts(df, {"x": "x", "y": "y"}, 3, salts=salts).collect()}
    occ, rec = Counter(), Counter()
    for f, cut in (("x", None), ("y", 1)):
        for s in seqs:
            t = [v for v in (s[:cut] if s else []) if v]
            grams = [(f, tuple(t[i : i + k])) for i in range(len(t)) for k in (1, 2, 3) if i + k <= len(t)]
            occ.update(grams)
            rec.update(set(grams))
    assert got == {g: (occ[g], rec[g]) for g in occ}


def test_ngram_counts_of_long_records(spark):
    """Records of tens of thousands of terms, as documents have them."""
    rng = random.Random(8)
    seqs = [[f"w{min(int(rng.expovariate(0.01)), 400)}" for _ in range(20_000)] for _ in range(3)]
    got = {tuple(r.ngram): (r.occurrences, r.records) for r in ngram_counts(spark.createDataFrame([(s,) for s in seqs], "x array<string>"), {"x": "x"}, 2).collect()}
    occ, rec = Counter(), Counter()
    for t in seqs:
        grams = [tuple(t[i : i + k]) for k in (1, 2) for i in range(len(t) - k + 1)]
        occ.update(grams)
        rec.update(set(grams))
    assert got == {g: (occ[g], rec[g]) for g in occ}


def test_ngram_counts_empty_and_marks(spark):
    assert not ngram_counts(spark.createDataFrame([], "x array<string>"), {"x": "x"}, 2).collect()
    c = spark.createDataFrame([(1,), (2,), (3,), (18,), (19,)], "records long")
    assert [r.mark for r in marked(c, 100, 2, 0.18).orderBy("records").collect()] == ["rare", "rare", None, None, "common"]


def test_current_rows_and_compared_form(spark):
    assert [compared(x) for x in (None, "", " Ｌｏ-Fi　", "ambient pad")] == ["", "", "lo-fi", "ambientpad"]
    rows = [(1, "a", 2), (1, "b", 3), (1, "b", 3), (2, "c", None), (2, "d", 1), (None, "e", 9), (3, None, None)]
    got = {r.k: r.v for r in current_rows(spark.createDataFrame(rows, "k long, v string, at int"), "k", "at", ["v"]).collect()}
    assert got == {1: "b", 2: "d", 3: None}


def test_varied_subset_covers_before_it_repeats(spark):
    groups = {f"m{i}": [i * 1000 + j for j in range(200 if i == 0 else 3)] for i in range(12)}
    rows = [(i, [g], [None], "x", 5) for g, ids in groups.items() for i in ids] + [(None, ["z"], None, "x", 5), (99_000, [], None, "x", 5), (99_001, None, None, "x", 5)]
    df = spark.createDataFrame(rows, "id long, emotion array<string>, style array<string>, idx string, copies int")
    got = varied_subset(df, 12, "id", ["emotion", "style"]).orderBy("pick").collect()
    assert len({r.id // 1000 for r in got}) == 12 and [r.pick for r in got] == list(range(1, 13))
    assert max(r.copies for r in got) == 200 and got[0].id == 0
    # more than the distinct sets: second copies, then third ones; rows without features last; never an id twice
    got = varied_subset(df, 30, "id", ["emotion", "style"]).collect()
    assert len({r.id for r in got}) == 30 and Counter(r.id // 1000 for r in got)[0] <= 3
    every = varied_subset(df, 10_000, "id", ["emotion", "style"]).collect()
    assert {r.id for r in every} == {i for ids in groups.values() for i in ids} | {99_000, 99_001}
    assert {r.id for r in every if r.pick > len(every) - 2} == {99_000, 99_001}


def test_varied_subset_edges(spark):
    schema = "id long, emotion array<string>"
    assert not varied_subset(spark.createDataFrame([], schema), 5, "id", ["emotion"]).collect()
    df = spark.createDataFrame([(1, ["a"]), (1, ["b"]), (2, ["a", "a", None]), (3, ["b", "a"])], schema)
    assert not varied_subset(df, 0, "id", ["emotion"]).collect()
    assert sorted(r.id for r in varied_subset(df, 9, "id", ["emotion"]).collect()) == [1, 2, 3]


def test_varied_subset_beats_chance(spark):
    """Of a skewed catalogue the picks hold more distinct tags than a random choice of as many rows."""
    rng = random.Random(9)
    tags = [f"t{i}" for i in range(40)]
    rows = [(i, [tags[min(int(rng.expovariate(0.25)), 39)] for _ in range(3)]) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, emotion array<string>")
    by = dict(rows)
    got = {t for r in varied_subset(df, 12, "id", ["emotion"]).collect() for t in by[r.id]}
    chance = sum(len({t for i in rng.sample(range(3000), 12) for t in by[i]}) for _ in range(200)) / 200
    assert len(got) > 1.3 * chance


def test_features_have_dimensions_of_their_own(spark, monkeypatch):
    """More features than any fixed number of dimensions, and more picks: all rows independent of one another are chosen before any other."""
    import reelframe.llm.varied_subset as V

    monkeypatch.setattr(V, "LEAF_ROWS", 4000)
    rows = [(i, [f"own{i}", "all"]) for i in range(6000)] + [(10_000 + i, [f"own{i}", f"own{i + 1}"]) for i in range(0, 5000)]
    df = spark.createDataFrame(rows, "id long, emotion array<string>")
    got = varied_subset(df, 200, "id", ["emotion"]).orderBy("pick").collect()
    by = dict(rows)
    seen = [{t for r in got[: k + 1] for t in by[r.id]} for k in range(200)]
    assert all(len(b) > len(a) for a, b in zip(seen, seen[1:])) and len({r.id for r in got}) == 200


def test_tournament_against_the_whole(spark, monkeypatch):
    """Pivoting all rows at once gives what plain Gram-Schmidt does, the tournament of one leaf the same, and that of many picks that add nearly as much."""
    import numpy as np
    import pandas as pd

    import reelframe.llm.varied_subset as V

    rng = random.Random(12)
    rows = [(i, sorted({f"t{min(int(rng.expovariate(0.08)), 90)}" for _ in range(4)})) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, emotion array<string>")
    n = Counter(t for _, ts in rows for t in ts)
    names = {t: i for i, t in enumerate(n)}
    sets = sorted({tuple(ts) for _, ts in rows})
    pdf = pd.DataFrame({"id": range(len(sets)), "idx": [[names[t] for t in ts] for ts in sets], "val": [[np.log1p(n[t]) ** 0.5 for t in ts] for ts in sets]})
    dense = np.zeros((len(sets), len(names)))
    for r, (i, v) in enumerate(zip(pdf["idx"], pdf["val"])):
        dense[r, i] = v

    greedy, _, residuals = V.pivoted_rows(pdf, V.Basis.empty(), 24)
    left = dense.copy()
    for i in greedy:  # against plain Gram-Schmidt with pivoting
        norms = (left**2).sum(axis=1)
        assert norms[i] > norms.max() - 1e-6
        d = left[i] / np.sqrt(norms[i])
        left -= np.outer(left @ d, d)
    one = [r.residual for r in varied_subset(df, 24, "id", ["emotion"]).orderBy("pick").collect()]
    assert np.allclose(one, residuals)
    monkeypatch.setattr(V, "LEAF_ROWS", 200)
    many = [r.residual for r in varied_subset(df, 24, "id", ["emotion"]).orderBy("pick").collect()]
    assert all(b > 0.95 * a for a, b in zip(residuals, many)) and np.log(many).sum() > np.log(residuals).sum() - 0.5


def test_tournament_is_the_same_for_any_number_of_leaves(spark, monkeypatch):
    import reelframe.llm.varied_subset as V

    rng = random.Random(2)
    rows = [(i, [f"t{rng.randint(0, 60)}" for _ in range(4)]) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, emotion array<string>").withColumn("emotion", F.col("emotion"))
    one = {t for r in varied_subset(df, 15, "id", ["emotion"]).collect() for t in dict(rows)[r.id]}
    monkeypatch.setattr(V, "LEAF_ROWS", 150)
    many = varied_subset(df, 15, "id", ["emotion"]).collect()
    assert len({r.id for r in many}) == 15
    assert len({t for r in many for t in dict(rows)[r.id]}) > 0.85 * len(one)
