import random

from reelframe.operators.intervals import periods_and_gaps

SCHEMA = "track string, episode string, s long, e long, kind string, start_ms long, _key int"


def brute(rows, limit):
    by = {}
    for t, ep, s, e, *_ in rows:
        if s is not None and e is not None and e > s:
            by.setdefault((t, ep), []).append((s, e))
    out = set()
    for (t, ep), ivs in by.items():
        merged = []
        for s, e in sorted(ivs):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out |= {(t, ep, "period", s, e) for s, e in merged}
        out |= {(t, ep, "gap", a[1], b[0]) for a, b in zip(merged, merged[1:]) if limit is None or b[0] - a[1] < limit}
    return out


def run(spark, rows, limit, **kw):
    got = [tuple(r) for r in periods_and_gaps(spark.createDataFrame(rows, SCHEMA), ["track", "episode"], "s", "e", limit, **kw).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_equals_brute_force_with_any_bucket(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(900):
        s = rng.choice([None, rng.randint(-50, 4000), rng.randint(0, 100) * 10])
        e = None if rng.random() < 0.05 or s is None else s + rng.randint(-5, 30)
        ep = rng.choice(["a", "a", "a", "b", None])
        rows.append((rng.choice(["w", "c"]), ep, s, e, "x", 5, 1))
    rows += rows[:50]
    for limit, bucket in ((None, 600_000), (40, 7), (100, 500)):
        assert run(spark, rows, limit, bucket_ms=bucket) == brute(rows, limit)


def test_edges(spark):
    assert run(spark, [], 10) == set()
    assert run(spark, [("w", "a", None, None, "", 0, 0), ("w", "a", 5, 5, "", 0, 0), ("w", "a", 9, 3, "", 0, 0)], 10) == set()
    touch = [("w", "a", 0, 10, "", 0, 0), ("w", "a", 10, 20, "", 0, 0), ("w", "a", 2, 3, "", 0, 0), ("w", "a", 30, 40, "", 0, 0), ("w", "a", 30, 40, "", 0, 0)]
    assert run(spark, touch, 10) == {("w", "a", "period", 0, 20), ("w", "a", "period", 30, 40)}
    assert run(spark, touch, 11) == {("w", "a", "period", 0, 20), ("w", "a", "gap", 20, 30), ("w", "a", "period", 30, 40)}
