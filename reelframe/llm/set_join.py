"""All similar pairs between set-valued records: exact Jaccard join by pigeonhole partitioning."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.session import cut

#: A token in more than 1/HEAVY of all records is heavy. A set of mean size s has at most HEAVY * s of them,
#: whatever the number of records: this is the proven bound of the only table that is sent to all executors.
HEAVY = 256
_EXACT, _LESS = 0, 1


def _need(a: int, b: int, num: int, den: int) -> int:
    """The largest symmetric difference of sets of sizes a and b with Jaccard >= num/den; negative: there is none."""
    common = -((-num * (a + b)) // (num + den))
    return a + b - 2 * common if common <= min(a, b) else -1


def _segments_of(size: int) -> tuple[int, int]:
    """Segments for light and for heavy tokens that a record of this size is split into."""
    m = 8
    while m < size:
        m *= 2
    return m - m // 4, m // 4


def _schemes(size: int, lengths: Callable[[int], range]) -> list[int]:
    """The numbers of segments under which a record of this size must be found by longer or shorter records."""
    return sorted({sum(_segments_of(b)) for b in lengths(size)})


_MIX = np.uint64(0x9E3779B97F4A7C15)
_KINDS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 bits of each value, well mixed (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x += _MIX
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(size: int, m: int, kind: int) -> np.ndarray:
    """What tells apart the segments of a scheme, the sizes and the kinds in a signature: one value a segment."""
    return _mixed(np.arange(m, dtype=np.uint64) + np.uint64((size << 32) | (m << 8)) ^ _KINDS[kind])


class _Split:
    """Records of one size under a scheme of m segments: where each token lies, and the sum of the mixed tokens of each segment.

    A sum does not depend on order, and a segment without a token is its sum less that token: signatures after a deletion cost one subtraction.
    """

    def __init__(self, t: np.ndarray, mixed: np.ndarray, heavy: np.ndarray, m: int) -> None:
        dense = m // 4
        place = (t >> 7).astype(np.int64)
        self.m, self.mixed = m, mixed
        self.seg = np.where(heavy, m - dense + place % dense, place % (m - dense))
        self.row = np.arange(len(t))[:, None]
        self.sum, self.count = np.zeros((len(t), m), np.uint64), np.zeros((len(t), m), np.int64)
        np.add.at(self.sum, (self.row, self.seg), mixed)
        np.add.at(self.count, (self.row, self.seg), 1)

    def exact(self, keys: np.ndarray) -> np.ndarray:
        return _mixed(self.sum ^ keys)

    def less(self, keys: np.ndarray) -> np.ndarray:
        """The signature of each token's segment without it."""
        return _mixed((self.sum[self.row, self.seg] - self.mixed) ^ keys[self.seg])


def _order(split: _Split, logp: np.ndarray, n: int) -> np.ndarray:
    """For each record and segment the ranks of the thresholds 0 and 1 (rows, m, 2) by what they add to the candidates expected.

    If two sets differ in at most ``need`` tokens and the chosen segments have thresholds t, with
    sum(t + 1) = need + 1, some chosen segment differs in at most its t tokens. A segment's second step costs at least as much as
    its first, so that the need + 1 least steps are the cheapest choice.
    """
    rows, m = split.sum.shape
    total = np.zeros((rows, m))
    np.add.at(total, (split.row, split.seg), logp)

    def expected(log: np.ndarray, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, np.maximum(1.0, n * np.exp(log)), 0.7 * n)

    first = expected(total, split.count)
    second = 2 * first
    np.add.at(second, (split.row, split.seg), expected(total[split.row, split.seg] - logp, split.count[split.row, split.seg] - 1))
    steps = np.stack((first, np.maximum(second, first)), axis=2).reshape(rows, 2 * m)
    ranks = np.empty((rows, 2 * m), np.int64)
    np.put_along_axis(ranks, np.argsort(steps, axis=1, kind="stable"), np.arange(2 * m)[None, :].repeat(rows, 0), axis=1)
    return ranks.reshape(rows, m, 2)


def _sketches(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits, one flipped by each token: the bits of two sketches differ in no more places than the sets."""
    k = ((t ^ (t >> 31)) & 127).astype(np.uint64)
    bit = np.uint64(1) << (k & np.uint64(63))
    zero = np.uint64(0)
    return tuple(np.bitwise_xor.reduce(np.where(half, bit, zero), axis=1).view(np.int64) for half in (k < 64, k >= 64))


def _by_size(pdf: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, classes, tokens as a matrix) of the records of each size."""
    sizes = pdf["t"].map(len).to_numpy()
    for z in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == z)
        step = max(1, 2_000_000 // max(z, 1))  # the matrices of a step stay small, however long the sets
        for k in range(0, len(at), step):
            part = at[k : k + step]
            yield z, pdf["c"].to_numpy()[part], np.stack([np.asarray(x, np.int64) for x in pdf["t"].iloc[part]])


def similar_pairs(left: DataFrame, threshold: float, id_col: str = "id", set_col: str = "tokens", right: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """All pairs of sets with Jaccard similarity >= ``threshold``, between the classes of equal sets.

    ``left`` (and ``right``, if two tables are joined) hold an id (long) and an array<string>. Returns
    (pairs, members): pairs(class_a, class_b, common, size_a, size_b), for one table with class_a <= class_b (class_a = class_b for
    a class of several records), and members(class, id[, side]). A class is the least id of the records with one set; in a join of two tables equal sets
    on both sides share the class, pairs then also holds (class, class) for sets present on both sides, and each
    other pair once, class_a being that of the left record.

    Exact: the universe is split into segments (their number depends on the length), an allocation of thresholds
    0 and 1 per segment guarantees by the pigeonhole principle that each similar pair agrees in a segment or after one
    deletion, and candidates are verified on their sets. Frequent tokens get segments of their own, so that the
    allocation can lean on rare ones; this only saves candidates.

    Defined results: null ids, null and empty sets take part in no pair; null and empty tokens and repeats within a set
    do not count; repeated rows are one record; empty tables give no pairs; other columns are ignored.
    """
    num, den = (lambda f: (f.numerator, f.denominator))(__import__("fractions").Fraction(str(threshold)))
    both = right is not None

    def norm(df: DataFrame, side: int) -> DataFrame:
        toks = F.array_distinct(F.filter(F.array_compact(F.col(f"`{set_col}`")), lambda t: t != ""))
        return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.array_sort(F.transform(toks, lambda t: F.xxhash64(t))).alias("t"), F.lit(side).alias("side"))

    rows = norm(left, 0) if right is None else norm(left, 0).unionByName(norm(right, 1))
    rows = rows.where(F.col("id").isNotNull() & (F.size("t") > 0)).distinct()
    # Equal sets become one class before anything is joined: copies cost nothing, however many.
    # The class of a row: equal sets have equal digests of their sorted tokens; 128 bits make a clash of sets impossible in practice.
    digest = F.md5(F.concat_ws(",", F.col("t").cast("array<string>")))
    rows = cut(rows.withColumn("h", digest))
    classes = cut(rows.groupBy("h").agg(F.min("id").alias("c"), F.max("side").alias("hi"), F.min("side").alias("lo"), F.any_value("t").alias("t"), F.count(F.lit(1)).alias("k")))
    n = classes.count()
    # Merge joins throughout: what has been cut from its lineage has no true size that could warrant a broadcast.
    members = rows.join(classes.select("h", F.col("c").alias("class")).hint("merge"), "h").select("class", "id", *(["side"] if both else []))

    df = classes.select(F.explode("t").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    heavy = {r[0]: r[1] for r in df.where(F.col("n") * HEAVY > n).collect()}

    def shorter(b: int) -> range:
        return range(-(-num * b // den), b + 1)

    def longer(a: int) -> range:
        return range(a, den * a // num + 1)

    tokens, weight = np.array(sorted(heavy), np.int64), np.log([heavy[t] / n for t in sorted(heavy)])
    floor = -math.log(4 * HEAVY)

    def marked(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which tokens are heavy, and the logarithm of each one's share of the records."""
        if not len(tokens):
            return np.zeros(t.shape, bool), np.full(t.shape, floor)
        at = np.minimum(np.searchsorted(tokens, t), len(tokens) - 1)
        hit = tokens[at] == t
        return hit, np.where(hit, weight[at], floor)

    def frames(size: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], c: np.ndarray, t: np.ndarray) -> Iterator[pd.DataFrame]:
        """Rows of (signatures, record numbers, whether the signature is that of an empty segment)."""
        s1, s2 = _sketches(t)
        sig, row, empty = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool))
        for k in range(0, len(sig), 200_000):
            r = row[k : k + 200_000]
            yield pd.DataFrame({"sig": sig[k : k + 200_000].view(np.int64), "c": c[r], "size": np.full(len(r), size, np.int64), "s1": s1[r], "s2": s2[r], "empty": empty[k : k + 200_000]})

    def looking(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Signatures by which a record looks for shorter (or equally long) ones."""
        for pdf in it:
            for size, c, t in _by_size(pdf):
                m = sum(_segments_of(size))
                hit, logp = marked(t)
                split = _Split(t, _mixed(t.view(np.uint64)), hit, m)
                ranks = _order(split, logp, n)
                parts = []
                for a in shorter(size):
                    need = _need(a, size, num, den)
                    if need < 0:
                        continue
                    exact, less = _keys(a, m, _EXACT), _keys(a, m, _LESS)
                    r, i = np.nonzero(ranks[:, :, 0] <= need)
                    parts.append((split.exact(exact)[r, i], r, split.count[r, i] == 0))
                    one = ranks[:, :, 1] <= need
                    r, i = np.nonzero(one)
                    parts.append((split.exact(less)[r, i], r, split.count[r, i] == 0))
                    r, j = np.nonzero(one[split.row, split.seg])
                    parts.append((split.less(exact)[r, j], r, split.count[r, split.seg[r, j]] == 1))
                yield from frames(size, parts, c, t)

    def findable(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Signatures by which a record is found by longer (or equally long) ones; those of empty segments only where some record looks for them."""
        for pdf in it:
            for size, c, t in _by_size(pdf):
                hit, _ = marked(t)
                mixed = _mixed(t.view(np.uint64))
                parts = []
                for m in _schemes(size, longer):
                    split = _Split(t, mixed, hit, m)
                    sig = split.exact(_keys(size, m, _EXACT))
                    r, i = np.nonzero((split.count > 0) | np.isin(sig, wanted))
                    parts.append((sig[r, i], r, split.count[r, i] == 0))
                    sig, last = split.less(_keys(size, m, _LESS)), split.count[split.row, split.seg] == 1
                    r, j = np.nonzero(~last | np.isin(sig, wanted))
                    parts.append((sig[r, j], r, last[r, j]))
                yield from frames(size, parts, c, t)

    ddl = "sig long, c long, size long, s1 long, s2 long, empty boolean"
    look = cut(classes.select("c", "t").mapInPandas(looking, ddl))
    # One signature a size, scheme and segment at most: a bound that does not grow with the records.
    wanted = np.array([r[0] for r in look.where("empty").select("sig").distinct().collect()], np.int64).view(np.uint64)
    found = classes.select("c", "t").mapInPandas(findable, ddl).select("sig", F.col("c").alias("cb"), F.col("size").alias("zb"), F.col("s1").alias("b1"), F.col("s2").alias("b2"))
    look = look.select("sig", F.col("c").alias("ca"), F.col("size").alias("za"), F.col("s1").alias("a1"), F.col("s2").alias("a2"))
    # Sizes a and b and at most d differing tokens: (a + b - d) / (a + b + d) >= num / den.
    bits = F.bit_count(F.col("a1").bitwiseXOR(F.col("b1"))) + F.bit_count(F.col("a2").bitwiseXOR(F.col("b2")))
    may = (F.col("za") + F.col("zb") - bits) * den >= (F.col("za") + F.col("zb") + bits) * num
    once = (F.col("za") > F.col("zb")) | (F.col("ca") > F.col("cb"))
    cand = look.join(found.hint("merge"), "sig").where((F.col("ca") != F.col("cb")) & once & may).select("ca", "cb").distinct()
    sets = classes.select("c", "t", "lo", "hi")
    x = cand.join(sets.select(F.col("c").alias("ca"), F.col("t").alias("ta"), F.col("lo").alias("la"), F.col("hi").alias("ha")).hint("merge"), "ca")
    x = x.join(sets.select(F.col("c").alias("cb"), F.col("t").alias("tb"), F.col("lo").alias("lb"), F.col("hi").alias("hb")).hint("merge"), "cb")
    x = x.withColumn("common", F.size(F.array_intersect("ta", "tb")))
    union = F.size("ta") + F.size("tb") - F.col("common")
    x = x.where(F.col("common") * den >= union * num)

    def pair(a: str, b: str):  # noqa: ANN202
        return F.struct(F.col(f"c{a}").alias("class_a"), F.col(f"c{b}").alias("class_b"), F.col("common"), F.size(f"t{a}").alias("size_a"), F.size(f"t{b}").alias("size_b"))

    same = classes.where("lo = 0 AND hi = 1" if both else "k > 1")
    same = same.select(F.col("c").alias("class_a"), F.col("c").alias("class_b"), F.size("t").alias("common"), F.size("t").alias("size_a"), F.size("t").alias("size_b"))
    if not both:
        return x.select(F.when(F.col("ca") < F.col("cb"), pair("a", "b")).otherwise(pair("b", "a")).alias("p")).select("p.*").unionByName(same), members
    ways = F.array_compact(
        F.array(F.when((F.col("la") == 0) & (F.col("hb") == 1), pair("a", "b")), F.when((F.col("lb") == 0) & (F.col("ha") == 1), pair("b", "a")))
    )
    return x.select(F.explode(ways).alias("p")).select("p.*").unionByName(same), members
