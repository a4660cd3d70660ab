"""Choosing a varied subset: tournament-pivoted rank-revealing QR over sparse feature rows."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelframe.session import cut

#: Rows that a tournament chooses before the rest is deflated, at least; more where many are wanted, so that there are no more than ROUNDS rounds a layer.
PANEL, ROUNDS = 32, 32
#: Rows that a leaf or a node of the tournament passes on, as a multiple of the panel, so that what the root needs is not lost below.
NOMINATED = 4
#: Distinct feature rows of one leaf of the tournament, about.
LEAF_ROWS = 16_384
#: A row counts as independent of those chosen if so much of its squared length is left.
INDEPENDENT = 1e-6

_ROW = "id long, copies long, idx array<long>, val array<double>"


@dataclass(frozen=True)
class Basis:
    """Orthonormal directions over the features that the rows chosen have: a row's other features cannot meet them."""

    feats: np.ndarray  # 64-bit digests of the features, one a column
    q: np.ndarray  # (directions, features)

    @staticmethod
    def empty() -> Basis:
        return Basis(np.empty(0, np.int64), np.empty((0, 0)))

    def with_rows(self, feats: np.ndarray, q: np.ndarray) -> Basis:
        """With more directions over these features, which begin with those of this basis."""
        old = np.pad(self.q, ((0, 0), (0, len(feats) - self.q.shape[1])))
        return Basis(feats, np.concatenate((old, q)))


def pivoted_rows(pdf: pd.DataFrame, basis: Basis, k: int) -> tuple[list[int], Basis, list[float]]:
    """Up to k rows by QR with row pivoting after deflation by ``basis``: (positions, the basis with their directions, their residuals).

    Each step takes the row of which most is left beside the basis and the rows taken before; ties go to the least id.
    Rows are sparse, so a step costs one product with their few entries; features are known by their digests, none shares a dimension with another.
    """
    if not len(pdf):
        return [], basis, []
    sizes = np.fromiter((len(x) for x in pdf["idx"]), np.int64, len(pdf))
    at = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    own, of = np.unique(np.concatenate([np.asarray(x, np.int64) for x in pdf["idx"]]), return_inverse=True)
    val = np.concatenate([np.asarray(x, float) for x in pdf["val"]])
    # Columns: the basis' features first, then those of rows taken here; the last column stands for all others and is 0 in every direction.
    n = len(basis.feats)
    width = n + int(min(len(own), k * sizes.max())) + 1
    column = np.full(len(own), width - 1)
    if n:
        order = np.argsort(basis.feats)
        where = order[np.minimum(np.searchsorted(basis.feats, own, sorter=order), n - 1)]
        column = np.where(basis.feats[where] == own, where, column)
    feats = list(basis.feats)
    cols = column[of]
    full = np.add.reduceat(val * val, at)
    left = full.copy()
    q = np.zeros((len(basis.q) + min(k, len(pdf)), width))
    q[: len(basis.q), :n] = basis.q
    m = len(basis.q)
    for d in q[:m]:
        left -= np.add.reduceat(val * d[cols], at) ** 2
    taken, residuals = [], []
    by_id = np.argsort(pdf["id"].to_numpy(), kind="stable")
    while len(taken) < min(k, len(pdf)):
        score = np.where(left > INDEPENDENT * full, np.round(left, 9), -1.0)
        i = int(by_id[np.argmax(score[by_id])])
        if score[i] < 0:
            break
        s = slice(at[i], at[i] + sizes[i])
        if (cols[s] == width - 1).any():
            for f in of[s]:
                if column[f] == width - 1:
                    column[f] = len(feats)
                    feats.append(own[f])
            cols = column[of]
        x = np.zeros(width)
        np.add.at(x, cols[s], val[s])
        for _twice in range(2):  # once more, for what rounding leaves
            x -= (q[:m] @ x) @ q[:m]
        norm = math.sqrt(x @ x)
        if norm * norm <= INDEPENDENT * full[i]:
            left[i] = -1.0
            full[i] = 1.0
            continue
        q[m] = x / norm
        taken.append(i)
        residuals.append(norm)
        left -= np.add.reduceat(val * q[m][cols], at) ** 2
        left[i] = -1.0
        m += 1
    return taken, basis.with_rows(np.array(feats, np.int64), q[len(basis.q) : m, : len(feats)]), residuals


def _features(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """id, h: the digests of the set of features."""
    tags = F.array_distinct(F.flatten(F.array(*[F.transform(F.array_compact(F.coalesce(F.col(f"`{f}`"), F.array().cast("array<string>"))), lambda t, f=f: F.concat(F.lit(f"{f}\x1f"), t)) for f in fields])))
    rows = df.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.array_sort(F.transform(tags, lambda t: F.xxhash64(t))).alias("h"))
    return rows.groupBy("id").agg(F.min("h").alias("h"))


def varied_subset(df: DataFrame, k: int, id_col: str, fields: list[str]) -> DataFrame:
    """``k`` rows that cover the variety of the array<string> ``fields``: pick (from 1), id, copies, residual.

    The picks are ordered: the first n of them are the choice of n. Rows with equal sets of features are one
    feature row with a number of copies, so that a large group of equals counts once; similar ones leave
    little beside the first that is chosen. A feature weighs sqrt(ln(1 + rows that have it)), so that a tag of one row
    weighs less than the large ones. A round is a tournament: the leaves nominate
    independent rows by pivoted QR, pairs of nominations are joined and pivoted again up to the root,
    and what the winners span is taken out of all rows (deflation) before the next round. If nothing independent is left (as many rows are chosen as there are
    independent ones), a new layer begins with an empty basis among the feature rows not chosen; when all of these are chosen, second and further copies fill up
    (least number of copies taken first), and rows without features last.

    A feature is known by a 64-bit digest and has a dimension of its own, however many there are. What is sent to the tasks is the basis of a layer: one
    direction a pick over the features of the picks, bounded by k and by the number of distinct features.

    Defined results: null ids do not count, an id given twice is one row (one of its feature sets, the least); null and empty arrays and null tags are
    no features; k < 1 or an empty table gives no rows, k above the number of ids gives all ids. ids must be integers.
    ``residual`` is what a row added to those before it in its layer; null for copies and rows without features.
    """
    spark = df.sparkSession
    schema = f"pick int, `{id_col}` long, copies long, residual double"
    if k < 1:
        return spark.createDataFrame([], schema)
    rows = cut(_features(df, id_col, fields))
    groups = rows.where(F.size("h") > 0).groupBy("h").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    each = groups.select("id", "copies", F.explode("h").alias("t"))
    weights = groups.select("copies", F.explode("h").alias("t")).groupBy("t").agg(F.sqrt(F.log1p(F.sum("copies"))).alias("w"))
    entries = F.array_sort(F.collect_list(F.struct("t", "w")))
    space = each.join(weights, "t").groupBy("id").agg(F.any_value("copies").alias("copies"), entries.alias("e")).select("id", "copies", F.col("e.t").alias("idx"), F.col("e.w").alias("val"))
    space = cut(space)
    n = space.count()
    leaves = max(1, -(-n // LEAF_ROWS))
    space = cut(space.repartition(leaves, "id")) if n else space
    panel = max(PANEL, -(-k // ROUNDS))
    chosen: list[tuple[int, int, float | None]] = []
    layer, basis = 0, Basis.empty()
    while len(chosen) < min(k, n):
        want = min(panel, k - len(chosen))
        won = _tournament(space, basis, max(panel, want) * NOMINATED, leaves)
        taken, basis, residuals = pivoted_rows(won, basis, want)
        chosen += [(int(won["id"].iloc[i]), int(won["copies"].iloc[i]), float(r)) for i, r in zip(taken, residuals)]
        if not taken:
            if len(chosen) == layer:
                break
            done = spark.createDataFrame([(c[0],) for c in chosen[layer:]], "id long")
            space, layer, basis = cut(space.join(done, "id", "left_anti")), len(chosen), Basis.empty()
            leaves = space.rdd.getNumPartitions()
    picks = [(i + 1, c, m, r) for i, (c, m, r) in enumerate(chosen)]
    out = spark.createDataFrame(picks, schema)
    if len(picks) >= k:
        return out
    # Copies: the second of each group, then the third, ...; a salted rank first, so that a huge group is no hot task.
    rest = rows.join(spark.createDataFrame([(c[0],) for c in chosen], "id long"), "id", "left_anti") if chosen else rows
    salt = F.pmod(F.xxhash64("id"), F.lit(64))
    few = rest.withColumn("r", F.row_number().over(Window.partitionBy("h", salt).orderBy("id"))).where(F.col("r") <= k)
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("h").orderBy("id"))).where(F.col("r") <= k)
    last = few.orderBy((F.size("h") == 0), "r", "id").limit(k - len(picks)).select("id").collect()
    more = [(len(picks) + 1 + i, r[0], None, None) for i, r in enumerate(last)]
    return spark.createDataFrame(picks + more, schema)


def _tournament(space: DataFrame, basis: Basis, k: int, leaves: int) -> pd.DataFrame:
    """The rows that the root is left with, k at most: leaves nominate, pairs of nominations are pivoted again.

    A row chosen in this layer has nothing left beside the basis, so that it is not nominated again.
    """
    shared = space.sparkSession.sparkContext.broadcast(basis)

    def nominate(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for pdf in it:
            both = pdf if best is None else pd.concat([best, pdf], ignore_index=True)
            best = both.iloc[pivoted_rows(both, shared.value, k)[0]].reset_index(drop=True)
        if best is not None and len(best):
            yield best.assign(node=TaskContext.get().partitionId())

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ignore_index=True)
        return pdf.iloc[pivoted_rows(pdf, shared.value, k)[0]]

    level = space.mapInPandas(nominate, _ROW + ", node long")
    while leaves > 1:
        level = level.withColumn("node", F.shiftright("node", 1)).groupBy("node").applyInPandas(meet, _ROW + ", node long")
        leaves = (leaves + 1) // 2
    return level.toPandas()
