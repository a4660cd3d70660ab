"""Filling fixed-capacity containers with items: vector best-fit under several capacities."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.tokenizer import VOCABULARY, tokenizer
from reelframe.session import cut

#: Items that one task packs together, about: more fill the containers no better, fewer leave more part-filled ones.
BLOCK_ITEMS = 16_384
#: Weights of tokens, documents and attention cost in the residual norm.
WEIGHTS = (1.0, 0.05, 0.25)


def best_fit(sizes: list[int], capacity: int, max_items: int, max_cost: int) -> list[int]:
    """The bin of each item (sizes in falling order) by vector best-fit.

    A bin has three residual capacities: tokens, documents, and attention cost (the sum of squared sizes). An item goes to the one of all
    open bins that can take it whose weighted residual norm is least afterwards (the first opened of equals); a new bin is opened only where none can. An item whose own cost is above ``max_cost`` has a bin to itself.
    """
    wt, wc, wa = (w / c / c for w, c in zip(WEIGHTS, (capacity, max_items, max_cost)))
    room = np.empty((3, 256))  # tokens, documents and cost left of the open bins
    number = np.empty(256, np.int64)
    m = bins = 0
    out = []
    for n in sizes:
        sq, at = n * n, -1
        if m:
            left = room[:, :m]
            r, a = left[0] - n, left[2] - sq
            norm = wt * r * r + wc * (left[1] - 1) ** 2 + wa * a * a
            norm[(r < 0) | (a < 0)] = np.inf
            at = int(norm.argmin())
            if norm[at] == np.inf:
                at = -1
        if at < 0:
            if sq > max_cost:
                out.append(bins)
                bins += 1
                continue
            if m == len(number):
                room, number = np.concatenate((room, np.empty_like(room)), axis=1), np.concatenate((number, np.empty_like(number)))
            room[:, m], number[m] = (capacity, max_items, max_cost), bins
            at, m, bins = m, m + 1, bins + 1
        room[:, at] -= (n, 1, sq)
        out.append(int(number[at]))
        if room[:, at].min() <= 0:  # closed: the bins behind move up, in the order in which they were opened
            room[:, at : m - 1], number[at : m - 1] = room[:, at + 1 : m], number[at + 1 : m].copy()
            m -= 1
    return out


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """id, n_tokens of every row; 0 for null and empty texts. Arrow batches in, whole texts, no shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(vocabulary)
        for b in batches:
            n = [tok.count(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=["id", "n_tokens"])

    cols = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return cols.mapInArrow(count, f"id {cols.schema['id'].dataType.simpleString()}, n_tokens long")


def pack(
    sizes: DataFrame, limits: list[tuple[int, int]], max_docs: float = 1 / 8, attention: float = 1.0, block_items: int = BLOCK_ITEMS
) -> DataFrame:
    """Combine items into containers of each limit, filling them as far as its capacities allow.

    ``sizes``: id, n_tokens. ``limits``: (limit_id, max_tokens). A container takes at most max_tokens tokens,
    max(1, max_tokens * ``max_docs``) documents and an attention cost (the sum of squared piece sizes) of ``attention`` *
    max_tokens². From 1 on any filling meets this and it weighs in the choice only; below 1 it binds, and a piece that alone costs more has a container of its own. Output: limit_id, container_id, id, piece, token_start, n_tokens.

    An item is split only if it exceeds max_tokens: into full pieces, each a container of its own, and a rest that is
    packed like any item. The sizes are written once and their rows numbered, so that equal ids and equal rows are spread alike; other items are spread over blocks
    by a hash of that number, so that no task takes more than about ``block_items``; each block is packed in falling order of size, and the containers of all blocks that stay less than
    nine tenths full are opened again and packed anew in fewer blocks.

    Defined results: items of no tokens (null or empty texts) get no container; equal ids or texts are items
    like any other; null n_tokens counts as 0; a limit that is null or below 1 is left out; no items, no rows. Ties in size go by id.
    """
    limits = sorted({(i, m) for i, m in limits if m is not None and m >= 1})
    spark = sizes.sparkSession
    schema = f"limit_id int, max_tokens long, id {sizes.schema['id'].dataType.simpleString()}, piece int, token_start long, n_tokens long, block long"
    if not limits:
        return spark.createDataFrame([], schema).select("limit_id", F.lit(0).cast("long").alias("container_id"), "id", "piece", "token_start", "n_tokens")
    # Numbered before they are written: what is read from there on has the same numbers in every attempt.
    sizes = cut(sizes.where("n_tokens > 0").select("id", "n_tokens", F.monotonically_increasing_id().alias("_row")))
    n = sizes.agg(F.count(F.lit(1))).first()[0]
    blocks = max(1, -(-n // block_items))
    each = F.explode(F.array(*[F.struct(F.lit(i).cast("int").alias("limit_id"), F.lit(m).cast("long").alias("max_tokens")) for i, m in limits]))
    items = sizes.select("_row", "id", "n_tokens", each.alias("l")).select("_row", "id", "n_tokens", "l.*")
    whole = F.col("n_tokens") <= F.col("max_tokens")
    starts = F.when(whole, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("n_tokens") - 1, F.col("max_tokens")))
    pieces = items.select("limit_id", "max_tokens", "_row", "id", F.col("n_tokens").alias("total"), F.posexplode(starts).alias("piece", "token_start"))
    pieces = pieces.withColumn("n_tokens", F.least("max_tokens", F.col("total") - F.col("token_start"))).drop("total")
    pieces = pieces.withColumn("block", F.pmod(F.xxhash64("_row", "piece", "limit_id"), F.lit(blocks))).drop("_row")

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "id", "piece"], ascending=[False, True, True], kind="stable", ignore_index=True)
        cap = int(pdf["max_tokens"].iloc[0])
        pdf["bin"] = best_fit(pdf["n_tokens"].tolist(), cap, max(1, int(cap * max_docs)), max(1, int(attention * cap * cap)))
        filled = pdf["n_tokens"].groupby(pdf["bin"]).transform("sum")
        pdf["open"] = filled * 10 < cap * 9
        return pdf[["limit_id", "max_tokens", "id", "piece", "token_start", "n_tokens", "block", "bin", "open"]]

    out_schema = schema + ", bin long, open boolean"
    full = F.col("n_tokens") == F.col("max_tokens")
    parts = cut(pieces.where(~full).groupBy("limit_id", "block").applyInPandas(fill, out_schema))
    left = parts.where("open").groupBy("limit_id").count().collect()  # a row a limit
    again = max([1, *(-(-r["count"] // block_items) for r in left)])
    rest = parts.where("open").withColumn("block", F.pmod("block", F.lit(again))).select("limit_id", "max_tokens", "id", "piece", "token_start", "n_tokens", "block")
    rest = rest.groupBy("limit_id", "block").applyInPandas(fill, out_schema)

    def rows(df: DataFrame, kind: int, number) -> DataFrame:  # noqa: ANN001
        # kind, block and bin side by side: 2, 30 and 31 bits.
        return df.select("limit_id", (F.lit(kind << 61).cast("long") + number).alias("container_id"), "id", "piece", "token_start", "n_tokens")

    key = F.shiftleft(F.col("block"), 31) + F.col("bin")
    alone = pieces.where(full)
    return rows(parts.where("NOT open"), 0, key).unionByName(rows(rest, 1, key)).unionByName(rows(alone, 2, F.monotonically_increasing_id()))
