"""Evaluation texts leaking into training text: matching by a generalised suffix automaton."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.llm.letters import letters
from reelframe.session import cut

#: Letters of test items that one automaton takes (about 200 bytes a letter in a worker): the bound of what is broadcast at once. More items
#: make more automata, and a pass over the documents for each: none is left out, and no task holds two of them.
SHARD_LETTERS = 1_000_000
#: No character gives more letters a byte in NFKC (U+FDFA: 3 bytes, 15 letters): a bound for texts that are too short for a run.
LETTERS_A_BYTE = 5


class SuffixAutomaton:
    """All substrings of a set of texts (arrays of code points); those of at least ``least`` letters with the texts that hold them."""

    def __init__(self, texts: dict[int, np.ndarray], least: int = 1) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends: list[set[int]] = [set()]
        for item, text in texts.items():
            last = 0
            for c in text.tolist():
                last = self._extend(last, c)
                while len(ends) < len(self.len):
                    ends.append(set())
                ends[last].add(item)
        # The texts of a state are those of all states below it in the tree of links. Longest first, so that a state is complete when it is
        # looked at; what is shorter than a run keeps no texts, however many share it.
        known: dict[tuple[int, ...], tuple[int, ...]] = {}
        self.items: list[tuple[int, ...]] = [()] * len(self.len)
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            if self.len[v] >= least:
                t = tuple(sorted(ends[v]))
                self.items[v] = known.setdefault(t, t)
                if self.len[self.link[v]] >= least:
                    ends[self.link[v]] |= ends[v]
            ends[v] = set()

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if c in nxt[last]:  # the texts before may hold this already
            q = nxt[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, c, q)
        cur = len(length)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        k = len(length)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = k
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = k
            p = link[p]
        return k

    def matches(self, text: list[int], least: int) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) of each position whose longest match with any text has at least ``least`` letters."""
        nxt, link, length = self.next, self.link, self.len
        v = n = 0
        for e, c in enumerate(text, 1):
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
            if n >= least:
                yield e, n, v

    def holders(self, state: int, length: int, least: int) -> Iterator[tuple[int, tuple[int, ...]]]:
        """(run, items): the items that hold the last ``run`` >= least letters of a match."""
        v, n = state, length
        while v > 0 and n >= least:
            yield n, self.items[v]
            v = self.link[v]
            n = self.len[v]


class Leaks:
    """Test items ready for the stream: their automaton, and a filter that finds where a long run can be at all.

    A run of ``least`` letters covers some block of g = (least + 1) // 2 letters that begins at a multiple of g
    in the document. So a document none of whose blocks is a substring of an item holds no such run, and
    only the neighbourhood of blocks that are needs the automaton. The blocks are compared by a 64-bit polynomial hash, which can
    only let a document through in vain.
    """

    def __init__(self, items: dict[int, np.ndarray], least: int) -> None:
        self.least, self.g = least, (least + 1) // 2
        rng = np.random.default_rng(20240)
        self.mul = rng.integers(1, 1 << 63, self.g, dtype=np.uint64) | np.uint64(1)
        long = {i: a for i, a in sorted(items.items()) if len(a) >= least}
        self.automaton = SuffixAutomaton(long, least) if long else None
        grams = [np.empty(0, np.uint64)] + [self._hash(np.lib.stride_tricks.sliding_window_view(a, self.g)) for a in long.values()]
        self.grams = np.unique(np.concatenate(grams))
        # A bitmap by the top 22 bits lets most blocks go without a search.
        self.bitmap = np.zeros(1 << 22, dtype=bool)
        self.bitmap[self.grams >> np.uint64(42)] = True

    def _hash(self, blocks: np.ndarray) -> np.ndarray:
        h = (blocks.astype(np.uint64) * self.mul).sum(axis=1, dtype=np.uint64)
        h ^= h >> np.uint64(29)
        return h * np.uint64(0x9E3779B97F4A7C15)

    def windows(self, a: np.ndarray) -> list[tuple[int, int]]:
        """The stretches of the letters that can hold a run, apart from one another."""
        g, k = self.g, len(a) // self.g
        if not k or not len(self.grams):
            return []
        h = self._hash(a[: k * g].reshape(k, g))
        hit = np.flatnonzero(self.bitmap[h >> np.uint64(42)])
        if len(hit):
            at = np.minimum(np.searchsorted(self.grams, h[hit]), len(self.grams) - 1)
            hit = hit[self.grams[at] == h[hit]]
        out: list[tuple[int, int]] = []
        for b in hit.tolist():
            lo, hi = max(0, (b - 1) * g), min(len(a), (b + 2) * g)
            if out and lo <= out[-1][1]:
                out[-1] = (out[-1][0], hi)
            else:
                out.append((lo, hi))
        return out

    def find(self, a: np.ndarray) -> tuple[dict[int, int], list[tuple[int, int]]]:
        """({item: its longest run}, covered stretches) of a document's letters."""
        runs: dict[int, int] = {}
        spans: list[tuple[int, int]] = []
        for lo, hi in self.windows(a):
            for e, n, v in self.automaton.matches(a[lo:hi].tolist(), self.least):
                spans.append((lo + e - n, lo + e))
                for run, items in self.automaton.holders(v, n, self.least):
                    for i in items:
                        if runs.get(i, 0) < run:
                            runs[i] = run
        return runs, merged(spans)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches that touch or overlap as one, in order."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _shards(spark: SparkSession, items: DataFrame, id_col: str, text_col: str, least: int, shard_letters: int):  # noqa: ANN202
    """One broadcast of Leaks a shard of at most ``shard_letters`` letters, but for an item that has more by itself; without items one of none.

    The items stream to the driver by id, a partition at a time, and a shard is built and handed over before the next one begins: what
    the driver and a worker hold is one shard, whatever the number of items.
    """
    rows = items.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t")).where(F.col("i").isNotNull() & (F.col("t") != "")).distinct().orderBy("i", "t")
    out, shard, size = [], {}, 0
    gap = np.zeros(1, np.uint32)  # no letter: keeps the texts of an item that is given several apart
    now, texts = None, []

    def close() -> None:
        nonlocal shard, size
        if shard or not out:
            out.append(spark.sparkContext.broadcast(Leaks(shard, least)))
        shard, size = {}, 0

    def add() -> None:
        nonlocal size
        n = sum(map(len, texts))
        if size and size + n > shard_letters:
            close()
        shard[now] = np.concatenate([x for p in texts for x in (p, gap)][:-1])
        size += n

    for i, t in rows.toLocalIterator():
        if i != now and texts:
            add()
            texts = []
        now = i
        texts.append(letters(t)[0])
    if texts:
        add()
    if shard or not out:
        close()
    return out


def leaked_items(
    docs: DataFrame,
    items: DataFrame,
    least: int = 32,
    doc_id: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shard_letters: int = SHARD_LETTERS,
) -> DataFrame:
    """The test items of which each document holds a run of ``least`` letters: the document's id, the item's id, longest_run.

    Both texts are reduced to letters after NFKC and lower-casing. Documents stream through a
    generalised suffix automaton of the items, which keeps the longest match up to each letter.

    Defined results: null and empty texts and items shorter than ``least`` letters match nothing; null ids of items are left out, null ids of documents are
    reported like others; repeated rows give repeated rows, items listed twice count once; empty tables give no rows.
    No shuffle: the items are broadcast, a shard of bounded size at a time, and each document is read once a shard, whole.
    """
    shards = _shards(docs.sparkSession, items, item_id, item_text, least, shard_letters)
    cols = docs.select(F.col(f"`{doc_id}`").alias("d"), F.col(f"`{text_col}`").cast("string").alias("t")).where(F.octet_length("t") * LETTERS_A_BYTE >= least)
    d_type, i_type = cols.schema["d"].dataType.simpleString(), items.schema[item_id].dataType.simpleString()

    i_arrow = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[i_type]

    def through(leaks):  # noqa: ANN001, ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = leaks.value.find
            for b in batches:
                ids, found = b.column(0), []
                for k, x in enumerate(b.column(1)):
                    found += [(k, i, n) for i, n in find(letters(x.as_py())[0])[0].items()]
                at, it, n = zip(*found) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), pa.array(it, i_arrow), pa.array(n, pa.int32())], names=[doc_id, item_id, "longest_run"])

        return cols.mapInArrow(run, f"`{doc_id}` {d_type}, `{item_id}` {i_type}, longest_run int")

    return reduce(DataFrame.unionByName, map(through, shards))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    least: int = 32,
    max_coverage: float = 0.5,
    doc_id: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shard_letters: int = SHARD_LETTERS,
) -> DataFrame:
    """What becomes of the documents that hold runs of test items: id, letters, covered, action, spans, text.

    Every run of ``least`` letters or more is a span to remove; where spans cover more than ``max_coverage`` of a
    document's letters the whole document goes (action 'drop', null text), else text is what is left (action 'trim').
    Documents without such runs are not listed. The same defined results as ``leaked_items``.
    """
    shards = _shards(docs.sparkSession, items, item_id, item_text, least, shard_letters)
    cols = docs.select(F.col(f"`{doc_id}`").alias("d"), F.col(f"`{text_col}`").cast("string").alias("t")).where(F.octet_length("t") * LETTERS_A_BYTE >= least)
    kind = cols.schema["d"].dataType.simpleString()
    out = f"`{doc_id}` {kind}, letters int, covered int, action string, spans array<struct<start:int,end:int>>, text string"

    def row(d, text: str, found: list[tuple[int, int]], a: np.ndarray, places: np.ndarray) -> tuple:  # noqa: ANN001
        covered = sum(e - s for s, e in found)
        drop = covered > max_coverage * len(a)
        cuts = [(int(places[s]), int(places[e - 1]) + 1) for s, e in found]
        kept, at = [], 0
        for s, e in cuts:
            kept.append(text[at:s])
            at = e
        kept.append(text[at:])
        return d, len(a), covered, "drop" if drop else "trim", [{"start": s, "end": e} for s, e in cuts], None if drop else "".join(kept)

    def removed(batches: Iterator[pd.DataFrame], spans: Callable) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                a, places = letters(r.t)
                if found := spans(r, a):
                    rows.append(row(r.d, r.t, found, a, places))
            yield pd.DataFrame(rows, columns=[doc_id, "letters", "covered", "action", "spans", "text"])

    if len(shards) == 1:
        return cols.mapInPandas(lambda it: removed(it, lambda r, a: shards[0].value.find(a)[1]), out)

    # Several shards: each pass gives the spans of its own items, those of a document are put together before they are cut out.
    rows = cut(cols.withColumn("n", F.monotonically_increasing_id()))

    def spans_of(leaks):  # noqa: ANN001, ANN202
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                got = [(n, [{"s": s, "e": e} for s, e in leaks.value.find(letters(t)[0])[1]]) for n, t in zip(pdf["n"], pdf["t"])]
                yield pd.DataFrame([x for x in got if x[1]], columns=["n", "spans"])

        return rows.select("n", "t").mapInPandas(run, "n long, spans array<struct<s:int,e:int>>")

    found = reduce(DataFrame.unionByName, map(spans_of, shards)).groupBy("n").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return rows.join(found.hint("merge"), "n").select("d", "t", "spans").mapInPandas(lambda it: removed(it, lambda r, a: merged([(x["s"], x["e"]) for x in r.spans])), out)
