"""Count-based windows over session streams, with full-history state, roll-back of unfixed text and time to live."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Generator, Iterable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SAMPLE_RATE = 16_000
TTL_MS = 600_000
#: Characters of a session's texts that are handed on at once.
PIECE_CHARS = 1 << 22
#: Where texts are put together again: pieces of a session at most, by which one long session is spread over tasks.
PIECES = 64

#: A decoder sees all samples so far and the text that is fixed; it gives the text of the whole (an adapter in production).
Decoder = Callable[[list[float], str], str]

OUT = "session_id string, step long, n_samples long, text string, finished boolean, missing long"
CHANGES = "session_id string, step long, n_samples long, kept long, text string, finished boolean, missing long"
STATE = "step long, buffer array<double>, history array<double>, text string, next_seq long, late array<struct<seq:long,samples:array<double>,is_end:boolean>>"


def chunk_samples(seconds: float) -> int:
    """Samples of a chunk, at least one."""
    if seconds <= 0:
        raise ValueError("chunk length must be positive")
    return max(1, round(seconds * SAMPLE_RATE))


def fixed_prefix(text: str, step: int, unfixed_chunks: int, unfixed_tokens: int, final: bool = False) -> str:
    """T4, T5: the part of the text so far that the next decode keeps: none for the first chunks, else all but the last tokens (characters here).

    While it ends in the replacement character more is dropped; at the end of a stream one token at least stays and this is not looked at.
    """
    if step < unfixed_chunks:
        return ""
    if final:
        return text[: max(1, len(text) - unfixed_tokens)]
    k = unfixed_tokens
    while k < len(text) and text.endswith("�", 0, len(text) - k):
        k += 1
    return text[: max(0, len(text) - k)]


def changes(state: tuple, rows: Iterable[tuple[int, list[float], bool]], size: int, decode: Decoder, unfixed_chunks: int, unfixed_tokens: int, ended: bool = False) -> Generator[tuple, None, tuple]:
    """Take rows (seq, samples, is_end) into a session's state; emit (step, n_samples, text, finished, missing, kept) for every full chunk and at the end.

    Rows are taken in the order of seq, whatever the micro-batches: one that comes early waits. A repeated seq counts once. When the session
    ends (``ended``: it timed out) while rows wait for a seq that never came, they are taken all the same, in order of seq; missing counts the seqs passed over.
    What is emitted is made when it is asked for, each text as long as the session so far; its first ``kept`` characters are those of the text before. The state after
    all rows is returned.
    """
    step, buffer, history, text, nxt, late = state
    buffer, history = list(buffer), list(history)
    waiting = {r[0]: r for r in late}
    waiting.update((r[0], r) for r in rows if r[0] >= nxt)
    end, missing = ended, 0

    def decoded(final: bool) -> int:
        nonlocal step, text
        prefix = fixed_prefix(text, step, unfixed_chunks, unfixed_tokens, final)
        text = decode(history, prefix)
        step += 1
        return len(prefix) if text.startswith(prefix) else 0

    def take(seq: int) -> Generator[tuple, None, bool]:
        nonlocal nxt, missing
        _, samples, is_end = waiting.pop(seq)
        missing += seq - nxt
        nxt = seq + 1
        buffer.extend(samples or [])
        at = 0
        while len(buffer) - at >= size:
            history.extend(buffer[at : at + size])
            at += size
            kept = decoded(False)
            yield step, len(history), text, False, missing, kept
        del buffer[:at]
        return is_end

    while nxt in waiting:
        end = (yield from take(nxt)) or end
    if end:
        for seq in sorted(waiting):
            yield from take(seq)
        kept = len(text)
        if buffer:
            history.extend(buffer)
            buffer.clear()
            kept = decoded(True)
        yield step, len(history), text, True, missing, kept
    return step, buffer, history, text, nxt, list(waiting.values())


def steps(state: tuple, rows: Iterable[tuple[int, list[float], bool]], size: int, decode: Decoder, unfixed_chunks: int, unfixed_tokens: int, ended: bool = False) -> Generator[tuple, None, tuple]:
    """``changes`` without what is kept: (step, n_samples, text, finished, missing)."""
    it = changes(state, rows, size, decode, unfixed_chunks, unfixed_tokens, ended)
    while True:
        try:
            r = next(it)
        except StopIteration as e:
            return e.value
        yield r[:5]


def advance(state: tuple, rows: list[tuple[int, list[float], bool]], size: int, decode: Decoder, unfixed_chunks: int, unfixed_tokens: int, ended: bool = False) -> tuple[tuple, list[tuple]]:
    """``steps`` at once: the state after all rows, and what is emitted."""
    out = []

    def run() -> Generator[tuple, None, tuple]:
        return (yield from steps(state, rows, size, decode, unfixed_chunks, unfixed_tokens, ended))

    it = run()
    while True:
        try:
            out.append(next(it))
        except StopIteration as e:
            return e.value, out


def transcribe_stream(
    stream: DataFrame, seconds: float, decode: Decoder, unfixed_chunks: int = 2, unfixed_tokens: int = 5, ttl_ms: int = TTL_MS, snapshot: bool = False, short: bool = False
) -> DataFrame:
    """T1 to T7 on a stream of session_id, seq (from 0), samples, is_end: session_id, step, n_samples, text, finished, missing.

    Use it in update mode. A chunk is a number of samples, not a time. A session ends with its end row, or when nothing has come for
    ``ttl_ms`` (processing time); then its rest, and what still waits for a missing seq, is flushed and its state removed. ``snapshot`` gives only the latest row
    of a session in each micro-batch.

    Each step gives the text of the session so far, so that a long session gives far more than it takes in. Rows are handed on while they are made, but Spark gathers
    spark.sql.execution.arrow.maxRecordsPerBatch of them (10000): where sessions are long, the stream's session should set that low. ``short`` gives steps as changes
    instead (``CHANGES``), as much as comes in: kept is the number of bytes of the text before that stay, text what follows them; ``whole_texts`` puts them together.
    """
    if short and snapshot:
        raise ValueError("changes are of all steps")
    size = chunk_samples(seconds)
    columns = [f.split()[0] for f in (CHANGES if short else OUT).split(", ")]

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get if state.exists else (0, [], [], "", 0, [])
        now = (now[0], list(now[1]), list(now[2]), now[3], now[4], [(r[0], list(r[1]), r[2]) for r in now[5]])
        late = state.hasTimedOut
        rows = () if late else ((int(s), [float(v) for v in x] if x is not None else [], bool(e)) for b in batches for s, x, e in zip(b["seq"], b["samples"], b["is_end"]))
        over, held, chars, before, n_bytes = late, [], 0, now[3], len(now[3].encode())

        def run() -> Iterator[tuple]:
            nonlocal now
            now = yield from changes(now, rows, size, decode, unfixed_chunks, unfixed_tokens, ended=late)

        def table() -> pd.DataFrame:
            return pd.DataFrame([(key[0], *r) for r in held], columns=columns)

        for step, n, text, finished, missing, kept in run():
            over = over or finished
            if snapshot:
                held = [(step, n, text, finished, missing)]
                continue
            if short:
                rest = text[kept:]
                n_bytes -= len(before[kept:].encode())
                held.append((step, n, n_bytes, rest, finished, missing))
                n_bytes += len(rest.encode())
                before = text
                chars += len(rest)
            else:
                held.append((step, n, text, finished, missing))
                chars += len(text)
            if chars >= PIECE_CHARS:
                yield table()
                held, chars = [], 0
        if over:
            state.remove()
        else:
            state.update(now)
            state.setTimeoutDuration(ttl_ms)
        yield table()

    rows = stream.select("session_id", "seq", "samples", "is_end")
    return rows.groupBy("session_id").applyInPandasWithState(update, CHANGES if short else OUT, STATE, "update", GroupStateTimeout.ProcessingTimeTimeout)


def pieces(kept: list[int], rest: list[bytes]) -> Iterator[tuple[int, int, bytes, list[int], list[bytes]]]:
    """The changes of one text in pieces that follow each other: from, to, the text after the last, and of each change the bytes that its text begins with of that one and what follows them.

    A piece is for about as many bytes of whole texts as another, and there are ``PIECES`` of them at most where little is taken back; else they are cut further, so that none is large.
    """
    kept = np.array(kept, dtype=np.int64)
    size = kept + np.fromiter(map(len, rest), np.int64, len(rest))
    total = np.cumsum(size)
    ids = (total - 1) // max(PIECE_CHARS, -(-int(total[-1]) // PIECES))
    ends = [*(np.flatnonzero(np.diff(ids)) + 1), len(rest)]
    text, todo = bytearray(), [*zip([0, *ends[:-1]], ends)][::-1]
    while todo:
        a, b = map(int, todo.pop())
        # What later steps of the piece leave of a text is at the beginning of the last one.
        least = np.minimum.accumulate(np.append(kept[a + 1 : b], size[b - 1])[::-1])[::-1]
        first = np.minimum(least, size[a:b])
        if b - a > 1 and int((size[a:b] - first).sum()) > PIECE_CHARS:
            todo += [((a + b) // 2, b), (a, (a + b) // 2)]
            continue
        own = []
        for k in range(a, b):
            del text[kept[k] :]
            text += rest[k]
            own.append(bytes(text[first[k - a] :]))
        yield a, b, bytes(text), first.tolist(), own


def whole_texts(short: DataFrame, order: list[str]) -> DataFrame:
    """The steps of ``transcribe_stream`` with the text of each, from its changes in the order of ``order`` in a session, of which the text before the first is empty.

    What is shuffled grows with the changes: a step goes with the piece of its session, which has its last text once; the text of a step is made when the row is read.
    """
    spark = short.sparkSession
    tasks = max(2, 2 * spark.sparkContext.defaultParallelism)
    columns = ["session_id", "step", "n_samples", "kept", "rest", "finished", "missing", "piece", "last"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        rows = (r for b in batches for r in zip(*(b[c].tolist() for c in ("session_id", "step", "n_samples", "kept", "text", "finished", "missing"))))
        for key, own in groupby(rows, key=lambda r: r[0]):
            own = list(own)
            for i, (a, b, last, first, rest) in enumerate(pieces([r[3] for r in own], [r[4].encode() for r in own])):
                held += [(key, *own[k][1:3], first[k - a], rest[k - a], *own[k][5:], i, last if k == a else None) for k in range(a, b)]
                n += len(last) + sum(map(len, rest))
                if n >= PIECE_CHARS or len(held) >= 10_000:
                    yield pd.DataFrame(held, columns=columns)
                    held, n = [], 0
        if held:
            yield pd.DataFrame(held, columns=columns)

    cut = short.repartition(tasks, "session_id").sortWithinPartitions("session_id", *order).select("session_id", "step", "n_samples", "kept", "text", "finished", "missing")
    cut = cut.mapInPandas(run, "session_id string, step long, n_samples long, kept int, rest binary, finished boolean, missing long, piece int, last binary")
    # A number of partitions by itself: Spark would merge them by the bytes that are shuffled, which are few.
    w = Window.partitionBy("session_id", "piece")
    made = cut.repartition(4 * tasks, "session_id", "piece").withColumn("last", F.max("last").over(w))
    text = F.concat(F.expr("substring(last, 1, kept)"), "rest").cast("string")
    return made.select("session_id", "step", "n_samples", text.alias("text"), "finished", "missing")


def valid_payload(data: bytes) -> list[float] | None:
    """Samples of a posted chunk of float32 little-endian; null if its length is no multiple of four."""
    import numpy as np

    return np.frombuffer(data, "<f4").astype(float).tolist() if len(data) % 4 == 0 else None


def payloads(posts: DataFrame, keys: list[str], data: str) -> DataFrame:
    """S31 on a table or stream of posted chunks: keys, samples; null where a chunk is refused. Row by row in Arrow batches."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pdf[keys].assign(samples=[None if x is None else valid_payload(bytes(x)) for x in pdf[data]])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in posts.select(*keys).schema)
    return posts.select(*keys, data).mapInPandas(run, f"{ddl}, samples array<double>")


class Sessions:
    """The sessions of a server: a new id for each start, touched on access; one that was not for ``ttl_ms`` is finished, when the registry is next looked at.

    ``finish`` is called with the state of a session that expires or ends; what it raises is left to it in the first case. Times are given in milliseconds, so that nothing depends on the clock.
    """

    def __init__(self, finish: Callable[[object], object], ttl_ms: int = TTL_MS) -> None:
        self._finish, self._ttl, self._held = finish, ttl_ms, {}

    def _expire(self, now_ms: int) -> None:
        for k in [k for k, (_, seen) in self._held.items() if now_ms - seen > self._ttl]:
            state, _ = self._held.pop(k)
            try:
                self._finish(state)
            except Exception:  # noqa: BLE001, S110
                pass

    def start(self, state: object, now_ms: int) -> str:
        key = uuid.uuid4().hex
        self._held[key] = (state, now_ms)
        return key

    def get(self, key: str, now_ms: int) -> object | None:
        """The state of a session, which is touched; null if there is none (any more)."""
        self._expire(now_ms)
        if key not in self._held:
            return None
        state, _ = self._held[key]
        self._held[key] = (state, now_ms)
        return state

    def end(self, key: str, now_ms: int) -> object | None:
        """What ``finish`` gives for a session, which is no more; null if there is none."""
        self._expire(now_ms)
        held = self._held.pop(key, None)
        return None if held is None else self._finish(held[0])


def event_sessions(stream: DataFrame, key: str, ts: str, gap: str, watermark: str) -> DataFrame:
    """Our extension: sessions by event time with a watermark; a gap longer than ``gap`` ends one."""
    s = stream.withWatermark(ts, watermark).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return s.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
