"""Splitting oversized items at natural boundaries: recursive bisection with overlaps."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.tokenizer import VOCABULARY, Tokenizer, tokenizer

#: The kinds of boundaries from the strongest; 'end' is the end of the text, 'token' a cut that no boundary allows.
KINDS = ("scene", "cue", "line", "sentence", "clause", "token", "end")
_LONE_CR = re.compile(r"\r(?!\n)")
_SCENE = re.compile(r"^[ \t]*(?:\d+-\d+|第\d+[集场幕]|(?:INT|EXT)[./ ].*)[ \t]*\r?$", re.M)
_CUE = re.compile(r"\n[ \t　]*\r?\n[\s　]*")
_SENTENCE = re.compile(r"(?:[。！？…!?；;]|\.(?=\s|$))[。！？…!?；;.]*[”’」』）》\"')\]]*[ \t　]*")
_CLAUSE = re.compile(r"[，、：,:}\]]+[ \t　]*|[ \t　]+")
#: A piece so near to its limit is counted again on its own: a token may break where the text is cut.
NEAR = 16
#: Punctuation or a line end before a letter or digit: there the pre-tokeniser always breaks, so that tokens on
#: either side are the same whether or not the text is cut.
_BREAK = re.compile(r"[。！？，、：；…”’）」』》】,.:;!?)\]}\r\n](?=[A-Za-z0-9一-鿿])")
#: Text of pieces that is handed on at a time.
BATCH_CHARS = 4_000_000


def _ranks(places: np.ndarray, size: int) -> np.ndarray:
    """For each of 0 to ``size`` the number of distinct places below it."""
    flags = np.zeros(size + 1, np.int32)
    flags[places + 1] = 1
    return np.cumsum(flags, dtype=np.int32)


class _Cutter:
    """Token positions and boundaries of one text; positions are in characters."""

    def __init__(self, text: str, tok: Tokenizer, lengths: np.ndarray) -> None:
        self.text, self.tok = text, tok
        # Line ends are \r\n, \r and \n: boundaries are looked for where a lone \r is \n, at the same positions.
        self.lined = _LONE_CR.sub("\n", text) if "\r" in text else text
        ends = np.cumsum(lengths)
        if len(text) == ends[-1]:  # one byte each
            char_at = None
        else:
            codes = np.frombuffer(self.lined.encode("utf-32-le", "replace"), np.uint32)
            width = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
            char_at = np.cumsum(width)  # the byte after each character
        self.n = len(lengths)
        # before[p]: tokens that begin before character p; where[t]: the character in which or before which token t begins
        starts, size = np.concatenate(([0], ends[:-1])), int(ends[-1])
        byte = np.arange(len(text) + 1) if char_at is None else np.concatenate(([0], char_at))
        self.before = _ranks(starts, size)[byte]
        self.where = np.append(starts if char_at is None else _ranks(byte[:-1], size)[starts], len(text))
        self._cuts: dict[tuple[int, int], tuple[int, int]] = {}
        self.codes = codes if char_at is not None else np.frombuffer(self.lined.encode("ascii"), np.uint8)
        self._bounds: list[list[int] | None] = [None] * 5

    def bounds(self, kind: int) -> list[int]:
        """Sorted positions of a kind of boundary, found when first asked for; a cut at p begins a piece with character p."""
        got = self._bounds[kind]
        if got is None:
            t, n = self.lined, len(self.text)
            if kind == 0:
                got = [m.start() for m in _SCENE.finditer(t)]
            elif kind == 2:
                got = (np.flatnonzero(self.codes == 10) + 1).tolist()
            else:
                got = [m.end() for m in (_CUE if kind == 1 else _SENTENCE if kind == 3 else _CLAUSE).finditer(t)]
            got = self._bounds[kind] = [p for p in got if 0 < p < n]
        return got

    def safe(self, p: int) -> bool:
        """Whether a cut at p changes no token."""
        return p == 0 or p == len(self.text) or _BREAK.match(self.text, p - 1) is not None

    def count(self, lo: int, hi: int, near: int) -> int:
        """Tokens of characters lo to hi: as in the whole text, or, where that comes to more than ``near``, as encoded by themselves."""
        n = int(self.before[hi] - self.before[lo])
        if n <= near:
            return n
        a, b = lo, hi
        if not self.safe(lo):
            m = _BREAK.search(self.text, lo, hi)
            a = m.end() if m else hi
        if not self.safe(hi):
            b = max((m.end() for m in _BREAK.finditer(self.text, max(a, hi - 64), hi) if m.end() < hi), default=a)
        if a >= b:
            return self.tok.count(self.text[lo:hi])
        return self.tok.count(self.text[lo:a]) + int(self.before[b] - self.before[a]) + self.tok.count(self.text[b:hi])

    def cut_once(self, lo: int, hi: int) -> tuple[int, int]:
        """``cut``, kept for the next limit: the bisections of all limits are one tree."""
        got = self._cuts.get((lo, hi))
        if got is None:
            got = self._cuts[lo, hi] = self.cut(lo, hi)
        return got

    def cut(self, lo: int, hi: int) -> tuple[int, int]:
        """(position, kind) of the strongest boundary near the middle of characters lo to hi.

        Near is the middle half by tokens; there the strongest kind counts, of one kind the nearest to the middle. Where
        it holds no scene, cue, line or sentence end, the nearest one of the whole span, then a clause end, then a token.
        """
        a, b = int(self.before[lo]), int(self.before[hi])
        mid = int(self.where[(a + b) // 2])
        # A token may reach over either end of the span.
        left, right = max(lo, int(self.where[a + (b - a) // 4])), min(hi, int(self.where[b - (b - a) // 4]))
        for kinds, (x, y) in ((range(4), (left, right)), (range(4), (lo, hi)), (range(4, 5), (left, right)), (range(4, 5), (lo, hi))):
            for k in kinds:
                ps = self.bounds(k)
                i, j = bisect_right(ps, x), bisect_left(ps, y)
                if i < j:
                    m = bisect_left(ps, mid, i, j)
                    p = min((q for q in (m - 1, m) if i <= q < j), key=lambda q: (abs(ps[q] - mid), q))
                    return ps[p], k
        p = mid if lo < mid < hi else lo + max(1, (hi - lo) // 2)
        return p, 5


def split_text(text: str, tok: Tokenizer, limits: list[tuple[int, int, int]]) -> Iterator[tuple]:
    """(limit_id, piece, start, core_start, end, n_tokens, boundary) of a text that exceeds a limit.

    ``limits``: (limit_id, max_tokens, overlap_tokens). A text within a limit gives nothing for it.
    Cores follow one another without gap and make up the text; a piece is its core with the
    overlap before it. n_tokens counts the tokens of the whole text in the piece, or, where that comes near to the limit, those of the
    piece encoded by itself.
    """
    smallest = min(m for _, m, _ in limits)
    if len(text) * 4 <= smallest:
        return
    lengths = tok.byte_lengths(text)
    if len(lengths) <= smallest:
        return
    c = _Cutter(text, tok, lengths)
    for limit_id, most, overlap in limits:
        if c.n <= most:
            continue
        room = most - overlap
        cores: list[tuple[int, int, int]] = []
        todo = [(0, len(text), 6)]
        while todo:
            lo, hi, kind = todo.pop()
            if int(c.before[hi] - c.before[lo]) <= room and c.count(lo, hi, room - NEAR) <= room or hi - lo == 1:
                cores.append((lo, hi, kind))
            else:
                p, k = c.cut_once(lo, hi)
                todo += [(p, hi, kind), (lo, p, k)]
        for i, (lo, hi, kind) in enumerate(cores):
            start, n = lo, c.count(lo, hi, most - NEAR)
            if i and overlap:
                first = int(c.before[lo]) - overlap
                start = int(c.where[max(0, first)])
                while True:
                    n = c.count(start, hi, most - NEAR)
                    if n <= most or start == lo:
                        break
                    first += max(1, n - most)
                    start = min(lo, max(start + 1, int(c.where[max(0, first)])))
            yield limit_id, i, start, lo, hi, n, KINDS[kind]


def split_documents(
    docs: DataFrame, limits: list[tuple[int, int, int]], id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """Cut texts larger than a limit into pieces within it, at natural boundaries, with overlaps.

    ``limits``: (limit_id, max_tokens, overlap_tokens). Output: limit_id, the id, piece (from 0), start, core_start, end
    (characters; the overlap is start to core_start), n_tokens, boundary (the kind of boundary at which the piece ends), text.
    Recursive bisection: a cut at the strongest boundary near the middle, again for halves that exceed max_tokens less
    overlap_tokens, then overlaps are attached: the last overlap_tokens tokens before the core, fewer only where the piece would
    exceed max_tokens on its own or a character would be split.

    Defined results: null, empty and small texts give no pieces; equal ids or texts are documents like any other; a
    single character of more tokens than the limit stays whole; limits with null or max_tokens < 1 are left out, an overlap is held
    between 0 and max_tokens - 1. Row-wise, without a shuffle: a hot id or a very long text is no more than its own rows.
    """
    limits = [(i, m, min(max(o or 0, 0), m - 1)) for i, m, o in limits if m is not None and m >= 1]
    cols = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = cols.schema["id"].dataType.simpleString()
    names = ["limit_id", id_col, "piece", "start", "core_start", "end", "n_tokens", "boundary", "text"]
    ddl = f"limit_id int, `{id_col}` {kind}, piece int, start int, core_start int, end int, n_tokens int, boundary string, text string"
    if not limits:
        return docs.sparkSession.createDataFrame([], ddl)
    smallest = min(m for _, m, _ in limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(vocabulary)
        types = [pa.int32(), None, *[pa.int32()] * 5, pa.string(), pa.string()]

        def out(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
            cols = list(zip(*rows)) if rows else [()] * 9
            return pa.RecordBatch.from_arrays([pa.array(c, t or id_type) for c, t in zip(cols, types)], names=names)

        for b in batches:
            rows, chars = [], 0
            for i, x in zip(b.column(0).to_pylist(), b.column(1)):
                text = x.as_py()
                if not text:
                    continue
                for limit_id, piece, start, core, end, n, kind_ in split_text(text, tok, limits):
                    rows.append((limit_id, i, piece, start, core, end, n, kind_, text[start:end]))
                    chars += end - start
                    if chars > BATCH_CHARS:
                        yield out(rows, b.column(0).type)
                        rows, chars = [], 0
            yield out(rows, b.column(0).type)

    # A text of so few bytes has no more tokens than the smallest limit; the filter reaches the scan.
    return cols.where(F.octet_length("text") > smallest).mapInArrow(run, ddl)
