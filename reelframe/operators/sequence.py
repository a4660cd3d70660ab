"""Passes over the ordered cues of an episode in which a row depends on what happened to the rows before it.

Such passes cannot be windows. Each is a function over Python lists, and ``by_episode`` runs them in Arrow batches
on one group of an entity at a time. Groups are cut at silences (``islands``) where a pass cannot look across one, so that an episode of
a large share of the rows is many groups.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator
from collections import Counter
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reelframe.functions.text import NOT_HAN
from reelframe.operators.likeness import Ends
from reelframe.operators.ranks import bucketed, neighbour, null_safe_join
from reelframe.session import spread

_NOT_HAN = re.compile(NOT_HAN)
PARTICLES = "吗呢吧啊哦嗯哈呀啦哟"  # fixed value: particles that a line of the script may end in


def han(s: str | None) -> str:
    return _NOT_HAN.sub("", s or "")


@dataclass(frozen=True)
class Cue:
    text: str
    start: float
    end: float
    li: int = -1
    score: float = 0.0

    @cached_property
    def h(self) -> str:
        return han(self.text)


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    masks: dict[str, int] = {}
    for i, c in enumerate(b):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(b)) - 1
    v = full
    for c in a:
        u = v & masks.get(c, 0)
        v = (v + u | v - u) & full
    return len(b) - v.bit_count()


def ratio(a: str, b: str) -> float:
    """H5 for Python strings."""
    return lcs(a, b) / max(len(a), len(b)) if a and b else 0.0


def ordered_ratio(hay: str, needle: str) -> float:
    """H6 for Python strings."""
    at = n = 0
    for c in needle:
        at = hay.find(c, at) + 1
        if not at:
            break
        n += 1
    return n / max(len(needle), 1)


class Script(list):
    """The lines of a script, searched for those that are like a text without comparing it with each.

    Lines are kept once each, by length. The characters that a line shares with a text in any order are at least those it shares in order; they are counted for all
    lines of the lengths in question at once, a byte a line, and only lines with enough of them are compared. What is found is what comparing all lines finds.
    """

    def __init__(self, lines: list[str]) -> None:
        super().__init__(lines)
        self.where: dict[str, list[int]] = {}
        for i, x in enumerate(lines):
            if x:
                self.where.setdefault(x, []).append(i)
        self.texts = sorted(self.where, key=len)
        self.ids = {x: i for i, x in enumerate(self.texts)}
        self.sizes = np.array([len(x) for x in self.texts], np.int64)
        self.first = np.array([self.where[x][0] for x in self.texts], np.int64)
        longest = int(self.sizes[-1]) if self.texts else 0
        #: The first text of so many characters or more.
        self.start = np.searchsorted(self.sizes, np.arange(longest + 2)).tolist()
        self._code: dict[str, int] = {}
        flat = np.array([self._code.setdefault(c, len(self._code)) for x in self.texts for c in x], np.int32)
        end = np.cumsum(self.sizes)
        #: Column j: the characters in place j from the left (right) of all texts that have so many.
        self.left = [flat[(end - self.sizes)[self.start[j + 1] :] + j] for j in range(longest)]
        self.right = [flat[end[self.start[j + 1] :] - 1 - j] for j in range(longest)]
        self._kind = np.uint8 if longest < 256 else np.uint32
        pair, n = np.unique(flat.astype(np.int64) * len(self.texts) + np.repeat(np.arange(len(self.texts)), self.sizes), return_counts=True)
        owner, cuts = pair % max(len(self.texts), 1), np.searchsorted(pair, np.arange(len(self._code) + 1) * len(self.texts))
        #: How often each text has a character: of all texts, or of those that have it where these are few.
        self._count: dict[str, tuple[np.ndarray | None, np.ndarray]] = {}
        for c, k in self._code.items():
            at, m = owner[cuts[k] : cuts[k + 1]], n[cuts[k] : cuts[k + 1]].astype(self._kind)
            if len(at) * 16 < len(self.texts):
                self._count[c] = at, m
            else:
                every = np.zeros(len(self.texts), self._kind)
                every[at] = m
                self._count[c] = None, every
        self._least: dict[float, np.ndarray] = {}
        self._ends: dict[int, dict[str, list[str]]] = {}

    @cached_property
    def _by_text(self) -> list[int]:
        return sorted(range(len(self)), key=self.__getitem__)

    @cached_property
    def _by_text_array(self) -> np.ndarray:
        return np.array(self._by_text, np.int64)

    def between(self, shortest: int, longest: int) -> tuple[int, int]:
        """The texts of so many characters."""
        last = len(self.start) - 1
        return self.start[min(max(shortest, 0), last)], self.start[min(max(longest, -1) + 1, last)]

    def add(self, total: np.ndarray, c: str, k: int, lo: int, hi: int) -> None:
        """Add one to the total of the texts lo to hi that have a character ``k`` times."""
        if c not in self._count:
            return
        at, n = self._count[c]
        if at is None:
            total += n[lo:hi] >= k
            return
        a, b = np.searchsorted(at, (lo, hi))
        total[(at[a:b] if k == 1 else at[a:b][n[a:b] >= k]) - lo] += 1

    def shared(self, h: str, lo: int, hi: int) -> np.ndarray:
        """The characters that the texts lo to hi share with ``h`` in any order."""
        total, seen = np.zeros(hi - lo, self._kind), Counter()
        for c in h:
            seen[c] += 1
            self.add(total, c, seen[c], lo, hi)
        return total

    def lcs(self, h: str) -> np.ndarray:
        """The LCS length of ``h`` with each line."""
        texts = self.compare(h, np.arange(len(self.texts)))
        return np.array([texts[self.ids[x]] if x else 0 for x in self], np.int64)

    def like(self, h: str, least: int) -> list[int]:
        """The lines, in order, that have at least ``least`` characters in common with ``h`` in order."""
        return np.flatnonzero(self.lcs(h) >= least).tolist()

    def compare(self, h: str, ids: np.ndarray) -> np.ndarray:
        """The LCS length of ``h`` with the texts ``ids``, in rising order."""
        n, masks = len(h), {}
        for i, c in enumerate(h):
            masks[c] = masks.get(c, 0) | 1 << i
        full = (1 << n) - 1
        if n > 64 or len(ids) < 24:
            out = []
            for i in ids.tolist():
                v = full
                for c in self.texts[i]:
                    if m := masks.get(c):
                        u = v & m
                        v = (v + u | v - u) & full
                out.append(n - v.bit_count())
            return np.array(out, np.int64)
        table = np.zeros(len(self._code), np.uint64)
        for c, m in masks.items():
            if c in self._code:
                table[self._code[c]] = m
        v = np.full(len(ids), full, np.uint64)
        for j in range(int(self.sizes[ids[-1]])):
            at = int(np.searchsorted(ids, self.start[j + 1]))
            x = v[at:]
            u = x & table[self.left[j][ids[at:] - self.start[j + 1]]]
            v[at:] = (x + u) | (x - u)
        return n - np.bitwise_count(v & np.uint64(full)).astype(np.int64)

    def _next(self, i: int, first: int) -> int:
        """The first line from ``first`` on that is text i; -1 if there is none."""
        if self.first[i] >= first:
            return int(self.first[i])
        w = self.where[self.texts[i]]
        k = bisect_left(w, first)
        return w[k] if k < len(w) else -1

    def pick(self, h: str, ids: np.ndarray, bound: np.ndarray, first: int = 0, least: float = 0.0) -> tuple[int, float]:
        """The first line from ``first`` on of the greatest ratio among texts, of which no ratio is above its bound; (-1, 0) if it is 0 or below ``least``."""
        order = np.argsort(-bound, kind="stable")
        ids, bound = ids[order], bound[order]
        at, top, k, step = -1, least, 0, 16
        while k < len(ids) and bound[k] >= top and bound[k] > 0:
            some = np.sort(ids[k : k + step])
            rs = self.compare(h, some) / np.maximum(self.sizes[some], len(h))
            for i in np.flatnonzero((rs >= top) & (rs > 0)).tolist():
                r = float(rs[i])
                li = self._next(int(some[i]), first) if r >= top else -1
                if li >= 0 and (r > top or at < 0 or li < at):
                    at, top = li, r
            k, step = k + step, min(4 * step, 4096)
        return (at, top) if at >= 0 else (-1, 0.0)

    def best(self, h: str) -> tuple[int, float]:
        """The first line of the greatest ratio; (-1, 0) if it is 0."""
        if h in self.where:
            return self.where[h][0], 1.0
        n = len(h)
        # A ratio is at most that of the lengths: lines of other lengths are looked at only where the best of those of like length is poor.
        for least in (0.6, 0.4, 0.2, 0.0):
            lo, hi = self.between(int(least * n), int(n / least) + 1 if least else 1 << 30)
            bound = self.shared(h, lo, hi) / np.maximum(self.sizes[lo:hi], n)
            ids = np.flatnonzero(bound >= least)
            got = self.pick(h, ids + lo, bound[ids], 0, least)
            if got[0] >= 0:
                return got
        return -1, 0.0

    def holds(self, h: str, least: float) -> bool:
        """Whether a line has ``least`` characters in common with ``h`` in order."""
        shared = self.shared(h, 0, len(self.texts))
        ids = np.flatnonzero(shared >= least)
        ids = ids[np.argsort(-shared[ids].astype(np.int64), kind="stable")]
        return any((self.compare(h, np.sort(ids[k : k + 256])) >= least).any() for k in range(0, len(ids), 256))

    def around(self, h: str, more: int) -> list[str]:
        """The texts that are ``h`` and up to ``more`` characters around it, in order of their first line."""
        lo, hi = self.between(len(h) + 1, len(h) + more)
        ids = lo + np.flatnonzero(self.shared(h, lo, hi) >= len(h))
        return self.ordered(i for i in ids.tolist() if h in self.texts[i])

    def ordered(self, ids: Iterable[int]) -> list[str]:
        return [self.texts[i] for i in sorted(set(ids), key=self.first.__getitem__)]

    def starting(self, part: str, first: int = 0) -> int:
        """The first line from ``first`` on that begins with ``part`` and is longer; -1 if there is none."""
        # Behind the part itself in the order of texts.
        lo = bisect_right(self._by_text, part, key=self.__getitem__)
        hi = bisect_left(self._by_text, part + "\U0010ffff", lo, key=self.__getitem__)
        w = self._by_text_array[lo:hi]
        w = w[w >= first]
        return int(w.min()) if len(w) else -1

    def ending(self, tail: str) -> list[str]:
        """The texts that end with ``tail``, in order of their first line."""
        n = len(tail)
        if n not in self._ends:
            d = self._ends[n] = {}
            for x in self.where:
                if len(x) >= n:
                    d.setdefault(x[-n:], []).append(x)
        return self._ends[n].get(tail, [])

    def aligned(self, columns: list[np.ndarray], h: Iterable[str], lo: int, hi: int, most: int) -> list[int]:
        """Of the texts lo to hi, all long enough, those that have the characters ``h`` in the places of ``columns``, but for ``most``."""
        ids, miss = np.arange(lo, hi), np.zeros(hi - lo, np.int64)
        for j, c in enumerate(h):
            if not len(ids):
                break
            s = self.start[j + 1]
            miss = miss + ((columns[j][lo - s : hi - s] if len(ids) == hi - lo else columns[j][ids - s]) != self._code.get(c, -1))
            if j >= most:
                keep = miss <= most
                ids, miss = ids[keep], miss[keep]
        return ids.tolist()

    def enough(self, least: float) -> np.ndarray:
        """For each text, the whole number of characters that is ``least`` of it."""
        if least not in self._least:
            self._least[least] = np.ceil(least * self.sizes - 1e-9).astype(self._kind)
        return self._least[least]


def as_script(lines: list[str]) -> Script:
    return lines if isinstance(lines, Script) else Script(lines)


def best_line(h: str, lines: list[str]) -> tuple[int, float]:
    """The first line of the greatest ratio; (-1, 0) for fewer than two characters or no line in common."""
    if len(h) < 2 or not lines:
        return -1, 0.0
    if isinstance(lines, Script) or len(lines) > 64:
        return as_script(lines).best(h)
    at, top = -1, 0.0
    for i, x in enumerate(lines):
        if min(len(x), len(h)) > top * max(len(x), len(h)) and (r := ratio(h, x)) > top:
            at, top = i, r
    return at, top


def _original(text: str, k: int) -> int:
    """H8: the place of the k-th Han character in the text."""
    at = [i for i, c in enumerate(text) if not _NOT_HAN.match(c)]
    return at[k] if k < len(at) else len(text)


# --- passes over segments of text ---------------------------------------------------------------------------------------


def split_merged(segments: list[str], lines: list[str]) -> list[str]:
    """A segment that runs over two neighbouring lines of the script is cut between them."""
    return [p for parts in split_all([(segments, lines)])[0] for p in parts]


def split_all(groups: list[tuple[list[str], list[str]]]) -> list[list[list[str]]]:
    """W38 for many groups of segments, each with its script, at once: the parts of each segment."""
    segs, seg_group, places, texts, text_group, wheres = [], [], [], [], [], []
    for g, (segments, lines) in enumerate(groups):
        where: dict[str, list[int]] = lines.where if isinstance(lines, Script) else {}
        if not where:
            for i, x in enumerate(lines):
                where.setdefault(x, []).append(i)
        wheres.append(where)
        hs = [han(x) for x in segments]
        longest = max((len(h) for h in hs), default=0) - 2
        mine = sorted((x for x in where if 2 <= len(x) <= longest), key=len)
        long = [(i, h) for i, h in enumerate(hs) if len(h) >= 5] if mine else []
        segs += [h for _, h in long]
        places += [i for i, _ in long]
        seg_group += [g] * len(long)
        texts += mine
        text_group += [g] * len(mine)
    out = [[[x] for x in segments] for segments, _ in groups]
    if not segs:
        return out

    def cut(seg: str, h: str, like: list[tuple[str, list[int]]], g: int) -> list[str]:
        lines, ends = groups[g][1], []
        for b, shared in like:
            tails = ((len(b) + d - 2, n) for d, n in enumerate(shared) if n >= 0)
            ks = [(len(h) - tail, r) for tail, n in tails if (r := n / max(tail, len(b))) >= 0.75]
            if ks:
                ends += [(i, ks) for i in wheres[g][b] if i]
        for i, ks in sorted(ends, key=lambda x: x[0]):
            a = lines[i - 1]
            if len(a) < 2:
                continue
            scored = []
            for k, r2 in ks:
                r1 = max(ordered_ratio(a, h[:k]), ordered_ratio(h[:k], a))
                if r1 >= 0.3:
                    scored.append((r1 + r2, -k))
            if scored:
                at = _original(seg, -max(scored)[1])
                parts = [seg[:at].strip(), seg[at:].strip()]
                if all(parts):
                    return parts
        return [seg]

    for s, t, shared in Ends(segs, np.array(seg_group, np.int64), texts, np.array(text_group, np.int64)).like():
        first = np.flatnonzero(np.diff(s, prepend=-1)).tolist()
        ids, ts, shared = s.tolist(), t.tolist(), shared.tolist()
        for a, b in zip(first, [*first[1:], len(ids)]):
            i = ids[a]
            g, k = seg_group[i], places[i]
            out[g][k] = cut(groups[g][0][k], segs[i], [(texts[ts[x]], shared[x]) for x in range(a, b)], g)
    return out


def fix_single_chars(segments: list[str], lines: list[str]) -> list[str]:
    """A segment of one character before a recognised line becomes the end of the line before it, where that is unsaid."""
    out, hs = list(segments), [han(s) for s in segments]
    if len(lines) > 64 and any(len(h) == 1 for h in hs):
        lines = as_script(lines)
    for i, h in enumerate(hs):
        if len(h) != 1:
            continue
        ahead = next((x for x in hs[i + 1 : i + 5] if len(x) > 1), "")
        li, r = best_line(ahead, lines)
        if r < 0.5 or li < 1 or not lines[li - 1]:
            continue
        said = [x for x in hs[max(0, i - 7) : i] if len(x) > 1 and ratio(x, lines[li - 1]) >= 0.25]
        tail = _unsaid(lines[li - 1], said)
        if 1 <= len(tail) <= 4:
            out[i] = tail
    return out


def _unsaid(line: str, said: list[str]) -> str:
    """What of a line follows the last of the texts said of it."""
    return line[max([line.find(x) + len(x) for x in said if x in line], default=0) :]


def trim_overlap(segments: list[str]) -> list[str]:
    """A segment loses the beginning that repeats the end of the segment before it, as that now is."""
    out = list(segments)
    for i in range(1, len(out)):
        a, b = han(out[i - 1]), han(out[i])
        k = next((k for k in range(min(len(a), len(b) - 1), 0, -1) if a.endswith(b[:k])), 0)
        if k:
            out[i] = b[k:]
    return out


def drop_said_twice(text: str) -> str:
    """H9 for Python strings."""
    h = han(text)
    return re.sub(r"^(.{1,4}?)\1", r"\1", h) if len(h) >= 5 and re.match(r"(.{1,4}?)\1", h) else text


# --- passes over timed words and cues -------------------------------------------------------------------------------------


def merge_words(words: list[tuple[str, float, float]], gap: float = 0.4, chars: int = 15, span: float = 5.0, least: float = 0.3, last: bool = True) -> list[Cue]:
    """Words become cues: a new one after a pause above ``gap``, at ``chars`` characters, or once the cue spans more than ``span``.

    A cue without text goes if it is the last one (``last``: the words are the end of an episode).
    """
    out: list[list] = []
    for i, (t, s, e) in enumerate(words):
        ended = words[i - 1][2] if i else 0.0
        if not out or s - ended > gap or len(out[-1][0]) >= chars or ended - out[-1][1] > span:
            out.append([t, s, e])
        else:
            out[-1][0] += t
            out[-1][2] = e
    if last and out and not out[-1][0]:
        out.pop()
    return [Cue(t, s, s + least if e - s < least else e) for t, s, e in out]


def align_segments(segments: list[str], words: list[tuple[str, float, float]]) -> list[Cue]:
    """Segments in order take their times from the words whose characters they match.

    Characters match in order within a bounded look-ahead. Fewer than 15 % matched: the time of the word at hand. A span of 0.3 s
    at least, and of at most 0.35 s a character plus 1.5 s; a span that reaches this limit is looked for once more
    further on. Then ends are cut at the next start.
    """
    chars = [c for t, _, _ in words for c in t]
    owner = [i for i, (t, _, _) in enumerate(words) for _ in t]
    places: dict[str, list[int]] = {}
    for i, c in enumerate(chars):
        places.setdefault(c, []).append(i)

    def match(seg: str, at: int) -> list[int]:
        got = []
        for c in seg:
            where = places.get(c, [])
            k = bisect_right(where, at - 1)
            if k < len(where) and where[k] < min(at + 5 * len(seg) + 20, len(chars)):
                got.append(where[k])
                at = where[k] + 1
        return got

    out, pos = [], 0
    for text in segments:
        seg = re.sub(r"[^一-鿿㐀-䶿\w]", "", text)
        if not seg:
            continue
        got = match(seg, pos)
        if not got or len(got) / len(seg) < 0.15:
            if chars:
                s = words[owner[min(pos, len(chars) - 1)]][1]
                out.append(Cue(text, s, s + max(0.2 * len(seg), 0.5)))
            continue
        most = 0.35 * len(seg) + 1.5
        s, e = words[owner[got[0]]][1], words[owner[got[-1]]][2]
        e = min(max(e, s + 0.3) if e - s < 0.3 else e, s + most) if e - s > most or e - s < 0.3 else e
        if abs(e - s - most) < 0.05:
            again = match(seg, got[-1] + 1)
            if again and len(again) / len(seg) >= 0.8:
                s2, e2 = words[owner[again[0]]][1], words[owner[again[-1]]][2]
                if e2 - s2 < 0.85 * most:
                    got, s, e = again, s2, e2
        out.append(Cue(text, s, e))
        pos = got[-1] + 1
    for i in range(len(out) - 1):
        if out[i].end > out[i + 1].start:
            out[i] = replace(out[i], end=max(out[i].start + 0.3, out[i + 1].start - 0.05))
    return out


def join_single_chars(cues: list[Cue], lines: list[str], gap: float = 1.5) -> list[Cue]:
    """Two to four cues of one character each, close together, become one if a line of the script holds them."""
    script = "\0".join(lines)
    out, i = [], 0
    while i < len(cues):
        n = 0
        while n < 4 and i + n < len(cues) and len(cues[i + n].h) == 1 and (not n or cues[i + n].start - cues[i + n - 1].end <= gap):
            n += 1
        k = next((k for k in range(2, n + 1) if "".join(c.h for c in cues[i : i + k]) in script), 1)
        out.append(cues[i] if k == 1 else replace(cues[i], text="".join(c.h for c in cues[i : i + k]), end=cues[i + k - 1].end))
        i += k
    return out


def merge_short(cues: list[Cue], chars: int = 2, least: float = 0.5) -> list[Cue]:
    """A short cue and the one after it become one; pairs do not overlap."""
    out, i = [], 0
    while i < len(cues):
        c = cues[i]
        if len(c.text.strip()) <= chars and c.end - c.start < least and i + 1 < len(cues):
            out.append(replace(c, text=c.text.strip() + cues[i + 1].text.strip(), end=cues[i + 1].end))
            i += 2
        else:
            out.append(c)
            i += 1
    return out


def attach_orphans(cues: list[Cue], lines: list[str]) -> list[Cue]:
    """One or two characters before a pause join the beginning of the next cue where together they are a line of the script."""
    out, lines = list(cues), as_script(lines)
    i = 0
    while i + 1 < len(out):
        c, n = out[i], out[i + 1]
        if 1 <= len(c.h) <= 2 and n.start - c.end > 1.0:
            held = (c.h + n.h[:k] for k in range(1, len(n.h) + 1))
            line = min((x for x in held if x in lines.where), key=lambda x: lines.where[x][0], default=None)
            if line:
                out[i] = replace(c, text=line, end=min(c.start + 0.4 * len(line), n.start - 0.05))
                rest = n.h[len(line) - len(c.h) :]
                out[i + 1 : i + 2] = [replace(n, text=rest)] if rest else []
        i += 1
    return out


def drop_noise(cues: list[Cue], lines: list[str]) -> list[Cue]:
    """Cues of one character: a very short one joins the cue kept before it where the script has both, else it goes; another goes if it is no
    line of its own and no neighbour is a single character too."""
    script, alone = "".join(lines), {x for x in lines if len(x) == 1}
    out: list[Cue] = []
    for i, c in enumerate(cues):
        if len(c.h) == 1:
            if c.end - c.start <= 0.4:
                if out and script and out[-1].h + c.h in script and len(out[-1].h) >= 1:
                    out[-1] = replace(out[-1], text=out[-1].text + c.text, end=c.end)
                continue
            sides = [x.h for x in (cues[i - 1 : i] if i else []) + cues[i + 1 : i + 2]]
            if c.h not in alone and all(len(x) != 1 for x in sides):
                continue
        out.append(c)
    return out


def drop_repeats(cues: list[Cue]) -> list[Cue]:
    """A cue equal to the one kept before it, or (three characters or more) to its end but for one character, goes."""
    out: list[Cue] = []
    for c in cues:
        if out and c.h:
            p = out[-1].h
            if c.h == p or (3 <= len(c.h) < len(p) and sum(a != b for a, b in zip(p[-len(c.h) :], c.h)) <= 1):
                continue
        out.append(c)
    return out


# --- correction against the script -----------------------------------------------------------------------------------------
# A pass takes (cues with their matched line and score, lines) and gives the cues after it.

LOW, HIGH, NEAR = 0.35, 0.5, 6


def score(cues: list[Cue], lines: list[str]) -> list[Cue]:
    script = as_script(lines)
    return [replace(c, li=m[0], score=m[1]) for c in cues for m in [best_line(c.h, script)]]


class Claims:
    """Which lines are held by cues, kept up to date while a pass changes them."""

    def __init__(self, cues: list[Cue]) -> None:
        self._cues, self._n = cues, Counter(c.li for c in cues if c.score >= HIGH)

    def by_another(self, i: int, li: int) -> bool:
        c = self._cues[i]
        return self._n[li] > (c.li == li and c.score >= HIGH)

    def put(self, i: int, cue: Cue) -> None:
        old = self._cues[i]
        self._n[old.li] -= old.score >= HIGH
        self._n[cue.li] += cue.score >= HIGH
        self._cues[i] = cue


def fix_lost(cues: list[Cue], lines: list[str]) -> list[Cue]:
    """A cue that fits no line takes what its recognised neighbours leave unsaid: the end of the line before the next
    recognised one, that whole line if it is short and nobody's, the beginning of the recognised line, or the short line that is said again.

    The recognised neighbours are judged by the texts as they were, what is said by the texts as they now are.
    """
    out, lines = list(cues), as_script(lines)
    claims = Claims(out)
    for i, c in enumerate(cues):
        h = c.h
        if out[i].score >= LOW or len(h) <= 1:
            continue
        if lines.holds(h, 0.5 * len(h)):
            continue
        ahead = next((j for j in range(i + 1, min(len(out), i + NEAR + 1)) if len(cues[j].h) > 1 and out[j].score >= HIGH and out[j].li >= 0), None)
        if ahead is None:
            continue
        li = out[ahead].li
        got = None
        if li > 0 and lines[li - 1]:
            target = lines[li - 1]
            said = [x for x in (out[j].h for j in range(max(0, i - NEAR), i)) if len(x) > 1 and ratio(x, target) >= 0.25]
            tail = _unsaid(target, said)
            if 2 <= len(tail) <= 8 and tail != h:
                got = tail, li - 1
            elif not said and 2 <= len(target) <= 8 and target != h and not claims.by_another(i, li - 1):
                got = target, li - 1
        same, nh = lines[li], cues[ahead].h
        if got is None and same:
            head = same[: max(same.find(nh), 0)]
            if 2 <= len(head) <= 8 and head != h:
                got = head, li
            elif len(same) <= 3 and nh == same and len(h) > len(same) + 1:
                got = same, li
        if got:
            claims.put(i, replace(out[i], text=got[0], li=got[1], score=1.0))
    return out


def expand_substrings(cues: list[Cue], lines: list[str]) -> list[Cue]:
    """A cue that lacks up to four characters of a line becomes the line, unless the line is the cue said twice, what would be added in front
    is a neighbour's text, or another cue holds the line."""
    out, lines = list(cues), as_script(lines)
    claims = Claims(out)
    for i, c in enumerate(cues):
        h = c.h
        if len(h) < 4 or c.score >= 1.0:
            continue
        longer = next(iter(lines.around(h, 4)), None)
        if longer is None or longer == 2 * h:
            continue
        li = lines.where[longer][0]
        head = han(lines[li][: lines[li].find(h)])
        sides = [out[j].h for j in (i - 1, i + 1) if 0 <= j < len(out)]
        if not (head and head in sides) and not claims.by_another(i, li):
            claims.put(i, replace(c, text=lines[li], li=li, score=1.0))
    return out


def _per_cue(rule: Callable[[str, str], tuple[str, float] | None], among: Callable[[Script, str], Iterable[str]], least: int, most: int = 1 << 30) -> Callable[[list[Cue], list[str]], list[Cue]]:
    """A pass that looks at each cue by itself: the first line for which the rule gives a text and a score.

    ``among``: the lines, in order, of which it can be given for a text; others are not looked at.
    """

    def run(cues: list[Cue], lines: list[str]) -> list[Cue]:
        lines, known = as_script(lines), {}

        def look(h: str) -> tuple[str, int, float] | None:
            return next(((got[0], lines.where[x][0], got[1]) for x in among(lines, h) if (got := rule(h, x))), None)

        out = []
        for c in cues:
            h = c.h
            if least <= len(h) <= most:
                if h not in known:
                    known[h] = look(h)
                if known[h]:
                    c = replace(c, text=known[h][0], li=known[h][1], score=known[h][2])
            out.append(c)
        return out

    return run


def _common_end(a: str, b: str) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[-1 - n] == b[-1 - n]:
        n += 1
    return n


def _by_end(h: str, x: str) -> tuple[str, float] | None:
    """From a common end of four characters on, a missing beginning (1-2) is added, a wrong one (2-8) replaced."""
    n = _common_end(h, x)
    if len(x) < 5 or n < 4:
        return None
    mine, theirs = h[: len(h) - n], x[: len(x) - n]
    if not mine:
        return (theirs + h, 1.0) if 1 <= len(theirs) <= 2 else None
    return (theirs + h[-n:], 1.0) if theirs and 2 <= len(theirs) <= 8 else None


def _short_tail(h: str, x: str) -> tuple[str, float] | None:
    """Two or three characters that end as a line does lose what stands before."""
    n = _common_end(h, x)
    if len(x) < len(h) + 2 or n < 2 or n == len(h):
        return None
    return h[-n:], n / len(x)


def _diffs(a: str, b: str) -> int:
    return sum(x != y for x, y in zip(a, b))


def _doubled(h: str, x: str) -> bool:
    """The beginning of a cue is said twice, and without the first time it is the line."""
    n = len(h) - len(x)
    return 1 <= n <= 4 and n <= len(h) // 2 and h[n:] == x and h[:n] == h[n : 2 * n]


def _near_exact(h: str, x: str) -> tuple[str, float] | None:
    """The rules for a cue that differs from a line in one or two characters, in the order in which they hold."""
    short = h[:-1]
    if short == x:  # one character too many at the end
        return x, 1.0
    if len(h) - len(x) in (1, 2) and h.endswith(x):  # one or two too many in front
        return x, 1.0
    if _doubled(h, x):
        return x, 1.0
    if len(x) >= len(h):
        better = ratio(short, x)
        if x.endswith(short) and better >= ratio(h, x):
            return short, better
        tail = x[-len(short) :]
        if _diffs(short, tail) <= 1 and better >= ratio(h, x):
            return tail, better
    if len(h) >= 5 and len(x) == len(short) and _diffs(short, x) <= 1:
        return x, 1.0
    if len(x) == len(h) + 1 and _diffs(h, x) <= 1:
        return x, 1.0
    bare = x.rstrip(PARTICLES)
    if len(bare) == len(h) and 1 <= _diffs(h, bare) <= 2 and ratio(h, bare) >= 0.85:
        return bare, 1.0
    return None


def _cleanup(h: str, x: str) -> tuple[str, float] | None:
    """After merging: up to three characters too many in front, a doubled beginning, or one or two characters missing in front."""
    if (1 <= len(h) - len(x) <= 3 and h.endswith(x)) or _doubled(h, x) or (1 <= len(x) - len(h) <= 2 and x.endswith(h)):
        return x, 1.0
    return None


def _shorter(script: Script, h: str) -> list[int]:
    """Texts that are all but the first characters of ``h``, up to four."""
    return [script.ids[h[k:]] for k in range(1, 5) if h[k:] in script.ids]


def _near(script: Script, h: str) -> list[str]:
    """What a rule can hold for is all of the text but its ends, or equals it, place by place from the left or the right, but for two or one characters."""
    n = len(h)
    ids = _shorter(script, h) + [script.ids[x] for x in (h[:-1],) if x in script.ids]
    ids += script.aligned(script.right, h[-2::-1], script.between(n, n)[0], len(script.texts), 1)
    ids += script.aligned(script.left, h[:-1], script.between(n - 1, n - 1)[0], len(script.texts), 2)
    return script.ordered(ids)


def _whole(script: Script, h: str) -> list[str]:
    """W35."""
    return script.ordered(_shorter(script, h) + script.aligned(script.right, h[::-1], *script.between(len(h) + 1, len(h) + 2), 0))


fix_by_end = _per_cue(_by_end, lambda script, h: script.ending(h[-4:]), 4)
strip_short_heads = _per_cue(_short_tail, lambda script, h: script.ending(h[-2:]), 2, 3)
fix_near_exact = _per_cue(_near_exact, _near, 4)
clean_heads = _per_cue(_cleanup, _whole, 4)


def merge_fragments(cues: list[Cue], lines: list[str], gap: float = 2.0) -> list[Cue]:
    """A cue of up to three characters that fits no line joins the next cue, or else the one before, where together they fit one.

    With 0.9 or more the line's own text is taken. Forward, a beginning of one or two characters may be dropped where the rest begins a
    line. Backward, the score must rise and the short cue must not belong to an earlier line.
    """
    out: list[Cue | None] = list(cues)
    lines = as_script(lines)

    def fit(h: str) -> tuple[int, float] | None:
        if len(h) < 4:
            return None
        m = best_line(h, lines)
        return m if m[1] >= HIGH else None

    def joined(a: Cue, b: Cue, m: tuple[int, float]) -> Cue:
        return replace(a, text=lines[m[0]] if m[1] >= 0.9 else a.h + b.h, end=b.end, li=m[0], score=m[1])

    for i in range(len(out)):
        c = out[i]
        if c is None or len(c.h) > 3 or c.score >= HIGH:
            continue
        j = next((j for j in range(i + 1, len(out)) if out[j] is not None), None)
        if j is not None and out[j].start - c.end <= gap:
            n = out[j]
            if m := fit(c.h + n.h):
                out[i], out[j] = joined(c, n, m), None
                continue
            both = c.h + n.h
            hit = next(((both[k:], li) for k in (1, 2) if len(both) - k >= 2 and (li := lines.starting(both[k:])) >= 0), None)
            if hit:
                out[i], out[j] = replace(c, text=hit[0], end=n.end, li=hit[1], score=len(hit[0]) / len(lines[hit[1]])), None
                continue
        j = next((j for j in range(i - 1, -1, -1) if out[j] is not None), None)
        if j is not None and c.start - out[j].end <= gap:
            p = out[j]
            m = fit(p.h + c.h)
            if m and not 0 <= c.li < p.li and m[1] > p.score:
                out[j], out[i] = joined(p, c, m), None
    return [c for c in out if c is not None]


def fix_short_repeats(cues: list[Cue], lines: list[str]) -> list[Cue]:
    """A cue at least 2.5 times as long as its poor match becomes the short line that is said soon after, the nearest to the line before its own."""
    out = list(cues)
    for i, c in enumerate(out):
        h = c.h
        if len(h) < 4 or c.score >= HIGH or (c.li >= 0 and lines[c.li] and len(h) / len(lines[c.li]) < 2.5):
            continue
        near = [
            (abs(n.li - (c.li - 1)), k)
            for k, n in enumerate(out[i + 1 : i + NEAR + 1])
            if n.score >= HIGH and n.li >= 0 and 1 <= len(lines[n.li]) <= 3 and n.h == lines[n.li] != h
        ]
        if near:
            n = out[i + 1 + min(near)[1]]
            out[i] = replace(c, text=lines[n.li], li=n.li, score=1.0)
    return out


def split_long(cues: list[Cue], lines: list[str], longest: float = 4.0) -> list[Cue]:
    """A cue longer than ``longest`` that fits two lines, one after the other, is cut between them."""

    script = as_script(lines)

    def candidates(h: str, least: float, wanted: Callable[[int], bool]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each beginning of ``h``: its length, the texts of which the ratio may be ``least``, and their bounds. The characters shared in any order are counted on from one to the next."""
        hi, seen, enough = script.between(0, int(len(h) / least) + 1)[1], Counter(), script.enough(least)
        total = np.zeros(hi, enough.dtype)
        for k in range(1, len(h) - 1):
            seen[h[k - 1]] += 1
            script.add(total, h[k - 1], seen[h[k - 1]], 0, hi)
            if k > 1 and wanted(k):
                a, b = script.between(int(least * k), int(k / least) + 1)
                m = min(max(script.between(k, k)[0], a), b)
                ids = np.concatenate([a + np.flatnonzero(total[a:m] >= np.ceil(least * k - 1e-9)), m + np.flatnonzero(total[m:b] >= enough[m:b])])
                yield k, ids, total[ids] / np.maximum(script.sizes[ids], k)

    def begun(part: str, ids: np.ndarray, bound: np.ndarray, first: int, least: float) -> tuple[int, float]:
        """The best line from ``first`` on for the second part; a line that begins with it (four characters or more) counts 0.75 at least."""
        got = script.pick(part, ids, bound, first, least)
        li = script.starting(part, first) if len(part) >= 4 and got[1] <= 0.75 else -1
        return (li, 0.75) if li >= 0 and (got[1] < 0.75 or li < got[0]) else got

    out = []
    for c in cues:
        h, dur = c.h, c.end - c.start
        found = None
        if dur > longest and len(h) >= 4:
            least, own = (0.5, 0.5) if dur > 6.0 else (0.7, 0.95)
            n = len(h)
            heads = {k: a for k, ids, bound in candidates(h, least, lambda _: True) if (a := script.pick(h[:k], ids, bound, 0, least))[1] >= least}
            # Ends are counted from the right: where totals are equal, the shortest beginning counts.
            tail = lambda j: n - j in heads and (not found or heads[n - j][1] * (n - j) + j >= found[0] * n - 1e-9)  # noqa: E731, B023
            for j, ids, bound in candidates(h[::-1], least, tail) if heads else ():
                k = n - j
                a = heads[k]
                b = begun(h[k:], ids, bound, a[0] + 1, least)
                total = (a[1] * k + b[1] * (n - k)) / n
                if b[1] >= least and (not found or total >= found[0]):
                    found = total, k, a, b
        if not found:
            out.append(c)
            continue
        _, k, a, b = found
        at = c.start + k / len(h) * dur
        out.append(replace(c, text=lines[a[0]] if a[1] >= own else h[:k], end=at, li=a[0], score=a[1]))
        out.append(replace(c, text=lines[b[0]] if b[1] >= own else h[k:], start=max(at, c.end - (len(h) - k) / 6.0), li=b[0], score=b[1]))
    return out


def drop_fragments(cues: list[Cue], lines: list[str]) -> list[Cue]:
    """A cue that repeats the end of the one before it, or begins the one after it (but for one character), goes unless it is a line."""
    own = set(lines)
    gone = [i > 0 and len(c.h) > 1 and cues[i - 1].h.endswith(c.h) and c.h not in own for i, c in enumerate(cues)]
    for i, c in enumerate(cues[:-1]):
        n = cues[i + 1].h
        if not gone[i] and not gone[i + 1] and len(c.h) > 1 and c.h not in own and len(c.h) <= len(n) and _diffs(c.h, n) <= 1:
            gone[i] = True
    return [c for c, g in zip(cues, gone) if not g]


def drop_jumps(cues: list[Cue], lines: list[str], jump: int = 5, chars: int = 7) -> list[Cue]:
    """A short cue whose line lies more than ``jump`` lines ahead of both its surviving neighbours goes."""
    nxt, after = [-1] * len(cues), -1
    for i in range(len(cues) - 1, -1, -1):
        nxt[i] = after
        after = cues[i].li if cues[i].li >= 0 else after
    out, prev = [], -1
    for c, n in zip(cues, nxt):
        if c.li >= 0:
            if len(c.h) <= chars and n >= 0 and c.li > n + jump and (prev < 0 or c.li > prev + jump):
                continue
            prev = c.li
        out.append(c)
    return out


#: The order of the correction passes is part of their meaning.
CORRECTION = (fix_lost, expand_substrings, fix_by_end, strip_short_heads, fix_near_exact, merge_fragments, clean_heads, fix_short_repeats, split_long, drop_fragments, drop_jumps)


def correct(cues: list[Cue], lines: list[str]) -> list[Cue]:
    """W29 to W36, W27, W11, W12 in order."""
    if not lines:
        return cues
    lines = as_script(lines)
    now = score(cues, lines)
    for p in CORRECTION:
        now = p(now, lines)
    return now


# --- numbers ---------------------------------------------------------------------------------------------------------------


def repair_times(ts: list[float]) -> list[int]:
    """Times out of the longest non-decreasing subsequence are set: one or two in a row to the nearer side, more by a straight line."""
    n = len(ts)
    if not n:
        return []
    # best[i]: the longest that ends in i; of the predecessors that give it, the first counts. Of each length, the rows that end one come in falling order of
    # their times, so that the first one not above a time is found by bisection.
    best, parent, ends = [1] * n, [-1] * n, []
    for i, t in enumerate(ts):
        lo, hi = 0, len(ends)
        while lo < hi:  # the greatest length of which an end is not above t
            mid = (lo + hi) // 2
            if ts[ends[mid][-1]] <= t:
                lo = mid + 1
            else:
                hi = mid
        best[i] = lo + 1
        if lo:
            e = ends[lo - 1]
            parent[i] = e[bisect_left(e, -t, key=lambda j: -ts[j])]
        if lo == len(ends):
            ends.append([])
        ends[lo].append(i)
    keep, i = set(), best.index(max(best))
    while i >= 0:
        keep.add(i)
        i = parent[i]
    kept = sorted(keep)
    out = list(ts)
    for lo, hi in zip([-1, *kept], [*kept, n]):
        m = hi - lo - 1
        a, b = ts[lo] if lo >= 0 else None, ts[hi] if hi < n else None
        for k in range(1, m + 1):
            if a is None or b is None:
                out[lo + k] = b if a is None else a
            elif m <= 2:
                out[lo + k] = a if k <= m + 1 - k else b
            else:
                out[lo + k] = a + (b - a) / (m + 1) * k
    return [int(x) for x in out]


def quiet_cuts(wav, rate: int, longest_s: float, search_s: float = 5.0, window_ms: float = 100.0) -> list[tuple[int, int]]:  # noqa: ANN001
    """(start, end) of chunks cut at the quietest place near each multiple of ``longest_s``; the chunks make up the whole."""
    import numpy as np

    x = np.abs(np.asarray(wav, dtype=np.float64))
    most, reach, win = int(longest_s * rate), int(search_s * rate), max(4, int(window_ms / 1000 * rate))
    out, at = [], 0
    if len(x) / rate <= longest_s:
        return [(0, len(x))]
    while len(x) - at > most:
        lo, hi = max(at, at + most - reach), min(len(x), at + most + reach)
        cut = at + most
        if hi - lo > win:
            sums = np.convolve(x[lo:hi], np.ones(win), mode="valid")
            w = lo + int(sums.argmin())
            cut = w + int(x[w : w + win].argmin())
        cut = min(max(cut, at + 1), len(x))
        out.append((at, cut))
        at = cut
    return [*out, (at, len(x))]


def collapse_patterns(s: str, times: int = 20, longest: int = 20) -> str:
    """The shortest pattern of up to ``longest`` characters said ``times`` or more times running becomes one, from left to right."""
    out = []
    i = 0
    while len(s) - i >= 2 * times:
        k = next((k for k in range(1, longest + 1) if i + k * times <= len(s) and s[i : i + k] * times == s[i : i + k * times]), 0)
        out.append(s[i : i + max(k, 1)])
        if k:
            p, e = s[i : i + k], i + k * times
            while s.startswith(p, e):
                e += k
            i = e
        else:
            i += 1
    return "".join(out) + s[i:]


# --- running passes on a cluster --------------------------------------------------------------------------------------------


def islands(df: DataFrame, keys: list[str], order: list[str], gap: float, bucket: Column | None = None) -> DataFrame:
    """Add _island: rows of an entity apart from one another by a pause above ``gap``; no pass that breaks there looks across.

    With ``bucket``, a non-decreasing function of the order, a hot entity is spread over its buckets.
    """
    rows = neighbour(df, keys, order, ["end_time"], "_p", False, bucket)
    rows = rows.withColumn("_o", F.when(F.col("start_time") - F.col("_p.end_time") > gap, 1).otherwise(0)).drop("_p")
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumn("_island", F.sum("_o").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_o")
    return bucketed(rows, keys, order, "_o", "_island", bucket).drop("_o")


def words_to_cues(words: DataFrame, keys: list[str], order: list[str], gap: float = 0.4, bucket: Column | None = None) -> DataFrame:
    """W2 on a table of words: keys, text, start_time, end_time. Words without a time or text are left out. ``bucket``: see ``islands``."""
    w = words.where("start_time IS NOT NULL AND end_time IS NOT NULL AND text IS NOT NULL")
    rows = islands(w, keys, order, gap, bucket)
    rows = null_safe_join(rows, rows.groupBy(*keys).agg(F.max("_island").alias("_end")), keys).withColumn("_last", F.col("_island") == F.col("_end"))
    rows = rows.select(*keys, "_island", "_last", *dict.fromkeys([*order, "text", "start_time", "end_time"]))

    # Islands are many and short: they stream through a task in order, instead of being a group each.
    routed = spread(rows, [*keys, "_island"]).sortWithinPartitions(*keys, "_island", *order)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, words, last = None, [], False

        def done() -> list[tuple]:
            return [(*at[:-1], c.text, c.start, c.end) for c in merge_words(words, gap, last=last)] if words else []

        for pdf in it:
            out = []
            ids = list(zip(*[pdf[k].tolist() for k in keys], pdf["_island"].tolist()))
            for i, t, s, e, z in zip(ids, pdf["text"], pdf["start_time"], pdf["end_time"], pdf["_last"]):
                if i != at:
                    out += done()
                    at, words = i, []
                words.append((t, s, e))
                last = bool(z)
            yield pd.DataFrame(out, columns=[*keys, "text", "start_time", "end_time"])
        yield pd.DataFrame(done(), columns=[*keys, "text", "start_time", "end_time"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in w.select(*keys).schema) + ", text string, start_time double, end_time double"
    return routed.mapInPandas(run, ddl)


def correct_cues(cues: DataFrame, lines: DataFrame, keys: list[str], cue_ord: str, line_ord: str, passes: Callable[[list[Cue], list[str]], list[Cue]] = correct) -> DataFrame:
    """A pass over the cues of an entity against its script: keys, cue_ord (from 0), text, start_time, end_time, match_li, match_score.

    A group is an episode: the passes look at its whole script and at neighbours without bound.
    """
    c = cues.where("start_time IS NOT NULL AND end_time IS NOT NULL").select(*keys, cue_ord, F.coalesce("text", F.lit("")).alias("text"), "start_time", "end_time")
    s = lines.select(*keys, line_ord, F.regexp_replace(F.coalesce("line", F.lit("")), NOT_HAN, "").alias("line"))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = a.sort_values([cue_ord, "start_time"], kind="stable"), b.sort_values(line_ord, kind="stable")
        got = passes([Cue(t, s, e) for t, s, e in zip(a["text"], a["start_time"], a["end_time"])], b["line"].tolist())
        out = pd.DataFrame([(i, x.text, x.start, x.end, x.li, x.score) for i, x in enumerate(got)], columns=[cue_ord, "text", "start_time", "end_time", "match_li", "match_score"])
        for k in keys:
            out[k] = a[k].iloc[0] if len(a) else None
        return out[[*keys, cue_ord, "text", "start_time", "end_time", "match_li", "match_score"]]

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in c.select(*keys).schema)
    return spread(c, keys).groupBy(*keys).cogroup(spread(s, keys).groupBy(*keys)).applyInPandas(run, ddl + f", `{cue_ord}` long, text string, start_time double, end_time double, match_li int, match_score double")


def align_cues(segments: DataFrame, words: DataFrame, lines: DataFrame, keys: list[str], seg_ord: str, word_ord: str, line_ord: str) -> DataFrame:
    """W38, W37, W22, H9, J7 on tables of segments, words and script lines: keys, ord (from 0), text, start_time, end_time.

    Words without a time or text are left out. W38 and W37 are spread over pieces of an episode (``split_segments``); after them a group is an episode: the match goes on from
    segment to segment. Without a script W38 and W37 are left out.
    """
    parts = split_segments(segments, lines.dropna(subset=keys), keys, seg_ord, line_ord, fix_singles=True)
    null = lambda kind: F.lit(None).cast(kind)
    w = words.where("start_time IS NOT NULL AND end_time IS NOT NULL AND text IS NOT NULL")
    said = parts.select(*keys, F.lit(1).alias("_kind"), F.struct(F.col("_piece").alias("a"), F.col("_part").alias("b")).alias("_at"), null(words.schema[word_ord].dataType).alias("_i"), "text", null("double").alias("start_time"), null("double").alias("end_time"))
    heard = w.select(*keys, F.lit(0).alias("_kind"), null(said.schema["_at"].dataType).alias("_at"), F.col(word_ord).alias("_i"), "text", F.col("start_time").cast("double").alias("start_time"), F.col("end_time").cast("double").alias("end_time"))
    rows = spread(heard.unionByName(said), keys).sortWithinPartitions(*keys, "_kind", "_at", F.asc_nulls_last("_i"), "start_time", "end_time", "text").drop("_at", "_i")

    def run(group: dict[str, list]) -> list[tuple]:
        kinds = group["_kind"]
        n = bisect_left(kinds, 1)
        if n == len(kinds):
            return []
        words = list(zip(group["text"][:n], group["start_time"][:n], group["end_time"][:n]))
        got = align_segments([drop_said_twice(x) for x in trim_overlap(group["text"][n:])], words)
        return [(i, c.text, c.start, c.end) for i, c in enumerate(got)]

    return grouped(rows, keys, lambda groups: [run(g) for g in groups], "ord long, text string, start_time double, end_time double")


#: Segments of an entity that a task splits at a time; rows of whole groups that are handed to a pass together.
PIECE, TOGETHER = 4096, 1 << 14


def grouped(rows: DataFrame, keys: list[str], fn: Callable[[list[dict[str, list]]], list[list[tuple]]], ddl: str) -> DataFrame:
    """A pass over groups of ``keys``, which lie one after the other in partitions: keys and what ``fn`` gives for each of some groups, from the columns of each and its _key.

    Groups are many and most are short: they stream through a task, and many are handed over at once.
    """
    cols, given = [c for c in rows.columns if c not in keys], T.StructType.fromDDL(ddl)
    found = list(to_arrow_schema(given))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        ids: list[tuple] = []
        groups: list[dict[str, list]] = []

        def done(schema: pa.Schema) -> Iterator[pa.RecordBatch]:
            got = fn(groups)
            at = [i for i, r in zip(ids, got) for _ in r]
            flat = [x for r in got for x in r]
            columns = [*(list(c) for c in zip(*at)), *(list(c) for c in zip(*flat))] if flat else [[] for _ in schema]
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            for k in range(0, batch.num_rows, 10000):
                yield batch.slice(k, 10000)

        n, schema = 0, None
        for batch in it:
            schema = schema or pa.schema([*(batch.schema.field(k) for k in keys), *found])
            key = list(zip(*(batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys)))
            values = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in cols}
            # Equal texts are kept once: words are one or two characters each.
            for c, v in values.items():
                if v and isinstance(v[0], str):
                    values[c] = [known.setdefault(x, x) if x is not None and len(x) < 4 else x for x in v]
            cuts = [0, *(i for i in range(1, len(key)) if key[i] != key[i - 1]), len(key)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if not ids or key[a] != ids[-1]:
                    if n >= TOGETHER:
                        yield from done(schema)
                        ids, groups, n = [], [], 0
                    ids.append(key[a])
                    groups.append({"_key": key[a]} | {c: [] for c in cols})
                for c in cols:
                    groups[-1][c] += values[c][a:b]
                n += b - a
        if groups:
            yield from done(schema)

    return rows.mapInArrow(run, T.StructType([*rows.select(*keys).schema, *given]))


def split_segments(segments: DataFrame, lines: DataFrame, keys: list[str], seg_ord: str, line_ord: str, fix_singles: bool = False, piece: int | None = None) -> DataFrame:
    """W38 on tables, then W37 if ``fix_singles``: keys, _piece, _part (the order within an entity), text.

    W38 looks at a segment and the script, W37 at up to seven parts before a segment and four after it, and a segment has one part at least. So an entity of many segments is cut in
    pieces of ``piece``, each with the seven segments before it, the four after it and the whole script. An entity without a script is not changed; null texts count as empty.
    """
    size, before, after = piece or PIECE, 7 * fix_singles, 4 * fix_singles
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("_i"), "text")
    seg = segments.select(*keys, F.col(seg_ord).cast("long").alias("_i"), F.coalesce("text", F.lit("")).alias("text")).withColumn("_i", F.row_number().over(order).cast("long") - 1)
    # A segment is before a piece's own ones, one of them or after them.
    pieces = F.explode(F.sequence(F.greatest(F.floor((F.col("_i") - after) / size), F.lit(0)), F.floor((F.col("_i") + before) / size)))
    seg = seg.select(*keys, pieces.alias("_piece"), F.lit(1).alias("_kind"), "_i", "text")
    script = lines.select(*keys, F.lit(0).alias("_kind"), F.col(line_ord).cast("long").alias("_i"), F.regexp_replace(F.coalesce("line", F.lit("")), NOT_HAN, "").alias("text"))
    script = null_safe_join(script, seg.select(*keys, "_piece").distinct(), keys).select(seg.columns)
    by = [*keys, "_piece"]
    rows = spread(script.unionByName(seg), by).sortWithinPartitions(*by, "_kind", F.asc_nulls_last("_i"), "text")

    def run(groups: list[dict[str, list]]) -> list[list[tuple]]:
        cuts = [bisect_left(g["_kind"], 1) for g in groups]
        scripts = [g["text"][:n] for g, n in zip(groups, cuts)]
        got = []
        for g, n, script, parts in zip(groups, cuts, scripts, split_all([(g["text"][n:], s) for g, n, s in zip(groups, cuts, scripts)])):
            flat = [p for x in parts for p in x]
            if fix_singles and script:
                flat = fix_single_chars(flat, script)
            owner = [i for i, x in zip(g["_i"][n:], parts) for _ in x]
            here = g["_key"][-1] * size
            got.append([(k, p) for k, (i, p) in enumerate(zip(owner, flat)) if here <= i < here + size])
        return got

    return grouped(rows, by, run, "_part long, text string")


def split_script(segments: DataFrame, lines: DataFrame, keys: list[str], seg_ord: str, line_ord: str, piece: int | None = None) -> DataFrame:
    """W38 on tables: keys, ord (from 0), text; see ``split_segments``."""
    parts = split_segments(segments, lines, keys, seg_ord, line_ord, piece=piece)
    order = Window.partitionBy(*keys).orderBy("_piece", "_part")
    return parts.select(*keys, (F.row_number().over(order) - 1).cast("long").alias("ord"), "text")


def _key_ddl(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)


def segment_pass(segments: DataFrame, lines: DataFrame, keys: list[str], seg_ord: str, line_ord: str, fn: Callable[[list[str], list[str]], list[str]]) -> DataFrame:
    """W38, W37, W22 on tables: a pass over the segments of an entity in order, given its script: keys, ord (from 0), text.

    A pass goes on from segment to segment, so that a group is an entity. An entity without a script has an empty one; null texts count as empty.
    """
    seg = segments.select(*keys, F.col(seg_ord).cast("long").alias("_i"), F.coalesce("text", F.lit("")).alias("text"))
    script = lines.select(*keys, F.col(line_ord).cast("long").alias("_i"), F.regexp_replace(F.coalesce("line", F.lit("")), NOT_HAN, "").alias("text"))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        got = fn(a.sort_values("_i", kind="stable")["text"].tolist(), b.sort_values("_i", kind="stable")["text"].tolist())
        out = pd.DataFrame(list(enumerate(got)), columns=["ord", "text"])
        for k in keys:
            out[k] = a[k].iloc[0] if len(a) else None
        return out[[*keys, "ord", "text"]]

    return spread(seg, keys).groupBy(*keys).cogroup(spread(script, keys).groupBy(*keys)).applyInPandas(run, f"{_key_ddl(seg, keys)}, ord long, text string")


def cue_pass(cues: DataFrame, keys: list[str], order: list[str], fn: Callable[[list[Cue]], list[Cue]]) -> DataFrame:
    """W24 and other passes that need no script, on tables: keys, ord (from 0), text, start_time, end_time. Cues without a time are left out; null texts count as empty."""
    c = cues.where("start_time IS NOT NULL AND end_time IS NOT NULL").withColumn("text", F.coalesce("text", F.lit(""))).select(*dict.fromkeys([*keys, *order, "text", "start_time", "end_time"]))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        got = fn([Cue(t, s, e) for t, s, e in zip(pdf["text"], pdf["start_time"], pdf["end_time"])])
        out = pd.DataFrame([(i, x.text, x.start, x.end) for i, x in enumerate(got)], columns=["ord", "text", "start_time", "end_time"])
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out[[*keys, "ord", "text", "start_time", "end_time"]]

    return spread(c, keys).groupBy(*keys).applyInPandas(run, f"{_key_ddl(c, keys)}, ord long, text string, start_time double, end_time double")


@F.pandas_udf(T.ArrayType(T.LongType()))
def repaired_times(ts: pd.Series) -> pd.Series:
    """W40 on an array column of times; null stays null."""
    return ts.map(lambda x: None if x is None else repair_times(list(x)))


@F.pandas_udf(T.StringType())
def collapsed_patterns(text: pd.Series) -> pd.Series:
    """H11 on a text column; null stays null."""
    return text.map(lambda x: None if x is None else collapse_patterns(x))


def quiet_chunks(waves: DataFrame, keys: list[str], wav: str, rate: int, longest_s: float, search_s: float = 5.0, window_ms: float = 100.0) -> DataFrame:
    """W39 on a table of waves: keys, chunk (from 0), lo, hi (sample bounds). Row by row in Arrow batches, no shuffle; null waves give none, an empty one gives an empty chunk."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = [(*k, i, lo, hi) for *k, x in pdf.itertuples(index=False) for i, (lo, hi) in enumerate(quiet_cuts(x, rate, longest_s, search_s, window_ms))]
            yield pd.DataFrame(rows, columns=[*keys, "chunk", "lo", "hi"])

    return waves.where(F.col(wav).isNotNull()).select(*keys, wav).mapInPandas(run, f"{_key_ddl(waves, keys)}, chunk int, lo long, hi long")
