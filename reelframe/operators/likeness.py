"""Which texts of a script are like the end of a segment, for many segments and scripts at once.

A text of L characters is like the end of a segment if it shares at least three quarters of itself, in order, with the last L + 2 characters. So at most L // 4 of its
characters are not among them, which is counted on sketches (a bit for each of 64 classes of characters, then one for each character) before anything is compared; what is
left is compared exactly, bit-parallel over all pairs at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Elements of an array at a time: pairs of a segment and a text, pairs that stay in a core's cache, masks of the ends of segments, places of characters.
_PAIRS, _CACHED, _MASKS, _PLACES = 1 << 20, 1 << 15, 1 << 22, 1 << 20
#: Scripts of more texts than this are compared length by length with blocks of segments.
_LARGE = 2048
_ONES = np.uint64((1 << 64) - 1)


def _ranges(n: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n, one after the other."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


class Ends:
    """The segments and the texts of some groups; texts are those of a group once each, by length, of two characters at least and by groups in order as segments are."""

    def __init__(self, segs: list[str], seg_group: np.ndarray, texts: list[str], text_group: np.ndarray) -> None:
        self.segs, self.texts, self.group = segs, texts, seg_group
        self.n, self.size = np.array([len(x) for x in segs], np.int64), np.array([len(x) for x in texts], np.int64)
        flat = np.frombuffer("".join([*segs, *texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
        _, inv, many = np.unique(flat, return_inverse=True, return_counts=True)
        rank = np.empty(len(many), np.int64)
        rank[np.argsort(-many, kind="stable")] = np.arange(len(many))
        self.code, self.codes = rank[inv], len(many)
        ends = np.cumsum(np.concatenate([self.n, self.size]))
        self.end, self.start = ends[: len(segs)], ends[len(segs) :] - self.size
        # The first sketch is of all characters; the others have the bits of some of them each, one a character as long as there are no more than 512.
        bit, words = np.uint64(1) << (np.arange(self.codes) % 64).astype(np.uint64), min(-(-self.codes // 64), 8)
        self.bits = [bit, *(np.where(np.arange(self.codes) // 64 % words == w, bit, np.uint64(0)) for w in range(words))]
        self.sketch = [np.bitwise_or.reduceat(b[self.code], self.start) if texts else np.zeros(0, np.uint64) for b in self.bits]
        self.base = np.searchsorted(text_group, seg_group)
        # Texts that are short enough for a segment: those up to here.
        key = text_group * (1 << 32) + self.size
        self.upto = np.searchsorted(key, seg_group * (1 << 32) + np.maximum(self.n - 2, 0), "right")

    def like(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The pairs (segment, text) that are alike, in order of the segment, each with the characters shared with the last L - 2 to L + 2 of the segment; -1 where these are not as many
        or leave less than two characters before them."""
        longest = int(self.size.max()) if len(self.size) else 0
        width = max(min(int(self.n.max()) if len(self.n) else 0, longest + 2), 1)
        step = max(_MASKS // width, 1)
        for lo in range(0, len(self.segs), step):
            hi = min(lo + step, len(self.segs))
            masks = []
            for b in self.bits:
                m = np.zeros((hi - lo, width), np.uint64)
                for j in range(width):
                    at = np.flatnonzero(self.n[lo:hi] > j)
                    m[at, j] = b[self.code[self.end[lo + at] - 1 - j]]
                masks.append(np.bitwise_or.accumulate(m, axis=1, out=m))
            many = np.maximum(self.upto[lo:hi] - self.base[lo:hi], 0)
            got = [np.zeros((2, 0), np.int64)]
            for s, t in self._small(lo, np.where(many > _LARGE, 0, many)):
                got.append(self._kept(s, t, lo, masks))
            large = lo + np.flatnonzero(many > _LARGE)
            for g in np.unique(self.group[large]).tolist():
                for s, t in self._large(large[self.group[large] == g], lo, masks[0]):
                    got.append(self._kept(s, t, lo, masks, True))
            s, t = np.concatenate(got, axis=1)
            order = np.argsort(s, kind="stable")
            yield self._alike(s[order], t[order])

    def _small(self, lo: int, many: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of segments and texts that are short enough."""
        total = np.cumsum(many)
        a = 0
        while a < len(many):
            b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + _PAIRS, "right")))
            m = many[a:b]
            s = np.repeat(np.arange(lo + a, lo + min(b, len(many))), m)
            yield s, np.repeat(self.base[lo + a : lo + b], m) + _ranges(m)
            a = b

    def _large(self, segs: np.ndarray, lo: int, mask: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs of the segments of a group and its texts that the first sketch lets pass."""
        first, last = int(self.base[segs[0]]), int(self.upto[segs].max())
        sizes, starts = np.unique(self.size[first:last], return_index=True)
        for size, a, b in zip(sizes.tolist(), (first + starts).tolist(), [*(first + starts[1:]).tolist(), last]):
            mine = segs[self.n[segs] >= size + 2]
            sketch = self.sketch[0][a:b]
            rows = max(_CACHED // (b - a), 1)
            for k in range(0, len(mine), rows):
                s = mine[k : k + rows]
                pair = np.flatnonzero(np.bitwise_count(sketch & ~mask[s - lo, size + 1][:, None]) <= size // 4)
                if len(pair):
                    yield s[pair // (b - a)], a + pair % (b - a)

    def _kept(self, s: np.ndarray, t: np.ndarray, lo: int, masks: list[np.ndarray], passed: bool = False) -> np.ndarray:
        """Of the pairs, those that the sketches let pass: the first one, then the others together."""
        size, missing = self.size[t], np.zeros(len(s), np.int64)
        for k, (mask, sketch) in enumerate(zip(masks, self.sketch)):
            if k == 0 and passed:
                continue
            if k == 1:
                missing = np.zeros(len(s), np.int64)
            missing = missing + np.bitwise_count(sketch[t] & ~mask[s - lo, size + 1])
            keep = missing <= size // 4
            s, t, size, missing = s[keep], t[keep], size[keep], missing[keep]
        return np.stack([s, t])

    def _alike(self, s: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out, size = self.shared(s, t), self.size[t]
        keep = out[:, 4] >= 0.75 * size
        s, t, out, size = s[keep], t[keep], out[keep], size[keep]
        tail = size[:, None] + np.arange(-2, 3)
        out[(tail < 2) | (tail > self.n[s][:, None] - 2)] = -1
        return s, t, out

    def shared(self, s: np.ndarray, t: np.ndarray) -> np.ndarray:
        """The LCS length of each text with the last L - 2 to L + 2 characters of the segment; segments in rising order."""
        out, words = np.empty((len(s), 5), np.int64), (self.size[t] + 65) // 64
        for w in np.unique(words).tolist():
            ids = np.flatnonzero(words == w)
            some, a = max(_PLACES // (self.codes * w), 1), 0
            while a < len(ids):
                # Some segments, and not too many pairs of them.
                b = min(int(np.searchsorted(s[ids], s[ids[a]] + some)), a + _PAIRS // w)
                out[ids[a:b]] = self._shared(s[ids[a:b]], t[ids[a:b]], w)
                a = b
        return out

    def _shared(self, s: np.ndarray, t: np.ndarray, words: int) -> np.ndarray:
        """Texts and segments are read from their ends, so that a bit depends on those below it only and one pass tells for all lengths of the end of a segment."""
        order = np.argsort(-self.size[t], kind="stable")
        s, size, end = s[order], self.size[t[order]], self.start[t[order]] + self.size[t[order]]
        first, last = int(s.min()), int(s.max())
        n = self.n[first : last + 1]
        places = [np.zeros((last + 1 - first, self.codes), np.uint64) for _ in range(words)]
        for j in range(min(int(n.max()), 64 * words)):
            at = np.flatnonzero(n > j)
            places[j // 64][at, self.code[self.end[first + at] - 1 - j]] |= np.uint64(1 << j % 64)
        row, v = s - first, [np.full(len(s), _ONES) for _ in range(words)]
        for j in range(int(size[0])):
            m = int(np.searchsorted(-size, -j))
            r, c, carry = row[:m], self.code[end[:m] - 1 - j], None
            for x, place in zip(v, places):
                x = x[:m]
                u = x & place[r, c]
                total, rest = x + u, x - u
                if words > 1:
                    over = total < x
                    if carry is not None:
                        total += carry
                        over |= total < carry
                    carry = over
                x[:] = total | rest
        got = np.empty((len(s), 5), np.int64)
        for d in range(-2, 3):
            left = np.zeros(len(s), np.int64)
            for w, x in enumerate(v):
                k = np.clip(size + d - 64 * w, 0, 64)
                left += np.bitwise_count(np.where(k > 0, x & (_ONES >> (64 - np.maximum(k, 1)).astype(np.uint64)), np.uint64(0)))
            got[order, d + 2] = size + d - left
        return got
