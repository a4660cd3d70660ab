"""A text reduced to its letters (categories L*) after NFKC and lower-casing, as code points, with their places."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

_DROP, _HARD = 0, 0xFFFFFFFF


def _letters(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKC", s).lower() if c.isalpha())


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    """For each code point of the basic plane: its one letter, 0 if it gives none, or _HARD if it depends on its neighbours."""
    table = np.zeros(0x10000, dtype=np.uint32)
    for p in range(0x10000):
        c = chr(p)
        if 0xD800 <= p < 0xE000:
            continue
        flat = unicodedata.normalize("NFKC", c)
        x = _letters(c)
        # Marks join what stands before them, and so do Hangul vowels and finals; sigma depends on what follows.
        joins = any(unicodedata.combining(d) or unicodedata.category(d)[0] == "M" or "ᄀ" <= d <= "ᇿ" for d in c + flat + unicodedata.normalize("NFKD", c)[:1])
        if joins or c == "Σ" or len(x) > 1:
            table[p] = _HARD
        else:
            table[p] = ord(x) if x else _DROP
    return table


def letters(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(letters, places): the code points of the letters, and for each the index of the character that gave it.

    Equal to ``[c for c in NFKC(text).lower() if c is a letter]`` for every text. Characters whose result does
    not depend on their neighbours go through a table; for a text with any other, the whole is normalised by the
    library, and the place of a letter is exact up to the run of such characters that it stems from.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    mapped = _table()[np.where(codes < 0x10000, codes, 0x0301)]  # beyond the basic plane: as hard
    if not (mapped == _HARD).any():
        places = np.flatnonzero(mapped)
        return mapped[places], places
    whole = np.frombuffer(_letters(text).encode("utf-32-le"), np.uint32)
    # Runs of hard characters with the starter before them, each normalised by itself, place the letters.
    hard = mapped == _HARD
    begin = np.flatnonzero(~(hard & np.concatenate(([False], np.ones(max(0, len(hard) - 1), bool)))))
    ends = np.append(begin[1:], len(codes))
    places: list[int] = []
    for i, j in zip(begin.tolist(), ends.tolist()):
        if j == i + 1 and not hard[i]:
            if mapped[i]:
                places.append(i)
        else:
            places += [min(i + k, j - 1) for k in range(len(_letters(text[i:j])))]
    at = np.array(places, dtype=np.int64)
    if len(at) != len(whole):  # a context that the runs don't show: spread the places evenly
        at = np.linspace(0, max(0, len(codes) - 1), len(whole)).astype(np.int64)
    return whole, at
