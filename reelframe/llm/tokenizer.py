"""A public byte-level BPE tokenizer by the path of its vocabulary; loaded once in each worker process."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import tiktoken

#: Where the public vocabularies lie; a parameter of every operator that counts tokens.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pre-tokenisation pattern that these vocabularies were made with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Tokenizer:
    """Token counts and byte lengths. Surrogates and other broken text are replaced, as UTF-8 demands."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._enc = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int32)
        for b, i in ranks.items():
            self._lengths[i] = len(b)

    def count(self, text: str) -> int:
        return len(self._enc.encode_to_numpy(text, disallowed_special=())) if text else 0

    def byte_lengths(self, text: str) -> np.ndarray:
        """The number of UTF-8 bytes of each token."""
        return self._lengths[self._enc.encode_to_numpy(text, disallowed_special=())] if text else self._lengths[:0]


@lru_cache(maxsize=4)
def tokenizer(path: str = VOCABULARY) -> Tokenizer:
    return Tokenizer(path)
