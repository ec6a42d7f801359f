"""Public byte-level BPE tokenizers, with a cache of the words between provable cut points.

The pattern that splits text before the merges has no look-behind, and none of its alternatives runs
from a character that is not white space over a following space. A space after such a character is
therefore a cut point in every context: text before it and text from it on have the same tokens
together as apart. Words between cut points repeat, so each is encoded once per worker.
"""

from __future__ import annotations

import base64
import functools
import os
import re
from itertools import chain

import numpy as np

#: Where the vocabulary files lie; every operator takes another path as a parameter.
TOKENIZER_DIR = "/opt/tokenizers"

#: The pre-splitting pattern of the rank files. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: White space before a space: there a plain split at spaces isn't one at cut points.
_UNSAFE = re.compile(r"\s ")
_CACHED_WORDS = 400_000
_CACHED_CHARS = 48


@functools.lru_cache(maxsize=4)
def load(name: str, folder: str = TOKENIZER_DIR):
    import tiktoken

    with open(os.path.join(folder, name + ".tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def fingerprint(name: str, folder: str = TOKENIZER_DIR) -> str:
    """Names a tokenizer by its content, so that counts of another vocabulary are never reused."""
    import hashlib

    h = hashlib.sha256(PATTERN.encode())
    with open(os.path.join(folder, name + ".tiktoken"), "rb") as f:
        h.update(f.read())
    return h.hexdigest()[:32]


class _Words(dict):
    """Word (without the space before it) -> what `of` makes of the space and the word."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, word: str):
        value = self.of(" " + word)
        if len(word) <= _CACHED_CHARS and len(self) < _CACHED_WORDS:
            self[word] = value
        return value


class Encoder:
    """encode and count of one tokenizer; strings that look like special tokens are plain text."""

    def __init__(self, name: str, folder: str = TOKENIZER_DIR):
        self.encoding = load(name, folder)
        plain = self.encoding.encode_ordinary
        self.plain = plain
        self._ids = _Words(plain)
        self._counts = _Words(lambda word: len(plain(word)))
        self._lengths: np.ndarray | None = None

    def encode(self, text: str) -> list[int]:
        if _UNSAFE.search(text):
            return self.plain(text)
        first, *words = text.split(" ")
        return self.plain(first) + list(chain.from_iterable(map(self._ids.__getitem__, words)))

    def count(self, text: str | None) -> int:
        """Tokens of text; none for null and empty texts."""
        if not text:
            return 0
        if _UNSAFE.search(text):
            return len(self.plain(text))
        first, *words = text.split(" ")
        return len(self.plain(first)) + sum(map(self._counts.__getitem__, words))

    @property
    def byte_lengths(self) -> np.ndarray:
        """Bytes that each token id stands for."""
        if self._lengths is None:
            n = self.encoding.max_token_value + 1
            self._lengths = np.array([len(x) for x in map(self.encoding.decode_single_token_bytes, range(n))], dtype=np.int64)
        return self._lengths


@functools.lru_cache(maxsize=4)
def encoder(name: str, folder: str = TOKENIZER_DIR) -> Encoder:
    """One encoder per Python worker, with its cache."""
    return Encoder(name, folder)
