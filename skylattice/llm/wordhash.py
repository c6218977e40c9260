"""Hashed word features: a text's distinct words, lower-cased, without punctuation, as numbers below a modulus."""

from __future__ import annotations

import zlib

#: ASCII other than letters, digits and the apostrophe parts words; bytes of other characters stay.
_PARTS = bytes(b if b >= 128 or chr(b).isalnum() or b == 39 else 32 for b in range(256))
CACHE_WORDS = 100_000


class WordHash:
    """features(text): {feature number: count}. Words and their numbers are kept until the cache is full."""

    def __init__(self, size: int):
        self.size = size
        self.cache: dict[bytes, int] = {}

    def words(self, text: str | None) -> list[bytes]:
        return (text or "").encode("utf-8", "replace").lower().translate(_PARTS).split()

    def number(self, word: bytes) -> int:
        got = self.cache.get(word)
        if got is None:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            got = self.cache[word] = zlib.crc32(word) % self.size
        return got
