"""Exact token ids by cached words, for the lower-casing BPE whose file is given.

A text is cut at ASCII white space, and plain commas and stops are cut off the letters before them; each distinct piece
is tokenized once as long as the cache holds it. That changes no id: the tokenizer drops white space and starts a new
run between letters and punctuation before any merge. ASCII capitals are lowered first, unless the text holds a
combining mark (lowering must then follow composition) or what may be a special token.
"""

from __future__ import annotations

import re
import unicodedata
from array import array

#: Words that each of a cache's two generations keeps: bounds a Python worker's memory.
CACHE_WORDS = 100_000
#: Stops and commas behind an ASCII or Latin-1 lower-case letter in UTF-8 and before white space or the end. The stop
#: comes first, so that the search passes quickly over letters.
_STOPS = re.compile(rb"[,.](?:(?<=[a-z].)|(?<=\xc3[\x9f-\xb6\xb8-\xbf].))[,.]*(?=[\x09-\x0d\x20]|$)")
_MARKS = re.compile("[̀-ͯ҃-҉֑-ֽؐ-ٟۖ-ܑۭ-ँ़-्ั-๎᪰-᫿᷀-᷿⃐-⃿〪-゙〯-゚︠-︯]")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for code points from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def may_compose(text: str) -> bool:
    """Whether a text may hold a combining mark. Latin-1 has none."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _MARKS.search(text) is not None
    return False


class _Cache(dict):
    """Words in use and those of the generation before: what is used again comes over, so that frequent words are
    tokenized once, however many rare ones pass."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.before = encode, {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.before.get(word)
        self[word] = ids = self.encode(word) if ids is None else ids
        return ids

    def age(self) -> None:
        self.before = dict(self)
        self.clear()


class WordIds:
    """ids_bytes(texts): each text's ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.cache = _Cache(self._encode)
        self.cache_words = cache_words

    def _encode(self, word: bytes) -> bytes:
        if word.isalpha() and word.islower():  # bytes: ASCII only
            return array("I", [t.id for t in self.model.tokenize(word.decode())]).tobytes()
        text = word.decode()
        # A word of lower-case composed letters is one run, to which normalizing does nothing.
        if text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text) and "ı" not in text and "ß" <= max(text) < "ƀ":
            text = "".join([self.letters[b] for b in word])
            return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _pieces(self, text: str | None) -> list[bytes]:
        if not text:
            return []
        data = text.encode("utf-8", "replace")
        if b"<|" in data or may_compose(text):
            return data.split()
        return _STOPS.sub(rb" \g<0>", data.lower()).split()

    def ids_bytes(self, texts: list[str | None]) -> list[bytes]:
        """Null counts as empty."""
        out, cache = [], self.cache
        for text in texts:
            out.append(b"".join(map(cache.__getitem__, self._pieces(text))))
            if len(cache) > self.cache_words:
                cache.age()
        return out
