"""Token ids of whole texts with public tokenizers, word by word through a bounded cache."""

from __future__ import annotations

import re
import sys
from array import array

_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:|#$%&*]*)")
CACHE_WORDS = 200_000


def _byte_chars() -> list[str]:
    """The character that byte-level BPE writes for each byte: itself if it prints, else one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(rest)) for b in range(256)]


class _Cache(dict):
    """What ``make`` gives for words (UTF-8), kept in two generations of ``CACHE_WORDS``."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, word: bytes) -> bytes:
        v = self.old.get(word)
        if v is None:
            v = self.make(word)
        if len(self) >= CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = v
        return v


class WordEncoder:
    """ids of ``tokenizer.encode(text, add_special_tokens=False)`` as little-endian unsigned 32-bit bytes.

    For tokenizers in which no token spans white space and white space itself is dropped, so that a text's ids are those
    of its words in a row. Words are kept in a cache of two generations of ``CACHE_WORDS``.
    """

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.chars = _byte_chars()
        self.cache = _Cache(self._bytes)
        self.marks: dict[str, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _model(self, piece: str) -> bytes:
        """Ids of letters or of marks; those of ASCII stand for themselves."""
        return self._pack([t.id for t in self.model.tokenize(piece if piece.isascii() else "".join(map(self.chars.__getitem__, piece.encode())))])

    def _bytes(self, word: bytes) -> bytes:
        return self._word(word.decode())

    def _word(self, word: str) -> bytes:
        m = _SIMPLE.fullmatch(word)
        if not m:
            return self._pack(self.tokenizer.encode(word, add_special_tokens=False).ids)
        core, marks = m.groups()
        low = core.lower()
        if low == word:
            return self._model(word)
        return self.cache[low.encode()] + self._marks(marks) if marks else self.cache[low.encode()]

    def _marks(self, marks: str) -> bytes:
        if marks not in self.marks:
            if len(self.marks) >= CACHE_WORDS:
                self.marks.clear()
            self.marks[marks] = self._model(marks)
        return self.marks[marks]

    def encode(self, text: str | bytes) -> bytes:
        data = text.encode() if isinstance(text, str) else text
        return b"".join(map(self.cache.__getitem__, data.split()))  # at the white space that parts words

    def close(self) -> None:
        """Lets go of the cache."""
        self.cache.clear()
        self.cache.old = {}
        self.marks.clear()


_TOKENIZERS: dict = {}


def encoder(path: str) -> WordEncoder:
    """An encoder whose cache goes with the task that asks for it; the tokenizer is read once for each worker process."""
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer

        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return WordEncoder(_TOKENIZERS[path])
