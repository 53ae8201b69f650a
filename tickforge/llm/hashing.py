"""Hashes of words and of byte strings, whole batches at a time in numpy.

They depend on a key that is drawn anew for each run and known to its tasks only, so that no text can be written whose
hashes are equal though its words aren't: what is hashed are blocks of eight bytes, each turned by secret factors, and
sums of those with secret factors of their own. Any two different strings have equal hashes with a chance of about 2^-63.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass, field
from functools import cache

import numpy as np

from tickforge.llm.common import FOLD_BYTES

CHUNK = 1 << 20
_R = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x ^= x >> np.uint64(33)
    x *= _M2
    x ^= x >> np.uint64(33)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """R**i and R**-i modulo 2**64 for i up to n."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(n, CHUNK) + 1
        for name, r in (("up", _R), ("down", pow(_R, -1, 1 << 64))):
            p = np.full(size + 1, r, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


@cache
def _factors(seed: bytes, n: int) -> np.ndarray:
    return np.random.default_rng(int.from_bytes(seed, "big")).integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class Key:
    """The secret of one run; a driver draws it and sends it to tasks with their code."""

    seed: bytes = field(default_factory=lambda: os.urandom(16), repr=False)

    def odd(self, n: int = 4096) -> np.ndarray:
        """At least n odd factors."""
        return _factors(self.seed, max(4096, n))

    def turn(self, x: np.ndarray) -> np.ndarray:
        """A bijection of 64-bit words by factors of the key's own."""
        a, b, c = self.odd()[-3:]
        x = x + a
        x ^= x >> np.uint64(32)
        x *= b
        x ^= x >> np.uint64(29)
        x *= c
        x ^= x >> np.uint64(32)
        return x


#: For tests and where hashes stay within one text.
PLAIN = Key(b"tickforge")
_LOW = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def _eights(b: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as numbers; behind the end are zeros."""
    padded = np.concatenate([b, np.zeros(8, np.uint8)])
    return np.ndarray((len(b),), "<u8", padded, strides=(1,)).astype(np.uint64)


def blocks(b: np.ndarray, key: Key) -> np.ndarray:
    """Hashes of the eight bytes from each place on."""
    return key.turn(_eights(b))


def windows(g: np.ndarray, n: int, key: Key) -> np.ndarray:
    """Hashes of all windows of n bytes, eight at least, from ``blocks``."""
    odd, m = key.odd(n // 8 + 2), max(0, len(g) - n + 1)
    out = g[n - 8 : n - 8 + m] * odd[0]
    for j in range(n // 8):
        out += g[8 * j : 8 * j + m] * odd[j + 1]
    return key.turn(out)


def spans(g: np.ndarray, start: np.ndarray, end: np.ndarray, key: Key) -> np.ndarray:
    """Hashes of spans of eight bytes or more, from ``blocks``."""
    n = end - start
    odd = key.odd(int(n.max(initial=0)) // 8 + 3)
    out = n.astype(np.uint64) * odd[0] + g[end - 8] * odd[1]
    for j in range(int(n.max(initial=0)) // 8):
        some = np.flatnonzero(n >= 8 * j + 8)
        out[some] += g[start[some] + 8 * j] * odd[j + 2]
    return key.turn(out)


#: Bytes of a word from which it is hashed by itself.
LONG = 512


def _words(data: bytes, key: Key) -> tuple[np.ndarray, np.ndarray]:
    b = np.frombuffer(data, np.uint8)
    space = np.ones(len(b) + 2, bool)
    space[1:-1] = _SPACE[b]
    edge = np.flatnonzero(space[1:] != space[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64), start
    n, raw, odd = end - start, _eights(b), key.odd()
    h = key.turn(raw[start] & _LOW[np.minimum(n, 8)]) + n.astype(np.uint64) * odd[0]
    j, rest = 8, np.flatnonzero((n > 8) & (n <= LONG))
    while len(rest):  # eight bytes more of each word that has them
        h[rest] = key.turn(h[rest] * odd[1] + (raw[start[rest] + j] & _LOW[np.minimum(n[rest] - j, 8)]))
        j += 8
        rest = rest[n[rest] > j]
    for i in np.flatnonzero(n > LONG).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]], digest_size=8, key=key.seed).digest(), "little")
    return key.turn(h), start


def word_hashes(texts: list[str | None], key: Key = PLAIN, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the texts in a row, and where each text's begin (one more than texts). A-Z folded on demand."""
    counts, out, group, size = [], [], [], 0

    def flush():
        nonlocal group, size
        if not group:
            return
        data = b"\n".join(group)
        if len(group) == 1 and len(data) > CHUNK:  # one long text, cut between words
            at, parts = 0, []
            while at < len(data):
                cut = len(data)
                if len(data) - at > CHUNK:
                    cut = at + CHUNK
                    while cut < len(data) and not _SPACE[data[cut]]:
                        cut += 1
                parts.append(_words(data[at:cut], key)[0])
                at = cut
            h = np.concatenate(parts)
            counts.append(np.array([len(h)]))
        else:
            h, start = _words(data, key)
            ends = np.cumsum([len(t) + 1 for t in group])
            counts.append(np.diff(np.searchsorted(start, ends), prepend=0))
        out.append(h)
        group, size = [], 0

    for t in texts:
        data = (t or "").encode()
        data = data.translate(FOLD_BYTES) if fold else data
        if group and size + len(data) > CHUNK:
            flush()
        group.append(data)
        size += len(data) + 1
    flush()
    ptr = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), ptr.astype(np.int64)


def grams(words: np.ndarray, n: int, key: Key = PLAIN) -> np.ndarray:
    """Hashes of all runs of n words."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    out, odd = np.zeros(len(words) - n + 1, np.uint64), key.odd(n + 8)
    for k in range(n):
        out += words[k : len(words) - n + 1 + k] * odd[k + 8]
    return key.turn(out)


def shingle_sets(texts: list[str | None], n: int, key: Key = PLAIN) -> list[np.ndarray]:
    """The sorted distinct n-word shingles of each text; of a text with fewer words, its whole sequence as one."""
    words, ptr = word_hashes(texts, key)
    g = grams(words, n, key)
    out = []
    for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True):
        if b - a >= n:
            s = np.sort(g[a : b - n + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            out.append(grams(words[a:b], b - a, key) + np.uint64(b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out
