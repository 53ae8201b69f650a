"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so that a question with other values has the same template. Windows
of template tokens are hash-joined with those of the benchmark; hits of one item that lie in one stretch are then read
again, alignment by alignment: the windows vote for what an item's value is in the document, one value for one, and
windows that agree with the votes count. A capitalised word that begins a sentence may be a name or not: windows are
joined under both readings. Items too short for a template are looked for as sentences of their own.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tickforge.llm.common import WORD, tidied, values
from tickforge.llm.hashing import mix, powers

#: Tokens of a window, literal tokens that a window needs, tokens from which on an item has a template, and the share of an item's windows that makes a leak.
WINDOW, LITERALS, LEAST, COVER = 8, 4, 4, 0.4
#: Benchmark items, and characters of them, that are sent to all tasks at once; larger benchmarks are taken in blocks of about so many.
ITEMS, CHARACTERS = 20_000, 20_000_000
#: Windows of a document that are read in all ways at once.
BLOCK = 4096
#: Words that a task remembers, beside those of the texts at hand, and characters of texts that are read at once.
WORDS, TEXTS = 200_000, 1 << 18
#: Units of measure.
UNITS = frozenset((
    "%", "am", "c", "cents", "cm", "days", "dollars", "eur", "euros", "f", "feet", "ft", "g", "gb", "grams", "hours", "hz", "in", "inches", "k", "kb",
    "kg", "kilograms", "kilometers", "km", "kph", "kwh", "l", "lb", "lbs", "liters", "m", "mb", "meters", "mg", "miles", "min", "minutes", "ml", "mm",
    "mph", "ms", "months", "oz", "pm", "pounds", "s", "seconds", "usd", "v", "w", "weeks", "yards", "years",
))
_UNIT_BYTES = frozenset(u.encode() for u in UNITS)
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
_NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*(?:e[+-]?\d+)?")
_MARKS, _ENDS = ".,!?;:()[]{}\"'«»“”‘’…", (".", "!", "?", ":")
_P = {p: mix(np.array([k + 1], np.uint64))[0] for k, p in enumerate((NUMBER, NAME, UNIT))}


def _kind(word: str) -> tuple[str, int]:
    """Literal of a word and flags: 1 number, 2 unit, 4 capitalised, 8 ends a sentence."""
    core = word.strip(_MARKS)
    flags = 8 * (word.rstrip("\"'»”’)")[-1:] in _ENDS) if core != word else 0
    letters = core.isalpha()
    if not letters and _NUMBER.fullmatch(core):
        return core, flags | 1
    low = core.lower()
    if low in UNITS:
        flags |= 2
    if len(core) > 1 and core[0].isupper() and (letters or all(c.isalpha() or c in "'’-" for c in core)):
        flags |= 4
    return low or word, flags


def template(text: str) -> list[tuple[str, str, bool]]:
    """Template token and value of each word, and whether it is written as a name; a literal token is its own value."""
    out, was = [], 8
    for w in WORD.findall(text):
        low, flags = _kind(w)
        if flags & 1:
            out.append((NUMBER, low, flags & 4 > 0))
        elif flags & 2 and was & 1:
            out.append((UNIT, low, flags & 4 > 0))
        elif flags & 4 and not was & 8:
            out.append((NAME, low, flags & 4 > 0))
        else:
            out.append((low, low, flags & 4 > 0))
        was = flags
    return out


def _slot(theirs: tuple[str, str, bool], mine: tuple[str, str, bool]) -> str | None:
    """As what an item's token and a document's are the same: a placeholder, "" for equal words; None if they are not."""
    (a, x, name), (b, y, also) = theirs, mine
    if a in (NUMBER, UNIT) or b in (NUMBER, UNIT):
        return a if a == b else None
    if name and also:
        return NAME
    return "" if x == y and NAME not in (a, b) else None


def _slots(theirs: list, mine: list) -> list[tuple[tuple[str, str], str]] | None:
    """Kind and value in the item, and value in the document, of each slot; None if the window isn't the same."""
    out = []
    for k, (x, y) in enumerate(zip(theirs, mine, strict=True)):
        kind = _slot(x, y)
        if kind is None and k == 0 and y[0] != NUMBER:  # what precedes the window doesn't count
            kind = _slot(x, (y[1], *y[1:]))
        if kind is None:
            return None
        if kind:
            out.append(((kind, x[1]), y[1]))
    return out


def _agreed(windows: list[tuple[int, list]], slots: dict[tuple[str, str], str]) -> tuple[set[int], dict[tuple[str, str], str]]:
    """Of one alignment's windows (place in the item, slots) those that agree, and what their slots are, given ``slots``.

    Each window votes for its slots; the values of most votes win, and no two values of a kind become the same.
    """
    votes: dict = defaultdict(set)
    for q, found in windows:
        for key, y in found:
            votes[key, y].add(q)
    chosen, taken = dict(slots), {(k[0], y) for k, y in slots.items()}
    for key, y in sorted(votes, key=lambda v: (-len(votes[v]), v[0][1] != v[1], v)):
        if key not in chosen and (key[0], y) not in taken:
            chosen[key] = y
            taken.add((key[0], y))
    ok = {q for q, found in windows if all(chosen.get(key) == y for key, y in found)}
    return ok, {key: y for q, found in windows if q in ok for key, y in found}


def readings(h: np.ndarray, both: np.ndarray, n: int, first: tuple[np.ndarray, np.ndarray] | None = None):
    """Blocks (places, hashes) of the windows of n tokens, each with every choice of those of ``both`` it has as names.

    ``first``: places, ascending, and hashes that the token there has as well where it begins a window.
    """
    m = len(h) - n + 1
    sums, up = np.zeros(max(m, 0), np.uint64), powers(n)[0]
    for k in range(n if m > 0 else 0):
        sums += h[k : m + k] * up[n - 1 - k]
    at = np.flatnonzero(both)
    change = _P[NAME] - h[at]
    for lo in range(0, m, BLOCK):
        p = np.arange(lo, min(m, lo + BLOCK))
        s = sums[p]
        if first is not None:
            k = slice(*np.searchsorted(first[0], (lo, min(m, lo + BLOCK))))
            q = first[0][k]
            p, s = np.concatenate([p, q]), np.concatenate([s, sums[q] + (first[1][k] - h[q]) * up[n - 1]])
        j, end = np.searchsorted(at, p), np.searchsorted(at, p + n)
        while len(p):
            yield p, mix(s)
            more = end - j  # tokens that may still become names, each after those that have
            k = np.repeat(np.arange(len(p)), more)
            j = j[k] + np.arange(len(k)) - (np.cumsum(more) - more)[k]
            p, end = p[k], end[k]
            s = s[k] + change[j] * up[n - 1 - (at[j] - p)]
            j += 1


class _Tokens(dict):
    """Hashes of template tokens of whole texts; words (UTF-8) are looked up in a bounded cache of their numbers."""

    def __init__(self):
        self.literal, self.flags = np.empty(1 << 16, np.uint64), np.empty(1 << 16, np.uint8)

    def __missing__(self, word: bytes) -> int:
        if word.isalpha() and word.islower():  # small letters of ASCII
            low, flags = word, 2 * (word in _UNIT_BYTES)
        else:
            low, flags = _kind(word.decode())
        k = len(self)
        if k == len(self.literal):
            self.literal, self.flags = np.resize(self.literal, 2 * k), np.resize(self.flags, 2 * k)
        self.literal[k], self.flags[k] = xxhash.xxh64_intdigest(low), flags
        self[word] = k
        return k

    def hashes(self, *texts: str) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray], np.ndarray]:
        """Of the texts in a row: hashes of the template tokens, which of them may be names as well, places and hashes of those
        that are others where a text begins with them, and where each text's tokens begin (one more than texts).
        """
        if len(self) > WORDS:
            self.clear()
        words = [t.encode().split() for t in texts]  # at the white space that parts words
        starts = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        k = np.fromiter(map(self.__getitem__, chain.from_iterable(words)), np.int64, starts[-1])
        f = self.flags[k]
        was = np.empty_like(f)
        was[1:] = f[:-1]
        was[starts[:-1][starts[:-1] < len(f)]] = 8
        number = (f & 1) > 0
        unit = ~number & ((f & 2) > 0) & ((was & 1) > 0)
        name = ~number & ~unit & ((f & 4) > 0)
        both = name & ((was & 8) > 0)
        h = self.literal[k]
        alone, named = np.flatnonzero(unit | name & ~both), np.flatnonzero(unit & ((f & 4) > 0))
        first = np.concatenate([alone, named]), np.concatenate([h[alone], np.full(len(named), _P[NAME])])
        if len(named):
            order = np.argsort(first[0], kind="stable")
            first = first[0][order], first[1][order]
        h[number], h[unit], h[name & ~both] = _P[NUMBER], _P[UNIT], _P[NAME]
        return h, both, first, starts


def _alone(text: str, mine: list, i: int, theirs: list) -> bool:
    """Whether the item's words stand at place i, from a sentence's or a line's beginning to its end."""
    n = len(theirs)
    if [x[1] for x in mine[i : i + n]] != [x[1] for x in theirs]:
        return False
    spans = [m.span() for m in WORD.finditer(text)]
    before, after = text[spans[i - 1][1] : spans[i][0]] if i else "\n", text[spans[i + n - 1][1] : spans[i + n][0]] if i + n < len(spans) else "\n"
    ends = lambda k: _kind(text[slice(*spans[k])])[1] & 8
    return bool(("\n" in before or ends(i - 1)) and ("\n" in after or ends(i + n - 1)))


class Benchmark:
    """Windows of a block of items, by hash: for each the items and places where it stands."""

    def __init__(self, items: list[tuple[int, str]]):
        tokens = _Tokens()
        self.templates, self.windows, self.lengths = {}, {}, set()
        at: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        seen: set[tuple] = set()
        for item, text in items:
            t, (h, both, *_) = template(text or ""), tokens.hashes(text or "")
            if not t or (item, text) in seen:
                continue
            seen.add((item, text))
            n = width = min(WINDOW, len(t))
            ones = np.ones(n, np.int64)
            literal = np.convolve([x[0] == x[1] for x in t], ones, "valid")
            enough, start = literal >= LITERALS, 0
            if not enough.any():  # all of the item is one window, looked up by a part of it
                n, enough = len(t), np.zeros(len(literal), bool)
                start = int(np.argmin((WINDOW + 1) * np.convolve(both, ones, "valid") - literal))
                enough[start] = True
            key = len(self.templates)
            self.lengths.add(width)
            self.templates[key], self.windows[key] = (item, t, n), int(enough.sum())
            for p, g in readings(h, both, width):
                for q, x in zip(p[enough[p]].tolist(), g[enough[p]].tolist(), strict=True):
                    at[x].append((key, q - start, start))
        self.keys = np.array(sorted(at), np.uint64)
        self.places = [at[int(k)] for k in self.keys]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, h: np.ndarray, both: np.ndarray, first: tuple[np.ndarray, np.ndarray], starts: np.ndarray) -> list[dict[int, set[tuple[int, int]]]]:
        """Of each text and item (place in the text, place in the item) of windows that are equal under a reading."""
        out: list[dict[int, set[tuple[int, int]]]] = [defaultdict(set) for _ in starts[1:]]
        for width in sorted(self.lengths):
            for p, g in readings(h, both, width, first):
                on = np.flatnonzero(self.maybe[(g & np.uint64((1 << 20) - 1)).astype(np.int64)])
                if not len(on):
                    continue
                k = np.searchsorted(self.keys, g[on])
                k[k == len(self.keys)] = 0
                same = self.keys[k] == g[on]
                at = p[on][same]
                for d, i, j in zip((np.searchsorted(starts, at, "right") - 1).tolist(), at.tolist(), k[same].tolist(), strict=True):
                    for key, q, start in self.places[j]:
                        n = self.templates[key][2]
                        if min(n, WINDOW) == width and starts[d] <= i - start <= starts[d + 1] - n:
                            out[d][key].add((i - start - int(starts[d]), q))
        return out

    def leaks(self, texts: Iterable[str | None], tokens: _Tokens, cover: float = COVER):
        """Of each text (item, its windows, windows found with consistent slots, how many slots have other values) of each leaked item."""
        group, size = [], 0
        for t in texts:
            group.append(t or "")
            size += len(group[-1])
            if size > TEXTS:
                yield from self._judged(group, tokens, cover)
                group, size = [], 0
        yield from self._judged(group, tokens, cover)

    def _judged(self, texts: list[str], tokens: _Tokens, cover: float) -> list[list[tuple[int, int, int, int]]]:
        if not len(self.keys):
            return [[] for _ in texts]
        return [self._leaks(t, pairs, cover) if pairs else [] for t, pairs in zip(texts, self.hits(*tokens.hashes(*texts)), strict=True)]

    def _leaks(self, text: str, found: dict[int, set[tuple[int, int]]], cover: float) -> list[tuple[int, int, int, int]]:
        mine, best = template(text), {}
        for key, pairs in found.items():
            item, theirs, n = self.templates[key]
            if len(theirs) < LEAST:
                if any(_alone(text, mine, i, theirs) for i, _ in pairs):
                    best[key] = (item, 1, 1, 0)
                continue
            if len({q for _, q in pairs}) < cover * self.windows[key]:
                continue
            # a copy of the item may have words put in or left out: take hits from one stretch of the document
            stretches: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for i, q in pairs:
                stretches[(i - q) // (len(theirs) + 8)].append((i, q))
                stretches[(i - q) // (len(theirs) + 8) + 1].append((i, q))
            for near in stretches.values():
                ways: dict[int, list[tuple[int, list]]] = defaultdict(list)
                for i, q in sorted(near):
                    slots = _slots(theirs[q : q + n], mine[i : i + n])
                    if slots is not None:
                        ways[i - q].append((q, slots))
                # the alignment that explains most comes first; others must fit what it says
                ok, known = set(), {}
                for d in sorted(ways, key=lambda d: (-len(_agreed(ways[d], {})[0]), d)):
                    more, new = _agreed(ways[d], known)
                    ok |= more
                    known |= new
                if len(ok) >= cover * self.windows[key]:
                    got = (item, self.windows[key], len(ok), sum(k[1] != y for k, y in known.items()))
                    best[key] = max(best.get(key, got), got, key=lambda x: (x[2], -x[3]))
        return sorted(best.values(), key=lambda x: (x[0] is None, x[0] if x[0] is not None else 0, x))


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, items: int):
    """The benchmark in blocks of about ``items`` items and CHARACTERS characters, each small enough for the driver and all tasks."""
    rows = benchmark.select(item_col, text_col)
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("c")).first()
    k = max(-(-size["n"] // items), -(-size["c"] // CHARACTERS))
    for i in range(k):
        yield Benchmark([(r[0], r[1]) for r in rows.filter(F.pmod(F.xxhash64(item_col, text_col), F.lit(k)) == i).collect()])


def find_leaks(docs: DataFrame, benchmark: DataFrame, cover: float = COVER, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", items: int = ITEMS, item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, n_windows, n_found, n_changed of each item that a document leaks.

    A leak is found if at least ``cover`` of the item's windows stand in one stretch of the document, with slots that map
    consistently and one to one; n_changed counts slots with other values (0: a plain copy). Items of fewer than LEAST words
    leak where their words stand as a sentence or a line of their own.

    Null texts leak nothing; null ids and repeated rows are judged a row each, and whole texts are read, however long. Items
    without a word are in no document, repeated ones count once, and those of one id but other texts apart; ids are of any type that has an order. Other columns,
    whatever their names, are ignored. Empty tables: no rows. Documents are read once for each block of the benchmark.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    item_kind, item_type = dict(benchmark.dtypes)[item_col], to_arrow_type(benchmark.schema[item_col].dataType)
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("item_id", benchmark.schema[item_col].dataType), *(T.StructField(c, T.LongType()) for c in ("n_windows", "n_found", "n_changed"))])
    rows, out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t")), spark.createDataFrame([], schema)
    for block in _blocks(benchmark, item_col, item_text_col, items):
        sent = spark.sparkContext.broadcast(block)

        def judge(batches, sent=sent):
            tokens = _Tokens()
            for b in batches:
                got = [(d, *x) for d, found in zip(b.column(0).to_pylist(), sent.value.leaks(values(b.column(1)), tokens, cover), strict=True) for x in found]
                cols = list(zip(*got, strict=True)) or [()] * 5
                kinds = (b.column(0).type, item_type, *[pa.int64()] * 3)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "item_id", "n_windows", "n_found", "n_changed"])

        out = out.unionByName(rows.mapInArrow(tidied(judge), f"doc_id {kind}, item_id {item_kind}, n_windows long, n_found long, n_changed long"))
    return out


def drop_leaking(docs: DataFrame, benchmark: DataFrame, cover: float = COVER, text_col: str = "text", item_col: str = "item_id", items: int = ITEMS, item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns; texts don't leave their task."""
    spark = docs.sparkSession
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    for block in _blocks(benchmark, item_col, item_text_col, items):
        sent = spark.sparkContext.broadcast(block)

        def keep(batches, sent=sent):
            tokens = _Tokens()
            for b in batches:
                yield b.filter(pa.array([not found for found in sent.value.leaks(values(b.column(text_col)), tokens, cover)], pa.bool_()))

        docs = docs.mapInArrow(tidied(keep), schema)
    return docs
