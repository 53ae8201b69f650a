"""Python data sources that ask a vendor in chunks, in turns that keep its limits for all tasks together.

Of a table, failures of a chunk lose that chunk and nothing else. Of a stream, a failure ends the batch, which is read again
from its offsets. With ``push`` filters on symbol, interval and time narrow what is asked for.
"""

from __future__ import annotations

import importlib
import math
import time
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual,
)

from tickforge.operators.bars import CHUNK_DAYS, DEFAULT_DAYS, SECONDS
from tickforge.schemas import QUOTE, names

#: Symbols of a quote call, and milliseconds to wait after a chunk of quotes, a single quote and a symbol's bars.
QUOTES_AT_ONCE, CHUNK_PAUSE, SINGLE_PAUSE, SYMBOL_PAUSE = 100, 500, 200, 120
DAY_MS = 86_400_000
#: Tasks that ask at once, in turns.
LANES = 4
VENDOR_BAR = "symbol string, date string, open double, high double, low double, close double, volume long, seq long, interval string, ts timestamp"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


class Turns:
    """When a lane may call: time is cut in turns of ``length`` seconds, which go round the lanes; a call takes ``cost`` of one.

    Turns follow the clock and nothing else, so that tasks need not know of each other: one that begins late, or again, waits
    for its next turn, and no two lanes call within the pause that a call demands.
    """

    def __init__(self, lane: int, lanes: int, length: float, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        self.lane, self.lanes, self.length, self.clock, self.sleep, self.free = lane, lanes, length, clock, sleep, 0.0

    def take(self, cost: float) -> float:
        """Waits for room in a turn of this lane, and gives when it began."""
        if self.length <= 0:
            return self.clock()
        now = self.clock()
        at = max(now, self.free)
        turn = math.floor(at / self.length + 1e-9)
        ahead = (self.lane - turn) % self.lanes
        if ahead or (turn + 1) * self.length - at < cost - 1e-6:
            at = (turn + (ahead or self.lanes)) * self.length
        if at > now:
            self.sleep(at - now)
        self.free = at + cost
        return at


class _Lane(InputPartition):
    """What one task asks for, call after call."""

    def __init__(self, lane: int, lanes: int, calls: list):
        self.lane, self.lanes, self.calls = lane, lanes, calls


def _spelled(symbol: str) -> str:
    return symbol.strip().upper().replace(".", "-")


def _client(name: str):
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _lanes(calls: list, options) -> list[_Lane]:
    """Calls dealt to ``lanes`` tasks; ``reader`` of ``readers`` share the vendor's limit, each with turns of its own."""
    lanes = max(1, int(options.get("lanes", LANES)))
    reader, readers = int(options.get("reader", 0)), int(options.get("readers", 1))
    return [_Lane(reader * lanes + i, readers * lanes, calls[i::lanes]) for i in range(min(lanes, len(calls)))]


def _listed(text: str) -> list[str]:
    return [s for s in text.split(",") if s.strip()]


def _millis(value: datetime, up: bool) -> int:
    at = (value if value.tzinfo else value.replace(tzinfo=UTC)).timestamp() * 1000
    return math.ceil(round(at, 3)) if up else math.floor(round(at, 3))


def _column(f, name: str, *kinds) -> bool:
    return isinstance(f, kinds) and getattr(f, "attribute", None) == (name,)


def _values(f) -> set:
    return set(f.value) if isinstance(f, In) else {f.value}


class QuoteSource(DataSource):
    """Quotes of a comma list ``symbols`` from a function ``client`` (``module:name``) that takes vendor symbols and gives a list of dicts.

    One call for each 100 symbols; where a call fails its symbols are asked for singly and those that fail again are left
    out. ``pause_ms`` is kept after each single call, ``chunk_pause_ms`` after each call for many, by all ``lanes`` together and by
    all ``readers`` of a vendor, of which this is number ``reader``.
    """

    @classmethod
    def name(cls) -> str:
        return "vendor_quotes"

    def schema(self) -> str:
        return QUOTE

    def reader(self, schema) -> DataSourceReader:
        return (_PushedQuotes if self.options.get("push", "false").lower() == "true" else _QuoteReader)(self.options)


class _QuoteReader(DataSourceReader):
    def __init__(self, options):
        self.options, self.symbols, self.client = dict(options), _listed(options.get("symbols", "")), options["client"]
        self.pause, self.chunk_pause = (float(options.get(k, v)) / 1000 for k, v in (("pause_ms", SINGLE_PAUSE), ("chunk_pause_ms", CHUNK_PAUSE)))

    def partitions(self):
        n = QUOTES_AT_ONCE
        return _lanes([self.symbols[i : i + n] for i in range(0, len(self.symbols), n)], self.options) or [_Lane(0, 1, [])]

    def read(self, partition):
        ask, columns = _client(self.client), names(QUOTE)
        turns = Turns(partition.lane, partition.lanes, max(self.pause, self.chunk_pause))
        for symbols in partition.calls:
            wanted = [_spelled(s) for s in symbols]
            turns.take(self.chunk_pause)
            try:
                found = ask(wanted)
            except Exception:  # noqa: BLE001  whatever the vendor's client raises
                found = []
                for s in wanted:
                    turns.take(self.pause)
                    try:
                        found += ask([s])
                    except Exception:  # noqa: BLE001, S110
                        pass
            for q in found:
                if q and q.get("symbol"):
                    yield tuple(q.get(c) for c in columns)


class _PushedQuotes(_QuoteReader):
    def pushFilters(self, filters):  # noqa: N802  a name that Spark gives
        for f in filters:
            if _column(f, "symbol", EqualTo, In):
                self.symbols = [s for s in self.symbols if _spelled(s) in _values(f)]
            yield f  # what a vendor calls a symbol is its own: Spark looks again


class BarSource(DataSource):
    """Bars of a comma list ``symbols`` at ``interval`` (or a comma list) from ``start_ms`` to ``end_ms``, as the vendor has them, with seq and ts.

    ``client`` (``module:name``) takes a vendor symbol, an interval and a range in milliseconds, and gives a list of dicts
    with a date. A symbol's range is cut as the interval demands; a chunk that fails is skipped. ``pause_ms`` is kept after each call,
    by all ``lanes`` and ``readers`` together. ``operators.bars.from_vendor`` and ``dedupe`` make bars of the rows.

    As a stream it goes on to the clock: its offset is the instant up to which all bars have been given, ``settle_ms`` behind the
    clock and at the end of a bar, or ``now_ms`` at most. A batch is a range, so that it can be asked for again; bars of its end belong to the next one. A call
    that fails ends the batch, unless ``failures`` is ``skip``.
    """

    @classmethod
    def name(cls) -> str:
        return "vendor_bars"

    def schema(self) -> str:
        return VENDOR_BAR

    def reader(self, schema) -> DataSourceReader:
        return (_PushedBars if self.options.get("push", "false").lower() == "true" else _BarReader)(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _BarStream(self.options)


def _calls(symbols: list[str], intervals: list[str], start: int, end: int) -> list[list[tuple]]:
    """The calls for each symbol and interval: (symbol, interval, from, to); neighbours share an instant."""
    out = []
    for symbol in symbols:
        for interval in intervals:
            step = CHUNK_DAYS.get(interval, DEFAULT_DAYS)[0] * DAY_MS
            out.append([(symbol, interval, begin, min(begin + step, end)) for begin in range(start, end, step)])
    return [calls for calls in out if calls]


def _row(symbol: str, interval: str, r: dict, seq: int) -> tuple:
    at = r.get("date")
    value = lambda n: None if r.get(n) is None else float(r[n])
    volume = value("volume")
    text = at.isoformat() if hasattr(at, "isoformat") else at if at is None else str(at)
    try:
        ts = at if isinstance(at, datetime) else datetime.fromisoformat(text) if text else None
    except ValueError:
        ts = None
    ts = ts.replace(tzinfo=UTC) if ts is not None and ts.tzinfo is None else ts
    return (symbol.strip().upper(), text, value("open"), value("high"), value("low"), value("close"), None if volume is None else int(volume), seq, interval, ts)


class _BarReader(DataSourceReader):
    def __init__(self, options):
        self.options, self.symbols, self.intervals = dict(options), _listed(options.get("symbols", "")), _listed(options.get("interval", "1m"))
        self.client, self.start, self.end, self.pause = options["client"], int(options["start_ms"]), int(options["end_ms"]), float(options.get("pause_ms", SYMBOL_PAUSE)) / 1000

    def partitions(self):
        return _lanes(_calls(self.symbols, self.intervals, self.start, self.end), self.options) or [_Lane(0, 1, [])]

    def read(self, partition) -> Iterator[tuple]:
        ask, turns = _client(self.client), Turns(partition.lane, partition.lanes, self.pause)
        for calls in partition.calls:
            seq = 0
            for symbol, interval, begin, end in calls:
                turns.take(self.pause)
                try:
                    rows = ask(_spelled(symbol), interval, begin, end)
                except Exception:  # noqa: BLE001  whatever the vendor's client raises
                    continue
                for r in rows or []:
                    yield _row(symbol, interval, r, seq)
                    seq += 1


class _PushedBars(_BarReader):
    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            if _column(f, "symbol", EqualTo, In):
                self.symbols = [s for s in self.symbols if s.strip().upper() in _values(f)]
            elif _column(f, "interval", EqualTo, In):
                self.intervals = [i for i in self.intervals if i in _values(f)]
            elif not _column(f, "symbol", IsNotNull):  # rows have one
                if _column(f, "ts", GreaterThan, GreaterThanOrEqual, EqualTo):
                    self.start = max(self.start, _millis(f.value, up=False))
                if _column(f, "ts", LessThan, LessThanOrEqual, EqualTo):
                    self.end = min(self.end, _millis(f.value, up=True) + (not isinstance(f, LessThan)))
                yield f  # a vendor may give more than it was asked for: Spark looks again


class _BarStream(DataSourceStreamReader):
    def __init__(self, options):
        self.options, self.symbols, self.intervals = dict(options), _listed(options.get("symbols", "")), _listed(options.get("interval", "1m"))
        self.client, self.start, self.pause = options["client"], int(options["start_ms"]), float(options.get("pause_ms", SYMBOL_PAUSE)) / 1000
        self.width = max(SECONDS.get(i, 86_400) for i in self.intervals) * 1000
        self.settle, self.most, self.skip = int(options.get("settle_ms", self.width)), int(options.get("now_ms", -1)), options.get("failures", "fail") == "skip"
        self.last = self.start

    def initialOffset(self) -> dict:  # noqa: N802
        return {"ms": self.start}

    def latestOffset(self) -> dict:  # noqa: N802
        now = int(time.time() * 1000)
        now = (min(now, self.most) if self.most >= 0 else now) - self.settle
        self.last = max(self.last, now - now % self.width)  # a clock that is set back takes nothing back
        return {"ms": self.last}

    def partitions(self, start: dict, end: dict) -> list[_Lane]:
        self.last = max(self.last, end["ms"])
        return _lanes(_calls(self.symbols, self.intervals, start["ms"], end["ms"]), self.options)

    def read(self, partition) -> Iterator[tuple]:
        ask, turns = _client(self.client), Turns(partition.lane, partition.lanes, self.pause)
        for calls in partition.calls:
            for symbol, interval, begin, end in calls:
                turns.take(self.pause)
                try:
                    rows = ask(_spelled(symbol), interval, begin, end)
                except Exception:
                    if self.skip:
                        continue
                    raise
                for k, r in enumerate(rows or []):
                    row = _row(symbol, interval, r, begin + k)
                    if row[-1] is not None and begin <= _millis(row[-1], up=False) < end:
                        yield row

    def commit(self, end: dict) -> None:
        self.last = max(self.last, end["ms"])


def register(spark: SparkSession) -> None:
    """Makes both sources known to a session and lets filters reach them where ``push`` is asked for."""
    spark.dataSource.register(QuoteSource)
    spark.dataSource.register(BarSource)
    spark.conf.set(PUSHDOWN, "true")


def vendor_bars(spark: SparkSession, symbols: list[str], client: str, start_ms: int, end_ms: int, interval: str = "1m", **options) -> DataFrame:
    """The vendor's bars; filters on symbol, interval and ts narrow what it is asked for.

    Spark keeps what was last pushed to a relation until something else is: the filter that is always here, and always
    true, is pushed by each query on the rows, so that none sees what another has left.
    """
    register(spark)
    rows = spark.read.format("vendor_bars").options(symbols=",".join(symbols), client=client, start_ms=start_ms, end_ms=end_ms, interval=interval, push="true", **options).load()
    return rows.filter("symbol IS NOT NULL")


def vendor_bar_stream(spark: SparkSession, symbols: list[str], client: str, start_ms: int, interval: str = "1m", **options) -> DataFrame:
    """The vendor's bars from ``start_ms`` on, as they settle."""
    register(spark)
    return spark.readStream.format("vendor_bars").options(symbols=",".join(symbols), client=client, start_ms=start_ms, interval=interval, **options).load()
