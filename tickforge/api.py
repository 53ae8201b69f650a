"""What a client calls: history, info, batch summaries, snapshots and the script, over one set of tables."""

from __future__ import annotations

import json
import logging
import threading
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.functions import expr as x
from tickforge.operators import bars, ledger, script, snapshots
from tickforge.operators import history as h
from tickforge.operators import summary as s
from tickforge.sources import lists


_LOG = logging.getLogger(__name__)


class NotFound(LookupError):
    """There is no such row."""


def found(df: DataFrame, what: str = "row") -> DataFrame:
    if df.isEmpty():
        raise NotFound(f"no {what}")
    return df


class SingleFlight:
    """Runs one call at a time; a call that comes meanwhile is skipped and told so."""

    def __init__(self):
        self._lock = threading.Lock()

    def run(self, call: Callable[[], None]) -> bool:
        if not self._lock.acquire(blocking=False):
            return False
        try:
            call()
        finally:
            self._lock.release()
        return True


class Engine:
    """``ticks`` (symbol, ts, seq, cents, volume), ``quotes`` (a row a symbol), ``store`` (the snapshots' folder), ``universes`` (texts of ticker files by type)."""

    def __init__(self, ticks: DataFrame, quotes: DataFrame, store: str | None = None, universes: dict[str, str] | None = None, scale: int | None = 2):
        self.ticks, self.quotes, self.store, self.universes, self.scale = ticks, quotes, store, universes or {}, scale
        self.spark, self._guard = ticks.sparkSession, SingleFlight()

    def _as_of(self, as_of: datetime | Column | None) -> Column:
        return F.current_timestamp() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")

    def health(self) -> dict[str, str]:
        return {"status": "ok"}

    def history(self, symbol: str, period: str = "max", interval: str = "1d", as_of=None) -> DataFrame:
        """Bars in order of time; none for an unknown symbol."""
        return h.history(self.ticks, [symbol], period, interval, self._as_of(as_of)).orderBy("ts")

    def history_json(self, symbol: str, period: str, interval: str, as_of=None) -> str:
        """The response document, with no bars for an unknown symbol."""
        now = self._as_of(as_of)
        row = h.envelope(self.history(symbol, period, interval, as_of), now).first()
        at = self.spark.range(1).select(x.iso_utc(now)).first()[0]
        return row["body"] if row else json.dumps({"symbol": symbol.upper(), "period": period, "interval": interval, "rowCount": 0, "data": [], "fetchedAt": at})

    def info(self, symbol: str) -> DataFrame:
        return s.stock_info(self.quotes, symbol)

    def batch_summary(self, symbols: list[str], as_of=None) -> DataFrame:
        """pos, the summary's columns, tradeDate and fetchedAt."""
        if not symbols or any(not isinstance(v, str) or not v.strip() for v in symbols):
            raise ValueError("symbols must be a non-empty array of non-blank strings")
        now = self._as_of(as_of)
        asked = self.spark.createDataFrame(list(enumerate(symbols)), "pos int, symbol string")
        out = s.batch_summary(asked, self.quotes, bars.recent_bars(self.ticks, now), now, self.scale)
        return out.withColumns({"tradeDate": x.et_date(x.eastern(now)), "fetchedAt": x.iso_utc(now)})

    def universe(self, kind: str) -> DataFrame:
        """pos, symbol of a snapshot type; all-combined is the stocks and then the funds, duplicates kept."""
        snapshots.check_type(kind)
        names = ["all-stocks", "all-etfs"] if kind == "all-combined" else [kind]
        rows = lists.combined(*(lists.universe(lists.texts(self.spark, self.universes[n])) for n in names))
        return rows.select((F.col("part").cast("long") * (1 << 40) + F.col("pos")).alias("pos"), "symbol")

    @property
    def kept(self) -> ledger.SnapshotStore:
        if not self.store:
            raise ValueError("a store is needed")
        return ledger.SnapshotStore(self.spark, self.store)

    def capture(self, kind: str, as_of=None, batch: str | None = None) -> bool:
        """Append a snapshot of a universe; False if another capture is running. A ``batch`` that is there already adds nothing."""
        now = self._as_of(as_of)

        def run():
            items = s.batch_summary(self.universe(kind), self.quotes, bars.recent_bars(self.ticks, now), now, self.scale)
            self.kept.append(items, kind, now, batch)

        return self._guard.run(run)

    def trigger(self, kind: str, as_of=None) -> threading.Thread:
        """Start a capture and return at once; a capture that is running goes on and this one is skipped."""
        snapshots.check_type(kind)
        thread = threading.Thread(target=self.capture, args=(kind, as_of), daemon=True)
        thread.start()
        return thread

    def start_timer(self, first: float = 5.0, every: float = 1800.0) -> Callable[[], None]:
        """Capture all ``first`` seconds from now and then ``every`` so many, in a thread; gives a function that ends it. Needs a store."""
        if not self.store:
            raise ValueError("a store is needed")
        ended = threading.Event()

        def run():
            wait = first
            while not ended.wait(wait):
                wait = every
                try:
                    self.capture_all()
                except Exception:
                    _LOG.exception("a timed capture failed")

        threading.Thread(target=run, daemon=True).start()
        return ended.set

    def batch_json(self, symbols: list[str], as_of=None) -> str:
        """The response document of a batch."""
        now = self._as_of(as_of)
        return s.batch_envelope(self.batch_summary(symbols, now), x.et_date(x.eastern(now)), x.iso_utc(now)).first()["body"]

    def capture_all(self, as_of=None) -> list[bool]:
        """What the timer does: stocks, then funds, one after the other."""
        return [self.capture(kind, as_of) for kind in ("all-stocks", "all-etfs")]

    def latest_snapshot(self, kind: str) -> DataFrame:
        entry = found(self.kept.newest(kind), "snapshot")
        return ledger.row(entry, self.kept.latest(kind))

    def get_snapshot(self, snapshot_id: int | str) -> DataFrame:
        number = snapshots.parse_id(str(snapshot_id))
        return ledger.row(found(self.kept.entry(number), "snapshot"), self.kept.by_id(number))

    def get_snapshot_json(self, snapshot_id: int | str) -> str:
        """The response document of a snapshot, with fields of its items that the summary doesn't know."""
        number = snapshots.parse_id(str(snapshot_id))
        return ledger.document(found(self.kept.entry(number), "snapshot"), self.kept.by_id(number)).first()["body"]

    def list_snapshots(self, kind: str | None = None, limit: int = snapshots.LIST_LIMIT) -> DataFrame:
        return self.kept.listing(kind, limit)

    def ticker_summary_v2(self, date: str, tickers: str | None = None, file_text: str | None = None) -> DataFrame:
        """The script's 39 columns of the tickers on an Eastern date. The date's bars are found by a range of raw instants."""
        ticks = bars.between(self.ticks, *bars.day_range(date))
        et = x.eastern("ts")
        minute = bars.with_session(bars.from_ticks(ticks)).filter(F.col("et_date") == date).withColumn("session", x.session_v2("et"))
        at = F.struct("ts", "seq")
        daily = ticks.groupBy(F.col("symbol").alias("ticker"), F.to_date(et).alias("date")).agg(F.max("ts").alias("ts"), F.min_by("cents", at).alias("o"), F.max("cents").alias("h"), F.min("cents").alias("l"), F.max_by("cents", at).alias("c"), F.sum("volume").alias("volume"))
        daily = daily.select("ticker", "date", "ts", *((F.col(k) / 100.0).alias(n) for k, n in (("o", "open"), ("h", "high"), ("l", "low"), ("c", "close"), ("c", "adj_close"))), "volume")
        asked = lists.ticker_arguments(tickers, file_text, self.spark)
        return script.summary_v2(asked, script.profile_v2(self.quotes), script.daily_v2(daily, date), script.intraday_v2(minute, self.scale), script.fallback_v2(self.quotes))
