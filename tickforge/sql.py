"""The engine's calls as functions of SQL: table functions that Spark plans into the query, and one over any table of bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, udtf
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from tickforge.functions import expr as x
from tickforge.operators import bars as b
from tickforge.operators import history as h

#: What each period and bar stand for: days back, and seconds of a bar, 0 for an Eastern day.
_KINDS = ", ".join(f"('{p}', '{i}', {1 if p == '1d' else b.CHUNK_DAYS[i][1]}, {b.SECONDS.get(i, 0)})" for p in h.PERIODS for i in h.INTERVALS)


def _start(ts: str) -> str:
    """Where the bar of kind c begins that an instant is in."""
    day = f"to_utc_timestamp(date_trunc('DAY', from_utc_timestamp({ts}, '{x.ZONE}')), '{x.ZONE}')"
    return f"CASE WHEN c.seconds = 0 THEN {day} ELSE timestamp_seconds(unix_seconds({ts}) - pmod(unix_seconds({ts}), c.seconds)) END"


def _history(ticks: str) -> str:
    begin = "(history.as_of - make_interval(0, 0, 0, c.days))"
    return f"""
CREATE OR REPLACE TEMPORARY FUNCTION history(symbol STRING, period STRING, bar STRING, as_of TIMESTAMP)
RETURNS TABLE(symbol STRING, period STRING, interval STRING, ts TIMESTAMP, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume BIGINT)
RETURN SELECT upper(symbol), period, bar, start, min_by(cents, struct(ts, seq)) / 100D, max(cents) / 100D, min(cents) / 100D, max_by(cents, struct(ts, seq)) / 100D, sum(volume)
  FROM (SELECT t.symbol, c.period, c.bar, c.days, t.ts, t.seq, t.cents, t.volume, {_start('t.ts')} AS start FROM {ticks} AS t, VALUES {_KINDS} AS c(period, bar, days, seconds)
    WHERE c.period = history.period AND c.bar = history.bar AND t.symbol = history.symbol AND t.ts >= {_start(begin)} AND t.ts < history.as_of) AS c
  WHERE start >= {begin} GROUP BY symbol, period, bar, start"""


def _info(quotes: str) -> str:
    columns = ("shortName", "longName", "exchange", "currency", "marketCap", "regularMarketPrice", "regularMarketChangePercent", "fiftyTwoWeekHigh", "fiftyTwoWeekLow")
    kinds = ("STRING", "STRING", "STRING", "STRING", "BIGINT", "DOUBLE", "DOUBLE", "DOUBLE", "DOUBLE")
    return f"""
CREATE OR REPLACE TEMPORARY FUNCTION stock_info(symbol STRING) RETURNS TABLE(symbol STRING, {', '.join(f'{c} {k}' for c, k in zip(columns, kinds, strict=True))})
RETURN SELECT upper(q.symbol), {', '.join(f'q.{c}' for c in columns)} FROM {quotes} AS q WHERE q.symbol = stock_info.symbol"""


class SessionVwap:
    """Any table of bars with valid, cum_volume and vwap: of each symbol and date the volume and the VWAP so far, in order of time.

    ``SELECT * FROM session_vwap(TABLE(bars))``; it needs symbol, et_date, ts, high, low, close and volume, and orders by seq if there is one.
    Spark deals the rows by symbol and date and sorts them: a task holds a sum.
    """

    NEEDED = ("symbol", "et_date", "ts", "high", "low", "close", "volume")
    ADDED = (StructField("valid", BooleanType()), StructField("cum_volume", LongType()), StructField("vwap", DoubleType()))

    @staticmethod
    def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable:
            raise ValueError("session_vwap takes a table of bars")
        there = rows.dataType.fieldNames()
        missing = [c for c in SessionVwap.NEEDED if c not in there]
        clashing = [f.name for f in SessionVwap.ADDED if f.name in there]
        if missing or clashing:
            raise ValueError(f"session_vwap: no column {', '.join(missing)}" if missing else f"session_vwap: there is a column {', '.join(clashing)} already")
        order = [OrderingColumn(c) for c in ("ts", "seq") if c in there]
        return AnalyzeResult(StructType([*rows.dataType.fields, *SessionVwap.ADDED]), partitionBy=[PartitioningColumn("symbol"), PartitioningColumn("et_date")], orderBy=order)

    def __init__(self):
        self.traded, self.volume = 0.0, 0

    def eval(self, row):
        high, low, close, volume = (row[c] for c in ("high", "low", "close", "volume"))
        valid, vwap = None not in (high, low, close, volume) and volume != 0, None
        if valid:
            self.traded, self.volume = self.traded + (high + low + close) * volume, self.volume + volume
            vwap = self.traded / (3 * self.volume) if self.volume > 0 else None
        yield (*row, valid, self.volume, vwap)


def register(spark: SparkSession, ticks: DataFrame, quotes: DataFrame, prefix: str = "tickforge") -> None:
    """history(symbol, period, bar, as_of), stock_info(symbol) and session_vwap(TABLE(bars)) for the session's SQL.

    Arguments may be columns of a lateral join; periods and bars that there are none of have no rows. Ranges and symbols reach the scan of the ticks, as in the calls that they stand for.
    """
    ticks.createOrReplaceTempView(f"{prefix}_ticks")
    quotes.createOrReplaceTempView(f"{prefix}_quotes")
    spark.sql(_history(f"{prefix}_ticks"))
    spark.sql(_info(f"{prefix}_quotes"))
    spark.udtf.register("session_vwap", udtf(SessionVwap))
