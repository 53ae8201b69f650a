"""Declared columns of the tables that the engine reads and returns."""

from __future__ import annotations

BAR = "symbol string, interval string, ts timestamp, seq long, open double, high double, low double, close double, volume long"
QUOTE = (
    "symbol string, shortName string, longName string, exchange string, currency string, regularMarketOpen double, regularMarketDayHigh double, "
    "regularMarketDayLow double, regularMarketPrice double, regularMarketPreviousClose double, previousClose double, "
    "regularMarketChangePercent double, fiftyTwoWeekHigh double, fiftyTwoWeekLow double, regularMarketVolume long, marketCap long"
)
SUMMARY = (
    "symbol string, shortName string, exchange string, currency string, prevClose double, dayOpen double, dayHigh double, dayLow double, "
    "dayClose double, dayVolume long, intradayReturnPct double, vsPreClosePct double, latestPrice double, latestSession string, "
    "latestChgPct double, latestBarTimeEt string, vwapDate string, regularBarCount long, intradayBarCount long, intradayVwapLast double, "
    "pctRegularMinutesAboveVwap double, fetchError string"
)
SNAPSHOT = f"id long, type string, trade_date string, fetched_at timestamp, symbol_count int, results array<struct<{SUMMARY.replace(' ', ': ').replace(',: ', ', ')}>>"


def names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


SUMMARY_COLUMNS = names(SUMMARY)
#: Columns of the summary's CSV, in order.
CSV_COLUMNS = [
    "symbol", "shortName", "prevClose", "dayOpen", "dayHigh", "dayLow", "dayClose", "dayVolume", "intradayReturnPct", "vsPreClosePct",
    "latestPrice", "latestSession", "latestChgPct", "vwapDate", "intradayVwapLast", "pctRegularMinutesAboveVwap", "latestBarTimeEt",
]
