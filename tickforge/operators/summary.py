"""The 22-column summary of a list of symbols, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions import expr as x
from tickforge.operators import bars as b
from tickforge.operators import vwap
from tickforge.schemas import SUMMARY_COLUMNS

NO_QUOTE = "No quote data"


def quote_columns(q: DataFrame) -> DataFrame:
    c = F.col
    return q.select(
        c("symbol").alias("_vendor"), "shortName", "exchange", "currency", F.coalesce("regularMarketPreviousClose", "previousClose").alias("prevClose"),
        c("regularMarketOpen").alias("dayOpen"), c("regularMarketDayHigh").alias("dayHigh"), c("regularMarketDayLow").alias("dayLow"),
        c("regularMarketPrice").alias("dayClose"), c("regularMarketVolume").alias("dayVolume"), F.lit(True).alias("_found"),
    )


def batch_summary(universe: DataFrame, quotes: DataFrame, minute_bars: DataFrame, as_of, scale: int | None = None, compat_midnight: bool = False) -> DataFrame:
    """pos and the summary of each requested symbol (pos, symbol), duplicates kept.

    A symbol without a quote has its error and nothing else; one without bars has counts of zero and the quote's typical
    price for its VWAP. Bars are joined on the vendor's spelling, as quotes are.
    """
    recent = b.with_session(b.recent(minute_bars, as_of), compat_midnight)
    traded = vwap.overview(recent, scale).withColumnRenamed("symbol", "_vendor")
    asked = universe.select("pos", F.upper(x.trimmed("symbol")).alias("symbol"), x.vendor_symbol("symbol").alias("_vendor"))
    rows = asked.join(quote_columns(quotes), "_vendor", "left").join(traded, "_vendor", "left")
    day = F.when(F.col("dayHigh").isNotNull() & F.col("dayLow").isNotNull() & F.col("dayClose").isNotNull(), x.round_up(x.typical("dayHigh", "dayLow", "dayClose"), 4))
    values = {
        "intradayReturnPct": x.return_pct("dayClose", "dayOpen"), "vsPreClosePct": x.return_pct("dayClose", "prevClose"), "latestChgPct": x.latest_change_pct("latestPrice", "dayClose"),
        "regularBarCount": F.coalesce("regularBarCount", F.lit(0).cast("long")), "intradayBarCount": F.coalesce("intradayBarCount", F.lit(0).cast("long")),
        "intradayVwapLast": F.coalesce("intradayVwapLast", day), "fetchError": F.lit(None).cast("string"),
    }
    found = F.coalesce("_found", F.lit(False))
    out = []
    for name in SUMMARY_COLUMNS:
        value = values.get(name, F.col(name))
        out.append(F.col(name) if name == "symbol" else F.when(~found, NO_QUOTE).alias(name) if name == "fetchError" else F.when(found, value).alias(name))
    return rows.select("pos", *out)


def batch_envelope(items: DataFrame, trade_date, fetched_at) -> DataFrame:
    """The response document of a batch, one row: results in order, tradeDate, fetchedAt. The request bounds its size."""
    rows = F.transform(F.sort_array(F.collect_list(F.struct("pos", F.struct(*SUMMARY_COLUMNS).alias("i")))), lambda e: e.i)
    out = items.agg(rows.alias("results"))
    return out.select(F.to_json(F.struct("results", x.c(trade_date).alias("tradeDate"), x.c(fetched_at).alias("fetchedAt")), {"ignoreNullFields": "false"}).alias("body"))


def stock_info(quotes: DataFrame, symbol: str) -> DataFrame:
    """The ten columns of one symbol, looked up as it is spelled."""
    if not symbol or not symbol.strip():
        raise ValueError("symbol is missing")
    q = quotes.filter(F.col("symbol") == symbol)
    return q.select(F.upper("symbol").alias("symbol"), *(F.col(c) for c in ("shortName", "longName", "exchange", "currency", "marketCap", "regularMarketPrice", "regularMarketChangePercent", "fiftyTwoWeekHigh", "fiftyTwoWeekLow")))
