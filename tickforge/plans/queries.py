"""The registered market-bar queries: each takes a session and a folder of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions import expr as x
from tickforge.operators import bars as b
from tickforge.operators import history as h
from tickforge.operators import daily, ledger, present, script, snapshots, summary, vwap
from tickforge.sources import lines, lists, tables
from tickforge.sources.tables import table
from tickforge.streaming import live, sessions

#: How late a tick of a stream may come.
LATE = "10 minutes"
SCALE = 2  # prices of the event table have two decimals
#: What a user asks for: repeated, lower-case, padded and unknown symbols.
ASKED = ("VIEW", " click ", "NOPE", "VIEW", "error", "SIGNUP", "PURCHASE", "BRK.B")
CATEGORY_TEXT = """GROUPS = {
 "Funnel": ["SIGNUP", 'view', CLICK, lower],
 "Money": ["PURCHASE", "VIEW", "BRK.B"],
 "Empty": [],
 "Faults": ['error'],
 "Funnel": ["VIEW", "CLICK", "SIGNUP", "TWELVELETTRS"],
}"""
ARGUMENTS = " amd, nvda,,AMD"


def _stamp(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: x.iso_utc(n) for n in names})


def _minute(spark: SparkSession, sf_dir: str, sparse: bool = False) -> DataFrame:
    return b.from_ticks(tables.ticks(spark, sf_dir, sparse), "1m")


def _bars(interval: str, finer: bool = False):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = b.resample(_minute(spark, sf_dir), interval) if finer else b.from_ticks(tables.ticks(spark, sf_dir), interval)
        return _stamp(out, "ts").drop("seq")

    return query


def _classify(compat: bool):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = b.with_session(_minute(spark, sf_dir), compat)
        return s.select("symbol", x.iso_utc("ts").alias("ts"), "et_date", "minute", "session", x.et_display("et").alias("et_text"), x.session_v2("et").alias("session_v2"), x.et_with_zone("ts").alias("et_zone"))

    return query


def session_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.with_session(_minute(spark, sf_dir)).groupBy("symbol", "et_date", "session").agg(F.count("*").alias("n_bars"), F.sum("volume").alias("volume"))


def vwap_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = vwap.running(b.with_session(_minute(spark, sf_dir)).filter("session = 'regular'"), SCALE)
    return r.select("symbol", "et_date", x.iso_utc("ts").alias("ts"), "valid", "cum_volume", "vwap")


def vwap_running_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream: bars that the watermark has passed, each with its session's VWAP so far."""
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")  # a file or a folder
    stream = sessions.running_vwap(live.minute_bars(tables.as_ticks(events), LATE, event_time=True), SCALE)
    out = sessions.run_to_table(stream, tables.shared_folder(spark, "vwap-stream"))
    return out.select("symbol", "et_date", x.iso_utc("ts").alias("ts"), "valid", "cum_volume", "vwap")


def vwap_session_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vwap.session_summary(b.with_session(_minute(spark, sf_dir)), SCALE)


def latest_bar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vwap.latest_bar(b.with_session(_minute(spark, sf_dir)))


def _universe(spark: SparkSession, symbols) -> DataFrame:
    return spark.createDataFrame(list(enumerate(symbols)), "pos int, symbol string")


def _recent(spark: SparkSession, sf_dir: str, as_of, sparse: bool = False) -> DataFrame:
    """Minute bars of the intraday scan; its range is pushed to the events."""
    lo, hi = b.tick_range(b.recent_since(as_of), as_of)
    return b.recent(b.from_ticks(tables.ticks(spark, sf_dir, sparse, lo, hi)), as_of)


def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables.ticks(spark, sf_dir)
    as_of = tables.last_tick(t)
    return summary.batch_summary(_universe(spark, ASKED), tables.quotes(t), _recent(spark, sf_dir, as_of), as_of, SCALE)


def _sparse_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All users as symbols; quotes of every third are missing, and most have few bars in the range."""
    t = tables.ticks(spark, sf_dir, sparse=True)
    users = t.groupBy("symbol").agg(F.min("seq").alias("pos"))
    quotes = tables.quotes(t).filter(F.substring("symbol", 2, 20).cast("long") % 3 != 0)
    as_of = tables.last_tick(t)
    return summary.batch_summary(users, quotes, _recent(spark, sf_dir, as_of, sparse=True), as_of, SCALE)


def quotes_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes of all users from a table of days that was brought forward now and then, and the ticks since."""
    t = tables.ticks(spark, sf_dir, sparse=True)
    kept = daily.DailyTable(spark, tables.shared_folder(spark, "days"))
    for day in ("2024-01-09", "2024-01-09", "2024-01-22"):
        kept.advance(t, day)
    as_of = tables.last_tick(t)
    q = kept.quotes(t, as_of + F.expr("INTERVAL 1 MICROSECOND"))
    return q.select("symbol", "regularMarketOpen", "regularMarketDayHigh", "regularMarketDayLow", "regularMarketPrice", "previousClose", "fiftyTwoWeekHigh", "fiftyTwoWeekLow", "regularMarketVolume")


def returns_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    a, z = F.col("o_totalprice"), F.when(F.col("o_orderkey") % 7 == 0, 0.0).otherwise(F.col("c_acctbal"))
    return o.select("o_orderkey", x.return_pct(a, z).alias("return_pct"), x.latest_change_pct(z, a).alias("latest_chg_pct"), x.round_up(z / 3, 4).alias("third"))


def _order_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bars that a vendor sent in overlapping chunks: many share a symbol and an instant."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").cast("timestamp").alias("ts"), F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("close"))


def history_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamp(b.dedupe(_order_bars(spark, sf_dir)), "ts")


def _since(spark: SparkSession, sf_dir: str, period: str, interval: str, as_of) -> DataFrame:
    """Ticks of a history's range, which is pushed to the events."""
    return tables.ticks(spark, sf_dir, since=b.bucket_start(h.since(period, interval, as_of), interval), until=as_of)


def _history(period: str, interval: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        as_of = tables.last_tick(tables.ticks(spark, sf_dir))
        return _stamp(h.history(_since(spark, sf_dir, period, interval, as_of), ["VIEW", "ERROR", "NOPE"], period, interval, as_of), "ts")

    return query


def _preset(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = tables.ticks(spark, sf_dir)
        return _stamp(h.preset(t, ["CLICK"], name, tables.last_tick(t)), "ts")

    return query


def history_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_nationkey") * 1000).cast("long").alias("s"), (F.col("n_nationkey") * 1000 + F.col("n_regionkey") * 777).cast("long").alias("e"))
    return n.select("n_nationkey", F.posexplode(b.chunks("s", "e", F.lit(500).cast("long"))).alias("k", "c")).select("n_nationkey", "k", "c.from_ms", "c.to_ms")


def history_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables.ticks(spark, sf_dir)
    as_of = tables.last_tick(t)
    return h.csv_blocks(h.history(t, ["VIEW", "ERROR"], "1d", "15m", as_of), F.lit("2024-02-01 00:00:00").cast("timestamp"))


def history_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables.ticks(spark, sf_dir)
    e = h.envelope(h.history(t, ["VIEW", "ERROR"], "1d", "15m", tables.last_tick(t)), F.lit("2024-02-01 00:00:00").cast("timestamp"))
    f = lambda p: F.get_json_object("body", p)
    return e.select("symbol", f("$.rowCount").cast("long").alias("row_count"), f("$.data[0].date").alias("first_date"), f("$.data[0].close").cast("double").alias("first_close"), f("$.fetchedAt").alias("fetched_at"))


def history_csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.csv_text(history_csv(spark, sf_dir))


def history_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = tables.last_tick(tables.ticks(spark, sf_dir))
    return _stamp(h.preview(h.history(_since(spark, sf_dir, "1d", "15m", as_of), ["VIEW", "ERROR"], "1d", "15m", as_of)), "ts")


def history_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What users ask for, and how many days of history they get."""
    pick = lambda names, by: F.element_at(F.array(*map(F.lit, names)), (by % len(names) + 1).cast("int"))
    e = table(spark, sf_dir, "events").select("event_id", pick((*h.PERIODS, "5d"), F.col("event_id")).alias("period"), pick((*h.INTERVALS, "2m"), F.col("user_id")).alias("interval"))
    days = h.lookback(F.col("period"), F.col("interval"))
    return e.select("event_id", "period", "interval", days.isNotNull().alias("taken"), days.alias("days"))


def vendor_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a vendor's rows: texts, some without a price, a volume or a date."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    rows = o.select(
        F.col("o_orderpriority").alias("symbol"), F.when(k % 11 == 0, "undefined").otherwise(F.col("o_orderdate").cast("string")).alias("date"), k.alias("seq"), F.when(k % 5 != 0, F.col("o_totalprice").cast("string")).alias("open"),
        F.col("o_totalprice").alias("high"), F.when(k % 3 == 0, "n/a").otherwise(F.lit("1.5")).alias("low"), F.col("o_totalprice").alias("close"), F.when(k % 4 != 0, k.cast("string")).alias("volume"),
    )
    return _stamp(b.dedupe(b.from_vendor(rows, "1d")), "ts")


def stock_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.stock_info(tables.quotes(tables.ticks(spark, sf_dir)), "VIEW")


def quote_prev_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.quote_columns(tables.quotes(tables.ticks(spark, sf_dir, sparse=True))).withColumnRenamed("_vendor", "symbol").drop("_found")


def _text_file(rows: DataFrame, name: str) -> str:
    """A text of the rows (key, line) in the order of their keys, in as many files as there are tasks."""
    folder = tables.shared_folder(rows.sparkSession, name)
    rows.repartitionByRange("key").sortWithinPartitions("key").select("line").write.text(folder)
    return folder


def _universe_line(key: str, more: str) -> Column:
    """Lines of a ticker file: names of any case, with quotes, dashes and dots, a header among them."""
    k, n = F.col(key), F.col(key).cast("string")
    name = F.when(k % 5 == 0, F.concat(F.lit('"Q'), n, F.lit('"'))).when(k % 5 == 1, F.concat(F.lit(" c"), n)).when(k % 5 == 2, F.concat(F.lit("B."), n)).when(k % 5 == 3, F.concat(F.lit("X-"), n)).otherwise(F.concat(F.lit("T"), (k % 50).cast("string"), F.lit(" ")))
    return F.when(k % 40 == 7, F.lit("Ticker,Name")).otherwise(F.concat(name, F.lit(","), F.col(more))).alias("line")


def _universes(spark: SparkSession, sf_dir: str):
    """The customers' ticker file and the suppliers'."""
    for name, key, more in (("customer", "c_custkey", "c_mktsegment"), ("supplier", "s_suppkey", "s_name")):
        yield lines.universe(lines.numbered(spark, _text_file(table(spark, sf_dir, name).select(F.col(key).alias("key"), _universe_line(key, more)), name)))


def universe_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next(_universes(spark, sf_dir))


def universe_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.combined(*_universes(spark, sf_dir))


def ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.ordered_distinct(tables.ticks(spark, sf_dir, sparse=True), "symbol", "seq")


def ticker_args_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A comma list, and a file of what parts are called, some lines of which are comments or blank."""
    k = F.col("p_partkey")
    line = F.when(k % 4 == 0, F.concat(F.lit(" # "), "p_name")).when(k % 4 == 1, F.concat("p_brand", F.lit(" ,, "), "p_type")).when(k % 4 == 2, F.concat(F.lit("\t"), "p_name")).otherwise(F.lit(" "))
    path = _text_file(table(spark, sf_dir, "part").select(k.alias("key"), line.alias("line")), "tickers")
    return lines.tickers(lines.numbered(spark, path), ARGUMENTS).select("symbol", F.col("at.part").alias("part"), F.col("at.line_no").alias("line_no"), F.col("at.k").alias("k"))


def category_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as categories of their nations, a text for each; names longer than ten fall apart into runs."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    name = F.concat(F.lit('"'), F.replace("n_name", F.lit("_"), F.lit("-")), F.lit('"'))
    rows = n.groupBy("r_regionkey", "r_name").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", name.alias("t")))), lambda e: e.t), ", ").alias("inner"))  # a region's nations
    return lists.categories(rows.select(F.col("r_regionkey").alias("id"), F.concat(F.lit('"'), "r_name", F.lit('": ['), "inner", F.lit("]")).alias("text")))


def category_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text for each part: its brand as the category, so that names repeat; quoted, bare and lower-case symbols, and an empty list."""
    p = table(spark, sf_dir, "part")
    words = F.split("p_type", " ")
    inner = F.when(F.col("p_partkey") % 9 == 0, F.lit("")).otherwise(F.concat(F.lit("'"), F.lower(F.get(words, 0)), F.lit("', "), F.upper("p_name"), F.lit(', x, "'), F.col("p_size").cast("string"), F.lit('.A"')))
    return lists.categories(p.select(F.col("p_partkey").alias("id"), F.concat(F.lit("{ '"), "p_brand", F.lit(" ' : ["), inner, F.lit("], }")).alias("text")))


def _groups(spark: SparkSession) -> DataFrame:
    return lists.categories(lists.texts(spark, CATEGORY_TEXT))


def category_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = present.join_categories(_groups(spark), batch_summary(spark, sf_dir))
    return joined.select("cat_pos", "category", "sym_pos", "symbol", "dayClose", "pctRegularMinutesAboveVwap")


def category_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.category_stats(present.join_categories(_groups(spark), batch_summary(spark, sf_dir)))


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_literal(spark, sf_dir).agg(F.countDistinct("symbol").alias("n_symbols"), F.countDistinct("category").alias("n_categories"))


def _sorted(descending: bool):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present.sort_items(_sparse_summary(spark, sf_dir), "vsPreClosePct", descending).select("pos", "symbol", "vsPreClosePct")

    return query


def top_movers_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = tables.ticks(spark, sf_dir, sparse=True).select("symbol").distinct()
    return present.top(_sparse_summary(spark, sf_dir), "vsPreClosePct", 5, among=users).select("symbol", "vsPreClosePct", "n_more")


def format_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.format_items(_sparse_summary(spark, sf_dir)).drop("change_bucket", "vwap_bucket", "session_badge")


def bucket_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.format_items(_sparse_summary(spark, sf_dir)).select("pos", "symbol", "change_bucket", "vwap_bucket", "session_badge")


def candle_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.candles(b.from_ticks(tables.ticks(spark, sf_dir), "15m"))


def csv_export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _sparse_summary(spark, sf_dir).withColumn("shortName", F.when(F.col("pos") % 2 == 0, F.concat("shortName", F.lit(", Inc."))).otherwise(F.col("shortName")))
    return present.csv_rows(items)


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot for each day of ticks, types in turn, with a few columns of each symbol."""
    t = tables.ticks(spark, sf_dir)
    days = t.groupBy(F.to_date("ts").alias("day"), "symbol").agg(F.max_by("cents", F.struct("ts", "seq")).alias("c"), F.sum("volume").alias("v"))
    item = F.struct("symbol", (F.col("c") / 100.0).alias("dayClose"), F.col("v").alias("dayVolume"))
    out = days.groupBy("day").agg(F.count("*").cast("int").alias("symbol_count"), F.sort_array(F.collect_list(item)).alias("results"))
    k = F.dayofmonth("day")
    return out.select(k.cast("long").alias("id"), F.element_at(F.array(*map(F.lit, snapshots.TYPES)), k % 3 + 1).alias("type"), F.date_format("day", "yyyy-MM-dd").alias("trade_date"), F.col("day").cast("timestamp").alias("fetched_at"), "symbol_count", "results")


def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamp(snapshots.items(snapshots.latest(_snapshots(spark, sf_dir), "all-etfs")).withColumn("fetched_at", F.lit(None).cast("timestamp")), "fetched_at").drop("fetched_at")


def snapshot_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamp(snapshots.listing(_snapshots(spark, sf_dir)), "fetched_at")


def snapshot_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A captured batch, item by item."""
    built = snapshots.build(batch_summary(spark, sf_dir), "all-combined", 7, F.lit("2024-02-01 02:00:00").cast("timestamp"))
    counted = built.select("id", "type", "trade_date", "symbol_count")
    return counted.join(snapshots.items(built), "id").select("id", "type", "trade_date", "symbol_count", "pos", "symbol", "dayClose", "fetchError")


def _appended(spark: SparkSession, sf_dir: str) -> ledger.SnapshotStore:
    """A store with a snapshot of all users, appended twice by a caller that asks again, and one of the symbols asked for."""
    store = ledger.SnapshotStore(spark, tables.shared_folder(spark, "snapshots"))
    at = F.lit("2024-02-01 02:00:00").cast("timestamp")
    users = _sparse_summary(spark, sf_dir)
    for _ in range(2):
        store.append(users, "all-stocks", at, "first")
    store.append(batch_summary(spark, sf_dir), "all-etfs", at, "first")
    return store


def snapshot_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _appended(spark, sf_dir)
    counted = store.listing().select("id", "trade_date", "symbol_count")
    return ledger.summaries(store.items(), ("id", "type", "pos")).join(counted, "id").select("id", "type", "trade_date", "symbol_count", "pos", "symbol", "dayClose", "dayVolume", "latestSession", "regularBarCount", "fetchError")


def snapshot_items_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot of several, its items by the paths that are asked for."""
    i = _appended(spark, sf_dir).latest("all-stocks")
    value = lambda n, t: F.variant_get("item", f"$.{n}", t).alias(n)
    return i.select("id", "pos", value("symbol", "string"), value("latestPrice", "double"), value("vwapDate", "string"), F.schema_of_variant("item").contains("dayClose").alias("has_close"))


def snapshot_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = snapshots.envelope(_snapshots(spark, sf_dir))
    f = lambda p: F.get_json_object("body", p)
    return e.select("id", f("$.type").alias("type"), f("$.tradeDate").alias("trade_date"), f("$.fetchedAt").alias("fetched_at"), f("$.symbolCount").cast("int").alias("symbol_count"), f("$.results[0].symbol").alias("first_symbol"), f("$.results[0].dayVolume").cast("long").alias("first_volume"))


def snapshot_list_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = snapshots.list_envelope(snapshots.listing(_snapshots(spark, sf_dir)))
    rows = e.select(F.posexplode(F.from_json("body", "snapshots array<struct<id: long, type: string, tradeDate: string, fetchedAt: string, symbolCount: int>>").getField("snapshots")).alias("k", "s"))
    return rows.select("k", "s.id", "s.type", "s.tradeDate", "s.fetchedAt", "s.symbolCount")


def batch_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = summary.batch_envelope(batch_summary(spark, sf_dir), F.lit("2024-01-31"), F.lit("2024-02-01T00:00:00.000Z"))
    parsed = e.select(F.from_json("body", "results array<struct<symbol: string, dayClose: double, fetchError: string>>, tradeDate string, fetchedAt string").alias("b"))
    return parsed.select("b.tradeDate", "b.fetchedAt", F.posexplode("b.results").alias("pos", "r")).select("tradeDate", "fetchedAt", "pos", "r.symbol", "r.dayClose", "r.fetchError")


def snapshot_list_of_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamp(snapshots.listing_of_type(_snapshots(spark, sf_dir), "all-stocks", limit=10), "fetched_at")


def snapshot_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamp(snapshots.by_id(_snapshots(spark, sf_dir), snapshots.parse_id("12abc")), "fetched_at").drop("results")


def snapshot_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.items(_snapshots(spark, sf_dir))


def _daily(t: DataFrame) -> DataFrame:
    at, et = F.struct("ts", "seq"), x.eastern("ts")
    d = t.groupBy("symbol", F.to_date(et).alias("date")).agg(F.max("ts").alias("ts"), F.min_by("cents", at).alias("o"), F.max("cents").alias("h"), F.min("cents").alias("l"), F.max_by("cents", at).alias("c"), F.sum("volume").alias("volume"))
    return d.select(F.col("symbol").alias("ticker"), "date", "ts", *((F.col(k) / 100.0).alias(n) for k, n in (("o", "open"), ("h", "high"), ("l", "low"), ("c", "close"), ("c", "adj_close"))), "volume")


def _script_bars(spark: SparkSession, sf_dir: str, date: str) -> DataFrame:
    s = b.with_session(b.from_ticks(tables.ticks(spark, sf_dir, False, *b.day_range(date)))).filter(F.col("et_date") == date)
    return s.withColumn("session", x.session_v2("et"))


def daily_ohlcv_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return script.daily_v2(_daily(tables.ticks(spark, sf_dir, True, *b.day_range("2024-01-18"))), "2024-01-18")


def vwap_running_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = script.running_v2(_script_bars(spark, sf_dir, "2024-01-18"), SCALE)
    return r.select("symbol", x.iso_utc("ts").alias("ts"), "cum_vwap", "above_vwap")


def after_hours_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return script.intraday_v2(_script_bars(spark, sf_dir, "2024-01-18"), SCALE)


def summary_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables.ticks(spark, sf_dir)
    q = tables.quotes(t)
    q2 = q.withColumn("postMarketPrice", F.col("regularMarketDayLow"))
    return script.summary_v2(lists.ordered_distinct(_universe(spark, ("VIEW", "CLICK", "NOPE", "ERROR"))), script.profile_v2(q), script.daily_v2(_daily(tables.ticks(spark, sf_dir, False, *b.day_range("2024-01-18"))), "2024-01-18"), script.intraday_v2(_script_bars(spark, sf_dir, "2024-01-18"), SCALE), script.fallback_v2(q2))


def preview_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return script.preview(summary_v2(spark, sf_dir).drop("after_hours_price"))


def script_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = summary_v2(spark, sf_dir).select("ticker", "company_name", "exchange", "market_cap", "day_open", "day_close", "day_volume", "website", "is_after_hours_latest")
    return script.csv_lines(rows).select("ticker", "line")


def flatten_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars under a header of two levels."""
    d = daily_ohlcv_v2(spark, sf_dir)
    return script.flatten_columns(d.select("ticker", F.col("day_open").alias("Open.X"), F.col("day_close").alias("Close.X")))


def query_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", x.query_parameter("name", "p_name").alias("name"), x.query_parameter("brand", F.when(F.col("p_size") % 2 == 0, F.col("p_brand"))).alias("brand"))


def parsed_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey") % 5
    body = (
        F.when(k == 0, F.concat(F.lit('\ufeff {"a": '), F.col("o_custkey").cast("string"), F.lit(' , "b":[1, null]} '))).when(k == 1, F.lit(" \n"))
        .when(k == 2, F.concat(F.lit("{"), "o_orderstatus")).when(k == 3, F.col("o_orderpriority"))
    )
    return o.select("o_orderkey", x.body_kind(body).alias("kind"), x.parsed_body(body).alias("parsed"))


def symbol_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    raw = F.concat(F.lit(" \t"), F.replace("p_name", F.lit(" "), F.lit(".")), F.lit("\n"))
    return p.select("p_partkey", x.vendor_symbol(raw).alias("vendor_symbol"), F.upper(x.trimmed(raw)).alias("symbol"))


def safe_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    text = F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).when(F.col("p_partkey") % 3 == 1, F.col("p_size").cast("string")).otherwise(F.lit("NaN"))
    return p.select("p_partkey", x.safe_double(text).alias("as_double"), x.safe_long(text).alias("as_long"))


def text_summary_500(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    long_name = F.when(F.col("doc_id") % 2 == 0, F.col("source")).otherwise(F.lit(""))
    return d.select("doc_id", x.first_filled(long_name, "lang").alias("company_name"), x.short_text("text").alias("business_summary"))


def iso_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("t", F.col("ts").cast("timestamp"))
    return e.select("event_id", x.iso_utc("t").alias("iso"), F.unix_seconds("t").alias("epoch"), x.et_date(x.eastern("t")).alias("trade_date"))


def request_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request for each order, some with blank symbols, without any, or no JSON."""
    k = F.col("o_orderkey") % 8
    asked = F.concat(F.lit('{"symbols": ["'), "o_orderpriority", F.lit('", "'), "o_orderstatus", F.lit('", "A"], "date": null}'))
    body = F.when(k == 0, F.lit('{"symbols": []}')).when(k == 1, F.lit('{"symbols": ["A", " "]}')).when(k == 2, F.col("o_orderpriority")).when(k == 3, F.lit('{"symbols": ["A", null]}')).otherwise(asked)
    return lists.requests(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), body.alias("text")))


def error_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 6
    status = F.lit('","detail":"').alias("_")
    body = (
        F.when(k == 0, F.concat(F.lit('{"title":"'), "o_orderpriority", status, "o_orderstatus", F.lit('"}'))).when(k == 1, F.concat(F.lit('{"title":"a","message":" '), "o_orderstatus", F.lit('"}')))
        .when(k == 2, F.lit('{"title":"only"}')).when(k == 3, F.lit("  plain text ")).when(k == 4, F.repeat(F.lit("x"), 400)).otherwise(F.lit('{"code":5}'))
    )
    return o.select("o_orderkey", x.error_text(F.lit(500), F.lit("Server Error"), body).alias("message"))


QUERIES = {
    "bars_1m": _bars("1m"), "bars_5m": _bars("5m", finer=True), "bars_15m": _bars("15m"), "bars_1h": _bars("1h", finer=True), "bars_1d": _bars("1d"),
    "session_classify": _classify(False), "session_classify_compat": _classify(True), "session_counts": session_counts,
    "vwap_running": vwap_running, "vwap_running_stream": vwap_running_stream, "vwap_session_summary": vwap_session_summary, "latest_bar": latest_bar,
    "batch_summary": batch_summary, "batch_summary_missing": _sparse_summary, "returns_pct": returns_pct, "quotes_kept": quotes_kept,
    "history_dedupe": history_dedupe, "history_period_1d": _history("1d", "5m"), "history_period_max": _history("max", "15m"), "history_chunks": history_chunks,
    "history_presets": _preset("all"), "history_csv": history_csv, "history_envelope": history_envelope,
    "history_preset_minute": _preset("minute"), "history_preset_intraday": _preset("intraday"), "history_csv_text": history_csv_text, "history_preview": history_preview,
    "history_parameters": history_parameters, "vendor_bars": vendor_bars, "batch_envelope": batch_envelope, "snapshot_build": snapshot_build,
    "snapshot_append": snapshot_append, "snapshot_items_latest": snapshot_items_latest,
    "snapshot_envelope": snapshot_envelope, "snapshot_list_envelope": snapshot_list_envelope, "preview_v2": preview_v2, "script_csv_rows": script_csv_rows,
    "flatten_v2": flatten_v2, "query_parameters": query_parameters, "parsed_bodies": parsed_bodies,
    "stock_info": stock_info, "quote_prev_close": quote_prev_close, "universe_load": universe_load, "universe_combined": universe_combined,
    "ordered_distinct": ordered_distinct, "ticker_args_parse": ticker_args_parse, "category_parse": category_parse, "category_literal": category_literal,
    "category_join": category_join, "category_stats": category_stats, "category_counts": category_counts,
    "sort_nulls_last_desc": _sorted(True), "sort_nulls_last_asc": _sorted(False), "top_movers_5": top_movers_5,
    "format_columns": format_columns, "bucket_columns": bucket_columns, "candle_series": candle_series, "csv_export_rows": csv_export_rows,
    "snapshot_latest": snapshot_latest, "snapshot_list": snapshot_list, "snapshot_list_of_type": snapshot_list_of_type, "snapshot_by_id": snapshot_by_id, "snapshot_explode": snapshot_explode,
    "daily_ohlcv_v2": daily_ohlcv_v2, "vwap_running_v2": vwap_running_v2, "after_hours_v2": after_hours_v2, "summary_v2": summary_v2,
    "symbol_normalize": symbol_normalize, "safe_numbers": safe_numbers, "text_summary_500": text_summary_500, "iso_epoch": iso_epoch,
    "request_parse": request_parse, "error_messages": error_messages,
}
