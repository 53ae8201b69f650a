"""DuckDB SQL of the market-bar queries over the same tables."""

from __future__ import annotations

from tickforge.plans import queries as q
from tickforge.sources.lists import BAD_REQUEST


def _s(text: str) -> str:
    """A SQL string; control characters by their numbers."""
    out = text.replace("'", "''")
    for ch in "\n\r\t":
        out = out.replace(ch, f"' || chr({ord(ch)}) || '")
    return f"('{out}')"


def _values(items) -> str:
    return "(VALUES " + ", ".join(f"({k}, {_s(v)})" for k, v in enumerate(items)) + ")"


ET = "((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')"
ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"
BLANKS = "' ' || chr(9) || chr(13) || chr(10) || chr(12) || chr(11) || chr(160)"


def iso(c: str) -> str:
    return ISO.format(c)


def up(v: str, k: int) -> str:
    return f"floor(({v}) * {float(10**k)}::DOUBLE + 0.5::DOUBLE) / {float(10**k)}::DOUBLE"


def ret(a: str, b: str) -> str:
    return f"CASE WHEN {a} <> 0 AND {b} <> 0 THEN {up(f'({a} / {b} - 1) * 100', 2)} END"


TICKS = "ticks AS (SELECT upper(event_type) AS symbol, ts, event_id AS seq, floor(value * 100 + 0.5)::BIGINT AS cents, json_extract_string(props, '$.k')::BIGINT AS volume FROM events)"
USERS = TICKS.replace("upper(event_type)", "'U' || user_id")


def start(interval: str) -> str:
    if interval == "1d":
        return f"((date_trunc('day', {ET}) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC')"
    n = {"1m": 60, "5m": 300, "15m": 900, "1h": 3600}[interval]
    return f"make_timestamp((floor(epoch(ts) / {n}) * {n})::BIGINT * 1000000)"


def bars(interval: str, name: str = "bars", source: str = "ticks") -> str:
    return f"""{name} AS (SELECT symbol, '{interval}' AS "interval", s AS ts, min(seq) AS seq, arg_min(cents, (ts, seq)) / 100::DOUBLE AS open, max(cents) / 100::DOUBLE AS high, min(cents) / 100::DOUBLE AS low,
  arg_max(cents, (ts, seq)) / 100::DOUBLE AS close, sum(volume)::BIGINT AS volume FROM (SELECT *, {start(interval)} AS s FROM {source}) GROUP BY symbol, s)"""


SESS = f"""sess AS (SELECT *, strftime(et, '%Y-%m-%d') AS et_date, CASE WHEN minute < 570 THEN 'premarket' WHEN minute > 960 THEN 'afterhours' ELSE 'regular' END AS session
  FROM (SELECT *, (hour(et) * 60 + minute(et))::INT AS minute FROM (SELECT *, {ET} AS et FROM bars)))"""
VALID = "(volume IS NOT NULL AND volume <> 0)"


def running(source: str, name: str = "run") -> str:
    w = "(PARTITION BY symbol, et_date ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)"
    return f"""{name} AS (SELECT *, CASE WHEN valid AND cum_volume > 0 THEN num::DOUBLE / (cum_volume * 300)::DOUBLE END AS vwap FROM (SELECT *, {VALID} AS valid,
  (sum(CASE WHEN {VALID} THEN volume ELSE 0 END) OVER {w})::BIGINT AS cum_volume,
  (sum(CASE WHEN {VALID} THEN floor((high + low + close) * 100 + 0.5)::BIGINT * volume ELSE 0 END) OVER {w})::BIGINT AS num FROM {source}))"""


SESSIONS = f"""reg AS (SELECT * FROM sess WHERE session = 'regular' QUALIFY et_date = max(et_date) OVER (PARTITION BY symbol)),
{running('reg')},
sums AS (SELECT symbol, max(et_date) AS vwapDate, count(*) AS regularBarCount, {up('arg_max(vwap, (ts, seq)) FILTER (vwap IS NOT NULL)', 4)} AS intradayVwapLast,
  CASE WHEN count(vwap) > 0 THEN {up('100.0::DOUBLE * count(*) FILTER (close > vwap) / count(vwap)', 2)} END AS pctRegularMinutesAboveVwap FROM run GROUP BY symbol)"""
LATEST = """latest AS (SELECT symbol, count(*) AS intradayBarCount, arg_max_null(close, (ts, seq)) AS latestPrice, arg_max(session, (ts, seq)) AS latestSession,
  strftime(arg_max(et, (ts, seq)), '%m/%d/%Y, %H:%M:%S') || ' ET' AS latestBarTimeEt FROM sess GROUP BY symbol)"""
QUOTES = f"""days AS (SELECT symbol, strftime({ET}, '%Y-%m-%d') AS day, arg_min(cents, (ts, seq)) AS o, max(cents) AS h, min(cents) AS l, arg_max(cents, (ts, seq)) AS c, sum(volume)::BIGINT AS v FROM ticks GROUP BY ALL),
quotes AS (SELECT symbol, upper(symbol[1]) || lower(symbol[2:]) AS shortName, upper(symbol[1]) || lower(symbol[2:]) || ', Inc.' AS longName, 'NMS' AS exchange, 'USD' AS currency,
  o / 100::DOUBLE AS dayOpen, h / 100::DOUBLE AS dayHigh, l / 100::DOUBLE AS dayLow, c / 100::DOUBLE AS dayClose, v AS dayVolume, prev / 100::DOUBLE AS prevClose, hi / 100::DOUBLE AS hi, lo / 100::DOUBLE AS lo
  FROM (SELECT *, lag(c) OVER (PARTITION BY symbol ORDER BY day) AS prev, max(h) OVER (PARTITION BY symbol) AS hi, min(l) OVER (PARTITION BY symbol) AS lo, row_number() OVER (PARTITION BY symbol ORDER BY day DESC) AS r FROM days) WHERE r = 1)"""
ASOF = "clock AS (SELECT max(ts) AS now FROM ticks)"
RECENT = "bars AS (SELECT b.* FROM allbars b, clock WHERE ts >= date_trunc('day', now - INTERVAL 3 DAY) + INTERVAL 8 HOUR AND ts < now)"


def summary(asked: str, quotes: str = "quotes") -> str:
    """``asked``: SELECT pos, symbol (upper, trimmed), vendor."""
    null = "CASE WHEN q.symbol IS NOT NULL THEN {} END"
    cols = {
        "shortName": "q.shortName", "exchange": "q.exchange", "currency": "q.currency", "prevClose": "prevClose", "dayOpen": "dayOpen", "dayHigh": "dayHigh", "dayLow": "dayLow", "dayClose": "dayClose", "dayVolume": "dayVolume",
        "intradayReturnPct": ret("dayClose", "dayOpen"), "vsPreClosePct": ret("dayClose", "prevClose"), "latestPrice": "latestPrice", "latestSession": "latestSession",
        "latestChgPct": f"CASE WHEN latestPrice IS NOT NULL AND dayClose <> 0 THEN {up('(latestPrice / dayClose - 1) * 100', 2)} END", "latestBarTimeEt": "latestBarTimeEt", "vwapDate": "vwapDate",
        "regularBarCount": "coalesce(regularBarCount, 0)", "intradayBarCount": "coalesce(intradayBarCount, 0)", "intradayVwapLast": f"coalesce(intradayVwapLast, {up('(dayHigh + dayLow + dayClose) / 3', 4)})", "pctRegularMinutesAboveVwap": "pctRegularMinutesAboveVwap",
    }
    picked = ", ".join(f"{null.format(v)} AS {k}" for k, v in cols.items())
    return f"""{bars('1m', 'allbars')}, {ASOF}, {RECENT}, {SESS}, {SESSIONS}, {LATEST}, {QUOTES}, asked AS ({asked}),
items AS (SELECT pos, a.symbol, {picked}, CASE WHEN q.symbol IS NULL THEN 'No quote data' END AS fetchError
  FROM asked a LEFT JOIN (SELECT * FROM {quotes}) q ON q.symbol = a.vendor LEFT JOIN latest l ON l.symbol = a.vendor LEFT JOIN sums s ON s.symbol = a.vendor)"""


ASKED = f"SELECT column0 AS pos, upper(trim(column1, {BLANKS})) AS symbol, replace(upper(trim(column1, {BLANKS})), '.', '-') AS vendor FROM {_values(q.ASKED).replace('VALUES', 'VALUES')} AS v(column0, column1)"
SPARSE = f"WITH {USERS}, {summary('SELECT min(seq) AS pos, symbol, symbol AS vendor FROM ticks GROUP BY symbol', 'quotes WHERE symbol[2:]::BIGINT % 3 <> 0')}"
DENSE = f"WITH {TICKS}, {summary(ASKED)}"


def classify(minute: str) -> str:
    return f"""WITH {TICKS}, {bars('1m')}, {SESS}
SELECT symbol, {iso('ts')} AS ts, et_date, minute, CASE WHEN m < 570 THEN 'premarket' WHEN m > 960 THEN 'afterhours' ELSE 'regular' END AS session, strftime(et, '%m/%d/%Y, %H:%M:%S') || ' ET' AS et_text,
  CASE WHEN strftime(et, '%H:%M:%S') < '09:30:00' THEN 'premarket' WHEN strftime(et, '%H:%M:%S') > '16:00:00' THEN 'afterhours' ELSE 'regular' END AS session_v2,
  strftime(et, '%Y-%m-%d %H:%M:%S ') || CASE WHEN epoch(ts) - epoch(et) = 14400 THEN 'EDT' ELSE 'EST' END AS et_zone
FROM (SELECT *, {minute} AS m FROM sess)"""


def plain(interval: str) -> str:
    return f"""WITH {TICKS}, {bars(interval)} SELECT symbol, "interval", {iso('ts')} AS ts, open, high, low, close, volume FROM bars"""


def history(symbols: str, period: str, interval: str, days: int, name: str = "") -> str:
    return f"""SELECT symbol, '{period}' AS period, "interval", ts, open, high, low, close, volume FROM (WITH part AS (SELECT t.* FROM ticks t, clock WHERE symbol IN ({symbols}) AND ts < now), {bars(interval, 'b', 'part')} SELECT b.* FROM b, clock WHERE ts >= now - INTERVAL {days} DAY)"""


def hist_query(symbols: str, *parts: tuple[str, str, int]) -> str:
    union = " UNION ALL ".join(history(symbols, *p) for p in parts)
    return f"""WITH {TICKS}, {ASOF}, hist AS ({union})"""


HIST_COLS = f"""SELECT symbol, period, "interval", {iso('ts')} AS ts, open, high, low, close, volume FROM hist"""
CSV = hist_query("'VIEW', 'ERROR'", ("1d", "15m", 1))
UNIVERSE = """SELECT pos, symbol FROM (SELECT pos, upper(trim(string_split(l, ',')[1], {b})) AS symbol, pos > min(CASE WHEN starts_with(l, 'Ticker') THEN pos END) OVER () AS after
  FROM (SELECT row_number() OVER (ORDER BY k) - 1 AS pos, CASE WHEN k % 40 = 7 THEN 'Ticker,Name' ELSE CASE k % 5 WHEN 0 THEN '"Q' || k || '"' WHEN 1 THEN ' c' || k WHEN 2 THEN 'B.' || k WHEN 3 THEN 'X-' || k ELSE 'T' || (k % 50) || ' ' END || ',' || more END AS l
    FROM (SELECT {key} AS k, {more} AS more FROM {table}))) WHERE after AND regexp_matches(symbol, '^[A-Z0-9.]+$')"""
CUSTOMERS, SUPPLIERS = (UNIVERSE.format(b=BLANKS, key=k, more=m, table=t) for t, k, m in (("customer", "c_custkey", "c_mktsegment"), ("supplier", "s_suppkey", "s_name")))
BLOCK, SYMBOL = r"""["'']([^"'']+)["'']\s*:\s*\[([^\]]*)\]""", r"""["'']([A-Za-z0-9.^-]{1,10})["'']|([A-Z]{1,10})"""


def categories(text: str) -> str:
    return f"""blocks AS (SELECT id * 4294967296::BIGINT + generate_subscripts(n, 1) - 1 AS spot, unnest(n) AS n, unnest(i) AS i FROM (SELECT id, regexp_extract_all(t, '{BLOCK}', 1) AS n, regexp_extract_all(t, '{BLOCK}', 2) AS i FROM ({text}))),
lists AS (SELECT spot, trim(n, {BLANKS}) AS category, [upper(translate(s, '"''', '')) FOR s IN regexp_extract_all(i, '{SYMBOL}', 0)] AS symbols FROM blocks),
cats AS (SELECT cat_pos, category, generate_subscripts(symbols, 1) - 1 AS sym_pos, unnest(symbols) AS symbol FROM (SELECT category, min(spot) AS cat_pos, arg_max(symbols, spot) AS symbols FROM lists WHERE len(symbols) > 0 GROUP BY category))"""


LITERAL = categories(f"SELECT 0 AS id, {_s(q.CATEGORY_TEXT)} AS t")
REGIONS = """SELECT r_regionkey AS id, '"' || r_name || '": [' || string_agg('"' || replace(n_name, '_', '-') || '"', ', ' ORDER BY n_nationkey) || ']' AS t
  FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_regionkey, r_name"""
BRANDS = """SELECT p_partkey AS id, '{ ' || chr(39) || p_brand || ' ' || chr(39) || ' : [' || CASE WHEN p_partkey % 9 = 0 THEN '' ELSE chr(39) || lower(string_split(p_type, ' ')[1]) || chr(39) || ', ' || upper(p_name) || ', x, "' || p_size || '.A"' END || '], }' AS t FROM part"""
LASTS = "lasts AS (SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY pos DESC) = 1), joined AS (SELECT cat_pos, category, sym_pos, lasts.* FROM cats JOIN lasts USING (symbol))"


def sorted_items(way: str) -> str:
    return f"{SPARSE} SELECT pos, symbol, vsPreClosePct FROM items ORDER BY vsPreClosePct {way} NULLS LAST, pos"


def half_up(v: str, k: int) -> str:
    return f"printf('%.{k}f', floor({v} * {10**k} + 0.5) / {10**k})"


SNAPS = f"""WITH {TICKS}, d AS (SELECT ts::DATE AS day, symbol, arg_max(cents, (ts, seq)) / 100::DOUBLE AS dayClose, sum(volume)::BIGINT AS dayVolume FROM ticks GROUP BY ALL),
snaps AS (SELECT day(day)::BIGINT AS id, ['all-stocks', 'all-etfs', 'all-combined'][day(day) % 3 + 1] AS type, strftime(day, '%Y-%m-%d') AS trade_date, day::TIMESTAMP AS fetched_at, count(*)::INT AS symbol_count FROM d GROUP BY day),
list10 AS (SELECT * FROM snaps ORDER BY fetched_at DESC, id DESC LIMIT 10),
list50 AS (SELECT * FROM snaps ORDER BY fetched_at DESC, id DESC LIMIT 50),
exploded AS (SELECT day(day)::BIGINT AS id, (row_number() OVER (PARTITION BY day ORDER BY symbol) - 1)::INT AS pos, symbol, dayClose, dayVolume FROM d)"""
SNAP_COLS = f"SELECT id, type, trade_date, {iso('fetched_at')} AS fetched_at, symbol_count"

DAILY = f"""daily AS (SELECT symbol AS ticker, arg_min(cents, (ts, seq)) / 100::DOUBLE AS day_open, max(cents) / 100::DOUBLE AS day_high, min(cents) / 100::DOUBLE AS day_low, arg_max(cents, (ts, seq)) / 100::DOUBLE AS day_close,
  arg_max(cents, (ts, seq)) / 100::DOUBLE AS day_adj_close, sum(volume)::BIGINT AS day_volume FROM ticks WHERE {ET}::DATE = DATE '2024-01-18' GROUP BY symbol)"""
DAILY_COLS = f"SELECT *, {ret('day_close', 'day_open')} AS day_return_pct FROM daily"
_W = "(PARTITION BY symbol, session ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)"
V2 = f"""{bars('1m')}, s2 AS (SELECT *, CASE WHEN strftime(et, '%H:%M:%S') < '09:30:00' THEN 'premarket' WHEN strftime(et, '%H:%M:%S') > '16:00:00' THEN 'afterhours' ELSE 'regular' END AS session FROM (SELECT *, {ET} AS et FROM bars) WHERE et::DATE = DATE '2024-01-18'),
r2 AS (SELECT *, CASE WHEN session = 'regular' THEN coalesce(close > cum_vwap, false) END AS above_vwap FROM (SELECT *, CASE WHEN session = 'regular' AND volume <> 0 THEN
  (sum(floor((high + low + close) * 100 + 0.5)::BIGINT * volume) OVER {_W})::BIGINT::DOUBLE / ((sum(nullif(volume, 0)) OVER {_W})::BIGINT * 300)::DOUBLE END AS cum_vwap FROM s2)),
i1 AS (SELECT symbol AS ticker, count(*) AS intraday_bar_count, count(*) FILTER (session = 'regular') AS regular_bar_count, max(ts) AS lt, arg_max(close, (ts, seq)) AS latest_price, arg_max(volume, (ts, seq)) AS latest_volume,
  arg_max(session, (ts, seq)) AS ls, max(ts) FILTER (session = 'regular') AS rt, arg_max(close, (ts, seq)) FILTER (session = 'regular') AS regular_close, arg_max_null(cum_vwap, (ts, seq)) FILTER (session = 'regular') AS intraday_vwap_last,
  count(*) FILTER (above_vwap) AS above, list(close) FILTER (session = 'afterhours') AS late FROM r2 GROUP BY symbol),
intra AS (SELECT ticker, intraday_bar_count, regular_bar_count, strftime(lt - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S EST') AS latest_bar_time_et, latest_price, latest_volume, ls = 'afterhours' AS is_after_hours_latest, ls = 'premarket' AS is_premarket_latest,
  strftime(rt - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S EST') AS regular_close_time_et, regular_close, intraday_vwap_last, {ret('latest_price', 'intraday_vwap_last')} AS current_vs_vwap_pct,
  CASE WHEN regular_bar_count > 0 THEN {up('above * 100.0::DOUBLE / regular_bar_count', 2)} END AS pct_regular_minutes_above_vwap,
  CASE WHEN len(late) > 0 AND intraday_vwap_last IS NOT NULL THEN {up('len(list_filter(late, lambda v: v > intraday_vwap_last)) * 100.0::DOUBLE / len(late)', 2)} END AS pct_after_hours_minutes_above_regular_vwap FROM i1)"""
_AH = "CASE WHEN is_after_hours_latest AND latest_price IS NOT NULL THEN latest_price ELSE post END"

ORACLE_SQL = {
    **{f"bars_{i}": plain(i) for i in ("1m", "5m", "15m", "1h", "1d")},
    "session_classify": classify("minute"),
    "session_classify_compat": classify("CASE WHEN minute < 60 THEN minute + 1440 ELSE minute END"),
    "session_counts": f"WITH {TICKS}, {bars('1m')}, {SESS} SELECT symbol, et_date, session, count(*) AS n_bars, sum(volume)::BIGINT AS volume FROM sess GROUP BY ALL",
    "vwap_running_stream": f"WITH {TICKS}, {bars('1m')}, {SESS}, reg AS (SELECT * FROM sess WHERE session = 'regular' AND ts + INTERVAL 1 MINUTE <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL {q.LATE} FROM events)), {running('reg')} SELECT symbol, et_date, {iso('ts')} AS ts, valid, cum_volume, vwap FROM run",
    "vwap_running": f"WITH {TICKS}, {bars('1m')}, {SESS}, reg AS (SELECT * FROM sess WHERE session = 'regular'), {running('reg')} SELECT symbol, et_date, {iso('ts')} AS ts, valid, cum_volume, vwap FROM run",
    "vwap_session_summary": f"WITH {TICKS}, {bars('1m')}, {SESS}, {SESSIONS} SELECT * FROM sums",
    "latest_bar": f"WITH {TICKS}, {bars('1m')}, {SESS}, {LATEST} SELECT * FROM latest",
    "batch_summary": f"{DENSE} SELECT * FROM items",
    "batch_summary_missing": f"{SPARSE} SELECT * FROM items",
    "returns_pct": f"SELECT o_orderkey, {ret('o_totalprice', 'z')} AS return_pct, CASE WHEN z IS NOT NULL AND o_totalprice <> 0 THEN {up('(z / o_totalprice - 1) * 100', 2)} END AS latest_chg_pct, {up('z / 3', 4)} AS third FROM (SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN 0.0::DOUBLE ELSE c_acctbal END AS z FROM orders JOIN customer ON o_custkey = c_custkey)",
    "history_dedupe": f"SELECT o_orderpriority AS symbol, {iso('o_orderdate')} AS ts, min(o_orderkey) AS seq, arg_min(o_totalprice, o_orderkey) AS close FROM orders GROUP BY o_orderpriority, o_orderdate",
    "history_period_1d": f"{hist_query(chr(39) + 'VIEW' + chr(39) + ', ' + chr(39) + 'ERROR' + chr(39), ('1d', '5m', 1))} {HIST_COLS}",
    "history_period_max": f"{hist_query(chr(39) + 'VIEW' + chr(39) + ', ' + chr(39) + 'ERROR' + chr(39), ('max', '15m', 60))} {HIST_COLS}",
    "history_presets": f"{hist_query(chr(39) + 'CLICK' + chr(39), ('max', '1d', 36500), ('max', '1m', 30), ('max', '15m', 60))} {HIST_COLS}",
    "history_chunks": "SELECT n_nationkey, k::INT AS k, (s + k * 500)::BIGINT AS from_ms, least(s + (k + 1) * 500, e)::BIGINT AS to_ms FROM (SELECT *, unnest(generate_series(0, ceil((e - s) / 500)::BIGINT - 1)) AS k FROM (SELECT n_nationkey, n_nationkey * 1000 AS s, n_nationkey * 1000 + n_regionkey * 777 AS e FROM nation) WHERE e > s)",
    "history_csv": f"""{CSV} SELECT symbol, period, "interval", '# ' || symbol || ' | period=' || period || ' | interval=' || "interval" || ' | rows=' || count(*) || ' | fetchedAt=2024-02-01T00:00:00.000Z' || chr(10) || 'date,open,high,low,close,volume' || chr(10) ||
  string_agg(concat_ws(',', {iso('ts')}, open, high, low, close, volume), chr(10) ORDER BY ts) AS block FROM hist GROUP BY symbol, period, "interval\"""",
    "history_envelope": f"{CSV} SELECT symbol, count(*) AS row_count, {iso('min(ts)')} AS first_date, arg_min(close, ts) AS first_close, '2024-02-01T00:00:00.000Z' AS fetched_at FROM hist GROUP BY symbol",
    "history_preset_minute": f"{hist_query(chr(39) + 'CLICK' + chr(39), ('max', '1m', 30))} {HIST_COLS}",
    "history_preset_intraday": f"{hist_query(chr(39) + 'CLICK' + chr(39), ('max', '1m', 30), ('max', '15m', 60))} {HIST_COLS}",
    "history_preview": f"{CSV} {HIST_COLS.replace(' FROM hist', ', n_more FROM (SELECT *, greatest(count(*) OVER (PARTITION BY symbol) - 5, 0) AS n_more FROM hist QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts) <= 5)')}",
    "history_parameters": """SELECT event_id, period, "interval", days IS NOT NULL AS taken, days FROM (SELECT *, CASE WHEN "interval" = '2m' OR period = '5d' THEN NULL WHEN period = '1d' THEN 1
  ELSE map {'1m': 30, '5m': 60, '15m': 60, '1h': 730, '1d': 36500}["interval"] END::INT AS days
  FROM (SELECT event_id, (['1d', 'max', '5d'])[event_id % 3 + 1] AS period, (['1m', '5m', '15m', '1h', '1d', '2m'])[user_id % 6 + 1] AS "interval" FROM events))""",
    "vendor_bars": f"""SELECT symbol, '1d' AS "interval", {iso('ts')} AS ts, seq, open, high, low, close, volume FROM (SELECT o_orderpriority AS symbol, o_orderdate AS ts, o_orderkey AS seq, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS open, o_totalprice AS high,
  CASE WHEN o_orderkey % 3 <> 0 THEN 1.5::DOUBLE END AS low, o_totalprice AS close, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey END AS volume FROM orders WHERE o_orderkey % 11 <> 0)
  QUALIFY row_number() OVER (PARTITION BY symbol, ts ORDER BY seq) = 1""",
    "batch_envelope": f"{DENSE} SELECT '2024-01-31' AS \"tradeDate\", '2024-02-01T00:00:00.000Z' AS \"fetchedAt\", (row_number() OVER (ORDER BY pos) - 1)::INT AS pos, symbol, dayClose, fetchError FROM items",
    "snapshot_build": f"{DENSE} SELECT 7::BIGINT AS id, 'all-combined' AS type, '2024-01-31' AS trade_date, (SELECT count(*) FROM items)::INT AS symbol_count, (row_number() OVER (ORDER BY pos) - 1)::INT AS pos, symbol, dayClose, fetchError FROM items",
    "quotes_kept": f"WITH {USERS}, {QUOTES} SELECT symbol, dayOpen AS \"regularMarketOpen\", dayHigh AS \"regularMarketDayHigh\", dayLow AS \"regularMarketDayLow\", dayClose AS \"regularMarketPrice\", prevClose AS \"previousClose\", hi AS \"fiftyTwoWeekHigh\", lo AS \"fiftyTwoWeekLow\", dayVolume AS \"regularMarketVolume\" FROM quotes",
    "snapshot_append": f"""SELECT 1::BIGINT AS id, 'all-stocks' AS type, '2024-01-31' AS trade_date, (count(*) OVER ())::INT AS symbol_count, * FROM ({SPARSE} SELECT pos::BIGINT AS pos, symbol, dayClose, dayVolume, latestSession, regularBarCount, fetchError FROM items)
UNION ALL SELECT 2::BIGINT, 'all-etfs', '2024-01-31', (count(*) OVER ())::INT, * FROM ({DENSE} SELECT pos::BIGINT AS pos, symbol, dayClose, dayVolume, latestSession, regularBarCount, fetchError FROM items)""",
    "snapshot_items_latest": f"{SPARSE} SELECT 1::BIGINT AS id, pos::BIGINT AS pos, symbol, latestPrice, vwapDate, true AS has_close FROM items",
    "snapshot_envelope": f"{SNAPS} {SNAP_COLS}, e.symbol AS first_symbol, e.dayVolume AS first_volume FROM snaps JOIN exploded e USING (id) WHERE e.pos = 0",
    "snapshot_list_envelope": f"{SNAPS} SELECT (row_number() OVER (ORDER BY fetched_at DESC, id DESC) - 1)::INT AS k, id, type, trade_date AS \"tradeDate\", {iso('fetched_at')} AS \"fetchedAt\", symbol_count AS \"symbolCount\" FROM list50",
    "query_parameters": "SELECT p_partkey, 'name=' || replace(url_encode(p_name), '%20', '+') AS name, 'brand=' || CASE WHEN p_size % 2 = 0 THEN url_encode(p_brand) ELSE 'null' END AS brand FROM part",
    "parsed_bodies": """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'json' WHEN 2 THEN 'text' WHEN 3 THEN 'text' ELSE 'empty' END AS kind,
  CASE o_orderkey % 5 WHEN 0 THEN '{"a":' || o_custkey || ',"b":[1,null]}' WHEN 2 THEN '{' || o_orderstatus WHEN 3 THEN o_orderpriority END AS parsed FROM orders""",
    "stock_info": f"WITH {TICKS}, {QUOTES} SELECT symbol, shortName, longName, exchange, currency, dayVolume * 1000 AS marketCap, dayClose AS regularMarketPrice, NULL::DOUBLE AS regularMarketChangePercent, hi AS fiftyTwoWeekHigh, lo AS fiftyTwoWeekLow FROM quotes WHERE symbol = 'VIEW'",
    "quote_prev_close": f"WITH {USERS}, {QUOTES} SELECT symbol, shortName, exchange, currency, prevClose, dayOpen, dayHigh, dayLow, dayClose, dayVolume FROM quotes",
    "universe_load": CUSTOMERS,
    "universe_combined": f"SELECT 0 AS part, * FROM ({CUSTOMERS}) UNION ALL SELECT 1, * FROM ({SUPPLIERS})",
    "ordered_distinct": f"WITH {USERS} SELECT symbol, min(seq) AS pos FROM ticks GROUP BY symbol",
    "ticker_args_parse": f"""SELECT symbol, f.part, f.line_no, f.k FROM (SELECT symbol, min({{'part': part, 'line_no': line_no, 'k': k}}) AS f FROM (SELECT part, line_no, generate_subscripts(w, 1) - 1 AS k, upper(trim(unnest(w), {BLANKS})) AS symbol
  FROM (SELECT part, line_no, string_split(line, ',') AS w FROM (SELECT 0 AS part, 0 AS line_no, {_s(q.ARGUMENTS)} AS line UNION ALL SELECT 1, row_number() OVER (ORDER BY p_partkey) - 1,
    CASE p_partkey % 4 WHEN 0 THEN ' # ' || p_name WHEN 1 THEN p_brand || ' ,, ' || p_type WHEN 2 THEN chr(9) || p_name ELSE ' ' END FROM part) WHERE part = 0 OR NOT starts_with(trim(line, {BLANKS}), '#'))) WHERE symbol <> '' GROUP BY symbol)""",
    "category_parse": f"WITH {categories(REGIONS)} SELECT * FROM cats",
    "category_literal": f"WITH {categories(BRANDS)} SELECT * FROM cats",
    "category_join": f"{DENSE}, {LITERAL}, {LASTS} SELECT cat_pos, category, sym_pos, symbol, dayClose, pctRegularMinutesAboveVwap FROM joined",
    "category_stats": f"""{DENSE}, {LITERAL}, {LASTS} SELECT *, CASE WHEN with_vwap = 0 THEN NULL WHEN above_60 / with_vwap >= 0.6 THEN 'green' WHEN above_60 / with_vwap >= 0.4 THEN 'yellow' ELSE 'red' END AS ratio_bucket
  FROM (SELECT cat_pos, category, count(*) AS n_symbols, count(pctRegularMinutesAboveVwap) AS with_vwap, count(*) FILTER (pctRegularMinutesAboveVwap >= 60) AS above_60 FROM joined GROUP BY ALL)""",
    "category_counts": f"WITH {categories(BRANDS)} SELECT count(DISTINCT symbol) AS n_symbols, count(DISTINCT category) AS n_categories FROM cats",
    "sort_nulls_last_desc": sorted_items("DESC"),
    "sort_nulls_last_asc": sorted_items("ASC"),
    "top_movers_5": f"{SPARSE} SELECT symbol, vsPreClosePct, (SELECT greatest(count(*) - 5, 0) FROM items) AS n_more FROM items ORDER BY vsPreClosePct DESC NULLS LAST, pos LIMIT 5",
    "format_columns": f"""{SPARSE} SELECT pos, symbol, coalesce({half_up('dayClose', 2)}, '—') AS close_text, coalesce({half_up('intradayVwapLast', 4)}, '—') AS vwap_text,
  CASE WHEN dayVolume IS NULL THEN '—' WHEN dayVolume >= 1e9 THEN {half_up('dayVolume / 1e9', 2)} || 'B' WHEN dayVolume >= 1e6 THEN {half_up('dayVolume / 1e6', 2)} || 'M' WHEN dayVolume >= 1e3 THEN {half_up('dayVolume / 1e3', 1)} || 'K' ELSE dayVolume::VARCHAR END AS volume_text,
  CASE WHEN vsPreClosePct IS NULL THEN '—' ELSE CASE WHEN vsPreClosePct >= 0 THEN '+' ELSE '' END || printf('%.2f', vsPreClosePct) || '%' END AS change_text,
  CASE WHEN dayVolume IS NULL THEN 'N/A' ELSE format('{{:,}}', dayVolume) END AS volume_grouped, coalesce({half_up('dayOpen', 4)}, 'N/A') AS open_text FROM items""",
    "bucket_columns": f"""{SPARSE} SELECT pos, symbol, CASE WHEN vsPreClosePct IS NULL THEN 'none' WHEN vsPreClosePct > 0 THEN 'up' WHEN vsPreClosePct < 0 THEN 'down' ELSE 'flat' END AS change_bucket,
  CASE WHEN pctRegularMinutesAboveVwap IS NULL THEN 'muted' WHEN pctRegularMinutesAboveVwap >= 60 THEN 'green' WHEN pctRegularMinutesAboveVwap >= 40 THEN 'yellow' ELSE 'red' END AS vwap_bucket,
  CASE latestSession WHEN 'afterhours' THEN 'AH' WHEN 'premarket' THEN 'PM' WHEN 'regular' THEN 'REG' ELSE '—' END AS session_badge FROM items""",
    "candle_series": f"WITH {TICKS}, {bars('15m')} SELECT symbol, epoch(ts)::BIGINT AS time, open, high, low, close, coalesce(volume, 0) AS volume, CASE WHEN close >= open THEN 'up' ELSE 'down' END AS direction FROM bars",
    "csv_export_rows": f"""{SPARSE}, named AS (SELECT * REPLACE (CASE WHEN pos % 2 = 0 THEN shortName || ', Inc.' ELSE shortName END AS shortName) FROM items)
SELECT pos, concat_ws(',', {', '.join(("CASE WHEN contains({0}, ',') THEN '{1}' || {0} || '{1}' ELSE coalesce({0}, '') END" if c in ("symbol", "shortName", "latestSession", "vwapDate", "latestBarTimeEt") else "coalesce({0}::VARCHAR, '')").format(c, '"') for c in q.present.CSV_COLUMNS)}) AS line FROM named""",
    "snapshot_latest": f"{SNAPS} SELECT exploded.* FROM exploded WHERE id = (SELECT id FROM snaps WHERE type = 'all-etfs' ORDER BY fetched_at DESC, id DESC LIMIT 1)",
    "snapshot_list": f"{SNAPS} {SNAP_COLS} FROM list50",
    "snapshot_list_of_type": f"{SNAPS} {SNAP_COLS} FROM list10 WHERE type = 'all-stocks'",
    "snapshot_by_id": f"{SNAPS} {SNAP_COLS} FROM snaps WHERE id = 12",
    "snapshot_explode": f"{SNAPS} SELECT * FROM exploded",
    "daily_ohlcv_v2": f"WITH {USERS}, {DAILY} {DAILY_COLS}",
    "vwap_running_v2": f"WITH {TICKS}, {V2} SELECT symbol, {iso('ts')} AS ts, cum_vwap, above_vwap FROM r2",
    "after_hours_v2": f"WITH {TICKS}, {V2} SELECT * FROM intra",
    "summary_v2": f"""WITH {TICKS}, {V2}, {DAILY}, d2 AS ({DAILY_COLS}), {QUOTES},
prof AS (SELECT symbol AS ticker, longName AS company_name, NULL::VARCHAR AS quote_type, NULL::VARCHAR AS sector, NULL::VARCHAR AS industry, exchange, currency, dayVolume * 1000 AS market_cap, NULL::VARCHAR AS website, NULL::VARCHAR AS business_summary,
  NULL::DOUBLE AS yahoo_current_price, dayClose AS yahoo_regular_market_price, NULL::DOUBLE AS yahoo_pre_market_price, dayLow AS yahoo_post_market_price, NULL::DOUBLE AS yahoo_post_market_change_pct, NULL::DOUBLE AS yahoo_regular_market_change_pct FROM quotes),
j AS (SELECT * REPLACE (coalesce(intraday_bar_count, 0) AS intraday_bar_count, coalesce(regular_bar_count, 0) AS regular_bar_count), {_AH.replace('post', 'yahoo_post_market_price')} AS after_hours_price
  FROM (VALUES ('VIEW'), ('CLICK'), ('NOPE'), ('ERROR')) AS t(ticker) LEFT JOIN prof USING (ticker) LEFT JOIN d2 USING (ticker) LEFT JOIN intra USING (ticker))
SELECT *, {ret('latest_price', 'day_close')} AS latest_vs_day_close_pct, {ret('after_hours_price', 'day_close')} AS after_hours_vs_day_close_pct FROM j""",
    "symbol_normalize": "SELECT p_partkey, replace(upper(p_name), ' ', '-') AS vendor_symbol, replace(upper(p_name), ' ', '.') AS symbol FROM part",
    "safe_numbers": "SELECT p_partkey, CASE WHEN p_partkey % 3 = 1 THEN p_size::DOUBLE END AS as_double, CASE WHEN p_partkey % 3 = 1 THEN p_size::BIGINT END AS as_long FROM part",
    "text_summary_500": f"SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source ELSE lang END AS company_name, trim(replace(left(text, 500), chr(10), ' '), {BLANKS}) AS business_summary FROM documents",
    "iso_epoch": f"SELECT event_id, {iso('ts')} AS iso, floor(epoch(ts))::BIGINT AS epoch, strftime({ET}, '%Y-%m-%d') AS trade_date FROM events",
    "request_parse": f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 8 > 3 THEN pos END AS pos, CASE WHEN o_orderkey % 8 > 3 THEN ([o_orderpriority, o_orderstatus, 'A'])[pos + 1] END AS symbol, CASE WHEN o_orderkey % 8 <= 3 THEN '{BAD_REQUEST}' END AS error
  FROM orders, (VALUES (0), (1), (2)) AS v(pos) WHERE o_orderkey % 8 > 3 OR pos = 0""",
    "error_messages": """SELECT o_orderkey, 'HTTP 500 Server Error' || CASE o_orderkey % 6 WHEN 0 THEN ': ' || o_orderpriority || ' — ' || o_orderstatus WHEN 1 THEN ': ' || o_orderstatus WHEN 2 THEN ': only' WHEN 3 THEN ': plain text' WHEN 4 THEN ': ' || repeat('x', 299) || '…' ELSE '' END AS message
  FROM orders""",
}
ORACLE_SQL["history_csv_text"] = f"""SELECT count(*) AS n_blocks, string_agg(block, chr(10) || chr(10) ORDER BY symbol, period, "interval") AS text FROM ({ORACLE_SQL['history_csv']})"""
ORACLE_SQL["preview_v2"] = f"SELECT {', '.join(c for c in q.script.PREVIEW if c != 'after_hours_price')} FROM ({ORACLE_SQL['summary_v2']})"
_CELLS = ", ".join((f"CASE WHEN contains({c}, ',') THEN '\"' || {c} || '\"' ELSE coalesce({c}, '') END" if c in ("ticker", "company_name", "exchange", "website") else f"coalesce({c}::VARCHAR, '')") for c in ("ticker", "company_name", "exchange", "market_cap", "day_open", "day_close", "day_volume", "website", "is_after_hours_latest"))
ORACLE_SQL["script_csv_rows"] = f"SELECT ticker, concat_ws(',', {_CELLS}) AS line FROM ({ORACLE_SQL['summary_v2']})"
ORACLE_SQL["flatten_v2"] = f'SELECT ticker, day_open AS "Open", day_close AS "Close" FROM ({ORACLE_SQL["daily_ohlcv_v2"]})'
