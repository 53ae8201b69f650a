"""Scalar expressions of the bar model: one home for rounding, truthiness, sessions, time and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The exchange's zone, the session's first and last minute of day, and the white space that is trimmed.
ZONE, OPEN_MINUTE, CLOSE_MINUTE = "America/New_York", 570, 960
BLANKS = " \t\r\n\f\x0b\xa0"
DASH = "—"
_BLOCK = r"""["']([^"']+)["']\s*:\s*\[([^\]]*)\]"""
_SYMBOL = r"""["']([A-Za-z0-9.^-]{1,10})["']|([A-Z]{1,10})"""


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trimmed(s) -> Column:
    return F.trim(c(s), F.lit(BLANKS))


def vendor_symbol(s) -> Column:
    """Trimmed, upper case, dots as dashes."""
    return F.replace(F.upper(trimmed(s)), F.lit("."), F.lit("-"))


def eastern(ts) -> Column:
    return F.from_utc_timestamp(c(ts), ZONE)


def et_date(et) -> Column:
    return F.date_format(c(et), "yyyy-MM-dd")


def et_minute(et) -> Column:
    return F.hour(c(et)) * 60 + F.minute(c(et))


def et_display(et) -> Column:
    return F.concat(F.date_format(c(et), "MM/dd/yyyy, HH:mm:ss"), F.lit(" ET"))


def session(minute, compat_midnight: bool = False) -> Column:
    """premarket, regular (09:30 to the end of minute 16:00) or afterhours; ``compat_midnight`` puts the hour after midnight last."""
    m = c(minute)
    m = F.when(m < 60, m + 1440).otherwise(m) if compat_midnight else m
    return F.when(m < OPEN_MINUTE, "premarket").when(m > CLOSE_MINUTE, "afterhours").when(m.isNotNull(), "regular")


def session_v2(et) -> Column:
    """The script's flags by the second: after 16:00:00 is afterhours."""
    t = F.date_format(c(et), "HH:mm:ss")
    return F.when(t < "09:30:00", "premarket").when(t > "16:00:00", "afterhours").when(t.isNotNull(), "regular")


def et_with_zone(ts) -> Column:
    """Eastern time with EST or EDT, told by its distance from UTC."""
    et = eastern(ts)
    hours = (F.unix_timestamp(et) - F.unix_timestamp(c(ts))) / 3600
    return F.concat(F.date_format(et, "yyyy-MM-dd HH:mm:ss "), F.when(hours == -4, "EDT").otherwise("EST"))


def iso_utc(ts) -> Column:
    return F.date_format(c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def round_up(x, digits: int) -> Column:
    """Halves go towards plus infinity."""
    k = F.lit(float(10**digits))
    return F.floor(c(x) * k + 0.5) / k


def truthy(x) -> Column:
    return c(x).isNotNull() & (c(x) != 0) & ~F.isnan(c(x).cast("double"))


def return_pct(a, b) -> Column:
    """Percent change, two digits; null unless both are there and neither is zero."""
    return F.when(truthy(a) & truthy(b), round_up((c(a) / c(b) - 1) * 100, 2))


def latest_change_pct(price, close) -> Column:
    """As ``return_pct``, but a price of zero counts."""
    return F.when(c(price).isNotNull() & truthy(close), round_up((c(price) / c(close) - 1) * 100, 2))


def typical(h, low, cl) -> Column:
    return (c(h) + c(low) + c(cl)) / 3


def fixed(x, digits: int = 2, none: str = DASH) -> Column:
    return F.when(c(x).isNull(), none).otherwise(F.format_string(f"%.{digits}f", c(x).cast("double")))


def short_volume(v) -> Column:
    x = c(v).cast("double")
    return (
        F.when(x.isNull(), DASH).when(x >= 1e9, F.format_string("%.2fB", x / 1e9)).when(x >= 1e6, F.format_string("%.2fM", x / 1e6))
        .when(x >= 1e3, F.format_string("%.1fK", x / 1e3)).otherwise(c(v).cast("string"))
    )


def signed_pct(x) -> Column:
    return F.when(c(x).isNull(), DASH).otherwise(F.concat(F.when(c(x) >= 0, "+").otherwise(""), F.format_string("%.2f%%", c(x).cast("double"))))


def grouped(v) -> Column:
    return F.when(c(v).isNull(), "N/A").otherwise(F.format_number(c(v), 0))


def direction(x) -> Column:
    return F.when(c(x).isNull(), "none").when(c(x) > 0, "up").when(c(x) < 0, "down").otherwise("flat")


def strength(pct) -> Column:
    return F.when(c(pct).isNull(), "muted").when(c(pct) >= 60, "green").when(c(pct) >= 40, "yellow").otherwise("red")


def ratio_bucket(strong, with_vwap) -> Column:
    r = c(strong) / F.nullif(c(with_vwap), F.lit(0))
    return F.when(r >= 0.6, "green").when(r >= 0.4, "yellow").when(r.isNotNull(), "red")


def badge(s) -> Column:
    return F.when(c(s) == "afterhours", "AH").when(c(s) == "premarket", "PM").when(c(s) == "regular", "REG").otherwise(DASH)


def candle(o, cl) -> Column:
    return F.when(c(cl) >= c(o), "up").otherwise("down")


def safe_double(x) -> Column:
    return F.nullif(c(x).try_cast("double"), F.lit(float("nan")))


def safe_long(x) -> Column:
    return safe_double(x).try_cast("long")


def first_filled(*names) -> Column:
    return F.coalesce(*(F.nullif(c(n), F.lit("")) for n in names))


def short_text(s, n: int = 500) -> Column:
    return trimmed(F.replace(F.substring(c(s), 1, n), F.lit("\n"), F.lit(" ")))


def category_blocks(text) -> Column:
    """Array of (name, inner) of the ``"name": [inner]`` blocks of a text."""
    return F.arrays_zip(F.regexp_extract_all(c(text), F.lit(_BLOCK), F.lit(1)).alias("name"), F.regexp_extract_all(c(text), F.lit(_BLOCK), F.lit(2)).alias("inner"))


def block_symbols(inner) -> Column:
    """Quoted tokens of any case and bare upper-case runs, upper case, in order."""
    return F.transform(F.regexp_extract_all(c(inner), F.lit(_SYMBOL), F.lit(0)), lambda s: F.upper(F.translate(s, "\"'", "")))


def clipped(text, limit: int = 300) -> Column:
    return F.when(F.length(c(text)) > limit, F.concat(F.left(c(text), F.lit(limit - 1)), F.lit("…"))).otherwise(c(text))


def error_text(status, reason, body) -> Column:
    """Message of a failed request: of a JSON object its best fields, of other text the first 300 characters."""
    prefix = F.concat(F.lit("HTTP "), c(status).cast("string"), F.lit(" "), c(reason))
    text = trimmed(F.regexp_replace(c(body), "^\\ufeff", ""))
    field = lambda name: F.nullif(trimmed(F.try_variant_get(F.try_parse_json(text), f"$.{name}", "string")), F.lit(""))
    title, detail = field("title"), field("detail")
    message = F.coalesce(field("message"), field("error_description"), field("error"))
    best = F.coalesce(F.concat(title, F.lit(" — "), detail), detail, message, title)
    said = F.when(F.startswith(text, F.lit("{")), best).otherwise(F.nullif(clipped(text), F.lit("")))
    return F.when(said.isNull(), prefix).otherwise(F.concat(prefix, F.lit(": "), said))


def query_parameter(name: str, value) -> Column:
    """``name=value`` of a URL, a null value as the word null."""
    return F.concat(F.lit(f"{name}="), F.url_encode(F.coalesce(c(value).cast("string"), F.lit("null"))))


def _body(body) -> tuple[Column, Column]:
    """A body's text without byte-order mark and blanks, and whether it is JSON that says so."""
    text = trimmed(F.regexp_replace(c(body), "^\\ufeff", ""))
    looks = F.startswith(text, F.lit("{")) | F.startswith(text, F.lit("["))
    return text, looks & F.try_parse_json(text).isNotNull()


def body_kind(body) -> Column:
    """What a response body is taken for: empty, json, or text."""
    text, json = _body(body)
    return F.when(text.isNull() | (text == ""), "empty").when(json, "json").otherwise("text")


def parsed_body(body) -> Column:
    """The body that a caller gets: null if empty, JSON in its plain form, other text as it came."""
    text, json = _body(body)
    return F.when(text.isNull() | (text == ""), F.lit(None).cast("string")).when(json, F.to_json(F.try_parse_json(text))).otherwise(c(body))
