"""Time arithmetic on epoch milliseconds, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
HOUR_MS = 3_600_000


def int_div(n: Column, d: Column | int) -> Column:
    """Integer quotient, truncated toward zero and exact for 64-bit values."""
    return F.call_function("div", n, d if isinstance(d, Column) else F.lit(d))


def ntz_ms(ts: Column) -> Column:
    """Epoch milliseconds of a zone-less timestamp read as UTC (sub-millisecond part dropped)."""
    days = F.unix_date(ts.cast("date")).cast("long")
    millis = F.floor(F.extract(F.lit("SECOND"), ts) * 1000).cast("long")
    return days * DAY_MS + F.hour(ts).cast("long") * HOUR_MS + F.minute(ts).cast("long") * 60_000 + millis


def time_bucket(ts_ms: Column, seconds: int) -> Column:
    """Start of the tumbling interval holding ``ts_ms``; the remainder truncates toward zero."""
    return ts_ms - ts_ms % F.lit(seconds * 1000)


def day_of(ts_ms: Column) -> Column:
    return F.date_from_unix_date(int_div(ts_ms - F.pmod(ts_ms, F.lit(DAY_MS)), DAY_MS).cast("int"))


def hour_of(ts_ms: Column) -> Column:
    return int_div(F.pmod(ts_ms, F.lit(DAY_MS)), HOUR_MS).cast("int")


def _padded(n: Column, width: int) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def render_template(template: Column | str, ts_ms: Column) -> Column:
    """Expand ``%y %M %d %H`` (year, month, day, hour in UTC); the template may differ per row."""
    tpl = F.lit(template) if isinstance(template, str) else template
    day = day_of(ts_ms)
    tokens = {
        "%y": _padded(F.year(day), 4),
        "%M": _padded(F.month(day), 2),
        "%d": _padded(F.dayofmonth(day), 2),
        "%H": _padded(hour_of(ts_ms), 2),
    }
    for token, text in tokens.items():
        tpl = F.replace(tpl, F.lit(token), text)
    return tpl
