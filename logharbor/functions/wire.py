"""Wire decode: envelope, priority, protocol version, timestamp and body of a log message.

Everything is a built-in Column expression.  The message bytes are viewed as
ISO-8859-1 text so that one character is one byte; a single anchored pattern then
yields every field, and the body is sliced from the binary value, so bytes that are
not valid UTF-8 survive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .times import int_div

# Fixed values of the wire format: envelope size, month names, field patterns.
ENVELOPE_BYTES = 10
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
PRI = r"(?:<(0|1[0-8]\d|19[01]|[1-9]\d?)>)?"
VERSION = r"(?:([1-9]\d{0,2}) )?"
SEP = r"[ \-:T]*"
MONTH = r"(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
ISO_DAY = rf"(\d{{4}}){SEP}(\d{{2}}){SEP}(\d{{2}})"
SYSLOG_DAY = rf"({MONTH})[\s\S]( \d|\d{{2}})"
CLOCK = rf"{SEP}(\d{{2}}){SEP}(\d{{2}}){SEP}(\d{{2}})"
FRACTION = r"(?:\.(\d*))?"
ZONE = r"(?:Z|([+-])(\d{2}):?(\d{2})?)?"
# A message that ends while a timestamp is still being spelled out.
ISO_CUT = rf"\d{{1,3}}|\d{{4}}(?:{SEP}\d{{2}}){{0,4}}{SEP}\d?"
SYSLOG_CUT = rf"{MONTH}(?:[\s\S](?:[ \d]|(?: \d|\d{{2}})(?:{SEP}\d{{2}}){{0,2}}{SEP}\d?)?)?"

STAMP = rf"((?:{ISO_DAY}|{SYSLOG_DAY}){CLOCK}{FRACTION}{ZONE})( ?)"
CUT = rf"(?=(?:{ISO_CUT}|{SYSLOG_CUT})\z)([\dA-S])"
MESSAGE = rf"^{PRI}{VERSION}(?:{STAMP}|{CUT})?(?s:.*)\z"

# Capture group of each field in MESSAGE.  The stamp text goes last because it may hold
# any byte (the one between month and day), including the field separator used below.
_GROUPS = {
    "pri": 1, "version": 2, "year": 4, "month": 5, "day": 6, "month_name": 7, "syslog_day": 8,
    "hour": 9, "minute": 10, "second": 11, "fraction": 12, "zone_sign": 13, "zone_hour": 14,
    "zone_minute": 15, "space": 16, "cut": 17, "stamp": 3,
}
_FIELDS = list(_GROUPS)
_FS = "\x01"


def envelope_version(value: Column) -> Column:
    """0 for an ``FE 00`` envelope, the raw version byte after another ``FE``, -1 for a raw line."""
    head = F.hex(F.substring(value, 1, 2))
    other = F.conv(F.substring(head, 3, 2), 16, 10).cast("int")
    return (
        F.when(head == "FE00", F.lit(0))
        .when(F.substring(head, 1, 2) == "FE", F.coalesce(other, F.lit(-2)))
        .otherwise(F.lit(-1))
    )


def envelope_ts(value: Column) -> Column:
    """Signed big-endian 64-bit milliseconds at bytes 2..9."""
    def word(start: int) -> Column:
        return F.conv(F.hex(F.substring(value, start, 4)), 16, 10).cast("long")

    high = word(3)
    signed = F.when(high >= 2**31, high - 2**32).otherwise(high)
    return signed * F.lit(2**32) + word(7)


def split_message(text: Column) -> Column:
    """All fields of a byte-per-character message as an array, with one pass of one pattern."""
    template = _FS.join(f"${n}" for n in _GROUPS.values())
    return F.split(F.regexp_replace(text, MESSAGE, template), _FS, len(_FIELDS))


def _field(parts: Column, name: str) -> Column:
    return parts[_FIELDS.index(name)]


def _number(parts: Column, name: str) -> Column:
    # The pattern admits digits or nothing; a failing try_cast would cost an exception per row.
    return F.nullif(_field(parts, name), F.lit("")).cast("int")


def facility(pri: Column) -> Column:
    return int_div(pri, 8).cast("int")


def severity(pri: Column) -> Column:
    return (pri % 8).cast("int")


def stamp_ms(parts: Column, as_of_year: Column) -> Column:
    """Epoch milliseconds of the parsed stamp, NULL when there is none.

    Out-of-range fields roll over (month 13 is January of the next year), a missing zone
    is UTC, and a stamp without a year takes ``as_of_year``.
    """
    name = _field(parts, "month_name")
    year = F.coalesce(_number(parts, "year"), F.when(name != "", as_of_year))
    named = F.when(name != "", int_div(F.position(name, F.lit(MONTHS)) + 2, 3))
    month0 = F.coalesce(_number(parts, "month"), named).cast("int") - 1
    day = F.coalesce(_number(parts, "day"), F.nullif(F.trim(_field(parts, "syslog_day")), F.lit("")).cast("int"))
    in_year = F.pmod(month0, F.lit(12))
    first = F.make_date((year + int_div(month0 - in_year, 12)).cast("int"), (in_year + 1).cast("int"), F.lit(1))
    days = (F.unix_date(first) + day - 1).cast("long")
    clock = (
        _number(parts, "hour").cast("long") * 3600
        + _number(parts, "minute") * 60
        + _number(parts, "second")
    )
    millis = F.substring(F.rpad(_field(parts, "fraction"), 3, "0"), 1, 3).cast("int")
    zone = F.coalesce(_number(parts, "zone_hour"), F.lit(0)).cast("long") * 3600 + (
        F.coalesce(_number(parts, "zone_minute"), F.lit(0)) * 60
    )
    east = F.when(_field(parts, "zone_sign") == "-", -zone).otherwise(zone)
    return (days * 86400 + clock - east) * 1000 + millis


def decode(log: DataFrame, as_of_year, value: str = "value", arrival_ms: str = "arrival_ms") -> DataFrame:
    """Add the decoded columns to a topic log.

    ``as_of_year`` (int or Column) dates stamps that carry no year; ``arrival_ms`` is the
    fallback time of a message that has neither a stamp nor an envelope.

    Added: ``enc_version, pri, facility, severity, rfc_version, parsed_ms, stamp_len,
    envelope_ms, ts_ms, ts_source, decode_status, body``.
    """
    year = as_of_year if isinstance(as_of_year, Column) else F.lit(as_of_year)
    raw = F.col(value)
    staged = log.withColumn("enc_version", envelope_version(raw))
    base = F.when(F.col("enc_version") == 0, F.lit(ENVELOPE_BYTES)).otherwise(F.lit(0))
    text = F.decode(F.substring(raw, base + 1, F.lit(2**31 - 1)), "ISO-8859-1")
    # Exploding a one-element array keeps the pattern out of filters: the optimizer would push
    # a filter on a decoded column below a plain projection and match again for every use.
    staged = staged.withColumn("_parts", F.explode(F.array(split_message(text))))
    parts = F.col("_parts")

    pri = _number(parts, "pri")
    version = _field(parts, "version")
    has_envelope = (F.col("enc_version") == 0) & (F.length(raw) >= ENVELOPE_BYTES)
    staged = staged.withColumns({
        "pri": pri,
        "rfc_version": _number(parts, "version"),
        "parsed_ms": stamp_ms(parts, year),
        "stamp_len": F.length(_field(parts, "stamp")),
        "envelope_ms": F.when(has_envelope, envelope_ts(raw)),
        "ts_source": F.when(_field(parts, "stamp") != "", "parsed").when(has_envelope, "envelope").otherwise("now"),
        "decode_status": F.when(base > F.length(raw), "short_envelope")
        .when(_field(parts, "cut") != "", "truncated_ts")
        .otherwise("ok"),
        "_pos": base
        + F.when(pri.isNull(), F.lit(0)).otherwise(F.length(_field(parts, "pri")) + 2)
        + F.when(version == "", F.lit(0)).otherwise(F.length(version) + 1)
        + F.length(_field(parts, "stamp"))
        + F.length(_field(parts, "space")),
    })
    return staged.withColumns({
        "facility": facility(F.col("pri")),
        "severity": severity(F.col("pri")),
        "ts_ms": F.coalesce("parsed_ms", "envelope_ms", arrival_ms),
        "body": F.substring(raw, F.col("_pos") + 1, F.lit(2**31 - 1)),
    }).drop("_parts", "_pos")


def landable(decoded: DataFrame, drop_truncated: bool = False) -> DataFrame:
    """Lines that are written: short envelopes never are, cut stamps unless ``drop_truncated``."""
    drop = ["short_envelope"] + (["truncated_ts"] if drop_truncated else [])
    return decoded.filter(~F.col("decode_status").isin(drop))


def body_text(body: Column) -> Column:
    """UTF-8 view of a body; malformed bytes become replacement characters."""
    return F.make_valid_utf8(body.cast("string"))


def body_is_utf8(body: Column) -> Column:
    return F.is_valid_utf8(body.cast("string"))


def partition_id(topic: Column, partition: Column) -> Column:
    return F.concat_ws("-", topic, partition.cast("string"))


def split_partition_id(pid: Column) -> tuple[Column, Column]:
    """Topic and partition of ``<topic>-<partition>``; the topic may itself hold dashes."""
    shape = r"^(.*)-(\d+)$"
    return F.regexp_extract(pid, shape, 1), F.nullif(F.regexp_extract(pid, shape, 2), F.lit("")).cast("int")
