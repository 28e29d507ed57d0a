"""Registered queries, each over the whole given tables, with the SQL that checks it.

The SQL works from the columns the messages were rendered from, not from their text, so it
checks the decoder independently.
"""

from __future__ import annotations

from collections.abc import Callable

from pyarrow import fs as pafs
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import wire
from .functions.times import render_template, time_bucket
from .operators import blocks as bl
from .operators import configs as cf
from .operators import ledger as lg
from .operators import offsets as of
from .operators import readiness as rd
from .operators import reports as rp
from .operators.common import TP
from .operators.files import FILE_KEY, file_keys, skew
from .plans import jobs
from .session import qualified, shared_dir, stored
from .sources import containers as boxes
from .sources import datasets, manifests as mf, markers, segments as sg, topic_log as tl
from .sources.events_log import YEAR, damaged_messages, messages, read_events, topic_log
from .streaming import landing, sink

AS_OF_MS = 1_706_661_000_000        # 2024-01-31 00:30 UTC, just after the last event
UNCONFIGURED = "signup"
CAP_SMALL = 20_000                  # block capacity that makes long documents split

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add


# --- the log in SQL ----------------------------------------------------------------------------

def _events_sql(shape: str) -> str:
    """Messages and what decoding them gives; ``shape`` is the SQL of a message's shape."""
    return f"""
ev AS (
  SELECT event_id, ts, user_id, props, event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
    (epoch_us(ts) // 1000) AS ms, CAST({shape} AS INTEGER) AS shape,
    CAST(8 * (event_id % 24) + event_id % 8 AS INTEGER) AS pri_value,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, 'user=' || user_id || ' ' || props AS tail
  FROM events
),
msg AS (
  SELECT *, ms + 5000 AS arrival_ms,
    CASE WHEN shape <= 4 OR shape = 9 THEN pri_value END AS pri,
    CASE WHEN shape <= 4 OR shape = 9 THEN 1 END AS rfc_version,
    CASE WHEN shape <= 4 THEN ms - 5400000 WHEN shape IN (5, 6) THEN ms - ms % 1000 END AS parsed_ms,
    CASE WHEN shape = 8 THEN ms END AS envelope_ms,
    CASE WHEN shape <= 6 THEN 'parsed' WHEN shape = 8 THEN 'envelope' ELSE 'now' END AS ts_source,
    CASE WHEN shape = 9 THEN 'truncated_ts' ELSE 'ok' END AS decode_status,
    CASE WHEN shape = 9 THEN substr(iso, 1, 14 - length(pri_value::VARCHAR)) ELSE tail END AS body
  FROM ev
),
dec AS (SELECT *, coalesce(parsed_ms, envelope_ms, arrival_ms) AS ts_ms FROM msg)
"""


# Messages whole, and, for showing the decoder, every tenth one ended inside its stamp.
_EV = _events_sql("CASE WHEN event_id % 10 = 9 THEN 0 ELSE event_id % 10 END")
_EV_CUT = _events_sql("event_id % 10")

_LOG = _EV + """,
ranked AS (
  SELECT *, sum(taken) OVER (PARTITION BY topic, "partition" ORDER BY event_id)::BIGINT - 1 AS "offset",
    sum(taken) OVER (PARTITION BY topic, "partition")::BIGINT AS total
  FROM (SELECT *, CASE WHEN event_id % 101 = 0 THEN 2 ELSE 1 END AS taken FROM dec)
),
log AS (
  SELECT *, "offset" * 2 AS arrival_seq, total AS high_watermark FROM ranked
  UNION ALL
  SELECT *, "offset" * 2 + 11, CASE WHEN event_id % 194 = 0 THEN "offset" + 2 ELSE total END
  FROM ranked WHERE event_id % 97 = 0
),
expecting AS (
  SELECT *, coalesce(max("offset") OVER (PARTITION BY topic, "partition" ORDER BY arrival_seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, 0) AS expected
  FROM log
),
audited AS (
  SELECT *, CASE WHEN "offset" > expected THEN 'gap' WHEN "offset" = expected THEN 'ok'
      WHEN expected < high_watermark THEN 'early' WHEN expected = high_watermark THEN 'at_hw'
      ELSE 'beyond_hw' END AS status,
    greatest("offset" - expected, 0) AS gap, high_watermark - ("offset" + 1) AS lag
  FROM expecting
),
lines AS (SELECT *, "offset" + 1 AS next_offset FROM audited WHERE "offset" >= expected)
"""


def _keyed_sql(seconds: int = 3600) -> str:
    w = seconds * 1000
    return _LOG + f""",
keyed AS (
  SELECT *, ts_ms - ts_ms % {w} AS bucket_ms, arrival_ms - arrival_ms % {w} AS shift_ms,
    arrival_seq // 1048576 AS roll
  FROM lines
),
named AS (
  SELECT *, topic || '-' || "partition" || '-' || first_value("offset" + 1) OVER f || '.bm' AS file_name,
    first_value(arrival_ms) OVER f AS opened_ms
  FROM keyed WINDOW f AS (PARTITION BY topic, "partition", bucket_ms, shift_ms, roll ORDER BY arrival_seq)
)
"""


_BLOCKS = """,
runs AS (
  SELECT *, ts_ms // 1000 AS second, CASE WHEN lag(ts_ms // 1000) OVER f = ts_ms // 1000 THEN 0 ELSE 1 END AS fresh
  FROM named WINDOW f AS (PARTITION BY topic, "partition", bucket_ms, shift_ms, roll ORDER BY arrival_seq)
),
numbered AS (
  SELECT *, CAST(sum(fresh) OVER (PARTITION BY topic, "partition", bucket_ms, shift_ms, roll
    ORDER BY arrival_seq) - 1 AS BIGINT) AS block_number
  FROM runs
),
placed AS (
  SELECT *, row_number() OVER b - 1 AS idx, first_value(arrival_ms) OVER b AS create_time
  FROM numbered WINDOW b AS (PARTITION BY topic, "partition", bucket_ms, shift_ms, roll, block_number
    ORDER BY arrival_seq)
)
"""

_CONFIGS = """,
config AS (
  SELECT event_type AS id, max(event_id) AS version,
    '/service/' || (arg_max(user_id, event_id) % 3) || '/logs/%y%M%d/%H/' || event_type AS "hdfsRootDir",
    'u' || arg_max(user_id, event_id) AS "proxyUser", 'data' AS "defaultDirectory"
  FROM events WHERE event_type <> 'signup' GROUP BY event_type
)
"""
_ALL_CONFIGS = _CONFIGS.replace("WHERE event_type <> 'signup' ", "")


def _label(ms: str, fmt: str) -> str:
    return f"strftime(make_timestamp({ms} * 1000), '{fmt}')"


def _path(root: str, ms: str) -> str:
    return f"replace(replace({root}, '%y%M%d', {_label(ms, '%Y%m%d')}), '%H', {_label(ms, '%H')})"


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()} {select}"


# --- shared inputs -----------------------------------------------------------------------------


def _messages(spark, sf, cut=False):
    return messages(read_events(spark, sf), cut)


def _log(spark, sf, disturbed=True):
    return topic_log(read_events(spark, sf), disturbed)


def _audited(spark, sf):
    return of.offset_audit(_log(spark, sf))


def _decoded(spark, sf):
    return wire.decode(of.accepted_rows(_audited(spark, sf)), YEAR)


def _keyed(spark, sf, seconds=3600):
    return file_keys(wire.landable(_decoded(spark, sf)), seconds)


def _config_docs(spark, sf):
    """Every event read as one revision of its topic's configuration."""
    ev = read_events(spark, sf)
    doc = F.format_string(
        '{version: %d, id: "%s", hdfsRootDir: "/service/%d/logs/%%y%%M%%d/%%H/%s", proxyUser: "u%d", '
        'defaultDirectory: "data", filterSet: [ ]}',
        "event_id", "event_type", F.pmod(F.col("user_id"), F.lit(3)), "event_type", "user_id",
    )
    return ev.select(doc.alias("json"))


def _all_configs(spark, sf):
    return cf.topic_configs(_config_docs(spark, sf))


def _configs(spark, sf):
    """Configurations without one topic, so that joins meet an unconfigured one."""
    return stored(_all_configs(spark, sf).filter(F.col("id") != UNCONFIGURED), "configs")


def _partitions(spark, sf):
    return stored(_messages(spark, sf).select(*TP).distinct(), "partitions")


def _ledger(spark, sf, **options):
    lines = _decoded(spark, sf)
    return lg.shift_ledger(lines, lg.shift_spine(_log(spark, sf), until_ms=AS_OF_MS), AS_OF_MS, **options)


def _stored(spark, sf):
    """Current ledger without the one partition that never stored a row."""
    current = lg.current_ledger(_ledger(spark, sf, final_only=True)).filter("NOT (topic = 'view' AND partition = 3)")
    return stored(current, "ledger")


def _flags(spark, sf):
    """Hours already flagged: those in which a topic received an even number of messages."""
    hours = _messages(spark, sf).groupBy("topic", time_bucket(F.col("arrival_ms"), 3600).alias("hour_ms"))
    return stored(hours.agg(F.count("*").alias("n")).filter("n % 2 = 0").select("topic", "hour_ms"), "flags")


_STORED = """,
ends AS (SELECT topic, "partition", min(arrival_ms) - min(arrival_ms) % 3600000 AS first_shift,
    max(arrival_ms) AS last_arrival FROM log GROUP BY ALL),
spine AS (
  SELECT topic, "partition", unnest(generate_series(first_shift,
      greatest(last_arrival, 1706661000000) - greatest(last_arrival, 1706661000000) % 3600000,
      3600000)) AS shift_start, first_shift
  FROM ends
),
totals AS (
  SELECT topic, "partition", arrival_ms - arrival_ms % 3600000 AS shift_start,
    arg_max(next_offset, arrival_seq) AS next_offset, max(ts_ms) AS max_ts_ms, count(*) AS consumed
  FROM lines GROUP BY ALL
),
ledger AS (
  SELECT s.topic, s."partition", (s.shift_start - s.first_shift) // 3600000 + 1 AS shift, s.shift_start,
    s.shift_start + 3600000 AS shift_end,
    coalesce(last_value(t.next_offset IGNORE NULLS) OVER (PARTITION BY s.topic, s."partition"
      ORDER BY s.shift_start ROWS UNBOUNDED PRECEDING), 0) AS next_offset,
    coalesce(t.max_ts_ms, -1) AS max_ts_ms,
    CASE WHEN t.max_ts_ms IS NULL THEN s.shift_start + 3600000
      ELSE least(t.max_ts_ms, 1706661000000) END AS offset_ts_ms,
    coalesce(t.consumed, 0) AS consumed
  FROM spine s LEFT JOIN totals t USING (topic, "partition", shift_start)
),
final AS (SELECT * FROM ledger WHERE 1706661000000 >= shift_end + 30000),
stored AS (
  SELECT * FROM final WHERE NOT (topic = 'view' AND "partition" = 3)
  QUALIFY row_number() OVER (PARTITION BY topic, "partition" ORDER BY shift_start DESC) = 1
)
"""

_FLAGS = """,
flags AS (SELECT topic, arrival_ms - arrival_ms % 3600000 AS hour_ms FROM msg GROUP BY ALL HAVING count(*) % 2 = 0)
"""

_WATER = """,
water AS (
  SELECT p.topic, CASE WHEN count(*) = count(s.offset_ts_ms) THEN min(s.offset_ts_ms) END AS low_water_ms,
    count(*) AS partitions, count(s.offset_ts_ms) AS reporting
  FROM (SELECT DISTINCT topic, "partition" FROM msg) p LEFT JOIN stored s USING (topic, "partition") GROUP BY p.topic
)
"""

_DUE = _STORED + _FLAGS + _WATER + _CONFIGS + f""",
hours AS (SELECT 1706659200000 - 3600000 * i AS hour_ms FROM generate_series(1, 24) g(i)),
due AS (
  SELECT w.topic, h.hour_ms, c."hdfsRootDir", c."defaultDirectory"
  FROM water w JOIN config c ON c.id = w.topic JOIN hours h ON h.hour_ms < w.low_water_ms
  WHERE NOT EXISTS (SELECT 1 FROM flags f WHERE f.topic = w.topic AND f.hour_ms = h.hour_ms)
)
"""


# --- decode ------------------------------------------------------------------------------------


@query(_with(_EV_CUT, "SELECT event_id, coalesce(pri, -1) AS pri, coalesce(pri // 8, -1) AS facility, "
                  "coalesce(pri % 8, -1) AS severity FROM dec"))
def decode_pri(spark, sf):
    out = wire.decode(_messages(spark, sf, cut=True), YEAR)
    return out.select("event_id", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("pri", "facility", "severity")])


@query(_with(_EV_CUT, "SELECT event_id, coalesce(rfc_version, -1) AS rfc_version, "
                  "CASE WHEN shape = 8 THEN 0 ELSE -1 END AS enc_version FROM dec"))
def decode_version(spark, sf):
    out = wire.decode(_messages(spark, sf, cut=True), YEAR)
    return out.select("event_id", F.coalesce("rfc_version", F.lit(-1)).alias("rfc_version"), "enc_version")


@query(_with(_EV_CUT, "SELECT event_id, coalesce(parsed_ms, -1) AS parsed_ms, CAST(CASE WHEN shape <= 4 THEN 28 "
                  "WHEN shape = 5 THEN 19 WHEN shape = 6 THEN 15 ELSE 0 END AS INTEGER) AS stamp_len FROM dec"))
def decode_timestamp(spark, sf):
    out = wire.decode(_messages(spark, sf, cut=True), YEAR)
    return out.select("event_id", F.coalesce("parsed_ms", F.lit(-1)).alias("parsed_ms"), "stamp_len")


_DAMAGED = """
damaged AS (
  SELECT event_id, event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", CAST(event_id % 8 AS INTEGER) AS kind,
    (epoch_us(ts) // 1000) AS ms, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, event_id % 192 AS n, 2 + event_id % 998 AS v, props
  FROM events
),
told AS (
  SELECT *, ms + 5000 AS arrival_ms, CASE WHEN kind IN (0, 5, 6, 7) THEN n ELSE -1 END AS pri,
    CASE WHEN kind IN (0, 5) THEN v WHEN kind = 6 THEN 1 ELSE -1 END AS rfc_version,
    CASE WHEN kind = 3 THEN 1 WHEN kind IN (4, 5) THEN 0 ELSE -1 END AS enc_version,
    CASE WHEN kind IN (0, 5) THEN ms - ms % 1000 ELSE -1 END AS parsed_ms,
    CASE WHEN kind = 4 THEN 'short_envelope' WHEN kind = 6 THEN 'truncated_ts' ELSE 'ok' END AS decode_status,
    CASE WHEN kind IN (0, 5) THEN 'parsed' ELSE 'now' END AS ts_source,
    CASE kind WHEN 1 THEN '<200>1 ' || iso || 'Z ' || props WHEN 2 THEN '<01>' || props WHEN 4 THEN '' WHEN 6 THEN substr(iso, 1, 12)
      WHEN 3 THEN '<' || n || '>' || v || ' ' || iso || 'Z ' || props ELSE props END AS body
  FROM damaged
)
"""


@query(_with(_DAMAGED, """SELECT event_id, CAST(pri AS INTEGER) AS pri, CAST(rfc_version AS INTEGER) AS rfc_version, enc_version, parsed_ms,
    decode_status, ts_source, body FROM told"""))
def decode_damaged(spark, sf):
    """Bad priorities, other envelopes, short envelopes, versions up to 999, cut stamps."""
    out = wire.decode(damaged_messages(read_events(spark, sf)), YEAR)
    none = [F.coalesce(c, F.lit(-1)).alias(c) for c in ("pri", "rfc_version", "parsed_ms")]
    # After an envelope of another version the body starts with its two bytes.
    skip = F.when(F.col("enc_version") == 1, 3).otherwise(1)
    body = wire.body_text(F.substring(F.col("body"), skip, F.lit(2**31 - 1)))
    return out.select("event_id", *none, "enc_version", "decode_status", "ts_source", body.alias("body"))


@query(_with(_DAMAGED, """SELECT topic, count(*) FILTER (ts_source = 'now') AS timestamp_errors,
    count(*) FILTER (kind IN (1, 2)) AS pri_errors FROM told GROUP BY topic"""))
def parse_errors_damaged(spark, sf):
    return rp.parse_errors(wire.decode(damaged_messages(read_events(spark, sf)), YEAR))


@query(_with(_DAMAGED, """SELECT *, CASE WHEN seconds > 0 THEN consumed // seconds ELSE -1 END AS lines_per_second FROM (
    SELECT topic, "partition", count(*) AS consumed, count(*) FILTER (decode_status <> 'short_envelope') AS written,
      (1706661000000 - min(arrival_ms)) // 1000 AS seconds FROM told GROUP BY ALL)"""))
def partition_rate_damaged(spark, sf):
    """Consumed and written lines differ by the messages dropped for a short envelope."""
    decoded = wire.decode(damaged_messages(read_events(spark, sf)), YEAR)
    return rp.consume_rate(decoded, AS_OF_MS).withColumn("lines_per_second", F.coalesce("lines_per_second", F.lit(-1)))


def _layout(spark, sf, text):
    """Decode one timestamp layout rendered for every event."""
    ev = read_events(spark, sf)
    rows = ev.select("event_id", F.encode(text, "UTF-8").alias("value"), F.lit(0).cast("long").alias("arrival_ms"))
    return wire.decode(rows, YEAR).select("event_id", "parsed_ms", wire.body_text(F.col("body")).alias("body"))


def _wall(ts="ts"):
    return F.col(ts).cast("string")


@query("SELECT event_id, (epoch_us(ts) // 1000) - (epoch_us(ts) // 1000) % 1000 AS parsed_ms, props AS body FROM events")
def decode_timestamp_iso(spark, sf):
    digits = F.regexp_replace(F.substring(_wall(), 1, 19), "[^0-9]", "")
    return _layout(spark, sf, F.concat(digits, F.lit(" "), "props"))


@query("SELECT event_id, (epoch_us(ts) // 1000) - (epoch_us(ts) // 1000) % 1000 AS parsed_ms, ' ' || props AS body FROM events")
def decode_timestamp_syslog(spark, sf):
    month = F.substring(F.lit(wire.MONTHS), (F.month("ts") - 1) * 3 + 1, F.lit(3))
    day = F.lpad(F.dayofmonth("ts").cast("string"), 2, "0")
    return _layout(spark, sf, F.concat(month, F.lit("_"), day, F.lit(" "), F.substring(_wall(), 12, 8), F.lit("  "), "props"))


@query("""SELECT event_id, (epoch_us(ts) // 1000) - (epoch_us(ts) // 1000) % 1000
    - (CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END) * ((event_id % 14) * 3600000 + (user_id % 60) * 60000) AS parsed_ms,
    props AS body FROM events""")
def decode_zone(spark, sf):
    sign = F.when(F.col("event_id") % 2 == 0, "+").otherwise("-")
    hours = F.lpad((F.col("event_id") % 14).cast("string"), 2, "0")
    minutes = F.lpad((F.col("user_id") % 60).cast("string"), 2, "0")
    colon = F.when(F.col("event_id") % 3 == 0, ":").otherwise("")
    return _layout(spark, sf, F.concat(F.substring(_wall(), 1, 19), sign, hours, colon, minutes, F.lit(" "), "props"))


@query("""SELECT event_id, (epoch_us(ts) // 1000) - (epoch_us(ts) // 1000) % 1000 + CASE CAST(event_id % 7 AS INTEGER) WHEN 0 THEN 0
    WHEN 1 THEN (epoch_us(ts) % 1000000) // 100000 * 100 WHEN 2 THEN (epoch_us(ts) % 1000000) // 10000 * 10
    ELSE (epoch_us(ts) % 1000000) // 1000 END AS parsed_ms, props AS body FROM events""")
def decode_fraction(spark, sf):
    micros = F.rpad(F.substring(_wall(), 21, 6), 6, "0")
    digits = F.substring(micros, F.lit(1), (F.col("event_id") % 7).cast("int"))
    return _layout(spark, sf, F.concat(F.substring(_wall(), 1, 19), F.lit("."), digits, F.lit(" "), "props"))


@query("""SELECT event_id, epoch_ms(make_timestamp(CAST(2023 + (k + 11) // 12 AS INTEGER), CAST((k + 11) % 12 + 1 AS INTEGER), 1, 0, 0, 0))
    + (k - 1) * 86400000 + k * 3661000 AS parsed_ms, props AS body FROM (SELECT *, event_id % 100 AS k FROM events)""")
def decode_calendar_roll(spark, sf):
    two = F.lpad((F.col("event_id") % 100).cast("string"), 2, "0")
    return _layout(spark, sf, F.concat(F.lit("2024-"), two, F.lit("-"), two, F.lit("T"), two, F.lit(":"), two, F.lit(":"), two, F.lit(" "), "props"))


@query(_with(_EV_CUT, "SELECT event_id, ts_source, ts_ms FROM dec"))
def timestamp_source(spark, sf):
    return wire.decode(_messages(spark, sf, cut=True), YEAR).select("event_id", "ts_source", "ts_ms")


@query(_with(_EV_CUT, "SELECT event_id, body, true AS utf8, topic || '-' || \"partition\" AS pid FROM dec"))
def body_slice(spark, sf):
    body = F.col("body")
    return wire.decode(_messages(spark, sf, cut=True), YEAR).select(
        "event_id", wire.body_text(body).alias("body"), wire.body_is_utf8(body).alias("utf8"),
        wire.partition_id(F.col("topic"), F.col("partition")).alias("pid"),
    )


@query(_with(_EV_CUT, "SELECT topic, decode_status, count(*) AS lines, CAST(sum(strlen(body)) AS BIGINT) AS body_bytes "
                  "FROM dec GROUP BY ALL"))
def decode_status(spark, sf):
    return wire.decode(_messages(spark, sf, cut=True), YEAR).groupBy("topic", "decode_status").agg(
        F.count("*").alias("lines"), F.sum(F.length("body")).alias("body_bytes"))


@query("SELECT doc_id, text AS body, strlen(text) AS body_bytes FROM documents")
def decode_documents(spark, sf):
    """Whole long texts behind an envelope: multi-byte characters and line breaks survive the slice."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = F.concat(F.lit("<13>1 2024-05-07T17:05:08.123Z "), "text")
    raw = F.concat(F.unhex(F.lit("FE000000018F00000000")), F.encode(text, "UTF-8"))
    rows = docs.select("doc_id", raw.alias("value"), F.lit(0).cast("long").alias("arrival_ms"))
    return wire.decode(rows, YEAR).select(
        "doc_id", wire.body_text(F.col("body")).alias("body"), F.length("body").cast("long").alias("body_bytes"))


# --- offsets -----------------------------------------------------------------------------------


@query(_with(_LOG, "SELECT event_id, \"offset\", arrival_seq, body FROM log "
                   "WHERE topic = 'click' AND \"partition\" = 2 AND \"offset\" BETWEEN 10 AND 1000000000"))
def range_scan(spark, sf):
    rows = of.range_scan(_log(spark, sf), "click", 2, 10, 1_000_000_000)
    return wire.decode(rows, YEAR).select("event_id", "offset", "arrival_seq", wire.body_text(F.col("body")).alias("body"))


def _overrides(spark, sf):
    """Two partitions of every topic ask to go back to their first purchase-sized value."""
    ev = read_events(spark, sf).select(F.col("event_type").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), "event_id")
    return ev.groupBy(*TP).agg(F.min("event_id").alias("offset_override")).filter("partition >= 2")


_RESUME = _LOG + _STORED + """,
overrides AS (SELECT topic, "partition", min(event_id) AS offset_override FROM msg GROUP BY ALL HAVING "partition" >= 2),
resume AS (
  SELECT p.topic, p."partition", coalesce(s.next_offset, -1) AS stored_offset,
    CASE WHEN s.next_offset IS NULL THEN 0 ELSE coalesce(o.offset_override, s.next_offset) END AS resume_offset,
    s.next_offset IS NOT NULL AND o.offset_override IS NOT NULL AS override_consumed
  FROM (SELECT DISTINCT topic, "partition" FROM msg) p
  LEFT JOIN stored s USING (topic, "partition") LEFT JOIN overrides o USING (topic, "partition")
)
"""


@query(_with(_RESUME, "SELECT * FROM resume"))
def resume_offsets(spark, sf):
    out = of.resume_offsets(_partitions(spark, sf), _stored(spark, sf), _overrides(spark, sf))
    return out.withColumn("stored_offset", F.coalesce("stored_offset", F.lit(-1)))


@query(_with(_RESUME, """SELECT topic, "partition", resume_offset, resume_offset + 40 < earliest OR resume_offset + 40 > latest AS was_reset,
    CASE WHEN resume_offset + 40 < earliest THEN earliest WHEN resume_offset + 40 > latest THEN earliest ELSE resume_offset + 40 END AS start_offset
    FROM (SELECT topic, "partition", resume_offset, min(l."offset") AS earliest, max(l.high_watermark) AS latest
      FROM resume JOIN log l USING (topic, "partition") GROUP BY ALL)"""))
def offset_reset(spark, sf):
    resume = of.resume_offsets(_partitions(spark, sf), _stored(spark, sf), _overrides(spark, sf))
    ahead = resume.withColumn("resume_offset", F.col("resume_offset") + 40)
    out = of.reset_out_of_range(ahead, of.log_bounds(_log(spark, sf)), "smallest")
    return out.select(*TP, (F.col("resume_offset") - 40).alias("resume_offset"), "was_reset", "start_offset")


@query(_with(_RESUME, """SELECT topic, "partition", resume_offset, resume_offset + 40 < earliest OR resume_offset + 40 > latest AS was_reset,
    CASE WHEN resume_offset + 40 < earliest OR resume_offset + 40 > latest THEN latest ELSE resume_offset + 40 END AS start_offset
    FROM (SELECT topic, "partition", resume_offset, min(l."offset") AS earliest, max(l.high_watermark) AS latest
      FROM resume JOIN log l USING (topic, "partition") GROUP BY ALL)"""))
def offset_reset_largest(spark, sf):
    resume = of.resume_offsets(_partitions(spark, sf), _stored(spark, sf), _overrides(spark, sf))
    ahead = resume.withColumn("resume_offset", F.col("resume_offset") + 40)
    out = of.reset_out_of_range(ahead, of.log_bounds(_log(spark, sf)), "largest")
    return out.select(*TP, (F.col("resume_offset") - 40).alias("resume_offset"), "was_reset", "start_offset")


@query(_with(_RESUME, """SELECT topic, "partition", count(*) AS messages, min("offset") AS first_offset
    FROM log JOIN resume USING (topic, "partition") WHERE "offset" >= resume_offset GROUP BY ALL"""))
def scan_from_resume(spark, sf):
    resume = of.resume_offsets(_partitions(spark, sf), _stored(spark, sf), _overrides(spark, sf))
    start = resume.withColumnRenamed("resume_offset", "start_offset")
    return tl.scan_from(_log(spark, sf), start).groupBy(*TP).agg(
        F.count("*").alias("messages"), F.min("offset").alias("first_offset"))


@query(_with(_LOG, """SELECT topic, "partition", "offset", arrival_seq, expected, status, gap, lag,
    "offset" >= expected AS accepted, CASE WHEN "offset" >= expected THEN "offset" + 1 ELSE expected END AS next_offset FROM audited"""))
def offset_audit(spark, sf):
    return _audited(spark, sf).select(
        *TP, "offset", "arrival_seq", "expected", "status", "gap", "lag", "accepted", "next_offset")


@query(_with(_LOG, """SELECT topic, "partition", count(*) FILTER (status = 'early') AS early FROM audited GROUP BY ALL"""))
def early_offsets(spark, sf):
    return rp.early_counts(_audited(spark, sf))


@query(_with(_LOG, """SELECT topic, "partition", expected AS missing_from, "offset" - 1 AS missing_to, gap FROM audited WHERE status = 'gap'"""))
def offset_gaps(spark, sf):
    return of.missing_ranges(_audited(spark, sf))


@query(_with(_LOG, """SELECT topic, "partition", count(*) FILTER (status = 'gap') AS gaps, CAST(sum(gap) AS BIGINT) AS missing FROM audited GROUP BY ALL"""))
def gap_counts(spark, sf):
    return rp.gap_counts(_audited(spark, sf))


@query(_with(_LOG, """SELECT topic, "partition", arrival_seq, next_offset, lag FROM lines"""))
def offset_lag(spark, sf):
    return of.accepted_rows(_audited(spark, sf)).select(*TP, "arrival_seq", "next_offset", "lag")


@query(_with(_EV, """SELECT topic, "partition", count(*) AS messages, count(*) AS next_offset FROM dec GROUP BY ALL"""))
def strict_scan(spark, sf):
    rows = of.strict_offsets(of.offset_audit(_log(spark, sf, disturbed=False)))
    return rows.groupBy(*TP).agg(F.count("*").alias("messages"), F.max("next_offset").alias("next_offset"))


_SINK = _LOG + """,
ordered AS (SELECT topic, "partition", "offset" AS o, high_watermark AS h, arrival_seq,
  row_number() OVER (PARTITION BY topic, "partition" ORDER BY arrival_seq) AS n FROM log),
walk AS (
  SELECT topic, "partition", n, arrival_seq, o, h, CAST(0 AS BIGINT) AS expected FROM ordered WHERE n = 1
  UNION ALL
  SELECT r.topic, r."partition", r.n, r.arrival_seq, r.o, r.h,
    CASE WHEN w.expected <= w.o THEN w.o + 1 WHEN w.expected > w.h THEN w.h ELSE w.expected END
  FROM walk w JOIN ordered r ON r.topic = w.topic AND r."partition" = w."partition" AND r.n = w.n + 1
)
"""


@query("WITH RECURSIVE " + _SINK.strip() + """ SELECT topic, "partition", o AS "offset", arrival_seq, expected,
    CASE WHEN o > expected THEN 'gap' WHEN o = expected THEN 'ok' WHEN expected < h THEN 'early'
      WHEN expected = h THEN 'at_hw' ELSE 'beyond_hw' END AS status FROM walk""")
def sink_to_watermark(spark, sf):
    return of.sink_to_high_watermark(_log(spark, sf)).select(*TP, "offset", "arrival_seq", "expected", "status")


# --- configuration, buckets, files -------------------------------------------------------------


@query(_with(_ALL_CONFIGS[1:], 'SELECT id, version, "hdfsRootDir", "proxyUser", "defaultDirectory" FROM config'))
def topic_config_latest(spark, sf):
    return _all_configs(spark, sf).drop("filterSet")


@query(_with(_ALL_CONFIGS[1:], """SELECT root, count(*) AS topics FROM (SELECT regexp_replace("hdfsRootDir", '/%.*$', '') AS root FROM config) GROUP BY root"""))
def unique_roots(spark, sf):
    return cf.unique_roots(_all_configs(spark, sf))


@query(_with(_LOG + _CONFIGS, """SELECT topic, "partition", count(*) AS lines FROM lines JOIN config ON id = topic GROUP BY ALL"""))
def config_join(spark, sf):
    return cf.configured(_decoded(spark, sf), _configs(spark, sf)).groupBy(*TP).agg(F.count("*").alias("lines"))


@query(_with(_LOG, """SELECT topic, "partition", "offset", ts_ms - ts_ms % 3600000 AS bucket_ms,
    arrival_ms - arrival_ms % 900000 AS shift_ms FROM lines"""))
def event_bucket(spark, sf):
    return _decoded(spark, sf).select(
        *TP, "offset", time_bucket(F.col("ts_ms"), 3600).alias("bucket_ms"),
        time_bucket(F.col("arrival_ms"), 900).alias("shift_ms"))


@query(_with(_LOG, """SELECT topic, "partition", arrival_seq, ((arrival_ms - arrival_ms % 3600000)
    - (first_ms - first_ms % 3600000)) // 3600000 + 1 AS shift
    FROM (SELECT *, min(arrival_ms) OVER (PARTITION BY topic, "partition") AS first_ms FROM log)"""))
def shift_number(spark, sf):
    log = _log(spark, sf)
    return lg.shift_number(log, stored(lg.first_shifts(log), "firsts")).select(*TP, "arrival_seq", "shift")


_SKEW = """SELECT *, bucket_ms > opened_ms + 600000 OR bucket_ms < opened_ms - 7200000 AS skewed FROM named"""


def _skewed(spark, sf, **extra):
    return skew(_keyed(spark, sf), future_s=600, past_s=7200, **extra)


@query(_with(_keyed_sql(), f"""SELECT topic, "partition", "offset", skewed FROM ({_SKEW})"""))
def skew_flag(spark, sf):
    return _skewed(spark, sf).select(*TP, "offset", "skewed")


@query(_with(_keyed_sql(), f"""SELECT topic, "partition", "offset", CASE WHEN skewed THEN 'late_' ELSE '' END AS file_prefix,
    CASE WHEN skewed THEN 'skewed' ELSE 'data' END AS data_dir, CASE WHEN skewed THEN opened_ms ELSE bucket_ms END AS dir_ms FROM ({_SKEW})"""))
def skew_relocate(spark, sf):
    out = _skewed(spark, sf, prefix="late_", data_dir="skewed", dir_to_now=True)
    return out.select(*TP, "offset", "file_prefix", F.coalesce("data_dir", F.lit("data")).alias("data_dir"), "dir_ms")


@query(_with(_keyed_sql(), f"""SELECT coalesce(topic, '*') AS topic, coalesce("partition", -1) AS "partition",
    CASE GROUPING(topic, "partition") WHEN 0 THEN 'partition' WHEN 1 THEN 'topic' ELSE 'total' END AS level, count(*) AS files
    FROM (SELECT DISTINCT topic, "partition", bucket_ms, shift_ms, roll FROM ({_SKEW}) WHERE skewed)
    GROUP BY ROLLUP (topic, "partition")"""))
def skewed_files(spark, sf):
    return rp.skewed_files(_skewed(spark, sf)).withColumns(
        {"topic": F.coalesce("topic", F.lit("*")), "partition": F.coalesce("partition", F.lit(-1))})


@query(_with(_keyed_sql() + _CONFIGS, f"""SELECT topic, "partition", "offset",
    {_path('''"hdfsRootDir" || '/' || CASE WHEN skewed THEN 'skewed' ELSE "defaultDirectory" END''', 'CASE WHEN skewed THEN opened_ms ELSE bucket_ms END')} AS path
    FROM ({_SKEW}) JOIN config ON id = topic"""))
def path_render(spark, sf):
    lines = _skewed(spark, sf, data_dir="skewed", dir_to_now=True)
    return cf.render_paths(lines, _configs(spark, sf)).select(*TP, "offset", "path")


@query(_with(_keyed_sql(), """SELECT topic, "partition", bucket_ms, shift_ms, roll, file_name, count(*) AS lines FROM named GROUP BY ALL"""))
def file_names(spark, sf):
    return _keyed(spark, sf).groupBy(*FILE_KEY, "file_name").agg(F.count("*").alias("lines"))


# --- blocks and containers ---------------------------------------------------------------------


@query(_with(_keyed_sql() + _BLOCKS, """SELECT topic, "partition", bucket_ms, shift_ms, roll, file_name, block_number, second,
    min(create_time) AS create_time, count(*) AS lines, string_agg(ts_ms % 1000 || ':' || body, '|' ORDER BY arrival_seq) AS content
    FROM placed GROUP BY topic, "partition", bucket_ms, shift_ms, roll, file_name, block_number, second"""))
def log_blocks(spark, sf):
    out = bl.log_blocks(_keyed(spark, sf), keep=["file_name"])
    content = F.array_join(F.transform("log_lines", lambda x: F.concat_ws(
        ":", x["ms"].cast("string"), wire.body_text(x["message"]))), "|")
    return out.select(*FILE_KEY, "file_name", "block_number", "second", "create_time",
                      F.size("log_lines").cast("long").alias("lines"), content.alias("content"))


def _document_lines(spark, sf):
    """Documents as lines: long bodies that fall into few seconds, so seconds outgrow a block."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    second = (F.col("doc_id") - F.col("doc_id") % 64) / 64
    return docs.select(
        F.lit("documents").alias("topic"), F.lit(0).alias("partition"), F.col("doc_id").alias("arrival_seq"),
        F.col("doc_id").alias("arrival_ms"), (second.cast("long") * 1000 + F.col("doc_id") % 1000).alias("ts_ms"),
        F.encode("text", "UTF-8").alias("body"),
        ((F.col("doc_id") - F.col("doc_id") % 4096) / 4096).cast("long").alias("roll"),
    )


def _varint_sql(n: str) -> str:
    return f"CASE WHEN {n} < 64 THEN 1 WHEN {n} < 8192 THEN 2 WHEN {n} < 1048576 THEN 3 ELSE 4 END"


@query(f"""WITH RECURSIVE line AS (
    SELECT doc_id, doc_id // 4096 AS roll, doc_id // 64 AS second, strlen(text) AS size, doc_id % 1000 AS ms FROM documents),
  costed AS (SELECT *, size + {_varint_sql('size')} + {_varint_sql('((second * 1000 + ms) % 1000)')} AS cost,
    row_number() OVER (PARTITION BY roll, ((second * 1000 + ms) // 1000) ORDER BY doc_id) AS n, (second * 1000 + ms) // 1000 AS run FROM line),
  walk AS (
    SELECT roll, run, n, doc_id, size, cost AS used, CAST(0 AS BIGINT) AS part FROM costed WHERE n = 1
    UNION ALL
    SELECT c.roll, c.run, c.n, c.doc_id, c.size,
      CASE WHEN {CAP_SMALL} - w.used < 20 + c.size THEN c.cost ELSE w.used + c.cost END,
      CASE WHEN {CAP_SMALL} - w.used < 20 + c.size THEN w.part + 1 ELSE w.part END
    FROM walk w JOIN costed c ON c.roll = w.roll AND c.run = w.run AND c.n = w.n + 1)
  SELECT roll, row_number() OVER (PARTITION BY roll ORDER BY run, part) - 1 AS block_number, run AS second, create_time, lines, bytes
  FROM (SELECT roll, run, part, min(doc_id) AS create_time, count(*) AS lines, CAST(sum(size) AS BIGINT) AS bytes FROM walk GROUP BY ALL)""")
def block_split(spark, sf):
    out = bl.log_blocks(_document_lines(spark, sf), ["roll"], cap_bytes=CAP_SMALL)
    bytes_ = F.aggregate("log_lines", F.lit(0).cast("long"), lambda a, x: a + F.length(x["message"]))
    return out.select("roll", "block_number", "second", "create_time",
                      F.size("log_lines").cast("long").alias("lines"), bytes_.alias("bytes"))


@query(_with(_keyed_sql() + _BLOCKS, """SELECT ts_ms, create_time, block_number, CAST(idx AS INTEGER) AS idx, file_name AS file, body
    FROM placed ORDER BY ts_ms, create_time, block_number, idx, file_name"""))
def canonical_order(spark, sf):
    blocks = bl.log_blocks(_keyed(spark, sf), keep=["file_name"]).withColumnRenamed("file_name", "file")
    out = bl.canonical_order(bl.explode_blocks(blocks, ["file"]))
    return out.select("ts_ms", "create_time", "block_number", "idx", "file", wire.body_text(F.col("message")).alias("body"))


def _files(spark, sf, seconds=86_400):
    return _keyed(spark, sf, seconds).withColumn(
        "file", F.concat_ws("/", render_template("%y%M%d", F.col("bucket_ms")), "topic", "file_name"))


@query(_with(_keyed_sql(86_400) + _BLOCKS, f"""SELECT {_label('bucket_ms', '%Y%m%d')} || '/' || topic || '/' || file_name AS file,
    block_number, CAST(idx AS INTEGER) AS idx, second, create_time, ts_ms, body FROM placed"""))
def container_roundtrip(spark, sf):
    """Lines written to deflated container files in day folders and read back."""
    root = shared_dir(spark, "containers")
    boxes.write_lines(_files(spark, sf), root)
    out = boxes.read_lines(spark, root)
    name = F.regexp_extract("file", r"([^/]*/[^/]*/[^/]*)$", 1)
    return out.select(name.alias("file"), "block_number", "idx", "second", "create_time", "ts_ms",
                      wire.body_text(F.col("message")).alias("body"))


@query(_with(_keyed_sql(86_400) + _BLOCKS, f"""SELECT {_label('bucket_ms', '%Y%m%d')} || '/' || topic || '/' || file_name AS file,
    block_number, CAST(idx AS INTEGER) AS idx, ts_ms, body FROM placed
    WHERE bucket_ms BETWEEN 1704412800000 AND 1704585600000"""))
def container_days(spark, sf):
    """Three days of a landed tree: only their folders are listed and opened."""
    root = shared_dir(spark, "days")
    boxes.write_lines(_files(spark, sf), root)
    out = boxes.read_folders(spark, root, "%y%M%d", 1_704_412_800_000, 1_704_585_600_000, 86_400)
    name = F.regexp_extract("file", r"([^/]*/[^/]*/[^/]*)$", 1)
    return out.select(name.alias("file"), "block_number", "idx", "ts_ms", wire.body_text(F.col("message")).alias("body"))


@query(_with(_keyed_sql(86_400), f"""SELECT topic, {_label('bucket_ms', '%Y-%m-%d')} AS day, CAST({_label('bucket_ms', '%H')} AS INTEGER) AS hour,
    count(*) AS lines, CAST(sum(strlen(body)) AS BIGINT) AS body_bytes FROM named GROUP BY ALL"""))
def partitioned_dataset(spark, sf):
    """Columnar copy in topic, day and hour folders (day-long buckets), summed up from the files."""
    root = shared_dir(spark, "dataset")
    lines = _keyed(spark, sf, 86_400).select(*TP, "offset", "arrival_seq", "bucket_ms", "ts_ms", "body")
    datasets.write_dataset(lines, root)
    back = datasets.read_dataset(spark, root)
    return back.groupBy("topic", F.col("day").cast("string").alias("day"), "hour").agg(
        F.count("*").alias("lines"), F.sum(F.length("body")).alias("body_bytes"))


@query(_with(_keyed_sql(86_400) + _BLOCKS + f""",
costs AS (
  SELECT topic, "partition", bucket_ms, shift_ms, roll, block_number, any_value(second) AS second,
    first(create_time) AS create_time, count(*) AS n,
    sum({'CASE WHEN ts_ms % 1000 < 64 THEN 1 ELSE 2 END'} + CASE WHEN strlen(body) < 64 THEN 1 ELSE 2 END + strlen(body)) AS line_bytes
  FROM placed GROUP BY topic, "partition", bucket_ms, shift_ms, roll, block_number
)""", """SELECT topic, count(*) AS blocks, CAST(sum(n) AS BIGINT) AS lines,
    CAST(sum(line_bytes + 5 + 6 + CASE WHEN block_number < 64 THEN 1 WHEN block_number < 8192 THEN 2 ELSE 3 END
      + CASE WHEN n < 64 THEN 1 ELSE 2 END + 1) AS BIGINT) AS raw_bytes FROM costs GROUP BY topic"""))
def raw_bytes_by_topic(spark, sf):
    """Uncompressed container bytes: every header, line and terminator of the format is accounted for."""
    lines = _files(spark, sf)
    blocks = bl.log_blocks(lines, keep=["file"])
    sizes = boxes.containers(blocks, "file", FILE_KEY).groupBy(
        F.regexp_extract("file", r"([^/]*)-\d+-\d+\.bm$", 1).alias("topic")
    ).agg(F.sum("records").alias("blocks"), F.sum(F.length("raw").cast("long")).alias("raw_bytes"))
    counts = blocks.groupBy("topic").agg(F.sum(F.size("log_lines")).alias("lines"))
    return sizes.join(counts, "topic").select("topic", "blocks", "lines", "raw_bytes")


_BOXES = _keyed_sql(86_400) + _BLOCKS + """,
sized AS (
  SELECT topic, "partition", bucket_ms, shift_ms, roll, block_number, count(*) AS n,
    sum(CASE WHEN ts_ms % 1000 < 64 THEN 1 ELSE 2 END + CASE WHEN strlen(body) < 64 THEN 1 ELSE 2 END + strlen(body)) AS line_bytes
  FROM placed GROUP BY ALL
),
records AS (
  SELECT *, line_bytes + 5 + 6 + CASE WHEN block_number < 64 THEN 1 WHEN block_number < 8192 THEN 2 ELSE 3 END
    + CASE WHEN n < 64 THEN 1 ELSE 2 END + 1 AS size FROM sized
),
boxed AS (
  SELECT *, (sum(size) OVER (PARTITION BY topic, "partition", bucket_ms, shift_ms, roll ORDER BY block_number) - size) // 2097152 AS box
  FROM records
),
boxes AS (
  SELECT topic, raw, raw + 5 * ((raw + 65534) // 65535) AS packed FROM (
    SELECT topic, sum(size)::BIGINT AS raw FROM boxed GROUP BY topic, "partition", bucket_ms, shift_ms, roll, box)
)
"""


def _landed_stats(spark, sf):
    """Container statistics of files landed with stored (level 0) blocks, whose size SQL can tell."""
    root = shared_dir(spark, "sizes")
    boxes.write_lines(_files(spark, sf), root, level=0)
    return rp.with_topic(boxes.read_container_stats(spark, root))


@query(_with(_BOXES, """SELECT topic, sum(packed)::BIGINT AS bytes, sum(raw)::BIGINT AS raw_bytes, count(*) AS containers,
    CAST(GROUPING(topic) AS INTEGER) AS is_total FROM boxes GROUP BY ROLLUP (topic)"""))
def bytes_by_topic(spark, sf):
    return rp.bytes_written(_landed_stats(spark, sf))


@query(_with(_BOXES, """SELECT topic, CAST(GROUPING(topic) AS INTEGER) AS is_total, count(*) AS containers, min(pct) AS min_pct,
    quantile_disc(pct, 0.05) AS p05_pct, quantile_disc(pct, 0.5) AS p50_pct, quantile_disc(pct, 0.95) AS p95_pct, max(pct) AS max_pct
    FROM (SELECT topic, CAST(floor(100.5::DOUBLE - 100.0::DOUBLE * packed / raw) AS BIGINT) AS pct FROM boxes) GROUP BY ROLLUP (topic)"""))
def compression_pct(spark, sf):
    return rp.compression_pct(_landed_stats(spark, sf))


def _manifest_tree(spark, sf, level):
    root = shared_dir(spark, "manifest")
    mf.write_lines(_files(spark, sf), root, level=level, key="landing")
    return root


@query(ORACLES["bytes_by_topic"])
def manifest_bytes(spark, sf):
    """Sizes from the side files that the writers' tasks left; no container is opened."""
    root = _manifest_tree(spark, sf, 0)
    mf.write_lines(_files(spark, sf), root, level=0, key="landing")        # the same job again: nothing is added
    return rp.bytes_written(rp.with_topic(mf.container_stats(spark, root)))


@query(ORACLES["compression_pct"])
def compression_merged(spark, sf):
    """The distribution of reductions merged from the stored counts of two commits, day by day."""
    root, base = shared_dir(spark, "merged"), shared_dir(spark, "reductions")
    early = F.col("bucket_ms") < 1_705_276_800_000
    for key, lines in (("early", _files(spark, sf).filter(early)), ("late", _files(spark, sf).filter(~early))):
        mf.write_lines(lines, root, level=0, key=key)
        stats = rp.with_topic(mf.container_stats(spark, root, [key]))
        rp.reduction_counts(stats).write.parquet(f"{base}/commit={key}")
    return rp.reduction_percentiles(rp.merge_reductions(spark.read.parquet(base)))


@query(_with(_BOXES, """SELECT b.topic, count(*) AS containers, sum(raw)::BIGINT AS raw_bytes, any_value(n) AS lines, true AS smaller, true AS as_on_disk
    FROM boxes b JOIN (SELECT topic, count(*) AS n FROM placed GROUP BY topic) USING (topic) GROUP BY b.topic"""))
def manifest_deflated(spark, sf):
    """Statistics of deflated containers: what SQL can tell of them, and whether they agree with the containers read back."""
    root = _manifest_tree(spark, sf, 6)
    told = rp.with_topic(mf.container_stats(spark, root)).groupBy("topic").agg(
        F.count("*").alias("containers"), F.sum("raw_bytes").alias("raw_bytes"), F.sum("lines").alias("lines"),
        F.sum("compressed_bytes").alias("_packed"))
    files = boxes.read_container_stats(spark, root).withColumn("file", F.regexp_replace("file", r"\.[0-9a-f]{32}-\d+", ""))
    found = rp.with_topic(files).groupBy("topic").agg(
        F.sum("compressed_bytes").alias("_found"), F.sum("raw_bytes").alias("_raw"), F.count("*").alias("_boxes"))
    return told.join(found, "topic").select(
        "topic", "containers", "raw_bytes", "lines", (F.col("_packed") < F.col("raw_bytes")).alias("smaller"),
        ((F.col("_packed") == F.col("_found")) & (F.col("raw_bytes") == F.col("_raw")) & (F.col("containers") == F.col("_boxes"))).alias("as_on_disk"))


@query(_with(_keyed_sql(86_400) + _BLOCKS, f"""SELECT {_label('bucket_ms', '%Y%m%d')} || '/' || topic || '/' || file_name AS file,
    block_number, CAST(idx AS INTEGER) AS idx, ts_ms, body FROM placed
    WHERE ts_ms BETWEEN 1704450000000 AND 1704461399999"""))
def manifest_window(spark, sf):
    """Three hours of a compacted tree: containers of other hours are not read."""
    root = _manifest_tree(spark, sf, 1)
    mf.compact(spark, root, 4)
    out = mf.read_lines(spark, root, 1_704_450_000_000, 1_704_461_399_999)
    name = F.regexp_extract("file", r"([^/]*/[^/]*/[^/]*)$", 1)
    return out.select(name.alias("file"), "block_number", "idx", "ts_ms", wire.body_text(F.col("message")).alias("body"))


# --- ledger ------------------------------------------------------------------------------------


@query(_with(_LOG, """SELECT topic, "partition", arrival_ms - arrival_ms % 3600000 AS shift_start, max(ts_ms) AS max_ts_ms,
    arg_max(next_offset, arrival_seq) AS next_offset, count(*) AS consumed FROM lines GROUP BY ALL"""))
def shift_max_ts(spark, sf):
    return lg.shift_totals(_decoded(spark, sf))


@query(_with(_LOG + _STORED, 'SELECT topic, "partition", shift, offset_ts_ms FROM ledger'))
def offset_timestamp(spark, sf):
    return _ledger(spark, sf).select(*TP, "shift", "offset_ts_ms")


@query(_with(_LOG + _STORED, "SELECT * FROM ledger"))
def shift_ledger(spark, sf):
    return _ledger(spark, sf)


@query(_with((_LOG + _STORED).replace("max(ts_ms) AS max_ts_ms", "max(parsed_ms) AS max_ts_ms"),
             'SELECT topic, "partition", shift, next_offset, max_ts_ms, offset_ts_ms FROM final'))
def shift_ledger_parsed(spark, sf):
    """The ledger from parsed times only, of shifts whose grace period is over."""
    out = _ledger(spark, sf, parsed_only=True, final_only=True)
    return out.select(*TP, "shift", "next_offset", "max_ts_ms", "offset_ts_ms")


# --- reports -----------------------------------------------------------------------------------

_HISTOGRAM = f"""SELECT topic, "partition", ts_source, {_label('ts_ms', '%Y-%m-%d-%H')} AS label, count(*) AS lines,
    min("offset") AS first_offset, arg_min(body, "offset") AS first_body FROM lines WHERE ts_source <> 'now' GROUP BY ALL"""


@query(_with(_LOG, f'SELECT topic, "partition", ts_source, label, lines FROM ({_HISTOGRAM})'))
def ts_histogram(spark, sf):
    return rp.timestamp_histogram(_decoded(spark, sf)).drop("first_offset", "first_body")


@query(_with(_LOG, f'SELECT topic, "partition", ts_source, label, first_offset, first_body FROM ({_HISTOGRAM})'))
def ts_first_seen(spark, sf):
    return rp.timestamp_histogram(_decoded(spark, sf)).drop("lines")


@query(_with(_LOG, """SELECT count(*) AS lines, count(*) FILTER (ts_source = 'envelope') AS envelope_errors,
    count(*) FILTER (ts_source = 'now') AS raw_errors FROM lines"""))
def ts_errors(spark, sf):
    return rp.histogram_errors(_decoded(spark, sf))


@query(_with(_LOG, """SELECT coalesce(topic, '*') AS topic, coalesce("partition", -1) AS "partition",
    CASE GROUPING(topic, "partition") WHEN 0 THEN 'partition' WHEN 1 THEN 'topic' ELSE 'total' END AS level, count(*) AS lines
    FROM lines GROUP BY ROLLUP (topic, "partition")"""))
def write_counters_rollup(spark, sf):
    return rp.write_counters(wire.landable(_decoded(spark, sf))).withColumns(
        {"topic": F.coalesce("topic", F.lit("*")), "partition": F.coalesce("partition", F.lit(-1))})


@query(_with(_EV_CUT, "SELECT topic, count(*) FILTER (ts_source = 'now') AS timestamp_errors, CAST(0 AS BIGINT) AS pri_errors FROM dec GROUP BY topic"))
def parse_errors(spark, sf):
    return rp.parse_errors(wire.decode(_messages(spark, sf, cut=True), YEAR))


@query(_with(_LOG, """SELECT *, CASE WHEN seconds > 0 THEN consumed // seconds ELSE -1 END AS lines_per_second FROM (
    SELECT topic, "partition", count(*) AS consumed, count(*) AS written,
      (1706661000000 - min(arrival_ms)) // 1000 AS seconds FROM lines GROUP BY ALL)"""))
def partition_rate(spark, sf):
    return rp.consume_rate(_decoded(spark, sf), AS_OF_MS).withColumn(
        "lines_per_second", F.coalesce("lines_per_second", F.lit(-1)))


_LAG = """SELECT topic, "partition", arg_max(lag, arrival_seq) AS lag,
    arg_max(greatest(0, (1706661000000 - ts_ms) // 1000), arrival_seq) AS lag_seconds FROM lines GROUP BY ALL"""


@query(_with(_LOG, _LAG))
def partition_lag(spark, sf):
    return rp.partition_lag(_decoded(spark, sf), AS_OF_MS)


@query(_with(_LOG, f"""SELECT max(lag) AS max_lag, CAST(sum(lag) AS BIGINT) AS sum_lag, CAST(sum(lag) // count(*) AS BIGINT) AS avg_lag,
    max(lag_seconds) AS max_lag_seconds, CAST(sum(lag_seconds) AS BIGINT) AS sum_lag_seconds,
    CAST(sum(lag_seconds) // count(*) AS BIGINT) AS avg_lag_seconds FROM ({_LAG})"""))
def cluster_lag(spark, sf):
    return rp.cluster_lag(rp.partition_lag(_decoded(spark, sf), AS_OF_MS))


def _placement(spark, sf):
    """Leaders, assignments and clients of the partitions found in the log."""
    parts = _partitions(spark, sf)
    mix = F.length("topic") + F.col("partition")
    leaders = parts.select(*TP, F.concat(F.lit("h"), (mix % 3).cast("string")).alias("host"))
    assigned = parts.filter("NOT (topic = 'click' AND partition = 1)")
    assignments = assigned.select(*TP, (F.length("topic") * 2 + F.col("partition")).alias("_m")).select(
        *TP, (F.col("_m") % 4).alias("client_id"))
    clients = assignments.select("client_id").distinct().select(
        F.col("client_id").alias("id"), F.concat(F.lit("h"), (F.col("client_id") % 3).cast("string")).alias("hostname"))
    return leaders, assignments, clients


@query(_with(_EV, """, pairs AS (
  SELECT topic, "partition", 'h' || ((length(topic) + "partition") % 3) AS host,
    CASE WHEN NOT (topic = 'click' AND "partition" = 1) THEN 'h' || (((length(topic) * 2 + "partition") % 4) % 3) END AS hostname,
    count(*) AS messages, sum(CASE WHEN shape = 9 THEN 18 ELSE strlen(body) + CASE WHEN shape <= 4 THEN 33 + length(pri_value::VARCHAR)
      WHEN shape = 5 THEN 20 WHEN shape = 6 THEN 16 WHEN shape = 8 THEN 10 ELSE 0 END END) AS bytes
  FROM dec GROUP BY ALL),
produced AS (SELECT host AS hostname, count(*) AS producing FROM pairs WHERE host <> hostname GROUP BY ALL),
rows_ AS (SELECT hostname, count(*) FILTER (host = hostname) AS lp, count(*) FILTER (host <> hostname) AS rp,
    sum(messages) FILTER (host = hostname) AS lm, sum(messages) FILTER (host <> hostname) AS rm,
    sum(bytes) FILTER (host <> hostname) AS rb, count(*) FILTER (hostname IS NULL) AS un FROM pairs GROUP BY hostname),
full_ AS (SELECT r.*, coalesce(p.producing, 0) AS producing FROM rows_ r LEFT JOIN produced p USING (hostname))
SELECT host, CAST(lp AS BIGINT) AS local_partitions, CAST(rp AS BIGINT) AS remote_partitions,
  CAST(coalesce(lm, 0) AS BIGINT) AS local_messages, CAST(coalesce(rm, 0) AS BIGINT) AS remote_messages,
  CAST(coalesce(rb, 0) AS BIGINT) AS remote_bytes, CAST(producing AS BIGINT) AS remote_producing,
  CAST(un AS BIGINT) AS unassigned_partitions, round(100.0::DOUBLE * lp / (lp + rp), 4) AS percent_local
FROM (SELECT hostname AS host, lp, rp, lm, rm, rb, producing, un FROM full_ WHERE hostname IS NOT NULL
  UNION ALL SELECT 'total', sum(lp), sum(rp), sum(lm), sum(rm), sum(rb), sum(producing), sum(un) FROM full_)"""))
def traffic_locality(spark, sf):
    out = rp.traffic_locality(_messages(spark, sf), *_placement(spark, sf))
    return out.withColumn("host", F.coalesce("host", F.lit("total")))


# --- readiness ---------------------------------------------------------------------------------


@query(_with(_LOG + _STORED + _WATER, "SELECT topic, coalesce(low_water_ms, -1) AS low_water_ms, partitions, reporting FROM water"))
def topic_low_water(spark, sf):
    out = rd.low_water(_partitions(spark, sf), _stored(spark, sf))
    return out.withColumn("low_water_ms", F.coalesce("low_water_ms", F.lit(-1)))


def _due(spark, sf):
    water = rd.low_water(_partitions(spark, sf), _stored(spark, sf))
    return rd.due_hours(water, _configs(spark, sf), _flags(spark, sf), AS_OF_MS)


_DUE_ROOT = _path('"hdfsRootDir"', "hour_ms")
_DUE_DATA = _path('''"hdfsRootDir" || '/' || "defaultDirectory"''', "hour_ms")


@query(_with(_LOG + _DUE, f"""SELECT 'data' AS level, topic, hour_ms, {_DUE_DATA} AS path FROM due
    UNION ALL SELECT 'topic', topic, hour_ms, {_DUE_ROOT} FROM due"""))
def due_hours(spark, sf):
    return rd.flag_paths(_due(spark, sf))


_READY = _keyed_sql() + _DUE + f""",
dirs AS (SELECT DISTINCT {_path("""regexp_extract("hdfsRootDir", '^(.*%H)', 1)""", 'bucket_ms')} AS hour_path,
    {_path("""regexp_extract("hdfsRootDir", '^(.*%d)', 1)""", 'bucket_ms')} AS day_path, topic, bucket_ms AS hour_ms
  FROM named JOIN config ON id = topic),
marked AS (SELECT topic, hour_ms FROM flags UNION SELECT topic, hour_ms FROM due),
hour AS (SELECT hour_path, day_path, d.hour_ms, count(*) AS topics, count(m.topic) AS ready_topics, count(*) = count(m.topic) AS ready
  FROM dirs d LEFT JOIN marked m ON m.topic = d.topic AND m.hour_ms = d.hour_ms GROUP BY ALL),
day AS (SELECT day_path, hour_ms - hour_ms % 86400000 AS day_ms, count(*) AS hours,
    count(*) FILTER (ready) AS ready_hours, bool_and(ready) AS ready FROM hour GROUP BY ALL),
markers AS (
  SELECT 'data' AS level, topic, hour_ms, {_DUE_DATA} AS path FROM due
  UNION ALL SELECT 'topic', topic, hour_ms, {_DUE_ROOT} FROM due
  UNION ALL SELECT 'hour', NULL, hour_ms, hour_path FROM hour WHERE ready
  UNION ALL SELECT 'day', NULL, day_ms, day_path FROM day WHERE ready
)
"""


def _dirs(spark, sf):
    """Hours that topics have data in, as the landing leaves them."""
    return stored(rd.topic_dirs(_keyed(spark, sf), []), "dirs")


def _hours(spark, sf):
    flags = _flags(spark, sf)
    water = rd.low_water(_partitions(spark, sf), _stored(spark, sf))
    configs = _configs(spark, sf)
    due = rd.due_hours(water, configs, flags, AS_OF_MS)
    marked = flags.unionByName(due.select("topic", "hour_ms"))
    return rd.hour_ready(rd.placed_dirs(_dirs(spark, sf), configs), marked, ["hour_path", "day_path"])


@query(_with(_READY, "SELECT * FROM hour"))
def hour_ready(spark, sf):
    return _hours(spark, sf)


@query(_with(_READY, "SELECT * FROM day"))
def day_ready(spark, sf):
    return rd.day_ready(_hours(spark, sf), ["day_path"])


def _markers(spark, sf):
    return jobs.readiness(_partitions(spark, sf), _stored(spark, sf), _configs(spark, sf), _flags(spark, sf), _dirs(spark, sf), AS_OF_MS)


@query(_with(_READY, "SELECT level, coalesce(topic, '*') AS topic, hour_ms, path FROM markers"))
def ready_flags(spark, sf):
    """Markers of all four levels, from stored tables alone."""
    return _markers(spark, sf).withColumn("topic", F.coalesce("topic", F.lit("*")))


@query(_with(_READY, """SELECT path, bool_or(level IN ('hour', 'day')) AS shared, true AS flagged FROM markers GROUP BY path
    UNION ALL SELECT DISTINCT hour_path, true, false FROM hour WHERE NOT ready AND hour_path NOT IN (SELECT path FROM markers)"""))
def ready_markers(spark, sf):
    """The markers written, then looked up again in the folders that got one and in those that did not."""
    base = shared_dir(spark, "markers")
    found = stored(_markers(spark, sf), "found")
    jobs.mark_ready(found, base)
    shared = F.col("level").isin("hour", "day")
    told = found.groupBy("path").agg(F.bool_or(shared).alias("shared"))
    hours = _hours(spark, sf).filter("NOT ready").select(F.col("hour_path").alias("path"), F.lit(True).alias("shared")).distinct()
    rows = told.unionByName(hours.join(told.select("path"), "path", "left_anti"))
    return markers.with_flag(rows, base)


@query(_with(_READY, "SELECT hour_path AS path, topics AS children, ready_topics AS ready_children, ready FROM hour"))
def hour_folders_ready(spark, sf):
    """Hour folders judged by the topic folders and markers in the file system, after a readiness run wrote its own there.

    The flags that the run starts from are found in the folders, too.
    """
    base = shared_dir(spark, "tree")
    configs, flags, dirs = _configs(spark, sf), _flags(spark, sf), _dirs(spark, sf)
    placed = rd.placed_dirs(dirs, configs)
    topic_path = F.concat_ws("/", "hour_path", "topic")
    # What the landing and earlier runs left: data folders, and a marker per flagged topic hour.
    markers.write_flags(placed.select(F.concat_ws("/", topic_path, F.lit("data")).alias("path")), base, "part.bm")
    markers.write_flags(placed.join(flags, ["topic", "hour_ms"]).select(topic_path.alias("path")), base)
    water = rd.low_water(_partitions(spark, sf), _stored(spark, sf))
    due = rd.due_hours(water, configs, markers.recorded_flags(configs, AS_OF_MS, base=base), AS_OF_MS)
    landed = due.join(placed.select("topic", "hour_ms"), ["topic", "hour_ms"])
    markers.write_flags(rd.flag_paths(landed), base)
    return markers.folder_ready(placed.select(F.col("hour_path").alias("path")), base)


# --- streaming ---------------------------------------------------------------------------------


@query(_with(_LOG + _CONFIGS, f"""SELECT {_path('''"hdfsRootDir" || '/data' ''', '(ts_ms - ts_ms % 86400000)')} AS folder,
    ts_ms, body FROM lines JOIN config ON id = topic"""))
def landing_stream(spark, sf):
    """The log landed by a stream in three batches, read back from its container files."""
    base = shared_dir(spark, "stream")
    cuts = [0, 1_704_931_200_000, 1_705_795_200_000, 2**62]
    _log(spark, sf).drop("event_id").write.parquet(f"{base}/log")
    log = tl.from_folder(spark, f"{base}/log")
    files = 8
    for lo, hi in zip(cuts, cuts[1:]):
        part = log.filter((F.col("arrival_ms") >= lo) & (F.col("arrival_ms") < hi))
        part.repartitionByRange(files, "arrival_ms").write.mode("append").parquet(f"{base}/in")
    options = landing.LandingOptions(
        f"{base}/out", f"{base}/ledger", f"{base}/checkpoint", YEAR, seconds=86_400)
    configs = f"{base}/configs"
    _configs(spark, sf).write.parquet(configs)
    stream = tl.from_folder(spark, f"{base}/in", streaming=True, files_per_trigger=files)
    landing.landing_stream(stream, spark.read.parquet(configs), options).awaitTermination()
    folder = F.regexp_extract("file", r"(/service/.*)/[^/]*$", 1)
    return boxes.read_lines(spark, f"{base}/out").select(
        folder.alias("folder"), "ts_ms", wire.body_text(F.col("message")).alias("body"))


_CUTS = """,
cuts AS (SELECT topic, "partition", coalesce(min(arrival_seq) FILTER (arrival_seq % 2 = 1 AND high_watermark < total
    AND arrival_seq > total), 9223372036854775807) AS cut FROM log GROUP BY ALL),
ordered AS (SELECT l.topic, l."partition", l."offset" AS o, l.high_watermark AS h, CASE WHEN arrival_seq <= cut THEN 0 ELSE 1 END AS batch,
  row_number() OVER (PARTITION BY l.topic, l."partition" ORDER BY arrival_seq) AS n FROM log l JOIN cuts USING (topic, "partition")),
walk AS (
  SELECT topic, "partition", n, batch, o, h, CASE WHEN o >= 0 THEN o + 1 ELSE 0 END AS following FROM ordered WHERE n = 1
  UNION ALL
  SELECT r.topic, r."partition", r.n, r.batch, r.o, r.h,
    CASE WHEN w.following <= r.o THEN r.o + 1 WHEN w.following > r.h THEN r.h ELSE w.following END
  FROM walk w JOIN ordered r ON r.topic = w.topic AND r."partition" = w."partition" AND r.n = w.n + 1
)
"""


@query("WITH RECURSIVE " + (_LOG + _CUTS).strip() + """ SELECT b.batch, topic, "partition", arg_max(following, n) AS start_offset
    FROM walk w JOIN (VALUES (0), (1)) b(batch) ON w.batch <= b.batch GROUP BY ALL""")
def landing_stream_offsets(spark, sf):
    """Offsets a sinking stream keeps after each of two batches.

    The first batch of a partition ends on a row that resets the expectation, and arrival times
    run backwards here and there, as a broker's create times do.
    """
    base = shared_dir(spark, "offsets")
    moved = F.col("arrival_ms") - (F.col("event_id") % 5) * 1_800_000
    log = stored(_log(spark, sf).withColumn("arrival_ms", moved).drop("event_id"), "log")
    # A row per topic-partition, stored, so that the joins below broadcast it and no row of the log moves for them.
    totals = stored(log.groupBy(*TP).agg(F.max("high_watermark").alias("_total")), "totals")
    lagging = (F.col("arrival_seq") % 2 == 1) & (F.col("high_watermark") < F.col("_total")) & (F.col("arrival_seq") > F.col("_total"))
    cuts = stored(log.join(totals, TP).groupBy(*TP).agg(F.min(F.when(lagging, F.col("arrival_seq"))).alias("_cut")), "cuts")
    batch = F.when(F.col("arrival_seq") <= F.coalesce("_cut", F.lit(2**63 - 1)), 0).otherwise(1)
    rows = log.join(cuts, TP).withColumn("batch", batch).drop("_cut")
    options = landing.LandingOptions(f"{base}/out", f"{base}/ledger", f"{base}/checkpoint", YEAR, seconds=86_400, sink_to_watermark=True)
    configs, states = _configs(spark, sf), []
    for k in (0, 1):
        landing.land_batch(rows.filter(F.col("batch") == k).drop("batch"), k, configs, options)
        states.append(landing.read_offsets(spark, options.ledger, k).select(F.lit(k).alias("batch"), *TP, "start_offset"))
    return states[0].unionByName(states[1])


@query(_with(_RESUME + """,
begun AS (SELECT topic, "partition", CASE WHEN resume_offset < earliest OR resume_offset > latest THEN latest ELSE resume_offset END AS start_offset
  FROM (SELECT topic, "partition", resume_offset, min(l."offset") AS earliest, max(l.high_watermark) AS latest
    FROM resume JOIN log l USING (topic, "partition") GROUP BY ALL)),
landed AS (SELECT l.topic, l."partition", "offset" FROM lines l JOIN begun b USING (topic, "partition") WHERE "offset" >= start_offset)
""", """SELECT b.topic, b."partition", b.start_offset, greatest(b.start_offset, coalesce(max("offset") + 1, 0)) AS next_offset,
    count("offset") AS consumed FROM begun b LEFT JOIN landed l USING (topic, "partition") GROUP BY b.topic, b."partition", b.start_offset"""))
def landing_resume(spark, sf):
    """A landing that starts where resume planning says: stored offsets, overrides, range resets to the end."""
    base = shared_dir(spark, "resume")
    log = stored(_log(spark, sf).drop("event_id"), "log")
    resume = of.resume_offsets(_partitions(spark, sf), _stored(spark, sf), _overrides(spark, sf))
    start = stored(of.reset_out_of_range(resume, of.log_bounds(log), "largest").select(*TP, "start_offset"), "start")
    options = landing.LandingOptions(f"{base}/out", f"{base}/ledger", f"{base}/checkpoint", YEAR, seconds=86_400, start=start)
    landing.land_batch(log, 0, _configs(spark, sf), options)
    consumed = landing.landed_shifts(spark, options.ledger).groupBy(*TP).agg(F.sum("consumed").alias("consumed"))
    ends = landing.read_offsets(spark, options.ledger, 0).select(*TP, F.col("start_offset").alias("next_offset"))
    return start.join(ends, TP).join(consumed, TP, "left").withColumn("consumed", F.coalesce("consumed", F.lit(0)))


_FIRST_CUT = 1_704_931_200_000


def _data_files(spark, path):
    fs, root = boxes.filesystem(qualified(spark, path))
    return [i.path for i in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if i.path.endswith(".parquet")]


def _swap_bytes(spark, base, path, data):
    """Give a file other content; returns what it held. A checksum beside it would tell, so it goes."""
    fs, _ = boxes.filesystem(qualified(spark, base))
    with fs.open_input_stream(path) as source:
        before = source.read()
    folder, name = path.rsplit("/", 1)
    if fs.get_file_info(f"{folder}/.{name}.crc").type != pafs.FileType.NotFound:
        fs.delete_file(f"{folder}/.{name}.crc")
    with fs.open_output_stream(path) as out:
        out.write(data)
    return before


_DATA_FOLDER = _path('''"hdfsRootDir" || '/data' ''', "(ts_ms - ts_ms % 86400000)")


@query(_with(_LOG + _CONFIGS, f"""SELECT state, {_DATA_FOLDER} AS folder, ts_ms, body FROM lines JOIN config ON id = topic
    JOIN (VALUES ('failed', {_FIRST_CUT}), ('again', 9223372036854775807)) s(state, until) ON arrival_ms < until"""))
def sink_replay(spark, sf):
    """A landing by the streaming sink: what is visible after its second batch failed midway, and after that ran again.

    One of the files of the second batch is broken at first, so some of its tasks have written when the batch fails.
    """
    base = shared_dir(spark, "sink")
    log = stored(_log(spark, sf).drop("event_id"), "sinklog")
    files = 8
    for at, part in enumerate((log.filter(F.col("arrival_ms") < _FIRST_CUT), log.filter(F.col("arrival_ms") >= _FIRST_CUT))):
        part.repartitionByRange(files, "arrival_ms").write.mode("append").parquet(f"{base}/in")
        if at == 0:
            first = _data_files(spark, f"{base}/in")
    broken = sorted(set(_data_files(spark, f"{base}/in")) - set(first))[-1]
    whole = _swap_bytes(spark, base, broken, b"not a file of rows")
    options = sink.SinkOptions(f"{base}/out", f"{base}/checkpoint", YEAR, seconds=86_400)
    _configs(spark, sf).write.parquet(f"{base}/configs")

    def land():
        stream = tl.from_folder(spark, f"{base}/in", streaming=True, files_per_trigger=files)
        sink.landing_sink(stream, spark.read.parquet(f"{base}/configs"), options).awaitTermination()

    def seen(state):
        folder = F.regexp_extract("file", r"(/service/.*)/[^/]*$", 1)
        return stored(mf.read_lines(spark, options.root).select(
            F.lit(state).alias("state"), folder.alias("folder"), "ts_ms", wire.body_text(F.col("message")).alias("body")), state)

    try:
        land()
    except StreamingQueryException:
        pass
    failed = seen("failed")
    _swap_bytes(spark, base, broken, whole)
    land()
    return failed.unionByName(seen("again"))


@query(ORACLES["sink_to_watermark"])
def stream_offset_state(spark, sf):
    """The resetting audit with its expectation in the state store: five micro-batches, the stream restarted after three."""
    base = shared_dir(spark, "state")
    log = _log(spark, sf).drop("event_id")
    longest = log.groupBy(*TP).agg((F.max("arrival_seq") + 1).alias("_n"))
    log = stored(log.join(longest, TP).withColumn("_batch", F.floor(F.col("arrival_seq") * 5 / F.col("_n"))).drop("_n"), "statelog")
    files = 4
    for batches in ((0, 1, 2), (3, 4)):
        for k in batches:
            rows = log.filter(F.col("_batch") == k).drop("_batch")
            rows.repartitionByRange(files, "arrival_seq", *TP).write.mode("append").parquet(f"{base}/in")
        stream = tl.from_folder(spark, f"{base}/in", streaming=True, files_per_trigger=files)
        with sink.state_store(spark):
            query_ = sink.audited(stream, sink=True).select(*TP, "offset", "arrival_seq", "expected", "status").writeStream.format("parquet") \
                .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(f"{base}/out")
        query_.awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query("""SELECT topic, "partition", "offset", true AS whole FROM (
    SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
      row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY ts, event_id) - 1 AS "offset" FROM events)
    WHERE "offset" >= CASE WHEN "partition" % 2 = 0 THEN 10 * "partition" + 7 ELSE 0 END AND (topic <> 'click' OR "offset" < 40)""")
def stream_from_offsets(spark, sf):
    """A segmented log read by a stream from a start table to an end table, a third of it at a time, stopped and restarted."""
    base = shared_dir(spark, "segments")
    log = stored(_log(spark, sf, disturbed=False).drop("event_id"), "whole")
    parts = log.select(*TP).distinct()
    start = parts.filter("partition % 2 = 0").select(*TP, (F.col("partition") * 10 + 7).cast("long").alias("start_offset"))
    end = parts.filter("topic = 'click'").select(*TP, F.lit(40).cast("long").alias("start_offset"))
    limit = max(40, log.count() // 3)
    for key, rows in (("early", log.filter("offset < 30")), ("late", log.filter("offset >= 30"))):
        sg.land_segments(rows, f"{base}/log", key, 64)
        stream = sg.from_segments(spark, f"{base}/log", start, end, limit)
        query_ = stream.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").start(f"{base}/out")
        query_.processAllAvailable()
        query_.stop()
    told = log.select(*TP, "offset", F.crc32("value").alias("_crc"))
    out = spark.read.parquet(f"{base}/out").select(*TP, "offset", F.crc32("value").alias("_read"))
    return out.join(told, [*TP, "offset"], "left").select(*TP, "offset", (F.col("_crc") == F.col("_read")).alias("whole"))


@query("""WITH steps AS (SELECT doc_id % 3 AS p, (doc_id // 3) // 16 AS step, sum(strlen(text)) AS bytes, count(*) AS n FROM documents GROUP BY ALL),
  rolled AS (SELECT p, n, bytes, CAST(coalesce(sum(bytes) OVER (PARTITION BY p ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 50000
    + step * 16 // 128 AS BIGINT) AS roll FROM steps)
  SELECT CAST(p AS INTEGER) AS "partition", roll, CAST(sum(n) AS BIGINT) AS "rows", CAST(sum(bytes) AS BIGINT) AS bytes FROM rolled GROUP BY ALL""")
def byte_slices(spark, sf):
    """Documents as a log of very uneven messages, in slices bounded by rows and bytes."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    log = docs.select(
        F.lit("documents").alias("topic"), (F.col("doc_id") % 3).cast("int").alias("partition"),
        F.floor(F.col("doc_id") / 3).alias("arrival_seq"), F.encode("text", "UTF-8").alias("value"))
    rolled = of.byte_rolls(log, roll_bytes=50_000, roll_rows=128, step_rows=16)
    return rolled.groupBy("partition", "roll").agg(F.count("*").alias("rows"), F.sum(F.length("value")).alias("bytes"))


@query(_with(_LOG, """SELECT topic, "partition", arrival_ms - arrival_ms % 86400000 AS shift_start, max(ts_ms) AS max_ts_ms,
    arg_max(next_offset, arrival_seq) AS next_offset, count(*) AS consumed FROM lines GROUP BY ALL"""))
def ledger_compacted(spark, sf):
    """Shift totals of a landing of six batches whose ledger was compacted twice on the way."""
    base = shared_dir(spark, "compacted")
    log = stored(_log(spark, sf).drop("event_id"), "log")
    options = landing.LandingOptions(f"{base}/out", f"{base}/ledger", f"{base}/checkpoint", YEAR, seconds=86_400, compact_every=2)
    configs, first, last = _configs(spark, sf), *log.agg(F.min("arrival_ms"), F.max("arrival_ms")).first()
    part = F.floor((F.col("arrival_ms") - first) * 6 / (last + 1 - first))
    for k in range(6):
        landing.land_batch(log.filter(part == k), k, configs, options)
    return landing.landed_shifts(spark, options.ledger).select(*TP, "shift_start", "next_offset", "max_ts_ms", "consumed")
