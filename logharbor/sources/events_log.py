"""Topic log derived from the ``events`` table.

A log row is ``topic, partition, offset, high_watermark, arrival_seq, arrival_ms, value``.
Real deployments read this shape from a broker or a landing folder (``topic_log.py``);
here it is rendered from structured rows so that results can be checked against the
generating columns.

Numbering rows of one topic-partition is done without gathering them: rows are ranked
inside slices of the event id, and the slice sizes are summed up over the (few) slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.times import int_div, ntz_ms
from ..functions.wire import MONTHS

PARTITIONS = 4
SLICE_IDS = 1 << 18        # event ids per slice; bounds every ranking group
ARRIVAL_DELAY_MS = 5_000
REPLAY_DISTANCE = 5        # a repeated row arrives after this many later rows
YEAR = 2024                # year of the generated rows


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _text(ts: Column, ts_ms: Column, cut: bool) -> Column:
    """Message text by shape: RFC form, plain ISO, syslog, no stamp, envelope text, RFC form again.

    ``cut`` ends the last shape inside its stamp, which is for showing the decoder only.
    """
    wall = ts.cast("string")
    iso = F.concat(F.substring(wall, 1, 10), F.lit("T"), F.substring(wall, 12, 8))
    millis = F.lpad((ts_ms % 1000).cast("string"), 3, "0")
    pri = (8 * F.pmod(F.col("event_id"), F.lit(24)) + F.pmod(F.col("event_id"), F.lit(8))).cast("string")
    tail = F.concat(F.lit("user="), F.col("user_id").cast("string"), F.lit(" "), F.col("props"))
    rfc = F.concat(F.lit("<"), pri, F.lit(">1 "), iso, F.lit("."), millis, F.lit("+0130 "), tail)
    month = F.substring(F.lit(MONTHS), (F.month(ts) - 1) * 3 + 1, F.lit(3))
    syslog = F.concat(
        month, F.lit(" "), F.lpad(F.dayofmonth(ts).cast("string"), 2, " "), F.lit(" "),
        F.substring(wall, 12, 8), F.lit(" "), tail,
    )
    shape = F.pmod(F.col("event_id"), F.lit(10))
    return (
        F.when(shape <= 4, rfc)
        .when(shape == 5, F.concat(F.substring(wall, 1, 19), F.lit(" "), tail))
        .when(shape == 6, syslog)
        .when(shape == 9, F.substring(rfc, 1, 18) if cut else rfc)
        .otherwise(tail)
    )


def _value(ts: Column, ts_ms: Column, cut: bool) -> Column:
    text = F.encode(_text(ts, ts_ms, cut), "UTF-8")
    header = F.unhex(F.concat(F.lit("FE00"), F.lpad(F.hex(ts_ms), 16, "0")))
    return F.when(F.pmod(F.col("event_id"), F.lit(10)) == 8, F.concat(header, text)).otherwise(text)


def messages(events: DataFrame, cut: bool = False) -> DataFrame:
    """One message per event, without broker bookkeeping: a plain projection of the scan."""
    ts_ms = ntz_ms(F.col("ts"))
    return events.select(
        "event_id",
        F.col("event_type").alias("topic"),
        F.pmod(F.col("user_id"), F.lit(PARTITIONS)).cast("int").alias("partition"),
        (ts_ms + ARRIVAL_DELAY_MS).alias("arrival_ms"),
        _value(F.col("ts"), ts_ms, cut).alias("value"),
    )


def topic_log(events: DataFrame, disturbed: bool = True, slice_ids: int = SLICE_IDS) -> DataFrame:
    """The full topic log.

    ``disturbed`` skips an offset before every 101st event (a gap; no event is lost), repeats
    every 97th event later (an early offset) and lets every second repeat come from a lagging
    broker with a low watermark.
    """
    key = ["topic", "partition", "_slice"]
    msgs = messages(events).withColumn("_slice", int_div(F.col("event_id"), slice_ids))
    over = Window.partitionBy("topic", "partition")
    # Offsets a row takes up: one, or two where the number before it is skipped.
    taken = F.when((F.col("event_id") % 101 == 0) & F.lit(disturbed), 2).otherwise(1)
    sizes = (
        msgs.groupBy(*key).agg(F.sum(taken).alias("_n"))
        .withColumn(
            "_before",
            F.coalesce(F.sum("_n").over(over.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .withColumn("high_watermark", F.sum("_n").over(over))
    )
    rank = F.sum(taken).over(Window.partitionBy(*key).orderBy("event_id"))
    numbered = (
        msgs.withColumn("_rank", rank).join(sizes, key)
        .withColumn("offset", F.col("_before") + F.col("_rank") - 1)
        .withColumn("arrival_seq", F.col("offset") * 2)
        .drop("_slice", "_rank", "_before", "_n")
    )
    if disturbed:
        event = F.col("event_id")
        copies = F.when(event % 97 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
        numbered = (
            numbered.withColumn("_again", F.explode(copies))
            .withColumn(
                "arrival_seq",
                F.col("arrival_seq") + F.when(F.col("_again"), 2 * REPLAY_DISTANCE + 1).otherwise(0),
            )
            .withColumn(
                "high_watermark",
                F.when(F.col("_again") & (event % 194 == 0), F.col("offset") + 2).otherwise(F.col("high_watermark")),
            )
            .drop("_again")
        )
    return numbered.select(
        "topic", "partition", "offset", "high_watermark", "arrival_seq", "arrival_ms", "event_id", "value"
    )


def damaged_messages(events: DataFrame) -> DataFrame:
    """One message per event in eight forms, half of them damaged; columns as :func:`messages` has them.

    By ``event_id % 8``: RFC form with versions from 2 to 999; a priority out of range; one with a
    leading zero; an envelope of another version; an envelope cut short; an envelope around an RFC
    form; a message ended inside its stamp; a priority without a stamp.
    """
    ts_ms = ntz_ms(F.col("ts"))
    wall, event, kind = F.col("ts").cast("string"), F.col("event_id"), F.pmod(F.col("event_id"), F.lit(8))
    iso = F.concat(F.substring(wall, 1, 10), F.lit("T"), F.substring(wall, 12, 8))
    pri, version = F.pmod(event, F.lit(192)).cast("string"), (2 + F.pmod(event, F.lit(998))).cast("string")

    def raw(*parts: Column | str) -> Column:
        return F.encode(F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]), "UTF-8")

    rfc = raw("<", pri, ">", version, " ", iso, "Z ", F.col("props"))
    envelope = F.unhex(F.concat(F.lit("FE00"), F.lpad(F.hex(ts_ms), 16, "0")))
    value = (
        F.when(kind == 0, rfc)
        .when(kind == 1, raw("<200>1 ", iso, "Z ", F.col("props")))
        .when(kind == 2, raw("<01>", F.col("props")))
        .when(kind == 3, F.concat(F.unhex(F.lit("FE01")), rfc))
        .when(kind == 4, F.unhex(F.lit("FE00000001")))
        .when(kind == 5, F.concat(envelope, rfc))
        .when(kind == 6, raw("<", pri, ">1 ", F.substring(iso, 1, 12)))
        .otherwise(raw("<", pri, ">", F.col("props")))
    )
    return events.select(
        "event_id", F.col("event_type").alias("topic"), F.pmod(F.col("user_id"), F.lit(PARTITIONS)).cast("int").alias("partition"),
        (ts_ms + ARRIVAL_DELAY_MS).alias("arrival_ms"), value.alias("value"),
    )
