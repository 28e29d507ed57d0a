"""Operator-facing reports: timestamp histogram, counters, lag, sizes and traffic locality.

All aggregate with partial results before the shuffle; the one that keeps a body (first seen) sorts, the others hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import int_div, render_template, time_bucket
from ..functions.wire import body_text
from .common import TP
from .files import FILE_KEY

HISTOGRAM_TEMPLATE = "%y-%M-%d-%H"


def timestamp_histogram(decoded: DataFrame, template: str = HISTOGRAM_TEMPLATE) -> DataFrame:
    """Lines per partition and time label, apart for parsed and envelope times, with the first line of each.

    ``topic, partition, ts_source, label, lines, first_offset, first_body``; lines dated by
    arrival are left out.
    """
    label = render_template(template, time_bucket(F.col("ts_ms"), 3600))
    return (
        decoded.filter(F.col("ts_source") != "now")
        .groupBy(*TP, "ts_source", label.alias("label"))
        .agg(
            F.count("*").alias("lines"),
            F.min("offset").alias("first_offset"),
            body_text(F.min_by("body", "offset")).alias("first_body"),
        )
    )


def histogram_errors(decoded: DataFrame) -> DataFrame:
    """Stamps that failed to parse, with an envelope time to fall back on and without."""
    return decoded.agg(
        F.count("*").alias("lines"),
        F.count_if(F.col("ts_source") == "envelope").alias("envelope_errors"),
        F.count_if(F.col("ts_source") == "now").alias("raw_errors"),
    )


def _levels(grouped: DataFrame) -> DataFrame:
    """Name the rollup level: partition, topic or total."""
    level = F.when(F.col("_level") == 0, "partition").when(F.col("_level") == 1, "topic").otherwise("total")
    return grouped.withColumn("level", level).drop("_level")


def write_counters(lines: DataFrame) -> DataFrame:
    """Lines written per partition, topic and in total."""
    return _levels(lines.rollup(*TP).agg(F.grouping_id().alias("_level"), F.count("*").alias("lines")))


def skewed_files(lines: DataFrame) -> DataFrame:
    """Files set aside for a skewed clock, per partition, topic and in total."""
    files = lines.filter("skewed").select(*FILE_KEY).distinct()
    return _levels(files.rollup(*TP).agg(F.grouping_id().alias("_level"), F.count("*").alias("files")))


def parse_errors(decoded: DataFrame) -> DataFrame:
    """Per topic: lines without any time of their own, and lines that open a priority but have none."""
    opens = F.substring("value", F.when(F.col("enc_version") == 0, F.lit(11)).otherwise(F.lit(1)), F.lit(1))
    return decoded.groupBy("topic").agg(
        F.count_if(F.col("ts_source") == "now").alias("timestamp_errors"),
        F.count_if((opens == F.unhex(F.lit("3C"))) & F.col("pri").isNull()).alias("pri_errors"),
    )


def consume_rate(decoded: DataFrame, as_of_ms: int | None = None) -> DataFrame:
    """Consumed and written lines per partition and the whole-second average rate.

    The clock runs from the partition's first arrival to ``as_of_ms`` (default: its last).
    """
    last = F.max("arrival_ms") if as_of_ms is None else F.lit(as_of_ms)
    return (
        decoded.groupBy(*TP)
        .agg(
            F.count("*").alias("consumed"),
            F.count_if(F.col("decode_status") != "short_envelope").alias("written"),
            int_div(last - F.min("arrival_ms"), 1000).alias("seconds"),
        )
        .withColumn("lines_per_second", F.when(F.col("seconds") > 0, int_div(F.col("consumed"), F.nullif("seconds", F.lit(0)))))
    )


def early_counts(audited: DataFrame) -> DataFrame:
    """Early offsets received per partition."""
    return audited.groupBy(*TP).agg(F.count_if(F.col("status") == "early").alias("early"))


def gap_counts(audited: DataFrame) -> DataFrame:
    """Anomalies per partition: runs of missing offsets and how many offsets they lack."""
    return audited.groupBy(*TP).agg(
        F.count_if(F.col("status") == "gap").alias("gaps"), F.sum("gap").alias("missing")
    )


def partition_lag(lines: DataFrame, as_of_ms: int) -> DataFrame:
    """Latest offset lag and latest time lag (whole seconds, not below 0) of each partition."""
    behind = F.greatest(F.lit(0).cast("long"), int_div(F.lit(as_of_ms) - F.col("ts_ms"), 1000))
    return lines.groupBy(*TP).agg(
        F.max_by("lag", "arrival_seq").alias("lag"), F.max_by(behind, "arrival_seq").alias("lag_seconds")
    )


def cluster_lag(lags: DataFrame) -> DataFrame:
    """Maximum, sum and integer average of both lags over all partitions; NULL without partitions."""
    partitions = F.nullif(F.count("*"), F.lit(0))
    return lags.agg(
        F.max("lag").alias("max_lag"),
        F.sum("lag").alias("sum_lag"),
        int_div(F.sum("lag"), partitions).alias("avg_lag"),
        F.max("lag_seconds").alias("max_lag_seconds"),
        F.sum("lag_seconds").alias("sum_lag_seconds"),
        int_div(F.sum("lag_seconds"), partitions).alias("avg_lag_seconds"),
    )


def with_topic(stats: DataFrame) -> DataFrame:
    """Topic of a container statistics row, from its file name ``<topic>-<partition>-<offset>.bm``."""
    return stats.withColumn("topic", F.regexp_extract("file", r"([^/]*)-\d+-\d+\.[^/.]*$", 1))


def bytes_written(stats: DataFrame) -> DataFrame:
    """Compressed bytes per topic and in total, from container statistics with a topic."""
    return (
        stats.rollup("topic")
        .agg(
            F.sum("compressed_bytes").alias("bytes"), F.sum("raw_bytes").alias("raw_bytes"),
            F.count("*").alias("containers"), F.grouping("topic").cast("int").alias("is_total"),
        )
    )


def compression_pct(stats: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Distribution of the whole-percent size reduction of container blocks, per topic and in total."""
    saved = F.floor(F.lit(100.5) - F.lit(100.0) * F.col("compressed_bytes") / F.col("raw_bytes"))
    points = F.percentile_approx("_pct", [0.05, 0.5, 0.95], accuracy)
    return (
        stats.withColumn("_pct", saved).rollup("topic")
        .agg(
            F.min("_pct").alias("min_pct"), F.max("_pct").alias("max_pct"), points.alias("_q"),
            F.count("*").alias("containers"), F.grouping("topic").cast("int").alias("is_total"),
        )
        .select(
            "topic", "is_total", "containers", "min_pct", F.col("_q")[0].alias("p05_pct"),
            F.col("_q")[1].alias("p50_pct"), F.col("_q")[2].alias("p95_pct"), "max_pct",
        )
    )


def reduction_counts(stats: DataFrame) -> DataFrame:
    """``topic, pct, containers``: how many container blocks shrank by each whole percent.

    A percentage is a whole number, so this small table is a sketch without error. Those of
    several commits are merged by adding them up (:func:`merge_reductions`), and old containers
    need not be looked at again.
    """
    saved = F.floor(F.lit(100.5) - F.lit(100.0) * F.col("compressed_bytes") / F.col("raw_bytes"))
    return stats.groupBy("topic", saved.alias("pct")).agg(F.count("*").alias("containers"))


def merge_reductions(counts: DataFrame) -> DataFrame:
    return counts.groupBy("topic", "pct").agg(F.sum("containers").alias("containers"))


def reduction_percentiles(counts: DataFrame) -> DataFrame:
    """The distribution of :func:`compression_pct` from merged counts, exactly; windows hold one row per percent."""
    both = F.explode(F.array(F.struct("topic", F.lit(0).alias("is_total")), F.struct(F.lit(None).cast("string").alias("topic"), F.lit(1).alias("is_total"))))
    levels = counts.select(both.alias("_of"), "pct", "containers").groupBy("_of.topic", "_of.is_total", "pct").agg(F.sum("containers").alias("n"))
    of = Window.partitionBy("topic", "is_total")
    summed = levels.withColumns({"_upto": F.sum("n").over(of.orderBy("pct")), "_all": F.sum("n").over(of)})

    def point(share: float, name: str):
        return F.min(F.when(F.col("_upto") >= F.ceil(F.col("_all") * share), F.col("pct"))).alias(name)

    return summed.groupBy("topic", "is_total").agg(
        F.sum("n").alias("containers"), F.min("pct").alias("min_pct"), point(0.05, "p05_pct"), point(0.5, "p50_pct"),
        point(0.95, "p95_pct"), F.max("pct").alias("max_pct"))


def traffic_locality(log: DataFrame, leaders: DataFrame, assignments: DataFrame, clients: DataFrame) -> DataFrame:
    """Local and remote consumption per host, with a total row.

    ``leaders (topic, partition, host)``, ``assignments (topic, partition, client_id)``,
    ``clients (id, hostname)``.  A partition is local when its consumer runs on its leader's
    host.  ``remote_producing`` counts partitions led by the host but consumed elsewhere; the
    total row (host NULL) also counts unassigned partitions.  The log is reduced to one row
    per partition before any join.
    """
    volume = log.groupBy(*TP).agg(F.count("*").alias("messages"), F.sum(F.length("value")).alias("bytes"))
    consumers = assignments.join(clients.select(F.col("id").alias("client_id"), "hostname"), "client_id")
    placed = (
        leaders.select(*TP, "host")
        .join(consumers.select(*TP, "hostname"), TP, "left")
        .join(volume, TP, "left")
    )
    local = F.col("hostname") == F.col("host")
    remote = F.col("hostname") != F.col("host")
    consuming = (
        placed.groupBy(F.col("hostname").alias("consumer"))
        .agg(
            F.count_if(local).alias("local_partitions"), F.count_if(remote).alias("remote_partitions"),
            F.sum(F.when(local, F.col("messages"))).alias("local_messages"),
            F.sum(F.when(remote, F.col("messages"))).alias("remote_messages"),
            F.sum(F.when(remote, F.col("bytes"))).alias("remote_bytes"),
            F.count_if(F.col("hostname").isNull()).alias("unassigned_partitions"),
        )
    )
    producing = placed.filter(remote).groupBy(F.col("host").alias("consumer")).agg(F.count("*").alias("_producing"))
    totals = [
        "local_partitions", "remote_partitions", "local_messages", "remote_messages", "remote_bytes",
        "remote_producing", "unassigned_partitions",
    ]
    # Hosts that only produce do not appear in their own row, as in the placement report this follows.
    rows = consuming.join(producing, "consumer", "left").withColumn("remote_producing", F.col("_producing"))
    rolled = rows.rollup("consumer").agg(
        F.grouping("consumer").alias("_total"), *[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in totals]
    )
    everything = F.col("local_partitions") + F.col("remote_partitions")
    share = F.round(F.lit(100.0) * F.col("local_partitions") / F.nullif(everything, F.lit(0)), 4)
    return (
        rolled.filter((F.col("_total") == 1) | F.col("consumer").isNotNull())
        .select(F.col("consumer").alias("host"), *totals, share.alias("percent_local"))
    )
