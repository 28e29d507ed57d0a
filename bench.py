"""Headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each job runs once to warm up and then ``$BENCH_RUNS`` times (median is reported); results go
to the no-op sink, so a job is timed without moving rows to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from logharbor import catalog as c  # noqa: E402
from logharbor.functions import wire  # noqa: E402
from logharbor.operators import blocks as bl  # noqa: E402
from logharbor.operators.files import FILE_KEY, file_keys  # noqa: E402
from logharbor.session import local_session  # noqa: E402
from logharbor.sources import containers as boxes  # noqa: E402
from logharbor.sources import topic_log as tl  # noqa: E402
from logharbor.sources.events_log import YEAR  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
BUCKET = 86_400


def sink(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    spark = local_session(CPUS, "bench")
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    # The landed topic log a deployment starts from; rendering it from events is not timed.
    c._log(spark, SF).repartition(2 * int(CPUS)).write.parquet(f"{work}/log")
    log = tl.from_folder(spark, f"{work}/log")
    rows = log.count()

    def lines():
        decoded = wire.decode(c.of.accepted_rows(c.of.offset_audit(log)), YEAR)
        return file_keys(wire.landable(decoded), BUCKET).withColumn(
            "file", F.concat_ws("/", c.render_template("%y%M%d", F.col("bucket_ms")), "topic", "file_name"))

    def write(level):
        boxes.write_lines(lines(), f"{work}/level{level}", level=level)

    jobs = {
        "decode": lambda: sink(wire.decode(log, YEAR)),
        "timestamp_histogram": lambda: sink(c.rp.timestamp_histogram(wire.decode(log, YEAR))),
        "offset_audit": lambda: sink(c.of.offset_audit(log)),
        "sink_to_watermark": lambda: sink(c.of.sink_to_high_watermark(log)),
        "log_blocks": lambda: sink(bl.log_blocks(lines(), FILE_KEY)),
        "write_containers_1": lambda: write(1),
        "write_containers_6": lambda: write(6),
        "write_containers_9": lambda: write(9),
        "read_canonical_order": lambda: sink(bl.canonical_order(boxes.read_lines(spark, f"{work}/level6"))),
        "ledger": lambda: sink(c.lg.shift_ledger(
            wire.decode(c.of.accepted_rows(c.of.offset_audit(log)), YEAR),
            c.lg.shift_spine(log, until_ms=c.AS_OF_MS), c.AS_OF_MS)),
        "day_ready": lambda: sink(c.QUERIES["day_ready"](spark, SF)),
        "block_split_documents": lambda: sink(c.QUERIES["block_split"](spark, SF)),
        "landing_stream": lambda: sink(c.QUERIES["landing_stream"](spark, SF)),
    }
    only = sys.argv[1:]
    took = {}
    for name, job in jobs.items():
        if only and name not in only:
            continue
        times = []
        for _ in range(1 if name == "landing_stream" else 1 + RUNS):
            start = time.time()
            job()
            times.append(time.time() - start)
        took[name] = round(statistics.median(times[1:] or times), 3)
        print(name, took[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds of headline jobs", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": os.path.basename(SF.rstrip("/")).removeprefix("sf"), "log_rows": rows,
        "rows_per_sec": {k: round(rows / v) for k, v in took.items() if v and k not in ("day_ready", "block_split_documents")},
        "cpus": CPUS, "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
