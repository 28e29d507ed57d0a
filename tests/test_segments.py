"""A segmented log: index, start and end offsets, admission, restart."""

import ast
import os

import pytest
from pyspark.sql import functions as F

from logharbor import catalog as c
from logharbor.sources import segments as sg

START = "topic string, partition int, start_offset long"


@pytest.fixture(scope="module")
def log(spark, sf_dir):
    return c.stored(c._log(spark, sf_dir, disturbed=False).drop("event_id"), "log")


def taken(spark, base, **options):
    query = sg.from_segments(spark, f"{base}/log", **options).select("topic", "partition", "offset").writeStream.format("parquet") \
        .option("checkpointLocation", f"{base}/check").start(f"{base}/out")
    query.processAllAvailable()
    ends = [p["sources"][0]["endOffset"] for p in query.recentProgress]
    ends = [ast.literal_eval(e) if isinstance(e, str) else e for e in ends]
    query.stop()
    return sorted(map(tuple, spark.read.parquet(f"{base}/out").collect())), ends


def test_index_and_idempotent_landing(spark, log, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        sg.land_segments(log, root, "all", 16)
    index = sg.segments(root)
    assert sum(s["rows"] for s in index) == log.count() and len([d for d in os.listdir(root) if d.startswith("all-")]) == 1
    assert all(s["last"] // 16 == s["first"] // 16 and s["rows"] == s["last"] - s["first"] + 1 for s in index)


def test_start_end_and_admission(spark, log, tmp_path):
    sg.land_segments(log, f"{tmp_path}/log", "all", 32)
    start = spark.createDataFrame([("click", 0, 7), ("view", 1, 5), ("view", 2, 10_000)], START)
    end = spark.createDataFrame([("view", 1, 9)], START)
    got, ends = taken(spark, tmp_path, start=start, end=end, max_offsets=200)
    begun = {("click", 0): 7, ("view", 1): 5, ("view", 2): 10_000}
    want = sorted(t for t in map(tuple, log.select("topic", "partition", "offset").collect())
                  if t[2] >= begun.get(t[:2], 0) and not (t[:2] == ("view", 1) and t[2] >= 9))
    assert got == want
    sums = [sum(n for ps in e.values() for n in ps.values()) for e in ends]
    assert len(sums) >= len(want) // 200 and all(b - a <= 200 for a, b in zip(sums, sums[1:]))


def test_restart_goes_on(spark, log, tmp_path):
    sg.land_segments(log.filter("offset < 20"), f"{tmp_path}/log", "a")
    first, _ = taken(spark, tmp_path)
    sg.land_segments(log.filter("offset >= 20"), f"{tmp_path}/log", "b")
    both, _ = taken(spark, tmp_path, start=spark.createDataFrame([("click", 0, 3)], START))     # a start is used by a new checkpoint alone
    assert first == sorted(map(tuple, log.filter("offset < 20").select("topic", "partition", "offset").collect()))
    assert both == sorted(map(tuple, log.select("topic", "partition", "offset").collect()))


def test_admission_shares():
    start, high = {"t": {"0": 0, "1": 10, "2": 5}}, {"t": {"0": 1000, "1": 11, "2": 5}}
    assert sg.admitted(start, high, None) == {"t": {"0": 1000, "1": 11, "2": 5}}
    end = sg.admitted(start, high, 100)
    assert end["t"]["1"] == 11 and end["t"]["2"] == 5 and end["t"]["0"] == 99
    many = {"t": {str(k): 0 for k in range(9)}}
    full = {"t": {str(k): 10 ** k for k in range(9)}}
    out = sg.admitted(many, full, 1000)
    assert sum(out["t"].values()) <= 1000 and min(out["t"].values()) >= 1


def test_ranges_read_again_are_the_same(spark, log, tmp_path):
    root = str(tmp_path)
    sg.land_segments(log, root, "all", 16)
    plans = sg.SegmentPlans(root, {"click": {"1": 4}}, {}, 50)
    rows, end = plans.read(plans.initialOffset())
    assert sorted(rows) == sorted(plans.readBetweenOffsets(plans.initialOffset(), end))
    more, after = plans.read(end)
    assert sorted(more) == sorted(plans.readBetweenOffsets(end, after)) and after != end


def test_small_segments_share_files(spark, tmp_path, monkeypatch):
    """The number of files and of planned reads follows the messages, however short a segment is."""
    monkeypatch.setattr(sg, "FILE_ROWS", 64)
    monkeypatch.setattr(sg, "PLAN_ROWS", 24)
    log = spark.range(200).selectExpr("'t' topic", "0 partition", "id offset", "200L high_watermark", "id arrival_seq", "id arrival_ms", "binary('v' || id) value")
    sg.land_segments(log, f"{tmp_path}/log", "all", 8)
    index = sg.segments(f"{tmp_path}/log")
    assert len(index) == 25 and len({s["path"] for s in index}) == 4
    plans = sg.SegmentPlans(f"{tmp_path}/log", {"t": {"0": 3}}, {"t": {"0": 130}}, None)
    rows, _ = plans.read(plans.initialOffset())
    rows = list(rows)
    assert [r[3:] for r in rows] == [(3, 23), (24, 47), (48, 63), (64, 87), (88, 111), (112, 127), (128, 129)]
    start, end = (spark.createDataFrame([("t", 0, o)], START) for o in (3, 130))
    assert taken(spark, tmp_path, start=start, end=end)[0] == [("t", 0, o) for o in range(3, 130)]
