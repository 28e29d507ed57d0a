"""Manifest trees, the streaming sink and keyed offset state."""

import glob
import json
import os
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual

import models
from logharbor.operators.files import file_keys
from logharbor.operators.offsets import sink_to_high_watermark
from logharbor.sources import containers as boxes, manifests as mf
from logharbor.streaming import sink
from test_blocks import DDL, make_lines


def lines(spark, rows):
    keyed = file_keys(spark.createDataFrame(rows, DDL).repartition(4), roll_rows=100)
    return keyed.withColumn("file", F.concat(F.lit("day/"), "bucket_ms", F.lit("/"), "file_name"))


def seen(spark, root, *bounds):
    return sorted((r.ts_ms, bytes(r.message)) for r in mf.read_lines(spark, root, *bounds).collect())


def data_files(root):
    return sorted(glob.glob(f"{root}/**/*.bm", recursive=True))


def test_a_job_is_visible_once(spark, tmp_path):
    root, rows = str(tmp_path), make_lines(1, n=300)
    want = sorted((r[5], bytes(r[6])) for r in rows)
    mf.write_lines(lines(spark, rows), root, key="job")
    assert seen(spark, root) == want
    files = data_files(root)
    mf.write_lines(lines(spark, rows), root, key="job")
    assert seen(spark, root) == want and data_files(root) == files and len(os.listdir(f"{root}/_stats")) == len(json.load(open(f"{root}/_commits/job.json"))["parts"])
    mf.write_lines(lines(spark, rows[:50]), root, key="more")
    assert len(seen(spark, root)) == 350
    mf.write_lines(lines(spark, rows[50:90]), root, mode="overwrite", key="instead")
    assert seen(spark, root) == sorted((r[5], bytes(r[6])) for r in rows[50:90])


def test_nothing_is_visible_before_the_commit(spark, tmp_path):
    """Tasks wrote, the driver died: the manifest is missing, and the files are leftovers."""
    root, rows = str(tmp_path), make_lines(2, n=200)
    mf.write_lines(lines(spark, rows), root, key="dead")
    os.remove(f"{root}/_commits/dead.json")
    assert seen(spark, root) == [] and mf.container_stats(spark, root).count() == 0
    mf.write_lines(lines(spark, rows[:40]), root, key="alive")
    before = len(data_files(root))
    assert mf.leftovers(spark, root).count() > 0
    gone = mf.sweep(spark, root)
    assert gone > 0 and len(data_files(root)) == before - gone and mf.leftovers(spark, root).count() == 0
    assert len(seen(spark, root)) == 40


def test_failed_task_leaves_no_file(spark, tmp_path):
    root = str(tmp_path)
    bad = lines(spark, make_lines(3, n=200)).withColumn("body", F.when(F.col("arrival_seq") == 90, F.raise_error("broken").cast("binary")).otherwise(F.col("body")))
    with pytest.raises(Exception, match="broken"):
        mf.write_lines(bad, root, key="bad")
    assert data_files(root) == [] and not os.path.exists(f"{root}/_commits")


def test_a_window_opens_only_its_containers(spark, tmp_path):
    root = str(tmp_path)
    rows = [("t", 0, i, i, i, 1_704_067_200_000 + i * 30_000, bytearray(b"x" * 400)) for i in range(2000)]
    mf.write_lines(lines(spark, rows), root, key="a")
    lo, hi = rows[700][5], rows[719][5]
    assert seen(spark, root, lo, hi) == [(r[5], bytes(r[6])) for r in rows[700:720]]

    def opened(reader):
        tables = [reader.blocks(p) for p in reader.partitions()]
        return sum(t.num_rows for t in tables), {x for t in tables for x in t["path"].to_pylist()}

    everything, _ = opened(mf.ManifestReader(root, 1 << 30))
    some, paths = opened(mf.ManifestReader(root, 1 << 30, lo // 1000, hi // 1000))
    assert 0 < some < everything / 5 and len(paths) < len(data_files(root))
    pushing = mf.PushingReader(root, 1 << 30)
    filters = [GreaterThanOrEqual(("ts_ms",), lo), LessThan(("second",), hi // 1000), EqualTo(("idx",), 3)]
    assert list(pushing.pushFilters(filters)) == filters
    assert (pushing.first, pushing.last) == (lo // 1000, hi // 1000)
    assert opened(pushing)[0] == some
    for f in (GreaterThan(("ts_ms",), 5999), LessThanOrEqual(("ts_ms",), 5999)):
        one = mf.PushingReader(root, 1)
        list(one.pushFilters([f]))
        assert 5 in (one.first, one.last)
    # Shares of a side file cover its blocks once.
    split = opened(mf.ManifestReader(root, 500))[0]
    assert split == everything and len(mf.ManifestReader(root, 500).partitions()) > 5


def test_pushed_conditions_reach_the_reader(spark, tmp_path):
    root = str(tmp_path)
    rows = [("t", 0, i, i, i, 1_704_067_200_000 + i * 30_000, bytearray(b"x")) for i in range(500)]
    mf.write_lines(lines(spark, rows), root, key="a")
    spark.conf.set(mf.PUSHDOWN, "true")
    try:
        got = mf.read_lines(spark, root).filter((F.col("ts_ms") > rows[10][5]) & (F.col("ts_ms") <= rows[20][5]))
        assert got.count() == 10
    finally:
        spark.conf.set(mf.PUSHDOWN, "false")


def test_compaction_switches_at_once(spark, tmp_path):
    root = str(tmp_path)
    for k in range(4):
        mf.write_lines(lines(spark, make_lines(k, n=80)), root, key=f"k{k}")
    want, stats = seen(spark, root), sorted(map(tuple, mf.container_stats(spark, root).collect()))
    files = data_files(root)
    mf.compact(spark, root, 2)
    mf.write_lines(lines(spark, make_lines(9, n=20)), root, key="late")
    assert data_files(root)[:0] == [] and set(files) <= set(data_files(root))
    fs, inner = mf.filesystem(root)
    assert len(mf.visible(fs, inner)) == 2
    assert set(stats) <= set(map(tuple, mf.container_stats(spark, root).collect()))
    assert len(seen(spark, root)) == len(want) + 20


def test_two_phases_of_the_streaming_sink(tmp_path):
    root = str(tmp_path)
    batch = pa.RecordBatch.from_pydict({"file": ["f/t-0-1.bm"] * 5, "arrival_seq": list(range(5)), "arrival_ms": [7] * 5,
                                        "ts_ms": [1000, 1001, 2000, 2001, 2002], "body": [b"a", b"b", b"c", b"d", b"e"]})
    writer = sink.StreamSink(root, 6, "s")
    parts = [writer.write(iter([batch])), writer.write(iter([]))]
    assert data_files(root) and not os.path.exists(f"{root}/_commits")
    writer.abort(parts, 3)
    assert data_files(root) == [] and os.listdir(f"{root}/_stats") == []
    parts = [writer.write(iter([batch]))]
    writer.commit(parts, 3)
    again = [writer.write(iter([batch]))]
    writer.commit(again, 3)                 # the batch ran again after its commit
    assert len(data_files(root)) == 1 and len(os.listdir(f"{root}/_stats")) == 1
    fs, inner = mf.filesystem(root)
    assert list(mf.visible(fs, inner)) == ["s-0000000000000000003"] and parts[0].lines == 5


@pytest.mark.parametrize("cap,flush", [(1_048_535, 1 << 30), (700, 1 << 30), (60, 900)])
def test_sink_blocks_match_a_sequential_packer(cap, flush):
    rng, rows, ts = random.Random(cap), [], -5000
    for i in range(400):
        ts += rng.choice([0, 0, 1, 300, 900, -700])
        rows.append((f"f{i % 2}", i, i * 3, ts, rng.randbytes(rng.randrange(0, 120))))
    columns = list(zip(*rows))
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["file", "arrival_seq", "arrival_ms", "ts_ms", "body"])
    numbers, got = {}, {}
    for k in range(0, 400, 100) if flush < 1000 else (0,):
        part = batch.slice(k, 100) if flush < 1000 else batch
        for r in sink.line_blocks(pa.Table.from_batches([part]), numbers, cap).to_pylist():
            got.setdefault((k, r["file"]), []).append((r["second"], r["create_time"], r["block_number"], [(x["ms"], x["message"]) for x in r["log_lines"]]))
    for (k, name), blocks in got.items():
        mine = [(r[3], r[2], r[4]) for r in rows[k:k + (100 if flush < 1000 else 400)] if r[0] == name]
        want = models.blocks(mine, cap, None)
        assert [(s, c, b) for s, c, _, b in blocks] == [(s, c, b) for s, c, _, b in want]
        assert [n for _, _, n, _ in blocks] == list(range(blocks[0][2], blocks[0][2] + len(blocks)))


def test_keyed_audit_equals_the_batch_form(spark):
    rng, rows, top = random.Random(4), [], 0
    for i in range(600):
        top += rng.choice([1, 1, 1, 1, 2, 0])
        o = max(0, top - rng.choice([0, 0, 0, 3, 9]))
        rows.append(("t", 0, o, None if i % 11 == 0 else max(0, o + rng.choice([5, 1, 0, -4])), i, i, bytearray(b"v")))
    ddl = "topic string, partition int, offset long, high_watermark long, arrival_seq long, arrival_ms long, value binary"
    want = sink_to_high_watermark(spark.createDataFrame(rows, ddl), slice_rows=50).orderBy("arrival_seq").collect()
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in ddl.split(", ")])
    frame["high_watermark"] = frame["high_watermark"].astype("Int64")
    out, start = [], 0
    for lo in range(0, 600, 150):
        part, start = sink.verdicts(frame.iloc[lo:lo + 150].sample(frac=1, random_state=1), start, True)
        out.append(part)
    got = pd.concat(out)
    for name in ("expected", "status", "accepted", "gap", "next_offset"):
        assert got[name].tolist() == [r[name] for r in want], name
    assert [None if pd.isna(x) else x for x in got["lag"]] == [r.lag for r in want]
    plain, after = sink.expectations(np.array([3, 1, 7]), np.array([9, 9, 9]), 2, False)
    assert plain.tolist() == [2, 4, 4] and after == 8


def test_batches_are_bounded_by_bytes_and_splits_by_work(spark):
    """Lines reach the packer in whole batches, and a folder of many small files is read by many tasks."""
    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = [spark.conf.get(n) for n in names]
    with boxes.bounded_batches(spark):
        rows, size = (int(spark.conf.get(n)) for n in names)
        assert rows >= 1024 and 0 < size <= 64 << 20
    assert [spark.conf.get(n) for n in names] == before
    assert len(boxes.pack_splits([(f"f{k}", 20_000) for k in range(1200)], boxes.SPLIT_BYTES)) >= 12
