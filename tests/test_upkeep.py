"""Slices by bytes, ledger snapshots, merged size counts, markers found in folders."""

import os
import random

import pytest
from pyspark.sql import functions as F

import models
from logharbor import catalog as c
from logharbor.operators import offsets as of
from logharbor.operators import configs as cf
from logharbor.operators import readiness as rd
from logharbor.operators import reports as rp
from logharbor.sources import containers as boxes
from logharbor.sources import markers
from logharbor.streaming import landing

LOG = "topic string, partition int, offset long, high_watermark long, arrival_seq long, arrival_ms long, value binary"
H = 3_600_000
T0 = 1_704_067_200_000


def uneven(n, seed):
    rng = random.Random(seed)
    return [("t", k % 2, k // 2 - (k % 40 == 9), 10 ** 6, k // 2, T0 + k, bytearray(b"x" * (rng.choice([1, 5, 4000]) if k % 2 else 3))) for k in range(n)]


@pytest.mark.parametrize("stretch", [1 << 14, 4])
def test_byte_rolls_are_bounded_and_in_order(spark, monkeypatch, stretch):
    monkeypatch.setattr(of, "STRETCH_STEPS", stretch)
    log = spark.createDataFrame(uneven(2000, 1), LOG)
    rolled = of.byte_rolls(log, roll_bytes=20_000, roll_rows=200, step_rows=8)
    rows = rolled.select("partition", "arrival_seq", "roll", F.length("value").alias("n")).collect()
    for p in (0, 1):
        mine = sorted((r.arrival_seq, r.roll, r.n) for r in rows if r.partition == p)
        assert [r[1] for r in mine] == sorted(r[1] for r in mine) and len(mine) == 1000
        for roll in {r[1] for r in mine}:
            inside = [r for r in mine if r[1] == roll]
            assert len(inside) <= 200 and sum(r[2] for r in inside) <= 20_000 + 8 * 4000


@pytest.mark.parametrize("sink", [False, True])
def test_audit_takes_any_slices(spark, sink):
    rows = [(*r[:3], r[2] + (-3 if k % 50 == 7 else 5), *r[4:]) for k, r in enumerate(uneven(600, 2))]
    log = spark.createDataFrame(rows, LOG)
    audit = of.sink_to_high_watermark if sink else of.offset_audit
    got = audit(of.byte_rolls(log, roll_bytes=9000, step_rows=4)).collect()
    for p in (0, 1):
        mine = sorted((r.arrival_seq, r.offset, r.high_watermark, r.expected, r.status) for r in got if r.partition == p)
        want = models.audit([(o, h) for _, o, h, _, _ in mine], sink=sink)
        assert [(e, s) for _, _, _, e, s in mine] == [(e, s) for e, s, _ in want]


def state(spark, path):
    return sorted(map(tuple, landing.landed_shifts(spark, path).collect()))


def test_ledger_snapshots(spark, tmp_path):
    options = landing.LandingOptions(f"{tmp_path}/out", f"{tmp_path}/ledger", f"{tmp_path}/check", c.YEAR, seconds=3600)
    configs = spark.createDataFrame([(1, "t", "/logs/%y%M%d/t", "u", "data", [])], cf.CONFIG_DDL)
    batches = [spark.createDataFrame([("t", 0, 3 * k + i, 99, 3 * k + i, T0 + k * H // 2 + i, bytearray(b"m")) for i in range(3)], LOG) for k in range(6)]
    for k in range(4):
        landing.land_batch(batches[k], k, configs, options)
    plain = state(spark, options.ledger)
    assert landing.compact_ledger(spark, options.ledger) == 2
    assert landing.ledger_folders(spark, options.ledger) == (2, [3]) and state(spark, options.ledger) == plain
    landing.land_batch(batches[3], 3, configs, options)         # the last batch runs again
    assert state(spark, options.ledger) == plain
    for k in (4, 5):
        landing.land_batch(batches[k], k, configs, options)
    full = state(spark, options.ledger)
    # A compaction that dies before its marker changes nothing.
    assert landing.compact_ledger(spark, options.ledger, keep=2) == 3
    os.remove(f"{options.ledger}/snapshots/{3:019}.done")
    assert landing.ledger_folders(spark, options.ledger)[0] == 2 and landing.compact_ledger(spark, options.ledger) == 4
    assert state(spark, options.ledger) == full and landing.ledger_folders(spark, options.ledger) == (4, [5])
    assert [r.start_offset for r in landing.read_offsets(spark, options.ledger, 5).collect()] == [18]
    assert landing.compact_ledger(spark, options.ledger) == 4
    with pytest.raises(ValueError):
        landing.compact_ledger(spark, options.ledger, keep=0)


def test_merged_counts_give_exact_percentiles(spark):
    rng = random.Random(5)
    raw = [(rng.choice("ab"), 1000, rng.randrange(100, 1100)) for _ in range(500)]
    stats = spark.createDataFrame(raw, "topic string, raw_bytes long, compressed_bytes long")
    parts = rp.reduction_counts(stats.limit(200)).union(rp.reduction_counts(stats.subtract(stats.limit(200))))
    assert parts.count() > 0
    whole = rp.reduction_percentiles(rp.merge_reductions(rp.reduction_counts(stats)))
    for r in whole.collect():
        pct = sorted(int((100.5 - 100.0 * x[2] / x[1]) // 1) for x in raw if r.is_total or x[0] == r.topic)
        at = lambda q: pct[-(-len(pct) * q // 100) - 1]
        assert (r.containers, r.min_pct, r.p05_pct, r.p50_pct, r.p95_pct, r.max_pct) == (len(pct), pct[0], at(5), at(50), at(95), pct[-1])


def test_markers_are_found_in_folders(spark, tmp_path):
    base = str(tmp_path)
    configs = spark.createDataFrame([("a", "/r/%y%M%d/%H/a", "data"), ("b", "/r/%y%M%d/%H/b", "data")], "id string, hdfsRootDir string, defaultDirectory string")
    paths = spark.createDataFrame([("/r/20240101/01/a",), ("/r/20240101/02/b",), ("/r/20240101/01/b/data",)], "path string")
    markers.write_flags(paths, base)
    found = markers.recorded_flags(configs, T0 + 6 * H, 6, base)
    assert sorted((r.topic, (r.hour_ms - T0) // H) for r in found.collect()) == [("a", 1), ("b", 2)]
    parts = spark.createDataFrame([("a", 0), ("b", 0)], "topic string, partition int")
    ledger = spark.createDataFrame([("a", 0, T0 + 3 * H), ("b", 0, T0 + 3 * H)], "topic string, partition int, offset_ts_ms long")
    due = rd.due_hours(rd.low_water(parts, ledger), configs, found, T0 + 6 * H, 6)
    assert sorted((r.topic, (r.hour_ms - T0) // H) for r in due.collect()) == [("a", 0), ("a", 2), ("b", 0), ("b", 1)]
    hours = spark.createDataFrame([("/r/20240101/01",), ("/r/20240101/02",), ("/r/20240101/09",)], "path string")
    got = {r.path: (r.children, r.ready_children, r.ready) for r in markers.folder_ready(hours, base).collect()}
    assert got == {"/r/20240101/01": (2, 1, False), "/r/20240101/02": (1, 1, True)}
