"""Offset audit, strict and resetting forms against the sequential loop on random logs."""

import random

import pytest

import models
from logharbor.operators import offsets as of

DDL = "topic string, partition int, offset long, high_watermark long, arrival_seq long, payload string"


def random_log(seed, n=300, weird=False):
    """Mostly rising offsets with gaps, repeats and watermarks that fall back."""
    rng = random.Random(seed)
    rows, nxt = [], {}
    for i in range(n):
        key = ("a", rng.randrange(2)) if rng.random() < 0.8 else ("b", 0)
        at = nxt.get(key, rng.choice([0, 3]))
        kind = rng.random()
        offset = at if kind < 0.7 else at + rng.randrange(1, 5) if kind < 0.8 else max(0, at - rng.randrange(1, 8))
        nxt[key] = max(at, offset + 1)
        low = -3 if weird else 1
        mark = offset + rng.randrange(low, 4) if rng.random() < 0.4 else nxt[key] + rng.randrange(0, 50)
        rows.append((*key, offset, mark, i * 3 + rng.randrange(3), f"p{i}"))
    return rows


def sequential(rows, start, sink):
    want = {}
    for key, group in models.by_key(rows, lambda r: r[:2]).items():
        group.sort(key=lambda r: r[4])
        walked = models.audit([(r[2], r[3]) for r in group], start.get(key, 0), sink)
        for r, (expected, status, after) in zip(group, walked):
            want[(*key, r[4])] = (expected, status, after, r[5])
    return want


def got(df):
    return {
        (r.topic, r.partition, r.arrival_seq): (r.expected, r.status, r.next_offset, r.payload)
        for r in df.collect()
    }


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("slice_rows", [7, 1 << 20])
def test_audit_matches_loop(spark, seed, slice_rows):
    rows = random_log(seed, weird=seed % 2 == 1)
    log = spark.createDataFrame(rows, DDL).repartition(6)
    assert got(of.offset_audit(log, 2, slice_rows)) == sequential(rows, {("a", 0): 2, ("a", 1): 2, ("b", 0): 2}, False)
    start = spark.createDataFrame([("a", 1, 40)], "topic string, partition int, start_offset long")
    assert got(of.offset_audit(log, start, slice_rows)) == sequential(rows, {("a", 1): 40}, False)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("slice_rows", [5, 60])
def test_sinking_matches_loop(spark, seed, slice_rows):
    rows = random_log(seed, n=200, weird=seed % 2 == 1)
    log = spark.createDataFrame(rows, DDL).repartition(3)
    start = spark.createDataFrame([("a", 1, 90)], "topic string, partition int, start_offset long")
    want = sequential(rows, {("a", 1): 90}, True)
    assert got(of.sink_to_high_watermark(log, start, slice_rows)) == want
    assert any(s == "beyond_hw" for _, s, _, _ in want.values())


def test_many_resets_in_a_slice(spark):
    """Every second row resets; no row carries a list of the points of its slice."""
    rows = [("t", 0, o, o + 2, 4 * k + 2 * again, f"p{k}") if again else ("t", 0, o, 10**6, 4 * k, f"p{k}")
            for k in range(1500) for again, o in ((0, 3 * k + 9), (1, 3 * k))]
    rows += [("t", 0, 5, 6, 4 * 700, "tied"), ("t", 0, 4, 5, 4 * 700 + 1, "after")]
    rows.sort(key=lambda r: r[4])
    rows = [(*r[:4], k, r[5]) for k, r in enumerate(rows)]
    log = spark.createDataFrame(rows, DDL).repartition(3)
    audited = of.sink_to_high_watermark(log)
    assert got(audited) == sequential(rows, {}, True)
    assert audited.filter("status = 'beyond_hw'").count() > 1000
    nodes = [audited._jdf.queryExecution().optimizedPlan()]
    for node in nodes:
        nodes += [node.children().apply(k) for k in range(node.children().size())]
        assert not any(node.output().apply(k).dataType().typeName() == "array" for k in range(node.output().size()))


def test_resets_shuffle_the_rows_once(spark):
    """Where a slice resets and nothing is broadcast, one shuffle serves the join with the slices and the windows."""
    rows = [("t", 0, o, mark, 2 * k + again, f"p{k}") for k in range(60) for again, o, mark in ((0, 3 * k + 9, 10**6), (1, 3 * k, 3 * k + 2))]
    log = spark.createDataFrame(rows, DDL)
    for slice_rows in (1000, 16):
        audited = of.sink_to_high_watermark(log, 0, slice_rows)
        assert models.shuffles_of(audited, "payload", broadcast=-1) == 1
        assert got(audited) == sequential(rows, {}, True)


def test_function_of_a_slice():
    """The three-number summary equals walking the rows, for every start."""
    rng = random.Random(5)
    for _ in range(400):
        rows = [(o := rng.randrange(12), o + rng.randrange(-4, 6)) for _ in range(rng.randrange(1, 6))]
        step, a, b, t = of._compose([o for o, _ in rows], [h for _, h in rows])
        for e in range(-2, 20):
            x = e
            for o, h in rows:
                x = of._advance(x, o, h)
            assert x == ((a if e <= t else b) if step else of._clamp(e, a, b)), (rows, e)


def test_strict(spark):
    def log(offsets, mark=100):
        rows = [("t", 0, o, mark, i, "") for i, o in enumerate(offsets)]
        return of.strict_offsets(of.offset_audit(spark.createDataFrame(rows, DDL), 5))

    assert [r.offset for r in log([4, 5, 6, 5, 7]).orderBy("offset").collect()] == [5, 6, 7]
    with pytest.raises(Exception, match="offset anomaly: gap t 0 expected 7 got 9"):
        log([5, 6, 9]).count()
    with pytest.raises(Exception, match="offset anomaly: beyond_hw"):
        log([5, 6, 5], mark=6).count()


def test_missing_ranges_and_scan(spark):
    log = spark.createDataFrame([("t", 0, o, 100, o, "") for o in (0, 1, 5, 9)], DDL)
    gaps = of.missing_ranges(of.offset_audit(log)).orderBy("missing_from").collect()
    assert [(r.missing_from, r.missing_to, r.gap) for r in gaps] == [(2, 4, 3), (6, 8, 3)]
    assert sorted(r.offset for r in of.range_scan(log, "t", 0, 1, 5).collect()) == [1, 5]


def test_resume_and_reset(spark):
    parts = spark.createDataFrame([("t", i) for i in range(4)], "topic string, partition int")
    ledger = spark.createDataFrame([("t", 0, 10), ("t", 1, 20)], "topic string, partition int, next_offset long")
    over = spark.createDataFrame([("t", 1, 7), ("t", 2, 8)], "topic string, partition int, offset_override long")
    rows = lambda df: sorted((r.partition, r.resume_offset, r.override_consumed) for r in df.collect())
    assert rows(of.resume_offsets(parts, ledger, over)) == [(0, 10, False), (1, 7, True), (2, 0, False), (3, 0, False)]
    off = of.resume_offsets(parts, ledger, over, allow_overrides=False)
    assert rows(off) == [(0, 10, False), (1, 20, False), (2, 0, False), (3, 0, False)]
    bounds = spark.createDataFrame([("t", i, 3, 12) for i in range(3)], "topic string, partition int, earliest long, latest long")
    start = lambda p: sorted((r.partition, r.start_offset) for r in of.reset_out_of_range(off, bounds, p).collect())
    assert start("smallest") == [(0, 10), (1, 3), (2, 3), (3, 0)]
    assert start("largest") == [(0, 10), (1, 12), (2, 12), (3, 0)]
    with pytest.raises(ValueError):
        of.reset_out_of_range(off, bounds, "middle")


def test_audit_windows_are_sliced(spark):
    """No window over rows is partitioned by the topic-partition alone."""
    log = spark.createDataFrame(random_log(1), DDL)
    plan = of.offset_audit(log)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2
    row_level = [w for w in windows if "max(offset" in w]
    assert row_level and all("roll" in w.split("],")[1] for w in row_level)


def test_sinking_joins_wide_rows_on_their_slice_only(spark, sf_dir):
    from logharbor import catalog as c

    plan = c.of.sink_to_high_watermark(c._log(spark, sf_dir).drop("event_id"))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("arrival_seq" in e.split("]")[0].split("ENSURE")[0] for e in exchanges)
