"""Skew, paths, ledger, readiness, markers, exports and the landing stream."""

import glob
import os

import pytest
from pyspark.sql import functions as F

import models
from logharbor import catalog as c
from logharbor.functions import wire
from logharbor.functions.times import render_template, time_bucket
from logharbor.operators import blocks as bl
from logharbor.operators import configs as cf
from logharbor.operators import files as fl
from logharbor.operators import ledger as lg
from logharbor.operators import readiness as rd
from logharbor.operators import reports as rp
from logharbor.plans import jobs
from logharbor.session import stored
from logharbor.sources import containers as boxes
from logharbor.sources import datasets, markers
from logharbor.sources import topic_log as tl
from logharbor.sources.events_log import YEAR
from logharbor.streaming import landing

H = 3_600_000
T0 = 1_704_067_200_000      # 2024-01-01 00:00 UTC


@pytest.fixture(scope="module")
def log(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "log")
    c._log(spark, sf_dir).drop("event_id").write.parquet(path)
    return tl.from_folder(spark, path)


@pytest.fixture(scope="module")
def configs(spark, sf_dir):
    return c._configs(spark, sf_dir)        # a stored table, so its size is known


def test_time_helpers(spark):
    df = spark.createDataFrame([(-1,), (-H - 1,), (T0 + 13 * H + 5,)], "ms long")
    got = df.select(time_bucket(F.col("ms"), 3600).alias("b"), render_template("a/%y%M%d/%H/%y", F.col("ms")).alias("r")).collect()
    assert [x.b for x in got] == [0, -H, T0 + 13 * H]          # truncation toward zero before 1970
    assert [x.r for x in got] == ["a/19691231/23/1969", "a/19691231/22/1969", "a/20240101/13/2024"]


def test_skew_thresholds(spark):
    base = [("t", 0, i, i, T0 + 10 * H, T0 + h * H + 5, bytearray(b"")) for i, h in enumerate((9, 10, 12, 5))]
    df = fl.file_keys(spark.createDataFrame(base, "topic string, partition int, offset long, arrival_seq long, arrival_ms long, ts_ms long, body binary"))
    flags = lambda **k: [r.skewed for r in fl.skew(df, **k).orderBy("offset").collect()]
    assert flags() == [False] * 4
    assert flags(future_s=7199) == [False, False, True, False]
    assert flags(future_s=7200) == [False] * 4
    assert flags(past_s=3600) == [False, False, False, True]
    assert flags(now_ms=T0, future_s=0) == [True] * 4
    moved = fl.skew(df, past_s=3600, prefix="odd_", data_dir="late", dir_to_now=True).orderBy("offset").collect()
    assert [(r.file_prefix, r.data_dir, r.dir_ms) for r in moved] == [
        ("", None, T0 + 9 * H), ("", None, T0 + 10 * H), ("", None, T0 + 12 * H), ("odd_", "late", T0 + 10 * H)]


def test_configs(spark):
    docs = [
        '{version: 1, id: "a", hdfsRootDir: "/x/%y%M%d/%H/a", proxyUser: "u", defaultDirectory: "data", filterSet: [ ]}',
        '{"version": 3, "id": "a", "hdfsRootDir": "/y/z/%y%M%d/%H/a", "defaultDirectory": "d3"}',
        '{version: 2, id: "a", hdfsRootDir: "/w/%y/a"}', '{version: 1, id: "b", hdfsRootDir: "/y/z/%y-%M/b", defaultDirectory: "d"}',
        '{version: 1, id: "c", hdfsRootDir: "/fixed/c", defaultDirectory: "d"}', "broken",
    ]
    table = cf.topic_configs(spark.createDataFrame([(d,) for d in docs], "json string"))
    assert sorted((r.id, r.version, r.hdfsRootDir) for r in table.collect()) == [
        ("a", 3, "/y/z/%y%M%d/%H/a"), ("b", 1, "/y/z/%y-%M/b"), ("c", 1, "/fixed/c")]
    assert sorted(tuple(r) for r in cf.unique_roots(table).collect()) == [("/fixed/c", 1), ("/y/z", 2)]
    lines = spark.createDataFrame([("a", T0 + H, None), ("b", T0, "late"), ("none", T0, None)], "topic string, dir_ms long, data_dir string")
    assert sorted((r.topic, r.path) for r in cf.render_paths(lines, table).collect()) == [
        ("a", "/y/z/20240101/01/a/d3"), ("b", "/y/z/2024-01/b/late")]


def test_stored_configs_are_broadcast_by_their_size(spark):
    """No job runs while the join is planned; a stored small table is broadcast, and not beyond the limit."""
    table = stored(spark.createDataFrame([("a", "/x/%H/a", "d")], "id string, hdfsRootDir string, defaultDirectory string"), "configs")
    big = stored(spark.range(50).select(F.col("id").cast("string").alias("topic")), "lines")
    plan = lambda: cf.configured(big, table)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        assert "BroadcastHashJoin" not in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


LINE = "topic string, partition int, arrival_seq long, arrival_ms long, ts_ms long, next_offset long, decode_status string, ts_source string"


def test_ledger_against_a_loop(spark):
    """Shift by shift: empty shifts store their end and carry the offset, future times are capped."""
    rows = [
        ("t", 0, 0, T0 + 10, T0 - 50, 1, "ok", "parsed"),
        ("t", 0, 1, T0 + 20, T0 + 20, 2, "short_envelope", "now"),
        ("t", 0, 2, T0 + 3 * H, T0 + 99 * H, 3, "ok", "parsed"),
        ("t", 0, 3, T0 + 3 * H + 5, T0 + 3 * H + 5, 4, "truncated_ts", "now"),
        ("t", 0, 4, T0 + 4 * H, T0 + 4 * H, 5, "ok", "now"),
    ]
    lines = spark.createDataFrame(rows, LINE)
    as_of = T0 + 5 * H + 29_999
    spine = lg.shift_spine(lines, until_ms=as_of)
    out = lambda **k: [(r.shift, r.next_offset, r.max_ts_ms, r.offset_ts_ms, r.consumed)
                       for r in lg.shift_ledger(lines, spine, as_of, **k).orderBy("shift").collect()]
    full = [(1, 2, T0 - 50, T0 - 50, 2), (2, 2, -1, T0 + 2 * H, 0), (3, 2, -1, T0 + 3 * H, 0),
            (4, 4, T0 + 99 * H, as_of, 2), (5, 5, T0 + 4 * H, T0 + 4 * H, 1), (6, 5, -1, T0 + 6 * H, 0)]
    assert out() == full
    assert out(final_only=True) == full[:4]
    assert out(parsed_only=True)[4] == (5, 5, -1, T0 + 5 * H, 1)
    current = lg.current_ledger(lg.shift_ledger(lines, spine, as_of)).first()
    assert (current.shift, current.next_offset) == (6, 5)


def test_readiness(spark):
    parts = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("b", 1)], "topic string, partition int")
    ledger = spark.createDataFrame([("a", 0, T0 + 5 * H), ("a", 1, T0 + 3 * H), ("b", 0, T0 + 9 * H)], "topic string, partition int, offset_ts_ms long")
    water = rd.low_water(parts, ledger)
    assert sorted((r.topic, r.low_water_ms, r.partitions, r.reporting) for r in water.collect()) == [
        ("a", T0 + 3 * H, 2, 2), ("b", None, 2, 1)]
    configs = spark.createDataFrame([("a", "/r/%y%M%d/%H/a", "data"), ("b", "/r/%y%M%d/%H/b", "data")], "id string, hdfsRootDir string, defaultDirectory string")
    flags = spark.createDataFrame([("a", T0 + H)], "topic string, hour_ms long")
    due = lambda **k: sorted((r.topic, (r.hour_ms - T0) // H) for r in rd.due_hours(water, configs, flags, T0 + 6 * H + 5, hours=6, **k).collect())
    assert due() == [("a", 0), ("a", 2)]        # hour 3 starts at the mark, hour 1 is flagged
    ledger2 = ledger.union(spark.createDataFrame([("b", 1, T0 + 2 * H + 1)], ledger.schema))
    water2 = rd.low_water(parts, ledger2)
    both = rd.due_hours(water2, configs, flags, T0 + 6 * H, hours=6)
    strict = rd.due_hours(water2, configs, flags, T0 + 6 * H, hours=6, strict=True)
    pick = lambda df: sorted((r.topic, (r.hour_ms - T0) // H) for r in df.collect())
    assert pick(both) == [("a", 0), ("a", 2), ("b", 0), ("b", 1), ("b", 2)]
    assert pick(strict) == [("a", 0), ("a", 2), ("b", 0), ("b", 1)]
    dirs = spark.createDataFrame([("r", "a", T0), ("r", "b", T0), ("r", "a", T0 + H), ("r", "a", T0 + 30 * H)], "root string, topic string, hour_ms long")
    marked = spark.createDataFrame([("a", T0), ("a", T0 + H), ("b", T0 + H), ("a", T0 + 30 * H)], "topic string, hour_ms long")
    hours = rd.hour_ready(dirs, marked, ["root"])
    assert sorted(((r.hour_ms - T0) // H, r.topics, r.ready_topics, r.ready) for r in hours.collect()) == [
        (0, 2, 1, False), (1, 1, 1, True), (30, 1, 1, True)]
    assert sorted((r.hours, r.ready_hours, r.ready) for r in rd.day_ready(hours, ["root"]).collect()) == [
        (1, 1, True), (2, 1, False)]


def test_markers(spark, tmp_path):
    base = str(tmp_path)
    due = spark.createDataFrame([("a", 1, "/x/a", "/x/a/data"), ("b", 1, "/x/b", "/x/b/data")], "topic string, hour_ms long, topic_path string, data_path string")
    paths = rd.flag_paths(due)
    assert markers.write_flags(paths, base) == 4
    assert markers.write_flags(paths, base) == 4
    found = sorted(glob.glob(f"{base}/x/**/_READY", recursive=True))
    assert [os.path.relpath(p, base) for p in found] == ["x/a/_READY", "x/a/data/_READY", "x/b/_READY", "x/b/data/_READY"]
    assert all(os.path.getsize(p) == 0 for p in found)
    dirs = spark.createDataFrame([("/x/a",), ("/x/none",)], "path string")
    assert sorted(tuple(r) for r in markers.with_flag(dirs, base).collect()) == [("/x/a", True), ("/x/none", False)]


def test_dataset_prunes_folders(spark, log, tmp_path):
    lines = fl.file_keys(wire.landable(wire.decode(log, YEAR)), 86_400)
    root = str(tmp_path / "ds")
    datasets.write_dataset(lines.select("topic", "partition", "offset", "arrival_seq", "bucket_ms", "ts_ms", "body"), root)
    back = datasets.read_dataset(spark, root)
    assert back.count() == log.count()
    picked = back.filter("topic = 'click' AND day = '2024-01-05'")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan and "click" in plan
    assert picked.count() == lines.filter("topic = 'click' AND bucket_ms = 1704412800000").count()


@pytest.mark.parametrize("roll_rows", [1 << 20, 7])
def test_export_range(spark, sf_dir, tmp_path, roll_rows):
    whole = c._log(spark, sf_dir, disturbed=False)
    path = str(tmp_path / "one.bm")
    for _ in range(2):
        jobs.export_range(whole, "view", 1, 5, 30, path, YEAR, level=1, roll_rows=roll_rows)
    assert sorted(os.listdir(tmp_path)) == ["one.bm"]
    want = wire.decode(whole.filter("topic = 'view' AND partition = 1 AND offset BETWEEN 5 AND 30"), YEAR).orderBy("offset").collect()
    got = boxes.read_lines(spark, path).orderBy("block_number", "idx").collect()
    assert [(r.ts_ms, bytes(r.message)) for r in got] == [(r.ts_ms, bytes(r.body)) for r in want]
    numbers = sorted({r.block_number for r in got})
    assert numbers == list(range(len(numbers)))
    with pytest.raises(Exception, match="offset anomaly"):
        jobs.export_range(c._log(spark, sf_dir), "view", 1, 0, 200, str(tmp_path / "bad.bm"), YEAR)
    assert sorted(os.listdir(tmp_path)) == ["one.bm"]


def test_landing_shuffles_wide_rows_once(spark, log, configs):
    """From the log to container bytes, rows that carry a message cross one exchange."""
    lines = jobs.prepared_lines(log, 0, YEAR)
    placed = cf.render_paths(lines, configs).withColumn("file", F.concat("path", F.lit("/"), "file_name"))
    boxed = boxes.containers(bl.log_blocks(placed, keep=["file"]), "file", fl.FILE_KEY)
    boxed.write.format("noop").mode("overwrite").save()
    plan = boxed._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len([e for e in exchanges if "roll" in e]) <= 3 and not any("bucket_ms" in e for e in exchanges)


def test_timestamp_report(spark, sf_dir):
    whole = c._log(spark, sf_dir, disturbed=False)
    report = jobs.timestamp_report(whole, "click", 0, 0, 40, YEAR)
    direct = rp.timestamp_histogram(wire.decode(whole.filter("topic='click' AND partition=0 AND offset<=40"), YEAR))
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, direct.collect()))
    with pytest.raises(Exception, match="offset anomaly"):
        jobs.timestamp_report(c._log(spark, sf_dir), "click", 0, 0, 40, YEAR).collect()


def batch_lines(log, configs):
    decoded = wire.decode(c.of.accepted_rows(c.of.offset_audit(log)), YEAR)
    return cf.configured(wire.landable(decoded), configs)


def landed(spark, root):
    return sorted((r.ts_ms, bytes(r.message)) for r in boxes.read_lines(spark, root).collect())


def test_stream_equals_batch_and_replay_changes_nothing(spark, log, configs, tmp_path):
    base = str(tmp_path)
    cuts = [0, 1_704_931_200_000, 1_705_795_200_000, 2**62]
    for lo, hi in zip(cuts, cuts[1:]):
        part = log.filter((F.col("arrival_ms") >= lo) & (F.col("arrival_ms") < hi))
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
    options = landing.LandingOptions(f"{base}/out", f"{base}/ledger", f"{base}/ckpt", YEAR, seconds=86_400)
    stream = tl.from_folder(spark, f"{base}/in", streaming=True, files_per_trigger=1)
    landing.landing_stream(stream, configs, options).awaitTermination()
    ledger = landing.read_ledger(spark, options.ledger)
    assert sorted(r.batch_id for r in ledger.select("batch_id").distinct().collect()) == [0, 1, 2]

    want = sorted((r.ts_ms, bytes(r.body)) for r in batch_lines(log, configs).collect())
    assert landed(spark, options.root) == want
    names = sorted(glob.glob(f"{options.root}/**/*", recursive=True))

    middle = log.filter((F.col("arrival_ms") >= cuts[1]) & (F.col("arrival_ms") < cuts[2]))
    before = sorted(map(tuple, ledger.collect()))
    landing.land_batch(middle, 1, configs, options)
    assert landed(spark, options.root) == want
    assert sorted(glob.glob(f"{options.root}/**/*", recursive=True)) == names
    assert sorted(map(tuple, landing.read_ledger(spark, options.ledger).collect())) == before
    ends = {(r.topic, r.partition): r.start_offset for r in landing.read_offsets(spark, options.ledger, 2).collect()}
    audited = c.of.accepted_rows(c.of.offset_audit(log)).groupBy("topic", "partition").agg(F.max("next_offset").alias("n"))
    assert ends == {(r.topic, r.partition): r.n for r in audited.collect()}

    # The stream's totals lead to the ledger the batch computes.
    decoded = wire.decode(c.of.accepted_rows(c.of.offset_audit(log)), YEAR)
    spine = lg.shift_spine(log, 86_400, c.AS_OF_MS)
    batch = lg.shift_ledger(decoded, spine, c.AS_OF_MS, 86_400)
    streamed = lg.ledger_from_totals(landing.landed_shifts(spark, options.ledger), spine, c.AS_OF_MS)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_first_batch_starts_at_zero_and_stream_can_sink(spark, log, configs, tmp_path):
    base = str(tmp_path)
    options = landing.LandingOptions(
        f"{base}/out", f"{base}/ledger", f"{base}/ckpt", YEAR, seconds=86_400, sink_to_watermark=True, drop_truncated=True)
    landing.land_batch(log, 0, configs, options)
    decoded = wire.decode(c.of.accepted_rows(c.of.sink_to_high_watermark(log)), YEAR)
    want = cf.configured(wire.landable(decoded, drop_truncated=True), configs)
    assert landed(spark, options.root) == sorted((r.ts_ms, bytes(r.body)) for r in want.collect())


def test_starting_offsets_json(spark):
    start = spark.createDataFrame([("a", 0, 5), ("a", 1, 0), ("b", 0, 7)], "topic string, partition int, start_offset long")
    assert tl.starting_offsets(start) in ('{"a": {"0": 5, "1": 0}, "b": {"0": 7}}', '{"b": {"0": 7}, "a": {"0": 5, "1": 0}}') or \
        __import__("json").loads(tl.starting_offsets(start)) == {"a": {"0": 5, "1": 0}, "b": {"0": 7}}


LOG = "topic string, partition int, offset long, high_watermark long, arrival_seq long, arrival_ms long, value binary"


def batches(spark, tmp_path, parts, **options):
    """State after each batch of (offset, watermark, arrival_ms) rows, and the landed messages."""
    opts = landing.LandingOptions(f"{tmp_path}/out", f"{tmp_path}/ledger", f"{tmp_path}/ckpt", YEAR, seconds=86_400, **options)
    configs = spark.createDataFrame([(1, "t", "/logs/%y%M%d/t", "u", "data", [])], cf.CONFIG_DDL)
    states, seq = [], 0
    for k, rows in enumerate(parts):
        data = [("t", 0, o, h, seq + i, ms, bytearray(f"m{o}".encode())) for i, (o, h, ms) in enumerate(rows)]
        seq += len(rows)
        landing.land_batch(spark.createDataFrame(data, LOG), k, configs, opts)
        states.append(landing.read_offsets(spark, opts.ledger, k).first().start_offset)
    return states, sorted(m.decode() for _, m in landed(spark, opts.root))


def test_state_follows_arrival_not_time(spark, tmp_path):
    """Rows stamped before the hour that an earlier row opened do not move the state back."""
    first = [(0, 9, T0 + H - 5), (1, 9, T0 + H + 5), (2, 9, T0 + H - 4), (3, 9, T0 + H - 3)]
    states, lines = batches(spark, tmp_path, [first, first[2:] + [(4, 9, T0 + 2 * H)]])
    assert states == [4, 5] and lines == ["m0", "m1", "m2", "m3", "m4"]


def test_reset_on_the_border_is_kept(spark, tmp_path):
    rows = [(o, 9, T0 + o) for o in range(5)] + [(2, 3, T0 + 9)]
    states, lines = batches(spark, tmp_path, [rows, [(3, 9, T0 + 10), (4, 9, T0 + 11)]], sink_to_watermark=True)
    assert states == [3, 5] and lines == ["m0", "m1", "m2", "m3", "m3", "m4", "m4"]


def test_many_resets_in_a_batch(spark, tmp_path, monkeypatch):
    """Every second row of two batches resets; what a landing keeps of a row does not grow with the resets of its slice."""
    rows = [(o, mark, T0 + k) for k in range(300) for o, mark in ((3 * k + 9, 10**6), (3 * k, 3 * k + 2))]
    frames, decode = [], landing.decode
    monkeypatch.setattr(landing, "decode", lambda audited, *a: frames.append(audited) or decode(audited, *a))
    states, lines = batches(spark, tmp_path, [rows[:250], rows[250:]], sink_to_watermark=True)
    walked = models.audit([(o, mark) for o, mark, _ in rows], 0, True)
    assert sum(status == "beyond_hw" for _, status, _ in walked) == 300
    assert states == [walked[249][2], walked[-1][2]]
    assert lines == sorted(f"m{o}" for (o, _, _), (_, status, _) in zip(rows, walked) if status in ("ok", "gap"))
    for nodes in ([f._jdf.queryExecution().optimizedPlan()] for f in frames):
        for node in nodes:
            nodes += [node.children().apply(k) for k in range(node.children().size())]
            assert not any(node.output().apply(k).dataType().typeName() == "array" for k in range(node.output().size()))


def test_offsets_of_a_stream_leave_the_log_in_place(spark, sf_dir, monkeypatch):
    """The log is shuffled once, while it is numbered; where its batches end is broadcast to its rows."""
    kept, batched, store, land = [], [], c.stored, landing.land_batch
    monkeypatch.setattr(c, "stored", lambda df, name: kept.append(df) or store(df, name))
    monkeypatch.setattr(landing, "land_batch", lambda batch, *a: batched.append(batch) or land(batch, *a))
    c.QUERIES["landing_stream_offsets"](spark, sf_dir).collect()
    assert [models.shuffles_of(df, "value", broadcast=-1) for df in kept if "value" in df.columns] == [1]
    assert [models.shuffles_of(df, "value", broadcast=10 << 20) for df in batched] == [0, 0]


def test_dropped_batch_keeps_the_state(spark, tmp_path):
    states, lines = batches(spark, tmp_path, [[(0, 9, T0), (1, 9, T0)], [(0, 9, T0)], [(2, 9, T0)]])
    assert states == [2, 2, 3] and lines == ["m0", "m1", "m2"]


def test_lost_snapshot_fails(spark, tmp_path, configs):
    options = landing.LandingOptions(f"{tmp_path}/out", f"{tmp_path}/ledger", f"{tmp_path}/ckpt", YEAR)
    rows = spark.createDataFrame([("t", 0, 0, 1, 0, T0, bytearray(b"x"))], LOG)
    with pytest.raises(ValueError, match="no offsets of batch 7"):
        landing.land_batch(rows, 8, configs, options)
    assert landing.read_ledger(spark, options.ledger).count() == 0


def test_unknown_watermark(spark):
    """Rows of a broker log have none: an early row is early, passes the strict form, and resets nothing."""
    rows = [("t", 0, o, None, k, T0, bytearray(b"x")) for k, o in enumerate((0, 1, 0, 2))]
    log = spark.createDataFrame(rows, LOG)
    for audit in (c.of.offset_audit, c.of.sink_to_high_watermark):
        got = audit(log).orderBy("arrival_seq").collect()
        assert [r.status for r in got] == ["ok", "ok", "early", "ok"] and [r.next_offset for r in got] == [1, 2, 2, 3]
        assert [r.lag for r in got] == [None] * 4
    assert c.of.strict_offsets(c.of.offset_audit(log)).count() == 3
    bounds = spark.createDataFrame([("t", 0, 7)], "topic string, partition int, latest long")
    filled = tl.with_watermarks(log, bounds)
    assert filled.columns == log.columns and {r.high_watermark for r in filled.collect()} == {7}


def test_start_table_is_used_once(spark, tmp_path):
    start = spark.createDataFrame([("t", 0, 2)], "topic string, partition int, start_offset long")
    states, lines = batches(spark, tmp_path, [[(1, 9, T0), (2, 9, T0)], [(1, 9, T0), (3, 9, T0)]], start=start)
    assert states == [3, 4] and lines == ["m2", "m3"]


def test_readiness_reads_no_log(spark, sf_dir):
    plan = c.QUERIES["ready_flags"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "event_id" not in plan and "props" not in plan and "Window" not in plan


def test_stored_deflate_blocks():
    import zlib
    for n in (0, 1, 65_535, 65_536, 200_000):
        data = bytes(range(256)) * (n // 256) + bytes(n % 256)
        packed = boxes._deflate(data, 0)
        assert zlib.decompress(packed, -15) == data and len(packed) == n + 5 * max(1, -(-n // 65_535))
