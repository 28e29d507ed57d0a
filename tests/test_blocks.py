"""Blocks and containers against a sequential packer, and the byte-exact round trip."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

import models
from logharbor.functions.encoding import varint_len
from logharbor.operators.blocks import canonical_order, explode_blocks, log_blocks
from logharbor.operators.files import FILE_KEY, file_keys
from logharbor.sources import containers as boxes

DDL = "topic string, partition int, offset long, arrival_seq long, arrival_ms long, ts_ms long, body binary"


def make_lines(seed, n=400, big=False):
    rng = random.Random(seed)
    rows, ts = [], 1_704_000_000_000
    for i in range(n):
        ts += rng.choice([0, 0, 1, 300, 900, -700, 4_000_000 if i % 97 == 0 else 0])
        size = rng.randrange(0, 900 if big else 30)
        rows.append(("t", i % 2, i // 2, i // 2, 1_704_000_000_000 + i * 20_000, ts,
                     bytearray(rng.randbytes(size))))
    return rows


def keyed(spark, rows, **options):
    return file_keys(spark.createDataFrame(rows, DDL).repartition(5), **options)


def expect(lines, cap, max_lines=None):
    want = {}
    key = lambda r: tuple(r[c] for c in FILE_KEY)
    for k, group in models.by_key(lines, key).items():
        group = sorted(group, key=lambda r: r.arrival_seq)
        want[k] = (group[0].file_name, models.blocks([(r.ts_ms, r.arrival_ms, bytes(r.body)) for r in group], cap, max_lines))
    return want


@pytest.mark.parametrize("cap,max_lines", [(1_048_535, None), (1500, None), (700, 3), (30, None), (1_048_535, 2)])
def test_blocks_match_sequential_packer(spark, cap, max_lines):
    lines = keyed(spark, make_lines(cap, big=cap > 600), seconds=3600, roll_rows=64)
    got = {}
    for r in log_blocks(lines, keep=["file_name"], cap_bytes=cap, max_lines=max_lines).collect():
        k = tuple(r[c] for c in FILE_KEY)
        body = [(x.ms, bytes(x.message)) for x in r.log_lines]
        got.setdefault((k, r.file_name), []).append((r.second, r.create_time, r.block_number, body))
    got = {k: sorted(v, key=lambda b: b[2]) for k, v in got.items()}
    want = {(k, name): b for k, (name, b) in expect(lines.collect(), cap, max_lines).items()}
    assert got == want


def test_file_name_is_offset_after_first_line(spark):
    rows = keyed(spark, make_lines(3), roll_rows=50).collect()
    for group in models.by_key(rows, lambda r: tuple(r[c] for c in FILE_KEY)).values():
        first = min(group, key=lambda r: r.arrival_seq)
        assert {r.file_name for r in group} == {f"t-{first.partition}-{first.offset + 1}.bm"}
        assert {r.opened_ms for r in group} == {first.arrival_ms}


def test_span_mark_only_adds_cuts(spark):
    rows = [("t", 0, i, i, 0, 5, bytearray(b"x" * 100)) for i in range(200)]
    out = log_blocks(keyed(spark, rows), cap_bytes=1000, span_bytes=2000).orderBy("block_number").collect()
    assert sum(len(r.log_lines) for r in out) == 200
    assert [r.block_number for r in out] == list(range(len(out)))
    assert max(len(r.log_lines) for r in out) == 9


@pytest.mark.parametrize("n", [0, 1, -1, 63, 64, -64, -65, 8191, 8192, 2**31, -(2**31), 2**62, 2**63 - 1, -(2**63)])
def test_varint(spark, n):
    data = boxes._long_bytes(n)
    row = spark.createDataFrame([(n,)], "n long").select(varint_len(F.col("n")).alias("size")).first()
    assert row.size == len(data)
    assert boxes._read_long(data, 0) == (n, len(data))
    assert n not in range(8192) or boxes._small_numbers()[n] == data


@pytest.mark.parametrize("level,split,cap", [(6, 128 << 20, 1_048_535), (1, 700, 2000), (9, 300, 50)])
def test_round_trip(spark, tmp_path, level, split, cap):
    lines = keyed(spark, make_lines(level, n=1200, big=True), roll_rows=200).withColumn(
        "file", F.concat(F.lit("day/"), "bucket_ms", F.lit("/"), "file_name"))
    root = str(tmp_path / "out")
    blocks = log_blocks(lines, keep=["file"], cap_bytes=cap)
    boxes.write_containers(boxes.containers(blocks, "file", FILE_KEY, 4000), root, level)
    back = boxes.read_lines(spark, root, split)
    strip = F.regexp_replace("file", f"^{root}/", "")
    got = sorted(tuple(r) for r in back.withColumn("file", strip).select("file", "block_number", "idx", "second", "create_time", "ts_ms", "message").collect())
    want = sorted(tuple(r) for r in explode_blocks(blocks, ["file"]).select("file", "block_number", "idx", "second", "create_time", "ts_ms", "message").collect())
    assert got == want
    assert len(got) == 1200
    stats = boxes.read_container_stats(spark, root)
    sizes = boxes.container_sizes(boxes.containers(blocks, "file", FILE_KEY, 4000), level)
    total = lambda df: df.agg(F.sum("records"), F.sum("raw_bytes"), F.sum("compressed_bytes"), F.count("*")).first()
    assert total(stats) == total(sizes)
    if split < 1000:
        assert back.rdd.getNumPartitions() > len(glob.glob(f"{root}/**/*.bm", recursive=True))


def test_splits_cover_every_byte_once():
    files = [("a", 0), ("b", 10), ("c", 1000), ("d", 3)]
    for size in (4, 64, 10**9):
        splits = boxes.pack_splits(files, size)
        got = sorted((r.path, r.start, r.end) for s in splits for r in s.ranges)
        for path, length in files:
            mine = [(s, e) for p, s, e in got if p == path]
            assert [s for s, _ in mine] + [length] == [0] * (length > 0) + [e for _, e in mine] or length == 0 and not mine
    assert len(boxes.pack_splits(files, 10**9)) == 1 and len(boxes.pack_splits(files, 100)) > 10


def test_odd_messages_round_trip(spark, tmp_path):
    bodies = [b"", b"\xff\xfe\x00", b"x" * 1_200_000, b"y" * 1_048_500, "é".encode(), b"\n"]
    rows = [("t", 0, i, i, 0, -1500 + i, bytearray(b)) for i, b in enumerate(bodies)]
    root = str(tmp_path / "odd")
    lines = keyed(spark, rows).withColumn("file", F.col("file_name"))
    boxes.write_lines(lines, root)
    back = canonical_order(boxes.read_lines(spark, root)).collect()
    assert [bytes(r.message) for r in back] == bodies
    assert [r.ts_ms for r in back] == [-1500 + i for i in range(6)]


def test_container_is_readable_by_avro(spark, tmp_path):
    """The JVM's own Avro reader accepts the files (it wants an .avro name)."""
    root = str(tmp_path / "avro")
    rows = [("t", 0, i, i, 0, 1000 * (i // 3), bytearray(b"line %d" % i)) for i in range(10)]
    boxes.write_lines(keyed(spark, rows).withColumn("file", F.regexp_replace("file_name", "bm$", "bm.avro")), root)
    text = spark.sparkContext.hadoopFile(
        root, "org.apache.avro.mapred.AvroAsTextInputFormat", "org.apache.hadoop.io.Text", "org.apache.hadoop.io.Text"
    ).keys().collect()
    assert len(text) == 4 and '"second": 0' in sorted(text)[0] and '"message": "line 9"' in "".join(text)


def test_overwrite_and_failed_write(spark, tmp_path):
    root = str(tmp_path / "ow")
    rows = make_lines(1, n=60)
    lines = keyed(spark, rows).withColumn("file", F.col("file_name"))
    boxes.write_lines(lines, root)
    boxes.write_lines(lines, root)
    assert boxes.read_lines(spark, root).count() == 60
    boxes.write_lines(lines.filter("partition = 0"), root, mode="overwrite")
    assert boxes.read_lines(spark, root).count() == 30
    bad = lines.withColumn("ts_ms", F.when(F.col("offset") == 29, F.raise_error(F.lit("broken line")).cast("long")).otherwise(F.col("ts_ms")))
    before = sorted(os.listdir(root))
    with pytest.raises(Exception):
        boxes.write_lines(bad, root)
    assert sorted(os.listdir(root)) == before


def test_one_shuffle_from_lines_to_containers(spark):
    lines = keyed(spark, make_lines(2, n=50)).withColumn("file", F.col("file_name"))
    plan = boxes.containers(log_blocks(lines, keep=["file"]), "file", FILE_KEY)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_long_header_is_read_whole(spark, tmp_path):
    """Metadata longer than the first read of a file."""
    root = str(tmp_path / "long")
    rows = [("t", 0, i, i, 0, i, bytearray(b"line")) for i in range(5)]
    boxes.write_lines(keyed(spark, rows).withColumn("file", F.col("file_name")), root)
    path, = glob.glob(f"{root}/*.bm")
    data = open(path, "rb").read()
    extra = boxes._long_bytes(1) + boxes._long_bytes(4) + b"note" + boxes._long_bytes(200_000) + b"n" * 200_000
    open(path, "wb").write(data[:4] + extra + data[4:])
    assert boxes.read_lines(spark, root).count() == 5
    open(path, "wb").write((data[:4] + extra)[:150_000])
    with pytest.raises(Exception, match="header cut short"):
        boxes.read_lines(spark, root).count()


def test_files_of_killed_attempts_are_swept(spark, tmp_path):
    root = tmp_path / "swept"
    rows = [("t", 0, i, i, 0, i, bytearray(b"line")) for i in range(5)]
    lines = keyed(spark, rows).withColumn("file", F.col("file_name"))
    boxes.write_lines(lines, str(root))
    name, = [p.name for p in root.glob("*.bm")]
    (root / f"_tmp_{name}.dead").write_bytes(b"half")
    (root / "_tmp_other.bm.dead").write_bytes(b"half")
    boxes.write_lines(lines, str(root))
    assert sorted(p.name for p in root.iterdir()) == ["_tmp_other.bm.dead", name]


def test_only_the_asked_folders_are_opened(spark, tmp_path):
    root = str(tmp_path / "tree")
    rows = [("t", 0, i, i, 0, i * 86_400_000, bytearray(b"day%d" % i)) for i in range(6)]
    lines = keyed(spark, rows, seconds=86_400).withColumn("file", F.concat(F.lit("1970010"), (F.col("bucket_ms") / 86_400_000 + 1).cast("int"), F.lit("/"), "file_name"))
    boxes.write_lines(lines, root)
    for day in (1, 5):                      # files of other days cannot be read any more
        path, = glob.glob(f"{root}/1970010{day}/*.bm")
        open(path, "wb").write(b"broken")
    got = boxes.read_folders(spark, root, "%y%M%d", 86_400_000, 2 * 86_400_000, 86_400).collect()
    assert sorted(bytes(r.message) for r in got) == [b"day1", b"day2"]
    assert boxes.read_folders(spark, root, "%y%M%d/%H", 10**12, 10**12).count() == 0
