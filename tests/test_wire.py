"""Golden vectors for the message decoder."""

import pytest
from pyspark.sql import functions as F

from logharbor.functions import wire

BASE = 1399482308000
ARRIVAL = 777


def run(spark, values, year=2014):
    rows = [(i, bytearray(v if isinstance(v, bytes) else v.encode()), ARRIVAL) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, value binary, arrival_ms long")
    return wire.decode(df, year).orderBy("i").collect()


# Fixed golden values: stamps, their epoch milliseconds and their length in bytes.
STAMPS = [
    ("2014-06-02T17:56:12.219+0000 x", 1401731772219, 28),
    ("2014-05-07T17:05:08.123 x", BASE + 123, 23),
    ("2014-05-07T17:05:08.123000 x", BASE + 123, 26),
    ("2014-05-07T17:05:08.12 x", BASE + 120, 22),
    ("2014-05-07T17:05:08.1 x", BASE + 100, 21),
    ("2014-05-07T17:05:08. x", BASE, 20),
    ("2014-05-07T17:05:08 x", BASE, 19),
    ("May 07 17:05:08.123 x", BASE + 123, 19),
    ("May  7 17:05:08.123 x", BASE + 123, 19),
    ("<1>1 2014-05-07T17:05:08 x", BASE, 19),
    ("2014-05-07T17:05:08Z x", BASE, 20),
    ("2014-05-07T17:05:08+01 x", BASE - 3600_000, 22),
    ("2014-05-07T17:05:08+0130 x", BASE - 5400_000, 24),
    ("2014-05-07T17:05:08+01:30 x", BASE - 5400_000, 25),
    ("2014-05-07T17:05:08-01:30 x", BASE + 5400_000, 25),
    ("2014-05-07T17:05:08+01: x", BASE - 3600_000, 23),
    ("2014-13-01T00:00:00", 1420070400000, 19),
    ("2014-00-01T00:00:00", 1385856000000, 19),
    ("2014-01-32T25:60:60 x", 1391306460000, 19),
    ("20140507170508 x", BASE, 14),
    ("1969-12-31T23:59:59.500 x", -500, 23),
    ("May\x0107 17:05:08 x", BASE, 15),
    ("Sunday 07 17:05:08", None, 0),
    ("may 07 17:05:08 x", None, 0),
    ("hello", None, 0),
    ("", None, 0),
]


def test_stamp_vectors(spark):
    out = run(spark, [s for s, _, _ in STAMPS])
    for row, (text, ms, length) in zip(out, STAMPS):
        assert (row.parsed_ms, row.stamp_len) == (ms, length), text
        assert row.ts_ms == (ms if ms is not None else ARRIVAL)
        assert row.ts_source == ("parsed" if ms is not None else "now")


def test_body_keeps_bytes(spark):
    out = run(spark, [
        b"<13>1 2014-05-07T17:05:08Z  two \xff\x00 spaces", b"404 not found", b"<7>no stamp",
        b"2014-05-07T17:05:08", b"2014-05-07T17:05:08x\ny\n", b"\xfe\x01raw",
    ])
    assert [bytes(r.body) for r in out] == [
        b" two \xff\x00 spaces", b"not found", b"no stamp", b"", b"x\ny\n", b"\xfe\x01raw"]
    assert [r.enc_version for r in out] == [-1] * 5 + [1]


def test_every_priority(spark):
    out = run(spark, [f"<{i}>priority body" for i in range(192)])
    assert [(r.pri, r.facility, r.severity) for r in out] == [(i, i // 8, i % 8) for i in range(192)]
    assert {bytes(r.body) for r in out} == {b"priority body"}
    bad = ["no priority", "<>empty", "<192>x", "<200>x", "<01>x", "<0", "<1", "<10", "<191", "<1915>x"]
    out = run(spark, bad)
    assert [r.pri for r in out] == [None] * len(bad)
    assert [bytes(r.body).decode() for r in out] == bad


def test_every_version(spark):
    for prefix in ("", "<123>"):
        out = run(spark, [f"{prefix}{i} priority body" for i in range(1, 1000)])
        assert [r.rfc_version for r in out] == list(range(1, 1000))
        assert {bytes(r.body) for r in out} == {b"priority body"}
    bad = ["12This", "1234 This", "01 This", "0 This"]
    assert [r.rfc_version for r in run(spark, bad)] == [None] * 4


@pytest.mark.parametrize("ms", [0, 1, 1399482308123, -1, -(2**63), 2**63 - 1])
def test_envelope_time(spark, ms):
    raw = b"\xfe\x00" + ms.to_bytes(8, "big", signed=True)
    out = run(spark, [raw + b"hello", raw, raw[:9], raw + b"2014-05-07T17:05:08 x"])
    assert [(r.enc_version, r.decode_status) for r in out] == [
        (0, "ok"), (0, "ok"), (0, "short_envelope"), (0, "ok")]
    assert [r.ts_ms for r in out] == [ms, ms, ARRIVAL, BASE]
    assert [r.ts_source for r in out] == ["envelope", "envelope", "now", "parsed"]
    assert [bytes(r.body) for r in out][:2] == [b"hello", b""]


def test_cut_stamps(spark):
    whole = "2014-05-07T17:05:08"
    cut = [whole[:n] for n in range(1, 19)]
    cut += ["May 07 17:05:08"[:n] for n in range(3, 15)] + ["<13>1 2014-05", "May  7 1"]
    out = run(spark, cut)
    assert [r.decode_status for r in out] == ["truncated_ts"] * len(cut)
    assert {r.ts_source for r in out} == {"now"}
    fine = [whole, "May 07 17:05:08", "Ma", "2014-05 x", "2014-05-07T17:0x", "May be", "May 0x"]
    assert {r.decode_status for r in run(spark, fine)} == {"ok"}
    df = wire.decode(spark.createDataFrame([(bytearray(b"2014-05"), 1)], "value binary, arrival_ms long"), 2014)
    assert wire.landable(df).count() == 1
    assert wire.landable(df, drop_truncated=True).count() == 0


def test_plan_has_one_pattern_and_no_python(spark):
    df = spark.createDataFrame([(bytearray(b"x"), 1)], "value binary, arrival_ms long")
    decoded = wire.landable(wire.decode(df, 2014), drop_truncated=True).filter("ts_source <> 'now' AND pri = 3")
    plan = decoded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") == 1
    assert "Python" not in plan


def test_partition_id(spark):
    df = spark.createDataFrame([("a-b-3",), ("x",)], "pid string")
    topic, partition = wire.split_partition_id(F.col("pid"))
    got = df.select(topic.alias("t"), partition.alias("p")).collect()
    assert [tuple(r) for r in got] == [("a-b", 3), ("", None)]
