"""Seconds gathered in several rows are cut like any other."""

import pytest

import models
from logharbor.operators.blocks import CAP_BYTES, SPAN_BYTES, log_blocks
from test_blocks import keyed


@pytest.mark.parametrize("n,size,cap,span,max_lines", [
    (200, 100, 1000, 1500, None), (200, 100, 1000, 300, 4), (40, 1 << 20, CAP_BYTES, SPAN_BYTES, None), (420, 100_000, CAP_BYTES, SPAN_BYTES, None)])
def test_heavy_second_matches_sequential_packer(spark, n, size, cap, span, max_lines):
    rows = [("t", 0, i, i, i, 5 + i % 3, bytearray(bytes([i % 251]) * (size - i % 7))) for i in range(n)]
    got = sorted((r.block_number, r.second, r.create_time, [(x.ms, bytes(x.message)) for x in r.log_lines])
                 for r in log_blocks(keyed(spark, rows), cap_bytes=cap, span_bytes=span, max_lines=max_lines).collect())
    want = models.blocks([(r[5], r[4], bytes(r[6])) for r in rows], cap, max_lines)
    assert [(s, c, k, b) for k, s, c, b in got] == [tuple(w) for w in want]
