"""Decoding of line records: numbers of every size, and lines cut into several arrays."""

import random

from logharbor.sources import containers as boxes


def test_numbers_of_every_size():
    rng, n = random.Random(1), boxes._long_bytes
    data, want = b"", []
    for number in range(30):
        data += n(1_704_067_200) + n(5) + n(number)
        idx = 0
        for count in (3, 70):
            data += n(count) if count == 3 else n(-count) + n(0)       # a negative count is followed by a size
            for _ in range(count):
                ms, body = rng.choice([-999, -64, -1, 0, 63, 64, 999, 10 ** 9]), rng.randbytes(rng.choice([0, 5, 63, 64, 300, 8191, 8192, 9000]))
                data += n(ms) + n(len(body)) + body
                want.append((number, idx, 1_704_067_200_000 + ms, body))
                idx += 1
        data += b"\0"
    got = boxes._lines("f", data, 30)
    assert list(zip(*(got.column(c).to_pylist() for c in ("block_number", "idx", "ts_ms", "message")))) == want
