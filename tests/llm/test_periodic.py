"""Periodic runs against a word-by-word search."""

import hashlib
import random
import zlib

import pytest

from logharbor.llm import periodic
from logharbor.llm.common import table
from logharbor.llm.queries import op12_periodic_runs


def brute(words):
    runs, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                runs.setdefault((i, j + q), q)
            i = j
    return sorted(((a, b - a, q) for (a, b), q in runs.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_text(rng):
    out = []
    for _ in range(rng.randint(0, 8)):
        if rng.random() < 0.5:
            period = [str(rng.randint(0, rng.choice([3, 100]))) for _ in range(rng.randint(1, rng.choice([3, 10, 40])))]
            length = max(1, int(len(period) * rng.choice([3.5, 4, 4.2, 6, 10])))
            out += [period[i % len(period)] for i in range(length)]
        else:
            out += [str(rng.randint(0, rng.choice([1, 2, 50]))) for _ in range(rng.randint(1, 60))]
    return out


@pytest.mark.parametrize("largest", [1 << 17, 8, 1])
def test_random_texts(monkeypatch, largest):
    monkeypatch.setattr(periodic, "LARGEST", largest)
    rng = random.Random(largest)
    for _ in range(60):
        docs = [random_text(rng) for _ in range(rng.randint(1, 10))]
        for words, (runs, kept) in zip(docs, periodic.runs_of_texts([" ".join(d) for d in docs])):
            assert runs == brute(words)
            assert kept.decode() == collapsed(words, runs)


def test_sums_that_vanish_by_chance_are_undone(monkeypatch):
    """Modulo 7 most sums vanish somewhere: words are compared all the same."""
    real = periodic.block_hits

    def more(x, squares, scale):
        k, d = real(x, squares, scale)
        blocks = max(1, len(x) // scale)
        rng = random.Random(scale)
        extra = [(rng.randrange(blocks), rng.randrange(scale, 2 * scale)) for _ in range(40)]
        import numpy as np
        pairs = np.unique(np.array([*zip(k.tolist(), d.tolist()), *extra], np.int64), axis=0)
        return pairs[:, 0], pairs[:, 1]

    monkeypatch.setattr(periodic, "block_hits", more)
    rng = random.Random(9)
    for _ in range(40):
        words = random_text(rng)
        assert periodic.runs_of_texts([" ".join(words)])[0][0] == brute(words)


def test_transform_is_exact():
    import numpy as np
    rng = np.random.default_rng(1)
    for size in (2, 64, 128, 4096, 1 << 14):
        x = rng.integers(0, periodic.PRIME, (2, size)).astype(float)
        back = periodic._backward(periodic._forward(x.copy()))
        assert (np.round(back) % periodic.PRIME == (x * size) % periodic.PRIME).all()


def test_long_texts():
    words = [str(i % 4096) for i in range(4 * 4096 + 5)]
    assert periodic.runs_of_texts([" ".join(words), None, ""])[0][0] == [(0, len(words), 4096)]
    assert periodic.runs_of_texts(["a " * 50_000])[0] == ([(0, 50_000, 1)], b"a")


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_the_query_equals_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    rows = op12_periodic_runs(spark, sf_dir).collect()
    assert len(rows) == len(docs) and sum(r.n_runs for r in rows) > 5
    for r in rows:
        words = planted(r.doc_id, (docs[r.doc_id] or "").encode().split())
        words = [w.decode() for w in words]
        runs = brute(words)
        best = min(((-n, a, q) for a, n, q in runs), default=None)
        want = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *want)
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()


def test_edges(spark):
    rows = spark.createDataFrame([(None, None, 1), (2, "", 1), (2, "", 1), (3, " \t ", 1), (4, "a a a a a a", 1), (5, "é b " * 6, 1)],
                                 "doc_id bigint, text string, lang int")
    got = {(r.doc_id, len(r.runs), r.kept) for r in periodic.with_runs(rows).collect()}
    assert got == {(None, 0, ""), (2, 0, ""), (3, 0, ""), (4, 1, "a"), (5, 1, "é b")}
    assert periodic.with_runs(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.with_runs(rows.withColumnRenamed("lang", "runs"))
