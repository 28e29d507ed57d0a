"""SimHash groups against brute force; posting families; blocks; edge rows."""

from itertools import combinations

import numpy as np
import pytest
import xxhash

from logharbor.llm import simhash
from logharbor.llm.components import components
from logharbor.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text, k=3):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(v >> b & 1 for v in h) > len(h)) << b for b in range(64)) if h else 0


def brute_components(prints, radius):
    ids, f = list(prints), np.array(list(prints.values()), np.uint64)
    low = {i: i for i in ids}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for k in range(len(f)):
        for q in np.flatnonzero(np.bitwise_count(f[k] ^ f) <= radius):
            a, b = root(ids[k]), root(ids[q])
            low[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_query_against_brute_force(spark, sf_dir):
    prints = {r.doc_id: plain_fingerprint(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = brute_components(prints, 3)
    rows = QUERIES["op4_simhash"](spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{f:016x}", want[i]) for i, f in prints.items()}


@pytest.mark.parametrize("block", [7, simhash.BLOCK])
def test_planted_fingerprints_lose_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(8)
    f = rng.integers(0, 1 << 63, 40, dtype=np.uint64).tolist()
    for _ in range(200):
        near = int(rng.choice(np.array(f, np.uint64)))
        for bit in rng.choice(64, rng.integers(1, 5), replace=False):
            near ^= 1 << int(bit)
        f.append(near)
    prints = {k: v for k, v in enumerate(f)}
    rows = [(k, [int(np.uint64(v).astype(np.int64))]) for k, v in prints.items()]
    got = simhash.near_duplicate_groups(spark.createDataFrame(rows, "doc_id bigint, fp array<bigint>")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(prints, 3)


def test_families_hold_a_triple():
    sets = [set(t) for t in simhash.HALVES]
    assert all(any(t <= set(five) for t in sets) for five in combinations(range(8), 5))
    assert len(simhash.PLANE) == 80
    assert all(sum({a, b} <= set(line) for line in simhash._plane()) == 1 for a, b in combinations(range(16), 2))


def test_one_of_each_group_stays(spark):
    rng = np.random.default_rng(9)
    base = [" ".join(f"w{int(x)}" for x in rng.integers(0, 5000, 400)) for _ in range(12)]
    rows = []
    for k, text in enumerate(base):
        rows.append((k, text))
        for copy in range(3):
            words = text.split()
            for at in rng.choice(400, 2, replace=False):
                words[at] = f"changed{copy}"
            rows.append((100 + 10 * k + copy, " ".join(words)))
    rows += [(3, base[3]), (None, base[4]), (500, None), (501, ""), (502, "   ")]
    df = spark.createDataFrame([(i, t, "fp", "x") for i, t in rows], "doc_id bigint, text string, fp string, component string")
    kept = simhash.one_per_group(df).collect()
    assert sorted(r.doc_id for r in kept) == [*range(12), 500]
    assert kept[0].asDict().keys() == {"doc_id", "text", "fp", "component"}
    assert simhash.one_per_group(df.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(200)] + [(300, 301), (301, 300), (400, 400), (None, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(201)}, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (None, "A b"), (4, "a B"), (4, "a b"), (5, "a b c d e")], "doc_id bigint, text string")
    got = simhash.near_duplicate_groups(simhash.with_fingerprint(df)).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got) == [(0, 4), (1, 1), (2, 1), (4, 4), (4, 4), (5, 5)]
