"""Repeated byte strings against a dictionary of all strings."""

import random
from collections import Counter

import numpy as np
import pytest

from logharbor.llm import suffix
from logharbor.llm.common import table
from logharbor.llm.queries import op13_suffix_arrays


def expected(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def check(spark, texts, length):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix.without_repeats(rows, length).collect()}
    assert [got[k] for k in range(len(texts))] == expected(texts, length)


def corpus(rng, n):
    passages = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(30, 150))) for _ in range(6)]
    out = [None, "", "x", "\0\0\0", "a" * 500, "ab" * 300, "a" * 39]
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(1, 6)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p))
            parts += [rng.choice([p, p[cut:], p[:cut]]), "".join(rng.choice("xyz€ ") for _ in range(rng.randint(0, 60)))]
        out.append("".join(parts))
    return out + out[10:14] + [out[12].upper() + "\0" * 60]


@pytest.mark.parametrize("hot,shard,merge", [(512, 4096, 1 << 20), (2, 16, 32)])
def test_against_all_strings(spark, monkeypatch, hot, shard, merge):
    monkeypatch.setattr(suffix, "HOT_PIECES", hot)
    monkeypatch.setattr(suffix, "SHARD_PIECES", shard)
    monkeypatch.setattr(suffix, "MERGE_KEYS", merge)
    check(spark, corpus(random.Random(hot), 60), 40)


def test_windows_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffix, "WINDOW", 1 << 10)
    suffix._tables.cache_clear()
    rng = random.Random(2)
    base = "".join(rng.choice("abcdefgh ") for _ in range(6000))
    check(spark, [base + "1" + base[1000:2500], base[500:900] + "2" * 300, "plain" * 30], 200)


def test_suffix_array_and_prefixes():
    rng = random.Random(3)
    for _ in range(40):
        data = bytes(rng.choice(b"\0ab") for _ in range(rng.randint(1, 200)))
        order = suffix.suffix_array(np.frombuffer(data, np.uint8))
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])


def test_the_query_equals_brute_force(spark, sf_dir):
    import hashlib
    docs = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    want = dict(zip(docs, expected(docs.values(), 200)))
    rows = op13_suffix_arrays(spark, sf_dir).collect()
    assert len(rows) == len(docs) and sum(r.n_removed for r in rows) > 0
    for r in rows:
        n, removed, spans, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, removed, spans, hashlib.sha256(kept).hexdigest())


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert suffix.without_repeats(empty).count() == 0
    rows = spark.createDataFrame([(None, "q" * 300, 1), (None, "q" * 300, 1), (1, "r", None)], "doc_id bigint, text string, extra int")
    assert sorted((r.doc_id or 0, r.extra or 0, r.n_removed, r.n_spans) for r in suffix.without_repeats(rows).collect()) == [(0, 1, 300, 1)] * 2 + [(1, 0, 0, 0)]
    with pytest.raises(ValueError):
        suffix.without_repeats(rows.withColumnRenamed("extra", "kept"))
