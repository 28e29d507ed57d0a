"""Groups of the near-duplicate stage against the exact similarity of shingle sets."""

import numpy as np
import pytest

from logharbor.llm import simhash


def text_of(codes):
    return " ".join(f"w{int(c)}" for c in codes)


def similarity(a, b):
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.lower().split(), b.lower().split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def planted(rng, least, most, n, words):
    """Pairs of texts with one stretch rewritten, whose similarity is in the range."""
    out = []
    while len(out) < n:
        a = rng.integers(0, 1 << 40, int(rng.integers(*words)))
        b = a.copy()
        cut = max(1, round(len(a) * rng.uniform(0.02, 0.2)))
        b[:cut] = rng.integers(0, 1 << 40, cut)
        pair = text_of(a), text_of(b)
        if least <= similarity(*pair) < most:
            out.append(pair)
    return out


def kept_of(spark, pairs):
    rows = [(2 * k + side, text) for k, pair in enumerate(pairs) for side, text in enumerate(pair)]
    return {r.doc_id for r in simhash.one_per_group(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}


@pytest.mark.parametrize("words", [(9, 40), (250, 350)])
def test_no_pair_from_080_to_090_is_lost(spark, words):
    pairs = planted(np.random.default_rng(words[0]), 0.8, 0.9, 300, words)
    assert kept_of(spark, pairs) == {2 * k for k in range(300)}


def test_no_pair_below_080_is_deleted(spark):
    """Nor texts that only share a passage, however often each repeats it."""
    rng = np.random.default_rng(5)
    pairs = planted(rng, 0.66, 0.8, 300, (250, 350))
    for _ in range(40):
        passage = rng.integers(0, 1 << 40, 44)
        pairs.append(tuple(text_of(np.concatenate([*[passage] * 10, rng.integers(0, 1 << 40, 400)])) for _ in range(2)))
    assert all(similarity(*p) < 0.2 for p in pairs[300:])
    assert len(kept_of(spark, pairs)) == 680


def test_repeated_rows_leave_one(spark):
    text = text_of(range(40))
    rows = spark.createDataFrame([(1, text, "a")] * 3 + [(2, text, "b"), (None, None, None), (None, None, None), (7, "x " * 9, "c")],
                                 "doc_id bigint, text string, extra string")
    assert sorted((r.doc_id or 0, r.extra) for r in simhash.one_per_group(rows).collect()) == [(0, None), (1, "a"), (7, "c")]


def test_the_fingerprint_index_finds_near_copies(spark, monkeypatch):
    """Without the prefixes, pairs that are nearly equal nearly all meet in the index over positional bytes."""
    rng = np.random.default_rng(11)
    pairs = []
    for _ in range(100):
        words = rng.integers(0, 1 << 40, 400)
        near = words.copy()
        near[rng.integers(0, 400)] = 7
        pairs.append((text_of(words), text_of(near)))
    monkeypatch.setattr(simhash, "candidate_links", lambda sets, similarity: spark.createDataFrame([], "a bigint, b bigint"))
    kept = kept_of(spark, pairs)
    assert kept >= {2 * k for k in range(100)} and len(kept) <= 120
