"""The pipeline's stages, each against brute force on its own input."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from logharbor.llm import pii, quality
from logharbor.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    sf = "/root/testdata/sf0.01"
    frames = [table(spark, sf, "documents")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        frames.append(stored(stage(spark, frames[-1], sf), f"test{k}"))
    return [f.collect() for f in frames]


def test_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    for rows in stages[:-1]:
        assert list(rows[0].asDict()) == COLUMNS


def test_quality_keeps_good_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    kept = {r.doc_id for r in stages[1]}
    judged = [(r.doc_id in kept) == bool(labels[r.doc_id]) for r in stages[0] if r.doc_id in labels]
    assert sum(judged) / len(judged) > 0.97
    assert not kept - {r.doc_id for r in stages[0]}


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def test_one_of_each_group_stays(stages):
    before, after = stages[1], {r.doc_id for r in stages[2]}
    sets = {r.doc_id: shingles(r.text) for r in before}
    ids = sorted(sets)
    exact = {}
    for r in sorted(before):
        exact.setdefault(" ".join(r.text.lower().split()), r.doc_id)
    assert all(r.doc_id == exact[" ".join(r.text.lower().split())] or r.doc_id not in after for r in before)
    # Copies at 0.9 or more are gone, and a document like no other stays.
    by_shingle = {}
    for i in ids:
        for s in sets[i]:
            by_shingle.setdefault(s, []).append(i)
    likest, caught, near = {}, 0, 0
    for i in ids:
        others = Counter(j for s in sets[i] for j in by_shingle[s] if j != i)
        likest[i] = max((n / len(sets[i] | sets[j]) for j, n in others.items()), default=0)
        for j, n in others.items():
            if j > i and n / len(sets[i] | sets[j]) >= 0.9:
                near += 1
                caught += j not in after or i not in after
    assert near == 0 or caught / near > 0.95
    lost = [i for i in ids if i not in after]
    assert all(likest[i] > 0.6 for i in lost) and all(i in after for i in ids if likest[i] < 0.5)


def test_near_duplicates_equal_brute_force(stages):
    """Exactly the smallest document of each component of pairs at 0.8 or more stays."""
    sets = {r.doc_id: shingles(r.text) for r in stages[1]}
    by_shingle, low = {}, {i: i for i in sets}

    def top(i):
        while low[i] != i:
            low[i] = low[low[i]]
            i = low[i]
        return i

    for i in sorted(sets):
        others = Counter(j for s in sets[i] for j in by_shingle.get(s, ()))
        for j, n in others.items():
            if n / (len(sets[i]) + len(sets[j]) - n) >= 0.8:
                a, b = sorted((top(i), top(j)))
                low[b] = a
        for s in sets[i]:
            by_shingle.setdefault(s, []).append(i)
    assert {r.doc_id for r in stages[2]} == {i for i in sets if top(i) == i}
    assert len(stages[2]) < len(stages[1])


def test_personal_data_is_gone(stages):
    before, after = {r.doc_id: r.text for r in stages[2]}, {r.doc_id: r for r in stages[3]}
    assert before.keys() == after.keys()
    for i, text in before.items():
        spans, _ = pii.base_spans(text)
        assert not pii.base_spans(after[i].text)[0]
        assert after[i].n_chars == len(after[i].text)
        if not spans:
            assert len(re.findall(r"\[(?:EMAIL|IP|CARD|PHONE)\]", after[i].text)) >= 0
        if not re.search(r"[0-9@]", text):
            assert after[i].text == text


def test_mixing_repeats_and_loses_nothing(stages):
    before, after = Counter(r.doc_id for r in stages[3]), Counter(r.doc_id for r in stages[4])
    assert before.keys() == after.keys() and set(after.values()) <= {1, 2, 3}
    tokens = Counter()
    for r in stages[3]:
        tokens[r.source] += len(r.text.split())
    mixed = Counter()
    for r in stages[4]:
        mixed[r.source] += len(r.text.split())
    assert mixed[max(tokens, key=tokens.get)] == max(tokens.values())
    assert all(mixed[s] <= 2 * n + 1 for s, n in tokens.items())


def test_tokens_cover_all_rows(stages):
    from tokenizers import Tokenizer

    from logharbor.llm.queries import vocabulary_path
    library = Tokenizer.from_file(vocabulary_path())
    texts = {r.doc_id: r.text for r in stages[4]}
    assert Counter(r.doc_id for r in stages[5]) == Counter(r.doc_id for r in stages[4])
    for r in stages[5][:300]:
        assert list(r.input_ids) == library.encode(texts[r.doc_id], add_special_tokens=False).ids


def test_threshold_is_the_documented_one():
    assert quality.THRESHOLD == 0.7
