"""Quality machine, language network and the personal data trees: held-out accuracy and edge rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from logharbor.llm import langid, pii, quality
from logharbor.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op9_factorisation_machine"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in judged) / len(judged) > 0.95


def test_sum_of_squares_equals_all_pairs():
    rng = np.random.default_rng(1)
    size = quality.WORD_SLOTS + quality.STATS * quality.BINS
    machine = quality.Machine(np.zeros((quality.STATS, quality.BINS - 1)), 0.1, rng.normal(0, 0.1, size), rng.normal(0, 0.1, (size, quality.RANK)))
    index, value, stats = quality.features("some words, Some more words!", 28)
    at, x = machine.vector(index, value, stats)
    pairs = sum(x[a] * x[b] * machine.factors[at[a]] @ machine.factors[at[b]] for a in range(len(at)) for b in range(a + 1, len(at)))
    want = 1 / (1 + np.exp(-(0.1 + x @ machine.linear[at] + pairs)))
    assert machine.score(index, value, stats) == pytest.approx(want, abs=1e-9)


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, None, 9.0), (2, "", 0, 9.0), (None, "x y", 3, 9.0), (4, "w " * 100000, 200000, 9.0)],
                                 "doc_id bigint, text string, n_chars bigint, score double")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    rows = quality.with_score(docs, quality.train(docs, none), "score").collect()
    assert [r.score for r in rows] == [0.5] * 4
    some = spark.createDataFrame([(1, 1), (2, 0), (4, 1), (4, None), (None, 1)], "doc_id bigint, quality int")
    assert all(0 < r.score < 1 for r in quality.with_score(docs, quality.train(docs, some, folds=97, held_out=96), "score").collect())
    assert quality.with_score(docs.limit(0), quality.train(docs.limit(0), some)).count() == 0


def test_language_on_held_out_rows(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op6_byte_cnn"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    judged = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert sum(judged) / len(judged) > 0.97


def test_tables_equal_the_network():
    rng = np.random.default_rng(3)
    net = langid.fit(rng.integers(0, 256, (40, langid.WINDOW)).astype(np.uint8), rng.integers(0, 2, 40), ["a", "b"])
    window = rng.integers(0, 256, (3, langid.WINDOW)).astype(np.uint8)
    pooled = []
    for width, w, b in zip(langid.WIDTHS, net.filters, net.biases):
        span = langid.WINDOW - width + 1
        patch = np.concatenate([net.embedding[window][:, i:i + span] for i in range(width)], axis=2)
        pooled.append((patch @ w).max(axis=1) + b)
    z = np.maximum(np.concatenate(pooled, axis=1), 0) @ net.dense + net.offset
    want = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    assert np.allclose(langid.Scorer(net).probabilities(window), want, atol=1e-4)


def test_language_edges(spark):
    rows = [(1, "hello the words and more " * 4, "en", "x"), (2, "le mot de la phrase et " * 4, "fr", "x"), (3, None, "en", "x"), (4, "12 !", None, "x"),
            (None, "hello the words", None, "x"), (6, "the words " * 30000, None, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, lang_pred string")
    net = langid.train(df, folds=97, held_out=96)
    got = {r.doc_id: r for r in langid.predictions(df, net).collect()}
    assert got[3].lang_pred == got[4].lang_pred == "und" and got[3].score == 0
    assert {got[1].lang_pred, got[2].lang_pred, got[6].lang_pred} <= {"en", "fr"}
    nothing = langid.train(df.filter("lang = 'xx'"))
    assert {r.lang_pred for r in langid.predictions(df, nothing).collect()} == {"und"}


# The base rules as plain patterns.
RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def rule_spans(text):
    return [(k, *m.span()) for k, p in RULES.items() for m in re.finditer(p, text) if pii.valid(k, m.group())]


def test_base_spans_on_random_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choice("a.@+ 0123456789-()%b") for _ in range(rng.randint(0, 80))) for _ in range(5000)]
    parts = ["a", "@", "b.c", ".", "1", "255", "9", "+1", "4111111111111111", " ", "-"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(5000)]
    for text in texts:
        assert pii.base_spans(text)[0] == rule_spans(text), text


def test_pii_query_against_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op5_boosted_pii"](spark, sf_dir).collect():
        want = rule_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.joined(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in RULES]
        assert set(pii.joined(want).split(",")) <= set(r.spans.split(","))


def test_dropped_matches_are_recovered(spark):
    """A phone number right before a card number: each rule matches, no rule keeps both."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    text = "words +1 (269) 555-3296 4524132264652876 and 4524132264652876 4451718024887799 or 1234567890123456 and version 3. 2024-01-02"
    base, spans = pii.all_spans(text, pii.train(docs))
    assert not [s for s in base if s[0] == "card" and s[1] < 50]
    found = {text[a:b] for _, a, b in spans}
    assert {"+1 (269) 555-3296", "4524132264652876", "4451718024887799"} <= found
    assert not any("1234567890123456" in f or "2024" in f for f in found)


def test_redaction_rows(spark):
    df = spark.createDataFrame([(1, "mail a.b@c.org now", 18, "x"), (2, None, 7, "x"), (3, "clean", 99, "x")], "doc_id bigint, text string, n_chars bigint, base string")
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.redacted(df, pii.train(df)).collect()}
    assert got == {1: ("mail [EMAIL] now", 16), 2: (None, 7), 3: ("clean", 99)}
    assert pii.redact("abcdef", [("card", 1, 4), ("phone", 2, 5)]) == "a[CARD]f"
    assert pii.redacted(df.limit(0), pii.train(df.limit(0))).count() == 0


def test_long_texts_are_linear():
    model = pii.Trees(thresholds={k: 0.9 for k in pii.KINDS})
    for text in ("9" * 100000, "a" * 100000, "+" * 100000, "a@" * 50000, "1 " * 60000, "+1 (" * 30000, "1." * 50000):
        pii.all_spans(text, model)
