"""Byte-level BPE against the tokenizers library, and edge rows through Spark."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from logharbor.llm import bpe
from logharbor.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def vocab():
    with open(vocabulary_path(), encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


EDGE = ["", " ", "a", "  a  b \n\n c\t", "<|endoftext|>", "x<|endoftext|>y <|endoftext|><|endo", "é" * 300, "ab" * 3000, " " * 500,
        "日本語 １２３", "'s 'S don't I'LL", "\x00\x01\x85 ​﻿", "😀 👩‍👩‍👧", "word\n next", "x \ny", "\u001c a"]


def test_edge_texts_match_the_library(vocab, library):
    for text in EDGE:
        want = library.encode(text, add_special_tokens=False).ids
        assert vocab.encode(text) == want, text
        assert vocab.decode(want) == library.decode(want, skip_special_tokens=False)


def test_random_texts_match_the_library(vocab, library):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab \n\t'sĀß<|>٣½{}\x1c") for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    got = [[i for p in parts for i in p[0]] for parts in vocab.pieces_of(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [vocab.decode(i) for i in got] == texts


def test_one_tree_and_many_trees_agree(vocab):
    rng = random.Random(5)
    pieces = [bytes(rng.choice(b"theandingr ") for _ in range(rng.randint(1, 64))) for _ in range(300)]
    for width in (4, 8, 16, 32, 64):
        mine = [p for p in pieces if width // 2 < len(p) <= width]
        one = [list(bpe.merge_piece([vocab.byte_ids[b] for b in p], vocab.merges)) for p in mine]
        assert [list(p) for p in vocab._merge_short(mine, width)] == one


def test_memory_is_bounded(vocab, monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(40)) for _ in range(10)]
    for text in texts * 2:
        assert vocab.encode(text) == library.encode(text, add_special_tokens=False).ids
        assert len(vocab.words) <= 200


def test_rows(spark, library):
    rows = [(1, None, "z"), (2, "", "z"), (2, "", "z"), (None, "a b", None), (4, "long " * 20000, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    got = bpe.encode_decode(df, vocabulary_path(), keep_ids=True).collect()
    assert len(got) == 5
    for r in got:
        text = {1: "", 2: "", None: "a b", 4: "long " * 20000}[r.doc_id]
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(r.input_ids) == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_decode(df.limit(0), vocabulary_path()).count() == 0


def test_cycle_collection_rests_while_encoding():
    import gc
    with pytest.raises(ValueError):
        with bpe.no_collection():
            assert not gc.isenabled()
            raise ValueError
    assert gc.isenabled()


def calls_during(f, *args):
    """Calls of Python and C functions that Python makes."""
    import sys
    made = 0

    def count(frame, event, arg):
        nonlocal made
        made += event in ("call", "c_call")
    sys.setprofile(count)
    try:
        f(*args)
    finally:
        sys.setprofile(None)
    return made


def test_python_does_nothing_per_word_of_the_text(vocab):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=500)) for _ in range(4)]
    longer = [" ".join([t] * 8) for t in texts]
    assert vocab.pieces_of(longer) and vocab.pieces_of(texts)
    few, many = calls_during(vocab.pieces_of, texts), calls_during(vocab.pieces_of, longer)
    assert many < few + 4 * 500


def test_words_seen_most_stay_remembered(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 20)
    with open(vocabulary_path(), encoding="utf-8") as f:
        vocab = bpe.Vocabulary(f.read())
    rng = random.Random(8)
    for k in range(30):
        text = "x " + "often seen " * 3 + " ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(15))
        assert vocab.encode(text) == library.encode(text, add_special_tokens=False).ids
    kept = vocab.words.to_pylist()
    assert len(kept) == len(set(kept)) == 20 and {"often", "seen"} <= set(kept)


def test_long_pieces_and_wide_gaps(vocab, library):
    rng = random.Random(9)
    texts = ["".join(rng.choice("日本語eéa") for _ in range(n)) for n in (20, 40, 63, 64, 65, 128, 255, 256, 257, 700)]
    texts += ["if x:\n        return  y  \n\n\t z", "\u3000a \u3000b \x85c \x1cd", "  <|endoftext|>  <|endoftext|><|endoftext|> a", " a", "a ", "'s's 're're x's\n't"]
    ids = vocab.ids_of(pa.array(texts, pa.large_string()))
    assert [ids.values[a:b].tolist() for a, b in ids.spans()] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    of_ids, of_texts = vocab.digests(ids)
    assert of_texts == [hashlib.sha256(t.encode()).hexdigest() for t in texts]
    assert of_ids == [hashlib.sha256(",".join(map(str, library.encode(t, add_special_tokens=False).ids)).encode()).hexdigest() for t in texts]


def test_ids_cut_inside_a_character_are_decoded_with_replacement(vocab):
    rows = [vocab.encode("é")[:1] + [vocab.byte_ids[0xC3]], [], [vocab.byte_ids[0xA9], vocab.byte_ids[0x61]]]
    ids = bpe.Ragged(np.array(sum(rows, []), np.int32), np.array([len(r) for r in rows]))
    assert vocab.digests(ids)[1] == [hashlib.sha256(vocab.decode(r).encode()).hexdigest() for r in rows]


def test_batches_are_encoded_together_and_large_ones_alone(monkeypatch):
    monkeypatch.setattr(bpe, "GROUP_BYTES", 100)
    batches = [pa.RecordBatch.from_pydict({"text": t}) for t in (["a" * 20], [], ["b" * 20, None], ["c" * 400], ["d"], ["e"])]
    batches[1] = batches[0].slice(0, 0)
    assert [g.column("text").to_pylist() for g in bpe.grouped(iter(batches))] == [["a" * 20, "b" * 20, None], ["c" * 400], ["d", "e"]]
