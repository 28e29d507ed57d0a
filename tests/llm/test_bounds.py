"""What blocks and training samples hold at most, and the count filter of fingerprints."""

import resource

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from logharbor.llm import embeddings, langid, quality, simhash


def block(n: int, right: bool, **columns) -> pa.Table:
    sides = {"low": np.zeros(n, np.int64), "high": np.full(n, int(right)), "right": np.arange(n) % 2 == 1 if right else np.zeros(n, bool)}
    return pa.table({"node": pa.array(np.arange(n)), **columns, **{k: pa.array(v) for k, v in sides.items()}})


def test_dense_block_of_vectors_stays_small():
    rng = np.random.default_rng(1)
    x = rng.normal(size=768) + 0.02 * rng.normal(size=(4096, 768))
    table = block(4096, True, copies=pa.array(np.ones(4096, np.int64)), home=pa.array(np.zeros(4096, np.int64)), cell=pa.array(np.zeros(4096, np.int64)),
                  embedding=pa.array(list(x)), visits=pa.array([[]] * 4096, pa.list_(pa.int64())))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    got = embeddings._compare(0.98)(table)
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10 < 500
    assert got.column("links").to_pylist() == [2048] * 4096 and got.column("joined").null_count == 1


def test_block_of_vectors_equals_all_pairs():
    rng = np.random.default_rng(2)
    x = rng.normal(size=24) + 0.14 * rng.normal(size=(300, 24))
    x[7], x[8] = np.eye(24)[0], 0.98 * np.eye(24)[0] + np.sqrt(1 - 0.98 ** 2) * np.eye(24)[1]       # on the threshold
    table = block(300, False, copies=pa.array(np.ones(300, np.int64)), home=pa.array(np.zeros(300, np.int64)), cell=pa.array(np.zeros(300, np.int64)),
                  embedding=pa.array(list(x)), visits=pa.array([[]] * 300, pa.list_(pa.int64())))
    got = embeddings._compare(0.98)(table)
    norms = np.sqrt((x * x).sum(axis=1))
    links = [sum((x[i] * x[j]).sum() / (norms[i] * norms[j]) >= 0.98 for j in range(300) if j != i) for i in range(300)]
    assert 0 < sum(links) < 300 * 299
    assert dict(zip(got.column("node").to_pylist(), got.column("links").to_pylist())) == {i: n for i, n in enumerate(links) if n}


def test_count_filter_rejects_before_bits_are_compared(monkeypatch):
    # Two pairs within two bits of one key's bytes: one shares five bytes, the other four and is never verified.
    fps = np.array([0, 0x0101010000000000, 0x0101010100000000], np.uint64)
    assert simhash.equal_bytes(fps).tolist() == [8, 5, 4]
    rng = np.random.default_rng(4)
    some = rng.integers(0, 1 << 63, 2000, np.uint64) & rng.integers(0, 1 << 63, 2000, np.uint64) & rng.integers(0, 1 << 63, 2000, np.uint64)
    assert simhash.equal_bytes(some).tolist() == [w.tobytes().count(0) for w in some]
    table = block(3, False, fp=pa.array([[int(w)] for w in fps], pa.list_(pa.int64())))
    got = simhash._block_links(8, 5, 8)(table)
    assert set(zip(got.column("a").to_pylist(), got.column("b").to_pylist())) == {(1, 0), (2, 0)}     # by way of 1; 0 and 2 share too few
    without = simhash._block_links(8, 5, 8)(table.take([0, 2]))
    assert without.num_rows == 0


def test_letters_are_letters():
    assert [langid.has_letter(t) for t in ("²½Ⅷ 12 ١٢", "٣ـ", "ª", "ß", "語", "́", "")] == [False, True, True, True, True, False, False]


def test_one_labelled_id_with_many_rows_is_bounded(spark, monkeypatch):
    many = spark.range(20000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("a text number "), "id").alias("text"),
                                     F.lit("en").alias("lang"), F.lit(9).alias("n_chars"))
    seen = []
    monkeypatch.setattr(langid, "fit", lambda data, target, languages: seen.append(len(data)))
    monkeypatch.setattr(quality, "fit", lambda rows, labels: seen.append(len(rows)))
    langid.train(many, sample_docs=30000)
    langid.train(many, sample_docs=50)
    quality.train(many, many.limit(1).select("doc_id", F.lit(1).alias("quality")), sample_rows=40)
    assert seen[0] == 20000 and seen[1] <= 2 * 50 * langid.DOC_WINDOWS and seen[2] == 40
