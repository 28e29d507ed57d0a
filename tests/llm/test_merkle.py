"""The Merkle manifest and its climb against plain hashing."""

import hashlib
import zlib

import pytest

from logharbor.llm import merkle
from logharbor.llm.common import table
from logharbor.llm.queries import op11_merkle_climb

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return H(*map(field, (r.doc_id, r.source, r.lang, r.n_chars, text)))


def climb(levels, at, h):
    proof = ""
    for level in levels[:-1]:
        lo = at // 8 * 8
        run = level[lo:lo + 8]
        left, right = "".join(run[:at - lo]), "".join(run[at - lo + 1:])
        proof, h, at = proof + left + right, H(left, h, right), at // 8
    return proof, h


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k:k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def expected(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r.lang, []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for k in langs:
        by_lang[k].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        trees[k] = tree([leaf(r, r.text) for r in by_lang[k]])
    top = tree([trees[k][-1][0] for k in langs])
    out = []
    for place, k in enumerate(langs):
        for at, r in enumerate(by_lang[k]):
            text = r.text
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            low, h = climb(trees[k], at, leaf(r, text))
            high, h = climb(top, place, h)
            root = top[-1][0]
            out.append((str(r.doc_id), trees[k][0][at], trees[k][-1][0], root, H(low + high), h, str(h == root)))
    return sorted(out)


def found(df):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted(tuple(str(r[c]) if c in ("doc_id", "verified") else r[c] for c in names) for r in df.collect())


def proofs(spark, rows):
    from pyspark.sql import functions as F
    return merkle.proofs(spark.createDataFrame(rows, SCHEMA)).withColumn("proof_sha256", F.sha2("proof", 256))


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8}, {"en": 9, None: 1}, {"a": 65, "b": 1, "B": 8, "é": 513, None: 3}, {f"l{i}": 1 + i % 3 for i in range(70)}])
def test_shapes(spark, sizes):
    rows = [(7 * i % 1000, f"Text {i} É", lang, None if i % 2 else "s", i) for lang, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(proofs(spark, rows)) == expected(df.collect())


def test_edges(spark):
    rows = [(None, "A", "x", None, None), (None, None, "x", None, 1), (3, "", None, "s", 0), (3, "", None, "s", 0), (3, "B", None, "s", 0), (5, "C" * 100_000, "y", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(proofs(spark, rows)) == expected(df.collect())
    assert merkle.proofs(df.limit(0)).count() == 0
    more = merkle.proofs(df.selectExpr("*", "1 AS hash", "2 AS tree", "3 AS `index`", "4 AS n", "5 AS _part"))
    assert more.count() == 6
    before = spark.conf.get(merkle.ROW_LIMIT, None)
    assert before is None or before != "-1"


def test_the_query_equals_plain_hashing(spark, sf_dir):
    assert found(op11_merkle_climb(spark, sf_dir)) == expected(table(spark, sf_dir, "documents").collect())


def test_a_changed_row_does_not_verify(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    from pyspark.sql import functions as F
    changed = F.when(F.col("doc_id") == 5, merkle.leaf_hash(text=F.concat("text", F.lit("!")))).otherwise(merkle.leaf_hash())
    assert [r.doc_id for r in merkle.proofs(docs, changed).filter("NOT verified").collect()] == [5]
