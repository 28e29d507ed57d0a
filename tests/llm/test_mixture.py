"""Mixing, sharding and embedding groups: SQL, brute force, edge rows."""

import math
import os
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from logharbor.llm import embeddings, mixing, sharding
from logharbor.llm.queries import ORACLES, QUERIES
from tools.check import rows_of


@pytest.fixture(scope="module")
def con(sf_dir):
    db = duckdb.connect()
    for name in os.listdir(sf_dir):
        if name.endswith(".parquet"):
            db.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{sf_dir}/{name}'")
    return db


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def documents(spark, sizes):
    rows = [(100 * k + i, "w " * (3 + i % 5), source, "x") for k, (source, n) in enumerate(sizes.items()) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, epoch string")


def test_mixture_and_order_agree(spark):
    docs = documents(spark, {"a": 60, "b": 25, None: 8, "d": 3})
    order = mixing.mixed_order(docs, max_repeats=3.0).collect()
    copies = Counter((r.doc_id, r.source) for r in order)
    assert copies == Counter((r.doc_id, r.source) for r in mixing.mixture(docs, max_repeats=3.0).collect())
    tokens = {r.source: 0 for r in order}
    for r in docs.collect():
        tokens[r.source] += len(r.text.split())
    biggest = max(tokens.values())
    exponent = 1 - math.log(3) / math.log(biggest / min(tokens.values()))
    for source, total in tokens.items():
        budget = math.floor(total * (biggest / total) ** (1 - exponent) + 0.5)
        mine = sorted((r for r in order if r.source == source), key=lambda r: (r.before, r.epoch))
        used = sum(r.tokens for r in mine)
        assert used <= budget < used + 8 and mine[0].budget_tokens == budget
        assert [r.before for r in mine] == list(np.cumsum([0] + [r.tokens for r in mine[:-1]]))
        assert min(c for (_, s), c in copies.items() if s == source) >= budget // total
        assert {r.doc_id for r in mine if r.epoch == 0} == {r.doc_id for r in docs.collect() if r.source == source}


def test_entropy_target(spark):
    sources = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10), ("d", 0)], "_key string, tokens bigint")

    def entropy(a):
        w = np.array([1000.0, 100, 10]) ** a
        p = w / w.sum()
        return -(p * np.log(p)).sum()

    for target in (0.5, 0.8, 1.05):
        assert entropy(mixing.exponent_for_entropy(sources, target)) == pytest.approx(target, abs=1e-6)
    assert mixing.exponent_for_entropy(sources, 0.0) == pytest.approx(1.0)
    assert mixing.exponent_for_entropy(sources, 9.0) == pytest.approx(0.0, abs=1e-6)
    assert mixing.exponent_for_repeats(1000, 10, 2.0) == pytest.approx(1 - math.log(2) / math.log(100))


def test_mixing_edges(spark):
    df = spark.createDataFrame([(1, None, "s", "x"), (2, "", "s", "x"), (None, "a b", None, "x"), (4, "c d e", "t", "x"), (4, "c d e", "t", "x")],
                               "doc_id bigint, text string, source string, tokens string")
    got = Counter((r.doc_id, r.source) for r in mixing.mixture(df).collect())
    assert set(got) == {(1, "s"), (2, "s"), (None, None), (4, "t")} and got[4, "t"] == 2
    assert mixing.mixture(df.limit(0)).count() == 0 and mixing.mixed_order(df.limit(0)).count() == 0


def test_shards_against_brute_force(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op8_stratified_shards"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    by_shard, mixture = defaultdict(list), Counter()
    for r in rows:
        text = (docs[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text), "rows", None)
        by_shard[r.shard].append(r.slot)
        mixture[r.shard, docs[r.doc_id].source] += 1
    assert set(by_shard) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    totals = Counter(d.source for d in docs.values())
    assert all(abs(mixture[s, source] - n / 16) < 2 for s in range(16) for source, n in totals.items())


def test_shards_are_native_and_handle_edges(spark, sf_dir):
    plan = QUERIES["op8_stratified_shards"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "Cartesian"))
    df = spark.createDataFrame([(1, None, None, "x"), (1, None, None, "x"), (None, "é", "s", "x")] + [(k, "t", "hot", "x") for k in range(40)],
                               "doc_id bigint, text string, source string, size string")
    rows = sharding.stratified_shards(df, shards=5).collect()
    assert len(rows) == 43 and sorted(Counter(r.shard for r in rows).values()) == [8, 8, 9, 9, 9]
    assert sharding.stratified_shards(df.limit(0)).count() == 0


def brute_links(rows):
    x = {i: np.array(e, np.float64) for i, _, e in rows if e and all(v is not None and math.isfinite(v) for v in e) and any(e)}
    label = {i: l for i, l, _ in rows}
    links = defaultdict(set)
    for a in x:
        for b in x:
            if a != b and label[a] is not None and label[a] == label[b] and len(x[a]) == len(x[b]) and \
                    x[a] @ x[b] / (np.linalg.norm(x[a]) * np.linalg.norm(x[b])) >= 0.98:
                links[a].add(b)
    return links


def test_embedding_groups_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL_ROWS", 8)
    monkeypatch.setattr(embeddings, "BLOCK", 9)
    rng = np.random.default_rng(12)
    centres = rng.normal(0, 1, (12, 16))
    rows = []
    for k in range(260):
        v = centres[k % 12] + rng.normal(0, 0.12, 16)
        rows.append((k, int(k % 3), [float(f) for f in v]))
    rows += [(300 + k, 0, rows[0][2]) for k in range(5)] + [(400, 0, None), (401, 0, [0.0] * 16), (402, 0, [float("nan")] * 16), (403, None, rows[0][2]),
                                                           (404, 0, rows[0][2][:3]), (405, 0, [None] + rows[0][2][1:]), (406, 0, [])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, label int, embedding array<double>, node string")
    links = brute_links(rows)
    got = {r.vec_id: r for r in embeddings.near_duplicates(df).collect()}
    assert len(got) == len(rows)

    def reach(i):
        seen, todo = {i}, [i]
        while todo:
            for n in links[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        return min(seen)

    for i, _, _ in rows:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(links[i]), reach(i), reach(i) == i), i
    assert sum(r.n_links for r in got.values()) > 300
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
