"""Registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, embeddings, html_text, langid, merkle, mixing, periodic, pii, quality, sharding, simhash, suffix, tiff
from .common import id_remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def vocabulary_path() -> str:
    """Where the public tokenizer files lie; ``LOGHARBOR_BPE`` names another vocabulary file."""
    own = os.environ.get("LOGHARBOR_BPE")
    if own:
        return own
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op1_tiff_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts stored as TIFF pages and read back."""
    media = tiff.with_tiff(table(spark, sf_dir, "documents"))
    read = tiff.with_pages(media).withColumn(
        "payload", F.aggregate("pages", F.lit(b""), lambda a, p: F.concat(a, p["pixels"])))
    first = F.col("pages")[0]
    feature = F.concat_ws(
        ";", F.concat(F.lit("pages="), F.size("pages")), F.concat(F.lit("size="), first["width"], F.lit("x"), first["height"]),
        F.concat(F.lit("samples="), first["samples"]), F.concat(F.lit("compression="), first["compression"]),
        F.concat(F.lit("predictor="), first["predictor"]), F.concat(F.lit("tiled="), first["tiled"].cast("int")),
        F.concat(F.lit("rows="), F.aggregate("pages", F.lit(0), lambda a, p: a + p["height"])),
        F.concat(F.lit("crc="), F.crc32("payload")))
    return read.select(
        "doc_id", "n_bytes", F.length("payload").cast("bigint").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring(F.col("payload"), -16, 16)).alias("tail_crc32"), F.length("media").cast("bigint").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"))


@query()
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of 64-bit fingerprints of 3-word shingles linked at up to 3 differing bits."""
    prints = simhash.with_fingerprint(table(spark, sf_dir, "documents"), words=3, bits=64)
    groups = simhash.near_duplicate_groups(prints, radius=3, bits=64)
    return groups.select("doc_id", F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of whole texts, decoded again."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary_path())


@query()
def op9_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents; the machine learns from the other three folds."""
    documents = table(spark, sf_dir, "documents")
    machine = quality.train(documents, table(spark, sf_dir, "labels"), folds=4, held_out=2)
    scored = quality.with_score(documents.select("doc_id", "text", "n_chars"), machine, "score")
    return scored.select("doc_id", F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query()
def op6_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents by the byte network."""
    documents = table(spark, sf_dir, "documents")
    found = langid.predictions(documents, langid.train(documents, folds=5, held_out=0))
    return found.select("doc_id", F.coalesce(id_remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query()
def op3_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages, site templates removed."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query()
def op5_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of personal data in all documents."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.with_spans(documents, pii.train(documents))

    def joined(column: str):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["from"], s["to"])), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
                        (F.size("spans") - F.size("base")).cast("bigint").alias("n_added"))


@query("""
WITH RECURSIVE rows AS (
  SELECT doc_id, coalesce('=' || source, '') AS k, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\t\\n\\x0B\\f\\r ]+'))::BIGINT AS tokens, md5(coalesce(text, '')) AS m
  FROM documents
),
sources AS (SELECT k, sum(tokens)::BIGINT AS total FROM rows GROUP BY k),
ends AS (SELECT max(total)::DOUBLE AS hi, min(total)::DOUBLE AS lo FROM sources WHERE total > 0),
halving(step, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN pow(e.hi / e.lo, 1 - (low + high) / 2) > 2.0 THEN (low + high) / 2 ELSE low END,
    CASE WHEN pow(e.hi / e.lo, 1 - (low + high) / 2) > 2.0 THEN high ELSE (low + high) / 2 END
  FROM halving, ends e WHERE step < 50
),
chosen AS (SELECT high AS a FROM halving WHERE step = 50),
budgets AS (
  SELECT k, total, CASE WHEN total > 0 THEN floor(total * pow(e.hi / total, 1 - a) + 0.5)::BIGINT ELSE 0 END AS budget
  FROM sources, ends e, chosen
),
blocks AS (SELECT *, CASE WHEN total > 0 THEN budget // total ELSE 1 END AS whole FROM budgets),
drawn AS (
  SELECT r.*, b.total, b.budget, b.whole, g.epoch,
    ('0x' || substr(md5('29|' || g.epoch || '|' || coalesce(doc_id::VARCHAR, '-') || '|' || m), 1, 15))::BIGINT AS h
  FROM rows r JOIN blocks b USING (k), generate_series(0, 3) g(epoch) WHERE g.epoch <= b.whole
),
summed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY k, epoch ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    coalesce(sum(tokens) OVER (PARTITION BY k, epoch ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM drawn
)
SELECT doc_id, source, tokens, epoch::INTEGER AS epoch, budget AS budget_tokens, (epoch * total + ahead)::BIGINT AS "before",
  CASE WHEN budget > 0 THEN (epoch * total + ahead)::DOUBLE / budget::DOUBLE ELSE 0.0 END AS place
FROM summed WHERE epoch < whole OR (budget - whole * total > 0 AND upto <= budget - whole * total)
""")
def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in the blocks of a mixture that repeats no source more than twice."""
    return mixing.mixed_order(table(spark, sf_dir, "documents"))


@query()
def op8_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of the same source mixture."""
    placed = sharding.stratified_shards(table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND NOT list_bool_or([x IS NULL OR isnan(x) OR isinf(x) FOR x IN embedding]) AND list_bool_or([x <> 0 FOR x IN embedding])
),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
),
reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
least AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN least ON least.a = vec_id LEFT JOIN degree ON degree.a = vec_id
""")
def op10_spherical_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors at cosine 0.98."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


@query("""
WITH RECURSIVE
crc_step(i, c, step) AS (
  SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, step + 1 FROM crc_step WHERE step < 8
),
crc_table AS (SELECT list(c ORDER BY i) AS tab FROM crc_step WHERE step = 8),
docs AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) % 3 = 0 AS hit
  FROM documents, crc_table
),
fields AS (
  SELECT doc_id, lang, hit, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM docs
),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(text) || ':' || CASE WHEN hit
      THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS tampered
  FROM fields
),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves),
built(lang, level, nodes) AS (
  SELECT lang, 0, list(leaf ORDER BY idx) FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, [sha256(array_to_string(nodes[k * 8 + 1:k * 8 + 8], '')) FOR k IN range(0, (len(nodes) + 7) // 8)]
  FROM built WHERE len(nodes) > 1
),
subroots AS (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM built WHERE len(nodes) = 1
),
top(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY place) FROM subroots
  UNION ALL
  SELECT level + 1, [sha256(array_to_string(nodes[k * 8 + 1:k * 8 + 8], '')) FOR k IN range(0, (len(nodes) + 7) // 8)]
  FROM top WHERE len(nodes) > 1
),
levels AS (
  SELECT s.lang, list(b.nodes ORDER BY b.level) FILTER (len(b.nodes) > 1) AS lists
  FROM subroots s JOIN built b ON b.lang IS NOT DISTINCT FROM s.lang GROUP BY s.lang
),
tops AS (SELECT list(nodes ORDER BY level) FILTER (len(nodes) > 1) AS lists, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root FROM top),
paths AS (
  SELECT p.doc_id, p.leaf, p.tampered, s.subroot, t.root,
    list_concat(
      [{'run': l[i][((p.idx >> (3 * (i - 1))) // 8) * 8 + 1:((p.idx >> (3 * (i - 1))) // 8) * 8 + 8], 'at': (p.idx >> (3 * (i - 1))) % 8}
        FOR i IN range(1, len(l) + 1)],
      [{'run': u[i][((s.place >> (3 * (i - 1))) // 8) * 8 + 1:((s.place >> (3 * (i - 1))) // 8) * 8 + 8], 'at': (s.place >> (3 * (i - 1))) % 8}
        FOR i IN range(1, len(u) + 1)]) AS steps
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
  JOIN (SELECT lang AS k, coalesce(lists, []) AS l FROM levels) v ON v.k IS NOT DISTINCT FROM p.lang,
  (SELECT coalesce(lists, []) AS u, root FROM tops) t
),
sided AS (
  SELECT * EXCLUDE steps, list_transform(steps, lambda s: [array_to_string(s.run[1:s.at], ''), array_to_string(s.run[s.at + 2:8], '')]) AS sides FROM paths
),
folded AS (
  SELECT *, list_reduce(list_prepend([tampered], sides), lambda h, s: [sha256(s[1] || h[1] || s[2])])[1] AS folded_root FROM sided
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(sides, lambda s: s[1] || s[2]), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM folded
""")
def op11_merkle_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, and what changed texts fold to."""
    found = merkle.proofs(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def with_planted_run(documents: DataFrame) -> DataFrame:
    """``text`` of a tenth of the documents becomes periodic from some word on (the contract of ``op12``)."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    words = F.filter(F.split("text", "[ \\x09-\\x0D]+"), lambda w: w != "")
    n, g = F.size("_words"), F.floor(h / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    place = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
    planted = F.array_join(F.transform(place, lambda i: F.get("_words", i.cast("int"))), " ")
    split = documents.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_words"))
    return split.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in all documents, and the texts without the repeats."""
    found = periodic.with_runs(with_planted_run(table(spark, sf_dir, "documents")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = F.col("_best")
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    return found.withColumn("_best", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"), (-best["less"]).alias("length"),
        best["period"].alias("period"), F.floor(-best["less"] * 1000 / best["period"]).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"))


@query()
def op13_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of repeated 200-byte strings."""
    found = suffix.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
