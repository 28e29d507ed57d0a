"""Temperature mixing: source token shares raised to a power, realised as block permutations.

The weight of a source with ``T`` tokens is ``T^a / sum T^a``; ``a = 1`` is the corpus as it is,
``a = 0`` gives all sources the same weight. ``a`` is found by bisection, so that either the
weights have a target entropy or no source is repeated more often than a limit. The budget is one
epoch of the source that the weights repeat least, the largest: no document is left out.

A source's budget is filled with blocks. Each block is the whole source in a permutation of its
own (seeded hash order); the last one is cut where the budget is used up.

Scale. The driver sees a handful of sums, never the table of sources. For the entropy, one pass
over that table evaluates all midpoints that ``STEPS`` bisection steps can ask for. The end of a
cut block is found from bucket totals (``order.py``) and kept as a hash bound per source, so rows
are chosen by a comparison. Nulls: a null source is a source of its own, a null text has no
tokens. Documents without tokens are in each whole block. Repeated rows are all kept; rows equal
in id and text share their place and are taken or left together. Empty tables give empty tables.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .order import bucket_count, hash_bucket, running, shuffle_hash

SEED = 29
MAX_REPEATS = 2.0       # times a source may be seen at most, in the registered query and the pipeline
ITERATIONS = 50
STEPS = 5               # bisection steps answered by one pass


def with_tokens(documents: DataFrame) -> DataFrame:
    """``documents`` with ``_key`` (its source, null apart), ``_tokens`` and ``_text_md5``."""
    return documents.withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))) \
        .withColumn("_tokens", F.coalesce(F.regexp_count("text", F.lit(r"[^\t\n\x0B\f\r ]+")), F.lit(0)).cast("bigint")) \
        .withColumn("_text_md5", F.md5(F.coalesce(F.col("text"), F.lit(""))))


def bisect(low: float, high: float, too_low, iterations: int = ITERATIONS) -> float:
    """The upper end of the last interval whose lower end is ``too_low``."""
    for _ in range(iterations):
        middle = (low + high) / 2
        if too_low(middle):
            low = middle
        else:
            high = middle
    return high


def exponent_for_repeats(largest: int, smallest: int, limit: float) -> float:
    """Least exponent in [0, 1] at which the smallest source is repeated ``limit`` times at most."""
    ratio = largest / smallest
    return bisect(0.0, 1.0, lambda a: math.pow(ratio, 1 - a) > limit)


def exponent_for_entropy(sources: DataFrame, target: float) -> float:
    """Exponent in [0, 1] whose weights have the entropy ``target`` (nats); entropy falls with it.

    Out of reach, the nearer end is returned.
    """
    low, high = 0.0, 1.0
    logs = sources.filter("tokens > 0").select(F.log(F.col("tokens").cast("double")).alias("t"))
    peak = logs.agg(F.max("t")).first()[0]
    if peak is None:
        return 1.0
    for _ in range(ITERATIONS // STEPS):
        grid = [low + (high - low) * k / 2 ** STEPS for k in range(1, 2 ** STEPS)]
        sums = logs.agg(*[F.sum(F.exp(a * (F.col("t") - peak))) for a in grid], *[F.sum((F.col("t") - peak) * F.exp(a * (F.col("t") - peak))) for a in grid]).first()
        entropy = [math.log(sums[k]) - a * sums[k + len(grid)] / sums[k] for k, a in enumerate(grid)]
        at, end = 0, 2 ** STEPS
        while end - at > 1:
            middle = (at + end) // 2
            at, end = (middle, end) if entropy[middle - 1] > target else (at, middle)
        low, high = low + (high - low) * at / 2 ** STEPS, low + (high - low) * end / 2 ** STEPS
    return high


def plan(tokens: DataFrame, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None, seed: int = SEED) -> DataFrame:
    """Per source ``_key``: tokens, budget, whole blocks and the hash that ends the cut block.

    ``tokens`` comes from ``with_tokens``. The result is a stored table.
    """
    sources = stored(tokens.groupBy("_key").agg(F.sum("_tokens").alias("tokens"), F.count("*").alias("docs")), "sources")
    ends = sources.filter("tokens > 0").agg(F.max("tokens"), F.min("tokens")).first()
    documents = sources.agg(F.sum("docs")).first()[0] or 0
    if ends[0] is None:
        exponent = 1.0
    elif entropy is not None:
        exponent = exponent_for_entropy(sources, entropy)
    else:
        exponent = exponent_for_repeats(ends[0], ends[1], max_repeats)
    repeats = F.when(F.col("tokens") > 0, F.pow(F.lit(float(ends[0] or 1)) / F.col("tokens"), F.lit(1 - exponent))).otherwise(F.lit(1.0))
    budgets = sources.withColumn("budget", F.floor(F.col("tokens") * repeats + 0.5).cast("bigint")).withColumn(
        "blocks", F.when(F.col("tokens") > 0, F.expr("budget DIV tokens")).otherwise(F.lit(1)).cast("int")).withColumn(
        "rest", (F.col("budget") - F.col("blocks") * F.col("tokens")).cast("bigint"))
    budgets = stored(budgets, "budgets")
    # Where the cut block ends: first among bucket totals, then among the rows of one bucket.
    buckets = bucket_count(documents)
    drawn = tokens.select("_key", "_tokens", "doc_id", "_text_md5").join(budgets.filter("rest > 0").select("_key", "blocks", "rest"), "_key").select(
        "_key", "_tokens", "rest", shuffle_hash(seed, F.col("blocks"), F.col("doc_id"), F.col("_text_md5")).alias("_h")
    ).withColumn("_bucket", hash_bucket(F.col("_h"), buckets))
    drawn = stored(drawn, "drawn")
    earlier = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = drawn.groupBy("_key", "_bucket", "rest").agg(F.sum("_tokens").alias("_sum")).withColumn(
        "_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    cut_bucket = totals.filter("_before <= rest AND _before + _sum > rest").groupBy("_key").agg(
        F.min("_bucket").alias("_bucket"), F.min("_before").alias("_before"))
    upto = Window.partitionBy("_key", "_bucket").orderBy("_h").rangeBetween(Window.unboundedPreceding, 0)
    inside = drawn.join(cut_bucket, ["_key", "_bucket"]).withColumn("_upto", F.col("_before") + F.sum("_tokens").over(upto))
    # Hashes up to ``_end`` are in; without a row inside the bucket the bound is its lower edge.
    edge = F.min(F.when(F.col("_upto") > F.col("rest"), F.col("_h"))).alias("_out")
    bounds = inside.groupBy("_key").agg(edge)
    return stored(budgets.join(bounds, "_key", "left"), "plan")


def repeated(tokens: DataFrame, budgets: DataFrame, seed: int = SEED) -> DataFrame:
    """``tokens`` once per block it is in: ``_epoch`` is the block's number, from 0.

    The source's ``_total`` and ``_budget`` come along; the last block may be a cut one.
    """
    own = budgets.select("_key", *[F.col(c).alias(f"_{n}") for n, c in (("total", "tokens"), ("budget", "budget"), ("blocks", "blocks"), ("rest", "rest"))], "_out")
    joined = tokens.join(own, "_key")
    last = shuffle_hash(seed, F.col("_blocks"), F.col("doc_id"), F.col("_text_md5"))
    cut = (F.col("_rest") > 0) & (last < F.coalesce(F.col("_out"), F.lit(1 << 60)))
    copies = F.col("_blocks") + F.when(cut, 1).otherwise(0)
    return joined.withColumn("_copies", copies).filter("_copies > 0").withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))


def mixed_order(documents: DataFrame, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None, seed: int = SEED) -> DataFrame:
    """Every document of every block with its place in the mixture.

    ``doc_id, source, tokens, epoch, budget_tokens, before, place``: ``before`` counts the source's
    tokens ahead of it, and ``place``, its share of the budget, orders the mixture: sorted by it,
    all sources run out together.
    """
    counted = stored(with_tokens(documents).select("doc_id", "source", "_key", "_tokens", "_text_md5"), "tokens")
    budgets = plan(counted, max_repeats, entropy, seed)
    rows = repeated(counted, budgets, seed).withColumn("_h", shuffle_hash(seed, F.col("_epoch"), F.col("doc_id"), F.col("_text_md5"))) \
        .withColumn("_bucket", hash_bucket(F.col("_h"), bucket_count(counted.count())))
    placed = running(rows, ["_key", "_epoch"], "_bucket", ["_h", "doc_id"], F.col("_tokens"), "_before", "_in_block")
    before = (F.col("_before") + F.col("_epoch") * F.col("_total")).cast("bigint")
    share = F.when(F.col("_budget") > 0, F.col("before").cast("double") / F.col("_budget").cast("double")).otherwise(F.lit(0.0))
    return placed.withColumn("before", before).withColumn("place", share).select(
        "doc_id", "source", F.col("_tokens").alias("tokens"), F.col("_epoch").alias("epoch"), F.col("_budget").alias("budget_tokens"), "before", "place")


def mixture(documents: DataFrame, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None, seed: int = SEED) -> DataFrame:
    """``documents``, each row as often as the mixture has it."""
    # The row travels as one value, so its columns cannot clash with those used on the way.
    counted = with_tokens(documents.select("doc_id", "source", "text", F.struct("*").alias("_row")))
    narrow = stored(counted.select("doc_id", "_key", "_tokens", "_text_md5"), "tokens")
    return repeated(counted, plan(narrow, max_repeats, entropy, seed), seed).select("_row.*")
