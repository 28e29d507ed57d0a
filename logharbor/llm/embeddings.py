"""Embedding near-duplicates: spherical k-means cells, blocked cosine products inside them.

Vectors of one label are compared when they share a cell. Each vector lives in the cell of its
nearest centroid and visits each other cell whose border is near: with centroids ``p`` (its own)
and ``c``, the signed distance to the bisecting plane is ``x.(p - c) / |p - c|``. Two unit vectors
with cosine ``t`` are ``sqrt(2 - 2t)`` apart, so if they live in different cells at least one of
them is within half of that of the plane between those cells, and visits the other's. No pair is
lost; recall is one whatever the centroids are.

Equal vectors of a label are compared once, with their count. Cells are compared in blocks of
bounded size, and a block's pairs in chunks, so a block of links all over takes no more memory than
one of none; it yields a count per vector and a forest of its links, never its pairs. A pair
that meets in two cells is counted in the lower one.

Null, zero, or partly null or non-finite vectors, and rows with a null label, link with nothing.
Vectors of different length are not comparable and never link. Repeated rows are copies of each
other. A null vec_id takes part in counts but names no group unless all of it is null.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import forest, in_blocks, per_block, sides
from .common import small_batches, stored
from .components import components

SAMPLE = 4096           # vectors the centroids are fitted on, at most
CELL_ROWS = 4096        # vectors per cell wanted, over all labels
MAX_CELLS = 1024
ROUNDS = 8
BLOCK = 2048
CHUNK = 1 << 21         # numbers of pairs held at a time while a block is compared


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Unit centroids; an empty cell keeps its old one."""
    rng = np.random.default_rng(seed)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    centroids = x[rng.permutation(len(x))[:k]]
    for _ in range(rounds):
        home = (x @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centroids)
    return centroids


def homes_and_visits(x: np.ndarray, centroids: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Nearest cell of each unit vector, and whether it visits each cell (its own not)."""
    if not len(centroids):
        return np.zeros(len(x), np.int64), np.zeros((len(x), 1), bool)
    dots = x @ centroids.T
    home = dots.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * centroids @ centroids.T, 0))[home]
    reach = 0.5 * np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-7
    visits = dots[np.arange(len(x)), home][:, None] - dots <= reach * apart + 1e-9
    visits[np.arange(len(x)), home] = False
    return home, visits


def _classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the two halves of their vector's hash, and the distinct comparable vectors."""
    rows = vectors.select("vec_id", "label", "embedding", F.xxhash64("label", "embedding").alias("h1"),
                          F.xxhash64(F.lit(77), "embedding", "label").alias("h2"))
    fine = F.col("embedding").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & ~F.exists(
        "embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists("embedding", lambda v: v != 0)
    # Classes get a number once and keep it: the table is written before it is used.
    distinct = rows.filter(fine).groupBy("h1", "h2", "label").agg(
        F.first("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    return rows.drop("embedding"), stored(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")


def fit_cells(classes: DataFrame, sample: int = SAMPLE, cell_rows: int = CELL_ROWS) -> np.ndarray:
    """Centroids for the most frequent vector length of a bounded sample."""
    count = classes.count()
    scale = 1 << 30
    limit = min(scale, 2 * scale * sample // max(1, count))
    picked = classes.filter(F.pmod(F.xxhash64("h1"), F.lit(scale)) < limit).select("h1", "embedding").orderBy("h1").limit(sample).collect()
    if not picked:
        return np.zeros((0, 0))
    size = Counter(len(r.embedding) for r in picked).most_common(1)[0][0]
    x = np.array([r.embedding for r in picked if len(r.embedding) == size], np.float64)
    return spherical_kmeans(x, min(MAX_CELLS, len(x), max(1, -(-count // cell_rows))))


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors (vec_id, label, embedding)``."""
    rows, classes = _classes(vectors)
    centroids = fit_cells(classes)
    number = classes.schema["embedding"].dataType.elementType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("embedding")])
            home, visited = np.zeros(len(sizes), np.int64), [[] for _ in sizes]
            fits = np.flatnonzero(sizes == centroids.shape[1]) if len(centroids) else np.zeros(0, np.int64)
            if len(fits):
                x = np.array([batch.column("embedding")[int(k)].as_py() for k in fits], np.float64)
                own, visits = homes_and_visits(x / np.linalg.norm(x, axis=1, keepdims=True), centroids, threshold)
                home[fits] = own
                for k, row in zip(fits.tolist(), visits):
                    visited[k] = np.flatnonzero(row).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("label"), batch.column("copies"), batch.column("embedding"), pa.array(sizes, pa.int64()),
                 pa.array(home, pa.int64()), pa.array(visited, pa.list_(pa.int64()))],
                names=["node", "label", "copies", "embedding", "length", "home", "visits"])

    kind = dict(classes.dtypes)["label"]
    homed = small_batches(classes.select("node", "label", "copies", "embedding"), 2048).mapInArrow(
        assign, f"node bigint, label {kind}, copies bigint, embedding array<{number}>, length bigint, home bigint, visits array<bigint>")
    in_cells = homed.withColumn("cell", F.explode(F.concat(F.array("home"), "visits"))).withColumn("list", F.xxhash64("label", "length"))
    found = stored(per_block(in_blocks(in_cells, ["list", "cell"], "node", BLOCK), ["list", "cell"], _compare(threshold),
                             "node bigint, links bigint, joined bigint"), "links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.filter("joined IS NOT NULL").select(F.col("node").alias("a"), F.col("joined").alias("b")))
    named = classes.select("node", "h1", "h2", "label", "copies", "low").join(groups, "node", "left").join(counts, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("low").alias("component_id"))
    result = stored(named.join(least, "component").select(
        "h1", "h2", F.col("label").alias("_label"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "groups")
    joined = rows.join(result, (rows.h1 == result.h1) & (rows.h2 == result.h2) & (rows.label == result._label), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _compare(threshold: float):
    """Links of a block, its pairs decided in chunks: a worker holds the block's vectors and ``CHUNK`` numbers more."""
    def links(table: pa.Table) -> pa.RecordBatch | None:
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        home, cell = table.column("home").to_numpy(), int(table.column("cell")[0].as_py())
        x = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(node), -1)
        left, right, same_chunk = sides(table)
        if not len(left) or not len(right):
            return None
        norms = np.sqrt((x * x).sum(axis=1))
        cells, visiting = _visited(table.column("visits").combine_chunks(), home)
        place = np.searchsorted(cells, home)
        counts, label = np.zeros(len(node)), np.arange(len(node))
        theirs, rows, pairs = x[right].T / norms[right], max(1, CHUNK // len(right)), max(1, CHUNK // x.shape[1])
        for at in range(0, len(left), rows):
            mine = left[at:at + rows]
            cosine = (x[mine] @ theirs) / norms[mine][:, None]
            near_i, near_j = np.nonzero(cosine >= threshold - 1e-12)
            sure = cosine[near_i, near_j] > threshold + 1e-12
            near_i, near_j = mine[near_i], right[near_j]
            keep = (home[near_i] == cell) | (home[near_j] == cell)
            if same_chunk:
                keep &= near_i < near_j
            near_i, near_j, sure = near_i[keep], near_j[keep], sure[keep]
            for k in range(0, len(near_i), pairs):
                i, j, exact = near_i[k:k + pairs], near_j[k:k + pairs], sure[k:k + pairs].copy()
                # Sums of a matrix product may differ in the last digits: where that matters, one plain sum decides.
                edge = np.flatnonzero(~exact)
                exact[edge] = (x[i[edge]] * x[j[edge]]).sum(axis=1) / (norms[i[edge]] * norms[j[edge]]) >= threshold
                i, j = i[exact], j[exact]
                guest, host = np.where(home[i] == cell, j, i), np.where(home[i] == cell, i, j)
                # A pair with two homes is counted here if it does not meet in the other home, or this is the lower one.
                here = (home[guest] == cell) | (cell < home[guest]) | ~visiting[host, place[guest]]
                counts += np.bincount(i[here], copies[j[here]], len(node)) + np.bincount(j[here], copies[i[here]], len(node))
                grown = np.flatnonzero(label != np.arange(len(node)))
                a, b = forest(len(node), np.concatenate([grown, i]), np.concatenate([label[grown], j]))
                label[a] = b
        told = np.flatnonzero((counts > 0) | (label != np.arange(len(node))))
        joined = pa.array(node[label[told]], mask=label[told] == told)
        return pa.RecordBatch.from_arrays([pa.array(node[told]), pa.array(counts[told].astype(np.int64)), joined], names=["node", "links", "joined"])

    return links


def _visited(visits: pa.Array, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The homes of a block's vectors, sorted, and a bit for each vector and each of them that it visits."""
    cells = np.unique(home)
    flat = visits.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    who = np.repeat(np.arange(len(home)), visits.value_lengths().to_numpy(zero_copy_only=False))
    at = np.minimum(np.searchsorted(cells, flat), len(cells) - 1)
    found = np.zeros((len(home), len(cells)), bool)
    found[who[cells[at] == flat], at[cells[at] == flat]] = True
    return cells, found
