"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document is a sparse vector ``x``: hashed lower-case words (log counts, length one together),
and one indicator per structure statistic or metadata value for the bin it falls in. The score is
``sigmoid(w0 + w.x + 1/2 sum_f ((V_f.x)^2 - (V_f^2).(x^2)))``: all pairs of features interact
through vectors of ``RANK`` numbers, in time linear in the features present.

Whole texts are read. Null and empty texts have no words and statistics of zero, and get a score
like any other. Training takes at most ``SAMPLE_ROWS`` labelled rows, in the order of a hash of
their id; workers turn them into features, so no text reaches the driver. Labels that are null,
and ids that are null, are left out. Rows of ``labels`` that repeat count repeatedly. Without any
labelled row every score is 0.5.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, small_batches

WORD_SLOTS = 4096
BINS = 10
RANK = 8
SAMPLE_ROWS = 6000          # labelled rows the model is fitted on, at most
EPOCHS, BATCH, RATE, DECAY = 12, 128, 0.02, 1e-4
THRESHOLD = 0.7
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
PUNCTUATION = np.frombuffer(b".,;:?'\"()-", np.uint8)
SYMBOLS = np.frombuffer(b"#$%&*+/<=>@[\\]^_`{|}~", np.uint8)
STATS = 16


def features(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word slots, their values, and the statistics before binning."""
    data = (text or "").encode()
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256) if data else np.zeros(256, np.int64)
    words = data.translate(LOWER).split()
    counts = Counter(words)
    n, total = max(1, len(data)), max(1, len(words))
    upper, lower = int(seen[65:91].sum()), int(seen[97:123].sum())
    repeats = sum(map(operator.eq, words, words[1:]))
    top = max(counts.values(), default=0)
    lines = int(seen[10]) + 1
    stats = np.array([
        upper / max(1, upper + lower), seen[48:58].sum() / n, seen[PUNCTUATION].sum() / n, seen[33] / total,
        seen[SYMBOLS].sum() / total, seen[124] / total, seen[128:].sum() / n, lines / total, len(counts) / total,
        top / total, (n - total) / total / 10, np.log1p(len(data)), np.log1p(total / lines), repeats / total,
        np.log1p(n_chars or 0), (n_chars or 0) / n,
    ], np.float64)
    slots: dict[int, float] = {}
    for word, times in counts.items():
        slot = zlib.crc32(word) % WORD_SLOTS
        slots[slot] = slots.get(slot, 0.0) + np.log1p(times) if times > 1 else slots.get(slot, 0.0) + 0.6931471805599453
    index = np.fromiter(slots.keys(), np.int64, len(slots))
    value = np.fromiter(slots.values(), np.float64, len(slots))
    return index, value / np.sqrt((value ** 2).sum()) if len(value) else value, stats


@dataclass
class Machine:
    cuts: np.ndarray        # (statistics, BINS - 1)
    bias: float
    linear: np.ndarray
    factors: np.ndarray     # (features, RANK)

    def vector(self, index: np.ndarray, value: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bins = (stats[:, None] > self.cuts).sum(axis=1)
        own = WORD_SLOTS + BINS * np.arange(len(stats)) + bins
        return np.concatenate([index, own]), np.concatenate([value, np.ones(len(own))])

    def score(self, index: np.ndarray, value: np.ndarray, stats: np.ndarray) -> float:
        at, x = self.vector(index, value, stats)
        v = self.factors[at]
        pairs = 0.5 * float((((x[:, None] * v).sum(axis=0)) ** 2 - ((x[:, None] * v) ** 2).sum(axis=0)).sum())
        z = self.bias + float(x @ self.linear[at]) + pairs
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Machine:
    """Logistic loss by Adam on dense batches of the (bounded) sample."""
    size = WORD_SLOTS + STATS * BINS
    if not rows:
        return Machine(np.zeros((STATS, BINS - 1)), 0.0, np.zeros(size), np.zeros((size, RANK)))
    rng = np.random.default_rng(seed)
    stats = np.stack([r[2] for r in rows])
    cuts = np.quantile(stats, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T.copy()
    machine = Machine(cuts, 0.0, np.zeros(size), rng.normal(0, 0.05, (size, RANK)))
    x = np.zeros((len(rows), size), np.float32)
    for k, row in enumerate(rows):
        at, value = machine.vector(*row)
        x[k, at] = value
    w, v, b = machine.linear.astype(np.float32), machine.factors.astype(np.float32), np.float32(0)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, v, b)]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            take = order[at:at + BATCH]
            part, y = x[take], labels[take].astype(np.float32)
            inner = part @ v
            squares = part ** 2
            z = b + part @ w + 0.5 * ((inner ** 2).sum(axis=1) - (squares @ (v ** 2)).sum(axis=1))
            g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y).astype(np.float32) / len(take)
            grads = (part.T @ g + DECAY * w, part.T @ (g[:, None] * inner) - v * (squares.T @ g)[:, None] + DECAY * v, g.sum())
            step += 1
            params = []
            for p, grad, m in zip((w, v, b), grads, moments):
                m[0] = 0.9 * m[0] + 0.1 * grad
                m[1] = 0.999 * m[1] + 0.001 * grad ** 2
                rate = RATE * (1 - 0.999 ** step) ** 0.5 / (1 - 0.9 ** step)
                params.append((p - rate * m[0] / (np.sqrt(m[1]) + 1e-8)).astype(np.float32))
            w, v, b = params
    return Machine(cuts, float(b), w.astype(np.float64), v.astype(np.float64))


# --- on tables ---------------------------------------------------------------------------------


def train(documents: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on labelled rows outside the held-out fold."""
    order = F.xxhash64("doc_id", F.lit(1))
    picked = labels.filter(id_remainder(F.col("doc_id"), folds) != held_out).filter("quality IS NOT NULL") \
        .select("doc_id", F.col("quality").cast("double").alias("quality")).orderBy(order, "doc_id", "quality").limit(sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py(), n.as_py()) for t, n in zip(batch.column("text"), batch.column("n_chars"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality")] + [pa.array([r[k].tolist() for r in rows], pa.list_(kind))
                                                                     for k, kind in enumerate((pa.int32(), pa.float64(), pa.float64()))],
                names=["doc_id", "quality", "index", "value", "stats"])

    # The sample has a fixed bound, so it may be broadcast.
    rows = documents.select("doc_id", "text", F.col("n_chars").cast("bigint").alias("n_chars")).join(F.broadcast(picked), "doc_id")
    drawn = small_batches(rows.select("doc_id", "quality", "text", "n_chars")).mapInArrow(
        run, f"doc_id {dict(rows.dtypes)['doc_id']}, quality double, index array<int>, value array<double>, stats array<double>")
    # An id may have very many rows: what the driver gets is bounded after the join, by a hash of id and features.
    got = drawn.orderBy(F.xxhash64("doc_id", "index", "value", "stats"), "doc_id", "quality").limit(sample_rows).collect()
    got.sort(key=lambda r: (r.doc_id, r.quality, r.stats))
    vectors = [(np.array(r["index"], np.int64), np.array(r["value"]), np.array(r["stats"])) for r in got]
    return fit(vectors, np.array([r.quality for r in got]))


def with_score(df: DataFrame, machine: Machine, column: str = "quality_score") -> DataFrame:
    """``df`` with its score; a column of that name is replaced."""
    df = df.drop(column)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n_chars").cast(pa.int64()) if "n_chars" in names else [pa.scalar(None)] * batch.num_rows
            scores = [machine.score(*features(t.as_py(), n.as_py())) for t, n in zip(batch.column("text"), sizes)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*names, column])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return small_batches(df).mapInArrow(run, f"{fields}, `{column}` double")
