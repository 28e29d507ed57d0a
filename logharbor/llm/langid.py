"""Language identification by a byte convolutional network, trained in NumPy.

A lower-cased text is cut into windows of ``WINDOW`` bytes, all of it. Each byte has an embedding;
filters of several widths slide over the window, each keeps its largest response, and a softmax
over those gives language probabilities. A text's probabilities are the mean over its windows,
weighted by the bytes they hold.

For scoring, embedding and filters are multiplied out: a response is a sum of rows looked up by
byte pairs, so no multiplication is left in the inner loop.

A null text, or one without a letter, is ``und`` with score 0. Training takes at most
about ``SAMPLE_DOCS`` documents (by a hash of the id; twice their windows where ids repeat), as many per language where there are enough, and
``DOC_WINDOWS`` windows of each, spread over the whole text; rows without language are left out.
With no labelled row at all everything is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, small_batches

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16                # per width
EMBED = 8
SAMPLE_DOCS = 3000          # documents the network is trained on, at most
DOC_WINDOWS = 4
EPOCHS, BATCH, RATE = 4, 64, 0.01
UNKNOWN = "und"


def has_letter(text: str) -> bool:
    """Whether a character is a letter by its general category (digits, powers and numerals are none)."""
    return any(map(str.isalpha, text))


def windows(data: bytes) -> np.ndarray:
    """All windows of a text, the last one filled with zero bytes."""
    count = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(count * WINDOW, b"\0"), np.uint8).reshape(count, WINDOW)


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray               # (256, EMBED)
    filters: list[np.ndarray]           # (width * EMBED, FILTERS) each
    biases: list[np.ndarray]
    dense: np.ndarray                   # (3 * FILTERS, languages)
    offset: np.ndarray


class Scorer:
    """A network with its filters multiplied out to tables over bytes and byte pairs."""

    def __init__(self, net: Network):
        self.net = net
        singles = [[net.embedding @ w[k * EMBED:(k + 1) * EMBED] for k in range(width)] for width, w in zip(WIDTHS, net.filters)]

        def pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
            return (first[:, None, :] + second[None, :, :]).reshape(65536, FILTERS).astype(np.float32)

        self.two = pairs(singles[0][0], singles[0][1])
        self.three, self.third = pairs(singles[1][0], singles[1][1]), singles[1][2].astype(np.float32)
        self.four, self.last = pairs(singles[2][0], singles[2][1]), pairs(singles[2][2], singles[2][3])

    def probabilities(self, data: np.ndarray) -> np.ndarray:
        """Language probabilities of each window."""
        out = []
        for at in range(0, len(data), 64):
            part = data[at:at + 64]
            codes = part[:, :-1].astype(np.int64) << 8 | part[:, 1:]
            pooled = np.concatenate([
                self.two.take(codes, axis=0).max(axis=1) + self.net.biases[0],
                (self.three.take(codes[:, :-1], axis=0) + self.third.take(part[:, 2:], axis=0)).max(axis=1) + self.net.biases[1],
                (self.four.take(codes[:, :-2], axis=0) + self.last.take(codes[:, 2:], axis=0)).max(axis=1) + self.net.biases[2],
            ], axis=1)
            z = np.maximum(pooled, 0) @ self.net.dense + self.net.offset
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out.append(z / z.sum(axis=1, keepdims=True))
        return np.concatenate(out)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.net.languages or not has_letter(text):
            return UNKNOWN, 0.0
        data = text.lower().encode()
        cut = windows(data)
        weight = np.full(len(cut), float(WINDOW))
        weight[-1] = len(data) - WINDOW * (len(cut) - 1)
        mean = (self.probabilities(cut) * weight[:, None]).sum(axis=0) / weight.sum()
        best = int(mean.argmax())
        return self.net.languages[best], min(1.0, float(mean[best]))


def fit(data: np.ndarray, target: np.ndarray, languages: list[str], seed: int = 11) -> Network:
    """Cross-entropy by Adam; the gradient of a pooled response goes to the place it came from."""
    rng = np.random.default_rng(seed)
    kinds = len(languages)
    params = [rng.normal(0, 0.5, (256, EMBED))]
    params += [rng.normal(0, (2 / (w * EMBED)) ** 0.5, (w * EMBED, FILTERS)) for w in WIDTHS]
    params += [np.zeros(FILTERS) for _ in WIDTHS]
    params += [rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, kinds)), np.zeros(kinds)]
    params = [p.astype(np.float32) for p in params]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    n, step = len(WIDTHS), 0
    for _ in range(EPOCHS if len(data) else 0):
        order = rng.permutation(len(data))
        for at in range(0, len(order), BATCH):
            take = order[at:at + BATCH]
            raw, goal = data[take], target[take]
            embedded = params[0][raw]
            patches, places, pooled = [], [], []
            for k, width in enumerate(WIDTHS):
                span = WINDOW - width + 1
                patch = np.concatenate([embedded[:, i:i + span] for i in range(width)], axis=2)
                response = patch @ params[1 + k] + params[1 + n + k]
                place = response.argmax(axis=1)
                patches.append(patch)
                places.append(place)
                pooled.append(np.take_along_axis(response, place[:, None, :], 1)[:, 0])
            hidden = np.concatenate(pooled, axis=1)
            active = np.maximum(hidden, 0)
            z = active @ params[-2] + params[-1]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            z[np.arange(len(take)), goal] -= 1
            z /= len(take)
            grads = [np.zeros_like(p) for p in params]
            grads[-2], grads[-1] = active.T @ z, z.sum(axis=0)
            back = (z @ params[-2].T) * (hidden > 0)
            rows = np.arange(len(take))[:, None]
            for k, width in enumerate(WIDTHS):
                g = back[:, k * FILTERS:(k + 1) * FILTERS]
                chosen = patches[k][rows, places[k]]                    # (batch, filters, width * embed)
                grads[1 + k] = np.einsum("bf,bfe->ef", g, chosen)
                grads[1 + n + k] = g.sum(axis=0)
                to_patch = (g[:, :, None] * params[1 + k].T[None]).reshape(-1, EMBED)
                where = raw[rows[:, :, None], places[k][:, :, None] + np.arange(width)].reshape(-1)
                np.add.at(grads[0], where, to_patch)
            step += 1
            rate = RATE * (1 - 0.999 ** step) ** 0.5 / (1 - 0.9 ** step)
            for p, g, a, b in zip(params, grads, first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * a / (np.sqrt(b) + 1e-8)
    return Network(languages, params[0], params[1:1 + n], params[1 + n:1 + 2 * n], params[-2], params[-1])


# --- on tables ---------------------------------------------------------------------------------


def train(documents: DataFrame, folds: int = 5, held_out: int = 0, sample_docs: int = SAMPLE_DOCS) -> Network:
    """Fit on texts with a language whose id is outside the held-out fold."""
    rows = documents.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL") \
        .filter(id_remainder(F.col("doc_id"), folds) != held_out)
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return fit(np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), [])
    quota = max(1, sample_docs // len(languages))
    scale = 1 << 30
    share = F.create_map(*[v for k in languages for v in (F.lit(k), F.lit(min(scale, int(scale * quota / counts[k]))))])
    sample = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(scale)) < share[F.col("lang")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, langs, cut = [], [], []
            for i, text, lang in zip(batch.column(0), batch.column(1), batch.column(2)):
                text = text.as_py()
                if not has_letter(text):
                    continue
                all_windows = windows(text.lower().encode())
                for k in sorted({int(x) for x in np.linspace(0, len(all_windows) - 1, DOC_WINDOWS)}):
                    ids.append(i.as_py())
                    langs.append(lang.as_py())
                    cut.append(all_windows[k].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(cut, pa.binary())],
                                             names=["doc_id", "lang", "bytes"])

    cut = small_batches(sample.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")).mapInArrow(
        run, "doc_id bigint, lang string, bytes binary")
    # The hash picks by id, so an id with very many rows is picked whole: what the driver gets is bounded here.
    got = cut.orderBy(F.xxhash64("doc_id", "bytes"), "doc_id", "lang", "bytes").limit(2 * sample_docs * DOC_WINDOWS).collect()
    got.sort(key=lambda r: (r.doc_id, r.lang, bytes(r.bytes)))
    data = np.frombuffer(b"".join(bytes(r.bytes) for r in got), np.uint8).reshape(-1, WINDOW)
    return fit(data, np.array([languages.index(r.lang) for r in got], np.int64), languages)


def predictions(documents: DataFrame, net: Network) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row."""
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for batch in batches:
            found = [scorer.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return small_batches(documents.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
