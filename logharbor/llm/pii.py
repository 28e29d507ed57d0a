"""Personal data: overlapping candidates judged by gradient boosted trees.

Base spans follow fixed rules per kind (email, ip, card, phone) and always stay. High-recall
generators propose further spans, overlapping as they may: every run of neighbouring digit groups,
phone numbers without a plus sign, dotted quads inside longer runs, spelled-out addresses. Each
candidate is described by its format (digits, groups, check digits, neighbours) and its context
(words before it), boosted regression trees give a probability, an isotonic map calibrates it on
held-out candidates, and the candidates above their kind's threshold are taken, best first, where
they overlap nothing taken before.

The trees learn from the rules: base spans are positive; candidates that fail their kind's check,
or cut a base span short or run beyond it, are negative. Candidates inside text that a rule matched
but dropped (say a phone number and a card number with one space between) have no label; those
are what the trees decide on.

Spans are code points, ends exclusive. A null text counts as empty: no spans. Texts of any length
are scanned whole, in linear time. Training takes about ``SAMPLE_CANDIDATES`` candidates, chosen by
a hash of the text. Without any positive example nothing is added.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

KINDS = ("email", "ip", "card", "phone")
SAMPLE_CANDIDATES = 20_000      # labelled candidates the trees are fitted on, about
SAMPLE_DOCS = 20_000            # documents they are looked for in, about
ROUNDS, DEPTH, RATE, CUTS, LEAF = 30, 3, 0.3, 16, 8
PRECISION = 0.99                # wanted among held-out candidates above a kind's threshold,
LEAST = 0.8                     # which is never below this probability
CONTEXT = 32                    # characters before a span in which key words count
OWN_NUMBER = 13         # digits from which a group is taken for a number of its own

# The rules of the base spans.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Generators beyond the rules.
DIGITS = re.compile(r"[0-9]+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3,}")
LOCAL_PHONE = re.compile(r"(?<![0-9+])(?:\(?[0-9]{2,5}\)?[ .-]?)(?:[0-9]{2,4}[ .-]){1,3}[0-9]{2,5}(?![0-9])")
SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]|@| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]| dot |\.) ?[A-Za-z0-9-]{2,63}){1,4}")
WORDS = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "addr"),
    "card": ("card", "visa", "credit", "master", "pay"), "phone": ("phone", "tel", "call", "fon", "mobil", "fax", "cell"),
}
FEATURES = 24


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def valid(kind: str, text: str) -> bool:
    """The check behind a rule's pattern."""
    if kind == "email":
        return True
    if kind == "ip":
        parts = [p.lstrip("0") for p in text.split(".")]
        return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)
    digits = only_digits(text)
    return 16 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 8 <= len(digits) <= 15


def matches(kind: str, text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of a rule's pattern, before its check."""
    if kind != "email":
        pattern, needs = {"ip": (IP, "."), "card": (CARD, ""), "phone": (PHONE, "+")}[kind]
        return [m.span() for m in pattern.finditer(text)] if needs in text else []
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and the matches that failed their check; by kind, then start."""
    good, dropped = [], []
    for kind in KINDS:
        for a, b in matches(kind, text):
            (good if valid(kind, text[a:b]) else dropped).append((kind, a, b))
    return good, dropped


# --- candidates --------------------------------------------------------------------------------


def candidates(text: str) -> set[tuple[str, int, int]]:
    """Spans worth judging, overlapping; far more than are personal data."""
    out: set[tuple[str, int, int]] = set()
    for m in CARD.finditer(text):
        groups = [(m.start() + g.start(), m.start() + g.end()) for g in DIGITS.finditer(m.group())]
        for i in range(len(groups)):
            size = 0
            for j in range(i, len(groups)):
                size += groups[j][1] - groups[j][0]
                if size > 19:
                    break
                if size >= 13:
                    out.add(("card", groups[i][0], groups[j][1]))
    if "+" in text:
        for m in PHONE.finditer(text):
            size = 0
            for g in DIGITS.finditer(m.group()):
                size += g.end() - g.start()
                if size > 17:
                    break
                if size >= 7:
                    out.add(("phone", m.start(), m.start() + g.end()))
    if "." in text:
        for m in DOTTED.finditer(text):
            parts = [(m.start() + g.start(), m.start() + g.end()) for g in DIGITS.finditer(m.group())]
            out |= {("ip", parts[i][0], parts[i + 3][1]) for i in range(len(parts) - 3)}
    out |= {("phone", *m.span()) for m in LOCAL_PHONE.finditer(text)}
    if "@" in text or "at" in text and "dot" in text:
        out |= {("email", *m.span()) for m in SPELLED.finditer(text) if "@" in m.group() or "dot" in m.group()}
    return out


def neighbour(digits: str) -> float:
    """Length of the digit group next to a span; one that is a number by itself does not count."""
    return float(len(digits)) if len(digits) < OWN_NUMBER else 0.0


def describe(kind: str, a: int, b: int, text: str) -> list[float]:
    """Format and context of a candidate as numbers."""
    span = text[a:b]
    groups = [len(g) for g in DIGITS.findall(span)]
    before, after = text[a - 1:a], text[b:b + 1]
    context = text[max(0, a - CONTEXT):a].lower()
    follows = DIGITS.match(text, b + 1) if after and after in " .-" else DIGITS.match(text, b)
    precedes = re.search(r"([0-9]+)[ .-]?\Z", text[max(0, a - 24):a])
    digits = only_digits(span)
    tail = span.rpartition(".")[2]
    return [
        *(float(kind == k) for k in KINDS), float(len(digits)), float(len(groups)), float(groups[0] if groups else 0),
        float(groups[-1] if groups else 0), float(max(groups, default=0)), float(valid(kind, span)), float(span[:1] == "+"),
        float(span.count("(") + span.count(")")), float(min(b - a, 99)), float(before.isalnum()), float(after.isalnum()),
        neighbour(follows.group() if follows else ""), neighbour(precedes.group(1) if precedes else ""),
        float(any(w in context for w in WORDS[kind])), sum(map(str.isalpha, span)) / (b - a),
        float(digits[:1] in ("3", "4", "5", "6")), float(min(len(tail), 99)), float(tail.isalpha()), float(" " in span), float("@" in span),
    ]


class Intervals:
    """Disjoint spans, kept in order, that can be asked for an overlap."""

    def __init__(self, spans: list[tuple[int, int]] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(b, self.ends[-1])
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        k = bisect_left(self.starts, b)
        return k > 0 and self.ends[k - 1] > a

    def holds(self, a: int, b: int) -> bool:
        k = bisect_right(self.starts, a)
        return k > 0 and self.ends[k - 1] >= b

    def add(self, a: int, b: int) -> None:
        k = bisect_left(self.starts, a)
        self.starts.insert(k, a)
        self.ends.insert(k, b)


def labelled(text: str) -> list[tuple[list[float], int]]:
    """Candidates of a text whose label follows from the rules."""
    good, dropped = base_spans(text)
    kept = {kind: Intervals([s[1:] for s in good if s[0] == kind]) for kind in KINDS}
    lost = {kind: Intervals([s[1:] for s in dropped if s[0] == kind]) for kind in KINDS}
    out = [(describe(*s, text), 1) for s in good]
    for kind, a, b in candidates(text) - set(good):
        failed = not valid(kind, text[a:b])
        if failed or kept[kind].meets(a, b) and not lost[kind].holds(a, b):
            out.append((describe(kind, a, b, text), 0))
    return out


# --- boosted trees -----------------------------------------------------------------------------


@dataclass
class Trees:
    """Each tree: feature, cut and value of its nodes, stored as a full binary tree."""
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    bias: float = 0.0
    knots: list[float] = field(default_factory=lambda: [0.0])
    levels: list[float] = field(default_factory=lambda: [0.0])
    thresholds: dict[str, float] = field(default_factory=dict)

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            z += value[node]
        return z

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability."""
        z = self.raw(x)
        return np.array([self.levels[max(0, bisect_right(self.knots, v) - 1)] for v in z])


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Gradient boosting of the logistic loss with Newton leaf values."""
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(bias=float(np.log(rate / (1 - rate))))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 1)[:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    z = np.full(len(x), model.bias)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        feature, cut = np.zeros(2 ** DEPTH - 1, np.int64), np.full(2 ** DEPTH - 1, np.inf)
        node = np.zeros(len(x), np.int64)
        for inner in range(2 ** DEPTH - 1):
            here = node == inner
            best = 1e-6
            if here.sum() >= 2 * LEAF:
                gs, hs, bs = g[here], h[here], bins[here]
                whole = gs.sum() ** 2 / (hs.sum() + 1)
                for f, c in enumerate(cuts):
                    left_g = np.cumsum(np.bincount(bs[:, f], gs, len(c) + 1))[:-1]
                    left_h = np.cumsum(np.bincount(bs[:, f], hs, len(c) + 1))[:-1]
                    left_n = np.cumsum(np.bincount(bs[:, f], minlength=len(c) + 1))[:-1]
                    gain = left_g ** 2 / (left_h + 1) + (gs.sum() - left_g) ** 2 / (hs.sum() - left_h + 1) - whole
                    gain[(left_n < LEAF) | (len(gs) - left_n < LEAF)] = -1
                    if len(gain) and gain.max() > best:
                        best, at = float(gain.max()), int(gain.argmax())
                        feature[inner], cut[inner] = f, c[at]
            node[here] = 2 * inner + 1 + (x[here, feature[inner]] > cut[inner])
        value = np.zeros(2 ** (DEPTH + 1) - 1)
        sums, weights = np.bincount(node, g, len(value)), np.bincount(node, h, len(value))
        value = RATE * sums / (weights + 1)
        model.trees.append((np.concatenate([feature, np.zeros(2 ** DEPTH, np.int64)]), np.concatenate([cut, np.full(2 ** DEPTH, np.inf)]), value))
        z += value[node]
    return model


def calibrate(model: Trees, x: np.ndarray, y: np.ndarray, kinds: np.ndarray) -> None:
    """Isotonic probabilities by pooling adjacent violators, then a threshold per kind."""
    z = model.raw(x)
    order = np.argsort(z, kind="stable")
    pools: list[list[float]] = []           # [first score, sum, count]
    for s, label in zip(z[order].tolist(), y[order].tolist()):
        pools.append([s, label, 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            s0, total, count = pools.pop()
            pools[-1][1] += total
            pools[-1][2] += count
    model.knots = [p[0] for p in pools]
    model.levels = [(p[1] + 0.1) / (p[2] + 0.2) for p in pools]
    p = model.probability(x)
    for k, kind in enumerate(KINDS):
        mine = kinds == k
        best = None
        for cut in sorted(set(p[mine].tolist()), reverse=True):
            taken = mine & (p >= cut)
            if y[taken].mean() < PRECISION:
                break
            best = cut
        if best is not None:
            model.thresholds[kind] = max(best, LEAST)


def fit(rows: list[tuple[list[float], int, int]]) -> Trees:
    """``rows`` of (features, label, fold); a quarter of the folds calibrates."""
    if not any(r[1] for r in rows) or all(r[1] for r in rows):
        return Trees()
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    hold = np.array([r[2] % 4 == 0 for r in rows])
    if not hold.any() or hold.all() or not y[~hold].any():
        hold = np.arange(len(rows)) % 4 == 0
    model = boost(x[~hold], y[~hold])
    calibrate(model, x[hold], y[hold], x[hold][:, :4].argmax(axis=1))
    return model


def all_spans(text: str, model: Trees) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and base with added spans; each by kind, then start."""
    base, _ = base_spans(text)
    open_ones = [c for c in candidates(text) - set(base) if c[0] in model.thresholds]
    fixed = Intervals([s[1:] for s in base])
    open_ones = [c for c in open_ones if not fixed.meets(*c[1:])]
    if not open_ones:
        return base, base
    open_ones.sort(key=lambda c: (c[1], c[2], c[0]))
    p = model.probability(np.array([describe(*c, text) for c in open_ones]))
    ranked = sorted(zip(-p, [c[1] - c[2] for c in open_ones], open_ones))
    taken: list[tuple[str, int, int]] = []
    busy = Intervals()
    for minus, _, (kind, a, b) in ranked:
        if -minus >= model.thresholds[kind] and not busy.meets(a, b):
            busy.add(a, b)
            taken.append((kind, a, b))
    return base, sorted([*base, *taken], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span, or run of overlapping spans, replaced by the kind of its first."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


# --- on tables ---------------------------------------------------------------------------------


def train(documents: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_candidates: int = SAMPLE_CANDIDATES) -> Trees:
    """Fit on the candidates of a sample of the texts, chosen by a hash of the text."""
    scale = 1 << 30
    total = max(1, documents.count())
    limit = min(scale, scale * sample_docs // total)
    sample = documents.select("text").filter(F.pmod(F.xxhash64("text", F.lit(5)), F.lit(scale)) < limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0):
                text = text.as_py() or ""
                fold = int.from_bytes(hashlib.sha256(text.encode()).digest()[:4], "big") & 0x3FFFFFFF
                rows += [(f, y, fold) for f, y in labelled(text)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.list_(pa.float64())), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.int32())], names=["x", "y", "fold"])

    found = small_batches(sample).mapInArrow(run, "x array<double>, y int, fold int")
    got = found.orderBy(F.xxhash64("x", "fold"), "fold", "y").limit(sample_candidates).collect()
    rows = sorted((list(r.x), r.y, r.fold) for r in got)
    return fit(rows)


def with_spans(df: DataFrame, model: Trees) -> DataFrame:
    """``df`` with ``base`` and ``spans``, arrays of (kind, from, to); columns of these names are replaced."""
    df = df.drop("base", "spans")
    names = df.columns
    kind = pa.list_(pa.struct([("kind", pa.string()), ("from", pa.int32()), ("to", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(t or "", model) for t in batch.column(names.index("text")).to_pylist()]
            arrays = [pa.array([[{"kind": k, "from": a, "to": b} for k, a, b in f[i]] for f in found], kind) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*names, "base", "spans"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    span = "array<struct<kind string, `from` int, `to` int>>"
    return small_batches(df).mapInArrow(run, f"{fields}, base {span}, spans {span}")


def redacted(df: DataFrame, model: Trees) -> DataFrame:
    """``df`` with personal data in ``text`` replaced, and ``n_chars`` counted anew where it exists. Null texts stay null."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(names.index("text")).to_pylist()
            clean = [None if t is None else redact(t, all_spans(t, model)[1]) for t in texts]
            arrays = list(batch.columns)
            arrays[names.index("text")] = pa.array(clean, pa.string())
            if "n_chars" in names:
                k = names.index("n_chars")
                sizes = [old if c == t else len(c) for c, t, old in zip(clean, texts, arrays[k].to_pylist())]
                arrays[k] = pa.array(sizes, arrays[k].type)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return small_batches(df).mapInArrow(run, df.schema)
