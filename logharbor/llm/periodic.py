"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a longest stretch of words in which words ``q`` apart are equal, with ``q`` its smallest
period, at least ``MIN_LENGTH`` words and ``MIN_PERIODS`` periods long.

Method. At scale ``B`` the words are cut into blocks of ``B``. The sum of squared differences of a
block and the stretch ``d`` words later is zero exactly if both are equal; for all ``d`` from ``B``
to ``2 B - 1`` at once these sums come from one product of number-theoretic transforms (integers
modulo a prime, so no rounding decides). A run of period ``q`` in ``[B, 2 B)`` has ``3 q`` words or
more with an equal partner ``q`` words later, so at least ``(3 q - B + 1) // B`` neighbouring
blocks report the distance ``q``: such a distance is a seed. Seeds inside a run of a smaller period
repeat that run and go; the others are compared word by word, which also undoes sums that only
vanish modulo the prime, and extended as far as they hold.

Scale. Nothing is shuffled: a text is one row. Texts of a batch are laid end to end, longest first,
with a word of its own between each two, so short texts leave the larger scales. A text of ``n``
words takes ``O(n log(n)^2)``: a scale has at most ``n`` hits, and seeds are stretches of three
periods or more, of which a text has ``O(n / B)``. Transforms have at most ``2 * LARGEST`` numbers;
longer distances use blocks of ``LARGEST`` words against several windows.

Cases. A null or empty text, or one of white space alone, has no words and no runs. Repeated rows,
null ids and further columns pass through; a column that clashes with one of the result
(``runs``, ``kept``) is an error. An empty table gives an empty one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches

MIN_LENGTH = 6
MIN_PERIODS = 4
PRIME, ROOT = 7_340_033, 3          # 7 * 2**20 + 1 and a generator of its units
DENSE = 64                          # transforms up to this size are one matrix product, exact in doubles
LARGEST = 1 << 17                   # words of a block that is transformed
SLICE = 1 << 19                     # numbers of transforms held at once
RUNS_DDL = "array<struct<start:bigint,length:bigint,period:bigint>>"


# --- transforms ---------------------------------------------------------------------------------


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo the prime, in place: from 0 to the prime, both included."""
    quotient = x * (1.0 / PRIME)
    np.floor(quotient, out=quotient)
    quotient *= PRIME
    x -= quotient
    return x


@lru_cache
def _powers(size: int, inverse: bool) -> np.ndarray:
    """Powers of a root of unity of order ``size``."""
    root = pow(ROOT, (PRIME - 1) // size, PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    out = np.ones(size, np.int64)
    filled = 1
    while filled < size:
        out[filled:2 * filled] = out[:filled] * pow(root, filled, PRIME) % PRIME
        filled *= 2
    return out


@lru_cache
def _matrix(size: int, inverse: bool) -> np.ndarray:
    k = np.arange(size)
    return _powers(size, inverse)[np.outer(k, k) % size].astype(np.float64)


def _split(size: int) -> tuple[int, int]:
    first = min(DENSE, 1 << ((size.bit_length() - 1) // 2))
    return first, size // first


@lru_cache
def _twiddles(size: int, inverse: bool) -> np.ndarray:
    first, second = _split(size)
    return _powers(size, inverse)[np.outer(np.arange(first), np.arange(second)) % size].astype(np.float64)


@lru_cache
def _order(size: int) -> np.ndarray:
    """Which frequency stands where after :func:`_forward`."""
    if size <= DENSE:
        return np.arange(size)
    first, second = _split(size)
    return (np.arange(first)[:, None] + first * _order(second)[None, :]).ravel()


@lru_cache
def _mirror(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the opposite frequencies, and the sign that a shift by half the size has."""
    order = _order(size)
    place = np.empty(size, np.int64)
    place[order] = np.arange(size)
    return place[-order % size], np.where(order % 2, -1.0, 1.0)


def _forward(x: np.ndarray) -> np.ndarray:
    size = x.shape[-1]
    if size <= DENSE:
        return _reduced(x @ _matrix(size, False))
    first, second = _split(size)
    y = _reduced(np.matmul(_matrix(first, False), x.reshape(-1, first, second)))
    y *= _twiddles(size, False)
    return _forward(_reduced(y)).reshape(x.shape)


def _backward(x: np.ndarray, rows: int | None = None) -> np.ndarray:
    """The inverse of :func:`_forward` times the size; ``rows`` asks for the first half alone."""
    size = x.shape[-1]
    if size <= DENSE:
        return _reduced(x @ _matrix(size, True)[:, :rows])
    first, second = _split(size)
    y = _backward(x.reshape(-1, first, second)) * _twiddles(size, True)
    part = _matrix(first, True)[:first if rows is None else rows // second]
    return _reduced(np.matmul(part, _reduced(y))).reshape(*x.shape[:-1], -1)


# --- one scale ----------------------------------------------------------------------------------


def block_hits(x: np.ndarray, squares: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks ``k`` and distances ``d`` in ``[scale, 2 * scale)`` whose squared differences sum up to zero.

    ``x`` holds numbers below the prime, ``squares`` the sums of their squares up to each place.
    """
    block = min(scale, LARGEST)
    size, ratio = 2 * block, scale // block
    blocks = -(-len(x) // scale)
    padded = np.zeros((blocks + 2) * scale + block)
    padded[:len(x)] = x
    ends = np.concatenate([squares, np.full(len(padded) + 1 - len(squares), squares[-1])])
    mirror, sign = _mirror(size)
    unit = float(pow(size, PRIME - 2, PRIME) * 2 % PRIME)
    at_once = max(1, SLICE // (size * ratio))
    found_k, found_d = [], []
    for lo in range(0, blocks, at_once):
        hi = min(blocks, lo + at_once)
        piece = padded[lo * scale:(hi + 2) * scale + block].reshape(-1, block)
        spectra = np.zeros((len(piece), size))
        spectra[:, :block] = piece
        spectra = _forward(spectra)
        k = np.arange(hi - lo)
        pattern = spectra[k * ratio][:, mirror]
        start = (np.arange(lo, hi) * scale)[:, None]
        own = ends[start + block] - ends[start]
        for c in range(ratio):
            window = spectra[(k + 1) * ratio + c] + sign * spectra[(k + 1) * ratio + c + 1]
            common = _backward(_reduced(_reduced(window) * pattern), block)
            shift = scale + c * block + np.arange(block)
            theirs = ends[start + shift + block] - ends[start + shift]
            rest = _reduced(own + theirs - _reduced(common * unit))
            rows, columns = np.nonzero((rest == 0) | (rest == PRIME))
            found_k.append(rows + lo)
            found_d.append(shift[columns])
    return np.concatenate(found_k), np.concatenate(found_d)


def _seeds(k: np.ndarray, d: np.ndarray, scale: int) -> Iterator[tuple[int, int, int]]:
    """First and last block and distance of each row of neighbouring hits that a run can give."""
    order = np.lexsort((k, d))
    k, d = k[order], d[order]
    cuts = np.flatnonzero((d[1:] != d[:-1]) | (k[1:] != k[:-1] + 1)) + 1
    first, last = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(k)]]) - 1
    enough = last - first + 1 >= (3 * d[first] - scale + 1) // scale
    yield from zip(k[first[enough]].tolist(), k[last[enough]].tolist(), d[first[enough]].tolist())


def _stretches(codes: np.ndarray, lo: int, hi: int, d: int) -> Iterator[tuple[int, int]]:
    """Longest stretches of places that touch ``[lo, hi)`` and equal the places ``d`` later."""
    limit, reach = len(codes) - d, 2 * d
    lo, hi = max(0, lo), min(hi, limit)
    if lo >= hi:
        return
    same = codes[lo:hi] == codes[lo + d:hi + d]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]])))
    for a, b in zip((edges[::2] + lo).tolist(), (edges[1::2] + lo).tolist()):
        while a == lo and a > 0:
            part = codes[max(0, a - reach):a] == codes[max(0, a - reach) + d:a + d]
            missed = np.flatnonzero(~part)
            a = a - len(part) + int(missed[-1]) + 1 if len(missed) else a - len(part)
            if len(missed):
                break
            lo = a
        while b == hi and b < limit:
            part = codes[b:min(limit, b + reach)] == codes[b + d:min(limit, b + reach) + d]
            missed = np.flatnonzero(~part)
            b = b + int(missed[0]) if len(missed) else b + len(part)
            if len(missed):
                break
            hi = b
        yield a, b


def find_runs(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``start, end, period`` of all runs in ``codes``, texts of ``sizes`` words, longest first.

    Between each two texts, and after the last, stands one code that occurs nowhere else.
    """
    runs: dict[tuple[int, int], int] = {}
    x = (codes % PRIME).astype(np.float64)
    squares = np.concatenate([[0], np.cumsum((codes % PRIME) ** 2 % PRIME)]).astype(np.float64)
    ends = np.cumsum(sizes + 1)
    scale = 1
    while True:
        part = int(np.searchsorted(-sizes, -MIN_PERIODS * scale, "right"))      # texts long enough for a period of this scale
        if not part:
            break
        n = int(ends[part - 1])
        k, d = block_hits(x[:n], squares[:n + 1], scale)
        known = np.array(sorted((a, b) for a, b in runs), np.int64).reshape(-1, 2)
        reach = np.maximum.accumulate(known[:, 1]) if len(known) else known[:, 1]
        for first, last, distance in _seeds(k, d, scale) if len(k) else ():
            a, b = first * scale, last * scale + scale
            before = int(np.searchsorted(known[:, 0], a, "right"))
            if before and reach[before - 1] >= b + distance:
                continue
            for lo, hi in _stretches(codes[:n], a, b, distance):
                if hi - lo >= max((MIN_PERIODS - 1) * distance, MIN_LENGTH - distance):
                    place = lo, hi + distance
                    runs[place] = min(distance, runs.get(place, distance))
        scale *= 2
    ordered = sorted((a, q, b) for (a, b), q in runs.items())
    return np.array(ordered, np.int64).reshape(-1, 3)[:, [0, 2, 1]]


# --- texts --------------------------------------------------------------------------------------


def runs_of_texts(texts: list[str | None]) -> list[tuple[list[tuple[int, int, int]], bytes]]:
    """Of each text its runs ``(start, length, period)`` by start and period, and its words without repeats.

    A word goes if a run has it after the run's first period; the others are joined by a space.
    """
    words = [(t or "").encode().split() for t in texts]
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    code = defaultdict(count(len(words)).__next__)
    parts = []
    for place, i in enumerate(order):
        parts.append(np.fromiter(map(code.__getitem__, words[i]), np.int64, len(words[i])))
        parts.append(np.array([place], np.int64))
    sizes = np.array([len(words[i]) for i in order], np.int64)
    found = find_runs(np.concatenate(parts), sizes) if len(words) else np.empty((0, 3), np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    owner = np.searchsorted(starts, found[:, 0], "right") - 1
    bounds = np.searchsorted(owner, np.arange(len(order) + 1))
    out: list = [None] * len(words)
    for place, i in enumerate(order):
        own = found[bounds[place]:bounds[place + 1]] - [starts[place], starts[place], 0] if bounds[place] < bounds[place + 1] else ()
        kept = words[i]
        if len(own):
            keep = np.ones(len(kept), bool)
            for a, b, q in own.tolist():
                keep[a + q:b] = False
            kept = compress(kept, keep.tolist())
        out[i] = [(a, b - a, q) for a, b, q in (own.tolist() if len(own) else ())], b" ".join(kept)
    return out


def with_runs(df: DataFrame) -> DataFrame:
    """``df`` with ``runs`` of its ``text`` (array of start, length, period) and ``kept``, the words without repeats."""
    clash = {"runs", "kept"} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are those of the result")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            found = runs_of_texts(batch.column("text").to_pylist())
            runs = pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own, _ in found], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, runs, pa.array([k.decode() for _, k in found], pa.string())],
                                             names=[*batch.schema.names, "runs", "kept"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return small_batches(df).mapInArrow(run, f"{fields}, runs {RUNS_DDL}, kept string")
