"""Byte-level BPE by a segment tree over the ranks of adjacent pairs.

A piece of text (as cut by the pre-tokenizer) starts as one symbol per byte. Leaf ``i`` of the
tree holds the rank of the pair that starts at symbol ``i``; an inner node holds the smaller of
its children together with its place, so the root names the leftmost pair of lowest rank. A merge
changes three leaves, each in logarithmic time, until no pair is mergeable. Long pieces therefore
cost ``n log n``. Pieces of bounded width are merged many at a time; there all nodes of all trees
are made anew after a merge, level by level.

Nothing is done in Python per word of the text: Arrow cuts texts into words and numbers the
different ones, each of these is encoded once per group of texts if it is not remembered, and ids,
their digits and the bytes they stand for are gathered by number.

Nulls encode like the empty text: no ids, decoded to the empty text. Repeated rows each get their
row; extra columns are ignored, except that the caller's columns may be carried.
"""

from __future__ import annotations

import gc
import hashlib
import json
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import small_batches, worker_state

#: The pre-tokenizer's pattern of the public byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_PIECES = 60_000       # distinct words a worker remembers, those seen most
CACHE_CHARS = 48            # words of more bytes are not remembered
GROUP_BYTES = 2 << 20       # Arrow batches are encoded together up to so many bytes of text
WIDEST = 256                # pieces of up to so many bytes are merged many at a time,
STEP_CELLS = 1 << 17        # so many bytes of them at once; rows that are gathered at once
PAIR_BITS = 24              # ids are below 2**24
HASH_FACTOR = np.uint64(0x9E3779B97F4A7C15)
EMPTY = -2                  # a free place in the table of pairs
#: All white space there is.
WHITE = [c for c in map(chr, range(1 << 16)) if c.isspace()]


def byte_symbols() -> list[str]:
    """The printable character by which the vocabulary file writes each byte.

    Printable Latin-1 characters stand for themselves, the other bytes for the code points from
    256 on, in order.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in own}
    rest = (b for b in range(256) if b not in table)
    table |= {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


class Ragged:
    """Rows of differing lengths in one array; they may lie in any order."""

    def __init__(self, values: np.ndarray, lengths: np.ndarray, starts: np.ndarray | None = None):
        self.values, self.lengths = values, lengths
        self.starts = lengths.cumsum() - lengths if starts is None else starts

    @classmethod
    def of_strings(cls, strings: pa.LargeStringArray) -> Ragged:
        """UTF-8 bytes of each string."""
        offsets, data = strings.buffers()[1:]
        ends = np.frombuffer(offsets, np.int64)[strings.offset:strings.offset + len(strings) + 1] if len(strings) else np.zeros(1, np.int64)
        return cls(np.frombuffer(data or b"", np.uint8), np.diff(ends), ends[:-1])

    @property
    def ends(self) -> np.ndarray:
        return self.starts + self.lengths

    def spans(self) -> list[tuple[int, int]]:
        return list(zip(self.starts.tolist(), self.ends.tolist()))

    def take(self, rows: np.ndarray | slice = slice(None)) -> Ragged:
        """The rows named, one after another."""
        lengths, starts = self.lengths[rows], self.starts[rows]
        ends = lengths.cumsum()
        values = np.empty(ends[-1] if len(ends) else 0, self.values.dtype)
        for k in range(0, len(ends), STEP_CELLS):
            some = slice(k, k + STEP_CELLS)
            a, b = ends[k] - lengths[k], ends[some][-1]
            at = np.repeat(starts[some] + lengths[some] - ends[some], lengths[some])
            at += np.arange(a, b)
            values[a:b] = self.values[at]
        return Ragged(values, lengths, ends - lengths)

    def followed_by(self, other: Ragged) -> Ragged:
        """These rows and the others."""
        return Ragged(np.concatenate([self.values, other.values]), np.append(self.lengths, other.lengths), np.append(self.starts, other.starts + len(self.values)))

    def gathered(self, counts: np.ndarray) -> Ragged:
        """So many rows each as one; they have to lie in order."""
        ends = np.append(0, self.lengths.cumsum())[np.append(0, counts.cumsum())]
        return Ragged(self.values, np.diff(ends), ends[:-1])


def spaced(words: pa.LargeStringArray, ends: np.ndarray | list[int]) -> pa.LargeStringArray:
    """Runs of words, with a space between two."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words), pa.scalar(" ", pa.large_string()))


def starts_white(words: pa.LargeStringArray) -> np.ndarray:
    """Which strings are empty or start with white space."""
    found = Ragged.of_strings(words)
    white = found.lengths == 0
    some = np.flatnonzero(~white)
    lead = np.zeros(256, bool)
    lead[[c.encode()[0] for c in WHITE]] = True
    some = some[lead[found.values[found.starts[some]]]]
    white[some] = [w[0].isspace() for w in words.take(pa.array(some)).to_pylist()]
    return white


class Vocabulary:
    """Merges, ids and added tokens of a tokenizer file."""

    def __init__(self, text: str):
        data = json.loads(text)
        to_byte = {c: b for b, c in enumerate(byte_symbols())}
        ids = data["model"]["vocab"]
        self.byte_ids = [ids[c] for c in byte_symbols()]
        self.bytes_of = [b""] * (1 + max([*ids.values(), *(t["id"] for t in data["added_tokens"])]))
        for token, i in ids.items():
            self.bytes_of[i] = bytes(to_byte[c] for c in token)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])
        added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.added = added
        longest_first = sorted(added, key=len, reverse=True)
        self.added_pattern = regex.compile("|".join(map(regex.escape, longest_first))) if added else None
        self.added_codes = "|".join("".join(f"\\x{{{ord(c):x}}}" for c in t) for t in longest_first)    # for Arrow's own expressions
        for token, i in added.items():
            self.bytes_of[i] = token.encode()
        self.pieces = regex.compile(PATTERN)
        self.byte_array = np.array(self.byte_ids, np.int32)
        keys = np.array([(a << PAIR_BITS) | b for a, b in self.merges], np.int64)
        made = np.array(list(self.merges.values()), np.int64).reshape(-1, 2)
        self.id_of_rank = np.zeros(len(data["model"]["merges"]) + 1, np.int32)
        self.id_of_rank[made[:, 0]] = made[:, 1]
        self._hash(keys, made[:, 0])
        ends = np.repeat(self.byte_array[None], 256, axis=0)
        self.byte_ranks = self._ranks(ends.T.ravel(), ends.ravel())      # by first byte * 256 + second
        #: What a tree's node holds is below this.
        self.none = np.int64(1 << 62) if len(self.id_of_rank) * WIDEST >= 1 << 31 else np.int32((1 << 31) - 1)
        self.token_bytes = pa.array(self.bytes_of, pa.large_binary())
        self.token_digits = pa.array([b"%d," % i for i in range(len(self.bytes_of))], pa.large_binary())
        #: Remembered words, their ids after a space, and how often they were seen.
        self.words = pa.array([], pa.large_string())
        self.known, self.seen = Ragged(np.empty(0, np.int32), np.empty(0, np.int64)), np.empty(0, np.float32)

    def _hash(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """A table of pairs with free places by the next one, mostly empty."""
        bits = max(4, (8 * len(keys)).bit_length())
        self.slot_shift, self.slot_mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot_keys = np.full(1 << bits, EMPTY, np.int64)
        self.slot_ranks = np.full(1 << bits, -1, np.int64)
        at = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.slot_keys[at] == EMPTY)
            free = free[np.unique(at[free], return_index=True)[1]]
            self.slot_keys[at[free]], self.slot_ranks[at[free]] = keys[free], ranks[free]
            left = np.ones(len(keys), bool)
            left[free] = False
            keys, ranks, at = keys[left], ranks[left], (at[left] + 1) & self.slot_mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * HASH_FACTOR) >> self.slot_shift).view(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 for none; symbols of -1 pair with nothing."""
        keys = (left.astype(np.int64) << PAIR_BITS) | right
        at = self._slots(keys)
        held = self.slot_keys[at]
        ranks = np.where(held == keys, self.slot_ranks[at], -1)
        missed = np.flatnonzero((held != keys) & (held != EMPTY))
        keys, at = keys[missed], at[missed]
        while len(missed):
            at = (at + 1) & self.slot_mask
            held = self.slot_keys[at]
            ranks[missed] = np.where(held == keys, self.slot_ranks[at], -1)
            more = np.flatnonzero((held != keys) & (held != EMPTY))
            missed, keys, at = missed[more], keys[more], at[more]
        return ranks

    def encode(self, text: str) -> list[int]:
        return self.ids_of(pa.array([text], pa.large_string())).values.tolist()

    def pieces_of(self, texts: list[str]) -> list[list[tuple[tuple[int, ...], str]]]:
        """Per text its parts in order, each as (ids, ids joined by commas); one part a text."""
        ids = self.ids_of(pa.array(texts, pa.large_string()))
        found = [tuple(ids.values[a:b].tolist()) for a, b in ids.spans()]
        return [[(f, ",".join(map(str, f)))] for f in found]

    def ids_of(self, texts: pa.LargeStringArray) -> Ragged:
        """Ids of each text."""
        if not self.added or not pc.any(pc.match_substring_regex(texts, self.added_codes)).as_py():
            return self._ids_between(texts)
        # Added tokens end the text before them.
        parts, token, first = [], [], []
        for text in texts.to_pylist():
            at = 0
            first.append(len(parts))
            for m in self.added_pattern.finditer(text):
                parts.append(text[at:m.start()])
                token.append(self.added[m.group()])
                at = m.end()
            parts.append(text[at:])
            token.append(-1)
        found, token = self._ids_between(pa.array(parts, pa.large_string())), np.array(token, np.int32)
        marked = token >= 0
        values = np.insert(found.values, found.ends[marked], token[marked])
        return Ragged(values, np.add.reduceat(found.lengths + marked, first))

    def _ids_between(self, texts: pa.LargeStringArray) -> Ragged:
        """Ids of texts without added tokens.

        The pattern always starts a piece at a space before a non-space, so texts are cut there,
        and what follows each such space is a word. A word can hold spaces in or before other
        white space. Each different word is encoded once; those remembered are numbered first.
        """
        split = pc.split_pattern(texts, " ")
        starts = split.offsets.to_numpy()[:-1] - split.offsets[0].as_py()
        numbered = pa.concat_arrays([self.words, split.flatten()]).dictionary_encode()
        words, code = numbered.dictionary, numbered.indices.to_numpy()[len(self.words):]
        # What starts with white space belongs to the part before it.
        opens = ~starts_white(words)[code]
        opens[starts] = True
        is_head = np.zeros(len(code), bool)
        is_head[starts] = True
        first = np.flatnonzero(opens)
        length, is_head = np.diff(first, append=len(code)), is_head[first]
        # Each text's first part, which has no space before it, and parts of several words are numbered one by one.
        other = np.flatnonzero(is_head | (length > 1))
        entry = code[first].astype(np.int64)
        single = np.ones(len(entry), bool)
        single[other] = False
        seen = np.bincount(entry[single], minlength=len(words))
        new = np.flatnonzero(seen[len(self.words):]) + len(self.words)
        fresh = words.take(pa.array(new))
        others = Ragged(code, length[other], first[other]).take()
        others = spaced(words.take(pa.array(others.values)), np.append(others.starts, len(others.values)))
        after_space = ~is_head[other]
        made = self.known.followed_by(self._encoded(fresh, others.filter(pa.array(after_space)), others.filter(pa.array(~after_space))))
        place = np.zeros(len(words), np.int64)
        place[:len(self.words)] = np.arange(len(self.words))
        place[new] = len(self.words) + np.arange(len(new))
        entry = place[entry]
        at = len(self.words) + len(new)
        entry[other[after_space]] = np.arange(at, at + after_space.sum())
        entry[other[~after_space]] = np.arange(at + after_space.sum(), len(made.lengths))
        parts = made.take(entry)
        self._remember(words, place, made, seen)
        return parts.gathered(np.diff(np.flatnonzero(is_head), append=len(entry)))

    def _encoded(self, words: pa.LargeStringArray, wide: pa.LargeStringArray, heads: pa.LargeStringArray) -> Ragged:
        """Ids of words after a space, of parts of several words after a space, and of parts as they are."""
        words = pa.concat_arrays([words, wide])
        pieces = self.pieces.findall(" " + spaced(words, [0, len(words)])[0].as_py()) if len(words) else []
        lengths = pc.utf8_length(words).to_numpy() + 1
        ends = np.fromiter(map(len, pieces), np.int64, len(pieces)).cumsum()
        counts = np.diff(np.searchsorted(ends, lengths.cumsum(), side="right"), prepend=0)
        of_heads = [self.pieces.findall(h) for h in heads.to_pylist()]
        counts = np.append(counts, np.fromiter(map(len, of_heads), np.int64, len(heads)))
        found = pa.array(chain(pieces, chain.from_iterable(of_heads)), pa.large_string()).dictionary_encode()
        merged = self._merge(Ragged.of_strings(found.dictionary))
        return merged.take(found.indices.to_numpy()).gathered(counts)

    def _remember(self, words: pa.LargeStringArray, place: np.ndarray, ids: Ragged, seen: np.ndarray) -> None:
        """Keeps the words seen most, of late rather than long ago."""
        seen = seen.astype(np.float32)
        seen[:len(self.words)] += self.seen * np.float32(0.9)
        kept = np.flatnonzero((seen > 0) & (Ragged.of_strings(words).lengths <= CACHE_CHARS))
        if len(kept) > CACHE_PIECES:
            kept = np.sort(kept[np.argpartition(-seen[kept], CACHE_PIECES)[:CACHE_PIECES]])
        self.words, self.known, self.seen = words.take(pa.array(kept)), ids.take(place[kept]), seen[kept]

    def _merge(self, pieces: Ragged) -> Ragged:
        """Ids of pieces, given as bytes."""
        none = np.empty(0, np.int32)
        counts, first, out, size = np.zeros(len(pieces.lengths), np.int64), np.zeros(len(pieces.lengths), np.int64), [none], 0
        width, least = 4, 0
        while width <= WIDEST:
            wide = np.flatnonzero((pieces.lengths > least) & (pieces.lengths <= width))
            for a in range(0, len(wide), STEP_CELLS // width):
                some = wide[a:a + STEP_CELLS // width]
                starts, lengths = pieces.starts[some], pieces.lengths[some]
                place = np.arange(width)[:, None]
                raw = pieces.values[np.minimum(starts + place, len(pieces.values) - 1)]
                ids = self._in_step(raw, lengths)
                counts[some], first[some] = ids.lengths, ids.starts + size
                out.append(ids.values)
                size += len(ids.values)
            width, least = 2 * width, width
        for k in np.flatnonzero(pieces.lengths > WIDEST).tolist():
            a = pieces.starts[k]
            ids = merge_piece(self.byte_array[pieces.values[a:a + pieces.lengths[k]]].tolist(), self.merges)
            counts[k], first[k] = len(ids), size
            out.append(np.array(ids, np.int32))
            size += len(ids)
        return Ragged(np.concatenate(out), counts, first)

    def _merge_short(self, pieces: list[bytes], width: int) -> list[list[int]]:
        """``merge_piece`` for many pieces of up to ``width`` bytes."""
        raw = np.frombuffer(b"".join(p.ljust(width, b" ") for p in pieces), np.uint8).reshape(len(pieces), width)
        ids = self._in_step(raw.T, np.fromiter(map(len, pieces), np.int64, len(pieces)))
        return [ids.values[a:b].tolist() for a, b in ids.spans()]

    def _in_step(self, raw: np.ndarray, lengths: np.ndarray) -> Ragged:
        """Ids of pieces, one a column of ``raw``: one tree a column, all in step.

        A row of the arrays holds one place of all pieces, so a level of all trees is the smaller
        of two runs of rows.
        """
        width, pieces = raw.shape
        bits, none = width.bit_length() - 1, self.none
        place = np.arange(width, dtype=np.int32)[:, None]
        # One row more stands for "no neighbour".
        symbols = np.full((width + 1, pieces), -1, np.int32)
        symbols[:-1] = np.where(place < lengths, self.byte_array[raw], -1)
        tree = np.full((2 * width, pieces), none)
        ranks = self.byte_ranks[(raw[:-1].astype(np.int64) << 8) | raw[1:]]
        tree[width:-1] = np.where((place[1:] < lengths) & (ranks >= 0), (ranks << bits) | place[:-1], none)
        after = np.repeat(np.arange(1, width + 2, dtype=np.int32).clip(max=width)[:, None], pieces, axis=1)
        before = np.repeat(np.arange(-1, width, dtype=np.int32)[:, None], pieces, axis=1)
        done, column = np.empty((width, pieces), np.int32), np.arange(pieces)
        while True:
            k = width // 2
            while k:
                np.minimum(tree[2 * k:4 * k:2], tree[2 * k + 1:4 * k:2], out=tree[k:2 * k])
                k //= 2
            live = np.flatnonzero(tree[1] != none)
            if 4 * len(live) < 3 * len(column):
                done[:, column] = symbols[:-1]
                symbols, tree, after, before = (x.take(live, axis=1) for x in (symbols, tree, after, before))
                column = column[live]
                live = np.arange(len(live))
            if not len(live):
                break
            n = len(column)
            flat, leaf, right_of, left_of = symbols.ravel(), tree[width:].ravel(), after.ravel(), before.ravel()
            top = tree[1][live].astype(np.int64)
            i = top & (width - 1)
            at = i * n + live
            j = right_of[at] * np.int64(n) + live
            k = right_of[j]
            merged = self.id_of_rank[top >> bits]
            flat[at] = merged
            flat[j] = -1
            right_of[at] = k
            k = k * np.int64(n) + live
            left_of[k] = i
            leaf[j] = none
            h = left_of[at]
            some = np.flatnonzero(h >= 0)
            h = h[some]
            left = h * np.int64(n) + live[some]
            ranks = self._ranks(np.concatenate([merged, flat[left]]), np.concatenate([flat[k], merged[some]]))
            leaf[np.concatenate([at, left])] = np.where(ranks >= 0, (ranks << bits) | np.concatenate([i, h]), none)
        symbols = done.T
        kept = symbols >= 0
        return Ragged(symbols[kept], kept.sum(axis=1))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    def digests(self, ids: Ragged) -> tuple[list[str], list[str]]:
        """Per row SHA-256 of its ids joined by commas, and of the text they are decoded to."""
        of_ids, of_texts = [], []
        tokens = pa.array(ids.values, pa.int32())
        for table, digest in (self.token_digits, of_ids), (self.token_bytes, of_texts):
            taken = table.take(tokens)
            data = memoryview(taken.buffers()[2] or b"")
            ends = np.frombuffer(taken.buffers()[1], np.int64) if len(taken) else np.zeros(1, np.int64)
            for a, b in zip(ends[ids.starts].tolist(), ends[ids.ends].tolist()):
                whole = data[a:max(a, b - 1)] if digest is of_ids else str(data[a:b], "utf-8", "replace").encode()
                digest.append(hashlib.sha256(whole).hexdigest())
        return of_ids, of_texts


def merge_piece(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Symbols after all merges, lowest rank first and leftmost among equals."""
    n = len(symbols)
    if n < 2:
        return symbols
    width = 1 << (n - 1).bit_length()
    none = 1 << 62
    # A node's value is rank * width + place: the smaller value is the lower rank, then the left.
    tree = [none] * (2 * width)
    for i in range(n - 1):
        found = merges.get((symbols[i], symbols[i + 1]))
        if found:
            tree[width + i] = found[0] * width + i
    for k in range(width - 1, 0, -1):
        left, right = tree[2 * k], tree[2 * k + 1]
        tree[k] = left if left <= right else right
    if tree[1] == none:
        return symbols
    symbols = list(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))

    def put(place: int, value: int) -> None:
        k = width + place
        if tree[k] == value:
            return
        tree[k] = value
        while k > 1:
            k >>= 1
            left, right = tree[2 * k], tree[2 * k + 1]
            low = left if left <= right else right
            if tree[k] == low:
                return
            tree[k] = low

    while (top := tree[1]) != none:
        i = top % width
        j = after[i]
        symbols[i] = merges[symbols[i], symbols[j]][1]
        symbols[j] = -1
        k = after[i] = after[j]
        put(j, none)
        if k < n:
            before[k] = i
            found = merges.get((symbols[i], symbols[k]))
            put(i, found[0] * width + i if found else none)
        else:
            put(i, none)
        if i > 0:
            h = before[i]
            found = merges.get((symbols[h], symbols[i]))
            put(h, found[0] * width + h if found else none)
    return [s for s in symbols if s >= 0]


def vocabulary(text: str) -> Vocabulary:
    """The parsed vocabulary, kept for the life of the worker."""
    state, key = worker_state(), "vocabulary " + hashlib.sha256(text.encode()).hexdigest()
    if key not in state:
        state[key] = Vocabulary(text)
    return state[key]


@contextmanager
def no_collection():
    """No cycle collection meanwhile: it would walk the remembered tuples again and again, which form no cycles."""
    enabled = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if enabled:
            gc.enable()


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches with rows, together up to ``GROUP_BYTES`` of text; a larger batch stays alone."""
    group, size = [], 0
    for batch in filter(len, batches):
        more = batch.column("text").nbytes
        if group and size + more > GROUP_BYTES:
            yield pa.Table.from_batches(group)
            group, size = [], 0
        group.append(batch)
        size += more
    if group:
        yield pa.Table.from_batches(group)


def encode_decode(df: DataFrame, vocabulary_path: str, keep_ids: bool = False, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: ``carry``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked, ``input_ids``.

    The ids are decoded again and the digest is of what comes back. The vocabulary file is read on
    the driver and broadcast (about 1.5 MB, the same for any input).
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        shipped = df.sparkSession.sparkContext.broadcast(f.read())
    digests = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(shipped.value)
        for group in grouped(batches):
            with no_collection():
                ids = vocab.ids_of(group.column("text").combine_chunks().cast(pa.large_string()).fill_null(""))
                kinds = vocab.digests(ids)
            arrays = [group.column(c).combine_chunks() for c in carry] + [pa.array(v, f.type) for v, f in zip((ids.lengths, *kinds), digests)]
            names = [*carry, *digests.names]
            if keep_ids:
                offsets = np.append(ids.starts, len(ids.values))
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.values, pa.int32())))
                names.append("input_ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    types = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in carry) + ", n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", input_ids array<int>" if keep_ids else ""
    return small_batches(df.select(*carry, "text")).mapInArrow(run, schema)
