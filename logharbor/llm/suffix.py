"""Repeated byte strings by suffix arrays of shards, merged by binary search.

A start is a place of a text that has ``length`` bytes from there on. It is repeated if the same
bytes start anywhere else. What repeated starts cover is removed.

Method. A shard is a set of pieces of texts. Its suffix array comes from Larsson-Sadakane
refinement in NumPy: suffixes are ordered by their first eight bytes, then by the ranks of the
suffixes 8, 16, 32, ... bytes later, where only groups that are still tied are sorted again. Common prefixes of neighbours come from Kasai's rule (the next
place of a text shares at most one byte less), for all pieces side by side. A start whose
neighbour shares ``length`` bytes is repeated. Shards that hold pieces of one hot group are merged:
each gives one key for each different string of that group, and a binary search in the sorted
keys of all of them finds those of several shards.

Which pieces meet. Each start has an anchor: of the ``width`` places from it on, that whose next
``gram`` bytes have the smallest hash (the leftmost of several). The ``length`` bytes of the start
hold all of these, so equal strings have equal anchors: starts whose anchor occurs once in the
corpus are not repeated, and the others are sent to a shard by the hash of the anchor's bytes. A
piece is the bytes that neighbouring starts with the same anchor need. This sorts out and deals
out; whether a start is repeated is told by the suffix array and by counts of equal pieces.

Scale. An anchor comes about every ``width / 2`` bytes and is a narrow row. Counts are made before
the shuffle. Equal pieces are one piece with a count (repeated as a whole when it is over one).
Pieces of a group of more than ``HOT_PIECES`` different ones are dealt to all shards. Texts are
shuffled to their pieces and to their cuts. No group is compared in pairs, nothing is capped; the
driver gets one count.

Cases. Null texts count as empty. Texts shorter than ``length`` bytes stay whole. Repeated rows are
copies of each other. Texts of any length are read in windows of ``WINDOW`` places. Cuts may fall
inside a character, so ``kept`` is binary. Columns of the result (``n_bytes, n_removed, n_spans,
kept``) that the input has, too, are an error; other columns pass through. An empty table gives an
empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import per_block
from .common import small_batches, stored

LENGTH = 200
WINDOW = 1 << 18            # places whose anchors are found at once
PLACE = np.uint64((1 << 20) - 1)
SHARD_PIECES = 4096         # about a megabyte
HOT_PIECES = 512            # different pieces of a group that one shard holds
MERGE_KEYS = 1 << 20        # keys of a group merged by one call
SEED = 42
RESULT = ("n_bytes", "n_removed", "n_spans", "kept")


# --- anchors ------------------------------------------------------------------------------------


@lru_cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte, powers of an odd base and of its inverse."""
    numbers = np.array([xxhash.xxh64_intdigest(bytes([b]), SEED) for b in range(256)], np.uint64)
    base = 0x9E3779B97F4A7C15
    size = WINDOW + (1 << 16)
    with np.errstate(over="ignore"):
        up, down = (np.cumprod(np.full(size, b, np.uint64)) for b in (base, pow(base, -1, 1 << 64)))
    return numbers, up, down


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from each place on."""
    numbers, up, down = _tables()
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers[data] * up[:len(data)])])
        h = (sums[gram:] - sums[:-gram]) * down[:len(data) - gram + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    return h


def anchors(data: np.ndarray, gram: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each start of ``data`` the place of its anchor, and the hash of each place's bytes."""
    h = gram_hashes(data, gram)
    least = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
    reach = 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[:len(least) - (width - reach)], least[width - reach:])
    return (least & PLACE).astype(np.int64), h


def _pieces(batch: pa.RecordBatch, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Row, first start and number of starts, hash of the anchor and of the piece, for each piece of a batch's texts."""
    texts = batch.column("text")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    width, digest = length - gram + 1, xxhash.xxh3_64_intdigest
    lo, end = int(offsets[0]), int(offsets[-1])
    while lo + length <= end:
        hi = min(end, lo + WINDOW + length - 1)
        part = data[lo:hi]
        anchor, h = anchors(part, gram, width)
        start = np.arange(lo, lo + len(anchor))
        row = np.searchsorted(offsets, start, "right") - 1
        anchor, start, row = (x[start + length <= offsets[row + 1]] for x in (anchor, start, row))
        if len(start):
            new = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(row) != 0)) + 1
            first = np.concatenate([[0], new])
            last = np.concatenate([new, [len(start)]]) - 1
            view = memoryview(part)
            a, b = start[first] - lo, start[last] - lo + length
            own = np.fromiter((digest(view[x:y], SEED) for x, y in zip(a.tolist(), b.tolist())), np.uint64, len(a))
            yield row[first], start[first] - offsets[row[first]], last - first + 1, h[anchor[first]], own
        lo = hi - length + 1


def text_key() -> Column:
    return F.xxhash64("text", F.octet_length("text"))


def anchored(documents: DataFrame, length: int, gram: int) -> DataFrame:
    """``key, piece, text_id, at``: all pieces; ``at`` holds the first start and, in its low 16 bits, the number of starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("text_id").to_numpy()
            for row, first, n, key, piece in _pieces(batch, length, gram):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(piece.view(np.int64)), pa.array(ids[row]), pa.array(first << 16 | n)],
                    names=["key", "piece", "text_id", "at"])

    texts = documents.filter(F.octet_length("text") >= length).select(text_key().alias("text_id"), "text")
    return small_batches(texts).mapInArrow(run, "key bigint, piece bigint, text_id bigint, at bigint")


# --- one shard ----------------------------------------------------------------------------------


def _ranks(order: np.ndarray, differs: np.ndarray) -> np.ndarray:
    """Rank of each member of ``order``: the place of the first member of its group."""
    return np.maximum.accumulate(np.where(differs, np.arange(len(order)), 0))


def leading_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number; zeros follow the end."""
    words = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for step, bits in ((1, 8), (2, 16), (4, 32)):
        words = (words[:-step] << np.uint64(bits)) | words[step:]
    return words[:len(data)]


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Places of ``data`` ordered by their suffixes (Larsson-Sadakane); the end comes before every byte."""
    n = len(data)
    words = leading_bytes(data)
    order = np.argsort(words)
    differs = np.concatenate([[True], words[order][1:] != words[order][:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = _ranks(order, differs)
    reach = 8
    while True:
        # Members of sorted groups, those of one suffix, are skipped.
        tied = np.flatnonzero(~(differs & np.concatenate([differs[1:], [True]])))
        if not len(tied):
            break
        suffixes = order[tied]
        later = suffixes + reach
        later = np.where(later < n, rank[np.minimum(later, n - 1)], n - later - 1)
        both = (rank[suffixes] << 32) + later
        again = np.argsort(both)
        order[tied] = suffixes[again]
        both = both[again]
        differs[tied] |= np.concatenate([[True], both[1:] != both[:-1]])
        fresh = _ranks(order, differs)[tied]
        rank[order[tied]] = fresh
        reach *= 2
    return order


def common_prefixes(words: np.ndarray, before: np.ndarray, first: np.ndarray, n: np.ndarray, cap: int) -> np.ndarray:
    """Bytes that each start shares with the start before it in suffix order, up to ``cap`` (Kasai's rule).

    ``before`` has that start for each place, -1 for none and -2 where no start is. Pieces, of
    ``n`` starts from ``first`` on, are walked side by side.
    """
    out = np.zeros(len(before), np.int64)
    lane = np.arange(len(first))
    i, end, h = first.copy(), first + n, np.zeros(len(first), np.int64)
    padded = np.concatenate([words, np.zeros(cap + 8, np.uint64)])
    while len(lane):
        j = before[i]
        none = j < 0
        apart = padded[i + h] ^ padded[np.where(none, i, j) + h]
        same = np.full(len(apart), 8, np.int64)
        for byte in range(8):
            same -= apart >= np.uint64(1 << 8 * byte)
        h = np.where(none, 0, h + same)
        done = none | (same < 8) | (h >= cap)
        at = i[done]
        out[at] = np.minimum(h[done], cap)
        # The start after this one and that after its neighbour share at least one byte less.
        follows = ~none[done] & (before[np.minimum(j[done] + 1, len(before) - 1)] != -2)
        h[done] = np.where(follows, np.maximum(np.minimum(h[done], cap) - 1, 0), 0)
        i[done] += 1
        open_ = i < end
        if not open_.all():
            lane, i, end, h = lane[open_], i[open_], end[open_], h[open_]
    return out


def repeated_starts(pieces: list[bytes], n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the starts of ``pieces`` laid end to end, which of them are repeated, and which are the first of their string."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    first = np.cumsum(sizes) - sizes
    starts = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    is_start = np.zeros(len(data), bool)
    is_start[starts] = True
    order = suffix_array(data)
    order = order[is_start[order]]
    before = np.full(len(data), -2, np.int64)
    before[order] = np.concatenate([[-1], order[:-1]])
    shared = common_prefixes(leading_bytes(data), before, first, n, length)[order] >= length
    both = np.zeros(len(data), bool)
    both[order] = shared | np.concatenate([shared[1:], [False]])
    lead = np.zeros(len(data), bool)
    lead[order] = ~shared
    return starts, both[starts], lead[starts]


def _stretches(flags: np.ndarray, lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each stretch of true ``flags`` within one lane."""
    cut = np.flatnonzero(lanes[1:] != lanes[:-1]) + 1
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    first, last = edges[:-1] == 1, edges[1:] == -1
    first[cut] |= flags[cut]
    last[cut - 1] |= flags[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last)


RUNS = "runs array<struct<from:int,to:int>>"
FOUND_DDL = f"key bigint, piece bigint, {RUNS}, sub int, shard bigint, strings array<bigint>, pieces array<bigint>, places array<int>"
RUN_TYPE = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))


def _lists(values: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, kind))


def _run_lists(a: np.ndarray, b: np.ndarray, cuts: np.ndarray) -> pa.Array:
    both = pa.StructArray.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32())], fields=list(RUN_TYPE.value_type))
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), both)


def _cuts(*columns: np.ndarray) -> np.ndarray:
    """Where stretches of equal rows begin, and the end."""
    new = np.zeros(max(0, len(columns[0]) - 1), bool)
    for c in columns:
        new |= c[1:] != c[:-1]
    return np.concatenate([[0], np.flatnonzero(new) + 1, [len(columns[0])]]) if len(columns[0]) else np.zeros(1, np.int64)


def _shard(length: int, width: int):
    def run(table: pa.Table) -> pa.RecordBatch | None:
        """A row for each piece with repeated starts (``runs``), and one for each hot group with its different strings, sorted."""
        keys, piece = table.column("key").to_numpy(), table.column("piece").to_numpy()
        _, once = np.unique(np.stack([keys, piece], axis=1), axis=0, return_index=True)
        table = table.take(pa.array(np.sort(once)))
        keys, piece, n, m = (table.column(c).to_numpy() for c in ("key", "piece", "n", "m"))
        texts = table.column("bytes").to_pylist()
        places, repeated, lead = repeated_starts(texts, n.astype(np.int64), length)
        lane = np.repeat(np.arange(len(n)), n)
        within = np.arange(len(lane)) - np.repeat(np.cumsum(n) - n, n)
        a, b = _stretches(repeated, lane)
        cuts = _cuts(lane[a])
        owner = lane[a][cuts[:-1]]
        # One key for each string of a hot group, by group, part of the group, and key.
        whole = b"".join(texts)
        asked = np.flatnonzero(lead & (m > HOT_PIECES)[lane])
        strings = np.array([xxhash.xxh3_64_intdigest(whole[p:p + length], SEED) for p in places[asked].tolist()], np.uint64).view(np.int64)
        of = lane[asked]
        sub = strings.view(np.uint64) % (-(-m[of] * width // MERGE_KEYS)).astype(np.uint64) if len(asked) else np.empty(0, np.uint64)
        order = np.lexsort((strings, sub, keys[of]))
        strings, of, sub, at = strings[order], of[order], sub[order], within[asked][order]
        parts = _cuts(keys[of], sub)
        heads = parts[:-1]
        size, more = len(owner), len(heads)
        if not size + more:
            return None
        late = np.concatenate([np.zeros(size + 1, np.int64), parts[1:]])
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([keys[owner], keys[of][heads]])),
            pa.array(np.concatenate([piece[owner], np.zeros(more, np.int64)])),
            _run_lists(within[a], within[b], np.concatenate([cuts, np.full(more, cuts[-1])])),
            pa.array(np.concatenate([np.zeros(size), sub[heads]]).astype(np.int32), mask=np.arange(size + more) < size),
            pa.array(np.full(size + more, table.column("shard")[0].as_py()), pa.int64()),
            _lists(strings, late, pa.int64()), _lists(piece[of], late, pa.int64()), _lists(at, late, pa.int32()),
        ], names=["key", "piece", "runs", "sub", "shard", "strings", "pieces", "places"])

    return run


def _merge(table: pa.Table) -> pa.RecordBatch | None:
    """Strings of a group that more than one shard has: each shard's keys are looked up in the sorted keys of all."""
    lists = [[np.asarray(x) for x in table.column(c).to_pylist()] for c in ("strings", "pieces", "places")]
    merged = np.sort(np.concatenate(lists[0]))
    pieces, places = [], []
    for own, piece, place in zip(*lists):
        several = np.searchsorted(merged, own, "right") - np.searchsorted(merged, own, "left") > 1
        pieces.append(piece[several])
        places.append(place[several])
    pieces, places = np.concatenate(pieces), np.concatenate(places)
    if not len(pieces):
        return None
    order = np.lexsort((places, pieces))
    pieces, places = pieces[order], places[order]
    cuts = _cuts(pieces)
    key = table.column("key")[0].as_py()
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(cuts) - 1, key), pa.int64()), pa.array(pieces[cuts[:-1]], pa.int64()), _run_lists(places, places, cuts)],
        names=["key", "piece", "runs"])


# --- the corpus ---------------------------------------------------------------------------------


def _with_bytes(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``key, piece, m, n, bytes`` of the wanted pieces, cut from their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            key, piece, m, n, parts = [], [], [], [], []
            for own, text, asked in zip(*(batch.column(c) for c in ("text_id", "text", "asked"))):
                if own == held:         # a copy of the text before it
                    continue
                held, view = own, memoryview(text.as_buffer())
                for x in asked.as_py():
                    first, count = x["at"] >> 16, x["at"] & 0xFFFF
                    key.append(x["key"])
                    piece.append(x["piece"])
                    m.append(x["m"])
                    n.append(count)
                    parts.append(bytes(view[first:first + count - 1 + length]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(piece, pa.int64()), pa.array(m, pa.int64()), pa.array(n, pa.int32()),
                 pa.array(parts, pa.binary())], names=["key", "piece", "m", "n", "bytes"])

    asked = wanted.groupBy("text_id").agg(F.collect_list(F.struct("key", "piece", "m", "at")).alias("asked"))
    both = texts.join(asked, "text_id")
    return small_batches(both.select("text_id", "text", "asked")).mapInArrow(run, "key bigint, piece bigint, m bigint, n int, bytes binary")


def repeated_cover(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """``text_id, cover``: for each text (:func:`text_key`) with repeated starts, stretches of their places, both ends included."""
    gram = max(1, length // 5)
    pieces = anchored(documents, length, gram)
    often = pieces.groupBy("key").agg(F.count("*").alias("_n")).filter("_n > 1").select("key")
    # The join is a step of its own, so that it can split hot anchors. Copies of a text have the
    # same pieces: one row with their number.
    met = stored(pieces.join(often, "key"), "met")
    pieces = stored(met.groupBy("key", "piece", "text_id", "at").agg(F.count("*").alias("n")), "pieces")
    different = stored(pieces.groupBy("key", "piece").agg(
        F.sum("n").alias("n"), F.min(F.struct("text_id", "at")).alias("one")), "different")
    groups = stored(different.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1"), "groups")
    wanted = stored(different.join(groups, "key").select("key", "piece", "one.text_id", "one.at", "m"), "wanted")
    shards = max(1, -(-wanted.count() // SHARD_PIECES))
    texts = documents.filter(F.octet_length("text") >= length).select(text_key().alias("text_id"), "text")
    shard = F.when(F.col("m") > HOT_PIECES, F.xxhash64("key", "piece")).otherwise(F.xxhash64("key"))
    whole = {"low": F.lit(0), "high": F.lit(0), "right": F.lit(False)}      # a block with no other side
    dealt = _with_bytes(texts, wanted, length).withColumns({"shard": F.pmod(shard, F.lit(shards)), **whole})
    found = stored(per_block(dealt, ["shard"], _shard(length, length - gram + 1), FOUND_DDL), "found")
    lists = found.filter("sub IS NOT NULL").select("key", "sub", "shard", "strings", "pieces", "places").withColumns(whole)
    merged = per_block(lists, ["key", "sub"], _merge, f"key bigint, piece bigint, {RUNS}")
    several = different.filter("n > 1").select("key", "piece", F.lit(None).cast(RUNS.split(" ", 1)[1]).alias("runs"))
    starts = found.filter("sub IS NULL").select("key", "piece", "runs").union(merged).union(several)
    starts = stored(starts, "starts")
    first, n = F.shiftright("at", 16), F.col("at").bitwiseAND(F.lit(0xFFFF))
    runs = F.transform("runs", lambda r: F.struct((first + r["from"]).alias("first"), (first + r["to"]).alias("last")))
    every = F.array(F.struct(first.alias("first"), (first + n - 1).alias("last")))
    rows = pieces.join(starts, ["key", "piece"]).select("text_id", F.coalesce(runs, every).alias("runs"))
    return rows.groupBy("text_id").agg(F.flatten(F.collect_list("runs")).alias("cover"))


def without_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """``documents`` with ``n_bytes, n_removed, n_spans`` and ``kept``, the bytes that no repeated start covers."""
    clash = set(RESULT) & set(documents.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are those of the result")
    cover = stored(repeated_cover(documents, length), "cover")
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for text, cover in zip(batch.column("text"), batch.column("_cover")):
                data = (text.as_py() or "").encode()
                flat = cover.values
                first, last = (flat.field(c).to_numpy() for c in ("first", "last")) if flat is not None else ([], [])
                order = np.argsort(first)
                parts, at, gone, runs = [], 0, 0, 0
                for a, b in zip(np.asarray(first)[order].tolist(), np.asarray(last)[order].tolist()):
                    if a > at or not runs:
                        parts.append(data[at:a])
                        runs += 1
                        at = a
                    gone += max(0, b + length - at)
                    at = max(at, b + length)
                parts.append(data[at:])
                sizes.append(len(data))
                removed.append(gone)
                spans.append(runs)
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *(pa.array(v, pa.int64()) for v in (sizes, removed, spans)), pa.array(kept, pa.binary())],
                names=[*names, *RESULT])

    joined = documents.withColumn("_id", text_key()).join(cover.withColumnRenamed("text_id", "_id").withColumnRenamed("cover", "_cover"), "_id", "left")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return small_batches(joined.select(*names, "_cover")).mapInArrow(
        run, f"{fields}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
