"""SimHash near-duplicates by an inverted index over byte positions with count filtering.

A fingerprint of ``bits`` bits has a byte at each of its positions. Two fingerprints within
``radius`` bits differ in at most ``radius`` bytes, so at least ``bytes - radius`` positional
bytes are shared: the guaranteed count. The postings are keyed by three positional bytes, for a
family of position triples of which every set of the guaranteed size holds one. Pairs that meet
in a posting are tallied, their shared positional bytes counted; those that reach the guaranteed
count are retained, and only they are verified on all bits.

With 64 bits and radius 3 five of eight bytes are shared, three of them in one half of the
fingerprint: the eight triples inside the halves lose no pair (``HALVES``). For wider radii
(``PLANE``, 16 positions) the triples are those inside the 20 lines of the affine plane of order
four, where each two positions share a line; there the count is a likely, not a certain, one.

Scale. Equal fingerprints are one entry. A posting is compared in blocks of at most ``BLOCK``
rows a side by NumPy popcounts, and a block yields a spanning forest of its links, never its
pairs, so output is linear and a long posting is spread over many tasks. No posting is cut.

Similarity of texts. ``one_per_group`` takes candidates from the same index (256 bits, ``LINES``),
and decides by the shingle sets themselves. Positional bytes cannot guarantee a similarity of 0.8,
so candidates by prefix filtering over shingles, thinned out by fingerprints, add the pairs that
share no line of bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import forest, in_blocks, per_block, sides
from .common import dealt, small_batches, stored
from .components import components

SEED = 42
BLOCK = 1024
EXACT_BLOCK = 512       # shingle sets a side of a block
CANDIDATE_RADIUS = 84   # of 256 bits; sets at 0.8 differ in 39 on average, with a deviation of 6
ORDER_SAMPLE, ORDER_LEAST, ORDER_MOST = 64, 4, 1 << 16      # one text in 64; shingles in 4 of them, up to so many, come last
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _plane() -> list[tuple[int, ...]]:
    """Lines of the affine plane of order 4 over 16 positions: x + 4y, x and y in GF(4)."""
    def times(a: int, b: int) -> int:
        product = (a if b & 1 else 0) ^ (a << 1 if b & 2 else 0)
        return product ^ 7 if product & 4 else product
    lines = [tuple(x + 4 * y for y in range(4)) for x in range(4)]
    return lines + [tuple(x + 4 * (times(m, x) ^ c) for x in range(4)) for m in range(4) for c in range(4)]


def triples(lines: list[tuple[int, ...]]) -> list[tuple[int, int, int]]:
    return [t for line in lines for t in combinations(sorted(line), 3)]


HALVES = triples([(0, 1, 2, 3), (4, 5, 6, 7)])
PLANE = triples(_plane())
LINES = _plane()        # whole lines of the plane: four positions a key, so that few keys meet by chance


# --- fingerprints ------------------------------------------------------------------------------


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of each shingle; a text of fewer words is one shingle, one without words has none."""
    parts = (text or "").encode().translate(LOWER).split()
    if not parts:
        return np.empty(0, np.uint64)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), SEED)], np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:len(parts) - words + 1].tolist(), ends[words - 1:].tolist())
    return np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(hashes: np.ndarray, bits: int) -> list[int]:
    """Words of 64 bits, each bit set when it is set in over half the hashes.

    Words after the first come from the same hashes, mixed anew by a multiply-xorshift step.
    """
    out, h = [], hashes
    for word in range(bits // 64):
        if word:
            with np.errstate(over="ignore"):
                h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
                h = h ^ (h >> np.uint64(29))
        sums = np.zeros(64, np.int64)
        for at in range(0, len(h), 1 << 16):
            part = h[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
            sums += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        out.append(int.from_bytes(np.packbits(2 * sums > len(h)).tobytes(), "big"))
    return out


def with_fingerprint(df: DataFrame, words: int = 3, bits: int = 64, carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns of ``df`` and ``fp``, an array of 64-bit words (as signed numbers).

    Null and empty texts have the fingerprint zero.
    """
    carry = ["doc_id"] if carry is None else carry
    names = [c for c in df.columns if c in carry]
    keep = [c for c in names if c != "text"]
    whole = "text" in names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array(fingerprint(shingle_hashes(t.as_py(), words), bits), np.uint64).astype(np.int64).tolist()
                     for t in batch.column("text")]
            arrays = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(found, pa.list_(pa.int64()))], names=[*names, "fp"])

    types = {f.name: f.dataType.simpleString() for f in df.schema}
    ddl = ", ".join(f"`{c}` {types[c]}" for c in names) + ", fp array<bigint>"
    source = df.select(*names) if whole else df.select(*keep, "text")
    return small_batches(source).mapInArrow(run, ddl)


# --- links -------------------------------------------------------------------------------------


def _posting_keys(family: list[tuple[int, ...]]) -> Column:
    """One key per set of positions: its number in the family above its bytes."""
    def byte(position: int) -> Column:
        return F.shiftrightunsigned(F.col("fp")[position // 8], 56 - 8 * (position % 8)).bitwiseAND(F.lit(255))

    def key(number: int, positions: tuple[int, ...]) -> Column:
        out = F.lit(number << 8 * len(positions)).cast("bigint")
        for above, position in enumerate(reversed(positions)):
            out = out.bitwiseOR(F.shiftleft(byte(position), 8 * above))
        return out

    return F.array(*[key(k, positions) for k, positions in enumerate(family)])


def equal_bytes(apart: np.ndarray) -> np.ndarray:
    """How many of the eight bytes of each 64-bit word are zero.

    Adding 127 to the low seven bits of a byte reaches its top bit unless they are zero.
    """
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    return np.bitwise_count(~(((apart & low) + low) | apart | low))


def fingerprint_links(fps: DataFrame, family: list[tuple[int, ...]], radius: int, min_shared: int, positions: int) -> DataFrame:
    """Links ``a, b`` between the distinct fingerprints of ``fps (node, fp)``, a stored table.

    Every two fingerprints that share ``min_shared`` positional bytes inside an indexed triple and
    are within ``radius`` bits are connected by a path of links. (``family`` may be of sets of four.)
    """
    postings = fps.select("node", F.explode(_posting_keys(family)).alias("key"))
    blocks = in_blocks(postings, ["key"], "node", BLOCK).join(fps.select("node", "fp"), "node")
    return per_block(blocks, ["key"], _block_links(radius, min_shared, positions), "a bigint, b bigint")


def _block_links(radius: int, min_shared: int, positions: int):
    def links(table: pa.Table) -> pa.RecordBatch | None:
        node = table.column("node").to_numpy()
        words = table.column("fp").combine_chunks().flatten().to_numpy().reshape(len(node), -1).astype(np.uint64)
        left, right, same_chunk = sides(table)
        if not len(left) or not len(right):
            return None
        first, second = [], []
        step = max(1, (1 << 18) // len(right))
        indexed = words[:, :positions // 8]
        for at in range(0, len(left), step):
            mine = left[at:at + step]
            tally = sum(equal_bytes(indexed[mine, w][:, None] ^ indexed[right, w][None, :]) for w in range(indexed.shape[1]))
            i, j = np.nonzero(tally >= min_shared)
            i, j = mine[i], right[j]
            keep = i < j if same_chunk else np.ones(len(i), bool)
            i, j = i[keep], j[keep]
            near = np.bitwise_count(words[i] ^ words[j]).sum(axis=1, dtype=np.int64) <= radius
            first.append(i[near])
            second.append(j[near])
        a, b = forest(len(node), np.concatenate(first), np.concatenate(second))
        return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

    return links


# --- groups ------------------------------------------------------------------------------------


def near_duplicate_groups(prints: DataFrame, radius: int = 3, bits: int = 64) -> DataFrame:
    """``prints (doc_id, fp, ...)`` with ``component_id``, the smallest doc_id of the group, and ``component``, its key.

    Rows with equal fingerprints are in one group; a null doc_id belongs to its group but never
    names one (null only if the whole group is null). Fingerprints of more than 64 bits are told
    apart by a 64-bit hash.
    """
    if bits == 64:
        family, positions, shared = HALVES, 8, 8 - radius
        if radius > 3:
            raise ValueError("64-bit fingerprints are indexed for a radius of up to 3")
    else:
        family, positions, shared = PLANE, 16, 3
    node = F.col("fp")[0] if bits == 64 else F.xxhash64("fp")
    prints = stored(prints.withColumn("node", node), "fingerprints")
    distinct = stored(prints.groupBy("node").agg(F.first("fp").alias("fp"), F.min("doc_id").alias("low")), "distinct")
    links = fingerprint_links(distinct.select("node", "fp"), family, radius, shared, positions)
    named = distinct.select("node", "low").join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = stored(named, "named")
    least = named.groupBy("component").agg(F.min("low").alias("component_id"))
    return prints.join(stored(named.join(least, "component").select("node", "component", "component_id"), "groups"), "node").drop("node")


# --- one document of each group, decided by shingle sets ----------------------------------------


def prefix_length(size: int, similarity: float) -> int:
    """How many of a set's shingles, first in the common order, are indexed.

    A set that is alike enough shares ``ceil(similarity * size)`` of them, so one of any
    ``size - ceil(similarity * size) + 1``. Sets too small to be alike but equal need none.
    """
    if size * (1 - similarity) + 1e-9 < similarity:
        return 0
    return size - math.ceil(similarity * size - 1e-9) + 1


def common_shingles(documents: DataFrame, words: int) -> np.ndarray:
    """Shingles frequent in a sample of the texts. They only order prefixes, which decides no pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                found = np.unique(shingle_hashes(text.as_py(), words)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found)], names=["shingle"])

    sample = documents.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(ORDER_SAMPLE)) == 0).distinct()
    counts = small_batches(sample).mapInArrow(run, "shingle bigint").groupBy("shingle").agg(F.count("*").alias("n"))
    rows = counts.filter(F.col("n") >= ORDER_LEAST).orderBy(F.desc("n"), "shingle").limit(ORDER_MOST).collect()
    return np.sort(np.array([r.shingle for r in rows], np.int64).view(np.uint64))


def with_prefix(df: DataFrame, words: int, bits: int, similarity: float, common: np.ndarray) -> DataFrame:
    """``doc_id, _r1, _r2`` with ``node`` (a key of the shingle set), its ``size``, ``fp`` and ``prefix``."""
    names = ["doc_id", "_r1", "_r2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, prints, prefixes = [], [], [], []
            for text in batch.column("text"):
                own = np.unique(shingle_hashes(text.as_py(), words))
                often = np.isin(own, common)
                ordered = np.concatenate([own[~often], own[often]])
                nodes.append(xxhash.xxh64_intdigest(own.tobytes(), SEED) - (1 << 63))
                sizes.append(len(own))
                prints.append(np.array(fingerprint(own, bits), np.uint64).view(np.int64))
                prefixes.append(ordered[:prefix_length(len(own), similarity)].view(np.int64))
            arrays = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(prints, pa.list_(pa.int64())),
                      pa.array(prefixes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *arrays], names=[*names, "node", "size", "fp", "prefix"])

    ddl = f"doc_id {dict(df.dtypes)['doc_id']}, _r1 bigint, _r2 bigint, node bigint, size int, fp array<bigint>, prefix array<bigint>"
    return small_batches(df.select(*names, "text")).mapInArrow(run, ddl)


def candidate_links(sets: DataFrame, similarity: float) -> DataFrame:
    """Links ``a, b`` between sets ``(node, size, fp, prefix)`` that may be alike; a superset by construction.

    Most prefix shingles occur once: they are counted alone and go before anything wider is made.
    Postings with the same members are one posting.
    """
    postings = sets.select("node", F.explode("prefix").alias("key"))
    often = postings.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    met = stored(postings.join(often, "key"), "met")
    members = met.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(7))).alias("y"))
    keys = stored(members.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key"), "keys")
    shared = stored(met.join(keys, "key"), "postings")
    blocks = in_blocks(shared, ["key"], "node", BLOCK).join(sets.select("node", "size", "fp"), "node")
    return per_block(blocks, ["key"], _candidates(similarity), "a bigint, b bigint")


def _alike_sizes(left: np.ndarray, right: np.ndarray, similarity: float) -> np.ndarray:
    return np.minimum(left[:, None], right[None, :]) >= similarity * np.maximum(left[:, None], right[None, :]) - 1e-9


def _candidates(similarity: float):
    def links(table: pa.Table) -> pa.RecordBatch | None:
        node, size = table.column("node").to_numpy(), table.column("size").to_numpy()
        words = table.column("fp").combine_chunks().flatten().to_numpy().reshape(len(node), -1).astype(np.uint64)
        left, right, _ = sides(table)
        if not len(left) or not len(right):
            return None
        first, second = [], []
        step = max(1, (1 << 18) // len(right))
        for at in range(0, len(left), step):
            mine = left[at:at + step]
            apart = np.bitwise_count(words[mine][:, None, :] ^ words[right][None, :, :]).sum(axis=2, dtype=np.int64)
            i, j = np.nonzero((apart <= CANDIDATE_RADIUS) & _alike_sizes(size[mine], size[right], similarity))
            first.append(mine[i])
            second.append(right[j])
        a, b = forest(len(node), np.concatenate(first), np.concatenate(second))
        return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

    return links


def _exact_links(similarity: float):
    """Links of the sets of a block whose Jaccard similarity is ``similarity`` or more."""
    def links(table: pa.Table) -> pa.RecordBatch | None:
        node, lists = table.column("node").to_numpy(), table.column("shingles").combine_chunks()
        size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        left, right, _ = sides(table)
        if not len(left) or not len(right):
            return None
        vocabulary, local = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        sets = np.split(local, np.cumsum(size)[:-1])
        theirs, starts = np.concatenate([sets[k] for k in right]), np.concatenate([[0], np.cumsum(size[right])[:-1]])
        alike = _alike_sizes(size[left], size[right], similarity)
        first, second, mine = [], [], np.zeros(len(vocabulary), np.int32)
        for k, i in enumerate(left):
            mine[sets[i]] = 1
            both = np.add.reduceat(mine[theirs], starts)
            mine[sets[i]] = 0
            found = right[alike[k] & (both >= similarity * (size[i] + size[right] - both) - 1e-9)]
            first.append(np.full(len(found), i))
            second.append(found)
        a, b = forest(len(node), np.concatenate(first), np.concatenate(second))
        return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

    return links


def _with_shingles(df: DataFrame, words: int) -> DataFrame:
    """``component, node`` with the set of ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(shingle_hashes(t.as_py(), words)).view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("component"), batch.column("node"), pa.array(found, pa.list_(pa.int64()))],
                                             names=["component", "node", "shingles"])

    return small_batches(df.select("component", "node", "text")).mapInArrow(run, "component bigint, node bigint, shingles array<bigint>")


def one_per_group(documents: DataFrame, words: int = 5, bits: int = 256, similarity: float = 0.8) -> DataFrame:
    """``documents`` with one row of each near-duplicate group, that of the smallest doc_id.

    Two texts are linked exactly if their sets of distinct shingles have a Jaccard similarity of
    ``similarity`` or more; linked texts are a group. Candidates come from the inverted index over
    positional bytes of the fingerprints: a line shared, four shared bytes tallied, within
    ``CANDIDATE_RADIUS`` bits. That index loses pairs near the similarity, so those that share a
    shingle of their prefixes (no alike pair is without one) and have sizes and fingerprints that
    allow the similarity are candidates, too. Components of the candidates bound where the sets
    themselves are compared.
    """
    key = [F.xxhash64("doc_id", "text").alias("_r1"), F.xxhash64(F.lit(9), "text", "doc_id").alias("_r2")]
    keyed = documents.select("doc_id", "text", *key)
    prints = with_prefix(keyed, words, bits, similarity, common_shingles(documents, words))
    low = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_r1", "_r2")).alias("row")
    sets = stored(prints.groupBy("node").agg(low, *(F.first(c).alias(c) for c in ("size", "fp", "prefix"))), "shinglesets")
    indexed = fingerprint_links(sets.select("node", "fp"), LINES, CANDIDATE_RADIUS, 4, 16)
    near = components(indexed.union(candidate_links(sets, similarity)))
    members = stored(sets.select("node", "row._r1", "row._r2").join(near, "node"), "members")
    # Whole rows cross the network once: both joins with them find them dealt out by their key.
    wide = dealt(documents.select(F.struct("*").alias("_row"), *key), ["_r1", "_r2"], "rows")
    texts = wide.select("_row.text", "_r1", "_r2").join(members, ["_r1", "_r2"]).dropDuplicates(["node"])
    blocks = in_blocks(stored(_with_shingles(texts, words), "sets"), ["component"], "node", EXACT_BLOCK)
    links = per_block(blocks, ["component"], _exact_links(similarity), "a bigint, b bigint")
    groups = sets.select("node", "row").join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    kept = groups.groupBy("component").agg(F.min("row").alias("row")).select("row._r1", "row._r2")
    # Repeated rows share the key, and one of them stays; only those are gathered for it.
    again = keyed.groupBy("_r1", "_r2").agg(F.count("*").alias("_n")).filter("_n > 1").select("_r1", "_r2", F.lit(True).alias("_again"))
    kept = stored(kept.join(again, ["_r1", "_r2"], "left").withColumn("_again", F.coalesce("_again", F.lit(False))), "kept")
    rows = wide.join(kept, ["_r1", "_r2"])
    return rows.filter("NOT _again").select("_row.*").union(rows.filter("_again").dropDuplicates(["_r1", "_r2"]).select("_row.*"))
