"""SimHash near-duplicate detection with bit-sliced comparison.

Fingerprint: words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lowered, 4-word shingles with
repeats, each hashed by XXH64 (seed 42); a bit of the fingerprint is 1 if it is set in more
than half of the hashes. Fewer words than a shingle: the whole sequence is one shingle; no
word (or a null text): fingerprint zero, linked like any other.

Links: two fingerprints link at ``radius`` or fewer differing bits, components are the closure.
All links are found, none is sampled or capped:

* Equal fingerprints are one node, so copies cost one row.
* The 64 bits are split into ``radius + extra`` bands; two linked fingerprints agree on
  ``extra`` whole bands at least, so every choice of ``extra`` bands is a key and linked nodes
  meet under one of them. ``extra`` follows from the number of nodes, so keys stay selective.
* Nodes that share a key are compared bit-sliced: bit planes are stored vertically (one bit
  per node, 64 nodes a word), each plane is XORed with itself shifted by a lag, and carry-save
  bitwise counters add the differing bits of many pairs at once. A block of pairs is abandoned
  as soon as all of its pairs exceed the radius.
* A key shared by more than ``GROUP_ROWS`` nodes is dealt into chunks, and pairs of chunks are
  compared in tasks of their own.
* A comparison emits a spanning forest of the links in its group, never all pairs.
* Components: rounds of large-star and small-star over the forest edges, each round written
  to the shared folder.

Defined cases: null ids are kept and count as larger than any id; rows that repeat an id are
kept each; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, saved, text_of, with_least

SEED = 42
SHINGLE = 4
RADIUS = 4
#: Nodes of one comparison; larger groups are compared as pairs of chunks.
GROUP_ROWS = 2048
#: Nodes that may share a key on average.
KEY_ROWS = 1024
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, width: int = SHINGLE, seed: int = SEED) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts[: 1 - width].tolist(), ends[width - 1 :].tolist(), strict=True)], dtype=np.uint64)
    return vote(hashes)


def vote(hashes: np.ndarray) -> int:
    """Bits that are set in more than half of the hashes."""
    totals = np.zeros(64, dtype=np.int64)
    for a in range(0, len(hashes), 1 << 16):
        totals += np.unpackbits(hashes[a : a + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(k) for k in np.flatnonzero(2 * totals > len(hashes)))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = np.array([fingerprint(x.as_py()) for x in batch.column(1)], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(made, pa.int64())], names=["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash (tells rows of one id apart), fp (the 64 bits as a signed long) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"), F.xxhash64(text_of(text_col)).alias("text_hash"))
    return rows.mapInArrow(_fingerprints, "doc_id long, text_hash long, fp long")


def band_plan(nodes: int, radius: int = RADIUS, bits: int = 64) -> list[list[tuple[int, int]]]:
    """Keys as lists of (shift, width) bands, for exact search among so many nodes."""
    for extra in range(1, bits - radius + 1):
        n = radius + extra
        cuts = [bits * k // n for k in range(n + 1)]
        bands = [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
        if nodes >> (bits // n * extra) <= KEY_ROWS or extra == 4:
            return [list(x) for x in combinations(bands, extra)]
    raise ValueError("no bands")


def _planes(values: np.ndarray, words: int) -> np.ndarray:
    """64 bit planes, each with one bit per value, in uint64 words."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    out = np.zeros((64, words * 8), dtype=np.uint8)
    out[:, : packed.shape[1]] = packed
    return out.view(np.uint64)


def _shifted(words: np.ndarray, lag: int) -> np.ndarray:
    """Bit i of the result is bit i + lag of the words."""
    skip, bits = divmod(lag, 64)
    out = np.zeros_like(words)
    rest = words[..., skip:]
    n = rest.shape[-1]
    if not n:
        return out
    if not bits:
        out[..., :n] = rest
    else:
        out[..., :n] = rest >> np.uint64(bits)
        out[..., : n - 1] |= rest[..., 1:] << np.uint64(64 - bits)
    return out


def lag_links(values: np.ndarray, groups: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of one group whose values differ in at most ``radius`` bits, by growing lag.

    ``groups`` is sorted. Every pair i, i + lag of a group is compared, 64 pairs a word.
    """
    index, lag = np.arange(len(values)), 0
    order = max(1, math.ceil(math.log2(radius + 2)))
    while True:
        lag += 1
        if lag == 1 or not lag & (lag - 1):
            # rows of groups that are too small for this lag and all greater ones leave the planes
            _, first, size = np.unique(groups[index], return_index=True, return_counts=True)
            stay = np.repeat(size > lag, size)
            index = index[stay]
            if not len(index):
                return
            own = groups[index]
            words = (len(index) + 63) // 64
            planes = _planes(values[index], words)
        n = len(index) - lag
        if n <= 0:
            return
        same = np.zeros(words * 64, dtype=np.uint8)
        same[:n] = own[:n] == own[lag:]
        if not same.any():
            continue
        alive = np.packbits(same, bitorder="little").view(np.uint64)
        block = np.flatnonzero(alive)
        dead = ~alive[block]
        counters = [np.zeros(len(block), dtype=np.uint64) for _ in range(order)]
        for k in range(64):
            carry = (planes[k] ^ _shifted(planes[k], lag))[block]
            for c in counters:  # add one bit to every lane's counter
                c_and = c & carry
                c ^= carry
                carry = c_and
            # a lane is dead once its counter passes the radius or overflows
            dead |= carry | _above(counters, radius)
            if k >= 8 and k % 4 == 0:
                live = dead != ALL
                if not live.any():
                    block = block[:0]
                    break
                if live.mean() < 0.5:  # abandon blocks whose pairs all exceed the radius
                    block, dead, counters = block[live], dead[live], [c[live] for c in counters]
        if len(block):
            found = np.flatnonzero(np.unpackbits((~dead).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").reshape(-1))
            if len(found):
                i = block[found // 64] * 64 + found % 64
                yield index[i], index[i + lag]


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is greater than ``radius``."""
    above, equal = np.zeros_like(counters[0]), np.full_like(counters[0], ALL)
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return above


def forest(values: np.ndarray, groups: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside the groups, as (node, smallest node of its tree) indexes."""
    root = np.arange(len(values))

    def top(x: np.ndarray) -> np.ndarray:
        while True:
            y = root[x]
            if (y == x).all():
                return x
            x = y

    for i, j in lag_links(values, groups, radius):
        a, b = top(i), top(j)
        while (a != b).any():
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(root, high, low)
            a, b = top(a), top(b)
        root = root[root]
    root = top(root)
    nodes = np.flatnonzero(root != np.arange(len(values)))
    return nodes, root[nodes]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by group; a group that is not over yet is carried to the next batch
        g, v = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)

        def out(groups: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(values):
                nodes, roots = forest(values, groups, radius)
                yield pa.RecordBatch.from_arrays([pa.array(values[nodes].view(np.int64)), pa.array(values[roots].view(np.int64))], names=["u", "v"])

        for batch in batches:
            g = np.concatenate([g, batch.column(0).to_numpy(zero_copy_only=False)])
            v = np.concatenate([v, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            cut = int(np.searchsorted(g, g[-1])) if len(g) else 0
            if cut:
                yield from out(g[:cut], v[:cut])
                g, v = g[cut:], v[cut:]
        yield from out(g, v)

    return run


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) between fingerprints, a spanning forest of the links under each key."""
    plan = band_plan(nodes.count(), radius)
    keys = []
    for k, bands in enumerate(plan):
        mask = sum(((1 << width) - 1) << shift for shift, width in bands)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(signed))))
    rows = nodes.select("fp", F.explode(F.array(*keys)).alias("key"))
    hot = rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP_ROWS).select("key", F.ceil(F.col("n") * 2 / GROUP_ROWS).cast("int").alias("chunks"))
    rows = rows.join(hot, "key", "left")
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks").cast("long")).cast("int")
    other = F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = rows.select("key", "fp", F.coalesce(chunk, F.lit(0)).alias("own"), F.explode(other).alias("other"))
    # a group: one key, or one pair of chunks of a hot key (its bits are mixed into the id)
    group = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    dealt = dealt.select(group.alias("grp"), "fp")
    return dealt.repartition("grp").sortWithinPartitions("grp").mapInArrow(_compare(radius), "u long, v long")


def components(edges: DataFrame, name: str = "stars") -> DataFrame:
    """(u, v): v is the smallest node that u is connected with, for every u that is not it.

    Alternates large-star and small-star until no edge changes; the number of rounds grows with
    the logarithm of the size of the components.
    """
    now = saved(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    if now.isEmpty():
        return now
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # a hub's neighbours are dealt to several tasks
        low = with_least(both, "u", F.col("v"), "v", "m")
        large = low.filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        # small star: every node links its smaller neighbours and itself to the smallest of them
        low = with_least(large, "u", F.col("v"), "v", "m")
        small = low.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u > v").distinct()
        before, now = now, saved(small, name)
        discard(before)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == mark:
            return now
        mark = state


def _grouped(docs: DataFrame, id_col: str, text_col: str, radius: int) -> DataFrame:
    marked = saved(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = marked.select("fp").distinct()
    roots = components(links(nodes, radius)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    least = saved(least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "roots")
    named = saved(with_least(least, "root", F.col("fp"), "least", "component_id").select("fp", "root", "component_id"), "components")
    return marked.join(named, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    return _grouped(docs, id_col, text_col, radius).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, one row each, all columns as they were."""
    from pyspark.sql import Window

    found = _grouped(docs, id_col, text_col, radius).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # ids may repeat inside a component: of such rows the one with the smallest text hash stays
    stay = found.groupBy("root").agg(F.min_by(F.struct(F.coalesce("doc_id", F.lit(-1)).alias("__key"), F.col("text_hash").alias("__hash")), "text_hash").alias("k")).select("k.*")
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("__key"), F.xxhash64(text_of(text_col)).alias("__hash"))
    hit = named.join(stay, ["__key", "__hash"])
    return hit.withColumn("__n", F.row_number().over(Window.partitionBy("__key", "__hash").orderBy("__key"))).filter("__n = 1").select("__row.*")
