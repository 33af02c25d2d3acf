"""Near copies by exact Jaccard similarity of five-word shingles.

Words are those of the SimHash operator; fewer words than a shingle are one shingle, no word is
the empty set, which equals itself. Two texts are near copies if their sets of shingles (64-bit
hashes) have a Jaccard similarity of ``LEAST`` or more; components are the closure.

Candidates, all of which are checked on the complete sets:

* Links of the bit-sliced SimHash index at its own radius.
* Texts that share one of ``BANDS`` keys of ``ROWS`` min-wise values each. At similarity s a
  pair shares one with probability 1 - (1 - s^ROWS)^BANDS, 0.9996 at 0.8. (A SimHash radius
  with that recall is about 16 bits, for which a banded index needs thousands of keys a text.)

Hot keys: first every text is checked against the most central text of each of its keys, the one
whose keys most texts share: the original of a group of copies, which all of them resemble, while
two copies may resemble each other less. So a large group of copies costs a row per member. Texts
that this has connected need no check against each other. Under keys that still hold different
components the sets of shingles are compared in blocks: of sizes that allow the similarity, a
bitmap per set bounds the difference from below (of two sets that differ in d shingles, at most d
bits differ), what is left is counted exactly, and only links that connect something come out,
never the pairs. A key of more than ``GROUP_ROWS`` texts is dealt out as pairs of chunks.

Equal texts, by SHA-256, are one node with a number of its own. Null ids count as larger than any
id. Joins carry texts, which compress; sets of hashes don't, and take twice the disk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import simhash
from .common import saved, text_of

SEED = 42
SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 20, 5
#: Texts of one key that are compared in one block.
GROUP_ROWS = 2048

_RNG = np.random.default_rng(SEED)
_XOR = _RNG.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64)
_TIMES = _RNG.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def shingles(text: str, width: int = SHINGLE) -> np.ndarray:
    """The sorted set of shingle hashes of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: 1 - width].tolist(), ends[width - 1 :].tolist(), strict=True)], dtype=np.uint64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key per band: the hash of its min-wise values."""
    least = np.full(BANDS * ROWS, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for a in range(0, len(hashes), 2048):
        np.minimum(least, ((hashes[a : a + 2048, None] ^ _XOR) * _TIMES).min(axis=0), out=least)
    raw = least.astype("<u8").tobytes()
    return np.array([xxhash.xxh64_intdigest(raw[8 * ROWS * k : 8 * ROWS * (k + 1)], k) for k in range(BANDS)], dtype=np.uint64).view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [band_keys(shingles(x.as_py())) for x in batch.column(1)]
        nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(np.concatenate(keys) if keys else [], pa.int64())], names=["node", "key"])


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, made = None, np.empty(0, dtype=np.uint64)
    for batch in batches:
        near = []
        for v, x, y in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
            if v != last:  # rows of one hub mostly follow each other
                last, made = v, shingles(y.as_py())
            near.append(jaccard(shingles(x.as_py()), made) >= LEAST)
        yield batch.select(["u", "v"]).filter(pa.array(near, pa.bool_()))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [shingles(x.as_py()).astype("<u8").tobytes() for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["node", "hashes"])


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """A row of ``bits`` bits for each set: bit k tells whether an odd number of its hashes ends in k."""
    odd = np.array([np.bincount((x & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1 for x in sets], dtype=np.uint8)
    return np.packbits(odd, axis=1).view(np.uint64)


def connected(roots: list[int], sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Positions of pairs of near sets that connect what ``roots`` (a component of each set) and earlier pairs don't."""
    parent = {r: r for r in roots}

    def top(r: int) -> int:
        while parent[r] != r:
            parent[r] = parent[parent[r]]
            r = parent[r]
        return r

    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    order = np.argsort(sizes, kind="stable")
    kind = np.array([int(n).bit_length() for n in sizes[order]])  # a set and one near it are of one kind or the next
    for c in np.unique(kind).tolist():
        here = order[np.isin(kind, (c, c + 1))]
        n, maps = sizes[here], bitmaps([sets[k] for k in here], 64 << max(0, c - 3))
        for i in range(int((kind == c).sum())):
            end = int(np.searchsorted(n, n[i] / LEAST + 1e-9, side="right"))
            apart = np.bitwise_count(maps[i] ^ maps[i + 1 : end]).sum(axis=1, dtype=np.int64)
            # Jaccard s of sizes a and b: the sets differ in (a + b) (1 - s) / (1 + s)
            for j in (i + 1 + np.flatnonzero(apart <= (n[i] + n[i + 1 : end]) * (1 - LEAST) / (1 + LEAST) + 1e-9)).tolist():
                a, b = top(roots[here[i]]), top(roots[here[j]])
                if a != b and jaccard(sets[here[i]], sets[here[j]]) >= LEAST:
                    parent[max(a, b)] = min(a, b)
                    yield int(here[i]), int(here[j])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # rows come sorted by group; a group that is not over yet is carried to the next batch
    held: list[tuple[int, int, int, bytes]] = []

    def out(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        at, links = 0, []
        while at < len(rows):
            end = at
            while end < len(rows) and rows[end][0] == rows[at][0]:
                end += 1
            part, at = sorted(rows[at:end]), end
            nodes = [r[1] for r in part]
            found = connected([r[2] for r in part], [np.frombuffer(r[3], "<u8") for r in part])
            links += [(max(nodes[i], nodes[j]), min(nodes[i], nodes[j])) for i, j in found]
        columns = list(zip(*links, strict=True)) if links else [[], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["u", "v"])

    for batch in batches:
        held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
        cut = len(held)
        while cut and held[cut - 1][0] == held[-1][0]:
            cut -= 1
        if cut:
            yield out(held[:cut])
            held = held[cut:]
    yield out(held)


def _near(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the distinct pairs (u, v) that are near copies."""
    x = pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("x")), "u")
    both = x.join(texts.select(F.col("node").alias("v"), F.col("text").alias("y")), "v")
    return both.select("u", "v", "x", "y").mapInArrow(_check, "u long, v long")


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def links(texts: DataFrame) -> DataFrame:
    """(u, v): node and smallest node of its component, for texts (node, text; distinct nodes)."""
    keys = saved(texts.mapInArrow(_keys, "node long, key long"), "bands")
    # tables on both sides of the joins let Spark split the rows of a hot key
    shared = saved(keys.groupBy("key").count().filter("count > 1"), "shared")
    held = saved(keys.join(shared, "key"), "held")
    central = saved(held.groupBy("node").agg(F.sum("count").alias("weight")), "central")
    hubs = saved(held.join(central, "node").groupBy("key").agg(F.max(F.struct("weight", "node")).alias("hub")).select("key", F.col("hub.node").alias("v")), "hubs")
    met = saved(held.select("node", "key").join(hubs, "key"), "met")
    prints = saved(simhash.fingerprints(texts, "node", "text").select("doc_id", "fp"), "fingerprints")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    equal = prints.join(least, "fp").select(F.col("doc_id").alias("u"), F.col("least").alias("v"))
    ends = (least.select(F.col("fp").alias(f"fp_{x}"), F.col("least").alias(x)) for x in "ab")
    close = simhash.links(least.select("fp")).withColumnsRenamed({"u": "fp_a", "v": "fp_b"}).distinct()
    for x in ends:
        close = close.join(x, x.columns[0])
    first = _pairs(met.select(F.col("node").alias("u"), "v").union(equal).union(close.select("a", "b")))
    edges = saved(_near(first, texts), "near")
    roots = simhash.components(edges).withColumnRenamed("u", "node")
    # keys whose texts are still in different components
    placed = met.select("key", "node").join(roots, "node", "left").select("key", "node", F.coalesce("v", "node").alias("root"))
    groups = placed.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n")).filter("a < b").select("key", "n")
    placed = saved(placed.join(groups, "key"), "placed")
    sets = texts.join(placed.select("node").distinct(), "node").select("node", "text").mapInArrow(_sets, "node long, hashes binary")
    chunks = F.when(F.col("n") > GROUP_ROWS, F.ceil(F.col("n") * 2 / GROUP_ROWS).cast("int")).otherwise(1)
    dealt = placed.join(saved(sets, "sets"), "node").withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks").cast("long")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    group = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    more = dealt.select(group.alias("grp"), "node", "root", "hashes").repartition("grp").sortWithinPartitions("grp").mapInArrow(_compare, "u long, v long")
    return simhash.components(edges.union(more.distinct()))


def _name(text_col: str) -> Column:
    return F.unhex(F.sha2(text_of(text_col).cast("binary"), 256))


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, one row each, all columns as they were."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    once = rows.groupBy(_name("text").alias("name")).agg(F.min("id").alias("id"), F.first("text").alias("text"))
    texts = saved(once.withColumn("node", F.monotonically_increasing_id()), "texts")
    roots = links(texts.select("node", "text")).select(F.col("u").alias("node"), F.col("v").alias("root"))
    named = texts.select("node", "id", "name").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # a null id comes after every other; of equal ids the smallest digest stays
    stay = named.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "name")).alias("k"))
    stay = stay.select(F.coalesce("k.id", F.lit(-1)).alias("__key"), F.col("k.id").isNull().alias("__null"), F.col("k.name").alias("__hash"))
    given = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("__key"),
        F.col(id_col).cast("long").isNull().alias("__null"), _name(text_col).alias("__hash"),
    )
    hit = given.join(stay, ["__key", "__null", "__hash"])
    return hit.withColumn("__n", F.row_number().over(Window.partitionBy("__key", "__null", "__hash").orderBy("__key"))).filter("__n = 1").select("__row.*")
