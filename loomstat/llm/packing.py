"""Sum-of-squares packing of token sequences.

A document's pieces are placed one by one: among the open sequences (one candidate per
residual gap) and a new one, a piece goes where the sum over all gaps of the squared number of
open sequences with that gap becomes smallest. Documents longer than the capacity are cut into
whole pieces of that length; what remains comes first and is packed like a short document.

Pieces of full length need no packing. The others are dealt evenly into shards of about
``SHARD_ITEMS`` pieces by their number, so that tasks stay bounded and no key (source, copy)
matters; each shard is packed on its own, its pieces placed longest first (of equal sums the
smallest gap is taken). Only lengths and ids travel, never texts.

``pack_in_order`` follows an order: pieces go to shards that are contiguous
ranges of their positions, each is packed in windows of ``WINDOW_ITEMS`` neighbouring pieces
(full ones with them), and sequences are numbered by the mean position of their tokens.

Tokens: ids of a byte-level BPE whose rank file and vocabulary file are parameters, then one end
id. The rank file is read with tiktoken, whose ids equal those of the ``tokenizers`` file of the
same vocabulary as it stands, its added tokens included: such a string in a text is one id (tests
compare them, no setting changed); it takes a quarter of the CPU time. Its pattern engine
gives up on very long runs of white space, so those are cut out at the borders the pattern
itself has there and go to the merges directly.

Defined cases: a null text is empty and is one piece (the end id); ids may be null or repeated;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, text_of

CAPACITY = 2048
END_ID = 0
SHARD_ITEMS = 65_536
#: Pieces of one window of an ordered packing: sequences leave the order by no more than that.
WINDOW_ITEMS = 1024
#: Runs of white space from this length on are cut out of a text.
LONG_RUN = 4096
#: The characters of Unicode's White_Space, which the pattern calls \\s.
_LONG_BLANK = re.compile(rf"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{LONG_RUN},}}")


@cache
def encoder(ranks_path: str | None = None, vocabulary_path: str | None = None):
    """The encoding of a rank file, with the added tokens of its vocabulary file; by default the public 50k byte-level BPE."""
    import public_tokenizers
    import tiktoken

    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    with open(vocabulary_path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        added = {x["content"]: x["id"] for x in json.load(file)["added_tokens"]}
    return tiktoken.Encoding("loomstat", pat_str=public_tokenizers.PATTERN, mergeable_ranks={k: v for k, v in ranks.items() if v not in added.values()}, special_tokens=added)


def token_ids(text: str, ranks_path: str | None = None) -> np.ndarray:
    """The ids of a whole text, whatever its length."""
    encoding = encoder(ranks_path)
    made, at, added = [], 0, tuple(encoding.special_tokens_set)

    def ids(part: str) -> np.ndarray:
        return encoding.encode_to_numpy(part, allowed_special="all")

    for run in _LONG_BLANK.finditer(text) if len(text) >= LONG_RUN else ():
        # the pattern takes a run up to its last character, which may belong to what follows; at the end or before an added token all of it
        end = run.end() if run.end() == len(text) or text.startswith(added, run.end()) else run.end() - 1
        made += [ids(text[at : run.start()]), np.array(encoding._encode_single_piece(text[run.start() : end]), dtype=np.uint32)]
        at = end
    made.append(ids(text[at:]))
    return np.concatenate(made) if len(made) > 1 else made[0]


def cuts(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be short."""
    first = length % capacity or capacity
    return [(0, min(first, length)), *((a, capacity) for a in range(first, length, capacity))]


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The bin of every item, in the order given. Lengths are 1 to capacity."""
    counts = np.zeros(capacity + 1, dtype=np.int64)  # open bins by residual gap
    of_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, made = np.empty(len(lengths), dtype=np.int64), 0
    never = np.int64(1 << 40)
    # change of the sum when a bin of gap g is taken away; a new bin (gap = capacity) takes none
    leave = np.full(capacity + 1, never)
    leave[capacity] = 0
    join = np.ones(capacity + 1, dtype=np.int64)  # when a bin of gap g comes; a full one isn't counted
    join[0] = 0
    for k, s in enumerate(lengths.tolist()):
        g = s + int((leave[s:] + join[: capacity + 1 - s]).argmin())
        if g == capacity:
            at, made = made, made + 1
        else:
            at = of_gap[g].pop()
            counts[g] -= 1
            leave[g] = 1 - 2 * counts[g] if counts[g] else never
            join[g] = 2 * counts[g] + 1
        bins[k] = at
        if rest := g - s:
            of_gap[rest].append(at)
            counts[rest] += 1
            leave[rest] = 1 - 2 * counts[rest]
            join[rest] = 2 * counts[rest] + 1
    return bins


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Bins of the items by sum-of-squares, longest item first."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), dtype=np.int64)
    bins[order] = sum_of_squares(lengths[order], capacity)
    return bins


_PIECES = pa.schema([("number", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _tokenize(capacity: int, end_id: int, ranks_path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(token_ids(text.as_py(), ranks_path), end_id).astype("<u4")
                for k, (a, n) in enumerate(cuts(len(ids), capacity)):
                    out.append((number, doc_id, k, a, n, zlib.crc32(ids[a : a + n].tobytes())))
                    number += 1
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECES, strict=True)], schema=_PIECES)

    return run


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, ranks_path: str | None = None) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(_tokenize(capacity, end_id, ranks_path), "number long, doc_id long, piece int, start long, length long, ids_crc32 long")


def _shard(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("number")  # the same order whatever order the rows came in
        lengths = table["length"].to_numpy()
        bins = pack_lengths(lengths, capacity)
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.concatenate(([True], bins[order][1:] != bins[order][:-1]))
        offset = np.empty(len(bins), dtype=np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        shard = table["shard"].to_numpy()
        made = table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        return made.append_column("sequence_id", pa.array((shard << 32) + bins)).append_column("offset", pa.array(offset))

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, shard_items: int = SHARD_ITEMS, ranks_path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    made = saved(pieces(docs, id_col, text_col, capacity, end_id, ranks_path), "pieces")
    part = made.filter(F.col("length") < capacity)
    shards = max(1, -(-part.count() // shard_items))
    packed = part.withColumn("shard", F.pmod(F.xxhash64("number"), F.lit(shards)).cast("long")).groupBy("shard").applyInArrow(_shard(capacity), _PACKED)
    whole = made.filter(F.col("length") == capacity).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.lit(1 << 60)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(packed)


def _windows(capacity: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows of a shard come sorted by position
        shard, made, held, rows = TaskContext.get().partitionId() << 32, 0, [], 0

        def out(table: pa.Table) -> pa.RecordBatch:
            nonlocal made
            lengths = table["length"].to_numpy()
            bins = np.empty(len(lengths), dtype=np.int64)
            short = lengths < capacity
            bins[short] = pack_lengths(lengths[short], capacity)
            bins[~short] = len(lengths) * 2 + np.arange(int((~short).sum()))
            _, bins = np.unique(bins, return_inverse=True)
            # number sequences by the mean position of their tokens
            mean = np.bincount(bins, weights=lengths * np.arange(len(bins))) / np.bincount(bins, weights=lengths)
            rank = np.empty(len(mean), dtype=np.int64)
            rank[np.argsort(mean, kind="stable")] = np.arange(len(mean))
            bins = rank[bins]
            order = np.argsort(bins, kind="stable")
            before = np.cumsum(lengths[order]) - lengths[order]
            first = np.concatenate(([True], bins[order][1:] != bins[order][:-1]))
            offset = np.empty(len(bins), dtype=np.int64)
            offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
            ids = pa.array(shard + made + bins)
            made += len(mean)
            columns = [table[c].combine_chunks() for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            return pa.RecordBatch.from_arrays([*columns, ids, pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

        for batch in batches:
            held.append(batch)
            rows += len(batch)
            while rows >= 2 * window:  # the last window has at least ``window`` pieces, if the shard has
                table = pa.Table.from_batches(held)
                yield out(table.slice(0, window))
                held, rows = table.slice(window).to_batches(), rows - window
        if rows:
            yield out(pa.Table.from_batches(held))

    return run


def pack_in_order(placed: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, shard_items: int = SHARD_ITEMS, ranks_path: str | None = None, window: int = WINDOW_ITEMS) -> DataFrame:
    """As ``pack``, for rows of ``mixing.mix``: sequences in the order of their ids are the mixture.

    A piece has the slot of its document plus the slots of its source's blocks that lie before it
    in the document, so long documents are dealt out at the rate of their source.
    """
    at = F.struct("slot", "block_offset", "size", "step", "block_chars")
    rows = placed.select(F.col(f"row.{id_col}").cast("long").alias("doc_id"), F.coalesce(F.col(f"row.{text_col}"), F.lit("")).alias("text"), at.alias("at"))
    made = saved(rows.mapInArrow(_tokenize_placed(capacity, end_id, ranks_path), "pos long, part long, doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    shards = max(1, -(-made.count() // shard_items))
    dealt = made.repartitionByRange(shards, "pos", "part", "doc_id", "piece").sortWithinPartitions("pos", "part", "doc_id", "piece")
    return dealt.mapInArrow(_windows(capacity, window), _PACKED)


def _tokenize_placed(capacity: int, end_id: int, ranks_path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, at in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                ids = np.append(token_ids(text.as_py(), ranks_path), end_id).astype("<u4")
                period, w = at["step"]["period"], at["step"]["w"]
                for k, (a, n) in enumerate(cuts(len(ids), capacity)):
                    blocks, part = divmod(at["block_offset"] + at["size"] * a // len(ids), at["block_chars"])
                    out.append((at["slot"] + blocks * period // w, part, doc_id, k, a, n, zlib.crc32(ids[a : a + n].tobytes())))
            columns = list(zip(*out, strict=True)) if out else [[]] * 7
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["pos", "part", "doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run
