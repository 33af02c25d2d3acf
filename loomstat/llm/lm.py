"""Language-model scoring by deleted interpolation.

The model mixes maximum-likelihood estimates of word bigrams, word unigrams and the uniform
distribution. The weights of a mixture depend on how often the context was seen (buckets of
powers of two), and expectation-maximisation learns them on held-out counts: an eighth of the
training documents is deleted from the counts, and the weights that suit the rest's estimates
best there are kept. Scores then use the counts of all training documents with those weights.

    p(w | h) = b2 * c(h w) / c(h) + b1 * c(w) / N + b0 / (V + 1),   b = weights[bucket(c(h))]

Tokens: ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, then one end token per document. A document
begins in a context that is counted as often as there are training documents.

How it scales: vocabulary and bigrams grow with the input, so no task, driver or broadcast
holds them.

1. Documents are written as blocks of about ``BLOCK_BYTES`` of text (compressed), each of
   training, deleted or scored documents only.
2. A block asks for its distinct n-grams, as 64-bit hashes sorted and dealt by their top bits;
   its own counts travel with the request. A word or bigram, however common, is one entry a block.
3. Each range of hashes adds up the counts and answers every block with the totals in the
   order asked, which are a few bytes an n-gram; the answers are written to the shared folder.
4. Each block looks at its texts again beside its answers: blocks of deleted documents give
   the held-out counts for the mixture weights, and all blocks give scores.

Blocks and ranges have a constant size, so a task's arrays are bounded whatever the input (about
six times ``BLOCK_BYTES``). A request has a row per block and range, which is too many where both
are many: above 2^``HOP_BITS`` ranges (32 GB of text) requests go in two hops. A block then asks
coarse ranges only; groups of blocks merge what they ask a coarse range, as many blocks as there
are coarse ranges, so that a merged request is no larger than a block's own; and merged requests
go to the fine ranges. The answers come back the same way. Rows grow with the input to the power
of 1.5: 4e10 rows of about 400 keys each way at 100 TB.

The held-out counts go to the driver as a histogram over (bucket, unigram probability, bigram
probability) with ``STEPS`` steps per power of ten, whose size has a bound that doesn't depend
on the corpus. Hash collisions: with n different n-grams, one of them shares its hash with
another at odds of n / 2^64.

Defined cases: a null text is empty (one end token); null ids belong to training; rows that
repeat an id are scored each; without training tokens N = V = 0 and scores are 0; without
deleted documents fixed weights are used; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, strings, text_of

BLOCK_BYTES = 8 << 20
#: Bytes of text for one range of hashes.
RANGE_BYTES = 8 << 20
#: Up to 2^this many ranges are asked directly.
HOP_BITS = 12
STEPS = 50
BUCKETS = 64
ROUNDS = 60
DEFAULT = (0.05, 0.55, 0.40)  # uniform, unigram, bigram
TRAIN, DELETED, SCORED = 0, 1, 2
END, BEGIN = np.uint64(xxhash.xxh3_64_intdigest(b" end ")), np.uint64(xxhash.xxh3_64_intdigest(b" begin "))
NEVER = -1_000_000


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts with their end tokens, and the number of tokens of each text."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    coded = pc.dictionary_encode(words.flatten())
    names = coded.dictionary.to_pylist()
    hashes = np.array([xxhash.xxh3_64_intdigest(x) for x in names] or [0], dtype=np.uint64)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    if "" in names:  # white space at the ends of a text leaves empty words
        full = codes != names.index("")
        sizes = np.add.reduceat(np.append(full, False).astype(np.int64), np.minimum(np.cumsum(sizes) - sizes, len(full))) * (sizes > 0)
        codes = codes[full]
    out = np.empty(len(codes) + len(texts), dtype=np.uint64)
    ends = np.cumsum(sizes + 1) - 1
    word = np.ones(len(out), dtype=bool)
    word[ends] = False
    out[word] = hashes[codes]
    out[ends] = END
    return out, sizes + 1


def bigrams(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[np.cumsum(sizes) - sizes] = BEGIN
    h = before * np.uint64(0x9E3779B97F4A7C15) + words
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes as differences, byte by byte, so that the high zero bytes compress."""
    return np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1), dtype=np.uint64)


_BLOCKS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("text_bytes", pa.int64()), ("payload", pa.binary())])


def _to_blocks(batches: Iterator[pa.RecordBatch], block_bytes: float) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    held: dict[int, tuple[list, list]] = {k: ([], []) for k in (TRAIN, DELETED, SCORED)}
    size = dict.fromkeys(held, 0)

    def out(kind: int) -> pa.RecordBatch:
        nonlocal number
        rows = pa.record_batch([pa.array(held[kind][0], pa.int64()), pa.array(held[kind][1], pa.large_string())], names=["doc_id", "text"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(rows)
        made = pa.RecordBatch.from_arrays([pa.array([number]), pa.array([kind], pa.int32()), pa.array([size[kind]]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], schema=_BLOCKS)
        number += 1
        held[kind], size[kind] = ([], []), 0
        return made

    for batch in batches:
        for doc_id, kind, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            text = text.as_py()
            held[kind][0].append(doc_id)
            held[kind][1].append(text)
            size[kind] += len(text) + 1
            if size[kind] >= block_bytes:
                yield out(kind)
    for kind in held:
        if held[kind][0]:
            yield out(kind)


def _rows(payload: bytes) -> tuple[pa.Array, list[str]]:
    with pa.ipc.open_stream(payload) as stream:
        batch = stream.read_next_batch()
    return batch.column(0), strings(batch.column(1))


_ASKED = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("u_keys", pa.binary()), ("u_counts", pa.binary()), ("b_keys", pa.binary()), ("b_counts", pa.binary())])


def _parts(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each range of the top bits begins in sorted hashes."""
    if not bits:
        return np.array([0, len(keys)])
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))


def _ask(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, kind, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                words, sizes = tokens(_rows(payload.as_buffer().to_pybytes())[1])
                asked = []
                for keys in (words, bigrams(words, sizes)):
                    own, counts = np.unique(keys, return_counts=True)
                    asked.append((own, counts.astype("<u4"), _parts(own, bits)))
                (u, u_n, u_at), (b, b_n, b_at) = asked
                out = [
                    (p, block, kind, _pack_keys(u[u_at[p] : u_at[p + 1]]), u_n[u_at[p] : u_at[p + 1]].tobytes() if kind != SCORED else b"", _pack_keys(b[b_at[p] : b_at[p + 1]]), b_n[b_at[p] : b_at[p + 1]].tobytes() if kind != SCORED else b"")
                    for p in range(1 << bits) if u_at[p + 1] > u_at[p] or b_at[p + 1] > b_at[p]
                ]
                for a in range(0, len(out), 256):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[a : a + 256], strict=True), _ASKED, strict=True)], schema=_ASKED)

    return run


_ANSWERS = "block long, part long, kind int, u_all binary, u_deleted binary, b_all binary, b_deleted binary, v long, n long, n_deleted long"
_ANSWERS_ARROW = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("kind", pa.int32()), *((x, pa.binary()) for x in ("u_all", "u_deleted", "b_all", "b_deleted")), *((x, pa.int64()) for x in ("v", "n", "n_deleted"))])


def _answer_of(table: pa.Table, width: str) -> pa.Table:
    """The totals of one range, for every row that asks; ``width`` is the type of the counts in the rows."""
    table = table.combine_chunks()
    part, kinds, blocks = table["part"][0].as_py(), table["kind"].to_pylist(), table["block"].to_pylist()
    columns: dict[str, list] = {"block": [*blocks, -1], "part": [part] * (len(blocks) + 1), "kind": [*kinds, -1]}
    for name in ("u", "b"):
        keys = [_unpack_keys(x) for x in table[f"{name}_keys"].to_pylist()]
        counts = [np.frombuffer(x, width) if k != SCORED else np.zeros(len(y), width) for x, k, y in zip(table[f"{name}_counts"].to_pylist(), kinds, keys, strict=True)]
        own, at = np.unique(np.concatenate(keys), return_inverse=True)
        every = np.bincount(at, weights=np.concatenate(counts), minlength=len(own)).astype("<i8")
        gone = np.bincount(at, weights=np.concatenate([c * (k == DELETED) for c, k in zip(counts, kinds, strict=True)]), minlength=len(own)).astype("<i8")
        ends = np.cumsum([len(x) for x in keys])
        ranges = [at[e - len(x) : e] for x, e in zip(keys, ends, strict=True)]
        columns[f"{name}_all"] = [*(every[r].tobytes() for r in ranges), None]
        columns[f"{name}_deleted"] = [*(gone[r].tobytes() if k == DELETED else b"" for r, k in zip(ranges, kinds, strict=True)), None]
        if name == "u":
            sums = (int((every > 0).sum()), int(every.sum()), int(gone.sum()))
    for name, value in zip(("v", "n", "n_deleted"), sums, strict=True):
        columns[name] = [None] * len(blocks) + [value]
    return pa.table([pa.array(columns[f.name], f.type) for f in _ANSWERS_ARROW], schema=_ANSWERS_ARROW)


def _answer(table: pa.Table) -> pa.Table:
    return _answer_of(table, "<u4")


def _answer_merged(table: pa.Table) -> pa.Table:
    return _answer_of(table, "<i8")


class _Merged:
    """What the blocks of a group ask a coarse range for, as one sorted set of keys for each kind of n-gram."""

    def __init__(self, table: pa.Table) -> None:
        self.kinds, self.keys, self.own, self.train, self.gone, self.asks_gone = table["kind"].to_pylist(), {}, {}, {}, {}, {}
        for name in ("u", "b"):
            keys = self.keys[name] = [_unpack_keys(x) for x in table[f"{name}_keys"].to_pylist()]
            own, at = np.unique(np.concatenate(keys), return_inverse=True)
            ends = np.cumsum([len(x) for x in keys])
            self.own[name] = own
            self.train[name], self.gone[name], self.asks_gone[name] = np.zeros(len(own), "<i8"), np.zeros(len(own), "<i8"), np.zeros(len(own), bool)
            for kind, data, x, end in zip(self.kinds, table[f"{name}_counts"].to_pylist(), keys, ends, strict=True):
                where = at[end - len(x) : end]  # the keys of a row are distinct
                if kind != SCORED:
                    (self.train if kind == TRAIN else self.gone)[name][where] += np.frombuffer(data, "<u4")
                if kind == DELETED:
                    self.asks_gone[name][where] = True

    def wanted(self, kind: int, name: str) -> np.ndarray:
        """Which keys the merged row of a kind has: that of training asks for all, that of deleted blocks for theirs."""
        return self.asks_gone[name] if kind == DELETED else np.ones(len(self.own[name]), bool)


def _group_of(block: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(block), F.lit(1 << bits))


def _merge(coarse: int, fine: int):
    """Merged requests of a (coarse range, group), a row per fine range and kind; ``block`` is 2 x group, and 1 more for deleted ones."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        part, group, merged = table["part"][0].as_py(), table["grp"][0].as_py(), _Merged(table)
        edges = ((np.uint64(part) << np.uint64(fine)) + np.arange(1, 1 << fine, dtype=np.uint64)) << np.uint64(64 - coarse - fine)
        out = []
        for kind in (TRAIN, DELETED):
            columns = []
            for name in ("u", "b"):
                some = merged.wanted(kind, name)
                keys, counts = merged.own[name][some], (merged.gone if kind == DELETED else merged.train)[name][some]
                columns.append((keys, counts, np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))))
            (u, u_n, u_at), (b, b_n, b_at) = columns
            out += [
                ((part << fine) + f, 2 * group + (kind == DELETED), kind, _pack_keys(u[u_at[f] : u_at[f + 1]]), u_n[u_at[f] : u_at[f + 1]].tobytes(), _pack_keys(b[b_at[f] : b_at[f + 1]]), b_n[b_at[f] : b_at[f + 1]].tobytes())
                for f in range(1 << fine) if u_at[f + 1] > u_at[f] or b_at[f + 1] > b_at[f]
            ]
        columns = list(zip(*out, strict=True)) if out else [[]] * len(_ASKED)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _ASKED, strict=True)], schema=_ASKED)

    return run


def _pass_on(asked: pa.Table, answers: pa.Table) -> pa.Table:
    """The answers to a merged request, dealt to the blocks that asked."""
    asked, answers = asked.combine_chunks(), answers.sort_by("part").combine_chunks()
    merged, columns = _Merged(asked), {"block": asked["block"], "part": asked["part"], "kind": asked["kind"]}
    kinds = answers["kind"].to_pylist()

    def joined(column: str, kind: int) -> np.ndarray:
        return np.frombuffer(b"".join(x for x, k in zip(answers[column].to_pylist(), kinds, strict=True) if k == kind), "<i8")

    for name in ("u", "b"):
        every, gone = joined(f"{name}_all", TRAIN), np.zeros(len(merged.own[name]), "<i8")
        gone[merged.asks_gone[name]] = joined(f"{name}_deleted", DELETED)
        at = [np.searchsorted(merged.own[name], x) for x in merged.keys[name]]
        columns[f"{name}_all"] = pa.array([every[x].tobytes() for x in at], pa.binary())
        columns[f"{name}_deleted"] = pa.array([gone[x].tobytes() if k == DELETED else b"" for x, k in zip(at, merged.kinds, strict=True)], pa.binary())
    none = pa.nulls(asked.num_rows, pa.int64())
    return pa.table([columns.get(f.name, none) for f in _ANSWERS_ARROW], schema=_ANSWERS_ARROW)


def _answered(asking: DataFrame, ask, bits: int) -> tuple[DataFrame, DataFrame]:
    """(answers to the blocks, rows of sums) for blocks ``asking`` (block, kind, payload), in one hop or in two."""
    schema = "part long, block long, kind int, u_keys binary, u_counts binary, b_keys binary, b_counts binary"
    if bits <= HOP_BITS:
        answers = saved(asking.mapInArrow(ask(bits), schema).groupBy("part").applyInArrow(_answer, _ANSWERS), "lm-answers")
        return answers.filter("block >= 0"), answers.filter("block = -1")
    coarse = -(-bits // 2)
    fine = bits - coarse
    asked = asking.mapInArrow(ask(coarse), schema).withColumn("grp", _group_of(F.col("block"), fine))
    requests = asked.groupBy("part", "grp").applyInArrow(_merge(coarse, fine), schema)
    far = saved(requests.groupBy("part").applyInArrow(_answer_merged, _ANSWERS), "lm-far-answers")
    back = far.filter("block >= 0").withColumns({"grp": F.shiftright("block", 1), "to": F.shiftright("part", fine)})
    dealt = asked.groupBy("part", "grp").cogroup(back.groupBy("to", "grp")).applyInArrow(_pass_on, _ANSWERS)
    return saved(dealt, "lm-answers"), far.filter("block = -1")


class _Block:
    """A block's tokens with their counts."""

    def __init__(self, rows: pa.Table, answers: pa.Table, deleted: bool = False) -> None:
        self.ids, texts = _rows(rows["payload"][0].as_py())
        words, self.sizes = tokens(texts)
        answers = answers.sort_by("part")

        def counts(keys: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray]:
            own, at = np.unique(keys, return_inverse=True)
            every = np.frombuffer(b"".join(answers[f"{name}_all"].to_pylist()), "<i8")
            if deleted:
                every = every - np.frombuffer(b"".join(answers[f"{name}_deleted"].to_pylist()), "<i8")
            assert len(every) == len(own)
            return every[at], every[own == END]

        self.word, ends = counts(words, "u")
        self.first = np.cumsum(self.sizes) - self.sizes
        self.context = np.empty_like(self.word)
        self.context[1:] = self.word[:-1]
        self.context[self.first] = ends[0]  # as many beginnings as ends
        self.pair, _ = counts(bigrams(words, self.sizes), "b")

    def bucket(self) -> np.ndarray:
        return np.frexp(self.context.astype(np.float64))[1]


def _held_out(n: int):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        x = _Block(rows, answers, deleted=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            p1 = np.where(x.word > 0, np.round(np.log10(x.word / max(n, 1)) * STEPS), NEVER).astype(np.int64)
            p2 = np.where((x.pair > 0) & (x.context > 0), np.round(np.log10(x.pair / np.maximum(x.context, 1)) * STEPS), NEVER).astype(np.int64)
        own, counts = np.unique(np.stack([x.bucket(), p1, p2]), axis=1, return_counts=True) if len(p1) else (np.empty((3, 0), np.int64), np.empty(0, np.int64))
        return pa.table({"bucket": own[0].astype(np.int64), "p1": own[1], "p2": own[2], "n": counts.astype(np.int64)})

    return run


def mixture_weights(rows: list[tuple[int, int, int, int]], v: int) -> np.ndarray:
    """EM on the histogram of held-out tokens: weights (uniform, unigram, bigram) by bucket."""
    out = np.tile(np.array(DEFAULT), (BUCKETS + 2, 1))
    if rows:
        bucket, p1, p2, n = (np.array(x, dtype=np.int64) for x in zip(*rows, strict=True))
        p = np.stack([np.full(len(n), 1 / (v + 1)), np.where(p1 == NEVER, 0, 10.0 ** (np.maximum(p1, -40 * STEPS) / STEPS)), np.where(p2 == NEVER, 0, 10.0 ** (np.maximum(p2, -40 * STEPS) / STEPS))], axis=1)

        def fit(p: np.ndarray, n: np.ndarray, start: np.ndarray) -> np.ndarray:
            w = start
            for _ in range(ROUNDS):
                share = w * p
                share *= (n / np.maximum(share.sum(axis=1), 1e-300))[:, None]
                w = share.sum(axis=0) + start  # the start counts as one token, so no weight is zero
                w = w / w.sum()
            return w

        pooled = fit(p, n, np.full(3, 1 / 3))
        for k in range(len(out)):
            mine = bucket == k
            out[k] = fit(p[mine], n[mine], pooled) if mine.any() else out[k - 1] if k and (bucket < k).any() else pooled
    # without a context there is no bigram estimate: its weight goes to the unigrams
    out[0, 1] += out[0, 2]
    out[0, 2] = 0
    return out


def _score(weights: np.ndarray, n: int, v: int):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        x = _Block(rows, answers)
        w = weights[x.bucket()]
        p = w[:, 0] / (v + 1) + w[:, 1] * x.word / max(n, 1) + w[:, 2] * x.pair / np.maximum(x.context, 1)
        if not n:
            p = np.ones(len(p))
        base = np.log10((x.word + 1) / (n + v + 1))
        sums = [np.add.reduceat(y, x.first) for y in (x.word > 0, base, np.log10(p))]
        held = rows["kind"][0].as_py() == SCORED
        return pa.table({
            "doc_id": x.ids.cast(pa.int64()), "held_out": pa.array([held] * len(x.ids)), "n_tokens": pa.array(x.sizes), "n_known": pa.array(sums[0].astype(np.int64)),
            "train_tokens": pa.array([n] * len(x.ids), pa.int64()), "base_score": pa.array(sums[1]), "score": pa.array(sums[2]),
        })

    return run


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score all rows with a model of those that ``held_out`` leaves: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    deleted = F.pmod(F.xxhash64(F.lit("deleted"), F.col(id_col).cast("string")), F.lit(8)) == 0
    kind = F.when(held_out, SCORED).when(deleted, DELETED).otherwise(TRAIN)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), kind.alias("kind"), text_of(text_col).alias("text"))
    text_bytes = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    blocks = saved(rows.mapInArrow(functools.partial(_to_blocks, block_bytes=BLOCK_BYTES), "block long, kind int, text_bytes long, payload binary"), "lm-blocks")
    bits = max(0, math.ceil(math.log2(max(1, text_bytes / RANGE_BYTES))))
    answers, sums = _answered(blocks.select("block", "kind", "payload"), _ask, bits)
    v, n, n_deleted = (x or 0 for x in sums.agg(F.sum("v"), F.sum("n"), F.sum("n_deleted")).first())
    told = answers.select("block", "part", "kind", "u_all", "u_deleted", "b_all", "b_deleted")

    def beside(kind: Column, run, schema: str) -> DataFrame:
        return blocks.filter(kind).groupBy("block").cogroup(told.filter(kind).groupBy("block")).applyInArrow(run, schema)

    held = beside(F.col("kind") == DELETED, _held_out(n - n_deleted), "bucket long, p1 long, p2 long, n long")
    histogram = held.groupBy("bucket", "p1", "p2").agg(F.sum("n").alias("n"))
    weights = mixture_weights([tuple(r) for r in histogram.collect()], v)
    return beside(F.lit(True), _score(weights, n, v), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
