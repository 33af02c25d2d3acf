"""Exact deduplication by Grace hash partitioning.

Two records are equal when their texts are identical, with no change made before the
comparison; a null text counts as empty. Of equal texts the record with the largest id stays.

1. Combine: every task reads its records once into an open-addressing table that compares
   complete content, and passes on one record per distinct text with the largest id and the
   number of rows. However large a group of copies, a task passes on one record of it.
2. Partition: those records are dealt out by the hash of the content (a Spark exchange, which
   is the first level of partition files).
3. Recurse: each bucket is loaded into an open-addressing table. If its contents outgrow the
   memory bound, its records go to ``FANOUT`` spill files by the next bits of the hash, and
   each file is treated alike. Spill files are unlinked scratch files of the running task,
   like Spark's own spill; a retried task makes them anew.
4. Look up: every document joins its class by the digest of its text. Spark splits the rows
   of a hot class there, as both sides of the join are plain exchanges.

Defined cases: a null id is smaller than any id; rows that repeat an id and its text are one
group in which exactly one row is kept; an empty table gives an empty result; other columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import marshal
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: Bytes of distinct content that one table may hold.
TABLE_BYTES = 48 << 20
#: Spill files of one level, taken from so many bits of the hash.
FANOUT_BITS = 4
MAX_LEVEL = 12

Record = tuple[int, bytes, "int | None", int]  # hash, content, largest id, rows


def larger(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


class OpenTable:
    """Open addressing with linear probing; a hit needs equal hash and equal complete content."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.ids: list[int | None] = []
        self.rows: list[int] = []
        self.bytes = 0

    def __len__(self) -> int:
        return len(self.contents)

    def _grow(self) -> None:
        size = len(self.slots) * 2
        slots, mask = [-1] * size, size - 1
        for k, h in enumerate(self.hashes):
            at = h & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = k
        self.slots = slots

    def add(self, record: Record) -> None:
        h, content, doc_id, rows = record
        mask = len(self.slots) - 1
        at = h & mask
        while (k := self.slots[at]) >= 0:
            if self.hashes[k] == h and self.contents[k] == content:
                self.ids[k] = larger(self.ids[k], doc_id)
                self.rows[k] += rows
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.ids.append(doc_id)
        self.rows.append(rows)
        self.bytes += len(content) + 64
        if 2 * len(self.contents) > len(self.slots):
            self._grow()

    def records(self) -> Iterator[Record]:
        yield from zip(self.hashes, self.contents, self.ids, self.rows, strict=True)


def grace(records: Iterable[Record], limit: int = TABLE_BYTES, level: int = 0) -> Iterator[Record]:
    """One record per distinct content, with memory for ``limit`` bytes of content."""
    table, files = OpenTable(), None
    # low bits address the table, so the partitions of each level use bits from the top
    shift = 64 - FANOUT_BITS * (level + 1)
    for record in records:
        if files is None:
            table.add(record)
            if table.bytes <= limit or len(table) < 2 or level >= MAX_LEVEL:
                continue
            files = [tempfile.TemporaryFile() for _ in range(1 << FANOUT_BITS)]
            for old in table.records():
                marshal.dump(old, files[(old[0] >> shift) & ((1 << FANOUT_BITS) - 1)])
            table = OpenTable()
        else:
            marshal.dump(record, files[(record[0] >> shift) & ((1 << FANOUT_BITS) - 1)])
    if files is None:
        yield from table.records()
        return
    for file in files:
        with file:
            file.seek(0)
            yield from grace(_read(file), limit, level + 1)


def _read(file) -> Iterator[Record]:
    while True:
        try:
            yield marshal.load(file)
        except EOFError:
            return


_PARTIAL = pa.schema([("bucket", pa.int64()), ("content", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
_CLASSES = pa.schema([("text_sha256", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _combine(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = OpenTable()

        def out(table: OpenTable) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(table), 1000):
                b = a + 1000
                yield pa.RecordBatch.from_arrays([pa.array([_signed(h) for h in table.hashes[a:b]], pa.int64()), pa.array(table.contents[a:b], pa.binary()), pa.array(table.ids[a:b], pa.int64()), pa.array(table.rows[a:b], pa.int64())], schema=_PARTIAL)

        for batch in batches:
            ids = batch.column(1)
            for k, text in enumerate(batch.column(0)):
                content = text.as_buffer().to_pybytes()
                table.add((xxhash.xxh3_64_intdigest(content), content, ids[k].as_py(), 1))
                if table.bytes > limit:
                    yield from out(table)
                    table = OpenTable()
        yield from out(table)

    return run


def _resolve(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[Record]:
            for batch in batches:
                hashes, ids, rows = (batch.column(k).to_pylist() for k in (0, 2, 3))
                for k, content in enumerate(batch.column(1)):
                    yield hashes[k] & 0xFFFFFFFFFFFFFFFF, content.as_buffer().to_pybytes(), ids[k], rows[k]

        digests, ids, rows = [], [], []

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(digests, pa.string()), pa.array(ids, pa.int64()), pa.array(rows, pa.int64())], schema=_CLASSES)
            for x in (digests, ids, rows):
                x.clear()
            return made

        for _, content, doc_id, n in grace(records(), limit):
            digests.append(hashlib.sha256(content).hexdigest())
            ids.append(doc_id)
            rows.append(n)
            if len(ids) >= 10_000:
                yield out()
        yield out()

    return run


def equal_text_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per distinct text: text_sha256, keep_id (largest id), group_size (rows)."""
    src = docs.select(text_of(text_col).cast("binary").alias("content"), F.col(id_col).cast("long").alias("id"))
    partial = src.mapInArrow(_combine(table_bytes), "bucket long, content binary, keep_id long, group_size long")
    return partial.repartition("bucket").mapInArrow(_resolve(table_bytes), "text_sha256 string, keep_id long, group_size long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.sha2(text_of(text_col).cast("binary"), 256).alias("text_sha256"))
    rows = rows.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("copies"))
    joined = rows.join(equal_text_classes(docs, id_col, text_col, table_bytes), "text_sha256")
    return joined.select("doc_id", "keep_id", "group_size", "text_sha256", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256"
    )


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were."""
    from pyspark.sql import Window

    classes = equal_text_classes(docs, id_col, text_col, table_bytes).select(F.col("text_sha256").alias("__sha"), F.col("keep_id").alias("__keep"))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(id_col).cast("long").alias("__id"), F.sha2(text_of(text_col).cast("binary"), 256).alias("__sha"))
    # ids may be null or repeated: join on (digest, id) and keep one row of those that repeat both
    hit = named.withColumn("__key", F.coalesce(F.col("__id"), F.lit(-1))).join(classes.withColumn("__key", F.coalesce(F.col("__keep"), F.lit(-1))), ["__sha", "__key"]).filter(F.col("__id").eqNullSafe(F.col("__keep")))
    one = Window.partitionBy("__sha", "__key").orderBy("__id")
    return hit.withColumn("__n", F.row_number().over(one)).filter("__n = 1").select("__row.*")
