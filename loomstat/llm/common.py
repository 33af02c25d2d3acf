"""Helpers shared by the operators: shared storage, hashing splits, whole-text access."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Texts of one working chunk inside a Python worker hold at most about so many characters.
CHUNK_CHARS = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset and everything runs on one machine (tests) a temporary folder is made.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="loomstat-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/loomstat-{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table made by ``saved`` that nothing will read again."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/loomstat-" in path:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % divisor, F.lit(-1)).cast("int")


def unused(df: DataFrame, name: str) -> None:
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"there is a column {name} already; give another name for the result")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores after it where ``df`` has it already."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def strings(column) -> list[str]:
    """Python strings of an Arrow column, null as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def chunks(texts: list[str], overlap: int = 0, limit: int = CHUNK_CHARS) -> Iterator[tuple[list[int], list[str]]]:
    """Deal whole texts into chunks of bounded size: (index of the text, piece) lists.

    A text longer than the limit comes in pieces that repeat ``overlap`` characters, so
    that every window of ``overlap + 1`` characters is in exactly one piece.
    """
    at, parts, held = [], [], 0
    for i, text in enumerate(texts):
        for start in range(0, max(1, len(text) - overlap), limit):
            piece = text[start : start + limit + overlap] if len(text) > limit else text
            if parts and held + len(piece) > limit:
                yield at, parts
                at, parts, held = [], [], 0
            at.append(i)
            parts.append(piece)
            held += len(piece)
            if len(text) <= limit:
                break
    if parts:
        yield at, parts


def batches_of(texts: pa.Array, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of an Arrow string array with about ``limit`` bytes of text each, one row at least."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    a, held = 0, 0
    for i, n in enumerate(sizes):
        if i > a and held + n > limit:
            yield a, i
            a, held = i, 0
        held += int(n)
    if a < len(sizes):
        yield a, len(sizes)


#: Shares into which a group's rows are dealt by ``with_least``.
SHARES = 64


def with_least(rows: DataFrame, group: str, spread: Column, value: str, name: str) -> DataFrame:
    """``rows`` with the smallest ``value`` of their group as ``name``; no task takes more than a share of a large group.

    ``spread`` is hashed to deal the rows of a group to ``SHARES`` shares.
    """
    rows = rows.withColumn("__share", F.pmod(F.xxhash64(spread), F.lit(SHARES)).cast("int"))
    shares = rows.groupBy(group, "__share").agg(F.min(value).alias(name))
    shares = shares.withColumn(name, F.min(name).over(Window.partitionBy(group)))  # SHARES rows a group at most
    return rows.join(shares, [group, "__share"]).drop("__share")


def bounded_sample(rows: DataFrame, group: str, key: Column, per_group: int) -> DataFrame:
    """(group, __key): for each group the ``per_group`` smallest distinct keys (hashes of a row), for fitting classifiers.

    Rows with one key are one row, so however often ids or texts repeat, the driver gets no more
    than about half as many keys again as are wanted. The groups must be few: it reads their
    counts, then the keys under a cut that leaves that many, and picks. No task sees a whole group.
    """
    keys = rows.select(group, key.alias("__key")).filter(F.col(group).isNotNull()).distinct()
    counts = keys.groupBy(group).count().collect()
    share = {r[0]: min(1.0, 1.5 * (per_group + 100) / r[1]) for r in counts}
    schema = keys.schema
    if not share:
        return rows.sparkSession.createDataFrame([], schema)
    cut = F.create_map(*[x for k, v in share.items() for x in (F.lit(k), F.lit(v))])[F.col(group)]
    near = keys.filter(F.col("__key").cast("double") / float(1 << 63) < cut * 2 - 1)
    kept, seen = [], dict.fromkeys(share, 0)
    for name, k in sorted(near.collect(), key=lambda r: r["__key"]):
        if seen[name] < per_group:
            seen[name] += 1
            kept.append((name, k))
    return rows.sparkSession.createDataFrame(kept, schema)


def sampled_texts(rows: DataFrame, group: str, text_col: str, per_group: int, salt: str, id_col: str) -> DataFrame:
    """(group, text) of a bounded sample of the rows: distinct (group, id, text), an id may be null or repeated."""
    key = F.xxhash64(F.lit(salt), F.col(id_col).cast("string"), F.col(text_col))
    chosen = bounded_sample(rows, group, key, per_group)
    hit = rows.select(group, F.col(text_col).alias("__text"), key.alias("__key")).join(F.broadcast(chosen), [group, "__key"])  # groups x per_group rows
    return hit.groupBy(group, "__key").agg(F.first("__text").alias("__text")).select(group, "__text")  # copies of a row are one
