"""Incremental ingest of a landing folder: bounded, restartable batches, each observation staged once.

Late and repeated arrivals need no watermark: observations are versions, known ones are left
out by their content hash, and "latest" is derived when it is read. ``ingest_once`` remembers the
hashes it has seen in a state store; ``ingest`` looks them up in the log, for logs that others
write to, too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.versioning import append_new


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def stage_batch(batch: DataFrame, path: str, keys: list[str]) -> None:
    """Append what the log at ``path`` lacks. A repeated batch appends nothing."""
    spark = batch.sparkSession
    known = spark.read.parquet(path) if _exists(spark, path) else batch.limit(0)
    append_new(known, batch, keys).write.mode("append").parquet(path)


def ingest(spark: SparkSession, landing: str, schema, log: str, checkpoint: str, keys: list[str], max_files: int = 50, file_format: str = "parquet") -> int:
    """Take in all files that have arrived, at most ``max_files`` a batch, then stop. Returns the number of batches."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(file_format).load(landing)
    query = stream.writeStream.foreachBatch(lambda batch, _: stage_batch(batch, log, keys)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(1 for p in query.recentProgress if p["numInputRows"])


STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def ingest_once(spark: SparkSession, landing: str, schema, log: str, checkpoint: str, keys: list[str], max_files: int = 50, file_format: str = "parquet") -> int:
    """Take in all files that have arrived, each key exactly once over all runs of ``checkpoint``. Returns the rows written.

    The keys seen are state, a key per observation (name a digest), kept by RocksDB on the
    executors' disks, dealt out by hash and saved with every batch; a batch reads its own files
    only, never the log. The file sink's own log makes a batch that is run again write nothing more.
    """
    before = spark.conf.get(STATE_STORE[0], None)
    spark.conf.set(*STATE_STORE)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(file_format).load(landing)
        once = stream.dropDuplicates(keys)
        query = once.writeStream.format("parquet").option("path", log).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE[0])
        else:
            spark.conf.set(STATE_STORE[0], before)
    return sum(s["numRowsUpdated"] for p in query.recentProgress for s in p["stateOperators"])


def latest(spark: SparkSession, log: str, keys: list[str], order: list) -> DataFrame:
    from ..operators.versioning import latest_by

    return latest_by(spark.read.parquet(log), keys, order)


def with_hash(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumn("content_sha256", F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256))
