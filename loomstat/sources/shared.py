"""The folder that the driver and all executors share, and tables written there between two steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where it is unset and everything runs on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="loomstat-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A folder that isn't there yet."""
    return f"{shared_dir(spark)}/loomstat-{name}-{uuid.uuid4().hex}"


def saved(rows: DataFrame, name: str) -> DataFrame:
    """Write ``rows`` and read them back: cuts lineage, and what a lost executor had is read again."""
    path = new_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
