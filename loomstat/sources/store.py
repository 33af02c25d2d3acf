"""Append-only Parquet logs under one shared folder.

A log is never changed in place: rows are added once per key, "latest" and the current version
of a label are derived when a log is read. Logs of runs lie in a folder per run, replaceable ones
in a folder per label and version, so whoever reads one run or label reads its files only. One
driver writes a log at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.audit import Audit
from ..operators.versioning import append_new

#: Columns that a log is split into folders by, where it has them.
SPLIT_BY = (("label", "version"), ("run",))
#: Runs of one append whose folders are named when known keys are looked up; beyond that all folders are read.
NAMED_FOLDERS = 200

POINTER = "label string, version string, selected_at timestamp, seq long"


class LogStore:
    """Logs by name. ``root`` is a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def read(self, name: str, schema: str) -> DataFrame:
        """The rows of a log; a log without rows is empty, columns that old files lack are null."""
        if not self.exists(name):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(self.path(name))
        return rows.select(*T._parse_datatype_string(schema).names)

    def read_all(self, name: str) -> DataFrame:
        """The rows of a log that is there, with the columns of its files; names of folders are text."""
        setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, "false")
        try:
            return self.spark.read.parquet(self.path(name))
        finally:
            self.spark.conf.set(setting, before)

    def count(self, name: str) -> int:
        """Rows of a log, from the footers of its files."""
        return self.spark.read.parquet(self.path(name)).count() if self.exists(name) else 0

    def append(self, name: str, rows: DataFrame) -> int:
        """Append; returns the number of rows added, as the job that writes counted them."""
        audit = Audit()
        self.write(name, audit.on(rows, added=F.count("*")))
        return audit.counts()["added"] or 0

    def write(self, name: str, rows: DataFrame) -> None:
        """Append, in folders by run, or by label and version."""
        split = next((by for by in SPLIT_BY if set(by) <= set(rows.columns)), ())
        if split and set(rows.columns) == set(split):  # a log of runs only has no other column for its files
            split = ()
        rows.write.mode("append").partitionBy(*split).parquet(self.path(name))

    def append_new(self, name: str, rows: DataFrame, keys: list[str]) -> int:
        """Append the rows whose key the log lacks, one per key; repeating it adds none."""
        if not self.exists(name):
            return self.append(name, append_new(rows.limit(0), rows, keys))
        known = self.read_all(name)
        if "run" in keys:  # look into the folders of these runs only
            runs = [r[0] for r in rows.select("run").distinct().limit(NAMED_FOLDERS + 1).collect()]
            if len(runs) <= NAMED_FOLDERS and None not in runs:
                known = known.filter(F.col("run").isin(runs))
        return self.append(name, append_new(known, rows, keys))

    def replace(self, name: str, label: str, rows: DataFrame, at: str, seq: int) -> int:
        """Make ``rows`` the current version of ``label``: they are written whole before the pointer moves to them."""
        version = uuid.uuid4().hex
        made = rows.withColumn("label", F.lit(label)).withColumn("version", F.lit(version))
        n = self.append(name, made)
        pointer = self.spark.createDataFrame([(label, version, seq)], "label string, version string, seq long").select("label", "version", F.lit(at).cast("timestamp").alias("selected_at"), "seq")
        pointer.coalesce(1).write.mode("append").parquet(self.path(f"{name}_current"))
        return n

    def overwrite(self, name: str, rows: DataFrame, by: str) -> None:
        """Put ``rows`` in the place of all folders of ``by`` that they have rows for; other folders stay.

        The rows are worked out and written whole before Spark puts them in place, so a plan that
        fails leaves everything as it was. For derived tables, which can be made again.
        """
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(self.path(name))

    def current(self, name: str, label: str, schema: str) -> DataFrame:
        """The current version of a label."""
        found = self.read(f"{name}_current", POINTER).filter(F.col("label") == label).orderBy(F.desc("seq")).first()
        rows = self.read(name, f"{schema}, label string, version string")
        return rows.filter((F.col("label") == label) & (F.col("version") == (found["version"] if found else ""))).drop("label", "version")


def last_known(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Per key, the newest value of each other column that isn't null."""
    return rows.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in rows.columns if c not in keys])
