"""Sinks: JSON and JSON lines with sorted keys, after the check of private fields."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import numbered
from ..operators.quality import assert_safe

JSON_OPTIONS = {"ignoreNullFields": "false"}


def with_sorted_fields(c: Column, kind: T.DataType) -> Column:
    """A value whose structs have their fields in alphabetical order, at every depth."""
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return F.when(c.isNotNull(), F.struct(*[with_sorted_fields(c[f.name], f.dataType).alias(f.name) for f in fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: with_sorted_fields(x, kind.elementType))
    return c


def json_lines(df: DataFrame, product: bool = False) -> DataFrame:
    """One column ``value``: a compact object per row."""
    assert_safe(df, product)
    return df.select(F.to_json(with_sorted_fields(F.struct(*df.columns), df.schema), JSON_OPTIONS).alias("value"))


def write_jsonl(df: DataFrame, path: str, product: bool = False) -> None:
    json_lines(df, product).write.mode("overwrite").text(path)


def write_profiles(df: DataFrame, by: str, path: str) -> None:
    """Payload texts (columns ``by``, payload) in a folder per value."""
    df.select(F.col(by), F.col("payload").alias("value")).write.mode("overwrite").partitionBy(by).text(path)


def export_json_array(df: DataFrame, order: list[str], path: str, product: bool = False) -> None:
    """All rows as one JSON array in the order given, written by executors.

    The folder's part files, one after the other by name, are the array: a line per object, its
    comma before it. Spark's commit makes the folder whole or not at all.
    """
    assert_safe(df, product)
    valued = df.select(*order, F.to_json(with_sorted_fields(F.struct(*df.columns), df.schema), JSON_OPTIONS).alias("__value"))
    placed = numbered(valued, [*order, "__value"], "__position")
    lines = placed.select("__position", F.when(F.col("__position") == 1, F.col("__value")).otherwise(F.concat(F.lit(","), "__value")).alias("value"))
    ends = df.sparkSession.createDataFrame([(0, "["), ((1 << 63) - 1, "]")], "__position long, value string")
    lines.union(ends).repartitionByRange("__position").sortWithinPartitions("__position").select("value").write.mode("overwrite").text(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The objects of an exported array."""
    lines = spark.read.text(path).filter(~F.col("value").isin("[", "]"))
    return lines.select(F.from_json(F.regexp_replace("value", "^,", ""), schema).alias("o")).select("o.*")


def write_json_array(df: DataFrame, path: str | Path, product: bool = False) -> Path:
    """All rows as one JSON array, for small results: rows are streamed to the driver one partition at a time."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", encoding="utf-8") as file:
        file.write("[")
        for k, row in enumerate(json_lines(df, product).toLocalIterator()):
            file.write(("," if k else "") + "\n" + row["value"])
        file.write("\n]\n")
    return path


def save_json(spark: SparkSession, payload: dict, path: str) -> None:
    """A payload that is on the driver already, such as a dashboard, in whatever storage the path names."""
    text = json.dumps(payload, ensure_ascii=False, sort_keys=True, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads("".join(r[0] for r in spark.read.text(path).collect()))  # one payload


def write_json(payload: dict, path: str | Path) -> Path:
    """A payload that is on the driver already, such as a dashboard."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(payload, ensure_ascii=False, indent=2, sort_keys=True, default=str) + "\n", encoding="utf-8")
    return path
