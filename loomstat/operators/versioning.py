"""Immutable observation logs: latest-wins views, idempotent appends, upserts, events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the order given (newest first). Spark limits each task to one row a key before the shuffle."""
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("__rank = 1").drop("__rank")


def distinct_last(rows: DataFrame, keys: list[str], position: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """One row per key, the last by position; of rows in one position the first by ``ties``."""
    return latest_by(rows, keys, [F.desc(position), *[F.asc(c) for c in ties]])


def append_new(known: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows to append: those whose key is not known yet, one per key. Appending them twice changes nothing."""
    return one_per_key(rows, keys).join(known.select(*keys), keys, "left_anti")


def one_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A row per key; of several the one that sorts first as JSON, whatever order they come in."""
    rest = F.struct(*[c for c in rows.columns if c not in keys])
    if len(keys) == len(rows.columns):
        return rows.distinct()
    picked = rows.groupBy(*keys).agg(F.min_by(rest, F.to_json(rest, {"ignoreNullFields": "false"})).alias("__rest"))
    return picked.select(*[F.col(c) if c in keys else F.col("__rest")[c].alias(c) for c in rows.columns])


def upsert(known: DataFrame, rows: DataFrame, keys: list[str], seen: str, keep_old: tuple[str, ...] = ()) -> DataFrame:
    """Newest values per key; the first ``seen`` instant stays, and columns in ``keep_old`` keep their value where the new one is null."""
    both = known.withColumn("__new", F.lit(0)).unionByName(rows.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    values = [c for c in known.columns if c not in keys and c != seen]
    newest = F.struct("__new", seen)
    picked = [F.max_by(c, F.when(F.col(c).isNotNull(), newest)).alias(c) if c in keep_old else F.max_by(c, newest).alias(c) for c in values]
    return both.groupBy(*keys).agg(F.min(seen).alias(seen), *picked).select(*known.columns)


def with_columns_of(rows: DataFrame, like: DataFrame) -> DataFrame:
    """Schema upgrade: the columns of ``like``, missing ones null."""
    return like.limit(0).unionByName(rows, allowMissingColumns=True).select(*like.columns)


def current_status(events: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Requests with their last recorded status."""
    return latest_by(events, keys, order)


def status_counts(events: DataFrame, keys: list[str], order: list[Column], by: list[str]) -> DataFrame:
    return current_status(events, keys, order).groupBy(*by).agg(F.count("*").alias("requests"))


def with_precedence(base: DataFrame, versions: list[tuple[str, DataFrame]], key: str, columns: list[str]) -> DataFrame:
    """``base`` with each of ``columns`` from the first of ``versions`` (name, one row per key) that has it, else its own."""
    made = base
    for name, df in versions:
        there = [c for c in columns if c in df.columns]
        made = made.join(df.select(key, *[F.col(c).alias(f"__{name}_{c}") for c in there]), key, "left")
    picked = [F.coalesce(*[F.col(f"__{name}_{c}") for name, df in versions if c in df.columns], *([F.col(c)] if c in base.columns else [F.lit(None)])).alias(c) for c in columns]
    return made.select(*[c for c in base.columns if c not in columns], *picked)
