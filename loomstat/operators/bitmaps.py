"""Exact distinct counts that can be added up: bitmaps over row numbers.

A bitmap stands for 32,768 numbers. Bitmaps of the finest cells are made once, before the shuffle
as far as a task has them; every coarser cell is their union. So one pass over the rows serves
counts by any combination of the cells, where a distinct count of each would expand every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmaps(rows: DataFrame, cells: list[str], number: str) -> DataFrame:
    """(cells, bucket, bits): a bitmap of the numbers of each cell; a null number is in none."""
    return rows.groupBy(*cells, F.bitmap_bucket_number(number).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def united(maps: DataFrame, cells: list[str]) -> DataFrame:
    """(cells, bucket, bits) of coarser cells."""
    return maps.groupBy(*cells, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(maps: DataFrame, cells: list[str], name: str) -> DataFrame:
    """(cells, name): how many numbers each cell has."""
    return maps.groupBy(*cells).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))
