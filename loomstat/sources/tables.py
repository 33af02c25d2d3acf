"""Readers of CSV exports, geography tables and staged page archives, with their gates."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import geo_ref, location_parts
from ..operators.quality import SnapshotIntegrityError

GEOGRAPHY_COLUMNS = ("division_code", "division_name_en", "division_name_bn", "district_code", "district_name_en", "district_name_bn", "upazila_code", "upazila_name_en", "upazila_name_bn")
BULK_COLUMNS = ("dife_public_id", "name", "sector", "location", "upazila", "district", "division", "licence_class", "status")


class IngestError(SnapshotIntegrityError):
    """A staged source can't be taken in."""


def read_csv(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """A CSV with a header that has all ``columns``; trimmed strings, blanks as null. A BOM is no part of the first name."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("inferSchema", False).csv(path)
    rows = rows.toDF(*[c.removeprefix("﻿").strip() for c in rows.columns])
    if lacking := [c for c in columns if c not in rows.columns]:
        raise IngestError(f"the header lacks {', '.join(lacking)}")
    return rows.select(*[F.nullif(F.trim(c), F.lit("")).alias(c) for c in columns])


def geography_units(spark: SparkSession, path: str) -> DataFrame:
    """Units of all three levels from a table with a row per upazila (or district); the first row of a unit wins."""
    rows = read_csv(spark, path, GEOGRAPHY_COLUMNS).withColumn("line", F.monotonically_increasing_id())
    has = lambda kind: F.col(f"{kind}_code").isNotNull() | F.col(f"{kind}_name_en").isNotNull() | F.col(f"{kind}_name_bn").isNotNull()
    whole = lambda kind: F.col(f"{kind}_code").isNotNull() & F.coalesce(f"{kind}_name_en", f"{kind}_name_bn").isNotNull()
    bad = ~whole("division") | (has("district") & ~whole("district")) | (has("upazila") & ~(whole("upazila") & whole("district")))
    if first := rows.filter(bad).orderBy("line").first():
        raise IngestError(f"incomplete unit in the row {first.asDict()}")
    made = None
    for level, kinds in (("DIVISION", ("division",)), ("DISTRICT", ("division", "district")), ("UPAZILA", ("division", "district", "upazila"))):
        part = rows.filter(whole(kinds[-1])).withColumns({"level": F.lit(level), "geo_ref": geo_ref(level, *[F.col(f"{k}_code") for k in kinds])})
        part = part.withColumn("n", F.row_number().over(Window.partitionBy("geo_ref").orderBy("line"))).filter("n = 1")
        part = part.select("geo_ref", "level", *[(F.col(c) if c.split("_")[0] in kinds else F.lit(None).cast("string")).alias(c) for c in GEOGRAPHY_COLUMNS])
        made = part if made is None else made.unionByName(part)
    return made


def bulk_registry(spark: SparkSession, path: str) -> DataFrame:
    """A bulk export: positive ids, names, and places (from the location where columns are blank)."""
    rows = read_csv(spark, path, BULK_COLUMNS).withColumn("id", F.col("dife_public_id").try_cast("long"))
    if first := rows.filter(F.col("id").isNull() | (F.col("id") <= 0) | F.col("name").isNull()).first():
        raise IngestError(f"a row without a positive id or a name: {first.asDict()}")
    place = location_parts(F.col("location"))
    return rows.select("id", "name", F.col("sector").alias("sector_label"), "location", *[F.coalesce(c, place[c]).alias(c) for c in ("upazila", "district", "division")], "licence_class", "status")


def checked_bulk(rows: DataFrame, declared_total: int) -> DataFrame:
    """The export, if it has as many rows and distinct ids as its source declares."""
    n, ids = rows.agg(F.count("*"), F.countDistinct("id")).first()
    if not n == ids == declared_total:
        raise IngestError(f"{n} rows, {ids} ids, declared {declared_total}")
    return rows


def archive_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Pages of a staged archive (page, file, retrieved_at, sha256), after checks of the manifest."""
    schema = "format_version string, universe_label string, seed_url string, page_size int, created_at string, pages array<struct<page:int,file:string,retrieved_at:string,sha256:string>>"
    head = spark.read.schema(schema).json(path, multiLine=True)
    pages = head.select("*", F.explode("pages").alias("p")).select("format_version", "universe_label", "seed_url", "page_size", "p.*")
    versions = [r[0] for r in head.select("format_version").distinct().limit(2).collect()]
    if versions != ["1.0"]:
        raise IngestError(f"unsupported manifest: {versions}")
    found = pages.agg(F.count("*").alias("n"), F.countDistinct("page").alias("d"), F.min("page").alias("first"), F.count_if(F.trim(F.coalesce("file", F.lit(""))) == "").alias("blank")).first()
    if not found["n"] or found["n"] != found["d"] or found["first"] != 1 or found["blank"]:
        raise IngestError("pages of a manifest are unique, begin with 1 and name a file")
    unsafe = F.col("file").rlike(r"(^|[/\\])\.\.([/\\]|$)") | F.startswith("file", F.lit("/")) | F.col("file").contains(":")
    if pages.filter(unsafe).count():
        raise IngestError("a file lies outside the archive")
    return pages


def archive_pages(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(page, file, retrieved_at, html, content_sha256) of the archive; contents must agree with the digests given."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    base = posixpath.normpath(folder.removeprefix("file://"))
    files = files.select(F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), f"^.*{base}/", "").alias("file"), F.col("content").cast("string").alias("html"), F.sha2("content", 256).alias("content_sha256"))
    made = manifest.select("page", "file", "retrieved_at", "sha256").join(files, "file", "left")
    if bad := made.filter(F.col("html").isNull() | (F.col("sha256").isNotNull() & (F.lower("sha256") != F.col("content_sha256")))).select("page").orderBy("page").first():
        raise IngestError(f"page {bad[0]} is missing or not as its digest says")
    return made.drop("sha256")


def assert_same_pages(planned: DataFrame, staged: DataFrame) -> None:
    """Both frames have the same pages, each as often."""
    lacking, extra = planned.select("page").exceptAll(staged.select("page")), staged.select("page").exceptAll(planned.select("page"))
    if found := lacking.limit(5).collect() + extra.limit(5).collect():
        raise IngestError(f"pages differ from the plan: {sorted(r[0] for r in found)}")


def ingest_archive(spark: SparkSession, folder: str, manifest_name: str = "manifest.json") -> tuple[DataFrame, DataFrame, int]:
    """(pages with status, members, expected total) of a staged archive, its page set equal to the plan."""
    from .html import parsed

    manifest = archive_manifest(spark, f"{folder}/{manifest_name}")
    size = manifest.select("page_size").first()[0]
    pages = parsed(archive_pages(spark, folder, manifest).withColumn("url", F.lit("")), "list")
    rows = pages.select("page", "content_sha256", F.col("parsed.total_records").alias("source_reported_total"), F.explode_outer("parsed.rows").alias("r")).persist()
    totals = rows.filter("page = 1").select("source_reported_total").first()
    if not totals or not totals[0]:
        raise IngestError("page 1 reports no total")
    total = int(totals[0])
    plan = spark.range(1, -(-total // size) + 1).select(F.col("id").cast("int").alias("page"))
    assert_same_pages(plan, manifest)
    staged = rows.groupBy("page").agg(F.max("source_reported_total").alias("source_reported_total")).withColumn("status", F.lit("STAGED"))
    return staged, rows.filter("r is not null").select("page", F.col("r.public_id").alias("id"), "content_sha256", "r.*"), total


def table_counts(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    made = None
    for name in names:
        part = spark.read.parquet(f"{folder}/{name}.parquet").agg(F.lit(name).alias("table"), F.count("*").alias("rows"))
        made = part if made is None else made.unionByName(part)
    return made
