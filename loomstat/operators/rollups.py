"""Registry rollups: counts, shares, location quotients, concentration, and the profiles made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import or_unknown, rounded

#: Column of the registry by dimension of a rollup.
DIMENSIONS = {"districts": "district", "divisions": "division", "statuses": "status", "source_sector_labels": "sector_label"}


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """Per cent; null of nothing."""
    return F.when(whole > 0, rounded(part / whole * 100.0, digits))


def composition(rows: DataFrame, column: str, by: list[str] | None = None, name: str = "share_pct") -> DataFrame:
    """Rows per label with their share in the whole (or in each group of ``by``); null and empty count as UNKNOWN."""
    by = by or []
    counted = rows.groupBy(*by, or_unknown(F.col(column)).alias("label")).agg(F.count("*").alias("establishments"))
    whole = F.sum("establishments").over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0)))  # a row per label by now
    return counted.withColumn(name, share(F.col("establishments"), whole))


def cells(rows: DataFrame) -> DataFrame:
    """District and sector family: count, shares in both, location quotient."""
    counted = rows.groupBy(or_unknown(F.col("district")).alias("district"), "sector_family").agg(F.count("*").alias("establishments"))
    n = F.col("establishments")
    district, family, total = (F.sum(n).over(Window.partitionBy(x)) for x in ("district", "sector_family", F.lit(0)))
    quotient = (n / district) / (family / total)
    return counted.withColumns({"share_of_district_pct": share(n, district), "share_of_national_sector_pct": share(n, family), "location_quotient": rounded(quotient, 4)})


def sector_concentration(rows: DataFrame) -> DataFrame:
    """Sector families: count, share, number of districts, sum of squared district shares."""
    counted = rows.groupBy("sector_family", or_unknown(F.col("district")).alias("district")).agg(F.count("*").alias("n"))
    parts = counted.withColumn("part", F.col("n") / F.sum("n").over(Window.partitionBy("sector_family")))
    made = parts.groupBy("sector_family").agg(F.sum("n").alias("establishments"), F.count("*").alias("district_count"), F.sum(F.col("part") * F.col("part")).alias("hhi"))
    return made.select("sector_family", "establishments", share(F.col("establishments"), F.sum("establishments").over(Window.partitionBy(F.lit(0)))).alias("share_national_pct"), "district_count", rounded(F.col("hhi"), 6).alias("district_hhi"))


def summary(rows: DataFrame) -> DataFrame:
    """One row of totals and the coverage of the sector rules."""
    mapped = F.count_if(F.col("sector_family") != "UNCLASSIFIED")
    return rows.agg(
        F.count("*").alias("establishments"), F.countDistinct(or_unknown(F.col("district"))).alias("districts"), F.countDistinct(or_unknown(F.col("division"))).alias("divisions"),
        F.countDistinct(or_unknown(F.col("sector_label"))).alias("source_sector_labels"), mapped.alias("mapped_sector_family_records"),
        (F.count("*") - mapped).alias("unclassified_sector_records"), share(mapped, F.count("*")).alias("sector_mapping_coverage_pct"),
    )


def top_share(counted: DataFrame, by: list[str], n: int, name: str) -> DataFrame:
    """Share of the n largest counts of each group."""
    ranked = counted.withColumn("__k", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("establishments"))))
    return ranked.groupBy(*by).agg(share(F.sum(F.when(F.col("__k") <= n, F.col("establishments")).otherwise(0)), F.sum("establishments")).alias(name))


def specialization(quotient: Column) -> Column:
    return F.when(quotient.isNull(), "NOT_AVAILABLE").when(quotient > 1, "ABOVE_NATIONAL_SHARE").when(quotient == 1, "EQUAL_TO_NATIONAL_SHARE").otherwise("BELOW_NATIONAL_SHARE")


def concentration(rows: DataFrame, by: str, of: str) -> DataFrame:
    """For every value of ``by``: shares of the 3 and 5 largest ``of`` and how many stand above the national share."""
    cell = cells(rows)
    top = top_share(cell, [by], 3, "largest_3_share_pct").join(top_share(cell, [by], 5, "largest_5_share_pct"), by)
    return top.join(cell.groupBy(by).agg(F.count("*").alias(f"{of}_count"), F.count_if(F.col("location_quotient") > 1).alias("location_quotient_above_1")), by)


def registry_rows(rows: DataFrame, universe_label: str, generated_at: str, prefix: str = "DIFE") -> DataFrame:
    """The public row of each establishment; fails on a repeated id."""
    repeated = F.when(F.count("*").over(Window.partitionBy("id")) > 1, F.raise_error(F.lit("repeated public id")).cast("string"))
    return rows.select(
        F.lit("1.0").alias("schema_version"), F.lit(generated_at).alias("generated_at"), F.lit(universe_label).alias("universe_label"),
        F.coalesce(repeated, F.concat_ws(":", F.lit(prefix), F.col("id").cast("string"))).alias("establishment_ref"),
        *[c for c in ("name", "location", "upazila", "district", "division") if c in rows.columns], F.col("sector_label").alias("source_sector_label"), "sector_family",
        F.col("status").alias("official_status"), *[c for c in ("licence_class", "observed_at") if c in rows.columns], F.lit(prefix).alias("source"),
    )


#: What a registry row takes from its member and from the observation that the member stands on.
OBSERVED = ("name", "location", "upazila", "district", "division", "sector_label", "licence_class", "status", "observed_at")


def member_rows(members: DataFrame, observations: DataFrame, universe_label: str) -> DataFrame:
    """The members (universe_label, id, observation_id) of a universe with their observations, columns as a registry has them.

    Tables that lie in buckets of ``observation_id`` join without an exchange. A member without its observation fails.
    """
    seen = observations.select("observation_id", *[c for c in OBSERVED if c in observations.columns], F.lit(True).alias("__seen"))
    made = members.filter(F.col("universe_label") == universe_label).select("id", "observation_id").join(seen, "observation_id", "left")
    checked = F.when(F.col("__seen").isNull(), F.raise_error(F.lit("a member has no observation")).cast(made.schema["id"].dataType)).otherwise(F.col("id"))
    return made.select(checked.alias("id"), "observation_id", *[c for c in OBSERVED if c in made.columns])


def drilldown(rows: DataFrame, filters: dict[str, str | None]) -> DataFrame:
    """Rows equal to all of the filters, by name and id; no filter selects nothing."""
    if not filters:
        return rows.limit(0)
    for column, value in filters.items():
        rows = rows.filter(F.col(column).eqNullSafe(F.lit(value)))
    return rows.orderBy("name", "id")


def assert_exact_universe(rows: DataFrame, expected_total: int, kind: str, eligible: bool) -> None:
    """Profiles and dashboards speak of complete national registries only."""
    n, refs = rows.agg(F.count("*"), F.countDistinct("id")).first()
    if kind != "NATIONAL_REGISTRY" or not eligible or not n == refs == expected_total:
        raise ValueError(f"not an exact national universe: kind {kind}, eligible {eligible}, rows {n}, ids {refs}, expected {expected_total}")


def dashboard(rows: DataFrame, universe_label: str, generated_at: str, expected_total: int, ingest_mode: str = "BULK", completed_at: str | None = None) -> dict:
    """The national payload. Collects rollups only, which have a row per label or cell."""
    assert_exact_universe(rows, expected_total, "NATIONAL_REGISTRY", True)
    rows = rows.select("id", "district", "division", "sector_label", "sector_family", "status").persist()

    def listed(df: DataFrame, *order: str) -> list[dict]:
        return [r.asDict() for r in df.orderBy(F.desc("establishments"), *order).collect()]

    try:
        made = {name: listed(composition(rows, column, name="share_national_pct"), "label") for name, column in DIMENSIONS.items()}
        return {
            "schema_version": "1.0", "generated_at": generated_at,
            "universe": {
                "label": universe_label, "kind": "NATIONAL_REGISTRY", "source": "DIFE", "completed_at": completed_at, "expected_total": expected_total,
                "unique_public_ids": expected_total, "ingest_mode": ingest_mode, "eligible_for_national_analysis": True,
            },
            "summary": summary(rows).first().asDict(), **made, "sector_families": listed(sector_concentration(rows), "sector_family"),
            "district_sector_cells": listed(cells(rows), "district", "sector_family"), "method": "Descriptive counts and shares of the declared universe.",
        }
    finally:
        rows.unpersist()


def profiles(rows: DataFrame, by: str, generated_at: str) -> DataFrame:
    """All profiles of one kind (``by``: district or sector_family) in one job: a JSON payload per value.

    Rows without a district have no profile, as there is nothing to drill down to.
    """
    of = "sector_family" if by == "district" else "district"
    named = rows.filter(F.col(by).isNotNull() & (F.col(by) != ""))

    def lists(df: DataFrame, name: str, *fields: str) -> DataFrame:
        packed = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("establishments")).alias("o"), *fields))), lambda x: F.struct(x[fields[0]].alias(fields[0]), (-x["o"]).alias("establishments"), *[x[f].alias(f) for f in fields[1:]]))
        return df.groupBy(by).agg(packed.alias(name))

    cell = cells(rows).withColumn("specialization", specialization(F.col("location_quotient"))).join(named.select(by).distinct(), by, "left_semi")
    made = concentration(rows, by, of).join(lists(cell, "cells", of, "share_of_district_pct", "share_of_national_sector_pct", "location_quotient", "specialization"), by)
    for name, column in (("statuses", "status"), ("source_sector_labels", "sector_label"), *((("upazilas", "upazila"),) if by == "district" and "upazila" in rows.columns else ())):
        made = made.join(lists(composition(named, column, [by]), name, "label", "share_pct"), by)
    fields = [c for c in made.columns if c != by]
    return made.select(by, F.to_json(F.struct(F.lit("1.0").alias("schema_version"), F.lit(generated_at).alias("generated_at"), by, *fields, F.struct(F.col(by).alias(by)).alias("drilldown"))).alias("payload"))
