"""The domain's relations over the tables at hand, in DataFrames and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import by_rules

#: Stand-in for the sector rules: segments of customers by family; FURNITURE has no rule.
SEGMENT_RULES = (
    ("RMG_TEXTILE", 100, ("household",)), ("ENGINEERING_MATERIALS", 80, ("automobile",)), ("ELECTRICAL_ELECTRONICS", 60, ("machinery",)), ("OTHER_MANUFACTURING", 60, ("building",)),
)
REGION_RULES = (("CORE", 90, ("asia",)), ("WEST", 70, ("america", "europe")), ("OTHER", 40, ()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name, district, division, upazila, sector_label, sector_family, status. Nations and regions have a fixed number of rows."""
    customer, nation, region = (table(spark, sf_dir, x) for x in ("customer", "nation", "region"))
    rows = customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("n_name").alias("district"), F.col("r_name").alias("division"),
        F.concat(F.lit("U"), (F.col("c_custkey") % 4).cast("string")).alias("upazila"), F.col("c_mktsegment").alias("sector_label"),
        by_rules(F.col("c_mktsegment"), SEGMENT_RULES, "UNCLASSIFIED").alias("sector_family"), F.when(F.col("c_acctbal") < 0, "SUSPENDED").otherwise("ACTIVE").alias("status"),
    )


FAMILY_SQL = "CASE WHEN lower({0}) LIKE '%household%' THEN 'RMG_TEXTILE' WHEN lower({0}) LIKE '%automobile%' THEN 'ENGINEERING_MATERIALS' WHEN lower({0}) LIKE '%machinery%' THEN 'ELECTRICAL_ELECTRONICS' WHEN lower({0}) LIKE '%building%' THEN 'OTHER_MANUFACTURING' ELSE '{1}' END"
REGISTRY_SQL = f"""registry AS (SELECT c_custkey AS id, c_name AS name, n_name AS district, r_name AS division, 'U' || (c_custkey % 4) AS upazila, c_mktsegment AS sector_label,
  {FAMILY_SQL.format("c_mktsegment", "UNCLASSIFIED")} AS sector_family, CASE WHEN c_acctbal < 0 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS status
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def sql_round(x: str, digits: int = 4) -> str:
    return f"floor(({x}) * {float(10**digits)} + 0.5) / {float(10**digits)}"
