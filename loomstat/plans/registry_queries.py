"""Queries on rollups, profiles, versions and text expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import rollups as R
from ..operators import versioning as V
from .domain import REGISTRY_SQL, registry, sql_round, table
from .registry import query

W = f"WITH {REGISTRY_SQL} "
SHARE = sql_round("n / sum(n) OVER () * 100.0")
CELLS = f"""cells AS (SELECT district, sector_family, count(*) AS n FROM registry GROUP BY ALL),
c AS (SELECT district, sector_family, n AS establishments, {sql_round("n / sum(n) OVER (PARTITION BY district) * 100.0")} AS share_of_district_pct,
  {sql_round("n / sum(n) OVER (PARTITION BY sector_family) * 100.0")} AS share_of_national_sector_pct,
  {sql_round("(n / sum(n) OVER (PARTITION BY district)) / (sum(n) OVER (PARTITION BY sector_family) / sum(n) OVER ())")} AS location_quotient FROM cells)"""


@query("location_quotient", W + f", {CELLS} SELECT * FROM c")
def location_quotient(spark, sf_dir):
    return R.cells(registry(spark, sf_dir))


def _composition(name, column):
    @query(name, W + f"SELECT label, n AS establishments, {SHARE} AS share_national_pct FROM (SELECT {column} AS label, count(*) AS n FROM registry GROUP BY ALL)")
    def run(spark, sf_dir):
        return R.composition(registry(spark, sf_dir), column, name="share_national_pct")


_composition("rollup_district", "district")
_composition("rollup_division", "division")
_composition("rollup_status", "status")
_composition("rollup_source_sector", "sector_label")


@query("rollup_sector_hhi", W + f"""SELECT sector_family, sum(n)::BIGINT AS establishments, {sql_round("sum(n) / sum(sum(n)) OVER () * 100.0")} AS share_national_pct, count(*) AS district_count,
  {sql_round("sum(p * p)", 6)} AS district_hhi
  FROM (SELECT *, n / sum(n) OVER (PARTITION BY sector_family) AS p FROM (SELECT sector_family, district, count(*) AS n FROM registry GROUP BY ALL)) GROUP BY ALL""")
def rollup_sector_hhi(spark, sf_dir):
    return R.sector_concentration(registry(spark, sf_dir))


@query("universe_summary", W + f"""SELECT count(*) AS establishments, count(DISTINCT district) AS districts, count(DISTINCT division) AS divisions, count(DISTINCT sector_label) AS source_sector_labels,
  count(*) FILTER (WHERE sector_family <> 'UNCLASSIFIED') AS mapped_sector_family_records, count(*) FILTER (WHERE sector_family = 'UNCLASSIFIED') AS unclassified_sector_records,
  {sql_round("count(*) FILTER (WHERE sector_family <> 'UNCLASSIFIED') / count(*) * 100.0")} AS sector_mapping_coverage_pct FROM registry""")
def universe_summary(spark, sf_dir):
    return R.summary(registry(spark, sf_dir))


@query("district_status_composition", W + f"""SELECT district, label, n AS establishments, {sql_round("n / sum(n) OVER (PARTITION BY district) * 100.0")} AS share_pct
  FROM (SELECT district, status AS label, count(*) AS n FROM registry GROUP BY ALL)""")
def district_status_composition(spark, sf_dir):
    return R.composition(registry(spark, sf_dir), "status", ["district"])


@query("district_upazila_composition", W + f"""SELECT district, label, n AS establishments, {sql_round("n / sum(n) OVER (PARTITION BY district) * 100.0")} AS share_pct
  FROM (SELECT district, upazila AS label, count(*) AS n FROM registry GROUP BY ALL)""")
def district_upazila_composition(spark, sf_dir):
    return R.composition(registry(spark, sf_dir), "upazila", ["district"])


def _concentration(name, by, of):
    @query(name, W + f""", {CELLS}, r AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY establishments DESC) AS k FROM c)
      SELECT {by}, {sql_round("sum(establishments) FILTER (WHERE k <= 3) / sum(establishments) * 100.0")} AS largest_3_share_pct,
      {sql_round("sum(establishments) FILTER (WHERE k <= 5) / sum(establishments) * 100.0")} AS largest_5_share_pct, count(*) AS {of}_count,
      count(*) FILTER (WHERE location_quotient > 1) AS location_quotient_above_1 FROM r GROUP BY ALL""")
    def run(spark, sf_dir):
        return R.concentration(registry(spark, sf_dir), by, of)


_concentration("district_concentration", "district", "sector_family")
_concentration("sector_concentration", "sector_family", "district")


@query("specialization_flags", W + f""", {CELLS} SELECT district, sector_family, location_quotient,
  CASE WHEN location_quotient > 1 THEN 'ABOVE_NATIONAL_SHARE' WHEN location_quotient = 1 THEN 'EQUAL_TO_NATIONAL_SHARE' ELSE 'BELOW_NATIONAL_SHARE' END AS specialization FROM c""")
def specialization_flags(spark, sf_dir):
    return R.cells(registry(spark, sf_dir)).select("district", "sector_family", "location_quotient", R.specialization(F.col("location_quotient")).alias("specialization"))


@query("profile_drilldown", W + "SELECT * FROM registry WHERE division = 'ASIA' AND sector_family = 'RMG_TEXTILE' AND status = 'ACTIVE'")
def profile_drilldown(spark, sf_dir):
    return R.drilldown(registry(spark, sf_dir), {"division": "ASIA", "sector_family": "RMG_TEXTILE", "status": "ACTIVE"})


@query("registry_rows", W + """SELECT '1.0' AS schema_version, '2026-01-01T00:00:00Z' AS generated_at, 'test' AS universe_label, 'DIFE:' || id AS establishment_ref, name, upazila, district, division,
  sector_label AS source_sector_label, sector_family, status AS official_status, 'DIFE' AS source FROM registry""")
def registry_rows(spark, sf_dir):
    return R.registry_rows(registry(spark, sf_dir), "test", "2026-01-01T00:00:00Z")


@query("district_profiles")
def district_profiles(spark, sf_dir):
    return R.profiles(registry(spark, sf_dir), "district", "2026-01-01T00:00:00Z")


@query("sector_profiles")
def sector_profiles(spark, sf_dir):
    return R.profiles(registry(spark, sf_dir), "sector_family", "2026-01-01T00:00:00Z")


@query("latest_observation", "SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_observation(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return V.latest_by(rows, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])


@query("first_seen_upsert", """SELECT o_custkey AS k, min(o_orderdate) AS seen, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status FROM orders GROUP BY o_custkey""")
def first_seen_upsert(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    newest = V.latest_by(rows, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("seen"), F.col("o_orderstatus").alias("status"))
    first = rows.groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderdate").alias("seen")).withColumn("status", F.lit("?"))
    return V.upsert(first, newest, ["k"], "seen")


@query("content_hash_dedup", "SELECT sha256(text) AS content_sha256, min(doc_id) AS first_doc, count(*) AS versions FROM documents WHERE text IS NOT NULL GROUP BY 1")
def content_hash_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", X.content_hash(F.col("text")).alias("content_sha256"))
    return rows.groupBy("content_sha256").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("versions"))


@query("append_new_snapshots", "SELECT doc_id, sha256(text) AS h FROM documents d WHERE doc_id % 2 = 1 AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 2 = 0) QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id) = 1")
def append_new_snapshots(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", X.content_hash(F.col("text")).alias("h"))
    fresh = V.latest_by(rows.filter("doc_id % 2 = 1"), ["h"], [F.asc("doc_id")])
    return V.append_new(rows.filter("doc_id % 2 = 0"), fresh, ["h"]).select("doc_id", "h")


NORM = r"trim(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"


@query("normalize_text", "SELECT page_id, " + NORM.format("html") + " AS norm FROM pages")
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.normalize_text(F.col("html")).alias("norm"))


@query("company_core", "SELECT s_suppkey, array_to_string(list_filter(string_split(" + NORM.format("s_name || ' Co. Ltd.'") + ", ' '), lambda w: w NOT IN ('limited','ltd','company','co','bangladesh','industries','industry','group','plc','private','pvt')), ' ') AS core FROM supplier")
def company_core(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", X.company_core(F.concat("s_name", F.lit(" Co. Ltd."))).alias("core"))


@query("parse_int_mixed", "SELECT page_id, TRY_CAST(nullif(regexp_extract(replace(url, ',', ''), '[0-9]+'), '') AS BIGINT) AS n FROM pages")
def parse_int_mixed(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.parse_int(F.col("url")).alias("n"))


@query("url_parts", r"""SELECT page_id, nullif(regexp_extract(url, '/(?:en|de|fr|es)/(\d+)(?:[/?#]|$)', 1), '') AS key, CASE WHEN regexp_matches(url, '[?&]page=') THEN regexp_replace(url, '([?&])page=[^&#]*', '\1page=7', 'g')
  ELSE regexp_replace(url, '#.*$', '') || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'page=7' END AS seventh,
  starts_with(url, 'https://') AND regexp_matches(url, '^https://[^/]+/en/') AND regexp_matches(url, '^https://therhe\.example\.org/') AS allowed FROM pages""")
def url_parts(spark, sf_dir):
    rows = table(spark, sf_dir, "pages")
    return rows.select("page_id", X.url_key(F.col("url"), "(?:en|de|fr|es)").alias("key"), X.set_page(F.col("url"), F.lit(7)).alias("seventh"), X.url_allowed(F.col("url"), ["therhe.example.org"], ["/en/"]).alias("allowed"))


@query("duplicate_ids_top20", "SELECT l_partkey AS id, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, id LIMIT 20")
def duplicate_ids_top20(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(F.count("*").alias("n")).filter("n > 1").orderBy(F.desc("n"), "id").limit(20)


@query("request_status_counts", "SELECT o_orderpriority AS plan, o_orderstatus AS status, count(*) AS requests FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) GROUP BY ALL")
def request_status_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", F.col("o_orderpriority").alias("plan"), F.col("o_orderstatus").alias("status"))
    return V.status_counts(rows, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], ["plan", "status"])


@query("field_precedence", """WITH o AS (SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
  SELECT c_custkey, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'NONE') AS status, coalesce(o_orderpriority, c_mktsegment) AS label FROM customer LEFT JOIN o ON c_custkey = o_custkey""")
def field_precedence(spark, sf_dir):
    latest = V.latest_by(table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    detail = latest.select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"))
    listed = latest.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("label"))
    base = table(spark, sf_dir, "customer").select("c_custkey", F.lit("NONE").alias("status"), F.col("c_mktsegment").alias("label"))
    return V.with_precedence(base, [("detail", detail), ("list", listed)], "c_custkey", ["status", "label"])
