"""Queries on scalar expressions, page seeds, request states, links and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import exposure as G
from ..operators import lifecycle as L
from ..operators import matching as M
from ..operators import sampling as S
from ..sources import sinks
from .domain import REGISTRY_SQL, registry, table
from .evidence_queries import _RESOLVED, EVIDENCE_SQL, parts
from .planning_queries import CANDIDATES_SQL, REGIONS, candidates
from .registry import query

BASE = "https://register.example.org/list"


@query("parse_number", "SELECT p_partkey, p_size * CASE p_size % 4 WHEN 0 THEN 1e3 WHEN 1 THEN 1e6 ELSE 1.0 END AS number, CASE p_size % 4 WHEN 2 THEN 'machines' ELSE 'pcs' END AS unit FROM part")
def parse_number(spark, sf_dir):
    after = F.when(F.col("p_size") % 4 == 0, " k pcs").when(F.col("p_size") % 4 == 1, " Million pcs").when(F.col("p_size") % 4 == 2, " machines").otherwise(" pcs")
    text = F.concat(F.lit("about "), F.col("p_size").cast("string"), after)
    return table(spark, sf_dir, "part").select("p_partkey", X.parse_number(text).alias("number"), X.capacity_unit(text).alias("unit"))


@query("parse_instant", "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders")
def parse_instant(spark, sf_dir):
    """Dates in five forms by priority; a year alone (status P) is no date."""
    forms = {"1": "yyyy-MM-dd", "2": "dd/MM/yyyy", "3": "d-M-yyyy", "4": "yyyyMMdd"}
    text = F.date_format("o_orderdate", "yyyy/M/d")
    for first, form in forms.items():
        text = F.when(F.startswith("o_orderpriority", F.lit(first)), F.date_format("o_orderdate", form)).otherwise(text)
    text = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy")).otherwise(text)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(X.parse_instant(text), "yyyy-MM-dd").alias("day"))


@query("split_list", "SELECT p_partkey, p_type || '/' || p_name AS parts, (1000 + p_partkey) || ',' || (500000 + p_partkey) AS codes FROM part")
def split_list(spark, sf_dir):
    key = F.col("p_partkey")
    text = F.concat("p_type", F.lit(" ;  "), "p_name", F.lit(" | "), F.lower("p_type"))
    codes = F.concat(F.lit("HS "), (key + 1000).cast("string"), F.lit(", "), F.col("p_size").cast("string"), F.lit(" and "), (key + 1000).cast("string"), F.lit("/"), (key + 500_000).cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(X.split_list(text), "/").alias("parts"), F.array_join(X.product_codes(codes), ",").alias("codes"))


@query("safe_label", "SELECT page_id, trim(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '_') AS label FROM pages")
def safe_label(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.safe_label(F.col("url")).alias("label"))


@query("same_text", "SELECT c_custkey, c_acctbal >= 0 AS same FROM customer")
def same_text(spark, sf_dir):
    other = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit(" ("), F.lower("c_mktsegment"), F.lit(").")))
    return table(spark, sf_dir, "customer").select("c_custkey", X.same_text(F.col("c_mktsegment"), other).alias("same"))


@query("location_parts", f"WITH {REGISTRY_SQL} SELECT id, CASE WHEN status = 'ACTIVE' THEN upazila END AS upazila, CASE WHEN status = 'ACTIVE' THEN district END AS district, CASE WHEN status = 'ACTIVE' THEN division END AS division FROM registry")
def location_parts(spark, sf_dir):
    text = F.when(F.col("status") == "ACTIVE", F.concat_ws(", ", F.lit("Road 1"), "upazila", "district", "division")).otherwise(F.concat_ws(",", "district", "division"))
    return registry(spark, sf_dir).select("id", X.location_parts(text).alias("p")).select("id", "p.*")


@query("admin_name", "SELECT n_nationkey, lower(replace(n_name, '_', ' ')) AS name FROM nation")
def admin_name(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", X.admin_name(F.concat(F.lit(" "), "n_name", F.lit(" (Zila).  District"))).alias("name"))


@query("ascii_digits", "SELECT c_custkey, c_custkey AS n FROM customer")
def ascii_digits(spark, sf_dir):
    bengali = F.translate(F.format_number("c_custkey", 0), "0123456789", "০১২৩৪৫৬৭৮৯")
    return table(spark, sf_dir, "customer").select("c_custkey", X.parse_int(F.concat(F.lit("মোট "), bengali, F.lit(" টি"))).alias("n"))


@query("filter_url", f"SELECT c_custkey, '{BASE}?industry_id=' || c_mktsegment || CASE WHEN c_acctbal >= 0 THEN '&district=' || c_nationkey ELSE '' END || '&page=1' AS url FROM customer")
def filter_url(spark, sf_dir):
    made = X.filter_url(BASE, industry_id=F.col("c_mktsegment"), district=F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")), page=F.lit(1))
    return table(spark, sf_dir, "customer").select("c_custkey", made.alias("url"))


def _options(spark, sf_dir):
    rows = registry(spark, sf_dir).select("sector_label", "sector_family").distinct()
    return rows.select(F.lit("INDUSTRIAL_SECTOR").alias("dimension"), F.length("sector_label").cast("string").alias("source_value"), F.col("sector_label").alias("source_label"), F.col("sector_family").alias("family"))


@query("seed_requests", f"WITH {REGISTRY_SQL} SELECT DISTINCT sector_family, length(sector_label)::VARCHAR AS source_value, sector_label AS source_label, 1 AS page, '{BASE}?industry_id=' || length(sector_label) || '&page=1' AS url, 'UNIVERSE_SEED' AS reason FROM registry")
def seed_requests(spark, sf_dir):
    return S.seed_requests(_options(spark, sf_dir), F.col("family"), BASE)


_LACKING = {"CORE": 10, "WEST": 5, "OTHER": 0}


@query("geographic_seeds", f"""WITH {REGISTRY_SQL}, d AS (SELECT CASE WHEN r_name = 'ASIA' THEN 'CORE' WHEN r_name IN ('AMERICA', 'EUROPE') THEN 'WEST' ELSE 'OTHER' END AS geography_group, n_nationkey::VARCHAR AS district_value, n_name AS district_label FROM nation JOIN region ON n_regionkey = r_regionkey),
 dd AS (SELECT * FROM d WHERE geography_group IN ('CORE', 'WEST') QUALIFY row_number() OVER (PARTITION BY geography_group ORDER BY district_label, district_value) <= 3),
 s AS (SELECT sector_label, length(sector_label)::VARCHAR AS sector_value FROM registry GROUP BY 1 ORDER BY count(*) DESC, sector_label LIMIT 3)
 SELECT geography_group, district_value, district_label, sector_value, sector_label, 1 AS page, '{BASE}?industry_id=' || sector_value || '&district=' || district_value || '&page=1' AS url FROM dd, s""")
def geographic_seeds(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    group = F.when(F.col("r_name") == "ASIA", "CORE").when(F.col("r_name").isin("AMERICA", "EUROPE"), "WEST").otherwise("OTHER")
    districts = n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey")).select(group.alias("geography_group"), F.col("n_nationkey").cast("string").alias("value"), F.col("n_name").alias("label"))
    sectors = registry(spark, sf_dir).groupBy(F.col("sector_label").alias("label")).agg(F.count("*").alias("total")).withColumn("value", F.length("label").cast("string"))
    return S.geographic_seeds(districts, sectors, _LACKING, BASE)


@query("geographic_rows", f"""WITH {CANDIDATES_SQL}, u AS (SELECT geography_group AS family, sector_family AS label, count(*) * 100 AS total FROM cand GROUP BY ALL)
 SELECT *, least(total, greatest(30, ceil(ceil(CASE family WHEN 'CORE' THEN {_LACKING["CORE"] * 90} ELSE {_LACKING["WEST"] * 90} END * 1.25) * total / sum(total) OVER (PARTITION BY family))))::BIGINT AS wanted FROM u WHERE family IN ('CORE', 'WEST')""")
def geographic_rows(spark, sf_dir):
    universes = candidates(spark, sf_dir).groupBy(F.col("geography_group").alias("family"), F.col("sector_family").alias("label")).agg((F.count("*") * 100).alias("total"))
    return S.geographic_rows(universes, {k: v * 90 for k, v in _LACKING.items() if k in REGIONS})


@query("index_page_plan", "SELECT o_custkey AS run_id, 1 AS current_page, n AS last_page, unnest(range(2, n + 1)) AS page FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)")
def index_page_plan(spark, sf_dir):
    """An index per customer with as many pages as orders."""
    made = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("run_id")).agg(F.lit(1).alias("current_page"), F.count("*").alias("last_page"))
    return S.index_page_plan(made)


@query("spread_items", """WITH k AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS m FROM orders)
 SELECT o_orderkey, o_custkey FROM k WHERE m <= 3 OR k IN (1, 1 + round_even((m - 1) / 2, 0), m)""")
def spread_items(spark, sf_dir):
    return S.spread_items(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], 3).select("o_orderkey", "o_custkey")


def _requests(spark, sf_dir):
    """Orders as events of their customers' requests."""
    status = F.when(F.col("o_orderstatus") == "O", "PLANNED").when(F.col("o_orderstatus") == "F", "FAILED").otherwise("STAGED")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("entity"), status.alias("status"), F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("seq"))


_STATES = "s AS (SELECT o_custkey::VARCHAR AS entity, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o FROM orders GROUP BY 1)"


@query("request_transitions", f"WITH {_STATES} SELECT c_custkey::VARCHAR AS entity, 'STAGED' AS status, coalesce(o = 'O', FALSE) AS accepted FROM customer LEFT JOIN s ON entity = c_custkey::VARCHAR")
def request_transitions(spark, sf_dir):
    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("entity"), F.lit("STAGED").alias("status"), F.lit("2030-01-01").cast("timestamp").alias("at"), F.col("c_custkey").alias("seq"))
    yes, no = L.transitions(_requests(spark, sf_dir), asked)
    return yes.select("entity", "status", F.lit(True).alias("accepted")).unionByName(no.select("entity", "status", F.lit(False).alias("accepted")))


@query("requests_due", f"WITH {_STATES} SELECT c_custkey::VARCHAR AS entity, c_custkey AS sequence_no, CASE o WHEN 'O' THEN 'PLANNED' ELSE 'FAILED' END AS status FROM customer JOIN s ON entity = c_custkey::VARCHAR WHERE o IN ('O', 'F')")
def requests_due(spark, sf_dir):
    manifest = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("entity"), F.col("c_custkey").alias("sequence_no"))
    return L.due(_requests(spark, sf_dir), manifest, ("PLANNED", "FAILED")).select("entity", "sequence_no", "status")


@query("audit_faults", """SELECT o_custkey AS run_id, count(*) AS attempted, count(*) FILTER (WHERE o_orderstatus <> 'P') AS staged FROM orders GROUP BY 1 HAVING count(*) FILTER (WHERE o_orderstatus = 'P') <> count(*) FILTER (WHERE o_orderpriority LIKE '1%')""")
def audit_faults(spark, sf_dir):
    runs = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("run_id")).agg(
        F.count("*").alias("planned"), F.count("*").alias("attempted"), F.count_if(F.col("o_orderstatus") != "P").alias("staged"), F.count_if(F.startswith("o_orderpriority", F.lit("1"))).alias("failed"),
        F.min("o_orderdate").alias("started_at"), F.max("o_orderdate").alias("finished_at"),
    )
    return L.audit_consistent(runs).select("run_id", "attempted", "staged")


_MATCH = {"1": "EXACT_SITE", "2": "PROBABLE_SITE", "3": "ORGANIZATION_ONLY", "4": "AMBIGUOUS", "5": "NO_MATCH"}
_MATCH_SQL = "CASE left(o_orderpriority, 1) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _MATCH.items()) + " END"


def _links(spark, sf_dir):
    """Orders as links of customers: the source is the segment, the priority tells the match type."""
    kind = F.create_map(*[F.lit(x) for kv in _MATCH.items() for x in kv])[F.substring("o_orderpriority", 1, 1)]
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(F.col("c_custkey").alias("target_id"), F.col("o_orderkey").alias("record_id"), F.col("c_mktsegment").alias("source"), kind.alias("match_type"), F.startswith("o_orderpriority", F.lit("1")).alias("site_level_match"))


_LINKS_SQL = f"lk AS (SELECT c_custkey AS target_id, o_orderkey AS record_id, c_mktsegment AS source, {_MATCH_SQL} AS match_type, o_orderpriority LIKE '1%' AS site FROM orders JOIN customer ON o_custkey = c_custkey)"


@query("linkage_coverage", f"""WITH {_LINKS_SQL}, t AS (SELECT c_mktsegment AS source, count(*) AS eligible FROM customer GROUP BY 1),
 g AS (SELECT source, count(DISTINCT record_id) AS linked_records, {", ".join(f"count(*) FILTER (WHERE match_type = '{m}') AS {m.lower()}" for m in _MATCH.values())} FROM lk GROUP BY 1)
 SELECT *, (exact_site + probable_site) / eligible AS site_match_rate, (exact_site + probable_site + organization_only) / eligible AS any_positive_link_rate FROM t JOIN g USING (source)""")
def linkage_coverage(spark, sf_dir):
    targets = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("source"), F.col("c_custkey").alias("target_id"))
    return M.coverage(targets, _links(spark, sf_dir))


@query("attached_facts", f"""WITH {_LINKS_SQL}, ty AS (SELECT l_orderkey AS record_id, CASE WHEN l_returnflag = 'R' THEN 'SITE' ELSE 'ORGANIZATION' END AS scope, l_quantity AS value_numeric FROM lineitem)
 SELECT target_id, scope, scope = 'SITE' AS site_attributable, count(*) AS facts, sum(value_numeric) AS total FROM lk JOIN ty USING (record_id)
 WHERE match_type IN ('EXACT_SITE', 'PROBABLE_SITE', 'ORGANIZATION_ONLY') AND (scope = 'ORGANIZATION' OR site) GROUP BY ALL""")
def attached_facts(spark, sf_dir):
    scope = F.when(F.col("l_returnflag") == "R", "SITE").otherwise("ORGANIZATION")
    typed = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("record_id"), scope.alias("scope"), F.col("l_quantity").alias("value_numeric"))
    made = M.attach_observations(_links(spark, sf_dir), typed)
    return made.groupBy("target_id", "scope", "site_attributable").agg(F.count("*").alias("facts"), F.sum("value_numeric").alias("total"))


@query("applied_links", _RESOLVED + "SELECT target_id, record_id, match_type FROM res JOIN short USING (target_id) WHERE outcome = 'AUTO_SELECTED' AND record_id = selected_record")
def applied_links(spark, sf_dir):
    short, outcomes = M.candidate_run(*parts(spark, sf_dir))
    return M.apply_resolutions(outcomes, short, None).select("target_id", "record_id", "match_type")


@query("detail_requests", f"WITH {EVIDENCE_SQL} SELECT record_id::VARCHAR AS source_key, count(DISTINCT target_id) AS targets FROM short GROUP BY 1")
def detail_requests(spark, sf_dir):
    t, r = parts(spark, sf_dir)
    short, _ = M.candidate_run(t, r)
    index = r.select("record_id", "source", F.col("external_key").alias("source_key"), F.concat(F.lit("https://h/member/"), "external_key").alias("detail_url"))
    return M.detail_requests(short, index)[0].select("source_key", "targets")


@query("exposure_faults", """SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'source is required' WHEN s_nationkey % 5 = 0 THEN 'unsupported domain' WHEN s_nationkey % 5 = 1 THEN 'unsupported spatial_scope'
 WHEN s_nationkey % 5 = 2 THEN 'UPAZILA needs district and upazila' WHEN s_nationkey % 5 = 3 THEN 'SITE needs establishment_ref' END AS fault FROM supplier""")
def exposure_faults(spark, sf_dir):
    k, none = F.col("s_nationkey") % 5, F.lit(None).cast("string")
    rows = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.when(F.col("s_acctbal") < 0, " ").otherwise("S").alias("source"), F.lit("M").alias("metric_code"), F.lit("Metric").alias("metric_label"), F.when(k == 0, "WEATHER").otherwise("POWER_SYSTEM").alias("domain"),
        F.when(k == 1, "PLANET").when(k == 2, "UPAZILA").when(k == 3, "SITE").otherwise("DISTRICT").alias("spatial_scope"), none.alias("direction"), none.alias("establishment_ref"), F.lit("d").alias("district"), none.alias("upazila"),
    )
    return rows.select("s_suppkey", G.faults(rows).alias("fault"))


@query("json_lines", f"WITH {REGISTRY_SQL} SELECT json_object('district', district, 'id', id, 'name', name)::VARCHAR AS value FROM registry")
def json_lines(spark, sf_dir):
    return sinks.json_lines(registry(spark, sf_dir).select("name", "id", "district"))
