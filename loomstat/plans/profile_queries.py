"""Queries on profiles, resolutions that are stored, bulk universes and comparisons over the large tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import exposure as G
from ..operators import matching as M
from ..operators import quality as Q
from ..operators import rollups as R
from ..operators import runs
from ..operators import versioning as V
from ..sources.shared import new_path
from ..sources.sinks import read_json, save_json
from ..sources.store import LogStore
from ..vocab import EXTERNAL_SOURCES
from .domain import REGISTRY_SQL, registry, sql_round, table
from .evidence_queries import EVIDENCE_SQL, LINKS_SQL, observations, parts, units, with_ref
from .planning_queries import CANDIDATES_SQL, candidates
from .registry import query

_PCT = sql_round("{0} / {1} * 100.0")


@query(
    "family_exposure_profile",
    f"""WITH {LINKS_SQL}, have AS (SELECT DISTINCT establishment_ref FROM links), r AS (SELECT reg.*, h.establishment_ref IS NOT NULL AS linked FROM reg LEFT JOIN have h USING (establishment_ref)),
f AS (SELECT sector_family, count(*) AS registry_establishments, count(*) FILTER (linked) AS with_evidence FROM r GROUP BY 1),
d AS (SELECT sector_family, district, count(*) AS establishments, count(*) FILTER (linked) AS district_with_evidence FROM r GROUP BY ALL),
c AS (SELECT sector_family, count(DISTINCT (domain, spatial_scope, context_district, value_numeric)) AS conditions FROM links JOIN reg USING (establishment_ref) GROUP BY 1)
SELECT sector_family, registry_establishments, with_evidence, {_PCT.format("with_evidence", "registry_establishments")} AS coverage_pct, coalesce(conditions, 0) AS conditions, district, establishments, district_with_evidence,
 {_PCT.format("district_with_evidence", "establishments")} AS district_coverage_pct FROM f JOIN d USING (sector_family) LEFT JOIN c USING (sector_family)""",
)
def family_exposure_profile(spark, sf_dir):
    """Coverage, number of conditions and district coverage of every sector family; a row per district."""
    rows = with_ref(spark, sf_dir)
    made = G.family_profiles(rows, G.links(rows, observations(spark, sf_dir)))
    conditions = F.coalesce(F.nullif(F.size("conditions"), F.lit(-1)), F.lit(0)).cast("long").alias("conditions")
    each = made.select("sector_family", "registry_establishments", F.col("establishments_with_evidence").alias("with_evidence"), "coverage_pct", conditions, F.explode("districts").alias("d"))
    return each.select(*each.columns[:-1], "d.district", "d.establishments", F.col("d.establishments_with_evidence").alias("district_with_evidence"), F.col("d.coverage_pct").alias("district_coverage_pct"))


_SELECTED = f"""{EVIDENCE_SQL}, g AS (SELECT target_id, count(*) FILTER (WHERE match_type IN ('EXACT_SITE', 'PROBABLE_SITE')) AS s, count(*) FILTER (WHERE match_type = 'ORGANIZATION_ONLY') AS o,
 min(record_id) FILTER (WHERE match_type IN ('EXACT_SITE', 'PROBABLE_SITE')) AS site, min(record_id) FILTER (WHERE match_type = 'ORGANIZATION_ONLY') AS org FROM short GROUP BY 1),
sel AS (SELECT g.target_id, CASE WHEN s = 1 THEN site ELSE org END AS record_id FROM g WHERE s = 1 OR s = 0 AND o = 1),
pair AS (SELECT sel.target_id, sel.record_id::VARCHAR AS record_id, name_result, district_result, address_result, match_type, match_type IN ('EXACT_SITE', 'PROBABLE_SITE') AS site, t.p_name AS t_name, r.p_name AS r_name, t.p_type AS t_type, r.p_type AS r_type,
  'D' || (t.p_size % 5) AS t_d, 'D' || (r.p_size % 5) AS r_d, r.p_size AS size, r.p_retailprice AS price FROM sel JOIN short s ON s.target_id = sel.target_id AND s.record_id = sel.record_id JOIN part t ON t.p_partkey = sel.target_id JOIN part r ON r.p_partkey = sel.record_id)"""


def _resolved(spark, sf_dir) -> LogStore:
    """A resolution of few targets against all records, so that some have a single best one, stored twice."""
    targets, records = parts(spark, sf_dir)
    made, _ = M.audited_run(targets, records, new_path(spark, "outcomes"), judged=False)
    p = table(spark, sf_dir, "part").filter("p_partkey % 2 = 1")
    none, number = F.lit(None).cast("string").alias("value_text"), F.lit("n").alias("unit")
    typed = p.select(F.col("p_partkey").alias("record_id"), F.lit("EMPLOYEES").alias("observation_type"), F.lit("ORGANIZATION").alias("scope"), none, F.col("p_size").cast("double").alias("value_numeric"), number)
    typed = typed.unionByName(p.select(F.col("p_partkey").alias("record_id"), F.lit("MACHINES").alias("observation_type"), F.lit("SITE").alias("scope"), none, F.col("p_retailprice").alias("value_numeric"), number))
    store = LogStore(spark, new_path(spark, "resolution"))
    runs.store_resolution(store, made, typed, "2024-01-01")
    if any(runs.store_resolution(store, made, typed, "2024-01-02").values()):
        raise ValueError("a resolution was stored twice")
    return store


@query(
    "stored_evidence",
    f"""WITH {_SELECTED} SELECT target_id, record_id, unnest(['NAME', 'DISTRICT', 'UPAZILA', 'ADDRESS', 'SOURCE_LINKAGE']) AS evidence_type, unnest([t_name, t_d, NULL, t_type, NULL]) AS register_value,
  unnest([r_name, r_d, NULL, r_type, 'BGMEA']) AS external_value, unnest([name_result, district_result, 'missing', address_result, '{EXTERNAL_SOURCES["BGMEA"][0]}']) AS result FROM pair""",
)
def stored_evidence(spark, sf_dir):
    """What was compared, and how it came out, for every stored link."""
    return _resolved(spark, sf_dir).read("link_evidence", runs.EVIDENCE).drop("linked_at")


@query(
    "stored_attachments",
    f"""WITH {_SELECTED} SELECT target_id, record_id, 'EMPLOYEES' AS observation_type, size::DOUBLE AS value_numeric, false AS site_attributable FROM pair WHERE match_type <> 'NO_MATCH'
 UNION ALL SELECT target_id, record_id, 'MACHINES', price, true FROM pair WHERE site""",
)
def stored_attachments(spark, sf_dir):
    """Typed facts of linked records; those of a site only where the link is to the site."""
    return _resolved(spark, sf_dir).read("link_attachments", runs.ATTACHED).select("target_id", "record_id", "observation_type", "value_numeric", "site_attributable")


@query("bulk_universe", "SELECT c_custkey + 1 AS id, (SELECT count(*) FROM customer) AS expected_total, 'COMPLETED' AS status FROM customer")
def bulk_universe(spark, sf_dir):
    """A national universe from one bulk export; one with a repeated id is refused and leaves nothing."""
    store = LogStore(spark, new_path(spark, "universe"))
    rows = registry(spark, sf_dir).select((F.col("id") + 1).alias("id"), "name")
    total = rows.count()
    try:
        runs.import_universe(store, "bad", rows.withColumn("id", F.greatest("id", F.lit(2))), total, "2024-01-01", "export")
    except ValueError:
        pass
    else:
        raise ValueError("a repeated id went through")
    status, _ = runs.import_universe(store, "u", rows, total, "2024-01-02", "export")
    known = runs.universe(store, "u")
    if store.exists("universe_members/run=bad") or known["status"] != status:
        raise ValueError(f"unexpected state: {known}")
    members = store.read("universe_members", runs.MEMBERS).filter("run = 'u'")
    return members.select("id", F.lit(known["expected_total"]).cast("long").alias("expected_total"), F.lit(known["status"]).alias("status"))


_COMPARED = """l AS (SELECT o_custkey AS id, o_orderpriority AS name, o_orderstatus AS status FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
d AS (SELECT o_custkey AS id, o_orderpriority AS name_en, o_orderstatus AS status, o_totalprice > 1000 AS core FROM orders WHERE o_orderkey % 2 = 0 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
q AS (SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'PLANNED' ELSE 'PARSED' END AS rs, c_mktsegment FROM customer WHERE c_custkey % 3 > 0)"""


@query(
    "request_comparisons",
    f"""WITH {_COMPARED} SELECT q.id AS public_id, rs AS request_status, c_mktsegment AS sector_family, l.name AS list_name, l.status AS list_status, d.name_en AS detail_name_en, d.status AS detail_status, core AS core_complete
  FROM q LEFT JOIN l USING (id) LEFT JOIN d USING (id)""",
)
def request_comparisons(spark, sf_dir):
    """Requests beside the latest listing and the latest detail of their establishment."""
    return _compared(spark, sf_dir).select("public_id", "request_status", "sector_family", "list_name", "list_status", "detail_name_en", "detail_status", "core_complete")


def _compared(spark, sf_dir):
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    k = F.col("c_custkey")
    requests = customer.select(k.alias("id"), k.alias("sequence_no"), F.when(k % 5 == 0, "FAILED").when(k % 5 == 1, "PLANNED").otherwise("PARSED").alias("request_status"))
    sample = customer.filter(k % 3 > 0).select(k.alias("id"), F.col("c_mktsegment").alias("sector_family"), F.lit("N").alias("geography_group"))
    seen = orders.select(F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("observed_at"), F.col("o_orderkey").alias("observation_id"), F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("status"), (F.col("o_totalprice") > 1000).alias("core_complete"))
    return Q.comparisons(requests, sample, seen, seen.filter("observation_id % 2 = 0").withColumnRenamed("name", "name_en"))


@query(
    "request_anomalies",
    f"""WITH {_COMPARED}, j AS (SELECT q.id, rs, l.name AS ln, l.status AS ls, d.name_en AS dn, d.status AS ds, core FROM q LEFT JOIN l USING (id) LEFT JOIN d USING (id))
SELECT id AS public_id, 'RETRIEVAL_FAILURE' AS anomaly_type, 'CRITICAL' AS severity FROM j WHERE rs = 'FAILED' UNION ALL SELECT id, 'UNRESOLVED_REQUEST', 'CRITICAL' FROM j WHERE rs = 'PLANNED'
 UNION ALL SELECT id, 'STATUS_MISMATCH', 'HIGH' FROM j WHERE rs = 'PARSED' AND ls <> ds UNION ALL SELECT id, 'NAME_VARIATION', 'INFO' FROM j WHERE rs = 'PARSED' AND ln <> dn
 UNION ALL SELECT id, 'CORE_FIELDS_INCOMPLETE', 'MEDIUM' FROM j WHERE rs = 'PARSED' AND NOT core""",
)
def request_anomalies(spark, sf_dir):
    return Q.anomalies(_compared(spark, sf_dir)).select("public_id", "anomaly_type", "severity")


@query(
    "crosswalk_links",
    f"""WITH {REGISTRY_SQL} SELECT 'DIFE:' || id AS establishment_ref, 'BBS:DIST:' || n_regionkey || ':' || n_nationkey AS canonical_geo_ref, v AS value_numeric
  FROM (SELECT s_nationkey, sum(s_suppkey)::DOUBLE AS v FROM supplier GROUP BY 1) JOIN nation ON s_nationkey = n_nationkey JOIN registry ON district = n_name WHERE n_nationkey % 2 = 0""",
)
def crosswalk_links(spark, sf_dir):
    """Observations that name a unit by its reference under another label: the reference decides, and one whose unit isn't known links nothing."""
    nation = table(spark, sf_dir, "nation")
    area = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.sum("s_suppkey").cast("double").alias("v")).join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
    none, even = F.lit(None).cast("string"), F.col("n_nationkey") % 2 == 0
    ref = F.concat_ws(":", F.when(even, F.lit("BBS:DIST")).otherwise(F.lit("OTHER:DIST")), "n_regionkey", "n_nationkey")
    facts = area.select(
        F.lit("TEST").alias("source"), F.lit("POWER_SYSTEM").alias("domain"), F.lit("M").alias("metric_code"), F.lit("M").alias("metric_label"), F.lit("DISTRICT").alias("spatial_scope"), none.alias("establishment_ref"),
        # the label is the right name where the reference is wrong, and the other way round
        F.when(even, F.lit("elsewhere")).otherwise(F.col("n_name")).alias("district"), none.alias("upazila"), none.alias("value_text"), F.col("v").alias("value_numeric"), none.alias("unit"), none.alias("direction"),
        none.alias("source_vintage"), none.alias("observed_at"), ref.alias("canonical_geo_ref"),
    )
    return G.links(with_ref(spark, sf_dir), facts, units(spark, sf_dir)).select("establishment_ref", "canonical_geo_ref", "value_numeric")


def _families(source: str) -> str:
    families = EXTERNAL_SOURCES[source][1]
    return "true" if families is None else "sector_family IN (" + ", ".join(f"'{f}'" for f in sorted(families)) + ")"


@query("target_state_counts", f"WITH {CANDIDATES_SQL} " + " UNION ALL ".join(f"SELECT '{s}' AS source, count(*) FILTER ({_families(s)}) AS eligible, count(*) FILTER (NOT ({_families(s)})) AS out_of_scope FROM cand" for s in EXTERNAL_SOURCES))
def target_state_counts(spark, sf_dir):
    """Targets of every source from one sample, by state, after they were planned twice."""
    store = LogStore(spark, new_path(spark, "targets"))
    store.replace("validation_sample", "v", candidates(spark, sf_dir), "2024-01-01", 1)
    runs.plan_targets(store, "v", next(iter(EXTERNAL_SOURCES)), "2024-01-01")
    made = [(source, *runs.plan_targets(store, "v", source, "2024-01-02").values()) for source in EXTERNAL_SOURCES]
    return spark.createDataFrame(made, "source string, eligible long, out_of_scope long")


@query("last_by_position", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC) = 1")
def last_by_position(spark, sf_dir):
    """The last line of every order; of lines with one number the one that stands first in the table's files."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey"]
    rows = table(spark, sf_dir, "lineitem").select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("line"))
    return V.distinct_last(rows, ["l_orderkey"], "l_linenumber", ("file", "line")).select(*columns)


@query(
    "reviewed_aliases",
    """SELECT 'DISTRICT' AS level, CASE n_nationkey WHEN 0 THEN 'Jhalokati' ELSE 'Nawabganj' END AS alias, 'BBS:DIST:' || n_regionkey || ':' || n_nationkey AS geo_ref FROM nation WHERE n_nationkey IN (0, 2)""",
)
def reviewed_aliases(spark, sf_dir):
    """Reviewed labels get an alias only where no unit bears the label itself and one bears the canonical name."""
    named = F.when(F.col("geo_ref").endswith(":0"), "Jhalokathi").when(F.col("geo_ref").endswith(":1"), "Brahmanbaria").when(F.col("geo_ref").endswith(":2"), "Chapai Nawabganj").otherwise(F.col("district_name_en"))
    places = units(spark, sf_dir).withColumn("district_name_en", F.when(F.col("level") == "DISTRICT", named).otherwise(F.col("district_name_en")))
    return G.risk_aliases(places).select("level", "alias", "geo_ref")


_SECTIONS = {"districts": "district", "divisions": "division", "statuses": "status", "source_sector_labels": "sector_label", "sector_families": "sector_family"}


@query(
    "national_dashboard",
    f"WITH {REGISTRY_SQL} " + " UNION ALL ".join(
        f"""SELECT '{section}' AS section, row_number() OVER (ORDER BY count(*) DESC, {c}) AS position, {c} AS label, count(*) AS establishments,
 {_PCT.format("count(*)", "(SELECT count(*) FROM registry)")} AS share_national_pct, (SELECT count(*) FROM registry) AS universe_total FROM registry GROUP BY {c}""" for section, c in _SECTIONS.items()
    ),
)
def national_dashboard(spark, sf_dir):
    """The national payload, written as JSON and read back; lists come by count, then label."""
    rows = registry(spark, sf_dir)
    path = new_path(spark, "dashboard")
    save_json(spark, R.dashboard(rows, "u", "2026-01-01T00:00:00Z", rows.count()), path)
    made = read_json(spark, path)
    flat = [
        (section, k, r.get("label", r.get("sector_family")), r["establishments"], r["share_national_pct"], made["universe"]["expected_total"])
        for section in _SECTIONS for k, r in enumerate(made[section], 1)
    ]
    return spark.createDataFrame(flat, "section string, position long, label string, establishments long, share_national_pct double, universe_total long")


def _profile_cells_sql(by: str, of: str) -> str:
    return f"""WITH {REGISTRY_SQL}, n AS (SELECT {by}, {of}, count(*) AS n FROM registry GROUP BY ALL),
q AS (SELECT *, sum(n) OVER (PARTITION BY district) AS d, sum(n) OVER (PARTITION BY sector_family) AS f, sum(n) OVER () AS t FROM n),
e AS (SELECT *, {sql_round("(n / d) / (f / t)")} AS location_quotient FROM q)
SELECT {by}, row_number() OVER (PARTITION BY {by} ORDER BY n DESC, {of}) AS position, {of}, n AS establishments, {_PCT.format("n", "d")} AS share_of_district_pct, {_PCT.format("n", "f")} AS share_of_national_sector_pct, location_quotient,
 CASE WHEN location_quotient > 1 THEN 'ABOVE_NATIONAL_SHARE' WHEN location_quotient = 1 THEN 'EQUAL_TO_NATIONAL_SHARE' ELSE 'BELOW_NATIONAL_SHARE' END AS specialization FROM e"""


def _profile_cells(spark, sf_dir, by: str, of: str):
    """The cells of the profiles' payloads, in their order."""
    cell = f"struct<{of}:string,establishments:bigint,share_of_district_pct:double,share_of_national_sector_pct:double,location_quotient:double,specialization:string>"
    payload = F.from_json("payload", f"cells array<{cell}>")
    made = R.profiles(registry(spark, sf_dir), by, "2026-01-01T00:00:00Z").select(by, F.posexplode(payload["cells"]).alias("k", "c"))
    return made.select(by, (F.col("k") + 1).cast("long").alias("position"), "c.*")


@query("district_profile_cells", _profile_cells_sql("district", "sector_family"))
def district_profile_cells(spark, sf_dir):
    return _profile_cells(spark, sf_dir, "district", "sector_family")


@query("sector_profile_cells", _profile_cells_sql("sector_family", "district"))
def sector_profile_cells(spark, sf_dir):
    return _profile_cells(spark, sf_dir, "sector_family", "district")


@query(
    "field_coverage_rates",
    "WITH p AS (SELECT * FROM orders WHERE o_orderstatus <> 'P') SELECT "
    + ", ".join(f"coalesce((SELECT count(*) FILTER ({when}) / count(*) FROM p), 0.0) AS {name}_coverage_rate" for name, when in (
        ("employment", "o_custkey % 2 = 0"), ("expiry", "true"), ("licence", "o_orderkey % 3 > 0"), ("registration", "o_orderkey % 5 > 0"), ("district", "o_orderpriority LIKE '1%'"), ("sector", "true"), ("status", "true"), ("establishment_type", "false"),
    )),
)
def field_coverage_rates(spark, sf_dir):
    """Share of parsed details in which each field isn't blank."""
    rows = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    made = rows.select(
        F.when(F.col("o_orderstatus") == "P", "FAILED").otherwise("PARSED").alias("status"), F.when(F.col("o_custkey") % 2 == 0, 5).alias("worker_total"), F.lit("2025").alias("licence_expiry_raw"),
        F.when(k % 3 > 0, "L").otherwise(" ").alias("licence_no"), F.when(k % 5 > 0, "R").alias("registration_no"), F.when(F.col("o_orderpriority").startswith("1"), "D").alias("district"), F.lit("S").alias("sector"),
        F.col("o_orderstatus").alias("detail_status"), F.lit("").alias("establishment_type"),
    )
    return Q.field_coverage(made)
