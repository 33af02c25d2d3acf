"""Queries on numbering, audited runs, labelled logs, streams and exports over the large tables."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from ..operators import exposure as G
from ..operators import matching as M
from ..operators import rollups as R
from ..operators import runs
from ..operators import sampling as S
from ..operators.ordering import numbered
from ..sources.bucketed import bucketed
from ..sources.layouts import VersionedTable, renamed, with_columns
from ..sources.shared import new_path
from ..sources.sinks import export_json_array, read_json_array
from ..sources.store import LogStore
from ..streaming.landing import ingest_once, with_hash
from .domain import table
from .evidence_queries import EVIDENCE_SQL, LINKS_SQL, observations, parts, with_ref
from .planning_queries import CANDIDATES_SQL, REGIONS, SAMPLE_SQL, SECTORS, candidates
from .registry import query

_LINK_ORDER = ("establishment_ref", "domain", "spatial_scope", "context_district", "value_numeric")


@query(
    "exposure_links_ordered",
    f"""WITH {LINKS_SQL} SELECT row_number() OVER (ORDER BY establishment_ref, domain, spatial_scope, coalesce(context_district, ''), value_numeric) AS position,
  establishment_ref, domain, spatial_scope, context_district, value_numeric FROM links""",
)
def exposure_links_ordered(spark, sf_dir):
    """Links with their place in the order of an export, null as empty text."""
    made = G.links(with_ref(spark, sf_dir), observations(spark, sf_dir)).select(*_LINK_ORDER)
    return numbered(made, [F.coalesce(c, F.lit("")) if c == "context_district" else c for c in _LINK_ORDER])


@query(
    "candidate_audit",
    f"""WITH {EVIDENCE_SQL}, g AS (SELECT target_id, count(*) AS n, count(*) FILTER (WHERE match_type IN ('EXACT_SITE', 'PROBABLE_SITE')) AS s, count(*) FILTER (WHERE match_type = 'ORGANIZATION_ONLY') AS o FROM short GROUP BY 1),
res AS (SELECT target_id, CASE WHEN n IS NULL THEN 'no_staged_candidate' WHEN s = 1 THEN 'auto_selected' WHEN s > 1 THEN 'ambiguous' WHEN o = 1 THEN 'auto_selected' WHEN o > 1 THEN 'ambiguous' ELSE 'review_required' END AS outcome FROM t LEFT JOIN g USING (target_id)),
judged AS (SELECT count(*) AS n FROM e2 WHERE name_result IN ('exact', 'strong') OR overlap >= 0.4)
SELECT unnest(['pairs', 'shortlisted', 'targets', 'auto_selected', 'ambiguous', 'review_required', 'no_staged_candidate']) AS name,
 unnest([(SELECT n FROM judged), (SELECT count(*) FROM short), (SELECT count(*) FROM t), (SELECT count(*) FROM res WHERE outcome = 'auto_selected'), (SELECT count(*) FROM res WHERE outcome = 'ambiguous'),
  (SELECT count(*) FROM res WHERE outcome = 'review_required'), (SELECT count(*) FROM res WHERE outcome = 'no_staged_candidate')]) AS n""",
)
def candidate_audit(spark, sf_dir):
    """The counts of a candidate run, all from the job that writes its outcomes."""
    _, counts = M.audited_run(*parts(spark, sf_dir), new_path(spark, "outcomes"))
    return spark.createDataFrame([(k, v) for k, v in counts.items() if k != "profile_pairs"], "name string, n long")


_ASKED = """asked AS (SELECT DISTINCT target_id, record_id FROM short), idx AS (SELECT p_partkey AS record_id, 'BGMEA' AS source, (p_partkey * 37 % 100003)::VARCHAR AS source_key FROM part WHERE p_partkey % 2 = 1),
req AS (SELECT source, source_key, count(DISTINCT target_id) AS targets FROM asked JOIN idx USING (record_id) GROUP BY ALL)"""


@query("detail_request_order", f"WITH {EVIDENCE_SQL}, {_ASKED} SELECT row_number() OVER (ORDER BY length(source_key), source_key) AS sequence_no, source, source_key, targets FROM req")
def detail_request_order(spark, sf_dir):
    """Requests for the profiles of shortlisted records in the order in which they are fetched."""
    targets, records = parts(spark, sf_dir)
    short, _ = M.candidate_run(targets, records)
    key = (F.col("record_id") * 37 % 100003).cast("string")
    index = records.select("record_id", "source", key.alias("source_key"), F.concat(F.lit("https://register.example.org/member/"), key).alias("detail_url"))
    requests, _ = M.detail_requests(short, index)
    return M.request_order(requests).select("sequence_no", "source", "source_key", "targets")


_RISKS = """u AS (SELECT n_nationkey AS k, n_name, r_name, n_regionkey FROM nation JOIN region ON r_regionkey = n_regionkey),
rec AS (SELECT s_suppkey, u.*, s_suppkey % 3 = 2 AS odd, CASE WHEN s_acctbal < 0 THEN 'Low' WHEN s_acctbal < 5000 THEN 'Medium' ELSE 'High' END AS risk FROM supplier JOIN u ON s_nationkey = k),
facts AS (SELECT DISTINCT k, m, CASE WHEN m = 5 THEN risk ELSE 'Zone ' || s_suppkey % 4 END AS value FROM rec, range(1, 6) t(m) WHERE NOT odd)"""


@query(
    "risk_import_audit",
    f"""WITH {_RISKS} SELECT run, name, n FROM (SELECT unnest(['records', 'unresolved', 'observations', 'inserted', 'stored']) AS name,
  unnest([(SELECT count(*) FROM rec), (SELECT count(*) FROM rec WHERE odd), (SELECT 5 * count(*) FROM rec WHERE NOT odd), (SELECT count(*) FROM facts), (SELECT count(*) FROM facts)]) AS n, 'first' AS run
 UNION ALL SELECT unnest(['records', 'unresolved', 'observations', 'inserted', 'stored']),
  unnest([(SELECT count(*) FROM rec), (SELECT count(*) FROM rec WHERE odd), (SELECT 5 * count(*) FROM rec WHERE NOT odd), 0, (SELECT count(*) FROM facts)]), 'again')""",
)
def risk_import_audit(spark, sf_dir):
    """District risk records of all suppliers, a third under names no unit has, imported twice; every import counts as it writes."""
    store = LogStore(spark, new_path(spark, "risks"))
    place = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    none = F.lit(None).cast("string")
    units = place.select(
        F.lit("DISTRICT").alias("level"), F.concat_ws(":", F.lit("BBS:DIST"), "n_regionkey", "n_nationkey").alias("geo_ref"), F.col("r_name").alias("division_name_en"), none.alias("division_name_bn"),
        F.col("n_name").alias("district_name_en"), none.alias("district_name_bn"), none.alias("upazila_name_en"), none.alias("upazila_name_bn"),
    )
    zone = F.concat(F.lit("Zone "), (F.col("s_suppkey") % 4).cast("string"))
    risk = F.when(F.col("s_acctbal") < 0, "Low").when(F.col("s_acctbal") < 5000, "Medium").otherwise("High")
    rows = table(spark, sf_dir, "supplier").join(F.broadcast(place), F.col("s_nationkey") == F.col("n_nationkey"))  # a row per nation
    records = rows.select(F.col("r_name").alias("division"), F.when(F.col("s_suppkey") % 3 == 2, F.concat(F.lit("Near "), "n_name")).otherwise(F.col("n_name")).alias("district"), *[(risk if c == "risk" else zone).alias(c) for c, *_ in G.RISK_METRICS])
    made = []
    for run in ("first", "again"):
        counts, _ = runs.import_risk(store, records, units, "DDM", "2020", "2024-01-01")
        made += [(run, name, n) for name, n in {**counts, "stored": store.count("exposures")}.items()]
    return spark.createDataFrame(made, "run string, name string, n long")


#: Places whose targets ask for more than small tables have.
PLACES = {"CORE": 120, "WEST": 120, "OTHER": 60}
_CUTS = f"""m AS (SELECT unnest(range(8)) AS set), b AS (SELECT unnest(['CORE', 'OTHER', 'WEST']) AS g, unnest([120, 60, 120]) AS t, unnest([0, 1, 2]) AS bit),
s AS (SELECT unnest({list(SECTORS)}) AS f, unnest({list(SECTORS.values())}) AS target),
h AS (SELECT set, f, least(target, count(id)) AS held FROM m CROSS JOIN s LEFT JOIN (SELECT * FROM cand JOIN b ON g = geography_group) c ON c.sector_family = f AND (set >> bit) % 2 = 1 GROUP BY set, f, target)"""


@query(
    "joint_freeze_cuts",
    f"""WITH {CANDIDATES_SQL}, {_CUTS}, a AS (SELECT set, sum(held)::BIGINT AS available FROM h GROUP BY set),
n AS (SELECT set, coalesce(string_agg(g, '+' ORDER BY g), '') AS places, coalesce(sum(t), 0)::BIGINT AS needed FROM m LEFT JOIN b ON (set >> bit) % 2 = 1 GROUP BY set)
SELECT places, needed, available, greatest(0, needed - available) AS gap FROM n JOIN a USING (set)""",
)
def joint_freeze_cuts(spark, sf_dir):
    """Whether a joint sample exists: every set of places, what it needs and what it can have."""
    return S.cuts(candidates(spark, sf_dir), SECTORS, PLACES)


@query(
    "joint_freeze_check",
    f"""WITH {SAMPLE_SQL} SELECT 'sector_family' AS dimension, sector_family AS label, count(*) AS chosen, 0::BIGINT AS skipped FROM sample GROUP BY ALL
 UNION ALL SELECT 'geography_group', geography_group, count(*), 0 FROM sample GROUP BY ALL""",
)
def joint_freeze_check(spark, sf_dir):
    """A joint sample meets both kinds of target (the margins of the quota sample) and takes the first ids of every cell."""
    rows = candidates(spark, sf_dir)
    chosen = S.quota_sample(rows, 400, SECTORS, REGIONS)
    sectors, places = ({r[0]: r[1] for r in chosen.groupBy(c).count().collect()} for c in ("sector_family", "geography_group"))  # a row per label
    frozen = S.joint_freeze(rows, sectors, places)
    cell = ["sector_family", "geography_group"]
    last = frozen.groupBy(*cell).agg(F.max("id").alias("last"))
    left_out = rows.join(frozen.select("id", F.lit(True).alias("in")), "id", "left").join(last, cell).filter("in is null and id < last").groupBy(*cell).agg(F.count("*").alias("skipped"))
    made = frozen.groupBy(*cell).agg(F.count("*").alias("chosen")).join(left_out, cell, "left").fillna(0, ["skipped"])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("label")) for c in cell])).alias("d")
    return made.select(each, "chosen", "skipped").groupBy("d.dimension", "d.label").agg(F.sum("chosen").alias("chosen"), F.sum("skipped").alias("skipped"))


@query(
    "labelled_samples",
    """SELECT o_orderpriority AS label, o_orderkey AS id, CASE WHEN o_orderpriority LIKE '1%' THEN 'second' ELSE 'first' END AS version FROM orders
  WHERE o_orderpriority NOT LIKE '1%' OR o_orderkey % 2 = 0""",
)
def labelled_samples(spark, sf_dir):
    """A version of every label; then one label is replaced. Each is read from its own folder."""
    store = LogStore(spark, new_path(spark, "labels"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"))
    labels = sorted(r[0] for r in rows.select("priority").distinct().collect())  # a handful of priorities

    def own(label: str, name: str):
        return rows.filter(F.col("priority") == label).select("id", F.lit(name).alias("name"))

    for seq, label in enumerate(labels):
        store.replace("sample", label, own(label, "first"), "2024-01-01", seq)
    first = next(x for x in labels if x.startswith("1"))
    store.replace("sample", first, own(first, "second").filter("id % 2 = 0"), "2024-01-02", 100)
    parts = [store.current("sample", label, "id long, name string").select(F.lit(label).alias("label"), "id", F.col("name").alias("version")) for label in labels]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


@query("landed_events", "SELECT event_id, user_id, event_type, value FROM events")
def landed_events(spark, sf_dir):
    """Events that arrive in overlapping pieces; the stream stops after the first and starts again with the second."""
    root = new_path(spark, "landing")
    rows = with_hash(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"), "event_id", "user_id", "event_type", "value")
    written = 0
    for piece in ("event_id % 3 < 2", "event_id % 3 > 0", "event_id % 3 > 0"):
        rows.filter(piece).write.mode("append").parquet(f"{root}/in")
        written += ingest_once(spark, f"{root}/in", rows.schema, f"{root}/log", f"{root}/checkpoint", ["content_sha256"])
    made = spark.read.parquet(f"{root}/log")
    return made.select("event_id", "user_id", "event_type", "value")


@query(
    "universe_member_rows",
    """SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS observation_id, o_orderpriority AS name, o_orderstatus AS status, o_orderdate AS observed_at
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'""",
)
def universe_member_rows(spark, sf_dir):
    """Members of one of three universes with their observations, both tables in buckets of the observation."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    members = lines.select(F.col("l_returnflag").alias("universe_label"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("observation_id"))
    observed = orders.select(F.col("o_orderkey").alias("observation_id"), F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("observed_at"))
    made = R.member_rows(bucketed(members, "observation_id", buckets, "members"), bucketed(observed, "observation_id", buckets, "observations"), "R")
    return made.select("id", "observation_id", "name", "status", "observed_at")


@query(
    "exposure_profile_export",
    f"""WITH {LINKS_SQL} SELECT establishment_ref, name, district, sector_family, count(domain) AS linked_observations, coalesce(string_agg(DISTINCT domain, '+' ORDER BY domain), '') AS domains,
  coalesce(bool_or(attribution = 'SITE_SPECIFIC'), false) AS has_site_specific_evidence FROM reg LEFT JOIN links USING (establishment_ref) GROUP BY establishment_ref, name, district, sector_family""",
)
def exposure_profile_export(spark, sf_dir):
    """Exposure profiles of all establishments as one JSON array, written by executors and read back."""
    rows = with_ref(spark, sf_dir)
    profiles = G.establishment_profiles(rows, G.links(rows, observations(spark, sf_dir)))
    path = new_path(spark, "profiles")
    export_json_array(profiles, ["establishment_ref"], path)
    made = read_json_array(spark, path, profiles.schema)
    return made.select("establishment_ref", "name", "district", "sector_family", "linked_observations", F.array_join("domains_with_evidence", "+").alias("domains"), "has_site_specific_evidence")


@query(
    "layout_upgrade",
    """SELECT l_orderkey, l_partkey AS part_ref, l_linenumber, CASE WHEN l_orderkey % 2 = 1 THEN l_returnflag ELSE 'UNKNOWN' END AS flag, 'BBS' AS geo_source, l_quantity FROM lineitem""",
)
def layout_upgrade(spark, sf_dir):
    """Lines in two files of an old layout, one of them without a column, brought to the third layout; every row stays."""
    steps = [with_columns(flag="UNKNOWN"), lambda rows: renamed(l_partkey="part_ref")(with_columns(geo_source="BBS")(rows))]
    held = VersionedTable(spark, new_path(spark, "layouts"), "lines", steps)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", F.col("l_returnflag").alias("flag"))
    held.append(rows.filter("l_orderkey % 2 = 0").drop("flag"))
    held.append(rows.filter("l_orderkey % 2 = 1"))
    if list(held.upgrade()) != [2, 3] or held.upgrade():
        raise ValueError("the layouts weren't brought up once each")
    return held.read().select("l_orderkey", "part_ref", "l_linenumber", "flag", "geo_source", "l_quantity")
