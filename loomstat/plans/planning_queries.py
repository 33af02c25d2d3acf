"""Queries on samples, plans, quality gates, lifecycle and sources."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import lifecycle as L
from ..operators import quality as Q
from ..operators import sampling as S
from ..sources import html, tables
from .domain import FAMILY_SQL, REGION_RULES, REGISTRY_SQL, SEGMENT_RULES, registry, table
from .registry import query

SECTORS = {code: n for code, n, _ in SEGMENT_RULES}
REGIONS = {code: n for code, n, _ in REGION_RULES}


def candidates(spark, sf_dir):
    rows = registry(spark, sf_dir)
    return rows.select("id", X.by_rules(F.col("sector_label"), SEGMENT_RULES, "OTHER_MANUFACTURING").alias("sector_family"), X.by_rules(F.col("division"), REGION_RULES, "OTHER").alias("geography_group"))


def _case(values, column):
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " ELSE 0 END"


CANDIDATES_SQL = f"""{REGISTRY_SQL}, cand AS (SELECT id, {FAMILY_SQL.format("sector_label", "OTHER_MANUFACTURING")} AS sector_family,
 CASE WHEN division = 'ASIA' THEN 'CORE' WHEN division IN ('AMERICA', 'EUROPE') THEN 'WEST' ELSE 'OTHER' END AS geography_group FROM registry)"""
SAMPLE_SQL = f"""{CANDIDATES_SQL}, q AS (SELECT *, row_number() OVER (PARTITION BY sector_family ORDER BY id) <= {_case(SECTORS, "sector_family")} AS q FROM cand),
f AS (SELECT *, NOT q AND row_number() OVER (PARTITION BY geography_group, q ORDER BY id) <= greatest(0, {_case(REGIONS, "geography_group")} - count(*) FILTER (WHERE q) OVER (PARTITION BY geography_group)) AS f FROM q),
st AS (SELECT *, CASE WHEN q THEN 0 WHEN f THEN 1 ELSE 2 END AS stage FROM f),
sample AS (SELECT id, sector_family, geography_group, ['SECTOR_QUOTA', 'GEOGRAPHY_FILL', 'GENERAL_FILL'][stage + 1] AS selection_stage FROM st QUALIFY row_number() OVER (ORDER BY stage, id) <= 400)"""


@query("quota_sample", f"WITH {SAMPLE_SQL} SELECT * FROM sample")
def quota_sample(spark, sf_dir):
    return S.quota_sample(candidates(spark, sf_dir), 400, SECTORS, REGIONS)


@query("sample_composition", f"""WITH {SAMPLE_SQL} SELECT 'sector_family' AS dimension, sector_family AS label, count(*) AS n FROM sample GROUP BY ALL UNION ALL
 SELECT 'geography_group', geography_group, count(*) FROM sample GROUP BY ALL UNION ALL SELECT 'selection_stage', selection_stage, count(*) FROM sample GROUP BY ALL""")
def sample_composition(spark, sf_dir):
    rows = S.quota_sample(candidates(spark, sf_dir), 400, SECTORS, REGIONS)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("label")) for c in ("sector_family", "geography_group", "selection_stage")])).alias("d")
    return rows.select(each).groupBy("d.dimension", "d.label").agg(F.count("*").alias("n"))


@query("progressive_batches", f"""WITH {SAMPLE_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY sector_family, geography_group ORDER BY sha256('test:' || id)) AS k, count(*) OVER (PARTITION BY sector_family, geography_group) AS size FROM sample),
 n AS (SELECT *, row_number() OVER (ORDER BY (2 * k - 1) / (2 * size), sector_family, geography_group) AS sequence_no FROM k)
 SELECT id, sector_family, geography_group, sequence_no, CASE WHEN sequence_no <= 50 THEN 50 WHEN sequence_no <= 150 THEN 150 WHEN sequence_no <= 400 THEN 400 END AS first_checkpoint FROM n""")
def progressive_batches(spark, sf_dir):
    return S.progressive_batches(S.quota_sample(candidates(spark, sf_dir), 400, SECTORS, REGIONS), "test", (50, 150, 400))


@query("joint_freeze")
def joint_freeze(spark, sf_dir):
    rows = candidates(spark, sf_dir)
    chosen = S.quota_sample(rows, 400, SECTORS, REGIONS)  # its margins are targets that can be met together
    sectors, places = ({r[0]: r[1] for r in chosen.groupBy(c).count().collect()} for c in ("sector_family", "geography_group"))
    return S.joint_freeze(rows, sectors, places)


@query("pool_health", f"""WITH {CANDIDATES_SQL}, t AS (SELECT * FROM (VALUES {", ".join(f"('{k}', {v * 10})" for k, v in SECTORS.items())}) t(sector_family, target))
 SELECT sector_family, target::BIGINT AS target, count(id) AS candidates, greatest(0, target - count(id))::BIGINT AS deficit, count(id) >= target AS ready FROM t LEFT JOIN cand USING (sector_family) GROUP BY sector_family, target""")
def pool_health(spark, sf_dir):
    return S.pool_health(candidates(spark, sf_dir), "sector_family", {k: v * 10 for k, v in SECTORS.items()})


def universes(spark, sf_dir):
    return registry(spark, sf_dir).groupBy(F.col("sector_family").alias("family"), F.col("district").alias("label")).agg((F.count("*") * 100).alias("total"))


_UNIVERSES = f"""{REGISTRY_SQL}, u AS (SELECT sector_family AS family, district AS label, count(*) * 100 AS total FROM registry GROUP BY ALL),
w AS (SELECT *, least(total, greatest(30, ceil(CASE family {" ".join(f"WHEN '{k}' THEN {-int(-v * 60.0 // 1)}" for k, v in SECTORS.items())} ELSE 30 END * total / sum(total) OVER (PARTITION BY family))))::BIGINT AS wanted FROM u)"""


@query("proportional_allocation", f"WITH {_UNIVERSES} SELECT * FROM w")
def proportional_allocation(spark, sf_dir):
    return S.proportional_rows(universes(spark, sf_dir), SECTORS, 60.0)


@query("spread_pages", f"""WITH {_UNIVERSES}, p AS (SELECT *, ceil(total / 30)::INT AS m, greatest(1, least(ceil(total / 30), ceil(wanted / 30)))::INT AS n FROM w),
 x AS (SELECT DISTINCT family, label, total, wanted, CASE WHEN n = 1 THEN 1 ELSE 1 + round_even(i * (m - 1) / (n - 1), 0)::INT END AS page FROM (SELECT *, unnest(range(n)) AS i FROM p)) SELECT * FROM x WHERE page > 1""")
def spread_pages(spark, sf_dir):
    return S.page_plan(S.proportional_rows(universes(spark, sf_dir), SECTORS, 60.0))


@query("full_page_plan", "SELECT o_custkey AS run_id, n AS expected_total, page::INT AS page, greatest(0, least(3, n - (page - 1) * 3)) AS records_due FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), unnest(range(1, CAST(ceil(n / 3) AS INT) + 1)) t(page)")
def full_page_plan(spark, sf_dir):
    runs = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("run_id")).agg(F.count("*").alias("expected_total"))
    return S.full_page_plan(runs, 3)


def pages(spark, sf_dir):
    """Orders as pages of 5 line items a page at most."""
    n = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return n.select(F.col("l_orderkey").alias("page"), F.when(F.col("n") > 0, "STAGED").alias("status"), F.lit(1000).cast("long").alias("source_reported_total"))


@query("universe_quality", """SELECT count(DISTINCT l_orderkey) AS pages, count(DISTINCT l_orderkey) AS staged, 0 AS failed, 0 AS skipped, 1000 AS least_total, 1000 AS most_total, count(*) AS membership_rows, count(DISTINCT l_partkey) AS unique_ids,
 count(*) - count(DISTINCT l_partkey) AS duplicate_ids, TRUE AS stable_total, FALSE AS eligible FROM lineitem""")
def universe_quality(spark, sf_dir):
    return Q.universe_quality(pages(spark, sf_dir), table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_partkey").alias("id")), 1000)


@query("page_faults", """WITH m AS (SELECT l_orderkey AS page, l_partkey AS id FROM lineitem), f AS (SELECT id, min(page) AS first_page FROM m GROUP BY 1),
 c AS (SELECT page, count(*) AS records, count(DISTINCT id) AS ids FROM m GROUP BY 1), a AS (SELECT page, count(DISTINCT id) AS known_ids FROM m JOIN f USING (id) WHERE page > first_page GROUP BY 1),
 j AS (SELECT page, records, ids, coalesce(known_ids, 0) AS known_ids FROM c LEFT JOIN a USING (page))
 SELECT *, CASE WHEN records <> greatest(0, least(4, 100000 - (page - 1) * 4)) THEN 'CARDINALITY' ELSE 'DUPLICATE_ID' END AS fault FROM j WHERE records <> greatest(0, least(4, 100000 - (page - 1) * 4)) OR ids < records OR known_ids > 0""")
def page_faults(spark, sf_dir):
    m = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_partkey").alias("id"))
    p = m.select("page").distinct().withColumn("source_reported_total", F.lit(100000))
    return Q.page_faults(m, p, 100000, 4)


@query("index_quality", r"""SELECT count(*) AS records, count(*) - count(DISTINCT page_id) AS duplicate_keys, 0 AS missing_names, count(*) FILTER (WHERE coalesce(nullif(regexp_extract(url, '/en/(\d+)(?:[/?#]|$)', 1), ''), '') <> (page_id % 10)::VARCHAR) AS invalid_detail_urls FROM pages""")
def index_quality(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select((F.col("page_id") % 10).cast("string").alias("source_key"), F.col("html").alias("entity_name"), F.col("url").alias("detail_url"), "page_id")
    made = Q.index_quality(rows, "en")
    keys = rows.agg((F.count("*") - F.countDistinct("page_id")).alias("k"))
    return made.crossJoin(keys).select("records", F.col("k").alias("duplicate_keys"), "missing_names", "invalid_detail_urls")


def comparisons(spark, sf_dir):
    """Labels against documents: what was listed and what the detail says."""
    l, d = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    rows = l.join(d.select("doc_id", "lang", "source"), "doc_id", "left")
    none = F.lit(None).cast("string")
    status = F.when(F.col("doc_id") % 11 == 0, "FAILED").when(F.col("doc_id") % 13 == 0, "PLANNED").otherwise("PARSED")
    return rows.select(
        F.col("doc_id").alias("public_id"), F.col("lang").alias("sector_family"), status.alias("request_status"), (F.col("quality") == 1).alias("parser_valid"), (F.col("toxic") == 0).alias("core_complete"),
        F.col("source").alias("list_name"), F.col("lang").alias("list_sector"), F.col("lang").alias("list_district"), F.lit("a").alias("list_status"), none.alias("list_class"),
        F.col("source").alias("detail_name_en"), none.alias("detail_name_bn"), F.col("lang").alias("detail_sector"), F.when(F.col("doc_id") % 7 == 0, "xx").otherwise(F.col("lang")).alias("detail_district"),
        F.when(F.col("toxic") == 1, "b").otherwise("A.").alias("detail_status"), none.alias("detail_class"),
    )


ANOMALY_SQL = """c AS (SELECT doc_id AS public_id, lang, quality, toxic, CASE WHEN doc_id % 11 = 0 THEN 'FAILED' WHEN doc_id % 13 = 0 THEN 'PLANNED' ELSE 'PARSED' END AS rs FROM labels LEFT JOIN documents USING (doc_id)),
an AS (SELECT public_id, 'RETRIEVAL_FAILURE' AS anomaly_type, 'CRITICAL' AS severity FROM c WHERE rs = 'FAILED' UNION ALL SELECT public_id, 'UNRESOLVED_REQUEST', 'CRITICAL' FROM c WHERE rs = 'PLANNED'
 UNION ALL SELECT public_id, 'PARSER_INVALID', 'CRITICAL' FROM c WHERE rs = 'PARSED' AND quality <> 1 UNION ALL SELECT public_id, 'DISTRICT_MISMATCH', 'HIGH' FROM c WHERE rs = 'PARSED' AND public_id % 7 = 0 AND coalesce(lang, '') <> ''
 UNION ALL SELECT public_id, 'STATUS_MISMATCH', 'HIGH' FROM c WHERE rs = 'PARSED' AND toxic = 1 UNION ALL SELECT public_id, 'CORE_FIELDS_INCOMPLETE', 'MEDIUM' FROM c WHERE rs = 'PARSED' AND toxic <> 0)"""


@query("anomalies", f"WITH {ANOMALY_SQL} SELECT * FROM an")
def anomalies(spark, sf_dir):
    return Q.anomalies(comparisons(spark, sf_dir))


@query("severity_counts", f"WITH {ANOMALY_SQL} SELECT severity, anomaly_type, count(*) AS n FROM an GROUP BY ALL")
def severity_counts(spark, sf_dir):
    made = Q.anomalies(comparisons(spark, sf_dir)).groupBy("severity", "anomaly_type").agg(F.count("*").alias("n"))
    return made.orderBy(Q.severity_order(), "anomaly_type")


@query("anomaly_breakdown", f"""WITH {ANOMALY_SQL}, g AS (SELECT public_id, count(*) AS n, count(*) FILTER (WHERE severity = 'CRITICAL') AS k FROM an GROUP BY 1)
 SELECT lang AS sector_family, count(*) AS records, count(*) FILTER (WHERE rs = 'PARSED') AS parsed, count(*) FILTER (WHERE n > 0) AS with_anomaly, count(*) FILTER (WHERE k > 0) AS with_critical FROM c LEFT JOIN g USING (public_id) GROUP BY 1""")
def anomaly_breakdown(spark, sf_dir):
    rows = comparisons(spark, sf_dir)
    return Q.breakdown(rows, Q.anomalies(rows), "sector_family")


@query("checkpoint_rates", """WITH c AS (SELECT CASE WHEN doc_id % 11 = 0 THEN 'FAILED' ELSE 'PARSED' END AS s, quality = 1 AS v, toxic = 0 AS k FROM labels)
 SELECT count(*) AS planned, count(*) FILTER (WHERE s = 'PARSED') AS parsed, count(*) FILTER (WHERE s = 'FAILED') AS failed, count(*) FILTER (WHERE s = 'PARSED') / count(*) AS retrieval_rate,
 count(*) FILTER (WHERE s = 'PARSED' AND v) / count(*) FILTER (WHERE s = 'PARSED') AS parser_rate, count(*) FILTER (WHERE s = 'PARSED' AND k) / count(*) FILTER (WHERE s = 'PARSED') AS core_rate FROM c""")
def checkpoint_rates(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select(F.when(F.col("doc_id") % 11 == 0, "FAILED").otherwise("PARSED").alias("status"), (F.col("quality") == 1).alias("parser_valid"), (F.col("toxic") == 0).alias("core_complete"), F.lit(True).alias("has_provenance"), F.lit(True).alias("url_ok"))
    return Q.checkpoint_metrics(rows).select("planned", "parsed", "failed", "retrieval_rate", "parser_rate", "core_rate")


@query("lifecycle_states", "SELECT o_custkey::VARCHAR AS entity, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status, count(*) AS attempts FROM orders GROUP BY 1")
def lifecycle_states(spark, sf_dir):
    events = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("entity"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("seq"))
    return L.attempts(events).select("entity", "status", "attempts")


_HEADING = "regexp_extract(html, '<h1>([^<]*)</h1>', 1)"
for _entity, _char in (("&lt", "<"), ("&gt", ">"), ("&quot", '"'), ("&#x27", "''"), ("&#39", "''"), ("&amp", "&")):  # HTML reads them without a semicolon, too
    _HEADING = f"regexp_replace({_HEADING}, '{_entity};?', '{_char}', 'g')"


@query("page_links", f"SELECT page_id, len(regexp_extract_all(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<a ')) AS links, trim(regexp_replace({_HEADING}, '\\s+', ' ', 'g')) AS heading FROM pages")
def page_links(spark, sf_dir):
    rows = table(spark, sf_dir, "pages")

    @F.arrow_udf("struct<links:long, heading:string>")
    def read(pages: pa.Array) -> pa.Array:
        links, headings = [], []
        for x in pages:  # one page and its tree at a time
            t = html.tree(x.as_py())
            links.append(len(t.all("a")))
            headings.append(next((h.text() for h in t.all("h1")), "") or "")
            t.clear()
        return pa.StructArray.from_arrays([pa.array(links, pa.int64()), pa.array(headings, pa.string())], names=["links", "heading"])

    return rows.select("page_id", read.asNondeterministic()("html").alias("r")).select("page_id", "r.links", "r.heading")


@query("table_counts", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in ("region", "nation", "customer", "orders")))
def table_counts(spark, sf_dir):
    return tables.table_counts(spark, sf_dir, ["region", "nation", "customer", "orders"])
