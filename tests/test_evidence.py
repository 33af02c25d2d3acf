import pytest
from pyspark.sql import functions as F

from loomstat.operators import evidence as E
from loomstat.operators import lifecycle as L
from loomstat.operators import sampling as S

FIELDS = "entity long, observation_type string, source_name string, scope string, match_type string, site_attributable boolean, value_text string, value_numeric double, unit string, source_updated_at_raw string, observed_at string"


def obs(spark, *rows):
    return spark.createDataFrame([(1, t, s, scope, "EXACT_SITE", site, str(v), v if isinstance(v, float) else None, None, vintage, at) for t, s, scope, site, v, vintage, at in rows], FIELDS)


def test_change_signal(spark):
    h = obs(spark, ("EMPLOYMENT_COUNT", "A", "SITE", True, 1000.0, None, "2025-01-01"), ("EMPLOYMENT_COUNT", "A", "SITE", True, 1200.0, None, "2026-01-01"), ("EMPLOYMENT_COUNT", "B", "SITE", True, 5.0, None, "2026-01-01"))
    got = E.change_signals(h).collect()
    assert [(r["source"], r["absolute_change"], r["percent_change"]) for r in got] == [("A", 200.0, 20.0)]
    shuffled = E.change_signals(h.orderBy(F.desc("observed_at"))).collect()
    assert shuffled == got


def test_consistency_and_bands(spark):
    e = E.approved(obs(spark, ("EMPLOYMENT_COUNT", "A", "SITE", True, 1000.0, None, None), ("EMPLOYMENT_COUNT", "B", "SITE", True, 1080.0, None, None), ("MACHINE_COUNT", "A", "SITE", True, 3.0, None, None), ("SECRET", "A", "SITE", True, 3.0, None, None)))
    assert {r["observation_type"]: r["band"] for r in E.source_consistency(e).collect()} == {"EMPLOYMENT_COUNT": "CONSISTENT", "MACHINE_COUNT": "NOT_CHECKED"}
    base = spark.createDataFrame([(1, 1000)], "entity long, worker_total long")
    got = E.employment_consistency(base, e).first()
    assert (got["value"], got["worst_difference_pct"], got["comparisons"]) == ("CONSISTENT_WITHIN_10_PERCENT", 8.0, 2)


def test_freshness(spark):
    e = E.approved(obs(spark, ("HS_CODE", "A", "ORGANIZATION", False, "x", "2026", "2026-01-10"), ("HS_CODE", "B", "ORGANIZATION", False, "y", "2025-12", "2026-06-01")))
    got = E.freshness(e, "2026-07-01").first()
    assert (got["age_days"], got["band"], got["basis_field"], got["source"]) == (172, "CURRENT", "observed_at", "A")


def test_breadths(spark):
    e = E.approved(obs(spark, ("HS_CODE", "A", "ORGANIZATION", False, "6109", None, None), ("HS_CODE", "A", "ORGANIZATION", False, "6109", None, None), ("EXPORT_MARKET", "B", "SITE", False, "EU", None, None)))
    assert e.count() == 2
    assert (lambda r: (r["value"], r["label"]))(E.export_breadth(e).first()) == (2, "MULTI_SOURCE")
    assert (lambda r: (r["hs_code_count"], r["market_count"], r["evidence_sources"]))(E.product_breadth(e).first()) == (1, 0, ["A"])


def test_typed_observations(spark):
    r = spark.createDataFrame([
        (1, "BGMEA", {"Employees": "1,250", "Production Capacity": "2.5 million pcs/year", "Principal Products": "a; b", "Export Markets": "EU; USA", "Other": "x"}),
        (2, "EPB", {"HS Code": "6109, 6110; 6203", "Category": "Large"}), (3, "DOE", {"Employees": "3"}),
    ], "record_id long, source string, source_fields map<string,string>")
    got = sorted((x["record_id"], x["observation_type"], x["scope"], x["value_text"], x["value_numeric"], x["unit"]) for x in E.typed_observations(r).collect())
    assert [x for x in got if x[0] == 1] == [
        (1, "ASSOCIATION_MEMBERSHIP_RECORD", "ORGANIZATION", "present", None, None), (1, "EMPLOYMENT_COUNT", "SITE", "1,250", 1250.0, None), (1, "EXPORT_MARKET", "ORGANIZATION", "EU", None, None), (1, "EXPORT_MARKET", "ORGANIZATION", "USA", None, None),
        (1, "PRINCIPAL_PRODUCT", "SITE", "a", None, None), (1, "PRINCIPAL_PRODUCT", "SITE", "b", None, None), (1, "PRODUCTION_CAPACITY", "SITE", "2.5 million pcs/year", 2.5e6, "pcs/year"),
    ]
    assert [x[3] for x in got if x[1] == "HS_CODE"] == ["6109", "6110", "6203"] and not [x for x in got if x[0] == 3]


def test_payload(spark):
    o = obs(spark, ("EMPLOYMENT_COUNT", "A", "SITE", True, 1080.0, None, "2026-01-01"), ("HS_CODE", "A", "ORGANIZATION", False, "6109", None, "2026-01-01"))
    base = spark.createDataFrame([(1, "x", 1000), (2, "y", None)], "entity long, name string, worker_total long")
    got = {r["entity"]: r for r in E.product_payloads(base, o, o, None, "2026-02-01").collect()}
    assert got[1]["calculated"]["employment_scale_band"] == "1000_PLUS" and got[2]["calculated"]["employment_scale_band"] == "UNKNOWN"
    assert got[1]["calculated"]["employment_consistency"]["value"] == "CONSISTENT_WITHIN_10_PERCENT" and len(got[1]["facts"]["hs_codes"]) == 1 and got[2]["evidence"] == []


def test_cluster_context(spark):
    u = spark.createDataFrame([("D", "F"), ("D", "F"), ("D", "G"), ("E", "F")], "district string, sector_family string")
    t = spark.createDataFrame([(1, "D", "F"), (2, None, "F")], "id long, district string, sector_family string")
    got = {r["id"]: r for r in E.cluster_context(t, u).collect()}
    assert got[1]["district_sector_share_of_district"] == 66.67 and got[2]["district_sector_share_of_district"] is None and got[2]["sector_establishments"] == 3


def candidates(spark, *cells):
    rows, k = [], 0
    for s, g, n in cells:
        for _ in range(n):
            k += 1
            rows.append((k, s, g))
    return spark.createDataFrame(rows, "id long, sector_family string, geography_group string")


def test_freeze_needs_joint_cells(spark):
    c = candidates(spark, ("A", "X", 1), ("A", "Y", 1), ("B", "X", 1), ("B", "Y", 1))
    assert S.joint_freeze(c, {"A": 1, "B": 1}, {"X": 1, "Y": 1}).count() == 2
    bad = candidates(spark, ("A", "X", 2), ("B", "X", 2), ("C", "Y", 2))
    with pytest.raises(S.FreezeError) as e:
        S.joint_freeze(bad, {"A": 1, "B": 1}, {"X": 1, "Y": 1})
    assert e.value.diagnostics["flow_gap"] == 1
    with pytest.raises(ValueError):
        S.joint_freeze(c, {"A": 1}, {"X": 2})


def test_freeze_reroutes(spark):
    c = candidates(spark, ("A", "X", 5), ("A", "Y", 5), ("B", "X", 5))
    got = S.joint_freeze(c, {"A": 5, "B": 5}, {"X": 5, "Y": 5}).groupBy("sector_family", "geography_group").count().collect()
    assert {(r[0], r[1]): r[2] for r in got} == {("A", "Y"): 5, ("B", "X"): 5}


def test_progressive_prefixes(spark):
    c = candidates(spark, ("A", "X", 60), ("B", "Y", 40))
    got = S.progressive_batches(c, "l", (10, 50, 100)).orderBy("sequence_no").collect()
    assert sum(r["sector_family"] == "A" for r in got[:10]) == 6
    assert [sum(r["first_checkpoint"] == n for r in got) for n in (10, 50, 100)] == [10, 40, 50]


def test_sample_and_health(spark):
    c = candidates(spark, ("RMG_TEXTILE", "CORE_DHAKA", 2))
    got = {r["sector_family"]: r["deficit"] for r in S.pool_health(c, "sector_family", S.SECTOR_TARGETS).collect()}
    assert got["RMG_TEXTILE"] == 498 and got["FOOD_AGRO"] == 300
    u = spark.createDataFrame([("F", "a", 4000), ("F", "b", 4), ("F", "c", 0)], "family string, label string, total long")
    got = {r["label"]: r["wanted"] for r in S.proportional_rows(u, {"F": 300}).collect()}
    assert got["b"] == 4 and got["a"] >= 30 and "c" not in got
    made = S.quota_sample(candidates(spark, ("A", "X", 5), ("B", "Y", 5), ("C", "Y", 5)), 8, {"A": 2, "B": 2}, {"X": 3, "Y": 3}).collect()
    assert len(made) == 8 and sum(r["selection_stage"] == "SECTOR_QUOTA" for r in made) == 4


def test_page_plans(spark):
    assert [r["records_due"] for r in S.full_page_plan(spark.createDataFrame([(1, 65)], "run_id long, expected_total long"), 30).orderBy("page").collect()] == [30, 30, 5]
    assert S.index_page_plan(spark.createDataFrame([(1, 4), (None, 3), (2, 2)], "current_page int, last_page int")).count() == 3
    o = spark.createDataFrame([("INDUSTRIAL_SECTOR", "7", "x"), ("DISTRICT", "1", "y")], "dimension string, source_value string, source_label string")
    assert [r["url"] for r in S.seed_requests(o, F.lit("F"), "https://h/p").collect()] == ["https://h/p?industry_id=7&page=1"]
    d = spark.createDataFrame([("G", str(k), f"d{k}") for k in range(5)], "geography_group string, value string, label string")
    s = spark.createDataFrame([(str(k), f"s{k}", k) for k in range(5)], "value string, label string, total long")
    assert S.geographic_seeds(d, s, {"G": 3, "H": 0}, "https://h/p").count() == 9
    assert [r["k"] for r in S.spread_items(spark.range(9).selectExpr("1 AS g", "id AS k"), "g", ["k"], 3).orderBy("k").collect()] == [0, 4, 8]


def test_lifecycle(spark):
    ev = lambda *x: spark.createDataFrame([(e, s, None, k, None) for k, (e, s) in enumerate(x)], "entity string, status string, at string, seq long, note string").withColumn("at", F.timestamp_seconds("seq"))
    log = ev(("a", "PLANNED"), ("b", "PLANNED"), ("b", "STAGED"))
    ok, bad = L.transitions(log, ev(("a", "FAILED"), ("b", "PLANNED"), ("c", "PLANNED"), ("d", "STAGED")))
    assert sorted(r["entity"] for r in ok.collect()) == ["a", "c"] and sorted(r["entity"] for r in bad.collect()) == ["b", "d"]
    manifest = spark.createDataFrame([("b", 1), ("a", 2)], "entity string, sequence_no int")
    assert [r["entity"] for r in L.due(log, manifest).collect()] == ["a"]
    stages = L.progressive_validation(lambda n: {"planned": n, "unresolved": int(n == 500), **{f"{k}_rate": 1.0 for k in ("retrieval", "parser", "provenance", "url", "core")}}, (100, 500, 2000))
    assert [s["passed"] for s in stages] == [True, False]
