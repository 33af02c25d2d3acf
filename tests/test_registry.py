import pytest
from pyspark.sql import functions as F

from loomstat.operators import quality as Q
from loomstat.operators import rollups as R
from loomstat.operators import versioning as V

SCHEMA = "id long, name string, district string, division string, sector_label string, sector_family string, status string"
ROWS = [(1, "a", "D1", "V", "s", "RMG", "ok"), (2, "b", "D1", "V", "s", "RMG", "ok"), (3, "c", "D2", "V", "t", "FOOD", "ok"), (4, "d", "D2", "V", "", "FOOD", None)]


@pytest.fixture
def registry(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_cells(registry):
    got = {(r["district"], r["sector_family"]): r for r in R.cells(registry).collect()}
    assert got["D1", "RMG"]["share_of_district_pct"] == got["D1", "RMG"]["share_of_national_sector_pct"] == 100.0
    assert got["D1", "RMG"]["location_quotient"] == 2.0


def test_composition_folds_null_and_empty(registry):
    assert {r["label"]: r["share_pct"] for r in R.composition(registry, "status").collect()} == {"ok": 75.0, "UNKNOWN": 25.0}
    assert {r["label"] for r in R.composition(registry, "sector_label").collect()} == {"s", "t", "UNKNOWN"}


def test_concentration_and_dashboard(registry):
    assert {r["sector_family"]: r["district_hhi"] for r in R.sector_concentration(registry).collect()} == {"RMG": 1.0, "FOOD": 1.0}
    made = R.dashboard(registry, "u", "now", 4)
    assert made["summary"]["establishments"] == 4 and sum(x["establishments"] for x in made["districts"]) == 4
    assert abs(sum(x["share_national_pct"] for x in made["districts"]) - 100) < 1e-9
    with pytest.raises(ValueError):
        R.dashboard(registry, "u", "now", 5)


def test_profiles_and_drilldown(registry):
    assert R.profiles(registry, "district", "now").count() == 2
    assert R.drilldown(registry, {}).count() == 0 and R.drilldown(registry, {"status": None}).count() == 1


def test_registry_rows_refuse_repeated_ids(registry):
    assert R.registry_rows(registry, "u", "now").count() == 4
    with pytest.raises(Exception, match="repeated public id"):
        R.registry_rows(registry.union(registry), "u", "now").collect()


def test_latest_append_upsert(spark, rows):
    log = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "k string, t int, v string")
    assert sorted(rows(V.latest_by(log, ["k"], [F.desc("t")]))) == [("a", 2, "y"), ("b", 1, None)]
    new = spark.createDataFrame([("b", 3, "z"), ("c", 3, "w"), ("c", 3, "w")], "k string, t int, v string")
    assert sorted(rows(V.append_new(log, new, ["k"]))) == [("c", 3, "w")]
    first = spark.createDataFrame([("a", 1, "x")], "k string, t int, v string")
    again = spark.createDataFrame([("a", 5, None), ("b", 5, "q")], "k string, t int, v string")
    assert sorted(rows(V.upsert(first, again, ["k"], "t")), key=str) == [("a", 1, None), ("b", 5, "q")]
    assert sorted(rows(V.upsert(first, again, ["k"], "t", ("v",))), key=str) == [("a", 1, "x"), ("b", 5, "q")]


def test_universe_quality(spark):
    pages = spark.createDataFrame([(1, "STAGED", 5), (2, "STAGED", 5)], "page int, status string, source_reported_total long")
    ids = lambda *x: spark.createDataFrame([(1, i) for i in x], "page int, id long")
    assert Q.universe_quality(pages, ids(1, 2, 3, 4, 5), 5).first()["eligible"]
    got = Q.universe_quality(pages, ids(1, 2, 3, 4, 4), 5).first()
    assert not got["eligible"] and got["duplicate_ids"] == 1
    drift = spark.createDataFrame([(1, "STAGED", 5), (2, "STAGED", 6)], "page int, status string, source_reported_total long")
    assert not Q.universe_quality(drift, ids(1, 2, 3, 4, 5), 5).first()["stable_total"]


def test_page_errors(spark):
    pages = lambda *t: spark.createDataFrame([(k + 1, x) for k, x in enumerate(t)], "page int, source_reported_total int")
    members = lambda *x: spark.createDataFrame(list(x), "page int, id long")
    Q.check_pages(members((1, 1), (1, 2), (2, 3)), pages(3, 3), 3, 2)
    with pytest.raises(Q.SourceTotalDriftError):
        Q.check_pages(members((1, 1), (1, 2), (2, 3)), pages(3, 4), 3, 2)
    with pytest.raises(Q.PageCardinalityError):
        Q.check_pages(members((1, 1), (2, 3)), pages(3, 3), 3, 2)
    with pytest.raises(Q.DuplicatePublicIdError):
        Q.check_pages(members((1, 1), (1, 2), (2, 2)), pages(3, 3), 3, 2)


def test_checkpoint_gate():
    good = {"planned": 100, "unresolved": 0, "retrieval_rate": 0.95, "parser_rate": 0.95, "provenance_rate": 1.0, "url_rate": 1.0, "core_rate": 0.85}
    assert Q.judge_checkpoint(good, 100) == (True, [])
    assert not Q.judge_checkpoint(good | {"core_rate": 0.8}, 100)[0] and not Q.judge_checkpoint(good, 500)[0]


def test_private_fields(spark):
    ok = spark.createDataFrame([(1, "a")], "public_id long, name string")
    assert Q.assert_safe(ok, product=True) is ok
    with pytest.raises(ValueError, match="public_id"):
        Q.assert_safe(ok)
    with pytest.raises(ValueError, match="raw_value"):
        Q.assert_safe(ok.select(F.array(F.struct(F.col("name").alias("raw_value"))).alias("x")), product=True)


def test_detail_and_anomalies(spark):
    d = spark.createDataFrame([("A", None, "L1", None, "x", None, "D", None, "s", "t", None, "on"), (None, None, None, None, None, None, None, None, None, None, None, "on")], "name_en string, name_bn string, licence_no string, registration_no string, address string, upazila string, district string, division string, sector string, establishment_type string, licence_class string, status string")
    assert [(r["anchors"], r["parser_valid"], r["core_complete"]) for r in Q.assess_detail(d).collect()] == [(5, True, True), (1, False, False)]
    fields = "public_id long, request_status string, parser_valid boolean, core_complete boolean, list_name string, list_sector string, list_district string, list_status string, list_class string, detail_name_en string, detail_name_bn string, detail_sector string, detail_district string, detail_status string, detail_class string"
    c = spark.createDataFrame([
        (1, "FAILED", None, None, "a", *["x"] * 10), (2, "PLANNED", None, None, "a", *["x"] * 10), (3, "PARSED", True, True, "a", "s", "d", "o", "c", "A.", None, "s", "e", "o", ""), (4, "PARSED", False, False, *["q"] * 5, "q", None, *["q"] * 4),
    ], fields)
    got = sorted((r["public_id"], r["anomaly_type"]) for r in Q.anomalies(c).collect())
    assert got == [(1, "RETRIEVAL_FAILURE"), (2, "UNRESOLVED_REQUEST"), (3, "DISTRICT_MISMATCH"), (4, "CORE_FIELDS_INCOMPLETE"), (4, "PARSER_INVALID")]


def test_the_first_of_lines_with_one_number_is_last(spark, rows, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from loomstat.plans import catalogue

    folder = tmp_path / "lineitem.parquet"
    folder.mkdir()
    for name, start, n in (("a", 0, 50), ("b", 1000, 20_000)):  # Spark reads the larger file first
        k = list(range(n))
        pq.write_table(pa.table({"l_orderkey": pa.array([i % 50 for i in k]), "l_linenumber": pa.array([1] * n, pa.int32()), "l_partkey": pa.array([start + i for i in k])}), folder / f"{name}.parquet")
    found = rows(catalogue.queries()["last_by_position"](spark, str(tmp_path)))
    assert sorted(found) == [(i, 1, i) for i in range(50)]


def test_page_faults_make_ids_distinct_once(spark, rows):
    from loomstat.operators import quality as Q

    members = spark.createDataFrame([(1, 7), (1, 8), (2, 7), (2, 7), (3, None), (3, 9), (4, 7), (4, 10)], "page long, id long")
    pages = spark.createDataFrame([(p, 10) for p in (1, 2, 3, 4, 5)], "page long, source_reported_total int")
    made = Q.page_faults(members, pages, 10, 2)
    assert sorted(rows(made)) == [(2, 2, 1, 1, "DUPLICATE_ID"), (3, 2, 1, 0, "DUPLICATE_ID"), (4, 2, 2, 1, "DUPLICATE_ID"), (5, 0, 0, 0, "CARDINALITY")]
    assert made._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2  # there were three, and ids made distinct for two of them
