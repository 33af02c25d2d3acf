import pytest
from pyspark.sql import functions as F

from loomstat.operators import quality, runs
from loomstat.sources.access import AccessPolicyError, FetchError
from loomstat.sources.store import LogStore

from .test_sources import list_html

BASE = "https://h/public-report/establishment"


def ticking():
    now = [0]

    def clock():
        now[0] += 1
        return f"2024-01-01 {now[0] // 3600:02d}:{now[0] // 60 % 60:02d}:{now[0] % 60:02d}"

    return clock


def detail_html(i, name=True):
    title = f"<h2>Acme {i}</h2>" if name else ""
    return f"""{title}<div>উপজেলা : Sreepur, জেলা : Gazipur, বিভাগ : Dhaka</div><div>বর্তমান অবস্থা</div><div>Active</div><div>মেয়াদ</div><div>2025</div>
    <div>ইন্ডাস্ট্রিয়াল সেক্টর:</div><div>Rice</div><div>লাইসেন্স নম্বর: L-{i}</div><div>শ্রেণী:</div><div>A (Factory)</div>"""


def frozen(spark, store, label="v"):
    rows = spark.createDataFrame([(i, "F" if i % 2 else "S", "N") for i in range(1, 9)], "id long, sector_family string, geography_group string")
    return runs.freeze(store, label, rows, "2024-01-01", {"F": 2, "S": 2}, {"N": 4})


def test_store(spark, tmp_path):
    store = LogStore(spark, str(tmp_path / "s"))
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    assert store.read("x", "id int").count() == 0 and store.append_new("x", rows, ["id"]) == 2 and store.append_new("x", rows, ["id"]) == 0
    assert store.replace("y", "l", rows, "2024-01-01", 1) == 3 and store.replace("y", "l", rows.limit(1), "2024-01-02", 2) == 1
    assert store.current("y", "l", "id int, v string").count() == 1 and store.current("y", "other", "id int, v string").count() == 0
    runs.register_source(store, "epb", "UNKNOWN", notes="first")
    runs.register_source(store, "EPB", "APPROVED")
    assert [(r["policy_status"], r["notes"]) for r in runs.source_profiles(store).collect()] == [("APPROVED", "first")]


def test_progressive_details(spark, tmp_path):
    store, clock = LogStore(spark, str(tmp_path / "s")), ticking()
    assert frozen(spark, store) == 4
    with pytest.raises(Exception, match="flow_gap"):
        runs.freeze(store, "v", runs.sample(store, "v"), "2024-01-02", {"F": 3, "S": 1}, {"N": 4})
    assert runs.sample(store, "v").count() == 4  # a plan that fails leaves the sample
    assert runs.plan_details(store, "v", clock(), BASE, (2, 4)) == 4
    with pytest.raises(ValueError, match="planned already"):
        runs.plan_details(store, "v", clock(), BASE, (2, 4))
    assert runs.checkpoint_states(store, "v") == {2: "READY", 4: "LOCKED"}
    with pytest.raises(ValueError, match="locked"):
        runs.evaluate_checkpoint(store, "v", 4, clock())
    with pytest.raises(ValueError, match="ready"):
        runs.run_checkpoint(store, detail_html, "v", 4, clock)
    asked = []

    def fetch(url):
        asked.append(url)
        if len(asked) == 4:
            raise FetchError("HTTP 500")
        return detail_html(url.rsplit("/", 1)[1])

    first, second = runs.run_progressive(store, fetch, "v", clock)
    assert first["passed"] and first["collection"] == {"attempted": 2, "fetched": 2, "failed": 0} and first["district_coverage_rate"] == 1.0 and first["employment_coverage_rate"] == 0.0
    assert not second["passed"] and second["failed"] == 1 and "retrieval rate 0.7500 under 0.95" in second["reasons"]
    assert runs.checkpoint_states(store, "v") == {2: "PASSED", 4: "FAILED"} and len(set(asked)) == 4
    assert runs.requeue_failed(store, "detail:v", clock(), "again") == 1
    assert runs.collect(store, fetch, "detail:v", clock)["fetched"] == 1 and runs.stage_details(store, "v", clock()) == 1
    assert runs.evaluate_checkpoint(store, "v", 4, clock())["passed"]
    assert store.count("checkpoint_decisions") == 3 and store.count("detail_observations") == 4


def test_pages_outside_the_plan_are_not_staged(spark, tmp_path):
    store, clock = LogStore(spark, str(tmp_path / "s")), ticking()
    plan = spark.createDataFrame([("7", 1, f"{BASE}/7"), ("8", 2, f"{BASE}/9")], "item string, sequence_no int, url string")
    runs.plan(store, "detail:w", plan, clock())
    runs.land(store, "detail:w", [("7", f"{BASE}/70", clock(), "x"), ("5", f"{BASE}/5", clock(), "x")])
    assert runs.landed(store, "detail:w").count() == 0

    def fetch(url):
        if url.endswith("9"):
            raise AccessPolicyError("no")
        return detail_html(7)

    with pytest.raises(AccessPolicyError):
        runs.collect(store, fetch, "detail:w", clock)
    assert [r["item"] for r in runs.landed(store, "detail:w").collect()] == ["7"]  # what was received stays
    assert runs.collect(store, detail_html, "detail:w", clock) == {"attempted": 1, "fetched": 1, "failed": 0}
    assert runs.stage_details(store, "w", clock()) == 2 and runs.stage_details(store, "w", clock()) == 0
    assert runs.status_counts(store, "detail:w") == {"PARSED": 1, "FAILED": 1}  # address of 9 under item 8


def test_universe_batches(spark, tmp_path):
    store, clock = LogStore(spark, str(tmp_path / "s")), ticking()
    pages = {"1": list_html([1, 2], "৫"), "2": list_html([3, 4], "৫"), "3": list_html([5], "৫")}
    fetch = lambda url: pages[url.rsplit("=", 1)[1]]
    runs.create_universe(store, "u", "https://h/list?page=1", clock(), 2)
    with pytest.raises(ValueError, match="can't become RUNNING"):
        runs.create_universe(store, "u", "https://h/list?page=1", clock(), 2)
    got = runs.run_universe_batch(store, fetch, "u", clock, max_pages=2)
    assert got["status"] == "RUNNING" and got["pages"] == {"STAGED": 2, "PLANNED": 1}
    with pytest.raises(ValueError, match="unresolved"):
        runs.finalize_universe(store, "u", clock())
    got = runs.run_universe_batch(store, fetch, "u", clock, max_pages=2)
    assert got["status"] == "COMPLETED" and got["attempted"] == 1 and store.count("universe_members") == 5
    with pytest.raises(ValueError, match="isn't running"):
        runs.run_universe_batch(store, fetch, "u", clock)
    with pytest.raises(ValueError, match="only a failed"):
        runs.restart_universe(store, "u", "u2", clock(), "why")


def test_universe_fault_and_restart(spark, tmp_path):
    store, clock = LogStore(spark, str(tmp_path / "s")), ticking()
    pages = {"1": list_html([1, 2]), "2": list_html([2])}
    runs.create_universe(store, "u", "https://h/list?page=1", clock(), 2)
    with pytest.raises(quality.DuplicatePublicIdError):
        runs.run_universe_batch(store, lambda url: pages[url.rsplit("=", 1)[1]], "u", clock)
    assert runs.universe(store, "u")["status"] == "FAILED" and store.count("universe_members") == 2
    runs.restart_universe(store, "u", "u2", clock(), "total moved")
    assert {k: runs.universe(store, "u2")[k] for k in ("parent", "reason", "status", "expected_total")} == {"parent": "u", "reason": "total moved", "status": "RUNNING", "expected_total": None}


def test_enrichment(spark, tmp_path):
    store, clock = LogStore(spark, str(tmp_path / "s")), ticking()
    frozen(spark, store)
    with pytest.raises(ValueError, match="no sample"):
        runs.plan_targets(store, "other", "EPB", clock())
    assert runs.plan_targets(store, "v", "BGMEA", clock()) == {"eligible": 0, "out_of_scope": 4} and runs.plan_targets(store, "v", "epb", clock()) == {"eligible": 4, "out_of_scope": 0}
    runs.plan(store, "bgmea", spark.createDataFrame([("12", 1, "https://h/member/12"), ("x", 2, "https://h/member/x")], "item string, sequence_no int, url string"), clock())
    page = "<h2>Acme Textile Mills</h2><table><tr><td>Factory Address</td><td>Road 7 Sreepur</td></tr><tr><td>District</td><td>Gazipur</td></tr><tr><td>Upazila</td><td>Sreepur</td></tr></table><p>Employees: 1,250</p>"
    asked = spark.createDataFrame([(1, "Acme Textile Mills Ltd", "Road 7 Sreepur", "Gazipur", "Sreepur", "RMG_TEXTILE"), (2, "Other Works", "Y", "Dhaka", "Savar", "RMG_TEXTILE")], "target_id long, name string, address string, district string, upazila string, sector_family string")
    go = lambda limit=None: runs.run_enrichment(store, lambda url: page, "bgmea", "BGMEA", asked, clock, limit)
    got = go(1)
    assert got["requests"] == {"PARSED": 1, "PLANNED": 1} and got["outcomes"] == {}
    got = go()
    assert got["requests"] == {"PARSED": 1, "FAILED": 1} and got["outcomes"] == {"AUTO_SELECTED": 1, "NO_STAGED_CANDIDATE": 1} and got["links"] == 1
    assert go()["links"] == 0
    facts = {(r["observation_type"], r["value_numeric"]) for r in runs.linked_facts(store).filter("target_id = 1").collect()}
    assert facts == {("ASSOCIATION_MEMBERSHIP_RECORD", None), ("EMPLOYMENT_COUNT", 1250.0)}


def member_html(rows, total):
    cells = "".join(f'<tr><td>{name}</td><td>R{k}</td><td><a href="/member/{k}">view</a></td></tr>' for k, name in rows)
    return f"Total {total} Member(s) Found<table>{cells}</table>"


def test_index_run(spark, tmp_path):
    store, clock = LogStore(spark, str(tmp_path / "s")), ticking()
    pages = {"1": member_html([(1, "Acme Ltd"), (2, "Beta Mills")], 3), "2": member_html([(3, "Gamma Knit")], 3)}
    fetch = lambda url: pages[url.rsplit("=", 1)[1]]
    with pytest.raises(ValueError, match="no directory"):
        runs.create_index(store, "i", "BEPZA", "member_index", "https://h/m?page=1", clock())
    with pytest.raises(KeyError):
        runs.index(store, "i")
    runs.create_index(store, "i", "bgmea", "member_index", "https://h/m?page=1", clock())
    assert runs.collect(store, fetch, "i", clock)["fetched"] == 1 and runs.stage_index(store, "i", clock()) == 1
    with pytest.raises(ValueError, match="1 unresolved"):
        runs.finalize_index(store, "i", clock())
    asked = spark.createDataFrame([(1, "Gamma Co."), (2, "acme")], "target_id long, name string")
    with pytest.raises(ValueError, match="isn't complete"):
        runs.plan_candidates(store, "d", "i", asked, clock())
    assert runs.collect(store, fetch, "i", clock)["fetched"] == 1 and runs.stage_index(store, "i", clock()) == 1 and runs.stage_index(store, "i", clock()) == 0
    assert runs.index_counts(store, "i") == {"pages": {"STAGED": 2}, "records_discovered": 3, "unique_keys": 3}
    status, figures = runs.finalize_index(store, "i", clock())
    assert status == runs.index(store, "i")["status"] == "COMPLETED" and figures["distinct_company_cores"] == 3
    assert [r["entity_name"] for r in runs.index_records(store, "i").orderBy("source_key").collect()] == ["Acme Ltd", "Beta Mills", "Gamma Knit"]
    assert runs.plan_candidates(store, "d", "i", asked, clock()) == 2
    assert [(r["item"], r["url"]) for r in runs.requests(store, "d").orderBy("sequence_no").collect()] == [("1", "https://h/member/1"), ("3", "https://h/member/3")]
    assert {(r["item"], r["target_id"]) for r in spark.read.parquet(store.path("request_targets")).collect()} == {("1", 2), ("3", 1)}
    with pytest.raises(ValueError, match="isn't running"):
        runs.stage_index(store, "i", clock())


def test_index_with_a_repeated_key_fails(spark, tmp_path):
    store, clock = LogStore(spark, str(tmp_path / "s")), ticking()
    pages = {"1": member_html([(1, "Acme Ltd"), (2, "Beta")], 3), "2": member_html([(2, "Beta")], 3)}
    runs.create_index(store, "i", "BGMEA", "member_index", "https://h/m?page=1", clock())
    for _ in range(2):
        runs.collect(store, lambda url: pages[url.rsplit("=", 1)[1]], "i", clock)
        runs.stage_index(store, "i", clock())
    status, figures = runs.finalize_index(store, "i", clock())
    assert status == "FAILED" and figures["duplicate_keys"] == 1 and runs.index_counts(store, "i")["unique_keys"] == 2


def test_exposures(spark, tmp_path):
    from loomstat.sources import html

    store = LogStore(spark, str(tmp_path / "s"))
    head = "".join(f"<th>{x.title()}</th>" for x in html.RISK_HEADERS)
    row = "<tr><td>Dhaka</td><td>{}</td><td>Z</td><td>High</td><td>Low</td><td>Low</td><td>Medium</td></tr>"
    page = spark.createDataFrame([(f"<table><tr>{head}</tr>{row.format('Gazipur')}{row.format('Nowhere')}</table>", "u")], "html string, url string")
    units = spark.createDataFrame([("DISTRICT", "BBS:DIST:30:33", "Dhaka", None, "Gazipur", None, None, None)], "level string, geo_ref string, division_name_en string, division_name_bn string, district_name_en string, district_name_bn string, upazila_name_en string, upazila_name_bn string")
    stage = lambda: runs.ingest_risk_page(store, page, units, "DDM", "2020", "2024-01-01")
    assert stage() == {"records": 2, "inserted": 5, "unresolved": [("Dhaka", "Nowhere", "NO_MATCH")]}
    assert stage()["inserted"] == 0
    bad = spark.read.parquet(store.path("exposures")).drop("observation_sha256").withColumn("domain", F.lit("?"))
    with pytest.raises(ValueError, match="unsupported domain"):
        runs.ingest_exposures(store, bad)


def test_stored_geography_and_provenance(spark, tmp_path):
    store = LogStore(spark, str(tmp_path / "s"))
    with pytest.raises(ValueError, match="no administrative units"):
        runs.stored_units(store)
    units = spark.createDataFrame([("BBS:DIV:1", "DIVISION", "A")], "geo_ref string, level string, division_name_en string")
    with pytest.raises(ValueError, match="no units"):
        runs.store_units(store, units.limit(0))
    aliases = spark.createDataFrame([("DIVISION", "Old A", "BBS:DIV:1", "s", "n"), ("DIVISION", "old  a", "BBS:DIV:1", "s", "again")], "level string, alias string, geo_ref string, source_name string, note string")
    assert runs.store_units(store, units, aliases) == {"units": 1, "aliases": 1}
    assert runs.store_units(store, units.withColumn("division_name_en", F.lit("B")), aliases) == {"units": 1, "aliases": 0}
    stored, known = runs.stored_units(store)
    assert [(r["geo_ref"], r["division_name_en"]) for r in stored.collect()] == [("BBS:DIV:1", "B")] and known.count() == 1
    with pytest.raises(ValueError, match="authority is required"):
        runs.register_exposure_source(store, "s", " ", "note", "2024-01-01")
    for note in ("one", "two"):
        runs.register_exposure_source(store, "s ", "a", note, "2024-01-01", "ref")
    assert [(r["source_name"], r["methodology_note"], r["source_reference"]) for r in runs.exposure_sources(store).collect()] == [("s", "two", "ref")]
