import pytest
from pyspark.sql import functions as F

from loomstat.operators import exposure as G
from loomstat.operators import matching as M

UNIT = "geo_ref string, level string, division_name_en string, division_name_bn string, district_name_en string, district_name_bn string, upazila_name_en string, upazila_name_bn string"
UNITS = [
    ("BBS:DIV:30", "DIVISION", "Dhaka", "ঢাকা", None, None, None, None), ("BBS:DIST:30:33", "DISTRICT", "Dhaka", "ঢাকা", "Gazipur", "গাজীপুর", None, None),
    ("BBS:DIST:50:70", "DISTRICT", "Rajshahi", None, "Chapai Nawabganj", None, None, None), ("BBS:UPZ:30:33:86", "UPAZILA", "Dhaka", "ঢাকা", "Gazipur", "গাজীপুর", "Sreepur", None),
    ("BBS:UPZ:40:55:95", "UPAZILA", "Khulna", None, "Magura", None, "Sreepur", None), ("BBS:DIST:40:55", "DISTRICT", "Khulna", None, "Magura", None, None, None),
]


@pytest.fixture
def units(spark):
    return spark.createDataFrame(UNITS, UNIT)


def test_resolution(spark, units):
    aliases = G.risk_aliases(units)
    assert [tuple(r) for r in aliases.collect()] == [("DISTRICT", "Nawabganj", "BBS:DIST:50:70")]
    asked = [
        ("a", "DISTRICT", "Gazipur District", None, None), ("b", "DISTRICT", "গাজীপুর", "ঢাকা", None), ("c", "DISTRICT", "Gazipurr", None, None), ("d", "DISTRICT", "Nawabganj", None, None), ("e", "UPAZILA", "Sreepur", None, None),
        ("f", "UPAZILA", "Sreepur", None, "Magura"), ("g", "DISTRICT", "", None, None), ("h", "DISTRICT", "Gazipur", "Khulna", None),
    ]
    q = spark.createDataFrame(asked, "ask_id string, level string, name string, division string, district string")
    got = {r["ask_id"]: (r["status"], r["geo_ref"]) for r in G.resolve_places(q, units, aliases).collect()}
    assert got == {
        "a": ("EXACT_NAME", "BBS:DIST:30:33"), "b": ("EXACT_NAME", "BBS:DIST:30:33"), "c": ("NO_MATCH", None), "d": ("APPROVED_ALIAS", "BBS:DIST:50:70"), "e": ("AMBIGUOUS", None),
        "f": ("EXACT_NAME", "BBS:UPZ:40:55:95"), "g": ("NO_MATCH", None), "h": ("NO_MATCH", None),
    }


OBS = "source string, domain string, metric_code string, metric_label string, spatial_scope string, establishment_ref string, district string, upazila string, value_numeric double, direction string, canonical_geo_ref string"
REG = "establishment_ref string, name string, district string, upazila string, division string, sector_family string"


def test_links_and_coverage(spark, units):
    reg = spark.createDataFrame([("R:1", "a", "Gazipur", "Sreepur", "Dhaka", "F"), ("R:2", "b", "গাজীপুর", "x", None, "F"), ("R:3", "c", "Khulna", "y", None, "G")], REG)
    ob = lambda *x: spark.createDataFrame(list(x), OBS)
    o = ob(("S", "POWER_SYSTEM", "m", "M", "DISTRICT", None, " gazipur ", None, 1.0, None, None), ("S", "POWER_SYSTEM", "m", "M", "UPAZILA", None, "Gazipur", "Sreepur", 1.0, None, None), ("S", "CLIMATE_HAZARD", "m", "M", "SITE", "R:3", None, None, 1.0, None, None), ("S", "CLIMATE_HAZARD", "m", "M", "DISTRICT", None, "Gazipur District", None, 1.0, None, None))
    linked = G.links(reg, o)
    assert sorted((r["establishment_ref"], r["attribution"]) for r in linked.collect()) == [("R:1", "DISTRICT_CONTEXT"), ("R:1", "UPAZILA_CONTEXT"), ("R:3", "SITE_SPECIFIC")]
    got = {(r["kind"], r["label"]): r["coverage_pct"] for r in G.coverage(reg, linked).collect()}
    assert got["ANY", "ANY"] == 66.6667 and got["DOMAIN", "POWER_SYSTEM"] == 33.3333
    by_ref = ob(("S", "DISASTER_RISK", "m", "M", "DISTRICT", None, "Gazipur", None, None, None, "BBS:DIST:30:33"))
    assert sorted(r["establishment_ref"] for r in G.links(reg, by_ref, units).collect()) == ["R:1", "R:2"]
    assert {r["establishment_ref"]: r["linked_observations"] for r in G.establishment_profiles(reg, linked).collect()} == {"R:1": 2, "R:2": 0, "R:3": 1}
    assert G.area_profiles(reg, linked, "sector_family").count() == 2


def test_unsound_observations_fail(spark):
    reg = spark.createDataFrame([("R:1", "a", "G", "S", "D", "F")], REG)
    for bad in (("S", "MOON", "m", "M", "SITE", "R:1", None, None, 1.0, None, None), ("S", "POWER_SYSTEM", "m", "M", "UPAZILA", None, "G", None, 1.0, None, None), ("", "POWER_SYSTEM", "m", "M", "SITE", "R:1", None, None, 1.0, None, None)):
        with pytest.raises(Exception, match="exposure observation"):
            G.links(reg, spark.createDataFrame([bad], OBS)).collect()


def test_risk_observations(spark, units):
    r = spark.createDataFrame([("Dhaka", "Gazipur", "Z", "High", "Low", "Low", "Medium"), ("Rajshahi", "Nawabganj", "Z", *["Low"] * 4), ("X", "Atlantis", "Z", *["Low"] * 4)], "division string, district string, climate_zone string, hazard_exposure string, vulnerability string, lack_of_coping_capacity string, risk string")
    made, bad = G.risk_observations(r, units, G.risk_aliases(units), "AWARE", None, "2026-01-01")
    assert made.count() == 10 and [(x["district"], x["status"]) for x in bad.collect()] == [("Atlantis", "NO_MATCH")]
    assert G.fingerprinted(made.withColumns({k: F.lit(None).cast("string") for k in ("establishment_ref", "upazila", "unit")}).withColumn("value_numeric", F.lit(None).cast("double"))).select("observation_sha256").distinct().count() == 10


def test_names_and_addresses(spark):
    rows = [("Acme Textiles Ltd", "ACME TEXTILES"), ("Acme Textile Mills", "Acme Textile Mills Unit2"), ("Alpha", "Beta"), ("Ltd", "Alpha")]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(M.name_strength(F.col("a"), F.col("b"))).collect()]
    assert got == ["exact", "strong", "weak", "missing"]
    rows = [("plot road dhaka north", "plot road dhaka south"), ("aa bb cc dd", "aa xx yy zz"), ("aa bb", "cc dd"), (None, "x")]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(M.address_result(F.col("a"), F.col("b"))).collect()]
    assert got == ["strong", "consistent", "conflict", "missing"]


def test_match_classes(spark):
    rows = [("exact", "match", "match", "missing"), ("strong", "match", "missing", "missing"), ("exact", "conflict", "match", "strong"), ("weak", "match", "match", "strong"), ("exact", "missing", "missing", "strong")]
    got = [r[0] for r in spark.createDataFrame(rows, "n string, d string, u string, a string").select(M.match_class(*[F.col(c) for c in "ndua"])).collect()]
    assert got == ["EXACT_SITE", "PROBABLE_SITE", "ORGANIZATION_ONLY", "NO_MATCH", "ORGANIZATION_ONLY"]


def test_outcomes(spark):
    t = spark.createDataFrame([(k, n, None, "D", None, "RMG_TEXTILE") for k, n in ((1, "Acme Knit"), (2, "Bolt Wear"), (3, "Zed"), (4, "Gamma Looms Delta"))], "target_id long, name string, address string, district string, upazila string, sector_family string")
    r = spark.createDataFrame([(10, "BGMEA", "10", "Acme Knit Ltd", None, "D", None), (11, "BGMEA", "11", "Bolt Wear", None, "D", None), (12, "BGMEA", "12", "Bolt Wear Ltd", None, "D", None), (13, "BKMEA", "13", "Gamma Looms Delta", None, "D", None)], "record_id long, source string, external_key string, name string, address string, district string, upazila string")
    short, made = M.candidate_run(t, r)
    assert {x["target_id"]: (x["outcome"], x["selected_record"]) for x in made.collect()} == {1: ("AUTO_SELECTED", 10), 2: ("AMBIGUOUS", None), 3: ("NO_STAGED_CANDIDATE", None), 4: ("AUTO_SELECTED", 13)}
    links = M.apply_resolutions(made, short, None)
    assert {x["record_id"]: (x["match_type"], x["site_level_match"]) for x in links.collect()} == {10: ("PROBABLE_SITE", True), 13: ("ORGANIZATION_ONLY", False)}
    assert M.apply_resolutions(made, short, links).count() == 0
    typed = spark.createDataFrame([(10, "SITE"), (13, "SITE"), (13, "ORGANIZATION")], "record_id long, scope string")
    assert sorted((x["record_id"], x["scope"], x["site_attributable"]) for x in M.attach_observations(links, typed).collect()) == [(10, "SITE", True), (13, "ORGANIZATION", False)]
    assert M.evidence_rows(short).count() == 5 * short.count()
