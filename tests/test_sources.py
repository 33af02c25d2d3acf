import hashlib
import io
import json
import urllib.error

import pytest
from pyspark.sql import functions as F

from loomstat.operators import lifecycle
from loomstat.sources import access, html, sinks, tables
from loomstat.streaming import landing


def list_html(ids, total="৩", extra=""):
    rows = "".join(f'<tr><td><a href="/public-report/establishment/{i}">Name {i}</a><td>রাইস মিল<td>Road, Sreepur, Gazipur, Dhaka<td>A<td>Active</tr>' for i in ids)
    return f"<p>প্রাপ্ত তথ্য : {total} টি</p><p>দেখাচ্ছে : ২ টি</p><div>প্রতিবেদন তৈরির তারিখ এবং সময় : 1 Jan</div><table>{rows}{extra}</table>"


def test_list_page():
    made = html.list_page(list_html([7, 8, 7], extra="<tr><td>no link</td></tr>"), "https://h")
    assert (made["total_records"], made["showing_records"], made["source_reported_at_raw"]) == (3, 2, "1 Jan")
    assert [r["public_id"] for r in made["rows"]] == [7, 8]
    assert made["rows"][0] | {} == {"public_id": 7, "name": "Name 7", "sector": "রাইস মিল", "location": "Road, Sreepur, Gazipur, Dhaka", "upazila": "Sreepur", "district": "Gazipur", "division": "Dhaka", "licence_class": "A", "status": "Active", "detail_url": "https://h/public-report/establishment/7"}
    assert html.list_page(None)["rows"] == [] and html.list_page("<table><tr><td")["rows"] == []


def test_detail_page():
    page = """<h2>Acme Ltd (একমি)</h2><div>পূর্ণ ঠিকানা</div><div>Road 1</div><div>উপজেলা : Sreepur, জেলা : Gazipur, বিভাগ : Dhaka</div><div>বর্তমান অবস্থা</div><div>Active</div>
    <div>ইন্ডাস্ট্রিয়াল সেক্টর:</div><div>Rice</div><div>লাইসেন্স নম্বর: L-1</div><div>শ্রেণী:</div><div>A (Factory)</div><div>মোট শ্রমিকের সংখ্যা:</div><div>১২ + ৮ = ২০</div>"""
    made = html.detail_page(page)
    want = {"name_en": "Acme Ltd", "name_bn": "একমি", "address": "Road 1", "upazila": "Sreepur", "district": "Gazipur", "division": "Dhaka", "status": "Active", "sector": "Rice", "licence_no": "L-1", "licence_class": "A", "establishment_type": "Factory", "worker_component_1": 12, "worker_component_2": 8, "worker_total": 20, "registration_no": None}
    assert {k: made[k] for k in want} == want


def test_options_indexes_and_records():
    page = '<select name="industry_id"><option value="">all<option value="3">Rice</select><select id="zone"><option value="1">Z</option></select>'
    assert [(o["dimension"], o["source_value"]) for o in html.options(page)] == [("INDUSTRIAL_SECTOR", "3"), ("ZONE", "1")]
    page = 'Total 4,291 Member(s) Found<table><tr><td>Acme</td><td>R1</td><td><a href="/member/12">view</a></td></tr><tr><td>Acme</td><td>R1</td><td><a href="/member/12">view</a></td></tr></table><a href="?page=215">215</a>'
    made = html.member_index(page, "https://h/page/member-list")
    assert (made["total_records"], made["last_page"], made["records_on_page"], made["has_next"], made["pager_disagrees"]) == (4291, 4291, 1, True, True)
    made = html.exporter_cards('<li><h3>Beta</h3><a href="/exporter/9/beta"></a></li><a href="/exporter/beta">x</a>', "https://h/")
    assert [(r["source_key"], r["entity_name"]) for r in made["rows"]] == [("9", "Beta")]
    made = html.exporter_json(json.dumps({"data": {"data": [{"id": 5, "name": "C", "slug": "c", "factory_district": {"name": "Gazipur"}}, {"id": "x", "name": "D"}], "total": 197, "current_page": 1, "last_page": 10}}), "https://h/")
    assert [(r["source_key"], r["district"], r["detail_url"]) for r in made["rows"]] == [("5", "Gazipur", "https://h/exporter/5/c")] and (made["total_records"], made["last_page"], made["has_next"]) == (197, 10, True)
    assert html.exporter_json("{")["rows"] == []
    page = "<h2>Acme</h2><table><tr><th>Factory Address:</th><td>Road</td></tr><tr><td>District</td><td>Gazipur</td></tr></table><dl><dt>Upazila<dd>Sreepur</dl><p>Employees: 1,250</p>"
    made = html.external_record("BGMEA", page, "https://h/member/12")
    assert (made["external_key"], made["entity_name"], made["site_text"], made["district"], made["upazila"], made["error"]) == ("12", "Acme", "Road", "Gazipur", "Sreepur", None)
    assert dict(made["source_fields"])["employees"] == "1,250"
    assert html.external_record("EPB", page, "https://h/exporter/acme")["error"] == "no stable key"
    assert html.external_record("BEPZA", "<p>Zone: North EPZ</p><h1>Acme Co. Ltd.</h1>", "")["external_key"] == "north epz::acme"


def test_risk_table():
    head = "".join(f"<th>{x.title()}</th>" for x in ("no", *html.RISK_HEADERS))
    row = "<tr><td>1</td><td>Dhaka</td><td>Gazipur</td><td>Z</td><td>High</td><td>Low</td><td>Low</td><td>{}</td></tr>"
    made = html.risk_table(f"<table><tr><td>other</td></tr></table><table><tr>{head}</tr>{row.format('Medium')}</table>")
    assert made["error"] is None and made["rows"][0]["risk"] == "Medium"
    assert html.risk_table(f"<table><tr>{head}</tr>{row.format('Awful')}</table>")["error"] == "unknown category: Awful"


def test_parsers_on_columns(spark):
    df = spark.createDataFrame([(1, list_html([1, 2]), "u"), (2, None, None)], "page int, html string, url string")
    got = html.rows_of(df, "list")
    assert [(r["page"], r["public_id"]) for r in got.orderBy("public_id").collect()] == [(1, 1), (1, 2)]
    assert html.parsed(df, "external", source="DOE").select("parsed.error").distinct().collect()[0][0] == "no stable key"


def test_archive(spark, tmp_path):
    pages = {1: list_html([1, 2]), 2: list_html([3])}
    entries = []
    for k, page in pages.items():
        (tmp_path / f"p{k}.html").write_text(page, encoding="utf-8")
        entries.append({"page": k, "file": f"p{k}.html", "retrieved_at": "t", "sha256": hashlib.sha256(page.encode()).hexdigest()})
    manifest = {"format_version": "1.0", "universe_label": "u", "seed_url": "s", "page_size": 2, "created_at": "t", "pages": entries}
    write = lambda m: (tmp_path / "manifest.json").write_text(json.dumps(m))
    write(manifest)
    staged, members, total = tables.ingest_archive(spark, str(tmp_path))
    assert total == 3 and members.count() == 3
    assert lifecycle.finalize_universe(staged, members, total)[0] == "COMPLETED"
    for change, message in (({"format_version": "2"}, "unsupported"), ({"pages": entries[1:]}, "unique"), ({"pages": entries[:1]}, "differ"), ({"pages": [entries[0], entries[1] | {"file": "../x"}]}, "outside"), ({"pages": [entries[0], entries[1] | {"sha256": "0"}]}, "digest")):
        write(manifest | change)
        with pytest.raises(tables.IngestError, match=message):
            tables.ingest_archive(spark, str(tmp_path))


def test_csv_readers(spark, tmp_path):
    g = tmp_path / "geo.csv"
    g.write_text("﻿" + ",".join(tables.GEOGRAPHY_COLUMNS) + "\n30,Dhaka,ঢাকা,33,Gazipur,গাজীপুর,86,Sreepur,\n30,Dhaka,,33,Gazipur,,30,Kaliganj,\n40,Khulna,,55,Magura,,,,\n", encoding="utf-8")
    assert sorted(r["geo_ref"] for r in tables.geography_units(spark, str(g)).collect()) == ["BBS:DIST:30:33", "BBS:DIST:40:55", "BBS:DIV:30", "BBS:DIV:40", "BBS:UPZ:30:33:30", "BBS:UPZ:30:33:86"]
    g.write_text(",".join(tables.GEOGRAPHY_COLUMNS) + "\n30,Dhaka,,33,,,86,Sreepur,\n", encoding="utf-8")
    with pytest.raises(tables.IngestError, match="incomplete"):
        tables.geography_units(spark, str(g))
    b = tmp_path / "bulk.csv"
    b.write_text(",".join(tables.BULK_COLUMNS) + '\n1,A,s,"R, U, D, V",,,,c,ok\n2,B,s,,u,d,v,,ok\n', encoding="utf-8")
    got = tables.checked_bulk(tables.bulk_registry(spark, str(b)), 2).orderBy("id").collect()
    assert [(r["upazila"], r["district"], r["licence_class"]) for r in got] == [("U", "D", "c"), ("u", "d", None)]
    with pytest.raises(tables.IngestError, match="declared 3"):
        tables.checked_bulk(tables.bulk_registry(spark, str(b)), 3)
    b.write_text("name\nA\n")
    with pytest.raises(tables.IngestError, match="lacks"):
        tables.bulk_registry(spark, str(b))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None)], "z int, b string, c string").select("z", F.struct("z", "b").alias("s"), "c")
    assert [r[0] for r in sinks.json_lines(df).collect()] == ['{"c":null,"s":{"b":"a","z":1},"z":1}']
    sinks.write_jsonl(df, str(tmp_path / "l"))
    assert json.loads(sinks.write_json_array(df, tmp_path / "x" / "a.json").read_text()) == [{"c": None, "s": {"b": "a", "z": 1}, "z": 1}]
    with pytest.raises(ValueError, match="snapshot_id"):
        sinks.json_lines(df.withColumn("snapshot_id", F.lit(1)))
    sinks.write_profiles(spark.createDataFrame([("d", "{}")], "district string, payload string"), "district", str(tmp_path / "p"))
    assert (tmp_path / "p" / "district=d").is_dir()


class Answer(io.BytesIO):
    status = 200

    def geturl(self):
        return "https://h/ok"


def test_fetcher():
    policy = access.AccessPolicy("s", "APPROVED", ("h",), ("/ok",), "me", "now", requests_per_minute=60)
    now, slept = [0.0], []
    calls = []

    def opener(request, timeout):
        calls.append(request.full_url)
        if len(calls) == 1:
            raise urllib.error.HTTPError(request.full_url, 503, "busy", {"Retry-After": "3"}, None)
        return Answer(b"hello")

    f = access.PoliteFetcher(policy, opener=opener, clock=lambda: now[0], sleep=slept.append)
    got = f.fetch("https://h/ok")
    assert got.text == "hello" and got.attempts == 2 and got.sha256 == hashlib.sha256(b"hello").hexdigest() and slept == [3.0, 1.0]
    with pytest.raises(access.AccessPolicyError):
        f.fetch("https://h/other")
    with pytest.raises(access.AccessPolicyError):
        access.PoliteFetcher(access.AccessPolicy("s", "PENDING", ("h",), ("/",))).fetch("https://h/ok")
    with pytest.raises(access.FetchError, match="too large"):
        access.PoliteFetcher(policy, max_bytes=2, opener=lambda r, timeout: Answer(b"hello")).fetch("https://h/ok")


def test_landing_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id long, v string")
    rows.write.parquet(str(tmp_path / "in"))
    go = lambda: landing.ingest(spark, str(tmp_path / "in"), rows.schema, str(tmp_path / "log"), str(tmp_path / "cp"), ["id", "v"])
    assert go() >= 1
    rows.union(spark.createDataFrame([(3, "c")], rows.schema)).write.mode("append").parquet(str(tmp_path / "in"))
    go()
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "log")).collect()) == [1, 2, 3]
    assert go() == 0 and landing.latest(spark, str(tmp_path / "log"), ["id"], [F.desc("v")]).count() == 3


def test_a_cleared_tree_is_free_at_once():
    import gc
    import weakref

    from loomstat.sources import html

    gc.disable()
    try:
        tree = html.tree("<div><p><a href='x'>y</a></p></div>")
        seen = [weakref.ref(x) for x in tree.walk()]
        tree.clear()
        assert len(seen) == 3 and all(x() is None for x in seen)
    finally:
        gc.enable()
