"""Queries on page parsers, file readers and planned runs.

Pages and files are rendered from the tables and read back, so the tables are what the result
has to be. Runs fetch one page after another, as the access policy asks, so theirs are made of
nations, of which there is a fixed number.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import exposure, lifecycle, runs
from ..operators.quality import SnapshotIntegrityError
from ..sources import html, tables
from ..sources.access import FetchError
from ..sources.shared import new_path as scratch
from ..sources.store import LogStore
from ..vocab import EXPOSURE_DOMAINS
from .domain import REGISTRY_SQL, registry, table
from .registry import query

HOST = "https://register.example.org"
SOURCES = ("EPB", "BGMEA", "BKMEA", "BEPZA", "DOE")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, in whatever storage the path names."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def joined(*parts) -> Column:
    """Text of columns and plain strings, one after the other."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def on_pages(rows: DataFrame, page: Column, key: Column, line: Column) -> DataFrame:
    """(page, n, lines): the lines of each page in the order of the key. A page has a fixed number of rows."""
    made = rows.groupBy(page.alias("page")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct(key.alias("k"), line.alias("line")))).alias("all"))
    return made.select("page", "n", F.array_join(F.col("all.line"), "").alias("lines"))


@query(
    "list_pages",
    f"""WITH {REGISTRY_SQL} SELECT (id - 1) // 25 + 1 AS page, (SELECT count(*) FROM registry) AS total_records, count(*) OVER (PARTITION BY (id - 1) // 25) AS showing_records,
  '1 Jan 2024' AS reported, id AS public_id, name, sector_label AS sector, upazila, district, division, 'A' AS licence_class, status, '{HOST}/public-report/establishment/' || id AS detail_url FROM registry""",
)
def list_pages(spark, sf_dir):
    """Every page repeats its first row and has a row without a link; both are left out."""
    rows = registry(spark, sf_dir)
    line = joined('<tr><td><a href="/public-report/establishment/', F.col("id"), '">', F.col("name"), "</a><td>", F.col("sector_label"), "<td>Road 1, ", F.col("upazila"), ", ", F.col("district"), ", ", F.col("division"), "<td>A<td>", F.col("status"), "</tr>")
    pages = on_pages(rows, F.expr("(id - 1) div 25 + 1"), F.col("id"), line).crossJoin(F.broadcast(rows.agg(F.count("*").alias("total"))))  # one row
    first = F.expr("substring_index(lines, '</tr>', 1)")
    page = joined(f"<p>{html.LIST_TOTAL} : ", F.format_number("total", 0), f" টি</p><p>{html.LIST_SHOWN} : ", F.col("n"), f" টি</p><div>{html.LIST_TIME} : 1 Jan 2024</div><table>", F.col("lines"), first, "</tr><tr><td>no link</td></tr></table>")
    made = html.parsed(pages.select("page", page.alias("html"), F.lit(f"{HOST}/list").alias("url")), "list")
    made = made.select("page", "parsed.total_records", "parsed.showing_records", F.col("parsed.source_reported_at_raw").alias("reported"), F.explode("parsed.rows").alias("r"))
    return made.select("page", "total_records", "showing_records", "reported", *[f"r.{c}" for c in ("public_id", "name", "sector", "upazila", "district", "division", "licence_class", "status", "detail_url")])


@query(
    "detail_pages",
    f"""WITH {REGISTRY_SQL} SELECT id, name AS name_en, 'bn ' || id AS name_bn, 'Road ' || id AS address, upazila, district, division, status, sector_label AS sector, 'L-' || id AS licence_no, 'A' AS licence_class,
  'Factory' AS establishment_type, CASE WHEN id % 3 > 0 THEN id % 50 END AS worker_component_1, CASE WHEN id % 3 > 0 THEN id % 7 END AS worker_component_2, CASE WHEN id % 3 > 0 THEN id % 50 + id % 7 ELSE id END AS worker_total FROM registry""",
)
def detail_pages(spark, sf_dir):
    place = joined("<div>", html.DETAIL_PLACE[0], " : ", F.col("upazila"), ", ", html.DETAIL_PLACE[1], " : ", F.col("district"), ", ", html.DETAIL_PLACE[2], " : ", F.col("division"), "</div>")
    workers = F.when(F.col("id") % 3 > 0, joined(F.col("id") % 50, " + ", F.col("id") % 7, " = ", F.col("id") % 50 + F.col("id") % 7)).otherwise(F.format_number("id", 0))
    page = joined(
        "<h2>", F.col("name"), " (bn ", F.col("id"), f")</h2><div>{html.DETAIL_LABELS['address']}</div><div>Road ", F.col("id"), "</div>", place, f"<div>{html.DETAIL_STATUS}</div><div>", F.col("status"),
        f"</div><div>{html.DETAIL_LABELS['sector']}</div><div>", F.col("sector_label"), f"</div><div>{html.DETAIL_LABELS['licence_no']} L-", F.col("id"), f"</div><div>{html.DETAIL_CLASS}</div><div>A (Factory)</div><div>{html.DETAIL_WORKERS} ", workers, "</div>",
    )
    made = html.parsed(registry(spark, sf_dir).select("id", page.alias("html"), F.lit(None).cast("string").alias("url")), "detail")
    return made.select("id", *[f"parsed.{c}" for c in ("name_en", "name_bn", "address", "upazila", "district", "division", "status", "sector", "licence_no", "licence_class", "establishment_type", "worker_component_1", "worker_component_2", "worker_total")])


@query(
    "filter_options",
    """SELECT r_regionkey, 'DISTRICT' AS dimension, n_nationkey::VARCHAR AS source_value, n_name AS source_label FROM region JOIN nation ON n_regionkey = r_regionkey
  UNION ALL SELECT r_regionkey, 'REGION', r_regionkey::VARCHAR, r_name FROM region""",
)
def filter_options(spark, sf_dir):
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    line = joined('<option value="', F.col("n_nationkey"), '">', F.col("n_name"), "</option>")
    pages = on_pages(nation, F.col("n_regionkey"), F.col("n_nationkey"), line).join(region, F.col("page") == F.col("r_regionkey"))
    page = joined('<select name="district"><option value="">all</option>', F.col("lines"), '</select><select id="region"><option value="', F.col("r_regionkey"), '">', F.col("r_name"), '<option value="9"> </select><select><option value="1">x</select>')
    return html.rows_of(pages.select("r_regionkey", page.alias("html"), F.lit(None).cast("string").alias("url")), "options").drop("url")


_MEMBER_SQL = """SELECT s_suppkey AS k, s_name AS name, (s_suppkey - 1) // 10 + 1 AS page, count(*) OVER (PARTITION BY (s_suppkey - 1) // 10) AS n, count(*) OVER () AS total FROM supplier"""


@query(
    "member_index_pages",
    f"""WITH m AS ({_MEMBER_SQL}), t AS (SELECT max(page) AS last FROM m)
  SELECT page, 'BGMEA' AS source_name, total AS total_records, n AS records_on_page, page AS current_page, greatest(ceil(total / n)::BIGINT, last) AS last_page, k::VARCHAR AS source_key, name AS entity_name,
    'R' || k AS registration_no, '{HOST}/member/' || k AS detail_url FROM m CROSS JOIN t""",
)
def member_index_pages(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier")
    line = joined("<tr><td>", F.col("s_name"), "</td><td>R", F.col("s_suppkey"), '</td><td><a href="/member/', F.col("s_suppkey"), '">view</a></td></tr>')
    pages = on_pages(rows, F.expr("(s_suppkey - 1) div 10 + 1"), F.col("s_suppkey"), line).crossJoin(F.broadcast(rows.agg(F.count("*").alias("total"), F.max(F.expr("(s_suppkey - 1) div 10 + 1")).alias("last"))))  # one row
    page = joined("<p>Total ", F.format_number("total", 0), " Member(s) Found</p><table>", F.col("lines"), F.col("lines"), '</table><a href="?page=', F.col("last"), '">', F.col("last"), "</a>")
    made = html.parsed(pages.select("page", page.alias("html"), joined(f"{HOST}/members?page=", F.col("page")).alias("url")), "member_index")
    made = made.select("page", *[f"parsed.{c}" for c in ("source_name", "total_records", "records_on_page", "current_page", "last_page")], F.explode("parsed.rows").alias("r"))
    return made.select("*", "r.source_key", "r.entity_name", "r.registration_no", "r.detail_url").drop("r")


@query(
    "exporter_directory",
    f"""WITH m AS ({_MEMBER_SQL}) SELECT page, (k + 1)::VARCHAR AS source_key, name AS entity_name, CASE WHEN page % 4 < 3 THEN n_name END AS district,
    CASE WHEN page % 4 < 3 THEN '{HOST}/exporter/' || (k + 1) || '/s' || (k + 1) ELSE '{HOST}/exporter/' || (k + 1) || '/card' END AS detail_url,
    CASE WHEN page % 4 < 3 THEN total END AS total_records FROM m JOIN supplier ON s_suppkey = k JOIN nation ON n_nationkey = s_nationkey""",
)
def exporter_directory(spark, sf_dir):
    """JSON in three envelopes, and cards whose name is a link's or a heading's; entries without a number as id are left out."""
    rows = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).withColumn("p", F.expr("(s_suppkey - 1) div 10 + 1"))
    total = F.broadcast(rows.agg(F.count("*").alias("total")))  # one row
    key = F.col("s_suppkey") + 1
    entry = joined('{"id":', key, ',"name":"', F.col("s_name"), '","slug":"s', key, '","factory_district":{"name":"', F.col("n_name"), '"}},')
    pages = on_pages(rows.filter("p % 4 < 3"), F.col("p"), key, entry).crossJoin(total)
    items = joined("[", F.col("lines"), '{"id":"none","name":"x"}]')
    body = F.when(F.col("page") % 4 == 0, joined('{"data":{"data":', items, ',"total":', F.col("total"), "}}")).when(F.col("page") % 4 == 1, joined('{"exporters":', items, ',"meta":{"total":"', F.col("total"), '"}}')).otherwise(joined('{"results":{"items":', items, '},"count":', F.col("total"), "}"))
    made = html.parsed(pages.select("page", body.alias("html"), F.lit(f"{HOST}/directory").alias("url")), "exporter_json")
    card = F.when(key % 2 == 0, joined('<li><a href="/exporter/', key, '/card">', F.col("s_name"), "</a></li>")).otherwise(joined("<li><h3>", F.col("s_name"), '</h3><p><a href="/exporter/', key, '/card"></a></p></li>'))
    cards = on_pages(rows.filter("p % 4 = 3"), F.col("p"), key, card).select("page", joined('<ul><a href="/exporter/no-number">x</a>', F.col("lines"), "</ul>").alias("html"), F.lit(f"{HOST}/directory").alias("url"))
    both = made.unionByName(html.parsed(cards, "exporter_cards"))
    return both.select("page", "parsed.total_records", F.explode("parsed.rows").alias("r")).select("page", "total_records", "r.source_key", "r.entity_name", "r.district", "r.detail_url")


@query(
    "external_profiles",
    """WITH m AS (SELECT s_suppkey AS k, s_suppkey % 5 AS kind, 'supplier ' || split_part(s_name, '#', 2) AS core, s_name || ' Co. Ltd.' AS name FROM supplier)
  SELECT k, CASE kind WHEN 0 THEN 'EPB' WHEN 1 THEN 'BGMEA' WHEN 2 THEN 'BKMEA' WHEN 3 THEN 'BEPZA' ELSE 'DOE' END AS source_name,
    CASE WHEN kind < 2 THEN k::VARCHAR WHEN kind = 2 THEN 'm ' || k WHEN kind = 3 THEN 'north epz::' || core ELSE 'c ' || k END AS external_key, name AS entity_name, 'Plot ' || k AS site_text, 'D' || k % 3 AS district,
    CASE WHEN k % 2 = 0 THEN 'U' || k % 4 END AS upazila, NULL::VARCHAR AS error FROM m""",
)
def external_profiles(spark, sf_dir):
    """Profiles of all five directories: a table, a definition list or ``label: value`` lines, with the key of each kind."""
    key = F.col("s_suppkey")
    label = F.element_at(F.array(*[F.lit(x) for x in ("Company Name", "Member Name", "Company", "Enterprise Name", "Project / Industry")]), (key % 5 + 1).cast("int"))
    own = F.when(key % 5 == 2, joined("<p>Membership No: M-", key, "</p>")).when(key % 5 == 3, F.lit("<p>Zone: North EPZ</p>")).when(key % 5 == 4, joined("<p>Client ID: C/", key, "</p>")).otherwise("")
    site = F.when(key % 5 < 3, "Factory Address").otherwise("Address")
    page = joined(
        "<table><tr><th>", label, "</th><td>", F.col("s_name"), " Co. Ltd.</td></tr></table><dl><dt>", site, "<dd>Plot ", key, "</dl>", own, "<p>District: D", key % 3, "</p>",
        F.when(key % 2 == 0, joined("<li>Upazila: U", key % 4, "</li>")).otherwise(""),
    )
    url = F.when(key % 5 == 0, joined(f"{HOST}/exporter/", key, "/x")).when(key % 5 == 1, joined(f"{HOST}/member/", key)).otherwise(f"{HOST}/profile")
    pages = table(spark, sf_dir, "supplier").select(key.alias("k"), page.alias("html"), url.alias("url"))
    made = None
    for n, source in enumerate(SOURCES):
        part = html.parsed(pages.filter(F.col("k") % 5 == n), "external", source=source)
        made = part if made is None else made.unionByName(part)
    return made.select("k", *[f"parsed.{c}" for c in ("source_name", "external_key", "entity_name", "site_text", "district", "upazila", "error")])


@query("risk_table_pages", "SELECT n_regionkey AS page, r_name AS division, n_name AS district, 'Zone ' || n_nationkey AS climate_zone, CASE n_nationkey % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END AS risk FROM nation JOIN region ON r_regionkey = n_regionkey")
def risk_table_pages(spark, sf_dir):
    """The second table of each page has the seven headers, in another order and with a column more."""
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    risk = F.element_at(F.array(F.lit("High"), F.lit("Medium"), F.lit("Low")), (F.col("n_nationkey") % 3 + 1).cast("int"))
    line = joined("<tr><td>", risk, "</td><td>", F.col("n_nationkey"), "</td><td>", F.col("r_name"), "</td><td>", F.col("n_name"), "</td><td>Zone ", F.col("n_nationkey"), "</td><td>High</td><td>Low</td><td>Low</td></tr>")
    head = "".join(f"<th>{x.title()}</th>" for x in ("risk", "no", *html.RISK_HEADERS[:-1]))
    pages = on_pages(rows, F.col("n_regionkey"), F.col("n_nationkey"), line)
    page = joined(f"<table><tr><td>other</td></tr></table><table><tr>{head}</tr>", F.col("lines"), "<tr></tr></table>")
    made = html.rows_of(pages.select("page", page.alias("html"), F.lit(None).cast("string").alias("url")), "risk")
    return made.select("page", "division", "district", "climate_zone", "risk")


@query(
    "geography_csv",
    """SELECT DISTINCT 'DIVISION' AS level, 'BBS:DIV:' || r_regionkey AS geo_ref, r_name AS name FROM region JOIN nation ON n_regionkey = r_regionkey
  UNION ALL SELECT 'DISTRICT', 'BBS:DIST:' || n_regionkey || ':' || n_nationkey, n_name FROM nation
  UNION ALL SELECT DISTINCT 'UPAZILA', 'BBS:UPZ:' || n_regionkey || ':' || n_nationkey || ':' || c_custkey % 4, 'U' || c_custkey % 4 FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def geography_csv(spark, sf_dir):
    """A row per customer's upazila, districts without one, every unit often; the first row of a unit counts."""
    nation, region, customer = (table(spark, sf_dir, x) for x in ("nation", "region", "customer"))
    named = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    whole = named.join(customer.select("c_nationkey", (F.col("c_custkey") % 4).alias("u")), F.col("n_nationkey") == F.col("c_nationkey"))
    columns = [F.col("r_regionkey").cast("string"), F.col("r_name"), F.lit(""), F.col("n_nationkey").cast("string"), F.col("n_name"), F.lit("")]
    rows = whole.select(*columns, F.col("u").cast("string"), joined("U", F.col("u")), F.lit("")).toDF(*tables.GEOGRAPHY_COLUMNS).unionByName(named.select(*columns, F.lit(""), F.lit(""), F.lit("")).toDF(*tables.GEOGRAPHY_COLUMNS))
    path = scratch(spark, "geography")
    rows.write.option("header", True).option("emptyValue", "").csv(path)
    made = tables.geography_units(spark, path)
    name = F.when(F.col("level") == "DIVISION", F.col("division_name_en")).when(F.col("level") == "DISTRICT", F.col("district_name_en")).otherwise(F.col("upazila_name_en"))
    return made.select("level", "geo_ref", name.alias("name"))


@query("bulk_csv", f"WITH {REGISTRY_SQL} SELECT id + 1 AS id, name, sector_label, upazila, district, division, CASE WHEN id % 2 = 0 THEN 'A' END AS licence_class, status FROM registry")
def bulk_csv(spark, sf_dir):
    """An export with places in columns of their own or in the location, quotes and line breaks, checked against its declared total."""
    rows = registry(spark, sf_dir)
    own = F.col("id") % 3 == 0
    place = F.concat_ws(", ", joined('"Road"\n', F.col("id")), "upazila", "district", "division")
    made = rows.select(
        (F.col("id") + 1).cast("string"), "name", "sector_label", F.when(~own, place), *[F.when(own, F.col(c)).otherwise("  ") for c in ("upazila", "district", "division")], F.when(F.col("id") % 2 == 0, " A "), "status",
    ).toDF(*tables.BULK_COLUMNS)
    path = scratch(spark, "bulk")
    made.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return tables.checked_bulk(tables.bulk_registry(spark, path), rows.count()).select("id", "name", "sector_label", "upazila", "district", "division", "licence_class", "status")


def nation_pages(spark: SparkSession, sf_dir: str, size: int) -> dict[int, str]:
    """Listing pages of the 25 nations, ``size`` on each."""
    found = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).orderBy("n_nationkey").collect()
    pages = {}
    for a in range(0, len(found), size):
        lines = "".join(f'<tr><td><a href="/public-report/establishment/{r.n_nationkey + 1}">{r.n_name} Mills</a><td>Rice<td>Road, U, {r.n_name}, {r.r_name}<td>A<td>Active</tr>' for r in found[a : a + size])
        pages[a // size + 1] = f"<p>{html.LIST_TOTAL} : {len(found)} টি</p><table>{lines}</table>"
    return pages


_NATIONS = "SELECT n_nationkey // {size} + 1 AS page, n_nationkey + 1 AS id, n_name || ' Mills' AS name, n_name AS district, r_name AS division FROM nation JOIN region ON r_regionkey = n_regionkey"


@query("page_archive", f"SELECT 'COMPLETED' AS status, * FROM ({_NATIONS.format(size=6)})")
def page_archive(spark, sf_dir):
    """A staged archive: manifest, a digest for each file, page set equal to the plan."""
    folder, entries = scratch(spark, "archive"), []
    for number, page in nation_pages(spark, sf_dir, 6).items():
        write_text(spark, f"{folder}/p{number}.html", page)
        entries.append({"page": number, "file": f"p{number}.html", "retrieved_at": "2024-01-01", "sha256": hashlib.sha256(page.encode()).hexdigest()})
    head = {"format_version": "1.0", "universe_label": "u", "seed_url": HOST, "page_size": 6, "created_at": "2024-01-01", "pages": entries}
    write_text(spark, f"{folder}/manifest.json", json.dumps(head))
    staged, members, total = tables.ingest_archive(spark, folder)
    status = lifecycle.finalize_universe(staged, members, total)[0]
    return members.select(F.lit(status).alias("status"), "page", F.col("id").cast("long").alias("id"), "name", "district", "division")


def _clock():
    now = [0]

    def tick() -> str:
        now[0] += 1
        return f"2024-01-01 {now[0] // 3600:02d}:{now[0] // 60 % 60:02d}:{now[0] % 60:02d}"

    return tick


@query("universe_run", "SELECT 'FAILED' AS first_status, 'COMPLETED' AS status, 'r1' AS parent, n_nationkey // 5 + 1 AS page, n_nationkey + 1 AS id, 25 AS reported_total FROM nation")
def universe_run(spark, sf_dir):
    """A run whose total moves fails; its restart collects in bounded batches until it is complete."""
    store, clock, pages = LogStore(spark, scratch(spark, "universe")), _clock(), nation_pages(spark, sf_dir, 5)
    moved = pages | {2: pages[2].replace(f"{html.LIST_TOTAL} : 25", f"{html.LIST_TOTAL} : 26")}

    def fetch(of: dict[int, str]):
        return lambda url: of[int(url.rsplit("=", 1)[1])]

    runs.create_universe(store, "r1", f"{HOST}/list?page=1", clock(), 5)
    try:
        runs.run_universe_batch(store, fetch(moved), "r1", clock)
    except SnapshotIntegrityError:
        pass  # the run has recorded it
    runs.restart_universe(store, "r1", "r2", clock(), "the total moved")
    for _ in range(3):
        if runs.universe(store, "r2")["status"] == "RUNNING":
            runs.run_universe_batch(store, fetch(pages), "r2", clock, max_pages=2)
    state, members = runs.universe(store, "r2"), spark.read.parquet(store.path("universe_members")).filter("run = 'r2'")
    return members.select(
        F.lit(runs.universe(store, "r1")["status"]).alias("first_status"), F.lit(state["status"]).alias("status"), F.lit(state["parent"]).alias("parent"),
        F.col("page").cast("long").alias("page"), F.col("id").cast("long").alias("id"), F.col("source_reported_total").alias("reported_total"),
    )


@query(
    "index_run",
    f"SELECT 'COMPLETED' AS status, (n_nationkey + 1)::VARCHAR AS source_key, substr(md5(n_name), 1, 9) || ' Co.' AS entity_name, '{HOST}/member/' || (n_nationkey + 1) AS detail_url, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey + 100 END AS target_id FROM nation",
)
def index_run(spark, sf_dir):
    """A directory index: planned pages, versions, gate; then a profile request for each target that meets a record."""
    store, clock = LogStore(spark, scratch(spark, "index")), _clock()
    # names that share no word but that of their legal form
    nations = table(spark, sf_dir, "nation").withColumn("n_name", F.substring(F.md5("n_name"), 1, 9))
    found = nations.orderBy("n_nationkey").collect()
    pages = ["".join(f'<tr><td>{r.n_name} Co.</td><td>R{r.n_nationkey}</td><td><a href="/member/{r.n_nationkey + 1}">view</a></td></tr>' for r in found[a : a + 10]) for a in range(0, 25, 10)]
    runs.create_index(store, "i", "BGMEA", "member_index", f"{HOST}/m?page=1", clock())
    for _ in range(2):
        runs.collect(store, lambda url: f"Total {len(found)} Member(s) Found<table>{pages[int(url.rsplit('=', 1)[1]) - 1]}</table>", "i", clock)
        runs.stage_index(store, "i", clock())
    status, _ = runs.finalize_index(store, "i", clock())
    runs.plan_candidates(store, "d", "i", nations.filter("n_nationkey % 2 = 0").select((F.col("n_nationkey") + 100).alias("target_id"), joined(F.col("n_name"), " Ltd").alias("name")), clock())
    asked = spark.read.parquet(store.path("request_targets")).select(F.col("item").alias("source_key"), F.col("target_id").cast("long").alias("target_id"))
    return runs.index_records(store, "i").select(F.lit(status).alias("status"), "source_key", "entity_name", "detail_url").join(asked, "source_key", "left").select("status", "source_key", "entity_name", "detail_url", "target_id")


@query(
    "progressive_details",
    "SELECT n_nationkey + 1 AS id, n_name || ' Mills' AS name_en, 'L-' || (n_nationkey + 1) AS licence_no, n_name AS district, 'PASSED' AS first_checkpoint, 'FAILED' AS second_checkpoint FROM nation WHERE n_nationkey % 9 < 8",
)
def progressive_details(spark, sf_dir):
    """Freeze, plan and collect by checkpoints: the first passes, the second misses its retrieval rate and stops the run."""
    store, clock = LogStore(spark, scratch(spark, "details")), _clock()
    found = {r.n_nationkey + 1: r.n_name for r in table(spark, sf_dir, "nation").collect()}
    kept = [k for k in sorted(found) if (k - 1) % 9 < 8]
    rows = spark.createDataFrame([(k, "F", "N") for k in found], "id long, sector_family string, geography_group string")
    runs.freeze(store, "v", rows, clock(), {"F": len(found)}, {"N": len(found)})
    runs.plan_details(store, "v", clock(), f"{HOST}/public-report/establishment", (len(found) - 2 * (len(found) - len(kept)), len(found)))
    order = [int(r["item"]) for r in runs.requests(store, "detail:v").orderBy("sequence_no").collect()]
    # the last requests stand for those that can't be fetched: the page of another nation is there
    swap = dict(zip([k for k in order if k in kept] + [k for k in order if k not in kept], order, strict=True))
    by_url = {v: k for k, v in swap.items()}

    def fetch(url: str) -> str:
        k = by_url[int(url.rsplit("/", 1)[1])]
        if k not in kept:
            raise FetchError("HTTP 404")
        place = f"{html.DETAIL_PLACE[0]} : U, {html.DETAIL_PLACE[1]} : {found[k]}, {html.DETAIL_PLACE[2]} : D"
        labels = html.DETAIL_LABELS
        parts = (place, html.DETAIL_STATUS, "Active", labels["licence_expiry_raw"], "2030", labels["sector"], "Rice", labels["address"], f"Road {k}", f"{labels['licence_no']} L-{k}", html.DETAIL_CLASS, "A (Factory)", f"{html.DETAIL_WORKERS} {k}")
        return f"<h2>{found[k]} Mills</h2>" + "".join(f"<div>{x}</div>" for x in parts)

    runs.run_progressive(store, fetch, "v", clock)
    states = [state for _, state in sorted(runs.checkpoint_states(store, "v").items())]
    made = spark.read.parquet(store.path("detail_observations"))
    return made.select(F.regexp_extract("licence_no", "([0-9]+)", 1).cast("long").alias("id"), "name_en", "licence_no", "district", F.lit(states[0]).alias("first_checkpoint"), F.lit(states[1]).alias("second_checkpoint"))


@query(
    "enrichment_run",
    """SELECT n_nationkey + 1 AS target_id, 'AUTO_SELECTED' AS outcome, 'EMPLOYMENT_COUNT' AS observation_type, (n_nationkey + 1) * 10.0 AS value_numeric FROM nation WHERE n_nationkey % 5 < 4
  UNION ALL SELECT n_nationkey + 1, 'AUTO_SELECTED', 'ASSOCIATION_MEMBERSHIP_RECORD', NULL FROM nation WHERE n_nationkey % 5 < 4""",
)
def enrichment_run(spark, sf_dir):
    """Profiles are fetched, staged as versions and typed facts, resolved and linked; a second run adds nothing. Every fifth profile is missing."""
    store, clock = LogStore(spark, scratch(spark, "enrichment")), _clock()
    nations = table(spark, sf_dir, "nation")
    found = {r.n_nationkey + 1: r.n_name for r in nations.collect()}
    items = spark.createDataFrame([(str(k), n, f"{HOST}/member/{k}") for n, k in enumerate(sorted(found), 1)], "item string, sequence_no int, url string")
    runs.plan(store, "p", items, clock())

    def fetch(url: str) -> str:
        k = int(url.rsplit("/", 1)[1])
        if (k - 1) % 5 == 4:
            raise FetchError("HTTP 404")
        return f"<h2>{found[k]} Textile Mills</h2><table><tr><td>Factory Address</td><td>Road {k} {found[k]}</td></tr><tr><td>District</td><td>{found[k]}</td></tr><tr><td>Upazila</td><td>U{k}</td></tr></table><p>Employees: {k * 10}</p>"

    key = F.col("n_nationkey") + 1
    asked = nations.select(key.alias("target_id"), joined(F.col("n_name"), " Textile Mills Ltd").alias("name"), joined("Road ", key, " ", F.col("n_name")).alias("address"), F.col("n_name").alias("district"), joined("U", key).alias("upazila"), F.lit("RMG_TEXTILE").alias("sector_family"))
    runs.run_enrichment(store, fetch, "p", "BGMEA", asked, clock)
    again = runs.run_enrichment(store, fetch, "p", "BGMEA", asked, clock)
    outcome = F.lit("AUTO_SELECTED" if not again["links"] and again["outcomes"].get("AUTO_SELECTED") == 20 else str(again))
    return runs.linked_facts(store).select(F.col("target_id").cast("long").alias("target_id"), outcome.alias("outcome"), "observation_type", "value_numeric")


@query("target_states", "SELECT n_nationkey + 1 AS target_id, n_nationkey % 2 = 0 AS eligible, CASE WHEN n_nationkey % 2 = 0 THEN 'PENDING' ELSE 'OUT_OF_SCOPE' END AS status, 'APPROVED' AS policy_status, 'first' AS notes FROM nation")
def target_states(spark, sf_dir):
    """Targets of a source from a frozen sample, planned twice; the source's profile keeps what an upsert leaves out."""
    store, clock = LogStore(spark, scratch(spark, "targets")), _clock()
    rows = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1).alias("id"), F.when(F.col("n_nationkey") % 2 == 0, "RMG_TEXTILE").otherwise("FOOD_AGRO").alias("sector_family"), F.lit("N").alias("geography_group"))
    even, odd = rows.filter("sector_family = 'RMG_TEXTILE'").count(), rows.filter("sector_family <> 'RMG_TEXTILE'").count()
    runs.freeze(store, "v", rows, clock(), {"RMG_TEXTILE": even, "FOOD_AGRO": odd}, {"N": even + odd})
    for _ in range(2):
        runs.plan_targets(store, "v", "BGMEA", clock())
    runs.register_source(store, "bgmea", "UNKNOWN", notes="first")
    runs.register_source(store, "BGMEA", "APPROVED")
    profile = runs.source_profiles(store).select("policy_status", "notes")
    return runs.targets(store, "v", "BGMEA").select(F.col("target_id").cast("long").alias("target_id"), "eligible", "status").crossJoin(F.broadcast(profile))  # one row


@query("exposure_ingest", "SELECT 'BBS:DIST:' || n_regionkey || ':' || n_nationkey AS geo_ref, count(*) * 5 AS observations, count(*) * 5 AS inserted_once FROM nation WHERE n_nationkey % 6 < 5 GROUP BY ALL")
def exposure_ingest(spark, sf_dir):
    """Risk tables become five observations per resolved district, added once; names without a unit are reported, not guessed."""
    store = LogStore(spark, scratch(spark, "exposures"))
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    none = F.lit(None).cast("string")
    units = rows.filter("n_nationkey % 6 < 5").select(
        F.lit("DISTRICT").alias("level"), joined("BBS:DIST:", F.col("n_regionkey"), ":", F.col("n_nationkey")).alias("geo_ref"), F.col("r_name").alias("division_name_en"), none.alias("division_name_bn"),
        F.col("n_name").alias("district_name_en"), none.alias("district_name_bn"), none.alias("upazila_name_en"), none.alias("upazila_name_bn"),
    )
    line = joined("<tr><td>", F.col("r_name"), "</td><td>", F.col("n_name"), "</td><td>Z</td><td>High</td><td>Low</td><td>Low</td><td>Medium</td></tr>")
    head = "".join(f"<th>{x.title()}</th>" for x in html.RISK_HEADERS)
    page = on_pages(rows, F.lit(1), F.col("n_nationkey"), line).select(joined(f"<table><tr>{head}</tr>", F.col("lines"), "</table>").alias("html"), F.lit("u").alias("url"))
    first = runs.ingest_risk_page(store, page, units, "DDM", "2020", "2024-01-01")
    again = runs.ingest_risk_page(store, page, units, "DDM", "2020", "2024-01-01")
    if again["inserted"] or len(first["unresolved"]) != rows.count() - units.count():
        raise ValueError(f"{first}, then {again}")
    made = spark.read.parquet(store.path("exposures"))
    return made.groupBy(F.col("canonical_geo_ref").alias("geo_ref")).agg(F.count("*").alias("observations"), F.count_distinct("observation_sha256").alias("inserted_once"))


@query(
    "stored_geography",
    """SELECT 'BBS:DIST:' || n_regionkey || ':' || n_nationkey AS geo_ref, CASE WHEN n_nationkey % 3 = 0 THEN 'new ' ELSE '' END || n_name AS district_name_en, r_name AS division_name_en,
  CASE WHEN n_nationkey % 2 = 0 THEN 'APPROVED_ALIAS' ELSE 'NO_MATCH' END AS resolved FROM nation JOIN region ON r_regionkey = n_regionkey""",
)
def stored_geography(spark, sf_dir):
    """Units are stored twice, a third of them renamed; every other one has an alias, which is stored once and resolves its name."""
    store = LogStore(spark, scratch(spark, "geography-store"))
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    units = rows.select(F.lit("DISTRICT").alias("level"), joined("BBS:DIST:", F.col("n_regionkey"), ":", F.col("n_nationkey")).alias("geo_ref"), F.col("r_name").alias("division_name_en"), F.col("n_name").alias("district_name_en"), F.col("n_nationkey").alias("k"))
    aliases = units.filter("k % 2 = 0").select("level", joined("Old place ", F.col("k")).alias("alias"), "geo_ref", F.lit("s").alias("source_name"), F.lit("n").alias("note"))
    runs.store_units(store, units.drop("k"), aliases)
    renamed = units.filter("k % 3 = 0").withColumn("district_name_en", joined("new ", F.col("district_name_en")))
    if runs.store_units(store, renamed.drop("k"), aliases)["aliases"]:
        raise ValueError("an alias was stored twice")
    stored, known = runs.stored_units(store)
    asked = units.select(F.col("geo_ref").alias("ask_id"), "level", joined("old PLACE ", F.col("k")).alias("name"), F.lit(None).cast("string").alias("division"), F.lit(None).cast("string").alias("district"))
    found = exposure.resolve_places(asked, stored, known).select("ask_id", F.when((F.col("status") == "NO_MATCH") | (F.col("geo_ref") == F.col("ask_id")), F.col("status")).alias("resolved"))
    return stored.join(found, F.col("geo_ref") == F.col("ask_id")).select("geo_ref", "district_name_en", "division_name_en", "resolved")


@query(
    "exposure_facts",
    """SELECT 'DDM' AS source, 'authority' AS authority, 'second' AS methodology_note, n_name AS district, 'DISTRICT' AS spatial_scope, n_nationkey * 1.5 AS value_numeric
  FROM nation""",
)
def exposure_facts(spark, sf_dir):
    """Facts are stored once each and read without the store's own columns, with the provenance that was registered last."""
    store = LogStore(spark, scratch(spark, "facts"))
    none = F.lit(None).cast("string")
    rows = table(spark, sf_dir, "nation").select(
        F.lit("DDM").alias("source"), F.lit(sorted(EXPOSURE_DOMAINS)[0]).alias("domain"), F.lit("m").alias("metric_code"), F.lit("Metric").alias("metric_label"), F.lit("DISTRICT").alias("spatial_scope"),
        F.col("n_name").alias("district"), (F.col("n_nationkey") * 1.5).alias("value_numeric"), F.lit(None).cast("string").alias("direction"),
        *[none.alias(c) for c in ("establishment_ref", "upazila", "value_text", "unit", "source_vintage", "observed_at", "evidence_note", "canonical_geo_ref", "geography_match_type", "source_geography_label")],
    )
    for note in ("first", "second"):
        runs.register_exposure_source(store, " DDM ", "authority", note, "2024-01-01")
        runs.ingest_exposures(store, rows)
    made = runs.exposure_facts(store)
    return made.join(F.broadcast(runs.exposure_sources(store)), F.col("source") == F.col("source_name")).select("source", "authority", "methodology_note", "district", "spatial_scope", "value_numeric")  # a row per source
