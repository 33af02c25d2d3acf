"""Planned runs over a store: immutable manifests, polite collection, staging bound to the plan, gates.

Pages are fetched one at a time on the driver (the access policy forbids more) and landed in
bounded batches. All that follows is set-based: a page counts only if its run, item and address
are planned and unresolved, observations are added by content hash, states are events. Each
step can be repeated after a failure: what is landed isn't fetched again, what is staged isn't
staged again.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import admin_name, set_page, url_key
from ..sources.access import FetchError
from ..sources.html import parsed
from ..sources.store import LogStore, last_known
from ..vocab import CHECKPOINTS
from . import evidence, exposure, lifecycle, matching, quality, sampling
from .audit import Audit
from .versioning import append_new, latest_by, one_per_key

MANIFEST = "run string, item string, sequence_no int, url string"
LANDED = "run string, item string, url string, retrieved_at timestamp, html string, content_sha256 string, seq long"
SAMPLE = "id long, sector_family string, geography_group string"
DECISIONS = "label string, checkpoint int, at timestamp, passed boolean, metrics string, reasons array<string>"
UNIVERSES = "run string, seed_url string, page_size int, expected_total long, seq long, parent string, reason string"
MEMBERS = "run string, page int, source_reported_total long, id long, content_sha256 string"
UNIVERSE_PAGES = "run string, page int, source_reported_total long, records_parsed int, content_sha256 string"
_PLACES = "entity_name string, site_text string, district string, upazila string"
VERSIONS = f"record_id string, source string, external_key string, url string, {_PLACES}, source_updated_at_raw string, source_fields map<string,string>, observed_at timestamp, content_sha256 string"
TYPED = "record_id string, source string, observation_type string, scope string, value_text string, value_numeric double, unit string, content_sha256 string, observed_at timestamp, observation_sha256 string"
LINKS = "target_id long, record_id string, source string, match_type string, site_level_match boolean, linked_at timestamp"
TARGETS = "label string, source string, target_id long, eligible boolean, status string, planned_at timestamp, seq long"
PROFILES = "source string, policy_status string, last_verified_at string, notes string, seq long"
INDEXES = "run string, source string, parser string, seed_url string, seq long"
INDEX_PAGES = "run string, page int, source_reported_total long, source_reported_last_page long, records_parsed int, content_sha256 string"
_INDEX_ROW = "source_key string, entity_name string, detail_url string, registration_no string, district string, upazila string, office_address string, factory_address string"
INDEX_VERSIONS = f"run string, page int, source string, {_INDEX_ROW}, row_sha256 string, observed_at timestamp"
#: Parsers that a source's directory pages may have, and the path segment of its profiles.
INDEX_PARSERS = {"BGMEA": ("member_index",), "EPB": ("exporter_cards", "exporter_json")}
INDEX_SEGMENTS = {"BGMEA": "member", "EPB": "exporter"}
CHECKPOINT_TRANSITIONS = {None: ("READY", "LOCKED"), "LOCKED": ("READY",), "READY": ("PASSED", "FAILED"), "FAILED": ("PASSED", "FAILED"), "PASSED": ("PASSED", "FAILED")}
#: Pages that are held on the driver before they are landed.
LAND_ROWS = 50


def _record(store: LogStore, log: str, rows: DataFrame, at: str, allowed: dict) -> int:
    """Append the events (entity, status, note) that the entities' states allow; returns their number."""
    asked = rows.select("entity", "status", F.lit(at).cast("timestamp").alias("at"), F.lit(time.time_ns()).alias("seq"), F.col("note").cast("string").alias("note"))
    accepted, _ = lifecycle.transitions(store.read(log, lifecycle.EVENT), asked, allowed)
    return store.append(log, accepted.select("entity", "status", "at", "seq", "note"))


def _one(store: LogStore, log: str, entity: str, status: str, at: str, note: str | None, allowed: dict) -> None:
    row = store.spark.createDataFrame([(entity, status, note)], "entity string, status string, note string")
    if not _record(store, log, row, at, allowed):
        raise ValueError(f"{entity} can't become {status}")


def _entity():
    return F.concat_ws("/", "run", "item")


def plan(store: LogStore, run: str, items: DataFrame, at: str, extend: bool = False) -> int:
    """Plan ``items`` (item, sequence_no, url) of a run. A run is planned once; only ``extend`` adds unknown items."""
    known = store.read("manifest", MANIFEST).filter(F.col("run") == run)
    if not extend and not known.isEmpty():
        raise ValueError(f"{run} is planned already; use a new label")
    rows = items.select(F.lit(run).alias("run"), F.col("item").cast("string").alias("item"), F.col("sequence_no").cast("int").alias("sequence_no"), "url")
    n = store.append_new("manifest", rows, ["run", "item"])
    planned = store.read("manifest", MANIFEST).filter(F.col("run") == run).select(_entity().alias("entity"), F.lit("PLANNED").alias("status"), F.lit(None).alias("note"))
    states = lifecycle.states(store.read("request_events", lifecycle.EVENT)).select("entity")
    _record(store, "request_events", planned.join(states, "entity", "left_anti"), at, lifecycle.TRANSITIONS)
    return n


def requests(store: LogStore, run: str) -> DataFrame:
    """The manifest of a run with the state of each item and when it came to it."""
    states = lifecycle.states(store.read("request_events", lifecycle.EVENT)).select("entity", F.col("status").alias("request_status"), F.col("seq").alias("state_seq"), F.col("note").alias("error"))
    return store.read("manifest", MANIFEST).filter(F.col("run") == run).withColumn("entity", _entity()).join(states, "entity")


def status_counts(store: LogStore, run: str) -> dict[str, int]:
    return {r[0]: r[1] for r in requests(store, run).groupBy("request_status").count().collect()}


def landed(store: LogStore, run: str) -> DataFrame:
    """Pages that may be staged: planned and unresolved, fetched from the planned address since the item was planned last."""
    pages = store.read("landed", LANDED).filter(F.col("run") == run).withColumnsRenamed({"seq": "landed_seq"})
    due = requests(store, run).filter("request_status = 'PLANNED'").select("run", "item", "url", "entity", "sequence_no", "state_seq")
    fresh = due.join(pages, ["run", "item", "url"]).filter("landed_seq > state_seq")
    return latest_by(fresh, ["entity"], [F.desc("landed_seq")])


def land(store: LogStore, run: str, pages: list[tuple[str, str, str, str]]) -> None:
    """Land (item, url, retrieved_at, html) rows as they were received."""
    seq = time.time_ns()
    rows = [(run, item, url, at, html, hashlib.sha256(html.encode("utf-8")).hexdigest(), seq) for item, url, at, html in pages]
    made = store.spark.createDataFrame(rows, LANDED.replace("retrieved_at timestamp", "retrieved_at string")).withColumn("retrieved_at", F.col("retrieved_at").cast("timestamp"))
    store.append("landed", made)


def collect(store: LogStore, fetch: Callable[[str], str], run: str, clock: Callable[[], str], limit: int | None = None, last_sequence: int | None = None) -> dict[str, int]:
    """Fetch what is planned and not landed, in order, one page at a time. A page that can't be fetched is FAILED."""
    if limit is not None and limit <= 0:
        raise ValueError("limit must be positive")
    todo = requests(store, run).filter("request_status = 'PLANNED'").join(landed(store, run).select("entity"), "entity", "left_anti")
    if last_sequence is not None:
        todo = todo.filter(F.col("sequence_no") <= last_sequence)
    todo = todo.orderBy("sequence_no", "item").select("entity", "item", "url")
    counts = {"attempted": 0, "fetched": 0, "failed": 0}
    held: list[tuple[str, str, str, str]] = []
    failures: list[tuple[str, str, str]] = []

    def keep() -> None:
        if held:
            land(store, run, held)
        if failures:
            _record(store, "request_events", store.spark.createDataFrame(failures, "entity string, status string, note string"), clock(), lifecycle.TRANSITIONS)
        held.clear()
        failures.clear()

    # rows are read off one partition at a time, so the driver never holds a long manifest
    try:
        for entity, item, url in (todo if limit is None else todo.limit(limit)).toLocalIterator():
            counts["attempted"] += 1
            try:
                held.append((item, url, clock(), fetch(url)))
                counts["fetched"] += 1
            except FetchError as e:
                failures.append((entity, "FAILED", str(e)))
                counts["failed"] += 1
            if len(held) + len(failures) >= LAND_ROWS:
                keep()
    finally:  # what was received stays, also when the policy forbids the next page
        keep()
    return counts


def land_pages(store: LogStore, run: str, pages: DataFrame, at: str, last_sequence: int | None = None, missing_fail: bool = True) -> int:
    """Land pages that were received together, such as an archive's (item, html), in one write; returns how many.

    Only planned items take a page, at their planned address. With ``missing_fail`` planned items
    (up to ``last_sequence``) that have none become FAILED, as if they couldn't be fetched.
    """
    todo = requests(store, run).filter("request_status = 'PLANNED'")
    if last_sequence is not None:
        todo = todo.filter(F.col("sequence_no") <= last_sequence)
    todo = todo.select("run", "item", "url", "entity")
    given = one_per_key(pages.select(F.col("item").cast("string").alias("item"), "html").filter("html is not null"), ["item"])
    made = todo.join(given, "item").select("run", "item", "url", F.lit(at).cast("timestamp").alias("retrieved_at"), "html", F.sha2("html", 256).alias("content_sha256"), F.lit(time.time_ns()).alias("seq"))
    n = store.append("landed", made)
    if missing_fail:
        lacking = todo.join(given.select("item"), "item", "left_anti").select("entity", F.lit("FAILED").alias("status"), F.lit("there is no page").alias("note"))
        _record(store, "request_events", lacking, at, lifecycle.TRANSITIONS)
    return n


def requeue_failed(store: LogStore, run: str, at: str, reason: str, items: list[str] | None = None) -> int:
    """Plan the failed items of a run again, all or those named."""
    failed = requests(store, run).filter("request_status = 'FAILED'")
    if items is not None:
        failed = failed.filter(F.col("item").isin([str(x) for x in items]))
    return _record(store, "request_events", failed.select("entity", F.lit("PLANNED").alias("status"), F.lit(reason).alias("note")), at, lifecycle.TRANSITIONS)


# --- details of a validation sample -------------------------------------------------------------


def freeze(store: LogStore, label: str, candidates: DataFrame, at: str, sectors: dict[str, int], geographies: dict[str, int]) -> int:
    """Select a sample that meets all targets, then make it the label's sample; an infeasible plan leaves the old one."""
    rows = sampling.joint_freeze(candidates, sectors, geographies)
    return store.replace("validation_sample", label, rows, at, time.time_ns())


def sample(store: LogStore, label: str) -> DataFrame:
    return store.current("validation_sample", label, SAMPLE)


def plan_details(store: LogStore, label: str, at: str, base_url: str, checkpoints: tuple[int, ...] = CHECKPOINTS) -> int:
    """The label's sample as a manifest of nested checkpoints; the first is READY, the others LOCKED."""
    rows = sampling.progressive_batches(sample(store, label), label, checkpoints)
    n = plan(store, f"detail:{label}", rows.select(F.col("id").alias("item"), "sequence_no", F.concat(F.lit(base_url.rstrip("/") + "/"), F.col("id").cast("string")).alias("url")), at)
    states = [(f"{label}#{c}", "LOCKED" if k else "READY", None) for k, c in enumerate(sorted(set(checkpoints)))]
    _record(store, "checkpoint_events", store.spark.createDataFrame(states, "entity string, status string, note string"), at, CHECKPOINT_TRANSITIONS)
    return n


def checkpoint_states(store: LogStore, label: str) -> dict[int, str]:
    found = lifecycle.states(store.read("checkpoint_events", lifecycle.EVENT)).filter(F.substring_index("entity", "#", 1) == label).select("entity", "status").collect()
    return dict(sorted((int(e.rsplit("#", 1)[1]), s) for e, s in found))


def stage_details(store: LogStore, label: str, at: str) -> int:
    """Parse landed detail pages. Their address has to name the item; the others become FAILED."""
    run = f"detail:{label}"
    pages = landed(store, run)
    ok = F.coalesce(url_key(F.col("url"), "establishment") == F.col("item"), F.lit(False))
    made = parsed(pages.filter(ok), "detail").select("run", F.col("item").cast("long").alias("id"), F.col("url").alias("source_url"), "retrieved_at", "content_sha256", "parsed.*")
    store.append_new("detail_observations", quality.assess_detail(made), ["run", "id", "content_sha256"])
    events = pages.select("entity", F.when(ok, "PARSED").otherwise("FAILED").alias("status"), F.when(~ok, "the address names another establishment").alias("note"))
    return _record(store, "request_events", events, at, lifecycle.TRANSITIONS)


def detail_rows(store: LogStore, label: str, checkpoint: int) -> DataFrame:
    """All requests up to a checkpoint with the latest observation of each."""
    asked = requests(store, f"detail:{label}").filter(F.col("sequence_no") <= checkpoint).select(F.col("item").cast("long").alias("id"), "sequence_no", "url", F.col("request_status").alias("status"))
    if not store.exists("detail_observations"):
        empty = quality.assess_detail(parsed(store.spark.createDataFrame([], "id long, url string, html string"), "detail").select("id", "parsed.*"))
        seen = empty.withColumns({"run": F.lit(""), "source_url": F.lit(""), "retrieved_at": F.lit(None).cast("timestamp"), "content_sha256": F.lit("")})
    else:
        seen = store.read_all("detail_observations")
    seen = latest_by(seen.filter(F.col("run") == f"detail:{label}"), ["id"], [F.desc("retrieved_at"), F.desc("content_sha256")]).withColumnRenamed("status", "detail_status")
    made = asked.join(seen.drop("run"), "id", "left")
    return made.withColumns({"has_provenance": (F.col("source_url") == F.col("url")) & F.col("retrieved_at").isNotNull() & F.col("content_sha256").isNotNull(), "url_ok": url_key(F.col("url"), "establishment") == F.col("id").cast("string")})


def evaluate_checkpoint(store: LogStore, label: str, checkpoint: int, at: str) -> dict:
    """Judge a checkpoint that isn't locked, keep the decision, unlock the next one if it passes."""
    states = checkpoint_states(store, label)
    if checkpoint not in states:
        raise KeyError(f"unknown checkpoint {checkpoint} of {label}")
    if states[checkpoint] == "LOCKED":
        raise ValueError(f"checkpoint {checkpoint} of {label} is locked")
    rows = detail_rows(store, label, checkpoint)
    metrics = quality.checkpoint_metrics(rows).first().asDict() | quality.field_coverage(rows).first().asDict()
    passed, reasons = quality.judge_checkpoint(metrics, checkpoint)
    decision = store.spark.createDataFrame([(label, checkpoint, passed, json.dumps(metrics, sort_keys=True), reasons)], "label string, checkpoint int, passed boolean, metrics string, reasons array<string>")
    store.append("checkpoint_decisions", decision.withColumn("at", F.lit(at).cast("timestamp")))
    _one(store, "checkpoint_events", f"{label}#{checkpoint}", "PASSED" if passed else "FAILED", at, "; ".join(reasons) or None, CHECKPOINT_TRANSITIONS)
    later = [n for n in states if n > checkpoint]
    if passed and later and states[min(later)] == "LOCKED":
        _one(store, "checkpoint_events", f"{label}#{min(later)}", "READY", at, None, CHECKPOINT_TRANSITIONS)
    return {"checkpoint": checkpoint, "passed": passed, "reasons": reasons, **metrics}


def run_checkpoint(store: LogStore, fetch: Callable[[str], str], label: str, checkpoint: int, clock: Callable[[], str], limit: int | None = None) -> dict[str, int]:
    """Collect and stage the requests of a READY checkpoint."""
    if checkpoint_states(store, label).get(checkpoint) != "READY":
        raise ValueError(f"checkpoint {checkpoint} of {label} isn't ready")
    counts = collect(store, fetch, f"detail:{label}", clock, limit, last_sequence=checkpoint)
    stage_details(store, label, clock())
    return counts


def run_progressive_pages(store: LogStore, pages: DataFrame, label: str, clock: Callable[[], str]) -> list[dict]:
    """Checkpoint after checkpoint over detail pages (item, html) that are there already, until one fails or all have passed."""
    out = []
    while ready := [n for n, s in checkpoint_states(store, label).items() if s == "READY"]:
        land_pages(store, f"detail:{label}", pages, clock(), last_sequence=min(ready))
        stage_details(store, label, clock())
        out.append(evaluate_checkpoint(store, label, min(ready), clock()))
        if not out[-1]["passed"]:
            break
    return out


def run_universe_pages(store: LogStore, run: str, pages: DataFrame, clock: Callable[[], str]) -> str:
    """Stage a universe from pages (item, html) that are there already: the first tells the total and plans the others, which come together. Returns its state."""
    try:
        for first in (True, False):
            land_pages(store, run, pages.filter(F.col("item") == "1") if first else pages, clock(), missing_fail=not first)
            stage_universe(store, run, clock())
        return finalize_universe(store, run, clock())[0]
    except quality.SnapshotIntegrityError:
        return universe(store, run)["status"]  # the run has recorded it


def run_progressive(store: LogStore, fetch: Callable[[str], str], label: str, clock: Callable[[], str]) -> list[dict]:
    """Checkpoint after checkpoint, until one fails or all have passed."""
    if not checkpoint_states(store, label):
        raise ValueError(f"no checkpoints are planned for {label}")
    out = []
    while ready := [n for n, s in checkpoint_states(store, label).items() if s == "READY"]:
        counts = run_checkpoint(store, fetch, label, min(ready), clock)
        out.append(evaluate_checkpoint(store, label, min(ready), clock()) | {"collection": counts})
        if not out[-1]["passed"]:
            break
    return out


# --- snapshots of the whole register --------------------------------------------------------------


def create_universe(store: LogStore, run: str, seed_url: str, at: str, page_size: int = 30, parent: str | None = None, reason: str | None = None) -> None:
    """A RUNNING universe whose first page is planned."""
    _one(store, "run_events", run, "RUNNING", at, reason, lifecycle.RUN_TRANSITIONS)
    store.append("universes", store.spark.createDataFrame([(run, seed_url, page_size, None, time.time_ns(), parent, reason)], UNIVERSES))
    plan(store, run, store.spark.createDataFrame([("1", 1, seed_url)], "item string, sequence_no int, url string"), at)


def universe(store: LogStore, run: str) -> dict:
    """What is known of a universe, with its state."""
    rows = last_known(store.read("universes", UNIVERSES).filter(F.col("run") == run), ["run"], F.col("seq")).first()
    if rows is None:
        raise KeyError(f"unknown universe {run}")
    state = lifecycle.states(store.read("run_events", lifecycle.EVENT)).filter(F.col("entity") == run).first()
    return rows.asDict() | {"status": state["status"]}


def _running(store: LogStore, run: str) -> dict:
    known = universe(store, run)
    if known["status"] != "RUNNING":
        raise ValueError(f"universe {run} isn't running")
    return known


def stage_universe(store: LogStore, run: str, at: str) -> int:
    """Stage landed pages after checking them with all staged before; a fault ends the universe, as its pages can't be mixed."""
    known = _running(store, run)
    pages = parsed(landed(store, run), "list").select("run", F.col("item").cast("int").alias("page"), F.col("parsed.total_records").alias("source_reported_total"), "content_sha256", "entity", F.col("parsed.rows.public_id").alias("ids")).persist()
    try:
        total = known["expected_total"]
        if total is None:
            first = pages.filter("page = 1").select("source_reported_total").first()
            if first is None:
                return 0
            total = first[0] or 0
        new = pages.select("run", "page", "source_reported_total", F.explode("ids").alias("id"), "content_sha256")
        members = store.read("universe_members", MEMBERS).filter(F.col("run") == run).unionByName(new)
        heads = pages.select("run", "page", "source_reported_total", F.size("ids").alias("records_parsed"), "content_sha256")
        every = store.read("universe_pages", UNIVERSE_PAGES).filter(F.col("run") == run).unionByName(heads).dropDuplicates(["page"])
        try:
            if total <= 0:
                raise quality.SourceTotalDriftError("page 1 reports no total")
            quality.check_pages(members.dropDuplicates(["page", "id"]), every, total, known["page_size"])
        except quality.SnapshotIntegrityError as e:
            _one(store, "run_events", run, "FAILED", at, str(e), lifecycle.RUN_TRANSITIONS)
            raise
        if known["expected_total"] is None:
            store.append("universes", store.spark.createDataFrame([(run, None, None, total, time.time_ns(), None, None)], UNIVERSES))
            numbers = store.spark.range(2, -(-total // known["page_size"]) + 1).select(F.col("id").cast("string").alias("item"), F.col("id").cast("int").alias("sequence_no"), set_page(F.lit(known["seed_url"]), F.col("id")).alias("url"))
            plan(store, run, numbers, at, extend=True)
        store.append_new("universe_members", new, ["run", "page", "id"])
        store.append_new("universe_pages", heads, ["run", "page"])
        return _record(store, "request_events", pages.select("entity", F.lit("STAGED").alias("status"), F.lit(None).alias("note")), at, lifecycle.TRANSITIONS)
    finally:
        pages.unpersist()


def finalize_universe(store: LogStore, run: str, at: str) -> tuple[str, dict]:
    """COMPLETED if the snapshot is exact, else FAILED; every page has to be resolved."""
    known = _running(store, run)
    if left := status_counts(store, run).get("PLANNED", 0):
        raise ValueError(f"universe {run} has {left} unresolved pages")
    totals = store.read("universe_pages", UNIVERSE_PAGES).filter(F.col("run") == run).select(F.col("page").cast("string").alias("item"), "source_reported_total")
    pages = requests(store, run).select("item", F.col("request_status").alias("status")).join(totals, "item", "left")
    status, figures = lifecycle.finalize_universe(pages, store.read("universe_members", MEMBERS).filter(F.col("run") == run), known["expected_total"])
    _one(store, "run_events", run, status, at, json.dumps(figures, sort_keys=True), lifecycle.RUN_TRANSITIONS)
    return status, figures


def import_universe(store: LogStore, run: str, rows: DataFrame, declared_total: int, at: str, source: str) -> tuple[str, dict]:
    """A universe of one snapshot from a bulk export (id, name): as many rows and distinct positive ids as its source declares, no blank name.

    An export that isn't sound fails before anything is written. Otherwise its members are one page
    and it is finalized like any other universe.
    """
    bad = (F.col("id") <= 0) | F.col("id").isNull() | (F.trim(F.coalesce("name", F.lit(""))) == "")
    n, ids, faulty = rows.agg(F.count("*"), F.countDistinct("id"), F.count_if(bad)).first()
    if faulty or not n == ids == declared_total or declared_total <= 0:
        raise ValueError(f"the export has {n} rows, {ids} ids and {faulty} without id or name; {declared_total} are declared")
    _one(store, "run_events", run, "RUNNING", at, f"bulk export of {source}", lifecycle.RUN_TRANSITIONS)
    store.append("universes", store.spark.createDataFrame([(run, source, declared_total, declared_total, time.time_ns(), None, None)], UNIVERSES))
    digest = F.sha2(F.to_json(F.struct("id", "name"), {"ignoreNullFields": "false"}), 256)
    total = F.lit(declared_total).cast("long")
    store.write("universe_members", rows.select(F.lit(run).alias("run"), F.lit(1).alias("page"), total.alias("source_reported_total"), F.col("id").cast("long").alias("id"), digest.alias("content_sha256")))
    members = store.read("universe_members", MEMBERS).filter(F.col("run") == run)
    page = store.spark.createDataFrame([("1", "STAGED", declared_total)], "item string, status string, source_reported_total long")
    status, figures = lifecycle.finalize_universe(page, members, declared_total)
    _one(store, "run_events", run, status, at, json.dumps(figures, sort_keys=True), lifecycle.RUN_TRANSITIONS)
    return status, figures


def restart_universe(store: LogStore, run: str, new_run: str, at: str, reason: str) -> None:
    """A fresh universe in place of a failed one, which stays as it is and is named as the parent."""
    old = universe(store, run)
    if old["status"] != "FAILED":
        raise ValueError("only a failed universe can be restarted")
    create_universe(store, new_run, old["seed_url"], at, old["page_size"], parent=run, reason=reason)


def run_universe_batch(store: LogStore, fetch: Callable[[str], str], run: str, clock: Callable[[], str], max_pages: int = 50, auto_finalize: bool = True) -> dict:
    """Collect and stage at most ``max_pages`` pages. The next call goes on; failed pages wait until they are requeued."""
    _running(store, run)
    counts = {"attempted": 0, "fetched": 0, "failed": 0}
    while counts["attempted"] < max_pages:
        got = collect(store, fetch, run, clock, max_pages - counts["attempted"])
        counts = {k: counts[k] + got[k] for k in counts}
        # page 1 tells how many pages there are, so more may be planned after it is staged
        if not stage_universe(store, run, clock()) or got["failed"]:
            break
    states = status_counts(store, run)
    if auto_finalize and not states.get("PLANNED") and not states.get("FAILED"):
        finalize_universe(store, run, clock())
    return counts | {"status": universe(store, run)["status"], "pages": states}


# --- external directories -------------------------------------------------------------------------


def register_source(store: LogStore, source: str, policy_status: str | None = None, last_verified_at: str | None = None, notes: str | None = None) -> None:
    """Add to what is known of a source; what is null keeps its earlier value."""
    store.append("source_profiles", store.spark.createDataFrame([(source.upper(), policy_status, last_verified_at, notes, time.time_ns())], PROFILES))


def source_profiles(store: LogStore) -> DataFrame:
    return last_known(store.read("source_profiles", PROFILES), ["source"], F.col("seq")).drop("seq")


def plan_targets(store: LogStore, label: str, source: str, at: str) -> dict[str, int]:
    """The label's sample as targets of a source. STAGED and REVIEWED targets keep their state."""
    source = source.upper()
    rows = sample(store, label)
    if rows.isEmpty():
        raise ValueError(f"no sample {label}")
    ok = matching.eligible(F.lit(source), F.col("sector_family"))
    old = targets(store, label, source).filter(F.col("status").isin("STAGED", "REVIEWED")).select("target_id", F.col("status").alias("sticky"))
    made = rows.select(F.lit(label).alias("label"), F.lit(source).alias("source"), F.col("id").alias("target_id"), ok.alias("eligible")).join(old, "target_id", "left")
    status = F.coalesce("sticky", F.when(F.col("eligible"), "PENDING").otherwise("OUT_OF_SCOPE"))
    store.append("enrichment_targets", made.select("label", "source", "target_id", "eligible", status.alias("status"), F.lit(at).cast("timestamp").alias("planned_at"), F.lit(time.time_ns()).alias("seq")))
    n, out = targets(store, label, source).agg(F.count_if("eligible"), F.count_if(~F.col("eligible"))).first()
    return {"eligible": n, "out_of_scope": out}


def targets(store: LogStore, label: str, source: str) -> DataFrame:
    rows = store.read("enrichment_targets", TARGETS).filter((F.col("label") == label) & (F.col("source") == source.upper()))
    return latest_by(rows, ["target_id"], [F.desc("seq")])


def stage_external(store: LogStore, run: str, source: str, at: str) -> int:
    """Versions of records by content, their typed facts by fingerprint. Pages without a key or a name become FAILED."""
    pages = parsed(landed(store, run), "external", source=source).select("entity", "url", "retrieved_at", "content_sha256", "parsed").persist()
    try:
        p = F.col("parsed")
        made = pages.filter(p["error"].isNull()).select(
            F.concat_ws(":", p["source_name"], p["external_key"]).alias("record_id"), p["source_name"].alias("source"), p["external_key"].alias("external_key"), "url",
            *[p[c].alias(c) for c in ("entity_name", "site_text", "district", "upazila", "source_updated_at_raw", "source_fields")], F.col("retrieved_at").alias("observed_at"), "content_sha256",
        )
        store.append_new("external_versions", made, ["record_id", "content_sha256"])
        version = made.select("record_id", "content_sha256", "observed_at").dropDuplicates(["record_id", "content_sha256"])
        facts = evidence.typed_observations(made).join(version, "record_id")
        digest = F.sha2(F.to_json(F.struct("observation_type", "scope", "unit", "value_numeric", "value_text"), {"ignoreNullFields": "false"}), 256)
        store.append_new("external_facts", facts.withColumn("observation_sha256", digest), ["record_id", "content_sha256", "observation_sha256"])
        events = pages.select("entity", F.when(p["error"].isNull(), "PARSED").otherwise("FAILED").alias("status"), p["error"].alias("note"))
        return _record(store, "request_events", events, at, lifecycle.TRANSITIONS)
    finally:
        pages.unpersist()


def external_records(store: LogStore, source: str) -> DataFrame:
    """The latest version of each record of a source."""
    rows = store.read("external_versions", VERSIONS).filter(F.col("source") == source.upper())
    return latest_by(rows, ["record_id"], [F.desc("observed_at"), F.desc("content_sha256")])


def run_enrichment(store: LogStore, fetch: Callable[[str], str], run: str, source: str, asked: DataFrame, clock: Callable[[], str], limit: int | None = None, k: int = 5) -> dict:
    """Fetch planned profiles; once none is left, resolve ``asked`` (as in matching.candidate_run) and link what is certain.

    Failed profiles never become a negative fact: their targets end as REVIEW_REQUIRED or NO_STAGED_CANDIDATE.
    """
    counts = collect(store, fetch, run, clock, limit)
    stage_external(store, run, source, clock())
    states = status_counts(store, run)
    if states.get("PLANNED"):
        return counts | {"requests": states, "outcomes": {}, "links": 0}
    records = external_records(store, source).select("record_id", "source", "external_key", F.col("entity_name").alias("name"), F.col("site_text").alias("address"), "district", "upazila")
    short, outcomes = matching.candidate_run(asked.filter(matching.eligible(F.lit(source.upper()), F.col("sector_family"))), records, k)
    found = matching.apply_resolutions(outcomes, short, store.read("entity_links", LINKS)).withColumn("linked_at", F.lit(clock()).cast("timestamp"))
    n = store.append_new("entity_links", found, ["target_id", "record_id"])
    return counts | {"requests": states, "outcomes": {r[0]: r[1] for r in outcomes.groupBy("outcome").count().collect()}, "links": n}


EVIDENCE = "target_id long, record_id string, evidence_type string, register_value string, external_value string, result string, linked_at timestamp"
ATTACHED = "target_id long, record_id string, observation_type string, scope string, value_text string, value_numeric double, unit string, site_attributable boolean, linked_at timestamp"


def store_resolution(store: LogStore, made: DataFrame, typed: DataFrame, at: str) -> dict[str, int]:
    """Store what an audited run selected: the links, five rows of evidence for each, and the typed facts of the linked records.

    ``typed`` has record_id, observation_type, scope, value_text, value_numeric, unit. What is stored
    already stays as it is, so repeating it adds nothing. Returns the rows added of each kind.
    """
    pairs = matching.selected_pairs(made).withColumn("record_id", F.col("record_id").cast("string"))
    when = F.lit(at).cast("timestamp").alias("linked_at")
    known = store.read("entity_links", LINKS).select("target_id", "record_id")
    links = pairs.select("target_id", "record_id", "source", "match_type", "site_level_match", when).join(known, ["target_id", "record_id"], "left_anti")
    n = store.append_new("entity_links", links, ["target_id", "record_id"])
    rows = matching.evidence_rows(pairs).select("target_id", "record_id", "evidence_type", "register_value", "external_value", "result", when)
    evidence_added = store.append_new("link_evidence", rows, ["target_id", "record_id", "evidence_type"])
    facts = typed.select(F.col("record_id").cast("string").alias("record_id"), "observation_type", "scope", "value_text", "value_numeric", "unit")
    attached = matching.attach_observations(pairs.select("target_id", "record_id", "match_type", "site_level_match"), facts)
    attached = attached.select("target_id", "record_id", "observation_type", "scope", "value_text", "value_numeric", "unit", "site_attributable", when)
    keys = ["target_id", "record_id", "observation_type", "scope", "value_text", "value_numeric", "unit"]
    return {"links": n, "evidence": evidence_added, "attachments": store.append_new("link_attachments", _keyed(attached, keys), ["fact_sha256"])}


def _keyed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a digest of ``keys``, among which nulls are equal."""
    return rows.withColumn("fact_sha256", F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256))


def linked_facts(store: LogStore) -> DataFrame:
    """Typed facts of the latest version of each record, by the latest link of a target and source."""
    links = latest_by(store.read("entity_links", LINKS), ["target_id", "source"], [F.desc("linked_at"), F.desc("record_id")])
    latest = latest_by(store.read("external_versions", VERSIONS), ["record_id"], [F.desc("observed_at"), F.desc("content_sha256")]).select("record_id", "content_sha256")
    return matching.attach_observations(links, store.read("external_facts", TYPED).join(latest, ["record_id", "content_sha256"]).drop("source"))


# --- indexes of external directories ---------------------------------------------------------------


def create_index(store: LogStore, run: str, source: str, parser: str, seed_url: str, at: str) -> None:
    """A RUNNING index of a source's directory whose first page is planned."""
    source = source.upper()
    if parser not in INDEX_PARSERS.get(source, ()):
        raise ValueError(f"{source} has no directory that {parser} reads")
    _one(store, "run_events", run, "RUNNING", at, None, lifecycle.RUN_TRANSITIONS)
    store.append("indexes", store.spark.createDataFrame([(run, source, parser, seed_url, time.time_ns())], INDEXES))
    plan(store, run, store.spark.createDataFrame([("1", 1, seed_url)], "item string, sequence_no int, url string"), at)


def index(store: LogStore, run: str) -> dict:
    """What is known of an index, with its state."""
    row = store.read("indexes", INDEXES).filter(F.col("run") == run).first()
    if row is None:
        raise KeyError(f"unknown index {run}")
    return row.asDict() | {"status": lifecycle.states(store.read("run_events", lifecycle.EVENT)).filter(F.col("entity") == run).first()["status"]}


def stage_index(store: LogStore, run: str, at: str) -> int:
    """Stage landed pages: a version per row of a page. The first page, if it tells how many there are, plans the others."""
    known = index(store, run)
    if known["status"] != "RUNNING":
        raise ValueError(f"index {run} isn't running")
    pages = parsed(landed(store, run), known["parser"]).select("run", F.col("item").cast("int").alias("page"), "entity", "retrieved_at", "content_sha256", "parsed").persist()
    try:
        p = F.col("parsed")
        heads = pages.select("run", "page", p["total_records"].alias("source_reported_total"), p["last_page"].alias("source_reported_last_page"), F.size(p["rows"]).alias("records_parsed"), "content_sha256")
        if (first := heads.filter("page = 1").first()) and (first["source_reported_last_page"] or 0) > 1:
            numbers = store.spark.range(2, first["source_reported_last_page"] + 1)
            plan(store, run, numbers.select(F.col("id").cast("string").alias("item"), F.col("id").cast("int").alias("sequence_no"), set_page(F.lit(known["seed_url"]), F.col("id")).alias("url")), at, extend=True)
        rows = pages.select("run", "page", F.lit(known["source"]).alias("source"), F.explode(p["rows"]).alias("r"), F.col("retrieved_at").alias("observed_at"))
        made = rows.select("run", "page", "source", "r.*", F.sha2(F.to_json("r", {"ignoreNullFields": "false"}), 256).alias("row_sha256"), "observed_at")
        store.append_new("index_versions", made, ["run", "page", "source_key", "row_sha256"])
        store.append_new("index_pages", heads, ["run", "page"])
        return _record(store, "request_events", pages.select("entity", F.lit("STAGED").alias("status"), F.lit(None).alias("note")), at, lifecycle.TRANSITIONS)
    finally:
        pages.unpersist()


def index_counts(store: LogStore, run: str) -> dict:
    """Pages, discovered records and distinct keys of an index, derived when asked."""
    records, keys = store.read("index_versions", INDEX_VERSIONS).filter(F.col("run") == run).agg(F.count("*"), F.countDistinct("source_key")).first()
    return {"pages": status_counts(store, run), "records_discovered": records, "unique_keys": keys}


def finalize_index(store: LogStore, run: str, at: str) -> tuple[str, dict]:
    """COMPLETED if its records are sound and no page failed, else FAILED; every page has to be resolved."""
    known, states = index(store, run), status_counts(store, run)
    if known["status"] != "RUNNING":
        raise ValueError(f"index {run} isn't running")
    if left := states.get("PLANNED", 0):
        raise ValueError(f"index {run} has {left} unresolved pages")
    versions = store.read("index_versions", INDEX_VERSIONS).filter(F.col("run") == run)
    status, figures = lifecycle.finalize_index(versions, INDEX_SEGMENTS[known["source"]], sum(states.values()), states.get("STAGED", 0))
    figures |= {"page_status_counts": states}
    _one(store, "run_events", run, status, at, json.dumps(figures, sort_keys=True), lifecycle.RUN_TRANSITIONS)
    return status, figures


def index_records(store: LogStore, run: str) -> DataFrame:
    """The latest version of each record of a run."""
    return latest_by(store.read("index_versions", INDEX_VERSIONS).filter(F.col("run") == run), ["source_key"], [F.desc("observed_at"), F.desc("page"), F.desc("row_sha256")])


def plan_candidates(store: LogStore, run: str, index_run: str, asked: DataFrame, at: str) -> int:
    """Plan the profiles of a completed index whose name blocks with one of ``asked`` (target_id, name); one request per profile."""
    if index(store, index_run)["status"] != "COMPLETED":
        raise ValueError(f"index {index_run} isn't complete")
    records = index_records(store, index_run).withColumn("record_id", F.col("source_key"))
    pairs = matching.block_pairs(asked, records, "target_id", "name", "record_id", "entity_name")
    found, targets_of = matching.detail_requests(pairs, records)
    store.append_new("request_targets", targets_of.select(F.lit(run).alias("run"), F.col("source_key").alias("item"), "target_id"), ["run", "item", "target_id"])
    ordered = matching.request_order(found)
    return plan(store, run, ordered.select(F.col("source_key").alias("item"), "sequence_no", F.col("detail_url").alias("url")), at)


# --- spatial exposure -----------------------------------------------------------------------------


def ingest_exposures(store: LogStore, observations: DataFrame) -> int:
    """Add sound observations once each; an unsound one fails the whole batch before anything is written."""
    if bad := observations.select(exposure.faults(observations.withColumn("direction", F.coalesce("direction", F.lit("CONTEXT_ONLY")))).alias("fault")).filter("fault is not null").first():
        raise ValueError(f"exposure observation: {bad[0]}")
    return store.append_new("exposures", exposure.fingerprinted(exposure.validated(observations)), ["observation_sha256"])


_UNIT = ("level", "division_code", "division_name_en", "division_name_bn", "district_code", "district_name_en", "district_name_bn", "upazila_code", "upazila_name_en", "upazila_name_bn", "source_name", "source_vintage")
UNITS = f"geo_ref string, {', '.join(f'{c} string' for c in _UNIT)}, seq long"
ALIASES = "level string, alias string, key string, geo_ref string, source_name string, note string"
EXPOSURE_SOURCES = "source_name string, authority string, methodology_note string, source_reference string, imported_at timestamp, seq long"


def store_units(store: LogStore, units: DataFrame, aliases: DataFrame | None = None) -> dict[str, int]:
    """Add administrative units, the newest state of a reference counts; aliases (level, alias, geo_ref, source_name, note) that are known are left as they are."""
    if units.isEmpty():
        raise ValueError("there are no units to store")
    rows = units.select("geo_ref", *[F.col(c) if c in units.columns else F.lit(None).cast("string").alias(c) for c in _UNIT])
    n = store.append("geography_units", rows.withColumn("seq", F.lit(time.time_ns())))
    if aliases is None:
        return {"units": n, "aliases": 0}
    keyed = aliases.select("level", "alias", admin_name(F.col("alias")).alias("key"), "geo_ref", "source_name", "note")
    return {"units": n, "aliases": store.append_new("geography_aliases", keyed, ["level", "key", "geo_ref"])}


def stored_units(store: LogStore) -> tuple[DataFrame, DataFrame]:
    """(units, aliases) for ``exposure.resolve_places``; fails if none were stored."""
    units = store.read("geography_units", UNITS)
    if units.isEmpty():
        raise ValueError("no administrative units are stored")
    return latest_by(units, ["geo_ref"], [F.desc("seq")]).drop("seq"), store.read("geography_aliases", ALIASES)


def register_exposure_source(store: LogStore, source_name: str, authority: str, methodology_note: str, at: str, source_reference: str | None = None) -> None:
    """Where a source's exposure facts come from; a later registration takes the place of an earlier one."""
    given = {"source_name": source_name, "authority": authority, "methodology_note": methodology_note}
    if lacking := [k for k, v in given.items() if not v.strip()]:
        raise ValueError(f"{lacking[0]} is required")
    row = store.spark.createDataFrame([(*(v.strip() for v in given.values()), source_reference)], "source_name string, authority string, methodology_note string, source_reference string")
    store.append("exposure_sources", row.select("*", F.lit(at).cast("timestamp").alias("imported_at"), F.lit(time.time_ns()).alias("seq")))


def exposure_sources(store: LogStore) -> DataFrame:
    return latest_by(store.read("exposure_sources", EXPOSURE_SOURCES), ["source_name"], [F.desc("seq")]).drop("seq")


#: What products may show of a stored exposure fact, in the order of the columns.
EXPOSURE_FACT = (
    "source", "domain", "metric_code", "metric_label", "spatial_scope", "establishment_ref", "district", "upazila", "value_text", "value_numeric", "unit", "direction", "source_vintage", "observed_at", "evidence_note",
    "canonical_geo_ref", "geography_match_type", "source_geography_label",
)


def exposure_facts(store: LogStore) -> DataFrame:
    """The stored exposure facts in order, without columns of the store's own."""
    rows = store.spark.read.parquet(store.path("exposures"))
    return rows.select(*EXPOSURE_FACT).orderBy("source", "domain", "metric_code", "spatial_scope", "district", "upazila", "establishment_ref")


def import_risk(store: LogStore, records: DataFrame, units: DataFrame, source: str, vintage: str | None, observed_at: str) -> tuple[dict[str, int], DataFrame]:
    """Stage district risk records (division, district and the metrics), each fact once.

    Returns counts of records, unresolved districts, sound observations and new ones, all from the
    job that writes, and the districts that can't be placed (they aren't guessed).
    """
    audit = Audit()
    good, bad = exposure.risk_observations(records, units, exposure.risk_aliases(units), source, vintage, observed_at, audit)
    lacking = [F.lit(None).cast(t).alias(c) for c, t in (("establishment_ref", "string"), ("upazila", "string"), ("value_numeric", "double"), ("unit", "string"), ("evidence_note", "string")) if c not in good.columns]
    rows = audit.on(exposure.fingerprinted(exposure.validated(good.select("*", *lacking))), observations=F.count("*"))
    known = store.spark.read.parquet(store.path("exposures")) if store.exists("exposures") else rows.limit(0)
    new = audit.on(append_new(known, rows, ["observation_sha256"]), inserted=F.count("*"))
    new.write.mode("append").parquet(store.path("exposures"))
    counts = audit.counts()
    if counts["records"] is None:  # without a unit or a record there was nothing to write
        counts |= {"records": records.count(), "unresolved": bad.count()}
    return {name: n or 0 for name, n in counts.items()}, bad


def ingest_risk_page(store: LogStore, page: DataFrame, units: DataFrame, source: str, vintage: str | None, observed_at: str) -> dict:
    """Stage a district risk table (one row: html, url)."""
    made = parsed(page, "risk").select("parsed")
    if error := made.select("parsed.error").first()[0]:
        raise ValueError(f"risk table: {error}")
    counts, bad = import_risk(store, made.select(F.explode("parsed.rows").alias("r")).select("r.*"), units, source, vintage, observed_at)
    return {"records": counts["records"], "inserted": counts["inserted"], "unresolved": [tuple(r) for r in bad.orderBy("division", "district").collect()]}  # rows of one page
