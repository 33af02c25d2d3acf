"""Runs, requests and audit trails as append-only events; states are derived, transitions are checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import quality
from .versioning import latest_by

#: From which states a request may go to which.
TRANSITIONS = {
    None: ("PLANNED",), "PLANNED": ("STAGED", "PARSED", "FETCHED", "FAILED", "SKIPPED"), "FAILED": ("PLANNED",), "STAGED": (), "PARSED": (), "FETCHED": ("PARSED", "FAILED"), "SKIPPED": ("PLANNED",),
}
RUN_TRANSITIONS = {None: ("RUNNING",), "RUNNING": ("COMPLETED", "FAILED"), "COMPLETED": (), "FAILED": ()}
EVENT = "entity string, status string, at timestamp, seq long, note string"


def states(events: DataFrame) -> DataFrame:
    """The last event of each entity."""
    return latest_by(events, ["entity"], [F.desc("at"), F.desc("seq")])


def transitions(events: DataFrame, requested: DataFrame, allowed: dict = TRANSITIONS) -> tuple[DataFrame, DataFrame]:
    """(accepted, refused) of requested events: accepted are those that the entity's state allows."""
    rules = F.create_map(*[x for a, bs in allowed.items() for x in (F.lit(a or ""), F.array(*[F.lit(b) for b in bs]).cast("array<string>"))])
    now = states(events).select("entity", F.col("status").alias("state"))
    # one request per entity and batch: the first
    first = latest_by(requested, ["entity"], [F.asc("at"), F.asc("seq")])
    judged = first.join(now, "entity", "left").withColumn("ok", F.coalesce(F.array_contains(rules[F.coalesce("state", F.lit(""))], F.col("status")), F.lit(False)))
    return judged.filter("ok").drop("ok", "state"), judged.filter("not ok").drop("ok")


def due(events: DataFrame, manifest: DataFrame, states_due: tuple[str, ...] = ("PLANNED",), limit: int | None = None) -> DataFrame:
    """Requests of a manifest (entity, sequence_no) that are in one of the states, in order, at most ``limit``."""
    made = manifest.join(states(events).select("entity", "status"), "entity").filter(F.col("status").isin(*states_due)).orderBy("sequence_no", "entity")
    return made if limit is None else made.limit(limit)


def attempts(events: DataFrame) -> DataFrame:
    """Per entity: attempts, failures and the last state."""
    last = F.max_by("status", F.struct("at", "seq"))
    return events.groupBy("entity").agg(F.count_if(F.col("status") != "PLANNED").alias("attempts"), F.count_if(F.col("status") == "FAILED").alias("failures"), last.alias("status"))


def finalize_universe(pages: DataFrame, members: DataFrame, expected_total: int | None) -> tuple[str, dict]:
    """COMPLETED for an exact snapshot, else FAILED, with the quality figures (one row)."""
    figures = quality.universe_quality(pages, members, expected_total).first().asDict()
    return ("COMPLETED" if figures["eligible"] else "FAILED"), figures


def finalize_index(records: DataFrame, segment: str, planned_pages: int, staged_pages: int) -> tuple[str, dict]:
    figures = quality.index_quality(records, segment).first().asDict()
    return ("COMPLETED" if figures["valid"] and planned_pages == staged_pages else "FAILED"), figures


def progressive_validation(stage, checkpoints: tuple[int, ...]) -> list[dict]:
    """Checkpoint by checkpoint until one fails. ``stage(n)`` collects what n needs and returns its metrics."""
    out = []
    for n in checkpoints:
        metrics = stage(n)
        ok, reasons = quality.judge_checkpoint(metrics, n)
        out.append({"checkpoint": n, "passed": ok, "reasons": reasons, **metrics})
        if not ok:
            break
    return out


def audit_consistent(runs: DataFrame) -> DataFrame:
    """Runs whose counts don't add up: attempted is staged plus failed, within the plan, and they end after they began."""
    return runs.filter((F.col("attempted") != F.col("staged") + F.col("failed")) | (F.col("attempted") > F.col("planned")) | (F.least("attempted", "staged", "failed") < 0) | (F.col("finished_at") < F.col("started_at")))
