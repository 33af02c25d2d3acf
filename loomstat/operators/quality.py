"""Gates: universe, page, index and detail quality, and the checks of private fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import company_core, same_text, url_key
from ..vocab import CHECKPOINT_RATES, PRIVATE_NATIONAL_KEYS, PRIVATE_PRODUCT_KEYS
from .versioning import latest_by


class SnapshotIntegrityError(ValueError):
    """A snapshot is not an exact picture of its source."""


class SourceTotalDriftError(SnapshotIntegrityError):
    """The source reports another total than at the start."""


class DuplicatePublicIdError(SnapshotIntegrityError):
    """A public id stands on more than one page."""


class PageCardinalityError(SnapshotIntegrityError):
    """A page has another number of records than its place implies."""


def universe_quality(pages: DataFrame, members: DataFrame, expected_total: int | None) -> DataFrame:
    """One row: page states, totals, membership, and whether the universe may be analysed."""
    p = pages.agg(
        F.count("*").alias("pages"), F.count_if(F.col("status") == "STAGED").alias("staged"), F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.count_if(F.col("status") == "SKIPPED").alias("skipped"), F.min("source_reported_total").alias("least_total"), F.max("source_reported_total").alias("most_total"),
    )
    m = members.agg(F.count("id").alias("membership_rows"), F.countDistinct("id").alias("unique_ids"))
    total = F.lit(expected_total).cast("long")
    whole = (F.col("staged") == F.col("pages")) & (F.col("failed") + F.col("skipped") == 0) & (F.col("membership_rows") == F.col("unique_ids")) & (F.col("unique_ids") == total) & (total > 0)
    made = p.crossJoin(m)  # one row each
    return made.withColumns({
        "duplicate_ids": F.col("membership_rows") - F.col("unique_ids"), "stable_total": F.coalesce((F.col("least_total") == F.col("most_total")) & (F.col("least_total") == total), F.lit(False)),
    }).withColumn("eligible", F.coalesce(whole & F.col("stable_total"), F.lit(False)))


def page_faults(members: DataFrame, pages: DataFrame, expected_total: int, page_size: int) -> DataFrame:
    """Pages with a fault: total drift, wrong cardinality, repeats inside the page, ids known from an earlier page."""
    # one row per page and id first; what is counted after that has no repeats, so nothing is made distinct again
    each = members.groupBy("page", "id").agg(F.count("*").alias("n"))
    first = each.filter("id is not null").groupBy("id").agg(F.min("page").alias("first_page"))
    known = each.join(first, "id", "left")
    counted = known.groupBy("page").agg(F.sum("n").alias("records"), F.count("id").alias("ids"), F.count_if(F.col("page") > F.col("first_page")).alias("known_ids"))
    made = pages.join(counted, "page", "left").fillna(0, ["records", "ids", "known_ids"])
    due = F.greatest(F.lit(0), F.least(F.lit(page_size), F.lit(expected_total) - (F.col("page") - 1) * page_size))
    fault = F.when(~F.col("source_reported_total").eqNullSafe(F.lit(expected_total)), "TOTAL_DRIFT").when(F.col("records") != due, "CARDINALITY").when((F.col("ids") < F.col("records")) | (F.col("known_ids") > 0), "DUPLICATE_ID")
    return made.withColumn("fault", fault).filter("fault is not null").select("page", "records", "ids", "known_ids", "fault")


def check_pages(members: DataFrame, pages: DataFrame, expected_total: int, page_size: int) -> None:
    """Raise the error of the first faulty page."""
    found = page_faults(members, pages, expected_total, page_size).orderBy("page").first()
    if found:
        kind = {"TOTAL_DRIFT": SourceTotalDriftError, "CARDINALITY": PageCardinalityError, "DUPLICATE_ID": DuplicatePublicIdError}[found["fault"]]
        raise kind(f"page {found['page']}: {found['records']} records, {found['ids']} ids")


def index_quality(records: DataFrame, segment: str) -> DataFrame:
    """One row on a source index: keys, names, URLs that name another key, distinct company cores."""
    made = records.agg(
        F.count("*").alias("records"), (F.count("*") - F.countDistinct("source_key")).alias("duplicate_keys"), F.count_if(F.coalesce(F.trim("entity_name"), F.lit("")) == "").alias("missing_names"),
        F.count_if(~F.coalesce(url_key(F.col("detail_url"), segment).eqNullSafe(F.col("source_key")), F.lit(False))).alias("invalid_detail_urls"),
        F.countDistinct(F.nullif(company_core(F.col("entity_name")), F.lit(""))).alias("distinct_company_cores"),
    )
    return made.withColumn("valid", (F.col("records") > 0) & (F.col("duplicate_keys") + F.col("missing_names") + F.col("invalid_detail_urls") == 0))


def assess_detail(rows: DataFrame) -> DataFrame:
    """Parser validity (two anchors of five) and core completeness (all of six) of detail records."""

    def there(*columns: str):
        made = F.lit(False)
        for c in columns:
            made = made | (F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "")
        return made

    identity, regulatory = there("name_en", "name_bn"), there("licence_no", "registration_no")
    anchors = [identity, regulatory, there("address", "upazila", "district", "division"), there("sector", "establishment_type", "licence_class"), there("status")]
    core = [identity, there("sector"), there("status"), there("district"), there("establishment_type"), regulatory]
    n = sum((a.cast("int") for a in anchors), F.lit(0))
    return rows.withColumns({"anchors": n, "parser_valid": n >= 2, "core_complete": sum((c.cast("int") for c in core), F.lit(0)) == len(core)})


def checkpoint_metrics(rows: DataFrame) -> DataFrame:
    """Counts and the five rates that a checkpoint is judged by. rows: status, parser_valid, core_complete, has_provenance, url_ok."""
    parsed = F.count_if(F.col("status") == "PARSED")
    made = rows.agg(
        F.count("*").alias("planned"), parsed.alias("parsed"), F.count_if(F.col("status") == "FAILED").alias("failed"), F.count_if(~F.col("status").isin("PARSED", "FAILED")).alias("unresolved"),
        *[F.count_if((F.col("status") == "PARSED") & F.coalesce(F.col(c), F.lit(False))).alias(c) for c in ("parser_valid", "core_complete", "has_provenance", "url_ok")],
    )
    rate = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return made.withColumns({"retrieval_rate": rate("parsed", "planned"), "parser_rate": rate("parser_valid", "parsed"), "provenance_rate": rate("has_provenance", "parsed"), "url_rate": rate("url_ok", "parsed"), "core_rate": rate("core_complete", "parsed")})


#: Fields whose share among parsed details a checkpoint reports: name of the rate, column.
COVERAGE_FIELDS = (
    ("employment", "worker_total"), ("expiry", "licence_expiry_raw"), ("licence", "licence_no"), ("registration", "registration_no"),
    ("district", "district"), ("sector", "sector"), ("status", "detail_status"), ("establishment_type", "establishment_type"),
)


def field_coverage(rows: DataFrame) -> DataFrame:
    """One row: the share of PARSED rows in which each field isn't blank, 0 without such rows."""
    parsed = F.col("status") == "PARSED"
    filled = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != ""
    return rows.agg(*[F.coalesce(F.try_divide(F.count_if(parsed & filled(c)), F.count_if(parsed)), F.lit(0.0)).alias(f"{name}_coverage_rate") for name, c in COVERAGE_FIELDS])


def judge_checkpoint(metrics: dict, checkpoint: int, least: dict[str, float] = CHECKPOINT_RATES) -> tuple[bool, list[str]]:
    """Whether a checkpoint passes, and what speaks against it."""
    reasons = []
    if metrics["planned"] != checkpoint:
        reasons.append(f"planned {metrics['planned']} of {checkpoint}")
    if metrics["unresolved"]:
        reasons.append(f"{metrics['unresolved']} unresolved")
    reasons += [f"{k} rate {metrics[f'{k}_rate']:.4f} under {v}" for k, v in least.items() if metrics[f"{k}_rate"] < v]
    return not reasons, reasons


SEVERITY = {"CRITICAL": 0, "HIGH": 1, "MEDIUM": 2, "INFO": 3}


def anomalies(rows: DataFrame) -> DataFrame:
    """Typed differences between listing and detail, a row each, with severity.

    A failed or unresolved request has that one anomaly only.
    """
    parsed = F.col("request_status") == "PARSED"

    def differs(a, b):
        return parsed & (F.trim(F.coalesce(a, F.lit(""))) != "") & (F.trim(F.coalesce(b, F.lit(""))) != "") & ~same_text(a, b)

    c, detail_name = F.col, F.coalesce(F.nullif(F.col("detail_name_en"), F.lit("")), F.col("detail_name_bn"))
    rules = [
        ("RETRIEVAL_FAILURE", "CRITICAL", c("request_status") == "FAILED"), ("UNRESOLVED_REQUEST", "CRITICAL", ~c("request_status").isin("PARSED", "FAILED")),
        ("PARSER_INVALID", "CRITICAL", parsed & c("parser_valid").eqNullSafe(F.lit(False))), ("DISTRICT_MISMATCH", "HIGH", differs(c("list_district"), c("detail_district"))),
        ("STATUS_MISMATCH", "HIGH", differs(c("list_status"), c("detail_status"))), ("SECTOR_MISMATCH", "HIGH", differs(c("list_sector"), c("detail_sector"))),
        ("CLASS_MISMATCH", "MEDIUM", differs(c("list_class"), c("detail_class"))), ("NAME_VARIATION", "INFO", differs(c("list_name"), detail_name)),
        ("CORE_FIELDS_INCOMPLETE", "MEDIUM", parsed & c("core_complete").eqNullSafe(F.lit(False))),
    ]
    found = F.filter(F.array(*[F.when(when, F.struct(F.lit(kind).alias("anomaly_type"), F.lit(severity).alias("severity"))) for kind, severity, when in rules]), lambda x: x.isNotNull())
    return rows.select("public_id", F.explode(found).alias("a")).select("public_id", "a.*")


#: What a comparison takes from the latest listing and the latest detail of an establishment.
LISTED = ("name", "sector", "district", "status", "class")
DETAILED = ("name_en", "name_bn", "sector", "district", "status", "class")


def comparisons(requests: DataFrame, sample: DataFrame, listed: DataFrame, details: DataFrame, newest: tuple[str, ...] = ("observed_at", "observation_id")) -> DataFrame:
    """Requests of a sample beside the latest listing and the latest detail of their establishment, for ``anomalies``.

    requests: id, sequence_no, request_status; sample: id, sector_family, geography_group; listed and
    details: id, what orders them (``newest``) and any of LISTED, DETAILED. Observations that were
    never made leave nulls; a request outside the sample is left out.
    """
    order = [F.desc(c) for c in newest]
    both = requests.join(sample.select("id", "sector_family", "geography_group"), "id")
    for rows, prefix, columns in ((listed, "list_", LISTED), (details, "detail_", DETAILED)):
        there = [c for c in columns if c in rows.columns]
        more = [c for c in ("parser_valid", "core_complete") if prefix == "detail_" and c in rows.columns]
        latest = latest_by(rows.select("id", *newest, *there, *more), ["id"], order)
        both = both.join(latest.select("id", *[F.col(c).alias(prefix + c) for c in there], *more), "id", "left")
        both = both.withColumns({prefix + c: F.lit(None).cast("string") for c in columns if c not in there})
    lacking = {c: F.lit(None).cast("boolean") for c in ("parser_valid", "core_complete") if c not in both.columns}
    return (both.withColumns(lacking) if lacking else both).withColumnRenamed("id", "public_id")


def severity_order():
    made = F.lit(len(SEVERITY))
    for name, k in SEVERITY.items():
        made = F.when(F.col("severity") == name, k).otherwise(made)
    return made


def breakdown(rows: DataFrame, found: DataFrame, by: str) -> DataFrame:
    """Per group: records, parsed, with an anomaly, with a critical one."""
    flags = found.groupBy("public_id").agg(F.count("*").alias("n"), F.count_if(F.col("severity") == "CRITICAL").alias("critical"))
    joined = rows.join(flags, "public_id", "left")
    return joined.groupBy(by).agg(F.count("*").alias("records"), F.count_if(F.col("request_status") == "PARSED").alias("parsed"), F.count_if(F.col("n") > 0).alias("with_anomaly"), F.count_if(F.col("critical") > 0).alias("with_critical"))


def private_fields(schema: T.DataType, product: bool, path: str = "$") -> list[str]:
    """Paths of fields that a payload must not have. Products may carry public_id; national payloads no *_id at all."""
    found = []
    if isinstance(schema, T.StructType):
        for f in schema.fields:
            at = f"{path}.{f.name}"
            if f.name in (PRIVATE_PRODUCT_KEYS if product else PRIVATE_NATIONAL_KEYS) or (f.name.endswith("_id") and not (product and f.name == "public_id")):
                found.append(at)
            found += private_fields(f.dataType, product, at)
    elif isinstance(schema, T.ArrayType):
        found += private_fields(schema.elementType, product, f"{path}[]")
    elif isinstance(schema, T.MapType):
        found += private_fields(schema.valueType, product, f"{path}{{}}")
    return found


def assert_safe(df: DataFrame, product: bool = False) -> DataFrame:
    """``df``, if its schema has no private field. Keys of maps are checked per row where there are maps."""
    if found := private_fields(df.schema, product):
        raise ValueError("private fields: " + ", ".join(found))
    return df
