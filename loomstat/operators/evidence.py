"""Typed observations and what is computed from evidence: freshness, breadth, consistency, change, context, product payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import capacity_unit, clean, employment_band, normalize_text, parse_instant, parse_number, product_codes, rounded, split_list
from ..vocab import APPROVED_TYPES, CHANGE_TYPES, EXPORT_TYPES, OBSERVATION_RULES, PRESENCE_TYPES
from .quality import assert_safe


def field(fields: Column, labels: tuple[str, ...]) -> Column:
    """(label, value) of the first entry of a map whose label is one of ``labels``."""
    wanted = [" ".join("".join(ch if ch.isalnum() or ch == "_" else " " for ch in x.lower()).split()) for x in labels]
    entries = F.filter(F.map_entries(fields), lambda e: normalize_text(e["key"]).isin(*wanted) & clean(e["value"]).isNotNull())
    return F.try_element_at(entries, F.lit(1))


def typed_observations(records: DataFrame, legacy_scale: bool = False) -> DataFrame:
    """Observations of external records (record_id, source, source_fields map), by the rules of their source."""
    observation = "struct<observation_type:string,scope:string,value_text:string,value_numeric:double,unit:string>"

    def one(kind: str, scope: str, text: Column, number: Column | None = None, unit: Column | None = None) -> Column:
        return F.struct(F.lit(kind).alias("observation_type"), F.lit(scope).alias("scope"), text.alias("value_text"), (F.lit(None) if number is None else number).cast("double").alias("value_numeric"), (F.lit(None) if unit is None else unit).cast("string").alias("unit"))

    by_source = F.lit(None).cast(f"array<{observation}>")
    for source, rules in OBSERVATION_RULES.items():
        found = [F.array(one(PRESENCE_TYPES[source], "ORGANIZATION", F.lit("present")))]
        for labels, kind, scope, form in rules:
            value = clean(field(F.col("source_fields"), labels)["value"])
            if form in ("list", "codes"):
                parts = (split_list if form == "list" else product_codes)(value)
                found.append(_each(parts, kind, scope, one))
            else:
                number = parse_number(value, legacy_scale) if form in ("number", "capacity") else None
                found.append(F.when(value.isNotNull(), F.array(one(kind, scope, value, number, capacity_unit(value, legacy_scale) if form == "capacity" else None))).otherwise(F.array().cast(f"array<{observation}>")))
        by_source = F.when(F.upper("source") == source, F.concat(*found)).otherwise(by_source)
    return records.select("record_id", "source", F.explode(by_source).alias("o")).select("record_id", "source", "o.*")


def _each(parts: Column, kind: str, scope: str, one) -> Column:
    return F.transform(parts, lambda x: one(kind, scope, x))


def approved(observations: DataFrame) -> DataFrame:
    """Evidence of approved types, renamed and without repeats (who may be credited with it is no part of the comparison)."""
    c = F.col
    rows = observations.filter(c("observation_type").isin(*APPROVED_TYPES)).select(
        "entity", c("observation_type").alias("type"), F.coalesce("source_name", F.lit("")).alias("source"), F.coalesce("scope", F.lit("")).alias("scope"), F.coalesce("match_type", F.lit("")).alias("match_type"),
        F.coalesce(c("site_attributable").cast("boolean"), F.lit(False)).alias("site_attributable"), c("value_text").alias("value"), c("value_numeric").alias("numeric_value"), "unit", c("source_updated_at_raw").alias("source_vintage"), "observed_at",
    )
    keys = [x for x in rows.columns if x != "site_attributable"]
    return rows.groupBy(*keys).agg(F.max("site_attributable").alias("site_attributable"))


def freshness(evidence: DataFrame, as_of: str) -> DataFrame:
    """Per entity: age of the newest evidence in days and its band. A source's own date counts before the observation's."""
    vintage, seen = parse_instant(F.col("source_vintage")), parse_instant(F.col("observed_at"))
    dated = evidence.select("entity", F.coalesce(vintage, seen).alias("at"), F.when(vintage.isNotNull(), "source_vintage").when(seen.isNotNull(), "observed_at").alias("basis_field"), F.nullif(F.col("source"), F.lit("")).alias("source"))
    made = dated.groupBy("entity").agg(F.max("at").alias("at"), F.max_by(F.struct("basis_field", "source"), F.struct("at", "source")).alias("b"))
    age = F.greatest(F.lit(0), F.floor((F.unix_timestamp(parse_instant(F.lit(as_of))) - F.unix_timestamp("at")) / 86400)).cast("long")
    return made.select("entity", age.alias("age_days"), F.when(F.col("at").isNull(), "UNKNOWN").when(age <= 180, "CURRENT").when(age <= 365, "AGING").otherwise("STALE").alias("band"), F.col("b.basis_field").alias("basis_field"), F.col("b.source").alias("source"))


def product_breadth(evidence: DataFrame) -> DataFrame:
    """Per entity: distinct codes, products, markets and the sources behind them, of the organisation only."""
    value = F.when(F.coalesce(F.col("value"), F.lit("")) != "", F.col("value"))
    kind, source = F.col("type"), F.nullif(F.col("source"), F.lit(""))

    def distinct(t: str) -> Column:
        return F.array_sort(F.collect_set(F.when(kind == t, value)))

    counted = (kind.isin("HS_CODE", "PRINCIPAL_PRODUCT", "EXPORT_MARKET") & value.isNotNull()) | kind.isin("EXPORTER_DATABASE_RECORD", "EXPORT_REGISTRATION", "EXPORTER_CATEGORY")
    made = evidence.filter("scope = 'ORGANIZATION'").groupBy("entity").agg(distinct("HS_CODE").alias("hs_codes"), distinct("PRINCIPAL_PRODUCT").alias("products"), distinct("EXPORT_MARKET").alias("markets"), F.array_sort(F.collect_set(F.when(counted, source))).alias("evidence_sources"))
    return made.withColumns({"hs_code_count": F.size("hs_codes"), "product_count": F.size("products"), "market_count": F.size("markets"), "evidence_source_count": F.size("evidence_sources")})


def export_breadth(evidence: DataFrame) -> DataFrame:
    """Per entity: how many sources give evidence of export, of any scope."""
    sources = F.array_sort(F.collect_set(F.when(F.col("type").isin(*EXPORT_TYPES), F.nullif(F.col("source"), F.lit("")))))
    made = evidence.groupBy("entity").agg(sources.alias("sources"))
    n = F.size("sources")
    return made.select("entity", n.alias("value"), F.when(n == 0, "NONE").when(n == 1, "SINGLE_SOURCE").otherwise("MULTI_SOURCE").alias("label"), "sources")


def source_consistency(evidence: DataFrame) -> DataFrame:
    """Per entity and type: spread of one value per source (the last by its text), with two sources or more."""
    rows = evidence.filter(F.col("site_attributable") & F.col("numeric_value").isNotNull())
    each = rows.groupBy("entity", "type", "source").agg(F.max_by("numeric_value", F.struct(F.coalesce("value", F.lit("")), "numeric_value")).alias("v"))
    made = each.groupBy("entity", "type").agg(F.count("*").alias("source_count"), F.min("v").alias("least"), F.max("v").alias("most"), F.avg("v").alias("mean"))
    many, spread = F.col("source_count") >= 2, F.when(F.col("mean") == 0, 0.0).otherwise((F.col("most") - F.col("least")) / F.abs("mean") * 100.0)
    band = F.when(~many, "NOT_CHECKED").when(spread <= 10, "CONSISTENT").when(spread <= 25, "MODERATE_DIFFERENCE").otherwise("MATERIAL_DIFFERENCE")
    return made.select("entity", F.col("type").alias("observation_type"), "source_count", band.alias("band"), F.when(many, F.col("least")).alias("min_value"), F.when(many, F.col("most")).alias("max_value"), F.when(many, rounded(F.col("mean"), 4)).alias("mean_value"), F.when(many, rounded(spread, 2)).alias("relative_spread_pct"))


def change_signals(history: DataFrame) -> DataFrame:
    """Per entity, type, source and unit: first and latest value, absolute and relative change.

    Needs two different instants. Values of one instant: the smallest first, the largest latest.
    """
    rows = history.filter(F.col("observation_type").isin(*CHANGE_TYPES) & F.col("site_attributable").cast("boolean") & F.col("value_numeric").isNotNull() & (F.coalesce("source_name", F.lit("")) != ""))
    rows = rows.withColumn("at", parse_instant(F.col("observed_at"))).filter("at is not null")
    made = rows.groupBy("entity", "observation_type", F.col("source_name").alias("source"), "unit").agg(
        F.min("at").alias("first_observed_at"), F.max("at").alias("latest_observed_at"), F.min_by("value_numeric", F.struct("at", "value_numeric")).alias("first_value"), F.max_by("value_numeric", F.struct("at", "value_numeric")).alias("latest_value"),
    ).filter("first_observed_at < latest_observed_at")
    change = F.col("latest_value") - F.col("first_value")
    return made.withColumns({"absolute_change": change, "percent_change": F.when(F.col("first_value") != 0, rounded(change / F.abs("first_value") * 100.0, 2))})


def cluster_context(targets: DataFrame, universe: DataFrame, kind: str = "NATIONAL_REGISTRY") -> DataFrame:
    """Targets (id, district, sector_family) with counts and shares of their district, sector and both."""
    cell = universe.groupBy("district", "sector_family").agg(F.count("*").alias("both"))
    size = F.sum("both").over(Window.partitionBy(F.lit(0)))
    cell = cell.withColumns({"in_district": F.sum("both").over(Window.partitionBy("district")), "in_sector": F.sum("both").over(Window.partitionBy("sector_family")), "universe_size": size})
    districts = cell.groupBy("district").agg(F.max("in_district").alias("district_establishments"), F.max("universe_size").alias("universe_size"))
    sectors = cell.groupBy("sector_family").agg(F.max("in_sector").alias("sector_establishments"))
    made = targets.join(districts, "district", "left").join(sectors, "sector_family", "left").join(cell.select("district", "sector_family", F.col("both").alias("district_sector_establishments")), ["district", "sector_family"], "left")
    made = made.fillna(0, ["district_establishments", "sector_establishments", "district_sector_establishments"])
    joint = F.col("district_sector_establishments") * 100.0
    return made.withColumns({
        "district_sector_share_of_district": F.when(F.col("district_establishments") > 0, rounded(joint / F.col("district_establishments"), 2)),
        "district_sector_share_of_sector": F.when(F.col("sector_establishments") > 0, rounded(joint / F.col("sector_establishments"), 2)), "suitable_for_national_cluster_claim": F.lit(kind == "NATIONAL_REGISTRY"),
    })


def employment_comparisons(base: DataFrame, evidence: DataFrame) -> DataFrame:
    """A row per external employment count of a site whose register entry has workers: source, both totals, difference in percent, flag."""
    external = evidence.filter((F.col("type") == "EMPLOYMENT_COUNT") & F.col("site_attributable") & F.col("numeric_value").isNotNull()).select("entity", "source", "numeric_value")
    made = base.filter("worker_total > 0").select("entity", "worker_total").join(external, "entity")
    made = made.withColumn("difference_pct", F.abs(F.col("numeric_value") - F.col("worker_total")) / F.col("worker_total") * 100.0)
    flag = F.when(F.col("difference_pct") <= 10, "WITHIN_10_PERCENT").when(F.col("difference_pct") <= 25, "DIFFERENCE_10_TO_25_PERCENT").otherwise("DIFFERENCE_OVER_25_PERCENT")
    return made.select("entity", "source", "worker_total", F.col("numeric_value").alias("external_worker_total"), "difference_pct", flag.alias("flag"))


def employment_consistency(base: DataFrame, evidence: DataFrame) -> DataFrame:
    """Per entity: the register's worker total against external counts of the site, the worst difference decides; the comparisons as a list."""
    pairs = employment_comparisons(base, evidence)
    one = F.struct("source", "external_worker_total", rounded(F.col("difference_pct"), 2).alias("absolute_difference_pct"), "flag")
    found = pairs.groupBy("entity").agg(F.array_sort(F.collect_list(one)).alias("list"), F.max("difference_pct").alias("worst"))
    made = base.select("entity", "worker_total").join(found, "entity", "left")
    label = F.when(F.col("worst").isNull(), "NOT_CHECKED").when(F.col("worst") <= 10, "CONSISTENT_WITHIN_10_PERCENT").when(F.col("worst") <= 25, "MODERATE_DIFFERENCE").otherwise("MATERIAL_DIFFERENCE")
    n = F.coalesce(F.size("list"), F.lit(0)).cast("long")
    return made.select("entity", F.when(n > 0, n).otherwise(0).alias("comparisons"), rounded(F.col("worst"), 2).alias("worst_difference_pct"), label.alias("value"), "list")


def observations_by_type(observations: DataFrame) -> DataFrame:
    """Per entity: a map from type to its observations."""
    listed = observations.groupBy("entity", "observation_type").agg(F.array_sort(F.collect_list(F.struct("source_name", "value_text", "value_numeric"))).alias("items"))
    return listed.groupBy("entity").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("observation_type", "items")))).alias("by_type"))


#: Lists of facts in a payload and the type of each.
FACTS = {
    "external_employment": "EMPLOYMENT_COUNT", "machines": "MACHINE_COUNT", "production_capacity": "PRODUCTION_CAPACITY", "products": "PRINCIPAL_PRODUCT", "hs_codes": "HS_CODE", "export_markets": "EXPORT_MARKET",
    "certifications": "CERTIFICATION", "association_membership": "ASSOCIATION_MEMBERSHIP_RECORD", "association_registration": "ASSOCIATION_REGISTRATION", "export_registration": "EXPORT_REGISTRATION",
    "exporter_database_evidence": "EXPORTER_DATABASE_RECORD", "associations": "ASSOCIATION", "exporter_category": "EXPORTER_CATEGORY",
}


def product_payloads(base: DataFrame, observations: DataFrame, history: DataFrame, context: DataFrame | None, generated_at: str) -> DataFrame:
    """The public payload of every establishment of ``base`` (entity and its descriptive columns), in one set-based job."""
    evidence = approved(observations)
    items = ["type", "source", "scope", "match_type", "site_attributable", "value", "numeric_value", "unit", "source_vintage", "observed_at"]
    sorted_items = F.transform(F.array_sort(F.collect_list(F.struct("type", "source", F.coalesce("value", F.lit("")).alias("o"), F.struct(*items).alias("e")))), lambda x: x["e"])
    made = base.join(evidence.groupBy("entity").agg(sorted_items.alias("evidence")), "entity", "left")
    for name, df in (
        ("export_evidence_breadth", export_breadth(evidence)), ("employment_consistency", employment_consistency(base, evidence)), ("evidence_freshness", freshness(evidence, generated_at)), ("export_product_breadth", product_breadth(evidence)),
    ):
        made = made.join(df.select("entity", F.struct(*[c for c in df.columns if c != "entity"]).alias(name)), "entity", "left")
    for name, df in (("external_numeric_consistency", source_consistency(evidence).filter(F.col("observation_type").isin(*CHANGE_TYPES))), ("change_signals", change_signals(history))):
        made = made.join(df.groupBy("entity").agg(F.array_sort(F.collect_list(F.struct(*[c for c in df.columns if c != "entity"]))).alias(name)), "entity", "left")
    if context is not None:
        made = made.join(context.select("entity", F.struct(*[c for c in context.columns if c != "entity"]).alias("cluster_context")), "entity", "left")
    else:
        made = made.withColumn("cluster_context", F.struct(F.lit("NOT_AVAILABLE").alias("status")))
    site_count = F.try_element_at(F.filter("evidence", lambda x: (x["type"] == "EMPLOYMENT_COUNT") & x["site_attributable"] & x["numeric_value"].isNotNull()), F.lit(1))["numeric_value"]
    workers = F.coalesce(F.col("worker_total").cast("double"), site_count)
    descriptive = [c for c in base.columns if c not in ("entity", "worker_total")]
    calculated = ["export_evidence_breadth", "employment_consistency", "evidence_freshness", "export_product_breadth", "external_numeric_consistency", "change_signals", "cluster_context"]
    return assert_safe(made.select(
        "entity", F.lit("1.1").alias("schema_version"), F.lit(generated_at).alias("generated_at"),
        F.struct(F.concat(F.lit("DIFE:"), F.col("entity").cast("string")).alias("establishment_ref"), *descriptive, F.col("worker_total").alias("dife_worker_total"), F.lit("DIFE").alias("source")).alias("establishment"),
        F.struct(*[_of_type(t).alias(n) for n, t in FACTS.items()]).alias("facts"),
        F.struct(employment_band(workers).alias("employment_scale_band"), *calculated).alias("calculated"), F.coalesce("evidence", F.array().cast(made.schema["evidence"].dataType)).alias("evidence"),
    ), product=True)


def _of_type(kind: str) -> Column:
    return F.filter("evidence", lambda x: x["type"] == kind)
