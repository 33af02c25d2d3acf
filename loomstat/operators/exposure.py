"""Administrative geography and exposure evidence: exact names, reviewed aliases, scoped links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import admin_name, collapse
from ..vocab import EXPOSURE_DIRECTIONS, EXPOSURE_DOMAINS, RISK_ALIASES, RISK_METRICS, SPATIAL_SCOPES
from .audit import Audit
from .bitmaps import bitmaps, counted, united
from .ordering import numbered
from .rollups import share

#: Units have a row per division, district and upazila of a country: some hundreds.
UNIT_COLUMNS = ("geo_ref", "level", "division_name_en", "division_name_bn", "district_name_en", "district_name_bn", "upazila_name_en", "upazila_name_bn")


def unit_names(units: DataFrame) -> DataFrame:
    """(level, key, geo_ref, divisions, districts): a row per name of a unit, keys and parents normalized."""
    n = units.select(*UNIT_COLUMNS[:2], *[admin_name(F.col(c)).alias(c) for c in UNIT_COLUMNS[2:]])

    def both(kind: str) -> Column:
        return F.array_distinct(F.filter(F.array(f"{kind}_name_en", f"{kind}_name_bn"), lambda x: x != ""))

    own = F.when(F.col("level") == "DIVISION", both("division")).when(F.col("level") == "DISTRICT", both("district")).otherwise(both("upazila"))
    return n.select("level", "geo_ref", both("division").alias("divisions"), both("district").alias("districts"), F.explode(own).alias("key"))


def resolve_places(asked: DataFrame, units: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """``asked`` (ask_id, level, name, division, district) with status, geo_ref and match_method.

    One reference by canonical name: EXACT_NAME; several: AMBIGUOUS; none: the same over
    approved aliases; else NO_MATCH. Blank parents are not compared; the parent district of an
    upazila may be named by an alias, too.
    """
    names = unit_names(units)
    # equal questions are answered once, so that NFKC sees distinct names only
    keys = ["level", "name", "division", "district"]
    with_key = asked.withColumn("__ask", F.md5(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})))
    q = with_key.select("__ask", *keys).dropDuplicates(["__ask"]).select(
        "__ask", F.col("level").alias("q_level"), admin_name(F.col("name")).alias("q"), admin_name(F.col("division")).alias("q_division"), admin_name(F.col("district")).alias("q_district")
    )
    parents = units.select("geo_ref", F.regexp_replace("geo_ref", "^BBS:UPZ:([^:]+:[^:]+):.*$", "BBS:DIST:$1").alias("parent_ref"))
    if aliases is None:
        alias_rows = units.sparkSession.createDataFrame([], "level string, key string, geo_ref string")
    else:
        alias_rows = aliases.select("level", admin_name(F.col("alias")).alias("key"), "geo_ref")
    alias_of = alias_rows.filter("level = 'DISTRICT'").groupBy(F.col("geo_ref").alias("parent_ref")).agg(F.collect_set("key").alias("parent_aliases"))
    known = parents.join(alias_of, "parent_ref", "left").select("geo_ref", F.coalesce("parent_aliases", F.array().cast("array<string>")).alias("parent_aliases"))
    under = ((F.col("q_division") == "") | F.array_contains("divisions", F.col("q_division"))) & (
        (F.col("q_district") == "") | F.array_contains("districts", F.col("q_district")) | ((F.col("level") == "UPAZILA") & F.array_contains("parent_aliases", F.col("q_district")))
    )
    places = names.join(known, "geo_ref")
    by_alias = alias_rows.join(places.select("geo_ref", "divisions", "districts", "parent_aliases").dropDuplicates(["geo_ref"]), "geo_ref")

    def refs(table: DataFrame, as_: str) -> DataFrame:
        hit = q.filter("q <> ''").join(table, (F.col("q_level") == F.col("level")) & (F.col("q") == F.col("key")))
        return hit.filter(under).groupBy("__ask").agg(F.countDistinct("geo_ref").alias(f"{as_}_n"), F.min("geo_ref").alias(f"{as_}_ref"))

    made = with_key.join(refs(places, "exact"), "__ask", "left").join(refs(by_alias, "alias"), "__ask", "left")
    e, a = F.coalesce(F.col("exact_n"), F.lit(0)), F.coalesce(F.col("alias_n"), F.lit(0))
    status = F.when(e == 1, "EXACT_NAME").when(e > 1, "AMBIGUOUS").when(a == 1, "APPROVED_ALIAS").when(a > 1, "AMBIGUOUS").otherwise("NO_MATCH")
    return made.select(
        *[with_key[c] for c in asked.columns], status.alias("status"), F.when(e == 1, F.col("exact_ref")).when((e == 0) & (a == 1), F.col("alias_ref")).alias("geo_ref"),
        F.when(e > 0, "canonical_name").when(a > 0, "approved_alias").alias("match_method"),
    )


def risk_aliases(units: DataFrame) -> DataFrame:
    """Reviewed aliases of the risk table that are needed: the label has no exact match, a canonical candidate has."""
    spark = units.sparkSession
    rows = [(label, k, c) for label, candidates in RISK_ALIASES for k, c in enumerate((label, *candidates))]
    asked = spark.createDataFrame([(f"{label}|{k}", label, k, "DISTRICT", c, None, None) for label, k, c in rows], "ask_id string, label string, k int, level string, name string, division string, district string")
    found = resolve_places(asked, units).filter("status = 'EXACT_NAME'").groupBy("label").agg(F.min("k").alias("k"), F.min_by("geo_ref", "k").alias("geo_ref"))
    return found.filter("k > 0").select(F.lit("DISTRICT").alias("level"), F.col("label").alias("alias"), "geo_ref")


def faults(observations: DataFrame) -> Column:
    """Why an observation is refused; null if it is sound."""

    def blank(c: str) -> Column:
        return F.trim(F.coalesce(F.col(c), F.lit(""))) == ""

    scope = F.col("spatial_scope")
    return (
        F.when(blank("source"), "source is required").when(blank("metric_code"), "metric_code is required").when(blank("metric_label"), "metric_label is required")
        .when(~F.coalesce(F.col("domain").isin(*EXPOSURE_DOMAINS), F.lit(False)), "unsupported domain").when(~F.coalesce(scope.isin(*SPATIAL_SCOPES), F.lit(False)), "unsupported spatial_scope")
        .when(~F.coalesce(F.col("direction"), F.lit("CONTEXT_ONLY")).isin(*EXPOSURE_DIRECTIONS), "unsupported direction")
        .when((scope == "SITE") & blank("establishment_ref"), "SITE needs establishment_ref").when((scope == "UPAZILA") & (blank("district") | blank("upazila")), "UPAZILA needs district and upazila")
        .when((scope == "DISTRICT") & blank("district"), "DISTRICT needs district")
    )


def validated(observations: DataFrame) -> DataFrame:
    """Observations with a direction; a refused one fails the query when its row is read."""
    checked = observations.withColumn("direction", F.coalesce(F.col("direction"), F.lit("CONTEXT_ONLY")))
    error = faults(checked)
    return checked.withColumn("source", F.when(error.isNotNull(), F.raise_error(F.concat(F.lit("exposure observation: "), error)).cast("string")).otherwise(F.trim("source")))


#: What makes two exposure observations the same.
FINGERPRINT = ("source", "domain", "metric_code", "spatial_scope", "establishment_ref", "district", "upazila", "value_text", "value_numeric", "unit", "source_vintage", "observed_at")


def fingerprinted(observations: DataFrame) -> DataFrame:
    return observations.withColumn("observation_sha256", F.sha2(F.to_json(F.struct(*sorted(FINGERPRINT)), {"ignoreNullFields": "false"}), 256))


_LINK = ("source", "domain", "metric_code", "metric_label", "spatial_scope", "value_text", "value_numeric", "unit", "direction", "source_vintage", "observed_at", "evidence_note", "canonical_geo_ref", "geography_match_type", "source_geography_label")


def links(registry: DataFrame, observations: DataFrame, units: DataFrame | None = None, aliases: DataFrame | None = None) -> DataFrame:
    """Establishments with the exposure evidence of their site, upazila or district.

    Each scope is an equi-join of its own. With a crosswalk and a canonical reference the
    reference decides, otherwise equal names (no suffix words are dropped there).
    """
    obs = validated(observations)
    for c in (*_LINK, "establishment_ref", "district", "upazila"):
        if c not in obs.columns:
            obs = obs.withColumn(c, F.lit(None).cast("double" if c == "value_numeric" else "string"))
    o = obs.select(*_LINK, F.col("establishment_ref").alias("o_ref"), F.col("district").alias("context_district"), F.col("upazila").alias("context_upazila"))
    rows = registry.select("establishment_ref", collapse(F.col("district")).alias("k_district"), collapse(F.col("upazila")).alias("k_upazila"))
    by_ref = F.lit(False) if units is None else (F.coalesce(F.col("canonical_geo_ref"), F.lit("")) != "")
    scope, named = F.col("spatial_scope"), o.withColumns({"k_district": collapse(F.col("context_district")), "k_upazila": collapse(F.col("context_upazila"))})
    # of rows that share a reference a site observation links one
    site = named.filter(scope == "SITE").drop("k_district", "k_upazila").join(rows.select("establishment_ref").filter("establishment_ref <> ''").distinct(), F.col("o_ref") == F.col("establishment_ref"))
    upazila = named.filter((scope == "UPAZILA") & ~by_ref).join(rows, ["k_district", "k_upazila"])
    district = named.filter((scope == "DISTRICT") & ~by_ref).drop("k_upazila").join(rows.drop("k_upazila"), "k_district")
    parts = [site, upazila, district]
    if units is not None:
        named_rows = registry.select("establishment_ref", F.coalesce("district", F.lit("")).alias("district"), F.coalesce("upazila", F.lit("")).alias("upazila"), "division")
        places = named_rows.select("district", "upazila", "division").distinct().withColumn("ask_id", F.lit(""))

        def resolved(level: str) -> DataFrame:
            asked = places.filter("district <> ''" + (" and upazila <> ''" if level == "UPAZILA" else "")).select("ask_id", F.lit(level).alias("level"), F.col("upazila" if level == "UPAZILA" else "district").alias("name"), "division", (F.col("district") if level == "UPAZILA" else F.lit(None).cast("string")).alias("district")).distinct()
            found = resolve_places(asked, units, aliases).filter("geo_ref is not null").select("name", F.col("division").alias("p_division"), F.col("district").alias("p_district"), "geo_ref")
            on = F.col("upazila" if level == "UPAZILA" else "district") == F.col("name")
            on = on & F.col("division").eqNullSafe(F.col("p_division")) & (F.col("district") == F.col("p_district") if level == "UPAZILA" else F.lit(True))
            return named_rows.join(found, on).select("establishment_ref", F.col("geo_ref").alias("canonical_geo_ref"))

        parts += [o.filter((scope == level) & by_ref).join(resolved(level), "canonical_geo_ref") for level in ("UPAZILA", "DISTRICT")]
    attribution = F.when(scope == "SITE", "SITE_SPECIFIC").when(scope == "UPAZILA", "UPAZILA_CONTEXT").otherwise("DISTRICT_CONTEXT")
    made = None
    for part in parts:
        p = part.select("establishment_ref", *_LINK[:5], attribution.alias("attribution"), "context_district", "context_upazila", *_LINK[5:], F.lit("SOURCE_OBSERVATION").alias("origin"))
        made = p if made is None else made.unionByName(p)
    return made


def reference_numbers(registry: DataFrame) -> DataFrame:
    """(establishment_ref, number): the references of a registry, numbered from 1."""
    return numbered(registry.select("establishment_ref").filter("establishment_ref is not null").distinct(), ["establishment_ref"], "number")


def coverage(registry: DataFrame, linked: DataFrame) -> DataFrame:
    """Establishments with evidence: overall, by domain and by scope (kind, label).

    Links become a bitmap of establishments per domain and scope, once; all counts are unions of those.
    """
    total = registry.agg(F.count("*").alias("registry_establishments"))
    maps = bitmaps(linked.join(reference_numbers(registry), "establishment_ref"), ["domain", "spatial_scope"], "number")
    kinds = [("ANY", F.lit("ANY")), ("DOMAIN", F.col("domain")), ("SCOPE", F.col("spatial_scope"))]
    each = maps.select("bucket", "bits", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("label")) for k, c in kinds])).alias("k")).select("k.*", "bucket", "bits")
    made = counted(united(each, ["kind", "label"]), ["kind", "label"], "establishments_with_evidence").crossJoin(F.broadcast(total))  # one row
    return made.withColumn("coverage_pct", share(F.col("establishments_with_evidence"), F.col("registry_establishments")))


_CONDITION = ("source", "domain", "metric_code", "metric_label", "spatial_scope", "attribution", "context_district", "context_upazila", "value_text", "value_numeric", "unit", "direction", "source_vintage", "observed_at")


def conditions(linked: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Distinct conditions and how many establishments stand in each."""
    return linked.groupBy(*(by or []), *_CONDITION).agg(F.countDistinct(F.nullif(F.col("establishment_ref"), F.lit(""))).alias("establishments_contextualized"))


def sector_districts(registry: DataFrame, linked: DataFrame) -> DataFrame:
    """Per sector family and district: establishments and those with evidence."""
    there = linked.select("establishment_ref").distinct().withColumn("linked", F.lit(True))
    made = registry.select("establishment_ref", "sector_family", "district").join(there, "establishment_ref", "left")
    # once per establishment and cell, so one distinct count gives both
    once = made.groupBy("sector_family", "district", "establishment_ref").agg(F.bool_or(F.coalesce("linked", F.lit(False))).alias("linked"))
    made = once.groupBy("sector_family", "district").agg(F.count("establishment_ref").alias("establishments"), F.count_if(F.col("linked") & F.col("establishment_ref").isNotNull()).alias("establishments_with_evidence"))
    return made.withColumn("coverage_pct", share(F.col("establishments_with_evidence"), F.col("establishments")))


def establishment_profiles(registry: DataFrame, linked: DataFrame) -> DataFrame:
    """Per establishment: number of observations, domains, whether evidence of the site itself and of its area is there."""
    made = linked.groupBy("establishment_ref").agg(
        F.count("*").alias("linked_observations"), F.array_sort(F.collect_set("domain")).alias("domains_with_evidence"),
        F.bool_or(F.col("attribution") == "SITE_SPECIFIC").alias("has_site_specific_evidence"), F.bool_or(F.col("attribution") != "SITE_SPECIFIC").alias("has_area_context"),
    )
    rows = registry.select("establishment_ref", "name", "district", "upazila", "sector_family").join(made, "establishment_ref", "left")
    return rows.fillna(0, ["linked_observations"]).withColumns({"domains_with_evidence": F.coalesce("domains_with_evidence", F.array().cast("array<string>")), "has_site_specific_evidence": F.coalesce("has_site_specific_evidence", F.lit(False)), "has_area_context": F.coalesce("has_area_context", F.lit(False))})


def area_profiles(registry: DataFrame, linked: DataFrame, by: str) -> DataFrame:
    """Per district or sector family: coverage and its conditions as a list."""
    with_area = linked.join(registry.select("establishment_ref", F.col(by).alias("__area")), "establishment_ref")
    n = registry.groupBy(F.col(by).alias("__area")).agg(F.count("*").alias("registry_establishments"))
    have = with_area.groupBy("__area").agg(F.countDistinct("establishment_ref").alias("establishments_with_evidence"))
    listed = conditions(with_area, ["__area"]).groupBy("__area").agg(F.array_sort(F.collect_list(F.struct("domain", "metric_code", "source", "context_district", "context_upazila", "value_text", "value_numeric", "establishments_contextualized"))).alias("conditions"))
    made = n.join(have, "__area", "left").join(listed, "__area", "left").fillna(0, ["establishments_with_evidence"])
    return made.withColumn("coverage_pct", share(F.col("establishments_with_evidence"), F.col("registry_establishments"))).withColumnRenamed("__area", by)


def family_profiles(registry: DataFrame, linked: DataFrame) -> DataFrame:
    """Per sector family: coverage, its conditions as a list, and the coverage of each of its districts as a list."""
    places = sector_districts(registry, linked)
    listed = F.array_sort(F.collect_list(F.struct("district", "establishments", "establishments_with_evidence", "coverage_pct"))).alias("districts")  # a row per district
    return area_profiles(registry, linked, "sector_family").join(places.groupBy("sector_family").agg(listed), "sector_family", "left")


def risk_observations(records: DataFrame, units: DataFrame, aliases: DataFrame | None, source: str, vintage: str | None, observed_at: str, audit: Audit | None = None) -> tuple[DataFrame, DataFrame]:
    """(observations, unresolved) of district risk records (division, district and the metrics): five metrics each.

    ``audit`` counts records and unresolved ones as the observations are made.
    """
    asked = records.withColumns({"ask_id": F.lit(""), "level": F.lit("DISTRICT"), "name": F.col("district")}).withColumnRenamed("district", "label").withColumn("district", F.lit(None).cast("string"))
    found = resolve_places(asked, units, aliases)
    bad = found.filter("geo_ref is null").select("division", F.col("label").alias("district"), "status")
    names = units.filter("level = 'DISTRICT'").select("geo_ref", "district_name_en")
    if audit is not None:
        found = audit.on(found, records=F.count("*"), unresolved=F.count_if(F.col("geo_ref").isNull()))
    good = found.filter("geo_ref is not null").join(names, "geo_ref")
    metrics = F.array(*[F.struct(F.lit(code).alias("metric_code"), F.lit(label).alias("metric_label"), F.col(column).alias("value_text")) for column, code, label in RISK_METRICS])
    made = good.select("*", F.explode(metrics).alias("m")).select(
        F.lit(source).alias("source"), F.lit("DISASTER_RISK").alias("domain"), "m.metric_code", "m.metric_label", F.lit("DISTRICT").alias("spatial_scope"), F.col("district_name_en").alias("district"),
        "m.value_text", F.lit("CONTEXT_ONLY").alias("direction"), F.lit(vintage).cast("string").alias("source_vintage"), F.lit(observed_at).alias("observed_at"), F.col("geo_ref").alias("canonical_geo_ref"),
        F.col("status").alias("geography_match_type"), F.concat_ws(" / ", "division", "label").alias("source_geography_label"),
    )
    return made, bad
