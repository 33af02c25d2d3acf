"""Validation samples and collection plans: quotas, joint feasibility, progressive batches, page plans."""

from __future__ import annotations

import functools
from collections import deque
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import filter_url, spread_pages, spread_positions
from ..vocab import CHECKPOINTS, GEOGRAPHY_RULES, SECTOR_RULES
from .ordering import numbered, numbered_in_groups
from .versioning import distinct_last

SECTOR_TARGETS = {code: n for code, n, _ in SECTOR_RULES}
GEOGRAPHY_TARGETS = {code: n for code, n, _ in GEOGRAPHY_RULES}


def _of(values: Mapping[str, int], key: Column) -> Column:
    made = F.lit(0)
    for code, n in values.items():
        made = F.when(key == code, n).otherwise(made)
    return made


def once_each(candidates: DataFrame, position: str | None = None) -> DataFrame:
    """(id, sector_family, geography_group): of a repeated id the last row by ``position``, else the one that sorts first."""
    if position:
        return distinct_last(candidates.select("id", "sector_family", "geography_group", position), ["id"], position).drop(position)
    return candidates.groupBy("id").agg(F.min(F.struct("sector_family", "geography_group")).alias("s")).select("id", "s.*")


def quota_sample(candidates: DataFrame, target: int = 2000, sectors: Mapping[str, int] = SECTOR_TARGETS, geographies: Mapping[str, int] = GEOGRAPHY_TARGETS, position: str | None = None) -> DataFrame:
    """(id, sector_family, geography_group, selection_stage): sector quotas first, then geography floors, then the rest up to the target.

    Each stage keeps the smallest ids of its strata, at most as many as its quotas ask for, so that
    Spark drops the others before the shuffle; what the stages hold together is bounded by the
    quotas and the target. A repeated id counts once: the last by ``position``, else the row that
    sorts first.
    """
    rows = once_each(candidates, position)

    def smallest(of: DataFrame, by: str, most: int, quota: Column) -> DataFrame:
        ranked = of.withColumn("k", F.row_number().over(Window.partitionBy(by).orderBy("id"))).filter(F.col("k") <= most)
        return ranked.filter(F.col("k") <= quota).drop("k")

    def without(of: DataFrame, taken: DataFrame) -> DataFrame:
        ids = F.broadcast(taken.select(F.col("id").alias("__taken")))  # as many rows as the quotas at most
        return of.join(ids, F.col("id").eqNullSafe(F.col("__taken")), "left_anti")

    quota = smallest(rows, "sector_family", max(sectors.values(), default=0), _of(sectors, F.col("sector_family")))
    rest = without(rows, quota)
    had = F.broadcast(quota.groupBy(F.col("geography_group").alias("__group")).agg(F.count("*").alias("had")))  # a row per geography group
    need = F.greatest(F.lit(0), _of(geographies, F.col("geography_group")) - F.coalesce("had", F.lit(0)))
    asked = rest.filter(F.col("geography_group").isin(*geographies)).join(had, F.col("geography_group") == F.col("__group"), "left")
    floor = smallest(asked, "geography_group", max(geographies.values(), default=0), need).select(*rows.columns)
    general = without(rest, floor).orderBy("id").limit(target)
    stages = zip((quota, floor, general), (0, 1, 2), strict=True)
    final = functools.reduce(DataFrame.unionByName, [df.withColumn("stage", F.lit(k)) for df, k in stages]).orderBy("stage", "id").limit(target)
    names = F.element_at(F.array(F.lit("SECTOR_QUOTA"), F.lit("GEOGRAPHY_FILL"), F.lit("GENERAL_FILL")), F.col("stage") + 1)
    return final.select("id", "sector_family", "geography_group", names.alias("selection_stage"))


def pool_health(candidates: DataFrame, by: str, targets: Mapping[str, int], position: str | None = None) -> DataFrame:
    """Candidates per group against its target; groups without candidates have a row, too. Ids count once, as in a sample."""
    want = candidates.sparkSession.createDataFrame(list(targets.items()), f"{by} string, target long")
    n = once_each(candidates, position).groupBy(by).agg(F.count("*").alias("candidates"))
    made = F.broadcast(want).join(n, by, "left").fillna(0, ["candidates"])
    return made.withColumn("deficit", F.greatest(F.lit(0), F.col("target") - F.col("candidates"))).withColumn("ready", F.col("deficit") == 0)


class FreezeError(ValueError):
    """No sample meets both kinds of target; carries what is missing."""

    def __init__(self, diagnostics: dict) -> None:
        super().__init__(f"joint targets can't be met: {diagnostics}")
        self.diagnostics = diagnostics


def allocate(cells: Mapping[tuple[str, str], int], sectors: Mapping[str, int], geographies: Mapping[str, int]) -> tuple[dict[tuple[str, str], int], int]:
    """How many of each cell meet all targets, by augmenting paths in a fixed order, and how many are missing.

    The cells are sectors x geographies, a few dozen, so this runs on the driver.
    """
    used: dict[tuple[str, str], int] = {c: 0 for c in sorted(cells)}
    need, room = dict(sectors), dict(geographies)
    missing = 0
    for sector in sorted(need):
        while need[sector]:
            # breadth first from the sector over cells with room, back over cells in use
            came: dict[tuple[str, str], tuple[tuple[str, str], tuple[str, str]] | None] = {("s", sector): None}
            queue, end = deque([("s", sector)]), None
            while queue and end is None:
                kind, name = queue.popleft()
                for cell in used:
                    if kind == "s" and cell[0] == name and used[cell] < cells[cell] and ("g", cell[1]) not in came:
                        came["g", cell[1]] = ((kind, name), cell)
                        if room.get(cell[1], 0):
                            end = ("g", cell[1])
                            break
                        queue.append(("g", cell[1]))
                    elif kind == "g" and cell[1] == name and used[cell] and ("s", cell[0]) not in came:
                        came["s", cell[0]] = ((kind, name), cell)
                        queue.append(("s", cell[0]))
            if end is None:
                missing += need[sector]
                break
            path, at, step = [], end, min(need[sector], room[end[1]])
            while came[at]:
                before, cell = came[at]
                path.append((cell, at[0] == "g"))
                step = min(step, cells[cell] - used[cell] if at[0] == "g" else used[cell])
                at = before
            for cell, forward in path:
                used[cell] += step if forward else -step
            need[sector] -= step
            room[end[1]] -= step
    return used, missing


#: Kinds of place whose subsets are all looked at.
MOST_PLACES = 16


def cuts(candidates: DataFrame, sectors: Mapping[str, int], geographies: Mapping[str, int], position: str | None = None) -> DataFrame:
    """(places, needed, available, gap): for every set of geographies, what its targets ask for and what its candidates can give.

    A set can give at most, over the sectors, the smaller of the sector's target and its candidates
    there. By max-flow and min-cut a plan exists exactly if no set has a gap, and the largest gap
    is what every plan lacks. Cells are sectors x geographies, sets 2 ^ geographies.
    """
    if len(geographies) > MOST_PLACES:
        raise ValueError(f"more than {MOST_PLACES} geographies have too many subsets")
    spark, names = candidates.sparkSession, sorted(geographies)
    cells = once_each(candidates, position).groupBy("sector_family", "geography_group").agg(F.count("*").alias("n"))
    asked = spark.createDataFrame(list(sectors.items()), "sector_family string, target long")
    bits = spark.createDataFrame([(g, k) for k, g in enumerate(names)], "geography_group string, bit int")
    sets = spark.range(1 << len(names)).withColumnRenamed("id", "set")
    has = F.expr("shiftright(set, bit) % 2 = 1")
    listed = F.array(*[F.lit(g) for g in names])
    picked = F.filter(listed, lambda x, k: F.expr("set").bitwiseAND(F.pow(F.lit(2.0), k).cast("long")) != 0)
    inside = F.broadcast(cells.join(F.broadcast(bits), "geography_group").join(F.broadcast(asked), "sector_family"))  # a row per cell
    held = sets.crossJoin(inside).filter(has).groupBy("set", "sector_family").agg(F.least(F.sum("n"), F.first("target")).alias("held"))
    needed = spark.createDataFrame([(k, sum(geographies[g] for i, g in enumerate(names) if k >> i & 1)) for k in range(1 << len(names))], "set long, needed long")
    made = needed.join(held.groupBy("set").agg(F.sum("held").alias("available")), "set", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    return made.select(F.array_join(picked, "+").alias("places"), "needed", "available", F.greatest(F.lit(0), F.col("needed") - F.col("available")).alias("gap"))


def joint_freeze(candidates: DataFrame, sectors: Mapping[str, int], geographies: Mapping[str, int], position: str | None = None) -> DataFrame:
    """(id, sector_family, geography_group) that meet both kinds of target exactly; FreezeError, with the cut that rules it out, if none do."""
    if sum(sectors.values()) != sum(geographies.values()) or min([*sectors.values(), *geographies.values()], default=0) < 0:
        raise ValueError("targets must be positive and add up to the same number")
    rows = once_each(candidates, position).filter(F.col("sector_family").isin(*sectors) & F.col("geography_group").isin(*geographies))
    cells = {(r[0], r[1]): r[2] for r in rows.groupBy("sector_family", "geography_group").count().collect()}  # a row per cell
    used, missing = allocate(cells, sectors, geographies)
    if missing:
        have = {k: sum(n for (s, g), n in cells.items() if k in (s, g)) for k in (*sectors, *geographies)}
        short = lambda targets: {k: v - have[k] for k, v in targets.items() if have[k] < v}
        worst = cuts(rows, sectors, geographies).orderBy(F.desc("gap"), "places").first() if len(geographies) <= MOST_PLACES else None
        raise FreezeError({"flow_gap": missing, "cut": worst.asDict() if worst else None, "sector_deficits": short(sectors), "geography_deficits": short(geographies)})
    plan = candidates.sparkSession.createDataFrame([(s, g, n) for (s, g), n in used.items() if n], "sector_family string, geography_group string, used int")
    ranked = rows.join(F.broadcast(plan), ["sector_family", "geography_group"]).withColumn("k", F.row_number().over(Window.partitionBy("sector_family", "geography_group").orderBy("id")))
    return ranked.filter("k <= used").select("id", "sector_family", "geography_group")


def progressive_batches(sample: DataFrame, label: str, checkpoints: tuple[int, ...] = CHECKPOINTS) -> DataFrame:
    """(id, sequence_no, first_checkpoint): cells are merged fairly, ids inside a cell in the order of their hash.

    Every prefix holds each cell in proportion, so the checkpoints are nested samples. The
    sequence numbers the sample itself, whose size is the last checkpoint. Numbers inside a cell
    and in the whole come from sorted range partitions, so a cell may hold any share of the sample.
    """
    rows = sample.select("id", "sector_family", "geography_group", F.sha2(F.concat(F.lit(f"{label}:"), F.col("id").cast("string")), 256).alias("key"))
    rows = numbered_in_groups(rows, ["sector_family", "geography_group"], ["key", "id"], "k", "size")
    rows = rows.withColumn("at", (2 * F.col("k") - 1) / (2 * F.col("size")))
    made = numbered(rows, ["at", "sector_family", "geography_group"], "sequence_no")
    first = F.lit(None).cast("int")
    for n in sorted(checkpoints, reverse=True):
        first = F.when(F.col("sequence_no") <= n, n).otherwise(first)
    return made.select("id", "sector_family", "geography_group", "sequence_no", first.alias("first_checkpoint"))


def proportional_rows(universes: DataFrame, targets: Mapping[str, int], multiplier: float = 1.5, page_size: int = 30) -> DataFrame:
    """Universes (family, label, total) with the rows wanted of each: its share of the family's target, a page at least."""
    total = F.sum("total").over(Window.partitionBy("family"))
    scaled = {k: -int(-v * multiplier // 1) for k, v in targets.items()}
    goal = F.when(F.col("family").isin(*scaled), _of(scaled, F.col("family"))).otherwise(page_size)
    return universes.filter("total > 0").withColumn("wanted", F.least(F.col("total"), F.greatest(F.lit(page_size), F.ceil(goal * F.col("total") / total))).cast("long"))


def page_plan(universes: DataFrame, page_size: int = 30, skip_first: bool = True) -> DataFrame:
    """A row per page to fetch, spread over each listing; the first page was the seed."""
    made = universes.select("*", F.explode(spread_pages(F.col("total"), F.col("wanted"), page_size)).alias("page"))
    return made.filter("page > 1") if skip_first else made


def seed_requests(options: DataFrame, family: Column, base_url: str) -> DataFrame:
    """One first-page request per sector option (dimension, source_value, source_label)."""
    rows = options.filter("dimension = 'INDUSTRIAL_SECTOR'").withColumn("sector_family", family)
    return rows.select("sector_family", "source_value", "source_label", F.lit(1).alias("page"), filter_url(base_url, industry_id=F.col("source_value"), page=F.lit(1)).alias("url"), F.lit("UNIVERSE_SEED").alias("reason"))


def geographic_seeds(districts: DataFrame, sectors: DataFrame, deficits: Mapping[str, int], base_url: str, max_districts: int = 3, max_sectors: int = 3) -> DataFrame:
    """First-page requests for groups that lack candidates: a few districts of each with a few sectors.

    districts: geography_group, value, label; sectors: value, label, total. Both lists are
    ranked first, so the product has at most groups x max_districts x max_sectors rows.
    """
    lacking = [k for k, v in deficits.items() if v > 0]
    d = districts.filter(F.col("geography_group").isin(*lacking)).withColumn("k", F.row_number().over(Window.partitionBy("geography_group").orderBy("label", "value"))).filter(F.col("k") <= max_districts)
    s = sectors.orderBy(F.desc("total"), "label", "value").limit(max_sectors)
    made = d.select("geography_group", F.col("value").alias("district_value"), F.col("label").alias("district_label")).crossJoin(F.broadcast(s.select(F.col("value").alias("sector_value"), F.col("label").alias("sector_label"))))
    return made.withColumns({"page": F.lit(1), "url": filter_url(base_url, industry_id=F.col("sector_value"), district=F.col("district_value"), page=F.lit(1))})


def geographic_rows(universes: DataFrame, deficits: Mapping[str, int], multiplier: float = 1.25, page_size: int = 30) -> DataFrame:
    """Universes (family is the geography group) with the rows wanted to make up the deficits."""
    return proportional_rows(universes.filter(F.col("family").isin(*[k for k, v in deficits.items() if v > 0])), deficits, multiplier, page_size)


def full_page_plan(runs: DataFrame, page_size: int = 30) -> DataFrame:
    """All pages of each run (run_id, expected_total) with the records due on each."""
    pages = runs.filter("expected_total > 0").select("run_id", "expected_total", F.explode(F.sequence(F.lit(1), F.ceil(F.col("expected_total") / page_size).cast("int"))).alias("page"))
    return pages.withColumn("records_due", F.greatest(F.lit(0), F.least(F.lit(page_size), F.col("expected_total") - (F.col("page") - 1) * page_size)))


def index_page_plan(indexes: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Pages after the first of indexes whose bounds are known (current_page, last_page)."""
    last = F.col("last_page") if max_pages is None else F.least("last_page", F.lit(max_pages))
    return indexes.filter(F.col("current_page").isNotNull() & (F.coalesce(last, F.lit(0)) > F.col("current_page"))).select("*", F.explode(F.sequence(F.col("current_page") + 1, last)).alias("page"))


def spread_items(rows: DataFrame, by: str, order: list[str], n: int) -> DataFrame:
    """Up to n rows of each group, evenly spread over its order."""
    w = Window.partitionBy(by)
    ranked = rows.withColumns({"__k": F.row_number().over(w.orderBy(*order)), "__m": F.count("*").over(w).cast("int")})
    return ranked.filter(F.array_contains(spread_positions(F.col("__m"), F.lit(n)), F.col("__k"))).drop("__k", "__m")
