"""Similar names by prefix filters, global numbering, counts of the writing job."""

import random

import pytest
from pyspark.sql import functions as F

from loomstat.operators import matching as M
from loomstat.operators.audit import Audit
from loomstat.operators.ordering import numbered, numbered_in_groups

WORDS = "steel jute mills knit dyeing fashion green star delta padma textile tex ab a b apparel apparels".split()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def names(seed, n):
    rng = random.Random(seed)
    made = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 6))) for _ in range(n)]
    for name in made[: n // 3]:  # some that contain or are contained
        cut = rng.randint(0, max(0, len(name) // 3))
        made.append(name[cut:].strip() if rng.random() < 0.5 else f"{rng.choice(WORDS)[:3]}{name}")
    return sorted({x for x in made if x})


def strong_or_alike(a, b, least=0.40):
    """By all pairs: blocks, and exact, contained, or enough common words."""
    x, y = ({w for w in s.split() if len(w) > 1} for s in (a, b))
    overlap = len(x & y) / len(x | y) if x and y else None
    short, long = sorted((len(a), len(b)))
    contained = (a in b or b in a) and short >= 5 and short / long >= 0.70
    return a == b or bool(overlap) and (contained or overlap >= least)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_similar_cores_against_all_pairs(spark, seed):
    t, r = names(seed, 120), names(seed + 100, 120)
    frames = [spark.createDataFrame([(x,) for x in xs], f"{c} string") for xs, c in ((t, "t_core"), (r, "r_core"))]
    want = {(a, b) for a in t for b in r if strong_or_alike(a, b)}
    assert {(x["t_core"], x["r_core"]) for x in M.similar_cores(*frames).collect()} == want
    assert M.core_candidates(*frames).count() < M.core_pairs(*frames).count()


def test_middles_find_all_that_is_contained(spark):
    rng = random.Random(7)
    pairs = []
    for n in [*range(5, 40), 63, 64, 65, 127, 128, 129]:
        whole = "".join(rng.choice("abcdefgh") for _ in range(n))
        parts = {whole[a : a + k] for k in range(max(5, -(-7 * n // 10)), n + 1) for a in range(n - k + 1) if k / n >= 0.70}
        pairs += [(whole, x) for x in parts]
    wholes, parts = ({p[k] for p in pairs} for k in (0, 1))
    t, r = (spark.createDataFrame([(x,) for x in xs], "core string") for xs in (wholes, parts))
    found = {tuple(x) for x in M.contained_pairs(t, r).collect()}
    assert set(pairs) <= found


TARGET = "target_id long, name string, address string, district string, upazila string, sector_family string"
RECORD = "record_id long, source string, external_key string, name string, address string, district string, upazila string"


def test_profiles_give_what_rows_give(spark):
    """Many rows of one name, nulls in places: the shortlist of all pairs of rows, ranked."""
    rng = random.Random(5)
    some = lambda *x: rng.choice(x)
    t = spark.createDataFrame([(k, some("Alpha Mills", "Beta Steel Ltd", "Alpha", None, ""), some("Road 1", "Road 1 Gate 2", None), some("D1", "d1", "D2", None), some("U1", None), some("RMG_TEXTILE", "FOOD_AGRO")) for k in range(80)], TARGET)
    r = spark.createDataFrame([(k, some("BGMEA", "EPB"), str(k % 7), some("alpha mills", "Beta Steel", "Alpha Mill", None), some("road 1", "gate 2 road", ""), some("D1", "D2", None), some("U1", "U2", None)) for k in range(90)], RECORD)
    short, _ = M.candidate_run(t, r, 4)
    left = M.prepared(t.select("target_id", "sector_family", "name", "address", "district", "upazila"), "t_")
    right = M.prepared(r.select("record_id", "source", "external_key", "name", "address", "district", "upazila"), "r_")
    cores = M.core_pairs(left, right).withColumn("overlap", M.token_jaccard(F.col("t_core"), F.col("r_core"))).withColumn("name_result", M.core_strength(F.col("t_core"), F.col("r_core"), F.col("overlap")))
    rows = left.join(cores, "t_core").join(right, "r_core").filter(M.eligible(F.col("source"), F.col("sector_family")))
    columns = ["target_id", "record_id", "rank", "priority", "match_type", "address_overlap", "t_name", "r_name", "r_address"]
    want = sorted(map(str, (tuple(x) for x in M.shortlist(M.with_evidence(rows), 4).select(columns).collect())))
    assert sorted(map(str, (tuple(x) for x in short.select(columns).collect()))) == want and want


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_to_be_listed_are_all_made(spark, rows, seed):
    rng = random.Random(seed)
    some = lambda words, least, most: " ".join(rng.choice(words) for _ in range(rng.randint(least, most)))
    word, line = ["alpha", "beta", "mills", "textile", "x", "gamma", "ltd"], ["road", "lane", "plot", "r1", "r2", "gate"]
    place = lambda: (some(line, 0, 5), rng.choice(["d1", "d2", "", None]), rng.choice(["u1", "u2", "", None]))
    t = spark.createDataFrame([(k, some(word, 0, 4), *place(), "RMG_TEXTILE") for k in range(90)], TARGET)
    r = spark.createDataFrame([(k, "BGMEA", str(k), some(word, 0, 4), *place()) for k in range(90)], RECORD)
    sides = M._profiled(t, r)
    columns = ["t_profile", "r_profile", "overlap", "name_result", "address_result", "match_type", "n_t", "n_r", "priority"]
    listed, judged = (sorted(map(str, rows(M.profile_pairs(*sides, listed_only=x).withColumn("priority", M.priority()).filter("priority is not null").select(columns)))) for x in (True, False))
    assert listed == judged and any(x.endswith("priority=5)") or x.endswith(", 5)") for x in listed)


def test_a_word_of_all_names_does_not_make_all_pairs(spark, tmp_path):
    n = 60
    t = spark.createDataFrame([(k, f"w{k} Textile Mills Ltd", f"R{k} Lane", "D", f"U{k}", "RMG_TEXTILE") for k in range(n)], TARGET)
    r = spark.createDataFrame([(k, "BGMEA", str(k), f"w{k} Textile Mills", f"R{k} Lane", "D", f"U{k}") for k in range(n)], RECORD)
    assert M.profile_pairs(*M._profiled(t, r), listed_only=True).count() == n
    made, counts = M.audited_run(t, r, str(tmp_path / "run"), judged=False)
    assert counts["auto_selected"] == n and "pairs" not in counts and made.filter("selected_record = target_id").count() == n


def test_classes_that_block_give_all_pairs(spark, rows):
    words = ["Alpha", "Beta", "Mills", "Ltd", "x"]
    rng = random.Random(3)
    t, r = (spark.createDataFrame([(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 3)))) for k in range(n, n + 150)] + [(n + 150, None)], "id long, name string") for n in (0, 1000))
    found = rows(M.block_classes(t, r, "id", "name", "id", "name"))
    members = {kind: {} for kind in ("target", "record")}
    for kind, a, b, member in found:
        if kind != "pair":
            members[kind].setdefault(a if kind == "target" else b, []).append(member)
    assert sorted(x for m in members.values() for ids in m.values() for x in ids) == [*range(151), *range(1000, 1151)]
    pairs = [(a, b) for kind, a, b, _ in found if kind == "pair"]
    made = [(x, y) for a, b in pairs for x in members["target"][a] for y in members["record"][b]]
    assert sorted(made) == sorted(rows(M.block_pairs(t, r, "id", "name", "id", "name"))) and len(found) < len(made)


def test_audited_run_counts_as_it_writes(spark, tmp_path):
    t = spark.createDataFrame([(1, "Alpha Mills", "Road", "D1", "U1", "RMG_TEXTILE"), (2, "Nobody", "x", "D1", None, "RMG_TEXTILE")], TARGET)
    r = spark.createDataFrame([(7, "BGMEA", "7", "Alpha Mills Ltd", "Road", "D1", "U1"), (8, "BGMEA", "8", "Alpha Mills", "Elsewhere", "D9", None)], RECORD)
    made, counts = M.audited_run(t, r, str(tmp_path / "run"))
    assert counts["pairs"] == 2 and counts["shortlisted"] == 2 and counts["targets"] == 2 and counts["auto_selected"] == counts["no_staged_candidate"] == 1
    rows = {x["target_id"]: x for x in made.collect()}
    assert rows[1]["selected_record"] == 7 and [c["record_id"] for c in rows[1]["shortlist"]] == [7, 8] and rows[2]["shortlist"] is None
    _, outcomes = M.candidate_run(t, r)
    assert {x["target_id"]: (x["candidates"], x["outcome"], x["selected_record"]) for x in outcomes.collect()} == {k: (x["candidates"], x["outcome"], x["selected_record"]) for k, x in rows.items()}


def test_numbered(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", None]), k) for k in range(2000)]
    frame = spark.createDataFrame(data, "g int, h string, k int").repartition(7)
    made = numbered(frame, ["g", "h", "k"])
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "", r[2]))
    assert [tuple(r) for r in made.orderBy("position").select("g", "h", "k").collect()] == order
    assert sorted(r[0] for r in made.select("position").collect()) == list(range(1, 2001))
    assert "SinglePartition" not in plan_of(made)
    assert numbered(frame.limit(0), ["k"]).count() == 0
    grouped = numbered_in_groups(frame, ["g", "h"], ["k"], "n", "size").collect()
    for r in grouped:
        own = sorted(x[2] for x in data if x[:2] == (r["g"], r["h"]))
        assert own[r["n"] - 1] == r["k"] and r["size"] == len(own)


def test_audit_counts_without_further_jobs(spark, tmp_path):
    audit = Audit()
    rows = audit.on(spark.range(100), all=F.count("*"))
    kept = audit.on(rows.filter("id % 4 = 0"), kept=F.count("*"), total=F.sum("id"))
    kept.write.parquet(str(tmp_path / "x"))
    assert audit.counts() == {"all": 100, "kept": 25, "total": sum(range(0, 100, 4))}


def test_logs_are_read_by_folder(spark, tmp_path):
    from loomstat.sources.store import LogStore

    store = LogStore(spark, str(tmp_path / "s"))
    rows = spark.createDataFrame([("01", 1, "a"), ("01", 2, "b"), ("x:y", 1, "c")], "run string, item int, v string")
    assert store.append_new("m", rows, ["run", "item"]) == 3 and store.append_new("m", rows.withColumn("v", F.lit("z")), ["run", "item"]) == 0
    one = store.read("m", "run string, item int, v string").filter("run = '01'")
    assert one.columns == ["run", "item", "v"] and sorted(r["v"] for r in one.collect()) == ["a", "b"]
    assert "PartitionFilters: [isnotnull(run" in plan_of(one) and {r["run"] for r in store.read_all("m").collect()} == {"01", "x:y"}
    store.replace("sample", "l", rows.select("item", "v"), "2024-01-01", 1)
    store.replace("sample", "k", rows.select("item", "v"), "2024-01-01", 2)
    broken = rows.select("item", F.when(F.col("item") == 2, F.raise_error(F.lit("broken plan")).cast("string")).otherwise(F.col("v")).alias("v"))
    with pytest.raises(Exception, match="broken plan"):
        store.replace("sample", "l", broken, "2024-01-02", 3)
    current = store.current("sample", "l", "item int, v string")
    assert sorted(r["v"] for r in current.collect()) == ["a", "b", "c"] and "version" in plan_of(current).split("PartitionFilters:")[1].split("]")[0]
    store.overwrite("derived", rows, "run")
    with pytest.raises(Exception, match="broken plan"):
        store.overwrite("derived", broken.withColumn("run", F.lit("01")), "run")
    store.overwrite("derived", rows.filter("run = '01' and item = 1"), "run")
    assert sorted(r["v"] for r in store.read_all("derived").collect()) == ["a", "c"]


def test_one_per_key_whatever_the_order(spark):
    from loomstat.operators import sampling as S
    from loomstat.operators import versioning as V

    data = [(1, "A", "X"), (1, "B", "Y"), (2, "B", "Y"), (2, "A", "Y"), (3, None, None), (3, "A", "X")]
    schema = "id int, sector_family string, geography_group string"
    made = [spark.createDataFrame(x, schema).coalesce(1) for x in (data, data[::-1])]
    frozen = [sorted(map(tuple, S.joint_freeze(df, {"A": 1, "B": 0}, {"X": 1}).collect())) for df in made]
    assert frozen[0] == frozen[1] == [(1, "A", "X")]
    assert len({str(sorted(map(tuple, V.one_per_key(df, ["id"]).collect()))) for df in made}) == 1
    assert [sorted(map(tuple, S.pool_health(df, "sector_family", {"A": 1, "B": 1}).collect())) for df in made] == [[("A", 1, 2, 0, True), ("B", 1, 0, 1, False)]] * 2
    last = spark.createDataFrame([(*r, k) for k, r in enumerate(data)], schema + ", at int")
    assert sorted(map(tuple, S.pool_health(last, "sector_family", {"A": 1, "B": 1}, "at").collect())) == [("A", 1, 2, 0, True), ("B", 1, 1, 0, True)]


@pytest.mark.parametrize("seed", range(3))
def test_cuts_are_what_the_flow_lacks(spark, seed):
    from loomstat.operators import sampling as S

    rng = random.Random(seed)
    sectors, places = {"A": rng.randint(1, 6), "B": rng.randint(1, 6), "C": 2}, {}
    total = sum(sectors.values())
    places["X"] = rng.randint(0, total)
    places["Y"] = rng.randint(0, total - places["X"])
    places["Z"] = total - places["X"] - places["Y"]
    cells = {(s, g): rng.randint(0, 3) for s in sectors for g in places}
    rows = spark.createDataFrame([(k, s, g) for k, (s, g) in enumerate(c for c, n in cells.items() for _ in range(n))] + [(9999, "D", "X")], "id int, sector_family string, geography_group string")
    _, missing = S.allocate(cells, sectors, places)
    made = S.cuts(rows, sectors, places).collect()
    assert len(made) == 8 and max(r["gap"] for r in made) == missing
    if missing:
        with pytest.raises(S.FreezeError) as error:
            S.joint_freeze(rows, sectors, places)
        assert error.value.diagnostics["cut"]["gap"] == missing


def test_members_join_without_exchange(spark):
    from loomstat.operators import rollups as R
    from loomstat.sources.bucketed import bucketed

    members = spark.range(1000).selectExpr("if(id % 2 = 0, 'u', 'v') as universe_label", "id", "id % 300 as observation_id")
    seen = spark.range(300).selectExpr("id as observation_id", "concat('n', id) as name", "'A' as status")
    made = R.member_rows(bucketed(members, "observation_id", 4, "m"), bucketed(seen, "observation_id", 4, "o"), "u").hint("merge")
    plan = plan_of(made)
    assert made.count() == 500 and made.columns == ["id", "observation_id", "name", "status"]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(R.member_rows(bucketed(members, "observation_id", 4, "m"), bucketed(seen, "observation_id", 4, "o"), "u"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Join" in plan and "Exchange" not in plan
    with pytest.raises(Exception, match="no observation"):
        R.member_rows(members, seen.filter("observation_id < 10"), "u").collect()


def test_landing_is_exactly_once_over_restarts(spark, tmp_path):
    from loomstat.streaming.landing import ingest_once

    data = spark.createDataFrame([(k, f"h{k % 40}") for k in range(100)], "k int, h string")
    args = (data.schema, str(tmp_path / "log"), str(tmp_path / "checkpoint"), ["h"])
    data.filter("k < 30").write.parquet(str(tmp_path / "in"))
    assert ingest_once(spark, str(tmp_path / "in"), *args) == 30
    assert ingest_once(spark, str(tmp_path / "in"), *args) == 0
    data.filter("k >= 20").repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
    assert ingest_once(spark, str(tmp_path / "in"), *args, max_files=1) == 10
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == log.select("h").distinct().count() == 40


def test_layouts_keep_all_rows(spark, tmp_path):
    from loomstat.sources.layouts import LayoutError, VersionedTable, renamed, with_columns

    held = VersionedTable(spark, str(tmp_path), "t", [with_columns(kind="old")])
    held.append(spark.createDataFrame([(1,)], "id int"))
    held.append(spark.createDataFrame([(2, "new")], "id int, kind string"))
    assert held.layout() == 1 and held.upgrade() == {2: 2} and held.upgrade() == {} and held.layout() == 2
    assert sorted(map(tuple, held.read().select("id", "kind").collect())) == [(1, "old"), (2, "new")]
    later = VersionedTable(spark, str(tmp_path), "t", [with_columns(kind="old"), lambda rows: rows.filter("id > 1")])
    with pytest.raises(LayoutError):
        later.upgrade()
    assert later.layout() == 2
    third = VersionedTable(spark, str(tmp_path), "t", [with_columns(kind="old"), renamed(kind="sort")])
    assert third.upgrade() == {3: 2} and set(third.read().columns) == {"id", "sort"}


def test_exported_array_is_one_document(spark, tmp_path):
    import json

    from loomstat.sources.sinks import export_json_array, read_json_array

    rows = spark.createDataFrame([(k % 7, f"n{k}", None if k % 3 else 'q"[\n') for k in range(50)], "b int, name string, a string").repartition(5)
    export_json_array(rows, ["b", "name"], str(tmp_path / "x"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "x").glob("part-*")))
    made = json.loads(text)
    assert [(r["b"], r["name"]) for r in made] == sorted((k % 7, f"n{k}") for k in range(50)) and list(made[0]) == ["a", "b", "name"]
    assert sorted(map(str, read_json_array(spark, str(tmp_path / "x"), rows.schema).collect())) == sorted(map(str, rows.collect()))
    export_json_array(rows.limit(0), ["b"], str(tmp_path / "none"))
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "none").glob("part-*")))) == []
    with pytest.raises(Exception):
        export_json_array(rows.withColumnRenamed("a", "internal_id"), ["b"], str(tmp_path / "private"), product=True)


def test_bitmaps_count_what_distinct_counts(spark):
    from loomstat.operators.bitmaps import bitmaps, counted, united

    rows = spark.range(5000).selectExpr("id % 3 as a", "id % 5 as b", "if(id % 11 = 0, null, (id * 7919) % 100000) as n")
    maps = bitmaps(rows, ["a", "b"], "n")
    for cells in (["a", "b"], ["a"], ["b"]):
        want = {tuple(r) for r in rows.groupBy(*cells).agg(F.countDistinct("n")).collect()}
        assert {tuple(r) for r in counted(united(maps, cells), cells, "c").collect()} == want


def test_counts_of_places_that_did_not_run(spark, tmp_path):
    audit = Audit()
    rows = audit.on(spark.range(10).limit(0), n=F.count("*")).join(spark.range(5), "id")
    audit.on(rows, m=F.count("*")).write.parquet(str(tmp_path / "x"))
    assert {k: v or 0 for k, v in audit.counts().items()} == {"n": 0, "m": 0}
    none = spark.createDataFrame([], RECORD)
    targets = spark.createDataFrame([(1, "Alpha Mills", "Road", "D1", "U1", "RMG_TEXTILE")], TARGET)
    _, counts = M.audited_run(targets, none, str(tmp_path / "run"))
    assert counts["pairs"] == counts["shortlisted"] == 0 and counts["targets"] == counts["no_staged_candidate"] == 1
