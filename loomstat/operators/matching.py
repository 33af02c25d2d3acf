"""Entity resolution: token blocking, name and place evidence, shortlists, decisions.

Rules decide, in a fixed order; there is no score and no fuzzy comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import company_core, normalize_text, token_jaccard, tokens
from ..vocab import EXTERNAL_SOURCES
from .audit import Audit
from .ordering import numbered


def eligible(source: Column, family: Column) -> Column:
    """Whether a source can speak of a sector family."""
    made = F.lit(False)
    for name, (_, families) in EXTERNAL_SOURCES.items():
        made = F.when(source == name, F.lit(True) if families is None else family.isin(*families)).otherwise(made)
    return made


def linkage(source: Column) -> Column:
    made = F.lit(None).cast("string")
    for name, (kind, _) in EXTERNAL_SOURCES.items():
        made = F.when(source == name, kind).otherwise(made)
    return made


def core_pairs(targets: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs of company cores (t_core of ``targets``, r_core of ``records``) that are equal or share a word.

    Works on distinct cores, so a name that many rows bear is one row here, and a frequent word
    joins names, not rows. The join is a plain equi-join that Spark splits where it is skewed.
    The result is all pairs with a common word, which is quadratic in a word's names: whoever
    wants similar names only takes ``similar_cores``.
    """

    def words(df: DataFrame, core: str) -> DataFrame:
        keys = F.array_distinct(F.concat(F.transform(tokens(F.col(core)), lambda w: F.concat(F.lit("t:"), w)), F.array(F.concat(F.lit("c:"), F.col(core)))))
        return df.select(core).filter(F.col(core) != "").distinct().select(core, F.explode(keys).alias("__word"))

    return words(targets, "t_core").join(words(records, "r_core"), "__word").select("t_core", "r_core").distinct()


def block_pairs(targets: DataFrame, records: DataFrame, target_id: str, target_name: str, record_id: str, record_name: str) -> DataFrame:
    """Pairs with an equal company core or a common word of its name. An id has one name."""
    t = targets.select(F.col(target_id).alias("target_id"), company_core(F.col(target_name)).alias("t_core"))
    r = records.select(F.col(record_id).alias("record_id"), company_core(F.col(record_name)).alias("r_core"))
    return t.join(core_pairs(t, r), "t_core").join(r, "r_core").select("target_id", "record_id")


def block_classes(targets: DataFrame, records: DataFrame, target_id: str, target_name: str, record_id: str, record_name: str) -> DataFrame:
    """The pairs of ``block_pairs`` by classes: rows of one company core block alike, so pairs stand for them all.

    kind 'pair': target_id and record_id are the smallest ids of two classes that block, member_id
    is null. kind 'target' or 'record': member_id is an id and target_id or record_id its class.
    Each pair of ids whose classes are a pair blocks, and no other; rows grow with the input and
    with pairs of distinct names. A class without a core is in no pair.
    """
    t = targets.select(F.col(target_id).alias("id"), company_core(F.col(target_name)).alias("t_core"))
    r = records.select(F.col(record_id).alias("id"), company_core(F.col(record_name)).alias("r_core"))
    first_t, first_r = (rows.groupBy(core).agg(F.min("id").alias(name)) for rows, core, name in ((t, "t_core", "target_id"), (r, "r_core", "record_id")))
    pairs = first_t.join(core_pairs(first_t, first_r), "t_core").join(first_r, "r_core")
    made = pairs.select(F.lit("pair").alias("kind"), "target_id", "record_id", F.lit(None).cast(t.schema["id"].dataType).alias("member_id"))
    for kind, rows, core, first, name in (("target", t, "t_core", first_t, "target_id"), ("record", r, "r_core", first_r, "record_id")):
        ids = {x: F.col(x) if x == name else F.lit(None).cast(rows.schema["id"].dataType).alias(x) for x in ("target_id", "record_id")}
        made = made.unionByName(rows.join(first, core).select(F.lit(kind).alias("kind"), *ids.values(), F.col("id").alias("member_id")))
    return made


def common_share(a: Column, b: Column) -> Column:
    """Share of common words of two word lists; null if either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def core_strength(x: Column, y: Column, overlap: Column) -> Column:
    """exact, strong (nearly contained, or three quarters of the words), weak; missing without a core."""
    short, long = F.least(F.length(x), F.length(y)), F.greatest(F.length(x), F.length(y))
    nearly = (F.contains(x, y) | F.contains(y, x)) & (short >= 5) & (short / long >= 0.70)
    return F.when((x == "") | (y == ""), "missing").when(x == y, "exact").when(nearly, "strong").when(F.coalesce(overlap >= 0.75, F.lit(False)), "strong").otherwise("weak")


def name_strength(a: Column, b: Column) -> Column:
    x, y = company_core(a), company_core(b)
    return core_strength(x, y, token_jaccard(x, y))


def place_of(x: Column, y: Column) -> Column:
    return F.when((x == "") | (y == ""), "missing").when(x == y, "match").otherwise("conflict")


def place_result(a: Column, b: Column) -> Column:
    return place_of(normalize_text(a), normalize_text(b))


def address_of(overlap: Column) -> Column:
    return F.when(overlap.isNull(), "missing").when(overlap >= 0.5, "strong").when(overlap >= 0.2, "consistent").when(overlap < 0.05, "conflict").otherwise("consistent")


def address_result(a: Column, b: Column) -> Column:
    return address_of(token_jaccard(a, b))


def match_class(name: Column, district: Column, upazila: Column, address: Column, several: Column | None = None) -> Column:
    """The class of a pair by the evidence on it; ``several``: other candidates are as good."""
    conflict = (district == "conflict") | (upazila == "conflict") | (address == "conflict")
    made = F.when(~name.isin("exact", "strong"), "NO_MATCH").when(conflict, "ORGANIZATION_ONLY")
    made = made.when((district == "match") & ((upazila == "match") | (address == "strong")), "EXACT_SITE").when((district == "match") & address.isin("consistent", "missing"), "PROBABLE_SITE").otherwise("ORGANIZATION_ONLY")
    return made if several is None else F.when(several, "AMBIGUOUS").otherwise(made)


def prepared(rows: DataFrame, prefix: str) -> DataFrame:
    """name, address, district and upazila with their normalized forms, which pairs then compare: once per row, not per pair."""
    core = company_core(F.col("name"))
    return rows.select(
        *[c for c in rows.columns if c not in ("name", "address", "district", "upazila")], *[F.col(c).alias(prefix + c) for c in ("name", "address", "district", "upazila")],
        core.alias(prefix + "core"), tokens(F.col("address")).alias(prefix + "address_words"),
        normalize_text(F.col("district")).alias(prefix + "district_key"), normalize_text(F.col("upazila")).alias(prefix + "upazila_key"),
    )


def with_evidence(pairs: DataFrame, t: str = "t_", r: str = "r_") -> DataFrame:
    """Evidence columns and the class of pairs of prepared rows with name_result and overlap; directories of organisations never prove a site."""
    c = F.col
    made = pairs.withColumn("address_overlap", common_share(c(f"{t}address_words"), c(f"{r}address_words")))
    made = made.withColumns({
        "district_result": place_of(c(f"{t}district_key"), c(f"{r}district_key")),
        "upazila_result": place_of(c(f"{t}upazila_key"), c(f"{r}upazila_key")), "address_result": address_of(c("address_overlap")),
    })
    raw = match_class(c("name_result"), c("district_result"), c("upazila_result"), c("address_result"))
    ok = eligible(c("source"), c("sector_family"))
    capped = F.when(raw.isin("EXACT_SITE", "PROBABLE_SITE") & (linkage(c("source")) == "ORGANIZATION"), "ORGANIZATION_ONLY").otherwise(raw)
    return made.withColumn("match_type", F.when(ok, capped).otherwise("NO_MATCH")).withColumn("site_level_match", c("match_type").isin("EXACT_SITE", "PROBABLE_SITE"))


def evidence_rows(pairs: DataFrame, t: str = "t_", r: str = "r_") -> DataFrame:
    """Five rows of evidence per pair: what was compared and how it came out."""
    kinds = [("NAME", "name", "name_result"), ("DISTRICT", "district", "district_result"), ("UPAZILA", "upazila", "upazila_result"), ("ADDRESS", "address", "address_result")]
    rows = [F.struct(F.lit(k).alias("evidence_type"), F.col(t + c).alias("register_value"), F.col(r + c).alias("external_value"), F.col(x).alias("result")) for k, c, x in kinds]
    rows.append(F.struct(F.lit("SOURCE_LINKAGE").alias("evidence_type"), F.lit(None).cast("string").alias("register_value"), F.col("source").alias("external_value"), linkage(F.col("source")).alias("result")))
    return pairs.select("target_id", "record_id", F.explode(F.array(*rows)).alias("e")).select("target_id", "record_id", "e.*")


def priority() -> Column:
    """P1 to P5 of a pair with evidence, null if it isn't to be shortlisted."""
    name, c = F.col("name_result"), F.col
    support = (c("district_result") == "match") | (c("upazila_result") == "match") | c("address_result").isin("strong", "consistent")
    firm = ((c("district_result") == "match") & (c("upazila_result") == "match")) | (c("address_result") == "strong")
    return F.when((name == "exact") & support, 1).when(name == "exact", 2).when((name == "strong") & support, 3).when(name == "strong", 4).when((name == "weak") & firm & (F.coalesce(c("overlap"), F.lit(0.0)) >= 0.40), 5)


def shortlist(pairs: DataFrame, k: int = 5) -> DataFrame:
    """The k best pairs of each target: priority, overlap, key, id."""
    ranked = pairs.withColumn("priority", priority()).filter("priority is not null")
    w = Window.partitionBy("target_id").orderBy("priority", F.coalesce(F.col("overlap"), F.lit(0.0)).desc(), "external_key", "record_id")
    return ranked.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def resolve(targets: DataFrame, short: DataFrame) -> DataFrame:
    """The outcome of each target: AUTO_SELECTED by its only positive site, else by its only
    positive organisation; several are AMBIGUOUS; others need review or have no candidate."""
    site, org = F.col("match_type").isin("EXACT_SITE", "PROBABLE_SITE"), F.col("match_type") == "ORGANIZATION_ONLY"
    made = short.groupBy("target_id").agg(F.count("*").alias("candidates"), F.count_if(site).alias("sites"), F.count_if(org).alias("organizations"), F.min(F.when(site, F.col("record_id"))).alias("site"), F.min(F.when(org, F.col("record_id"))).alias("organization"))
    rows = targets.select("target_id").distinct().join(made, "target_id", "left")
    n, s, o = (F.coalesce(F.col(x), F.lit(0)) for x in ("candidates", "sites", "organizations"))
    outcome = F.when(n == 0, "NO_STAGED_CANDIDATE").when(s == 1, "AUTO_SELECTED").when(s > 1, "AMBIGUOUS").when(o == 1, "AUTO_SELECTED").when(o > 1, "AMBIGUOUS").otherwise("REVIEW_REQUIRED")
    return rows.select("target_id", n.alias("candidates"), outcome.alias("outcome"), F.when(outcome == "AUTO_SELECTED", F.coalesce(F.when(s == 1, F.col("site")), F.col("organization"))).alias("selected_record"))


#: Words that may be in the table of frequent ones; others count as equally rare.
FREQUENT_WORDS = 100_000
#: Names contained in one another are that much alike in length, and at least so long.
CONTAINED_SHARE, CONTAINED_LENGTH = 0.70, 5


def word_prefixes(cores: DataFrame, frequent: DataFrame, least: float) -> DataFrame:
    """(core, n, place, word): of each core's n words, rarest first, as many as overlap ``least`` demands.

    Two sets of a and b words whose share of common words is ``least`` or more have a common word
    among the first a - ceil(least a) + 1 and b - ceil(least b) + 1 of any one order of words.
    """
    words = cores.select("core", tokens(F.col("core")).alias("words")).select("core", F.size("words").alias("n"), F.explode("words").alias("word"))
    ranked = words.join(F.broadcast(frequent), "word", "left")  # FREQUENT_WORDS rows at most
    order = F.sort_array(F.collect_list(F.struct(F.coalesce("names", F.lit(0)).alias("names"), "word")))
    sets = ranked.groupBy("core", "n").agg(order.alias("words"))
    wanted = F.col("n") - F.ceil(F.col("n") * least - 1e-9).cast("int") + 1
    return sets.select("core", "n", F.posexplode(F.slice("words", 1, wanted)).alias("place", "w")).select("core", "n", "place", "w.word")


def overlap_pairs(t: DataFrame, r: DataFrame, least: float) -> DataFrame:
    """(t_core, r_core) that may share ``least`` of their words: prefix, length and position filters."""
    words = t.union(r).select(F.explode(tokens(F.col("core"))).alias("word")).groupBy("word").agg(F.count("*").alias("names"))
    frequent = words.filter("names > 2").orderBy(F.desc("names"), "word").limit(FREQUENT_WORDS)
    x, y = word_prefixes(t, frequent, least).alias("x"), word_prefixes(r, frequent, least).alias("y")
    n, m = F.col("x.n"), F.col("y.n")
    alike = (n >= F.ceil(m * least - 1e-9)) & (m >= F.ceil(n * least - 1e-9))
    # the first common word of a pair leaves room for the rest of what it has to share
    room = 1 + F.least(n - F.col("x.place"), m - F.col("y.place")) - 1 >= (n + m) * (least / (1 + least)) - 1e-9
    return x.join(y, (F.col("x.word") == F.col("y.word")) & alike & room).select(F.col("x.core").alias("t_core"), F.col("y.core").alias("r_core"))


def _gram(bits: Column) -> Column:
    """Length of the piece that stands for names of 2^bits to 2^(bits + 1) - 1 characters: it lies in all that is contained in one."""
    return F.greatest(F.lit(3), F.floor(F.pow(F.lit(2.0), bits) * (2 * CONTAINED_SHARE - 1) + 1e-9)).cast("int")


def _bits(n: Column) -> Column:
    return F.length(F.bin(n)) - 1


def middles(cores: DataFrame) -> DataFrame:
    """(core, key): the piece in the middle of a name. Any part of the name of 70 % of its length has it."""
    n, core = F.length("core"), F.col("core")
    rows = cores.filter(n >= CONTAINED_LENGTH).withColumn("bits", _bits(n)).withColumn("q", _gram(F.col("bits")))
    start = F.floor((n - F.col("q")) / 2).cast("int")
    return rows.select("core", F.concat_ws(":", F.col("bits").cast("string"), F.substring(core, start + 1, F.col("q"))).alias("key"))


def possible_middles(cores: DataFrame) -> DataFrame:
    """(core, key): the pieces of a name that may be the middle of one which contains it."""
    n, core = F.length("core"), F.col("core")
    longest = F.floor(n / CONTAINED_SHARE + 1e-9).cast("int")
    rows = cores.filter(n >= CONTAINED_LENGTH).select("core", F.explode(F.sequence(_bits(n), _bits(longest))).alias("bits"))
    rows = rows.withColumn("q", _gram(F.col("bits")))
    most = F.least(longest, F.shiftleft(F.lit(1), 1) * F.pow(F.lit(2.0), F.col("bits")).cast("int") - 1)
    last = F.floor((most - F.col("q")) / 2).cast("int")
    rows = rows.withColumns({"first": F.greatest(F.lit(0), n - most + last), "last": F.least(n - F.col("q"), last)}).filter("first <= last")
    at = rows.select("core", "bits", "q", F.explode(F.sequence("first", "last")).alias("at"))
    return at.select("core", F.concat_ws(":", F.col("bits").cast("string"), F.substring(core, F.col("at") + 1, F.col("q"))).alias("key")).distinct()


def contained_pairs(t: DataFrame, r: DataFrame) -> DataFrame:
    """(t_core, r_core) one of which contains the other and is not much longer."""
    made = []
    for whole, part, names in ((t, r, ("t_core", "r_core")), (r, t, ("r_core", "t_core"))):
        x, y = middles(whole).alias("x"), possible_middles(part).alias("y")
        holds = F.contains(F.col("x.core"), F.col("y.core")) & (F.length("y.core") / F.length("x.core") >= CONTAINED_SHARE)
        made.append(x.join(y, (F.col("x.key") == F.col("y.key")) & holds).select(F.col("x.core").alias(names[0]), F.col("y.core").alias(names[1])).select("t_core", "r_core"))
    return made[0].union(made[1])


def core_candidates(targets: DataFrame, records: DataFrame, least: float = 0.40) -> DataFrame:
    """(t_core, r_core): pairs that are equal, may share ``least`` of their words, or contain one another."""
    t = targets.select(F.col("t_core").alias("core")).filter("core <> ''").distinct()
    r = records.select(F.col("r_core").alias("core")).filter("core <> ''").distinct()
    equal = t.join(r, "core").select(F.col("core").alias("t_core"), F.col("core").alias("r_core"))
    return equal.union(overlap_pairs(t, r, least)).union(contained_pairs(t, r)).distinct()


def similar_cores(targets: DataFrame, records: DataFrame, least: float = 0.40) -> DataFrame:
    """Pairs of cores that block (equal, or a common word) and are exact, strong or share ``least`` of their words.

    The same rows as ``core_pairs`` filtered by that, without making its pairs: a frequent word
    joins only names that are short of rarer ones.
    """
    t, r = F.col("t_core"), F.col("r_core")
    # words are taken once per core, not once per pair
    words = [rows.select(core).distinct().withColumn(f"__{core}", tokens(F.col(core))) for rows, core in ((targets, "t_core"), (records, "r_core"))]
    made = core_candidates(targets, records, least).join(words[0], "t_core").join(words[1], "r_core")
    made = made.withColumn("overlap", common_share(F.col("__t_core"), F.col("__r_core"))).withColumn("name_result", core_strength(t, r, F.col("overlap"))).drop("__t_core", "__r_core")
    blocks = (F.col("name_result") == "exact") | F.coalesce(F.col("overlap") > 0, F.lit(False))
    return made.filter(blocks & (F.col("name_result").isin("exact", "strong") | (F.coalesce(F.col("overlap"), F.lit(0.0)) >= least)))


#: What the evidence on a pair depends on; rows alike in it have the same evidence.
_T_PROFILE = ("sector_family", "t_core", "t_address_words", "t_district_key", "t_upazila_key")
_R_PROFILE = ("source", "r_core", "r_address_words", "r_district_key", "r_upazila_key")


def _profiled(targets: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    left = prepared(targets.select("target_id", "sector_family", "name", "address", "district", "upazila"), "t_")
    right = prepared(records.select("record_id", "source", "external_key", "name", "address", "district", "upazila"), "r_")
    same = lambda c: F.array_sort(c) if c.endswith("words") else F.col(c)
    return left.withColumn("t_profile", F.struct(*[same(c).alias(c) for c in _T_PROFILE])), right.withColumn("r_profile", F.struct(*[same(c).alias(c) for c in _R_PROFILE]))


#: Least shares of common words: of a strong name, of a weak one that is shortlisted, and of a strong address.
STRONG_NAME, WEAK_NAME, STRONG_ADDRESS = 0.75, 0.40, 0.5


def role_keys(sets: DataFrame, least: float) -> DataFrame:
    """``sets`` (words) with t_keys and r_keys: two sets of which one as t and one as r share ``least`` of their words have a key in common.

    A key is a word and which side has no more words than the other. Of n words, rarest first, the
    larger set needs as many as ``word_prefixes`` gives; the smaller one only the first
    n - ceil(2 least / (1 + least) n) + 1, as its sum with the larger is 2 n at least.
    """
    sets = sets.select("words").distinct()
    single = sets.select("words", F.explode("words").alias("word"))
    frequent = single.groupBy("word").agg(F.count("*").alias("names")).filter("names > 2").orderBy(F.desc("names"), "word").limit(FREQUENT_WORDS)
    order = F.sort_array(F.collect_list(F.struct(F.coalesce("names", F.lit(0)).alias("names"), "word")))
    ranked = single.join(F.broadcast(frequent), "word", "left").groupBy("words").agg(F.transform(order, lambda x: x["word"]).alias("__by"))  # FREQUENT_WORDS rows at most
    n = F.size("words")
    first = lambda share: F.slice("__by", 1, n - F.ceil(n * share - 1e-9).cast("int") + 1)
    small, large = first(2 * least / (1 + least)), first(least)
    keys = lambda a, b: F.concat(F.transform(a, lambda w: F.concat(F.lit("<"), w)), F.transform(b, lambda w: F.concat(F.lit(">"), w)))
    return ranked.select("words", keys(small, large).alias("t_keys"), keys(large, small).alias("r_keys"))


def firm_weak_pairs(t: DataFrame, r: DataFrame) -> DataFrame:
    """(t_profile, r_profile, overlap, name_result) of weak names that ``priority`` shortlists: they share
    ``WEAK_NAME`` of their words and the place is the same or the address strong.

    A pair is found by a word of the name together with the place or with a word of the address, so
    a word that all names have doesn't make all pairs.
    """
    words = t.select(tokens(F.col("t_core")).alias("words")).union(r.select(tokens(F.col("r_core")).alias("words")))
    addresses = t.select(F.col("t_address_words").alias("words")).union(r.select(F.col("r_address_words").alias("words")))
    names, lines = role_keys(words, WEAK_NAME), role_keys(addresses, STRONG_ADDRESS)

    def side(rows: DataFrame, x: str) -> DataFrame:
        c = lambda name: F.col(f"{x}_{name}")
        rows = rows.select(f"{x}_profile", f"{x}_profile.*").withColumn("words", tokens(c("core")))
        rows = rows.join(names.select("words", F.col(f"{x}_keys").alias("__name")), "words").withColumnRenamed("words", f"{x}_words")
        rows = rows.withColumn("words", c("address_words")).join(lines.select("words", F.col(f"{x}_keys").alias("__line")), "words", "left")
        placed = F.when((c("district_key") != "") & (c("upazila_key") != ""), F.array(F.concat_ws("\n", F.lit("p"), c("district_key"), c("upazila_key"))))
        others = F.concat(F.coalesce(placed, F.array().cast("array<string>")), F.coalesce("__line", F.array().cast("array<string>")))
        return rows.withColumn("__other", F.explode(others)).select(f"{x}_profile", f"{x}_core", f"{x}_words", F.explode("__name").alias("__word"), "__other")

    overlap = common_share(F.col("t_words"), F.col("r_words"))
    made = side(t, "t").join(side(r, "r"), ["__word", "__other"]).select("t_profile", "r_profile", "t_core", "r_core", "t_words", "r_words").distinct()
    made = made.withColumn("overlap", overlap).withColumn("name_result", core_strength(F.col("t_core"), F.col("r_core"), F.col("overlap")))
    return made.filter((F.col("name_result") == "weak") & (F.col("overlap") >= WEAK_NAME)).select("t_profile", "r_profile", "overlap", "name_result")


def profile_pairs(left: DataFrame, right: DataFrame, listed_only: bool = False) -> DataFrame:
    """Evidence on pairs of profiles (t_profile, r_profile) with n_t and n_r, how many rows have each.

    Pairs are those of ``similar_cores``; with ``listed_only`` weak names without a firm place or
    address, which are never shortlisted, aren't made.
    """
    t = left.groupBy("t_profile").agg(F.count("*").alias("n_t")).select("*", "t_profile.*")
    r = right.groupBy("r_profile").agg(F.count("*").alias("n_r")).select("*", "r_profile.*")
    if not listed_only:
        full = t.join(similar_cores(t, r), "t_core").join(r, "r_core")
    else:
        close = similar_cores(t, r, STRONG_NAME).filter(F.col("name_result").isin("exact", "strong"))
        firm = firm_weak_pairs(t, r).join(t, "t_profile").join(r, "r_profile")
        full = t.join(close, "t_core").join(r, "r_core").unionByName(firm)
    return with_evidence(full.filter(eligible(F.col("source"), F.col("sector_family"))))


def shortlisted(left: DataFrame, right: DataFrame, pairs: DataFrame, k: int = 5) -> DataFrame:
    """The k best records of each target profile: of records that are alike only the first k can be among them."""
    first = Window.partitionBy("r_profile").orderBy("external_key", "record_id")
    few = right.withColumn("__at", F.row_number().over(first)).filter(F.col("__at") <= k).drop("__at", *_R_PROFILE)
    ranked = pairs.withColumn("priority", priority()).filter("priority is not null").join(few, "r_profile")
    best = Window.partitionBy("t_profile").orderBy("priority", F.coalesce(F.col("overlap"), F.lit(0.0)).desc(), "external_key", "record_id")
    short = ranked.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return left.drop(*_T_PROFILE).join(short, "t_profile").drop("t_profile", "r_profile", "n_t", "n_r")


def candidate_run(targets: DataFrame, records: DataFrame, k: int = 5) -> tuple[DataFrame, DataFrame]:
    """Shortlist and outcomes of all targets (target_id, name, address, district, upazila, sector_family)
    against records (record_id, source, external_key, name, address, district, upazila), one plan.

    Pairs are made of profiles, not of rows: rows with one name in one place have the same
    evidence, and only the k first of like records can be shortlisted.
    """
    left, right = _profiled(targets, records)
    short = shortlisted(left, right, profile_pairs(left, right, listed_only=True), k)
    return short, resolve(targets, short)


#: What a run keeps of a shortlisted pair.
KEPT_EVIDENCE = (
    "record_id", "source", "external_key", "rank", "priority", "match_type", "site_level_match", "name_result", "overlap", "district_result", "upazila_result", "address_result", "address_overlap",
    "t_name", "t_district", "t_upazila", "t_address", "r_name", "r_district", "r_upazila", "r_address",
)
OUTCOMES = ("AUTO_SELECTED", "AMBIGUOUS", "REVIEW_REQUIRED", "NO_STAGED_CANDIDATE")


def audited_run(targets: DataFrame, records: DataFrame, path: str, k: int = 5, judged: bool = True) -> tuple[DataFrame, dict[str, int]]:
    """The run written to ``path``, a row per target (target_id, candidates, outcome, selected_record, shortlist), and its counts.

    One job writes and counts: pairs of rows that were judged, pairs of profiles that stand for
    them, shortlisted pairs, targets and each outcome. ``shortlist`` has k candidates at most.
    Without ``judged`` the two counts of pairs are left out, and with them all pairs of alike names
    that can't be shortlisted; the rows are the same.
    """
    left, right = _profiled(targets, records)
    audit = Audit()
    pairs = profile_pairs(left, right, listed_only=not judged)
    if judged:
        pairs = audit.on(pairs, pairs=F.sum(F.col("n_t") * F.col("n_r")), profile_pairs=F.count("*"))
    short = audit.on(shortlisted(left, right, pairs, k), shortlisted=F.count("*"))
    listed = short.groupBy("target_id").agg(F.array_sort(F.collect_list(F.struct("rank", *[c for c in KEPT_EVIDENCE if c != "rank"]))).alias("shortlist"))  # k a target
    rows = targets.select("target_id").distinct().join(listed, "target_id", "left")
    sites = F.filter("shortlist", lambda x: x["match_type"].isin("EXACT_SITE", "PROBABLE_SITE"))
    organizations = F.filter("shortlist", lambda x: x["match_type"] == "ORGANIZATION_ONLY")
    n, s, o = (F.coalesce(F.nullif(F.size(x), F.lit(-1)), F.lit(0)) for x in (F.col("shortlist"), sites, organizations))
    outcome = F.when(n == 0, "NO_STAGED_CANDIDATE").when(s == 1, "AUTO_SELECTED").when(s > 1, "AMBIGUOUS").when(o == 1, "AUTO_SELECTED").when(o > 1, "AMBIGUOUS").otherwise("REVIEW_REQUIRED")
    only = F.when(s == 1, F.get(sites, F.lit(0))["record_id"]).otherwise(F.get(organizations, F.lit(0))["record_id"])
    made = rows.select("target_id", n.alias("candidates"), outcome.alias("outcome"), F.when(outcome == "AUTO_SELECTED", only).alias("selected_record"), "shortlist")
    counted = audit.on(made, targets=F.count("*"), **{x.lower(): F.count_if(F.col("outcome") == x) for x in OUTCOMES})
    counted.write.parquet(path)
    return targets.sparkSession.read.schema(made.schema).parquet(path), {name: n or 0 for name, n in audit.counts().items()}


def selected_pairs(made: DataFrame) -> DataFrame:
    """The pair that each automatically selected target of an audited run stands for, with its evidence."""
    one = made.filter("outcome = 'AUTO_SELECTED'").select("target_id", "selected_record", F.explode("shortlist").alias("x"))
    return one.filter(F.col("x.record_id") == F.col("selected_record")).select("target_id", "x.*")


def request_order(requests: DataFrame) -> DataFrame:
    """Requests with their ``sequence_no``; keys are numbers as text."""
    return numbered(requests, [F.length("source_key"), "source_key", "source", "detail_url"], "sequence_no")


def detail_requests(pairs: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Profiles to fetch for pairs (target_id, record_id): each of the index once, and for which targets it is asked.

    requests: source, source_key, detail_url, targets (their number); asked: source, source_key, target_id.
    """
    hit = pairs.select("target_id", "record_id").distinct().join(index.select("record_id", "source", "source_key", "detail_url"), "record_id")
    return hit.groupBy("source", "source_key", "detail_url").agg(F.countDistinct("target_id").alias("targets")), hit.select("source", "source_key", "target_id").distinct()


def apply_resolutions(outcomes: DataFrame, short: DataFrame, applied: DataFrame | None) -> DataFrame:
    """New links for automatically selected pairs; what is applied already stays as it is."""
    chosen = outcomes.filter("outcome = 'AUTO_SELECTED'").select("target_id", F.col("selected_record").alias("record_id"))
    links = chosen.join(short, ["target_id", "record_id"]).select("target_id", "record_id", "source", "match_type", "site_level_match")
    return links if applied is None else links.join(applied.select("target_id", "record_id"), ["target_id", "record_id"], "left_anti")


def attach_observations(links: DataFrame, typed: DataFrame) -> DataFrame:
    """Typed observations of linked records. Facts of a site need a link to the site; only positive links attach."""
    positive = links.filter(F.col("match_type").isin("EXACT_SITE", "PROBABLE_SITE", "ORGANIZATION_ONLY"))
    made = positive.join(typed, "record_id").filter((F.col("scope") == "ORGANIZATION") | F.col("site_level_match"))
    return made.withColumn("site_attributable", (F.col("scope") == "SITE") & F.col("site_level_match"))


def coverage(targets: DataFrame, links: DataFrame) -> DataFrame:
    """Per source: eligible targets, records linked, targets by match type, and rates (latest links)."""
    types = ("EXACT_SITE", "PROBABLE_SITE", "ORGANIZATION_ONLY", "AMBIGUOUS", "NO_MATCH")
    asked = targets.groupBy("source").agg(F.count("*").alias("eligible"))
    made = links.groupBy("source").agg(F.countDistinct("record_id").alias("linked_records"), *[F.count_if(F.col("match_type") == t).alias(t.lower()) for t in types])
    made = asked.join(made, "source", "left").fillna(0)
    sites = F.col("exact_site") + F.col("probable_site")
    return made.withColumns({"site_match_rate": F.coalesce(F.try_divide(sites, F.col("eligible")), F.lit(0.0)), "any_positive_link_rate": F.coalesce(F.try_divide(sites + F.col("organization_only"), F.col("eligible")), F.lit(0.0))})
