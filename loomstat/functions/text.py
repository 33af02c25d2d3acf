"""Text, number, date and URL expressions. All but NFKC are built-in functions of Spark."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from ..vocab import CORPORATE_TOKENS, GEOGRAPHY_RULES, SECTOR_RULES

#: Everything but letters, digits and underscore. Vowel signs are marks, so they part words too.
_NOT_WORD = r"[^\p{L}\p{N}_]+"
_NOT_WORD_OR_MARK = r"[^\p{L}\p{M}\p{N}_]+"


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def collapse(c: Column) -> Column:
    """Trimmed, runs of white space as one blank, lower case; null is empty."""
    return F.lower(F.trim(F.regexp_replace(_text(c), r"\s+", " ")))


def clean(c: Column) -> Column:
    """Runs of white space as one blank; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(c, r"[\s\x{00A0}]+", " ")), F.lit(""))


def normalize_text(c: Column, strict_marks: bool = False) -> Column:
    """Lower case, punctuation as blanks. ``strict_marks`` keeps combining vowel signs, so that
    names that differ only there stay apart."""
    return F.trim(F.regexp_replace(F.lower(_text(c)), _NOT_WORD_OR_MARK if strict_marks else _NOT_WORD, " "))


def company_core(c: Column, strict_marks: bool = False) -> Column:
    """``normalize_text`` without corporate words."""
    words = F.filter(F.split(normalize_text(c, strict_marks), " "), lambda w: ~w.isin(*CORPORATE_TOKENS))
    return F.array_join(words, " ")


def tokens(c: Column) -> Column:
    """Distinct words of more than one character."""
    return F.array_distinct(F.filter(F.split(normalize_text(c), " "), lambda w: F.length(w) > 1))


def token_jaccard(a: Column, b: Column) -> Column:
    """Share of common words; null if either side has none."""
    x, y = tokens(a), tokens(b)
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


@F.arrow_udf(StringType())
def nfkc(names: pa.Array) -> pa.Array:
    """Unicode compatibility composition; meant for distinct names."""
    return pa.array([None if x is None else unicodedata.normalize("NFKC", x) for x in names.to_pylist()], pa.string())


def admin_name(c: Column, compose: bool = True) -> Column:
    """A place name without punctuation and administrative words. ``compose`` applies NFKC first."""
    text = F.lower(F.trim(F.translate(nfkc(_text(c)) if compose else _text(c), "’‘`", "'''")))
    text = F.replace(F.regexp_replace(text, r"[.,;:_/\\()\[\]{}-]+", " "), F.lit("'"), F.lit(""))
    text = F.regexp_replace(text, r"\b(district|zila|zilla|upazila|upozilla|thana|division)\b", " ")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def same_text(a: Column, b: Column) -> Column:
    """Both sides say something and it is the same after ``normalize_text``."""
    x, y = normalize_text(a), normalize_text(b)
    return (x != "") & (x == y)


def ascii_digits(c: Column) -> Column:
    return F.translate(_text(c), "০১২৩৪৫৬৭৮৯", "0123456789")


def parse_int(c: Column) -> Column:
    """The first integer in Bengali or ASCII digits, commas left out."""
    return F.regexp_extract(F.replace(ascii_digits(c), F.lit(","), F.lit("")), r"\d+", 0).try_cast("long")


def split_list(c: Column) -> Column:
    """The parts of a listing, without repeats (compared by ``normalize_text``), in order."""
    parts = F.filter(F.transform(F.split(_text(c), r"\s*(?:;|\||\n|•|,\s*(?=[A-Za-z]))\s*"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: normalize_text(x) != "")
    keys = F.transform(parts, lambda x: normalize_text(x))
    return F.filter(parts, lambda x, i: F.array_position(keys, F.element_at(keys, i + 1)) == i + 1)


def product_codes(c: Column) -> Column:
    """Runs of 4 to 10 digits, without repeats, in order."""
    return F.array_distinct(F.regexp_extract_all(_text(c), F.lit(r"(?<!\d)(\d{4,10})(?!\d)"), F.lit(1)))


_SCALE = r"thousand|million|billion|k|m|bn"


def parse_number(c: Column, legacy_scale: bool = False) -> Column:
    """The first number, times a scale word after it.

    A scale word has to end there ("300 machines" is 300); ``legacy_scale`` lets it run on.
    """
    text = F.lower(_text(c))
    guard = "" if legacy_scale else r"(?!\p{L})"
    whole = rf"(?<![\p{{L}}\p{{N}}_])(\d[\d,]*(?:\.\d+)?)\s*((?:{_SCALE}){guard})?"
    number = F.replace(F.regexp_extract(text, whole, 1), F.lit(","), F.lit("")).try_cast("double")
    scale = F.regexp_extract(text, whole, 2)
    return number * F.when(scale.isin("thousand", "k"), 1e3).when(scale.isin("million", "m"), 1e6).when(scale.isin("billion", "bn"), 1e9).otherwise(1.0)


def capacity_unit(c: Column, legacy_scale: bool = False) -> Column:
    """What follows the number of a capacity."""
    guard = "" if legacy_scale else r"(?!\p{L})"
    return F.when(parse_number(c).isNotNull(), clean(F.regexp_extract(_text(c), rf"(?i)(?<![\p{{L}}\p{{N}}_])\d[\d,]*(?:\.\d+)?\s*(?:(?:{_SCALE}){guard})?\s*(.*)$", 1)))


def parse_instant(c: Column) -> Column:
    """ISO dates and times first, then year-month-day, day-month-year and year-month with - or /.

    Without an offset it is UTC (the session's zone). A year alone is no date.
    """
    text = F.trim(c.cast("string"))
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"), text.try_cast("timestamp"))
    compact = F.when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")))
    rest = [F.when(text.rlike(rule), F.try_to_timestamp(text, F.lit(form))) for rule, form in (
        (r"^\d{4}-\d{1,2}-\d{1,2}$", "y-M-d"), (r"^\d{4}/\d{1,2}/\d{1,2}$", "y/M/d"), (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-y"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/y"), (r"^\d{4}-\d{1,2}$", "y-M"))]
    return F.coalesce(iso, compact, *rest)


def url_key(url: Column, segment: str) -> Column:
    """The number after /segment/ in a path."""
    return F.nullif(F.regexp_extract(_text(url), rf"/{segment}/(\d+)(?:[/?#]|$)", 1), F.lit(""))


def url_page(url: Column) -> Column:
    """The page parameter; 1 without one, null if it is no number."""
    value = F.try_parse_url(url, F.lit("QUERY"), F.lit("page"))
    return F.when(value.isNull(), 1).otherwise(value.try_cast("int"))


def set_page(url: Column, page: Column) -> Column:
    """The URL with its page parameter set or added; other parameters stay as they are."""
    value = F.concat(F.lit("page="), page.cast("string"))
    with_page = F.regexp_replace(url, F.lit(r"(?<=[?&])page=[^&#]*"), value)
    fresh = F.regexp_replace(url, F.lit(r"#.*$"), F.lit(""))
    return F.when(url.rlike(r"[?&]page="), with_page).otherwise(F.concat(fresh, F.when(F.contains(url, F.lit("?")), F.lit("&")).otherwise(F.lit("?")), value))


def filter_url(base: str, **parameters: Column) -> Column:
    """A query string of the parameters that are not null, in the order given."""
    parts = [F.concat(F.lit(f"{k}="), F.url_encode(v.cast("string"))) for k, v in parameters.items()]
    return F.concat(F.lit(f"{base}?"), F.concat_ws("&", *parts))


def url_allowed(url: Column, hosts: list[str], prefixes: list[str]) -> Column:
    """HTTPS, one of the hosts, and a path under one of the prefixes."""
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    under = F.lit(False)
    for prefix in prefixes:
        under = under | F.startswith(path, F.lit(prefix))
    return F.coalesce((F.try_parse_url(url, F.lit("PROTOCOL")) == "https") & F.lower(F.try_parse_url(url, F.lit("HOST"))).isin(*hosts) & under, F.lit(False))


def safe_label(c: Column) -> Column:
    """Letters, digits, dot, dash and underscore; other runs become one underscore."""
    return F.regexp_replace(F.regexp_replace(_text(c), r"[^A-Za-z0-9._-]+", "_"), r"^_+|_+$", "")


def or_unknown(c: Column) -> Column:
    """Null and empty as UNKNOWN (blanks alone stay)."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("UNKNOWN"))


def rounded(c: Column, digits: int) -> Column:
    """Half up on the double as it is; the same in every engine that has floor."""
    return F.floor(c * float(10**digits) + 0.5) / float(10**digits)


@F.arrow_udf(DoubleType())
def round_to_even_4(values: pa.Array) -> pa.Array:
    """Correctly rounded to four places, ties to even; for results that must equal Python's ``round``."""
    return pa.array([None if x is None else round(x, 4) for x in values.to_pylist()], pa.float64())


def by_rules(c: Column, rules, otherwise: str) -> Column:
    """The code of the first rule of which a word is a part of the collapsed label."""
    label, made = collapse(c), F.lit(otherwise)
    for code, _, words in reversed(rules):
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(label, F.lit(" ".join(word.split()).casefold()))
        made = F.when(hit, code).otherwise(made)
    return made


def sector_family(c: Column, rules=SECTOR_RULES) -> Column:
    """For rollups: a label without a rule is UNCLASSIFIED."""
    return by_rules(c, rules, "UNCLASSIFIED")


def sampling_family(c: Column, rules=SECTOR_RULES) -> Column:
    """For sampling: a label without a rule is OTHER_MANUFACTURING."""
    return by_rules(c, rules, "OTHER_MANUFACTURING")


def geography_group(c: Column, rules=GEOGRAPHY_RULES) -> Column:
    """The group that lists the district by name, else OTHER."""
    name, made = collapse(c), F.lit("OTHER")
    for code, _, names in reversed(rules):
        if names:
            made = F.when(name.isin(*[" ".join(x.split()).casefold() for x in names]), code).otherwise(made)
    return made


def employment_band(c: Column) -> Column:
    return F.when(c.isNull(), "UNKNOWN").when(c < 50, "UNDER_50").when(c < 250, "50_249").when(c < 1000, "250_999").otherwise("1000_PLUS")


def records_on_page(total: Column, page: Column, size: Column) -> Column:
    return F.greatest(F.lit(0), F.least(size, total - (page - 1) * size))


def spread_positions(m: Column, wanted: Column) -> Column:
    """``wanted`` positions spread evenly over 1..m, ends included, halves to even, without repeats."""
    n = F.least(wanted, m)
    spread = F.array_distinct(F.transform(F.sequence(F.lit(0), n - 1), lambda i: (1 + F.bround(i * (m - 1) / F.greatest(n - 1, F.lit(1)))).cast("int")))
    return F.when(n <= 0, F.array().cast("array<int>")).when(n == 1, F.array(F.lit(1))).otherwise(spread)


def spread_pages(total: Column, wanted: Column, size: int) -> Column:
    """Pages of a listing with ``total`` rows, for about ``wanted`` rows."""
    total, wanted = F.greatest(F.coalesce(total, F.lit(0)), F.lit(0)), F.greatest(F.coalesce(wanted, F.lit(0)), F.lit(0))
    pages = F.ceil(total / size).cast("int")
    return F.when((total == 0) | (wanted == 0), F.array().cast("array<int>")).otherwise(spread_positions(pages, F.greatest(F.lit(1), F.ceil(wanted / size).cast("int"))))


def geo_ref(level: str, *codes: Column) -> Column:
    """BBS:DIV:x, BBS:DIST:x:y or BBS:UPZ:x:y:z; fails on a blank code."""
    kind = {"DIVISION": "DIV", "DISTRICT": "DIST", "UPAZILA": "UPZ"}[level]
    parts = [F.when(F.trim(_text(c)) == "", F.raise_error(F.lit(f"{level} needs all its codes")).cast("string")).otherwise(F.trim(_text(c))) for c in codes]
    return F.concat_ws(":", F.lit("BBS"), F.lit(kind), *parts)


def location_parts(c: Column) -> Column:
    """(upazila, district, division): the last three parts between commas; all null with fewer."""
    parts = F.filter(F.transform(F.split(_text(c), ","), lambda x: F.trim(x)), lambda x: x != "")
    named = [F.when(F.size(parts) >= 3, F.try_element_at(parts, F.lit(k))).alias(n) for k, n in ((-3, "upazila"), (-2, "district"), (-1, "division"))]
    return F.struct(*named)


def content_hash(*columns: Column) -> Column:
    """SHA-256 of one text, or of the JSON of several values."""
    return F.sha2(_text(columns[0]), 256) if len(columns) == 1 else F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
