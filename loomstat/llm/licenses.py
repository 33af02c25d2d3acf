"""License scan by canonical digest lookup, in DataFrame functions only.

The canonical form of a text: lines that state a copyright or reserve all rights are left out,
and the numbers and bullets of lists; letters are lowered, every run of other characters than
letters and digits is one blank, and equivalent spellings are brought to one. The form of an
entire text also leaves out a heading that only names a licence ("MIT License") and doesn't
depend on how lines are wrapped. The SHA-256 digests of canonical forms are hash-joined with
those of known licence texts: full texts in ``license_texts``, notices in ``NOTICES``. Looked up
are the entire text of a document, and each of its lines as a text of its own (notices such as
"Released under the MIT License." stand on a line of their own).

The table of known texts is a parameter of fixed size (``known``), so it is broadcast; only
lines that hit leave the first stage, so nothing else is dealt out.

Defined cases: a null text has no licence; ids may be null or repeated (a row each; rows that
share id and text share their findings); a text whose canonical form is empty never hits; an
empty table gives an empty result; other columns are not looked at. A licence whose wording was
changed, or that stands inside a longer text, isn't an entire text and isn't found.
"""

from __future__ import annotations

from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Equivalent spellings, as in licence matching guidelines.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"),
    ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"), ("catalogue", "catalog"), ("centre", "center"), ("emphasised", "emphasized"),
    ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"),
    ("labelled", "labeled"), ("labour", "labor"), ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("recognised", "recognized"), ("signalling", "signaling"), ("sublicence", "sublicense"), ("sublicences", "sublicenses"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
)

#: Equivalent spellings of two words.
PHRASES = (("copyright owner", "copyright holder"), ("non commercial", "noncommercial"), ("per cent", "percent"), ("sub license", "sublicense"))

#: Fixed values: (licence, notice).
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-3-Clause", "Released under the 3-Clause BSD License."),
)

# The patterns mean the same in Java and RE2. Lines that state a copyright (with a sign, a year, a
# place for one, or nothing but a name) or reserve all rights, then numbers and bullets of lists.
_MARK = r"(?:[Cc]opyright|COPYRIGHT|\([Cc]\)|©)[^\p{L}\n]*(?:\([Cc]\)|©|[0-9]|[\[<{](?:yyyy|YYYY|year|YEAR))"
_NAME = r"Copyright(?:[ \t]+\p{Lu}[\p{L}.,&-]*){1,8}[^\p{L}\n]*$"
_RIGHTS = r"(?:[Aa]ll [Rr]ights [Rr]eserved|ALL RIGHTS RESERVED)[^\p{L}\n]*$"
DROPPED = rf"(?m)^[^\p{{L}}\p{{N}}\n©]*(?:{_MARK}.*|{_NAME}|{_RIGHTS})"
MARKERS = r"(?m)^[ \t]*(?:[0-9]{1,2}[.)]|\([A-Za-z0-9]\))[ \t]+"
#: In the lowered form: a first line of at most six words that ends in "license" and perhaps one word in brackets.
HEADING = r"\A[ \n]*(?:[\p{L}\p{N}]+ +){0,5}license(?: +[\p{L}\p{N}]{1,8})? *\n"

# A quick test whether a text has any of the words: three classes of first letters turn most words away before the words are tried.
_STARTS = sorted({a[:2] for a, _ in SPELLINGS})
_FIRST = "".join(f"[{''.join(sorted({a[k] for a, _ in SPELLINGS}))}]" for k in range(3))
_SPELT = f"(?={_FIRST})(?:" + "|".join(f"{x}(?:{'|'.join(a[2:] for a, _ in SPELLINGS if a[:2] == x)})" for x in _STARTS) + ")"
_PHRASED = "|".join(a for a, _ in PHRASES)
# Other characters than letters and digits: ASCII ones (a class that Java tests by table), and all others.
_ASCII_GAPS = r"[\x00-\x09\x0b-\x2f\x3a-\x60\x7b-\x7f]+"
_OTHER_GAP = r"[^\x00-\x7f\p{L}\p{N}]"


@cache
def known_texts() -> tuple[tuple[str, str], ...]:
    """(licence, text): the notices and the full texts."""
    files = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    return NOTICES + tuple((f.stem.removesuffix("-Regents"), f.read_text(encoding="utf-8")) for f in files)


# Every step below is a projection of its own: what it uses more than once is worked out once.


def _replaced(form: str, pairs) -> Column:
    # a fold over whole texts: as nested calls the generated code would grow too large to compile
    listed = F.array(*[F.struct(F.lit(f" {a} ").alias("a"), F.lit(f" {b} ").alias("b")) for a, b in pairs])
    return F.aggregate(listed, F.col(form), lambda made, pair: F.replace(made, pair["a"], pair["b"]))


def _phrases(rows: DataFrame, form: str) -> DataFrame:
    """``form`` has one blank around each word; of phrases in a row every second shares a blank, hence twice."""
    return rows.withColumn(form, F.when(F.rlike(form, F.lit(f" (?:{_PHRASED}) ")), _replaced(form, PHRASES * 2)).otherwise(F.col(form)))


def _with_forms(rows: DataFrame) -> DataFrame:
    """``text`` gives way to ``lowered`` (lines in canonical form but for phrases, a blank before and after each word) and ``whole``."""
    kept = F.regexp_replace(F.regexp_replace("text", f"(?d){DROPPED}", ""), f"(?d){MARKERS}", "")
    rows = rows.withColumn("lowered", F.regexp_replace(F.lower(kept), _ASCII_GAPS, "  ")).drop("text")
    rows = rows.withColumn("lowered", F.when(F.rlike("lowered", F.lit(_OTHER_GAP)), F.regexp_replace("lowered", f"(?: |{_OTHER_GAP})+", "  ")).otherwise(F.col("lowered")))
    rows = rows.withColumn("lowered", F.concat(F.lit(" "), F.replace(F.col("lowered"), F.lit("\n"), F.lit(" \n ")), F.lit(" ")))
    rows = rows.withColumn("lowered", F.when(F.rlike("lowered", F.lit(f" (?:{_SPELT}) ")), _replaced("lowered", SPELLINGS)).otherwise(F.col("lowered")))
    form = F.replace(F.regexp_replace("lowered", HEADING, " "), F.lit("\n"), F.lit(" "))
    for _ in range(3):
        form = F.replace(form, F.lit("  "), F.lit(" "))
    rows = rows.withColumn("whole", form)
    rows = rows.withColumn("whole", F.when(F.contains("whole", F.lit("  ")), F.regexp_replace("whole", " +", " ")).otherwise(F.col("whole")))  # after empty lines
    return _phrases(rows, "whole").withColumn("whole", F.trim("whole"))


def known_digests(spark: SparkSession, known=None) -> DataFrame:
    """(digest, license) of the known texts; each text as a whole."""
    rows = spark.createDataFrame([(name, text) for name, text in known or known_texts()], "license string, text string")
    return _with_forms(rows).filter("whole <> ''").select(F.sha2("whole", 256).alias("digest"), "license").distinct()


def scan(docs: DataFrame, known=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, whole_license (of the entire text), n_lines (that are a known text), licenses (sorted, joined by commas)."""
    table = known_digests(docs.sparkSession, known)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = _with_forms(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")))
    # position 0 is the entire text, the others are its lines
    units = rows.select("doc_id", "text_hash", F.posexplode(F.concat(F.array("whole"), F.split("lowered", "\n"))).alias("pos", "form"))
    units = _phrases(units.withColumn("form", F.replace(F.col("form"), F.lit("  "), F.lit(" "))), "form")
    hits = units.select("doc_id", "text_hash", "pos", F.sha2(F.trim("form"), 256).alias("digest")).join(F.broadcast(table), "digest")  # the known texts are a parameter of fixed size
    # rows that repeat id and text share their findings
    found = hits.groupBy("doc_id", "text_hash").agg(
        F.min(F.when(F.col("pos") == 0, F.col("license"))).alias("whole_license"), F.count_distinct(F.when(F.col("pos") > 0, F.col("pos"))).alias("n_lines"),
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
    ).withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"})
    every = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"))
    joined = every.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash")), "left")
    return joined.select("doc_id", "whole_license", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"), F.coalesce("licenses", F.lit("")).alias("licenses"))


def oracle_sql(known=None) -> str:
    """The same for DuckDB."""
    quoted = [(n, t.replace("'", "''")) for n, t in known or known_texts()]
    values = ", ".join(f"('{n}', '{t}')" for n, t in quoted)

    def replaced(x: str, pairs) -> str:
        for a, b in pairs:
            x = f"replace({x}, ' {a} ', ' {b} ')"
        return x

    kept = f"regexp_replace(regexp_replace(text, '{DROPPED}', '', 'g'), '{MARKERS}', '', 'g')"
    lowered = replaced(f"' ' || replace(regexp_replace(lower({kept}), '[^\\p{{L}}\\p{{N}}\\n]+', '  ', 'g'), chr(10), ' ' || chr(10) || ' ') || ' '", SPELLINGS)
    whole = f"trim({replaced(f"regexp_replace(regexp_replace(lowered, '{HEADING}', ' '), '[ \\n]+', ' ', 'g')", PHRASES * 2)}, ' ')"
    line = f"trim({replaced("replace(x, '  ', ' ')", PHRASES * 2)}, ' ')"
    return f"""
WITH known AS (SELECT DISTINCT sha256({whole}) AS digest, license FROM (SELECT license, {lowered} AS lowered FROM (VALUES {values}) k(license, text)) WHERE {whole} <> ''),
d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT n, {lowered} AS lowered FROM d),
u AS (SELECT n, TRUE AS whole, {whole} AS form FROM l UNION ALL SELECT n, FALSE, {line} FROM (SELECT n, unnest(string_split(lowered, chr(10))) AS x FROM l)),
h AS (SELECT n, whole, license FROM u JOIN known ON known.digest = sha256(form)),
f AS (SELECT n, min(license) FILTER (WHERE whole) AS whole_license, count(*) FILTER (WHERE NOT whole) AS n_lines, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM h GROUP BY n)
SELECT doc_id, whole_license, coalesce(n_lines, 0) AS n_lines, coalesce(licenses, '') AS licenses FROM d LEFT JOIN f USING (n)
"""
