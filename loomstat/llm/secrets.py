"""Secret scan with an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its text). The ledger is a table
of (blob, rule, version, spans): a row says that the blob was scanned by that version of the
rule, with the spans found (none, too). A run scans only the pairs of blob and rule version
that the ledger lacks, appends them, and joins the findings back to all paths that ever held
the blob. A changed rule gets a new version and is run alone over the known blobs.

Spans are code points, end exclusive. Matches of a rule are leftmost and not overlapping; those
whose checked group is shorter than the rule's least length are dropped. Base rules: assign,
access and hex. The method's further rules look for keys whose form names their kind.

Copies: texts are addressed and compressed in one pass, equal ones are combined per task before
they are dealt out, so a group of copies costs one scan and one row a task, and paths get their
findings by a join on the digest that Spark splits where it is skewed.

Defined cases: a null text is empty; ids may be null or repeated (a row each); an empty table
gives an empty result; other columns are not looked at. A version that a current rule hasn't
scanned is an error in ``findings``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, saved, text_of


class Rule(NamedTuple):
    kind: str
    version: int
    pattern: str
    group: int
    least: int


#: In the order in which spans with one start are listed. Patterns are ASCII: \\w, \\d and (?i:) know no other letters.
BASE_RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, r"[0-9a-f]+", 0, 16),
)
MORE_RULES = (
    Rule("private_key", 1, r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", 0, 1),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
)
RULES = BASE_RULES + MORE_RULES

_LEDGER = "blob string, rule string, version int, spans array<struct<start:long,end:long>>"
_LEDGER_ARROW = pa.schema([("blob", pa.string()), ("rule", pa.string()), ("version", pa.int32()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


@cache
def _pattern(pattern: str, least: int) -> re.Pattern:
    # a run of one class that is too short can't hold a longer one, so the least length may go into the pattern
    if re.fullmatch(r"\[[^\]\\]+\]\+", pattern):
        pattern = f"{pattern[:-1]}{{{least},}}"
    return re.compile(pattern, re.ASCII)


def spans(rule: Rule, text: str) -> list[tuple[int, int]]:
    return [x.span() for x in _pattern(rule.pattern, rule.least).finditer(text) if x.end(rule.group) - x.start(rule.group) >= rule.least]


def _address(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and compressed bytes of every text; a text that repeats within a batch comes once."""
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        raw = {hashlib.sha256(x).hexdigest(): x for x in (y.as_buffer().to_pybytes() for y in batch.column(0))}
        yield pa.RecordBatch.from_arrays([pa.array(list(raw), pa.string()), pa.array([packer.compress(x) for x in raw.values()], pa.binary())], names=["blob", "packed"])


def _scan(rules: tuple[Rule, ...]):
    by_key = {f"{r.kind}@{r.version}": r for r in rules}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[tuple] = []
            for blob, packed, keys in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                text = unpacker.decompress(packed.as_buffer()).decode("utf-8", "surrogatepass")
                for key in keys:
                    rule = by_key[key]
                    out.append((blob, rule.kind, rule.version, [{"start": a, "end": b} for a, b in spans(rule, text)]))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LEDGER_ARROW, strict=True)], schema=_LEDGER_ARROW)

    return run


class BlobLedger:
    """The ledger at a path in storage that all executors share."""

    def __init__(self, spark: SparkSession, path: str | None = None, rules: tuple[Rule, ...] = RULES) -> None:
        self.spark, self.rules = spark, rules
        self.path = path or new_path(spark, "ledger")

    def rows(self) -> DataFrame | None:
        """What the ledger holds, None before the first run."""
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        if not at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return None
        return self.spark.read.schema(_LEDGER).parquet(self.path)

    def update(self, versions: DataFrame, text_col: str = "text") -> None:
        """Scan the pairs of blob and rule version that are new in ``versions`` and append what was found.

        A run that dies before its commit leaves no row (Spark's job commit), so it can be
        repeated; a repeated run scans nothing that is in the ledger.
        """
        wanted = F.array(*[F.lit(f"{r.kind}@{r.version}") for r in self.rules])
        rows = versions.select(text_of(text_col).alias("text")).mapInArrow(_address, "blob string, packed binary")
        known = self.rows()
        if known is None:
            todo = rows.groupBy("blob").agg(F.first("packed").alias("packed")).withColumn("todo", wanted)
        else:
            # digests alone decide which texts are scanned, and for which rules
            done = known.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "rule", F.col("version").cast("string"))).alias("done"))
            once = rows.groupBy("blob").agg(F.first("packed").alias("packed"))
            todo = once.join(done, "blob", "left").withColumn("todo", F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))).filter(F.size("todo") > 0)
        todo.select("blob", "packed", "todo").mapInArrow(_scan(self.rules), _LEDGER).write.mode("append").option("compression", "zstd").parquet(self.path)

    def findings(self, versions: DataFrame, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
        """``columns`` of every row of ``versions`` with n_<base kind>, base_sha256 and spans; fails for a version that wasn't scanned."""
        order = F.create_map(*[F.lit(x) for k, r in enumerate(self.rules) for x in (r.kind, k)])
        current = F.create_map(*[F.lit(x) for r in self.rules for x in (r.kind, r.version)])
        base = [r.kind for r in BASE_RULES]
        rows = self.rows().filter(F.col("version") == current[F.col("rule")])
        listed = F.transform("spans", lambda x: F.struct(x["start"].alias("start"), order[F.col("rule")].alias("order"), x["end"].alias("end"), F.col("rule").alias("rule")))
        by_blob = rows.groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(listed)))).alias("all"), F.size(F.collect_set("rule")).alias("n_rules"))

        def of(kinds):
            return F.filter("all", lambda x: x["rule"].isin(kinds))

        def text(found):
            return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["rule"], x["start"].cast("string"), x["end"].cast("string"))), ",")

        made = by_blob.select(
            "blob", *[F.size(of([k])).cast("long").alias(f"n_{k}") for k in base],
            F.sha2(text(of(base)), 256).alias("base_sha256"), text(F.col("all")).alias("spans"), "n_rules",
        )
        made = saved(made, "findings")  # a table on both sides of the join lets Spark split the rows of a hot blob
        paths = versions.select(*[F.col(f"`{c}`") for c in columns or versions.columns], F.sha2(text_of(text_col).cast("binary"), 256).alias("blob"))
        missed = F.raise_error(F.concat(F.lit("not scanned by all rules: blob "), F.col("blob"))).cast("long")
        checked = F.when(F.coalesce("n_rules", F.lit(0)) < len(self.rules), missed).otherwise(F.col(f"n_{base[0]}"))
        return paths.join(made, "blob", "left").withColumn(f"n_{base[0]}", checked).drop("n_rules")
