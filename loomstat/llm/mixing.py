"""Mixing sources to target weights by Pfair scheduling.

The characters of a source, documents in the order of a digest of id and text, are one stream
that is cut into blocks of ``block_chars`` characters; a document that reaches over a border is
cut there. With target weight w, block number i (from 1) of a source is released at slot
floor((i - 1) / w) and has to be done by slot ceil(i / w). One block is done a slot; of the
released blocks the one with the earliest deadline comes first. Such a schedule exists and is
found by this rule because the weights add up to one, and at every slot each source has had its
share to within less than one block.

Weights are whole multiples of 1 / period, so the schedule repeats after period slots and one
period is enough: it is a fold over its slots, in SQL functions. Unless it is given, the period
is ``PERIOD`` or, with more sources than a quarter of that, the next power of two above four
times their number. Documents then get their slots by arithmetic and a join with that table.
Sources of one weight have the same release times and deadlines, so the fold keeps a state per
weight and takes them in turn; it takes steps in proportion to the period times the number of
different weights, which is less than the square root of twice the period. It runs in one task,
as one slot depends on those before; what it holds is a row's worth of numbers per source and slot.

Hot sources: running totals inside a source are taken in two steps, over ``BUCKETS`` ranges of
the digest and then inside each range, so no task needs a whole source.

All rows are kept. Once a source has no block left, its slots stay empty and the others keep
their proportions. Defined cases: a null source is a source of its own; an empty or null text
counts as one character; ids may be null or repeated (rows of one id and one text are alike, so
any order of them is the same plan); sources without a given weight share the smallest weight;
a given period with fewer slots than sources fails; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_CHARS = 8192
#: The least number of slots of a period.
PERIOD = 1024
#: Ranges of the digest: its first three hex digits.
BUCKETS = 4096


def source_weights(sizes: DataFrame, targets: Mapping[str, float] | None, period: int | None) -> DataFrame:
    """(source, name, w, j, period): whole weights that add up to the period, at least 1 each; j numbers the sources.

    Without targets a source weighs the square root of its size. ``sizes`` has a row per source.
    """
    if targets is None:
        raw = F.floor(F.sqrt(F.col("size"))).cast("decimal(38,0)")
    else:
        given = F.create_map(*[F.lit(x) for k, v in targets.items() for x in (k, float(v))]) if targets else F.expr("map('', 0d)")
        raw = F.greatest(F.floor(F.coalesce(given[F.col("source")], F.lit(0.0)) * 1e9), F.lit(1)).cast("decimal(38,0)")
    every = Window.partitionBy(F.lit(0))
    rows = sizes.select("source", "name", raw.alias("raw")).withColumns({"n": F.count("*").over(every), "all": F.sum("raw").over(every)})
    if period is None:
        slots = F.greatest(F.lit(PERIOD), F.expr("shiftleft(1L, length(bin(4L * n - 1)))"))
    else:
        slots = F.when(F.col("n") > period, F.raise_error(F.lit("more sources than slots in a period")).cast("int")).otherwise(F.lit(period))
    rows = rows.withColumn("period", slots.cast("long"))
    rows = rows.withColumn("scaled", (F.col("raw") * (F.col("period") - F.col("n"))).cast("decimal(38,0)"))
    rows = rows.withColumn("base", (F.expr("scaled div all") + 1).cast("long")).withColumn("rest", F.expr("scaled % all"))
    rows = rows.withColumn("more", F.row_number().over(every.orderBy(F.desc("rest"), "name")) <= F.col("period") - F.sum("base").over(every))
    number = (F.row_number().over(every.orderBy("name")) - 1).cast("int")
    return rows.select("source", "name", (F.col("base") + F.col("more").cast("long")).alias("w"), number.alias("j"), "period")


#: Slots that are worked out before they are added to the list.
CHUNK = 1024


def schedule(weights: DataFrame) -> DataFrame:
    """(j, k, slot): the slot of the k-th block (from 1) of source j in one period, earliest deadline first, of equal ones the smallest j."""
    alike = weights.groupBy(F.col("w").cast("long").alias("w")).agg(F.array_sort(F.collect_list(F.col("j").cast("int"))).alias("js"), F.max("period").alias("p"))
    one = alike.agg(F.array_sort(F.collect_list(F.struct("w", "js", F.size("js").alias("m")))).alias("c"), F.max("p").cast("long").alias("p")).filter(F.size("c") > 0)
    # of each weight: block number ``done`` of the sources from place ``at`` on is next
    pick = """array_min(transform(c, (x, i) -> if(s.done[i] < x.w and s.done[i] * p div x.w <= t,
        named_struct('deadline', ((s.done[i] + 1L) * p + x.w - 1L) div x.w, 'j', x.js[s.at[i]], 'i', i), null)))"""
    step = f"""element_at(transform(array({pick}), q -> named_struct(
        'done', transform(s.done, (d, i) -> if(i = q.i and s.at[i] + 1 = c[i].m, d + 1L, d)),
        'at', transform(s.at, (a, i) -> if(i = q.i, if(a + 1 = c[i].m, 0, a + 1), a)),
        'out', concat(s.out, array(q.j)))), 1)"""
    chunk = f"""aggregate(sequence(b * {CHUNK}L, least(p, (b + 1L) * {CHUNK}L) - 1L),
        named_struct('done', acc.done, 'at', acc.at, 'out', cast(array() as array<int>)), (s, t) -> {step})"""
    fold = f"""aggregate(sequence(0L, (p - 1L) div {CHUNK}L),
        named_struct('done', transform(c, x -> 0L), 'at', transform(c, x -> 0), 'out', cast(array() as array<array<int>>)),
        (acc, b) -> element_at(transform(array({chunk}), r -> named_struct('done', r.done, 'at', r.at, 'out', concat(acc.out, array(r.out)))), 1),
        acc -> flatten(acc.out))"""
    slots = one.select(F.posexplode(F.expr(fold)).alias("slot", "j"))
    k = F.row_number().over(Window.partitionBy("j").orderBy("slot")).cast("long")
    return slots.select("j", k.alias("k"), F.col("slot").cast("long").alias("slot"))


def _source_name(source_col: str) -> Column:
    # a null source must not meet a source of any name
    return F.when(F.col(source_col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source_col).cast("string")))


def _size(text_col: str) -> Column:
    return F.greatest(F.coalesce(F.length(F.col(text_col)), F.lit(1)), F.lit(1)).cast("long")


def _digest(id_col: str, text_col: str) -> Column:
    # with the text, rows of one id (null is one, too) are in different ranges
    text = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    return F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), text).cast("binary"))


def _streams(rows: DataFrame, targets: Mapping[str, float] | None, period: int | None) -> tuple[DataFrame, DataFrame]:
    """Rows with their ``start`` in the stream of their source, and the slots of one period.

    ``rows`` has row, source, name, digest, size.
    """
    rows = rows.withColumn("bucket", F.conv(F.substring("digest", 1, 3), 16, 10).cast("int"))
    buckets = rows.groupBy("name", "bucket").agg(F.first("source").alias("source"), F.sum("size").alias("size"))
    before = Window.partitionBy("name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select("name", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("bucket_start"))
    sizes = buckets.groupBy("name").agg(F.first("source").alias("source"), F.sum("size").alias("size"))
    weights = source_weights(sizes, targets, period)
    # joins by name and bucket, or name and slot of the period: rows of a hot source have many of either, and Spark
    # sends these tables (a row per source and bucket, or per slot) to all tasks only if they are small
    starts = starts.join(weights.select("name", "w", "period"), "name")
    plan = schedule(weights).join(weights, "j").select("name", "k", F.col("slot").alias("first_slot"))
    inside = Window.partitionBy("name", "bucket").orderBy("digest", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["name", "bucket"])
    return placed.withColumn("start", F.col("start") + F.col("bucket_start")), plan


def _with_slot(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with ``block``, w and period get their ``slot``, ``release`` and ``deadline``."""
    rows = rows.withColumn("k", F.col("block") % F.col("w") + 1).join(plan, ["name", "k"])
    return rows.withColumns({
        "slot": F.expr("block div w * period + first_slot"),
        "release": F.expr("block * period div w"),
        "deadline": F.expr("((block + 1) * period + w - 1) div w"),
    })


def mix(docs: DataFrame, targets: Mapping[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_chars: int = BLOCK_CHARS, period: int | None = None) -> DataFrame:
    """The rows of ``docs`` (as struct ``row``), each whole, in the block of its first character.

    With it: source, size, block, release, deadline, slot, block_offset, step (period and weight),
    block_chars. Sorted by (slot, block_offset) the rows are the mixture.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(source_col).alias("source"), _source_name(source_col).alias("name"),
        _digest(id_col, text_col).alias("digest"), _size(text_col).alias("size"),
    )
    placed, plan = _streams(rows, targets, period)
    placed = placed.withColumns({"block": F.expr(f"start div {block_chars}"), "block_offset": F.col("start") % block_chars})
    return _with_slot(placed, plan).select(
        "row", "source", "size", "block", "release", "deadline", "slot", "block_offset",
        F.struct("period", "w").alias("step"), F.lit(block_chars).cast("long").alias("block_chars"),
    )


def mixing_plan(docs: DataFrame, targets: Mapping[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_chars: int = BLOCK_CHARS, period: int | None = None) -> DataFrame:
    """The mixture, documents cut at the borders of blocks.

    A row per part of a row of ``docs``: doc_id, source, start and size (characters of the
    document before the part, and in it), block, release, deadline, slot, block_offset.
    """
    rows = docs.select(
        F.col(id_col).alias("row"), F.col(source_col).alias("source"), _source_name(source_col).alias("name"), _digest(id_col, text_col).alias("digest"), _size(text_col).alias("size"),
    )
    placed, plan = _streams(rows, targets, period)
    parts = placed.withColumn("block", F.explode(F.expr(f"sequence(start div {block_chars}, (start + size - 1) div {block_chars})")))
    parts = parts.withColumns({"from": F.greatest(F.col("start"), F.col("block") * block_chars), "to": F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_chars)})
    return _with_slot(parts, plan).select(
        F.col("row").alias("doc_id"), "source", (F.col("from") - F.col("start")).alias("start"), (F.col("to") - F.col("from")).alias("size"),
        "block", "release", "deadline", "slot", (F.col("from") - F.col("block") * block_chars).alias("block_offset"),
    )


def mixed(docs: DataFrame, targets: Mapping[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_chars: int = BLOCK_CHARS, period: int | None = None) -> DataFrame:
    """All rows of ``docs`` in the order of the mixture, columns as they were."""
    return mix(docs, targets, id_col, text_col, source_col, block_chars, period).orderBy("slot", "block_offset").select("row.*")
