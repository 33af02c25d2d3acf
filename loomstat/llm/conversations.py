"""Conversation structure repair: the cheapest edits that make the roles of a conversation follow a grammar.

Role initials have to read ``(s?(ua)+)?``: nothing, or an optional system turn and then user and
assistant in turns. A forward Viterbi pass goes over the rows of a conversation with four grammar
states (nothing yet, after s, after u, after a) and carries the least (cost, audit string) of each.
A row is kept (0), given the role that the state asks for (2) or deleted (3); after each row the
layer is closed by at most two inserted turns (2 each), more never help. Blank rows and repeats of
an earlier row have to be deleted, rows that end without a stop cost 1 unless they are deleted.

Of two audit strings of equal cost for the same rows neither is a prefix of the other (each
further letter would be an insert, which costs), so the least string of a state stays least
whatever follows, and the forward pass is exact.

How it is dealt out: identical rows of a turn are one row with a count; rows are sorted into range
partitions by (conversation, turn, role, text), so a conversation that holds a third of all rows
spreads over many tasks; a task cuts its rows into blocks of bounded size and works out, for each
state before a block, the least path to each state after it. A fold over the blocks of a
conversation picks its path and sees block summaries only. Edits are then applied block by block.

Defined cases: nulls in role and text count as one space; a null turn sorts first; rows of one
turn are ordered by role, then text; a null conversation id is a conversation of its own. Roles
other than those the grammar knows have to be given a role or deleted. A conversation of which
nothing is left has zeros, an empty audit and no repaired rows. An empty table gives an empty
result; other columns aren't read. The audit is one string, so a conversation can't have more
than 2^31 rows.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved

#: White space as the contract has it.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: A block ends at so many rows or characters of text, whichever comes first.
BLOCK_ROWS, BLOCK_CHARS = 1024, 1_000_000

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a role initial, by the state before it.
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The role that an inserted or changed turn gets in a state, and the state after it.
WANTED = ("user", "user", "assistant", "user")
THEN = (USER, USER, ASSISTANT, USER)
ENTRIES = {"first": (NOTHING,), "any": (NOTHING, SYSTEM, USER, ASSISTANT)}


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows after the planted damage; a dropped row has no copies."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", shown(conv_col), shown(turn_col)).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(shown(text_col), "[.!?]", "")).otherwise(shown(text_col))
    role = F.when(kind == 4, F.lit("user")).otherwise(shown(role_col))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"), copies.cast("long").alias("copies"))


def _better(layer: dict, state: int, cost: int, audit: str) -> None:
    if state not in layer or (cost, audit) < layer[state]:
        layer[state] = (cost, audit)


def _closed(layer: dict) -> dict:
    for _ in range(2):
        made = dict(layer)
        for state, (cost, audit) in layer.items():
            _better(made, THEN[state], cost + INSERT, audit + "I")
        layer = made
    return layer


def paths(symbols: str, entry: int) -> tuple:
    """For each state at the end the least (cost, audit) from ``entry`` over the rows, or None.

    A row's symbol is ``d`` where it has to be deleted, else its role initial (``x`` for one that
    the grammar doesn't know), as a capital where the text is cut off.
    """
    layer = _closed({entry: (0, "")})
    for symbol in symbols:
        made: dict = {}
        initial, extra = symbol.lower(), TRUNCATED * symbol.isupper()
        for state, (cost, audit) in layer.items():
            _better(made, state, cost + DELETE, audit + "D")
            if symbol != "d":
                if initial in NEXT[state]:
                    _better(made, NEXT[state][initial], cost + extra, audit + "K")
                _better(made, THEN[state], cost + REROLE + extra, audit + "R")
        layer = _closed(made)
    return tuple(layer.get(s) for s in range(4))


#: Most conversations are short and read alike; longer ones aren't kept.
_known = lru_cache(maxsize=20_000)(paths)
KNOWN_ROWS = 32


class Row(NamedTuple):
    turn: object
    role: str
    text: str
    copies: int
    first: bool


def _fault(row: Row) -> str:
    """blank, duplicate or truncated, or nothing; of the first copy of a row."""
    body = row.text.rstrip(BLANKS)
    if not body:
        return "blank"
    if not row.first:
        return "duplicate"
    return "" if body[-1] in ENDS else "truncated"


class _Block:
    """Rows of one conversation that follow each other, and what the fold needs to know of them."""

    def __init__(self, conv: object, number: int, starts: bool):
        self.conv, self.number, self.starts = conv, number, starts
        self.rows: list[Row] = []
        self.chars = 0

    def full(self) -> bool:
        return len(self.rows) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS

    def add(self, row: Row) -> None:
        if row.copies:
            self.rows.append(row)
            self.chars += len(row.text) + row.copies

    def summary(self) -> dict:
        faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        symbols, illegal, distinct, turns, before = [], 0, 0, [], None
        for row in self.rows:
            fault, initial = _fault(row), row.role[:1]
            if fault:
                faults[fault] += 1
            faults["blank" if fault == "blank" else "duplicate"] += row.copies - 1
            symbol = initial if initial in ("s", "u", "a") else "x"
            symbols.append("d" if fault in ("blank", "duplicate") else symbol.upper() if fault else symbol)
            symbols.append("d" * (row.copies - 1))
            illegal += (before is not None and before + initial not in ("su", "ua", "au")) + row.copies - 1  # a role never follows itself
            before = initial
            if row.turn is not None and (not turns or row.turn != turns[-1]):
                distinct += 1
                turns = [*turns[:1], row.turn]
        chain = "".join(symbols)
        least = _known if len(chain) <= KNOWN_ROWS else paths
        ways = [[e, s, *way] for e in ENTRIES["first" if self.starts else "any"] for s, way in enumerate(least(chain, e)) if way]
        return {
            "n": len(chain), **faults, "illegal": illegal, "distinct": distinct, "turns": turns[:1] + turns[-1:],
            "initials": [self.rows[0].role[:1], before] if self.rows else [], "ways": [dict(zip(("entry", "exit", "cost", "audit"), w, strict=True)) for w in ways],
        }


WAYS = "array<struct<entry:int,exit:int,cost:long,audit:string>>"
SUMMARY = f"n long, blank long, duplicate long, truncated long, illegal long, distinct long, turns array<long>, initials array<string>, ways {WAYS}"
ROWS = "array<struct<turn:long,role:string,text:string,copies:long,first:boolean>>"


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(schema))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Row]]:
    """(conversation, row); a row of very many copies comes in several pieces, all but the first of them repeats."""
    for batch in batches:
        for conv, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            row = Row(*row)
            while row.copies > BLOCK_CHARS:
                yield conv, row._replace(copies=BLOCK_CHARS)
                row = row._replace(copies=row.copies - BLOCK_CHARS, first=False)
            yield conv, row


def _cut(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, number, block = TaskContext.get().partitionId(), 0, None

    def made(block: _Block) -> dict:
        return {"conv_id": block.conv, "part": task, "block": block.number, **block.summary(), "rows": [r._asdict() for r in block.rows]}

    held, chars = [], 0
    for conv, row in _rows(batches):
        if block is None or conv != block.conv or block.full():
            # rows of the first conversation of a task may have begun in the task before
            starts = block is not None and conv != block.conv
            if block is not None:
                held.append(made(block))
                chars += block.chars
            if len(held) >= 256 or chars >= BLOCK_CHARS:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held, chars = [], 0
            block, number = _Block(conv, number, starts), number + 1
        block.add(row)
    if block is not None:
        yield pa.RecordBatch.from_pylist([*held, made(block)], schema=schema)


def blocks(turns: DataFrame) -> DataFrame:
    """The rows as blocks (conv_id, part, block, summary, rows), written once; (part, block) is a key and sorts them."""
    once = saved(turns.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "turns")
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    there = once.filter(F.col("copies") > 0).select("conv_id", digest.alias("digest"), F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn")).alias("at"))
    firsts = there.groupBy("conv_id", "digest").agg(F.min("at.known").alias("known"), F.min("at").alias("at"))
    firsts = firsts.select(F.col("conv_id").alias("f_conv"), F.col("digest").alias("f_digest"), F.col("at.turn").alias("f_turn"), F.lit(True).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("f_conv")) & (digest == F.col("f_digest")) & F.col("turn").eqNullSafe(F.col("f_turn"))
    marked = once.join(firsts, same, "left").select("conv_id", F.col("turn").cast("long"), "role", "text", "copies", F.coalesce("first", F.lit(False)).alias("first"))
    keys = ["conv_id", "turn", "role", "text"]
    kind = once.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, part int, block int, {SUMMARY}, rows {ROWS}"
    arrow = _arrow(schema)
    return saved(marked.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(lambda b: _cut(b, arrow), schema), "blocks")


class _Fold:
    """The least path over the blocks of one conversation so far, per state, and its counts."""

    def __init__(self, conv: object):
        self.conv = conv
        self.counts = dict.fromkeys(("n", "blank", "duplicate", "truncated", "illegal", "distinct"), 0)
        self.least = self.last = self.initial = None
        self.common = ""  # what all paths begin with
        self.layer = {NOTHING: (0, "", None)}  # state: (cost, audit after the common part, blocks chosen as (before, key, entry, audit))

    def add(self, block: dict) -> None:
        for k in self.counts:
            self.counts[k] += block[k]
        if block["turns"]:
            self.counts["distinct"] -= block["turns"][0] == self.last and self.last is not None
            self.least, self.last = block["turns"][0] if self.least is None else self.least, block["turns"][1]
        if block["initials"]:
            self.counts["illegal"] += self.initial is not None and self.initial + block["initials"][0] not in ("su", "ua", "au")
            self.initial = block["initials"][1]
        made: dict = {}
        for way in block["ways"]:
            if way["entry"] in self.layer:
                cost, audit, chosen = self.layer[way["entry"]]
                new = (cost + way["cost"], audit + way["audit"])
                if way["exit"] not in made or new < made[way["exit"]][:2]:
                    made[way["exit"]] = (*new, (chosen, (block["part"], block["block"]), way["entry"], way["audit"]))
        # paths meet again after a few rows; what they share decides no comparison
        shared = os.path.commonprefix([audit for _, audit, _ in made.values()])
        self.common += shared
        self.layer = {s: (cost, audit[len(shared) :], chosen) for s, (cost, audit, chosen) in made.items()}

    def rows(self) -> Iterator[dict]:
        """A row per block with its entry state and edits; the last one has what is known of the conversation."""
        cost, audit, chosen = min((self.layer[s] for s in (NOTHING, ASSISTANT) if s in self.layer), key=lambda way: way[:2])
        audit, way = self.common + audit, []
        while chosen:
            chosen, key, entry, edits = chosen
            way.append((key, entry, edits))
        start = 0
        for k, ((part, block), entry, edits) in enumerate(reversed(way)):
            last = k == len(way) - 1
            yield {"part": part, "block": block, "entry": entry, "edits": edits, "start": start} | ({"report": self.report(cost, audit)} if last else {})
            start += len(edits) - edits.count("D")

    def report(self, cost: int, audit: str) -> dict:
        c = self.counts
        gaps = 0 if self.least is None else self.last - self.least + 1 - c["distinct"]
        return {"gaps": gaps, **{k: c[k] for k in ("blank", "duplicate", "truncated", "illegal")}, "cost": cost, "audit": audit}


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
DECISION = f"part int, block int, entry int, edits string, start long, report struct<{REPORT.replace(' ', ':').replace(',:', ',')}>"


def _folded(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    fold, held = None, []
    for batch in batches:
        for block in batch.to_pylist():
            if fold is None or block["conv_id"] != fold.conv:
                held += fold.rows() if fold else ()
                fold = _Fold(block["conv_id"])
                if len(held) >= 256:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
                    held = []
            fold.add(block)
    held += fold.rows() if fold else ()
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _applied(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The edits of a block put to its rows."""
    held, chars = [], 0
    for batch in batches:
        for k in range(batch.num_rows):
            block = batch.slice(k, 1).to_pylist()[0]
            state, rows, made = block["entry"], iter(block["rows"]), []
            row, left = None, 0
            for edit in block["edits"]:
                if edit == "I":
                    made.append({"edit": edit, "turn": None, "role": WANTED[state], "text": ""})
                    state = THEN[state]
                    continue
                if not left:
                    row = next(rows)
                    left = row["copies"]
                left -= 1
                if edit != "D":
                    role = row["role"] if edit == "K" else WANTED[state]
                    made.append({"edit": edit, "turn": row["turn"], "role": role, "text": row["text"]})
                    state = NEXT[state][role[0]]
            held.append({x: block[x] for x in ("conv_id", "part", "block", "start", "report")} | {"repaired": made})
            chars += sum(len(r["text"]) for r in made)
            if len(held) >= 256 or chars >= BLOCK_CHARS:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def solved(turns: DataFrame) -> DataFrame:
    """A row per block: (conv_id, part, block, start, report, repaired); ``report`` is with the last block of a conversation.

    ``turns`` has conv_id, turn, role, text and copies. ``repaired`` has the turns that stay or are
    put in, (edit, turn, role, text); the first of them is turn ``start`` of the repaired conversation.
    """
    table = blocks(turns)
    fields = _arrow(DECISION)
    summaries = table.drop("rows").repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    decisions = summaries.mapInArrow(lambda b: _folded(b, fields), DECISION)
    kind = table.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, {DECISION.replace('entry int, edits string, ', '')}, repaired array<struct<edit:string,turn:long,role:string,text:string>>"
    arrow = _arrow(schema)
    joined = table.select("conv_id", "part", "block", "rows").join(decisions, ["part", "block"]).select("conv_id", "part", "block", "entry", "edits", "start", "report", "rows")
    return joined.mapInArrow(lambda b: _applied(b, arrow), schema)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, position, edit, turn, role, text): the repaired conversations, row by row; ``edit`` is K, R or I."""
    made = solved(turns).select("conv_id", "start", F.posexplode("repaired").alias("at", "row"))
    return made.select("conv_id", (F.col("start") + F.col("at")).alias("position"), "row.*")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest, lines = hashlib.sha256(), 0
    for batch in batches:
        out: list = []
        for report, text, n in zip(*(c.to_pylist() for c in batch.columns[-3:]), strict=True):
            if n:
                digest.update(("\n" * bool(lines) + text).encode("utf-8", "surrogatepass"))
                lines += n
            out.append(digest.hexdigest() if report else None)
            if report:  # the last block of its conversation
                digest, lines = hashlib.sha256(), 0
        ended = pa.array([x is not None for x in out])
        made = pa.RecordBatch.from_arrays([*batch.columns[:-3], batch.column(batch.num_columns - 3), pa.array(out, pa.string())], names=["conv_id", "report", "repaired_sha256"])
        yield made.filter(ended)


def reports(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), a row per conversation.

    The digest of a conversation is worked out in order over one string per block.
    """
    lines = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    pieces = solved(turns).select("conv_id", "part", "block", "report", F.array_join(lines, "\n").alias("lines"), F.size("repaired").alias("n"))
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block").select("conv_id", "report", "lines", "n")
    schema = T.StructType([ordered.schema["conv_id"], ordered.schema["report"], T.StructField("repaired_sha256", T.StringType())])
    return ordered.mapInArrow(_hashed, schema).select("conv_id", "report.*", "repaired_sha256")


#: The damage, the faults and the Viterbi pass, row by row in a recursive query; an entry is {cost, audit, repaired text}.
ORACLE_SQL = """
WITH RECURSIVE table_of AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS tab
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ascii(ch)::BIGINT) AS bytes
  FROM conversations
), kinds AS (
  SELECT conv_id, turn, role, body, xor(list_reduce(bytes, lambda c, b: xor(c // 256, tab[xor(c % 256, b) + 1]), 4294967295), 4294967295) % 20 AS kind
  FROM keyed CROSS JOIN table_of
), hurt AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(body, '[.!?]', '', 'g') ELSE body END AS text,
         unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS body
  FROM hurt
), faults AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN body = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN NOT contains('.!?', right(body, 1)) THEN 'truncated' ELSE '' END AS fault
  FROM numbered
), about AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faults GROUP BY conv_id
), way(conv_id, i, n0, n1, n2, n3) AS (
  SELECT conv_id, 0::BIGINT, {'c': 0::BIGINT, 'a': '', 'r': ''}, NULL::STRUCT(c BIGINT, a VARCHAR, r VARCHAR),
         {'c': 2::BIGINT, 'a': 'I', 'r': chr(10) || 'user:'}, {'c': 4::BIGINT, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}
  FROM about
  UNION ALL
  SELECT conv_id, i, s0, s1, t2, least(s3, CASE WHEN t2 IS NOT NULL THEN {'c': t2.c + 2, 'a': t2.a || 'I', 'r': t2.r || chr(10) || 'assistant:'} END)
  FROM (
    SELECT conv_id, i, s0, s1, s3,
           least(s2, CASE WHEN s0 IS NOT NULL THEN {'c': s0.c + 2, 'a': s0.a || 'I', 'r': s0.r || chr(10) || 'user:'} END,
                     CASE WHEN s1 IS NOT NULL THEN {'c': s1.c + 2, 'a': s1.a || 'I', 'r': s1.r || chr(10) || 'user:'} END,
                     CASE WHEN s3 IS NOT NULL THEN {'c': s3.c + 2, 'a': s3.a || 'I', 'r': s3.r || chr(10) || 'user:'} END) AS t2
    FROM (
      SELECT w.conv_id, f.i, d0 AS s0,
             least(d1, CASE WHEN may AND initial = 's' AND n0 IS NOT NULL THEN {'c': n0.c + x, 'a': n0.a || 'K', 'r': n0.r || line} END) AS s1,
             least(d2, CASE WHEN may AND n0 IS NOT NULL THEN {'c': n0.c + x + CASE initial WHEN 'u' THEN 0 ELSE 2 END, 'a': n0.a || u, 'r': n0.r || uline} END,
                       CASE WHEN may AND n1 IS NOT NULL THEN {'c': n1.c + x + CASE initial WHEN 'u' THEN 0 ELSE 2 END, 'a': n1.a || u, 'r': n1.r || uline} END,
                       CASE WHEN may AND n3 IS NOT NULL THEN {'c': n3.c + x + CASE initial WHEN 'u' THEN 0 ELSE 2 END, 'a': n3.a || u, 'r': n3.r || uline} END) AS s2,
             least(d3, CASE WHEN may AND n2 IS NOT NULL THEN {'c': n2.c + x + CASE initial WHEN 'a' THEN 0 ELSE 2 END,
                                'a': n2.a || CASE initial WHEN 'a' THEN 'K' ELSE 'R' END,
                                'r': n2.r || CASE initial WHEN 'a' THEN line ELSE chr(10) || 'assistant:' || text END} END) AS s3
      FROM (
        SELECT *, CASE WHEN n0 IS NOT NULL THEN {'c': n0.c + 3, 'a': n0.a || 'D', 'r': n0.r} END AS d0,
               CASE WHEN n1 IS NOT NULL THEN {'c': n1.c + 3, 'a': n1.a || 'D', 'r': n1.r} END AS d1,
               CASE WHEN n2 IS NOT NULL THEN {'c': n2.c + 3, 'a': n2.a || 'D', 'r': n2.r} END AS d2,
               CASE WHEN n3 IS NOT NULL THEN {'c': n3.c + 3, 'a': n3.a || 'D', 'r': n3.r} END AS d3
        FROM way
      ) w JOIN (
        SELECT conv_id, i, text, initial, fault NOT IN ('blank', 'duplicate') AS may, (fault = 'truncated')::BIGINT AS x, chr(10) || role || ':' || text AS line,
               CASE initial WHEN 'u' THEN 'K' ELSE 'R' END AS u, chr(10) || CASE initial WHEN 'u' THEN role ELSE 'user' END || ':' || text AS uline
        FROM faults
      ) f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
    )
  )
), best AS (
  SELECT w.conv_id, least(n0, n3) AS b FROM way w JOIN about a ON a.conv_id IS NOT DISTINCT FROM w.conv_id AND a.n = w.i
)
SELECT o.conv_id, coalesce(a.gaps, 0) AS gaps, coalesce(a.blank, 0) AS blank, coalesce(a.duplicate, 0) AS duplicate, coalesce(a.truncated, 0) AS truncated,
       coalesce(a.illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit, sha256(coalesce(b.r[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN about a ON a.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id
"""
