import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from loomstat.llm import centroids as K
from loomstat.llm import conversations as C

BLANK = " \t\n\x0b\x0c\r"


def brute_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired rows) of damaged rows in order, trying all edits."""
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(BLANK)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    found = []

    def go(k, cost, audit, made, inserts):
        if inserts < 2:
            for role in ("user", "assistant"):
                go(k, cost + 2, audit + "I", [*made, (role, "")], inserts + 1)
        if k == len(rows):
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in made)):
                found.append((cost, audit, made))
            return
        _, role, text = rows[k]
        go(k + 1, cost + 3, audit + "D", made, 0)
        if faults[k] not in ("blank", "duplicate"):
            extra = faults[k] == "truncated"
            go(k + 1, cost + extra, audit + "K", [*made, (role, text)], 0)
            for other in ("user", "assistant"):
                go(k + 1, cost + 2 + extra, audit + "R", [*made, (other, text)], 0)

    go(0, 0, "", [], 0)
    cost, audit, made = min(found, key=lambda f: f[:2])
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit), made


def digest(made):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()


def brute_damage(turns):
    out = []
    for conv, turn, role, text in turns:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2], r[3]))


def random_turns(seed, conversations, most):
    rng = random.Random(seed)
    texts = ["", " \t", "Yes.", "no", "What?  ", "ok!\n", "Yes.", None]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    return [
        (conv, rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(texts)) for conv in [None, *range(conversations)] for _ in range(rng.randint(1, most))
    ]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("rows_a_block", [1, 1024])
def test_repair_against_all_edits(spark, monkeypatch, rows_a_block):
    monkeypatch.setattr(C, "BLOCK_ROWS", rows_a_block)
    turns = random_turns(3, 60, 4)
    made = {r["conv_id"]: r for r in C.reports(C.damaged(spark.createDataFrame(turns, SCHEMA))).collect()}
    assert set(made) == {t[0] for t in turns}
    hurt = brute_damage(turns)
    for conv in made:
        (gaps, *rest), repaired = brute_repair([r[1:] for r in hurt if r[0] == conv])
        assert tuple(made[conv])[1:8] == (gaps, *rest), conv
        assert made[conv]["repaired_sha256"] == digest(repaired)


@pytest.mark.parametrize("chain", ["susA", "uua", "xdA", "aaaa", "dddd", "UuSs", ""])
def test_paths_compose(chain):
    """Cutting a chain anywhere gives the same least paths."""
    whole = C.paths(chain, C.NOTHING)
    for k in range(len(chain) + 1):
        made = [None] * 4
        for state, way in enumerate(C.paths(chain[:k], C.NOTHING)):
            for end, rest in enumerate(C.paths(chain[k:], state) if way else ()):
                if rest:
                    new = (way[0] + rest[0], way[1] + rest[1])
                    made[end] = min(made[end] or new, new)
        assert tuple(made) == whole


def test_repaired_turns_come_in_order(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_ROWS", 7)
    turns = [(1, k, ("user", "assistant", "tool")[k % 3], f"text {k}.") for k in range(500)] + [(2, 0, "assistant", "Hello.")]
    frame = spark.createDataFrame([(*t, 1) for t in turns], SCHEMA + ", copies long").repartition(5)
    made = C.repaired_turns(frame).orderBy("conv_id", "position").collect()
    one = [r for r in made if r["conv_id"] == 1]
    assert [r["position"] for r in one] == list(range(len(one)))
    assert re.fullmatch("(ua)+", "".join(r["role"][0] for r in one)) and all(r["edit"] in "KRI" for r in made)
    assert [(r["edit"], r["role"], r["text"]) for r in made if r["conv_id"] == 2] == [("I", "user", ""), ("K", "assistant", "Hello.")]
    report = {r["conv_id"]: r for r in C.reports(frame).collect()}
    assert report[1]["audit"].replace("D", "") == "".join(r["edit"] for r in one)
    assert report[1]["repaired_sha256"] == digest([(r["role"], r["text"]) for r in one])


def test_one_conversation_of_repeats(spark):
    """A third of all rows may be one row of one conversation: it travels as a row with a count."""
    frame = spark.range(30_000).selectExpr("5L as conv_id", "1L as turn", "'user' as role", "'Hi.' as text", "1L as copies")
    (made,) = C.reports(frame).collect()
    assert made["duplicate"] == made["illegal"] == 29_999 and made["cost"] == 29_999 * 3 + 2
    assert made["audit"] == "K" + "D" * 29_999 + "I"


def test_very_many_copies_come_in_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(C, "BLOCK_CHARS", 4)
    batch = pa.RecordBatch.from_pylist([{"conv_id": 1, "turn": 0, "role": "user", "text": "Hi.", "copies": 10, "first": True}])
    assert [(r.copies, r.first) for _, r in C._rows([batch])] == [(4, True), (4, False), (2, False)]


def test_repair_of_nothing_and_of_dropped_rows(spark):
    assert C.reports(C.damaged(spark.createDataFrame([], SCHEMA))).count() == 0
    frame = spark.createDataFrame([(1, 1, "user", "a.", 0), (1, 2, "user", "b.", 0)], SCHEMA + ", copies long")
    assert [tuple(r) for r in C.reports(frame).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    extra = spark.createDataFrame([(1, 1, "user", "a.", "x", "y")], SCHEMA + ", part string, report string")
    assert C.reports(C.damaged(extra)).count() == 1


def brute_clusters(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    at = [v for _, _, v in sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), 0, v) for i, v in kept)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(at))

    for _ in range(rounds):
        who = [nearest(v)[1] for _, v in kept]
        for c in set(who):
            own = [v for (_, v), w in zip(kept, who, strict=True) if w == c]
            at[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    last = [(i, *nearest(v)) for i, v in kept]
    spent = [sum(d for _, d, c in last if c == k) for k in range(len(at))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted(((i, c, d, spent[c], sum(spent), names[c]) for i, d, c in last), key=str)


def test_clusters_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(k, [rng.choice([-1.0, 0.0, 0.5]) + rng.random() / 50 for _ in range(64)]) for k in range(150)]
    rows += [(None, [0.25] * 64), (None, [0.5] * 64), (7, rows[7][1]), (7, rows[7][1]), (900, None), (901, []), (902, [1.0] * 63), (903, [None, *[1.0] * 63]), (904, [math.nan, *[1.0] * 63]), (905, [math.inf, *[1.0] * 63])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, cluster string, v int")
    made = K.clusters(frame).drop("centroid")
    assert made.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in made.collect()), key=str) == brute_clusters(rows)


def test_clusters_of_few_and_of_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert K.clusters(spark.createDataFrame([], schema)).count() == 0
    few = K.clusters(spark.createDataFrame([(1, [1.0] * 64), (2, [2.0] * 64)], schema)).collect()
    assert {(r["vec_id"], r["distance"], r["inertia"]) for r in few} == {(1, 0, 0), (2, 0, 0)}
    with pytest.raises(ValueError, match="range"):
        K.clusters(spark.createDataFrame([(1, [1.0] * 63 + [1e9])], schema))


def test_partial_distance_search_is_exact():
    rng = np.random.default_rng(2)
    x, c = rng.integers(-3, 4, (500, 64)), rng.integers(-3, 4, (8, 64))
    whole = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    for step in (1, 8, 64):
        order = rng.permutation(64)
        who, best = K.nearest(x[:, order], c[:, order], step)
        assert (who == whole.argmin(axis=1)).all() and (best == whole.min(axis=1)).all()
