import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from loomstat.llm import exact_dedup as D
from loomstat.llm import near_copies as N
from loomstat.llm import simhash as S

from .conftest import ROWS


def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in sorted(ids, key=lambda x: (x is None, x or 0)):
            kept = i == keep and left > 0
            left -= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("limit", [64, D.TABLE_BYTES])
def test_exact_dedup(edge, rows, limit):
    made = D.exact_dedup(edge, table_bytes=limit)
    assert made.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(rows(made)) == brute_exact(ROWS)


def test_exact_dedup_keeps_rows_whole(edge, empty):
    made = D.keep_distinct(edge)
    assert made.columns == edge.columns and sorted((r["doc_id"] or 0, r["text"] or "") for r in made.collect()) == sorted({(max((x[0] or 0) for x in ROWS if (x[1] or "") == (r[1] or "")), r[1] or "") for r in ROWS})
    assert D.exact_dedup(empty).count() == D.keep_distinct(empty).count() == 0


def test_grace_recursion_spills_and_compares_content():
    rng = random.Random(1)
    texts = [bytes([rng.randrange(97, 123)]) * rng.randrange(1, 300) for _ in range(3000)]
    # one hash for all: only complete content tells records apart, at every level
    for h in (lambda t: xxhash.xxh3_64_intdigest(t), lambda t: 12345):
        got = {c: (i, n) for _, c, i, n in D.grace(((h(t), t, k, 1) for k, t in enumerate(texts)), limit=2000)}
        want = {}
        for k, t in enumerate(texts):
            want[t] = (k, want.get(t, (0, 0))[1] + 1)
        assert got == want


def test_hot_group_of_copies(spark, docs):
    made = D.exact_dedup(docs([(k, "same" if k % 3 else f"t{k}", "en", "a") for k in range(3000)]))
    assert made.filter("kept").count() == 1001 and made.filter("group_size = 2000").count() == 2000


def brute_fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + width]), 42) for k in range(max(1, len(words) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, radius=4):
    root = list(range(len(fps)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    d = np.bitwise_count(np.array(fps, dtype=np.uint64)[:, None] ^ np.array(fps, dtype=np.uint64)[None, :])
    for i, j in zip(*np.nonzero(np.triu(d <= radius, 1)), strict=True):
        a, b = top(i), top(j)
        root[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for k, i in enumerate(ids):
        least[top(k)].append(i)
    return [min((x for x in least[top(k)] if x is not None), default=None) for k in range(len(ids))]


def test_simhash_edges(edge, empty, rows):
    fps = [brute_fingerprint(r[1]) for r in ROWS]
    want = Counter(zip([r[0] for r in ROWS], [f"{f:016x}" for f in fps], brute_components([r[0] for r in ROWS], fps), strict=True))
    assert Counter(rows(S.near_duplicates(edge))) == want
    assert S.near_duplicates(empty).count() == S.keep_one_each(empty).count() == 0


def test_simhash_near_copies(docs, rows):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    made = []
    for k in range(60):
        base = [word() for _ in range(300)]
        for c in range(rng.choice((1, 1, 2, 6))):
            copy = list(base)
            for _ in range(c):
                copy[rng.randrange(300)] = word()
            made.append((len(made), " ".join(copy), "en", "a"))
    fps = [brute_fingerprint(r[1]) for r in made]
    want = brute_components(range(len(made)), fps)
    assert len(set(want)) < len(made)
    assert {r[0]: r[2] for r in rows(S.near_duplicates(docs(made)))} == dict(enumerate(want))
    assert sorted(r["doc_id"] for r in S.keep_one_each(docs(made)).collect()) == sorted(set(want))


@pytest.mark.parametrize("nodes", [10, 10**5, 10**9, 10**13])
def test_bands_leave_no_link_out(nodes):
    plan = S.band_plan(nodes)
    rng = random.Random(nodes)
    for _ in range(300):
        flipped = set(rng.sample(range(64), 4))
        assert any(all(not any(a <= b < a + w for b in flipped) for a, w in bands) for bands in plan)


def test_bit_sliced_links_equal_brute_force():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**64, 400, dtype=np.uint64)
    flips = [base ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)) for _ in range(2)]
    values = np.unique(np.concatenate([base, *flips, flips[0] ^ (np.uint64(3) << np.uint64(7)) ^ (np.uint64(7) << np.uint64(40))]))
    groups = np.sort(rng.integers(0, 9, len(values)))
    groups[:300] = 0
    groups = np.sort(groups)
    got = {(int(i), int(j)) for a, b in S.lag_links(values, groups) for i, j in zip(a, b, strict=True)}
    d = np.bitwise_count(values[:, None] ^ values[None, :])
    want = {(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(d <= 4, 1)), strict=True) if groups[i] == groups[j]}
    assert got == want and want


def test_hot_key_is_dealt_into_chunks(spark, monkeypatch, rows):
    monkeypatch.setattr(S, "GROUP_ROWS", 16)
    rng = random.Random(2)
    center = rng.getrandbits(62)
    values = {center}
    for _ in range(200):
        values.add(center ^ (1 << rng.randrange(62)) ^ (1 << rng.randrange(62)))
    edges = S.links(spark.createDataFrame([(v,) for v in values], "fp long"))
    made = dict(rows(S.components(edges)))
    assert set(made.values()) == {min(values)} and set(made) == values - {min(values)}


def test_components_of_a_chain(spark, rows):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (7, 7)], "u long, v long")
    got = dict(rows(S.components(edges)))
    assert got == {**{k: 0 for k in range(1, 201)}, 501: 500}


def test_near_copies_at_jaccard_of_0_8(docs, edge, empty):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    made = []
    for k in range(40):
        base = [word() for _ in range(400)]
        made.append((len(made), " ".join(base), "en", "a"))
        for changed in (rng.choice((2, 5, 8)), 60):  # Jaccard above 0.8, and well under it
            copy = list(base)
            for at in rng.sample(range(0, 400, 5), changed):
                copy[at] = word()
            made.append((len(made), " ".join(copy), "en", "a"))

    def five(text):
        words = text.split()
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    sets = [five(r[1]) for r in made]
    root = list(range(len(made)))
    for i in range(len(made)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    kept = {r["doc_id"] for r in N.keep_one_each(docs(made)).collect()}
    assert kept == set(root) and len(kept) == 80
    assert len(S.keep_one_each(docs(made)).collect()) > 80  # radius 4 leaves copies
    assert N.keep_one_each(empty).count() == 0
    assert len({r["text"] or "" for r in N.keep_one_each(edge).collect()} - {"", " \t\n"}) == 7


def test_chained_copies_of_a_hot_key_are_one_component(docs):
    base = [f"w{k}" for k in range(300)]
    chain = [" ".join(base[6 * k :] + [f"n{x}" for x in range(6 * k)]) for k in range(12)]  # neighbours only
    assert [r["doc_id"] for r in N.keep_one_each(docs([(k, x, "en", "a") for k, x in enumerate(chain)])).collect()] == [0]


def test_sets_under_one_key_are_connected_as_by_brute_force():
    rng = np.random.default_rng(2)
    sets = [np.empty(0, np.uint64), np.empty(0, np.uint64)]
    for _ in range(12):
        base = rng.integers(0, 2**64, int(rng.choice([1, 3, 9, 60, 500])), dtype=np.uint64)
        for _ in range(8):
            kept = base[rng.random(len(base)) > rng.choice([0.02, 0.1, 0.15])]
            sets.append(np.unique(np.concatenate([kept, rng.integers(0, 2**64, int(len(base) * rng.choice([0, 0.05])), dtype=np.uint64)])))
    sets += sets[5:9]
    nodes = list(range(len(sets)))
    root = list(nodes)
    root[40] = 20  # connected before
    want = {k: k for k in nodes}

    def top(of, k):
        while of[k] != k:
            k = of[k]
        return k

    want[40] = 20
    for i, j in itertools.combinations(nodes, 2):
        if N.jaccard(sets[i], sets[j]) >= N.LEAST:
            a, b = sorted((top(want, i), top(want, j)))
            want[b] = a
    got = {k: k for k in nodes}
    got[40] = 20
    links = list(N.connected(root, sets))
    for i, j in links:
        assert N.jaccard(sets[i], sets[j]) >= N.LEAST and top(got, i) != top(got, j)
        a, b = sorted((top(got, i), top(got, j)))
        got[b] = a
    assert [top(got, k) for k in nodes] == [top(want, k) for k in nodes]


@pytest.mark.parametrize("group_rows", [8, 2048])
def test_groups_without_a_center(spark, docs, monkeypatch, group_rows):
    """Two groups of copies and strangers share a passage; no row per pair, the components of brute force."""
    monkeypatch.setattr(N, "GROUP_ROWS", group_rows)
    rng = random.Random(12)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = []
    for k in range(90):
        tail = [f"{'ab'[k % 2]}{j}" if k % 3 else f"s{k}x{j}" for j in range(30)]
        for _ in range(rng.choice((0, 1, 2))):
            tail[rng.randrange(30)] = f"r{rng.random()}"
        rows.append((k, passage + " " + " ".join(tail), None, None))
    made = N.keep_one_each(docs(rows)).select("doc_id").collect()
    sets = [N.shingles(r[1]) for r in rows]
    root = list(range(90))
    for _ in range(90):
        before = list(root)
        for i, j in itertools.combinations(range(90), 2):
            if N.jaccard(sets[i], sets[j]) >= N.LEAST:
                root[i] = root[j] = min(root[i], root[j])
        if root == before:
            break
    assert {r[0] for r in made} == set(root)
