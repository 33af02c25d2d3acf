import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomstat.llm import chroma as A
from loomstat.llm import mixing as X
from loomstat.llm import packing as P

from .conftest import ROWS


@pytest.fixture(scope="module")
def reference_ids():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: made.encode(text, add_special_tokens=False).ids


ADDED = "<|endoftext|>"
#: Texts into which the added token is mixed, also next to blanks and inside words.
MIXED = st.lists(st.one_of(st.text(max_size=30), st.sampled_from([ADDED, " ", "\n\n", "<|", "|>", "endoftext", "a"])), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(MIXED)
def test_ids_equal_the_tokenizer_file(reference_ids, text):
    assert P.token_ids(text).tolist() == reference_ids(text)


@pytest.mark.parametrize("text", [ADDED, ADDED * 2, f"hello {ADDED} world", f"in{ADDED}side", f"  {ADDED}  ", f"{ADDED}\n\n{ADDED}", "<|endoftext|", ADDED.upper(), "a  b", "\r\n\t  x", "ſ́"])
def test_added_tokens_are_one_id(reference_ids, text):
    assert P.token_ids(text).tolist() == reference_ids(text)
    assert P.token_ids(text).tolist().count(50256) == text.count(ADDED)


@pytest.mark.parametrize("length", [P.LONG_RUN - 1, P.LONG_RUN, P.LONG_RUN + 1])
@pytest.mark.parametrize("blanks", [" ", "\n", " \n", "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u200a\u2028\u202f\u205f\u3000"])
@pytest.mark.parametrize(("before", "after"), [("", ""), ("ab", "cd"), ("a ", " 1"), ("", "!x"), ("x", ""), ("\x1c", "\x1f"), ("", "<|endoftext|>"), ("<|endoftext|>", "<|endoftext|>x")])
def test_ids_of_long_white_space(reference_ids, length, blanks, before, after):
    rng = random.Random(length)
    run = "".join(rng.choice(blanks) for _ in range(length))
    text = before + run + after + "hello\n\n   world" + run + "end"
    for x in (text, before + run + after):
        assert P.token_ids(x).tolist() == reference_ids(x)


@pytest.mark.parametrize(("blanks", "length"), [(" ", 1_000_000), ("\n", 10_000_000), (" \n\t", 1_000_000)])
def test_ids_of_millions_of_blanks(reference_ids, blanks, length):
    rng = random.Random(1)
    text = "a" + "".join(rng.choices(blanks, k=length)) + "b"
    assert P.token_ids(text).tolist() == reference_ids(text)


def check_packing(made, ids, capacity):
    seen = defaultdict(list)
    for r in made:
        assert 1 <= r["length"] <= capacity
        seen[r["sequence_id"]].append(r)
    for parts in seen.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in made)
    want = Counter()
    for doc_id, x in ids:
        want.update((doc_id, k, a, n, zlib.crc32(np.array(x[a : a + n], "<u4").tobytes())) for k, (a, n) in enumerate(P.cuts(len(x), capacity)))
    assert got == want
    return len(seen)


@pytest.mark.parametrize("shard_items", [3, 65_536])
def test_packing(edge, empty, reference_ids, shard_items):
    ids = [(r[0], [*reference_ids(r[1] or ""), 0]) for r in ROWS]
    made = P.pack(edge, shard_items=shard_items).collect()
    check_packing(made, ids, 2048)
    assert P.pack(empty).count() == 0


@pytest.mark.parametrize("shard_items", [40, 65_536])
def test_every_piece_lies_where_the_squares_are_least(docs, shard_items):
    """The bins of the result itself, shard by shard, against brute force over their gaps."""
    rng = random.Random(6)
    texts = [" ".join(["word"] * (rng.randint(1, 200) if k % 2 else rng.choice((31, 64, 97)))) for k in range(300)]
    made = P.pack(docs([(k, x, None, None) for k, x in enumerate(texts)]).repartition(5), capacity=256, shard_items=shard_items).collect()
    shards = defaultdict(lambda: defaultdict(list))
    for r in made:
        if r["length"] < 256:
            shards[r["sequence_id"] >> 32][r["sequence_id"]].append(r["length"])
    assert len(shards) == max(1, -(-300 // shard_items))
    for bins in shards.values():
        lengths = sorted((n for x in bins.values() for n in x), reverse=True)
        gaps = Counter()
        for g, n in zip(brute_sum_of_squares(lengths, 256), lengths, strict=True):
            gaps[g] -= 1
            gaps[g - n] += 1
        del gaps[256]  # new sequences
        assert Counter(256 - sum(x) for x in bins.values()) == +gaps


def test_cuts():
    assert P.cuts(1) == [(0, 1)] and P.cuts(2048) == [(0, 2048)] and P.cuts(5000) == [(0, 904), (904, 2048), (2952, 2048)]


def brute_sum_of_squares(lengths, capacity):
    gaps, bins = Counter(), []
    for s in lengths:
        options = []
        for g in sorted({g for g in gaps if gaps[g] and g >= s} | {capacity}):
            after = Counter(gaps)
            if g < capacity:
                after[g] -= 1
            if g > s:
                after[g - s] += 1
            options.append((sum(n * n for n in after.values()), g, after))
        _, g, gaps = min(options, key=lambda x: x[:2])
        bins.append(g)
    return bins


def test_sum_of_squares_takes_the_smallest_sum():
    rng = random.Random(2)
    lengths = [rng.randint(1, 20) for _ in range(300)]
    bins = P.sum_of_squares(np.array(lengths), 20)
    fill, chosen = Counter(), []
    for b, s in zip(bins.tolist(), lengths, strict=True):
        chosen.append(20 - fill[b])
        fill[b] += s
    assert max(fill.values()) <= 20 and chosen == brute_sum_of_squares(lengths, 20)


def test_few_sequences():
    lengths = np.random.default_rng(3).integers(1, 1200, 20_000)
    assert len(np.unique(P.pack_lengths(lengths))) <= 1.005 * -(-lengths.sum() // 2048)


def schedule_of(spark, weights, period):
    w = spark.createDataFrame([(f"s{k}", f"s{k}", x, k, period) for k, x in enumerate(weights)], "source string, name string, w long, j int, period long")
    return [r["j"] for r in X.schedule(w).orderBy("slot").collect()]


@pytest.mark.parametrize("weights", [[32, 32], [57, 7], [1, 1, 62], [5, 9, 13, 17, 20], [1] * 20 + [44], [64], [31, 1] + [2] * 16])
def test_deviation_is_less_than_a_block(spark, weights):
    period = sum(weights)
    order = schedule_of(spark, weights, period)
    assert len(order) == period
    done = [0] * len(weights)
    for t, j in enumerate(order, 1):
        done[j] += 1
        assert all(abs(d - w * t / period) < 1 for d, w in zip(done, weights, strict=True))


def plain_schedule(weights, period):
    """Slot by slot over all sources: earliest deadline first, of equal ones the smallest number."""
    done, out = [0] * len(weights), []
    for t in range(period):
        due = [(-(-(done[i] + 1) * period // w), i) for i, w in enumerate(weights) if done[i] < w and done[i] * period // w <= t]
        out.append(min(due)[1])
        done[out[-1]] += 1
    return out


@pytest.mark.parametrize("seed", range(4))
def test_sources_of_one_weight_take_turns_as_single_ones_would(spark, seed):
    rng = random.Random(seed)
    weights = [rng.choice([1, 1, 2, 3, 5, rng.randint(1, 60)]) for _ in range(rng.randint(2, 40))]
    assert schedule_of(spark, weights, sum(weights)) == plain_schedule(weights, sum(weights))


def test_very_many_sources(spark):
    """A source per site: more of them than slots of a chunk, all in their windows."""
    n = 5000
    frame = spark.range(2 * n).selectExpr("id as doc_id", "repeat('x', cast(1 + id % 7 as int)) as text", f"concat('site', id % {n}) as source")
    made = X.mixing_plan(frame, block_chars=4)
    parts = made.agg(F.count("*"), F.countDistinct("slot"), F.countDistinct("source", "block"), F.count_if((F.col("release") <= F.col("slot")) & (F.col("slot") < F.col("deadline")))).first()
    assert parts[3] == parts[0] and parts[1] == parts[2]


def test_mixing_rows(edge, empty, docs):
    made = X.mixed(edge, block_chars=64)
    assert made.columns == edge.columns and Counter(tuple(r) for r in made.collect()) == Counter(tuple(r) for r in edge.collect())
    assert X.mixed(empty).count() == X.mixing_plan(empty).count() == 0
    rows = [(k, "x" * 10, None, "hot" if k % 3 else f"s{k % 4}") for k in range(3000)] + [(5000, "y", None, None)]
    plan = X.mixing_plan(docs(rows), targets={"hot": 0.5, "s0": 0.2, "s1": 0.2, "s2": 0.1}, block_chars=100).collect()
    assert {r["doc_id"] for r in plan} == {r[0] for r in rows} and all(r["release"] <= r["slot"] < r["deadline"] for r in plan)
    block = defaultdict(set)
    for r in plan:
        block[r["slot"]].add((r["source"], r["block"]))
    assert all(len(x) == 1 for x in block.values())  # one block a slot
    horizon = 60
    n = Counter(next(iter(block[t]))[0] for t in range(horizon) if t in block)
    assert abs(n["hot"] - horizon * 0.5) <= 2


def check_parts(plan, lengths):
    """Parts of a document follow each other and cover it."""
    parts = defaultdict(list)
    for r in plan:
        parts[r["doc_id"]].append((r["start"], r["size"]))
    assert parts.keys() == lengths.keys()
    for k, x in parts.items():
        x.sort()
        assert [a for a, _ in x] == [sum(n for _, n in x[:i]) for i in range(len(x))] and sum(n for _, n in x) == lengths[k] and all(n > 0 for _, n in x)


def test_emitted_characters_deviate_by_less_than_a_block(docs):
    rng, block = random.Random(4), 100
    weights = {"a": 0.5, "b": 0.3, "c": 0.2}
    rows = [(k, "x" * rng.choice((3, 40, 250, 1700)), None, rng.choice("abc")) for k in range(900)]
    plan = X.mixing_plan(docs(rows), targets=weights, block_chars=block).collect()
    check_parts(plan, {r[0]: len(r[1]) for r in rows})
    sent = defaultdict(Counter)
    for r in plan:
        sent[r["slot"]][r["source"]] += r["size"]
    full = {s: sum(len(r[1]) for r in rows if r[3] == s) // block for s in weights}
    last = min(max(t for t, n in sent.items() if n[s] == block) for s in weights)
    share = {s: r["w"] for s, r in weights_of(docs, rows, weights).items()}
    done, slots = Counter(), 0
    for t in range(last + 1):
        assert list(sent[t].values()) == [block]
        done.update(sent[t])
        slots += 1
        assert all(abs(done[s] - block * slots * w / 1024) < block for s, w in share.items())
    assert slots > 300 and any(done[s] == block * full[s] for s in weights)  # until the first source has no full block left


def weights_of(docs, rows, targets):
    sizes = docs(rows).groupBy("source").agg(F.sum(F.length("text")).alias("size")).withColumn("name", F.col("source"))
    return {r["source"]: r for r in X.source_weights(sizes, targets, None).collect()}


def test_rows_without_ids_are_spread(docs):
    rows = [(None, f"text {k}", None, "a") for k in range(500)] + [(7, "y" * k, None, "a") for k in range(1, 500)]
    made = docs(rows).select(F.substring(X._digest("doc_id", "text"), 1, 3).alias("bucket"))
    assert made.groupBy("bucket").count().agg(F.max("count")).first()[0] < 10


def test_the_period_grows_with_the_sources(docs):
    made = X.mixing_plan(docs([(k, "x" * 30, None, f"s{k}") for k in range(300)]), block_chars=10)
    plan = made.collect()
    assert len(plan) == 900 and all(r["release"] <= r["slot"] < r["deadline"] for r in plan)
    assert len({(r["source"], r["block"]) for r in plan}) == 900 == len({r["slot"] for r in plan})
    assert max(r["deadline"] for r in plan if r["block"] == 0) > 256  # 2048 slots for 300 sources


def test_a_given_period_with_fewer_slots_than_sources_fails(docs):
    with pytest.raises(Exception, match="more sources"):
        X.mixing_plan(docs([(k, "x", None, f"s{k}") for k in range(40)]), period=32).collect()


def tune(rng, n=24):
    return [rng.uniform(-3, 3) for _ in range(2 * n)]


def noisy(audio, noise, level=0.02):
    x, rate = A.decode(audio)
    return A.wav(np.clip(x + noise.normal(0, level, len(x)), -1, 1) * 20_000, rate)


def brute_aligned(x, y):
    return any(e <= A.limit(n) for e, n in (A.bit_error(x, y, k) for k in range(-len(x), len(y))))


@pytest.mark.parametrize(("seed", "level"), [(8, 0.02), (21, 0.02), (22, 0.02), (23, 0.02), (24, 0.02), (8, 0.1), (24, 0.1)])
def test_chroma_search_meets_what_brute_force_aligns(spark, seed, level):
    rng, noise = random.Random(seed), np.random.default_rng(seed)
    vectors = [tune(rng) for _ in range(60)]
    rows = [(k, A.rendered(v, k % 7)) for k, v in enumerate(vectors)]
    rows += [(100 + k, noisy(A.rendered(v, (k + 3) % 7), noise, level)) for k, v in enumerate(vectors)]
    marked = A.fingerprints(spark.createDataFrame([(i, bytearray(a)) for i, a in rows], "id long, audio binary"), "id", "audio").persist()
    members, matches = A.search(marked, F.col("rec_id") < 60)
    name = {bytes(r["class"]): r["class_id"] for r in members.collect()}
    found = {(name[bytes(r["query_class"])], r["match_id"]) for r in matches.collect()}
    prints = {r["rec_id"]: np.frombuffer(bytes(r["fingerprint"]), "<u4") for r in marked.collect()}
    want = {(q, o) for q in range(60) for o in prints if q != o and brute_aligned(prints[q], prints[o])}
    assert {(k, 100 + k) for k in range(60)} <= want and found <= want
    assert len(found & want) >= 0.95 * len(want)


def test_chroma_classes_and_ids(spark, monkeypatch):
    monkeypatch.setattr(A, "HOT", 2)  # nearly every key is split
    rng, noise = random.Random(3), np.random.default_rng(3)
    one, two, three = (A.rendered(tune(rng), 2) for _ in range(3))
    rows = [(0, one), (1, noisy(one, noise)), (1, noisy(two, noise)), (2, two), (303, one), (None, noisy(one, noise)), (None, None), (300, None), (301, b"junk"), (302, A.wav(np.zeros(10), 4000)), (304, A.wav(np.zeros(40_000), 4000)), (305, A.wav(np.zeros(50_000), 4000)), (4, three)]
    marked = A.fingerprints(spark.createDataFrame([(i, bytearray(a) if a is not None else None) for i, a in rows], "id long, audio binary"), "id", "audio").persist()
    members, matches = A.search(marked, F.col("rec_id") != 1)
    by = {r["rec_id"]: r for r in members.collect()}
    assert members.count() == len(rows) and by[303]["class_id"] == 0 and by[300]["n_values"] == by[302]["n_values"] == 0 and by[300]["class_id"] == by[301]["class_id"] == 300
    name = {bytes(r["class"]): r["class_id"] for r in members.collect()}
    got = Counter((name[bytes(r["query_class"])], r["match_id"], r["offset"]) for r in matches.collect())
    assert got == Counter({(0, 1, 0): 1, (2, 1, 0): 1, (0, None, 0): 1})  # both recordings of id 1, each by its own fingerprint
    assert A.search(marked.limit(0), F.lit(True))[1].count() == 0


def test_chroma_finds_a_shared_passage(spark):
    """Less than half of two long recordings is the same, at different places."""
    rng = random.Random(5)
    shared, a, b = (np.concatenate([A.decode(A.rendered(tune(rng), 0))[0] for _ in range(n)]) * 30_000 for n in (2, 3, 4))
    rows = [(1, A.wav(np.concatenate([a, shared]), A.RATE)), (2, A.wav(np.concatenate([shared, b]), A.RATE)), (3, A.wav(b[::-1], A.RATE))]
    marked = A.fingerprints(spark.createDataFrame([(i, bytearray(x)) for i, x in rows], "id long, audio binary"), "id", "audio").persist()
    _, matches = A.search(marked, F.col("rec_id") == 1)
    got = matches.collect()
    assert [r["match_id"] for r in got] == [2]
    assert abs(got[0]["offset"] + len(a) / (1024 // 3)) <= 1 and got[0]["overlap"] > 100


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_the_query_meets_the_copies_in_its_own_rows(spark):
    from loomstat.llm import queries

    made = queries.QUERIES["op6_chroma_fingerprints"](spark, "/root/testdata/sf0.001").collect()
    asked = {r["vec_id"] for r in made if r["is_query"] and r["vec_id"] + 1 in {x["vec_id"] for x in made}}
    met = {r["vec_id"] for r in made if r["match_class"] == r["vec_id"] + 1}
    assert len(asked) >= 10 and len(met & asked) >= 0.9 * len(asked)
    assert all(r["match_class"] in (None, r["vec_id"] + 1) for r in made)


def test_the_limit_tightens_with_the_overlap():
    limits = [A.limit(n) for n in range(A.LEAST_OVERLAP, 200)]
    assert limits == sorted(limits) and limits[-1] == A.MAX_BIT_ERROR and A.limit(16) < 0


def test_wav_forms():
    x = np.array([0, 1000, -1000, 32_000], dtype=np.int16)
    y, rate = A.decode(A.wav(x, 8000))
    assert rate == 8000 and np.allclose(y * 32_768, x)
    assert len(A.decode(b"RIFF\x00\x00\x00\x00WAVEfmt ")[0]) == len(A.decode(None)[0]) == 0


def test_integral_image_filters_use_the_whole_image():
    for plus, minus in A.filters():
        assert all(0 <= x and x + w <= A.WIDTH and 0 <= y and y + h <= 12 for x, y, w, h in plus + minus)
        assert sum(w * h for _, _, w, h in plus) == sum(w * h for _, _, w, h in minus)


@pytest.mark.parametrize("shard_items", [400, 65_536])
def test_sequences_in_order_have_the_shares_of_the_mixture(spark, docs, shard_items):
    rng = random.Random(5)
    weights = {"a": 0.5, "b": 0.3, "c": 0.2}
    rows = []
    for s, w in weights.items():
        size = 0
        while size < w * 6_000_000:
            rows.append((len(rows), " ".join(["word"] * rng.choice((20, 200, 1000, 6000))), None, s))
            size += len(rows[-1][1])
    rng.shuffle(rows)
    by = {r[0]: r[3] for r in rows}
    made = P.pack_in_order(X.mix(docs(rows).repartition(7), targets=weights), shard_items=shard_items, window=100).collect()
    check_packing(made, [(r[0], [*P.encoder().encode_to_numpy(r[1]).tolist(), 0]) for r in rows], 2048)
    tokens = defaultdict(Counter)
    for r in made:
        tokens[r["sequence_id"]][by[r["doc_id"]]] += r["length"]
    order = sorted(tokens)
    assert len(order) <= 1.05 * -(-sum(r["length"] for r in made) // 2048)
    worst = 0
    for a in range(0, int(0.9 * len(order)) - 100, 50):
        n = sum((tokens[q] for q in order[a : a + 100]), Counter())
        worst = max(worst, *(abs(n[s] / n.total() - w) for s, w in weights.items()))
    assert worst < 0.04  # packing by hash of a piece number: 0.068


def test_packing_in_order_of_edges(edge, empty, reference_ids):
    check_packing(P.pack_in_order(X.mix(edge)).collect(), [(r[0], [*reference_ids(r[1] or ""), 0]) for r in ROWS], 2048)
    assert P.pack_in_order(X.mix(empty)).count() == 0
