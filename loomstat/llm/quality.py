"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is a linear score of features of its whole text. Training takes pairs of
a document that is marked good and one that isn't, models the odds that the first wins by the
difference of their scores, and minimises the logistic loss on the feature differences (Newton
steps with a ridge). Documents are then judged by a quantile of the score: the threshold is the
quantile of the training scores that leaves as large a share below it as is marked bad.

    score = 1 / (1 + exp(-(strength - threshold) / scale)),  predicted = score >= 0.5

Features: shares of byte classes and of single ASCII symbols, word lengths, repeats of words
and lines, line lengths, sizes. Only texts are read; ids and sources never enter a feature.

All labelled rows are learned from. Spark deals them to blocks of about ``BLOCK`` rows by a hash of
the id, a block is one row of a table, and pairs are made inside blocks, so a Newton step is a sum
over blocks of which the driver gets the total. Mean, spread and threshold (an exact order
statistic) are of all rows. A block with one label only makes no pairs. ``per_label`` bounds the
rows of a label only where a caller asks for it.

Defined cases: null text counts as empty and gets a score like any other; rows without a label
aren't learned from; a label without rows leaves a model that scores every text with the share
of good labels; ids may be null or repeat (each row is scored); an empty table gives an empty
result. The column that ``scored`` adds must not be there already (an error).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, bounded_sample, new_path, saved, strings, text_of, unused

#: Labelled rows of a block, about; a block is held whole by a task (432 bytes a row).
BLOCK = 1_000
#: Strengths that are sorted on the driver when the quantile has been narrowed down to them.
FEW = 10_000
#: Pairs in which each document of the smaller class stands.
PAIRS = 20
RIDGE = 1e-3
NEWTON_STEPS = 25
SYMBOLS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
N_FEATURES = 22 + len(SYMBOLS)


def features(text: str) -> np.ndarray:
    raw = text.encode("utf-8", "surrogatepass")
    out = np.zeros(N_FEATURES)
    size = len(raw)
    out[0] = np.log1p(size)
    if not size:
        out[1] = 1
        return out
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower, digits = bytes_[65:91].sum(), bytes_[97:123].sum(), bytes_[48:58].sum()
    blank, high = bytes_[9:14].sum() + bytes_[32], bytes_[128:].sum()
    out[2:7] = np.array([upper, lower, digits, blank, high]) / size
    out[7] = (bytes_[:32].sum() - bytes_[9:14].sum()) / size
    words = raw.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1, np.int64)
    counts = Counter(words)
    top = [c for _, c in counts.most_common(5)] or [0]
    out[8], out[9], out[10] = np.log1p(len(words)), lengths.mean() / 10, lengths.std() / 10
    out[11], out[12] = np.log1p(lengths.max()), (lengths <= 3).mean()
    out[13], out[14], out[15] = len(counts) / n, top[0] / n, sum(top) / n
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n_lines = max(1, len(lines))
    out[16], out[17] = np.log1p(len(lines)), 1 - len(set(lines)) / n_lines
    out[18] = np.log1p(size / n_lines)
    out[19] = sum(x.rstrip()[-1:] in b".!?" for x in lines) / n_lines
    out[20] = sum(not w[:1].isalpha() and w[0] < 128 for w in words) / n
    out[21] = sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / n
    out[22:] = np.sqrt(bytes_[np.frombuffer(SYMBOLS, np.uint8)] / size)
    return out


@dataclass
class Ranker:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    scale: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        x = np.stack([features(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip((self.strength(x) - self.threshold) / self.scale, -30, 30)))


def one_label(share: float) -> Ranker:
    """The model that scores every text with the share of good labels."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Ranker(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), float(-np.log(share / (1 - share))), 1.0)


def standard(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / spread, -8, 8)


def paired(z: np.ndarray, good: np.ndarray, seed: int) -> np.ndarray:
    """Differences of pairs: every document of the smaller class stands in PAIRS pairs, the others about equally often."""
    winners, losers = z[good == 1], z[good == 0]
    rng = np.random.default_rng(seed)
    n = PAIRS * min(len(winners), len(losers))
    return winners[np.resize(rng.permutation(len(winners)), n)] - losers[np.resize(rng.permutation(len(losers)), n)]


def slopes(diff: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over pairs of the loss's first and second derivatives."""
    p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))  # odds that the winner wins
    return diff.T @ (p - 1), (diff * (p * (1 - p))[:, None]).T @ diff


def newton(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, float]]) -> np.ndarray:
    """The weights of least loss; ``sums`` gives both derivatives summed over pairs, and the number of pairs."""
    w = np.zeros(N_FEATURES)
    for _ in range(NEWTON_STEPS):
        gradient, hessian, n = sums(w)
        if not n:
            break
        step = np.linalg.solve(hessian / n + RIDGE * np.eye(len(w)), gradient / n + RIDGE * w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(x: np.ndarray, good: np.ndarray, seed: int = 7) -> Ranker:
    """The ranker from features and marks (1 good, 0 not) of one block."""
    share = float(good.mean()) if len(good) else 0.5
    if not len(good) or share in (0.0, 1.0):
        return one_label(share)
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread = np.where(spread < 1e-9, 1.0, spread)
    z = standard(x, mean, spread)
    diff = paired(z, good, seed)
    w = newton(lambda w: (*slopes(diff, w), len(diff)))
    strength = np.sort(z @ w)
    below = int((good == 0).sum())  # the quantile: halfway between the scores that it parts
    return Ranker(mean, spread, w, float(strength[below - 1 : below + 1].mean()), 1.0)


def _batch_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [features(x.as_py()).tolist() for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(made, pa.list_(pa.float64()))], names=["__id", "hash", "x"])


def _block(rows: pa.Table) -> pa.Table:
    """The rows of a block as one row, in the order of ids whatever order they came in."""
    rows = rows.sort_by([("__id", "ascending"), ("mark", "ascending")])
    x = np.array(rows.column("x").to_pylist(), dtype="<f8")
    good = (rows.column("mark").to_numpy() == 1).astype(np.int8)
    return pa.table({"block": rows.column("block")[:1].combine_chunks(), "good": pa.array([good.tobytes()]), "x": pa.array([x.tobytes()])})


def _of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block, marks, features) of blocks."""
    for batch in batches:
        for k, good, x in zip(*batch.columns, strict=True):
            yield k.as_py(), np.frombuffer(good.as_buffer(), np.int8), np.frombuffer(x.as_buffer(), "<f8").reshape(-1, N_FEATURES)


def _summed(blocks: DataFrame, of: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over blocks of an array that ``of`` makes of each: summed in tasks, then per place of the array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _of_blocks(batches):
            made = of(*block)
            total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "v"])

    found = blocks.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    return np.array([r["v"] for r in sorted(found, key=lambda r: r["at"])])


def nth(values: DataFrame, column: str, n: int) -> float:
    """The n-th smallest value (from 0), exactly: counts per bin narrow it down until few are left to sort."""
    c = F.col(column)
    low, high, held = values.agg(F.min(c), F.max(c), F.count(c)).first()
    while held > FEW and low < high:
        width = (high - low) / 1024
        here = values.filter((c >= low) & (c <= high)).groupBy(F.least(F.lit(1023), F.floor((c - low) / width)).alias("bin") if width else F.lit(0).alias("bin"))
        for _, low, high, held in sorted(here.agg(F.min(c), F.max(c), F.count(c)).collect()):
            if n < held:
                break
            n -= held
    return low if low == high else sorted(r[0] for r in values.filter((c >= low) & (c <= high)).select(c).collect())[n]


def fit_blocks(blocks: DataFrame, seed: int = 7) -> Ranker:
    """``fit`` over a table of blocks; of a single block it is the same."""
    size = _summed(blocks, lambda _, good, x: np.array([float(len(good)), float(good.sum())]))
    if not len(size) or size[1] in (0.0, size[0]):
        return one_label(size[1] / size[0] if len(size) else 0.5)
    mean = _summed(blocks, lambda _, good, x: x.sum(axis=0)) / size[0]
    spread = np.sqrt(_summed(blocks, lambda _, good, x: ((x - mean) ** 2).sum(axis=0)) / size[0])
    spread = np.where(spread < 1e-9, 1.0, spread)
    upper = np.triu_indices(N_FEATURES)

    def sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        def of(block: int, good: np.ndarray, x: np.ndarray) -> np.ndarray:
            diff = paired(standard(x, mean, spread), good, seed + block) if 0 < good.sum() < len(good) else np.empty((0, N_FEATURES))
            gradient, hessian = slopes(diff, w)
            return np.concatenate([[float(len(diff))], gradient, hessian[upper]])

        found = _summed(blocks, of)
        hessian = np.zeros((N_FEATURES, N_FEATURES))
        hessian[upper] = found[1 + N_FEATURES :]
        return found[1 : 1 + N_FEATURES], hessian + np.triu(hessian, 1).T, found[0]

    w = np.round(newton(sums), 9)  # sums come in no fixed order

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, x in _of_blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(standard(x, mean, spread) @ w)], names=["strength"])

    made = saved(blocks.mapInArrow(strengths, "strength double"), "quality-strengths")
    below = int(size[0] - size[1])
    return Ranker(mean, spread, w, (nth(made, "strength", below - 1) + nth(made, "strength", below)) / 2, 1.0)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_label: int | None = None) -> Ranker:
    """Fit on all rows of ``docs`` that ``labels`` marks, one text for an id that repeats (the one with the smallest hash).

    Features are made of every row of ``docs``, marked or not: leave out rows that can't be marked beforehand.
    """
    marks = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("mark")).distinct()
    if per_label is not None:
        key = F.xxhash64(F.lit("quality"), F.col("__id"))
        marks = marks.withColumn("__key", key).join(F.broadcast(bounded_sample(marks, "mark", key, per_label)), ["mark", "__key"]).drop("__key")  # 2 x per_label rows
    n = max(1, -(-marks.count() // BLOCK))
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("__id"), text_of(text_col).alias("text")).select("__id", F.xxhash64("text").alias("hash"), "text")
    each = rows.mapInArrow(_batch_features, "__id long, hash long, x array<double>").groupBy("__id").agg(F.min_by("x", "hash").alias("x"))
    # features go through the shuffle, texts don't; sorted at every size, as labels grow with the documents
    dealt = each.join(marks.hint("merge"), "__id").withColumn("block", F.pmod(F.xxhash64(F.lit("block"), F.col("__id")), F.lit(n)))
    made = dealt.groupBy("block").applyInArrow(_block, "block long, good binary, x binary")
    path = new_path(docs.sparkSession, "quality-blocks")
    made.write.option("compression", "none").parquet(path)  # a task reads as many bytes as a split has
    return fit_blocks(docs.sparkSession.read.schema(made.schema).parquet(path))


def scored(docs: DataFrame, model: Ranker, text_col: str = "text", name: str = "__quality") -> DataFrame:
    """``docs`` with a struct column ``name`` of (score, predicted)."""
    unused(docs, name)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<score:double, predicted:int>")
    def judge(texts: pa.Array) -> pa.Array:
        out = [shared.value.score(strings(texts.slice(a, b - a))) for a, b in batches_of(texts)]
        score = np.concatenate(out) if out else np.empty(0)
        return pa.StructArray.from_arrays([pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["score", "predicted"])

    return docs.withColumn(name, judge.asNondeterministic()(F.col(text_col)))
