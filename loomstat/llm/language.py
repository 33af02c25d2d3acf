"""Language identification with a language-bitmask n-gram filter.

The filter is a bit-sliced Bloom filter: a table of slots that each hold one bit per language.
A query takes the slots of an n-gram's ``HASHES`` hashes and ANDs them; the bits left name
every language that contains the n-gram. Over a text, the popcount of each language is
corrected for false positives with the fill of that language's slice, and the largest
corrected count decides.

Training: the rows given, at most ``per_language`` distinct ones of each language (those with the
smallest hash of id and text; a documented bound for the classifier's sample), whole texts. An n-gram enters
a language's filter if the language has it at least ``MIN_COUNT`` times and at no less than
``RATIO`` of the highest rate that any language has it; at most ``GRAMS`` n-grams a language,
the most frequent first.

N-grams: ``WIDTH`` characters of the lowered text in which every run of other characters than
letters is one blank; those with a blank inside are left out. Texts are read whole.

Defined cases: a text that is null or has no letter is ``und`` with score 0; a text without a
known n-gram gets the language with most training rows and score 0; ties go to the language
that sorts first; without training rows every text is ``und``; ids may be null or repeated.
The column that ``predicted`` adds must not be there already (an error).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, chunks, sampled_texts, saved, strings, unused

WIDTH = 4
HASHES = 2
MIN_COUNT = 3
RATIO = 0.25
GRAMS = 65_536
PER_LANGUAGE = 2_000
#: Slots of the filter per n-gram of the largest language.
SLOTS_PER_GRAM = 8
MIX = np.uint64(0x9E3779B97F4A7C15)


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(k).isalpha() for k in range(0x110000)), dtype=bool, count=0x110000)


def grams(parts: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of the parts, the part of each, and the letters in each part."""
    lowered = [f" {x.lower()} " for x in parts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    sizes = np.fromiter(map(len, lowered), dtype=np.int64, count=len(lowered))
    part = np.repeat(np.arange(len(parts)), sizes)
    letter = _letters()[points]
    stay = letter.copy()
    stay[1:] |= letter[:-1]
    stay[0] = True
    first = np.cumsum(sizes)[:-1]
    stay[first] = True  # each part begins with a blank
    code = np.where(letter, points, 32)[stay].astype(np.uint64)
    part, letter = part[stay], letter[stay]
    n = len(code) - width + 1
    counts = np.bincount(part, weights=letter, minlength=len(parts)).astype(np.int64)
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), counts
    h = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        h = (h ^ code[k : k + n]) * MIX
        h ^= h >> np.uint64(29)
    good = part[:n] == part[width - 1 :]
    for k in range(1, width - 1):
        good &= letter[k : k + n]
    return h[good], part[:n][good], counts


@dataclass
class LanguageFilter:
    languages: list[str]
    slots: np.ndarray  # slots x words of 64 languages
    false_rate: np.ndarray
    fallback: int
    width: int = WIDTH

    def masks(self, h: np.ndarray) -> np.ndarray:
        found = self.slots[_slot(h, 0, len(self.slots))]
        for k in range(1, HASHES):
            found = found & self.slots[_slot(h, k, len(self.slots))]
        return found

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[float]]:
        """Language, its score (share of the evidence for any language) and its share of all n-grams of the text."""
        n_lang = len(self.languages)
        hits, total, letters = np.zeros((len(texts), n_lang)), np.zeros(len(texts)), np.zeros(len(texts))
        for at, parts in chunks(texts, self.width - 1):
            h, part, found = grams(parts, self.width)
            at = np.asarray(at)
            np.add.at(letters, at, found)
            masks = self.masks(h)
            np.add.at(total, at, np.bincount(part, minlength=len(parts)))
            for k in range(n_lang):
                bit = (masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)
                np.add.at(hits[:, k], at, np.bincount(part, weights=bit, minlength=len(parts)))
        if not n_lang:
            return ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        right = np.maximum(0, (hits - total[:, None] * self.false_rate) / (1 - self.false_rate))
        best = right.argmax(axis=1)
        top, whole = right.max(axis=1), right.sum(axis=1)
        best = np.where(top > 0, best, self.fallback)
        score = np.where(whole > 0, top / np.maximum(whole, 1e-300), 0.0)
        names = [self.languages[b] if n else "und" for b, n in zip(best, letters, strict=True)]
        return names, np.where(letters > 0, score, 0.0).tolist(), np.where(letters > 0, top / np.maximum(total, 1), 0.0).tolist()


def _slot(h: np.ndarray, k: int, size: int) -> np.ndarray:
    h = h * np.uint64(0xD6E8FEB86659FD93 + 2 * k)
    return ((h ^ (h >> np.uint64(32))) & np.uint64(size - 1)).astype(np.int64)


def build(rows: list[tuple[str, int, int]], n_docs: dict[str, int], width: int = WIDTH) -> LanguageFilter:
    """The filter from (language, n-gram hash, count) rows; n_docs: training rows by language."""
    languages = sorted(n_docs)
    at = {x: k for k, x in enumerate(languages)}
    words = max(1, (len(languages) + 63) // 64)
    lang = np.array([at[x] for x, _, _ in rows], dtype=np.int64)
    gram = np.array([g for _, g, _ in rows], dtype=np.int64).view(np.uint64)
    count = np.array([c for _, _, c in rows], dtype=np.float64)
    sizes = np.maximum(1, np.bincount(lang, weights=count, minlength=len(languages)))
    if len(rows):
        rate = count / sizes[lang]
        own, back = np.unique(gram, return_inverse=True)
        most = np.zeros(len(own))
        np.maximum.at(most, back, rate)
        stay = rate >= RATIO * most[back]
        lang, gram = lang[stay], gram[stay]
    largest = int(np.bincount(lang, minlength=1).max()) if len(lang) else 1
    size = 1 << max(10, (SLOTS_PER_GRAM * largest - 1).bit_length())
    slots = np.zeros((size, words), dtype=np.uint64)
    for k in range(HASHES):
        np.bitwise_or.at(slots, (_slot(gram, k, size), lang // 64), np.uint64(1) << (lang % 64).astype(np.uint64))
    fill = np.array([((slots[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(languages))])
    fallback = max(range(len(languages)), key=lambda k: (n_docs[languages[k]], -k), default=0)
    return LanguageFilter(languages, slots, fill**HASHES, fallback, width)


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, width: int = WIDTH) -> LanguageFilter:
    """Fit on at most ``per_language`` distinct rows (id and text) of each language; rows without a language or text are left out."""
    rows = rows.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    named = rows.select(F.col(id_col).alias("__id"), F.col(lang_col).alias("__lang"), F.col(text_col).alias("__text"))
    texts = saved(sampled_texts(named, "__lang", "__text", per_language, "language", "__id"), "sample")
    n_docs = {r["__lang"]: r["count"] for r in texts.groupBy("__lang").count().collect()}
    if not n_docs:
        return build([], {}, width)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in batches_of(batch.column(1)):
                langs, part_texts = batch.column(0).slice(a, b - a).to_pylist(), strings(batch.column(1).slice(a, b - a))
                for at, parts in chunks(part_texts, width - 1):
                    h, part, _ = grams(parts, width)
                    names = [langs[k] for k in at]
                    for name in sorted(set(names)):
                        mine = np.array([x == name for x in names])
                        values, n = np.unique(h[mine[part]], return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    counted = texts.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)
    ranked = counted.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).filter(F.col("k") <= GRAMS)
    return build([tuple(r) for r in ranked.select("lang", "gram", "n").collect()], n_docs, width)


def predicted(docs: DataFrame, model: LanguageFilter, text_col: str = "text", name: str = "__lang"):
    """``docs`` with a struct column ``name`` of (lang_pred, score, share), see ``LanguageFilter.predict``."""
    unused(docs, name)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # slots and languages are bounded, see GRAMS

    @F.arrow_udf("struct<lang_pred:string, score:double, share:double>")
    def predict(texts: pa.Array) -> pa.Array:
        made: tuple[list, list, list] = ([], [], [])
        for a, b in batches_of(texts):
            for column, x in zip(made, shared.value.predict(strings(texts.slice(a, b - a))), strict=True):
                column += x
        types = (pa.string(), pa.float64(), pa.float64())
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(made, types, strict=True)], names=["lang_pred", "score", "share"])

    return docs.withColumn(name, predict.asNondeterministic()(F.col(text_col)))
