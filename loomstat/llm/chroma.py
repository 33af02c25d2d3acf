"""Chroma audio fingerprints: index, search and alignment of recordings.

A recording is a WAV file (PCM). Its spectrum is folded into twelve pitch classes per frame;
sixteen filters compare rectangles of this image (sums by an integral image) and each gives two
bits in Gray code, so every position of the image is a packed 32-bit integer.

Search: equal fingerprints are one class, named by their digest. The index key of a position is
the sign bits (the bits that noise turns last) of three integers ``GAP`` apart, so that unrelated
recordings hardly ever share one. A query also asks for the keys that differ from its own in one
bit, since noise can turn a sign. Query and indexed classes meet where they share a key; each
meeting votes for the offset between their positions, and every offset with votes is checked by
bit errors over the overlap.

A pair aligns at an offset if the share of differing bits is at most ``limit(overlap)``: that of
unrelated recordings falls below it at odds of about one in a million. Neighbouring positions
share most of their frames, so a position counts as 2 independent bits (32 bits over windows of
``WIDTH`` frames): with n positions the share has mean 1/2 and deviation 1 / (2 sqrt(2 n)), the
limit is ``SIGMAS`` deviations below the mean and at most ``MAX_BIT_ERROR``. Overlaps below
``LEAST_OVERLAP`` positions, the length of a key, aren't looked at. Of the offsets that align,
the one furthest below its limit is reported.

A run of one key (a held chord) counts once, at its first position, so that it can't outvote the
rest; silence has no key. Keys that more than ``HOT`` classes hold are dealt out to several tasks.
Recordings of no more than 2 * ``GAP`` positions have no key.

Defined cases: null or undecodable audio and audio shorter than a filter has an empty
fingerprint, is in the class of the empty fingerprint and matches nothing; ids may be null
(never a query, but found by others: class_id is null where no recording of a class has an id)
or repeated (classes with one class_id stay apart); an empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

#: Frame of the spectrum in seconds (rounded to a power of two of samples); frames overlap by two thirds.
FRAME_S = 0.25
LOW_HZ, HIGH_HZ = 55.0, 3520.0
WIDTH = 16
MAX_BIT_ERROR = 0.25
SIGMAS = 4.75
GAP = 8
LEAST_OVERLAP = 2 * GAP + 1
#: Classes of one key that one task takes.
HOT = 4096
SIGNS = 0xAAAAAAAA


def wav(samples: np.ndarray, rate: int) -> bytes:
    data = samples.astype("<i2").tobytes()
    return b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, 2 * rate, 2, 16) + b"data" + struct.pack("<I", len(data)) + data


def decode(audio: bytes | None) -> tuple[np.ndarray, int]:
    """Mono samples in [-1, 1] and the rate; no samples if it isn't PCM in a WAV file."""
    nothing = np.empty(0, dtype=np.float32), 1
    if not audio or audio[:4] != b"RIFF" or audio[8:12] != b"WAVE":
        return nothing
    at, form = 12, None
    while at + 8 <= len(audio):
        kind, size = audio[at : at + 4], struct.unpack_from("<I", audio, at + 4)[0]
        body = audio[at + 8 : at + 8 + size]
        if kind == b"fmt " and len(body) >= 16:
            form = struct.unpack_from("<HHIIHH", body)
        elif kind == b"data" and form and form[0] == 1 and form[5] in (8, 16, 32) and form[1] and form[2]:
            width = form[5] // 8 * form[1]
            body = body[: len(body) // width * width]
            x = np.frombuffer(body, {8: "u1", 16: "<i2", 32: "<i4"}[form[5]]).astype(np.float32)
            x = (x - 128) / 128 if form[5] == 8 else x / float(1 << (form[5] - 1))
            return x.reshape(-1, form[1]).mean(axis=1), form[2]
        at += 8 + size + size % 2
    return nothing


@cache
def _pitches(frame: int, rate: int) -> tuple[np.ndarray, np.ndarray]:
    """The bins of a spectrum that count and the matrix that folds them into pitch classes."""
    hz = np.fft.rfftfreq(frame, 1 / rate)
    used = np.flatnonzero((hz >= LOW_HZ) & (hz <= HIGH_HZ))
    fold = np.zeros((len(used), 12), dtype=np.float32)
    fold[np.arange(len(used)), np.round(12 * np.log2(hz[used] / 440.0)).astype(int) % 12] = 1
    return used, fold


def chroma(samples: np.ndarray, rate: int) -> np.ndarray:
    """Frames x 12, each frame of length one (silence: zero), smoothed over five frames."""
    frame = 1 << max(4, round(np.log2(rate * FRAME_S)))
    if len(samples) < frame:
        return np.empty((0, 12), dtype=np.float32)
    frames = np.lib.stride_tricks.sliding_window_view(samples, frame)[:: frame // 3]
    used, fold = _pitches(frame, rate)
    image = np.empty((len(frames), 12), dtype=np.float32)
    for a in range(0, len(frames), 512):
        spectrum = np.fft.rfft(frames[a : a + 512] * np.hanning(frame).astype(np.float32), axis=1)[:, used]
        image[a : a + 512] = (spectrum.real**2 + spectrum.imag**2) @ fold
    padded = np.pad(image, ((2, 2), (0, 0)), mode="edge")
    image = sum(w * padded[k : k + len(image)] for k, w in enumerate((0.25, 0.75, 1.0, 0.75, 0.25)))
    norm = np.sqrt((image**2).sum(axis=1, keepdims=True))
    return np.where(norm > 1e-6, image / np.maximum(norm, 1e-6), 0)


def filters() -> list[tuple[list[tuple[int, int, int, int]], list[tuple[int, int, int, int]]]]:
    """Sixteen pairs of rectangle lists (time, pitch, duration, height): added, subtracted.

    Four kinds in turn (before and after, low and high, middle and outer time, chequered), at
    pitches and durations that step through the image.
    """
    out = []
    for k in range(16):
        y, h, w = 3 * k % 8, 4, (16, 8, 12, 4)[k // 4]
        x = (WIDTH - w) // 2
        if k % 4 == 0:
            out.append(([(x, y, w // 2, h)], [(x + w // 2, y, w // 2, h)]))
        elif k % 4 == 1:
            out.append(([(x, y, w, h // 2)], [(x, y + h // 2, w, h // 2)]))
        elif k % 4 == 2:
            out.append(([(x + w // 4, y, w // 2, h)], [(x, y, w // 4, h), (x + w - w // 4, y, w // 4, h)]))
        else:
            out.append(([(x, y, w // 2, h // 2), (x + w // 2, y + h // 2, w // 2, h // 2)], [(x + w // 2, y, w // 2, h // 2), (x, y + h // 2, w // 2, h // 2)]))
    return out


def fingerprint(audio: bytes | None) -> np.ndarray:
    image = chroma(*decode(audio))
    n = len(image) - WIDTH + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint32)
    total = np.zeros((len(image) + 1, 13))
    total[1:, 1:] = image.cumsum(axis=0, dtype=np.float64).cumsum(axis=1)

    def area(rectangles: list[tuple[int, int, int, int]]) -> np.ndarray:
        return sum(total[x + w : x + w + n, y + h] - total[x : x + n, y + h] - total[x + w : x + w + n, y] + total[x : x + n, y] for x, y, w, h in rectangles)

    out = np.zeros(n, dtype=np.uint32)
    for k, (plus, minus) in enumerate(filters()):
        value = np.log1p(np.maximum(area(plus), 0)) - np.log1p(np.maximum(area(minus), 0))
        step = (value > -0.3).astype(np.uint32) + (value > 0) + (value > 0.3)
        out |= (step ^ (step >> 1)).astype(np.uint32) << np.uint32(2 * k)
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [fingerprint(x).astype("<u4").tobytes() for x in (y.as_py() for y in batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["rec_id", "fingerprint"])


def fingerprints(recordings: DataFrame, id_col: str, audio_col: str) -> DataFrame:
    """rec_id, fingerprint (packed little-endian integers)."""
    return recordings.select(F.col(id_col).cast("long").alias("rec_id"), F.col(audio_col).alias("audio")).mapInArrow(_fingerprints, "rec_id long, fingerprint binary")


def index_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions that start a run of one key, and their keys."""
    x = values.astype(np.int64) & SIGNS
    if len(x) <= 2 * GAP:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys = (x[: -2 * GAP] << 31) | x[GAP:-GAP] | (x[2 * GAP :] >> 1)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])) & (keys != 0))  # silence has no sign
    return first, keys[first]


#: What a query changes in its keys: nothing, or one of the 48 sign bits.
PROBES = np.array([0] + [1 << k for k in [*range(32), *range(32, 64, 2)]], dtype=np.int64)


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for digest, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            first, keys = index_keys(np.frombuffer(raw.as_buffer(), "<u4"))
            yield pa.RecordBatch.from_arrays([pa.array([digest] * len(first), pa.binary()), pa.array(first), pa.array(keys)], names=["digest", "at", "value"])


def _questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _postings(batches):
        n = len(PROBES)
        keys = batch.column(2).to_numpy(zero_copy_only=False)
        for a in range(0, len(keys), 1 << 14):  # probes of a long recording come in pieces
            part = batch.slice(a, 1 << 14)
            digest = part.column(0).take(pa.array(np.repeat(np.arange(len(part)), n)))
            at = np.repeat(part.column(1).to_numpy(zero_copy_only=False), n)
            yield pa.RecordBatch.from_arrays([digest, pa.array(at), pa.array((keys[a : a + (1 << 14), None] ^ PROBES).reshape(-1))], names=["query", "query_at", "value"])


def bit_error(query: np.ndarray, other: np.ndarray, offset: int) -> tuple[float, int]:
    """Share of differing bits and length of the overlap if ``other`` at i + offset meets ``query`` at i."""
    a, b = max(0, -offset), min(len(query), len(other) - offset)
    if b <= a:
        return 1.0, 0
    return float(np.bitwise_count(query[a:b] ^ other[a + offset : b + offset]).sum()) / (32 * (b - a)), b - a


def limit(overlap: int) -> float:
    return min(MAX_BIT_ERROR, 0.5 - SIGMAS / (2 * (2 * overlap) ** 0.5)) if overlap >= LEAST_OVERLAP else -1.0


_MATCHES = "query binary, match binary, offset long, votes long, bit_error double, overlap long"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for query, match, at, q, o in zip(*(batch.column(x).to_pylist() for x in ("query", "match", "at")), batch.column("fp_q"), batch.column("fp_o"), strict=True):
            x, y = np.frombuffer(q.as_buffer(), "<u4"), np.frombuffer(o.as_buffer(), "<u4")
            aligned = []
            for offset, votes in ((v["offset"], v["votes"]) for v in at):
                e, n = bit_error(x, y, offset)
                if e <= limit(n):
                    aligned.append((e - limit(n), abs(offset), offset, votes, e, n))
            if aligned:
                out.append((query, match, *min(aligned)[2:]))
        types = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query", "match", "offset", "votes", "bit_error", "overlap"])


def search(marked: DataFrame, is_query: Column) -> tuple[DataFrame, DataFrame]:
    """Classes and alignments of fingerprints (rec_id, fingerprint; read more than once, so written before).

    members: rec_id, class_id (smallest id with that fingerprint), class (its digest), is_query, n_values.
    matches: query_class, match_class, match_id (class_id of the match), offset, votes, bit_error, overlap; other classes only.
    """
    digest = F.unhex(F.md5("fingerprint"))
    named = marked.select("rec_id", "fingerprint", digest.alias("digest"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    classes = named.groupBy("digest").agg(F.min("rec_id").alias("class_id"), F.first("fingerprint").alias("fp"), F.max("is_query").alias("asked"))
    members = named.select("rec_id", "digest", "is_query", F.expr("octet_length(fingerprint) div 4").cast("long").alias("n_values")).join(classes.select("digest", "class_id"), "digest").withColumnRenamed("digest", "class")
    postings = saved(classes.select("digest", "fp").mapInArrow(_postings, "digest binary, at long, value long"), "postings")
    asked = classes.filter("asked").select("digest", "fp").mapInArrow(_questions, "query binary, query_at long, value long")
    # a hot key is dealt out by the digest of the indexed class; a question about it goes to every share
    hot = postings.groupBy("value").count().filter(F.col("count") > HOT).select("value", F.ceil(F.col("count") / HOT).cast("int").alias("shares"))
    share = F.pmod(F.xxhash64("digest"), F.coalesce("shares", F.lit(1))).cast("int")
    held = postings.join(hot, "value", "left").withColumn("share", share).drop("shares")
    spread = asked.join(hot, "value", "left").withColumn("share", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1))).drop("shares")
    met = spread.join(held, ["value", "share"]).filter(F.col("query") != F.col("digest"))
    votes = met.groupBy("query", F.col("digest").alias("match"), (F.col("at") - F.col("query_at")).alias("offset")).agg(F.count("*").alias("votes"))
    pairs = votes.groupBy("query", "match").agg(F.collect_list(F.struct("offset", "votes")).alias("at"))  # no more offsets than the two have positions
    with_fp = pairs.join(classes.select(F.col("digest").alias("query"), F.col("fp").alias("fp_q")), "query").join(classes.select(F.col("digest").alias("match"), F.col("fp").alias("fp_o")), "match")
    checked = with_fp.select("query", "match", "at", "fp_q", "fp_o").mapInArrow(_verify, _MATCHES)
    ids = classes.select(F.col("digest").alias("match"), F.col("class_id").alias("match_id"))
    return members, checked.join(ids, "match").withColumnsRenamed({"query": "query_class", "match": "match_class"})


RATE, NOTE_S, NOTES, PITCHES = 4000, 0.25, 24, 36


@cache
def _notes() -> np.ndarray:
    """The samples of one note of each pitch."""
    t = np.arange(int(RATE * NOTE_S), dtype=np.float32) / RATE
    phase = (2 * np.pi * 110 * 2 ** (np.arange(PITCHES) / 12)).astype(np.float32)[:, None] * t
    return (np.sin(phase) + 0.4 * np.sin(2 * phase)) * 12_000


def rendered(vector: list[float] | None, lead: int) -> bytes:
    """A tune whose notes follow from a vector, after ``lead`` tenths of a second of silence.

    The tables at hand have no audio; this makes a media column out of a vector column.
    """
    v = np.nan_to_num(np.array([x or 0.0 for x in vector or []], dtype=np.float64))
    if not len(v):
        return b""
    v = np.resize(v, 2 * NOTES)
    pitch = np.floor(np.abs(v[0::2] * 1000 + v[1::2] * 700)).astype(np.int64) % PITCHES
    return wav(np.concatenate([np.zeros(RATE * lead // 10, dtype=np.float32), _notes()[pitch].reshape(-1)]), RATE)


#: Noise of recordings made again, in turn, as a share of full scale.
NOISE = (0.02, 0.1)


def recorded_again(audio: bytes, number: int) -> bytes:
    """The recording once more with noise; every third lacks its first quarter."""
    samples, rate = decode(audio)
    if number % 3 == 2:
        samples = samples[len(samples) // 4 :]
    noise = np.random.default_rng(number).normal(0, NOISE[number % len(NOISE)], len(samples))
    return wav(np.clip(samples + noise, -1, 1) * 20_000, rate)
