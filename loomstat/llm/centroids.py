"""Centroid clustering of integer vectors with partial-distance search.

Components become integers, ``floor(1024 * x)``, so that distances, sums and means are exact and
don't depend on how the rows are dealt. For every centroid a row's squared differences are added
up over a few dimensions at a time, those with the highest variance first; once the part is
strictly above the best distance so far the centroid is abandoned for that row, and only rows
that survive finish all 64 dimensions. The order of the dimensions changes the work, never the
result: a part is never larger than the whole distance.

A round is one pass over the table: each task returns counts and sums of its rows, one row per
cluster, which the JVM adds up; the driver gets one row per cluster. Nothing is shuffled by
vector and no cluster is gathered, however large it is.

Defined cases: vectors that are null, have not exactly 64 components or a null or non-finite one
are left out; repeated rows count as often as they stand there; a null id is the text '' in the
order of the first centroids, and rows of one id follow by their components; fewer vectors than
clusters give as many clusters as vectors; an empty table gives an empty result. A component
whose integer has a magnitude of 2^27 or more is an error, as squared distances would leave 64
bits. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

DIMENSIONS = 64
SCALE = 1024
LIMIT = 1 << 27
#: Dimensions that are added up before centroids are abandoned.
STEP = 8
#: Rows whose distances are worked out at a time.
ROWS = 16_384


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, v array<bigint>) of the vectors that are complete and finite."""
    wide = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    kept = vectors.select(F.col(id_col).alias("vec_id"), wide.alias("x")).filter(
        (F.size("x") == dimensions) & F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    )
    return kept.select("vec_id", F.transform("x", lambda x: F.floor(x * F.lit(float(SCALE)))).alias("v"))


def nearest(x: np.ndarray, centroids: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each row; of equal distances the smaller number.

    The columns of both stand in the order in which differences are added up.
    """
    who = np.zeros(len(x), np.int32)
    best = np.full(len(x), np.iinfo(np.int64).max)
    for k, c in enumerate(centroids):
        alive, part = np.arange(len(x)), np.zeros(len(x), np.int64)
        for a in range(0, x.shape[1], step):
            diff = x[alive, a : a + step] - c[a : a + step]
            part += (diff * diff).sum(axis=1)
            stay = part <= best[alive]
            alive, part = alive[stay], part[stay]
            if not len(alive):
                break
        closer = part < best[alive]
        who[alive[closer]], best[alive[closer]] = k, part[closer]
    return who, best


def _matrices(batches: Iterator[pa.RecordBatch], order: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            part = batch.slice(a, ROWS)
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
            yield part.column(0), np.ascontiguousarray(flat.reshape(part.num_rows, -1)[:, order])


def _assign(table: DataFrame, centroids: np.ndarray, order: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    sent = table.sparkSession.sparkContext.broadcast((centroids[:, order], order))  # clusters x dimensions numbers

    def assign(batches):
        at, order = sent.value
        for ids, x in _matrices(batches, order):
            who, best = nearest(x, at)
            yield pa.RecordBatch.from_arrays([ids, pa.array(who), pa.array(best)], names=["vec_id", "cluster", "distance"])

    kind = table.schema["vec_id"].dataType.simpleString()
    return table.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long")


def _sums(table: DataFrame, centroids: np.ndarray, order: np.ndarray) -> list:
    """(cluster, count, sum per dimension) of the clusters that have vectors."""
    sent = table.sparkSession.sparkContext.broadcast((centroids[:, order], order))
    width = centroids.shape[1]

    def add(batches):
        at, order = sent.value
        count, total = np.zeros(len(at), np.int64), np.zeros((len(at), width), np.int64)
        for _, x in _matrices(batches, order):
            who, _ = nearest(x, at)
            count += np.bincount(who, minlength=len(at))
            for k in np.unique(who):
                total[k, order] += x[who == k].sum(axis=0)
        own = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own.astype(np.int32)), pa.array(count[own]), pa.array(total[own].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "total"]
        )

    parts = table.mapInArrow(add, "cluster int, n long, total array<bigint>")
    exact = [F.sum(F.col("total")[d].cast("decimal(38,0)")).alias(f"d{d}") for d in range(width)]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).collect()  # a row per cluster


def clusters(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 8, rounds: int = 10, salt: str = "3:", dimensions: int = DIMENSIONS
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid) of every complete vector.

    The first centroids are the ``k`` vectors with the smallest SHA-256 of ``salt`` and id. Every
    round assigns all vectors and replaces the non-empty centroids by the floor of their means.
    """
    table = saved(integer_vectors(vectors, id_col, vector_col, dimensions), "vectors")
    name = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    seeds = table.select(name.alias("name"), "v").orderBy("name", "v").limit(k).collect()
    at = [F.var_pop(F.col("v")[d]).alias(f"d{d}") for d in range(dimensions)]
    seen = table.agg(F.max(F.array_max("v")).alias("high"), F.min(F.array_min("v")).alias("low"), *at).first()
    if seeds and not -LIMIT < seen["low"] <= seen["high"] < LIMIT:
        raise ValueError(f"a component leaves the range of {LIMIT // SCALE} to either side, so distances would leave 64 bits")
    order = np.argsort([-(seen[f"d{d}"] or 0.0) for d in range(dimensions)], kind="stable")
    centroids = np.array([r["v"] for r in seeds], np.int64).reshape(-1, dimensions)
    for _ in range(rounds if seeds else 0):
        for r in _sums(table, centroids, order):
            centroids[r["cluster"]] = [int(r[f"d{d}"]) // r["n"] for d in range(dimensions)]
    made = _assign(table, centroids, order)
    if not seeds:
        made = made.limit(0)
    spent = {r["cluster"]: int(r["s"]) for r in made.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(c, spent.get(c, 0), sum(spent.values()), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest(), v) for c, v in enumerate(centroids.tolist())]
    about = made.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<bigint>")
    return made.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")  # k rows


def oracle_sql(k: int = 8, rounds: int = 10) -> str:
    """The same in DuckDB: a step of the rounds is a pair of common table expressions."""
    distance = "list_sum(list_transform(list_zip(v, c.m), lambda p: ((p[1] - p[2]) * (p[1] - p[2]))::HUGEINT))::BIGINT"
    steps = [
        f"""a{r} AS MATERIALIZED (
  SELECT n, vec_id, v, min({{'d': {distance}, 'k': c.k}}) AS best FROM x CROSS JOIN c{r} c GROUP BY n, vec_id, v
)"""
        + f""", s{r} AS (
  SELECT best.k AS k, i, sum(v[i])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{r} CROSS JOIN range(1, {DIMENSIONS + 1}) t(i) GROUP BY 1, 2
), m{r} AS (SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m FROM s{r} GROUP BY k
), c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(m{r}.m, c.m) AS m FROM c{r} c LEFT JOIN m{r} ON m{r}.k = c.k
)"""
        * (r < rounds)
        for r in range(rounds + 1)
    ]
    return f"""
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda y: y::DOUBLE) AS y FROM embeddings
), x AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, list_transform(y, lambda z: floor({SCALE} * z)::BIGINT) AS v FROM e
  WHERE len(y) = {DIMENSIONS} AND len(list_filter(y, lambda z: z IS NOT NULL AND isfinite(z))) = {DIMENSIONS}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS k, v AS m FROM x QUALIFY k < {k}
), {', '.join(steps)}
SELECT vec_id, best.k::INTEGER AS "cluster", best.d AS distance, sum(best.d) OVER (PARTITION BY best.k)::BIGINT AS cluster_inertia,
       sum(best.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.m, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.k = a.best.k
"""
