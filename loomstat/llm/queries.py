"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, chroma, conversations, exact_dedup, language, licenses, lm, main_text, mixing, packing, quality, secrets, simhash
from .common import documents, id_remainder, saved


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(documents(spark, sf_dir), id_remainder("doc_id", 7) == 2)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a history: an older quarter was scanned by the base rules, then all of it arrives and there are more rules.

    The second update scans the quarter's blobs by the new rules only, and blobs it knows by
    other paths not again.
    """
    docs = documents(spark, sf_dir)
    older = secrets.BlobLedger(spark, rules=secrets.BASE_RULES)
    older.update(docs.filter(id_remainder("doc_id", 4) == 0))
    ledger = secrets.BlobLedger(spark, older.path)
    ledger.update(docs)
    return ledger.findings(docs, columns=["doc_id"]).drop("blob")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op5_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_plan(documents(spark, sf_dir))


def _tune(vec_id: int | None, vector: list, copied: bool) -> bytes:
    audio = chroma.rendered(vector, (vec_id or 0) % 7)
    return chroma.recorded_again(audio, vec_id // 50) if copied else audio


def _tunes(batches):
    for batch in batches:
        ids, vectors, copied = (c.to_pylist() for c in batch.columns)
        for a in range(0, len(ids), 64):
            audio = [_tune(*x) for x in zip(ids[a : a + 64], vectors[a : a + 64], copied[a : a + 64], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids[a : a + 64], pa.int64()), pa.array(audio, pa.binary())], names=["vec_id", "audio"])


def op6_chroma_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as a recording; those whose id is divisible by 50 are searched among all.

    So that there are true matches, the recording after each of these is of the same tune: it begins
    at another time, has noise, and every third has lost its first quarter (``chroma.recorded_again``).

    A row per recording (vec_id, class_id, is_query, n_values), for queries a row per class that
    aligns with theirs (match_class, offset in frames, votes, bit_error); match_class is null without one.
    """
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    copies = vectors.filter("vec_id % 50 = 0").select((F.col("vec_id") + 1).alias("copy_id"), F.col("embedding").alias("copied")).dropDuplicates(["copy_id"])
    rows = vectors.join(copies, F.col("vec_id") == F.col("copy_id"), "left")
    audio = rows.select("vec_id", F.coalesce("copied", "embedding"), F.col("copied").isNotNull()).mapInArrow(_tunes, "vec_id long, audio binary")
    marked = saved(chroma.fingerprints(audio, "vec_id", "audio"), "chroma")
    members, matches = chroma.search(marked, F.col("rec_id") % 50 == 0)
    rows = members.withColumn("query_class", F.when(F.col("is_query"), F.col("class")))
    made = rows.join(matches.drop("overlap", "match_class"), "query_class", "left")
    return made.select(F.col("rec_id").alias("vec_id"), "class_id", "is_query", "n_values", F.col("match_id").alias("match_class"), "offset", "votes", F.round("bit_error", 6).alias("bit_error"))


def op7_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = documents(spark, sf_dir).select("doc_id", "text"), id_remainder("doc_id", 3) == 1
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held)
    model = quality.train(docs.filter(~held), labels)
    return quality.scored(docs, model).select("doc_id", held.alias("held_out"), "__quality.score", "__quality.predicted")


def op8_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op9_grace_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language.train(docs.filter(id_remainder("doc_id", 4) != 2))
    made = language.predicted(docs.select("doc_id", "text"), model)
    return made.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "__lang.lang_pred", "__lang.score")


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return main_text.extracted(pages, main_text.train(pages)).drop("html")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.reports(conversations.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("centroid")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_secret_scan": op2_secret_scan,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_pfair_mixing": op5_pfair_mixing,
    "op6_chroma_fingerprints": op6_chroma_fingerprints,
    "op7_pairwise_quality": op7_pairwise_quality,
    "op8_sum_of_squares_packing": op8_sum_of_squares_packing,
    "op9_grace_exact_dedup": op9_grace_exact_dedup,
    "op10_language_id": op10_language_id,
    "op11_html_extraction": op11_html_extraction,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_centroid_clustering": op13_centroid_clustering,
}

#: The schedule is folded slot by slot in a recursive query; weights as in mixing.source_weights.
OP5_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, greatest(coalesce(length(text), 1), 1)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS digest FROM documents
), s AS (SELECT source, sum(size) AS total FROM d GROUP BY source
), pd AS (SELECT greatest(1024, 1::BIGINT << length(bin(4 * count(*) - 1))) AS p FROM s
), r AS (
  SELECT source, floor(sqrt(total))::HUGEINT AS raw, p - count(*) OVER () AS free, sum(floor(sqrt(total))::HUGEINT) OVER () AS all_raw, p FROM s CROSS JOIN pd
), b AS (SELECT source, (raw * free // all_raw + 1)::BIGINT AS base, raw * free % all_raw AS rest, p FROM r
), w AS (
  SELECT source, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, source) <= p - sum(base) OVER () THEN 1 ELSE 0 END AS w,
         row_number() OVER (ORDER BY source) AS j, p FROM b
), ws AS (SELECT list(w::BIGINT ORDER BY j) AS w, max(p)::BIGINT AS p FROM w
), edf(t, done, pick) AS (
  SELECT -1::BIGINT, list_transform((SELECT w FROM ws), lambda x: 0::BIGINT), 0::BIGINT
  UNION ALL
  SELECT t + 1, list_transform(done, lambda d, i: CASE WHEN i = pick THEN d + 1 ELSE d END), pick
  FROM (SELECT t, done, list_min(list_transform(w, lambda x, i:
          CASE WHEN done[i] < x AND done[i] * p // x <= t + 1 THEN (((done[i] + 1) * p + x - 1) // x) * 1000000 + i ELSE 9223372036854775807 END)) % 1000000 AS pick
        FROM edf CROSS JOIN ws WHERE t < p - 1)
), plan AS (SELECT pick AS j, t AS slot, row_number() OVER (PARTITION BY pick ORDER BY t) AS k FROM edf WHERE t >= 0
), p AS (
  SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY digest, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d
), c AS (SELECT *, unnest(range(start // 8192, (start + size - 1) // 8192 + 1)) AS block FROM p
), e AS (SELECT doc_id, source, block, start, greatest(start, block * 8192) AS lo, least(start + size, (block + 1) * 8192) AS hi FROM c
)
SELECT e.doc_id, e.source, lo - start AS start, hi - lo AS size, block, (block * w.p // w.w)::BIGINT AS release,
       (((block + 1) * w.p + w.w - 1) // w.w)::BIGINT AS deadline, (block // w.w * w.p + plan.slot)::BIGINT AS slot, lo - block * 8192 AS block_offset
FROM e JOIN w ON e.source IS NOT DISTINCT FROM w.source JOIN plan ON plan.j = w.j AND plan.k = block % w.w + 1
"""

OP9_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM d
"""

ORACLE_SQL: dict[str, str] = {"op4_license_scan": licenses.oracle_sql(), "op5_pfair_mixing": OP5_SQL, "op9_grace_exact_dedup": OP9_SQL} | {
    "op11_html_extraction": main_text.ORACLE_SQL,
    "op12_conversation_repair": conversations.ORACLE_SQL,
    "op13_centroid_clustering": centroids.oracle_sql(),
}
