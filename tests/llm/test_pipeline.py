import itertools
import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from loomstat.llm import exact_dedup, queries
from loomstat.llm.common import documents

SF_DIR = os.environ.get("LOOMSTAT_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


def one_of_each_component(rows):
    """The smallest id of each component of texts with a five-word Jaccard similarity of 0.8 or more."""
    sets = {}
    for r in rows:
        words = (r["text"] or "").encode().lower().split()
        sets[r["doc_id"]] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {k: k for k in sets}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if (not x and not y) or len(x & y) >= 0.8 * len(x | y) > 0:
            a, b = sorted((top(a), top(b)))
            root[b] = a
    return {k for k in sets if root[k] == k}


def test_stages(spark, tmp_path):
    docs, sizes = documents(spark, SF_DIR), []
    start = docs
    for k, (_, stage) in enumerate(C.STAGES):
        before, columns = docs, docs.columns
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        sizes.append(docs.count())
        if k < len(C.STAGES) - 1:
            assert docs.columns == columns
            assert docs.exceptAll(before).count() == 0  # nothing is changed or made up
    assert sizes[0] >= 0.95 * start.count() and sizes[1] < sizes[0] and sizes[2] <= sizes[1] and sizes[3] == sizes[2]
    second, third = (spark.read.parquet(str(tmp_path / x)) for x in "12")
    assert exact_dedup.exact_dedup(second).filter("not kept").count() == 0
    assert one_of_each_component(second.collect()) == {r[0] for r in third.select("doc_id").collect()}
    assert C.run(spark, SF_DIR).count() == sizes[-1]


def test_stages_without_rows(spark):
    docs = documents(spark, SF_DIR).limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0


def through_all_stages(spark, docs, tmp_path):
    sizes = []
    for k, (_, stage) in enumerate(C.STAGES):
        columns = docs.columns
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert k == len(C.STAGES) - 1 or docs.columns == columns
        sizes.append(docs.count())
    return docs, sizes


def test_edges_go_through_all_stages(spark, edge, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows and ids, columns of clashing names."""
    packed, sizes = through_all_stages(spark, edge.withColumn("__lang", F.lit("mine")), tmp_path)
    assert sizes[0] >= sizes[1] >= sizes[2] == sizes[3] and packed.count() >= sizes[3] > 0


def test_copies_alone_leave_one(spark, docs, tmp_path):
    rows = [(k if k % 5 else None, "the same text in every row " * 20, "en", "a") for k in range(500)]
    packed, sizes = through_all_stages(spark, docs(rows), tmp_path)
    assert sizes == [500, 1, 1, 1, 1] and packed.first()["doc_id"] == 499


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run_and_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    made = queries.QUERIES[name](spark, SF_DIR)
    rows = sorted(tuple(map(str, r)) for r in made.select(*sorted(made.columns)).collect())
    assert rows
    if name in queries.ORACLE_SQL:
        con = duckdb.connect()
        for t in ("documents", "pages", "conversations", "embeddings"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet" + ("/*.parquet')" if os.path.isdir(f"{SF_DIR}/{t}.parquet") else "')"))
        asked = con.execute(queries.ORACLE_SQL[name])
        columns = [d[0] for d in asked.description]
        order = sorted(range(len(columns)), key=lambda k: columns[k])
        assert rows == sorted(tuple(str(r[k]) for k in order) for r in asked.fetchall())
