"""Every registered query against its SQL, on the smallest tables where they are at hand."""

import math
import os

import pytest

from loomstat.plans import catalogue

SF_DIR = os.environ.get("LOOMSTAT_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return ""
    if isinstance(x, bool):
        return str(x)
    if hasattr(x, "tolist"):
        return plain(x.tolist())
    try:
        return f"{float(x):.6f}"
    except (TypeError, ValueError):
        return str(x)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(plain(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    made = catalogue.queries()[name](spark, SF_DIR)
    rows = [tuple(r) for r in made.collect()]
    if name not in catalogue.oracle_sql():
        assert rows
        return
    asked = duck.execute(catalogue.oracle_sql()[name])
    columns = [d[0] for d in asked.description]
    assert sorted(made.columns) == sorted(columns)
    assert table(made.columns, rows) == table(columns, asked.fetchall())


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
