"""Every catalogue query against its DuckDB oracle on the smallest testdata."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from casebook.plans import catalogue
from casebook.sources.tables import TABLES
from tools.oracle_check import rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="testdata missing")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_oracle_or_is_model():
    missing = set(catalogue.QUERIES) - set(E.oracle_sql())
    assert missing <= {"kmeans_profile", "renewal_scores", "multilabel_scores"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["query", "image", "distance", "rank"]
