"""Plan guards over the whole catalogue: no cross joins, no row-at-a-time
Python, Python only where visual words and boosted trees need numpy, pruned scans."""

import re

import pytest

import __spark_entry__ as E
from casebook.plans import catalogue

SF = "/root/testdata/sf0.001"
PYTHON_OK = {"bovw_assign", "bovw_hist", "bovw_search", "bovw_search_many", "bovw_search_lists", "bovw_trained", "renewal_scores"}


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: physical(E.queries()[name](spark, SF)) for name in catalogue.QUERIES}


def test_no_cross_joins(plans):
    bad = {n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p}
    assert not bad


def test_no_row_at_a_time_python(plans):
    assert not {n for n, p in plans.items() if "BatchEvalPython" in p}


def test_python_only_where_numpy_is_needed(plans):
    with_python = {n for n, p in plans.items() if re.search(r"MapInPandas|ArrowEvalPython|FlatMapGroupsInPandas", p)}
    assert with_python <= PYTHON_OK


def scan_columns(plan: str) -> list[list[str]]:
    return [[c.split("#")[0] for c in m.split(",")] for m in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]


def test_scans_are_pruned(spark):
    cols = scan_columns(physical(E.queries()["minmax_scale"](spark, SF)))
    assert cols == [["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]]
    cols = scan_columns(physical(E.queries()["ab_shares"](spark, SF)))
    assert cols == [["user_id", "event_type"]]
