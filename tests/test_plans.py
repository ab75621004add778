"""Every registered query against its SQL at the smallest scale, and the shape of some plans."""

import os

import pytest

import __spark_entry__ as driver
from check import compare, connect
from tastegraph.plans import all_oracles, all_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
QUERIES, ORACLES = all_queries(), all_oracles()
ROWS_ONLY = {
    "interaction_classifier", "deep_classifier", "lsi_similar_topk",
}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_only_learners_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY and not set(ORACLES) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER).toPandas(), con.execute(ORACLES[name]).fetchdf()) == "ok"


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_neighbour_recommend_answers_every_customer(spark, con):
    buyers = con.execute("SELECT count(DISTINCT o_custkey) FROM orders JOIN lineitem ON l_orderkey = o_orderkey").fetchone()[0]
    got = QUERIES["neighbour_recommend"](spark, FOLDER)
    assert got.select("user_id").distinct().count() == buyers > 1


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name", ["candidate_items", "attach_context", "negative_sample", "rule_recommend", "user_user_cf", "walk_item_recommend"]
)
def test_no_cross_joins(spark, name):
    shown = plan(spark, name)
    assert "CartesianProduct" not in shown and "NestedLoop" not in shown


@pytest.mark.parametrize("name", ["topk_per_user", "rule_recommend", "walk_neighbours", "group_sample_k", "tfidf_similar_topk"])
def test_top_k_is_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


def test_columns_and_filters_reach_the_scan(spark):
    shown = plan(spark, "restrict_to_ids")
    assert "LessThan(c_acctbal,0.0)" in shown
    assert "l_extendedprice" not in shown and "o_totalprice" not in shown
