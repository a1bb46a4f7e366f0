"""Queries over panels deal the lines by model once: no join, group or window shuffles them again."""

import re

import pytest

from stereobate import catalog
from stereobate.operators import topology as T
from stereobate.plans import catalogues, gates, shells, silhouettes
from stereobate.plans.binding import REDEAL


def reshuffles(df):
    """Shuffles by key that Spark added to the plan, for itself or for joins; those of the query's own dealing don't count."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "ENSURE_REQUIREMENTS" in line]


@pytest.fixture
def unbroadcast(spark, monkeypatch):
    """As for large tables: no broadcast, and lines for more than a few tasks."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for plans in (catalogues, gates, shells, silhouettes):
        monkeypatch.setattr(plans, "FEW", 200)
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["c14_t_junctions", "d12_silhouettes", "k5_face_gate", "c15_uncovered_edges"])
def test_nothing_is_dealt_twice(unbroadcast, sf, name):
    assert reshuffles(catalog.QUERIES[name](unbroadcast, sf)) == []


@pytest.mark.parametrize("name", ["c8_match_triangles", "d8_open_loops", "d10_shell_gate"])
def test_what_is_dealt_again_goes_by_model(unbroadcast, sf, name):
    # Rows of a model that were made anew (components, one row for a report) come to where its others lie.
    again = reshuffles(catalog.QUERIES[name](unbroadcast, sf))
    assert all(re.search(r"hashpartitioning\(model_id#\d+L, \d+\)", line) for line in again)


def test_roots_name_their_model(spark):
    links = spark.createDataFrame([(1, 10, 11), (1, 12, 11), (2, 20, 21), (2, 23, 22), (2, 22, 21), (3, 30, 30)], "g long, a long, b long")
    want = [(1, 11, 10), (1, 12, 10), (2, 21, 20), (2, 22, 20), (2, 23, 20)]
    for most in (1, 100):  # the smaller goes on to the rounds
        got = {(r.g, r.node, r.root) for r in T.roots(links, most=most).collect()}
        assert sorted(x for x in got if x[1] != x[2]) == want


def test_other_queries_leave_joins_to_spark(spark, sf):
    catalog.QUERIES["c14_t_junctions"](spark, sf)
    assert spark.conf.get(REDEAL) == "false"
    catalog.QUERIES["e1_cluster_gap"](spark, sf)
    assert spark.conf.get(REDEAL) == "true"
