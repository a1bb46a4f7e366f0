"""Rows dealt over tasks by their counted number, and queries whose steps stay where they were dealt."""

import pytest

from stereobate import catalog
from stereobate.operators import topology as T


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(T, "DEALT", 500)  # some tasks also for the smallest tables


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_rows_are_dealt_by_their_number(spark, few):
    assert T.dealt(spark.range(5000), "id").rdd.getNumPartitions() == 10
    assert T.dealt(spark.range(0), "id").rdd.getNumPartitions() == 1


@pytest.mark.parametrize("name", ["n1_wall_quads", "k8_profile_missing"])
def test_one_shuffle_is_all(spark, sf, few, name):
    assert len(shuffles(catalog.QUERIES[name](spark, sf))) == 1


@pytest.mark.parametrize("name", ["b21_box_parts", "k8_profile_missing"])
def test_no_shuffle_depends_on_the_session(spark, sf, few, name):
    found = shuffles(catalog.QUERIES[name](spark, sf))
    assert found and all("REPARTITION_BY_NUM" in line for line in found)


def test_segments_are_cut_where_they_were_dealt(spark, sf, few):
    from stereobate.operators.rings import noded
    from stereobate.plans.binding import plan_segments

    assert len(shuffles(noded(plan_segments(spark, sf), ["model_id"], 1.0))) == 1


@pytest.mark.parametrize("name, steps", [("mesh_edge_gate", 4), ("d3_edge_uses", 4), ("d14_dominant_planes", 5), ("d7_fan_vertices", 2)])
def test_joins_and_groups_of_corners_are_dealt_by_their_number(spark, sf, few, name, steps):
    assert sum("REPARTITION_BY_NUM" in line for line in shuffles(catalog.QUERIES[name](spark, sf))) == steps
