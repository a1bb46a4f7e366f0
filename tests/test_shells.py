"""Polygon operators and rule sets on hand-made faces: boundary values and the cases that break."""

import pytest
from pyspark.sql import functions as F

from stereobate.operators import gates as G, shells as H

FACES = "model_id long, face_id long, pts array<struct<x double, y double, z double>>"


def boxed(df):
    ends = [f(F.col(f"pts.{c}")).alias(f"{c}{i}") for c in "xyz" for i, f in enumerate((F.array_min, F.array_max))]
    return df.select("*", *ends)


def square(x, y, z, size=1.0):
    return [(x, y, z), (x + size, y, z), (x + size, y + size, z), (x, y + size, z)]


def upright(x, y0, y1, z0, z1):
    return [(x, y0, z0), (x, y1, z0), (x, y1, z1), (x, y0, z1)]


@pytest.mark.parametrize("z, shift, pairs", [(0.0, 0.0, 1), (0.004, 0.25, 1), (0.006, 0.0, 0), (0.0, 1.0, 0), (0.0, 3.0, 0)])
def test_overlaps_by_distance_and_shift(spark, z, shift, pairs):
    for second in (square(shift, 0.0, z), square(shift, 0.0, z)[::-1]):
        f = boxed(spark.createDataFrame([(1, 1, square(0.0, 0.0, 0.0)), (1, 2, second), (2, 3, second)], FACES))
        got = H.overlaps(f, 0.005, 0.999999, 1e-7, 0.7).collect()
        assert len(got) == pairs and all(r.area == pytest.approx(1 - shift) for r in got)


def test_overlap_of_turned_squares_is_an_octagon(spark):
    d = 0.5**0.5
    turned = [(0.5 + d, 0.5, 0.0), (0.5, 0.5 + d, 0.0), (0.5 - d, 0.5, 0.0), (0.5, 0.5 - d, 0.0)]
    f = boxed(spark.createDataFrame([(1, 1, square(0.0, 0.0, 0.0)), (1, 2, turned)], FACES))
    assert H.overlaps(f, 0.001, 0.99, 1e-7, 2.0).first().area == pytest.approx(2 * (2**0.5 - 1))


@pytest.mark.parametrize("x, y0, y1, length", [(0.5, -1.0, 2.0, 0.994), (0.5, 0.5, 2.0, 0.494), (0.002, -1.0, 2.0, None), (1.5, -1.0, 2.0, None), (0.5, 0.98, 2.0, None)])
def test_crossings_stop_at_edges(spark, x, y0, y1, length):
    f = boxed(spark.createDataFrame([(1, 1, square(0.0, 0.0, 0.0)), (1, 2, upright(x, y0, y1, -1.0, 1.0))], FACES))
    got = [r.length for r in H.crossings(f, 0.02, 0.003, 1.0).collect()]
    assert got == ([] if length is None else [pytest.approx(length)])


def test_open_edges_of_two_joined_squares_and_a_cover(spark):
    f = boxed(spark.createDataFrame([(1, 1, square(0.0, 0.0, 0.0)), (1, 2, square(1.0, 0.0, 0.0)), (1, 3, upright(0.0, -1.0, 2.0, -1.0, 1.0))], FACES))
    open_ = H.uncovered_edges(f, 0.01, 1.0).where("face_id < 3").collect()
    assert len(open_) == 5  # six sides of the pair are open, one of them lies on the upright face


def test_gate_of_an_empty_table_and_of_one_square(spark):
    f = boxed(spark.createDataFrame([(1, 1, square(0.0, 0.0, 0.0, 0.5))], FACES))
    r = H.surface_gate(f, 1.0).first()
    assert (r.faces, r.concave, r.duplicates, r.uncovered, r.status) == (1, 0, 0, 4, "fail")
    assert H.surface_gate(f.limit(0), 1.0).count() == 0


def test_union_area_counts_shared_parts_once(spark):
    r = spark.createDataFrame([(1, 0.0, 2.0, 0.0, 2.0), (1, 1.0, 3.0, 1.0, 3.0), (1, 0.0, 2.0, 0.0, 2.0), (2, 0.0, 1.0, 0.0, 1.0)], "k long, u0 double, u1 double, v0 double, v1 double")
    assert {x.k: x.area for x in H.union_area(r, ["k"]).collect()} == {1: 7.0, 2: 1.0}


def test_low_detail_package_and_checks_that_break(spark):
    names = ["0001_A_Ground.fbx", "0001_A_01.fbx", "0001_A_21.fbx", "texture.png"]
    got = {r.rule: r.status for r in G.low_detail_package(spark.createDataFrame([("0001_A", n) for n in names], "package string, name string"), 2, 21, 20).collect()}
    assert got == {"foreign": "fail", "count": "pass", "archive": "pass", "ground": "pass", "names": "fail"}
    checks = G.Checks()
    checks.register("good", lambda t: t.select("key", F.lit("pass").alias("status")), ["t"])
    checks.register("breaks", lambda t: t.select("nothing"), ["t"])
    checks.register("empty", lambda t: t.limit(0).select("key", F.lit("pass").alias("status")), ["t"])
    t = spark.createDataFrame([(1,)], "key long")
    assert {r.name: r.status for r in checks.run({"t": t}).collect()} == {"good": "pass", "breaks": "not_measured", "empty": "not_measured"}
    with pytest.raises(ValueError):
        checks.register("good", lambda t: t, ["t"])
