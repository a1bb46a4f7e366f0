"""Exact areas of unions against a slab sweep in fractions and hand-made silhouettes."""

import random
from fractions import Fraction

import pytest

from stereobate.operators import silhouettes as S

FLAT = "k int, ax long, ay long, bx long, by long, cx long, cy long"
SOLID = "model long, role string, " + ", ".join(f"{k}{c} double" for k in "abc" for c in "xyz")


def swept(tris):
    """Area of the union: between neighbouring x of corners and crossings the sides don't cross."""
    sides = [(t[i], t[(i + 1) % 3]) for t in tris for i in range(3)]
    xs = {Fraction(p[0]) for t in tris for p in t}
    for n, (p, q) in enumerate(sides):
        for r, s in sides[:n]:
            d, e = (q[0] - p[0], q[1] - p[1]), (s[0] - r[0], s[1] - r[1])
            w = d[0] * e[1] - d[1] * e[0]
            if w:
                xs.add(p[0] + Fraction((r[0] - p[0]) * e[1] - (r[1] - p[1]) * e[0], w) * d[0])
    xs, total = sorted(xs), Fraction(0)
    for x0, x1 in zip(xs, xs[1:]):
        x, spans = (x0 + x1) / 2, []
        for t in tris:
            ys = [p[1] + (x - p[0]) / (q[0] - p[0]) * (q[1] - p[1]) for p, q in ((t[i], t[(i + 1) % 3]) for i in range(3)) if min(p[0], q[0]) < x < max(p[0], q[0])]
            if len(ys) == 2:
                spans.append(sorted(ys))
        end = None
        for lo, hi in sorted(spans):
            lo = lo if end is None else max(lo, end)
            if hi > lo:
                total += (hi - lo) * (x1 - x0)
            end = hi if end is None else max(end, hi)
    return float(total)


def ccw(t):
    w = (t[1][0] - t[0][0]) * (t[2][1] - t[0][1]) - (t[1][1] - t[0][1]) * (t[2][0] - t[0][0])
    return t if w > 0 else (t[0], t[2], t[1]) if w < 0 else None


@pytest.mark.parametrize("size", [3, 1000])
def test_random_triangles_with_shared_and_lying_sides(spark, size):
    rng = random.Random(4)
    groups = []
    for k, (n, span) in enumerate([(1, 9), (6, 4), (12, 6), (14, 3), (10, 40)]):  # narrow spans: many sides lie along others
        found = {ccw(tuple((rng.randrange(-span, span), rng.randrange(-span, span)) for _ in range(3))) for _ in range(n)} - {None}
        # The same triangle with another first corner is the same triangle.
        groups.append((k, list({min((t[i:] + t[:i] for i in range(3))) for t in found})))
    rows = [(k, *t[0], *t[1], *t[2]) for k, ts in groups for t in ts]
    got = {r.k: r.area for r in S.union_area(spark.createDataFrame(rows, FLAT), ["k"], size, 1.0).collect()}
    assert set(got) == {k for k, ts in groups if ts}
    for k, ts in groups:
        if ts:
            assert got[k] == pytest.approx(swept(ts), abs=1e-9)


def quad(model, role, p, q, r, s):
    return [(model, role, *p, *q, *r), (model, role, *p, *r, *s)]


def box(model, role, x, y, z, w, d, h):
    c = lambda i, j, k: (float(x + i * w), float(y + j * d), float(z + k * h))
    out = []
    for at in (0, 1):
        out += quad(model, role, c(0, 0, at), c(1, 0, at), c(1, 1, at), c(0, 1, at))
        out += quad(model, role, c(0, at, 0), c(1, at, 0), c(1, at, 1), c(0, at, 1))
        out += quad(model, role, c(at, 0, 0), c(at, 1, 0), c(at, 1, 1), c(at, 0, 1))
    return out


def test_silhouettes_of_boxes_in_every_view(spark):
    tris = box(1, "a", 0, 0, 0, 4, 3, 2) + box(1, "b", 2, 0, 0, 4, 3, 2) + box(2, "a", 0, 0, 0, 1, 1, 1) + box(2, "b", 0, 0, 0, 1, 1, 1) + box(3, "a", 1e5, 1e5, 0, 1, 1, 1)
    tris += [(4, "a", None, *[0.0] * 8), (4, "b", *[1.0] * 9)]
    oblique = {**S.VIEWS, "oblique": ((1.0, 0.5, 0.0), (0.0, 0.25, 1.0))}
    got = {(r.model, r.view): r for r in S.compare(spark.createDataFrame(tris, SOLID), ["model"], "role", "a", "b", 700, oblique).collect()}
    top, front, side = (got[1, v] for v in ("top", "front", "side"))
    assert (top.area_a, top.area_b, top.union_area, top.shared, top.apart) == pytest.approx((12, 12, 18, 6, 12)) and top.iou == pytest.approx(1 / 3)
    assert (front.union_area, front.iou) == pytest.approx((12, 1 / 3)) and (side.union_area, side.iou) == pytest.approx((6, 1))
    # A sheared box: front, lid and the strip of its end, w*h + |w*0.25 d| + |0.5 d * h| here.
    assert got[1, "oblique"].area_a == pytest.approx(4 * 2 + 4 * 0.75 + 1.5 * 2)
    assert all(got[2, v].iou == pytest.approx(1) for v in oblique)
    assert (got[3, "top"].area_a, got[3, "top"].area_b, got[3, "top"].iou) == pytest.approx((1, 0, 0))
    assert not [k for k in got if k[0] == 4]


def test_a_fan_and_its_cover_have_one_area(spark):
    import math

    n, r = 60, 100_000
    rim = [(round(r * math.cos(2 * math.pi * i / n)), round(r * math.sin(2 * math.pi * i / n))) for i in range(n)]
    rows = [(0, 0, 0, *rim[i], *rim[(i + 1) % n]) for i in range(n)]
    small = [(0, *(c // 2 for c in row[1:])) for row in rows]
    want = sum(p[0] * q[1] - p[1] * q[0] for p, q in zip(rim, rim[1:] + rim[:1])) / 2
    flat = spark.createDataFrame(rows + small, FLAT)
    got = S.union_area(flat, ["k"], 30_000, 1.0).first().area
    assert got == pytest.approx(want, rel=1e-9)
