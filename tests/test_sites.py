"""Stacks, covers, islands and the tailing source: hand-made cases and brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stereobate.operators import cover as C, islands as I, stacks as K
from stereobate.sources import tail

WALL = "model_id int, wall_id int, foot array<struct<u:double,v:double>>, x0 double, x1 double, y0 double, y1 double, z0 double, z1 double, band_top double, curtain boolean"


def wall(i, x0, y0, x1, y1, z0, z1, top=3.0, curtain=False, model=0):
    return (model, i, [(x0, y0), (x1, y0), (x1, y1), (x0, y1)], x0, x1, y0, y1, z0, z1, top, curtain)


def frame(spark, rows):
    return spark.createDataFrame([tuple(float(v) if isinstance(v, int) and k > 2 and k < 10 else v for k, v in enumerate(r)) for r in rows], WALL)


def house(model=0):
    sides = [(0.0, 0.0, 10.0, 0.3), (0.0, 7.7, 10.0, 8.0), (0.0, 0.0, 0.3, 8.0), (9.7, 0.0, 10.0, 8.0)]
    return [wall(i, *s, 0.0, 3.0, model=model) for i, s in enumerate(sides)]


def found(spark, rows):
    return sorted((r.model_id, r.wall_id) for r in K.attachments(frame(spark, rows), 0.05, 0.5, 0.5, 1.0).collect())


def test_low_frame_outside_is_an_attachment_and_a_tower_is_none(spark):
    low = [wall(40, 12.0, 2.0, 14.0, 2.3, 0.0, 2.0), wall(41, 12.0, 4.0, 14.0, 4.3, 0.0, 2.0)]
    assert found(spark, house() + low) == [(0, 40), (0, 41)]
    on_top = [wall(50, 12.0, 2.0, 14.0, 2.3, 2.03, 3.0), wall(51, 12.0, 4.0, 12.5, 4.3, 2.0, 3.0)]
    # 40 carries a wall that reaches the band's top and so is body; what stands on 41 covers too little of it, and the
    # hull's side from (14, 2.3) to (10, 8) leaves 65 % of its plan outside.
    assert found(spark, house() + low + on_top) == [(0, 41)]
    assert found(spark, house() + [low[1], on_top[1]]) == [(0, 41)]
    inside = [wall(60, 3.0, 3.0, 5.0, 3.3, 0.0, 2.0)]
    assert found(spark, house() + inside) == []
    assert found(spark, low) == []  # no body
    assert found(spark, house() + [wall(7, 11.0, 0.0, 20.0, 0.3, 0.0, 3.0, curtain=True)] + low) == [(0, 40), (0, 41)]
    assert found(spark, []) == []


def test_a_chain_of_walls_reaches_its_top_and_models_stay_apart(spark):
    chain = [wall(i, 0.0, 0.0, 1.0, 1.0, float(i), float(i + 1)) for i in range(300)]
    other = [wall(i, 0.0, 0.0, 1.0, 1.0, float(i), float(i + 1), model=1) for i in range(10)]
    tops = {(r.model_id, r.wall_id): r.top for r in K.stack_tops(frame(spark, chain + other), 0.05, 0.5, 1.0).collect()}
    assert len(tops) == 310 and {t for (m, _), t in tops.items() if m == 0} == {300.0} and {t for (m, _), t in tops.items() if m == 1} == {10.0}


def test_stacks_equal_a_walk_over_all_pairs(spark):
    rng = random.Random(5)
    rows = []
    for i in range(150):
        x, y, z = rng.randrange(8) * 0.5, rng.randrange(8) * 0.5, float(rng.randrange(5))
        rows.append(wall(i, x, y, x + rng.choice([0.5, 1.0, 1.5]), y + rng.choice([0.5, 1.0]), z, z + rng.choice([0.04, 1.0, 2.0]), 6.0, i % 7 == 0))
    box = {r[1]: r for r in rows}
    lap = lambda a, b, i: max(min(a[i + 1], b[i + 1]) - max(a[i], b[i]), 0)

    def top(w):
        on = [o for o in rows if o[1] != w[1] and abs(o[7] - w[8]) <= 0.05 and o[8] > w[8] and lap(o, w, 3) * lap(o, w, 5) >= 0.5 * (w[4] - w[3]) * (w[6] - w[5])]
        return max([w[8], *(top(o) for o in on)])

    got = {r.wall_id: r.top for r in K.stack_tops(frame(spark, rows), 0.05, 0.5, 1.0).collect()}
    assert got == {i: top(w) for i, w in box.items()}
    main = np.array([p for w in rows if top(w) >= w[9] - 0.05 and not w[10] for p in w[2]])

    def in_hull(p):  # no direction in which p lies beyond every corner
        angles = np.linspace(0, 2 * np.pi, 721)
        d = np.stack([np.cos(angles), np.sin(angles)])
        return bool(((np.array(p) @ d) <= (main @ d).max(0) + 1e-9).all())

    expected, close = set(), set()  # walls whose share the raster can't tell from a half
    for w in rows:
        grid = [(w[3] + (i + 0.5) / 40 * (w[4] - w[3]), w[5] + (j + 0.5) / 40 * (w[6] - w[5])) for i in range(40) for j in range(40)]
        share = sum(not in_hull(p) for p in grid) / len(grid)
        if abs(share - 0.5) < 0.02:
            close.add(w[1])
        elif top(w) < w[9] - 0.05 and share > 0.5:
            expected.add(w[1])
    assert expected and len(close) < 10
    assert {i for _, i in found(spark, rows)} - close == expected


RECT = "k int, role string, u0 double, u1 double, v0 double, v1 double"


def test_covers_equal_cells_counted_one_by_one(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(2), rng.choice("ab"), *sorted(rng.sample(range(-9, 9), 2)), *sorted(rng.sample(range(-9, 9), 2))) for _ in range(60)]
    rows += rows[:5] + [(0, "a", 1, 1, 0, 5), (0, "c", 0, 9, 0, 9), (1, "b", 3, 2, 0, 5)]
    df = spark.createDataFrame([(k, r, *map(float, x)) for k, r, *x in rows], RECT)
    cells = {}
    for k, r, u0, u1, v0, v1 in rows:
        if r != "c":
            for i in range(u0, u1):
                for j in range(v0, v1):
                    cells.setdefault((k, i, j), {"a": 0, "b": 0})[r] += 1
    for size in (2.5, 100.0):
        got = {}
        for p in C.covered(df, ["k"], ["a", "b"], size).collect():
            for i in range(-9, 9):
                for j in range(-9, 9):
                    if p.u0 < i + 0.75 < p.u1 and p.v0 < j + 0.75 < p.v1:
                        assert (p.k, i, j) not in got
                        got[p.k, i, j] = {"a": p.a, "b": p.b}
        assert got == cells
        left = C.difference(df, ["k"], "a", "b", size).groupBy("k").agg(C.area().alias("s")).collect()
        assert {r.k: r.s for r in left} == {k: float(sum(c["a"] > 0 and c["b"] == 0 for (m, *_), c in cells.items() if m == k)) for k in (0, 1)}


def gate(spark, faces, profiles, openings=(), cuts=None):
    on = ["run"]
    kind = "run int, u0 double, u1 double, v0 double, v1 double"
    given = [(r, a, x) for r, *e in [*profiles, *openings] for a, x in zip("uuvv", e)] if cuts is None else cuts
    f = spark.createDataFrame(faces, kind + ", off double, facing double")
    out = C.profile_gate(f, spark.createDataFrame(profiles, kind), spark.createDataFrame(list(openings), kind), spark.createDataFrame(given, "run int, axis string, at double"), on, 5e-6, 2.0)
    return {r.run: (r.faces, r.off_plane, r.inward, r.extra_cuts, round(r.difference, 6), round(r.overlap, 6), round(r.opening_fill, 6), r.status) for r in out.collect()}


def test_profile_gate_names_each_fault(spark):
    whole, hole = (1, 0.0, 4.0, 0.0, 3.0), (1, 1.0, 2.0, 1.0, 2.0)
    ring = [(1, 0.0, 4.0, 0.0, 1.0), (1, 0.0, 4.0, 2.0, 3.0), (1, 0.0, 1.0, 1.0, 2.0), (1, 2.0, 4.0, 1.0, 2.0)]
    fine = [(*r, 0.0, 1.0) for r in ring]
    assert gate(spark, fine, [whole], [hole])[1] == (4, 0, 0, 0, 0.0, 0.0, 0.0, "pass")
    noisy = [(r, a + 2e-6, b - 2e-6, c, d, 1e-6, 1.0) for r, a, b, c, d, *_ in fine]
    assert gate(spark, noisy, [whole], [hole])[1][-1] == "pass"
    assert gate(spark, fine + [(1, 1.0, 2.0, 1.0, 2.0, 0.0, 1.0)], [whole], [hole])[1] == (5, 0, 0, 0, 1.0, 0.0, 1.0, "fail")
    assert gate(spark, fine[:3], [whole], [hole])[1] == (3, 0, 0, 0, 2.0, 0.0, 0.0, "fail")
    assert gate(spark, fine + fine[3:], [whole], [hole])[1] == (5, 0, 0, 0, 0.0, 2.0, 0.0, "fail")
    assert gate(spark, [(*ring[0], 0.0, -1.0), (*ring[1], 1.0, 1.0), *fine[2:]], [whole], [hole])[1] == (4, 1, 1, 0, 0.0, 0.0, 0.0, "fail")
    moved = [fine[0], fine[1], fine[2], (1, 2.0, 3.5, 1.0, 2.0, 0.0, 1.0), (1, 3.5, 4.0, 1.0, 2.0, 0.0, 1.0)]
    assert gate(spark, moved, [whole], [hole])[1] == (5, 0, 0, 2, 0.0, 0.0, 0.0, "fail")
    both = gate(spark, [(2, 0.0, 1.0, 0.0, 1.0, 0.0, 1.0)], [whole])
    assert both[1][-1] == "missing" and both[1][4] == 12.0 and both[2][-1] == "unregistered"


def test_axes_equal_numpy(spark):
    rng = np.random.default_rng(1)
    cases = [np.eye(3), np.zeros((3, 3)), np.diag([2.0, 2.0, 5.0]), np.diag([5.0, 2.0, 5.0]), np.diag([0.0, 0.0, 3.0]), np.diag([1e-9, 1.0, 1e6])]
    for i in range(60):
        a = rng.normal(size=(3, int(rng.integers(1, 5)))) * 10.0 ** int(rng.integers(-3, 4))
        cases.append(a @ a.T if i % 3 else (a + a.T if a.shape == (3, 3) else a @ a.T))
    rows = [(i, *[float(m[r][c]) for r, c in ((0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2))]) for i, m in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, xx double, xy double, xz double, yy double, yz double, zz double")
    for r in df.select("i", I.axes3(F.struct(*I.PAIRS)).alias("a")).collect():
        m = cases[r.i]
        size = max(np.abs(m).max(), 1e-300)
        values, vectors = np.array([a.value for a in r.a]), np.array([[a.x, a.y, a.z] for a in r.a])
        assert np.abs(values - np.linalg.eigvalsh(m)[::-1]).max() <= 1e-9 * size
        assert np.abs(vectors @ vectors.T - np.eye(3)).max() < 1e-9
        assert np.abs(m @ vectors.T - vectors.T * values).max() <= 1e-7 * size
    assert spark.createDataFrame([(None,) * 6], ", ".join(f"{p} double" for p in I.PAIRS)).select(I.axes3(F.struct(*I.PAIRS)).alias("a")).first().a is None


def test_islands_and_radius_profiles(spark):
    a = 0.5
    turned = [(0, 3 + np.cos(a) * u - np.sin(a) * v, 4 + np.sin(a) * u + np.cos(a) * v, w) for u in (-5, 5) for v in (-2, 2) for w in (0, 1)]
    few = [(1, 1.0, 1.0, 1.0), (1, 3.0, 1.0, 1.0), (1, None, 1.0, 1.0)]
    df = spark.createDataFrame([(k, *[None if c is None else float(c) for c in p]) for k, *p in turned + few], "k int, x double, y double, z double")
    got = {r.k: r for r in I.islands(df, ["k"]).collect()}
    assert got[0].n == 8 and np.allclose(got[0].extents, [10, 4, 1]) and np.allclose(got[0].centre, [3, 4, 0.5])
    assert abs(got[0].axes[0].x * np.cos(a) + got[0].axes[0].y * np.sin(a)) == pytest.approx(1)
    assert got[1].n == 2 and got[1].axes is None and got[1].extents == [0, 0, 0] and tuple(got[1].centre) == (2, 1, 1)
    rows = [(0, 0.0, 0.0, -0.5), (0, 4.0, 0.0, 0.2), (0, 2.0, 0.0, 0.4), (1, 0.0, 0.0, 1.5), (1, 6.0, 8.0, 50.0)]
    prof = sorted(map(tuple, I.radius_profile(spark.createDataFrame(rows, "k int, x double, y double, z double"), ["k"]).collect()))
    assert prof == [(0, -1.0, 1, 2.0, 2.0), (0, 0.0, 2, 0.0, 2.0), (1, 1.0, 1, 5.0, 5.0), (1, 46.0, 1, 5.0, 5.0)]


def test_weighted_mean_leaves_out_nulls(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 3.0), (None, 9.0), (5.0, None)], "v double, w double")
    assert df.agg(I.wmean(F.col("v"), F.col("w")).alias("m")).first().m == 2.5
    assert df.where("v is null").agg(I.wmean(F.col("v"), F.col("w")).alias("m")).first().m is None


def test_tail_gives_each_line_once_and_holds_back_a_torn_one(spark, tmp_path):
    folder, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    folder.mkdir()

    def step():  # a new query each time: it goes on from the checkpoint
        q = tail.tail_lines(spark, str(folder), 10).writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(state)).trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted(r.value for r in spark.read.parquet(str(out)).collect())

    a, b = folder / "a.jsonl", folder / "b.jsonl"
    a.write_bytes(b'{"n": 1}\n{"n": "a line of more than one span"}\n{"n"')
    assert step() == ['{"n": "a line of more than one span"}', '{"n": 1}']
    with a.open("ab") as f:
        f.write(b': 3}\r\n\n{"t": "\xc3')
    b.write_bytes(b'{"m": 1}\n')
    second = ["", '{"m": 1}', '{"n": "a line of more than one span"}', '{"n": 1}', '{"n": 3}']
    assert step() == second
    assert step() == second
    with a.open("ab") as f:
        f.write(b'\xa4"}\n')
    assert step() == sorted([*second, '{"t": "ä"}'])
    a.write_bytes(b"new\n")  # replaced by a shorter file
    assert step() == sorted([*second, '{"t": "ä"}', "new"])


def test_hull_corners_are_extremes_of_their_u(spark):
    import random

    from stereobate.operators import stacks

    rnd = random.Random(3)
    pts = [(m, float(rnd.randrange(9)), float(rnd.randrange(9))) for m in range(4) for _ in range(80)]
    got = {r.model_id: {(p.u, p.v) for p in r.hull} for r in stacks.hulls(spark.createDataFrame(pts, "model_id long, u double, v double")).collect()}
    assert got == {m: {tuple(p) for p in stacks._hull(stacks.np.array([q[1:] for q in pts if q[0] == m])).tolist()} for m in range(4)}
