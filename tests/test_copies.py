"""Copies of rows, one place for many: results are whole, and the work is done once for equal rows."""

from itertools import combinations, product

from pyspark.sql import functions as F

from stereobate.operators import gates as G, matching as M, shells as H, spatial as S, topology as T


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_covers_tests_equal_places_and_shapes_once(spark):
    points = [(i, 0.6 + i % 3, 0.5) for i in range(30)]
    boxes = [(100 + i, i % 4 * 0.75, i % 4 * 0.75 + 1.0, 0.0, 1.0) for i in range(40)]
    rows = [(f, [(x0, y0, x1, y0), (x1, y0, x1, y1), (x1, y1, x0, y1), (x0, y1, x0, y0)], x0, x1, y0, y1) for f, x0, x1, y0, y1 in boxes]
    polygons = spark.createDataFrame(rows, "face_id long, sides array<struct<x:double,y:double,x2:double,y2:double>>, x0 double, x1 double, y0 double, y1 double")
    got = S.covers(spark.createDataFrame(points, "point_id long, x double, y double"), polygons, 0.5)
    want = sorted((p, f) for (p, x, y), (f, x0, x1, y0, y1) in product(points, boxes) if x0 < x < x1 and y0 < y < y1)
    assert sorted(map(tuple, got.collect())) == want
    plan = plan_of(got)
    assert plan[plan.index("size(filter(sides"):].count("Aggregate [") >= 2  # distinct places, distinct shapes


def test_matching_reads_many_small_groups_in_one_call(spark):
    rows = [(g, a, b, float((g * 7 + a * 5 + b * 3) % 11)) for g in range(40) for a in range(1 + g % 4) for b in range(1 + g % 3) if (g + a + b) % 5]
    pairs = spark.createDataFrame(rows, "g long, a_id long, b_id long, distance double")
    greedy, most = [], {}
    for g in range(40):
        own, used_a, used_b = sorted((d, a, b) for h, a, b, d in rows if h == g), set(), set()
        for _, a, b in own:
            if a not in used_a and b not in used_b:
                used_a.add(a), used_b.add(b), greedy.append((g, a, b))
        edges = [(a, b) for _, a, b in own]
        most[g] = max((n for n in range(len(edges) + 1) for c in combinations(edges, n) if len({a for a, _ in c}) == n == len({b for _, b in c})), default=0)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # groups go on over batches
    try:
        got = M.match_greedy(pairs, ["g"])
        assert sorted(map(tuple, got.collect())) == sorted(greedy)
        found = list(map(tuple, M.match_most(pairs, ["g"]).collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {(g, a, b) for g, a, b, _ in rows} >= set(found)
    for g in range(40):
        own = [(a, b) for h, a, b in found if h == g]
        assert len(own) == len({a for a, _ in own}) == len({b for _, b in own}) == most[g]
    assert "FlatMapGroupsInPandas" not in plan_of(got)  # no call for each group


def test_nearest_drops_far_pairs_before_the_aggregate(spark, monkeypatch):
    left, right = [(1, i, i * 0.37 % 5, i * 0.73 % 5) for i in range(40)], [(1, i, i * 0.59 % 5, i * 0.91 % 9) for i in range(60)]
    plans, cut = [], S.cut
    monkeypatch.setattr(S, "cut", lambda df: plans.append(plan_of(df)) or cut(df))
    a, b = spark.createDataFrame(left, "m long, id long, x double, y double"), spark.createDataFrame(right, "m long, other long, u double, v double")
    distance = F.abs(F.col("x") - F.col("u")) + F.abs(F.col("y") - F.col("v"))
    want = sorted(min((abs(x - u) + abs(y - v), i, o) for _, o, u, v in right)[1:] for _, i, x, y in left)
    for on in (["m"], []):
        plans.clear()
        got = S.nearest(a, b if on else b.drop("m"), on, [("x", "x", "u", "u"), ("y", "y", "v", "v")], distance, "id", ["other"], 0.5)
        assert sorted((r.id, r.other) for r in got.collect()) == want
        first = next(p for p in plans if "min_by" in p)
        assert "<= 0.5" in next(line for line in first.splitlines() if "Join Inner" in line)


def faces_of(spark, rows):
    return spark.createDataFrame(rows, "model_id long, face_id long, pts array<struct<x:double,y:double,z:double>>")


def boxed(df):
    return df.select("*", *[f(F.col(f"pts.{c}")).alias(f"{c}{i}") for c in "xyz" for i, f in enumerate((F.array_min, F.array_max))])


def level(x, y, z, size=1.0):
    return [(x, y, z), (x + size, y, z), (x + size, y + size, z), (x, y + size, z)]


def test_triangles_meet_by_centre_without_a_row_for_each_neighbouring_cell(spark):
    rows = [(1, i, "k", [(i * 0.0131, 0.0, 0.0), (i * 0.0131 + 1.0, 0.0, 0.0), (i * 0.0131, 1.0, 0.0)]) for i in range(60)]
    moved = [(m, f, k, [(x + (0.0034 if f % 2 else -0.0034), y, z) for x, y, z in pts[1:] + pts[:1]]) for m, f, k, pts in rows]
    schema = "model_id long, face_id long, kind string, pts array<struct<x:double,y:double,z:double>>"
    got = G.match_triangles(spark.createDataFrame(rows, schema), spark.createDataFrame(moved, schema), 0.0035)
    assert sorted((r.a, r.b) for r in got.collect()) == [(i, i) for i in range(60)]
    assert "explode(array(" not in plan_of(got)  # 27 rows for each triangle


def test_pairs_of_faces_carry_their_planes(spark):
    f = boxed(faces_of(spark, [(1, i, level(i * 0.5, 0.0, 0.0)) for i in range(6)]))
    got = H.overlaps(f, 0.001, 0.999999, 1e-7, 0.7)
    assert sorted((r.a, r.b) for r in got.collect()) == [(i, i + 1) for i in range(5)]
    assert plan_of(got).count("Join Inner") == 1  # nothing is joined to the pairs
    assert plan_of(H.crossings(f, 0.02, 0.003, 0.7)).count("Join Inner") == 1


def test_covered_sides_leave_no_pairs(spark):
    f = boxed(faces_of(spark, [(1, 1, level(0.0, 0.0, 0.0)), (1, 2, level(0.0, 0.0, 0.0, 3.0)), (1, 3, level(2.5, 0.0, 0.0))]))
    got = H.uncovered_edges(f, 0.01, 1.0)
    assert sorted((r.face_id, tuple(r.p), tuple(r.q)) for r in got.collect() if r.face_id == 1) == []
    assert sum(r.face_id == 3 for r in got.collect()) == 3
    assert plan_of(got).count("Join ") == 1 and "Join LeftAnti" in plan_of(got)


def test_components_within_a_model_are_settled_in_one_pass(spark):
    links = [(m, m * 1000 + a, m * 1000 + b) for m in range(5) for a in range(1, 40) for b in [(a * 7 + m) % 41] if a != b and (a + m) % 4]
    nodes = sorted({m * 1000 + i for m in range(5) for i in range(41)})
    least = {n: n for n in nodes}
    for _ in nodes:
        for _, a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    df = spark.createDataFrame(links, "m long, a long, b long")
    for most in (3, 1000):  # the smaller goes on to the rounds
        got = T.components(spark.createDataFrame([(n,) for n in nodes], "node long"), df, within="m", most=most)
        assert {r.node: r.component for r in got.collect()} == least


def test_merged_rectangles_form_each_pair_once(spark, monkeypatch):
    rects = spark.createDataFrame([(1, i, i * 0.5, i * 0.5 + 2.5, 0.0, 3.0) for i in range(6)], "m long, face_id long, u0 double, u1 double, v0 double, v1 double")
    seen, components = [], H.components
    monkeypatch.setattr(H, "components", lambda nodes, links, **more: seen.append((links, more)) or components(nodes, links, **more))
    assert [(r.first, r.pieces) for r in H.merge_rectangles(rects, ["m"], 0.3, 0.9, False, 1.0).collect()] == [(0, 6)]
    (links, more) = seen[0]
    assert more == {"within": "on"} and sorted((r.a, r.b) for r in links.collect()) == list(combinations(range(6), 2))[:15]
    assert "Aggregate" not in plan_of(links)


def test_junctions_meet_once_and_bring_their_side(spark):
    ends = "ax double, ay double, az double, bx double, by double, bz double"
    sides = spark.createDataFrame([(1, 0, 9, 0.0, 0.0, 0.0, 3.0, 0.0, 0.0), (1, 0, 8, 0.0, 0.0, 0.0, 0.0, 2.0, 0.0)], f"model_id long, a long, b long, {ends}")
    places = [(0, 0.0, 0.0, 0.0), (9, 3.0, 0.0, 0.0), (8, 0.0, 2.0, 0.0), (5, 0.5, 0.0, 0.0), (6, 1.5, 0.0005, 0.0), (7, 0.0, 1.0, 0.0), (4, 1.0, 1.0, 0.0)]
    got = S.t_junctions(sides, spark.createDataFrame([(1, *p) for p in places], "model_id long, vid long, x double, y double, z double"), 0.5, 0.001)
    assert sorted((r.b, r.vid, r.bx, r.by) for r in got.collect()) == [(8, 7, 0.0, 2.0), (9, 5, 3.0, 0.0), (9, 6, 3.0, 0.0)]
    assert "Aggregate" not in plan_of(got)
