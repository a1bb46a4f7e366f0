"""Single operators on hand-made tables: boundary values, invariances, mutations, streams."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from stereobate.operators import matching as M, ordered as O, rules as U, spatial as S, tables as K, topology as T
from stereobate.sources import readers
from stereobate.streaming import evidence as E

BOX = [(0, 3, 2, 1), (4, 5, 6, 7), (0, 1, 5, 4), (1, 2, 6, 5), (2, 3, 7, 6), (3, 0, 4, 7)]
PLACES = [(x, y, z) for z in (0.0, 3.0) for x, y in ((0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0))]


def box(spark, models=1, faces=BOX):
    rows = [(m, m * 100 + f, c, m * 10 + v, 1) for m in range(models) for f, loop in enumerate(faces) for c, v in enumerate(loop)]
    corners = spark.createDataFrame(rows, "model_id long, face_id long, corner long, vid long, material long")
    vertices = spark.createDataFrame([(m * 10 + i, *p) for m in range(models) for i, p in enumerate(PLACES)], "vid long, x double, y double, z double")
    return corners, vertices


def gate(corners):
    return T.edge_gate(T.edge_uses(T.edges(corners))).collect()


def test_closed_box_passes_and_a_lost_face_opens_four_edges(spark):
    whole = gate(box(spark)[0])
    assert [(r.boundary, r.manifold, r.non_manifold, r.status) for r in whole] == [(0, 12, 0, "pass")]
    lost = gate(box(spark, faces=BOX[1:])[0])
    assert [(r.boundary, r.status) for r in lost] == [(4, "fail")]


def test_fleet_of_copies_gives_that_many_rows(spark):
    assert len(gate(box(spark, 5)[0])) == 5


def test_result_does_not_depend_on_partitions_or_order(spark):
    corners, _ = box(spark, 3)
    key = lambda df: sorted(map(tuple, T.edge_uses(T.edges(df)).collect()))
    assert key(corners) == key(corners.repartition(7).orderBy(F.desc("vid")))


def test_turned_or_reversed_face_is_a_duplicate(spark):
    corners, _ = box(spark, faces=[(0, 1, 2, 3), (2, 3, 0, 1), (3, 2, 1, 0), (4, 5, 6, 7)])
    (row,) = T.duplicate_faces(corners).collect()
    assert (row.copies, row.first_face) == (3, 0)


def test_weld_on_one_grid_splits_at_a_border_and_the_robust_weld_does_not(spark):
    v = spark.createDataFrame([(1, 0.2499999, 0.0, 0.0), (2, 0.2500001, 0.0, 0.0), (3, 5.0, 5.0, 5.0)], "vid long, x double, y double, z double")
    assert {r.vid: r.weld_id for r in T.weld(v, 0.5).collect()} == {1: 1, 2: 2, 3: 3}
    assert {r.vid: r.weld_id for r in T.weld_robust(v, 0.5).collect()} == {1: 1, 2: 1, 3: 3}


def test_components_of_a_long_chain(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).where("a <> 150")
    label = {r.node: r.component for r in T.components(spark.range(301).withColumnRenamed("id", "node"), links).collect()}
    assert all(c == (0 if n <= 150 else 151) for n, c in label.items())


def test_two_fans_at_one_vertex(spark):
    t = spark.createDataFrame([(0, 0, 0, 1, 2, 3, 1), (0, 1, 0, 1, 3, 4, 1), (0, 2, 0, 1, 5, 6, 1)], "model_id long, face_id long, tri long, a long, b long, c long, material long")
    assert [(r.vid, r.fans) for r in T.fan_vertices(t).collect()] == [(1, 2)]


def test_section_of_a_box_has_its_outline(spark):
    corners, vertices = box(spark)
    s = T.section(T.face_corners(T.triangulate(corners), vertices), 1.5)
    total = s.select(F.sum(F.sqrt((F.col("x1") - F.col("x0")) ** 2 + (F.col("y1") - F.col("y0")) ** 2))).first()[0]
    assert total == pytest.approx(40.0)


def test_plan_area_counts_cells(spark):
    corners, vertices = box(spark)
    assert T.plan_cells(T.face_corners(T.triangulate(corners), vertices), 0.5).count() == 400


@pytest.mark.parametrize("gap, pairs", [(0.0, 0), (0.01, 1)])
def test_box_pairs_count_once_over_many_cells(spark, gap, pairs):
    b = spark.createDataFrame([(0, 1, 0.0, 5.0, 0.0, 5.0, 0.0, 5.0), (0, 2, 5.005, 9.0, 0.0, 5.0, 0.0, 5.0)], "model_id long, face_id long, x0 double, x1 double, y0 double, y1 double, z0 double, z1 double")
    assert S.box_pairs(b, 1.0, gap).count() == pairs


def test_maximum_matching_beats_greedy(spark):
    a = spark.createDataFrame([(0, 1, 1.0), (0, 2, 2.0)], "k long, id long, v double")
    b = spark.createDataFrame([(0, 1, 1.9), (0, 2, 2.95)], "k long, id long, v double")
    pairs = M.candidates(a, b, ["k"], {"v": 1.0})
    assert M.match_most(pairs, ["k"]).count() == 2
    assert {(r.a_id, r.b_id) for r in M.match_greedy(pairs, ["k"]).collect()} == {(2, 1)}


def test_questions_keep_ids_and_answers(spark):
    old = spark.createDataFrame([(0, 1, 5.0, "yes"), (0, 2, 50.0, "no")], "k long, id long, v double, answer string")
    new = spark.createDataFrame([(0, 7, 5.2), (0, 8, 90.0)], "k long, id long, v double")
    got = {(r.id, r.answer, r.state) for r in M.merge_questions(old, new, ["k"], {"v": 1.0}, "v2").collect()}
    assert got == {("1", "yes", "kept"), ("v2-8", None, "new"), ("2", "no", "gone v2")}


def test_span_clusters_depend_on_their_anchor(spark):
    d = spark.createDataFrame([(0, v) for v in (0.0, 4.0, 8.0, 12.0)], "k long, v double")
    assert sorted((r.anchor, r.members) for r in O.cluster_span(d, ["k"], "v", 5.0).collect()) == [(0.0, 2), (8.0, 2)]


def test_floor_runs_stay_near_the_first(spark):
    d = spark.createDataFrame([(0, i, v) for i, v in enumerate((1.0, 1.6, 2.2, 9.0))], "k long, l int, v double")
    assert sorted((r.first_level, r.last_level, r.floors) for r in O.collapse_runs(d, ["k"], "l", "v", 1.0).collect()) == [(0, 1, 2), (2, 2, 1), (3, 3, 1)]


def test_ring_cuts_spread_over_opposite_sides(spark):
    q = spark.createDataFrame([(1, 0, 1, 4, 3, [3, 1, 1, 1]), (2, 3, 4, 6, 5, [1, 1, 2, 1])], "face_id long, a long, b long, c long, d long, cuts array<int>")
    got = {(r.a, r.b): r.cuts for r in M.ring_cuts(q).collect()}
    assert got[0, 1] == got[3, 4] == got[5, 6] == 3 and got[1, 4] == 1


def test_empty_stage_is_not_run(spark):
    folded = K.fold_verdict(spark.createDataFrame([(1, "pass"), (1, "review")], "stage long, status string"), ["stage"])
    plan = K.stage_plan(spark.createDataFrame([(1,), (2,)], "stage long"), folded, "stage")
    assert {r.stage: r.verdict for r in plan.collect()} == {1: "review", 2: "not_run"}


def test_null_rule_is_not_measured(spark):
    got = U.findings(spark.createDataFrame([(1, None), (2, 3)], "k long, v long"), "k", {"small": F.col("v") < 5}).collect()
    assert {r.key: r.status for r in got} == {1: "not_measured", 2: "pass"}


def test_approved_rows_survive_a_merge(spark):
    cur = spark.createDataFrame([(1, "a", True), (2, "b", False)], "k long, v string, ok boolean")
    new = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k long, v string")
    merged, conflicts = K.merge_registry(cur, new, "k", ["v"], F.col("ok"))
    assert {r.k: r.v for r in merged.collect()} == {1: "a", 2: "y", 3: "z"}
    assert [tuple(r) for r in conflicts.collect()] == [(1, "x")]


def test_dump_reader_drops_collisions_and_reports_bad_files(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"units": "m", "meshes": [{"name": "A", "vertices": [[0,0,0],[1,0,0],[0,1,0]], "triangles": [[0,1,2]], "material_ids": [4]}, {"name": "UCX_A", "vertices": [], "triangles": [[0,1,2]]}], "helpers": [{"name": "LEVEL_G", "location": [0,0,3.3]}]}')
    (tmp_path / "bad.json").write_text("{")
    got = readers.read_dumps(spark, str(tmp_path))
    assert [(r.model_id, r.material) for r in got["triangles"].collect()] == [("good", 4)]
    assert [(r.level, r.elev) for r in got["levels"].collect()] == [("G", 3.3)]
    assert [r.model_id for r in got["problems"].collect()] == ["bad"]


def test_zip_members_say_what_is_wrong(spark):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("a.txt", "hello")
        z.writestr("../b.txt", "x")
    rows = readers.package_members(spark.createDataFrame([("p", bytearray(buf.getvalue())), ("q", bytearray(b"no"))], "package string, content binary")).collect()
    assert {(r.package, r.path, r.problem) for r in rows} == {("p", "a.txt", None), ("p", "../b.txt", "unsafe_path"), ("q", None, "unreadable")}


def test_markdown_keeps_escaped_pipes(spark):
    t = spark.createDataFrame([(1, "| a | b |\n|---|---|\n| x\\|y | z |\ntext")], "k long, t string")
    assert [r.cells for r in readers.markdown_rows(t, "k", "t").orderBy("line").collect()] == [["a", "b"], ["x|y", "z"]]


def test_image_and_model_headers(spark):
    png = bytes.fromhex("89504E470D0A1A0A0000000D49484452") + (640).to_bytes(4, "big") + (480).to_bytes(4, "big") + bytes([8, 6, 0, 0, 0])
    fbx = b"Kaydara FBX Binary  \x00\x1a\x00" + (7400).to_bytes(4, "little")
    f = spark.createDataFrame([(1, bytearray(png)), (2, bytearray(fbx))], "id long, content binary")
    got = {r.id: r for r in readers.model_header(readers.image_facts(f, "content"), "content").collect()}
    assert (got[1].width, got[1].height, got[1].bits, got[1].colour, got[1].version) == (640, 480, 8, 6, None)
    assert (got[2].ok, got[2].version) == (False, 7400)


def test_versions_are_never_overwritten(spark, tmp_path):
    readers.write_versioned(spark.range(3), str(tmp_path), "1")
    with pytest.raises(Exception, match="already exists"):
        readers.write_versioned(spark.range(3), str(tmp_path), "1")


def test_rule_profiles_become_leaves(spark):
    got = readers.rules_table(spark, {"low": {"limits": {"size": 5, "names": ["a"]}}}).collect()
    assert {(r.path, r.value) for r in got} == {("limits.size", "5"), ("limits.names", '["a"]')}


def _replay(spark, tmp_path, rows, schema, build, mode):
    """Run a stream over two files of rows; the rows it gave."""
    half = len(rows) // 2
    for i, part in enumerate((rows[:half], rows[half:])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "part=*"))
    name = f"t{abs(hash(str(tmp_path)))}"
    q = build(stream).writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name).collect()


def test_streamed_usage_equals_the_batch(spark, sf, tmp_path):
    e = spark.read.parquet(f"{sf}/events.parquet").orderBy("ts").select("ts", F.col("event_type").alias("name"))
    rows = [tuple(r) for r in e.collect()]
    got = _replay(spark, tmp_path, rows, "ts timestamp, name string", lambda s: E.usage_windows(s, "1 day"), "append")
    batch = {(r.start, r.name): r.uses for r in E.usage_windows(e, "1 day").collect()}
    streamed = {(r.start, r.name): r.uses for r in got}
    assert streamed and all(batch[k] == v for k, v in streamed.items())


def test_streamed_gauge_fires_once_between_resets(spark, tmp_path):
    import datetime as dt

    at = lambda i: dt.datetime(2024, 1, 1, 0, i)
    rows = [(1, at(i), i, i == 4, 30.0) for i in range(8)]
    got = _replay(spark, tmp_path, rows, "session long, ts timestamp, event_id long, reset boolean, amount double", lambda s: E.gauge(s, [50.0, 100.0]), "append")
    assert sorted((r.event_id, r.threshold) for r in got) == [(1, 50.0), (3, 100.0), (6, 50.0)]


def test_streamed_recent_keeps_the_last(spark, tmp_path):
    import datetime as dt

    rows = [(1, dt.datetime(2024, 1, 1, 0, i), i) for i in range(6)]
    got = _replay(spark, tmp_path, rows, "session long, ts timestamp, event_id long", lambda s: E.recent(s, 2), "update")
    assert got[-1].event_ids == [4, 5]


@pytest.mark.parametrize("seed", range(6))
def test_largest_matching_equals_brute_force(seed):
    import itertools
    import random

    rng = random.Random(seed)
    n, m = rng.randint(1, 6), rng.randint(1, 6)
    near = [sorted(rng.sample(range(m), rng.randint(0, m))) for _ in range(n)]
    best = max(sum(v in near[u] for u, v in enumerate(p) if v is not None) for p in itertools.permutations([*range(m), *[None] * n], n))
    got = M.largest_matching(near, m)
    taken = [v for v in got if v >= 0]
    assert len(taken) == best == len(set(taken)) and all(v < 0 or v in near[u] for u, v in enumerate(got))


def test_matching_of_a_long_chain_uses_no_recursion():
    n = 20_000
    near = [[u, u + 1] for u in range(n)] + [[0]]
    assert sum(v >= 0 for v in M.largest_matching(near, n + 1)) == n + 1


def test_fans_of_busy_vertices_equal_those_of_others(spark):
    rows = [(0, 7 * f + t, 0, 100 * f + t + 1, 100 * f + t + 2) for f in range(3) for t in range(6)]
    tris = spark.createDataFrame(rows, "model_id long, face_id long, a long, b long, c long").withColumn("tri", F.lit(1))
    want = [(0, 0, 3)]
    for sides in (2, 256):
        assert [tuple(r) for r in T.fan_vertices(tris, sides).collect()] == want
