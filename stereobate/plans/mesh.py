"""Queries of the mesh operators: welding, edges, measures, planes, sections."""

from __future__ import annotations

from pyspark.sql import functions as F

from stereobate.functions.exprs import udim
from stereobate.operators import topology as T
from stereobate.plans.binding import Registry, corners, levels, points, table, vertices, with_

R = Registry()
WELD = 0.5


def _tris(spark, sf):
    return T.triangulate(corners(spark, sf))


def _lines(spark, sf):
    return table(spark, sf, "lineitem")


def _tri_points(spark, sf):
    return T.face_corners(_tris(spark, sf), vertices(spark, sf), _lines(spark, sf))


_WELDED = "welded AS (SELECT vid, min(vid) OVER (PARTITION BY round_even(x / 0.5, 0), round_even(y / 0.5, 0), round_even(z / 0.5, 0)) AS weld_id FROM vertices)"
_USES = """uses AS (SELECT e.model_id, least(p.weld_id, q.weld_id) AS a, greatest(p.weld_id, q.weld_id) AS b, count(*) AS uses,
                   CAST(sum(CASE WHEN p.weld_id < q.weld_id THEN 1 WHEN p.weld_id > q.weld_id THEN -1 ELSE 0 END) AS BIGINT) AS winding
            FROM edges e JOIN welded p ON e.a = p.vid JOIN welded q ON e.b = q.vid GROUP BY ALL)"""


@R.add("mesh_edge_gate", with_("edges", "vertices") + f", {_WELDED}, {_USES}" + """
    SELECT model_id, count(*) FILTER (uses = 1) AS boundary, count(*) FILTER (uses = 2) AS manifold, count(*) FILTER (uses > 2) AS non_manifold,
           CASE WHEN count(*) FILTER (uses > 2) = 0 AND count(*) FILTER (uses = 1) <= 0 THEN 'pass' ELSE 'fail' END AS status
    FROM uses GROUP BY model_id""")  # fmt: skip
def mesh_edge_gate(spark, sf):
    return T.edge_gate(T.edge_uses(T.edges(corners(spark, sf)), T.weld(vertices(spark, sf), WELD), _lines(spark, sf)))


@R.add("d3_edge_uses", with_("edges", "vertices") + f", {_WELDED}, {_USES} SELECT * FROM uses")
def d3_edge_uses(spark, sf):
    return T.edge_uses(T.edges(corners(spark, sf)), T.weld(vertices(spark, sf), WELD), _lines(spark, sf))


@R.add("d2_weld", with_("vertices") + f", {_WELDED} SELECT * FROM welded")
def d2_weld(spark, sf):
    return T.weld(vertices(spark, sf), WELD)


_STEP = lambda s: f"SELECT vid AS a, min(vid) OVER (PARTITION BY round_even((x + {s & 1} * 0.25) / 0.5, 0), round_even((y + {s >> 1 & 1} * 0.25) / 0.5, 0), round_even((z + {s >> 2 & 1} * 0.25) / 0.5, 0)) AS b FROM vertices"


@R.add("d2_weld_robust", with_("vertices").replace("WITH", "WITH RECURSIVE", 1) + f""", {_WELDED},
    links AS (SELECT a, b FROM ({" UNION ".join(_STEP(s) for s in range(8))}) UNION SELECT b, a FROM ({" UNION ".join(_STEP(s) for s in range(8))})),
    reach AS (SELECT vid, vid AS root FROM vertices UNION SELECT r.vid, l.b FROM reach r JOIN links l ON r.root = l.a),
    label AS (SELECT vid, min(root) AS component FROM reach GROUP BY vid),
    wide AS (SELECT component, greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) AS width FROM label JOIN vertices USING (vid) GROUP BY component)
    SELECT vid, CASE WHEN width <= 0.5 THEN component ELSE weld_id END AS weld_id FROM label JOIN wide USING (component) JOIN welded USING (vid)""")  # fmt: skip
def d2_weld_robust(spark, sf):
    return T.weld_robust(vertices(spark, sf), WELD)


@R.add("b5_triangulate", with_("tris") + " SELECT model_id, face_id, tri, a, b, c, material FROM tris")
def b5_triangulate(spark, sf):
    return _tris(spark, sf)


@R.add("c1_corners", with_("tri_points") + " SELECT face_id, tri, ax, ay, az, bx, by_ AS by, bz, cx, cy, cz FROM tri_points")
def c1_corners(spark, sf):
    return _tri_points(spark, sf).select("face_id", "tri", *[f"{k}{c}" for k in "abc" for c in "xyz"])


_MEASURES = """m AS (SELECT *, (by_-ay)*(cz-az)-(bz-az)*(cy-ay) AS nx, (bz-az)*(cx-ax)-(bx-ax)*(cz-az) AS ny, (bx-ax)*(cy-ay)-(by_-ay)*(cx-ax) AS nz_ FROM tri_points),
    m2 AS (SELECT *, sqrt(nx*nx+ny*ny+nz_*nz_) AS size FROM m)"""


@R.add("b3_tri_measures", with_("tri_points") + f""", {_MEASURES}
    SELECT face_id, tri, round(size/2, 6) AS area, round(CASE WHEN size > 0 THEN nz_/size END, 6) AS nz,
           round(degrees(acos(greatest(least(abs(CASE WHEN size > 0 THEN nz_/size END), 1), 0))), 4) AS slope, round((ax+bx+cx)/3, 6) AS mx,
           least(az, bz, cz) AS zmin, greatest(az, bz, cz) AS zmax FROM m2 WHERE size > 0""")  # fmt: skip
def b3_tri_measures(spark, sf):
    m = T.tri_measures(_tri_points(spark, sf)).where("area > 0")
    return m.select("face_id", "tri", F.round("area", 6).alias("area"), F.round("nz", 6).alias("nz"), F.round("slope", 4).alias("slope"), F.round("mx", 6).alias("mx"), "zmin", "zmax")


_NEWELL = """sides AS (SELECT model_id, face_id, x, y, z, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2,
                 coalesce(lead(z) OVER w, first_value(z) OVER w) AS z2 FROM points WINDOW w AS (PARTITION BY face_id ORDER BY corner)),
    newell AS (SELECT model_id, face_id, count(*) AS corners, sum((y-y2)*(z+z2))/2 AS nx, sum((z-z2)*(x+x2))/2 AS ny, sum((x-x2)*(y+y2))/2 AS nz FROM sides GROUP BY ALL)"""


@R.add("b4_face_measures", with_("points") + f", {_NEWELL} SELECT face_id, corners, round(sqrt(nx*nx+ny*ny+nz*nz), 6) AS area, sqrt(nx*nx+ny*ny+nz*nz) < 1e-9 AS flat FROM newell")
def b4_face_measures(spark, sf):
    return T.face_measures(points(spark, sf)).select("face_id", "corners", F.round("area", 6).alias("area"), "flat")


@R.add("b9_project_dominant", with_("points") + f""", {_NEWELL}
    SELECT face_id, CASE WHEN abs(nx) >= abs(ny) AND abs(nx) >= abs(nz) THEN 'x' WHEN abs(ny) >= abs(nz) THEN 'y' ELSE 'z' END AS drop_axis FROM newell""")  # fmt: skip
def b9_project_dominant(spark, sf):
    return T.project_dominant(T.face_measures(points(spark, sf))).select("face_id", "drop_axis")


@R.add("d6_duplicate_faces", with_("corners") + """,
    loops AS (SELECT model_id, face_id, list(vid % 12 ORDER BY corner) AS l FROM corners GROUP BY ALL),
    turned AS (SELECT model_id, face_id, len(l) AS corners, list_min(list_concat(list_transform(range(len(l)), lambda i: list_concat(l[i+1:], l[:i])),
                      list_transform(range(len(l)), lambda i: list_concat(list_reverse(l)[i+1:], list_reverse(l)[:i])))) AS loop FROM loops)
    SELECT model_id, corners, count(*) AS copies, min(face_id) AS first_face FROM turned GROUP BY model_id, corners, loop HAVING count(*) > 1""")  # fmt: skip
def d6_duplicate_faces(spark, sf):
    # The bound tables repeat hardly any face; over the vertices modulo 12 many coincide.
    return T.duplicate_faces(corners(spark, sf).withColumn("vid", F.col("vid") % 12))


@R.add("d6_duplicate_vertices", with_("vertices") + " SELECT x, y, z, count(*) AS copies, min(vid) AS first_vid FROM vertices GROUP BY x, y, z HAVING count(*) > 1")
def d6_duplicate_vertices(spark, sf):
    return T.duplicate_vertices(vertices(spark, sf))


@R.add("d4_mesh_inventory", with_("points", "edges") + """,
    s AS (SELECT model_id, mesh, vid AS a, coalesce(lead(vid) OVER w, first_value(vid) OVER w) AS b FROM corners WINDOW w AS (PARTITION BY face_id ORDER BY corner)),
    u AS (SELECT model_id, mesh, least(a, b) AS a, greatest(a, b) AS b, count(*) AS n FROM s GROUP BY ALL),
    k AS (SELECT model_id, mesh, count(*) FILTER (n = 1) AS boundary, count(*) FILTER (n > 2) AS multi_face, count(*) FILTER (a = b) AS degenerate FROM u GROUP BY ALL)
    SELECT p.*, k.boundary, k.multi_face, k.degenerate FROM (
      SELECT model_id, mesh, count(DISTINCT face_id) AS faces, count(*) AS corners, count(DISTINCT vid) AS used_vertices, min(x) AS xmin, min(y) AS ymin, min(z) AS zmin,
             max(x) AS xmax, max(y) AS ymax, max(z) AS zmax, count(*) - 2 * count(DISTINCT face_id) AS triangles FROM points GROUP BY ALL) p JOIN k USING (model_id, mesh)""")  # fmt: skip
def d4_mesh_inventory(spark, sf):
    return T.mesh_inventory(corners(spark, sf), vertices(spark, sf))


@R.add("d3_interface_edges", with_("edges") + """
    SELECT model_id, low, high, count(*) AS edges FROM (SELECT model_id, least(a, b), greatest(a, b), min(material) AS low, max(material) AS high FROM edges GROUP BY 1, 2, 3)
    WHERE low <> high GROUP BY model_id, low, high""")  # fmt: skip
def d3_interface_edges(spark, sf):
    return T.interface_edges(T.edges(corners(spark, sf)))


@R.add("d5_components", with_("edges").replace("WITH", "WITH RECURSIVE", 1) + """,
    part AS (SELECT DISTINCT a, b FROM edges WHERE face_id % 10 = 0 AND a <> b), both_ AS (SELECT a, b FROM part UNION SELECT b, a FROM part),
    reach AS (SELECT DISTINCT a AS node, a AS root FROM both_ UNION SELECT r.node, l.b FROM reach r JOIN both_ l ON r.root = l.a)
    SELECT node, min(root) AS component FROM reach GROUP BY node""".replace("face_id % 10 = 0 AND ", ""))  # fmt: skip
def d5_components(spark, sf):
    sides = T.edges(corners(spark, sf)).where("a <> b").select("a", "b")
    return T.components(sides.select(F.col("a").alias("node")).union(sides.select("b")), sides)


@R.add("d7_fan_vertices", with_("tris").replace("WITH ", "WITH RECURSIVE ", 1) + """,
    s AS (SELECT model_id, a AS vid, b AS p, c AS q FROM tris UNION SELECT model_id, b, c, a FROM tris UNION SELECT model_id, c, a, b FROM tris),
    l AS (SELECT * FROM s WHERE vid <> p AND vid <> q AND p <> q), d AS (SELECT * FROM l UNION SELECT model_id, vid, q, p FROM l),
    reach AS (SELECT DISTINCT model_id, vid, p AS x, p AS r FROM d UNION SELECT reach.model_id, reach.vid, reach.x, d.q FROM reach JOIN d ON d.model_id = reach.model_id AND d.vid = reach.vid AND d.p = reach.r),
    named AS (SELECT model_id, vid, x, min(r) AS fan FROM reach GROUP BY ALL)
    SELECT model_id, vid, count(DISTINCT fan) AS fans FROM named GROUP BY model_id, vid HAVING count(DISTINCT fan) > 1""")  # fmt: skip
def d7_fan_vertices(spark, sf):
    return T.fan_vertices(_tris(spark, sf), counted=_lines(spark, sf))


@R.add("d14_dominant_planes", with_("tri_points") + f""", {_MEASURES},
    p AS (SELECT model_id, face_id, 'x' AS axis, round_even(ax, 2) AS coordinate, size/2 AS area FROM m2 WHERE size > 0 AND abs(nx) > 0.999*size
          UNION ALL SELECT model_id, face_id, 'y', round_even(ay, 2), size/2 FROM m2 WHERE size > 0 AND abs(ny) > 0.999*size
          UNION ALL SELECT model_id, face_id, 'z', round_even(az, 2), size/2 FROM m2 WHERE size > 0 AND abs(nz_) > 0.999*size)
    SELECT model_id, axis, coordinate, round(sum(area), 6) AS area, count(DISTINCT face_id) AS faces FROM p GROUP BY model_id, axis, coordinate HAVING sum(area) >= 0.5""")  # fmt: skip
def d14_dominant_planes(spark, sf):
    return T.dominant_planes(_tri_points(spark, sf), 0.5, _lines(spark, sf)).withColumn("area", F.round("area", 6))


@R.add("d16_quantiles", with_("tri_points") + f", {_MEASURES} SELECT model_id, quantile_cont(size/2, 0.5) AS p50, quantile_cont(size/2, 0.9) AS p90, quantile_cont(size/2, 0.99) AS p99, count(*) AS n FROM m2 GROUP BY model_id")
def d16_quantiles(spark, sf):
    p = lambda q: F.percentile("area", F.lit(q))
    return T.tri_measures(_tri_points(spark, sf)).groupBy("model_id").agg(p(0.5).alias("p50"), p(0.9).alias("p90"), p(0.99).alias("p99"), F.count("*").alias("n"))


@R.add("d18_geometry_key", with_("points") + """,
    l AS (SELECT model_id, face_id, corner, printf('%d,%d,%d', CAST(round_even((x - min(x) OVER f) / 0.001, 0) AS BIGINT), CAST(round_even((y - min(y) OVER f) / 0.001, 0) AS BIGINT), CAST(round_even((z - min(z) OVER f) / 0.001, 0) AS BIGINT)) AS place
          FROM points WINDOW f AS (PARTITION BY face_id)),
    g AS (SELECT model_id, face_id, list(place ORDER BY corner) AS p FROM l GROUP BY ALL)
    SELECT model_id, face_id, sha1(list_min(list_transform(range(len(p)), lambda i: array_to_string(list_concat(p[i+1:], p[:i]), ';')))) AS key FROM g""")  # fmt: skip
def d18_geometry_key(spark, sf):
    return T.geometry_key(points(spark, sf))


@R.add("d11_section", with_("tri_points") + """,
    n AS (SELECT model_id, CASE WHEN max((least(abs(az-1), abs(bz-1), abs(cz-1)) < 1e-4)::INT) = 1 THEN 1.0001::DOUBLE ELSE 1::DOUBLE END AS h FROM tri_points GROUP BY model_id),
    c AS (SELECT t.*, h FROM tri_points t JOIN n USING (model_id) WHERE least(az, bz, cz) < h AND greatest(az, bz, cz) > h),
    e AS (SELECT model_id, face_id, tri, list_filter([
            CASE WHEN (az < h) <> (bz < h) THEN {'x': ax + (h-az)/(bz-az)*(bx-ax), 'y': ay + (h-az)/(bz-az)*(by_-ay)} END,
            CASE WHEN (bz < h) <> (cz < h) THEN {'x': bx + (h-bz)/(cz-bz)*(cx-bx), 'y': by_ + (h-bz)/(cz-bz)*(cy-by_)} END,
            CASE WHEN (cz < h) <> (az < h) THEN {'x': cx + (h-cz)/(az-cz)*(ax-cx), 'y': cy + (h-cz)/(az-cz)*(ay-cy)} END], lambda s: s IS NOT NULL) AS s FROM c)
    SELECT model_id, face_id, tri, round(s[1].x, 9) AS x0, round(s[1].y, 9) AS y0, round(s[2].x, 9) AS x1, round(s[2].y, 9) AS y1 FROM e""")  # fmt: skip
def d11_section(spark, sf):
    s = T.section(_tri_points(spark, sf), 1.0)
    return s.select("model_id", "face_id", "tri", *[F.round(c, 9).alias(c) for c in ("x0", "y0", "x1", "y1")])


@R.add("d12_plan_area", with_("tri_points") + """,
    c AS (SELECT *, unnest(range(CAST(floor(least(ax,bx,cx)/0.5-0.5) AS INT), CAST(ceil(greatest(ax,bx,cx)/0.5-0.5) AS INT)+1)) AS i FROM tri_points),
    d AS (SELECT *, unnest(range(CAST(floor(least(ay,by_,cy)/0.5-0.5) AS INT), CAST(ceil(greatest(ay,by_,cy)/0.5-0.5) AS INT)+1)) AS j FROM c),
    p AS (SELECT *, (i+0.5::DOUBLE)*0.5 AS x, (j+0.5::DOUBLE)*0.5 AS y FROM d),
    s AS (SELECT model_id, i, j, (bx-ax)*(y-ay)-(by_-ay)*(x-ax) AS s1, (cx-bx)*(y-by_)-(cy-by_)*(x-bx) AS s2, (ax-cx)*(y-cy)-(ay-cy)*(x-cx) AS s3,
                 (bx-ax)*(cy-ay)-(by_-ay)*(cx-ax) AS w FROM p)
    SELECT model_id, count(*) AS cells, count(*) * 0.25::DOUBLE AS area FROM (SELECT DISTINCT model_id, i, j FROM s WHERE abs(w) > 1e-12 AND (least(s1,s2,s3) >= 0 OR greatest(s1,s2,s3) <= 0)) GROUP BY model_id""")  # fmt: skip
def d12_plan_area(spark, sf):
    return T.plan_cells(_tri_points(spark, sf), 0.5).groupBy("model_id").agg(F.count("*").alias("cells"), (F.count("*") * 0.25).alias("area"))


@R.add("d13_floor_areas", with_("tri_points", "levels") + """,
    t AS (SELECT l.level, t.model_id, sqrt(pow((by_-ay)*(cz-az)-(bz-az)*(cy-ay),2)+pow((bz-az)*(cx-ax)-(bx-ax)*(cz-az),2)+pow((bx-ax)*(cy-ay)-(by_-ay)*(cx-ax),2))/2 AS area
          FROM tri_points t JOIN (SELECT level, elev, coalesce(lead(elev) OVER (ORDER BY elev), 1e9) AS top FROM levels) l ON (az+bz+cz)/3 >= l.elev AND (az+bz+cz)/3 < l.top)
    SELECT model_id, level, round(sum(area), 4) AS area, count(*) AS triangles FROM t GROUP BY ALL""")  # fmt: skip
def d13_floor_areas(spark, sf):
    from stereobate.operators.spatial import to_storey

    measured = T.tri_measures(_tri_points(spark, sf))
    ladders = corners(spark, sf).select("model_id").distinct().join(F.broadcast(levels(spark)))
    placed = to_storey(measured, ladders, "mz", ["model_id"])
    return placed.groupBy("model_id", "level").agg(F.round(F.sum("area"), 4).alias("area"), F.count("*").alias("triangles"))


@R.add("d1_bbox", with_("points") + " SELECT model_id, mesh, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1 FROM points GROUP BY ALL")
def d1_bbox(spark, sf):
    from stereobate.operators.spatial import bbox

    return bbox(points(spark, sf), ["model_id", "mesh"])


@R.add("b13_udim", with_("vertices") + " SELECT vid, CASE WHEN x >= 0 AND x < 10 AND y >= 0 AND y < 10 THEN CAST(1001 + floor(x) + 10 * floor(y) AS INT) END AS tile FROM vertices")
def b13_udim(spark, sf):
    return vertices(spark, sf).select("vid", udim(F.col("x"), F.col("y")).alias("tile"))


@R.add("d15_direction_hist", with_("tri_points") + f""", {_MEASURES}
    SELECT model_id, CAST(round_even(degrees(atan2(ny, nx)) / 15, 0) * 15 + 360 AS INT) % 360 AS direction, round(sum(size)/2, 4) AS area, count(*) AS triangles
    FROM m2 WHERE size > 0 AND abs(nz_) < 0.5 * size GROUP BY ALL""")  # fmt: skip
def d15_direction_hist(spark, sf):
    a, b, c = T.corner("a"), T.corner("b"), T.corner("c")
    n = T.cross(T.minus(b, a), T.minus(c, a))
    size = T.length(n)
    t = _tri_points(spark, sf).select("model_id", size.alias("size"), *[v.alias(k) for k, v in zip(("nx", "ny", "nz"), n)]).where("size > 0 and abs(nz) < 0.5 * size")
    turn = F.pmod((F.bround(F.degrees(F.atan2("ny", "nx")) / 15) * 15).cast("int"), F.lit(360))
    return t.groupBy("model_id", turn.alias("direction")).agg(F.round(F.sum("size") / 2, 4).alias("area"), F.count("*").alias("triangles"))


@R.add("d39_rank_parts", with_("tri_points") + f""", {_MEASURES},
    p AS (SELECT model_id, material, sum(size)/2 AS area, sum(size*(az+bz+cz)/3)/nullif(sum(size), 0) AS height FROM m2 GROUP BY ALL)
    SELECT model_id, material, round(area, 4) AS area, round(height, 6) AS height, CAST(row_number() OVER (PARTITION BY model_id ORDER BY area DESC, material) AS INT) AS rank FROM p""")  # fmt: skip
def d39_rank_parts(spark, sf):
    from pyspark.sql import Window

    m = T.tri_measures(_tri_points(spark, sf)).groupBy("model_id", "material").agg(F.sum("area").alias("area"), (F.sum(F.col("area") * F.col("mz")) / F.nullif(F.sum("area"), F.lit(0.0))).alias("height"))
    rank = F.row_number().over(Window.partitionBy("model_id").orderBy(F.desc("area"), "material"))
    return m.select("model_id", "material", F.round("area", 4).alias("area"), F.round("height", 6).alias("height"), rank.alias("rank"))
