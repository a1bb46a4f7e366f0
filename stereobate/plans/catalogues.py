"""Queries of joins and comparisons over keyed tables, boxes and places."""

from __future__ import annotations

from pyspark.sql import functions as F

from stereobate.operators import spatial as S, tables as K, topology as T
from stereobate.plans.binding import FEW, MATERIAL_RANGES, Registry, boxes, corners, findings, levels, material_ranges, panel_faces, panels, plan_segments, points, table, vertices, with_

R = Registry()


@R.add("c2_to_storey", with_("panels", "levels") + """,
    m AS (SELECT model_id, level, elev + model_id % 3 * 0.5 AS elev FROM (SELECT DISTINCT model_id FROM panels), levels),
    l AS (SELECT *, coalesce(lead(elev) OVER (PARTITION BY model_id ORDER BY elev), 'infinity'::DOUBLE) AS top FROM m)
    SELECT p.model_id, p.face_id, l.level FROM panels p JOIN l ON l.model_id = p.model_id AND p.z0 >= l.elev AND p.z0 < l.top""")  # fmt: skip
def c2_to_storey(spark, sf):
    p = panels(spark, sf).select("model_id", "face_id", "z0")
    # Every model has its own ladder of levels; the few levels are laid beside its models.
    ladders = p.select("model_id").distinct().join(F.broadcast(levels(spark))).withColumn("elev", F.col("elev") + F.col("model_id") % 3 * 0.5)
    return S.to_storey(p, ladders, "z0", ["model_id"]).select("model_id", "face_id", "level")


_PAIRS = """pairs AS (SELECT p.model_id, p.face_id AS a, q.face_id AS b, p.x0, p.x1, p.y0, p.y1, p.z0, p.z1, q.x0 AS qx0, q.x1 AS qx1, q.y0 AS qy0, q.y1 AS qy1, q.z0 AS qz0, q.z1 AS qz1
      FROM boxes p JOIN boxes q ON p.model_id = q.model_id AND p.face_id < q.face_id AND p.x0 - {g} <= q.x1 AND q.x0 - {g} <= p.x1 AND p.y0 - {g} <= q.y1 AND q.y0 - {g} <= p.y1 AND p.z0 - {g} <= q.z1 AND q.z0 - {g} <= p.z1)"""
_SMALL = with_("panels") + ", boxes AS (SELECT model_id, face_id, x0, x1, y0, y1, z0, z1 FROM panels)"


def _small(spark, sf):
    return panels(spark, sf).select("model_id", "face_id", *[f"{c}{i}" for c in "xyz" for i in "01"])


@R.add("c3_overlaps", _SMALL + ", " + _PAIRS.format(g=0) + """
    SELECT model_id, a, b, round((least(x1, qx1) - greatest(x0, qx0)) * (least(y1, qy1) - greatest(y0, qy0)), 6) AS area FROM pairs
    WHERE (least(x1, qx1) - greatest(x0, qx0)) * (least(y1, qy1) - greatest(y0, qy0)) >= 0.0000001""")  # fmt: skip
def c3_overlaps(spark, sf):
    p = S.box_pairs(_small(spark, sf), 2.0)
    return p.withColumn("area", F.col("shared_x") * F.col("shared_y")).where("area >= 1e-7").select("model_id", "a", "b", F.round("area", 6).alias("area"))


@R.add("c16_contacts", _SMALL + ", " + _PAIRS.format(g=0.002) + " SELECT model_id, a, b FROM pairs")
def c16_contacts(spark, sf):
    return S.box_pairs(_small(spark, sf), 2.0, 0.002).select("model_id", "a", "b")


@R.add("c6_nearest_box", _SMALL + """,
    n AS (SELECT p.model_id, p.face_id, q.face_id AS other, abs(p.x0-q.x0)+abs(p.x1-q.x1)+abs(p.y0-q.y0)+abs(p.y1-q.y1)+abs(p.z0-q.z0)+abs(p.z1-q.z1) AS distance
          FROM boxes p JOIN boxes q ON p.model_id = q.model_id AND q.face_id % 2 = 1 WHERE p.face_id % 2 = 0)
    SELECT model_id, face_id, other, distance FROM n QUALIFY row_number() OVER (PARTITION BY model_id, face_id ORDER BY distance, other) = 1""")  # fmt: skip
def c6_nearest_box(spark, sf):
    b = _small(spark, sf)
    sides = [f"{c}{i}" for c in "xyz" for i in "01"]
    left = b.where("face_id % 2 = 0").select("model_id", "face_id", *[F.col(s).alias(f"p_{s}") for s in sides])
    right = b.where("face_id % 2 = 1").select("model_id", F.col("face_id").alias("other"), *sides)
    distance = sum((F.abs(F.col(f"p_{s}") - F.col(s)) for s in sides[1:]), F.abs(F.col("p_x0") - F.col("x0")))
    # The summed difference is never less than that of the low corners along one axis.
    axes = [(f"p_{c}0", f"p_{c}0", f"{c}0", f"{c}0") for c in "xyz"]
    return S.nearest(left, right, ["model_id"], axes, distance, "face_id", ["other"], 1.0).select("model_id", "face_id", "other", "distance")


# Walls run along an axis: the distance is that to a box without width.
@R.add("c5_nearest_wall", with_("panels", "plan_segments") + """,
    p AS (SELECT model_id, face_id AS point_id, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y FROM panels WHERE axis = 2),
    m AS (SELECT p.model_id, point_id, s.face_id AS wall, round(sqrt(pow(greatest(px - x, x - qx, 0), 2) + pow(greatest(py - y, y - qy, 0), 2)), 9) AS distance,
                 CASE WHEN py = qy THEN x - 0.25 >= px - 0.05 AND x + 0.25 <= qx + 0.05 ELSE y - 0.25 >= py - 0.05 AND y + 0.25 <= qy + 0.05 END AS fits
          FROM p JOIN plan_segments s USING (model_id))
    SELECT model_id, point_id, wall, round(distance, 6) AS distance, fits FROM m QUALIFY row_number() OVER (PARTITION BY model_id, point_id ORDER BY NOT fits, distance, wall) = 1""")  # fmt: skip
def c5_nearest_wall(spark, sf):
    points = panels(spark, sf).where("axis = 2").select("model_id", F.col("face_id").alias("point_id"), ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"))
    walls = plan_segments(spark, sf).withColumnRenamed("face_id", "wall")
    return S.nearest_wall(points, walls, ["model_id"], 0.25, 0.05, 1.0).withColumn("distance", F.round("distance", 6))


@R.add("c10_outside", with_("vertices") + """,
    rects AS (SELECT n_nationkey * 0.5::DOUBLE AS x0, n_nationkey * 0.5 + 0.3::DOUBLE AS x1, 0::DOUBLE AS y0, 2::DOUBLE AS y1 FROM nation)
    SELECT vid FROM vertices v WHERE NOT EXISTS (SELECT 1 FROM rects r WHERE v.x >= r.x0 - 0.05 AND v.x <= r.x1 + 0.05 AND v.y >= r.y0 - 0.05 AND v.y <= r.y1 + 0.05)""")  # fmt: skip
def c10_outside(spark, sf):
    x = F.col("n_nationkey") * 0.5
    rects = table(spark, sf, "nation").select(x.alias("x0"), (x + 0.3).alias("x1"), F.lit(0.0).alias("y0"), F.lit(2.0).alias("y1"))
    return S.outside(vertices(spark, sf), rects, 0.05).select("vid")


def _polygons(spark, sf):
    """Level panels as polygons with their sides."""
    p = panels(spark, sf).where("axis = 2").withColumn("pts", F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"))]))
    sides = F.transform("pts", lambda q, i: F.struct(q["x"].alias("x"), q["y"].alias("y"), F.get("pts", (i + 1) % 4)["x"].alias("x2"), F.get("pts", (i + 1) % 4)["y"].alias("y2")))
    return p.select("face_id", sides.alias("sides"), "x0", "x1", "y0", "y1")


def _plan_points(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("point_id"), (F.col("c_custkey") % 97 * 0.13 + 0.011).alias("x"), (F.col("c_custkey") % 89 * 0.041 + 0.007).alias("y"))


_PLAN_POINTS = "pp AS (SELECT c_custkey AS point_id, (c_custkey % 97) * 0.13::DOUBLE + 0.011 AS x, (c_custkey % 89) * 0.041::DOUBLE + 0.007 AS y FROM customer)"


@R.add("c11_covers", with_("panels") + f", {_PLAN_POINTS} SELECT point_id, face_id FROM pp JOIN panels ON axis = 2 AND x > x0 AND x < x1 AND y > y0 AND y < y1")
def c11_covers(spark, sf):
    return S.covers(_plan_points(spark, sf), _polygons(spark, sf), 0.5)


@R.add("c12_top_surface", with_("panels") + f""", {_PLAN_POINTS},
    flat AS (SELECT DISTINCT x0, x1, y0, y1, z0 FROM panels WHERE axis = 2),
    over_ AS (SELECT point_id, max(z0) AS z FROM pp JOIN flat ON x >= x0 AND x <= x1 AND y >= y0 AND y <= y1 GROUP BY point_id),
    bare AS (SELECT DISTINCT x, y FROM pp WHERE point_id NOT IN (SELECT point_id FROM over_)),
    beside AS (SELECT x, y, arg_min(z0, (round(sqrt(pow(greatest(x0 - x, x - x1, 0), 2) + pow(greatest(y0 - y, y - y1, 0), 2)), 9), -z0)) AS z FROM bare, flat GROUP BY x, y)
    SELECT point_id, z, false AS extrapolated FROM over_ UNION ALL SELECT point_id, z, true FROM pp JOIN beside USING (x, y) WHERE point_id NOT IN (SELECT point_id FROM over_)""")  # fmt: skip
def c12_top_surface(spark, sf):
    p = panels(spark, sf).where("axis = 2")
    half = lambda b, c: F.struct(*[F.col(x).alias(f"{k}{i}") for k, corner in zip("abc", (("x0", "y0"), b, c)) for i, x in zip("xyz", (*corner, "z0"))])
    tris = p.select("face_id", F.explode(F.array(half(("x1", "y0"), ("x1", "y1")), half(("x1", "y1"), ("x0", "y1")))).alias("t")).select("face_id", "t.*")
    return S.top_surface(_plan_points(spark, sf), tris, 0.5).select("point_id", F.round("z", 9).alias("z"), "extrapolated")


# Sides run along an axis: a vertex inside one has its two other coordinates.
_ALONG = " UNION ALL ".join(f"SELECT s.* FROM s JOIN v ON s.model_id = v.model_id AND s.{q} = v.{q} AND s.{r} = v.{r} AND v.{p} > s.{p} AND v.{p} < s.{p}2 WHERE s.{q} = s.{q}2 AND s.{r} = s.{r}2" for p, q, r in ("xyz", "yzx", "zxy"))


@R.add("c14_t_junctions", with_("panel_sides") + f""",
    s AS (SELECT DISTINCT model_id, p[1] AS x, p[2] AS y, p[3] AS z, q[1] AS x2, q[2] AS y2, q[3] AS z2 FROM (SELECT model_id, least([ax,ay,az],[bx,by_,bz]) AS p, greatest([ax,ay,az],[bx,by_,bz]) AS q FROM panel_sides)),
    v AS (SELECT DISTINCT model_id, ax AS x, ay AS y, az AS z FROM panel_sides)
    SELECT model_id, x AS ax, y AS ay, z AS az, x2 AS bx, y2 AS by_, z2 AS bz, count(*) AS vertices FROM ({_ALONG}) GROUP BY ALL""", here=True)  # fmt: skip
def c14_t_junctions(spark, sf):
    from stereobate.operators import shells as H

    # Places are named by a hash; sides and vertices of a model are told apart by place, not by face.
    place = lambda c: F.xxhash64(c)
    sides = H.side_uses(panel_faces(spark, sf, FEW)).select("model_id", place("p").alias("a"), place("q").alias("b"), *[F.col(f"{e}.{c}").alias(f"{k}{c}") for k, e in (("a", "p"), ("b", "q")) for c in "xyz"])
    ends = H.sides_of(panel_faces(spark, sf, FEW)).select("model_id", "p").distinct().select("model_id", place("p").alias("vid"), "p.*")
    met = S.t_junctions(sides, ends, 0.5, 0.001).groupBy("model_id", "a", "b", *[f"{k}{c}" for k in "ab" for c in "xyz"]).agg(F.count("*").alias("vertices"))
    return met.select("model_id", *[F.col(f"{k}{c}").alias({"by": "by_"}.get(f"{k}{c}", f"{k}{c}")) for k in "ab" for c in "xyz"], "vertices")


@R.add("c17_nest", _SMALL + """
    SELECT o.model_id, o.face_id AS outer, i.face_id AS inner FROM boxes o JOIN boxes i ON o.model_id = i.model_id AND o.face_id <> i.face_id
      AND i.x0 >= o.x0 - 0.012 AND i.x1 <= o.x1 + 0.012 AND i.z0 >= o.z0 - 0.012 AND i.z1 <= o.z1 + 0.012""".replace("AS outer", 'AS "outer"').replace("AS inner", 'AS "inner"'))  # fmt: skip
def c17_nest(spark, sf):
    b = _small(spark, sf)
    return S.nested(b, b, ["model_id"], 0.012, 1.0)


@R.add("c18_expand_instances", "SELECT o_orderkey AS object_id, p_partkey AS part_id, p_size FROM orders JOIN part ON p_partkey // 8 = o_custkey")
def c18_expand_instances(spark, sf):
    objects = table(spark, sf, "orders").select(F.col("o_orderkey").alias("object_id"), F.col("o_custkey").alias("type"))
    types = table(spark, sf, "part").select(F.floor(F.col("p_partkey") / 8).alias("type"), F.col("p_partkey").alias("part_id"), "p_size")
    return objects.join(types, "type").select("object_id", "part_id", "p_size")


@R.add("c19_missing_extra", """
    SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'missing' ELSE 'extra' END AS side
    FROM (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity < 10) a FULL JOIN (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 45) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""")  # fmt: skip
def c19_missing_extra(spark, sf):
    d = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("k"), "l_quantity")
    return K.missing_extra(d.where("l_quantity < 10"), d.where("l_quantity > 45"), ["k"])


@R.add("c20_trace_coverage", """
    WITH t AS (SELECT c_nationkey AS rule, count(*) AS traced FROM customer GROUP BY 1)
    SELECT coalesce(n_nationkey, rule) AS rule, coalesce(traced, 0) AS traced, CASE WHEN n_nationkey IS NULL THEN 'unknown' WHEN traced IS NULL THEN 'untraced' WHEN traced = 1 THEN 'ok' ELSE 'repeated' END AS state
    FROM (SELECT * FROM nation WHERE n_regionkey < 4) FULL JOIN t ON n_nationkey = rule""")  # fmt: skip
def c20_trace_coverage(spark, sf):
    rules = table(spark, sf, "nation").where("n_regionkey < 4").select(F.col("n_nationkey").alias("rule"))
    return K.trace_coverage(rules, table(spark, sf, "customer").select(F.col("c_nationkey").alias("rule")), "rule")


@R.add("c21_referential", """
    SELECT DISTINCT l_partkey AS k, 'orphan' AS problem FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)
    UNION ALL SELECT p_partkey, 'unused' FROM part WHERE p_size > 5 AND p_partkey NOT IN (SELECT l_partkey FROM lineitem)""")  # fmt: skip
def c21_referential(spark, sf):
    return K.referential(table(spark, sf, "lineitem").select(F.col("l_partkey").alias("k")), table(spark, sf, "part").where("p_size > 5").select(F.col("p_partkey").alias("k")), ["k"])


@R.add("c22_bind_evidence", """
    WITH r AS (SELECT page_id, length(html) AS n, sha256(html) AS digest FROM pages WHERE page_id % 11 <> 0), a AS (SELECT page_id, length(html) AS n, sha256(CASE WHEN page_id % 5 = 0 THEN html || '!' ELSE html END) AS digest FROM pages WHERE page_id % 7 <> 0)
    SELECT coalesce(r.page_id, a.page_id) AS page_id, CASE WHEN a.page_id IS NULL THEN 'gone' WHEN r.page_id IS NULL THEN 'new' WHEN r.n = a.n AND r.digest = a.digest THEN 'same' ELSE 'changed' END AS state FROM r FULL JOIN a ON r.page_id = a.page_id""")  # fmt: skip
def c22_bind_evidence(spark, sf):
    p = table(spark, sf, "pages")
    old = p.where("page_id % 11 <> 0").select("page_id", F.length("html").alias("n"), F.sha2("html", 256).alias("digest"))
    new = p.where("page_id % 7 <> 0").select("page_id", F.length("html").alias("n"), F.sha2(F.when(F.col("page_id") % 5 == 0, F.concat("html", F.lit("!"))).otherwise(F.col("html")), 256).alias("digest"))
    return K.bind_evidence(old, new, "page_id", ["n", "digest"])


@R.add("c27_first_wins", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_partkey, l_suppkey) = 1")
def c27_first_wins(spark, sf):
    return K.first_wins(table(spark, sf, "lineitem"), ["l_orderkey"], ["l_quantity", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_partkey", "l_quantity")


_GROUP = "CASE WHEN material = 0 THEN 'unassigned' ELSE coalesce(material_group, 'out_of_range') END"


@R.add("d23_material_check", with_("corners", "ranges") + f" SELECT model_id, {_GROUP} AS material_group, count(*) AS uses, count(DISTINCT material) AS materials FROM corners LEFT JOIN ranges ON material BETWEEN first_id AND last_id GROUP BY ALL")
def d23_material_check(spark, sf):
    g = K.material_group(corners(spark, sf), material_ranges(spark), "material")
    return g.groupBy("model_id", "material_group").agg(F.count("*").alias("uses"), F.countDistinct("material").alias("materials"))


@R.add("b8_sub_soup", with_("tris") + " SELECT face_id, tri FROM tris WHERE face_id NOT IN (SELECT face_id FROM tris WHERE a % 7 = 0 OR b % 7 = 0 OR c % 7 = 0)")
def b8_sub_soup(spark, sf):
    tris = T.triangulate(corners(spark, sf))
    gone = tris.where("a % 7 = 0 or b % 7 = 0 or c % 7 = 0").select("face_id")
    return tris.join(gone, "face_id", "left_anti").select("face_id", "tri")


@R.add("b6_assign_materials", """
    SELECT p_partkey, CAST(CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN CASE p_brand WHEN 'Brand#1' THEN 11 ELSE 12 END WHEN p_type = 'SMALL' THEN 16 WHEN p_type = 'LARGE' THEN 21 ELSE 0 END AS INT) AS material FROM part""")  # fmt: skip
def b6_assign_materials(spark, sf):
    by_mesh = spark.createDataFrame([("Brand#1", 11), ("Brand#2", 12)], "mesh string, mesh_material int")
    by_slot = spark.createDataFrame([("SMALL", 16), ("LARGE", 21)], "slot string, slot_material int")
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("mesh"), F.col("p_type").alias("slot"))
    return K.assign_materials(parts, by_mesh, by_slot).select("p_partkey", "material")


@R.add("d17_budget", with_("tris") + """, t AS (SELECT model_id, CASE WHEN material BETWEEN 1 AND 15 THEN 'wall' WHEN material BETWEEN 16 AND 20 THEN 'glass' ELSE 'other' END AS role, count(*) AS total FROM tris GROUP BY ALL)
    SELECT model_id, role, total, CASE WHEN role = 'other' THEN 'not_measured' WHEN total <= CASE role WHEN 'wall' THEN 900 ELSE 200 END THEN 'pass' ELSE 'fail' END AS status FROM t""")  # fmt: skip
def d17_budget(spark, sf):
    m = F.col("material")
    role = F.when(m.between(1, 15), "wall").when(m.between(16, 20), "glass").otherwise("other")
    facts = T.triangulate(corners(spark, sf)).select("model_id", role.alias("role"), F.lit(1).cast("long").alias("n"))
    limits = spark.createDataFrame([("wall", 900), ("glass", 200)], "role string, most long")
    return K.budget(facts, limits, ["model_id"], "role", "n").select("model_id", "role", "total", "status")


@R.add("d21_fold_verdict", with_("findings") + """
    SELECT model_id, stage, CASE max(CASE status WHEN 'pass' THEN 0 WHEN 'not_run' THEN 1 WHEN 'review' THEN 2 ELSE 3 END) WHEN 0 THEN 'pass' WHEN 1 THEN 'not_run' WHEN 2 THEN 'review' ELSE 'fail' END AS verdict,
           count(*) FILTER (status = 'pass') AS n_pass, count(*) FILTER (status = 'not_run') AS n_not_run, count(*) FILTER (status = 'review') AS n_review, count(*) FILTER (status = 'fail') AS n_fail FROM findings GROUP BY ALL""")  # fmt: skip
def d21_fold_verdict(spark, sf):
    return K.fold_verdict(findings(spark, sf), ["model_id", "stage"])


@R.add("l1_stage_plan", with_("findings") + """,
    v AS (SELECT stage, max(CASE status WHEN 'pass' THEN 0 WHEN 'not_run' THEN 1 WHEN 'review' THEN 2 ELSE 3 END) AS w FROM findings GROUP BY stage)
    SELECT s.stage, CASE coalesce(w, 1) WHEN 0 THEN 'pass' WHEN 1 THEN 'not_run' WHEN 2 THEN 'review' ELSE 'fail' END AS verdict FROM (SELECT unnest(range(17)) AS stage) s LEFT JOIN v USING (stage)""")  # fmt: skip
def l1_stage_plan(spark, sf):
    folded = K.fold_verdict(findings(spark, sf), ["stage"])
    return K.stage_plan(spark.range(17).withColumnRenamed("id", "stage"), folded, "stage").select("stage", "verdict")


@R.add("d22_roll_up", with_("findings") + """
    SELECT stage, count(*) AS checks, count(*) FILTER (status = 'pass') AS passes, count(*) FILTER (status = 'fail') AS fails, count(*) FILTER (status = 'pass') = count(*) AS passed,
           CAST(CASE WHEN count(*) FILTER (status = 'fail') > 0 THEN 1 WHEN count(*) FILTER (status = 'pass') < count(*) THEN 2 ELSE 0 END AS INT) AS exit_code FROM findings WHERE event_id % 4 = 0 GROUP BY stage""".replace(" WHERE event_id % 4 = 0", ""))  # fmt: skip
def d22_roll_up(spark, sf):
    return K.roll_up(findings(spark, sf), ["stage"])


@R.add("d26_duplicate_files", "SELECT sha256(text) AS digest, count(*) AS files, CAST(max(strlen(text)) AS BIGINT) AS bytes, min(doc_id) AS first_id FROM documents WHERE strlen(text) <= 100000 GROUP BY 1 HAVING count(*) > 1")
def d26_duplicate_files(spark, sf):
    return K.duplicate_files(table(spark, sf, "documents").withColumnRenamed("doc_id", "id"), "text", 100_000)


@R.add("d28_usage_stats", """
    WITH known(name) AS (VALUES ('click'), ('view'), ('purchase'), ('refund')), u AS (SELECT event_type AS name, count(*) AS uses FROM events GROUP BY 1)
    SELECT coalesce(known.name, u.name) AS name, coalesce(uses, 0) AS uses, CASE WHEN known.name IS NULL THEN 'other' WHEN uses IS NULL THEN 'never' ELSE 'known' END AS kind FROM known FULL JOIN u ON known.name = u.name""")  # fmt: skip
def d28_usage_stats(spark, sf):
    known = spark.createDataFrame([("click",), ("view",), ("purchase",), ("refund",)], "name string")
    return K.usage_stats(table(spark, sf, "events").select(F.col("event_type").alias("name")), known, "name")


@R.add("d29_islands", """
    WITH v AS (SELECT label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)
    SELECT label, count(*) AS n, round(avg(x), 6) AS mx, round(covar_samp(x, x), 6) AS xx, round(covar_samp(x, y), 6) AS xy, round(covar_samp(y, z), 6) AS yz FROM v GROUP BY label""")  # fmt: skip
def d29_islands(spark, sf):
    v = table(spark, sf, "embeddings").select("label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate("xyz")])
    c = lambda a, b: F.round(F.covar_samp(a, b), 6)
    return v.groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg("x"), 6).alias("mx"), c("x", "x").alias("xx"), c("x", "y").alias("xy"), c("y", "z").alias("yz"))


@R.add("d31_height_levels", with_("tri_points") + " SELECT round(greatest(az, bz, cz), 2) AS top, count(*) AS n FROM tri_points GROUP BY 1 ORDER BY n DESC, top LIMIT 10")
def d31_height_levels(spark, sf):
    t = T.face_corners(T.triangulate(corners(spark, sf)), vertices(spark, sf))
    return t.groupBy(F.round(F.greatest("az", "bz", "cz"), 2).alias("top")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "top").limit(10)


@R.add("d36_window_types", with_("intervals") + """,
    t AS (SELECT hi - lo AS w, face_id % 4 AS panes, count(*) AS n FROM intervals GROUP BY ALL)
    SELECT w, panes, n, (SELECT min(u.w) FROM t u WHERE u.panes = t.panes AND u.w >= t.w - 1 AND u.w < t.w) AS same_as FROM t""")  # fmt: skip
def d36_window_types(spark, sf):
    from pyspark.sql import Window
    from stereobate.plans.binding import intervals

    t = intervals(spark, sf).groupBy((F.col("hi") - F.col("lo")).alias("w"), (F.col("face_id") % 4).alias("panes")).agg(F.count("*").alias("n"))
    near = Window.partitionBy("panes").orderBy("w").rangeBetween(-1, 0)
    return t.withColumn("same_as", F.nullif(F.min("w").over(near), F.col("w")))


@R.add("d42_area_conservation", with_("tri_points", "points") + """,
    c AS (SELECT face_id, sum(abs((bx-ax)*(cy-ay)-(by_-ay)*(cx-ax)))/2 AS child_area, count(*) AS children FROM tri_points GROUP BY face_id),
    b AS (SELECT face_id, (max(x)-min(x))*(max(y)-min(y)) AS parent_area FROM points GROUP BY face_id)
    SELECT face_id, children, abs(coalesce(child_area, 0) - coalesce(parent_area, 0)) <= 1 AS kept FROM c FULL JOIN b USING (face_id)""")  # fmt: skip
def d42_area_conservation(spark, sf):
    t = T.face_corners(T.triangulate(corners(spark, sf)), vertices(spark, sf))
    c = lambda s: F.col(s)
    children = t.select("face_id", (F.abs((c("bx") - c("ax")) * (c("cy") - c("ay")) - (c("by") - c("ay")) * (c("cx") - c("ax"))) / 2).alias("area"))
    parents = boxes(spark, sf).select("face_id", ((c("x1") - c("x0")) * (c("y1") - c("y0"))).alias("area"))
    return K.area_conservation(children, parents, "face_id", 1.0).select("face_id", "children", "kept")


_CELLS = "cells AS (SELECT DISTINCT model_id, CAST(floor(x0) AS BIGINT) AS i, CAST(floor(y0) AS BIGINT) AS j, CAST(floor(z0) AS BIGINT) AS k FROM panels)"


def _cells(spark, sf):
    return panels(spark, sf).select("model_id", F.floor("x0").cast("long").alias("i"), F.floor("y0").cast("long").alias("j"), F.floor("z0").cast("long").alias("k")).distinct()


@R.add("d43_cell_faces", with_("panels") + f", {_CELLS}" + """
    SELECT c.model_id, a.axis, a.side, c.i, c.j, c.k FROM cells c, (VALUES ('i', -1, -1, 0, 0), ('i', 1, 1, 0, 0), ('j', -1, 0, -1, 0), ('j', 1, 0, 1, 0), ('k', -1, 0, 0, -1), ('k', 1, 0, 0, 1)) a(axis, side, di, dj, dk)
    WHERE NOT EXISTS (SELECT 1 FROM cells n WHERE n.model_id = c.model_id AND n.i = c.i + di AND n.j = c.j + dj AND n.k = c.k + dk)""")  # fmt: skip
def d43_cell_faces(spark, sf):
    return K.exposed_faces(_cells(spark, sf))


@R.add("n10_cell_rectangles", with_("panels") + f", {_CELLS}, p AS (SELECT DISTINCT model_id, i, j FROM cells)" + """,
    r AS (SELECT model_id, j, min(i) AS i0, max(i) AS i1 FROM (SELECT *, i - row_number() OVER (PARTITION BY model_id, j ORDER BY i) AS g FROM p) GROUP BY model_id, j, g)
    SELECT model_id, i0, i1, min(j) AS j0, max(j) AS j1 FROM (SELECT *, j - row_number() OVER (PARTITION BY model_id, i0, i1 ORDER BY j) AS h FROM r) GROUP BY model_id, i0, i1, h""")  # fmt: skip
def n10_cell_rectangles(spark, sf):
    return K.cell_rectangles(_cells(spark, sf))


@R.add("k1_compare_specs", """
    WITH a AS (SELECT l_orderkey AS k, sum(l_quantity) AS v FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1), b AS (SELECT l_orderkey AS k, sum(l_quantity) AS v FROM lineitem WHERE l_linenumber BETWEEN 2 AND 5 GROUP BY 1)
    SELECT k, a.v AS left_value, b.v AS right_value, CASE WHEN a.v IS NULL OR b.v IS NULL THEN 'deferred' WHEN abs(a.v - b.v) <= 20 + 1e-9 THEN 'match' ELSE 'no_match' END AS verdict FROM a FULL JOIN b USING (k)""")  # fmt: skip
def k1_compare_specs(spark, sf):
    d = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "k")
    v = F.sum("l_quantity").alias("v")
    return K.compare_values(d.where("l_linenumber <= 3").groupBy("k").agg(v), d.where("l_linenumber between 2 and 5").groupBy("k").agg(v), ["k"], "v", 20.0)


_REG = "c AS (SELECT s_suppkey AS k, s_acctbal AS v, s_suppkey % 2 = 0 AS ok FROM supplier), p AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 7 = 0 THEN s_acctbal + 1 ELSE s_acctbal END AS v FROM supplier WHERE s_suppkey % 5 <> 0)"


def _registry(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("v"))
    proposed = s.where("k % 5 <> 0").withColumn("v", F.when(F.col("k") % 7 == 0, F.col("v") + 1).otherwise(F.col("v")))
    return K.merge_registry(s, proposed, "k", ["v"], F.col("k") % 2 == 0)


@R.add("m1_merge_registry", f"WITH {_REG} SELECT k, CASE WHEN p.k IS NULL OR c.ok THEN c.v ELSE p.v END AS v FROM c LEFT JOIN p USING (k)")
def m1_merge_registry(spark, sf):
    return _registry(spark, sf)[0]


@R.add("m1_registry_conflicts", f"WITH {_REG} SELECT k, p.v FROM c JOIN p USING (k) WHERE ok AND c.v <> p.v")
def m1_registry_conflicts(spark, sf):
    return _registry(spark, sf)[1]


@R.add("m3_apply_decisions", "SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 'confirmed' ELSE p_type END AS status FROM part")
def m3_apply_decisions(spark, sf):
    entries = table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("status"))
    decisions = entries.where("p_partkey % 9 = 0").select("p_partkey", F.lit("confirmed").alias("status"))
    return K.apply_decisions(entries, decisions, "p_partkey", "status")[0].select("p_partkey", "status")


@R.add("g_material_ranges", " UNION ALL ".join(f"SELECT '{n}' AS material_group, count(*) AS parts FROM part WHERE p_partkey % 36 BETWEEN {a} AND {b}" for n, a, b in MATERIAL_RANGES))
def g_material_ranges(spark, sf):
    p = K.material_group(table(spark, sf, "part").withColumn("m", F.col("p_partkey") % 36), material_ranges(spark), "m")
    return p.where("material_group not in ('unassigned', 'out_of_range')").groupBy("material_group").agg(F.count("*").alias("parts"))
