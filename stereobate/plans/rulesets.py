"""Queries of row expressions and rule sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from stereobate.operators import rules as U, tables as K, topology as T
from stereobate.plans.binding import Registry, boxes, corners, intervals, points, table, vertices, with_

R = Registry()


def _frames(spark):
    c = lambda k: F.col("id") % k
    d = lambda v: F.lit(float(v))
    sign = F.when(c(2) == 1, -1.0).otherwise(1.0)
    return spark.range(20).select(F.col("id").alias("model_id"), sign.alias("m00"), d(0).alias("m01"), d(0).alias("m02"), F.col("id").cast("double").alias("m03"), d(0).alias("m10"), d(0.6).alias("m11"), d(-0.8).alias("m12"), d(1).alias("m13"), d(0).alias("m20"), d(0.8).alias("m21"), d(0.6).alias("m22"), d(-2).alias("m23"))


@R.add("b1_transform", with_("points") + """
    SELECT face_id, corner, round(CASE WHEN model_id % 2 = 1 THEN -x ELSE x END + model_id, 6) AS x, round(0.6::DOUBLE*y - 0.8::DOUBLE*z + 1, 6) AS y, round(0.8::DOUBLE*y + 0.6::DOUBLE*z - 2, 6) AS z FROM points""")  # fmt: skip
def b1_transform(spark, sf):
    t = U.transform(points(spark, sf).select("model_id", "face_id", "corner", "x", "y", "z"), _frames(spark), "model_id")
    return t.select("face_id", "corner", *[F.round(c, 6).alias(c) for c in "xyz"])


@R.add("b2_fix_winding", with_("tris") + " SELECT face_id, tri, CASE WHEN model_id % 2 = 1 THEN c ELSE a END AS a, b, CASE WHEN model_id % 2 = 1 THEN a ELSE c END AS c FROM tris")
def b2_fix_winding(spark, sf):
    return U.fix_winding(T.triangulate(corners(spark, sf)), _frames(spark), "model_id").select("face_id", "tri", "a", "b", "c")


@R.add("b10_wall_frame", with_("points") + """
    SELECT face_id, corner, round(((x-0.5)*3 + (y-0.25)*4)/5, 6) AS s, round(((x-0.5)*4 - (y-0.25)*3)/5, 6) AS t FROM points""")  # fmt: skip
def b10_wall_frame(spark, sf):
    p = points(spark, sf).withColumns({"px": F.lit(0.5), "py": F.lit(0.25), "qx": F.lit(3.5), "qy": F.lit(4.25)})
    return U.wall_frame(p).select("face_id", "corner", F.round("s", 6).alias("s"), F.round("t", 6).alias("t"))


_HELPERS = "h AS (SELECT n_regionkey AS model_id, CASE WHEN n_nationkey % 6 = 0 THEN 'LEVEL 1' WHEN n_nationkey % 6 = 1 THEN 'L.001' WHEN n_nationkey % 6 = 2 THEN 'L2' ELSE n_name END AS name, floor(n_nationkey / 2) * 3.0::DOUBLE AS elev FROM nation)"


@R.add("b11_level_table", f"""WITH {_HELPERS}, g AS (SELECT *, lag(elev) OVER (PARTITION BY model_id ORDER BY elev, name) AS before, count(*) OVER (PARTITION BY model_id, name) AS same FROM h)
    SELECT model_id, name, 'bad_name' AS rule FROM g WHERE NOT regexp_matches(name, '^[A-Za-z0-9_]+$') UNION ALL SELECT model_id, name, 'copy_suffix' FROM g WHERE regexp_matches(name, '\\.\\d{{3}}$')
    UNION ALL SELECT model_id, name, 'double_name' FROM g WHERE same > 1 UNION ALL SELECT model_id, name, 'too_close' FROM g WHERE elev - before < 0.001
    UNION ALL SELECT model_id, NULL, 'too_few' FROM h GROUP BY model_id HAVING count(*) < 2""")  # fmt: skip
def b11_level_table(spark, sf):
    k = F.col("n_nationkey") % 6
    h = table(spark, sf, "nation").select(F.col("n_regionkey").alias("model_id"), F.when(k == 0, "LEVEL 1").when(k == 1, "L.001").when(k == 2, "L2").otherwise(F.col("n_name")).alias("name"), (F.floor(F.col("n_nationkey") / 2) * 3.0).alias("elev"))
    return U.level_findings(h)


@R.add("b12_bim_levels", """
    SELECT n_nationkey AS id, CASE WHEN r_name IS NULL THEN 'question' ELSE r_name END AS level, CASE WHEN r_name IS NOT NULL THEN n_nationkey * 3.0::DOUBLE + 0.25 END AS elev FROM nation LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 3) ON n_regionkey = r_regionkey""")  # fmt: skip
def b12_bim_levels(spark, sf):
    known = table(spark, sf, "region").where("r_regionkey < 3")
    out = table(spark, sf, "nation").join(F.broadcast(known), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return out.select(F.col("n_nationkey").alias("id"), F.coalesce("r_name", F.lit("question")).alias("level"), F.when(F.col("r_name").isNotNull(), F.col("n_nationkey") * 3.0 + 0.25).alias("elev"))


_UV = """uv AS (SELECT face_id, corner, x / 8 + 0.01 AS u, y / 4 + 0.02 AS v FROM points),
    s AS (SELECT *, coalesce(lead(u) OVER w, first_value(u) OVER w) AS u2, coalesce(lead(v) OVER w, first_value(v) OVER w) AS v2 FROM uv WINDOW w AS (PARTITION BY face_id ORDER BY corner)),
    f AS (SELECT face_id, count(*) AS n, sum(u*v2-u2*v)/2 AS uv_area, min(u) AS u0, max(u) AS u1, min(v) AS v0, max(v) AS v1,
                 bool_or(u-floor(u) < 0.02 OR ceil(u)-u < 0.02 OR v-floor(v) < 0.02 OR ceil(v)-v < 0.02) AS near FROM s GROUP BY face_id)"""


def _uv_faces(spark, sf):
    p = points(spark, sf).select("face_id", F.struct("corner", (F.col("x") / 8 + 0.01).alias("u"), (F.col("y") / 4 + 0.02).alias("v")).alias("p"))
    return p.groupBy("face_id").agg(F.transform(F.array_sort(F.collect_list("p")), lambda s: F.struct(s["u"].alias("u"), s["v"].alias("v"))).alias("uv"))


@R.add("b14_uv_issue", with_("points") + f""", {_UV} SELECT face_id, CASE WHEN n < 3 OR abs(round(uv_area, 9)) < 1e-9 THEN 'invalid' WHEN uv_area < 0 THEN 'mirrored'
    WHEN floor(u0) <> floor(u1) OR floor(v0) <> floor(v1) THEN 'cross_tile' WHEN near THEN 'margin' END AS issue FROM f""")  # fmt: skip
def b14_uv_issue(spark, sf):
    return U.uv_issue(_uv_faces(spark, sf), 0.02).select("face_id", "issue")


@R.add("b15_texel_density", with_("points") + f""", {_UV}, b AS (SELECT face_id, (max(x)-min(x))*(max(y)-min(y)) AS area FROM points GROUP BY face_id)
    SELECT face_id, round(CASE WHEN area > 0 AND abs(round(uv_area, 9)) > 0 THEN 1024 * sqrt(abs(uv_area) / area) END, 3) AS density FROM f JOIN b USING (face_id)""")  # fmt: skip
def b15_texel_density(spark, sf):
    b = boxes(spark, sf).select("face_id", ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("area"))
    faces = U.uv_issue(_uv_faces(spark, sf), 0.02).join(b, "face_id").withColumn("uv_area", F.when(F.abs(F.round("uv_area", 9)) > 0, F.col("uv_area")).otherwise(0.0))
    return U.texel_density(faces, 1024).select("face_id", F.round("density", 3).alias("density"))


@R.add("b16_facade_rect", with_("boxes") + """,
    m AS (SELECT *, (min(x0) OVER w + max(x1) OVER w)/2 AS mx, (min(y0) OVER w + max(y1) OVER w)/2 AS my FROM boxes WINDOW w AS (PARTITION BY model_id))
    SELECT face_id, CASE WHEN x1-x0 < y1-y0 THEN CASE WHEN (x0+x1)/2 < mx THEN 'W' ELSE 'E' END WHEN (y0+y1)/2 < my THEN 'S' ELSE 'N' END AS side,
           CASE WHEN x1-x0 < y1-y0 THEN y0 ELSE x0 END AS u0, CASE WHEN x1-x0 < y1-y0 THEN y1 ELSE x1 END AS u1, z0, z1 FROM m""")  # fmt: skip
def b16_facade_rect(spark, sf):
    return U.facade_side(boxes(spark, sf)).drop("model_id")


_URL = r"^http://[a-z]+\.example\.com/[a-z]{2}/[0-9]+"


@R.add("b17_name_findings", rf"SELECT page_id AS key, 'address' AS rule, CASE WHEN regexp_matches(url, '{_URL}') THEN 'pass' ELSE 'fail' END AS status, url AS observed FROM pages UNION ALL SELECT page_id, 'query', CASE WHEN NOT contains(url, '?') THEN 'pass' ELSE 'fail' END, NULL FROM pages")
def b17_name_findings(spark, sf):
    url = F.col("url")
    return U.findings(table(spark, sf, "pages"), "page_id", {"address": url.rlike(_URL), "query": ~url.contains("?")}, {"address": url})


@R.add("b18_classify_paths", r"""
    WITH p AS (SELECT page_id, string_split_regex(lower(url), '[/?&=]') AS parts FROM pages)
    SELECT page_id, CASE WHEN list_has_any(parts, ['secret', 'token', 'password', 'private']) THEN 'sensitive' WHEN list_has_any(parts, ['tmp', 'cache', 'draft']) THEN 'local'
                         WHEN list_has_any(parts, ['en', 'fr', 'de', 'es']) THEN 'promote' ELSE 'review' END AS place FROM p""")  # fmt: skip
def b18_classify_paths(spark, sf):
    return U.classify_paths(table(spark, sf, "pages"), "url").select("page_id", "place")


@R.add("b22_opening_kind", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_discount > 0 AND 3 - l_quantity / 20 <= 0.1 + 1e-9 THEN 'window' WHEN l_tax <= 0.1 + 1e-9 AND l_quantity / 20 BETWEEN 0.7 AND 2.5 THEN 'door' ELSE 'opening' END AS kind FROM lineitem""")  # fmt: skip
def b22_opening_kind(spark, sf):
    o = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.when(F.col("l_discount") > 0, F.col("l_quantity") / 20).alias("glass_h"), F.lit(3.0).alias("h"), F.col("l_tax").alias("sill"), (F.col("l_quantity") / 20).alias("w"))
    return U.opening_kind(o).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "kind")


@R.add("b23_decor_kind", "SELECT p_partkey, CASE WHEN p_size / (p_partkey % 17 + 1)::DOUBLE >= 3 THEN 'band' WHEN p_size / (p_partkey % 17 + 1)::DOUBLE <= 1/3::DOUBLE THEN 'strip' ELSE 'panel' END AS kind, round((p_partkey % 20) / 100::DOUBLE, 3) <= 0.10 AS texture FROM part")
def b23_decor_kind(spark, sf):
    d = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("w"), (F.col("p_partkey") % 17 + 1).cast("double").alias("h"), (F.col("p_partkey") % 20 / 100).alias("projection"))
    return U.decor_kind(d).select("p_partkey", "kind", "texture")


@R.add("l2_package_rules", r"""
    WITH f AS (SELECT regexp_extract(url, '^http://([^/]+)/', 1) AS package, count(*) AS members, sum(length(html)) AS bytes, max(length(html)) AS largest, count(*) - count(DISTINCT url) AS double_paths, count(DISTINCT regexp_extract(url, '^https?://[^/]+/([^/]+)/', 1)) AS kinds FROM pages GROUP BY 1)
    SELECT package AS key, rule, status, observed FROM (
      SELECT package, 'members' AS rule, CASE WHEN members BETWEEN 1 AND 30 THEN 'pass' ELSE 'fail' END AS status, members::VARCHAR AS observed FROM f
      UNION ALL SELECT package, 'size', CASE WHEN bytes <= 200000 THEN 'pass' ELSE 'fail' END, bytes::VARCHAR FROM f
      UNION ALL SELECT package, 'flat', CASE WHEN kinds = 1 THEN 'pass' ELSE 'fail' END, NULL FROM f
      UNION ALL SELECT package, 'unique', CASE WHEN double_paths = 0 THEN 'pass' ELSE 'fail' END, NULL FROM f)""")  # fmt: skip
def l2_package_rules(spark, sf):
    p = table(spark, sf, "pages").withColumn("package", F.regexp_extract("url", r"^http://([^/]+)/", 1))
    facts = U.package_facts(p, "package", "url", F.length("html"))
    c = F.col
    return U.findings(facts, "package", {"members": c("members").between(1, 30), "size": c("bytes") <= 200000, "flat": c("kinds") == 1, "unique": c("double_paths") == 0}, {"members": c("members"), "size": c("bytes")})


@R.add("l4_scene_rules", with_("corners") + """,
    f AS (SELECT model_id || '/' || mesh AS key, count(DISTINCT face_id) AS faces, count(*) AS n, min(material) AS lo FROM corners GROUP BY model_id, mesh)
    SELECT key, 'triangulated' AS rule, CASE WHEN n = 3 * faces THEN 'pass' ELSE 'fail' END AS status, NULL AS observed FROM f UNION ALL SELECT key, 'count', CASE WHEN faces <= 60 THEN 'pass' ELSE 'fail' END, faces::VARCHAR FROM f
    UNION ALL SELECT key, 'assigned', CASE WHEN lo > 0 THEN 'pass' ELSE 'fail' END, NULL FROM f""")  # fmt: skip
def l4_scene_rules(spark, sf):
    f = corners(spark, sf).groupBy(F.concat_ws("/", "model_id", "mesh").alias("key")).agg(F.countDistinct("face_id").alias("faces"), F.count("*").alias("n"), F.min("material").alias("lo"))
    return U.findings(f, "key", {"triangulated": F.col("n") == 3 * F.col("faces"), "count": F.col("faces") <= 60, "assigned": F.col("lo") > 0}, {"count": F.col("faces")})


@R.add("l6_map_sets", """
    SELECT l_orderkey AS slot, l_linenumber AS tile, array_to_string(list_sort(list_filter(['A', 'N', 'R'], lambda k: NOT list_contains(list(l_returnflag), k))), ',') AS missing, count(DISTINCT l_returnflag) FILTER (l_returnflag IN ('A', 'N', 'R')) = 3 AS whole FROM lineitem GROUP BY ALL""")  # fmt: skip
def l6_map_sets(spark, sf):
    images = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("slot"), F.col("l_linenumber").alias("tile"), "l_returnflag")
    return U.map_sets(images, ["slot", "tile"], "l_returnflag", ["A", "N", "R"])


@R.add("l8_geojson_rules", """
    SELECT event_id AS key, 'parsed' AS rule, CASE WHEN json_valid(props) THEN 'pass' ELSE 'fail' END AS status, NULL AS observed FROM events
    UNION ALL SELECT event_id, 'range', CASE WHEN (props->>'k')::INT IS NULL THEN 'not_measured' WHEN (props->>'k')::INT BETWEEN 0 AND 89 THEN 'pass' ELSE 'fail' END, props->>'k' FROM events""")  # fmt: skip
def l8_geojson_rules(spark, sf):
    e = table(spark, sf, "events").withColumn("k", F.from_json("props", "k int")["k"])
    return U.findings(e, "event_id", {"parsed": F.try_parse_json("props").isNotNull(), "range": F.col("k").between(0, 89)}, {"range": F.col("k")})


@R.add("l10_spec_rules", with_("intervals") + """,
    s AS (SELECT *, lag(lo) OVER (PARTITION BY face_id ORDER BY seq) AS before FROM intervals)
    SELECT face_id, count(*) AS levels, count(*) FILTER (lo = before) AS repeated, CASE WHEN count(*) FILTER (lo = before) > 0 THEN 'stop' ELSE 'pass' END AS status FROM s GROUP BY face_id""")  # fmt: skip
def l10_spec_rules(spark, sf):
    from pyspark.sql import Window

    s = intervals(spark, sf).withColumn("before", F.lag("lo").over(Window.partitionBy("face_id").orderBy("seq")))
    n = F.sum(F.when(F.col("lo") == F.col("before"), 1).otherwise(0)).cast("long")
    return s.groupBy("face_id").agg(F.count("*").alias("levels"), n.alias("repeated")).withColumn("status", F.when(F.col("repeated") > 0, "stop").otherwise("pass"))


@R.add("l11_source_rules", """
    SELECT c_custkey AS key, 'format' AS rule, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN 'pass' ELSE 'fail' END AS status, c_mktsegment AS observed FROM customer
    UNION ALL SELECT c_custkey, 'opened', CASE WHEN c_acctbal > 0 THEN 'pass' ELSE 'fail' END, NULL FROM customer""")  # fmt: skip
def l11_source_rules(spark, sf):
    c = table(spark, sf, "customer")
    return U.findings(c, "c_custkey", {"format": F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD"), "opened": F.col("c_acctbal") > 0}, {"format": F.col("c_mktsegment")})


@R.add("l13_status_gate", """
    SELECT o_orderkey AS job, CASE WHEN o_orderstatus = 'O' THEN 'draft' WHEN n IS NULL THEN 'no_checks' WHEN fails > 0 THEN 'failed' ELSE 'ready' END AS gate
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS fails FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")  # fmt: skip
def l13_status_gate(spark, sf):
    checks = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("fails"))
    jobs = table(spark, sf, "orders").join(checks, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return jobs.select(F.col("o_orderkey").alias("job"), F.when(F.col("o_orderstatus") == "O", "draft").when(F.col("n").isNull(), "no_checks").when(F.col("fails") > 0, "failed").otherwise("ready").alias("gate"))


@R.add("l14_contract_rules", """
    SELECT p_partkey AS key, 'size' AS rule, CASE WHEN p_size BETWEEN 1 AND 40 THEN 'pass' ELSE 'fail' END AS status, p_size::VARCHAR AS observed FROM part
    UNION ALL SELECT p_partkey, 'name', CASE WHEN regexp_matches(p_name, '^[a-z]+ [a-z]+$') THEN 'pass' ELSE 'fail' END, NULL FROM part""")  # fmt: skip
def l14_contract_rules(spark, sf):
    return U.findings(table(spark, sf, "part"), "p_partkey", {"size": F.col("p_size").between(1, 40), "name": F.col("p_name").rlike("^[a-z]+ [a-z]+$")}, {"size": F.col("p_size")})


@R.add("l15_tile_rules", "SELECT l_suppkey AS tile, count(*) AS uses FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def l15_tile_rules(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("tile")).agg(F.count("*").alias("uses")).where("uses > 1")


@R.add("l16_atlas_coverage", """
    SELECT DISTINCT p_brand AS region, 'no_region' AS problem FROM part WHERE p_size > 20 AND p_brand NOT IN (SELECT p_brand FROM part WHERE p_type = 'ECONOMY' AND p_size <= 3)
    UNION ALL SELECT DISTINCT p_brand, 'unused' FROM part WHERE p_type = 'ECONOMY' AND p_size <= 3 AND p_brand NOT IN (SELECT p_brand FROM part WHERE p_size > 20)""")  # fmt: skip
def l16_atlas_coverage(spark, sf):
    p = table(spark, sf, "part").withColumnRenamed("p_brand", "region")
    found = K.referential(p.where("p_size > 20").select("region"), p.where("p_type = 'ECONOMY' and p_size <= 3").select("region").distinct(), ["region"])
    return found.select("region", F.when(F.col("problem") == "orphan", "no_region").otherwise(F.col("problem")).alias("problem"))


@R.add("n8_best_phase", with_("intervals") + """,
    t AS (SELECT face_id % 32 AS material, phase, fmod(lo + phase * 0.21875, 7) AS a, fmod(hi + phase * 0.21875, 7) AS b FROM intervals, (SELECT unnest(range(32)) AS phase)),
    m AS (SELECT material, phase, round(min(least(a, 7 - a, b, 7 - b)), 9) AS margin FROM t GROUP BY ALL)
    SELECT material, phase, margin FROM m QUALIFY row_number() OVER (PARTITION BY material ORDER BY margin DESC, phase) = 1""")  # fmt: skip
def n8_best_phase(spark, sf):
    return U.best_phase(intervals(spark, sf).withColumn("material", F.col("face_id") % 32), "material", "lo", "hi", 7.0, 32)


@R.add("n9_map_uv", with_("vertices") + " SELECT vid, round(fmod(x * 0.7::DOUBLE, 1), 9) AS u, round(fmod(y * 0.7::DOUBLE, 1), 9) AS v FROM vertices")
def n9_map_uv(spark, sf):
    return U.map_uv(vertices(spark, sf), 0.7, 1.0).select("vid", F.round("u", 9).alias("u"), F.round("v", 9).alias("v"))


@R.add("n2_subdivide", with_("edges", "vertices") + """
    SELECT e.face_id, CAST(sum(greatest(ceil(round(sqrt(pow(p.x-q.x,2)+pow(p.y-q.y,2)+pow(p.z-q.z,2)) / 1.5, 9)), 1)) AS BIGINT) AS cuts FROM edges e JOIN vertices p ON e.a = p.vid JOIN vertices q ON e.b = q.vid GROUP BY e.face_id""")  # fmt: skip
def n2_subdivide(spark, sf):
    s = T.edges(corners(spark, sf))
    for end in "ab":
        s = s.join(vertices(spark, sf).select(F.col("vid").alias(end), *[F.col(c).alias(f"{end}{c}") for c in "xyz"]), end)
    d = [F.col(f"a{c}") - F.col(f"b{c}") for c in "xyz"]
    s = s.withColumn("length", F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]))
    return U.subdivide_counts(s, 1.5).groupBy("face_id").agg(F.sum("cuts").alias("cuts"))


@R.add("n3_rims", with_("edges") + " SELECT model_id, count(*) AS rim_faces FROM (SELECT model_id, least(a, b), greatest(a, b) FROM edges GROUP BY 1, 2, 3 HAVING count(*) = 1) GROUP BY model_id")
def n3_rims(spark, sf):
    return T.edge_uses(T.edges(corners(spark, sf))).where("uses = 1").groupBy("model_id").agg(F.count("*").alias("rim_faces"))


@R.add("n5_pair_gaps", with_("intervals") + """,
    d AS (SELECT face_id, lo, lead(lo) OVER w AS n, lag(lo) OVER w AS p FROM (SELECT DISTINCT face_id, lo FROM intervals) WINDOW w AS (PARTITION BY face_id ORDER BY lo)),
    e AS (SELECT *, n IS NOT NULL AND n - lo <= 8 AND (p IS NULL OR n - lo < lo - p) AS to_next, p IS NOT NULL AND lo - p <= 8 AND (n IS NULL OR lo - p <= n - lo) AS to_prev FROM d)
    SELECT face_id, lo, n AS hi FROM e QUALIFY to_next AND lead(to_prev) OVER (PARTITION BY face_id ORDER BY lo)""")  # fmt: skip
def n5_pair_gaps(spark, sf):
    return U.mutual_nearest(intervals(spark, sf), "face_id", "lo", 8.0)


@R.add("k3_complexity", with_("corners") + """,
    g AS (SELECT model_id, mesh, list(vid % 10 ORDER BY face_id, corner) AS l FROM corners GROUP BY model_id, mesh, face_id)
    SELECT model_id, count(*) AS instances, count(DISTINCT l) AS types, count(*) - count(DISTINCT l) AS shared FROM g GROUP BY model_id""")  # fmt: skip
def k3_complexity(spark, sf):
    loop = F.transform(F.array_sort(F.collect_list(F.struct("corner", (F.col("vid") % 10).alias("v")))), lambda s: s["v"])
    g = corners(spark, sf).groupBy("model_id", "mesh", "face_id").agg(loop.alias("l"))
    return g.groupBy("model_id").agg(F.count("*").alias("instances"), F.countDistinct("l").alias("types")).withColumn("shared", F.col("instances") - F.col("types"))


@R.add("k7_reimport_gate", """
    WITH a AS (SELECT p_size, p_type, p_brand FROM part), b AS (SELECT p_size + (p_partkey % 50 = 0)::INT AS p_size, p_type, p_brand FROM part)
    SELECT 'missing' AS side, count(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'extra', count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")  # fmt: skip
def k7_reimport_gate(spark, sf):
    p = table(spark, sf, "part")
    a = p.select("p_size", "p_type", "p_brand")
    b = p.select((F.col("p_size") + (F.col("p_partkey") % 50 == 0).cast("int")).alias("p_size"), "p_type", "p_brand")
    return a.exceptAll(b).agg(F.count("*").alias("n")).select(F.lit("missing").alias("side"), "n").unionByName(b.exceptAll(a).agg(F.count("*").alias("n")).select(F.lit("extra").alias("side"), "n"))
