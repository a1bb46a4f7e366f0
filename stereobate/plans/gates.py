"""Queries of package, scene and image rules, openings over levels, captures and the registry of checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from stereobate.operators import gates as G
from stereobate.plans.binding import FEW, Registry, corners, panel_faces, panels, table, with_

R = Registry()


def _union(facts: str, key: str, rules: list[tuple[str, str, str]]) -> str:
    """Findings of ``facts`` as SQL: rule, condition, observed."""
    return " UNION ALL ".join(f"SELECT {key} AS key, '{rule}' AS rule, CASE WHEN ({cond}) IS NULL THEN 'not_measured' WHEN {cond} THEN 'pass' ELSE 'fail' END AS status, {seen} AS observed FROM {facts}" for rule, cond, seen in rules)


@R.add("l3_low_detail_package", r"""
    WITH f AS (SELECT package, CASE page_id % 7 WHEN 0 THEN package || '_Ground.fbx' WHEN 1 THEN package || '.png' ELSE package || '_' || lpad((page_id % 25)::VARCHAR, 2, '0') || '.fbx' END AS name
               FROM (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS package FROM pages)),
    n AS (SELECT *, regexp_matches(lower(name), '\.fbx$') AS model, name = package || '_Ground.fbx' AS ground, coalesce(name = package || '_' || regexp_extract(name, '_([0-9]{2})\.fbx$', 1) || '.fbx'
                 AND TRY_CAST(regexp_extract(name, '_([0-9]{2})\.fbx$', 1) AS INT) BETWEEN 1 AND 20, false) AS part FROM f),
    facts AS (SELECT package, count(*) FILTER (NOT model) AS foreign_, count(*) FILTER (model) AS models, count(*) FILTER (ground) AS grounds, count(*) FILTER (model AND NOT ground AND NOT part) AS misnamed FROM n GROUP BY package)
    """ + _union("facts", "package", [("foreign", "foreign_ = 0", "foreign_::VARCHAR"), ("count", "models BETWEEN 2 AND 21", "models::VARCHAR"), ("archive", "regexp_matches(package, '^[A-Za-z0-9]+([-._][A-Za-z0-9]+)*$')", "NULL"), ("ground", "grounds > 0", "NULL"), ("names", "misnamed = 0", "misnamed::VARCHAR")]))  # fmt: skip
def l3_low_detail_package(spark, sf):
    p = table(spark, sf, "pages").select("page_id", F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("package"))
    k = F.col("page_id") % 7
    number = F.lpad((F.col("page_id") % 25).cast("string"), 2, "0")
    name = F.when(k == 0, F.concat("package", F.lit("_Ground.fbx"))).when(k == 1, F.concat("package", F.lit(".png"))).otherwise(F.concat("package", F.lit("_"), number, F.lit(".fbx")))
    return G.low_detail_package(p.select("package", name.alias("name")), 2, 21, 20)


@R.add("l5_pivot_rules", with_("panels") + """,
    m AS (SELECT part AS scene, face_id, kind = 7 AS main, kind = 35 AS helper, floor(x0) AS lx, floor(y0) AS ly, floor(z0) AS lz, x0, x1, y0, y1 FROM panels),
    o AS (SELECT * FROM m WHERE NOT helper), f AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY scene ORDER BY NOT main, face_id) = 1),
    facts AS (SELECT f.scene, any_value(greatest(abs(f.lx), abs(f.ly), abs(f.lz))) AS from_zero,
                     any_value(greatest(coalesce(abs((f.x0 + f.x1) / 2 - f.lx) / nullif(f.x1 - f.x0, 0), 0), coalesce(abs((f.y0 + f.y1) / 2 - f.ly) / nullif(f.y1 - f.y0, 0), 0))) AS off_,
                     count(*) FILTER (sqrt(pow(o.lx - f.lx, 2) + pow(o.ly - f.ly, 2) + pow(o.lz - f.lz, 2)) > 0.001) AS shifted FROM f JOIN o ON o.scene = f.scene GROUP BY f.scene)
    """ + _union("facts", "scene", [("at_zero", "from_zero <= 0.001", "NULL"), ("centre", "off_ <= 0.1", "NULL"), ("shared", "shifted = 0", "shifted::VARCHAR")]))  # fmt: skip
def l5_pivot_rules(spark, sf):
    at = [F.floor(f"{k}0").cast("double").alias(f"l{k}") for k in "xyz"]
    return G.pivot_rules(panels(spark, sf).select(F.col("part").alias("scene"), F.col("face_id").alias("mesh"), (F.col("kind") == 7).alias("main"), (F.col("kind") == 35).alias("helper"), *at, "x0", "x1", "y0", "y1"))


@R.add("l7_atlas_rules", """
    WITH i AS (SELECT p_partkey AS image, [128, 512, 1000, 1024, 2048][(p_partkey % 5 + 1)::INT] AS width, CASE WHEN p_partkey % 11 = 0 THEN 64 ELSE [128, 512, 1000, 1024, 2048][(p_partkey % 5 + 1)::INT] END AS height,
                      floor(p_retailprice)::BIGINT * 2000 AS bytes, p_partkey % 13 = 0 AS alpha, CASE WHEN p_partkey % 17 = 0 THEN 16 ELSE 8 END AS depth, p_size AS colours FROM part)
    """ + _union("i", "image", [("size", "CASE WHEN width = 128 AND height = 128 THEN colours = 1 AND NOT alpha ELSE width = height AND width IN (512, 1024, 2048) END", "NULL"), ("bytes", "bytes <= 3145728", "bytes::VARCHAR"), ("no_alpha", "NOT alpha", "NULL"), ("depth", "depth = 8", "depth::VARCHAR")]))  # fmt: skip
def l7_atlas_rules(spark, sf):
    k = F.col("p_partkey")
    side = F.element_at(F.array(*map(F.lit, (128, 512, 1000, 1024, 2048))), (k % 5 + 1).cast("int"))
    images = table(spark, sf, "part").select(k.alias("image"), side.alias("width"), F.when(k % 11 == 0, 64).otherwise(side).alias("height"), (F.floor("p_retailprice") * 2000).alias("bytes"), (k % 13 == 0).alias("alpha"), F.when(k % 17 == 0, 16).otherwise(8).alias("depth"), F.col("p_size").alias("colours"))
    return G.atlas_rules(images, [512, 1024, 2048], 3 << 20)


@R.add("c24_join_across_levels", with_("panels").replace("WITH ", "WITH RECURSIVE ", 1) + """,
    o AS (SELECT model_id, floor(y0)::BIGINT AS wall, floor(z0)::BIGINT AS level, face_id, x0, x1, z0, z1 FROM panels WHERE axis = 1),
    l AS (SELECT p.face_id AS a, q.face_id AS b FROM o p JOIN o q ON p.model_id = q.model_id AND p.wall = q.wall AND q.level = p.level + 1 AND abs(p.x0 - q.x0) <= 0.3 AND abs(p.x1 - q.x1) <= 0.3 AND q.z0 - p.z1 BETWEEN -1e-9 AND 0.15),
    d AS (SELECT a, b FROM l UNION SELECT b, a FROM l), reach AS (SELECT face_id, face_id AS r FROM o UNION SELECT reach.face_id, b FROM reach JOIN d ON a = r),
    n AS (SELECT face_id, min(r) AS first FROM reach GROUP BY face_id)
    SELECT model_id, first, count(*) AS parts, min(level) AS level, min(x0) AS x0, max(x1) AS x1, min(z0) AS z0, max(z1) AS z1 FROM o JOIN n USING (face_id) GROUP BY model_id, first""")  # fmt: skip
def c24_join_across_levels(spark, sf):
    o = panels(spark, sf).where("axis = 1").select("model_id", F.floor("y0").alias("wall"), F.floor("z0").alias("level"), "face_id", "x0", "x1", "z0", "z1")
    return G.join_across_levels(o, 0.3, 0.15)


@R.add("a4_captured_uv", """
    WITH r AS (SELECT l_orderkey AS capture, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS id, l_partkey, l_suppkey FROM lineitem),
    p AS (SELECT capture, CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE id END AS id, l_suppkey % 9 <> 0 AS finite FROM r)
    SELECT capture, count(*) AS rows, count(*) FILTER (id IS NULL) AS bad, count(DISTINCT id) AS ids, count(*) FILTER (finite) AS finite,
           CASE WHEN coalesce(count(*) FILTER (id IS NULL) = 0 AND count(DISTINCT id) = count(*) AND min(id) = 0 AND max(id) = count(*) - 1 AND count(*) FILTER (finite) = count(*), false) THEN 'pass' ELSE 'fail' END AS status
    FROM p GROUP BY capture""")  # fmt: skip
def a4_captured_uv(spark, sf):
    from pyspark.sql import Window

    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    number = F.when(F.col("l_partkey") % 50 == 0, "x").otherwise((F.row_number().over(order) - 1).cast("string"))
    u = F.when(F.col("l_suppkey") % 9 == 0, "NaN").otherwise((F.col("l_suppkey") * 0.25).cast("string"))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("capture"), F.concat_ws(",", number, u, (F.col("l_partkey") * 0.5).cast("string")).alias("line"))
    return G.captured_uv(lines)


@R.add("j1_check_registry", with_("corners", "panels") + """
    SELECT 'materials' AS name, CASE WHEN min(material) = 0 THEN 'fail' ELSE 'pass' END AS status, count(DISTINCT face_id) AS rows, NULL::VARCHAR AS reason FROM corners
    UNION ALL SELECT 'extents', CASE WHEN bool_or(x1 > 9 OR y1 > 9 OR z1 > 9) THEN 'fail' ELSE 'pass' END, count(*), NULL FROM panels
    UNION ALL SELECT 'breaks', 'not_measured', 0, 'AnalysisException' UNION ALL SELECT 'no_evidence', 'not_measured', 0, 'no renders'""")  # fmt: skip
def j1_check_registry(spark, sf):
    checks, verdict = G.Checks(), lambda bad: F.when(bad, "fail").otherwise("pass").alias("status")
    checks.register("materials", lambda c: c.groupBy(F.col("face_id").alias("key")).agg(verdict(F.min("material") == 0)), ["corners"])
    checks.register("extents", lambda p: p.select(F.col("face_id").alias("key"), verdict(F.greatest("x1", "y1", "z1") > 9)), ["panels"])
    checks.register("breaks", lambda p: p.select("no_such_column"), ["panels"])
    checks.register("no_evidence", lambda p: p, ["renders"])
    return checks.run({"corners": corners(spark, sf), "panels": panels(spark, sf)})


_TRIS = """half AS (SELECT model_id, face_id * 2 + k AS face_id, kind, CASE k WHEN 0 THEN [r[1], r[2], r[3]] ELSE [r[1], r[3], r[4]] END AS pts FROM (
        SELECT model_id, face_id, kind, CASE axis WHEN 0 THEN [[x0,y0,z0],[x0,y1,z0],[x0,y1,z1],[x0,y0,z1]] WHEN 1 THEN [[x0,y0,z0],[x1,y0,z0],[x1,y0,z1],[x0,y0,z1]] ELSE [[x0,y0,z0],[x1,y0,z0],[x1,y1,z0],[x0,y1,z0]] END AS r FROM panels), range(2) t(k)),
    moved AS (SELECT model_id, face_id, kind, list_transform([pts[(face_id % 3 + 1)::INT], pts[((face_id + 1) % 3 + 1)::INT], pts[((face_id + 2) % 3 + 1)::INT]], lambda p: [p[1] + face_id % 5 * 0.001, p[2], p[3]]) AS pts FROM half WHERE face_id % 31 <> 0)"""
_APART = "sqrt(pow(e.pts[{i}][1] - m.pts[{j}][1], 2) + pow(e.pts[{i}][2] - m.pts[{j}][2], 2) + pow(e.pts[{i}][3] - m.pts[{j}][3], 2))"
_SHIFTS = ", ".join("greatest(" + ", ".join(_APART.format(i=i + 1, j=(i + s) % 3 + 1) for i in range(3)) + ")" for s in range(3))


@R.add("c8_match_triangles", with_("panels") + f""", {_TRIS},
    met AS (SELECT e.model_id, e.face_id AS a, m.face_id AS b, least({_SHIFTS}) AS error FROM half e JOIN moved m ON e.model_id = m.model_id AND e.kind = m.kind AND abs(e.pts[1][3] + e.pts[2][3] + e.pts[3][3] - m.pts[1][3] - m.pts[2][3] - m.pts[3][3]) < 0.01),
    pairs AS (SELECT model_id, a, b, error FROM met WHERE error <= 0.0035 QUALIFY row_number() OVER (PARTITION BY model_id, a ORDER BY error, b) = 1 AND row_number() OVER (PARTITION BY model_id, b ORDER BY error, a) = 1),
    x AS (SELECT model_id, count(*) AS expected FROM half GROUP BY 1), y AS (SELECT model_id, count(*) AS actual FROM moved GROUP BY 1), z AS (SELECT model_id, count(*) AS matched, max(error) AS worst FROM pairs GROUP BY 1)
    SELECT model_id, expected, actual, matched, expected - matched AS missing, actual - matched AS extra, round(worst, 6) AS worst FROM x JOIN y USING (model_id) JOIN z USING (model_id)""", here=True)  # fmt: skip
def c8_match_triangles(spark, sf):
    f = panel_faces(spark, sf, FEW)
    halves = F.array(*[F.struct(F.lit(k).alias("k"), F.array(*[F.col("pts")[i] for i in ring]).alias("pts")) for k, ring in enumerate(((0, 1, 2), (0, 2, 3)))])
    half = f.select("model_id", "face_id", "kind", F.explode(halves).alias("h")).select("model_id", (F.col("face_id") * 2 + F.col("h.k")).alias("face_id"), "kind", F.col("h.pts").alias("pts"))
    at = lambda i: F.get("pts", ((F.col("face_id") + i) % 3).cast("int"))
    turned = F.array(*[F.struct((at(i)["x"] + F.col("face_id") % 5 * 0.001).alias("x"), at(i)["y"].alias("y"), at(i)["z"].alias("z")) for i in range(3)])
    moved = half.where("face_id % 31 <> 0").select("model_id", "face_id", "kind", turned.alias("pts"))
    report = G.triangle_report(half, moved, G.match_triangles(half, moved, 0.0035))
    return report.withColumn("worst", F.round("worst", 6))
