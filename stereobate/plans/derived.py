"""Queries of composite gates, derivations and matching."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from stereobate.operators import matching as M, ordered as O, spatial as S, tables as K, topology as T
from stereobate.operators.topology import dealt
from stereobate.plans.binding import Registry, boxes, corners, findings, intervals, panels, points, table, vertices, with_

R = Registry()


def _openings(spark, sf, low, high):
    i = intervals(spark, sf).where((F.col("seq") >= low) & (F.col("seq") <= high))
    return i.select("face_id", F.col("seq").alias("id"), "lo", "hi")


@R.add("c7_match_max")
def c7_match_max(spark, sf):
    pairs = M.candidates(_openings(spark, sf, 1, 4), _openings(spark, sf, 3, 7), ["face_id"], {"lo": 6.0, "hi": 8.0})
    return M.match_most(pairs, ["face_id"])


def _greedy_sql(pairs: str) -> str:
    """Pairs of ``pairs(face_id, a_id, b_id, distance)`` one after another: a pair is kept if it meets no kept one."""
    return f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY face_id ORDER BY distance, a_id, b_id) AS n FROM {pairs}),
    greedy AS (
        SELECT face_id, 1 AS n, [a_id] AS ua, [b_id] AS ub FROM ranked WHERE n = 1
        UNION ALL
        SELECT g.face_id, r.n, CASE WHEN list_contains(ua, r.a_id) OR list_contains(ub, r.b_id) THEN ua ELSE list_append(ua, r.a_id) END,
               CASE WHEN list_contains(ua, r.a_id) OR list_contains(ub, r.b_id) THEN ub ELSE list_append(ub, r.b_id) END
        FROM greedy g JOIN ranked r ON r.face_id = g.face_id AND r.n = g.n + 1),
    kept AS (SELECT face_id, unnest(ua) AS a_id, unnest(ub) AS b_id FROM greedy QUALIFY n = max(n) OVER (PARTITION BY face_id))"""


_OPENING_PAIRS = """p AS (SELECT a.face_id, a.seq AS a_id, b.seq AS b_id, abs(a.lo - b.lo) + abs(a.hi - b.hi) AS distance FROM intervals a JOIN intervals b USING (face_id)
    WHERE a.seq BETWEEN 1 AND 4 AND b.seq BETWEEN 3 AND 7 AND abs(a.lo - b.lo) <= 6 AND abs(a.hi - b.hi) <= 8)"""


@R.add("c9_match_greedy", with_("intervals").replace("WITH ", "WITH RECURSIVE ", 1) + f", {_OPENING_PAIRS}, {_greedy_sql('p')} SELECT face_id, a_id, b_id FROM kept")
def c9_match_greedy(spark, sf):
    pairs = M.candidates(_openings(spark, sf, 1, 4), _openings(spark, sf, 3, 7), ["face_id"], {"lo": 6.0, "hi": 8.0})
    return M.match_greedy(pairs, ["face_id"])


@R.add("c7_candidates", with_("intervals") + """
    SELECT a.face_id, a.seq AS a_id, b.seq AS b_id, abs(a.lo - b.lo) + abs(a.hi - b.hi) AS distance FROM intervals a JOIN intervals b USING (face_id)
    WHERE a.seq BETWEEN 1 AND 4 AND b.seq BETWEEN 3 AND 7 AND abs(a.lo - b.lo) <= 6 AND abs(a.hi - b.hi) <= 8""")  # fmt: skip
def c7_candidates(spark, sf):
    return M.candidates(_openings(spark, sf, 1, 4), _openings(spark, sf, 3, 7), ["face_id"], {"lo": 6.0, "hi": 8.0})


@R.add("m2_merge_questions", with_("intervals").replace("WITH ", "WITH RECURSIVE ", 1) + f""",
    o AS (SELECT face_id, face_id * 100 + seq AS id, lo, hi, 'a' || (face_id * 100 + seq) AS answer FROM intervals WHERE seq BETWEEN 1 AND 3),
    nw AS (SELECT face_id, face_id * 100 + seq AS id, lo, hi FROM intervals WHERE seq BETWEEN 3 AND 5),
    p AS (SELECT o.face_id, o.id AS a_id, nw.id AS b_id, abs(o.lo - nw.lo) + abs(o.hi - nw.hi) AS distance FROM o JOIN nw USING (face_id) WHERE abs(o.lo - nw.lo) <= 5 AND abs(o.hi - nw.hi) <= 9),
    {_greedy_sql('p')}
    SELECT CASE WHEN k.a_id IS NULL THEN 'v2-' || nw.id ELSE k.a_id::VARCHAR END AS id, o.answer, CASE WHEN k.a_id IS NULL THEN 'new' ELSE 'kept' END AS state
    FROM nw LEFT JOIN kept k ON k.b_id = nw.id LEFT JOIN o ON o.id = k.a_id
    UNION ALL SELECT o.id::VARCHAR, o.answer, 'gone v2' FROM o WHERE o.id NOT IN (SELECT a_id FROM kept)""")  # fmt: skip
def m2_merge_questions(spark, sf):
    q = lambda lo, hi: _openings(spark, sf, lo, hi).withColumn("id", F.col("face_id") * 100 + F.col("id")).withColumn("answer", F.concat(F.lit("a"), F.col("id")))
    return M.merge_questions(q(1, 3), q(3, 5), ["face_id"], {"lo": 5.0, "hi": 9.0}, "v2")


_LINE_PAIRS = with_("intervals") + ", s AS (SELECT * FROM intervals)"


@R.add("c13_provenance", _LINE_PAIRS + """
    SELECT n.face_id, n.seq, list_sort(list(DISTINCT o.seq)) AS sources, sum(least(n.hi, o.hi) - greatest(n.lo, o.lo)) AS covered FROM s n JOIN s o ON n.face_id = o.face_id AND n.seq % 2 = 0 AND o.seq % 2 = 1
    WHERE least(n.hi, o.hi) > greatest(n.lo, o.lo) GROUP BY ALL""")  # fmt: skip
def c13_provenance(spark, sf):
    s = intervals(spark, sf)
    new = s.where("seq % 2 = 0")
    old = s.where("seq % 2 = 1").select("face_id", F.col("seq").alias("source"), F.col("lo").alias("olo"), F.col("hi").alias("ohi"))
    met = new.join(old, "face_id").withColumn("shared", F.least("hi", "ohi") - F.greatest("lo", "olo")).where("shared > 0")
    return met.groupBy("face_id", "seq").agg(F.sort_array(F.collect_set("source")).alias("sources"), F.sum("shared").alias("covered"))


_KEYS = """, l AS (SELECT model_id, face_id, list(vid % 6 ORDER BY corner) AS p FROM corners GROUP BY ALL)"""


def _keys(spark, sf):
    rows = F.array_sort(F.collect_list(F.struct("corner", (F.col("vid") % 6).alias("v"))))
    return corners(spark, sf).groupBy("model_id", "face_id").agg(F.transform(rows, lambda r: r["v"]).alias("p"))


@R.add("c23_same_geometry", with_("corners") + _KEYS + """
    SELECT a.face_id AS left_face, count(*) AS twins, min(b.face_id) AS first_twin FROM l a JOIN l b ON a.p = b.p AND a.model_id % 2 = 0 AND b.model_id = a.model_id + 1 GROUP BY 1""")  # fmt: skip
def c23_same_geometry(spark, sf):
    k = _keys(spark, sf)
    left = k.where("model_id % 2 = 0").select(F.col("face_id").alias("left_face"), (F.col("model_id") + 1).alias("model_id"), "p")
    return left.join(k, ["model_id", "p"]).groupBy("left_face").agg(F.count("*").alias("twins"), F.min("face_id").alias("first_twin"))


@R.add("d19_type_census", with_("corners") + _KEYS + """
    SELECT model_id, count(*) AS objects, count(DISTINCT p) AS types, max(n) AS most_used FROM (SELECT model_id, p, count(*) OVER (PARTITION BY model_id, p) AS n FROM l) GROUP BY model_id""")  # fmt: skip
def d19_type_census(spark, sf):
    k = _keys(spark, sf).groupBy("model_id", "p").agg(F.count("*").alias("n"))
    return k.groupBy("model_id").agg(F.sum("n").alias("objects"), F.count("*").alias("types"), F.max("n").alias("most_used"))


@R.add("d20_assembly_types", with_("points") + """,
    r AS (SELECT model_id, face_id, q, CAST(CASE q WHEN 0 THEN dx WHEN 1 THEN -dy WHEN 2 THEN -dx ELSE dy END AS BIGINT) AS u, CAST(CASE q WHEN 0 THEN dy WHEN 1 THEN dx WHEN 2 THEN -dy ELSE -dx END AS BIGINT) AS v
          FROM (SELECT model_id, face_id, round_even((x - first_value(x) OVER w) * 4, 0) AS dx, round_even((y - first_value(y) OVER w) * 4, 0) AS dy FROM points WINDOW w AS (PARTITION BY face_id ORDER BY corner)), (SELECT unnest(range(4)) AS q)),
    s AS (SELECT model_id, face_id, q, string_agg(printf('%d,%d', u, v), ';' ORDER BY printf('%d,%d', u, v)) AS sig FROM r GROUP BY ALL),
    t AS (SELECT model_id, face_id, min(sig) AS sig FROM s GROUP BY ALL)
    SELECT sig AS signature, count(*) AS placements, count(DISTINCT model_id) AS models FROM t GROUP BY sig""")  # fmt: skip
def d20_assembly_types(spark, sf):
    w = Window.partitionBy("face_id").orderBy("corner")
    local = points(spark, sf).select("model_id", "face_id", *[F.bround((F.col(c) - F.first(c).over(w)) * 4).cast("long").alias(f"d{c}") for c in "xy"])
    x, y = F.col("dx"), F.col("dy")
    turns = F.array(*[F.struct(F.lit(q).alias("q"), u.alias("u"), v.alias("v")) for q, (u, v) in enumerate([(x, y), (-y, x), (-x, -y), (y, -x)])])
    placed = local.select("model_id", "face_id", F.explode(turns).alias("t")).select("model_id", "face_id", "t.q", F.format_string("%d,%d", "t.u", "t.v").alias("s"))
    sig = placed.groupBy("model_id", "face_id", "q").agg(F.array_join(F.sort_array(F.collect_list("s")), ";").alias("sig"))
    least = sig.groupBy("model_id", "face_id").agg(F.min("sig").alias("signature"))
    return least.groupBy("signature").agg(F.count("*").alias("placements"), F.countDistinct("model_id").alias("models"))


@R.add("c26_wall_end_extension", with_("intervals") + """,
    w AS (SELECT face_id, seq, lo, hi, seq % 3 + 1 AS thickness FROM intervals)
    SELECT a.face_id, a.seq, max(b.thickness) / 2.0::DOUBLE AS extension FROM w a JOIN w b ON a.face_id = b.face_id AND a.seq <> b.seq AND abs(b.lo - a.hi) <= 0.01 GROUP BY ALL""")  # fmt: skip
def c26_wall_end_extension(spark, sf):
    w = intervals(spark, sf).select("face_id", "seq", "lo", "hi", (F.col("seq") % 3 + 1).alias("thickness"))
    other = w.select("face_id", F.col("seq").alias("other"), F.col("lo").alias("olo"), F.col("thickness").alias("t"))
    met = w.join(other, "face_id").where((F.col("seq") != F.col("other")) & (F.abs(F.col("olo") - F.col("hi")) <= 0.01))
    return met.groupBy("face_id", "seq").agg((F.max("t") / 2).alias("extension"))


@R.add("c28_assemble_openings", with_("intervals") + """,
    f AS (SELECT *, CASE WHEN lo - max(hi) OVER (PARTITION BY face_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 0.05 THEN 0 ELSE 1 END AS fresh FROM intervals),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY face_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM f)
    SELECT face_id, min(lo) AS lo, max(hi) AS hi, CASE WHEN count(DISTINCT seq % 3) = 1 THEN min(seq % 3) END AS material, count(DISTINCT seq % 3) > 1 AS conflict FROM g GROUP BY face_id, n""")  # fmt: skip
def c28_assemble_openings(spark, sf):
    g = O.cluster_gap(intervals(spark, sf), ["face_id"], "lo", "hi", 0.05).withColumn("m", F.col("seq") % 3)
    out = g.groupBy("face_id", "cluster").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.countDistinct("m").alias("k"), F.min("m").alias("m"))
    return out.select("face_id", "lo", "hi", F.when(F.col("k") == 1, F.col("m")).alias("material"), (F.col("k") > 1).alias("conflict"))


@R.add("c29_assign_type", with_("intervals") + """,
    p AS (SELECT face_id, seq, lo, hi - lo AS size, lag(lo) OVER w AS plo, lag(hi - lo) OVER w AS psize, lag(seq) OVER w AS pseq FROM intervals WINDOW w AS (PARTITION BY face_id ORDER BY seq))
    SELECT face_id, seq, CASE WHEN abs(lo - plo) <= 2 AND abs(size - psize) <= 3 THEN 'as_' || pseq WHEN size < 3 THEN 'small' WHEN size < 7 THEN 'medium' ELSE 'large' END AS type FROM p""")  # fmt: skip
def c29_assign_type(spark, sf):
    w = Window.partitionBy("face_id").orderBy("seq")
    p = intervals(spark, sf).withColumn("size", F.col("hi") - F.col("lo"))
    near = (F.abs(F.col("lo") - F.lag("lo").over(w)) <= 2) & (F.abs(F.col("size") - F.lag("size").over(w)) <= 3)
    return p.select("face_id", "seq", F.when(near, F.concat(F.lit("as_"), F.lag("seq").over(w))).when(F.col("size") < 3, "small").when(F.col("size") < 7, "medium").otherwise("large").alias("type"))


@R.add("c30_placement_fit", with_("boxes") + """,
    m AS (SELECT model_id, min(x0) AS x0, max(x1) AS x1, min(y0) AS y0, max(y1) AS y1 FROM boxes GROUP BY model_id)
    SELECT b.face_id, round(greatest(abs(b.x0 - m.x0), abs(b.x1 - m.x1)), 6) AS in_plane, round(greatest(abs(b.y0 - m.y0), abs(b.y1 - m.y1)), 6) AS depth, greatest(abs(b.x0 - m.x0), abs(b.x1 - m.x1)) <= 4 AS fits FROM boxes b JOIN m USING (model_id)""")  # fmt: skip
def c30_placement_fit(spark, sf):
    b = boxes(spark, sf)
    m = b.groupBy("model_id").agg(F.min("x0").alias("mx0"), F.max("x1").alias("mx1"), F.min("y0").alias("my0"), F.max("y1").alias("my1"))
    worst = lambda c: F.greatest(F.abs(F.col(f"{c}0") - F.col(f"m{c}0")), F.abs(F.col(f"{c}1") - F.col(f"m{c}1")))
    return b.join(m, "model_id").select("face_id", F.round(worst("x"), 6).alias("in_plane"), F.round(worst("y"), 6).alias("depth"), (worst("x") <= 4).alias("fits"))


@R.add("c31_not_nested", "SELECT l_suppkey AS type, count(*) AS placed FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 25) GROUP BY 1")
def c31_not_nested(spark, sf):
    inside = table(spark, sf, "part").where("p_size > 25").select(F.col("p_partkey").alias("l_partkey"))
    return table(spark, sf, "lineitem").join(inside, "l_partkey", "left_anti").groupBy(F.col("l_suppkey").alias("type")).agg(F.count("*").alias("placed"))


@R.add("c32_layout_phase", with_("points") + """,
    s AS (SELECT face_id, count(*) AS n, sum(x) AS sx, sum(y) AS su, sum(x*x) AS sxx, sum(x*y) AS sxu FROM points GROUP BY face_id),
    f AS (SELECT face_id, (n*sxu - sx*su) / nullif(n*sxx - sx*sx, 0) AS scale, su, sx, n FROM s)
    SELECT face_id, round(scale, 6) AS scale, round(((su - scale*sx)/n) - floor((su - scale*sx)/n + 1e-9), 4) AS phase FROM f WHERE scale IS NOT NULL""")  # fmt: skip
def c32_layout_phase(spark, sf):
    s = points(spark, sf).groupBy("face_id").agg(F.count("*").alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("su"), F.sum(F.col("x") * F.col("x")).alias("sxx"), F.sum(F.col("x") * F.col("y")).alias("sxu"))
    c = F.col
    f = s.withColumn("scale", (c("n") * c("sxu") - c("sx") * c("su")) / F.nullif(c("n") * c("sxx") - c("sx") * c("sx"), F.lit(0.0))).where("scale is not null")
    place = (c("su") - c("scale") * c("sx")) / c("n")
    return f.select("face_id", F.round("scale", 6).alias("scale"), F.round(place - F.floor(place + 1e-9), 4).alias("phase"))


@R.add("d24_opening_planes", with_("intervals") + """,
    o AS (SELECT face_id, lo, hi FROM intervals WHERE seq = 1 AND hi > lo), p AS (SELECT i.face_id, greatest(i.lo, o.lo) AS lo, least(i.hi, o.hi) AS hi, o.lo AS olo, o.hi AS ohi FROM intervals i JOIN o USING (face_id) WHERE i.seq > 1 AND i.lo < o.hi AND i.hi > o.lo),
    f AS (SELECT *, CASE WHEN lo <= max(hi) OVER (PARTITION BY face_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM p),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY face_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM f),
    u AS (SELECT face_id, min(olo) AS olo, max(ohi) AS ohi, max(hi) - min(lo) AS len FROM g GROUP BY face_id, n)
    SELECT o.face_id, round(coalesce(sum(len), 0) / (o.hi - o.lo), 6) AS cover, coalesce(sum(len), 0) / (o.hi - o.lo) >= 0.95 AS covered FROM o LEFT JOIN u USING (face_id) GROUP BY o.face_id, o.lo, o.hi""")  # fmt: skip
def d24_opening_planes(spark, sf):
    i = intervals(spark, sf)
    o = i.where("seq = 1 and hi > lo").select("face_id", F.col("lo").alias("olo"), F.col("hi").alias("ohi"))
    inside = i.where("seq > 1").join(o, "face_id").where("lo < ohi and hi > olo").select("face_id", F.greatest("lo", "olo").alias("lo"), F.least("hi", "ohi").alias("hi"))
    runs = O.merge_runs(inside, ["face_id"], "lo", "hi", 0.0).groupBy("face_id").agg(F.sum(F.col("hi") - F.col("lo")).alias("len"))
    share = F.coalesce("len", F.lit(0.0)) / (F.col("ohi") - F.col("olo"))
    return o.join(runs, "face_id", "left").select("face_id", F.round(share, 6).alias("cover"), (share >= 0.95).alias("covered"))


@R.add("d34_questions", with_("findings") + """
    SELECT stage, name, count(*) AS pieces, count(DISTINCT model_id) AS levels, CASE WHEN count(DISTINCT model_id) >= 2 OR count(*) > 100 THEN 'high' ELSE 'normal' END AS priority FROM findings WHERE status <> 'pass' GROUP BY stage, name""")  # fmt: skip
def d34_questions(spark, sf):
    q = findings(spark, sf).where("status <> 'pass'").groupBy("stage", "name").agg(F.count("*").alias("pieces"), F.countDistinct("model_id").alias("levels"))
    return q.withColumn("priority", F.when((F.col("levels") >= 2) | (F.col("pieces") > 100), "high").otherwise("normal"))


@R.add("d38_storey_bands", with_("intervals") + """
    SELECT face_id, CAST(floor(lo / 10) AS BIGINT) AS band, sum(hi - lo) AS length, sum(hi - lo) / 30 >= 0.6 AS is_band FROM intervals GROUP BY ALL""")  # fmt: skip
def d38_storey_bands(spark, sf):
    b = intervals(spark, sf).groupBy("face_id", F.floor(F.col("lo") / 10).cast("long").alias("band")).agg(F.sum(F.col("hi") - F.col("lo")).alias("length"))
    return b.withColumn("is_band", F.col("length") / 30 >= 0.6)


@R.add("d40_compare_modules", with_("boxes", "tris") + """,
    b AS (SELECT model_id, max(x1) - min(x0) AS dx, max(z1) - min(z0) AS dz FROM boxes GROUP BY model_id), t AS (SELECT model_id, count(*) AS triangles FROM tris GROUP BY model_id), a AS (SELECT * FROM b JOIN t USING (model_id))
    SELECT s.model_id, s.triangles AS source_triangles, m.triangles AS model_triangles, s.dx - m.dx AS dx, s.dz - m.dz AS dz FROM a s JOIN a m ON m.model_id = s.model_id + 10""")  # fmt: skip
def d40_compare_modules(spark, sf):
    b = boxes(spark, sf).groupBy("model_id").agg((F.max("x1") - F.min("x0")).alias("dx"), (F.max("z1") - F.min("z0")).alias("dz"))
    a = b.join(T.triangulate(corners(spark, sf)).groupBy("model_id").agg(F.count("*").alias("triangles")), "model_id")
    m = a.select((F.col("model_id") - 10).alias("model_id"), F.col("triangles").alias("model_triangles"), F.col("dx").alias("mdx"), F.col("dz").alias("mdz"))
    return a.join(m, "model_id").select("model_id", F.col("triangles").alias("source_triangles"), "model_triangles", (F.col("dx") - F.col("mdx")).alias("dx"), (F.col("dz") - F.col("mdz")).alias("dz"))


_UVB = "uvb AS (SELECT face_id, CAST(floor(min(x)) AS BIGINT) AS tile, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM points WHERE corner < 2 GROUP BY face_id HAVING max(x) - min(x) <= 1 AND max(y) - min(y) <= 1)"


@R.add("d41_uv_islands", with_("panels") + """
    SELECT p.model_id, p.face_id AS a, q.face_id AS b FROM panels p JOIN panels q ON p.model_id = q.model_id AND p.axis = 2 AND q.axis = 2 AND p.face_id < q.face_id
      AND least(p.x1, q.x1) - greatest(p.x0, q.x0) > 0.2 AND least(p.y1, q.y1) - greatest(p.y0, q.y0) > 0.2""")  # fmt: skip
def d41_uv_islands(spark, sf):
    return S.box_pairs(panels(spark, sf).where("axis = 2"), 1.0, axes="xy").where("shared_x > 0.2 and shared_y > 0.2").select("model_id", "a", "b")


_PC = "pc AS (SELECT DISTINCT model_id, CAST(floor(x0 / 0.5) AS BIGINT) AS i, CAST(floor(y0 / 0.5) AS BIGINT) AS j FROM panels WHERE axis = 2)"


@R.add("d44_plan_clusters", with_("panels").replace("WITH", "WITH RECURSIVE", 1) + f", {_PC}" + """,
    r AS (SELECT model_id, i, j, i * 1000 + j AS root FROM pc UNION SELECT r.model_id, n.i, n.j, r.root FROM r JOIN pc n ON n.model_id = r.model_id AND abs(n.i - r.i) <= 1 AND abs(n.j - r.j) <= 1),
    l AS (SELECT model_id, i, j, min(root) AS c FROM r GROUP BY ALL)
    SELECT model_id, count(DISTINCT c) AS clusters, count(*) AS cells FROM l GROUP BY model_id""")  # fmt: skip
def d44_plan_clusters(spark, sf):
    cells = panels(spark, sf).where("axis = 2").select("model_id", F.floor(F.col("x0") / 0.5).cast("long").alias("i"), F.floor(F.col("y0") / 0.5).cast("long").alias("j"))
    return M.cell_clusters(cells, 1).groupBy("model_id").agg(F.countDistinct("component").alias("clusters"), F.count("*").alias("cells"))


@R.add("d45_material_groups", with_("edges").replace("WITH", "WITH RECURSIVE", 1) + """,
    s AS (SELECT DISTINCT model_id, material, face_id, least(a, b) AS a, greatest(a, b) AS b FROM edges),
    n AS (SELECT DISTINCT p.face_id AS a, q.face_id AS b FROM s p JOIN s q ON p.model_id = q.model_id AND p.material = q.material AND p.a = q.a AND p.b = q.b),
    r AS (SELECT DISTINCT face_id, face_id AS root FROM s UNION SELECT r.face_id, n.b FROM r JOIN n ON r.root = n.a)
    SELECT component, count(*) AS faces FROM (SELECT face_id, min(root) AS component FROM r GROUP BY face_id) GROUP BY component HAVING count(*) > 1""")  # fmt: skip
def d45_material_groups(spark, sf):
    s = T.edges(corners(spark, sf)).select("model_id", "material", "face_id", F.least("a", "b").alias("p"), F.greatest("a", "b").alias("q"))
    hub = s.groupBy("model_id", "material", "p", "q").agg(F.min("face_id").alias("b"))
    links = s.join(hub, ["model_id", "material", "p", "q"]).select(F.col("face_id").alias("a"), "b")
    return T.components(s.select(F.col("face_id").alias("node")), links).groupBy("component").agg(F.count("*").alias("faces")).where("faces > 1")


@R.add("e16_ring_cuts", with_("corners").replace("WITH ", "WITH RECURSIVE ", 1) + """,
    q AS (SELECT face_id, list(vid ORDER BY corner) AS v FROM corners GROUP BY face_id HAVING count(*) = 4),
    sides AS (SELECT face_id, i, least(v[i], v[i % 4 + 1]) AS a, greatest(v[i], v[i % 4 + 1]) AS b, abs(v[i] - v[i % 4 + 1]) % 5 + 1 AS cuts FROM q, range(1, 5) t(i)),
    links AS (SELECT DISTINCT p.a, p.b, o.a AS oa, o.b AS ob FROM sides p JOIN sides o ON p.face_id = o.face_id AND (p.i + 1) % 4 + 1 = o.i),
    reach AS (SELECT DISTINCT a, b, a AS ra, b AS rb FROM sides UNION SELECT r.a, r.b, l.oa, l.ob FROM reach r JOIN links l ON l.a = r.ra AND l.b = r.rb),
    own AS (SELECT a, b, max(cuts) AS cuts FROM sides GROUP BY ALL)
    SELECT r.a, r.b, max(o.cuts) AS cuts FROM reach r JOIN own o ON o.a = r.ra AND o.b = r.rb GROUP BY ALL""")  # fmt: skip
def e16_ring_cuts(spark, sf):
    rows = F.array_sort(F.collect_list(F.struct("corner", "vid")))
    q = corners(spark, sf).groupBy("face_id").agg(F.transform(rows, lambda r: r["vid"]).alias("v")).where("size(v) = 4")
    cuts = F.array(*[(F.abs(F.col("v")[i] - F.col("v")[(i + 1) % 4]) % 5 + 1) for i in range(4)])
    return M.ring_cuts(q.select("face_id", *[F.col("v")[i].alias(c) for i, c in enumerate("abcd")], cuts.alias("cuts")))


@R.add("k4_master_gate", with_("edges", "vertices") + """,
    s AS (SELECT e.face_id, sqrt(pow(p.x-q.x,2)+pow(p.y-q.y,2)+pow(p.z-q.z,2)) AS len FROM edges e JOIN vertices p ON e.a = p.vid JOIN vertices q ON e.b = q.vid)
    SELECT face_id, count(*) AS corners, count(*) = 4 AS quad, round(max(len), 6) AS longest, max(len) <= 4 AS size_ok FROM s GROUP BY face_id""")  # fmt: skip
def k4_master_gate(spark, sf):
    s = T.edges(corners(spark, sf))
    for end in "ab":
        s = s.join(vertices(spark, sf).select(F.col("vid").alias(end), *[F.col(c).alias(f"{end}{c}") for c in "xyz"]), end)
    d = [F.col(f"a{c}") - F.col(f"b{c}") for c in "xyz"]
    s = s.withColumn("len", F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]))
    return s.groupBy("face_id").agg(F.count("*").alias("corners"), (F.count("*") == 4).alias("quad"), F.round(F.max("len"), 6).alias("longest"), (F.max("len") <= 4).alias("size_ok"))


@R.add("k5_surface_gate", with_("edges") + """,
    u AS (SELECT model_id, least(a, b) AS a, greatest(a, b) AS b, count(*) AS n, abs(sum(CASE WHEN a < b THEN 1 WHEN a > b THEN -1 ELSE 0 END)) AS w FROM edges GROUP BY 1, 2, 3),
    d AS (SELECT model_id, v, count(*) AS degree FROM (SELECT model_id, a AS v FROM u WHERE n = 1 UNION ALL SELECT model_id, b FROM u WHERE n = 1) GROUP BY ALL)
    SELECT u.model_id, count(*) FILTER (n = 2 AND w = 2) AS bad_winding, count(*) FILTER (n > 2) AS multi, (SELECT count(*) FROM d WHERE d.model_id = u.model_id AND degree % 2 = 1) AS odd_ends FROM u GROUP BY u.model_id""")  # fmt: skip
def k5_surface_gate(spark, sf):
    u = T.edge_uses(T.edges(corners(spark, sf)))
    n = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    ends = u.where("uses = 1").select("model_id", F.explode(F.array("a", "b")).alias("v")).groupBy("model_id", "v").count()
    odd = ends.groupBy("model_id").agg(n(F.col("count") % 2 == 1).alias("odd_ends"))
    out = u.groupBy("model_id").agg(n((F.col("uses") == 2) & (F.abs("winding") == 2)).alias("bad_winding"), n(F.col("uses") > 2).alias("multi"))
    return out.join(odd, "model_id", "left").withColumn("odd_ends", F.coalesce("odd_ends", F.lit(0)))


@R.add("k6_compare_groups", with_("points") + """,
    c AS (SELECT DISTINCT model_id, CAST(floor(x) AS BIGINT) AS i, CAST(floor(y / 0.5) AS BIGINT) AS j FROM points), a AS (SELECT model_id // 2 AS g, i, j FROM c WHERE model_id % 2 = 0), b AS (SELECT model_id // 2 AS g, i, j FROM c WHERE model_id % 2 = 1)
    SELECT coalesce(a.g, b.g) AS pair, count(*) FILTER (a.g IS NOT NULL AND b.g IS NOT NULL) AS shared, count(*) AS total, round(count(*) FILTER (a.g IS NOT NULL AND b.g IS NOT NULL) / count(*)::DOUBLE, 6) AS iou FROM a FULL JOIN b ON a.g = b.g AND a.i = b.i AND a.j = b.j GROUP BY 1""")  # fmt: skip
def k6_compare_groups(spark, sf):
    c = points(spark, sf).select("model_id", F.floor("x").cast("long").alias("i"), F.floor(F.col("y") / 0.5).cast("long").alias("j")).distinct()
    side = c.groupBy(F.floor(F.col("model_id") / 2).cast("long").alias("pair"), "i", "j").agg(F.countDistinct("model_id").alias("n"))
    both = F.sum(F.when(F.col("n") == 2, 1).otherwise(0)).cast("long")
    out = side.groupBy("pair").agg(both.alias("shared"), F.count("*").alias("total"))
    return out.withColumn("iou", F.round(F.col("shared") / F.col("total"), 6))


@R.add("n1_wall_quads", with_("intervals") + """,
    cuts AS (SELECT DISTINCT face_id, c FROM (SELECT face_id, lo AS c FROM intervals UNION ALL SELECT face_id, hi FROM intervals UNION ALL SELECT face_id, 0.0 FROM intervals UNION ALL SELECT face_id, 70.0 FROM intervals)),
    cells AS (SELECT face_id, c AS a, lead(c) OVER (PARTITION BY face_id ORDER BY c) AS b FROM cuts),
    k AS (SELECT c.face_id, c.b - c.a AS w, EXISTS (SELECT 1 FROM intervals i WHERE i.face_id = c.face_id AND i.lo <= c.a AND i.hi >= c.b) AS hole FROM cells c WHERE b IS NOT NULL)
    SELECT face_id, count(*) FILTER (NOT hole) AS wall_quads, count(*) FILTER (hole) AS holes, coalesce(sum(w) FILTER (NOT hole), 0) AS wall_length FROM k GROUP BY face_id""")  # fmt: skip
def n1_wall_quads(spark, sf):
    # Dealt by face once: cuts, cells and the intervals that hold them are windows and groups over the same tasks.
    i = dealt(intervals(spark, sf).select("face_id", "lo", "hi"), "face_id")
    at = lambda c, to=F.lit(None).cast("double"): F.struct(c.alias("c"), to.alias("to"))
    ends = i.select("face_id", F.explode(F.array(at(F.col("lo"), F.when(F.col("lo").isNotNull(), F.col("hi"))), at(F.col("hi")), at(F.lit(0.0)), at(F.lit(70.0)))).alias("e"))
    w = Window.partitionBy("face_id").orderBy("c")
    cuts = ends.groupBy("face_id", F.col("e.c").alias("c")).agg(F.max("e.to").alias("to"))
    # An interval that begins at or before a cell holds it if it reaches the cell's end.
    reach = F.max("to").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    k = cuts.withColumn("b", F.lead("c").over(w)).withColumn("hole", F.coalesce(reach >= F.col("b"), F.lit(False))).where("b is not null").withColumn("w", F.col("b") - F.col("c"))
    n = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    return k.groupBy("face_id").agg(n(~F.col("hole")).alias("wall_quads"), n(F.col("hole")).alias("holes"), F.sum(F.when(~F.col("hole"), F.col("w")).otherwise(0.0)).alias("wall_length"))


@R.add("n7_roof", with_("tri_points") + """,
    m AS (SELECT model_id, (az+bz+cz)/3 AS h, abs((bx-ax)*(cy-ay)-(by_-ay)*(cx-ax))/2 AS plan FROM tri_points)
    SELECT model_id, round(sum(plan*h)/nullif(sum(plan), 0), 6) AS roof_height, round(max(h), 6) AS top FROM m GROUP BY model_id""")  # fmt: skip
def n7_roof(spark, sf):
    t = T.tri_measures(T.face_corners(T.triangulate(corners(spark, sf)), vertices(spark, sf)))
    c = lambda s: F.col(s)
    plan = F.abs((c("bx") - c("ax")) * (c("cy") - c("ay")) - (c("by") - c("ay")) * (c("cx") - c("ax"))) / 2
    t = t.withColumn("plan", plan)
    return t.groupBy("model_id").agg(F.round(F.sum(c("plan") * c("mz")) / F.nullif(F.sum("plan"), F.lit(0.0)), 6).alias("roof_height"), F.round(F.max("mz"), 6).alias("top"))


@R.add("d10_mesh_gate", with_("edges") + """,
    u AS (SELECT model_id, least(a, b) AS a, greatest(a, b) AS b, count(*) AS n FROM edges GROUP BY 1, 2, 3), f AS (SELECT model_id, count(DISTINCT face_id) AS faces, count(*) AS sides FROM edges GROUP BY model_id),
    e AS (SELECT model_id, count(*) FILTER (n > 2) AS multi FROM u GROUP BY model_id)
    SELECT model_id, 'non_manifold' AS "check", CASE WHEN multi <= 1 THEN 'pass' ELSE 'fail' END AS status, multi AS value FROM e UNION ALL SELECT model_id, 'n_gons', CASE WHEN sides <= 5 * faces THEN 'pass' ELSE 'fail' END, sides - 4 * faces FROM f""")  # fmt: skip
def d10_mesh_gate(spark, sf):
    sides = T.edges(corners(spark, sf))
    n = F.sum(F.when(F.col("uses") > 2, 1).otherwise(0)).cast("long")
    e = T.edge_uses(sides).groupBy("model_id").agg(n.alias("value")).select("model_id", F.lit("non_manifold").alias("check"), F.when(F.col("value") <= 1, "pass").otherwise("fail").alias("status"), "value")
    f = sides.groupBy("model_id").agg(F.countDistinct("face_id").alias("faces"), F.count("*").alias("sides"))
    return e.unionByName(f.select("model_id", F.lit("n_gons").alias("check"), F.when(F.col("sides") <= 5 * F.col("faces"), "pass").otherwise("fail").alias("status"), (F.col("sides") - 4 * F.col("faces")).alias("value")))


@R.add("l12_intake_rules", """
    SELECT o_orderkey AS item, CASE WHEN o_totalprice < 50000 THEN 'unconfirmed' WHEN n > 1 AND NOT answered THEN 'contradiction' ELSE 'buildable' END AS state
    FROM orders JOIN (SELECT l_orderkey, count(DISTINCT l_returnflag) AS n, bool_or(l_linestatus = 'F') AS answered FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")  # fmt: skip
def l12_intake_rules(spark, sf):
    facts = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("item")).agg(F.countDistinct("l_returnflag").alias("n"), F.bool_or(F.col("l_linestatus") == "F").alias("answered"))
    j = table(spark, sf, "orders").select(F.col("o_orderkey").alias("item"), "o_totalprice").join(facts, "item")
    return j.select("item", F.when(F.col("o_totalprice") < 50000, "unconfirmed").when((F.col("n") > 1) & ~F.col("answered"), "contradiction").otherwise("buildable").alias("state"))


@R.add("l9_bundle_rules", """
    SELECT l_orderkey AS package, CASE WHEN sum(l_quantity) > 150 THEN 'too_large' WHEN min(l_linenumber) <> 1 THEN 'not_sequential' WHEN NOT bool_and(l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 45)) THEN 'not_approved' ELSE 'ok' END AS state FROM lineitem GROUP BY 1""")  # fmt: skip
def l9_bundle_rules(spark, sf):
    ok = table(spark, sf, "part").where("p_size <= 45").select(F.col("p_partkey").alias("l_partkey"), F.lit(True).alias("ok"))
    j = table(spark, sf, "lineitem").join(ok, "l_partkey", "left").groupBy(F.col("l_orderkey").alias("package"))
    a = j.agg(F.sum("l_quantity").alias("q"), F.min("l_linenumber").alias("first"), F.bool_and(F.coalesce("ok", F.lit(False))).alias("approved"))
    return a.select("package", F.when(F.col("q") > 150, "too_large").when(F.col("first") != 1, "not_sequential").when(~F.col("approved"), "not_approved").otherwise("ok").alias("state"))


@R.add("k2_geometry_checks", with_("corners", "ranges", "boxes") + """,
    g AS (SELECT model_id, count(*) FILTER (material = 0) AS unassigned FROM corners GROUP BY model_id), b AS (SELECT model_id, max(x1) - min(x0) AS dx FROM boxes GROUP BY model_id)
    SELECT model_id, count(*) AS checks, count(*) FILTER (status = 'pass') AS passes, count(*) FILTER (status = 'fail') AS fails FROM (
      SELECT model_id, CASE WHEN unassigned <= 12 THEN 'pass' ELSE 'fail' END AS status FROM g UNION ALL SELECT model_id, CASE WHEN abs(dx - 12) <= 0.25 THEN 'pass' ELSE 'fail' END FROM b) GROUP BY model_id""")  # fmt: skip
def k2_geometry_checks(spark, sf):
    g = corners(spark, sf).groupBy("model_id").agg(F.sum((F.col("material") == 0).cast("long")).alias("v")).select("model_id", F.when(F.col("v") <= 12, "pass").otherwise("fail").alias("status"))
    b = boxes(spark, sf).groupBy("model_id").agg((F.max("x1") - F.min("x0")).alias("dx")).select("model_id", F.when(F.abs(F.col("dx") - 12) <= 0.25, "pass").otherwise("fail").alias("status"))
    return K.roll_up(g.unionByName(b), ["model_id"]).select("model_id", "checks", "passes", "fails")
