"""Queries of windows, ordered folds, sorts and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from stereobate.operators import ordered as O
from stereobate.plans.binding import Registry, boxes, findings, intervals, points, table, vertices, with_

R = Registry()


@R.add("e1_cluster_gap", with_("intervals") + """,
    f AS (SELECT *, CASE WHEN lo - max(hi) OVER (PARTITION BY face_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 1 THEN 0 ELSE 1 END AS fresh FROM intervals)
    SELECT face_id, seq, CAST(sum(fresh) OVER (PARTITION BY face_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cluster FROM f""")  # fmt: skip
def e1_cluster_gap(spark, sf):
    return O.cluster_gap(intervals(spark, sf), ["face_id"], "lo", "hi", 1.0).select("face_id", "seq", "cluster")


@R.add("e1_cluster_span", with_("intervals").replace("WITH", "WITH RECURSIVE", 1) + """,
    d AS (SELECT DISTINCT face_id, lo FROM intervals),
    a AS (SELECT face_id, min(lo) AS anchor FROM d GROUP BY face_id UNION ALL
          SELECT a.face_id, (SELECT min(d.lo) FROM d WHERE d.face_id = a.face_id AND d.lo > a.anchor + 5) FROM a
          WHERE EXISTS (SELECT 1 FROM d WHERE d.face_id = a.face_id AND d.lo > a.anchor + 5))
    SELECT i.face_id, (SELECT max(anchor) FROM a WHERE a.face_id = i.face_id AND a.anchor <= i.lo) AS anchor, count(*) AS members FROM intervals i GROUP BY 1, 2""")  # fmt: skip
def e1_cluster_span(spark, sf):
    return O.cluster_span(intervals(spark, sf), ["face_id"], "lo", 5.0)


@R.add("e2_height_spans", with_("points") + """,
    s AS (SELECT model_id, z AS lo, lead(z) OVER (PARTITION BY model_id ORDER BY z) AS hi FROM (SELECT DISTINCT model_id, z FROM points))
    SELECT model_id, lo, hi, (lo + hi) / 2 AS middle FROM s WHERE hi - lo >= 1""")  # fmt: skip
def e2_height_spans(spark, sf):
    return O.height_spans(points(spark, sf), ["model_id"], "z", 1.0)


_RUNS = """f AS (SELECT *, CASE WHEN lo - max(hi) OVER (PARTITION BY face_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {tol} THEN 0 ELSE 1 END AS fresh FROM intervals),
    g AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY face_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cluster FROM f)
    SELECT face_id, cluster, min(lo) AS lo, max(hi) AS hi, count(*) AS parts FROM g GROUP BY ALL"""


@R.add("e3_merge_runs", with_("intervals") + ", " + _RUNS.format(tol=0))
def e3_merge_runs(spark, sf):
    return O.merge_runs(intervals(spark, sf), ["face_id"], "lo", "hi", 0.0)


@R.add("e12_merge_panes", with_("intervals") + ", " + _RUNS.format(tol=0.15))
def e12_merge_panes(spark, sf):
    return O.merge_runs(intervals(spark, sf), ["face_id"], "lo", "hi", 0.15)


@R.add("e4_collapse_floors", with_("intervals").replace("WITH ", "WITH RECURSIVE ", 1) + """,
    c AS (SELECT face_id, seq, lo, seq AS first, lo AS head FROM intervals WHERE seq = 1
          UNION ALL
          SELECT i.face_id, i.seq, i.lo, CASE WHEN abs(i.lo - c.lo) <= 6 AND abs(i.lo - head) <= 6 THEN first ELSE i.seq END,
                 CASE WHEN abs(i.lo - c.lo) <= 6 AND abs(i.lo - head) <= 6 THEN head ELSE i.lo END
          FROM c JOIN intervals i ON i.face_id = c.face_id AND i.seq = c.seq + 1)
    SELECT face_id, first::DOUBLE AS first_level, max(seq)::DOUBLE AS last_level, count(*) AS floors FROM c GROUP BY face_id, first""")  # fmt: skip
def e4_collapse_floors(spark, sf):
    return O.collapse_runs(intervals(spark, sf), ["face_id"], "seq", "lo", 6.0)


@R.add("e5_expand_floors", with_("intervals") + """
    SELECT face_id, seq, last_value(CASE WHEN seq % 3 = 1 THEN lo END IGNORE NULLS) OVER (PARTITION BY face_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS contour FROM intervals""")  # fmt: skip
def e5_expand_floors(spark, sf):
    floors = intervals(spark, sf).select("face_id", "seq", F.when(F.col("seq") % 3 == 1, F.col("lo")).alias("contour"))
    return O.expand_runs(floors, ["face_id"], "seq", "contour")


_RING = """r AS (SELECT face_id, corner, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS xn, coalesce(lead(y) OVER w, first_value(y) OVER w) AS yn,
              coalesce(lag(x) OVER w, last_value(x) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS xp,
              coalesce(lag(y) OVER w, last_value(y) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS yp FROM points WINDOW w AS (PARTITION BY face_id ORDER BY corner))"""


@R.add("e6_ring_turns", with_("points") + f""", {_RING}
    SELECT face_id, corner, round(abs(degrees(atan2((x-xp)*(yn-y)-(y-yp)*(xn-x), (x-xp)*(xn-x)+(y-yp)*(yn-y)+0.0)+0.0)), 4) AS turn FROM r""")  # fmt: skip
def e6_ring_turns(spark, sf):
    return O.ring_turns(points(spark, sf), ["face_id"], "corner").select("face_id", "corner", F.round(F.abs("turn"), 4).alias("turn"))


@R.add("e6_ring_area", with_("points") + f", {_RING} SELECT face_id, round(sum(x*yn-xn*y)/2, 6) AS area FROM r GROUP BY face_id")
def e6_ring_area(spark, sf):
    return O.ring_area(points(spark, sf), ["face_id"], "corner").withColumn("area", F.round("area", 6))


@R.add("e8_latest_stage", with_("findings") + """
    SELECT model_id, stage, name, status, event_id FROM findings QUALIFY row_number() OVER (PARTITION BY model_id, stage ORDER BY event_id DESC) = 1""")  # fmt: skip
def e8_latest_stage(spark, sf):
    return O.latest(findings(spark, sf), ["model_id", "stage"], [F.desc("event_id")])


@R.add("e8_repeat_failures", with_("findings") + """,
    r AS (SELECT *, CASE WHEN status = 'fail' THEN name END AS reason FROM findings)
    SELECT stage, event_id, reason FROM r QUALIFY reason IS NOT NULL AND lag(reason) OVER (PARTITION BY stage ORDER BY event_id) = reason""")  # fmt: skip
def e8_repeat_failures(spark, sf):
    f = findings(spark, sf).select("stage", "event_id", F.when(F.col("status") == "fail", F.col("name")).alias("reason"))
    return O.repeat_failures(f, ["stage"], "event_id", "reason")


@R.add("e9_last_before", """
    SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS command
    FROM events""")  # fmt: skip
def e9_last_before(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return O.last_before(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase", F.col("event_id"), "command").select("event_id", "command")


@R.add("e10_no_gaps", """
    SELECT l_orderkey AS face_id, CAST(min(l_linenumber) AS BIGINT) AS lo, CAST(max(l_linenumber) AS BIGINT) AS hi, count(DISTINCT l_linenumber) AS kinds,
           max(l_linenumber) - min(l_linenumber) + 1 = count(DISTINCT l_linenumber) AND min(l_linenumber) = 1 AS whole FROM lineitem GROUP BY l_orderkey""")  # fmt: skip
def e10_no_gaps(spark, sf):
    d = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("face_id"), F.col("l_linenumber").cast("long").alias("n"))
    return O.no_gaps(d, ["face_id"], "n", 1)


@R.add("e11_ordinals", "SELECT p_partkey, printf('%s_%03d', p_type, row_number() OVER (PARTITION BY p_type ORDER BY p_size, p_partkey)) AS ordinal FROM part")
def e11_ordinals(spark, sf):
    return O.ordinals(table(spark, sf, "part"), ["p_type"], ["p_size", "p_partkey"], "%s_%03d").select("p_partkey", "ordinal")


@R.add("e13_top_n", with_("findings") + " SELECT stage, event_id, rank FROM (SELECT stage, event_id, row_number() OVER (PARTITION BY stage ORDER BY event_id) AS rank FROM findings WHERE status = 'fail') WHERE rank <= 5")
def e13_top_n(spark, sf):
    return O.top_n(findings(spark, sf).where("status = 'fail'"), ["stage"], ["event_id"], 5).select("stage", "event_id", "rank")


@R.add("e14_smooth", with_("vertices") + """,
    g AS (SELECT CAST(floor(x) AS BIGINT) AS i, CAST(floor(y / 0.5) AS BIGINT) AS j, max(z) AS z FROM vertices GROUP BY ALL),
    s AS (SELECT g.i + a.d AS i, g.j + b.d AS j, z FROM g, (SELECT unnest(range(-2, 3)) AS d) a, (SELECT unnest(range(-2, 3)) AS d) b)
    SELECT g.i, g.j, round_even(median(s.z) / 0.25, 0) * 0.25::DOUBLE AS z FROM g JOIN s USING (i, j) GROUP BY g.i, g.j""")  # fmt: skip
def e14_smooth(spark, sf):
    g = vertices(spark, sf).groupBy(F.floor("x").cast("long").alias("i"), F.floor(F.col("y") / 0.5).cast("long").alias("j")).agg(F.max("z").alias("z"))
    return O.smooth(g, "z", 0.25)


@R.add("e15_token_gauge", """
    WITH s AS (SELECT *, CAST(sum((event_type = 'signup')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS stretch FROM events),
    t AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 0 ELSE value END) OVER (PARTITION BY user_id, stretch ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM s)
    SELECT user_id, stretch, threshold, event_id, round(total, 4) AS total FROM t, (VALUES (50.0::DOUBLE), (100.0::DOUBLE)) h(threshold) WHERE total >= threshold
    QUALIFY row_number() OVER (PARTITION BY user_id, stretch, threshold ORDER BY ts, event_id) = 1""")  # fmt: skip
def e15_token_gauge(spark, sf):
    e = table(spark, sf, "events")
    return O.gauge(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup", F.col("value"), [50, 100]).select("user_id", "stretch", "threshold", "event_id", F.round("total", 4).alias("total"))


@R.add("d37_pane_layout", with_("intervals") + f", r AS ({_RUNS.format(tol=2).replace('f AS', 'WITH f AS', 1)}) SELECT face_id, count(*) AS columns, CAST(max(parts) AS BIGINT) AS most_panes, sum(hi - lo) AS width FROM r GROUP BY face_id")
def d37_pane_layout(spark, sf):
    runs = O.merge_runs(intervals(spark, sf), ["face_id"], "lo", "hi", 2.0)
    return runs.groupBy("face_id").agg(F.count("*").alias("columns"), F.max("parts").alias("most_panes"), F.sum(F.col("hi") - F.col("lo")).alias("width"))


@R.add("f1_order_questions", with_("findings") + """
    SELECT event_id, row_number() OVER (ORDER BY CASE status WHEN 'fail' THEN 0 WHEN 'review' THEN 1 ELSE 2 END, stage, name, event_id) AS place FROM findings WHERE status <> 'pass'""")  # fmt: skip
def f1_order_questions(spark, sf):
    rank = F.when(F.col("status") == "fail", 0).when(F.col("status") == "review", 1).otherwise(2)
    asked = findings(spark, sf).where("status <> 'pass'").select("event_id", rank.alias("rank"), "stage", "name")
    return O.numbered(asked, ["rank", "stage"], ["name", "event_id"], "place").select("event_id", "place")


@R.add("f2_most_common", "SELECT p_size, p_type, count(*) AS n FROM part GROUP BY ALL ORDER BY n DESC, p_size, p_type LIMIT 10")
def f2_most_common(spark, sf):
    return table(spark, sf, "part").groupBy("p_size", "p_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_size", "p_type").limit(10)


@R.add("f3_largest", with_("boxes") + " SELECT face_id, round((x1-x0)*(y1-y0), 6) AS area FROM boxes ORDER BY area DESC, face_id LIMIT 20")
def f3_largest(spark, sf):
    return boxes(spark, sf).select("face_id", F.round((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")), 6).alias("area")).orderBy(F.desc("area"), "face_id").limit(20)


@R.add("g1_union_meshes", "SELECT 'customer' AS owner, c_custkey AS id, c_nationkey AS place FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_nationkey FROM supplier")
def g1_union_meshes(spark, sf):
    c = table(spark, sf, "customer").select(F.lit("customer").alias("owner"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("place"))
    return c.unionByName(table(spark, sf, "supplier").select(F.lit("supplier").alias("owner"), F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("place")))


_TWO = "a AS (SELECT s_suppkey % 47 AS k FROM supplier), b AS (SELECT c_custkey % 41 AS k FROM customer)"


def _two(spark, sf):
    return table(spark, sf, "supplier").select((F.col("s_suppkey") % 47).alias("k")), table(spark, sf, "customer").select((F.col("c_custkey") % 41).alias("k"))


@R.add("g2_symmetric_difference", f"WITH {_TWO} SELECT 'left' AS side, k FROM (SELECT k FROM a EXCEPT ALL SELECT k FROM b) UNION ALL SELECT 'right', k FROM (SELECT k FROM b EXCEPT ALL SELECT k FROM a)")
def g2_symmetric_difference(spark, sf):
    a, b = _two(spark, sf)
    return a.exceptAll(b).select(F.lit("left").alias("side"), "k").unionByName(b.exceptAll(a).select(F.lit("right").alias("side"), "k"))


@R.add("g3_multiset_equal", f"WITH {_TWO} SELECT (SELECT count(*) FROM (SELECT k FROM a EXCEPT ALL SELECT k FROM b)) AS only_left, (SELECT count(*) FROM (SELECT k FROM b EXCEPT ALL SELECT k FROM a)) AS only_right")
def g3_multiset_equal(spark, sf):
    a, b = _two(spark, sf)
    return a.exceptAll(b).agg(F.count("*").alias("only_left")).crossJoin(b.exceptAll(a).agg(F.count("*").alias("only_right")))


@R.add("g4_known_only", f"WITH {_TWO} SELECT k FROM a INTERSECT SELECT k FROM b")
def g4_known_only(spark, sf):
    a, b = _two(spark, sf)
    return a.intersect(b)
