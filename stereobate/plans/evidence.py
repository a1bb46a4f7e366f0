"""Queries of readers, evidence and streams (as batch replays over the events table)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stereobate.plans.binding import Registry, corners, findings, table, vertices, with_
from stereobate.sources import readers as S
from stereobate.streaming import evidence as E

R = Registry()


def _dumps(spark, sf):
    """A mesh dump in JSON for each model: every face a mesh of its own corners."""
    c = corners(spark, sf).join(vertices(spark, sf), "vid")
    rows = F.array_sort(F.collect_list(F.struct("corner", F.array("x", "y", "z").alias("p"), "material")))
    faces = c.groupBy("model_id", "face_id").agg(rows.alias("r"))
    fan = F.transform(F.sequence(F.lit(1), F.size("r") - 2), lambda i: F.array(F.lit(0), i, i + 1))
    mesh = F.struct(F.concat(F.when(F.col("face_id") % 10 == 0, "UCX_").otherwise("M"), F.col("face_id")).alias("name"), F.transform("r", lambda s: s["p"]).alias("vertices"), fan.alias("triangles"), F.transform(fan, lambda t: F.get("r", F.lit(0))["material"].cast("int")).alias("material_ids"))
    return faces.select("model_id", "face_id", mesh.alias("m")).groupBy("model_id", (F.col("face_id") % 64).alias("part")).agg(F.to_json(F.struct(F.lit("m").alias("units"), F.collect_list("m").alias("meshes"))).alias("text"))


@R.add("a1_read_dumps", with_("tris") + " SELECT model_id, count(*) AS triangles, count(DISTINCT material) AS materials, CAST(sum(material) AS BIGINT) AS material_sum FROM tris WHERE face_id % 10 <> 0 GROUP BY model_id")
def a1_read_dumps(spark, sf):
    t = S.parse_dumps(_dumps(spark, sf), "model_id", "text")["triangles"]
    return t.groupBy("model_id").agg(F.count("*").alias("triangles"), F.countDistinct("material").alias("materials"), F.sum("material").alias("material_sum"))


@R.add("a2_read_faces", with_("points") + " SELECT model_id, count(*) AS corners, count(DISTINCT face_id) AS faces, round(sum(x + y + z), 4) AS total FROM points GROUP BY model_id")
def a2_read_faces(spark, sf):
    c = corners(spark, sf).join(vertices(spark, sf), "vid")
    f = c.groupBy("model_id", "mesh", "face_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("corner", F.array("x", "y", "z").alias("p")))), lambda s: s["p"]).alias("points"))
    texts = f.groupBy("model_id", (F.col("face_id") % 64).alias("part")).agg(F.to_json(F.collect_list(F.struct(F.col("mesh").alias("object"), F.col("face_id").cast("int").alias("index"), "points"))).alias("text"))
    out = S.parse_faces(texts, "model_id", "text")
    return out.groupBy("model_id").agg(F.count("*").alias("corners"), F.countDistinct("face").alias("faces"), F.round(F.sum(F.col("x") + F.col("y") + F.col("z")), 4).alias("total"))


@R.add("a3_read_specs", "SELECT CASE WHEN n_nationkey % 4 = 0 THEN 'corrupt' ELSE 'spec' END AS kind, count(*) AS n FROM nation GROUP BY 1")
def a3_read_specs(spark, sf):
    spec = F.to_json(F.struct(F.col("n_name").alias("id"), F.lit("0.7").alias("spec_version"), F.array(F.struct(F.lit("L0").alias("name"), F.lit(0.0).alias("elev_m"))).alias("levels")))
    texts = table(spark, sf, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 4 == 0, F.substring(spec, 1, 20)).otherwise(spec).alias("text"))
    specs, corrupt = S.parse_specs(texts, "n_nationkey", "text")
    return specs.select(F.lit("spec").alias("kind")).unionByName(corrupt.select(F.lit("corrupt").alias("kind"))).groupBy("kind").agg(F.count("*").alias("n"))


@R.add("a6_transcripts", "SELECT event_type, count(*) FILTER (event_id % 9 <> 0) AS records, count(*) FILTER (event_id % 9 = 0) AS unreadable, CAST(sum(CASE WHEN event_id % 9 <> 0 THEN (props->>'k')::INT END) AS BIGINT) AS total FROM events GROUP BY event_type")
def a6_transcripts(spark, sf):
    lines = table(spark, sf, "events").select("event_type", F.when(F.col("event_id") % 9 == 0, F.substring("props", 1, 5)).otherwise(F.col("props")).alias("value"))
    records, bad = S.parse_lines(lines, "value", "k int")
    a = records.groupBy("event_type").agg(F.count("*").alias("records"), F.sum("record.k").alias("total"))
    return a.join(bad.groupBy("event_type").agg(F.count("*").alias("unreadable")), "event_type", "full_outer")


@R.add("a8_read_usage", "SELECT event_type AS name, count(*) AS uses FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY 1")
def a8_read_usage(spark, sf):
    return S.recent(table(spark, sf, "events"), "ts", 7).groupBy(F.col("event_type").alias("name")).agg(F.count("*").alias("uses"))


@R.add("a9_markdown_rows", r"""
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS value FROM documents)
    SELECT doc_id AS key, count(*) AS rows_, CAST(sum(len(string_split(regexp_replace(regexp_replace(trim(value), '^\|', ''), '\|$', ''), '|'))) AS BIGINT) AS cells FROM l WHERE value LIKE '%|%' GROUP BY doc_id""")  # fmt: skip
def a9_markdown_rows(spark, sf):
    rows = S.markdown_rows(table(spark, sf, "documents"), "doc_id", "text")
    return rows.groupBy("key").agg(F.count("*").alias("rows_"), F.sum(F.size("cells")).alias("cells"))


@R.add("a11_page_index", "SELECT page_id AS key, length(trim(html)) AS characters, length(trim(html)) = 0 AS needs_ocr, sha256(html) AS digest FROM pages")
def a11_page_index(spark, sf):
    return S.page_index(table(spark, sf, "pages"), "page_id", "html")


@R.add("a13_to_markdown", """
    SELECT n_regionkey AS region, '| n_nationkey | n_name |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || n_nationkey || ' | ' || n_name || ' |', chr(10) ORDER BY n_nationkey) AS text FROM nation GROUP BY 1""")  # fmt: skip
def a13_to_markdown(spark, sf):
    return S.to_markdown(table(spark, sf, "nation").withColumnRenamed("n_regionkey", "region"), "region", ["n_nationkey", "n_name"], ["n_nationkey"])


def _events(spark, sf):
    return table(spark, sf, "events")


@R.add("i2_pair_calls", """
    WITH c AS (SELECT event_id % 500 AS call_id, ts FROM events WHERE event_type = 'purchase'), r AS (SELECT event_id % 500 AS call_id, ts, event_type <> 'error' AS ok FROM events WHERE event_type IN ('error', 'click'))
    SELECT c.call_id, c.ts AS call_ts, r.ts AS result_ts, CASE WHEN ok THEN 'ok' WHEN NOT ok THEN 'failed' ELSE 'pending' END AS state FROM c LEFT JOIN r ON c.call_id = r.call_id AND r.ts >= c.ts AND r.ts <= c.ts + INTERVAL 24 HOUR""")  # fmt: skip
def i2_pair_calls(spark, sf):
    e = _events(spark, sf).withColumn("call_id", F.col("event_id") % 500)
    results = e.where("event_type in ('error', 'click')").select("call_id", "ts", (F.col("event_type") != "error").alias("ok"))
    return E.pair_calls(e.where("event_type = 'purchase'"), results, "24 hours")


@R.add("i4_denials", "SELECT user_id AS call_id, min(ts) AS ts FROM events WHERE event_type = 'error' AND value > 5 GROUP BY 1")
def i4_denials(spark, sf):
    e = _events(spark, sf).withColumnRenamed("user_id", "call_id")
    return E.denials(e, (F.col("event_type") == "error") & (F.col("value") > 5))


@R.add("i5_usage_tumbling", "SELECT date_trunc('day', ts) AS start, event_type AS name, count(*) AS uses FROM events GROUP BY ALL")
def i5_usage_tumbling(spark, sf):
    return E.usage_windows(_events(spark, sf).withColumnRenamed("event_type", "name"), "1 day")


@R.add("i5_usage_sliding", """
    SELECT date_trunc('day', ts) - d * INTERVAL 1 DAY AS start, event_type AS name, count(*) AS uses FROM events, (SELECT unnest(range(7)) AS d) GROUP BY ALL""")  # fmt: skip
def i5_usage_sliding(spark, sf):
    return E.usage_windows(_events(spark, sf).withColumnRenamed("event_type", "name"), "7 days", "1 day")


@R.add("i6_sessions", """
    WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM g)
    SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS stop, count(*) AS events FROM s GROUP BY user_id, n""")  # fmt: skip
def i6_sessions(spark, sf):
    return E.session_windows(_events(spark, sf), "6 hours")


@R.add("i7_run_state", """
    WITH a AS (SELECT event_id % 101 AS run_id, user_id % 5 AS stage, event_id AS attempt, CASE event_type WHEN 'error' THEN 'fail' WHEN 'click' THEN 'review' ELSE 'pass' END AS status FROM events),
    t AS (SELECT *, row_number() OVER (PARTITION BY run_id, stage ORDER BY attempt DESC) AS n FROM a),
    l AS (SELECT run_id, stage, max(status) FILTER (n = 1) AS status, count(*) FILTER (status = 'fail') = 2 AS again FROM t WHERE n <= 2 GROUP BY ALL),
    r AS (SELECT run_id, count(*) AS stages, count(*) FILTER (status = 'fail') AS failed, count(*) FILTER (status = 'pass') AS passed, count(*) FILTER (again) AS stuck FROM l GROUP BY run_id)
    SELECT *, CASE WHEN failed > 0 THEN 'failed' WHEN passed = stages THEN 'verified' ELSE 'running' END AS state, CASE WHEN stuck > 0 THEN 'stop' WHEN failed > 0 THEN 'repeat' WHEN passed = stages THEN 'none' ELSE 'continue' END AS action FROM r""")  # fmt: skip
def i7_run_state(spark, sf):
    kind = F.col("event_type")
    status = F.when(kind == "error", "fail").when(kind == "click", "review").otherwise("pass")
    e = table(spark, sf, "events")
    return E.run_state(e.select((F.col("event_id") % 101).alias("run_id"), (F.col("user_id") % 5).alias("stage"), F.col("event_id").alias("attempt"), status.alias("status")))


@R.add("i8_split_late", """
    WITH s AS (SELECT event_id, user_id, ts - (CASE WHEN event_id % 10 = 0 THEN 3 ELSE 0 END) * INTERVAL 1 DAY AS ts FROM events),
    m AS (SELECT *, max(ts) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM s)
    SELECT event_id FROM m WHERE ts < seen - INTERVAL 1 HOUR""")  # fmt: skip
def i8_split_late(spark, sf):
    back = F.when(F.col("event_id") % 10 == 0, F.expr("interval 3 days")).otherwise(F.expr("interval 0 days"))
    e = _events(spark, sf).select("event_id", F.col("user_id").alias("source"), F.col("event_id").alias("arrival"), (F.col("ts") - back).alias("ts"))
    return E.split_late(e, "1 hour")[1].select("event_id")


@R.add("j2_known_answers", with_("findings") + """,
    v AS (SELECT model_id, stage, bool_and(status <> 'fail') AS passed FROM findings GROUP BY model_id, stage)
    SELECT model_id, stage, passed, passed = (stage % 2 = 0) AS as_expected FROM v""")  # fmt: skip
def j2_known_answers(spark, sf):
    v = findings(spark, sf).groupBy("model_id", "stage").agg(F.bool_and(F.col("status") != "fail").alias("passed"))
    expected = spark.range(17).select(F.col("id").alias("stage"), (F.col("id") % 2 == 0).alias("expected"))
    return v.join(F.broadcast(expected), "stage").select("model_id", "stage", "passed", (F.col("passed") == F.col("expected")).alias("as_expected"))
